"""Prefix trie (Euler tour, list ranking) and embedding whitening against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.llm import prefix_trie, scans, whitening
from tests.llm import brute

TRIE_COLUMNS = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def as_nodes(df):
    rows = df.collect()
    got = {(r["conv_id"], r["depth"]): tuple(r[c] for c in TRIE_COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def made_conversations(seed, n=90):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, None]) if t == 0 else t, rng.choice(["user", "bot", None]), rng.choice(["hello there", "a b  c", "", None, "x"])))
    rows += [(-5, 0, "u", "neg"), (-20, 0, "u", "below"), (None, 0, "u", "no number"), (3, 50, "u", "same"), (3, 50, "u", "same"), (10_000_000_007, 2, None, None)]
    return rows


# -- scans -----------------------------------------------------------------------------------

def test_scan_numbers_and_sums(spark):
    rows = [(i * 7919 % 1000, "hot" if i % 3 else str(i), (i * i) << 40) for i in range(1000)]
    df = spark.createDataFrame(rows, "v long, k string, w long").repartition(5)
    got = sorted(((r["ix"], r["k"], r["v"], r["w_upto"]) for r in scans.scan(df, ["k", "v"], ["w"]).collect()))
    order, total = sorted((k, v, w) for v, k, w in rows), 0
    for (ix, k, v, upto), (n, (bk, bv, w)) in zip(got, enumerate(order)):
        total = (total + w) % scans.MODULUS
        assert (ix, k, v, upto) == (n, bk, bv, total)
    assert len(got) == 1000 and scans.scan(df.limit(0), ["k", "v"], ["w"]).count() == 0


# -- prefix trie -----------------------------------------------------------------------------

@pytest.mark.parametrize("seed, run_rows, walked", [(1, prefix_trie.RUN_ROWS, prefix_trie.WALKED), (2, 1, 3), (3, 7, 0)])
def test_trie_against_brute_force(spark, seed, run_rows, walked):
    """With few arcs in a run and few pieces walked, all of the list goes through random mates."""
    rows = made_conversations(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    if walked == 0:
        walked = 1  # one piece is what a ranked list ends as
    assert as_nodes(prefix_trie.trie(df, run_rows=run_rows, walked=walked)) == brute.prefix_trie(rows)


def test_trie_of_a_long_and_many_equal_conversations(spark):
    """A third of all turns in one conversation, another third in equal ones."""
    rows = [(7, t, "user", f"turn {t % 5}") for t in range(400)]
    rows += [(20 * c, t, "user", f"same {t}") for c in range(1, 101) for t in range(4)]
    rows += [(10_001 + c, t, "user", "z" * 3000 + str(c)) for c in range(100) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert as_nodes(prefix_trie.trie(df, run_rows=50, walked=20)) == brute.prefix_trie(rows)


def test_trie_edges(spark):
    schema = "conv_id long, turn long, role string, text string, Depth string, ix int, `a.b` int, Conv_Id2 string"
    rows = [(1, None, None, None, "x", 1, None, None), (1, 0, "u", "a " * 50_000, "x", 1, None, None), (None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    assert as_nodes(prefix_trie.trie(df)) == brute.prefix_trie([r[:4] for r in rows])
    assert prefix_trie.trie(df.limit(0)).count() == 0
    assert prefix_trie.trie(df.where("conv_id is null")).count() == 0
    alone = as_nodes(prefix_trie.trie(df.where("turn is null and conv_id is not null")))
    assert alone == brute.prefix_trie([rows[0][:4]])


def test_list_ranks_of_a_shuffled_list(spark):
    rng = random.Random(5)
    ids = rng.sample(range(10_000), 700)
    links = spark.createDataFrame([(a, b) for a, b in zip(ids, [*ids[1:], None])], "id long, succ long").orderBy(F.xxhash64("id"))
    got = {r["id"]: r["rank"] for r in prefix_trie.list_ranks(links, run_rows=64, walked=5).collect()}
    assert got == {x: k for k, x in enumerate(ids)}


def test_member_digests_over_many_pieces(spark):
    import hashlib
    members = {0: list(range(5, 3000, 2)), 3: [7], 4: [-30, -4, 12]}
    df = spark.createDataFrame([(k, c) for k, v in members.items() for c in v], "ix long, conv long").repartition(5)
    got = {r["ix"]: r["ends_sha256"] for r in prefix_trie.member_digests(df, piece=100).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in members.items()}


# -- whitening -------------------------------------------------------------------------------

def check_whitened(got, rows, most=16):
    kept, n, sums, values, vectors, cov = brute.whitened(rows, most)
    size = int(np.sum(values > whitening.NOISE * values[0]))
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, size + 1)) and len(got) == size * len(kept)
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-4
    exact = sorted((str(i), sum((n * v - s) ** 2 for v, s in zip(x, sums))) for i, x in kept)
    for k in range(1, size + 1):
        assert sorted((str(r["vec_id"]), r["deviation"]) for r in by[k]) == exact
        assert all(abs(r["explained"] - values[k - 1] / np.trace(cov)) < 1e-8 for r in by[k])
    return kept, n, sums, values, vectors


def test_whitening_against_numpy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    rows += [rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1]), (9_001, None), (9_002, [None, *rows[0][1][1:]]), (9_003, [math.nan, *rows[0][1][1:]]), (9_004, [math.inf, *rows[0][1][1:]])]
    more = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = whitening.whiten(more).collect()
    kept, n, sums, values, vectors = check_whitened(got, rows)
    expected = {}
    for i, x in kept:
        expected.setdefault(str(i), []).append((np.array([v - s / n for v, s in zip(x, sums)]) @ vectors) / np.sqrt(values))
    found = {}
    for r in got:
        found.setdefault(str(r["vec_id"]), {}).setdefault(r["component"], []).append(r["whitened"])
    for i, rows_ in expected.items():
        if len(rows_) == 1:
            mine = np.array([found[i][k][0] for k in range(1, 17)])
            assert np.allclose(np.abs(mine), np.abs(rows_[0]), atol=1e-7)


def test_whitening_equal_eigenvalues(spark):
    """All eigenvalues equal: any turned basis is right, as long as it is orthonormal."""
    rows = [(k, [float(s * (j == d)) for j in range(6)]) for k, (d, s) in enumerate((d, s) for d in range(6) for s in (-1, 1))]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check_whitened(got, rows)
    table = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    w = np.array([[table[k, c] for c in range(1, 7)] for k in range(12)])
    assert np.allclose(w.T @ w / 12, np.eye(6), atol=1e-12)


def test_whitening_edges(spark):
    schema = "vec_id string, embedding array<double>, X int, Component int, `a.b` string"
    flat = [("a", [1.0, 2.0], 1, 1, "q"), ("b", [3.0, 2.0], 1, 1, "q"), ("b", [3.0, 2.0], None, None, None), ("c", [1.0, 2.0, 3.0], 1, 1, "q"), (None, None, 1, 1, "q"), ("e", [], 1, 1, "q")]
    df = spark.createDataFrame(flat, schema)
    got = whitening.whiten(df).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 12), r["explained"]) for r in got) == [("a", 1, 1.0, 1.0), ("b", 1, 1.0, 1.0), ("b", 1, 1.0, 1.0)]
    for none in (df.limit(0), df.where("vec_id = 'a'"), df.where("vec_id = 'e'"), df.where("vec_id is null")):
        assert whitening.whiten(none).count() == 0
    huge = [("a", [1e30, 0.0], 1, 1, "q"), ("b", [-1e30, 1.0], 1, 1, "q"), ("c", [0.0, 5.0], 1, 1, "q")]
    far = whitening.whiten(spark.createDataFrame(huge, schema)).collect()
    assert {r["deviation"] for r in far if r["vec_id"] != "c"} == {None}


def test_deviations_beyond_int64_arithmetic():
    x = np.array([[1_000_000, 5], [1_000_003, 9]])
    n, sums = 10 ** 9, [1_000_001 * 10 ** 9 + 7, 6 * 10 ** 9 + 1]
    base, rest = (np.array(v) for v in zip(*[divmod(s, n) for s in sums]))
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
    assert whitening.deviations(x, n, base, rest) == [v if v < 1 << 63 else None for v in exact]
