"""The n-gram join by parity sketches, and links in hot groups by pivots, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.llm import parity_join, pivots
from stationcast.llm.components import components
from tests.llm import brute


def classes(df):
    return {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in df.collect()}


def expected(docs, size=4, percent=85):
    comp = brute.near_components(docs, size, percent)
    return {(i, len(brute.shingles(t, size))): comp[i] for i, t in docs}


def hot_documents(seed, near=160, words=70):
    """One group of near copies of very different distances, one passage that many foreign texts hold, some pairs and short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    base = [word() for _ in range(words)]
    passage = [word() for _ in range(40)]
    docs = [(1, " ".join(base))]
    for i in range(2, near):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 1, 2, 2, 3, 4])):
            w[rng.randrange(words)] = f"edit{rng.randrange(6)}" if rng.random() < 0.5 else f"own{i}x{rng.randrange(99)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join([word() for _ in range(30)] + passage)) for i in range(60)]
    docs += [(2000 + i, " ".join([word() for _ in range(rng.randint(1, 9))])) for i in range(40)]
    docs += [(3000 + i, " ".join(passage + [f"tail{i // 3}"] * (i % 3))) for i in range(30)]
    rng.shuffle(docs)
    return docs


def test_sizes_bands_and_blocks():
    for percent in (50, 80, 85, 95):
        edges = parity_join.size_edges(percent, 100_000)
        for a in [*range(1, 400), 997, 5000, 31_111]:
            b = a * 100 // percent  # the largest partner
            for partner in {a, b, (a + b) // 2}:
                both = set(parity_join.windows(a, edges)) & set(parity_join.windows(partner, edges))
                assert both, (percent, a, partner)
                apart = (a + partner) * (100 - percent) // (100 + percent)
                for count, spare in (parity_join.blocks(m, edges, percent) for m in both):
                    assert count - spare > apart or (count == 0 and apart == 0)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        common, x, y = (rng.integers(-(1 << 62), 1 << 62, rng.integers(1, 300)) for _ in range(3))
        a, b = (np.unique(np.concatenate([common, v])) for v in (x, y))
        apart = len(np.setxor1d(a, b))
        assert parity_join.hamming(parity_join.one_sketch(a), parity_join.one_sketch(b)) <= apart
        spare = int(rng.integers(0, 9))
        s = [parity_join.block_codes(parity_join._mixed(v, 1), apart + 1 + spare) for v in (a, b)]
        assert np.sum(s[0] == s[1]) > spare


def test_join_against_brute_force(small):
    docs, rows = small
    assert classes(parity_join.jaccard_classes(docs)) == expected(rows)


@pytest.mark.parametrize("seed, few", [(1, 2), (2, 8)])
def test_hot_groups_against_brute_force(spark, seed, few):
    """With few members to a small group nearly all goes through pivots."""
    docs = hot_documents(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert classes(parity_join.jaccard_classes(df, small=few)) == expected(docs)


def test_pivots_lose_no_link(spark):
    """Any pivot, also one that is far from all, and groups of unlike sets."""
    rng = random.Random(9)
    sets = {0: list(range(100))}
    for i in range(1, 120):
        s = set(range(100))
        for _ in range(rng.randint(0, 9)):
            s.discard(rng.randrange(100))
            s.add(1000 + rng.randrange(12) if rng.random() < 0.5 else 5000 + 100 * i + rng.randrange(50))
        sets[i] = sorted(s)
    for i in range(120, 160):
        sets[i] = sorted({*range(200, 240), *[9000 + rng.randrange(40) for _ in range(rng.randint(2, 12))]})
    table = spark.createDataFrame([(i, 0, len(s), s) for i, s in sets.items()], "rep long, tag long, n long, set array<bigint>")
    linked = {(a, b) for a in sets for b in sets if a > b and 100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))}
    root = list(range(160))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    none = spark.createDataFrame([], "id long, component long")
    for pivot in (0, 7, 150):
        members = spark.createDataFrame([(pivot, i) for i in sets], "pivot long, rep long")
        star, candidates = pivots.hot_links(members, table, none, 85)
        star, candidates = ({(r["a"], r["b"]) for r in x.collect()} for x in (star, candidates))
        assert star <= linked
        links = spark.createDataFrame([*star, *(candidates & linked)], "a long, b long")
        comp = {r["id"]: r["component"] for r in components(links).collect()}
        assert {i: comp.get(i, i) for i in sets} == {i: find(i) for i in sets}


def test_join_edges(spark, edge, empty, edge_rows):
    got = parity_join.jaccard_classes(edge).collect()
    assert len(got) == len(edge_rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[2] == {2} and by[4] == {4} and by[1] == {0} and by[10] == {0} and by[None] == {None}
    assert parity_join.jaccard_classes(empty).count() == 0


def test_rows_of_one_key_are_one_document(spark):
    rng = random.Random(2)
    text = lambda: " ".join(f"v{rng.randrange(500)}" for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(5, a), (5, b), (3, b), (9, a + " more"), (7, c), (7, c), (8, None), (8, c + " x")]
    schema = "doc_id long, text string, Component_Id string, `a.b` int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema).repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in parity_join.jaccard_classes(df).where(F.col("n_shingles") > 0).collect()} == {5: 3, 3: 3, 9: 3, 7: 7, 8: 7}
