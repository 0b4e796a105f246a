"""Near-dedup, suffix-array dedup, language ID, quality classifier, pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationcast.llm import components, decontamination, language_id, mixing, near_dedup, pivots, quality, repeats, suffix_arrays
from stationcast.llm.common import held_out
from tests.llm import brute
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


# -- components and near-dedup ----------------------------------------------------------------

def test_components_of_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (202, 202)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys(range(200, 203), 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_grow_by_further_links(spark):
    frame = lambda links: spark.createDataFrame(links, "a long, b long")
    linked = lambda comps: {r["id"]: r["component"] for r in comps.collect()}
    first, more = [(9, 8), (8, 7), (4, 3), (20, 21)], [(9, 4), (7, 8), (2, 21), (30, 31), (5, 5)]
    old = components.components(frame(first))
    for links in (more, [], [(3, 4)], [(1, 9)]):
        new = components.grown(old, frame(links))
        assert linked(new) == linked(components.components(frame(first + links)))
        assert new.count() == len(linked(new))
    assert linked(components.grown(components.components(frame([])), frame(more))) == linked(components.components(frame(more)))


def near_texts():
    rng = random.Random(4)
    docs, i = [], 0
    for size in (1, 2, 3, 12, 60):  # groups of copies with more and more words changed
        base = prose(rng, 160).split()
        for k in range(size):
            w = list(base)
            for _ in range(k % 9):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            docs.append((i, " ".join(w).upper() if k % 2 else " ".join(w)))
            i += 1
    docs += [(i, docs[-1][1]), (i + 1, ""), (i + 2, "two words"), (i + 3, "Two  WORDS"), (i + 4, "one")]
    return docs


def test_near_duplicates_against_brute_force(spark):
    docs = near_texts()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for size, percent in ((3, 85), (5, 80)):
        expected = brute.near_components(docs, size, percent)
        got = near_dedup.near_duplicates(d, size=size, percent=percent).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == expected
        assert all(r["n_shingles"] == len(brute.shingles(dict(docs)[r["doc_id"]], size)) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_in_regions_dealt_over_tasks(spark, monkeypatch):
    docs = near_texts()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    reps = near_dedup.signatures(d, "text", "doc_id", 3, 60).where("n > 0").select(F.col("doc_id").alias("rep"), "sig")
    rows = near_dedup.forest(reps, 10)
    whole = {(r["a"], r["b"]) for r in near_dedup.neighbours(rows).collect()}
    dealt = {(r["a"], r["b"]) for r in near_dedup.neighbours(rows, region_rows=5).collect()}
    assert whole and dealt
    linked = lambda pairs: {r["id"]: r["component"] for r in components.components(spark.createDataFrame(sorted(pairs), "a long, b long")).collect()}
    assert linked(whole) == linked(dealt)  # leaders keep the pieces of a region together


def test_near_duplicates_edges(edge, empty, edge_rows):
    got = near_dedup.near_duplicates(edge).collect()
    assert len(got) == len(edge_rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (None, 3)}
    assert by[1]["component_id"] == by[10]["component_id"] == 0 and by[2]["component_id"] == 2 and by[2]["n_shingles"] == 0
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert near_dedup.near_duplicates(empty).count() == 0
    left = near_dedup.deduplicate(edge)
    assert left.columns == edge.columns and {r["doc_id"] for r in left.collect()} >= {0, None, 2, 4}


# -- suffix arrays ---------------------------------------------------------------------------

def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(80):
        n = int(rng.integers(0, 300))
        data = rng.integers(97, 97 + rng.integers(1, 4), n).astype(np.uint8)
        if trial % 3 == 0 and n:
            data = np.tile(data[:max(1, n // 7)], 8)[:n].copy()
        b, n = data.tobytes(), len(data)
        sa = suffix_arrays.suffix_array(data)
        assert list(sa) == sorted(range(n), key=lambda i: b[i:])
        got = suffix_arrays.common_prefixes(data, sa, n, np.array([0])[:n])
        for k in range(1, n):
            x, y = b[sa[k - 1]:], b[sa[k]:]
            m = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert got[k] == m


def test_removal_against_brute_force(spark):
    rng = random.Random(2)
    shared = [prose(rng, 20), "of " * 60, "é ü " * 30, prose(rng, 9)[:50]]
    docs = []
    for i in range(60):
        t = " ".join(rng.choice([prose(rng, 12), rng.choice(shared), rng.choice(shared)[:rng.randint(40, 80)]]) for _ in range(rng.randint(0, 6)))
        docs.append((i if i % 13 else i // 2, t))
    docs += [(None, shared[0] * 2), (None, shared[0]), (70, None), (71, docs[5][1]), (71, docs[5][1]), (72, "x" * 49), (73, "x" * 50)]
    expected = sorted((i is None, i, *x) for (i, _), x in zip(docs, brute.removed_bytes(docs)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for parameters in ({}, {"shard_bytes": 900}, {"shard_bytes": 500, "hot_shards": 2, "array_contexts": 7}):
        got = repeats.removal(d, **parameters).withColumn("sha", F.sha2("kept", 256)).collect()
        key = lambda x: (x[0], x[1] or 0, *x[2:])
        assert sorted(((r["doc_id"] is None, r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in got), key=key) == sorted(expected, key=key)


def test_removal_edges(edge, empty, edge_rows):
    got = repeats.digest(edge).collect()
    assert len(got) == len(edge_rows) and sum(r["n_removed"] for r in got) > 0
    assert repeats.digest(empty).count() == 0


# -- models ----------------------------------------------------------------------------------

def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.97
    assert np.mean([r["rejected"] for r in got]) <= 0.02 and all(0 <= r["score"] <= 1 for r in got)


def test_language_id_edges(spark, edge, empty, edge_rows):
    model = language_id.train([(k, prose(random.Random(k), 30, w).encode(), g) for k in range(60) for g, w in (("en", ("the", "house", "with")), ("xx", ("zuq", "qarr", "wol")))])
    got = language_id.identify(edge, model)
    assert set(edge.columns) - {"score"} <= set(got.columns)
    rows = got.collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        no_letter = not r["text"] or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == no_letter and (not no_letter or (r["score"] == 0 and r["rejected"]))
    assert language_id.identify(empty, model).count() == 0
    assert language_id.digest(empty).count() == 0
    none = language_id.identify(edge, language_id.train([]), passthrough=["doc_id"]).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


@pytest.mark.parametrize("learned", [("en", "de"), ("en", "de", "fr", "es")])
def test_language_id_rejects_noise_and_unlearned_languages(spark, learned):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") > 400)
    known = docs.where(F.col("lang").isin(*learned))
    model = language_id.fit(known)
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(120)) for _ in range(50)]
    other = [" ".join(rng.choice(("ja", "niin", "kuin", "että", "talossa", "kävelee", "hyvää", "yötä", "sinä", "minulla", "kukkien")) for _ in range(120)) for _ in range(50)]
    if len(learned) == 2:
        other += [r["text"] for r in docs.where("lang = 'es'").limit(50).collect()]
    for texts in (noise, other):
        got = language_id.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
        assert np.mean([r["rejected"] for r in got]) >= 0.95
    own = language_id.identify(known.where(held_out(F.col("doc_id"))), model).collect()
    assert len(own) > 50 and np.mean([r["rejected"] for r in own]) <= 0.02


def test_language_id_does_not_see_held_out_rows(spark):
    """Other labels on held-out rows change no prediction."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.digest(d).collect()} for d in (docs, changed))
    assert a == b


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 40 and np.mean([r["predicted"] == r["quality"] for r in got]) >= 0.9


def test_quality_attention_finds_the_passage_that_matters():
    """Bags are good unless one passage of several is bad: only weighting by passage can tell."""
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for k in range(300):
        bag = rng.normal(0, 0.3, (int(rng.integers(4, 9)), quality.FEATURES)).astype(np.float32)
        if k % 2:
            bag[rng.integers(len(bag)), :5] += 3
        bags.append(bag)
        labels.append(1.0 - k % 2)
    model = quality.train(bags, np.array(labels), epochs=30)
    x, lengths = model.scaled(np.concatenate(bags)), np.array([len(b) for b in bags])
    out = model.forward(x, np.cumsum(lengths) - lengths, lengths)
    assert np.mean((out["y"] >= 0.5) == np.array(labels)) > 0.95
    assert np.allclose(np.add.reduceat(out["a"], np.cumsum(lengths) - lengths), 1)


def test_quality_edges(spark, edge, empty, edge_rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (4, None), (5, 0)], "doc_id long, quality int")
    got = quality.digest(edge, labels).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert quality.digest(empty, labels).count() == 0
    assert {r["score"] for r in quality.digest(edge, labels.limit(0)).collect()} == {0.5}


# -- pipeline --------------------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    """Every stage against its brute-force version, each on what the stage before left."""
    sf_dir, stages = "/root/testdata/sf0.001", dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pull = lambda d: {r["doc_id"]: r for r in d.collect()}
    pairs = lambda rows: [(i, r["text"]) for i, r in rows.items()]

    kept = stages["language_id"](spark, docs, sf_dir).cache()
    model = language_id.fit(docs)
    start = pull(docs)
    p = model.probabilities([r["text"].encode() for r in start.values()]).max(axis=1)
    assert set(pull(kept)) == {i for i, x in zip(start, p) if language_id.has_letter(start[i]["text"]) and x >= model.reject_below}
    assert kept.columns == docs.columns

    lines = stages["line_dedup"](spark, kept, sf_dir).cache()
    assert {i: r["text"] for i, r in pull(lines).items()} == brute.line_dedup(pairs(pull(kept)))
    assert lines.columns == docs.columns

    near = stages["near_dedup"](spark, lines, sf_dir).cache()
    groups = brute.near_components(pairs(pull(lines)), 5, 80)
    assert set(pull(near)) == {i for i, c in groups.items() if i == c} and near.columns == docs.columns

    clean = stages["decontamination"](spark, near, sf_dir).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute.contaminated(pairs(pull(near)), items, decontamination.MASKS, decontamination.SPAN, decontamination.WINDOW, decontamination.SHARE)}
    assert set(pull(clean)) == set(pull(near)) - bad and clean.columns == docs.columns

    out = pull(stages["mixing"](spark, clean, sf_dir))
    weights = {r["doc_id"]: 4.0 ** (r["quality"] - 0.5) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    taken, _ = brute.mix([(i, r["text"], r["source"]) for i, r in pull(clean).items()], weights, mixing.SEED)
    assert {i: r["taken"] for i, r in out.items()} == {i: n for i, n in taken.items() if n}
    whole = pull(corpus_pipeline.run(spark, sf_dir))
    assert {i: r["taken"] for i, r in whole.items()} == {i: r["taken"] for i, r in out.items()}


def test_pipeline_stages_on_edge_rows_and_empty_input(spark, edge, empty):
    sf_dir = "/root/testdata/sf0.001"
    for d in (edge, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, sf_dir)
            assert set(d.columns) <= set(out.columns) and out.count() <= d.count(), name


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 14)} and "pipeline" in entry.queries()


def test_chunks_are_shift_resistant(spark):
    """Two lines put in front of a text change its first chunks only; the cuts are those of a plain rolling hash."""
    import hashlib
    from stationcast.llm import line_dedup
    lines = [f"line {k * k % 97} of {k}" for k in range(200)]
    texts = ["\n".join(lines), "\n".join(["new", "lines"] + lines)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: [(c["start"], c["stop"]) for c in r["c"]] for r in d.select("i", line_dedup.chunks(F.split("t", "\n", -1)).alias("c")).collect()}
    for i, t in enumerate(texts):
        h = [0, 0] + [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in t.split("\n")]
        ends = [k + 1 for k in range(len(h) - 2) if (h[k + 2] + 31 * h[k + 1] + 961 * h[k]) % 4 == 0 or k == len(h) - 3]
        assert [b for _, b in got[i]] == ends and [a for a, _ in got[i]] == [0, *ends[:-1]]
    moved = {(a - 2, b - 2) for a, b in got[1]}
    assert len(set(got[0]) - moved) <= 2 and 20 < len(got[0]) < 100


@pytest.mark.parametrize("name", ["op2_line_dedup", "op8_mixing", "op9_decontamination"])
def test_sql_queries_match_duckdb(spark, duck, name):
    from stationcast.llm.queries import ORACLE, QUERIES
    from tools.oracle_check import compare
    result = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF)
    assert result["ok"], result.get("why")


@pytest.mark.parametrize("small, region_rows", [(2, 25), (16, 20_000)])
def test_near_duplicates_of_a_hot_group(spark, monkeypatch, small, region_rows):
    """Near copies of all distances, and a passage in many foreign texts: large regions go through pivots."""
    from tests.llm.test_parity_join import hot_documents
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "REGION_ROWS", region_rows)
    docs = hot_documents(5, near=90)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == brute.near_components(docs, 3, 85)


def test_near_duplicates_of_repeated_numbers(spark):
    """Numbers with two texts: each is linked with what either text is linked with."""
    import random
    rng = random.Random(8)
    text = lambda: " ".join(f"v{rng.randrange(900)}" for _ in range(50))
    base, rows = text(), []
    for i in range(0, 24, 2):
        other = text()
        rows += [(i, base + f" e{i}"), (i, other), (i + 1, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in near_dedup.near_duplicates(df).collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert got[0] == {0} and all(got[i] == {0} for i in range(0, 24, 2)) and all(len(v) == 1 for v in got.values())
    assert all(got[i] == {0} for i in range(1, 24, 2))  # the second text of an even number


def test_small_sides_are_not_a_reason_to_shuffle_texts(spark):
    """What is left out is a few rows; the texts of all others stay where they lie."""
    texts = [f"{' '.join(f'w{i}x{j}' for j in range(30))}" for i in range(40)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([("i", texts[7])], "item_id string, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    near, clean = near_dedup.deduplicate(d), decontamination.decontaminate(d, bench)
    weighed = mixing.with_quality(d, labels)
    assert sorted(r["doc_id"] for r in near.collect()) == list(range(40))
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i in range(41) if i != 7]
    for frame in (near, clean, weighed):
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_elements_of_the_pivot_are_not_dealt_out(spark, monkeypatch):
    """Members far from a pivot all lack the same elements of it; these would meet in pairs."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 60, 200))
    sets = [base] + [np.unique(np.r_[base[:60], rng.integers(0, 1 << 60, 140)]) for _ in range(60)]
    sets += [np.r_[sets[-1][1:], 1 << 61], np.r_[base[:90], 1 << 61]]
    table = spark.createDataFrame([(i, 0, len(s), sorted(map(int, s))) for i, s in enumerate(sets)], "rep long, tag long, n long, set array<bigint>")
    seen = {}
    staged = pivots.staged
    monkeypatch.setattr(pivots, "staged", lambda df, label, *a: seen.setdefault(label, staged(df, label, *a)))
    members = spark.createDataFrame([(0, i) for i in range(len(sets))], "pivot long, rep long")
    star, candidates = pivots.hot_links(members, table, spark.createDataFrame([], "id long, component long"), 85)
    assert star.count() == 0 and {(r["a"], r["b"]) for r in candidates.collect()} >= {(61, 60)}
    assert candidates.count() < 5
    assert sum(f.count() for k, f in seen.items() if k in ("pivot-elements", "pivot-first")) < 1.2 * sum(len(np.setdiff1d(s, base)) for s in sets)
    assert seen["pivot-elements"].where(F.col("h").isin([int(x) for x in base])).count() == 0


def test_suffixes_equal_in_their_first_bytes_are_told_apart():
    rng = np.random.default_rng(8)
    for unit in (1, 5, 8, 13):
        data = np.tile(rng.integers(97, 99, unit).astype(np.uint8), 60)
        raw = data.tobytes()
        assert suffix_arrays.suffix_array(data).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_little_is_sent_between_many_small_shards(spark, monkeypatch):
    """A large input has few keys for each pair of shards, and more short strings that repeat by chance."""
    rng = random.Random(11)
    shared = [prose(rng, 25) for _ in range(4)]
    docs = [(i, " ".join([prose(rng, 120), rng.choice(shared), prose(rng, 120)])) for i in range(120)]
    made = []
    for kind in (type(spark.range(1).groupBy("id")), type(spark.range(1).groupBy("id").cogroup(spark.range(1).groupBy("id")))):
        monkeypatch.setattr(kind, "applyInArrow", lambda self, f, schema, call=kind.applyInArrow: made.append(call(self, f, schema)) or made[-1])
    repeats.removal(spark.createDataFrame(docs, "doc_id long, text string"), shard_bytes=1000)
    monkeypatch.undo()
    sizes = [d.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) if k == "binary" else F.lit(0)) + 8 for c, k in d.dtypes))).first()[0] for d in made[:-1]]
    assert len(sizes) == 4 and sum(sizes) < 0.6 * sum(len(t) for _, t in docs)


def test_each_window_is_in_the_context_of_one_anchor():
    rng = random.Random(12)
    texts = [prose(rng, 60).encode(), b"x" * 49, b"", prose(rng, 9).encode()[:50], "é ü ".encode() * 30, prose(rng, 200).encode()]
    ids = list(range(len(texts)))
    shard = repeats.Shard(pa.table({"doc_id": ids, "doc": ids, "n": [len(t) for t in texts], "bytes": pa.array(texts, pa.binary())}))
    keys = np.unique(shard.key)
    for hot in (False, True):
        rows, size, _, _, number, base, at = shard.contexts(keys, np.full(len(keys), hot))
        held = {}
        for k, b, own in zip(number, base, at):
            assert rows[k, :size[k]].tobytes() == texts[own][b - shard.start[own]:][:size[k]] and (rows[k, size[k]:] == repeats.OUTSIDE).all()
            for w in range(b, b + size[k] - repeats.LENGTH + 1):
                held[w] = held.get(w, 0) + 1
        assert sorted(held) == [s + w for s, t in zip(shard.start.tolist(), texts) for w in range(len(t) - repeats.LENGTH + 1)]
        plain = [n for w, n in held.items() if not shard.start[4] <= w < shard.end[4]]  # that text repeats within a window
        assert set(plain) == {1}
