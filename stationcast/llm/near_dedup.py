"""MinHash near-dedup with an LSH forest.

Documents are sets of word shingles.  Equal sets are folded into one
representative (the smallest doc_id) first.  Every representative has a MinHash
signature; each tree of the forest reads it in another order and is a sorted
order of all representatives, kept as hashes of its prefixes of three depths.
The number of trees follows from the threshold, so that a pair just at it
shares the shallowest prefix in some tree but for about MISS of the cases.

Neighbours of longest common prefix in the sorted orders are the first
candidates: each representative's best one by signature is confirmed on the
full shingle sets, then the best pairs between the components so far.  A region
(one shallow prefix) of many members is cut by its next deeper prefix, where
that is still large by the deepest, and only what agrees in all of it is dealt
by a hash, so the depth follows the region.

What remains are regions that hold several components.  In a region of few
members the pairs between components are candidates.  In a large one, as of
thousands of near copies, links are settled by the differences from a pivot
(pivots.py), the central member of the region's main component: members that
are both linked with it need no comparison, and others only where their
differences from it have enough in common.  Both ways lose no link.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.common import BATCH_ROWS, ascii_lower, map_batches, named, sheltered, staged, words
from stationcast.llm.components import components, grown
from stationcast.llm.pivots import hot_links
from stationcast.operators.common import BROADCAST_MAX_BYTES, bounded, measured_bytes

#: Prefix depths of a tree.  The first alone makes a region.
DEPTHS = (6, 10, 14)
#: Share of pairs exactly at the threshold that no tree may bring together.
MISS = 2e-6
#: Standard errors below the threshold at which a signature rules a pair out.
SLACK = 5.4
#: Members of a region that are sorted in one piece; larger ones are cut by a deeper prefix.
REGION_ROWS = 20_000
#: Members of a region whose pairs between components are candidates themselves.
SMALL = 16
_CHUNK = 2048


def n_trees(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold ** DEPTHS[0]))


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: Column, size: int) -> Column:
    """Distinct hashes of the text's shingles; a shorter text is one shingle, one without words has none."""
    w = F.transform(words(ascii_lower(text)), lambda x: F.xxhash64(x))

    def of(h: Column) -> Column:
        moving = F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(F.size(h) >= size, F.array_distinct(moving)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return F.element_at(F.transform(F.array(w), of), 1)


def signatures(docs: DataFrame, text: str, key: str, size: int, mins: int) -> DataFrame:
    """(doc_id, n, k1, k2, sig): size of the set, 128 bits that tell sets apart, MinHash values."""
    own = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), shingle_hashes(F.col(f"`{text}`"), size).alias("set"))
    mult, mix = _odd(mins, 1), _odd(2, 2)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = batch.column(1)
        values, offsets = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64), sets.offsets.to_numpy()
        offsets = offsets - offsets[0]
        keys, sigs = np.zeros((len(sets), 2), np.uint64), []
        for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
            x = values[a:b]
            if not len(x):
                sigs.append(None)
                continue
            for k in (0, 1):
                y = (x ^ (x >> np.uint64(29 + k))) * mix[k]
                keys[i, k] = np.sum(y ^ (y >> np.uint64(32)), dtype=np.uint64)
            low = np.full(mins, ~np.uint64(0))
            for c in range(0, len(x), _CHUNK):
                np.minimum(low, (x[c:c + _CHUNK, None] * mult).min(axis=0), out=low)
            sigs.append((low >> np.uint64(32)).astype(np.uint32).tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(keys[:, 0].view(np.int64)),
                                           pa.array(keys[:, 1].view(np.int64)), pa.array(sigs, pa.binary())], ["doc_id", "n", "k1", "k2", "sig"])
    return map_batches(own, run, "doc_id long, n long, k1 long, k2 long, sig binary")


def forest(reps: DataFrame, trees: int) -> DataFrame:
    """(region, mid, deep, rep): a row for every representative and tree; hashes
    of the tree's prefixes, each of which starts with the one before."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sig = np.stack([np.frombuffer(s, np.uint32) for s in batch.column(1).to_pylist()]).astype(np.uint64)
        mult, out = _odd(DEPTHS[-1] + 1, 3), []
        for t in range(trees):
            order = (t * DEPTHS[0] + np.arange(DEPTHS[-1])) % sig.shape[1]
            h = np.full(len(sig), (t + 1) * int(mult[-1]) % (1 << 64), np.uint64)
            levels = []
            for d, c in enumerate(order):
                h = (h ^ sig[:, c]) * mult[d]
                h ^= h >> np.uint64(31)
                if d + 1 in DEPTHS:
                    levels.append(h.copy().view(np.int64))
            out.append(levels)
        cols = [np.concatenate([levels[k] for levels in out]) for k in range(len(DEPTHS))]
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(np.tile(batch.column(0).to_numpy(), trees))], ["region", "mid", "deep", "rep"])
    return map_batches(reps.select("rep", "sig"), run, "region long, mid long, deep long, rep long")


def _large(rows: DataFrame, prefix: list[str], most: int) -> DataFrame:
    return staged(rows.groupBy(*prefix).agg(F.count("*").alias("n")).where(F.col("n") > most), "near-large")


def neighbours(tree_rows: DataFrame, region_rows: int = REGION_ROWS) -> DataFrame:
    """Distinct pairs (a > b) that lie side by side in some sorted order.

    A region of more than ``region_rows`` is sorted in parts: one for each of its
    next deeper prefixes, for those that are large themselves one for each of the
    deepest, and of those several by a hash.  The region's least member is put
    into every part, so the parts stay connected."""
    names = ["region", "mid", "deep"]
    rows, large = tree_rows.withColumn("part", F.lit(0).cast("long")), _large(tree_rows, names[:1], region_rows)
    if not large.isEmpty():
        hot = staged(tree_rows.join(bounded(large.select("region")), "region"), "near-hot")
        by_mid, by_deep = _large(hot, names[:2], region_rows), _large(hot, names, region_rows)
        cut = (hot.join(bounded(by_mid.select("region", "mid", F.lit(True).alias("mid_large"))), names[:2], "left")
               .join(bounded(by_deep.withColumnRenamed("n", "deep_n")), names, "left"))
        deal = F.pmod(F.xxhash64("rep"), F.ceil(F.coalesce("deep_n", F.lit(1)) / region_rows))
        cut = cut.withColumn("part", F.when(F.col("mid_large").isNull(), F.xxhash64("mid")).otherwise(F.xxhash64("mid", "deep", deal)))
        leaders = cut.select("region", "part").distinct().join(hot.groupBy("region").agg(F.min("rep").alias("rep")), "region")
        none = F.lit(None).cast("long")
        rows = (rows.join(bounded(large.select("region")), "region", "left_anti").select(*names, "rep", "part")
                .unionByName(cut.select(*names, "rep", "part")).unionByName(leaders.select("region", none.alias("mid"), none.alias("deep"), "rep", "part")))
    before = F.lag("rep").over(Window.partitionBy("region", "part").orderBy("mid", "deep", "rep"))
    return _pairs(rows.select("rep", before.alias("other")).where(F.col("other").isNotNull()), "rep", "other")


def _pairs(frame: DataFrame, a: str, b: str) -> DataFrame:
    return frame.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def _beside(pairs: DataFrame, rows: DataFrame, value: str) -> DataFrame:
    """The pairs (a, b) with ``value``_a and ``value``_b of ``rows`` (rep, value).  Pairs of
    measured size go to the rows of ``a``, so these are not shuffled; in no more
    tasks than the pairs fill Arrow batches."""
    own = lambda c: rows.select(F.col("rep").alias(c), F.col(value).alias(f"{value}_{c}"))
    pairs = staged(pairs.select("a", "b"), "near-asked")
    few = measured_bytes(pairs) <= BROADCAST_MAX_BYTES
    both = own("a").join(F.broadcast(pairs) if few else pairs, "a").join(own("b"), "b").select("a", "b", f"{value}_a", f"{value}_b")
    return both.coalesce(max(1, -(-pairs.count() // BATCH_ROWS))) if few else both


def estimated(pairs: DataFrame, reps: DataFrame, floor: float) -> DataFrame:
    """(a, b, est) of the pairs whose signatures agree in at least a share ``floor``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.stack([np.frombuffer(s, np.uint32) for s in batch.column(c).to_pylist()]) for c in ("sig_a", "sig_b"))
        est = (x == y).mean(axis=1)
        keep = pa.array(est >= floor)
        return pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(est).filter(keep)], ["a", "b", "est"])
    return map_batches(_beside(pairs, reps, "sig"), run, "a long, b long, est double")


def shingle_set(text: str, size: int) -> set[tuple[str, ...]]:
    """The shingles themselves, for the exact check."""
    w = [x for x in text.translate(_LOWER).translate(_BLANK).split(" ") if x]
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


_LOWER = {c: c + 32 for c in range(65, 91)}
_BLANK = {c: 32 for c in range(9, 14)}


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * common >= percent * together, on their whole sets."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, last, held = [], None, set()
        for s, t in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
            x = shingle_set(s, size)
            if t != last:
                last, held = t, shingle_set(t, size)
            common = len(x & held)
            keep.append(100 * common >= percent * (len(x) + len(held) - common))
        mask = pa.array(keep)
        return pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])
    return map_batches(_beside(pairs, texts, "text"), run, "a long, b long")


def _labelled(frame: DataFrame, comps: DataFrame, vertex: str, out: str) -> DataFrame:
    """``frame`` with the component of ``vertex``, itself where it has no link."""
    return (frame.join(bounded(comps.select(F.col("id").alias(vertex), F.col("component").alias(out))), vertex, "left")
            .withColumn(out, F.coalesce(out, vertex)))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are linked where 100 * common shingles >= percent * together; the
    component is the smallest doc_id that can be reached over links.  Null,
    empty and blank texts have no shingles and are linked with nothing.  Keys
    must be integers.  Rows without a key have no component and are kept.  Rows of one key are one
    document, linked with what any of its rows is linked with.  An empty table
    gives an empty result; other columns are not read."""
    threshold = percent / 100
    trees = n_trees(threshold)
    mins = trees * DEPTHS[0]
    floor = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / mins)
    base = staged(signatures(docs, text, key, size, mins), "near-signatures")
    full = base.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # copies are few rows or narrow ones; signatures of first documents stay where they lie
    known = full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    known = staged(full.select("doc_id", "n", "k1", "k2").join(known, ["k1", "k2"]), "near-known")
    copies = known.where(F.col("doc_id") != F.col("rep")).select("doc_id", "k1", "k2").distinct()
    reps = full.join(bounded(copies), ["doc_id", "k1", "k2"], "left_anti").select(F.col("doc_id").alias("rep"), "sig")
    rows = forest(reps, trees)
    regions = staged(rows.groupBy("region").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where(F.col("low") != F.col("high")).select("region"), "near-shared")
    shared = staged(rows.join(bounded(regions), "region", "left_semi"), "near-forest")  # rows alone in their region are no one's candidates
    involved = staged(shared.select("rep").distinct(), "near-involved")
    texts = staged(docs.select(F.col(f"`{key}`").cast("long").alias("rep"), F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull())
                   .join(bounded(involved), "rep", "left_semi"), "near-texts")
    reps = staged(reps.join(bounded(involved), "rep", "left_semi"), "near-reps")
    close = staged(estimated(neighbours(shared), reps, floor), "near-pairs")
    both = close.unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "est"))
    best = both.groupBy("a").agg(F.max_by("b", F.struct("est", -F.col("b"))).alias("b"))
    links = staged(confirmed(_pairs(best, "a", "b"), texts, size, percent), "near-links")
    comps = staged(components(links), "near-components")

    apart = _labelled(_labelled(close, comps, "a", "ca"), comps, "b", "cb").where(F.col("ca") != F.col("cb"))
    rank = F.struct("est", "a", "b")
    between = (apart.groupBy(F.greatest("ca", "cb").alias("x"), F.least("ca", "cb").alias("y")).agg(F.max(rank).alias("p")).select("p.a", "p.b"))
    comps = grown(comps, staged(confirmed(between, texts, size, percent), "near-links"))

    members = staged(_labelled(shared.select("region", "rep"), comps, "rep", "c"), "near-members")
    held = staged(members.groupBy("region", "c").agg(F.count("*").alias("n")).groupBy("region").agg(
        F.count("*").alias("parts"), F.sum("n").alias("size"), F.max_by("c", F.struct("n", "c")).alias("main")), "near-held")
    open_ = staged(members.join(held.where(F.col("parts") > 1).select("region", "size", "main"), "region"), "near-regions")
    few = open_.where(F.col("size") <= SMALL)
    across = (few.alias("x").join(few.alias("y"), "region").where((F.col("x.rep") > F.col("y.rep")) & (F.col("x.c") != F.col("y.c")))
              .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct())
    comps = grown(comps, staged(confirmed(staged(estimated(across, reps, floor), "near-rest"), texts, size, percent), "near-links"))
    wide = open_.where(F.col("size") > SMALL)
    mains = wide.select(F.col("main").alias("c")).distinct()
    central = (members.join(bounded(mains), "c", "left_semi").join(held.select("region", "size"), "region").groupBy("rep", "c").agg(F.sum("size").alias("score"))
               .groupBy(F.col("c").alias("main")).agg(F.max_by("rep", F.struct("score", -F.col("rep"))).alias("pivot")))
    groups = staged(wide.join(bounded(staged(central, "near-central")), "main").select("pivot", "rep").distinct(), "near-groups")
    both = groups.select("rep").unionByName(groups.select(F.col("pivot").alias("rep"))).distinct()
    sets = texts.join(bounded(both), "rep", "left_semi").select("rep", F.array_sort(shingle_hashes(F.col("text"), size)).alias("set"))
    sets = staged(sets.select("rep", F.xxhash64("set").alias("tag"), F.size("set").cast("long").alias("n"), "set").dropDuplicates(["rep", "tag"]), "near-sets").where(F.col("n") > 0)
    star, candidates = hot_links(groups, sets, comps, percent)
    links = staged(confirmed(star.unionByName(candidates).distinct(), texts, size, percent), "near-links")
    # a number of several texts joins their groups
    named = known.select("doc_id", "rep", "k1", "k2").distinct()
    several = named.groupBy("doc_id").agg(F.count("*").alias("sets")).where(F.col("sets") > 1).select("doc_id")
    comps = grown(comps, links.unionByName(_pairs(named.join(several, "doc_id", "left_semi"), "doc_id", "rep")))

    known = _labelled(known, comps, "rep", "component_id")
    alone = base.where((F.col("n") == 0) | F.col("doc_id").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (known.select("doc_id", "n", "component_id").unionByName(alone)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its group; all columns stay."""
    gone = near_duplicates(docs, text, key, size, percent).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    held, back = sheltered(docs, docs.columns, __key=named(key)[0].cast("long"))
    return held.join(bounded(staged(gone, "near-gone")), F.col("__key") == F.col("__gone"), "left_anti").select(*back)
