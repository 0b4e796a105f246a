"""N-gram Jaccard join by parity sketches.

A set of word shingles is hashed into a bit sketch: every shingle flips one bit.
The sketches of two sets differ in no more bits than the sets differ in
elements, so their Hamming distance bounds the symmetric difference from
below.  Linked sets of a band of sizes differ in at most k elements; cut into
k + 1 + spare blocks, their sketches agree in at least 1 + spare blocks.  Every
set gives a key for each block, and linked sets meet in that many keys.

A key that many sets share is hot: blocks that no shingle fell into, or only
those of a passage that many texts hold.  A set with no more than ``spare`` hot
keys does not need them, since it meets all that it is linked with in another
key too.  So hot keys only concern sets with more of them: near copies in
thousands, and texts made of common passages.  Their links are settled exactly
by differences from a pivot (pivots.py).

Keys are not expanded into pairs either.  Every member is compared with one
pivot, the links so found give components, and only a key of few members that
still holds several components gives its pairs between them.  Candidates are
checked by the Hamming distance of one dense sketch a set, folded to the
shorter one's length, and then on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import map_batches, staged
from stationcast.llm.components import components, grown
from stationcast.llm.near_dedup import shingle_hashes
from stationcast.llm.pivots import _arrays, hot_links
from stationcast.operators.common import bounded

#: Members of a key whose pairs between components are candidates themselves; keys of more are hot.
SMALL = 16
#: Blocks beyond what a link needs, as a share of the elements that linked sets can differ in.
SPARE = 0.25
#: Bits of a sketch block (as a power of two).
BLOCK_BITS = 16
_ODD = 0x9E3779B97F4A7C15


def size_edges(percent: int, most: int = 1 << 40) -> list[int]:
    """First sizes of the bands; linked sets lie in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(edges[-1] * 100 // percent + 1)
    return edges


def windows(n: int, edges: list[int]) -> list[int]:
    """The windows that a set of ``n`` is in: window m spans the bands 2 m to 2 m + 2."""
    band = int(np.searchsorted(edges, n, "right")) - 1
    return [band // 2] if band % 2 else [m for m in (band // 2 - 1, band // 2) if m >= 0]


def blocks(window: int, edges: list[int], percent: int) -> tuple[int, int]:
    """(blocks of the window's sketches, hot ones that a set can do without); no
    blocks where only equal sets link."""
    largest = edges[window * 2 + 3] - 1
    apart = 2 * largest * (100 - percent) // (100 + percent)
    spare = int(apart * SPARE)
    return (apart + 1 + spare, spare) if apart else (0, 0)


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    x = values.view(np.uint64) + np.uint64((2 * seed + 1) * _ODD % (1 << 64))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def block_codes(mixed: np.ndarray, count: int) -> np.ndarray:
    """A 32-bit code of each of ``count`` blocks of the parity sketch.

    Every element flips the bit that its hash names; a block's code is the XOR of
    the codes of its set bits, so a bit flipped twice is gone from it as well."""
    bit = mixed & np.uint64((1 << BLOCK_BITS) - 1)
    block = (mixed >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
    codes = np.zeros(count, np.uint32)
    np.bitwise_xor.at(codes, block.astype(np.int64), (_mixed(bit.view(np.int64), 3) >> np.uint64(32)).astype(np.uint32))
    return codes.view(np.int32)


def one_sketch(values: np.ndarray) -> bytes:
    """Parity sketch of at least 4 bits an element and a power of two bits long."""
    mixed = _mixed(values, 0)
    bits = max(64, 1 << (4 * len(values) - 1).bit_length())
    return np.packbits(np.bincount((mixed & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches, the longer folded to the length of the shorter."""
    x, y = (np.frombuffer(s, np.uint64) for s in (a, b))
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


_IDENTITY = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


_BLOCKS = "array<struct<window:int,spare:int,codes:array<int>>>"


def _sketched(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, k1, k2, sketch, blocks) of (doc_id, text): size of the set, 128 bits
    that tell sets apart, one dense sketch, and the codes of its windows' blocks."""
    edges = size_edges(percent)
    own = docs.select("doc_id", shingle_hashes(F.col("text"), size).alias("set"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets, keys, codes = _arrays(batch.column(1)), [], []
        for x in sets:
            y = [_mixed(x ^ np.int64(k + 1), 7 + k) * _IDENTITY[k] for k in (0, 1)]
            keys.append([int(np.sum(v, dtype=np.uint64).view(np.int64)) for v in y])
            mixed = _mixed(x, 1)
            mine = [(m, *blocks(m, edges, percent)) for m in windows(len(x), edges)] if len(x) else []
            codes.append([{"window": m, "spare": spare, "codes": block_codes(mixed, count)} for m, count, spare in mine if count])
        kind = pa.list_(pa.struct([("window", pa.int32()), ("spare", pa.int32()), ("codes", pa.list_(pa.int32()))]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                                           pa.array([one_sketch(x) if len(x) else None for x in sets], pa.binary()), pa.array(codes, kind)], ["doc_id", "n", "k1", "k2", "sketch", "blocks"])
    return map_batches(own, run, f"doc_id long, n long, k1 long, k2 long, sketch binary, blocks {_BLOCKS}")


def _keys(reps: DataFrame) -> DataFrame:
    """(key, rep, window, spare): a row for every block of every sketch."""
    rows = reps.select("rep", F.explode("blocks").alias("b")).select("rep", F.col("b.window").alias("window"), F.col("b.spare").alias("spare"), F.posexplode("b.codes").alias("block", "code"))
    return rows.select(F.xxhash64("window", "block", "code").alias("key"), "rep", "window", "spare")


def set_table(texts: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(rep, tag, n, set) of (rep, text) for the numbers in ``ids``: whole sets, in
    rising order; a number's sets are told apart by ``tag``, equal ones are one."""
    own = texts.join(bounded(ids), "rep", "left_semi").select("rep", F.array_sort(shingle_hashes(F.col("text"), size)).alias("set"))
    # filtered after it is written: before, the filter would make the sets of all texts
    sets = staged(own.select("rep", F.xxhash64("set").alias("tag"), F.size("set").cast("long").alias("n"), "set"), "parity-sets").where(F.col("n") > 0)
    again = sets.groupBy("rep", "tag").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
    return sets if again.isEmpty() else staged(sets.dropDuplicates(["rep", "tag"]), "parity-sets")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()


def linked_pairs(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked: by sizes and sketches first, then on the whole sets."""
    pairs = staged(pairs, "parity-pairs")
    some = reps.select("rep", "n", "sketch").join(bounded(_ids(pairs)), "rep", "left_semi")
    own = lambda side: some.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
        apart = np.array([hamming(x, y) for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())])
        keep = pa.array(((100 + percent) * apart <= (100 - percent) * (n[0] + n[1])) & (100 * np.minimum(*n) >= percent * np.maximum(*n)))
        return pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], ["a", "b"])
    sketched = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "n_a", "sketch_a", "b", "n_b", "sketch_b")
    close = staged(map_batches(sketched, near, "a long, b long").distinct(), "parity-near")
    return exact_links(close, set_table(texts, _ids(close), size), percent)


def exact_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked on their whole sets."""
    own = lambda side: sets.select(F.col("rep").alias(side), F.col("set").alias(f"set_{side}"))

    def equal(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = [_arrays(batch.column(c)) for c in ("set_a", "set_b")]
        common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides)])
        both = np.array([len(x) + len(y) for x, y in zip(*sides)])
        keep = pa.array(100 * common >= percent * (both - common))
        return pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])
    whole = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "set_a", "b", "set_b")
    return map_batches(whole, equal, "a long, b long").distinct()


def _pairs(frame: DataFrame, a: str, b: str) -> DataFrame:
    return frame.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def _labelled(frame: DataFrame, comps: DataFrame) -> DataFrame:
    return frame.join(comps.select(F.col("id").alias("rep"), F.col("component").alias("c")), "rep", "left").withColumn("c", F.coalesce("c", "rep"))


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members (key, rep, n, c) of groups that hold several components."""
    rows = _labelled(members, comps)
    mixed = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where(F.col("low") != F.col("high")).select("key")
    return rows.join(mixed, "key", "left_semi")


def set_links(texts: DataFrame, reps: DataFrame, size: int, percent: int, small: int = SMALL) -> DataFrame:
    """(a, b): links enough to join every two linked sets in one component, all of them true.

    ``texts`` is (rep, text) of all documents, ``reps`` (rep, n, sketch, blocks) of one document for each set."""
    first, _, rest = _settled(texts, reps, size, percent, small)
    return first.unionByName(rest)


def _settled(texts: DataFrame, reps: DataFrame, size: int, percent: int, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The links of ``set_links`` in two parts, and between them the components (id, component) of the first."""
    keys = _keys(reps)
    groups = staged(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("pivot"), F.max("rep").alias("other")).where(F.col("pivot") != F.col("other")), "parity-groups")
    members = staged(keys.join(bounded(groups.where(F.col("n") > 2).select("key", "n", "pivot")), "key"), "parity-members")
    cold, hot = members.where(F.col("n") <= small), members.where(F.col("n") > small)
    needed = hot.groupBy("window", "rep").agg(F.count("*").alias("keys"), F.first("spare").alias("spare")).where(F.col("keys") > F.col("spare")).select("window", "rep")
    hot = staged(hot.join(needed, ["window", "rep"]).select("key", "rep", "n", "pivot"), "parity-hot")

    first = _pairs(cold.unionByName(hot, allowMissingColumns=True), "rep", "pivot").unionByName(_pairs(groups.where(F.col("n") == 2), "other", "pivot")).distinct()
    links = staged(linked_pairs(first, reps, texts, size, percent), "parity-links")
    comps = staged(components(links), "parity-components")
    few = staged(_open(cold.select("key", "rep"), comps), "parity-open")
    across = few.alias("x").join(few.alias("y"), "key").where((F.col("x.rep") > F.col("y.rep")) & (F.col("x.c") != F.col("y.c"))).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    more = staged(linked_pairs(across, reps, texts, size, percent), "parity-links")

    open_ = staged(_open(hot.select("key", "rep", "n"), comps), "parity-open")
    if open_.isEmpty():
        return links, comps, more
    # every open key is settled from the central member of its main component
    score = _labelled(hot.groupBy("rep").agg(F.sum("n").alias("score")), comps)
    central = score.groupBy(F.col("c").alias("main")).agg(F.max_by("rep", F.struct("score", -F.col("rep"))).alias("pivot"))
    main = open_.groupBy("key", "c").agg(F.count("*").alias("m")).groupBy("key").agg(F.max_by("c", F.struct("m", "c")).alias("main"))
    pivoted = staged(open_.join(main.join(central, "main"), "key").select("pivot", "rep").distinct(), "parity-pivoted")
    comps, links = grown(comps, more), links.unionByName(more)
    ids = pivoted.select("rep").unionByName(pivoted.select(F.col("pivot").alias("rep"))).distinct()
    sets = set_table(texts, ids, size)
    star, candidates = hot_links(pivoted, sets, comps, percent)
    return links, comps, staged(star.unionByName(exact_links(candidates, sets, percent)), "parity-links")


def jaccard_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 4, percent: int = 85,
                    small: int = SMALL) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    A text's set is that of its distinct shingles of ``size`` words, told apart by
    64-bit hashes; a shorter text is one shingle, and one without words, or null,
    is linked with nothing.  Texts are linked where 100 * common >= percent *
    together; the component is the smallest doc_id that links reach.  Rows
    without a key have no component.  Rows of one key are one document, linked
    with what any of them is linked with.  Keys must be integers.  An empty
    table gives an empty result; other columns are not read, so their names may
    clash."""
    own = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    base = staged(_sketched(own, size, percent), "parity-base")
    full = base.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    sets = full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    known = staged(full.select("doc_id", "n", "k1", "k2").join(sets, ["k1", "k2"]), "parity-known")
    copies = known.where(F.col("doc_id") != F.col("rep")).select("doc_id", "k1", "k2").distinct()
    first = full.join(bounded(copies), ["doc_id", "k1", "k2"], "left_anti")
    # a number of several sets joins them
    several = known.select("doc_id", "k1", "k2").distinct().groupBy("doc_id").agg(F.count("*").alias("sets")).where(F.col("sets") > 1).select("doc_id")
    same = _pairs(known.join(several, "doc_id", "left_semi"), "doc_id", "rep")
    texts = own.select(F.col("doc_id").alias("rep"), "text")
    _, comps, links = _settled(texts, first.select(F.col("doc_id").alias("rep"), "n", "sketch", "blocks"), size, percent, small)
    comps = grown(comps, links.unionByName(same))
    joined = known.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left").select("doc_id", "n", F.coalesce("component", "rep").alias("component_id"))
    none = base.where((F.col("n") == 0) | F.col("doc_id").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return joined.unionByName(none).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
