"""Prefix trie of conversations, by the Euler-tour technique.

Every conversation is a path of turns from the root.  A prefix is known by the
sum of the hashes of its turns with their places (two sums of 62 bits), which
is a running sum: conversations of any length are summed over many tasks.
Equal prefixes fold into nodes.

The tour enters and leaves every node once: two arcs a node, each with the arc
that follows it.  Ranking that list gives every arc its place in the tour.  It
is ranked in three steps.  Tasks first join the arcs that follow each other
among those that they hold; arcs lie in the order of conversations, which the
tour also follows, so mostly long runs form.  What is left is shortened by
random mates: in every round an arc that drew heads takes in its follower if
that drew tails, about a quarter of the list, and each removed piece leaves its
distance from the one that took it.  The last few thousand are walked; the
rounds are then undone in reverse.

With the arcs in tour order, the leaves and the savings of a subtree are the
difference of a running sum at the arc that leaves its top and the one that
enters it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import n_words, staged
from stationcast.llm.scans import MODULUS, scan

#: A conversation may take up to BORROWED - 1 first turns from the first one of its block of BLOCK numbers.
BLOCK, BORROWED = 20, 4
#: Arcs that a task joins into runs at once.
RUN_ROWS = 1 << 16
#: Pieces of the list that are walked by themselves; more are shortened by random mates first.
WALKED = 10_000
#: Numbers of conversations in a piece of a node's list of members.
PIECE = 1000


def _mod(value: Column) -> Column:
    return F.pmod(value, F.lit(MODULUS))


def turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, k1, k2, words): turns with 128 bits that stand for role and text."""
    r, t = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.sha2(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t), 256)
    part = lambda k: F.conv(F.substring(F.col("digest"), k, 16), 16, -10).cast("long")
    own = conversations.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), r.alias("role"),
                               n_words(t).alias("words"), digest.alias("digest")).where(F.col("conv").isNotNull())
    return own.select("conv", "turn", "role", part(1).alias("k1"), part(17).alias("k2"), "words")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, p, k1, k2, words), (conv, length)): the rebuilt conversations' turns,
    numbered from 0, and how many each has."""
    rows = scan(own, ["conv", F.col("turn").asc_nulls_first(), "role", "k1", "k2"])
    size = staged(rows.groupBy("conv").agg(F.min("ix").alias("first"), F.count("*").alias("n")), "trie-conversations")
    base = size.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = (size.withColumn("base", F.col("conv") - F.col("conv") % BLOCK)
            .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED).join(base, "base", "left")
            .withColumn("take", F.least("h", F.coalesce("base_n", F.lit(0)))))
    plan = staged(plan.select("conv", "base", "first", "h", "take", (F.col("take") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-plan")
    placed = rows.join(plan.select("conv", "first", "h", "take"), "conv").withColumn("pos", F.col("ix") - F.col("first"))
    kept = placed.where(F.col("pos") >= F.col("h")).select("conv", (F.col("pos") - F.col("h") + F.col("take")).alias("p"), "k1", "k2", "words")
    heads = (placed.where((F.col("pos") < BORROWED - 1) & (F.col("conv") % BLOCK == 0))
             .select(F.col("conv").alias("base"), F.col("pos").alias("p"), "k1", "k2", "words"))
    borrowed = plan.where(F.col("take") > 0).select("conv", "base", "take").join(heads, "base").where(F.col("p") < F.col("take"))
    return kept.unionByName(borrowed.select("conv", "p", "k1", "k2", "words")), plan.select("conv", "length")


def prefixes(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, depth, s1, s2, t1, t2, words, ends): every prefix of every path, the root's
    too; s1, s2 stand for the prefix, t1, t2 for the one before its last turn."""
    hashed = paths.select("conv", "p", "words", _mod(F.xxhash64("k1", "k2", "p")).alias("a"), _mod(F.xxhash64("p", "k2", "k1")).alias("b"))
    rows = scan(hashed, ["conv", "p"], ["a", "b"])
    start = rows.where(F.col("p") == 0).select("conv", (F.col("a_upto") - F.col("a")).alias("a0"), (F.col("b_upto") - F.col("b")).alias("b0"))
    s1, s2 = _mod(F.col("a_upto") - _mod(F.col("a0"))), _mod(F.col("b_upto") - _mod(F.col("b0")))
    below = (rows.join(start.join(lengths, "conv"), "conv")
             .select("conv", (F.col("p") + 1).alias("depth"), s1.alias("s1"), s2.alias("s2"), _mod(s1 - F.col("a")).alias("t1"), _mod(s2 - F.col("b")).alias("t2"),
                     "words", (F.col("p") + 1 == F.col("length")).alias("ends")))
    zero = F.lit(0).cast("long")
    root = lengths.select("conv", zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), F.lit(None).cast("long").alias("t1"), F.lit(None).cast("long").alias("t2"),
                          zero.alias("words"), (F.col("length") == 0).alias("ends"))
    return staged(below.unionByName(root), "trie-prefixes")


def nodes(rows: DataFrame) -> DataFrame:
    """(ix, conv_id, depth, s1, s2, n_convs, words, parent, parent_conv_id, n_children, first_child, next_sibling).

    Nodes are numbered by depth, parent and smallest member, so the children of a
    node have consecutive numbers in the order of their smallest members."""
    folded = rows.groupBy("depth", "s1", "s2").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
                                                   F.min("t1").alias("t1"), F.min("t2").alias("t2"))
    named = scan(folded, ["depth", F.col("t1").asc_nulls_first(), F.col("t2").asc_nulls_first(), "conv_id"])
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.col("ix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = staged(named.join(above, ["depth", "t1", "t2"], "left"), "trie-nodes")
    children = staged(linked.where(F.col("parent").isNotNull()).groupBy("parent").agg(F.count("*").alias("n_children"), F.min("ix").alias("first_child"), F.max("ix").alias("last_child")), "trie-children")
    own = children.select(F.col("parent").alias("ix"), "n_children", "first_child")
    return staged(linked.join(own, "ix", "left").join(children.select("parent", "last_child"), "parent", "left")
                  .select("ix", "conv_id", "depth", "s1", "s2", "n_convs", "words", "parent", "parent_conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child",
                          F.when(F.col("ix") < F.col("last_child"), F.col("ix") + 1).alias("next_sibling")), "trie-linked")


def arcs(tree: DataFrame) -> DataFrame:
    """(id, succ, conv_id, depth): the Euler tour; arc 2 ix enters the node, 2 ix + 1 leaves it."""
    enter, leave = F.col("ix") * 2, F.col("ix") * 2 + 1
    both = F.array(F.struct(enter.alias("id"), F.coalesce(F.col("first_child") * 2, leave).alias("succ")),
                   F.struct(leave.alias("id"), F.coalesce(F.col("next_sibling") * 2, F.col("parent") * 2 + 1).alias("succ")))
    return tree.select(F.explode(both).alias("arc"), "conv_id", "depth").select("arc.id", "arc.succ", "conv_id", "depth")


def _runs(ids: np.ndarray, succ: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the run's first arc, place in the run, is last) for arcs of a list of which
    these are some; succ is -1 at the list's end."""
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids[order], succ), len(ids) - 1)
    follower = np.where(ids[order][at] == succ, order[at], -1)
    head = np.arange(len(ids))
    place = np.zeros(len(ids), np.int64)
    has = follower >= 0
    head[follower[has]] = np.flatnonzero(has)
    place[follower[has]] = 1
    while True:
        beyond = head[head]
        if np.array_equal(beyond, head):
            return head, place, ~has
        place, head = place + place[head], beyond


def list_ranks(links: DataFrame, run_rows: int = RUN_ROWS, walked: int = WALKED) -> DataFrame:
    """(id, rank): place from 0 of every arc of one list given as (id, succ), the last
    without succ; ``links`` should lie in an order that the list mostly follows."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([b.column(0).to_numpy() for b in held])
            succ = np.concatenate([b.column(1).fill_null(-1).to_numpy() for b in held])
            held.clear()
            head, place, last = _runs(ids, succ)
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[head]), pa.array(place), pa.array(last), pa.array(succ, mask=succ < 0)], ["id", "head", "place", "last", "succ"])
        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= run_rows:
                yield flush()
        if held:
            yield flush()
    spark = links.sparkSession
    runs = staged(links.mapInArrow(join, "id long, head long, place long, last boolean, succ long"), "trie-runs")
    pieces = staged(runs.where("last").select(F.col("head").alias("id"), "succ", (F.col("place") + 1).alias("size")), "trie-pieces")
    removed: list[DataFrame] = []
    while (left := pieces.count()) > walked:
        heads = lambda c, r=len(removed): F.xxhash64(c, F.lit(r)).bitwiseAND(1) == 1
        takers, rest = pieces.where(heads(F.col("id"))), pieces.where(~heads(F.col("id")))
        asks = takers.where(F.col("succ").isNotNull() & ~heads(F.col("succ"))).select(F.col("succ").alias("id"), F.col("id").alias("taker"), F.col("size").alias("distance"))
        gone = staged(rest.join(asks, "id"), "trie-removed")
        longer = takers.join(gone.select(F.col("taker").alias("id"), F.col("succ").alias("far"), F.col("size").alias("more")), "id", "left")
        longer = longer.select("id", F.when(F.col("more").isNull(), F.col("succ")).otherwise(F.col("far")).alias("succ"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))
        pieces = staged(longer.unionByName(rest.join(gone.select("id"), "id", "left_anti")), "trie-pieces")
        removed.append(gone.select("id", "taker", "distance"))
    rows = {r["id"]: (r["succ"], r["size"]) for r in pieces.collect()}  # ``walked`` at most
    firsts = rows.keys() - {s for s, _ in rows.values()}
    at, rank, ranked = (firsts.pop() if firsts else None), 0, []
    while at is not None:
        ranked.append((at, rank))
        at, rank = rows[at][0], rank + rows[at][1]
    ranks = spark.createDataFrame(ranked, "id long, rank long")
    for gone in reversed(removed):
        back = gone.join(ranks.withColumnRenamed("id", "taker"), "taker").select("id", (F.col("rank") + F.col("distance")).alias("rank"))
        ranks = staged(ranks.unionByName(back), "trie-ranks")
    return runs.join(ranks.select(F.col("id").alias("head"), F.col("rank").alias("start")), "head").select("id", (F.col("start") + F.col("place")).alias("rank"))


def subtrees(tree: DataFrame, run_rows: int = RUN_ROWS, walked: int = WALKED) -> DataFrame:
    """(ix, n_leaves, saved_tokens) of every node, from running sums over the tour."""
    tour = arcs(tree).repartitionByRange("conv_id", "depth", "id").sortWithinPartitions("conv_id", "depth", "id").select("id", "succ")
    ranks = list_ranks(tour, run_rows, walked)
    enters = tree.select((F.col("ix") * 2).alias("id"), (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    zero = F.lit(0).cast("long")
    weights = enters.unionByName(tree.select((F.col("ix") * 2 + 1).alias("id"), zero.alias("leaves"), zero.alias("saved")))
    sums = scan(ranks.join(weights, "id"), ["rank"], ["leaves", "saved"])
    into = F.col("id") % 2 == 0
    at = lambda c: F.max(F.when(~into, F.col(f"{c}_upto"))) - F.max(F.when(into, F.col(f"{c}_upto") - F.col(c)))
    return sums.groupBy((F.col("id") - F.col("id") % 2).alias("id")).agg(at("leaves").alias("n_leaves"), at("saved").alias("saved_tokens")).select(
        (F.col("id") / 2).cast("long").alias("ix"), "n_leaves", "saved_tokens")


def member_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(ix, ends_sha256) from (ix, conv): SHA-256 of the conversation numbers of a node,
    ascending and joined by commas.

    Tasks join runs of up to ``piece`` sorted numbers first, and a node's runs are
    then hashed as a stream: SHA-256 has no other way, but nothing is gathered."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, conv = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(node)) + 1
            edges = sorted({0, len(node), *cuts.tolist(), *[k for a, z in zip([0, *cuts], [*cuts, len(node)]) for k in range(int(a), int(z), piece)]})
            spans = [(a, z) for a, z in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([int(node[a]) for a, _ in spans], pa.int64()), pa.array([int(conv[a]) for a, _ in spans], pa.int64()),
                                              pa.array([",".join(map(str, conv[a:z].tolist())) for a, z in spans], pa.string())], ["ix", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for b in batches:
            for ix, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if ix == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = ix, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done])], ["ix", "ends_sha256"])
                done.clear()
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], ["ix", "ends_sha256"])
    pieces = ends.repartitionByRange("ix", "conv").sortWithinPartitions("ix", "conv").mapInArrow(join, "ix long, first long, ids string")
    return pieces.repartition("ix").sortWithinPartitions("ix", "first").mapInArrow(digest, "ix long, ends_sha256 string")


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
         run_rows: int = RUN_ROWS, walked: int = WALKED) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations: (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    A null role or text counts as empty, a null turn comes first.  Turns of one
    number follow in the order of their role, then of their content's hash;
    repeated rows are turns of their own.  Rows without a conversation number
    belong to no conversation and are left out; numbers must be integers.
    Texts may be of any length: only hashes and word counts are shuffled.  An
    empty table gives an empty result.  Other columns are not read, so their
    names may clash."""
    paths, lengths = rebuilt(turns(conversations, conv, turn, role, text))
    rows = prefixes(paths, lengths)
    tree = nodes(rows)
    ends = rows.where("ends").join(tree.select("depth", "s1", "s2", "ix"), ["depth", "s1", "s2"]).select("ix", "conv")
    out = tree.join(subtrees(tree, run_rows, walked), "ix").join(member_digests(ends), "ix", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


#: Paths are compared as text here; a subtree's sums go over the prefixes of each node's smallest member.
ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
          lambda s, c: list_reduce(list_prepend(xor(s, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v // 2, 3988292384 * (v % 2)))) AS s
        FROM (SELECT DISTINCT conv_id FROM t)),
h AS (SELECT conv_id, xor(s, 4294967295::BIGINT) % {BORROWED} AS h FROM crc),
r AS (SELECT h.conv_id, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % {BLOCK} AND t.pos <= h.h
      UNION ALL SELECT t.conv_id, t.pos + 1000000, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.pos > h.h),
p AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS path,
             len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, count(*) OVER (PARTITION BY conv_id) AS size
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (SELECT conv_id, depth, md5(path) AS path, words, size = depth AS ends FROM p
      UNION ALL SELECT h.conv_id, 0, '', 0, NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = h.conv_id) FROM h),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM a GROUP BY path, depth),
m AS (SELECT n.*, a.path AS above FROM n LEFT JOIN a ON a.conv_id = n.conv_id AND a.depth = n.depth - 1),
c AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY ALL),
l AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM n LEFT JOIN c USING (path, depth)),
s AS (SELECT a.path, a.depth, count(*) FILTER (WHERE l.n_children = 0) AS n_leaves, sum((l.n_convs - 1) * l.words) AS saved_tokens
      FROM l JOIN a ON a.conv_id = l.conv_id AND a.depth <= l.depth GROUP BY ALL)
SELECT l.conv_id, l.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, l.n_convs::BIGINT AS n_convs, l.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM l JOIN m USING (path, depth) JOIN s USING (path, depth) LEFT JOIN n o ON o.path = m.above AND o.depth = l.depth - 1
"""
