"""Line dedup by content-defined chunks of lines.

A text is its lines (between line feeds).  A polynomial rolling hash over the
hashes of three lines cuts after a line where it is 0 modulo DIVISOR, so a
chunk's borders depend on the lines right before them only: inserted or removed
lines move the chunks around them and no others.  A chunk of two or more lines
that are not blank, which occurs more than once in the whole corpus, stays at
its first place (smallest key, then position) and goes elsewhere.

Chunks that begin or end differently leave parts of a repeated passage behind.
A second, exact step takes what they left: every two successive lines that are
not blank, and every single line of LINE_WORDS words or more, go where they
stood at an earlier place already.  Both steps judge the input, and what the
chunks remove the second step would remove as well, so the result does not
depend on the cuts.  A blank line goes with the line before it.

Equal means equal bytes for chunks: what shares an MD5 is compared as text before
it goes.  The second step shuffles no text: MD5, 64 bits of another hash and the
length, all three part of the key, stand for a pair or line.
Rows are combined in the tasks first, so a passage that a third of all documents
share reaches the shuffle once per task, and only keys and places go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import SPACE, WORD, named, others, sheltered, staged
from stationcast.operators.common import bounded

#: Lines under the rolling hash, its base, and the share of lines that end a chunk.
WINDOW, BASE, DIVISOR = 3, 31, 4
MIN_LINES = 2
#: A single line that stood elsewhere goes from so many words on.
LINE_WORDS = 20


def line_hash(line: Column) -> Column:
    """32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _with(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chunks(lines: Column) -> Column:
    """The chunks of an array of lines, in order: array of (ix, start, stop, lines)."""
    def cut(hashes: Column) -> Column:
        def rolling(i: Column) -> Column:  # over the lines up to the i-th, from 1
            return sum((F.coalesce(F.get(hashes, i - 1 - k), F.lit(0)) * BASE ** k for k in range(1, WINDOW)), F.get(hashes, i - 1))
        return F.filter(F.sequence(F.lit(1), F.size(hashes)), lambda i: (i == F.size(hashes)) | (rolling(i) % DIVISOR == 0))

    def pieces(ends: Column) -> Column:
        def piece(stop: Column, k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1))
            full = F.size(F.filter(F.slice(lines, start + 1, stop - start), lambda x: F.trim(x) != ""))
            return F.struct(k.alias("ix"), start.alias("start"), stop.alias("stop"), full.alias("lines"))
        return F.transform(ends, piece)
    return _with(F.transform(lines, line_hash), lambda h: _with(cut(h), pieces))


def _text(lines: Column, start: Column, stop: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, stop - start), "\n")


def has_words(line: Column, n: int) -> Column:
    """Whether a line has ``n`` words or more; looks no further than at the n-th and makes no array of them."""
    return line.rlike(rf"\A(?:{SPACE})?+(?:{WORD}+{SPACE}+){{{n - 1}}}{WORD}")


def repeated(places: DataFrame, by: Sequence[str] = ("h",), k: str = "k") -> DataFrame:
    """The rows (k, at, *by, start, stop) of ``places`` whose ``by`` stood at an earlier (k, at).
    A column ``bytes`` has the texts of hashes that do not tell them apart for certain."""
    place = F.struct(F.col(k), F.col("at"))
    groups = staged(places.groupBy(*by).agg(F.count("*").alias("times"), F.min(place).alias("first")).where(F.col("times") > 1).drop("times"), "line-groups")
    again = places.join(bounded(groups), list(by))
    late = again.where(place != F.col("first")).select(k, "at", *by, "start", "stop")
    if "bytes" not in places.columns:
        return late
    # different texts of one hash remove nothing
    mixed = again.groupBy(*by).agg(F.min("bytes").alias("low"), F.max("bytes").alias("high")).where(F.col("low") != F.col("high")).select(*by)
    return late.join(mixed, list(by), "left_anti")


def removed_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(k, gone: numbers, from 0, of the lines that go) of the documents that lose lines."""
    own = docs.select(named(key)[0].alias("k"), F.split(named(text)[0], "\n", -1).alias("lines")).where(F.col("k").isNotNull() & F.col("lines").isNotNull())
    cut = own.select("k", "lines", chunks(F.col("lines")).alias("chunks"))
    whole = cut.select("k", "lines", F.explode(F.filter("chunks", lambda c: c["lines"] >= MIN_LINES)).alias("c"))
    whole = whole.select("k", F.col("c.ix").alias("at"), F.col("c.start").alias("start"), F.col("c.stop").alias("stop"), _text(F.col("lines"), F.col("c.start"), F.col("c.stop")).alias("bytes"))
    big = staged(repeated(whole.withColumn("h", F.md5("bytes"))).select("k", "start", "stop"), "line-chunks")

    full = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda v: F.trim(v["x"]) != "")
    # no text goes on from here: 128 bits, 64 others and the length together say what is equal
    unit = lambda at, a, b, t: F.struct(at.alias("at"), a.alias("start"), (b + 1).alias("stop"), F.md5(t).alias("h"),
                                        F.xxhash64(t).alias("x"), F.octet_length(t).alias("n"))

    def units(v: Column) -> Column:
        pairs = F.transform(F.when(F.size(v) > 1, F.sequence(F.lit(0), F.size(v) - 2)).otherwise(F.array().cast("array<int>")), lambda j: unit(
            F.get(v, j)["i"] * 2, F.get(v, j)["i"], F.get(v, j + 1)["i"], F.concat(F.get(v, j)["x"], F.lit("\n"), F.get(v, j + 1)["x"])))
        longer = F.filter(v, lambda e: has_words(e["x"], LINE_WORDS))
        return F.concat(pairs, F.transform(longer, lambda e: unit(e["i"] * 2 + 1, e["i"], e["i"], e["x"])))
    # a pair and a line are never the same: only pairs have a line feed
    rest = repeated(own.select("k", F.explode(_with(full, units)).alias("u")).select("k", "u.*"), ("h", "x", "n"))
    numbers = big.select("k", F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("i"))
    ends = rest.select("k", F.explode(F.array("start", F.col("stop") - 1)).alias("i"))  # the blank lines between follow the first
    return numbers.unionByName(ends).groupBy("k").agg(F.collect_set("i").alias("gone"))  # a document's own lines


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", counts: tuple[str, str, str] = ("lines_before", "lines_removed", "runs_removed")) -> DataFrame:
    """``docs`` with its repeated lines removed, and three columns more (of the names
    ``counts``, replaced if they exist): lines before, lines removed, runs of them.

    Null texts stay null (0 lines), empty ones empty (1 line); a text that loses all
    lines is empty.  Rows without a key stay as they are and take no part.  Rows of
    one key count as one document: they do not remove each other's passages of the
    same place, and lose lines by the same numbers.  Of equal passages the one with
    the smallest (key, place) stays.  An empty table gives an empty result."""
    d, back = sheltered(docs, others(docs, *counts), __k=named(key)[0], __t=named(text)[0])
    d = d.join(removed_lines(docs, text, key).select(F.col("k").alias("__k"), F.col("gone").alias("__gone")), "__k", "left")
    lines = F.split("__t", "\n", -1)
    flags = F.transform(lines, lambda x, i: F.when(F.trim(x) != "", F.array_contains("__gone", i)))  # null: blank
    # a blank line goes with the line before it
    kept = F.aggregate(F.arrays_zip(lines.alias("x"), flags.alias("g")), F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("last"), F.lit(0).alias("runs")),
                       lambda s, v: _with(F.coalesce(v["g"], s["last"]), lambda gone: F.struct(
                           F.when(gone, s["kept"]).otherwise(F.concat(s["kept"], F.array(v["x"]))).alias("kept"), gone.alias("last"),
                           (s["runs"] + (gone & ~s["last"]).cast("int")).alias("runs"))))
    d = d.withColumn("__new", F.when(F.col("__gone").isNotNull() & F.col("__t").isNotNull(), kept))
    before = F.coalesce(F.size(lines), F.lit(0))
    before = F.when(F.col("__t").isNull(), F.lit(0)).otherwise(before)
    new = F.when(F.col("__new").isNull(), F.col("__t")).otherwise(F.array_join("__new.kept", "\n"))
    removed = F.when(F.col("__new").isNull(), F.lit(0)).otherwise(before - F.size("__new.kept"))
    names = others(docs, *counts)
    return d.select(*[new.alias(c) if c == text else b for c, b in zip(names, back)], before.cast("long").alias(counts[0]), removed.cast("long").alias(counts[1]),
                    F.coalesce("__new.runs", F.lit(0)).cast("long").alias(counts[2]))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, lines_before, lines_removed, runs_removed, kept_md5 for every document."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "lines_before", "lines_removed", "runs_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


#: Says what goes without any cut: pairs of successive lines, and long lines, that stood earlier.
ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
f AS (SELECT *, lead(line) OVER w AS next_line, lead(pos) OVER w AS next_pos FROM l WHERE trim(line, ' ') <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
u AS (SELECT doc_id, pos * 2 AS spot, pos AS a, next_pos AS b, line || chr(10) || next_line AS t FROM f WHERE next_line IS NOT NULL
      UNION ALL SELECT doc_id, pos * 2 + 1, pos, pos, line FROM f WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {LINE_WORDS}),
g AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, spot) AS place FROM u),
x AS (SELECT doc_id, a AS pos FROM g WHERE place > 1 UNION SELECT doc_id, b FROM g WHERE place > 1),
m AS (SELECT l.doc_id, l.pos, l.line, CASE WHEN trim(l.line, ' ') <> '' THEN x.pos IS NOT NULL END AS flag FROM l LEFT JOIN x ON x.doc_id = l.doc_id AND x.pos = l.pos),
n AS (SELECT *, coalesce(last_value(flag IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS gone FROM m),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM n),
s AS (SELECT doc_id, count(*) AS lines_before, count(*) FILTER (WHERE gone) AS lines_removed, count(*) FILTER (WHERE opens) AS runs_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(s.lines_before, 0)::BIGINT AS lines_before, coalesce(s.lines_removed, 0)::BIGINT AS lines_removed,
       coalesce(s.runs_removed, 0)::BIGINT AS runs_removed, md5(coalesce(s.kept, '')) AS kept_md5
FROM documents d LEFT JOIN s USING (doc_id)
"""
