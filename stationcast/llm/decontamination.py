"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

Words are runs of letters and digits, lowered, so case and punctuation do not
hide a passage.  A spaced seed reads 9 consecutive words and hashes the 6 that
its mask selects; the ignored positions may differ.  Seeds of the benchmark
items and of every position of every document are joined on their hashes, and
each hit is verified on its diagonal: a window of WINDOW words of the item (all
of a shorter item) around the hit must agree with the document in at least
SHARE of its words, whatever the substituted ones are.

Only positions where every word that the mask reads occurs in the benchmark at
all are hashed: a bit map of the items' words, of checked size, tells that for
each word once, and never excludes a hit.  The scan makes the seeds of a
document, joins them with the items' seeds and verifies hits in one pass,
without a shuffle, as long as the items' seeds are a table of checked size; a
larger benchmark is joined by a shuffle instead, and one of more than
VOCABULARY words hashes every position.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import named, sheltered, staged
from stationcast.operators.common import bounded

#: Which of 9 consecutive words a seed reads.
MASKS = ("111010011", "110010111", "101101101")
SPAN = 9
WINDOW, SHARE = 13, 0.8
#: Items' seeds are broadcast up to this many rows (about 30 MB); beyond, the join shuffles.
BROADCAST_SEEDS = 500_000
#: Words of the benchmark that the bit map may hold (16 bits each, in the plan).
VOCABULARY = 200_000
_SEPARATOR = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; null gives []."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATOR), lambda w: w != "")


def word_bits(words: DataFrame, limit: int = VOCABULARY) -> list[int] | None:
    """Bit map of the word hashes in ``words`` (h), as 64-bit numbers; None for more than ``limit`` of them."""
    n = words.distinct().count()
    if n > limit:
        return None
    cells = max(16, 1 << (16 * max(n, 1) - 1).bit_length() >> 6)
    at = F.pmod(F.shiftrightunsigned("h", 6), F.lit(cells))
    rows = words.groupBy(at.alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63L as int))")).alias("bits")).collect()  # at most ``cells``
    out = [0] * cells
    for r in rows:
        out[r["at"]] = r["bits"]
    return out


def known_words(hashes: Column, bits: list[int] | None) -> Column:
    """Whether each word's bit is set."""
    if bits is None:
        return F.transform(hashes, lambda h: F.lit(True))
    table = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")  # folded to one literal
    cell = lambda h: F.get(table, F.pmod(F.shiftrightunsigned(h, 6), F.lit(len(bits))).cast("int"))
    return F.transform(hashes, lambda h: F.getbit(cell(h), h.bitwiseAND(F.lit(63)).cast("int")) == 1)


def with_seeds(frame: DataFrame, key: str, text: str, out: str, bits: list[int] | None = None, around: int | None = None) -> DataFrame:
    """(``out``_id, mask, seed, ``out``_pos, ``out``_words), a row for every seed
    whose words are in ``bits``; none for texts of under SPAN words.

    ``out``_words are the words from ``around`` before to ``around`` behind the
    seed, all of the text without it, and ``out``_pos is the seed's place among
    them: a row carries what its check needs, not the text."""
    d = frame.select(F.col(f"`{key}`").alias(f"{out}_id"), tokens(F.col(f"`{text}`")).alias("words"))
    d = d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    at = F.when(F.size("hashes") >= SPAN, F.sequence(F.lit(0), F.size("hashes") - SPAN)).otherwise(F.array().cast("array<int>"))

    def known_at(picks: list[int], i: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.get("known", i + k) for k in picks])

    def of(mask: int, picks: list[int], i: Column) -> Column:
        first = F.lit(0) if around is None else F.greatest(i - around, F.lit(0))
        words = F.col("words") if around is None else F.slice("words", first + 1, i - first + SPAN + around)
        return F.struct(F.lit(mask).alias("mask"), F.xxhash64(F.lit(mask), *[F.get("hashes", i + k) for k in picks]).alias("seed"),
                        (i - first).alias(f"{out}_pos"), words.alias(f"{out}_words"))
    read = [[k for k, c in enumerate(m) if c == "1"] for m in MASKS]
    common = sorted(set.intersection(*map(set, read)))
    if bits is not None:
        d = d.withColumn("known", known_words(F.col("hashes"), bits))
        at = F.filter(at, partial(known_at, common))
    d = d.withColumn("at", at)
    places = [F.col("at") if bits is None else F.filter("at", partial(known_at, [k for k in r if k not in common])) for r in read]
    return d.select(f"{out}_id", F.inline(F.concat(*[F.transform(p, partial(of, m, r)) for m, (p, r) in enumerate(zip(places, read))])))


def best_window(doc: Column, item: Column, doc_pos: Column, item_pos: Column) -> Column:
    """Most equal words in any window of the item that holds the hit."""
    length = F.least(F.size(item), F.lit(WINDOW))
    first, last = F.greatest(item_pos - (length - SPAN), F.lit(0)), F.least(item_pos, F.size(item) - length)
    shift = doc_pos - item_pos
    equal = lambda j: F.coalesce(F.get(item, j) == F.get(doc, j + shift), F.lit(False))
    return F.array_max(F.transform(F.sequence(first, last), lambda s: F.size(F.filter(F.sequence(s, s + length - 1), equal))))


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """Pairs of a document and a benchmark item that it holds a passage of:
    (doc_id, text_md5, item_id, matched, window, hits).

    Null and empty texts and items of under SPAN words give no pair.  Rows with
    null keys pair like others (doc_id or item_id is null then), told apart by
    the MD5 of their text; equal rows are one pair.  Either table may be empty.
    Other columns are not read."""
    item_seeds = staged(with_seeds(benchmark, item_key, item_text, "item"), "benchmark-seeds")
    small = item_seeds.count() <= BROADCAST_SEEDS
    bits = word_bits(benchmark.select(F.explode(tokens(F.col(f"`{item_text}`"))).alias("w")).select(F.xxhash64("w").alias("h")))
    own = docs.select(F.struct(F.col(f"`{key}`").alias("doc_id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_md5")).alias("__id"), F.col(f"`{text}`"))
    hits = with_seeds(own, "__id", text, "doc", bits, WINDOW - SPAN).join(F.broadcast(item_seeds) if small else item_seeds, ["mask", "seed"])
    length = F.least(F.size("item_words"), F.lit(WINDOW))
    found = hits.select("doc_id", "item_id", length.alias("window"),
                        best_window(F.col("doc_words"), F.col("item_words"), F.col("doc_pos"), F.col("item_pos")).alias("matched"))
    return (found.where(F.col("matched") >= F.ceil(F.col("window") * SHARE)).groupBy("doc_id", "item_id")
            .agg(F.max("matched").alias("matched"), F.max("window").alias("window"), F.count("*").alias("hits"))
            .select("doc_id.doc_id", "doc_id.text_md5", "item_id", "matched", "window", "hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without those that hold a passage of ``benchmark``; all columns stay."""
    bad = overlaps(docs, benchmark, text, key).select(F.col("doc_id").alias("__bad"), F.col("text_md5").alias("__md5")).distinct()
    bad = staged(bad, "benchmark-found")
    held, back = sheltered(docs, docs.columns, __key=named(key)[0], __text_md5=F.md5(F.coalesce(named(text)[0], F.lit(""))))
    return held.join(bounded(bad), F.col("__key").eqNullSafe(F.col("__bad")) & (F.col("__text_md5") == F.col("__md5")), "left_anti").select(*back)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched, window, hits of every pair."""
    return overlaps(docs, benchmark).select("doc_id", "item_id", F.col("matched").cast("long").alias("matched"), F.col("window").cast("long").alias("window"), "hits")


def _sql_seeds(table: str, key: str) -> str:
    picks = " UNION ALL ".join(
        f"SELECT {key}, w, {m} AS mask, i, " + " || ' ' || ".join(f"w[i + {k + 1}]" for k, c in enumerate(mask) if c == "1") + f" AS seed FROM p_{table}" for m, mask in enumerate(MASKS))
    return (f"w_{table} AS (SELECT {key}, [x FOR x IN regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS w FROM {table}),\n"
            f"p_{table} AS (SELECT {key}, w, unnest(range(0, len(w) - {SPAN - 1})) AS i FROM w_{table} WHERE len(w) >= {SPAN}),\n"
            f"s_{table} AS ({picks})")


ORACLE_SQL = f"""
WITH {_sql_seeds("documents", "doc_id")},
{_sql_seeds("benchmark", "item_id")},
h AS (SELECT d.doc_id, b.item_id, least(len(b.w), {WINDOW}) AS n, d.w AS dw, b.w AS bw, d.i AS i, b.i AS j
      FROM s_documents d JOIN s_benchmark b USING (mask, seed)),
v AS (SELECT doc_id, item_id, n, list_max([len([x FOR x IN range(s, s + n) IF x + i - j >= 0 AND coalesce(bw[x + 1] = dw[x + i - j + 1], false)])
                                            FOR s IN range(greatest(j - (n - {SPAN}), 0), least(j, len(bw) - n) + 1)]) AS matched FROM h)
SELECT doc_id, item_id, max(matched)::BIGINT AS matched, max(n)::BIGINT AS "window", count(*) AS hits
FROM v WHERE matched >= ceil(n * {SHARE}) GROUP BY 1, 2
"""
