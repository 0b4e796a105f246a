"""Document fingerprints by Order MinHash, DataFrame functions only.

The k-mers are K consecutive words (a shorter text is one k-mer), numbered by
occurrence: the second time a k-mer comes it counts as another element.  Every
element has a hash; its top bits deal it to one of BUCKETS buckets (one
permutation of the elements, cut in parts).  From each bucket the two elements
of least hash are selected, put back into the order in which they stand in the
text, and hashed as a tuple.  Texts share a tuple only if both elements agree
and stand in the same order, so the likeness of two fingerprints falls with the
edits that separate them, also with edits that only move parts.

A bucket that got fewer than two elements, as most do in short texts, takes the
two least of all elements under a hash salted with its number, so an entry
carries order wherever a text has two elements at all.

An element is one long: 35 bits of hash, 28 bits of position, so a plain sort
of longs orders elements by bucket, hash and position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.common import named, others, sheltered, words

K, BUCKETS = 5, 64
_POS_BITS, _BUCKET_SHIFT = 28, 57  # 63 bits: 6 of bucket, 29 more of hash, 28 of position


def _pack(h: Column, pos: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(h, 29), _POS_BITS).bitwiseOR(pos.cast("long"))


def _hash(v: Column) -> Column:
    return F.shiftright(v, _POS_BITS)


def _pos(v: Column) -> Column:
    return v.bitwiseAND(F.lit((1 << _POS_BITS) - 1))


def _bucket(v: Column) -> Column:
    return F.shiftright(v, _BUCKET_SHIFT)


def with_fingerprint(frame: DataFrame, text: str, out: str) -> DataFrame:
    """``frame`` with ``out`` (array<int>): an entry for each bucket; none for texts without words."""
    n = F.size("__w")
    d, back = sheltered(frame, others(frame, out), __w=words(named(text)[0]))
    names = [F.col(c) for c in d.columns[:-1]]
    d = d.select(*names, F.transform("__w", lambda w: F.xxhash64(w)).alias("__w"))
    whole = F.array(_pack(F.xxhash64("__w"), F.lit(0)))
    moving = F.transform(F.sequence(F.lit(0), n - K), lambda i: _pack(F.xxhash64(*[F.get("__w", i + k) for k in range(K)]), i))
    d = d.select(*names, F.when(n >= K, F.sort_array(moving)).when(n > 0, whole).otherwise(F.array().cast("array<bigint>")).alias("__s"))
    # runs of one hash are the occurrences of a k-mer, in text order
    starts = F.when(F.size("__s") == 0, F.array().cast("array<int>")).otherwise(
        F.filter(F.sequence(F.lit(0), F.size("__s") - 1), lambda j: (j == 0) | (_hash(F.get("__s", j)) != _hash(F.get("__s", j - 1)))))
    d = d.select(*names, "__s", starts.alias("__r"))
    numbered = F.flatten(F.transform("__r", lambda a, k: F.transform(
        F.slice("__s", a + 1, F.coalesce(F.get("__r", k + 1), F.size("__s")) - a),
        lambda v, o: F.when(o == 0, v).otherwise(_pack(F.xxhash64(_hash(v), o), _pos(v))))))
    d = d.select(*names, F.when(F.size("__r") == F.size("__s"), F.col("__s")).otherwise(F.sort_array(numbered)).alias("__s"))
    least = F.filter("__s", lambda v, j: (j < 2) | (_bucket(v) != _bucket(F.get("__s", j - 2))))
    d = d.select(*names, "__s", least.alias("__l"))

    def entry(bucket: Column, a: Column, b: Column) -> Column:
        pair = F.when(_pos(a) < _pos(b), F.xxhash64(_hash(a), _hash(b))).otherwise(F.xxhash64(_hash(b), _hash(a)))
        h = F.when(b.isNotNull(), pair).otherwise(F.xxhash64(_hash(a)))  # the only element
        return F.shiftleft(bucket.cast("int"), 26).bitwiseOR(F.shiftrightunsigned(h, 38).cast("int"))

    def of_all(bucket: Column) -> Column:
        """Places in __s of the two least elements under the bucket's own hash."""
        salted = F.transform("__s", lambda v, j: _pack(F.xxhash64(_hash(v), bucket), j))
        return F.transform(F.slice(F.sort_array(salted), 1, 2), lambda x: _pos(x).cast("int"))
    twos = F.when(F.size("__l") < 2, F.array().cast("array<int>")).otherwise(
        F.filter(F.sequence(F.lit(0), F.size("__l") - 2), lambda j: _bucket(F.get("__l", j)) == _bucket(F.get("__l", j + 1))))
    d = d.select(*names, "__s", "__l", twos.alias("__r"))
    scarce = F.when(F.size("__s") == 0, F.array().cast("array<int>")).otherwise(
        F.array_except(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), F.transform("__r", lambda j: _bucket(F.get("__l", j)).cast("int"))))
    places = F.transform(scarce, lambda b: F.struct(b.alias("bucket"), of_all(b).alias("at")))
    d = d.select(*names, "__s", "__l", "__r", places.alias("__p"))
    own = F.transform("__r", lambda j: entry(_bucket(F.get("__l", j)), F.get("__l", j), F.get("__l", j + 1)))
    filled = F.transform("__p", lambda p: entry(p["bucket"], F.get("__s", F.get(p["at"], 0)), F.get("__s", F.get(p["at"], 1))))
    low = F.lit(-(1 << 31))  # buckets in order: the upper half are negative numbers
    ordered = F.transform(F.sort_array(F.transform(F.concat(own, filled), lambda v: v.bitwiseXOR(low))), lambda v: v.bitwiseXOR(low))
    return d.select(*back, ordered.alias(out))


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits for each entry."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.lower(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among the buckets that either fingerprint has; two empty ones are alike (1)."""
    buckets = lambda x: F.transform(x, lambda v: F.shiftrightunsigned(v, 26))
    either = F.size(F.array_union(buckets(a), buckets(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def with_next(docs: DataFrame, key: str, cols: list[str], parts: int) -> DataFrame:
    """``docs`` with ``next_<col>`` for every col of ``cols``: the value of the row that
    follows in ascending ``key`` (null keys last, equal keys by a hash of ``cols``),
    the first row's after the last.

    Rows are cut into ``parts`` ranges of the key by its quantiles; every range
    gets a copy of the first row of the next range behind its own rows, so each
    is sorted on its own and no row needs the whole order.  Only the quantiles
    and the first key of each range pass the driver."""
    k = F.col(f"`{key}`")
    bounds = sorted(set(docs.approxQuantile(key, [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    if bounds:  # binary search among the bounds; null keys after all of them
        bits = [1 << i for i in reversed(range(len(bounds).bit_length()))]
        table = F.array(*[F.lit(float(b)) for b in bounds])
        block = F.aggregate(F.array(*map(F.lit, bits)), F.lit(0), lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(table, at + step - 1) <= k.cast("double")), at + step).otherwise(at))
        block = F.when(k.isNull(), F.lit(len(bounds) + 1)).otherwise(block)
    else:
        block = F.when(k.isNull(), F.lit(1)).otherwise(F.lit(0))
    d = docs.withColumn("__block", block)
    firsts = d.groupBy("__block").agg(F.min(k).alias("k")).orderBy("__block").collect()  # at most parts + 1 rows
    copies = d.where(F.lit(False))
    if firsts:
        blocks = [r["__block"] for r in firsts]
        table = lambda keys, values: F.element_at(F.create_map(*[F.lit(x) for pair in zip(keys, values) for x in pair]), F.col("__block"))
        own = [r for r in firsts if r["k"] is not None]
        if own:
            copies = d.where(k == table([r["__block"] for r in own], [r["k"] for r in own]))
        if len(own) < len(firsts):  # of the rows with null keys the first stands for all
            copies = copies.unionByName(d.where(k.isNull()).orderBy(F.xxhash64(*cols)).limit(1))
        copies = copies.withColumn("__block", table(blocks, [blocks[i - 1] for i in range(len(blocks))]))
    w = Window.partitionBy("__block").orderBy("__copy", k.asc_nulls_last(), F.xxhash64(*cols))
    both = d.withColumn("__copy", F.lit(0)).unionByName(copies.withColumn("__copy", F.lit(1)))
    return both.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols]).where(F.col("__copy") == 0).drop("__copy", "__block")


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out``, the fingerprint as text (a column of that name is replaced).

    Equal texts have equal fingerprints.  Null, empty and blank texts have the
    empty one.  Null keys, repeated rows and further columns stay as they are;
    an empty table gives an empty result."""
    d = with_fingerprint(docs, text, out)
    return d.select(*named(*others(d, out)), as_text(named(out)[0]).alias(out))


def digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text (second half replaced by
    the beginning of the next document), and their likeness."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = with_fingerprint(d, "text", "fp")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = with_next(d, "doc_id", ["text", "fp"], parts)
    n = F.char_length("text")
    d = d.withColumn("edited", F.concat(F.expr("substring(text, 1, char_length(text) - char_length(text) div 2)"), F.expr("substring(next_text, 1, char_length(text) div 2)")))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), "edited", "fp", "next_fp")
    d = with_fingerprint(d.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_fp")
    return d.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
