"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words.  It is met by complete epochs of
the source first; the rest of an epoch is a weighted sample without
replacement: each document draws an exponential key, scaled by its quality
weight, and documents are taken in the order of their keys until the prefix
sum of their sizes reaches what is left of the budget.

The prefix sums need no source in one task: keys fall into BUCKETS ranges,
their sums (combined in the tasks first) tell the one range in which the
budget ends, and only the documents of that range are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationcast.llm.common import n_words, named, others, sheltered, staged
from stationcast.operators.common import bounded

#: Ranges of keys in a source.
BUCKETS = 4096
#: Weights of the sources, in order, repeating; no source is taken more than MOST times.
WEIGHTS, MOST = (1, 2, 3), 3
SEED = "mix-1"
#: Source tables of up to this many rows (some MB) are broadcast; larger ones are joined by a shuffle.
SMALL_TABLE = 50_000


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets from (source, source_size): shares by weight, cut at MOST times the
    source's size, what is cut off shared again by weight until none is above.

    Sources that stay below their cap get weight x level, so with the sources
    ordered by cap / weight the level follows from prefix sums: it is that of the
    first source, of several that tie too, whose own level is not above its cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    w = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", F.lit(float(MOST)) * F.col("source_size"))
    order = [F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()]
    before, after = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    w = w.withColumn("level", level).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    w = w.withColumn("level", F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("place", "level"))).over(whole)["level"])
    return w.select("source", "source_size", F.least(F.coalesce(F.col("weight") * F.col("level"), F.col("cap")), F.col("cap")).alias("target"))


def sample_key(doc_id: Column, quality: Column) -> Column:
    """Exponential key -ln(u) / quality; u in (0, 1) from the MD5 of seed and doc_id."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / quality


def mix(docs: DataFrame, quality: Column | None = None, text: str = "text", key: str = "doc_id", source: str = "source",
        size: Column | None = None) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``taken``
    (words the mix takes, repeats counted); columns of these names are replaced.

    ``quality`` is a positive weight over the columns of ``docs`` (1 by default;
    null and values that are not positive count as 1), ``size`` the number of
    words, for a caller that counted them before a join already.  Null and empty texts
    have size 0 and are taken 0 words.  A null source is a source like others,
    the last one; null keys draw one common number.  Equal sample keys are
    ordered by key and text, so reruns agree.  An empty table gives an empty result."""
    names = others(docs, "size", "source_size", "target", "taken")
    q = F.lit(1.0) if quality is None else F.when(quality > 0, quality).otherwise(1.0).cast("double")
    has_text = text.lower() in {c.lower() for c in names}
    d, back = sheltered(docs, names, __q=q, __id=named(key)[0], __s=named(source)[0], size=size if size is not None else n_words(named(text)[0]) if has_text else F.col("size"),
                        __text=F.xxhash64(named(text)[0]) if has_text else F.lit(0))
    d = d.withColumn("__key", sample_key(F.col("__id"), F.col("__q")))
    d = d.withColumn("__b", F.least(F.floor((1 - F.exp(-F.col("__key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    sums = staged(d.groupBy("__s", "__b").agg(F.sum("size").alias("size")), "mix-sums")
    targets = source_targets(sums.groupBy(F.col("__s").alias("source")).agg(F.sum("size").alias("source_size")))
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    running = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (sums.withColumn("upto", F.sum("size").over(running)).withColumn("upto_before", F.col("upto") - F.col("size"))
            .join(plan, F.col("__s").eqNullSafe(F.col("source"))).where((F.col("upto_before") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
            .select("source", F.col("__b").alias("last"), "upto_before"))
    plan = staged(plan.alias("p").join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
                  .select(F.col("p.source").alias("__source"), "source_size", "target", F.col("epochs").alias("__epochs"), F.col("rest").alias("__rest"),
                          F.col("last").alias("__last"), F.col("upto_before").alias("__before")), "mix-plan")
    small = plan.count() <= SMALL_TABLE
    j = d.join(F.broadcast(plan) if small else plan, F.col("__s").eqNullSafe(F.col("__source")), "left")
    ends_here = F.coalesce(F.col("__b") == F.col("__last"), F.lit(False))
    ties = [F.col("__key"), F.col("__id").asc_nulls_last(), F.col("__text"), F.col("size")]
    upto = F.sum("size").over(Window.partitionBy("__s", "__b").orderBy(*ties).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # the document that crosses the budget is taken when that comes nearer to it
    inside = j.where(ends_here).withColumn("__more", (F.col("__before") + upto - F.col("size") / 2 <= F.col("__rest")).cast("long"))
    outside = j.where(~ends_here).withColumn("__more", F.coalesce((F.col("__b") < F.col("__last")) & (F.col("__rest") > 0), F.lit(False)).cast("long"))
    return inside.unionByName(outside).select(*back, "size", "source_size", "target",
                                              (F.col("size") * (F.col("__epochs") + F.col("__more"))).cast("long").alias("taken"))


def with_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``__quality``: 2 where its label is 1, 0.5 where it is 0, by
    the mean of several labels, 1 without a label."""
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__lk")).agg(F.pow(F.lit(4.0), F.avg(F.col("quality").cast("double")) - 0.5).alias("__quality"))
    joined = docs.drop("__quality").join(bounded(staged(known, "mix-quality")), named(key)[0] == F.col("__lk"), "left")
    return joined.drop("__lk").withColumn("__quality", F.coalesce("__quality", F.lit(1.0)))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    return mix(with_quality(sized, labels), F.col("__quality")).select("doc_id", "size", "source_size", "target", "taken")


#: Targets by sharing again and again: in every round the sources above their cap are cut and leave.
ORACLE_SQL = f"""
WITH RECURSIVE q AS (SELECT doc_id, pow(4.0, avg(quality::DOUBLE) - 0.5) AS w FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
d AS (SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
             -ln((('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}.0) / coalesce(q.w, 1.0) AS k
      FROM documents d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS w,
             {float(MOST)} * sum(size)::DOUBLE AS cap FROM d GROUP BY source),
v AS (SELECT 0 AS round, source, source_size, w, cap, 0.0::DOUBLE AS target, true AS free FROM s
      UNION ALL
      SELECT round + 1, source, source_size, w, cap, CASE WHEN free THEN least(cap, share) ELSE target END, free AND share < cap
      FROM (SELECT *, w * (((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(target) FILTER (WHERE NOT free) OVER (), 0.0))
                           / sum(w::DOUBLE) FILTER (WHERE free) OVER ()) AS share FROM v)
      WHERE round < (SELECT count(*) FROM s)),
t AS (SELECT source, source_size, target FROM v WHERE round = (SELECT count(*) FROM s)),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
x AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM x
"""
