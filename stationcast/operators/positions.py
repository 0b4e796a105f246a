"""Exact ranks and order statistics without one task per key.

A window ``partitionBy(site).orderBy(value)`` sorts every value of a site in
one task; with a site holding a third of the data that task holds a third
of the data.  Here the sort is global and range-partitioned on
(keys, value, hash of the row and its input partition): Spark samples that
space, so a hot key, and one value that most rows of a key share, spread over
many partitions.  Per (partition, key) counts form a small table whose running
sums give every partition its offset; position = offset + local index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.operators.common import cut_lineage, join_on


def global_positions(df: DataFrame, keys: Sequence[str], value: str,
                     num_partitions: int | None = None, keep_partition: bool = False,
                     ties: bool = True) -> DataFrame:
    """Add ``pos`` (0-based row number in value order within the key),
    ``n_lt`` (rows of the key with a strictly smaller value; only with
    ``ties``, as it costs a join on the distinct values) and ``n`` (rows of
    the key).  Rows with a null value have no position and are left out;
    callers that keep them add them again.  A null key is a key like others.

    Ties get consecutive ``pos`` in an arbitrary but fixed order.  With
    ``keep_partition`` the range partition of each row is kept as
    ``range_part`` (to inspect how a hot key was spread).
    """
    keys = list(keys)
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = df.filter(F.col(value).isNotNull())
    # Range bounds come from a sample and ids from row order, both of which
    # may differ between two evaluations of the input: the tagged frame is
    # written once to the checkpoint folder and every branch reads that copy.
    salted = d.withColumn("_salt", F.xxhash64(*[F.col(f"`{c}`") for c in d.columns], F.spark_partition_id()))
    d = cut_lineage(salted.repartitionByRange(n_parts, *keys, value, "_salt")
                    .sortWithinPartitions(*keys, value, "_salt").drop("_salt")
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_id", F.monotonically_increasing_id()))
    # local index within (partition, key)
    part = d.groupBy("_pid", *keys).agg(F.min("_id").alias("_kmin"), F.count(F.lit(1)).alias("_kn"))
    wk = Window.partitionBy(*keys).orderBy("_pid")
    part = part.select("_pid", *keys, "_kmin",
                       (F.sum("_kn").over(wk) - F.col("_kn")).alias("_off"),
                       F.sum("_kn").over(Window.partitionBy(*keys)).alias("n"))
    out = join_on(d, part, ["_pid", *keys]).withColumn("pos", F.col("_off") + F.col("_id") - F.col("_kmin"))
    if ties:
        out = join_on(out, out.groupBy(*keys, value).agg(F.min("pos").alias("n_lt")), [*keys, value])
    if keep_partition:
        out = out.withColumnRenamed("_pid", "range_part")
    return out.drop("_pid", "_id", "_kmin", "_off")


def quantile_cont(df: DataFrame, keys: Sequence[str], value: str, q: float,
                  name: str = "quantile") -> DataFrame:
    """Exact linearly interpolated quantile per key (NumPy ``percentile``
    default, DuckDB ``quantile_cont``) from global positions.

    Only the two order statistics around ``q * (n - 1)`` are kept, so the
    final aggregation is two rows per key.
    """
    keys = list(keys)
    p = global_positions(df.select(*keys, value), keys, value, ties=False)
    h = F.lit(q) * (F.col("n") - 1)
    lo, hi = F.floor(h), F.ceil(h)
    sel = p.filter((F.col("pos") == lo) | (F.col("pos") == hi)).select(
        *keys, "pos", value, h.alias("_h"), lo.alias("_lo"))
    agg = sel.groupBy(*keys).agg(
        F.max(F.when(F.col("pos") == F.col("_lo"), F.col(value))).alias("_vlo"),
        F.max(F.when(F.col("pos") == F.ceil("_h"), F.col(value))).alias("_vhi"),
        F.first("_h").alias("_h"), F.first("_lo").alias("_lo"))
    return agg.select(*keys, (F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))).alias(name))
