"""Structured Streaming variants of the daily aggregation (A1) and the
ensemble exceedance (A13).

Both are update-mode aggregations keyed by an event-time day window with a
watermark, so state for days older than the watermark is dropped.  The sink
is an append-only parquet log written per micro-batch under
``<path>/epoch=<id>`` (a replayed epoch overwrites itself, so the sink is
idempotent); ``read_latest`` returns the newest row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.operators.climatology import _AGG, DEFAULT_MAPPING, DEFAULT_RULES
from stationcast.operators.windows import utc_date, utc_instant
from stationcast.session import checkpoint_dir


def daily_agg_stream(stream: DataFrame, mapping: Mapping[str, str] | None = None,
                     rules: Mapping[str, str] | None = None, keys: Sequence[str] = ("site",),
                     time: str = "time", watermark: str = "2 days", empty_sum: str = "null") -> DataFrame:
    """A1 on a streaming frame: per key and UTC day, one rule per target."""
    mapping = dict(mapping or DEFAULT_MAPPING)
    rules = dict(rules or DEFAULT_RULES)
    s = stream.withColumn(time, utc_instant(stream, time)).withWatermark(time, watermark)
    targets: dict[str, list[str]] = {}
    for src in [c for c in mapping if c in s.columns]:
        targets.setdefault(mapping[src], []).append(src)
    aggs = []
    for tgt, srcs in targets.items():
        parts = [_AGG[rules[tgt]](F.col(c)) for c in srcs]
        e = parts[0] if len(parts) == 1 else F.coalesce(*parts)
        if rules[tgt] == "sum" and empty_sum == "zero":
            e = F.coalesce(e, F.lit(0.0))
        aggs.append(e.alias(tgt))
    g = s.groupBy(*keys, F.window(F.col(time), "1 day").alias("_w")).agg(*aggs)
    return g.select(*keys, utc_date(F.col("_w.start")).alias("date"), *targets.keys())


def exceedance_stream(stream: DataFrame, members: DataFrame, threshold: float, op: str = "above",
                      keys: Sequence[str] = ("site",), time: str = "date", value: str = "value",
                      watermark: str = "2 days") -> DataFrame:
    """A13 on a streaming daily ensemble (keys, member, date, value).

    ``members`` is a static table (keys, n_members): the ensemble size per
    key, joined stream-static before the aggregation.
    """
    cond = F.col(value) > threshold if op == "above" else F.col(value) < threshold
    s = (stream.withColumn("_t", utc_instant(stream, time)).withWatermark("_t", watermark)
         .join(members, list(keys)))
    g = s.groupBy(*keys, F.window("_t", "1 day").alias("_w"), "n_members").agg(F.count_if(cond).alias("_hits"))
    return g.select(*keys, utc_date(F.col("_w.start")).alias(time),
                    (F.lit(100.0) * F.col("_hits") / F.col("n_members")).alias("pct"))


def run_available(query: DataFrame, path: str, name: str, output_mode: str = "update") -> str:
    """Process everything available now, batch by batch, into ``path``."""
    spark = query.sparkSession
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    q = (query.writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return path


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest emitted row per key from the epoch log."""
    log = spark.read.option("mergeSchema", "true").parquet(path)
    rest = [c for c in log.columns if c not in (*keys, "_epoch", "epoch")]
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("_epoch")).alias("_r"))
            .select(*keys, "_r.*"))
