"""Catalogue: streaming variants of A1 and A13.

The sources are staged from the driver's tables as parquet files (one file
per day), read with ``readStream`` a few files per micro-batch, and their
results must equal the batch oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import ensemble as E
from stationcast.operators.common import stage_path
from stationcast.plans import standins as S
from stationcast.plans.q_ensemble import _EXC_SQL, THRESHOLD
from stationcast.plans.registry import ORACLE, register
from stationcast.streaming import daily as ST


def _disorder(path, spark, part="day") -> str:
    """Watermark delay covering the staged source's disorder.

    The day files are written by parallel tasks of one job, so the file
    stream (which follows modification time) may deliver any day in any
    order: the delay must span all staged days, or earlier days arriving
    after later ones would be dropped as late.  A source that delivers days
    in order would use a short delay instead.
    """
    lo, hi = spark.read.parquet(path).agg(F.min(part), F.max(part)).first()
    return f"{(hi - lo).days + 2} days"


def _stage(df, name, spark, part="day"):
    path = stage_path(spark, name)
    df.hint("rebalance", F.col(part)).write.partitionBy(part).parquet(path)
    return path


@register("a1_daily_agg_stream")
def a1_daily_agg_stream(spark, d):
    sub = S.subdaily(spark, d).withColumn("day", F.to_date("time"))
    src = _stage(sub, "a1src", spark)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 8).parquet(src)
    q = ST.daily_agg_stream(stream.drop("day"), empty_sum="zero", watermark=_disorder(src, spark))
    out = ST.read_latest(spark, ST.run_available(q, stage_path(spark, "a1out"), f"a1-{os.path.basename(src)}"), ["site", "date"])
    return out.select("site", "date", "WG", "TN", "TX", rnd("TP").alias("TP"), rnd("RH").alias("RH"))


@register("a13_exceedance_stream")
def a13_exceedance_stream(spark, d):
    ens = S.ens(spark, d)
    members = E.member_counts(ens)                      # static: one row per site
    src = _stage(ens.withColumn("day", F.col("date")), "a13src", spark)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 8).parquet(src)
    q = ST.exceedance_stream(stream.drop("day"), members, THRESHOLD, watermark=_disorder(src, spark))
    out = ST.read_latest(spark, ST.run_available(q, stage_path(spark, "a13out"), f"a13-{os.path.basename(src)}"), ["site", "date"])
    return out.select("site", "date", rnd("pct").alias("pct"))


# The streaming results must equal the batch queries' oracle.
ORACLE["a1_daily_agg_stream"] = ORACLE["a1_daily_agg"]
ORACLE["a13_exceedance_stream"] = _EXC_SQL + "SELECT site, date, " + S.r("pct") + " AS pct FROM exc"
