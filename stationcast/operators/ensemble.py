"""Ensemble-forecast operators over the long form (keys, date, member, value).

The wide ``<PRED>_<member>`` layout of forecast files is melted once at the
source (R5); everything below is grouping on ``keys + time`` so the shuffle
carries one partially-aggregated row per key and day, never a member list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions.scalars import SQRT_2PI, month_label, scott_bandwidth
from stationcast.operators.common import join_on


def _cond(value: str, threshold: float, op: str):
    v = F.col(value)
    if op == "above":
        return v > F.lit(threshold)
    if op == "below":
        return v < F.lit(threshold)
    raise ValueError(f"op must be 'above' or 'below', not {op!r}")


def member_counts(df: DataFrame, keys: Sequence[str] = ("site",),
                  member: str = "member") -> DataFrame:
    """Distinct members per key (the column count of the wide forecast)."""
    return df.groupBy(*keys).agg(F.countDistinct(member).alias("n_members"))


def exceedance(df: DataFrame, threshold: float, op: str = "above",
               keys: Sequence[str] = ("site",), time: str = "date",
               member: str = "member", value: str = "value",
               n_members: int | None = None) -> DataFrame:
    """Percent of ensemble members above/below ``threshold`` per key and day.

    Members without a value (null or absent that day) count as not
    exceeding and stay in the denominator, as a row mean over all member
    columns of the wide forecast does.  The denominator is the number of
    members of the key, or ``n_members`` when the ensemble size is known.
    """
    hits = df.groupBy(*keys, time).agg(
        F.count_if(_cond(value, threshold, op)).alias("_hits"))
    if n_members is not None:
        denom = F.lit(float(n_members))
        out = hits
    else:
        # One row per key: its size is bounded by the number of sites and
        # AQE broadcasts it at runtime when small.
        out = join_on(hits, member_counts(df, keys, member), list(keys))
        denom = F.col("n_members")
    return out.select(*keys, time, (F.lit(100.0) * F.col("_hits") / denom).alias("pct"))


def monthly_risk(exc: DataFrame, p: float, keys: Sequence[str] = ("site",),
                 time: str = "date", pct: str = "pct") -> DataFrame:
    """Per key and ``YYYY-MM``: days with probability > p, total days and
    their percentage rounded half-to-even to 1 dp; 0 when none (A14)."""
    over = F.count_if(F.col(pct) > F.lit(p))
    return (exc.groupBy(*keys, month_label(time).alias("month"))
            .agg(over.alias("days_over"), F.count(F.lit(1)).alias("total_days"),
                 F.bround(F.lit(100.0) * over / F.count(F.lit(1)), 1).alias("percentage")))


def risk_days(exc: DataFrame, p: float, keys: Sequence[str] = ("site",),
              time: str = "date", pct: str = "pct") -> DataFrame:
    """Days whose probability exceeds ``p``, in time order."""
    return exc.filter(F.col(pct) > F.lit(p)).orderBy(*keys, time)


def ensemble_mean(df: DataFrame, keys: Sequence[str] = ("site",),
                  time: str = "date", value: str = "value") -> DataFrame:
    """Mean over members skipping nulls."""
    return df.groupBy(*keys, time).agg(F.avg(value).alias("ensemble_mean"))


def member_matrix(df: DataFrame, columns: Sequence, keys: Sequence[str] = ("site",),
                  member: str = "member", time: str = "date",
                  value: str = "value", agg: str = "avg") -> DataFrame:
    """Member x time matrix (R6): one row per member, one column per listed
    time value.  The column list is explicit so the pivot never scans for
    distinct values and its width is bounded by the caller."""
    return (df.groupBy(*keys, member).pivot(time, list(columns))
            .agg(getattr(F, agg)(value)))


def scale_bias(ens: DataFrame, obs: DataFrame, keys: Sequence[str] = ("site",),
               member: str = "member", value: str = "value",
               obs_value: str = "value") -> DataFrame:
    """Multiplicative bias correction.

    factor = mean(obs) / mean over members of (mean of the member); 1 when
    the ensemble mean is 0.  Applied to every member value.
    """
    member_means = ens.groupBy(*keys, member).agg(F.avg(value).alias("_mm"))
    ens_mean = member_means.groupBy(*keys).agg(F.avg("_mm").alias("ens_mean"))
    obs_mean = obs.groupBy(*keys).agg(F.avg(obs_value).alias("obs_mean"))
    factor = (join_on(ens_mean, obs_mean, list(keys), "left")
              .select(*keys, F.when(F.col("ens_mean") == 0, F.lit(1.0))
                      .otherwise(F.col("obs_mean") / F.col("ens_mean")).alias("factor")))
    return (join_on(ens, factor, list(keys), "left")
            .withColumn("corrected", F.col(value) * F.col("factor")))


def kde(df: DataFrame, keys: Sequence[str], value: str = "value",
        gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of each series on an evaluation grid.

    Bandwidth is Scott's rule on the sample standard deviation; the grid runs
    from min - cut*h to max + cut*h in ``gridsize`` steps per series.  The
    grid (keys x gridsize rows, bounded by the number of series) is joined to
    the values; the density sum is a partial aggregation per (key, grid
    index), so the shuffle carries keys x gridsize rows whatever the series
    length.
    """
    keys = list(keys)
    vals = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    stats = (vals.groupBy(*keys)
             .agg(F.count("_x").alias("_n"), F.stddev_samp("_x").alias("_sd"),
                  F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
             .withColumn("_h", scott_bandwidth(F.col("_sd"), F.col("_n")))
             .filter((F.col("_n") > 1) & (F.col("_h") > 0)))
    step = (F.col("_hi") - F.col("_lo") + F.lit(2 * cut) * F.col("_h")) / F.lit(gridsize - 1)
    grid = (stats.select(*keys, "_n", "_h", "_lo", step.alias("_step"),
                         F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_idx"))
            .withColumn("x", F.col("_lo") - F.lit(cut) * F.col("_h") + F.col("grid_idx") * F.col("_step")))
    z = (F.col("x") - F.col("_x")) / F.col("_h")
    return (vals.join(grid.select(*keys, "grid_idx", "x", "_n", "_h"), keys)
            .groupBy(*keys, "grid_idx", "x", "_n", "_h")
            .agg(F.sum(F.exp(F.lit(-0.5) * z * z)).alias("_s"))
            .select(*keys, "grid_idx", "x",
                    (F.col("_s") / (F.col("_n") * F.col("_h") * F.lit(SQRT_2PI))).alias("density")))


def kde_binned(df: DataFrame, keys: Sequence[str], value: str = "value",
               gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """``kde`` by linear binning (A21): the tasks reduce the values to weights on the
    grid, each value shared by its two neighbours, and the kernel is summed
    between grid points, so the cost is rows + series x gridsize^2 and not
    rows x gridsize.  A density differs from the exact sum by at most
    step^2 / (8 h^3 sqrt(2 pi)).  A series without spread, or of one value, is one
    row: null ``grid_idx`` and ``density``, ``x`` its least value.
    """
    keys = list(keys)
    vals = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    stats = (vals.groupBy(*keys)
             .agg(F.count("_x").alias("_n"), F.stddev_samp("_x").alias("_sd"),
                  F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
             .withColumn("_h", scott_bandwidth(F.col("_sd"), F.col("_n")))
             .withColumn("_wide", F.coalesce((F.col("_n") > 1) & (F.col("_h") > 0), F.lit(False))))
    own = ["_n", "_h", "_from", "_step"]
    grid = stats.filter("_wide").select(
        *keys, "_n", "_h", (F.col("_lo") - F.lit(cut) * F.col("_h")).alias("_from"),
        ((F.col("_hi") - F.col("_lo") + F.lit(2 * cut) * F.col("_h")) / F.lit(gridsize - 1)).alias("_step"))
    at = (F.col("_x") - F.col("_from")) / F.col("_step")
    placed = (join_on(vals, grid, keys).withColumn("_at", at)
              .withColumn("_i", F.least(F.floor("_at"), F.lit(gridsize - 2)).cast("int")))
    part = F.col("_at") - F.col("_i")
    weights = (placed.select(*keys, *own, F.inline(F.array(F.struct(F.col("_i").alias("i"), (F.lit(1.0) - part).alias("w")),
                                                           F.struct((F.col("_i") + 1).alias("i"), part.alias("w")))))
               .groupBy(*keys, *own, "i").agg(F.sum("w").alias("w")))
    bins = weights.groupBy(*keys, *own).agg(F.collect_list(F.struct("i", "w")).alias("_bins"))  # at most gridsize
    points = bins.select(*keys, *own, "_bins", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_idx"))

    def add(total, b):
        z = (F.col("grid_idx") - b["i"]) * F.col("_step") / F.col("_h")
        return total + b["w"] * F.exp(F.lit(-0.5) * z * z)
    dense = points.select(*keys, "grid_idx", (F.col("_from") + F.col("grid_idx") * F.col("_step")).alias("x"),
                          (F.aggregate("_bins", F.lit(0.0), add) / (F.col("_n") * F.col("_h") * F.lit(SQRT_2PI))).alias("density"))
    flat = stats.filter(~F.col("_wide")).select(*keys, F.lit(None).cast("int").alias("grid_idx"), F.col("_lo").alias("x"),
                                                F.lit(None).cast("double").alias("density"))
    return dense.unionByName(flat)
