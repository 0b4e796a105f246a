"""Daily aggregation, monthly statistics, climatologies and delta change.

Statistics are computed at the (keys, year, month) or (keys, month) grain and
joined back to daily rows; those stat tables are bounded by
sites x years x 12, so AQE turns the join into a broadcast at runtime.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions.scalars import wind_speed

def circular_mean(c):
    """Mean direction in degrees [0, 360) of angles in degrees (Q9 option)."""
    r = F.radians(F.col(c) if isinstance(c, str) else c)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r)))), F.lit(360.0))


_AGG = {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg, "avg": F.avg,
        "circular_mean": circular_mean}

# Default source -> target names and rules for station data.
DEFAULT_MAPPING = {
    "WG_PT1H_MAX": "WG", "WG_PT10M_MAX": "WG",
    "TA_PT12H_MIN": "TN", "TA_PT12H_MAX": "TX",
    "PRA_PT12H_ACC": "TP",
    "RH_PT1H_AVG": "RH", "RH_PT1M_AVG": "RH",
    "WS_PT1H_AVG": "WS", "WD_PT1H_AVG": "WD",
    "WS_PT10M_AVG": "WS", "WD_PT10M_AVG": "WD",
}
DEFAULT_RULES = {"WG": "max", "TN": "min", "TX": "max", "TP": "sum",
                 "RH": "mean", "WS": "mean", "WD": "mean"}


def daily_agg(df: DataFrame, mapping: Mapping[str, str] | None = None,
              rules: Mapping[str, str] | None = None,
              keys: Sequence[str] = ("site",), time: str = "time",
              empty_sum: str = "null") -> DataFrame:
    """Sub-daily -> daily with one rule per target variable (A1).

    ``mapping`` maps source columns to targets; several sources may feed one
    target and are combined with ``coalesce`` in mapping order (Q10).  Only
    sources present in ``df`` are used.  ``empty_sum='zero'`` makes a sum
    over a day with rows but no values 0 (pandas ``sum``); ``'null'`` keeps
    SQL semantics (``sum(min_count=1)``).
    """
    mapping = dict(mapping or DEFAULT_MAPPING)
    rules = dict(rules or DEFAULT_RULES)
    present = [c for c in mapping if c in df.columns]
    targets: dict[str, list[str]] = {}
    for src in present:
        targets.setdefault(mapping[src], []).append(src)
    aggs = []
    for tgt, srcs in targets.items():
        rule = rules[tgt]
        parts = [_AGG[rule](F.col(s)) for s in srcs]
        expr = parts[0] if len(parts) == 1 else F.coalesce(*parts)
        if rule == "sum" and empty_sum == "zero":
            expr = F.coalesce(expr, F.lit(0.0))
        aggs.append(expr.alias(tgt))
    return df.groupBy(*keys, F.to_date(F.col(time)).alias("date")).agg(*aggs)


def daily_wind(df: DataFrame, keys: Sequence[str], time: str = "time",
               u: str = "u", v: str = "v") -> DataFrame:
    """6-hourly -> daily mean of u and v, then wind speed of the means (A2).

    Rows with a null key (time or coordinates) are dropped, as a pandas
    group-by does (D7); Spark would otherwise keep a null group.
    """
    notnull = F.col(time).isNotNull()
    for k in keys:
        notnull = notnull & F.col(k).isNotNull()
    return (df.filter(notnull).groupBy(*keys, F.to_date(F.col(time)).alias("date"))
            .agg(F.avg(u).alias(u), F.avg(v).alias(v))
            .withColumn("wind_speed", wind_speed(u, v)))


def _stat_aggs(cols: Sequence[str], stats=("mean", "min", "max")):
    return [_AGG[s](c).alias(f"{c}_{s}") for c in cols for s in stats]


def monthly_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("site",),
                  date: str = "date") -> DataFrame:
    """Year-month mean/min/max of ``cols`` (A3): ``<col>_mean|_min|_max``."""
    return (df.groupBy(*keys, F.year(date).alias("year"), F.month(date).alias("month"))
            .agg(*_stat_aggs(cols)))


def month_climatology(df: DataFrame, cols: Sequence[str], until: str | None = None,
                      keys: Sequence[str] = ("site",), date: str = "date",
                      since: str | None = None) -> DataFrame:
    """Month-of-year mean/min/max over the training window only (A4)."""
    if until is not None:
        df = df.filter(F.col(date) <= F.lit(until).cast("date"))
    if since is not None:
        df = df.filter(F.col(date) >= F.lit(since).cast("date"))
    return df.groupBy(*keys, F.month(date).alias("month")).agg(*_stat_aggs(cols))


def stat_climatology(df: DataFrame, col: str, keys: Sequence[str] = ("site",),
                     date: str = "date") -> DataFrame:
    """Climatology of monthly statistics (A5).

    The reference averages the year-month mean/max/min over the *daily* rows
    they were joined to, so each month is weighted by its number of days.
    Computed here without the join back: sum(stat * days) / sum(days) over
    the year-month table, counting only months whose statistic exists.
    """
    ym = (df.groupBy(*keys, F.year(date).alias("year"), F.month(date).alias("month"))
          .agg(F.count(F.lit(1)).alias("_days"), *_stat_aggs([col], ("mean", "max", "min"))))
    out = []
    for s in ("mean", "max", "min"):
        stat = F.col(f"{col}_{s}")
        w = F.when(stat.isNotNull(), F.col("_days"))
        out.append((F.sum(stat * F.col("_days")) / F.sum(w)).alias(f"{col}_{s}_climatology"))
    return ym.groupBy(*keys, "month").agg(*out)


def climatology_for_year(df: DataFrame, clim: DataFrame, year: int,
                         keys: Sequence[str] = ("site",), date: str = "date") -> DataFrame:
    """Dates of one template year carrying the month climatology."""
    days = (df.filter(F.year(date) == year).select(*keys, date).distinct()
            .withColumn("month", F.month(date)))
    return days.join(clim, [*keys, "month"], "left").drop("month")


def diff_features(stats: DataFrame, var: str, pred: str) -> DataFrame:
    """``<var>_<pred>_diff_{mean,min,max}`` = ``<var>_sum_*`` - ``<pred>_*``."""
    return stats.withColumns({
        f"{var}_{pred}_diff_{s}": F.col(f"{var}_sum_{s}") - F.col(f"{pred}_{s}")
        for s in ("mean", "min", "max")})


def fill_future(df: DataFrame, clim: DataFrame, pred: str, cutoff: str,
                keys: Sequence[str] = ("site",), date: str = "date") -> DataFrame:
    """Rows after ``cutoff`` get ``<pred>_{mean,min,max}`` from the month
    climatology ``clim`` (columns ``<pred>_mean|_min|_max``) (A8)."""
    fut = df.filter(F.col(date) > F.lit(cutoff).cast("date")).withColumn("month", F.month(date))
    stats = [f"{pred}_{s}" for s in ("mean", "min", "max")]
    fut = fut.drop(*[c for c in stats if c in fut.columns])
    return fut.join(clim.select(*keys, "month", *stats), [*keys, "month"], "left")


def delta_change(df: DataFrame, var_sum: str, pred: str, cutoff: str,
                 keys: Sequence[str] = ("site",), date: str = "date",
                 materialize: bool = False) -> DataFrame:
    """Delta-change projection of predictand monthly statistics.

    Input: daily rows with the 4-point mean ``var_sum`` and the predictand
    ``pred`` (null after the cutoff).  Past rows (date <= cutoff) carry the
    year-month statistics of ``pred``; future rows carry
    ``clim[month] + diff_future - mean(diff_past over past days of month)``
    where ``diff_past = <var>_sum_stat - pred_stat`` of the past year-month
    and ``diff_future = <var>_sum_stat`` of the future year-month (the
    future has no predictand statistics, so nothing is subtracted).

    The daily input is read twice (statistics, then the join back); with
    ``materialize`` it is written once to the checkpoint folder first, for
    inputs that are expensive to recompute.
    """
    stats = ("mean", "min", "max")
    cut = F.lit(cutoff).cast("date")
    d = df.select(*keys, date, var_sum, pred).withColumns({
        "year": F.year(date), "month": F.month(date), "_past": F.col(date) <= cut})
    if materialize:
        from stationcast.operators.common import cut_lineage
        d = cut_lineage(d)
    ym = (d.groupBy(*keys, "year", "month", "_past")
          .agg(F.count(F.lit(1)).alias("_days"), F.count(pred).alias("_pn"),
               *[_AGG[s](var_sum).alias(f"_v_{s}") for s in stats],
               *[_AGG[s](pred).alias(f"_p_{s}") for s in stats]))
    # month climatology of the past from the (small) year-month table, not
    # from another pass over the daily rows
    clim = (ym.filter("_past").groupBy(*keys, "month")
            .agg((F.sum(F.col("_p_mean") * F.col("_pn")) / F.sum(F.when(F.col("_pn") > 0, F.col("_pn")))).alias("_c_mean"),
                 F.min("_p_min").alias("_c_min"), F.max("_p_max").alias("_c_max")))
    # mean over past *days* of the year-month diff (day-weighted)
    past_diff = (ym.filter("_past").groupBy(*keys, "month")
                 .agg(*[(F.sum((F.col(f"_v_{s}") - F.col(f"_p_{s}")) * F.col("_days"))
                         / F.sum(F.when((F.col(f"_v_{s}") - F.col(f"_p_{s}")).isNotNull(), F.col("_days"))))
                        .alias(f"_dp_{s}") for s in stats]))
    ym = ym.join(clim, [*keys, "month"], "left").join(past_diff, [*keys, "month"], "left")
    proj = {f"{pred}_{s}": F.when(F.col("_past"), F.col(f"_p_{s}"))
            .otherwise(F.col(f"_c_{s}") + F.col(f"_v_{s}") - F.col(f"_dp_{s}")) for s in stats}
    ym = ym.select(*keys, "year", "month", "_past", *[e.alias(k) for k, e in proj.items()])
    return (d.join(ym, [*keys, "year", "month", "_past"], "left")
            .select(*keys, date, *proj.keys()))
