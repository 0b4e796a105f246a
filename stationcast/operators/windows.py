"""Time-window operators.

Daily lags are equi-joins on (keys, date - n) rather than windows, so a
site's whole series never has to sit in one sorted partition; the 24-hour
trailing aggregate sampled at 00 UTC is a group-by on the sample instant;
forward fill runs per (key, chunk) with a carried-in value per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.operators.common import join_on
from stationcast.operators.positions import global_positions

_AGG = {"max": F.max, "min": F.min, "sum": F.sum, "mean": F.avg, "avg": F.avg}


def utc_instant(df: DataFrame, col: str):
    """The column as a TIMESTAMP instant, reading wall-clock types as UTC.

    ``timestamp_ntz`` and ``date`` values are zone-less UTC in the data; a
    plain cast would read them in the session time zone.
    """
    t = F.col(col)
    kind = dict(df.dtypes)[col]
    if kind == "timestamp_ntz":
        return F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
                                F.date_part(F.lit("SECOND"), t), F.lit("UTC"))
    if kind == "date":
        return F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    return t


def utc_date(ts):
    """UTC calendar day of a TIMESTAMP instant."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("int"))


# ------------------------------------------------------------------ W1/W2
def shift_days(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("site",),
               date: str = "date", n: int = 1, suffix: str = "_lag") -> DataFrame:
    """Value of ``cols`` ``n`` calendar days earlier.

    On a complete daily series (see ``reindex_daily``) this equals the
    previous row.  Written as a left equi-join on (keys, date - n) so it is
    partitioned by (keys, date): no per-site sort.
    """
    prev = df.select(*keys, F.date_add(F.col(date), n).alias(date),
                     *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return join_on(df, prev, [*keys, date], "left")


def shift_rows(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("site",),
               order: str = "date", n: int = 1, suffix: str = "_lag") -> DataFrame:
    """Previous-row shift by physical order within a key (D6 semantics on
    irregular series).

    Rows meet by their exact positions, from one range-partitioned sort over
    all keys, so a long series is not sorted in one task.  Rows without an
    order stay, with a null shift."""
    keys = list(keys)
    pos = global_positions(df, keys, order, ties=False).drop("n")
    prev = pos.select(*keys, (F.col("pos") + n).alias("pos"), *[F.col(f"`{c}`").alias(f"{c}{suffix}") for c in cols])
    out = join_on(pos, prev, [*keys, "pos"], "left").select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{c}{suffix}`") for c in cols])
    return out.unionByName(df.filter(F.col(order).isNull()), allowMissingColumns=True)


def delta(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("site",),
          date: str = "date", prefix: str = "D") -> DataFrame:
    """Day-to-day change ``D<col> = col - col(previous day)``."""
    out = shift_days(df, cols, keys, date, 1, "__prev")
    return out.withColumns({f"{prefix}{c}": F.col(c) - F.col(f"{c}__prev") for c in cols}).drop(
        *[f"{c}__prev" for c in cols])


# ------------------------------------------------------------------ W3
def trailing_agg_sampled(df: DataFrame, value: str, fn: str, keys: Sequence[str] = ("site",),
                         time: str = "time", sample_hour: int = 0, name: str | None = None) -> DataFrame:
    """Trailing 24 h aggregate over (t - 24 h, t] kept at rows at
    ``sample_hour`` UTC (W3, e.g. ``max_t(x/24h/0h)``).

    Each row belongs to exactly one sample instant (the next HH:00 at or
    after it), so the windowed value is a grouped aggregate with a map-side
    partial step; rows existing at the sample instant are then kept.
    """
    t = F.col(time)
    day = F.date_trunc("day", t - F.make_dt_interval(hours=F.lit(sample_hour)))
    anchor = day + F.make_dt_interval(hours=F.lit(sample_hour))
    sample = F.when(t == anchor, t).otherwise(anchor + F.expr("INTERVAL 1 DAY"))
    agg = df.groupBy(*keys, sample.alias(time)).agg(_AGG[fn](value).alias(name or f"{fn}_24h"))
    at = df.filter((F.hour(t) == sample_hour) & (F.minute(t) == 0) & (F.second(t) == 0)).select(*keys, time).distinct()
    return join_on(agg, at, [*keys, time], "left_semi")


def trailing_agg(df: DataFrame, value: str, fn: str, keys: Sequence[str] = ("site",),
                 time: str = "time", hours: int = 24, name: str | None = None) -> DataFrame:
    """Trailing (t - hours, t] aggregate at every row (W3, unsampled).

    A RANGE frame, but never over a whole series: time is cut into buckets
    of ``hours``; every row is also copied into the next bucket, so the
    window partitioned by (keys, bucket) sees the previous bucket's rows it
    needs and holds at most two buckets of one key.  Only the originals are
    returned.
    """
    span = hours * 3600 * 1_000_000
    micros = F.unix_micros(utc_instant(df, time))
    d = df.withColumns({"_us": micros, "_b": F.floor(micros / F.lit(span))})
    both = (d.withColumn("_own", F.lit(True))
            .unionByName(d.withColumns({"_b": F.col("_b") + 1, "_own": F.lit(False)})))
    w = Window.partitionBy(*keys, "_b").orderBy("_us").rangeBetween(-span + 1, 0)
    out = both.withColumn(name or f"{fn}_{hours}h", _AGG[fn](value).over(w))
    return out.filter("_own").drop("_us", "_b", "_own")


# ------------------------------------------------------------------ W4
def ffill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("site",),
          order: str = "date", chunk: str = "month") -> DataFrame:
    """Forward fill (last non-null value so far) within each key.

    Two steps so no task holds a whole series: the last non-null value of
    every (key, chunk) is found by aggregation, a window over that small
    table carries it into later chunks, and the fill inside a chunk is a
    window over (key, chunk) only.
    """
    ch = F.date_trunc(chunk, F.col(order))
    d = df.withColumn("_chunk", ch)
    lasts = d.groupBy(*keys, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in cols])
    wc = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(*keys, "_chunk", *[F.last(f"_last_{c}", ignorenulls=True).over(wc).alias(f"_in_{c}")
                                            for c in cols])
    wi = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = join_on(d, carry, [*keys, "_chunk"], "left").withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(wi), F.col(f"_in_{c}")) for c in cols})
    return filled.drop("_chunk", *[f"_in_{c}" for c in cols])
