"""Model calendars: 360-day detection and repair, positional time stamps,
no-leap spine rebuild (R8-R11).

Raw model dates stay strings until repaired (Spark dates cannot hold
Feb 30); month and day are read with ``substring``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.operators.common import join_on
from stationcast.operators.positions import global_positions

# Months with 31 days.
MONTHS_31 = (1, 3, 5, 7, 8, 10, 12)


def _md(date_str: str):
    s = F.col(date_str)
    return s.substr(6, 2).cast("int"), s.substr(9, 2).cast("int")


# ------------------------------------------------------------------ R8
def is_360_day(df: DataFrame, keys: Sequence[str] = ("source",), date_str: str = "time") -> DataFrame:
    """Per source: a 30 February exists, or one of the seven 31sts never
    occurs across the data (R8)."""
    m, d = _md(date_str)
    return (df.groupBy(*keys).agg(
        F.max((m == 2) & (d == 30)).alias("_feb30"),
        F.count_distinct(F.when((d == 31) & m.isin(*MONTHS_31), m)).alias("_n31"))
        .select(*keys, (F.col("_feb30") | (F.col("_n31") < len(MONTHS_31))).alias("is_360_day")))


# ------------------------------------------------------------------ R9
def repair_360_day(df: DataFrame, date_str: str = "time", keys: Sequence[str] = (),
                   compat: bool = False) -> DataFrame:
    """Fill the days a 360-day calendar lacks by copying neighbours.

    Copies: 1 Feb -> 31 Jan; in leap years 28 Feb -> 29 Feb; the last
    February day (29 in leap years, else 28) -> 1 Mar; day 30 -> 31 in the
    seven 31-day months.  Originals are kept; invalid dates (30 Feb) drop.
    Every row emits its candidate dates in one ``explode`` (no per-year
    loop).  By default one row per (keys, date) survives: the original,
    else the first copy in the order above; ``compat`` keeps every copy as
    the reference does (Q6).  Output column ``date`` (DateType) and
    ``copied`` (false for originals).
    """
    s = F.col(date_str)
    y, m, d = s.substr(1, 4).cast("int"), s.substr(6, 2).cast("int"), s.substr(9, 2).cast("int")
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    orig = F.expr(f"try_to_date(substr(`{date_str}`, 1, 10), 'yyyy-MM-dd')")

    def cand(cond, yy, mm, dd, prio):
        return F.when(cond, F.struct(F.make_date(yy, mm, dd).alias("date"), F.lit(prio).alias("prio")))
    cands = F.array(
        F.when(orig.isNotNull(), F.struct(orig.alias("date"), F.lit(0).alias("prio"))),
        cand((m == 2) & (d == 1), y, F.lit(1), F.lit(31), 1),
        cand(leap & (m == 2) & (d == 28), y, F.lit(2), F.lit(29), 2),
        cand((m == 2) & (d == F.when(leap, 29).otherwise(28)), y, F.lit(3), F.lit(1), 3),
        cand(m.isin(*MONTHS_31) & (d == 30), y, m, F.lit(31), 4))
    rest = [c for c in df.columns if c != date_str]
    out = (df.select(*rest, F.explode(F.filter(cands, lambda x: x.isNotNull())).alias("_c"))
           .select(*rest, F.col("_c.date").alias("date"), F.col("_c.prio").alias("_prio")))
    if not compat:
        row = F.struct(*[F.col(f"`{c}`") for c in rest if c not in keys])
        out = (out.groupBy(*keys, "date").agg(F.min_by(row, F.col("_prio")).alias("_r"), F.min("_prio").alias("_prio"))
               .select(*keys, "date", "_r.*", "_prio"))
    return out.withColumn("copied", F.col("_prio") > 0).drop("_prio")


# ------------------------------------------------------------------ R10
def zip_time(df: DataFrame, ref: DataFrame, keys: Sequence[str], order: str,
             ref_time: str = "time", out: str = "time", period: int = 4) -> DataFrame:
    """Row k of ``df`` (in ``order``) takes the k-th time of ``ref``.

    When ``ref`` is shorter its last ``period`` times repeat cyclically.
    Rows without an order, and rows whose key ``ref`` lacks, stay with a null time.
    Row numbers come from range-partitioned global positions, then rows
    meet ``ref`` by an equi-join on (keys, position).
    """
    keys = list(keys)
    a = global_positions(df, keys, order, ties=False).drop("n").withColumnRenamed("pos", "_k")
    r = global_positions(ref.select(*keys, ref_time), keys, ref_time, ties=False).select(
        *keys, F.col("pos").alias("_rk"), F.col(ref_time).alias(out), F.col("n").alias("_m"))
    m = r.groupBy(*keys).agg(F.max("_m").alias("_m"))
    k, mm = F.col("_k"), F.col("_m")
    target = F.when(k < mm, k).otherwise(mm - period + F.pmod(k - mm, F.lit(period)))
    a = join_on(a, m, keys, "left").withColumn("_rk", target)
    res = a.drop(out) if out in a.columns and out != order else a
    res = join_on(res, r.drop("_m"), [*keys, "_rk"], "left").drop("_k", "_rk", "_m")
    return res.unionByName(df.filter(F.col(order).isNull()).withColumn(out, F.lit(None).cast(ref.schema[ref_time].dataType)))


# ------------------------------------------------------------------ R11
def noleap_spine(spark, start: str, end: str, per_day: int = 4) -> DataFrame:
    """Positions 0.. of a no-leap calendar with ``per_day`` rows per day.

    The spine is generated by Spark from the calendar (days x per_day rows,
    independent of the data volume)."""
    days = (spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("time"))
            .filter(~((F.month("time") == 2) & (F.dayofmonth("time") == 29))))
    # day index over the calendar table only (one row per calendar day)
    di = days.select("time", (F.row_number().over(Window.orderBy("time")) - 1).alias("_d"))
    return di.select("time", F.explode(F.sequence(F.col("_d") * per_day, F.col("_d") * per_day + per_day - 1)).alias("_pos"))


def rebuild_noleap(df: DataFrame, order: str, start: str, end: str, per_day: int = 4,
                   keys: Sequence[str] = (), drop_year: int | None = None,
                   pad_last: bool = True, strict: bool = False) -> DataFrame:
    """Re-stamp rows onto a no-leap spine of ``per_day`` rows per day.

    Row k (in ``order``) gets the k-th spine time; in ``drop_year`` only its
    first day is kept; the last day's rows are copied to the next day when
    ``pad_last``.  Rows beyond the spine and rows without an order stay with
    a null time; ``strict`` fails when there are such rows.
    """
    keys = list(keys)
    spark = df.sparkSession
    spine = noleap_spine(spark, start, end, per_day)
    a = global_positions(df, keys, order, ties=False).drop("n").withColumnRenamed("pos", "_pos")
    a = a.join(spine, "_pos", "left").drop("_pos")
    out = a.unionByName(df.filter(F.col(order).isNull()).withColumn("time", F.lit(None).cast("date")))
    if strict and (left := out.filter(F.col("time").isNull()).count()):
        raise ValueError(f"{left} rows have no place on the calendar from {start} to {end}")
    if drop_year is not None:
        out = out.filter(F.col("time").isNull() | ~((F.year("time") == drop_year) & (F.dayofyear("time") != 1)))
    if pad_last:
        last = out.filter(F.col("time") == F.lit(end).cast("date")).withColumn(
            "time", F.date_add(F.col("time"), 1))
        out = out.unionByName(last)
    return out
