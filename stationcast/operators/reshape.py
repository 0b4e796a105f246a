"""Reshape operators: point ids, pivots, melts, spines, first-per-key.

Pivots always take an explicit value list (no distinct-value scan) and are
written as one conditional aggregation, so one pass builds every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.operators.common import join_on


def _q(c: str):
    return F.col(f"`{c}`")


# ------------------------------------------------------------------ R1
def point_ids(df: DataFrame, keys: Sequence[str] = ("site",), lat: str = "lat",
              lon: str = "lon", name: str = "point") -> DataFrame:
    """Distinct coordinates per key numbered 1.. in (lat, lon) order.

    Only the distinct-coordinate table is windowed (a few rows per key), so
    no window ever runs over the fact rows.
    """
    w = Window.partitionBy(*keys).orderBy(lat, lon)
    return df.select(*keys, lat, lon).distinct().withColumn(name, F.dense_rank().over(w))


def point_id(df: DataFrame, keys: Sequence[str] = ("site",), lat: str = "lat",
             lon: str = "lon", name: str = "point") -> DataFrame:
    """Attach the 1-based ordinal of (lat, lon) within its key."""
    return df.join(point_ids(df, keys, lat, lon, name), [*keys, lat, lon])


# ------------------------------------------------------------------ R2
def pivot_points(df: DataFrame, values: Sequence[str], keys: Sequence[str] = ("site", "date"),
                 point: str = "point", n: int = 4, agg=F.max, strict: bool = False) -> DataFrame:
    """Long -> wide by grid point: ``<var>-<i>`` for i in 1..n (R2).

    Input must have one row per (keys, point); ``agg`` only collapses that
    single row (use ``dedup_first`` first when unsure, D10).  ``strict``
    fails on a duplicate (keys, point), as a pandas pivot does; the check is
    one aggregation that stops at the first duplicate.
    """
    if strict:
        dup = (df.groupBy(*keys, point).agg(F.count(F.lit(1)).alias("_c"))
               .filter(F.col("_c") > 1).limit(1).collect())
        if dup:
            raise ValueError(f"duplicate (keys, point) in pivot input: {dup[0].asDict()}")
    cols = [agg(F.when(F.col(point) == i, F.col(v))).alias(f"{v}-{i}")
            for v in values for i in range(1, n + 1)]
    return df.groupBy(*keys).agg(*cols)


# ------------------------------------------------------------------ R3
def blocks_by_point(df: DataFrame, points: DataFrame, values: Sequence[str],
                    keys: Sequence[str] = ("site",), by: Sequence[str] = ("date",),
                    lat: str = "lat", lon: str = "lon", n: int = 4) -> DataFrame:
    """Select the known grid cells of each key and lay them side by side as
    ``lat-i, lon-i, <value>-i`` blocks (R3).  ``points`` holds
    (keys, lat, lon, point); it is a handful of rows per site."""
    j = df.join(points.select(*keys, lat, lon, "point"), [*keys, lat, lon])
    return pivot_points(j, [lat, lon, *values], [*keys, *by], "point", n)


# ------------------------------------------------------------------ R4
def attach_coords(df: DataFrame, coords: DataFrame, keys: Sequence[str] = ("site",),
                  lat: str = "lat", lon: str = "lon", n: int = 4) -> DataFrame:
    """Attach constant ``lat-i`` / ``lon-i`` columns per key.

    ``coords`` (keys, point, lat, lon) pivots to one row per key.
    """
    wide = pivot_points(coords, [lat, lon], list(keys), "point", n)
    return df.join(wide, list(keys), "left")


# ------------------------------------------------------------------ R5
def melt(df: DataFrame, prefix: str, ids: Sequence[str], var_name: str = "variable",
         value_name: str = "value", strip: bool = True) -> DataFrame:
    """Wide -> long for every column starting with ``prefix``.

    Null cells are kept as null values, as a column loop would.
    """
    cols = [c for c in df.columns if c.startswith(prefix)]
    if not cols:
        raise ValueError(f"no column starts with {prefix!r}")
    ren = {c: c[len(prefix):] if strip else c for c in cols}
    src = df.select(*[_q(i) for i in ids], *[_q(c).alias(ren[c]) for c in cols])
    return src.unpivot(list(ids), list(ren.values()), var_name, value_name)


# ------------------------------------------------------------------ R7
def reindex_daily(df: DataFrame, keys: Sequence[str] = ("site",), date: str = "date",
                  start: str | None = None) -> DataFrame:
    """Complete daily calendar per key.

    Spine from max(first date, ``start``) to the last date; days without data
    get nulls.  The spine is generated per key with ``sequence`` (one row
    per key and day) and left-joined on (keys, date).
    """
    bounds = df.groupBy(*keys).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    lo = F.col("_lo") if start is None else F.greatest(F.col("_lo"), F.lit(start).cast("date"))
    # keys whose data ends before ``start`` get no spine (and no rows)
    bounds = bounds.withColumn("_lo", lo).filter(F.col("_lo") <= F.col("_hi"))
    spine = bounds.select(*keys, F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 DAY"))).alias(date))
    data = df if start is None else df.filter(F.col(date) >= F.lit(start).cast("date"))
    return join_on(spine, data, [*keys, date], "left")


# ------------------------------------------------------------------ R12
def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order``.

    Written as ``min_by`` over a struct so it is a hash aggregation with a
    map-side partial step: a key repeated across a third of the data never
    lands whole in one sort.  Remaining columns break ties, so the result is
    deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    tiebreak = [c for c in rest if c not in order]
    okey = F.struct(*[_q(c) for c in [*order, *tiebreak]])
    row = F.struct(*[_q(c) for c in rest])
    return (df.groupBy(*[_q(k) for k in keys]).agg(F.min_by(row, okey).alias("_r"))
            .select(*[_q(k) for k in keys], *[F.col(f"_r.`{c}`").alias(c) for c in rest]))


# ------------------------------------------------------------------ R13
def limit_points(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int = 4) -> DataFrame:
    """At most ``n`` rows per group in ``order``.

    ``row_number() <= n`` is planned as a window group limit, which keeps
    only the top n per group before the shuffle.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
