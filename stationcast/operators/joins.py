"""Joins and set operations.

All joins are equi-joins on keys.  The two geometric ones (model pairs,
nearest point) run on bounded dimension tables or as bucketed equi-joins
with an exact widening search, never as a cross product of fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions.scalars import EARTH_RADIUS_KM, haversine_km
from stationcast.operators.common import bounded, cut_lineage, join_on


# ------------------------------------------------------------------ J1
def assemble(obs: DataFrame, preds: DataFrame, variables: Sequence[str], n_points: int = 4,
             keys: Sequence[str] = ("site",), date: str = "date", variable: str = "variable",
             point: str = "point", value: str = "value") -> DataFrame:
    """Training table = observations + every predictor at every point.

    Predictors arrive long (keys, date, variable, point, value) - the union
    of all extracts - and are pivoted once into ``<variable>-<point>``
    columns, then left-joined to the observations on (keys, date): one
    shuffle instead of one join per predictor file, and rows meet by key,
    never by position (Q4).
    """
    cols = [F.max(F.when((F.col(variable) == v) & (F.col(point) == i), F.col(value))).alias(f"{v}-{i}")
            for v in variables for i in range(1, n_points + 1)]
    wide = preds.groupBy(*keys, date).agg(*cols)
    return obs.join(wide, [*keys, date], "left")


# ------------------------------------------------------------------ J2
def join_obs(df: DataFrame, obs: DataFrame, on: Sequence[str] = ("site", "date"),
             cols: Sequence[str] | None = None) -> DataFrame:
    """Left join of observations on time keys, optionally only some columns."""
    right = obs.select(*on, *cols) if cols else obs
    return df.join(right, list(on), "left")


# ------------------------------------------------------------------ J3
def outer_merge(dfs: Sequence[DataFrame], on: Sequence[str] = ("date",)) -> DataFrame:
    """N-way full outer merge on ``on`` with the key coalesced.

    Written as one union + group-by (each input has one row per key and its
    own value columns), so N inputs cost one shuffle, not N - 1 joins.
    """
    on = list(on)
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    vals = [c for c in u.columns if c not in on]
    return u.groupBy(*on).agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in vals])


# ------------------------------------------------------------------ J4
def with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregate joined back to its detail rows (J4); ``stats`` is one row
    per key, so AQE broadcasts it from its measured size."""
    return df.join(stats, list(keys), "left")


# ------------------------------------------------------------------ J5/J6, U3/U4
def common_dates(a: DataFrame, b: DataFrame, c: DataFrame, on: Sequence[str] = ("date",)) -> DataFrame:
    """Rows of ``a`` whose key also occurs in ``b`` and ``c``."""
    return a.join(b.select(*on), list(on), "left_semi").join(c.select(*on), list(on), "left_semi")


def missing_dates(a: DataFrame, b: DataFrame, on: Sequence[str] = ("date",)) -> DataFrame:
    """Rows of ``a`` whose key is absent from ``b``."""
    return a.join(b.select(*on), list(on), "left_anti")


def date_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set difference of two key sets."""
    return a.subtract(b)


def date_intersection(*dfs: DataFrame) -> DataFrame:
    """Intersection of several key sets (U4)."""
    return reduce(lambda x, y: x.intersect(y), dfs)


# ------------------------------------------------------------------ J7/J8
def keep_points(df: DataFrame, coords: DataFrame, on: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Inner join to a retained coordinate set (J7); the set is checked small."""
    return df.join(bounded(coords.select(*on).distinct()), list(on))


def merge_on_grid(a: DataFrame, b: DataFrame, col: str, date: str = "date",
                  lat: str = "lat", lon: str = "lon", digits: int = 6) -> DataFrame:
    """Left join on date + coordinates rounded to ``digits``, replacing
    ``col`` of ``a`` by the one of ``b`` (J8)."""
    def keyed(df):
        return df.withColumns({"_rlat": F.round(F.col(lat), digits), "_rlon": F.round(F.col(lon), digits)})
    left = keyed(a.drop(col))
    right = keyed(b).select(date, "_rlat", "_rlon", col)
    return left.join(right, [date, "_rlat", "_rlon"], "left").drop("_rlat", "_rlon")


# ------------------------------------------------------------------ J9
def model_pairs(models: DataFrame, model: str = "model") -> DataFrame:
    """Every unordered pair of distinct models.

    Runs on the distinct model list (a dimension, size-checked before it is
    broadcast), with the pair condition ``m1 < m2`` as the join predicate.
    """
    m = models.select(F.col(model).alias("model_1")).distinct()
    m2 = bounded(m.select(F.col("model_1").alias("model_2")))
    return m.join(m2, F.col("model_1") < F.col("model_2"))


# ------------------------------------------------------------------ J10
def _unit_vec(lat: str, lon: str):
    la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def nearest_point(a: DataFrame, b: DataFrame, a_id: str = "id", b_id: str = "id",
                  keys: Sequence[str] = (), lat: str = "lat", lon: str = "lon",
                  cell_km: float = 50.0, names: tuple[str, str] = ("a_id", "b_id")) -> DataFrame:
    """For every point of ``a`` the closest point of ``b`` within the same
    ``keys`` (J10), with the haversine distance; null where ``b`` has no point
    of the key.

    Only distinct coordinates are searched, of ``b`` with their smallest id.
    They become unit vectors in cubes of side ``c`` (chord units).  A round
    joins each open coordinate to the ``b`` coordinates in the 27 cubes around
    it; any other is more than c away, so a best chord <= c is exact.  Open
    ones go to the next round with cubes of twice the side, until a cube spans
    the sphere: rounds grow with the logarithm of the distance, and none is
    left out.  Ties go to the smallest id.
    """
    keys = list(keys)

    def coordinates(df: DataFrame, x: str, *aggs) -> DataFrame:
        v = _unit_vec(f"{x}_lat", f"{x}_lon")
        d = df.select(*keys, F.col(lat).alias(f"{x}_lat"), F.col(lon).alias(f"{x}_lon"), *aggs)
        d = d.groupBy(*keys, f"{x}_lat", f"{x}_lon").agg(F.min("b_id").alias("b_id")) if aggs else d.distinct()
        return d.withColumns({f"{x}x": v[0], f"{x}y": v[1], f"{x}z": v[2]})
    targets = cut_lineage(coordinates(b, "b", F.col(b_id).alias("b_id")))
    pending = cut_lineage(coordinates(a, "a"))
    place, found, c = [*keys, "a_lat", "a_lon"], [], cell_km / EARTH_RADIUS_KM
    axes = (("_i", "x"), ("_j", "y"), ("_k", "z"))
    while True:
        cand, cells = pending, targets.withColumns({i: F.floor(F.col(f"b{x}") / c) for i, x in axes})
        for i, x in axes:
            cand = cand.withColumn(i, F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), partial(_beside, x, c))))
        chord = F.sqrt(sum((F.col(f"a{x}") - F.col(f"b{x}")) ** 2 for _, x in axes))
        best = (cand.join(cells, [*keys, "_i", "_j", "_k"]).withColumn("_chord", chord).groupBy(*place)
                .agg(F.min_by(F.struct("b_id", "b_lat", "b_lon"), F.struct("_chord", "b_id")).alias("_b"), F.min("_chord").alias("_chord")))
        if c < 2.0:  # else every point lies in the 27 cubes
            best = best.filter(F.col("_chord") <= c)
        found.append(cut_lineage(best))
        pending = cut_lineage(pending.join(found[-1].select(*place), place, "left_anti"))
        if c >= 2.0 or pending.isEmpty():
            break
        c *= 2
    nearest = reduce(lambda x, y: x.unionByName(y), found).select(*place, "_b")
    points = a.select(*keys, F.col(a_id).alias("a_id"), F.col(lat).alias("a_lat"), F.col(lon).alias("a_lon"))
    return points.join(nearest, place, "left").select(
        *keys, F.col("a_id").alias(names[0]), F.col("_b.b_id").alias(names[1]),
        haversine_km("a_lat", "a_lon", "_b.b_lat", "_b.b_lon").alias("distance_km"))


def _beside(axis: str, c: float, step):
    return F.floor(F.col(f"a{axis}") / c) + step


# ------------------------------------------------------------------ J11-J13
def align_series(a: DataFrame, b: DataFrame, on: Sequence[str] = ("date",),
                 a_col: str = "a", b_col: str = "b") -> DataFrame:
    """Outer alignment then complete cases == inner join without nulls."""
    return (join_on(a.select(*on, a_col), b.select(*on, b_col), list(on))
            .filter(F.col(a_col).isNotNull() & F.col(b_col).isNotNull()))


def compare_metrics(a: DataFrame, b: DataFrame, on: Sequence[str], suffixes=("_a", "_b")) -> DataFrame:
    """Inner join of two metric tables with suffixed value columns."""
    ra = a.select(*on, *[F.col(c).alias(c + suffixes[0]) for c in a.columns if c not in on])
    rb = b.select(*on, *[F.col(c).alias(c + suffixes[1]) for c in b.columns if c not in on])
    return ra.join(rb, list(on))


def attach_observed(pred: DataFrame, obs: DataFrame, on: Sequence[str] = ("site", "date"),
                    obs_col: str = "observed") -> DataFrame:
    """Observed value placed on predictions by key, not by row index."""
    return pred.join(obs.select(*on, obs_col), list(on), "left")


# ------------------------------------------------------------------ U1/U2
def union_all(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Union by column name (U1); with ``allow_missing`` absent columns are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=allow_missing), dfs)


# ------------------------------------------------------------------ O1-O3
def sort_by(df: DataFrame, cols: Sequence[str], ascending=True) -> DataFrame:
    """Multi-key sort (O1, O2): a range-partitioned global sort."""
    return df.orderBy(*cols, ascending=ascending)


def top_k(df: DataFrame, col: str, k: int = 20) -> DataFrame:
    """Top-k rows by ``col`` descending (O3): planned as TakeOrderedAndProject
    (per-partition top-k, then a k-row merge).  Ties are ordered by the other
    columns, so the k-th row is always the same."""
    rest = [F.col(f"`{c}`") for c, t in df.dtypes if c != col and not t.startswith(("map", "variant"))]
    return df.orderBy(F.col(f"`{col}`").desc_nulls_last(), *rest).limit(k)
