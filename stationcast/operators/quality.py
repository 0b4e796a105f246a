"""Coverage, missing data, percentiles, scores and grid comparison
(A10-A12, A16-A18, A20, A22-A25).

Every statistic is an aggregation with a map-side partial step; exact
percentiles use range-partitioned global positions rather than collecting a
group's values into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.operators import joins as J
from stationcast.operators.common import join_on
from stationcast.operators.positions import quantile_cont


# ------------------------------------------------------------------ A10
def coverage(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Rows, first/last date, distinct dates and rows per date (A10)."""
    per_date = df.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("_n"))
    return per_date.groupBy(*keys).agg(
        F.sum("_n").alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.count(F.lit(1)).alias("n_dates"), F.min("_n").alias("min_per_date"), F.max("_n").alias("max_per_date"))


def irregular_dates(df: DataFrame, expected: int = 4, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Dates whose row count differs from ``expected`` (A10, ``HAVING``)."""
    return (df.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") != expected))


# ------------------------------------------------------------------ A11
def mode_values(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value per key, ties to the smallest value.

    Counted per (key, value) first, so a key's values are never gathered.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct(-F.col("_c"), F.col(col))).alias(f"{col}_mode"))


def mode_fill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Fill nulls with the column's most frequent value."""
    keys = list(keys)
    out = df if keys else df.withColumn("_all", F.lit(0))
    on = keys or ["_all"]
    for c in cols:
        m = mode_values(df, c, keys)
        m = m if keys else m.withColumn("_all", F.lit(0))
        out = join_on(out, m, on, "left")
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"{c}_mode"))).drop(f"{c}_mode")
    return out if keys else out.drop("_all")


# ------------------------------------------------------------------ A12
def percentile_table(obs: DataFrame, pred: DataFrame, keys: Sequence[str], q: float = 0.95,
                     obs_col: str = "observed", pred_col: str = "predicted",
                     combinations: DataFrame | None = None) -> DataFrame:
    """Exact q-percentile of observed and predicted per key with a reason
    code when a side has no data (A12).

    One row for every key of ``combinations``; without it, for every key that
    either side has a row of, with a value or not."""
    keys = list(keys)
    base = (combinations if combinations is not None else obs.select(*keys).unionByName(pred.select(*keys))).select(*keys).distinct()
    o = quantile_cont(obs, keys, obs_col, q, "obs_percentile")
    p = quantile_cont(pred, keys, pred_col, q, "pred_percentile")
    j = join_on(join_on(base, o, keys, "left"), p, keys, "left")
    reason = (F.when(F.col("obs_percentile").isNull(), F.lit("no_observed"))
              .when(F.col("pred_percentile").isNull(), F.lit("no_predicted")))
    return j.withColumn("error", reason)


def percentile_summary(table: DataFrame) -> DataFrame:
    """Counts of successful and failed combinations."""
    return table.agg(F.count_if(F.col("error").isNull()).alias("successful"),
                     F.count_if(F.col("error").isNotNull()).alias("failed"))


# ------------------------------------------------------------------ A16
def mae_by_month(a: DataFrame, b: DataFrame, on: Sequence[str] = ("date",), a_col: str = "a",
                 b_col: str = "b", date: str = "date") -> DataFrame:
    """Overall and per-calendar-month MAE of two aligned series.

    One pass with ``rollup``: the row with a null month is the overall MAE.
    """
    al = J.align_series(a, b, on, a_col, b_col)
    return (al.rollup(F.month(date).alias("month"))
            .agg(F.avg(F.abs(F.col(a_col) - F.col(b_col))).alias("mae"), F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ A17
def missing_pct(df: DataFrame) -> DataFrame:
    """Percent of missing values per column, long form."""
    n = F.count(F.lit(1))
    row = df.agg(*[(F.lit(100.0) * (n - F.count(F.col(f"`{c}`"))) / F.nullif(n, F.lit(0))).alias(c)
                   for c in df.columns])
    return row.unpivot([], list(df.columns), "column", "missing_pct")


def incomplete_rows_pct(df: DataFrame) -> DataFrame:
    """Percent of rows with any null after dropping all-null columns.

    One pass: a column is all-null when its count is 0; the row test is
    re-evaluated per row only over columns that have data, via a second
    aggregate on the (small) per-column counts."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    keep = [c for c in df.columns if counts[c] > 0]
    complete = F.lit(True)
    for c in keep:
        complete = complete & F.col(f"`{c}`").isNotNull()
    return df.agg((F.lit(100.0) * F.count_if(~complete) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("incomplete_pct"),
                  F.lit(len(df.columns) - len(keep)).alias("all_null_columns"))


# ------------------------------------------------------------------ A18
def score(df: DataFrame, keys: Sequence[str] = (), obs: str = "observed", pred: str = "predicted") -> DataFrame:
    """Regression scores per key on complete rows.

    error = predicted - observed; mean error, MAE, RMSE,
    R2 = 1 - SSE / (n var_pop(y)), explained variance = 1 - var_pop(e) / var_pop(y);
    null where the observations have no variance.
    """
    d = df.filter(F.col(obs).isNotNull() & F.col(pred).isNotNull()).withColumn("_e", F.col(pred) - F.col(obs))
    vy = F.var_pop(obs)
    return d.groupBy(*keys).agg(
        F.avg("_e").alias("mean_error"), F.avg(F.abs("_e")).alias("mae"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        (F.lit(1.0) - F.sum(F.col("_e") * F.col("_e")) / F.nullif(F.count(F.lit(1)) * vy, F.lit(0.0))).alias("r2"),
        (F.lit(1.0) - F.var_pop("_e") / F.nullif(vy, F.lit(0.0))).alias("explained_variance"),
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ A20
def grid_diff(points: DataFrame, model: str = "model", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Per unordered model pair: identical grids flag and min / max / mean /
    population std of each model-1 point's distance to the nearest
    model-2 point (A20)."""
    pts = points.select(F.col(model).alias("_m"), lat, lon).distinct().withColumn(
        "_pid", F.concat_ws(":", F.col(lat).cast("string"), F.col(lon).cast("string")))
    pairs = J.model_pairs(points, model)
    a = pairs.join(pts.withColumnRenamed("_m", "model_1"), "model_1")
    b = pairs.join(pts.withColumnRenamed("_m", "model_2"), "model_2")
    near = J.nearest_point(a, b, "_pid", "_pid", keys=["model_1", "model_2"], lat=lat, lon=lon)
    stats = near.groupBy("model_1", "model_2").agg(
        F.min("distance_km").alias("min_dist"), F.max("distance_km").alias("max_dist"),
        F.avg("distance_km").alias("avg_dist"), F.stddev_pop("distance_km").alias("std_dist"))
    n = pts.groupBy("_m").agg(F.count(F.lit(1)).alias("_n"))
    common = (a.join(b.select("model_1", "model_2", lat, lon), ["model_1", "model_2", lat, lon])
              .groupBy("model_1", "model_2").agg(F.count(F.lit(1)).alias("_common")))
    ident = (pairs.join(n.withColumnRenamed("_m", "model_1").withColumnRenamed("_n", "_n1"), "model_1")
             .join(n.withColumnRenamed("_m", "model_2").withColumnRenamed("_n", "_n2"), "model_2")
             .join(common, ["model_1", "model_2"], "left")
             .select("model_1", "model_2",
                     ((F.col("_n1") == F.col("_n2")) & (F.coalesce("_common", F.lit(0)) == F.col("_n1"))).alias("identical")))
    return ident.join(stats, ["model_1", "model_2"], "left")


# ------------------------------------------------------------------ A22-A25
def mean_sorted(df: DataFrame, key: str, value: str, ascending: bool = True) -> DataFrame:
    """Group mean then sort."""
    return df.groupBy(key).agg(F.avg(value).alias(f"mean_{value}")).orderBy(f"mean_{value}", ascending=ascending)


def time_range(df: DataFrame, keys: Sequence[str], time: str = "date") -> DataFrame:
    """First and last time per dataset and a label."""
    return (df.groupBy(*keys).agg(F.min(time).alias("start"), F.max(time).alias("end"))
            .withColumn("label", F.concat_ws(" to ", F.date_format("start", "yyyy-MM-dd"),
                                              F.date_format("end", "yyyy-MM-dd"))))


def producer_matrix(df: DataFrame, producers: Sequence[str], keys: Sequence[str] = ("date",),
                    producer: str = "producer", value: str = "value") -> DataFrame:
    """One column per producer side by side (A24); explicit producer list."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(producer) == p, F.col(value))).alias(p) for p in producers])


def extent(points: DataFrame, sites: DataFrame, keys: Sequence[str] = ("site",), lat: str = "lat",
           lon: str = "lon", site_lat: str = "latitude", site_lon: str = "longitude",
           pad: float = 0.1) -> DataFrame:
    """Bounding box of a site's grid points and the station, padded."""
    box = points.groupBy(*keys).agg(F.min(lat).alias("_lat0"), F.max(lat).alias("_lat1"),
                                    F.min(lon).alias("_lon0"), F.max(lon).alias("_lon1"))
    j = box.join(sites.select(*keys, site_lat, site_lon), list(keys))
    return j.select(*keys,
                    (F.least("_lat0", site_lat) - pad).alias("lat_min"), (F.greatest("_lat1", site_lat) + pad).alias("lat_max"),
                    (F.least("_lon0", site_lon) - pad).alias("lon_min"), (F.greatest("_lon1", site_lon) + pad).alias("lon_max"))
