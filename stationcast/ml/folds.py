"""Year splits and grouped folds (M1, M2) and fold-wise cross-validation (M3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.ml.boosting import fit_models
from stationcast.ml.histograms import Settings
from stationcast.operators.common import join_on

# Fixed value: multiplier of the seeded year order (Knuth's multiplicative hash).
_HASH_MULT = 2654435761
_HASH_MOD = 2 ** 32


def split_years(df: DataFrame, test_years: Mapping | Sequence[int], keys: Sequence[str] = (),
                date: str = "date") -> DataFrame:
    """Hold-out split by listed years (M1): adds boolean ``is_test``.

    ``test_years`` is a list (all keys) or a DataFrame (keys..., year).
    """
    y = F.year(date)
    if isinstance(test_years, DataFrame):
        t = test_years.select(*keys, F.col("year").alias("_ty")).withColumn("_t", F.lit(True))
        out = df.withColumn("_ty", y).join(t, [*keys, "_ty"], "left")
        return out.withColumn("is_test", F.coalesce(F.col("_t"), F.lit(False))).drop("_ty", "_t")
    return df.withColumn("is_test", y.isin(list(test_years)))


def year_folds(df: DataFrame, k: int = 5, seed: int = 42, keys: Sequence[str] = (),
               date: str = "date", bounds: DataFrame | None = None) -> DataFrame:
    """Assign each (keys, year) to one of ``k`` folds in a seeded shuffled
    order (M2).  Years are first clipped to the site bounds when ``bounds``
    (keys, start, end) is given; a site without an entry, or with an open end, keeps its years.  Returns (keys, year, fold); folds without
    years simply do not appear.

    Only the distinct-year table is ordered (a few dozen rows per key).
    """
    years = df.select(*keys, F.year(date).alias("year")).distinct()
    if bounds is not None:
        inside = F.col("year").between(F.coalesce(F.year("start"), F.col("year")), F.coalesce(F.year("end"), F.col("year")))
        years = join_on(years, bounds.select(*keys, "start", "end"), list(keys), "left").filter(inside).drop("start", "end")
    h = F.pmod(F.col("year").cast("long") * F.lit(_HASH_MULT) + F.lit(seed), F.lit(_HASH_MOD))
    w = Window.partitionBy(*keys).orderBy(h, F.col("year")) if keys else Window.orderBy(h, F.col("year"))
    return years.withColumn("fold", ((F.row_number().over(w) - 1) % k).cast("int"))


def with_folds(df: DataFrame, folds: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Attach the fold of each row's year (small fold table, broadcast by AQE); rows
    whose year has none, outside the site's bounds or without a date, stay with a null fold."""
    return join_on(df.withColumn("year", F.year(date)), folds, [*keys, "year"], "left")


def best_split(df: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold",
               max_iter: int = 645, max_depth: int = 10, learning_rate: float = 0.067, seed: int = 0, subsample: float = 0.29,
               colsample: float = 0.56, parallel_trees: int = 10, early_stopping: int = 50, year: str = "year") -> DataFrame:
    """Cross-validate squared-error boosted trees, one fold held out at a
    time (M3).  Returns (fold, rmse, mae, rounds, n_test, train_years, test_years,
    best); the fold with the lowest RMSE is the split to keep, and its years
    are what a fit takes over.

    A fold's model ends once the error on its held-out rows has not fallen for
    ``early_stopping`` rounds.  All folds are one set of jobs: every row goes once
    to each fold's model, where it is held out or trained on.  Folds that hold
    out nothing, or leave nothing to train on, are left out, and so are rows
    without a fold."""
    years_known = year in df.columns
    data = df.where(F.col(fold_col).isNotNull())
    folds = data.select(F.col(fold_col).cast("int").alias("__model")).distinct()  # at most k
    rows = data.join(F.broadcast(folds)).withColumn("__held", F.col(fold_col).cast("int") == F.col("__model"))
    s = Settings(squared=True, max_depth=max_depth, learning_rate=learning_rate, n_estimators=max_iter, subsample=subsample, colsample=colsample,
                 early_stopping=early_stopping, seed=seed, parallel_trees=parallel_trees)
    models = fit_models(rows, ["__model"], features, label, "__held", s).where((F.col("n_train") > 0) & (F.col("n_test") > 0))
    out = models.select(F.col("__model").alias("fold"), F.col("error").alias("rmse"), "mae", "rounds", F.col("n_test"))
    if years_known:  # a few dozen years
        named = data.where(F.col(label).isNotNull()).select(F.col(fold_col).cast("int").alias("f"), F.col(year).cast("int").alias("y")).distinct()
        own = folds.join(F.broadcast(named)).groupBy(F.col("__model").alias("fold")).agg(
            F.sort_array(F.collect_set(F.when(F.col("f") != F.col("__model"), F.col("y")))).alias("train_years"),
            F.sort_array(F.collect_set(F.when(F.col("f") == F.col("__model"), F.col("y")))).alias("test_years"))
        out = out.join(own, "fold", "left")
    else:
        out = out.withColumns({c: F.array().cast("array<int>") for c in ("train_years", "test_years")})
    best = F.row_number().over(Window.orderBy("rmse", "fold")) == 1  # one row a fold
    return out.select("fold", "rmse", "mae", "rounds", "n_test", "train_years", "test_years", best.alias("best"))
