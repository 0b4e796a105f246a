"""Parameter search minimising hold-out MAE (M5), by successive halving.

The rows are quantised and packed once, for all trials.  A rung boosts all its
trials on by the same number of rounds in one job, a trial a task; then the
better share of them stays and the others end.  A trial that stays goes on from
its own trees, so it becomes the model that it would have become alone.  The
sampler is a seeded random search over the reference's ranges.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationcast.ml.boosting import QuantileGBT, advance_models, new_models, pack
from stationcast.ml.histograms import Settings

# Search ranges (low, high) per parameter.
SPACE = {
    "max_depth": (3, 18),
    "subsample": (0.01, 1.0),
    "learning_rate": (0.01, 0.7),
    "colsample": (0.01, 1.0),
    "n_estimators": (50, 1000),
}


def sample_params(n: int, space: Mapping[str, tuple] = SPACE, seed: int = 0) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        p = {}
        for k, (lo, hi) in space.items():
            p[k] = rng.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else rng.uniform(lo, hi)
        out.append(p)
    return out


def param_search(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, alpha: float,
                 n_trials: int = 30, space: Mapping[str, tuple] = SPACE, seed: int = 0, early_stopping: int = 50,
                 first_rung: int = 30, keep: int = 3) -> DataFrame:
    """Random search; returns one row per trial with its parameters, the
    hold-out MAE (``best_mae``), the number of rounds kept and the rounds it was
    boosted to (``boosted``), best first.

    The first rung ends after ``first_rung`` rounds, every further one after
    ``keep`` times as many, and one in ``keep`` trials (one at least) goes on to
    the next.  ``keep`` 1 ends no trial early."""
    spark = train.sparkSession
    trials = dict(enumerate(sample_params(n_trials, space, seed)))
    settings = {i: Settings(alpha=alpha, max_depth=int(p["max_depth"]), learning_rate=float(p["learning_rate"]), n_estimators=int(p["n_estimators"]),
                            subsample=float(p["subsample"]), colsample=float(p["colsample"]), early_stopping=early_stopping, seed=seed + i) for i, p in trials.items()}
    cols = [F.col(f"`{c}`") for c in (*features, label)]
    rows = train.select(*cols, F.lit(False).alias("__held")).unionByName(valid.select(*cols, F.lit(True).alias("__held")))
    blocks = pack(rows, [], features, label, "__held")
    running, ended, upto, left = new_models(blocks, list(trials)), None, first_rung, n_trials
    most = max((s.n_estimators for s in settings.values()), default=0)
    while left:
        last = keep < 2 or upto >= most or left <= 1
        now = advance_models(blocks, running, settings, None if last else upto)
        place = F.row_number().over(Window.partitionBy(*blocks.keys).orderBy(F.col("error").asc_nulls_last(), "trial"))  # as many rows as trials
        ranked = now.withColumn("place", place)
        left = 0 if last else max(1, left // keep)
        stays = F.col("place") <= left
        out = ranked.where(~stays).drop("place").withColumn("boosted", F.lit(most if last else upto))
        ended = out if ended is None else ended.unionByName(out)
        running, upto = ranked.where(stays).select(*blocks.keys, "trial", "body"), upto * keep
    schema = "trial int, max_depth int, subsample double, learning_rate double, colsample_bytree double, n_estimators int, quantile_alpha double"
    told = spark.createDataFrame([(i, s.max_depth, s.subsample, s.learning_rate, s.colsample, s.n_estimators, s.alpha) for i, s in settings.items()], schema)
    if ended is None:
        return told.withColumns({"best_mae": F.lit(None).cast("double"), "rounds": F.lit(0), "boosted": F.lit(0)})
    return (told.join(ended, "trial").select("trial", "max_depth", "subsample", "learning_rate", "colsample_bytree", "n_estimators", F.col("error").alias("best_mae"), "rounds",
                                            F.least("boosted", "n_estimators").alias("boosted"), "quantile_alpha").orderBy(F.col("best_mae").asc_nulls_last(), "trial"))


def best_model(trials: DataFrame, train: DataFrame, features: Sequence[str], label: str,
               valid: DataFrame | None = None, early_stopping: int = 50, seed: int = 0):
    """Fit the quantile model with the parameters of the best trial (M5 -> M4)."""
    b = trials.orderBy(F.col("best_mae").asc_nulls_last(), "trial").first()
    return QuantileGBT(features, label, alpha=b["quantile_alpha"], max_depth=b["max_depth"], learning_rate=b["learning_rate"],
                       n_estimators=b["n_estimators"], subsample=b["subsample"], colsample=b["colsample_bytree"],
                       early_stopping=early_stopping, seed=seed + b["trial"]).fit(train, valid)
