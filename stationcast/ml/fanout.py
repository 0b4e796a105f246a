"""Fan-out of fits over site x predictand x scenario x model.

All keys are fitted by one set of jobs (boosting.py): the keys' rows are packed
by one shuffle, keys that fit a block are boosted where their block lies, and
larger ones together, by grouped sums of their blocks' counts.  No list of keys
passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.ml.boosting import MAX_ROWS, fit_models
from stationcast.ml.histograms import Settings


def fit_per_key(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str,
                test: str = "is_test", alpha: float = 0.95, max_rows: int = MAX_ROWS, **gbt) -> DataFrame:
    """Fit one quantile model per key combination; one result row per key
    with the rows it was trained on, the rounds kept, and hold-out pinball loss
    and MAE (null without held-out or training rows).  Null keys are a key."""
    out = fit_models(df, keys, features, label, test, Settings(alpha=alpha, **gbt), max_rows)
    fitted = F.col("n_train") > 0
    return out.select(*[F.col(f"`{k}`") for k in keys], "n_train", "rounds", F.when(fitted, F.col("pinball")).alias("pinball"), F.when(fitted, F.col("mae")).alias("mae"))
