"""Batch and scenario scoring (M6-M8)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.functions.scalars import clamp_min
from stationcast.ml.boosting import QuantileGBT, QuantileGBTModel
from stationcast.operators import climatology as C
from stationcast.operators import frames as FR


def score_batch(model: QuantileGBTModel, df: DataFrame, keys: Sequence[str] = ("site", "date"),
                observed: str | None = None, on_missing: str = "zero") -> DataFrame:
    """Align the frame to the model's features (P23) and score it (M6).

    Output: keys, observed (when given) and predicted.
    """
    keep = [*keys, *([observed] if observed else [])]
    aligned = FR.align_features(df, model.features, on_missing, keep=keep)
    out = model.transform(aligned, "predicted")
    cols = [*keys, *([F.col(observed).alias("observed")] if observed else []), "predicted"]
    return out.select(*cols)


def score_scenario(model: QuantileGBTModel, df: DataFrame, predictor: str, keys: Sequence[str] = ("site", "date"),
                   unit_rule: str | None = None, unit_keys: Sequence[str] = ("site",),
                   clamp_zero: bool = False, predictand: str | None = None, observed: str | None = None,
                   convert_output: Callable[[Column], Column] | None = None, on_missing: str = "error") -> DataFrame:
    """Scenario projection (M7).

    The model scores the columns as they are, with the predictor's year-month
    mean, max and min added; a feature the frame lacks is an error unless
    ``on_missing`` says otherwise.  ``predictand`` adds the predictor's monthly
    summaries under the predictand's names, in the unit that ``unit_rule``
    detects per ``unit_keys`` (P5); ``observed`` adds the observations in the
    same way.  ``convert_output`` converts the predictions.  Negative ones are
    marked in ``negative`` before they are clamped to 0 (P16, Q11).
    """
    site, date = list(keys[:-1]), keys[-1]

    def monthly(d: DataFrame) -> DataFrame:
        return C.monthly_stats(d, [predictor], site, date)
    d = df.withColumns({"year": F.year(date), "month": F.month(date)}).join(monthly(df), [*site, "year", "month"], "left")
    extra = []
    if predictand:
        converted = FR.auto_units(df, predictor, unit_rule, unit_keys) if unit_rule else df
        names = {f"{predictor}_{s}": f"{predictand}_{s}" for s in ("mean", "max", "min")}
        d = d.join(monthly(converted).withColumnsRenamed(names), [*site, "year", "month"], "left")
        extra = list(names.values())
    if observed and unit_rule:
        d = FR.auto_units(d, observed, unit_rule, unit_keys)
    keep = [*keys, *([observed] if observed else []), *extra]
    out = model.transform(FR.align_features(d, model.features, on_missing, keep=keep), "predicted")
    predicted = convert_output(F.col("predicted")) if convert_output else F.col("predicted")
    out = out.withColumn("predicted", predicted).withColumn("negative", F.col("predicted") < 0)
    if clamp_zero:
        out = out.withColumn("predicted", clamp_min("predicted", 0.0))
    return out.select(*keys, *([F.col(observed).alias("observed")] if observed else []), "predicted", "negative", *extra)


def fit_on_score_on(train: DataFrame, target: DataFrame, features: Sequence[str], label: str,
                    scenario_col: str, fit_scenario: str, score_scenario_: str, **gbt) -> DataFrame:
    """Fit on one scenario, score another (M8)."""
    model = QuantileGBT(features, label, **gbt).fit(train.filter(F.col(scenario_col) == fit_scenario))
    return score_batch(model, target.filter(F.col(scenario_col) == score_scenario_), observed=label)
