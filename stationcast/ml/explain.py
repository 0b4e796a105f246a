"""Feature importance and attribution.

Attribution is exact: the Shapley value of every feature, where a feature that
is not known lets a row go both ways at its splits, by the share of training
rows that went there.  A leaf adds to a row's prediction through the features
on its path only; each is met by the row or not, and has a share of training
rows where it is unknown.  The weights of all subsets of the other features
come from one polynomial a leaf, from which each feature is divided out again,
so nothing is sampled and no background rows are needed.  Rows are explained in
Arrow batches, every row by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions.scalars import feature_base, feature_point
from stationcast.ml.boosting import NodeArrays, QuantileGBTModel


def gain_importance(model: QuantileGBTModel) -> DataFrame:
    """Per-feature mean tree importance, ascending (M9)."""
    spark_rows = sorted(model.gain_importance().items(), key=lambda kv: kv[1])
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(spark_rows, "feature string, importance double").orderBy("importance")


class _Paths:
    """The leaves of a tree by their paths: (leaves, places) arrays of feature, the
    range of values that reaches the leaf, and the share of training rows that
    stays on the path where the feature is unknown.  Paths with fewer features
    are filled up with one that every row meets, which changes no value."""

    def __init__(self, tree: NodeArrays):
        paths: list[tuple[int, dict[int, tuple[float, float, float]]]] = []
        todo = [(0, {})]
        while todo:
            at, path = todo.pop()
            f = int(tree.feature[at])
            if f < 0:
                paths.append((at, path))
                continue
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for child, ends in ((int(tree.left[at]), (low, min(high, tree.threshold[at]))), (int(tree.left[at]) + 1, (max(low, tree.threshold[at]), high))):
                todo.append((child, {**path, f: (*ends, share * (tree.cover[child] / tree.cover[at] if tree.cover[at] else 0.5))}))
        width = max(1, max(len(p) for _, p in paths))
        shape = (len(paths), width)
        self.feature, self.low, self.high, self.share = np.zeros(shape, np.int64), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape)
        self.value = tree.value[[k for k, _ in paths]]
        for i, (_, path) in enumerate(paths):
            for j, (f, (low, high, share)) in enumerate(path.items()):
                self.feature[i, j], self.low[i, j], self.high[i, j], self.share[i, j] = f, low, high, share
        self.weight = np.array([1 / (width * comb(width - 1, k)) for k in range(width)])
        self.mean = float(self.value @ self.share.prod(axis=1))

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) of ``x``."""
        rows, (leaves, width) = len(x), self.feature.shape
        met = (x[:, self.feature] > self.low) & (x[:, self.feature] <= self.high)
        # coefficients, by number of known features, of the product of (share + met z)
        c = np.zeros((width + 1, rows, leaves))
        c[0] = 1
        for j in range(width):
            up = np.where(met[:, :, j], c[:-1], 0.0)
            c *= self.share[:, j]
            c[1:] += up
        out = np.zeros(x.shape)
        for j in range(width):
            share, known = self.share[:, j], met[:, :, j]
            q, total = np.zeros((rows, leaves)), np.zeros((rows, leaves))
            for k in range(width - 1, -1, -1):  # without feature j again: divided by (share + z), or by share alone
                q = np.where(known, c[k + 1] - share * q, c[k] / np.where(share > 0, share, 1.0))
                total += self.weight[k] * q
            part = total * (known - share) * self.value
            np.add.at(out.T, self.feature[:, j], part.T)
        return out


def expectation(model: QuantileGBTModel) -> float:
    """What the model predicts where no feature is known: a row's attributions add up to its prediction less this."""
    return model.base + model.learning_rate * sum(_Paths(t).mean for t in model.trees)


def shapley_values(model: QuantileGBTModel, x: np.ndarray, paths: Sequence[_Paths] | None = None, piece: int = 128) -> np.ndarray:
    """Exact attributions of the rows of ``x``, ``piece`` rows at a time."""
    out = np.zeros(x.shape)
    for p in paths if paths is not None else map(_Paths, model.trees):
        for i in range(0, len(x), piece):
            out[i:i + piece] += model.learning_rate * p.shapley(x[i:i + piece])
    return out


def attribution(model: QuantileGBTModel, df: DataFrame, row_id: str) -> DataFrame:
    """Exact Shapley attribution per (row, feature).

    Returns long form (row_id, feature, value, attribution); a row's attributions
    sum to its prediction less ``expectation``.  Rows with a null feature have no
    prediction and are left out; repeated and null ids give rows like others; a
    model without trees attributes 0."""
    feats, shared = model.features, df.sparkSession.sparkContext.broadcast(model)  # trees x nodes
    kind = dict(df.dtypes)[row_id]
    rows = df.select(F.col(f"`{row_id}`"), *[F.col(f"`{f}`").cast("double").alias(f"__f{j}") for j, f in enumerate(feats)])
    rows = rows.na.drop("any", subset=[f"__f{j}" for j in range(len(feats))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = None
        for b in batches:
            paths = paths or [_Paths(t) for t in shared.value.trees]
            x = np.column_stack([b.column(j + 1).to_numpy() for j in range(len(feats))])
            values = shapley_values(shared.value, x, paths)
            again = pa.array(np.repeat(np.arange(len(x)), len(feats)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(again), pa.array(feats * len(x), pa.string()), pa.array(x.reshape(-1)), pa.array(values.reshape(-1))],
                                             [row_id, "feature", "value", "attribution"])
    return rows.mapInArrow(run, f"`{row_id}` {kind}, feature string, value double, attribution double")


def mean_abs_attribution(attr: DataFrame, feature: str = "feature") -> DataFrame:
    """Mean absolute attribution per feature (M10 summary)."""
    return attr.groupBy(feature).agg(F.avg(F.abs("attribution")).alias("mean_abs"))


def rollup_by_point(attr: DataFrame, row_id: str = "row_id", feature: str = "feature") -> tuple[DataFrame, DataFrame]:
    """Attribution by grid point.

    Returns (per point: sum over its features of mean |attribution|, mean
    feature value; 'Other' excluded) and (per row and point: signed sum).
    """
    a = attr.withColumn("point", feature_point(feature))
    per_feat = a.groupBy("point", feature).agg(F.avg(F.abs("attribution")).alias("_ma"), F.avg("value").alias("_mv"))
    per_point = (per_feat.filter(F.col("point") != "Other").groupBy("point")
                 .agg(F.sum("_ma").alias("mean_abs"), F.avg("_mv").alias("mean_value")))
    per_row = (a.filter(F.col("point") != "Other").groupBy(row_id, "point")
               .agg(F.sum("attribution").alias("attribution")))
    return per_point, per_row


def rollup_by_variable(attr: DataFrame, k: int = 20, feature: str = "feature") -> DataFrame:
    """Attribution by base variable, top ``k`` by summed mean |attribution|."""
    a = attr.withColumn("variable", feature_base(feature))
    per_feat = a.groupBy("variable", feature).agg(F.avg(F.abs("attribution")).alias("_ma"))
    return (per_feat.groupBy("variable").agg(F.sum("_ma").alias("mean_abs"))
            .orderBy(F.col("mean_abs").desc(), "variable").limit(k))
