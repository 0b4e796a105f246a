"""Distribution-based bias correction.

Order statistics come from ``global_positions`` (range-partitioned sort), so
a key with a third of the values is still spread over many tasks; the
polynomial fit reduces every key to eleven moment sums before the solve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.operators.common import join_on
from stationcast.operators.positions import global_positions


# ------------------------------------------------------------------ W5
def quantile_map(control: DataFrame, hist: DataFrame, keys: Sequence[str], value: str = "value",
                 out: str = "corrected") -> DataFrame:
    """Empirical quantile mapping of control values onto the historical
    distribution of the same key (W5).

    idx = number of control values strictly below the value; frac =
    (idx - 1) / (n - 1), or 0 when idx = 0; result = sorted historical value
    at position int(frac * (m - 1)).  Keys without history and null values
    get null.
    """
    keys = list(keys)
    c = global_positions(control, keys, value)
    frac = F.when((F.col("n_lt") > 0) & (F.col("n") > 1),
                  (F.col("n_lt") - 1) / (F.col("n") - 1)).otherwise(F.lit(0.0))
    h = global_positions(hist.select(*keys, value), keys, value, ties=False)
    m = h.groupBy(*keys).agg(F.max("n").alias("_m"))
    c = join_on(c, m, keys, "left").withColumn("_target", F.floor(frac * (F.col("_m") - 1)))
    hv = h.select(*keys, F.col("pos").alias("_target"), F.col(value).alias(out))
    mapped = join_on(c, hv, [*keys, "_target"], "left").drop("_target", "_m", "pos", "n_lt", "n")
    return mapped.unionByName(control.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast(hist.schema[value].dataType)))


# ------------------------------------------------------------------ W6
#: Share of the row count below which a pivot counts as zero.
RANK = 1e-10


def quantile_pairs(control: DataFrame, hist: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Sorted control values paired with the linearly interpolated
    historical quantile at the same plotting position p = i / (n - 1)."""
    keys = list(keys)
    c = global_positions(control.select(*keys, value), keys, value, ties=False)
    h = global_positions(hist.select(*keys, value), keys, value, ties=False)
    m = h.groupBy(*keys).agg(F.max("n").alias("_m"))
    pos = F.when(F.col("n") > 1, F.col("pos") / (F.col("n") - 1)).otherwise(F.lit(0.0)) * (F.col("_m") - 1)
    c = join_on(c, m, keys).select(*keys, F.col(value).alias("x"), pos.alias("_h"))
    c = c.withColumns({"_lo": F.floor("_h"), "_hi": F.ceil("_h")})
    hv = h.select(*keys, "pos", F.col(value).alias("_v"))
    lo = hv.withColumnRenamed("pos", "_lo").withColumnRenamed("_v", "_vlo")
    hi = hv.withColumnRenamed("pos", "_hi").withColumnRenamed("_v", "_vhi")
    j = join_on(join_on(c, lo, [*keys, "_lo"]), hi, [*keys, "_hi"])
    y = F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return j.select(*keys, "x", y.alias("y"))


def fit_polynomial(pairs: DataFrame, keys: Sequence[str], degree: int = 3) -> DataFrame:
    """Least-squares polynomial y ~ x per key.

    x is standardised per key for conditioning; each key is reduced to the
    moment sums of x'^k (k <= 2 deg) and x'^k y (k <= deg) by one aggregation,
    and the normal equations are solved by elimination in column expressions.
    A power that the lower ones already determine (fewer distinct x than
    powers) gets the coefficient 0.  Output: keys, x mean / scale and
    coefficients c0..c_deg of the polynomial in the standardised x.
    """
    keys, size = list(keys), degree + 1
    st = pairs.groupBy(*keys).agg(F.avg("x").alias("x_mean"), F.stddev_pop("x").alias("_sd"))
    st = st.withColumn("x_scale", F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(F.lit(1.0))).drop("_sd")
    z = join_on(pairs, st, keys).withColumn("_z", (F.col("x") - F.col("x_mean")) / F.col("x_scale"))
    mom = z.groupBy(*keys, "x_mean", "x_scale").agg(
        *[F.sum(F.pow("_z", k)).alias(f"_s{k}") for k in range(2 * degree + 1)],
        *[F.sum(F.pow("_z", k) * F.col("y")).alias(f"_b{k}") for k in range(size)])
    # rows of the symmetric, positive matrix in turn; no row exchanges are needed
    m = mom.withColumns({f"_a{i}_{j}": F.col(f"_s{i + j}") for i in range(size) for j in range(size)})
    for k in range(size):
        sound = F.col(f"_a{k}_{k}") > RANK * F.col("_s0")
        factor = {i: F.when(sound, F.col(f"_a{i}_{k}") / F.col(f"_a{k}_{k}")).otherwise(0.0) for i in range(k + 1, size)}
        m = m.withColumns({f"_f{i}": f for i, f in factor.items()})
        m = m.withColumns({**{f"_a{i}_{j}": F.col(f"_a{i}_{j}") - F.col(f"_f{i}") * F.col(f"_a{k}_{j}") for i in factor for j in range(k, size)},
                           **{f"_b{i}": F.col(f"_b{i}") - F.col(f"_f{i}") * F.col(f"_b{k}") for i in factor}})
    for k in range(degree, -1, -1):
        rest = F.col(f"_b{k}")
        for j in range(k + 1, size):
            rest = rest - F.col(f"_a{k}_{j}") * F.col(f"c{j}")
        m = m.withColumn(f"c{k}", F.when(F.col(f"_a{k}_{k}") > RANK * F.col("_s0"), rest / F.col(f"_a{k}_{k}")).otherwise(0.0))
    return m.select(*keys, "x_mean", "x_scale", *[f"c{k}" for k in range(size)])


def apply_polynomial(df: DataFrame, coefs: DataFrame, keys: Sequence[str], value: str = "value",
                     degree: int = 3, out: str = "corrected") -> DataFrame:
    """Evaluate the fitted polynomial as a Horner column expression."""
    j = join_on(df, coefs, list(keys), "left")
    z = (F.col(value) - F.col("x_mean")) / F.col("x_scale")
    acc = F.col(f"c{degree}")
    for k in range(degree - 1, -1, -1):
        acc = acc * z + F.col(f"c{k}")
    return j.withColumn(out, acc).drop("x_mean", "x_scale", *[f"c{k}" for k in range(degree + 1)])


def poly_correction(control: DataFrame, hist: DataFrame, keys: Sequence[str], value: str = "value",
                    degree: int = 3, out: str = "corrected") -> DataFrame:
    """Cubic quantile correction of control values."""
    coefs = fit_polynomial(quantile_pairs(control, hist, keys, value), keys, degree)
    return apply_polynomial(control, coefs, keys, value, degree, out)


# ------------------------------------------------------------------ W7
def correction_skill(df: DataFrame, keys: Sequence[str] = (), raw: str = "value",
                     corrected: str = "corrected", observed: str = "observed") -> DataFrame:
    """MAE before and after correction."""
    d = df.filter(F.col(observed).isNotNull())
    return d.groupBy(*keys).agg(F.avg(F.abs(F.col(raw) - F.col(observed))).alias("mae_before"),
                                F.avg(F.abs(F.col(corrected) - F.col(observed))).alias("mae_after"))
