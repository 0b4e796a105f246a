"""Null keys are a key like others: no row with one is lost, and it meets its own kind only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationcast.ml import folds as FO
from stationcast.operators import calendar as CAL
from stationcast.operators import correction as K
from stationcast.operators import ensemble as E
from stationcast.operators import quality as Q
from stationcast.operators import windows as W
from stationcast.operators.common import join_on

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    rows = [(s, DAY + dt.timedelta(days=k), float(10 * i + k)) for i, s in enumerate(["a", None, "b"]) for k in range(8)]
    return spark.createDataFrame(rows, "site string, date date, value double").repartition(3)


def by_site(df, *cols):
    out = {}
    for r in df.collect():
        out.setdefault(r["site"], []).append(tuple(r[c] for c in cols))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_join_on_meets_null_with_null(spark):
    a = spark.createDataFrame([(None, 1, "x"), ("s", 1, "y"), ("s", None, "z")], "k string, n int, v string")
    b = spark.createDataFrame([(None, 1, 10), ("s", None, 20)], "k string, n int, w int")
    got = {(r.k, r.n, r.v, r.w) for r in join_on(a, b, ["k", "n"], "left").collect()}
    assert got == {(None, 1, "x", 10), ("s", 1, "y", None), ("s", None, "z", 20)}
    assert join_on(a, b, ["k", "n"], "left_anti").columns == ["k", "n", "v"] and join_on(a, b, ["k", "n"], "left_anti").count() == 1


def test_shifts(series):
    rows = by_site(W.shift_rows(series, ["value"]), "value", "value_lag")
    assert set(rows) == {"a", None, "b"} and all(len(v) == 8 for v in rows.values())
    assert (13.0, 12.0) in rows[None] and (10.0, None) in rows[None]
    assert (13.0, 12.0) in by_site(W.shift_days(series, ["value"]), "value", "value_lag")[None]


def test_fill_and_trailing(series, spark):
    gaps = series.withColumn("value", F.when(F.dayofmonth("date") % 3 != 0, F.col("value")))
    assert all(v[0] is not None for v in by_site(W.ffill(gaps, ["value"], chunk="week"), "value")[None])
    hourly = series.select("site", F.col("date").cast("timestamp_ntz").alias("time"), "value")
    assert len(by_site(W.trailing_agg_sampled(hourly, "value", "max"), "max_24h")[None]) == 8


def test_corrections(series):
    hist = series.withColumn("value", F.col("value") * 2 + 1)
    assert sorted(v for v, _ in by_site(K.quantile_map(series, hist, ["site"]), "value", "corrected")[None]) == [10.0 + k for k in range(8)]
    fitted = by_site(K.poly_correction(series, hist, ["site"]), "value", "corrected")
    assert set(fitted) == {"a", None, "b"} and all(c == pytest.approx(2 * v + 1) for vs in fitted.values() for v, c in vs)


def test_polynomial_of_few_distinct_values(spark):
    """Powers that the lower ones determine get no coefficient; the fit is still the least squares one."""
    pairs = spark.createDataFrame([("one", 3.0, 5.0), ("one", 3.0, 7.0), ("two", 0.0, 1.0), ("two", 4.0, 9.0), ("two", 4.0, 11.0)], "site string, x double, y double")
    coefs = K.fit_polynomial(pairs, ["site"])
    at = K.apply_polynomial(pairs.withColumnRenamed("x", "value").drop("y").distinct(), coefs, ["site"])
    assert {(r.site, r.value): round(r.corrected, 9) for r in at.collect()} == {("one", 3.0): 6.0, ("two", 0.0): 1.0, ("two", 4.0): 10.0}


def test_zip_and_noleap(series, spark):
    ref = series.select("site", (F.col("date") + F.expr("INTERVAL 10 DAY")).alias("time"))
    got = by_site(CAL.zip_time(series, ref, ["site"], "date"), "date", "time")
    assert len(got[None]) == 8 and all(t is not None for _, t in got[None])
    out = by_site(CAL.rebuild_noleap(series, "date", "2021-01-01", "2021-01-02", keys=["site"], pad_last=False), "time")
    assert out[None] == out["a"] == [(dt.date(2021, 1, 1),)] * 4 + [(dt.date(2021, 1, 2),)] * 4


def test_ensemble_and_percentiles(series):
    ens = series.withColumn("member", F.dayofmonth("date")).withColumn("date", F.lit(DAY))
    exc = by_site(E.exceedance(ens, 12.5), "pct")
    assert exc == {"a": [(0.0,)], None: [(62.5,)], "b": [(100.0,)]}
    assert len(by_site(E.scale_bias(ens, series), "corrected")[None]) == 8
    table = by_site(Q.percentile_table(series.withColumnRenamed("value", "observed"), series.withColumnRenamed("value", "predicted"), ["site"], 0.5), "obs_percentile", "pred_percentile", "error")
    assert table[None] == [(13.5, 13.5, None)]


def test_folds_without_bounds(spark):
    rows = [(s, dt.date(y, 5, 1)) for s in ("a", None, "free") for y in range(2000, 2006)] + [("a", None)]
    df = spark.createDataFrame(rows, "site string, date date")
    bounds = spark.createDataFrame([("a", dt.date(2001, 1, 1), dt.date(2003, 1, 1)), (None, None, dt.date(2002, 1, 1))], "site string, start date, end date")
    folds = FO.year_folds(df.where("date is not null"), keys=["site"], bounds=bounds)
    years = {}
    for r in folds.collect():
        years.setdefault(r.site, set()).add(r.year)
    assert years == {"a": {2001, 2002, 2003}, None: {2000, 2001, 2002}, "free": set(range(2000, 2006))}
    with_folds = FO.with_folds(df, folds, ["site"])
    assert with_folds.count() == len(rows) and with_folds.where("fold is null").count() == 3 + 3 + 1
