"""Rows that have no partner, no value or no place stay, with a defined result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationcast.operators import calendar as CAL
from stationcast.operators import correction as K
from stationcast.operators import frames as FR
from stationcast.operators import joins as J
from stationcast.operators import quality as Q
from stationcast.operators.positions import global_positions
from stationcast.plans import flows as FL
from stationcast.sources import readers as SRC

D = dt.date


def test_rebuild_noleap_keeps_rows_beyond_the_spine(spark):
    df = spark.createDataFrame([(k, float(k)) for k in range(20)] + [(None, 99.0)], "k int, v double")
    out = CAL.rebuild_noleap(df, "k", "2021-01-01", "2021-01-02", 4, pad_last=False)
    rows = {r.v: r.time for r in out.collect()}
    assert len(rows) == 21 and rows[0.0] == D(2021, 1, 1) and rows[7.0] == D(2021, 1, 2) and rows[8.0] is None and rows[99.0] is None
    with pytest.raises(ValueError, match="13 rows"):
        CAL.rebuild_noleap(df, "k", "2021-01-01", "2021-01-02", 4, pad_last=False, strict=True)


def test_zip_time_keeps_rows_without_order(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), ("b", 1, 3.0)], "site string, k int, v double")
    ref = spark.createDataFrame([("a", D(2020, 1, 1))], "site string, time date")
    assert {r.v: r.time for r in CAL.zip_time(df, ref, ["site"], "k").collect()} == {1.0: D(2020, 1, 1), 2.0: None, 3.0: None}


def test_quantile_map_keeps_null_control_values(spark):
    c = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "site string, value double")
    h = spark.createDataFrame([("a", 5.0), ("a", 6.0)], "site string, value double")
    got = sorted(((r.site, r.value, r.corrected) for r in K.quantile_map(c, h, ["site"]).collect()), key=str)
    assert got == sorted([("a", 1.0, 5.0), ("a", None, None), ("b", 2.0, None)], key=str)


def test_positions_spread_one_value_over_partitions(spark):
    """70 % of a site's rows share one value: no range partition holds twice the mean."""
    df = spark.range(0, 60_000, numPartitions=8).select(F.lit("s").alias("key"), F.when(F.col("id") % 10 < 7, 0.0).otherwise(F.col("id") * 1.0).alias("value"), "id")
    pos = global_positions(df, ["key"], "value", num_partitions=12, keep_partition=True).cache()
    sizes = [r["count"] for r in pos.groupBy("range_part").count().collect()]
    assert max(sizes) < 2 * 60_000 / 12
    r = pos.agg(F.count_distinct("pos").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                F.max(F.when(F.col("value") == 0, F.col("pos"))).alias("zero"), F.max(F.when(F.col("value") == 0, F.col("n_lt"))).alias("lt")).first()
    zeros = df.where("value = 0").count()
    assert (r.n, r.lo, r.hi, r.zero, r.lt) == (60_000, 0, 59_999, zeros - 1, 0)


def test_sites_without_entry_get_the_default_window(spark):
    df = spark.createDataFrame([("a", D(2001, 1, 1)), ("b", D(2001, 1, 1)), ("b", D(1990, 1, 1)), (None, D(2002, 1, 1))], "site string, date date")
    sites = spark.createDataFrame([("a", D(2005, 1, 1), None)], "site string, start date, end date")
    assert {(r.site, r.date.year) for r in FR.clip_period(df, sites).collect()} == {("b", 2001), (None, 2002)}
    dim = spark.createDataFrame([("a", "20050101T000000Z", None)], "site string, start string, end string")
    got = {r.site: (r.start, r.end) for r in SRC.with_site_dim(df, dim).collect()}
    assert got["a"] == (D(2005, 1, 1), D(2025, 1, 1)) and got["b"] == (D(2000, 1, 1), D(2025, 1, 1))


def test_nearest_point_far_away_missing_and_repeated(spark):
    a = spark.createDataFrame([("k", 1, 0.0, 0.0), ("k", 2, 0.0, 0.0), ("k", 3, 10.0, 179.9), ("lonely", 4, 0.0, 0.0), ("k", 5, None, 0.0)], "g string, id int, lat double, lon double")
    b = spark.createDataFrame([("k", 9, 0.0, 60.0), ("k", 8, 0.0, 60.0), ("k", 7, 10.0, -179.9), ("k", 6, -80.0, 0.0)], "g string, id int, lat double, lon double")
    got = {r.a_id: (r.b_id, r.distance_km) for r in J.nearest_point(a, b, keys=["g"], cell_km=1.0).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 8, 2: 8, 3: 7, 4: None, 5: None}
    assert abs(got[1][1] - 6671.7) < 1 and got[4][1] is None


def test_haversine_of_antipodes(spark):
    from stationcast.functions.scalars import haversine_km
    df = spark.createDataFrame([(x / 7, x / 3 - 90) for x in range(500)], "lat double, lon double")
    got = df.select(haversine_km("lat", "lon", -F.col("lat"), F.col("lon") + 180).alias("d")).collect()
    assert all(abs(r.d - 20015.1) < 1 for r in got)


def test_mode_fill_of_text(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,)], "name string")
    assert sorted(r.name for r in Q.mode_fill(df, ["name"]).collect()) == ["x", "x", "x", "y", "y"]


def test_percentile_table_lists_every_combination(spark):
    obs = spark.createDataFrame([("a", 1.0), ("b", None)], "site string, observed double")
    pred = spark.createDataFrame([("a", 2.0), ("b", None), ("c", 3.0)], "site string, predicted double")
    assert {r.site: r.error for r in Q.percentile_table(obs, pred, ["site"]).collect()} == {"a": None, "b": "no_observed", "c": "no_observed"}
    base = spark.createDataFrame([("a",), ("z",)], "site string")
    t = Q.percentile_table(obs, pred, ["site"], combinations=base)
    assert {r.site for r in t.collect()} == {"a", "z"}
    assert Q.percentile_summary(t).first().asDict() == {"successful": 1, "failed": 1}


def test_uneven_packed_rows_fail_unless_dropped(spark):
    df = spark.createDataFrame([("t1", "[1 2]", "[3 4]"), ("t2", "[1 2]", "[3]")], "utctime string, a string, b string")
    assert SRC.explode_packed_series(df, ["a", "b"], uneven="drop").count() == 2
    with pytest.raises(Exception, match="different length"):
        SRC.explode_packed_series(df, ["a", "b"]).collect()


def test_lagged_predictor_over_a_day_without_observation(spark):
    obs = spark.createDataFrame([("s", D(2020, 1, d), float(d)) for d in (1, 2, 4)], "site string, date date, y double")
    grid = spark.createDataFrame([("s", D(2020, 1, d), v, p, float(d) if v == "t" else 10.0 * d) for d in range(1, 5) for v in ("t", "u") for p in range(1, 5)],
                                 "site string, date date, variable string, point int, value double")
    out = {r.date.day: r for r in FL.reanalysis_table(obs, grid, ["t", "u"], "y", "u", lag=["t"]).collect()}
    assert out[4]["t-1"] == 3.0 and out[2]["t-1"] == 1.0 and out[1]["t-1"] is None and out[4]["u-1"] == 40.0
