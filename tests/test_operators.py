"""Hand-computed unit tests on small frames: pandas/Spark differences (D1-D13),
quirk decisions (Q1-Q17) and invariants.  Expected values are written out."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationcast.functions import scalars as X
from stationcast.operators import calendar as CAL
from stationcast.operators import climatology as C
from stationcast.operators import correction as K
from stationcast.operators import ensemble as E
from stationcast.operators import frames as FR
from stationcast.operators import joins as J
from stationcast.operators import quality as Q
from stationcast.operators import reshape as R
from stationcast.operators import windows as W
from stationcast.plans.q_frames import CORDEX_MAP, ERA5_MAP
from stationcast.sources import readers as SRC

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------ D1 / P17
def test_point_mean_fixed_divisor(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 1), 1, 4.0), ("s", D(2020, 1, 1), 2, None),
                                ("s", D(2020, 1, 1), 3, 8.0), ("s", D(2020, 1, 2), 1, None)],
                               "site string, date date, point int, v double")
    out = rows(FR.point_mean(df, "v"), "date", "v_sum")
    assert out == [(D(2020, 1, 1), 3.0), (D(2020, 1, 2), 0.0)]  # (4+8)/4, all-null -> 0/4


# ------------------------------------------------------------ D3 / A13
def test_exceedance_counts_missing_members_in_denominator(spark):
    df = spark.createDataFrame([("s", 0, D(2020, 1, 1), 10.0), ("s", 1, D(2020, 1, 1), None),
                                ("s", 2, D(2020, 1, 1), 1.0), ("s", 3, D(2020, 1, 2), 10.0)],
                               "site string, member int, date date, value double")
    out = dict(rows(E.exceedance(df, 5.0), "date", "pct"))
    assert out[D(2020, 1, 1)] == pytest.approx(25.0)   # 1 of 4 members
    assert out[D(2020, 1, 2)] == pytest.approx(25.0)
    for v in out.values():
        assert 0.0 <= v <= 100.0


def test_monthly_risk_half_even(spark):
    exc = spark.createDataFrame([("s", D(2020, 1, d), 60.0 if d <= 1 else 10.0) for d in range(1, 9)],
                                "site string, date date, pct double")
    r = E.monthly_risk(exc, 50.0).collect()[0]
    assert (r.days_over, r.total_days) == (1, 8)
    assert r.percentage == 12.5  # 12.5 at 1 dp
    exc2 = spark.createDataFrame([("s", D(2020, 2, d), 60.0 if d <= 1 else 10.0) for d in range(1, 17)],
                                 "site string, date date, pct double")
    assert E.monthly_risk(exc2, 50.0).collect()[0].percentage == 6.2  # 6.25 -> 6.2 (half to even)


# ------------------------------------------------------------ D4 / D5 / Q10 / A1
def test_daily_agg_sum_modes_and_two_sources(spark):
    df = spark.createDataFrame([
        ("s", dt.datetime(2020, 1, 1, 6), None, 3.0, None),
        ("s", dt.datetime(2020, 1, 1, 18), None, 5.0, None),
        ("s", dt.datetime(2020, 1, 2, 6), 7.0, 9.0, None)],
        "site string, time timestamp, WG_PT1H_MAX double, WG_PT10M_MAX double, PRA_PT12H_ACC double")
    z = dict((r.date, (r.WG, r.TP)) for r in C.daily_agg(df, empty_sum="zero").collect())
    n = dict((r.date, r.TP) for r in C.daily_agg(df).collect())
    assert z[D(2020, 1, 1)] == (5.0, 0.0)     # second source fills; pandas sum of NaN = 0
    assert z[D(2020, 1, 2)] == (7.0, 0.0)     # first source wins where present
    assert n[D(2020, 1, 1)] is None           # min_count=1


def test_daily_agg_circular_mean_option(spark):
    df = spark.createDataFrame([("s", dt.datetime(2020, 1, 1, 6), 350.0), ("s", dt.datetime(2020, 1, 1, 18), 10.0)],
                               "site string, time timestamp, WD_PT1H_AVG double")
    arith = C.daily_agg(df).first().WD
    circ = C.daily_agg(df, rules={**C.DEFAULT_RULES, "WD": "circular_mean"}).first().WD
    assert arith == 180.0                              # reference parity (Q9)
    assert min(circ, 360.0 - circ) == pytest.approx(0.0, abs=1e-9)


# ------------------------------------------------------------ D11 / S5
def test_packed_series_unequal_lengths_dropped(spark):
    df = spark.createDataFrame([("t1", "[60.0 60.25]", "[1.0 2.0]", "[ 3.5  4.5 ]"),
                                ("t2", "[60.0 60.25]", "[1.0]", "[3.5 4.5]")],
                               "utctime string, lat string, lon string, v string")
    out = rows(SRC.explode_packed_series(df, ["lat", "lon", "v"], uneven="drop"), "utctime", "cell", "lat", "lon", "v")
    assert out == [("t1", 0, 60.0, 1.0, 3.5), ("t1", 1, 60.25, 2.0, 4.5)]


# ------------------------------------------------------------ D12 / P7
def test_wind_direction_pmod(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0)], "u double, v double")
    out = [r.wd for r in df.select(X.wind_direction("u", "v").alias("wd")).collect()]
    assert out == pytest.approx([270.0, 180.0, 90.0, 0.0])


# ------------------------------------------------------------ D13 / P15
def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("abc",), (None,)], "x string")
    assert [r.x for r in FR.coerce_numeric(df, ["x"]).collect()] == [1.5, 2.0, None, None]


# ------------------------------------------------------------ Q1 / Q2 / P10 / P11
def test_select_features_contains_drops_ewss():
    cols = ["fg10-1", "ewss-1", "mx2t-1", "WG_PT24H_MAX", "TA_PT24H_MAX"]
    assert FR.select_features(cols, "TA_PT24H_MAX", ERA5_MAP, "contains") == ["mx2t-1", "TA_PT24H_MAX"]


def test_select_features_delimited_and_empty_parameter():
    cols = ["TA_PT24H_MAX", "WG_PT24H_MAX_mean", "x_hurs", "pr-1", "tasmax_sum"]
    keep = FR.select_features(cols, "TA_PT24H_MAX", CORDEX_MAP, "delimited", essentials=["TA_PT24H_MAX"])
    assert keep == ["TA_PT24H_MAX", "pr-1", "tasmax_sum"]
    compat = FR.select_features(cols, "TA_PT24H_MAX", CORDEX_MAP, "delimited", essentials=["TA_PT24H_MAX"],
                                strict_compat=True)
    assert compat == ["TA_PT24H_MAX", "pr-1"]  # empty WD parameter makes "_" drop every "_" name


# ------------------------------------------------------------ Q3 / P8
def test_relative_humidity_units(spark):
    df = spark.createDataFrame([(283.15, 283.15), (278.15, 283.15)], "td double, t double")
    out = [r.rh for r in df.select(X.relative_humidity("td", "t", "K").alias("rh")).collect()]
    assert out[0] == pytest.approx(100.0)
    e = lambda x: math.exp(17.625 * x / (243.04 + x))
    assert out[1] == pytest.approx(100 * e(5.0) / e(10.0))


# ------------------------------------------------------------ P5
def test_auto_units_per_key(spark):
    df = spark.createDataFrame([("c", 10.0), ("c", 20.0), ("k", 283.15), ("k", 293.15), ("n", None)],
                               "site string, t double")
    out = rows(FR.auto_units(df, "t", "K_to_C", flag="conv"), "site", "t", "conv")
    assert out[:2] == [("c", 10.0, False), ("c", 20.0, False)]
    assert out[2][1] == pytest.approx(10.0) and out[2][2] is True
    assert out[4] == ("n", None, False)


# ------------------------------------------------------------ P23
def test_align_features_strict_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert FR.align_features(df, ["b", "c"]).columns == ["b", "c"]
    assert FR.align_features(df, ["b", "c"]).first().c == 0.0
    with pytest.raises(ValueError):
        FR.align_features(df, ["b", "c"], on_missing="error")


# ------------------------------------------------------------ S3 / P3
def test_station_blend_parsing(spark):
    lines = spark.createDataFrame([("EUROPEAN CLIMATE ASSESSMENT",), ("",), ("STAID, SOUID,    DATE,   TG, Q_TG",),
                                   ("   123,  456,20200101,   55,    0",), ("   123,  456,20200102,-9999,    9",),
                                   ("   123,  456,2020013x,   10,    0",)], "value string")
    out = rows(SRC.parse_station_blend(lines), "staid", "date", "value")
    assert out == [(123, D(2020, 1, 1), 5.5), (123, D(2020, 1, 2), None)]


# ------------------------------------------------------------ S4
def test_dms_to_degrees(spark):
    df = spark.createDataFrame([("-04:28:56",), ("+60:12:31",), ("60:12",)], "d string")
    out = [r.x for r in df.select(SRC.dms_to_degrees("d").alias("x")).collect()]
    assert out[0] == pytest.approx(-(4 + 28 / 60 + 56 / 3600))
    assert out[1] == pytest.approx(60 + 12 / 60 + 31 / 3600)
    assert out[2] is None


# ------------------------------------------------------------ S2
def test_trimmed_csv_per_file(spark, tmp_path):
    for name in ("a", "b"):
        lines = ["junk1", "junk2", "junk3"] + [f"2020-01-0{i},1.0,2.0,{i}" for i in range(1, 4)] + ["t1", "t2", "t3", "t4"]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    out = SRC.read_trimmed_csv(spark, str(tmp_path), 3, 4, "date DATE, lat DOUBLE, lon DOUBLE, v DOUBLE")
    assert sorted(r.v for r in out.collect()) == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0]


def test_line_numbers_across_file_splits(spark, tmp_path):
    n = 60000
    (tmp_path / "big.csv").write_text("".join(f"2020-01-01,1.0,2.0,{i}\n" for i in range(1, n + 1)))
    (tmp_path / "small.csv").write_text("h\n2020-01-01,1.0,2.0,7\nt\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        lines = SRC.with_line_numbers(spark.read.text(str(tmp_path)))
        big = lines.filter(F.col("file").endswith("big.csv"))
        got = big.select(F.split("value", ",")[3].cast("long").alias("v"), "line", "n_lines")
        assert got.filter(F.col("v") != F.col("line")).count() == 0 and got.count() == n
        assert got.agg(F.max("n_lines")).first()[0] == n
        assert spark.read.text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# ------------------------------------------------------------ S9
def test_read_keyed_patterns(spark, tmp_path):
    names = ["predictions_Malaga_WG_PT24H_MAX_rcp45_cnrm.csv", "predictions_Malaga_TP_rcp85_mpi.csv",
             "predictions_Bremen_TA_MAX_rcp45_ec.csv", "notes_Malaga.csv"]
    for n in names:
        (tmp_path / n).write_text("utctime,observed,predicted\n2020-01-01,1.0,2.0\n")
    pat = r"^predictions_([A-Za-z]+)_(.+)_(rcp\d+)_([A-Za-z0-9]+)\.csv$"
    out = SRC.read_keyed(spark, str(tmp_path), pat, ["site", "predictand", "scenario", "model"],
                         schema="utctime date, observed double, predicted double")
    assert rows(out, "site", "predictand", "scenario", "model") == [
        ("Bremen", "TA_MAX", "rcp45", "ec"), ("Malaga", "TP", "rcp85", "mpi"),
        ("Malaga", "WG_PT24H_MAX", "rcp45", "cnrm")]


# ------------------------------------------------------------ R7 invariant
def test_reindex_daily_row_count(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 1), 1.0), ("s", D(2020, 1, 5), 2.0), ("t", D(2020, 2, 1), 3.0)],
                               "site string, date date, v double")
    out = R.reindex_daily(df)
    assert out.filter("site = 's'").count() == 5 and out.filter("site = 't'").count() == 1
    assert R.reindex_daily(df, start="2020-01-03").filter("site = 's'").count() == 3
    late = R.reindex_daily(df, start="2020-01-20")            # 's' ends before the start
    assert late.filter("site = 's'").count() == 0 and late.filter("site = 't'").count() == 1


# ------------------------------------------------------------ R8 / R9 / Q6
def test_360_day_detection_and_repair(spark):
    days = [f"2020-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 31)]
    df = spark.createDataFrame([("m", t, float(i)) for i, t in enumerate(days)], "source string, time string, v double")
    assert CAL.is_360_day(df).first().is_360_day is True
    rep = CAL.repair_360_day(df.drop("source"))
    dates = [r.date for r in rep.collect()]
    assert len(dates) == len(set(dates))                   # unique after dedup
    assert D(2020, 1, 31) in dates and D(2020, 2, 29) in dates and D(2020, 12, 31) in dates
    assert D(2020, 2, 30 - 1) in dates
    jan31 = rep.filter(F.col("date") == D(2020, 1, 31)).first()
    assert jan31.v == 30.0 and jan31.copied                  # copy of 1 Feb (index 30) wins
    compat = CAL.repair_360_day(df.drop("source"), compat=True)
    assert compat.filter(F.col("date") == D(2020, 1, 31)).count() == 2   # Q6: twice
    full = spark.createDataFrame([("g", (D(2021, 1, 1) + dt.timedelta(i)).isoformat()) for i in range(365)],
                                 "source string, time string")
    assert CAL.is_360_day(full).first().is_360_day is False


def test_pivot_strict_duplicates_and_empty_missing_pct(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 1), 1, 1.0), ("s", D(2020, 1, 1), 1, 2.0)],
                               "site string, date date, point int, v double")
    assert R.pivot_points(df, ["v"]).first()["v-1"] == 2.0
    with pytest.raises(ValueError):
        R.pivot_points(df, ["v"], strict=True)
    empty = df.filter("v > 10")
    assert all(r.missing_pct is None for r in Q.missing_pct(empty).collect())
    assert Q.incomplete_rows_pct(empty).first().incomplete_pct is None


# ------------------------------------------------------------ R12
def test_dedup_first_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, 1, "x")], "k int, o int, v string")
    assert rows(R.dedup_first(df, ["k"], ["o"]), "k", "o", "v") == [(1, 3, "a"), (2, 1, "x")]


# ------------------------------------------------------------ W1/W2/W3/W4
def test_shift_and_delta_by_calendar(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 1), 1.0), ("s", D(2020, 1, 2), 4.0), ("s", D(2020, 1, 4), 5.0)],
                               "site string, date date, p double")
    out = rows(W.delta(df, ["p"]), "date", "Dp")
    assert out == [(D(2020, 1, 1), None), (D(2020, 1, 2), 3.0), (D(2020, 1, 4), None)]


def test_trailing_24h_sampled(spark):
    T = dt.datetime
    df = spark.createDataFrame([("s", T(2020, 1, 1, 0), 9.0), ("s", T(2020, 1, 1, 6), 1.0),
                                ("s", T(2020, 1, 1, 23), 3.0), ("s", T(2020, 1, 2, 0), 2.0),
                                ("s", T(2020, 1, 3, 12), 7.0)], "site string, time timestamp_ntz, v double")
    out = rows(W.trailing_agg_sampled(df, "v", "max"), "time", "max_24h")
    assert out == [(T(2020, 1, 1, 0), 9.0), (T(2020, 1, 2, 0), 3.0)]  # (t-24h, t]: 00:00 of day 1 excluded


def test_ffill_across_chunks(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 30), 1.0), ("s", D(2020, 2, 2), None), ("s", D(2020, 3, 1), None),
                                ("s", D(2020, 3, 2), 4.0), ("t", D(2020, 1, 1), None)], "site string, date date, v double")
    assert rows(W.ffill(df, ["v"]), "site", "date", "v") == [
        ("s", D(2020, 1, 30), 1.0), ("s", D(2020, 2, 2), 1.0), ("s", D(2020, 3, 1), 1.0),
        ("s", D(2020, 3, 2), 4.0), ("t", D(2020, 1, 1), None)]


# ------------------------------------------------------------ W5 / W6 invariants
def test_quantile_map_ties_and_subset(spark):
    ctrl = spark.createDataFrame([("s", i, v) for i, v in enumerate([1.0, 2.0, 2.0, 3.0, 4.0])],
                                 "site string, i int, value double")
    hist = spark.createDataFrame([("s", v) for v in [10.0, 20.0, 30.0]], "site string, value double")
    out = dict(rows(K.quantile_map(ctrl, hist, ["site"]), "i", "corrected"))
    # idx = number strictly smaller: [0,1,1,3,4]; frac=(idx-1)/4 or 0; pos=int(frac*2)
    assert out == {0: 10.0, 1: 10.0, 2: 10.0, 3: 20.0, 4: 20.0}
    vals = list(out.values())
    assert set(vals) <= {10.0, 20.0, 30.0} and vals == sorted(vals)


def test_global_positions_spread_hot_key_and_stay_exact(spark):
    from stationcast.operators.positions import global_positions
    import random
    rng = random.Random(5)
    data = [("hot", float(rng.randint(0, 500))) for _ in range(4000)]
    data += [(f"k{i}", float(rng.randint(0, 50))) for i in range(20) for _ in range(30)]
    df = spark.createDataFrame(data, "key string, value double")
    pos = global_positions(df, ["key"], "value", num_partitions=8, keep_partition=True)
    hot = pos.filter("key = 'hot'").select("range_part").distinct().count()
    assert hot > 1                                     # the hot key is not in one task
    got = sorted((r.key, r.value, r.pos, r.n_lt, r.n) for r in pos.collect())
    by_key = {}
    for k, v in data:
        by_key.setdefault(k, []).append(v)
    for k, vals in by_key.items():
        rows_k = [g for g in got if g[0] == k]
        assert sorted(g[2] for g in rows_k) == list(range(len(vals)))          # positions 0..n-1
        for _, v, p, n_lt, n in rows_k:
            assert n == len(vals) and n_lt == sum(1 for x in vals if x < v)
            assert n_lt <= p < n_lt + vals.count(v)


def test_poly_correction_recovers_cubic(spark):
    xs = [float(i) for i in range(20)]
    ctrl = spark.createDataFrame([("s", x) for x in xs], "site string, value double")
    hist = spark.createDataFrame([("s", 2 * x ** 3 - x + 1) for x in xs], "site string, value double")
    out = K.poly_correction(ctrl, hist, ["site"])
    for r in out.collect():
        assert r.corrected == pytest.approx(2 * r.value ** 3 - r.value + 1, rel=1e-6, abs=1e-6)


# ------------------------------------------------------------ A18 / A20
def test_score_zero_variance_and_mae_le_rmse(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 0.0), ("b", 1.0, 2.0), ("b", 3.0, 3.0)],
                               "k string, observed double, predicted double")
    out = {r.k: r for r in Q.score(df, ["k"]).collect()}
    assert out["a"].r2 is None and out["a"].explained_variance is None
    assert out["a"].mae == 1.0 and out["a"].mean_error == 0.0
    assert out["b"].mae <= out["b"].rmse
    assert out["b"].r2 == pytest.approx(1 - 1.0 / 2.0)


def test_grid_diff_identical_and_shifted(spark):
    pts = [("m1", 60.0, 24.0), ("m1", 60.25, 24.0), ("m2", 60.0, 24.0), ("m2", 60.25, 24.0),
           ("m3", 60.5, 24.0), ("m3", 60.75, 24.0)]
    df = spark.createDataFrame(pts, "model string, lat double, lon double")
    out = {(r.model_1, r.model_2): r for r in Q.grid_diff(df).collect()}
    assert out[("m1", "m2")].identical is True and out[("m1", "m2")].max_dist == pytest.approx(0.0)
    assert out[("m1", "m3")].identical is False
    assert out[("m1", "m3")].min_dist == pytest.approx(0.25 * math.pi / 180 * 6371.0, rel=1e-6)


# ------------------------------------------------------------ J3 / J10
def test_outer_merge(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "d int, a double")
    b = spark.createDataFrame([(2, 20.0), (3, 30.0)], "d int, b double")
    assert rows(J.outer_merge([a, b], ["d"]), "d", "a", "b") == [(1, 1.0, None), (2, 2.0, 20.0), (3, None, 30.0)]


def test_nearest_point_far_points_resolve(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 60.0, 25.0)], "id int, lat double, lon double")
    b = spark.createDataFrame([(10, 0.0, 1.0), (11, -50.0, 170.0), (12, 59.0, 25.0)], "id int, lat double, lon double")
    out = dict(rows(J.nearest_point(a, b), "a_id", "b_id"))
    assert out == {1: 10, 2: 12}


# ------------------------------------------------------------ A21
def test_kde_integrates_to_one(spark):
    df = spark.createDataFrame([("s", float(v)) for v in [1, 2, 2, 3, 7]], "k string, value double")
    dens = sorted((r.x, r.density) for r in E.kde(df, ["k"], gridsize=400).collect())
    step = dens[1][0] - dens[0][0]
    assert sum(d for _, d in dens) * step == pytest.approx(1.0, abs=0.01)


def test_binned_kde_is_within_its_bound(spark):
    rows = [("s", float(v)) for v in [1, 2, 2, 3, 7]] + [(None, 1.0), (None, 4.5), ("flat", 2.0), ("flat", 2.0), ("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, value double")
    got = {(r.k, r.grid_idx): (r.x, r.density) for r in E.kde_binned(df, ["k"], gridsize=60).collect()}
    assert got[("flat", None)] == (2.0, None) and got[("one", None)] == (5.0, None)
    assert len(got) == 2 * 60 + 2
    exact = {(r.k, r.grid_idx): (r.x, r.density) for r in E.kde(df, ["k"], gridsize=60).collect()}
    h = pd.Series([1, 2, 2, 3, 7]).std() * 5 ** -0.2
    bound = (got[("s", 1)][0] - got[("s", 0)][0]) ** 2 / (8 * h ** 3 * (2 * 3.141592653589793) ** 0.5)
    for i in range(60):
        assert got[("s", i)][0] == pytest.approx(exact[("s", i)][0])
        assert abs(got[("s", i)][1] - exact[("s", i)][1]) <= bound


# ------------------------------------------------------------ D2 / D6 / D7
def test_ensemble_mean_skips_nulls(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 1), 1, 2.0), ("s", D(2020, 1, 1), 2, None),
                                ("s", D(2020, 1, 1), 3, 4.0)], "site string, date date, member int, value double")
    assert E.ensemble_mean(df).first().ensemble_mean == 3.0


def test_shift_rows_follows_order_not_arrival(spark):
    df = spark.createDataFrame([("s", D(2020, 1, 3), 3.0), ("s", D(2020, 1, 1), 1.0), ("s", D(2020, 1, 2), 2.0)],
                               "site string, date date, v double")
    assert rows(W.shift_rows(df, ["v"]), "date", "v_lag") == [
        (D(2020, 1, 1), None), (D(2020, 1, 2), 1.0), (D(2020, 1, 3), 2.0)]


def test_daily_wind_drops_null_keys_and_averages_first(spark):
    T = dt.datetime
    df = spark.createDataFrame([(T(2020, 1, 1, 0), 60.0, 3.0, 0.0), (T(2020, 1, 1, 6), 60.0, -3.0, 4.0),
                                (T(2020, 1, 1, 12), None, 100.0, 100.0)], "time timestamp, lat double, u double, v double")
    out = C.daily_wind(df, ["lat"]).collect()
    assert len(out) == 1
    assert out[0].u == 0.0 and out[0].v == 2.0 and out[0].wind_speed == 2.0  # speed of the mean vector


# ------------------------------------------------------------ M11 / M12 invariant
def test_rollups_add_up(spark):
    from stationcast.ml import explain as EX
    attr = spark.createDataFrame([(1, "t2-1", 1.0, 0.5), (1, "t2-2", 2.0, -0.25), (2, "t2-1", 3.0, 0.1),
                                  (2, "msl", 4.0, 0.2), (1, "msl", 5.0, -0.4)],
                                 "row_id int, feature string, value double, attribution double")
    per_point, per_row = EX.rollup_by_point(attr)
    by_var = {r.variable: r.mean_abs for r in EX.rollup_by_variable(attr).collect()}
    pts = sum(r.mean_abs for r in per_point.collect())
    other = attr.filter("feature = 'msl'").agg(F.avg(F.abs("attribution"))).first()[0]
    assert pts + other == pytest.approx(sum(by_var.values()))
    assert by_var["t2"] == pytest.approx(0.3 + 0.25)
    assert rows(per_row, "row_id", "point", "attribution") == [(1, "1", 0.5), (1, "2", -0.25), (2, "1", 0.1)]


def test_station_catalog_starts_after_each_files_header(spark, tmp_path):
    from stationcast.sources.readers import read_station_catalog
    record = "{:>5},{:<40},FI,+60:10:30,+024:57:00,{:>4}"
    note, header = record.format(7, "A NOTE LIKE A RECORD", 1), "STAID,STANAME                                 ,CN,      LAT,       LON,HGHT"
    (tmp_path / "a.txt").write_text("\n".join(["EUROPEAN STATIONS", note, header, record.format(1, "HELSINKI", 4), header, record.format(2, "KOTKA", 9)]))
    (tmp_path / "b.txt").write_text("\n".join([header, record.format(3, "OULU", 14), "", "END"]))
    (tmp_path / "c.txt").write_text(record.format(4, "NO HEADER", 2))
    got = sorted((r["staid"], r["name"], round(r["lat"], 3), r["height"]) for r in read_station_catalog(spark, str(tmp_path)).collect())
    assert got == [(1, "HELSINKI", 60.175, 4.0), (2, "KOTKA", 60.175, 9.0), (3, "OULU", 60.175, 14.0)]
