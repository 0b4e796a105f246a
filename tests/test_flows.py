"""End-to-end flows on small hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationcast.plans import flows as FL

D = dt.date


@pytest.fixture(scope="module")
def grid(spark):
    rows = []
    for day in range(60):
        date = D(2020, 1, 1) + dt.timedelta(day)
        for p in range(1, 5):
            rows.append(("s", date, "t2", p, 10.0 + p + day * 0.1))
            rows.append(("s", date, "u10", p, 1.0 * p))
    return spark.createDataFrame(rows, "site string, date date, variable string, point int, value double")


@pytest.fixture(scope="module")
def obs(spark):
    rows = [("s", D(2020, 1, 1) + dt.timedelta(day), 20.0 + (day % 7)) for day in range(60)]
    return spark.createDataFrame(rows, "site string, date date, TX double")


def test_reanalysis_table(grid, obs):
    t = FL.reanalysis_table(obs, grid, ["t2", "u10"], "TX", "t2", lag=["u10"])
    cols = set(t.columns)
    assert {"t2-1", "u10-4", "t2_sum", "t2_sum_mean", "TX_mean", "t2_TX_diff_max", "TX_mean_climatology",
            "dayOfYear", "year", "month"} <= cols
    r = t.filter(F.col("date") == D(2020, 1, 2)).first()
    assert r["t2_sum"] == pytest.approx((11 + 12 + 13 + 14) / 4 + 0.1)
    assert r["u10-1"] == 1.0                                   # lagged from the previous day
    assert t.filter(F.col("date") == D(2020, 1, 1)).first()["u10-1"] is None
    assert t.count() == 60


def test_materialize_options_do_not_change_results(spark, grid, obs):
    from stationcast.operators import climatology as C
    a = FL.reanalysis_table(obs, grid, ["t2", "u10"], "TX", "t2")
    b = FL.reanalysis_table(obs, grid, ["t2", "u10"], "TX", "t2", materialize=True)
    cols = ["site", "date", "t2_sum", "TX_mean", "TX_mean_climatology"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())
    daily = a.select("site", "date", "t2_sum", "TX")
    x = C.delta_change(daily, "t2_sum", "TX", "2020-01-31")
    y = C.delta_change(daily, "t2_sum", "TX", "2020-01-31", materialize=True)
    assert sorted(x.collect()) == sorted(y.collect())


def test_scenario_tables(spark, grid, obs):
    wide = (grid.filter("variable = 't2'").groupBy("site", "date")
            .agg(*[F.max(F.when(F.col("point") == i, F.col("value"))).alias(f"t2-{i}") for i in range(1, 5)])
            .join(obs, ["site", "date"], "left"))
    train, pred = FL.scenario_tables(wide, "TX", "t2", ("2020-01-10", "2020-01-31"))
    assert train.count() == 22 and pred.count() == 51
    row = pred.filter(F.col("date") == D(2020, 1, 20)).first()
    assert row["TX_mean"] is not None
    assert row["t2_TX_diff_mean"] == pytest.approx(row["t2_sum_mean"] - row["TX_mean"])
    feb = pred.filter(F.col("date") == D(2020, 2, 15)).first()
    assert feb["TX_mean"] is None and feb["t2_sum_mean"] is not None   # month absent from the training window


def test_station_daily(spark):
    sub = spark.createDataFrame([("a", dt.datetime(2020, 1, 1, 6), 5.0, 1.0), ("a", dt.datetime(2020, 1, 3, 6), 7.125, 2.0)],
                                "site string, time timestamp, WG_PT1H_MAX double, PRA_PT12H_ACC double")
    sites = spark.createDataFrame([("a", "Harbour", 60.0, 24.0)], "site string, name string, latitude double, longitude double")
    out = FL.station_daily(sub, sites).orderBy("utctime").collect()
    assert [r.utctime for r in out] == [D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 3)]
    assert out[1].WG_PT24H_MAX is None and out[2].WG_PT24H_MAX == 7.12 and out[0].name == "Harbour"


def test_risk_report(spark):
    ens = spark.createDataFrame([("s", m, D(2020, 1, d), float(m * d)) for m in range(4) for d in range(1, 4)],
                                "site string, member int, date date, value double")
    rep = FL.risk_report(ens, 2.5, 50.0)
    pct = {r.date: r.pct for r in rep["exceedance"].collect()}
    assert pct == {D(2020, 1, 1): 25.0, D(2020, 1, 2): 50.0, D(2020, 1, 3): 75.0}
    assert [r.date for r in rep["days"].collect()] == [D(2020, 1, 3)]
