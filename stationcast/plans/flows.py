"""End-to-end flows of SURVEY section 3, composed from the operators.

Each flow takes long-form inputs for all sites at once and returns lazy
DataFrames; the only driver actions are the bounded ones inside the
operators (dimension size checks, model leaf tables).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.ml import folds as FO
from stationcast.ml import scoring as SC
from stationcast.ml.boosting import QuantileGBT
from stationcast.operators import climatology as C
from stationcast.operators import ensemble as E
from stationcast.operators import frames as FR
from stationcast.operators import joins as J
from stationcast.operators import quality as Q
from stationcast.operators import reshape as R

# Standard daily names and output order of station data.
STATION_NAMES = {"WG": "WG_PT24H_MAX", "TX": "TA_PT24H_MAX", "TN": "TA_PT24H_MIN", "TP": "TP_PT24H_ACC",
                 "RH": "RH_PT24H_AVG", "WS": "WS_PT24H_AVG", "WD": "WD_PT24H_AVG"}
STATION_ORDER = ["utctime", "latitude", "longitude", "name", "WG_PT24H_MAX", "TA_PT24H_MAX", "TA_PT24H_MIN",
                 "TP_PT24H_ACC", "RH_PT24H_AVG", "WS_PT24H_AVG", "WD_PT24H_AVG"]


# ------------------------------------------------------------ 3.4 station feed
def station_daily(subdaily: DataFrame, sites: DataFrame, start: str | None = None,
                  mapping: Mapping[str, str] | None = None, rules: Mapping[str, str] | None = None,
                  keys: Sequence[str] = ("site",), time: str = "time") -> DataFrame:
    """Sub-daily station observations -> standard daily table: A1 daily
    rules, R7 complete calendar from ``start``, P14 rounding to 2 dp, P12
    standard names and order, P25 site name and coordinates (from the
    ``sites`` dimension: keys, name, latitude, longitude)."""
    daily = C.daily_agg(subdaily, mapping, rules, keys, time, empty_sum="zero")
    full = R.reindex_daily(daily, keys, "date", start)
    vals = [c for c in full.columns if c not in (*keys, "date")]
    full = FR.round_cols(full, vals, 2)
    full = FR.rename_by(full, {**STATION_NAMES, "date": "utctime"})
    dim = sites.select(*keys, "name", "latitude", "longitude")
    out = full.join(dim, list(keys), "left")
    return FR.order_columns(out, [*keys, *STATION_ORDER])


# ------------------------------------------------------------ 3.1 reanalysis
def reanalysis_table(obs: DataFrame, grid_long: DataFrame, variables: Sequence[str], predictand: str,
                     parameter: str, lag: Sequence[str] = (), keys: Sequence[str] = ("site",),
                     n_points: int = 4, materialize: bool = False) -> DataFrame:
    """Training table of the reanalysis flow (stages 3-6).

    ``obs`` (keys, date, predictand...) and ``grid_long`` (keys, date,
    variable, point, value).  Predictors are pivoted once into
    ``<variable>-<point>`` (J1); ``lag`` variables move one day (W1, the
    daily aggregates that end at 00 UTC); date parts (P1); the four-point
    mean ``<parameter>_sum`` (P17, fixed divisor); year-month statistics of
    it and of the predictand and their differences (A3, A7) joined back
    (J4); and the predictand's climatology of monthly statistics (A5).
    With ``materialize`` the assembled daily table is written once to the
    checkpoint folder before the statistics read it again.
    """
    if lag:  # lagged before assembly: a day without observation still hands its predictors on
        grid_long = grid_long.withColumn("date", F.when(F.col("variable").isin(*lag), F.date_add("date", 1)).otherwise(F.col("date")))
    t = J.assemble(obs, grid_long, variables, n_points, keys)
    t = FR.add_date_parts(t, "date", ("dayOfYear", "year", "month"))
    t = FR.point_mean_wide(t, parameter, n_points)
    if materialize:
        from stationcast.operators.common import cut_lineage
        t = cut_lineage(t)
    st = C.diff_features(C.monthly_stats(t, [f"{parameter}_sum", predictand], keys), parameter, predictand)
    t = J.with_stats(t, st, [*keys, "year", "month"])
    clim = C.stat_climatology(t, predictand, keys)
    return t.join(clim, [*keys, "month"], "left")


def fit_and_evaluate(table: DataFrame, features: Sequence[str], predictand: str, alpha: float,
                     test_years: Sequence[int], keys: Sequence[str] = ("site",), **gbt):
    """Stages 7-13: complete cases, hold-out years, quantile model, scores
    on the hold-out (P13, M1, M4, M6, A18).  Returns (model, predictions,
    scores)."""
    data, _ = FR.complete_cases(table.select(*keys, "date", *features, predictand))
    data = FO.split_years(data, test_years)
    model = QuantileGBT(features, predictand, alpha=alpha, **gbt).fit(
        data.filter(~F.col("is_test")), data.filter(F.col("is_test")))
    pred = SC.score_batch(model, data.filter(F.col("is_test")), [*keys, "date"], observed=predictand)
    return model, pred, Q.score(pred, list(keys))


# ------------------------------------------------------------ 3.2 scenario
def scenario_tables(wide: DataFrame, predictand: str, variable: str, train_window: tuple[str, str],
                    keys: Sequence[str] = ("site",), n_points: int = 4) -> tuple[DataFrame, DataFrame]:
    """Training and prediction tables of the scenario flow (stage 10).

    ``wide`` has keys, date, ``<variable>-1..n`` and the predictand.  The
    training table is the window [start, end]; the prediction table runs
    from the start on.  Year-month stats of ``<variable>_sum`` come from the
    whole prediction period; month statistics of the predictand from the
    training window only (A4); their differences (A7) are joined to both.
    """
    start, end = train_window
    t = FR.point_mean_wide(wide, variable, n_points)
    t = t.withColumns({"year": F.year("date"), "month": F.month("date")})
    pred_tab = FR.clip_period(t, start=start, open_end=True)
    train_tab = FR.clip_period(t, start=start, end=end)
    vs = C.monthly_stats(pred_tab, [f"{variable}_sum"], keys)
    ps = C.month_climatology(train_tab, [predictand], keys=keys)
    ms = C.diff_features(vs.join(ps, [*keys, "month"], "left"), variable, predictand)
    cols = [c for c in ms.columns if c not in (*keys, "year", "month")]
    ms = ms.select(*keys, "year", "month", *cols)
    return (train_tab.drop(*[c for c in cols if c in train_tab.columns]).join(ms, [*keys, "year", "month"], "left"),
            pred_tab.drop(*[c for c in cols if c in pred_tab.columns]).join(ms, [*keys, "year", "month"], "left"))


# ------------------------------------------------------------ 3.3 ensemble risk
def risk_report(ens: DataFrame, threshold: float, p: float, op: str = "above",
                keys: Sequence[str] = ("site",)) -> dict[str, DataFrame]:
    """Ensemble risk tables: daily exceedance (A13), monthly risk (A14),
    high-risk days (A15), ensemble mean (P18)."""
    exc = E.exceedance(ens, threshold, op, keys)
    return {"exceedance": exc, "monthly": E.monthly_risk(exc, p, keys), "days": E.risk_days(exc, p, keys),
            "mean": E.ensemble_mean(ens, keys)}


__all__ = ["station_daily", "reanalysis_table", "fit_and_evaluate", "scenario_tables", "risk_report"]
