"""Catalogue: model operators.

Model matrix stand-in: per site and day, mean quantity, discount, tax and
day of year are the predictors of the day's mean price; years 1995-2001
give the folds, 2000-2001 the hold-out.  Fits run at the full settings: 645
rounds of depth 10, ended by the hold-out error, and a search of 100 trials
over the whole space.  What a model predicts has no SQL; the ``_rows`` queries
hold keys, observations, summaries and checked properties against SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.ml import explain as EX
from stationcast.ml import folds as FO
from stationcast.ml import scoring as SC
from stationcast.ml.boosting import QuantileGBT, QuantileGBTModel, pinball
from stationcast.ml.fanout import fit_per_key
from stationcast.ml.search import SPACE, best_model, param_search
from stationcast.operators import climatology as C
from stationcast.operators.common import cut_lineage, stage_path
from stationcast.plans import standins as S
from stationcast.plans.registry import register

FEATURES = ["qty", "disc", "tax", "doy"]
TEST_YEARS = [2000, 2001]
# Settings of the fits.
GBT = dict(max_depth=10, learning_rate=0.067, n_estimators=645, subsample=0.29, colsample=0.56, early_stopping=50)
ALPHA = 0.95
FRAME_SQL = """WITH mf AS (SELECT l_orderkey % 3 AS site, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS qty, avg(l_extendedprice) AS price
  FROM lineitem GROUP BY 1, 2), t AS (SELECT *, year(date) IN (2000, 2001) AS is_test FROM mf)
"""


def model_frame(spark, d):
    li = S.read_table(spark, d, "lineitem")
    g = li.groupBy((F.col("l_orderkey") % 3).alias("site"), F.to_date("l_shipdate").alias("date")).agg(
        F.avg("l_quantity").alias("qty"), F.avg("l_discount").alias("disc"), F.avg("l_tax").alias("tax"),
        F.avg("l_extendedprice").alias("price"))
    return g.withColumn("doy", F.dayofyear("date").cast("double"))


def _split(spark, d):
    return FO.split_years(model_frame(spark, d), TEST_YEARS)


def _fit(spark, d, **kw):
    df = _split(spark, d)
    params = {**GBT, **kw}
    return QuantileGBT(FEATURES, "price", alpha=ALPHA, **params).fit(df.filter(~F.col("is_test")),
                                                                    df.filter(F.col("is_test")))


@register("m1_split_years", """
SELECT site, date, year(date) IN (2000, 2001) AS is_test
FROM (SELECT DISTINCT l_orderkey % 3 AS site, CAST(l_shipdate AS DATE) AS date FROM lineitem)""")
def m1_split_years(spark, d):
    return _split(spark, d).select("site", "date", "is_test")


@register("m2_year_folds", """
SELECT site, year, CAST((row_number() OVER (PARTITION BY site ORDER BY (year * 2654435761 + 42) % 4294967296, year) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT DISTINCT l_orderkey % 3 AS site, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)""")
def m2_year_folds(spark, d):
    return FO.year_folds(model_frame(spark, d), k=5, seed=42, keys=["site"])


@register("m3_best_split")
def m3_best_split(spark, d):
    mf = model_frame(spark, d)
    folds = FO.year_folds(mf, k=5, seed=42)
    return FO.best_split(FO.with_folds(mf, folds), FEATURES, "price").select("fold", "rmse", "mae", "rounds", "n_test", "train_years", "test_years", "best")


@register("m3_split_rows", """
WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem),
f AS (SELECT year, CAST((row_number() OVER (ORDER BY (year * 2654435761 + 42) % 4294967296, year) - 1) % 5 AS INTEGER) AS fold FROM y),
d AS (SELECT DISTINCT l_orderkey % 3 AS site, CAST(l_shipdate AS DATE) AS date FROM lineitem)
SELECT f.fold, count(*) AS n_test, (SELECT string_agg(CAST(g.year AS VARCHAR), ',' ORDER BY g.year) FROM f g WHERE g.fold = f.fold) AS test_years,
  (SELECT string_agg(CAST(g.year AS VARCHAR), ',' ORDER BY g.year) FROM f g WHERE g.fold <> f.fold) AS train_years, true AS scored
FROM d JOIN f ON f.year = year(d.date) GROUP BY f.fold""")
def m3_split_rows(spark, d):
    out = m3_best_split(spark, d)
    years = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return out.select("fold", "n_test", years("test_years"), years("train_years"), (F.col("rmse") > 0).alias("scored"))


@register("m4_quantile_gbt")
def m4_quantile_gbt(spark, d):
    model = _fit(spark, d)
    test = _split(spark, d).filter(F.col("is_test"))
    return SC.score_batch(model, test, observed="price")


@register("m4_quantile_rows", FRAME_SQL + """
SELECT count(*) AS n_train, 645 AS rounds, true AS coverage_within, true AS loss_below_constant FROM t WHERE NOT is_test""")
def m4_quantile_rows(spark, d):
    """All 645 rounds of depth 10, none ended early: on the training rows the share
    below the predicted quantile is within 0.05 of it, and the loss is below that
    of the constant quantile."""
    train = _split(spark, d).filter(~F.col("is_test"))
    model = QuantileGBT(FEATURES, "price", alpha=ALPHA, **{**GBT, "early_stopping": 0, "subsample": 1.0, "colsample": 1.0}).fit(train)
    scored = model.transform(train.select(*FEATURES, "price"), "q")
    loss = lambda q: F.avg(pinball(F.col("price"), q, ALPHA))
    m = scored.agg(F.count("*").alias("n_train"), F.avg((F.col("price") <= F.col("q")).cast("double")).alias("coverage"), loss(F.col("q")).alias("loss"), loss(F.lit(model.base)).alias("constant"))
    return m.select("n_train", F.lit(len(model.trees)).alias("rounds"), (F.abs(F.col("coverage") - ALPHA) <= 0.05).alias("coverage_within"), (F.col("loss") < F.col("constant")).alias("loss_below_constant"))


def _search(spark, d):
    df = _split(spark, d)
    return param_search(df.filter(~F.col("is_test")), df.filter(F.col("is_test")), FEATURES, "price", ALPHA, n_trials=100)


@register("m5_param_search")
def m5_param_search(spark, d):
    return _search(spark, d)


@register("m5_search_rows", "SELECT 100 AS trials, true AS in_space, true AS best_ran_on, true AS model_is_best")
def m5_search_rows(spark, d):
    """The search, and the fit that takes over its best trial: the model's hold-out error is the trial's."""
    df, trials = _split(spark, d), cut_lineage(_search(spark, d))
    train, test = df.filter(~F.col("is_test")), df.filter(F.col("is_test"))
    model = best_model(trials, train, FEATURES, "price", test)
    error = min(e for _, e in model.history)
    inside = F.lit(True)
    for name, column in (("max_depth", "max_depth"), ("subsample", "subsample"), ("learning_rate", "learning_rate"), ("colsample", "colsample_bytree"), ("n_estimators", "n_estimators")):
        inside = inside & F.col(column).between(*SPACE[name])
    first = F.min(F.struct(F.coalesce("best_mae", F.lit(float("inf"))), "trial", "boosted", "n_estimators", "best_mae"))
    return trials.agg(F.count("*").cast("int").alias("trials"), F.bool_and(inside).alias("in_space"), first.alias("b")).select(
        "trials", "in_space", (F.col("b.boosted") == F.col("b.n_estimators")).alias("best_ran_on"), (F.abs(F.col("b.best_mae") - F.lit(error)) < 1e-9 * F.lit(error)).alias("model_is_best"))


@register("m6_score_batch")
def m6_score_batch(spark, d):
    model = _fit(spark, d)
    test = _split(spark, d).filter(F.col("is_test")).withColumn("unused", F.lit(1.0))
    return SC.score_batch(model, test, observed="price")


@register("m6_scored_rows", FRAME_SQL + "SELECT site, CAST(date AS VARCHAR) AS date, " + S.r("price", 4) + " AS observed, true AS predicted FROM t WHERE is_test")
def m6_scored_rows(spark, d):
    return m6_score_batch(spark, d).select("site", F.col("date").cast("string").alias("date"), rnd("observed", 4).alias("observed"), F.col("predicted").isNotNull().alias("predicted"))


@register("m7_score_scenario")
def m7_score_scenario(spark, d):
    mf = model_frame(spark, d)
    st = C.monthly_stats(mf, ["qty"])
    train = (mf.withColumns({"year": F.year("date"), "month": F.month("date")})
             .join(st, ["site", "year", "month"]).filter(~F.col("year").isin(TEST_YEARS)).drop("year", "month"))
    feats = FEATURES + ["qty_mean", "qty_max", "qty_min"]
    model = QuantileGBT(feats, "price", alpha=ALPHA, **GBT).fit(train)
    # written to and read from shared storage between fit and scoring, as two jobs would
    model = QuantileGBTModel.load(spark, model.save(spark, stage_path(spark, "model")))
    return SC.score_scenario(model, mf, "qty", clamp_zero=True, predictand="price", observed="price")


@register("m7_scored_rows", FRAME_SQL + ", st AS (SELECT site, year(date) AS y, month(date) AS m, avg(qty) AS a, max(qty) AS b, min(qty) AS c FROM mf GROUP BY 1, 2, 3)\n"
          + "SELECT site, CAST(date AS VARCHAR) AS date, " + S.r("price", 4) + " AS observed, true AS clamped, " + S.r("a", 6) + " AS price_mean, "
          + S.r("b", 6) + " AS price_max, " + S.r("c", 6) + " AS price_min FROM mf JOIN st USING (site) WHERE y = year(date) AND m = month(date)")
def m7_scored_rows(spark, d):
    out = m7_score_scenario(spark, d)
    return out.select("site", F.col("date").cast("string").alias("date"), rnd("observed", 4).alias("observed"), (F.col("predicted") >= 0).alias("clamped"),
                      *[rnd(f"price_{x}", 6).alias(f"price_{x}") for x in ("mean", "max", "min")])


@register("m8_scenario_transfer")
def m8_scenario_transfer(spark, d):
    mf = model_frame(spark, d).withColumn("scenario", F.when(F.col("site") == 0, "rcp45").otherwise("rcp85"))
    return SC.fit_on_score_on(mf, mf, FEATURES, "price", "scenario", "rcp45", "rcp85", **GBT)


@register("m8_scored_rows", FRAME_SQL + "SELECT site, CAST(date AS VARCHAR) AS date, " + S.r("price", 4) + " AS observed, true AS predicted FROM t WHERE site <> 0")
def m8_scored_rows(spark, d):
    return m8_scenario_transfer(spark, d).select("site", F.col("date").cast("string").alias("date"), rnd("observed", 4).alias("observed"), F.col("predicted").isNotNull().alias("predicted"))


@register("m9_gain_importance")
def m9_gain_importance(spark, d):
    return EX.gain_importance(_fit(spark, d))


@register("m9_importance_rows", "SELECT 4 AS features, true AS sum_is_one, true AS all_used")
def m9_importance_rows(spark, d):
    out = EX.gain_importance(_fit(spark, d))
    return out.agg(F.count("*").cast("int").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sum_is_one"), (F.min("importance") > 0).alias("all_used"))


def _explained(spark, d):
    model = _fit(spark, d)
    test = _split(spark, d).filter(F.col("is_test")).withColumn("row_id", F.concat_ws(":", "site", "date"))
    return model, test, EX.attribution(model, test, "row_id")


@register("m10_attribution")
def m10_attribution(spark, d):
    return EX.mean_abs_attribution(_explained(spark, d)[2])


@register("m10_attribution_rows", FRAME_SQL + "SELECT CAST(site AS VARCHAR) || ':' || CAST(date AS VARCHAR) AS row_id, 4 AS features, true AS sums_to_prediction FROM t WHERE is_test")
def m10_attribution_rows(spark, d):
    """Every row's attributions sum to its prediction less the expectation."""
    model, test, attr = _explained(spark, d)
    sums = attr.groupBy("row_id").agg(F.count("*").cast("int").alias("features"), F.sum("attribution").alias("s"))
    gap = F.abs(F.col("s") + F.lit(EX.expectation(model)) - F.col("p"))
    return sums.join(model.transform(test, "p").select("row_id", "p"), "row_id").select("row_id", "features", (gap < 1e-6 * (1 + F.abs("p"))).alias("sums_to_prediction"))


_ATTR_SQL = """WITH attr AS (SELECT l_orderkey AS row_id, l_returnflag || '-' || CAST(l_linenumber AS VARCHAR) AS feature,
  l_quantity AS value, l_tax - 0.04 AS attribution FROM lineitem),
a AS (SELECT *, CASE WHEN l_ln BETWEEN 1 AND 4 THEN CAST(l_ln AS VARCHAR) ELSE 'Other' END AS point,
  CASE WHEN l_ln BETWEEN 1 AND 4 THEN split_part(feature, '-', 1) ELSE feature END AS variable
  FROM (SELECT *, CAST(split_part(feature, '-', 2) AS INTEGER) AS l_ln FROM attr))
"""


def attr_standin(spark, d):
    li = S.read_table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("row_id"),
                     F.concat("l_returnflag", F.lit("-"), F.col("l_linenumber").cast("string")).alias("feature"),
                     F.col("l_quantity").alias("value"), (F.col("l_tax") - 0.04).alias("attribution"))


@register("m11_rollup_by_point", _ATTR_SQL + """,
pf AS (SELECT point, feature, avg(abs(attribution)) AS ma, avg(value) AS mv FROM a GROUP BY 1, 2)
SELECT point, """ + S.r("sum(ma)", 9) + " AS mean_abs, " + S.r("avg(mv)", 9) + """ AS mean_value FROM pf WHERE point <> 'Other' GROUP BY 1""")
def m11_rollup_by_point(spark, d):
    per_point, _ = EX.rollup_by_point(attr_standin(spark, d))
    return per_point.select("point", rnd("mean_abs", 9).alias("mean_abs"), rnd("mean_value", 9).alias("mean_value"))


@register("m11_rollup_rows", _ATTR_SQL + """
SELECT row_id, point, """ + S.r("sum(attribution)", 9) + """ AS attribution FROM a WHERE point <> 'Other' GROUP BY 1, 2""")
def m11_rollup_rows(spark, d):
    _, per_row = EX.rollup_by_point(attr_standin(spark, d))
    return per_row.withColumn("attribution", rnd("attribution", 9))


@register("m12_rollup_by_variable", _ATTR_SQL + """,
pf AS (SELECT variable, feature, avg(abs(attribution)) AS ma FROM a GROUP BY 1, 2)
SELECT variable, """ + S.r("sum(ma)", 9) + """ AS mean_abs FROM pf GROUP BY 1 ORDER BY mean_abs DESC, variable LIMIT 20""")
def m12_rollup_by_variable(spark, d):
    out = EX.rollup_by_variable(attr_standin(spark, d), 20)
    return out.withColumn("mean_abs", rnd("mean_abs", 9))


@register("m13_fit_per_key")
def m13_fit_per_key(spark, d):
    return fit_per_key(_split(spark, d), ["site"], FEATURES, "price", **GBT)


@register("m13_fit_rows", FRAME_SQL + """, k AS (SELECT site, month(date) AS month, is_test FROM t)
SELECT site, month, CAST(count(*) FILTER (WHERE NOT is_test) AS BIGINT) AS n_train, true AS fitted, count(*) FILTER (WHERE is_test) > 0 AS scored FROM k GROUP BY 1, 2""")
def m13_fit_rows(spark, d):
    """A model for every site and month, all in one set of jobs."""
    data = _split(spark, d).withColumn("month", F.month("date").cast("long"))
    out = fit_per_key(data, ["site", "month"], FEATURES, "price", **GBT)
    return out.select("site", "month", "n_train", (F.col("rounds") > 0).alias("fitted"), F.col("pinball").isNotNull().alias("scored"))
