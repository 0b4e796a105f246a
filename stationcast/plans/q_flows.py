"""Catalogue: end-to-end flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.plans import flows as FL
from stationcast.plans import standins as S
from stationcast.plans.q_models import FEATURES, GBT, TEST_YEARS, model_frame
from stationcast.plans.registry import register

_FEED_MAP = {"WG_PT1H_MAX": "WG", "WG_PT10M_MAX": "WG", "TA_PT12H_MIN": "TN", "TA_PT12H_MAX": "TX",
             "PRA_PT12H_ACC": "TP"}


@register("f1_station_daily", S.with_sql("subdaily", "sites") + """,
d AS (SELECT site, CAST(time AS DATE) AS date, coalesce(max(WG_PT1H_MAX), max(WG_PT10M_MAX)) AS WG,
      min(TA_PT12H_MIN) AS TN, max(TA_PT12H_MAX) AS TX, coalesce(sum(PRA_PT12H_ACC), 0.0) AS TP
      FROM subdaily GROUP BY 1, 2),
b AS (SELECT site, greatest(min(date), DATE '2024-01-03') AS lo, max(date) AS hi FROM d GROUP BY 1),
sp AS (SELECT site, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT sp.site, sp.date AS utctime, s.latitude, s.longitude, s.name,
  round_even(d.WG * 1e2, 0) / 1e2 AS WG_PT24H_MAX, round_even(d.TX * 1e2, 0) / 1e2 AS TA_PT24H_MAX,
  round_even(d.TN * 1e2, 0) / 1e2 AS TA_PT24H_MIN, round_even(d.TP * 1e2, 0) / 1e2 AS TP_PT24H_ACC
FROM sp LEFT JOIN d USING (site, date) LEFT JOIN sites s ON s.site = sp.site""")
def f1_station_daily(spark, d):
    sites = S.sites(spark, d).withColumn("site", F.col("site").cast("bigint"))
    return FL.station_daily(S.subdaily(spark, d), sites, start="2024-01-03", mapping=_FEED_MAP)


_F2_COLS = ["price_sum", "qty-1", "obs", "obs_mean", "price_obs_diff_mean", "obs_mean_climatology"]


@register("f2_reanalysis_table", S.with_sql("grid", "pred") + """,
ps AS (SELECT site, date, sum(price) / 4 AS price_sum FROM grid GROUP BY 1, 2),
q AS (SELECT site, CAST(date + 1 AS DATE) AS date, max(CASE WHEN point = 1 THEN qty END) AS q1 FROM grid GROUP BY 1, 2),
t AS (SELECT p.site, p.date, p.obs, coalesce(ps.price_sum, 0) AS price_sum, q.q1, year(p.date) AS y, month(p.date) AS m
      FROM pred p LEFT JOIN ps USING (site, date) LEFT JOIN q USING (site, date)),
st AS (SELECT site, y, m, avg(price_sum) AS pm, avg(obs) AS om, count(*) AS days FROM t GROUP BY 1, 2, 3),
c AS (SELECT site, m, sum(om * days) / sum(CASE WHEN om IS NOT NULL THEN days END) AS oc FROM st GROUP BY 1, 2)
SELECT t.site, t.date, """ + S.r("t.obs", 4) + " AS obs, " + S.r("t.price_sum", 4) + " AS price_sum, " + S.r("t.q1", 4) + ' AS "qty-1", '
          + S.r("st.om", 4) + " AS obs_mean, " + S.r("st.pm - st.om", 4) + " AS price_obs_diff_mean, " + S.r("c.oc", 4) + """ AS obs_mean_climatology
FROM t JOIN st USING (site, y, m) JOIN c USING (site, m)""")
def f2_reanalysis_table(spark, d):
    g = S.grid(spark, d).unpivot(["site", "date", "point"], ["price", "qty"], "variable", "value")
    t = FL.reanalysis_table(S.pred(spark, d), g, ["price", "qty"], "obs", "price", lag=["qty"])
    return t.select("site", "date", *[rnd(F.col(f"`{c}`"), 4).alias(c) for c in _F2_COLS])


@register("f3_fit_and_evaluate")
def f3_fit_and_evaluate(spark, d):
    mf = model_frame(spark, d)
    _, _, scores = FL.fit_and_evaluate(mf, FEATURES, "price", 0.95, TEST_YEARS, **GBT)
    return scores


@register("f4_scenario_tables", S.with_sql("grid", "pred") + """,
t AS (SELECT g.site, g.date, g.price_sum, p.obs, year(g.date) AS y, month(g.date) AS m
      FROM (SELECT site, date, coalesce(sum(price), 0) / 4 AS price_sum FROM grid GROUP BY 1, 2) g LEFT JOIN pred p USING (site, date)
      WHERE g.date >= DATE '1996-01-01'),
v AS (SELECT site, y, m, avg(price_sum) AS pm FROM t GROUP BY 1, 2, 3),
o AS (SELECT site, m, avg(obs) AS om FROM t WHERE date <= DATE '""" + S.CUTOFF + """' GROUP BY 1, 2)
SELECT t.site, t.date, """ + S.r("t.price_sum", 4) + " AS price_sum, " + S.r("v.pm", 4) + " AS price_sum_mean, " + S.r("o.om", 4)
          + " AS obs_mean, " + S.r("v.pm - o.om", 4) + """ AS price_obs_diff_mean
FROM t JOIN v USING (site, y, m) LEFT JOIN o USING (site, m)""")
def f4_scenario_tables(spark, d):
    g = S.grid(spark, d)
    wide = g.groupBy("site", "date").agg(*[F.max(F.when(F.col("point") == i, F.col("price"))).alias(f"price-{i}")
                                           for i in range(1, 5)])
    wide = wide.join(S.pred(spark, d), ["site", "date"], "left")
    train, pred = FL.scenario_tables(wide, "obs", "price", ("1996-01-01", S.CUTOFF))
    return pred.select("site", "date", *[rnd(c, 4).alias(c) for c in ("price_sum", "price_sum_mean", "obs_mean", "price_obs_diff_mean")])
