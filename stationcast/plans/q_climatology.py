"""Catalogue: daily wind, monthly statistics, climatologies, delta change."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import climatology as C
from stationcast.operators import frames as FR
from stationcast.plans import standins as S
from stationcast.plans.registry import register

CUT = S.CUTOFF

_DAILY_SQL = S.with_sql("grid", "pred") + """,
ps AS (SELECT site, date, coalesce(sum(price), 0) / 4 AS price_sum FROM grid GROUP BY 1, 2),
daily AS (SELECT ps.site, ps.date, ps.price_sum, p.obs FROM ps LEFT JOIN pred p USING (site, date))
"""


def daily_training(spark, d):
    """(site, date, price_sum, obs): four-point mean of the predictor and the predictand."""
    ps = FR.point_mean(S.grid(spark, d), "price")
    return ps.join(S.pred(spark, d), ["site", "date"], "left")


def _r_all(df, keys):
    return df.select(*keys, *[rnd(c).alias(c) for c in df.columns if c not in keys])


def _stat_sql(col):
    return ", ".join(f"{S.r(f'{fn}({col})')} AS {col}_{s}" for s, fn in (("mean", "avg"), ("min", "min"), ("max", "max")))


_UV_U, _UV_V = "l_discount * 100 - 5", "l_tax * 100 - 4"


@register("a2_daily_wind", f"""
WITH m AS (SELECT l_linenumber AS point, CAST(l_shipdate AS DATE) AS date, avg({_UV_U}) AS u, avg({_UV_V}) AS v
           FROM lineitem GROUP BY 1, 2)
SELECT point, date, {S.r('u')} AS u, {S.r('v')} AS v, {S.r('sqrt(u * u + v * v)')} AS wind_speed FROM m""")
def a2_daily_wind(spark, d):
    li = S.read_table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("point"), F.col("l_shipdate").alias("time"),
        (F.col("l_discount") * 100 - 5).alias("u"), (F.col("l_tax") * 100 - 4).alias("v"))
    return _r_all(C.daily_wind(li, ["point"]), ["point", "date"])


@register("a3_monthly_stats", _DAILY_SQL + """
SELECT site, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, """
          + _stat_sql("price_sum") + ", " + _stat_sql("obs") + " FROM daily GROUP BY 1, 2, 3")
def a3_monthly_stats(spark, d):
    return _r_all(C.monthly_stats(daily_training(spark, d), ["price_sum", "obs"]), ["site", "year", "month"])


@register("a4_month_climatology", _DAILY_SQL + """
SELECT site, CAST(month(date) AS INTEGER) AS month, """ + _stat_sql("obs")
          + f" FROM daily WHERE date <= DATE '{CUT}' GROUP BY 1, 2")
def a4_month_climatology(spark, d):
    return _r_all(C.month_climatology(daily_training(spark, d), ["obs"], until=CUT), ["site", "month"])


_CLIM_SQL = _DAILY_SQL + """,
ym AS (SELECT site, year(date) AS y, month(date) AS m, avg(obs) AS obs_mean, max(obs) AS obs_max, min(obs) AS obs_min
       FROM daily GROUP BY 1, 2, 3),
j AS (SELECT d.site, month(d.date) AS m, ym.obs_mean, ym.obs_max, ym.obs_min FROM daily d
      JOIN ym ON d.site = ym.site AND year(d.date) = ym.y AND month(d.date) = ym.m),
clim AS (SELECT site, CAST(m AS INTEGER) AS month, avg(obs_mean) AS obs_mean_climatology,
         avg(obs_max) AS obs_max_climatology, avg(obs_min) AS obs_min_climatology FROM j GROUP BY 1, 2)
"""


@register("a5_stat_climatology", _CLIM_SQL + "SELECT site, month, " + ", ".join(
    f"{S.r(f'obs_{s}_climatology')} AS obs_{s}_climatology" for s in ("mean", "max", "min")) + " FROM clim")
def a5_stat_climatology(spark, d):
    return _r_all(C.stat_climatology(daily_training(spark, d), "obs"), ["site", "month"])


@register("a6_climatology_for_year", _CLIM_SQL + """
SELECT x.site, x.date, """ + ", ".join(f"{S.r(f'c.obs_{s}_climatology')} AS obs_{s}_climatology" for s in ("mean", "max", "min"))
          + """ FROM (SELECT DISTINCT site, date FROM daily WHERE year(date) = 2000) x
LEFT JOIN clim c ON c.site = x.site AND c.month = month(x.date)""")
def a6_climatology_for_year(spark, d):
    daily = daily_training(spark, d)
    out = C.climatology_for_year(daily, C.stat_climatology(daily, "obs"), 2000)
    return _r_all(out, ["site", "date"])


@register("a7_diff_features", _DAILY_SQL + """,
st AS (SELECT site, year(date) AS year, month(date) AS month, avg(price_sum) AS psm, min(price_sum) AS psn,
       max(price_sum) AS psx, avg(obs) AS om, min(obs) AS onn, max(obs) AS ox FROM daily GROUP BY 1, 2, 3)
SELECT site, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, """ + S.r("psm - om") + """ AS price_obs_diff_mean,
  """ + S.r("psn - onn") + """ AS price_obs_diff_min, """ + S.r("psx - ox") + """ AS price_obs_diff_max FROM st""")
def a7_diff_features(spark, d):
    st = C.monthly_stats(daily_training(spark, d), ["price_sum", "obs"])
    out = C.diff_features(st, "price", "obs")
    return _r_all(out.select("site", "year", "month", "price_obs_diff_mean", "price_obs_diff_min",
                             "price_obs_diff_max"), ["site", "year", "month"])


@register("a8_fill_future", _DAILY_SQL + f""",
cl AS (SELECT site, month(date) AS m, avg(obs) AS mn, min(obs) AS mi, max(obs) AS mx FROM daily
       WHERE date <= DATE '{CUT}' GROUP BY 1, 2)
SELECT d.site, d.date, {S.r('cl.mn')} AS obs_mean, {S.r('cl.mi')} AS obs_min, {S.r('cl.mx')} AS obs_max
FROM daily d LEFT JOIN cl ON cl.site = d.site AND cl.m = month(d.date) WHERE d.date > DATE '{CUT}'""")
def a8_fill_future(spark, d):
    daily = daily_training(spark, d)
    clim = C.month_climatology(daily, ["obs"], until=CUT)
    out = C.fill_future(daily, clim, "obs", CUT)
    return _r_all(out.select("site", "date", "obs_mean", "obs_min", "obs_max"), ["site", "date"])


@register("a9_delta_change", _DAILY_SQL + f""",
dd AS (SELECT *, year(date) AS y, month(date) AS m, date <= DATE '{CUT}' AS past FROM daily),
ym AS (SELECT site, y, m, past, count(*) AS days,
       avg(price_sum) AS v_mean, min(price_sum) AS v_min, max(price_sum) AS v_max,
       avg(obs) AS p_mean, min(obs) AS p_min, max(obs) AS p_max FROM dd GROUP BY 1, 2, 3, 4),
cl AS (SELECT site, m, avg(obs) AS c_mean, min(obs) AS c_min, max(obs) AS c_max FROM dd WHERE past GROUP BY 1, 2),
pd AS (SELECT site, m,
       sum((v_mean - p_mean) * days) / sum(CASE WHEN v_mean - p_mean IS NOT NULL THEN days END) AS dp_mean,
       sum((v_min - p_min) * days) / sum(CASE WHEN v_min - p_min IS NOT NULL THEN days END) AS dp_min,
       sum((v_max - p_max) * days) / sum(CASE WHEN v_max - p_max IS NOT NULL THEN days END) AS dp_max
       FROM ym WHERE past GROUP BY 1, 2),
proj AS (SELECT ym.site, ym.y, ym.m, ym.past,
  CASE WHEN ym.past THEN p_mean ELSE c_mean + v_mean - dp_mean END AS obs_mean,
  CASE WHEN ym.past THEN p_min ELSE c_min + v_min - dp_min END AS obs_min,
  CASE WHEN ym.past THEN p_max ELSE c_max + v_max - dp_max END AS obs_max
  FROM ym LEFT JOIN cl USING (site, m) LEFT JOIN pd USING (site, m))
SELECT dd.site, dd.date, {S.r('obs_mean')} AS obs_mean, {S.r('obs_min')} AS obs_min, {S.r('obs_max')} AS obs_max
FROM dd LEFT JOIN proj USING (site, y, m, past)""")
def a9_delta_change(spark, d):
    out = C.delta_change(daily_training(spark, d), "price_sum", "obs", CUT)
    return out.select("site", "date", *[rnd(c).alias(c) for c in ("obs_mean", "obs_min", "obs_max")])
