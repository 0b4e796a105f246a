"""Catalogue: station daily aggregation and ensemble risk (A1, A13-A15,
A19, A21, P18, P26, R6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import member_band, rnd
from stationcast.operators import climatology as C
from stationcast.operators import ensemble as E
from stationcast.plans import standins as S
from stationcast.plans.registry import register

THRESHOLD = 60.0     # exceedance threshold on the daily member value
PROB = 50.0          # probability threshold in %

_EXC_SQL = S.with_sql("ens") + """,
nm AS (SELECT site, count(DISTINCT member) AS n_members FROM ens GROUP BY site),
exc AS (SELECT e.site, e.date, 100.0 * count_if(e.value > 60.0) / nm.n_members AS pct
        FROM ens e JOIN nm USING (site) GROUP BY e.site, e.date, nm.n_members)
"""


def risk_frame(spark, d):
    return E.exceedance(S.ens(spark, d), THRESHOLD, "above")


@register("a1_daily_agg", S.with_sql("subdaily") + """
SELECT site, CAST(time AS DATE) AS date,
  coalesce(max(WG_PT1H_MAX), max(WG_PT10M_MAX)) AS WG,
  min(TA_PT12H_MIN) AS TN, max(TA_PT12H_MAX) AS TX,
  """ + S.r("coalesce(sum(PRA_PT12H_ACC), 0.0)") + """ AS TP,
  """ + S.r("avg(RH_PT1H_AVG)") + """ AS RH
FROM subdaily GROUP BY 1, 2""")
def a1_daily_agg(spark, d):
    out = C.daily_agg(S.subdaily(spark, d), empty_sum="zero")
    return out.withColumns({"TP": rnd("TP", 6), "RH": rnd("RH", 6)})


@register("a13_exceedance", _EXC_SQL + "SELECT site, date, " + S.r("pct") + " AS pct FROM exc")
def a13_exceedance(spark, d):
    return risk_frame(spark, d).withColumn("pct", rnd("pct", 6))


@register("a13_exceedance_below", S.with_sql("ens") + """,
nm AS (SELECT site, count(DISTINCT member) AS n_members FROM ens GROUP BY site)
SELECT e.site, e.date, """ + S.r("100.0 * count_if(e.value < 20.0) / nm.n_members") + """ AS pct
FROM ens e JOIN nm USING (site) GROUP BY e.site, e.date, nm.n_members""")
def a13_exceedance_below(spark, d):
    """Share of members below a threshold (minimum-temperature style risk)."""
    return E.exceedance(S.ens(spark, d), 20.0, "below").withColumn("pct", rnd("pct"))


@register("a14_monthly_risk", _EXC_SQL + """
SELECT site, strftime(date, '%Y-%m') AS month,
  CAST(count_if(pct > 50.0) AS BIGINT) AS days_over, count(*) AS total_days,
  round_even(100.0 * count_if(pct > 50.0) / count(*), 1) AS percentage
FROM exc GROUP BY 1, 2""")
def a14_monthly_risk(spark, d):
    return E.monthly_risk(risk_frame(spark, d), PROB)


@register("a15_risk_days", _EXC_SQL + """
SELECT site, date, """ + S.r("pct") + """ AS pct FROM exc WHERE pct > 50.0 ORDER BY site, date""")
def a15_risk_days(spark, d):
    return E.risk_days(risk_frame(spark, d), PROB).withColumn("pct", rnd("pct", 6))


@register("p18_ensemble_mean", S.with_sql("ens") + """
SELECT site, date, """ + S.r("avg(value)", 9) + """ AS ensemble_mean FROM ens GROUP BY 1, 2""")
def p18_ensemble_mean(spark, d):
    return E.ensemble_mean(S.ens(spark, d)).withColumn("ensemble_mean", rnd("ensemble_mean", 9))


@register("p26_member_band", S.with_sql("ens") + """
SELECT CASE WHEN member = 0 THEN '0' ELSE
  CAST((member - 1) // 10 * 10 + 1 AS VARCHAR) || '-' || CAST((member - 1) // 10 * 10 + 10 AS VARCHAR) END AS band,
  count(DISTINCT member) AS members, """ + S.r("avg(value)", 9) + """ AS mean_value
FROM ens GROUP BY 1""")
def p26_member_band(spark, d):
    e = S.ens(spark, d).withColumn("band", member_band("member"))
    return e.groupBy("band").agg(F.countDistinct("member").alias("members"),
                                 rnd(F.avg("value"), 9).alias("mean_value"))


_DAYS = [f"2024-01-{i:02d}" for i in range(1, 31)]


@register("r6_member_matrix", S.with_sql("ens") + "SELECT site, member, " + ", ".join(
    S.r(f"avg(CASE WHEN date = DATE '{x}' THEN value END)") + f" AS \"{x}\"" for x in _DAYS)
    + " FROM ens GROUP BY 1, 2")
def r6_member_matrix(spark, d):
    e = S.ens(spark, d).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    m = E.member_matrix(e, _DAYS)
    return m.select("site", "member", *[rnd(F.col(f"`{x}`"), 6).alias(x) for x in _DAYS])


@register("a19_scale_bias", S.with_sql("ens") + """,
mm AS (SELECT site, member, avg(value) AS m FROM ens GROUP BY 1, 2),
em AS (SELECT site, avg(m) AS ens_mean FROM mm GROUP BY 1),
obs AS (SELECT user_id % 4 AS site, avg(value) AS obs_mean FROM events GROUP BY 1),
f AS (SELECT em.site, CASE WHEN ens_mean = 0 THEN 1.0 ELSE obs_mean / ens_mean END AS factor
      FROM em LEFT JOIN obs USING (site))
SELECT e.site, e.member, e.date, """ + S.r("e.value * f.factor") + """ AS corrected, """ + S.r("f.factor", 9) + """ AS factor
FROM ens e LEFT JOIN f USING (site)""")
def a19_scale_bias(spark, d):
    ev = S.read_table(spark, d, "events")
    obs = ev.select((F.col("user_id") % S.EVENT_SITES).alias("site"), "value")
    out = E.scale_bias(S.ens(spark, d), obs)
    return out.select("site", "member", "date", rnd("corrected", 6).alias("corrected"),
                      rnd("factor", 9).alias("factor"))


@register("a21_kde", S.with_sql("ens") + """,
v AS (SELECT site, member, value AS x0 FROM ens WHERE value IS NOT NULL),
st AS (SELECT site, member, count(x0) AS n, stddev_samp(x0) * pow(count(x0), -0.2) AS h,
              min(x0) AS lo, max(x0) AS hi FROM v GROUP BY 1, 2),
g AS (SELECT site, member, n, h, CAST(i AS INTEGER) AS grid_idx,
             lo - 3.0 * h + i * ((hi - lo + 6.0 * h) / 49) AS x
      FROM st, range(0, 50) t(i) WHERE n > 1 AND h > 0)
SELECT g.site, g.member, g.grid_idx, """ + S.r("g.x") + """ AS x,
       """ + S.r("sum(exp(-0.5 * ((g.x - v.x0) / g.h) * ((g.x - v.x0) / g.h))) / (g.n * g.h * sqrt(2 * pi()))", 9) + """ AS density
FROM v JOIN g USING (site, member) GROUP BY g.site, g.member, g.grid_idx, g.x, g.n, g.h""")
def a21_kde(spark, d):
    k = E.kde(S.ens(spark, d), ["site", "member"], gridsize=50)
    return k.select("site", "member", "grid_idx", rnd("x", 6).alias("x"),
                    rnd("density", 9).alias("density"))


@register("a21_kde_binned", S.with_sql("ens") + """,
v AS (SELECT site, member, value AS x0 FROM ens WHERE value IS NOT NULL),
st AS (SELECT site, member, count(x0) AS n, stddev_samp(x0) * pow(count(x0), -0.2) AS h,
              min(x0) AS lo, max(x0) AS hi FROM v GROUP BY 1, 2),
g AS (SELECT *, lo - 3.0 * h AS f, (hi - lo + 6.0 * h) / 49 AS step FROM st WHERE n > 1 AND h > 0),
p AS (SELECT g.*, (x0 - f) / step AS a, least(floor((x0 - f) / step), 48) AS i FROM v JOIN g USING (site, member)),
w AS (SELECT site, member, i, sum(w) AS w FROM (
        SELECT site, member, i, 1 - (a - i) AS w FROM p UNION ALL SELECT site, member, i + 1, a - i FROM p) GROUP BY 1, 2, 3),
e AS (SELECT g.site, g.member, CAST(j AS INTEGER) AS grid_idx, any_value(f + j * step) AS x,
             sum(w.w * exp(-0.5 * pow((j - w.i) * step / h, 2))) / any_value(n * h * sqrt(2 * pi())) AS density
      FROM g JOIN w USING (site, member), range(0, 50) t(j) GROUP BY 1, 2, 3
      UNION ALL SELECT site, member, NULL, lo, NULL FROM st WHERE NOT coalesce(n > 1 AND h > 0, false))
SELECT site, member, grid_idx, """ + S.r("x") + """ AS x, """ + S.r("density", 9) + """ AS density FROM e""")
def a21_kde_binned(spark, d):
    k = E.kde_binned(S.ens(spark, d), ["site", "member"], gridsize=50)
    return k.select("site", "member", "grid_idx", rnd("x", 6).alias("x"),
                    rnd("density", 9).alias("density"))
