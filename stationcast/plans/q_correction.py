"""Catalogue: quantile mapping, polynomial correction and its skill."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import correction as K
from stationcast.plans import standins as S
from stationcast.plans.registry import register


def control(spark, d):
    """Control series: daily mean quantity, one key per year."""
    li = S.read_table(spark, d, "lineitem")
    return li.groupBy(F.year("l_shipdate").alias("site"), F.to_date("l_shipdate").alias("date")).agg(
        F.avg("l_quantity").alias("value"))


def historical(spark, d):
    """Historical series: daily mean order price, one key per year."""
    o = S.read_table(spark, d, "orders")
    return o.groupBy(F.year("o_orderdate").alias("site"), F.to_date("o_orderdate").alias("date")).agg(
        F.avg("o_totalprice").alias("value"))


_QM_SQL = """WITH c AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS site, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS value
           FROM lineitem GROUP BY 1, 2),
h AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS site, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS value
      FROM orders GROUP BY 1, 2),
cr AS (SELECT *, rank() OVER (PARTITION BY site ORDER BY value) - 1 AS idx, count(*) OVER (PARTITION BY site) AS n FROM c),
hr AS (SELECT site, value, row_number() OVER (PARTITION BY site ORDER BY value) - 1 AS pos,
       count(*) OVER (PARTITION BY site) AS m FROM h),
mm AS (SELECT DISTINCT site, m FROM hr),
qm AS (SELECT cr.site, cr.date, cr.value, hr.value AS corrected FROM cr LEFT JOIN mm USING (site)
       LEFT JOIN hr ON hr.site = cr.site AND hr.pos = floor(CASE WHEN idx > 0 AND n > 1 THEN (idx - 1) / (n - 1) ELSE 0 END * (mm.m - 1)))
"""


@register("w5_quantile_map", _QM_SQL + "SELECT site, date, value, " + S.r("corrected", 4) + " AS corrected FROM qm")
def w5_quantile_map(spark, d):
    out = K.quantile_map(control(spark, d), historical(spark, d), ["site"])
    return out.select("site", "date", "value", rnd("corrected", 4).alias("corrected"))


_PAIRS_SQL = """
WITH c AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS site, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS value
           FROM lineitem GROUP BY 1, 2),
h AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS site, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS value
      FROM orders GROUP BY 1, 2),
cp AS (SELECT site, value AS x, row_number() OVER (PARTITION BY site ORDER BY value) - 1 AS pos,
       count(*) OVER (PARTITION BY site) AS n FROM c),
hp AS (SELECT site, value AS v, row_number() OVER (PARTITION BY site ORDER BY value) - 1 AS pos,
       count(*) OVER (PARTITION BY site) AS m FROM h),
mm AS (SELECT DISTINCT site, m FROM hp),
q AS (SELECT cp.site, cp.x, CASE WHEN n > 1 THEN pos / (n - 1) ELSE 0 END * (mm.m - 1) AS hh FROM cp JOIN mm USING (site)),
pairs AS (SELECT q.site, q.x, lo.v + (q.hh - floor(q.hh)) * (hi.v - lo.v) AS y
FROM q JOIN hp lo ON lo.site = q.site AND lo.pos = floor(q.hh) JOIN hp hi ON hi.site = q.site AND hi.pos = ceil(q.hh))
"""


def _fit_sql() -> str:
    """Cubic least squares per site: moments about the mean, then Cramer's rule on the 4 x 4 normal equations."""
    def det(m):
        if len(m) == 1:
            return m[0][0]
        terms = [f"{'+' if j % 2 == 0 else '-'} {m[0][j]} * ({det([[r[k] for k in range(len(m)) if k != j] for r in m[1:]])})" for j in range(len(m))]
        return " ".join(terms).lstrip("+ ")
    moments = ", ".join([f"avg(pow(z, {k})) AS s{k}" for k in range(7)] + [f"avg(pow(z, {k}) * y) AS b{k}" for k in range(4)])
    a = [[f"s{i + j}" for j in range(4)] for i in range(4)]
    columns = ", ".join(f"({det([[f'b{i}' if j == k else a[i][j] for j in range(4)] for i in range(4)])}) / ({det(a)}) AS c{k}" for k in range(4))
    return f""",
st AS (SELECT site, avg(x) AS x_mean, stddev_pop(x) AS x_scale FROM pairs GROUP BY 1),
mo AS (SELECT site, x_mean, x_scale, {moments} FROM (SELECT site, x_mean, x_scale, y, (x - x_mean) / x_scale AS z FROM pairs JOIN st USING (site)) GROUP BY 1, 2, 3),
co AS (SELECT site, x_mean, x_scale, {columns} FROM mo)
"""


@register("w6_quantile_pairs", _PAIRS_SQL + "SELECT site, x, " + S.r("y", 4) + " AS y FROM pairs")
def w6_quantile_pairs(spark, d):
    """The pairing step of W6: sorted control values with the linearly
    interpolated historical quantile at the same plotting position."""
    out = K.quantile_pairs(control(spark, d), historical(spark, d), ["site"])
    return out.select("site", "x", rnd("y", 4).alias("y"))


@register("w6_poly_correction", _PAIRS_SQL + _fit_sql() + "SELECT site, date, value, " + S.r("c0 + z * (c1 + z * (c2 + z * c3))", 3)
          + " AS corrected FROM (SELECT c.site, c.date, c.value, (c.value - x_mean) / x_scale AS z, c0, c1, c2, c3 FROM c JOIN co USING (site))")
def w6_poly_correction(spark, d):
    out = K.poly_correction(control(spark, d), historical(spark, d), ["site"])
    return out.select("site", "date", "value", rnd("corrected", 3).alias("corrected"))


@register("w7_correction_skill", _QM_SQL + """
SELECT qm.site, """ + S.r("avg(abs(qm.value - h.value))", 4) + """ AS mae_before,
  """ + S.r("avg(abs(qm.corrected - h.value))", 4) + """ AS mae_after
FROM qm JOIN h USING (site, date) GROUP BY qm.site""")
def w7_correction_skill(spark, d):
    qm = K.quantile_map(control(spark, d), historical(spark, d), ["site"])
    obs = historical(spark, d).withColumnRenamed("value", "observed")
    out = K.correction_skill(qm.join(obs, ["site", "date"]), ["site"])
    return out.select("site", rnd("mae_before", 4).alias("mae_before"), rnd("mae_after", 4).alias("mae_after"))
