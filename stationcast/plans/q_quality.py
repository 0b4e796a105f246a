"""Catalogue: coverage, missing data, percentiles, scores, grid comparison
(A10-A12, A16-A18, A20, A22-A25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import quality as Q
from stationcast.plans import standins as S
from stationcast.plans.q_frames import _PIVOT_SQL, wide_grid
from stationcast.plans.q_joins import _FLAG_SQL, _flag_daily
from stationcast.plans.registry import register


@register("a10_coverage", """
WITH pd AS (SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT flag, CAST(sum(n) AS BIGINT) AS rows, min(date) AS first_date, max(date) AS last_date, count(*) AS n_dates,
  min(n) AS min_per_date, max(n) AS max_per_date FROM pd GROUP BY flag""")
def a10_coverage(spark, d):
    li = S.read_table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("date"))
    return Q.coverage(li, ["flag"])


@register("a10_irregular_dates", S.with_sql("grid") + """
SELECT site, date, count(*) AS n FROM grid GROUP BY site, date HAVING count(*) <> 4""")
def a10_irregular_dates(spark, d):
    return Q.irregular_dates(S.grid(spark, d), 4, ["site"])


@register("a11_mode_fill", """
WITH q AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_quantity END AS qty FROM lineitem),
c AS (SELECT l_returnflag, qty, count(*) AS cnt FROM q WHERE qty IS NOT NULL GROUP BY 1, 2),
m AS (SELECT l_returnflag, arg_max(qty, (cnt, -qty)) AS qty_mode FROM c GROUP BY 1)
SELECT q.l_orderkey, q.l_linenumber, q.l_returnflag, coalesce(q.qty, m.qty_mode) AS qty FROM q LEFT JOIN m USING (l_returnflag)""")
def a11_mode_fill(spark, d):
    li = S.read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.when(F.col("l_linestatus") == "F", F.lit(None)).otherwise(F.col("l_quantity")).alias("qty"))
    return Q.mode_fill(li, ["qty"], ["l_returnflag"])


@register("a12_percentile_table", S.with_sql("grid") + """,
o AS (SELECT o_orderkey % 4 AS site, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS observed FROM orders GROUP BY 1, 2),
p AS (SELECT site, date, avg(price) AS predicted FROM grid GROUP BY 1, 2),
oq AS (SELECT site, quantile_cont(observed, 0.95) AS obs_percentile FROM o GROUP BY 1),
pq AS (SELECT site, quantile_cont(predicted, 0.95) AS pred_percentile FROM p GROUP BY 1)
SELECT coalesce(oq.site, pq.site) AS site, """ + S.r("obs_percentile", 4) + """ AS obs_percentile,
  """ + S.r("pred_percentile", 4) + """ AS pred_percentile,
  CASE WHEN obs_percentile IS NULL THEN 'no_observed'
       WHEN pred_percentile IS NULL THEN 'no_predicted' END AS error
FROM oq FULL OUTER JOIN pq ON oq.site = pq.site""")
def a12_percentile_table(spark, d):
    o = S.read_table(spark, d, "orders").groupBy((F.col("o_orderkey") % 4).alias("site"), F.to_date("o_orderdate").alias("date")) \
        .agg(F.avg("o_totalprice").alias("observed"))
    p = S.grid(spark, d).groupBy("site", "date").agg(F.avg("price").alias("predicted"))
    t = Q.percentile_table(o, p, ["site"])
    return t.select("site", rnd("obs_percentile", 4).alias("obs_percentile"),
                    rnd("pred_percentile", 4).alias("pred_percentile"), "error")


@register("a12_percentile_summary", S.with_sql("grid") + """,
o AS (SELECT DISTINCT o_orderkey % 4 AS site FROM orders),
p AS (SELECT DISTINCT site FROM grid),
t AS (SELECT coalesce(o.site, p.site) AS site, o.site IS NOT NULL AND p.site IS NOT NULL AS ok
      FROM o FULL OUTER JOIN p ON o.site = p.site)
SELECT CAST(count_if(ok) AS BIGINT) AS successful, CAST(count_if(NOT ok) AS BIGINT) AS failed FROM t""")
def a12_percentile_summary(spark, d):
    o = S.read_table(spark, d, "orders").groupBy((F.col("o_orderkey") % 4).alias("site"), F.to_date("o_orderdate").alias("date")) \
        .agg(F.avg("o_totalprice").alias("observed"))
    p = S.grid(spark, d).groupBy("site", "date").agg(F.avg("price").alias("predicted"))
    return Q.percentile_summary(Q.percentile_table(o, p, ["site"]))


@register("a16_mae_by_month", _FLAG_SQL + """
SELECT coalesce(CAST(month(date) AS INTEGER), 0) AS month, """ + S.r("avg(abs(a - b))") + """ AS mae, count(*) AS n
FROM a JOIN b USING (flag, date) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ROLLUP (month(date))""")
def a16_mae_by_month(spark, d):
    """Per-month MAE; the overall row (rollup's null month) is reported as month 0."""
    out = Q.mae_by_month(_flag_daily(spark, d, 1, "a"), _flag_daily(spark, d, 0, "b"), ["flag", "date"])
    return out.withColumns({"month": F.coalesce("month", F.lit(0)), "mae": rnd("mae")})


_WCOLS = [f"{v}-{i}" for v in ("price", "qty") for i in range(1, 5)]


@register("a17_missing_pct", _PIVOT_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {S.r(f'100.0 * (count(*) - count(\"{c}\")) / count(*)')} AS missing_pct FROM wide"
    for c in ["site", "date", *_WCOLS]))
def a17_missing_pct(spark, d):
    return Q.missing_pct(wide_grid(spark, d)).withColumn("missing_pct", rnd("missing_pct"))


@register("a17_incomplete_rows", _PIVOT_SQL + "SELECT " + S.r("100.0 * count_if(NOT (" + " AND ".join(
    f'"{c}" IS NOT NULL' for c in _WCOLS) + ")) / count(*)") + " AS incomplete_pct, 0 AS all_null_columns FROM wide")
def a17_incomplete_rows(spark, d):
    return Q.incomplete_rows_pct(wide_grid(spark, d)).withColumn("incomplete_pct", rnd("incomplete_pct"))


@register("a18_score", S.with_sql("grid", "pred") + """,
j AS (SELECT g.site, g.date, avg(g.price) AS predicted, any_value(p.obs) AS observed
      FROM grid g JOIN pred p USING (site, date) GROUP BY 1, 2),
e AS (SELECT site, observed, predicted, predicted - observed AS e FROM j)
SELECT site, """ + S.r("avg(e)", 4) + " AS mean_error, " + S.r("avg(abs(e))", 4) + " AS mae, " + S.r("sqrt(avg(e * e))", 4)
          + " AS rmse, " + S.r("1 - sum(e * e) / (count(*) * var_pop(observed))") + " AS r2, "
          + S.r("1 - var_pop(e) / var_pop(observed)") + " AS explained_variance, count(*) AS n FROM e GROUP BY site")
def a18_score(spark, d):
    pr = S.grid(spark, d).groupBy("site", "date").agg(F.avg("price").alias("predicted"))
    j = pr.join(S.pred(spark, d).withColumnRenamed("obs", "observed"), ["site", "date"])
    out = Q.score(j, ["site"])
    return out.select("site", rnd("mean_error", 4).alias("mean_error"), rnd("mae", 4).alias("mae"),
                      rnd("rmse", 4).alias("rmse"), rnd("r2").alias("r2"),
                      rnd("explained_variance").alias("explained_variance"), "n")


_HAV = "2 * 6371.0 * asin(sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2)))"


@register("a20_grid_diff", S.with_sql("cells") + """,
pts AS (SELECT DISTINCT segment AS model, lat, lon FROM cells),
pairs AS (SELECT DISTINCT x.model AS model_1, y.model AS model_2 FROM pts x JOIN pts y ON x.model < y.model),
near AS (SELECT p.model_1, p.model_2, a.lat, a.lon, min(""" + _HAV + """) AS dist
         FROM pairs p JOIN pts a ON a.model = p.model_1 JOIN pts b ON b.model = p.model_2 GROUP BY ALL),
n AS (SELECT model, count(*) AS n FROM pts GROUP BY 1),
common AS (SELECT p.model_1, p.model_2, count(*) AS c FROM pairs p JOIN pts a ON a.model = p.model_1
           JOIN pts b ON b.model = p.model_2 AND a.lat = b.lat AND a.lon = b.lon GROUP BY ALL)
SELECT p.model_1, p.model_2, (n1.n = n2.n AND coalesce(c.c, 0) = n1.n) AS identical,
  """ + S.r("min(dist)", 4) + " AS min_dist, " + S.r("max(dist)", 4) + " AS max_dist, " + S.r("avg(dist)", 4)
          + " AS avg_dist, " + S.r("stddev_pop(dist)", 4) + """ AS std_dist
FROM pairs p JOIN n n1 ON n1.model = p.model_1 JOIN n n2 ON n2.model = p.model_2
LEFT JOIN common c USING (model_1, model_2) LEFT JOIN near USING (model_1, model_2)
GROUP BY p.model_1, p.model_2, n1.n, n2.n, c.c""")
def a20_grid_diff(spark, d):
    pts = S.cells(spark, d).select(F.col("segment").alias("model"), "lat", "lon")
    out = Q.grid_diff(pts)
    return out.select("model_1", "model_2", "identical",
                      *[rnd(c, 4).alias(c) for c in ("min_dist", "max_dist", "avg_dist", "std_dist")])


@register("a22_mean_sorted", """
SELECT event_type, """ + S.r("avg(value)", 9) + """ AS mean_value FROM events GROUP BY 1 ORDER BY mean_value""")
def a22_mean_sorted(spark, d):
    out = Q.mean_sorted(S.read_table(spark, d, "events"), "event_type", "value")
    return out.withColumn("mean_value", rnd("mean_value", 9))


@register("a23_time_range", """
SELECT l_returnflag AS flag, CAST(min(l_shipdate) AS DATE) AS start, CAST(max(l_shipdate) AS DATE) AS "end",
  strftime(min(l_shipdate), '%Y-%m-%d') || ' to ' || strftime(max(l_shipdate), '%Y-%m-%d') AS label
FROM lineitem GROUP BY 1""")
def a23_time_range(spark, d):
    li = S.read_table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("date"))
    return Q.time_range(li, ["flag"])


@register("a24_producer_matrix", """
SELECT CAST(l_shipdate AS DATE) AS date, max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS "A",
  max(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS "N",
  max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS "R" FROM lineitem GROUP BY 1""")
def a24_producer_matrix(spark, d):
    li = S.read_table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"),
                                                  F.col("l_returnflag").alias("producer"),
                                                  F.col("l_extendedprice").alias("value"))
    return Q.producer_matrix(li, ["A", "N", "R"])


@register("a25_extent", S.with_sql("cells", "sites") + """
SELECT c.site, """ + ", ".join(S.r(e) + " AS " + n for e, n in (
    ("least(min(c.lat), any_value(s.latitude)) - 0.1", "lat_min"), ("greatest(max(c.lat), any_value(s.latitude)) + 0.1", "lat_max"),
    ("least(min(c.lon), any_value(s.longitude)) - 0.1", "lon_min"), ("greatest(max(c.lon), any_value(s.longitude)) + 0.1", "lon_max")))
          + " FROM cells c JOIN sites s USING (site) GROUP BY c.site")
def a25_extent(spark, d):
    out = Q.extent(S.cells(spark, d), S.sites(spark, d))
    return out.select("site", *[rnd(c).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")])
