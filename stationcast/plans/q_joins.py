"""Catalogue: joins, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import climatology as C
from stationcast.operators import joins as J
from stationcast.plans import standins as S
from stationcast.plans.q_frames import _PIVOT_SQL, wide_grid
from stationcast.plans.registry import register


def _q(c):
    return '"' + c + '"'


_WCOLS = [f"{v}-{i}" for v in ("price", "qty") for i in range(1, 5)]


@register("j1_assemble", _PIVOT_SQL.replace("WITH ", "WITH pred AS (" + S.SQL["pred"] + "),\n", 1)
          + "SELECT p.site, p.date, " + S.r("p.obs", 4) + " AS obs, "
          + ", ".join(f"{S.r('w.' + _q(c))} AS {_q(c)}" for c in _WCOLS)
          + " FROM pred p LEFT JOIN wide w USING (site, date)")
def j1_assemble(spark, d):
    # one aggregate, melted by an Expand: a single scan feeds both variables
    long = S.grid(spark, d).unpivot(["site", "date", "point"], ["price", "qty"], "variable", "value")
    out = J.assemble(S.pred(spark, d), long, ["price", "qty"])
    return out.select("site", "date", rnd("obs", 4).alias("obs"), *[rnd(F.col(f"`{c}`")).alias(c) for c in _WCOLS])


@register("j2_join_obs", _PIVOT_SQL.replace("WITH ", "WITH pred AS (" + S.SQL["pred"] + "),\n", 1)
          + "SELECT w.site, w.date, " + S.r('w."price-1"') + ' AS "price-1", ' + S.r("p.obs", 4)
          + " AS obs FROM wide w LEFT JOIN pred p USING (site, date)")
def j2_join_obs(spark, d):
    w = wide_grid(spark, d).select("site", "date", "`price-1`")
    out = J.join_obs(w, S.pred(spark, d), cols=["obs"])
    return out.select("site", "date", rnd("`price-1`").alias("price-1"), rnd("obs", 4).alias("obs"))


def _status_daily(spark, d, st):
    o = S.read_table(spark, d, "orders").filter(F.col("o_orderstatus") == st)
    return o.groupBy(F.to_date("o_orderdate").alias("date")).agg(rnd(F.avg("o_totalprice"), 4).alias(st))


_STATUS_SQL = "WITH " + ",\n".join(
    f"{s.lower()} AS (SELECT CAST(o_orderdate AS DATE) AS date, {S.r('avg(o_totalprice)', 4)} AS \"{s}\" "
    f"FROM orders WHERE o_orderstatus = '{s}' GROUP BY 1)" for s in ("F", "O", "P")) + "\n"


@register("j3_outer_merge", _STATUS_SQL + """
SELECT coalesce(f.date, o.date, p.date) AS date, f."F", o."O", p."P"
FROM f FULL OUTER JOIN o ON f.date = o.date FULL OUTER JOIN p ON coalesce(f.date, o.date) = p.date""")
def j3_outer_merge(spark, d):
    return J.outer_merge([_status_daily(spark, d, s) for s in ("F", "O", "P")])


@register("j4_with_stats", S.with_sql("pred") + """,
m AS (SELECT site, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, avg(obs) AS obs_mean FROM pred GROUP BY 1, 2, 3)
SELECT p.site, p.date, """ + S.r("p.obs", 4) + """ AS obs, """ + S.r("m.obs_mean") + """ AS obs_mean
FROM pred p LEFT JOIN m ON p.site = m.site AND year(p.date) = m.year AND month(p.date) = m.month""")
def j4_with_stats(spark, d):
    p = S.pred(spark, d)
    st = C.monthly_stats(p, ["obs"]).select("site", "year", "month", "obs_mean")
    out = J.with_stats(p.withColumns({"year": F.year("date"), "month": F.month("date")}), st, ["site", "year", "month"])
    return out.select("site", "date", rnd("obs", 4).alias("obs"), rnd("obs_mean").alias("obs_mean"))


@register("j5_common_dates", _STATUS_SQL + """
SELECT f.date, f."F" FROM f WHERE f.date IN (SELECT date FROM o) AND f.date IN (SELECT date FROM p)""")
def j5_common_dates(spark, d):
    return J.common_dates(*[_status_daily(spark, d, s) for s in ("F", "O", "P")])


@register("j6_missing_dates", _STATUS_SQL + """
SELECT f.date, f."F" FROM f WHERE f.date NOT IN (SELECT date FROM p)""")
def j6_missing_dates(spark, d):
    return J.missing_dates(_status_daily(spark, d, "F"), _status_daily(spark, d, "P"))


@register("j7_keep_points", S.with_sql("cells") + """
SELECT id, lat, lon FROM cells WHERE (lat, lon) IN (SELECT DISTINCT lat, lon FROM cells WHERE lat = floor(lat))""")
def j7_keep_points(spark, d):
    c = S.cells(spark, d)
    # retained coordinate set: the southern row of every 2 x 2 cell block
    keep = c.filter(F.col("lat") == F.floor("lat")).select("lat", "lon")
    return J.keep_points(c.select("id", "lat", "lon"), keep)


@register("j8_merge_on_grid", S.with_sql("cells") + """,
b AS (SELECT segment, round(lat + 1e-9, 6) AS rlat, round(lon - 1e-9, 6) AS rlon, avg(value) AS value
      FROM cells GROUP BY segment, lat, lon)
SELECT c.id, c.segment, c.lat, c.lon, """ + S.r("b.value", 4) + """ AS value
FROM cells c LEFT JOIN b ON b.segment = c.segment AND b.rlat = round(c.lat, 6) AND b.rlon = round(c.lon, 6)""")
def j8_merge_on_grid(spark, d):
    c = S.cells(spark, d)
    b = (c.groupBy("segment", "lat", "lon").agg(F.avg("value").alias("value"))
         .withColumns({"lat": F.col("lat") + 1e-9, "lon": F.col("lon") - 1e-9}))
    out = J.merge_on_grid(c.select("id", "segment", "lat", "lon", "value"), b, "value", date="segment")
    return out.select("id", "segment", "lat", "lon", rnd("value", 4).alias("value"))


@register("j9_model_pairs", """
SELECT a.m AS model_1, b.m AS model_2 FROM (SELECT DISTINCT c_mktsegment AS m FROM customer) a
JOIN (SELECT DISTINCT c_mktsegment AS m FROM customer) b ON a.m < b.m""")
def j9_model_pairs(spark, d):
    c = S.read_table(spark, d, "customer").select(F.col("c_mktsegment").alias("model"))
    return J.model_pairs(c)


_SUPP_SQL = """sp AS (SELECT s_suppkey AS id, CAST(s_nationkey * 3 - 30 AS DOUBLE) + (s_suppkey % 3) * 0.1::DOUBLE AS lat,
  CAST(s_nationkey * 2 - 20 AS DOUBLE) + 0.05::DOUBLE AS lon FROM supplier)"""


def _suppliers(spark, d):
    s = S.read_table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("id"),
                    ((F.col("s_nationkey") * 3 - 30).cast("double") + (F.col("s_suppkey") % 3) * 0.1).alias("lat"),
                    ((F.col("s_nationkey") * 2 - 20).cast("double") + 0.05).alias("lon"))


_HAV = "2 * 6371.0 * asin(sqrt(pow(sin((radians(c.lat) - radians(sp.lat)) / 2), 2) + cos(radians(sp.lat)) * cos(radians(c.lat)) * pow(sin((radians(c.lon) - radians(sp.lon)) / 2), 2)))"


@register("j10_nearest_point", S.with_sql("cells") + "," + _SUPP_SQL + """,
d AS (SELECT sp.id AS s_id, c.id AS c_id, """ + _HAV + """ AS dist FROM sp, cells c),
best AS (SELECT s_id, arg_min(c_id, (dist, c_id)) AS c_id, min(dist) AS dist FROM d GROUP BY s_id)
SELECT s_id, c_id, """ + S.r("dist", 4) + """ AS distance_km FROM best""")
def j10_nearest_point(spark, d):
    out = J.nearest_point(_suppliers(spark, d), S.cells(spark, d), names=("s_id", "c_id"))
    return out.select("s_id", "c_id", rnd("distance_km", 4).alias("distance_km"))


_FLAG_SQL = """WITH a AS (SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS a FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY 1, 2),
b AS (SELECT l_returnflag AS flag, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS b FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1, 2)
"""


def _flag_daily(spark, d, odd, name):
    """One of two producers of the daily maximum price per flag: odd or even lines, all rows between them."""
    li = S.read_table(spark, d, "lineitem").filter(F.col("l_linenumber") % 2 == odd)
    return li.groupBy(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("date")).agg(F.max("l_extendedprice").alias(name))


@register("j11_align_series", _FLAG_SQL + "SELECT flag, date, a, b FROM a JOIN b USING (flag, date) WHERE a IS NOT NULL AND b IS NOT NULL")
def j11_align_series(spark, d):
    return J.align_series(_flag_daily(spark, d, 1, "a"), _flag_daily(spark, d, 0, "b"), ["flag", "date"])


@register("j12_compare_metrics", """
WITH a AS (SELECT s_nationkey AS nation, """ + S.r("avg(s_acctbal)", 4) + """ AS mean, max(s_acctbal) AS max FROM supplier GROUP BY 1),
b AS (SELECT c_nationkey AS nation, """ + S.r("avg(c_acctbal)", 4) + """ AS mean, max(c_acctbal) AS max FROM customer GROUP BY 1)
SELECT a.nation, a.mean AS mean_a, a.max AS max_a, b.mean AS mean_b, b.max AS max_b FROM a JOIN b USING (nation)""")
def j12_compare_metrics(spark, d):
    s = S.read_table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        rnd(F.avg("s_acctbal"), 4).alias("mean"), F.max("s_acctbal").alias("max"))
    c = S.read_table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        rnd(F.avg("c_acctbal"), 4).alias("mean"), F.max("c_acctbal").alias("max"))
    return J.compare_metrics(s, c, ["nation"])


@register("j13_attach_observed", S.with_sql("grid", "pred") + """
SELECT g.site, g.date, """ + S.r("avg(g.price)") + """ AS predicted, """ + S.r("any_value(p.obs)", 4) + """ AS observed
FROM grid g LEFT JOIN pred p USING (site, date) GROUP BY g.site, g.date""")
def j13_attach_observed(spark, d):
    pr = S.grid(spark, d).groupBy("site", "date").agg(rnd(F.avg("price")).alias("predicted"))
    obs = S.pred(spark, d).select("site", "date", rnd("obs", 4).alias("observed"))
    return J.attach_observed(pr, obs)


@register("u1_union_all", S.with_sql("pred") + """
SELECT site, date, """ + S.r("obs", 4) + """ AS obs FROM pred WHERE date <= DATE '1999-12-31'
UNION ALL SELECT site, date, """ + S.r("obs", 4) + """ FROM pred WHERE date > DATE '1999-12-31'""")
def u1_union_all(spark, d):
    p = S.pred(spark, d).withColumn("obs", rnd("obs", 4))
    cut = F.lit(S.CUTOFF).cast("date")
    return J.union_all(p.filter(F.col("date") <= cut), p.filter(F.col("date") > cut))


@register("u2_union_missing", S.with_sql("pred", "grid") + """
SELECT site, date, """ + S.r("obs", 4) + """ AS obs, NULL::DOUBLE AS price FROM pred
UNION ALL SELECT site, date, NULL::DOUBLE, """ + S.r("avg(price)") + """ FROM grid GROUP BY site, date""")
def u2_union_missing(spark, d):
    p = S.pred(spark, d).withColumn("obs", rnd("obs", 4))
    g = S.grid(spark, d).groupBy("site", "date").agg(rnd(F.avg("price")).alias("price"))
    return J.union_all(p, g, allow_missing=True)


@register("u3_date_difference", _STATUS_SQL + "SELECT date FROM f EXCEPT SELECT date FROM o")
def u3_date_difference(spark, d):
    return J.date_difference(_status_daily(spark, d, "F").select("date"), _status_daily(spark, d, "O").select("date"))


@register("u4_date_intersection", _STATUS_SQL + "SELECT date FROM f INTERSECT SELECT date FROM o INTERSECT SELECT date FROM p")
def u4_date_intersection(spark, d):
    return J.date_intersection(*[_status_daily(spark, d, s).select("date") for s in ("F", "O", "P")])


@register("o1_multi_sort", """
SELECT c_mktsegment AS segment, c_nationkey AS nation, c_custkey FROM customer ORDER BY segment, nation, c_custkey""")
def o1_multi_sort(spark, d):
    c = S.read_table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"),
                                                  F.col("c_nationkey").alias("nation"), "c_custkey")
    return J.sort_by(c, ["segment", "nation", "c_custkey"])


@register("o2_time_sort", S.with_sql("pred") + "SELECT site, date, " + S.r("obs", 4) + " AS obs FROM pred ORDER BY date, site")
def o2_time_sort(spark, d):
    return J.sort_by(S.pred(spark, d).withColumn("obs", rnd("obs", 4)), ["date", "site"])


@register("o3_top_k", """
SELECT feature, score FROM (SELECT l_returnflag || '-' || CAST(l_linenumber AS VARCHAR) AS feature,
  """ + S.r("avg(abs(l_tax))", 9) + """ AS score FROM lineitem GROUP BY 1) ORDER BY score DESC, feature LIMIT 20""")
def o3_top_k(spark, d):
    li = S.read_table(spark, d, "lineitem")
    f = li.groupBy(F.concat("l_returnflag", F.lit("-"), F.col("l_linenumber").cast("string")).alias("feature")).agg(
        rnd(F.avg(F.abs("l_tax")), 9).alias("score"))
    return J.top_k(f, "score", 20)
