"""Catalogue: reshape operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import reshape as R
from stationcast.plans import standins as S
from stationcast.plans.q_frames import _PIVOT_SQL, wide_grid
from stationcast.plans.registry import register

_POINTS_SQL = S.with_sql("cells") + """,
pts AS (SELECT site, lat, lon, CAST(dense_rank() OVER (PARTITION BY site ORDER BY lat, lon) AS INTEGER) AS point
        FROM (SELECT DISTINCT site, lat, lon FROM cells))
"""


@register("r1_point_id", _POINTS_SQL + "SELECT c.id, c.site, p.point FROM cells c JOIN pts p USING (site, lat, lon)")
def r1_point_id(spark, d):
    return R.point_id(S.cells(spark, d)).select("id", "site", "point")


@register("r2_pivot_points", _PIVOT_SQL + "SELECT site, date, " + ", ".join(
    f'{S.r(c)} AS {c}' for c in ['"price-1"', '"price-2"', '"price-3"', '"price-4"', '"qty-1"', '"qty-2"', '"qty-3"', '"qty-4"'])
    + " FROM wide")
def r2_pivot_points(spark, d):
    w = wide_grid(spark, d)
    return w.select("site", "date", *[rnd(F.col(f"`{c}`")).alias(c) for c in w.columns[2:]])


@register("r3_blocks_by_point", _POINTS_SQL + """,
j AS (SELECT c.site, c.segment, p.point, c.lat, c.lon, avg(c.value) AS acct
      FROM cells c JOIN pts p USING (site, lat, lon) GROUP BY ALL)
SELECT site, segment, """ + ", ".join(
    f"max(CASE WHEN point = {i} THEN {v} END) AS \"{v}-{i}\"" if v != "acct" else
    f"{S.r(f'max(CASE WHEN point = {i} THEN acct END)')} AS \"acct-{i}\""
    for v in ("lat", "lon", "acct") for i in range(1, 5)) + " FROM j GROUP BY site, segment")
def r3_blocks_by_point(spark, d):
    c = S.cells(spark, d)
    pts = R.point_ids(c)
    agg = c.groupBy("site", "segment", "lat", "lon").agg(F.avg("value").alias("acct"))
    out = R.blocks_by_point(agg, pts, ["acct"], by=["segment"])
    return out.withColumns({f"acct-{i}": rnd(F.col(f"`acct-{i}`")) for i in range(1, 5)})


@register("r4_attach_coords", _PIVOT_SQL.replace("WITH ", "WITH cells AS (" + S.SQL["cells"] + "),\n", 1) + """,
pts AS (SELECT site, lat, lon, dense_rank() OVER (PARTITION BY site ORDER BY lat, lon) AS point
        FROM (SELECT DISTINCT site, lat, lon FROM cells)),
cw AS (SELECT site, """ + ", ".join(f"max(CASE WHEN point = {i} THEN {v} END) AS \"{v}-{i}\"" for v in ("lat", "lon") for i in range(1, 5)) + """
       FROM pts GROUP BY site)
SELECT w.site, w.date, """ + S.r('w."price-1"') + """ AS "price-1", """ + ", ".join(f'cw."{v}-{i}"' for v in ("lat", "lon") for i in range(1, 5)) + """
FROM wide w LEFT JOIN cw ON CAST(w.site AS BIGINT) = CAST(cw.site AS BIGINT)""")
def r4_attach_coords(spark, d):
    pts = R.point_ids(S.cells(spark, d)).withColumn("site", F.col("site").cast("bigint"))
    w = wide_grid(spark, d).select("site", "date", rnd(F.col("`price-1`")).alias("price-1"))
    return R.attach_coords(w, pts)


@register("r5_melt", _PIVOT_SQL + " " + " UNION ALL ".join(
    f"SELECT site, date, '{i}' AS variable, {S.r(chr(34) + f'price-{i}' + chr(34))} AS value FROM wide" for i in range(1, 5)))
def r5_melt(spark, d):
    m = R.melt(wide_grid(spark, d), "price-", ["site", "date"])
    return m.withColumn("value", rnd("value"))


@register("r7_reindex_daily", """
WITH p AS (SELECT user_id AS site, event_type AS kind, CAST(ts AS DATE) AS date, max(value) AS value
           FROM events GROUP BY 1, 2, 3),
b AS (SELECT site, kind, greatest(min(date), DATE '2024-01-03') AS lo, max(date) AS hi FROM p GROUP BY 1, 2),
spine AS (SELECT site, kind, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b WHERE lo <= hi)
SELECT s.site, s.kind, s.date, p.value FROM spine s LEFT JOIN p USING (site, kind, date)""")
def r7_reindex_daily(spark, d):
    p = S.event_series(spark, d)
    return R.reindex_daily(p, ["site", "kind"], start="2024-01-03")


@register("r12_dedup_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""")
def r12_dedup_first(spark, d):
    li = S.read_table(spark, d, "lineitem")
    out = R.dedup_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


@register("r13_limit_points", """
SELECT date, l_orderkey, l_linenumber, l_partkey FROM (
  SELECT CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_partkey,
    row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn
  FROM lineitem) WHERE rn <= 4""")
def r13_limit_points(spark, d):
    li = S.read_table(spark, d, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    out = R.limit_points(li, ["date"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_quantity", "l_extendedprice", "l_discount", "l_tax"], 4)
    return out.select("date", "l_orderkey", "l_linenumber", "l_partkey")
