"""Catalogue: model calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import calendar as CAL
from stationcast.plans import standins as S
from stationcast.plans.registry import register


@register("r8_is_360_day", """
WITH src AS (SELECT l_returnflag AS source, strftime(l_shipdate, '%Y-%m-%d') AS time FROM lineitem
             UNION ALL SELECT event_type, strftime(ts, '%Y-%m-%d') FROM events),
p AS (SELECT source, CAST(substr(time, 6, 2) AS INTEGER) AS m, CAST(substr(time, 9, 2) AS INTEGER) AS d FROM src)
SELECT source, (bool_or(m = 2 AND d = 30)
  OR count(DISTINCT CASE WHEN d = 31 AND m IN (1, 3, 5, 7, 8, 10, 12) THEN m END) < 7) AS is_360_day
FROM p GROUP BY source""")
def r8_is_360_day(spark, d):
    li = S.read_table(spark, d, "lineitem").select(F.col("l_returnflag").alias("source"),
                                                  F.date_format("l_shipdate", "yyyy-MM-dd").alias("time"))
    ev = S.read_table(spark, d, "events").select(F.col("event_type").alias("source"),
                                                F.date_format("ts", "yyyy-MM-dd").alias("time"))
    return CAL.is_360_day(li.unionByName(ev))


def calendar_360(spark, d):
    """A 360-day model series: 12 months of 30 days per year (string dates)."""
    o = S.read_table(spark, d, "orders")
    k = F.col("o_orderkey") % 360
    t = F.format_string("%04d-%02d-%02d", F.year("o_orderdate"), F.floor(k / 30) + 1, k % 30 + 1)
    return o.groupBy(t.alias("time")).agg(F.avg("o_totalprice").alias("value"))


_R9_SQL = """WITH s AS (SELECT printf('%04d-%02d-%02d', year(o_orderdate), (o_orderkey % 360) // 30 + 1, (o_orderkey % 360) % 30 + 1) AS time,
  avg(o_totalprice) AS value FROM orders GROUP BY 1),
l AS (SELECT time, value, CAST(substr(time, 1, 4) AS INTEGER) AS y, CAST(substr(time, 6, 2) AS INTEGER) AS m,
  CAST(substr(time, 9, 2) AS INTEGER) AS d FROM s),
l2 AS (SELECT *, (y % 4 = 0 AND y % 100 <> 0) OR y % 400 = 0 AS leap FROM l),
c AS (SELECT TRY_CAST(time AS DATE) AS date, value, 0 AS prio FROM l2 WHERE TRY_CAST(time AS DATE) IS NOT NULL
  UNION ALL SELECT make_date(y, 1, 31), value, 1 FROM l2 WHERE m = 2 AND d = 1
  UNION ALL SELECT make_date(y, 2, 29), value, 2 FROM l2 WHERE leap AND m = 2 AND d = 28
  UNION ALL SELECT make_date(y, 3, 1), value, 3 FROM l2 WHERE m = 2 AND d = CASE WHEN leap THEN 29 ELSE 28 END
  UNION ALL SELECT make_date(y, m, 31), value, 4 FROM l2 WHERE m IN (1, 3, 5, 7, 8, 10, 12) AND d = 30)
"""


@register("r9_repair_360_day", _R9_SQL + "SELECT date, " + S.r("arg_min(value, prio)") + " AS value, min(prio) > 0 AS copied FROM c GROUP BY date")
def r9_repair_360_day(spark, d):
    out = CAL.repair_360_day(calendar_360(spark, d))
    return out.select("date", rnd("value").alias("value"), "copied")


@register("r9_repair_360_day_compat", _R9_SQL + "SELECT date, " + S.r("value") + " AS value, prio > 0 AS copied FROM c")
def r9_repair_360_day_compat(spark, d):
    out = CAL.repair_360_day(calendar_360(spark, d), compat=True)
    return out.select("date", rnd("value").alias("value"), "copied")


@register("r10_zip_time", """
WITH a AS (SELECT l_orderkey % 3 AS site, CAST(l_shipdate AS DATE) AS day, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2),
ar AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY day) - 1 AS k FROM a),
r AS (SELECT DISTINCT o_orderkey % 3 AS site, CAST(o_orderdate AS DATE) AS time FROM orders),
rr AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time) - 1 AS rk, count(*) OVER (PARTITION BY site) AS m FROM r),
mm AS (SELECT DISTINCT site, m FROM rr)
SELECT ar.site, ar.day, ar.price, rr.time FROM ar JOIN mm USING (site)
LEFT JOIN rr ON rr.site = ar.site AND rr.rk = CASE WHEN ar.k < mm.m THEN ar.k ELSE mm.m - 4 + (ar.k - mm.m) % 4 END""")
def r10_zip_time(spark, d):
    li = S.read_table(spark, d, "lineitem")
    a = li.groupBy((F.col("l_orderkey") % 3).alias("site"), F.to_date("l_shipdate").alias("day")).agg(
        F.max("l_extendedprice").alias("price"))
    o = S.read_table(spark, d, "orders")
    ref = o.select((F.col("o_orderkey") % 3).alias("site"), F.to_date("o_orderdate").alias("time")).distinct()
    return CAL.zip_time(a, ref, ["site"], "day").select("site", "day", "price", "time")


@register("r11_rebuild_noleap", """
WITH sp AS (SELECT CAST(t AS DATE) AS time FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2029-12-31', INTERVAL 1 DAY) g(t)
            WHERE NOT (month(t) = 2 AND day(t) = 29)),
spd AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS d FROM sp),
spos AS (SELECT time, d * 4 + j AS pos FROM spd, range(0, 4) r(j)),
e AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
o AS (SELECT e.event_id, e.value, spos.time FROM e LEFT JOIN spos USING (pos)
      WHERE spos.time IS NULL OR NOT (year(spos.time) = 2026 AND dayofyear(spos.time) <> 1))
SELECT event_id, value, time FROM o UNION ALL SELECT event_id, value, CAST(time + 1 AS DATE) FROM o WHERE time = DATE '2029-12-31'""")
def r11_rebuild_noleap(spark, d):
    ev = S.read_table(spark, d, "events").select("event_id", "value")
    out = CAL.rebuild_noleap(ev, "event_id", "2024-01-01", "2029-12-31", 4, drop_year=2026)
    return out.select("event_id", "value", "time")
