"""Catalogue: scalar functions and frame operators (P1-P26 except P18, P26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions import scalars as X
from stationcast.functions.scalars import rnd
from stationcast.operators import climatology as C
from stationcast.operators import frames as FR
from stationcast.operators import reshape as R
from stationcast.plans import standins as S
from stationcast.plans.registry import register
from stationcast.sources import readers as SRC

_PIVOT_SQL = S.with_sql("grid") + """,
wide AS (SELECT site, date,
  max(CASE WHEN point = 1 THEN price END) AS "price-1", max(CASE WHEN point = 2 THEN price END) AS "price-2",
  max(CASE WHEN point = 3 THEN price END) AS "price-3", max(CASE WHEN point = 4 THEN price END) AS "price-4",
  max(CASE WHEN point = 1 THEN qty END) AS "qty-1", max(CASE WHEN point = 2 THEN qty END) AS "qty-2",
  max(CASE WHEN point = 3 THEN qty END) AS "qty-3", max(CASE WHEN point = 4 THEN qty END) AS "qty-4"
  FROM grid GROUP BY site, date)
"""


def wide_grid(spark, d):
    return R.pivot_points(S.grid(spark, d), ["price", "qty"])


@register("p1_date_parts", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS utctime,
  CAST(dayofyear(o_orderdate) AS INTEGER) AS dayOfYear, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, CAST(hour(o_orderdate) AS INTEGER) AS hour FROM orders""")
def p1_date_parts(spark, d):
    o = S.read_table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("utctime"))
    return FR.add_date_parts(o).withColumn("utctime", F.to_date("utctime"))


@register("p2_clip_period", S.with_sql("pred", "sites") + """,
b AS (SELECT site, coalesce(CAST(strptime(start, '%Y%m%dT%H%M%SZ') AS DATE), DATE '2000-01-01') AS s,
             coalesce(CAST(strptime("end", '%Y%m%dT%H%M%SZ') AS DATE), DATE '2025-01-01') AS e FROM sites)
SELECT p.site, p.date, """ + S.r("p.obs", 4) + """ AS obs FROM pred p JOIN b USING (site) WHERE p.date BETWEEN b.s AND b.e""")
def p2_clip_period(spark, d):
    dim = SRC.with_site_bounds(S.sites(spark, d))
    out = FR.clip_period(S.pred(spark, d), dim.select("site", "start", "end"))
    return out.select("site", "date", rnd("obs", 4).alias("obs"))


@register("p3_null_if", """
SELECT s_suppkey, CASE WHEN s_acctbal / 5 - 100 < -100 THEN NULL ELSE """ + S.r("s_acctbal / 5 - 100") + """ END AS temp_c FROM supplier""")
def p3_null_if(spark, d):
    s = S.read_table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") / 5 - 100).alias("temp_c"))
    out = FR.null_if(s, ["temp_c"], lambda c: c < -100)
    return out.withColumn("temp_c", rnd("temp_c"))


@register("p4_convert_units", """
SELECT s_suppkey, """ + S.r("s_acctbal / 500 + 273.15") + """ AS t_k,
  """ + S.r("s_acctbal - 273.15") + """ AS t_c, """ + S.r("s_acctbal * 1000.0") + """ AS mm,
  """ + S.r("s_acctbal * 86400.0") + """ AS mm_day, """ + S.r("s_acctbal / 86400.0 / 1000.0", 12) + """ AS m_s FROM supplier""")
def p4_convert_units(spark, d):
    s = S.read_table(spark, d, "supplier")
    a = F.col("s_acctbal")
    return s.select("s_suppkey",
                    rnd(X.convert_units(a / 500, "C", "K")).alias("t_k"),
                    rnd(X.convert_units(a, "K", "C")).alias("t_c"),
                    rnd(X.convert_units(a, "m", "mm")).alias("mm"),
                    rnd(X.convert_units(a, "kg m-2 s-1", "mm/day")).alias("mm_day"),
                    rnd(X.convert_units(a, "mm/day", "m/s"), 12).alias("m_s"))


@register("p5_auto_units", S.with_sql("temps") + """,
st AS (SELECT site, median(t) AS med FROM temps GROUP BY site)
SELECT id, site, """ + S.r("CASE WHEN med > 100 THEN t - 273.15 ELSE t END") + """ AS t,
  coalesce(med > 100, false) AS converted FROM temps JOIN st USING (site)""")
def p5_auto_units(spark, d):
    out = FR.auto_units(S.temps(spark, d).select("id", "site", "t"), "t", "K_to_C", flag="converted")
    return out.select("id", "site", rnd("t").alias("t"), "converted")


_UV = "l_discount * 100 - 5", "l_tax * 100 - 4"


@register("p6_p7_wind", f"""
SELECT l_orderkey, l_linenumber, {S.r(f"sqrt(({_UV[0]}) * ({_UV[0]}) + ({_UV[1]}) * ({_UV[1]}))")} AS ws,
  {S.r(f"((270 - degrees(atan2({_UV[1]}, {_UV[0]}))) % 360 + 360) % 360", 4)} AS wd
FROM lineitem""")
def p6_p7_wind(spark, d):
    li = S.read_table(spark, d, "lineitem")
    u, v = F.col("l_discount") * 100 - 5, F.col("l_tax") * 100 - 4
    return li.select("l_orderkey", "l_linenumber", rnd(X.wind_speed(u, v)).alias("ws"),
                     rnd(X.wind_direction(u, v), 4).alias("wd"))


@register("p8_relative_humidity", S.with_sql("temps") + """
SELECT id, """ + S.r("100 * exp(17.625 * (tdk - 273.15) / (243.04 + (tdk - 273.15))) / exp(17.625 * (tk - 273.15) / (243.04 + (tk - 273.15)))") + """ AS rh,
  """ + S.r("100 * exp(17.625 * tdk / (243.04 + tdk)) / exp(17.625 * tk / (243.04 + tk))") + """ AS rh_compat FROM temps""")
def p8_relative_humidity(spark, d):
    t = S.temps(spark, d)
    return t.select("id", rnd(X.relative_humidity("tdk", "tk", "K")).alias("rh"),
                    rnd(X.relative_humidity("tdk", "tk", "K", compat=True)).alias("rh_compat"))


@register("p9_mean_two_times", _PIVOT_SQL + """
SELECT site, date, """ + S.r('("price-1" + "price-2") / 2') + """ AS price_mean FROM wide""")
def p9_mean_two_times(spark, d):
    w = wide_grid(spark, d)
    return w.select("site", "date", rnd(X.mean_two_times("`price-1`", "`price-2`")).alias("price_mean"))


# The reanalysis and scenario predictand -> parameter maps.
ERA5_MAP = {"WG_PT24H_MAX": "fg10", "TA_PT24H_MAX": "mx2t", "TA_PT24H_MIN": "mn2t",
            "TP_PT24H_ACC": "tp", "RH_PT24H_AVG": "rh", "WS_PT24H_AVG": "ws", "WD_PT24H_AVG": "wd"}
CORDEX_MAP = {"WG_PT24H_MAX": "maxWind", "TA_PT24H_MAX": "tasmax", "TA_PT24H_MIN": "tasmin",
              "TP_PT24H_ACC": "pr", "RH_PT24H_AVG": "hurs", "WS_PT24H_AVG": "sfcWind", "WD_PT24H_AVG": ""}


def named_wide(spark, d):
    w = wide_grid(spark, d).join(S.pred(spark, d), ["site", "date"], "left")
    return w.select("site", "date", F.col("obs").alias("TA_PT24H_MAX"),
                    F.col("`price-1`").alias("fg10-1"), F.col("`qty-1`").alias("ewss-1"),
                    F.col("`price-2`").alias("mx2t-1"), F.col("`qty-2`").alias("tp-1"),
                    F.col("`price-3`").alias("ws-1"), F.col("`qty-3`").alias("WG_PT24H_MAX"),
                    F.col("`price-4`").alias("tasmax-1"), F.col("`qty-4`").alias("pr-1"),
                    (F.col("`price-1`") * 2).alias("sfcWind_sum_mean"),
                    (F.col("`qty-1`") * 2).alias("WG_PT24H_MAX_mean"),
                    (F.col("`price-2`") * 2).alias("x_hurs"),
                    (F.col("`qty-2`") * 2).alias("maxWind_WG_PT24H_MAX_diff_mean"))


_NAMED_SQL = _PIVOT_SQL + """,
named AS (SELECT w.site, w.date, p.obs AS TA_PT24H_MAX, "price-1" AS "fg10-1", "qty-1" AS "ewss-1",
  "price-2" AS "mx2t-1", "qty-2" AS "tp-1", "price-3" AS "ws-1", "qty-3" AS WG_PT24H_MAX,
  "price-4" AS "tasmax-1", "qty-4" AS "pr-1", "price-1" * 2 AS sfcWind_sum_mean,
  "qty-1" * 2 AS WG_PT24H_MAX_mean, "price-2" * 2 AS x_hurs, "qty-2" * 2 AS maxWind_WG_PT24H_MAX_diff_mean
  FROM wide w LEFT JOIN (""" + S.SQL["pred"] + """) p USING (site, date))
"""


@register("p10_select_contains", _NAMED_SQL + """
SELECT site, date, TA_PT24H_MAX, "mx2t-1", "tasmax-1", "pr-1", sfcWind_sum_mean, x_hurs FROM named""")
def p10_select_contains(spark, d):
    # 'ewss-1' goes because it contains 'ws' (Q1); 'date' has no other name in it.
    return FR.select_feature_frame(named_wide(spark, d), "TA_PT24H_MAX", ERA5_MAP, "contains")


@register("p11_select_delimited", _NAMED_SQL + """
SELECT site, date, TA_PT24H_MAX, "fg10-1", "ewss-1", "mx2t-1", "tp-1", "ws-1", "tasmax-1", "pr-1",
  sfcWind_sum_mean, maxWind_WG_PT24H_MAX_diff_mean FROM named""")
def p11_select_delimited(spark, d):
    return FR.select_feature_frame(named_wide(spark, d), "TA_PT24H_MAX", CORDEX_MAP, "delimited",
                                   essentials=("utctime", "name", "latitude", "longitude", "TA_PT24H_MAX"))


@register("p12_rename_order", S.with_sql("subdaily") + """
SELECT site, CAST(time AS DATE) AS utctime, coalesce(max(WG_PT1H_MAX), max(WG_PT10M_MAX)) AS WG_PT24H_MAX,
  min(TA_PT12H_MIN) AS TA_PT24H_MIN, max(TA_PT12H_MAX) AS TA_PT24H_MAX,
  """ + S.r("sum(PRA_PT12H_ACC)") + """ AS TP_PT24H_ACC, """ + S.r("avg(RH_PT1H_AVG)") + """ AS RH_PT24H_AVG
FROM subdaily GROUP BY 1, 2""")
def p12_rename_order(spark, d):
    daily = C.daily_agg(S.subdaily(spark, d))
    out = FR.rename_by(daily, {"date": "utctime", "TN": "TA_PT24H_MIN", "TX": "TA_PT24H_MAX"},
                       substrings={"WG": "WG_PT24H_MAX", "TP": "TP_PT24H_ACC", "RH": "RH_PT24H_AVG"})
    out = FR.order_columns(out, ["utctime", "site", "WG_PT24H_MAX", "TA_PT24H_MAX", "TA_PT24H_MIN"])
    return out.withColumns({"TP_PT24H_ACC": rnd("TP_PT24H_ACC"), "RH_PT24H_AVG": rnd("RH_PT24H_AVG")})


_WIDE_COLS = ['"price-1"', '"price-2"', '"price-3"', '"price-4"', '"qty-1"', '"qty-2"', '"qty-3"', '"qty-4"']


@register("p13_complete_cases", _PIVOT_SQL + "SELECT site, date, " + ", ".join(
    f"{S.r(c, 4)} AS {c}" for c in _WIDE_COLS) + " FROM wide WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in _WIDE_COLS))
def p13_complete_cases(spark, d):
    out, _report = FR.complete_cases(wide_grid(spark, d))
    return out.select("site", "date", *[rnd(F.col(c.replace('"', '`')), 4).alias(c.strip('"')) for c in _WIDE_COLS])


@register("p14_round_cols", """
SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * (1 - l_discount) * 1e2, 0) / 1e2 AS revenue,
  round_even(l_quantity / 7 * 1e3, 0) / 1e3 AS qty FROM lineitem""")
def p14_round_cols(spark, d):
    li = S.read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_quantity") / 7).alias("qty"))
    return FR.round_cols(FR.round_cols(li, ["revenue"], 2), ["qty"], 3)


@register("p15_coerce_numeric", """
SELECT event_id, TRY_CAST(CASE WHEN event_type = 'click' THEN CAST(value AS VARCHAR) ELSE event_type END AS DOUBLE) AS v FROM events""")
def p15_coerce_numeric(spark, d):
    ev = S.read_table(spark, d, "events")
    raw = ev.select("event_id", F.when(F.col("event_type") == "click", F.col("value").cast("string"))
                    .otherwise(F.col("event_type")).alias("v"))
    return FR.coerce_numeric(raw, ["v"])


@register("p16_clamp_min", """
SELECT l_orderkey, l_linenumber, """ + S.r("greatest(l_discount * 100 - 5, 0)") + """ AS u FROM lineitem""")
def p16_clamp_min(spark, d):
    li = S.read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", rnd(X.clamp_min(F.col("l_discount") * 100 - 5, 0.0)).alias("u"))


@register("p17_point_mean", S.with_sql("grid") + """
SELECT site, date, """ + S.r("coalesce(sum(price), 0) / 4") + """ AS price_sum FROM grid GROUP BY site, date""")
def p17_point_mean(spark, d):
    out = FR.point_mean(S.grid(spark, d), "price")
    return out.withColumn("price_sum", rnd("price_sum"))


@register("p19_shift_time", """
SELECT event_id, strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS utctime FROM events""")
def p19_shift_time(spark, d):
    ev = S.read_table(spark, d, "events")
    return ev.select("event_id", F.date_format(X.shift_time("ts", -1), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("utctime"))


@register("p20_labels", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, monthname(o_orderdate) AS month_name,
  strftime(o_orderdate, '%d.%m.%Y') AS day FROM orders""")
def p20_labels(spark, d):
    o = S.read_table(spark, d, "orders")
    return o.select("o_orderkey", X.month_label("o_orderdate").alias("month"),
                    X.month_name("o_orderdate").alias("month_name"), X.day_label("o_orderdate").alias("day"))


@register("p21_haversine", S.with_sql("cells", "sites") + """
SELECT c.id, """ + S.r("2 * 6371.0 * asin(sqrt(pow(sin((radians(s.latitude) - radians(c.lat)) / 2), 2) + cos(radians(c.lat)) * cos(radians(s.latitude)) * pow(sin((radians(s.longitude) - radians(c.lon)) / 2), 2)))", 4) + """ AS dist_km
FROM cells c JOIN sites s USING (site)""")
def p21_haversine(spark, d):
    c = S.cells(spark, d).join(S.sites(spark, d), "site")
    return c.select("id", rnd(X.haversine_km("lat", "lon", "latitude", "longitude"), 4).alias("dist_km"))


@register("p22_split_feature", """
SELECT DISTINCT l_returnflag || '-' || CAST(l_linenumber AS VARCHAR) AS feature,
  CASE WHEN l_linenumber BETWEEN 1 AND 4 THEN CAST(l_linenumber AS VARCHAR) ELSE 'Other' END AS point,
  CASE WHEN l_linenumber BETWEEN 1 AND 4 THEN l_returnflag ELSE l_returnflag || '-' || CAST(l_linenumber AS VARCHAR) END AS base
FROM lineitem""")
def p22_split_feature(spark, d):
    li = S.read_table(spark, d, "lineitem")
    f = li.select(F.concat("l_returnflag", F.lit("-"), F.col("l_linenumber").cast("string")).alias("feature")).distinct()
    return f.select("feature", X.feature_point("feature").alias("point"), X.feature_base("feature").alias("base"))


@register("p23_align_features", _PIVOT_SQL + """
SELECT site, date, """ + S.r('"price-2"', 4) + """ AS "price-2", """ + S.r('"qty-1"', 4) + """ AS "qty-1", 0.0::DOUBLE AS "tp-9" FROM wide""")
def p23_align_features(spark, d):
    out = FR.align_features(wide_grid(spark, d), ["price-2", "qty-1", "tp-9"], keep=["site", "date"])
    return out.withColumns({"price-2": rnd("`price-2`", 4), "qty-1": rnd("`qty-1`", 4)})


@register("p24_exceeds", "SELECT event_id, value FROM events WHERE value > 300")
def p24_exceeds(spark, d):
    return FR.exceeds(S.read_table(spark, d, "events").select("event_id", "value"), "value", 300.0)


@register("p24_below", "SELECT event_id, value FROM events WHERE value < 1.0")
def p24_below(spark, d):
    return FR.exceeds(S.read_table(spark, d, "events").select("event_id", "value"), "value", 1.0, "below")


@register("p25_stamp", S.with_sql("pred") + """
SELECT site, date, """ + S.r("obs", 4) + """ AS obs, 'Harbour' AS name, 60.25 ::DOUBLE AS latitude, 24.75::DOUBLE AS longitude FROM pred""")
def p25_stamp(spark, d):
    out = FR.stamp(S.pred(spark, d), {"name": "Harbour", "latitude": 60.25, "longitude": 24.75})
    return out.withColumn("obs", rnd("obs", 4))
