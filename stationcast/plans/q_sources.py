"""Catalogue: sources and sinks.

Text inputs are staged from the driver's tables into the shared checkpoint
folder by Spark writers (one file per key, written by parallel tasks), then
read back through the source operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators.common import stage_path
from stationcast.plans import standins as S
from stationcast.plans.registry import register
from stationcast.sources import readers as SRC


def _lines_with_junk(df, keys, order, line, head, tail):
    """Rows of ``df`` as text lines, each key's file framed by junk lines."""
    body = df.select(*keys, F.col(order).cast("double").alias("_o"), line.alias("value"))
    k = df.select(*keys).distinct()
    heads = [k.select(*keys, F.lit(-float(head - i)).alias("_o"), F.lit(f"# tool output line {i}").alias("value"))
             for i in range(head)]
    tails = [k.select(*keys, F.lit(1e12 + i).alias("_o"), F.lit(f"-- end {i}").alias("value"))
             for i in range(tail)]
    out = body
    for x in heads + tails:
        out = out.unionByName(x)
    return out


def _write_text(df, keys, path):
    (df.repartition(*keys).sortWithinPartitions(*keys, "_o").drop("_o")
     .write.mode("overwrite").partitionBy(*keys).text(path))
    return path


@register("s1_read_table", """
SELECT l_orderkey, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def s1_read_table(spark, d):
    path = stage_path(spark, "s1")
    li = S.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                  F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    li.write.option("header", True).option("compression", "gzip").csv(path)
    schema = "l_orderkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_shipdate STRING"
    out = SRC.read_table(spark, path, schema, ["l_orderkey", "l_quantity", "l_shipdate"],
                         date_cols=["l_shipdate"], date_format="yyyy-MM-dd")
    return out.withColumn("l_shipdate", F.to_date("l_shipdate"))


@register("s2_trimmed_csv", S.with_sql("pred") + """
SELECT site, date, """ + S.r("obs", 4) + """ AS obs FROM pred""")
def s2_trimmed_csv(spark, d):
    p = S.pred(spark, d).withColumn("year", F.year("date"))
    line = F.concat_ws(",", F.date_format("date", "yyyy-MM-dd"), F.lit("60.25"), F.lit("24.75"), F.col("obs").cast("string"))
    path = _write_text(_lines_with_junk(p.withColumn("_ord", F.dayofyear("date")), ["site", "year"], "_ord",
                                        line, 3, 4), ["site", "year"], stage_path(spark, "s2"))
    out = SRC.read_trimmed_csv(spark, path, 3, 4, "date DATE, lat DOUBLE, lon DOUBLE, obs DOUBLE")
    return out.select(F.col("site").cast("bigint").alias("site"), "date", rnd("obs", 4).alias("obs"))


@register("s2_trimmed_csv_pattern", S.with_sql("pred") + """
SELECT site, date, """ + S.r("obs", 4) + """ AS obs FROM pred""")
def s2_trimmed_csv_pattern(spark, d):
    p = S.pred(spark, d).withColumn("year", F.year("date"))
    line = F.concat_ws(",", F.date_format("date", "yyyy-MM-dd"), F.lit("60.25"), F.lit("24.75"), F.col("obs").cast("string"))
    path = _write_text(_lines_with_junk(p.withColumn("_ord", F.dayofyear("date")), ["site", "year"], "_ord",
                                        line, 3, 4), ["site", "year"], stage_path(spark, "s2p"))
    out = SRC.read_trimmed_csv(spark, path, 0, 0, "date DATE, lat DOUBLE, lon DOUBLE, obs DOUBLE",
                               record_pattern=r"^\d{4}-\d{2}-\d{2},")
    return out.select(F.col("site").cast("bigint").alias("site"), "date", rnd("obs", 4).alias("obs"))


_BLEND_SQL = S.with_sql("pred") + """,
blend AS (SELECT site + 1 AS staid, date,
  CASE WHEN day(date) = 13 THEN NULL ELSE CAST(round(obs / 1000) AS INTEGER) / 10.0 END AS value FROM pred)
"""


def blend_files(spark, d):
    p = S.pred(spark, d)
    raw = F.when(F.dayofmonth("date") == 13, F.lit(-9999)).otherwise(F.round(F.col("obs") / 1000).cast("int"))
    line = F.concat_ws(",", F.format_string("%6d", (F.col("site") + 1).cast("int")), F.lit("   100"),
                       F.date_format("date", "yyyyMMdd"), F.format_string("%5d", raw), F.lit("    0"))
    df = _lines_with_junk(p.withColumn("_ord", F.datediff("date", F.lit("1990-01-01"))), ["site"], "_ord", line, 3, 1)
    return _write_text(df, ["site"], stage_path(spark, "s3"))


@register("s3_station_blend", _BLEND_SQL + "SELECT staid, date, " + S.r("value", 4) + " AS value FROM blend")
def s3_station_blend(spark, d):
    out = SRC.read_station_blend(spark, blend_files(spark, d))
    return out.select(F.col("staid").cast("bigint").alias("staid"), "date", rnd("value", 4).alias("value"))


def catalog_lines(spark, d):
    """Station catalogue text from the supplier table: one station per
    supplier, DMS coordinates; stations with a negative balance carry a
    malformed longitude."""
    s = S.read_table(spark, d, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    lat = F.format_string("%s%02d:%02d:%02d", F.when(n * 3 - 30 < 0, "-").otherwise("+"),
                          F.abs(n * 3 - 30), k % 60, (k * 7) % 60)
    lon = F.when(F.col("s_acctbal") < 0, F.lit("bad")).otherwise(
        F.format_string("+%03d:%02d:%02d", n * 2, (k * 11) % 60, (k * 13) % 60))
    return s.select(F.concat_ws(",", k.cast("string"), F.col("s_name"), F.lit("XX"), lat, lon,
                                F.lit("12")).alias("value"))


@register("s4_station_catalog", """
SELECT CAST(s_suppkey AS INTEGER) AS staid, s_name AS name,
  """ + S.r("sign(s_nationkey * 3 - 30 + 0.5) * (abs(s_nationkey * 3 - 30) + (s_suppkey % 60) / 60.0 + ((s_suppkey * 7) % 60) / 3600.0)") + """ AS lat,
  CASE WHEN s_acctbal < 0 THEN NULL ELSE """ + S.r("(s_nationkey * 2) + ((s_suppkey * 11) % 60) / 60.0 + ((s_suppkey * 13) % 60) / 3600.0") + """ END AS lon
FROM supplier""")
def s4_station_catalog(spark, d):
    header = spark.createDataFrame([("STAID,STANAME                                 ,CN,      LAT,       LON,HGHT",)], "value string")
    lines = header.unionByName(catalog_lines(spark, d))
    cat = SRC.parse_station_catalog(lines)
    return cat.select(F.col("staid").cast("int").alias("staid"), "name", rnd("lat").alias("lat"), rnd("lon").alias("lon"))


@register("s5_packed_series", """
SELECT vec_id AS utctime, CAST(k - 1 AS INTEGER) AS cell, """ + S.r("60 + (k - 1) * 0.25") + """ AS lat,
  """ + S.r("20 + (k - 1) * 0.5") + """ AS lon, """ + S.r("CAST(embedding[k] AS DOUBLE)", 5) + """ AS value
FROM embeddings, range(1, 65) t(k) WHERE label <> 0""")
def s5_packed_series(spark, d):
    e = S.read_table(spark, d, "embeddings")
    n = F.size("embedding")
    idx = F.sequence(F.lit(0), n - 1)
    lats = F.transform(idx, lambda i: (F.lit(60.0) + i * 0.25).cast("string"))
    lons = F.transform(idx, lambda i: (F.lit(20.0) + i * 0.5).cast("string"))
    # label 0 rows carry one coordinate too few: dropped as malformed
    lons = F.when(F.col("label") == 0, F.slice(lons, 1, n - 1)).otherwise(lons)
    vals = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    packed = e.select(F.col("vec_id").alias("utctime"),
                      F.concat(F.lit("["), F.array_join(lats, " "), F.lit("]")).alias("lat"),
                      F.concat(F.lit("["), F.array_join(lons, " "), F.lit("]")).alias("lon"),
                      F.concat(F.lit("[ "), F.array_join(vals, "  "), F.lit(" ]")).alias("value"))
    out = SRC.explode_packed_series(packed, ["lat", "lon", "value"], uneven="drop")
    return out.select("utctime", "cell", rnd("lat").alias("lat"), rnd("lon").alias("lon"), rnd("value", 5).alias("value"))


_PERIOD = "struct<dateTimeISO:string,tempC:double,windGustMPS:double>"
_RESP = f"struct<response:array<struct<place:struct<name:string,country:string>,loc:struct<lat:double,long:double>,periods:array<{_PERIOD}>>>>"


@register("s6_flatten_periods", """
SELECT 'u' || CAST(user_id AS VARCHAR) AS place_name, CAST(user_id % 90 AS DOUBLE) AS loc_lat,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS dateTimeISO, value AS tempC, value * 2 AS windGustMPS FROM events
UNION ALL
SELECT 'u' || CAST(user_id AS VARCHAR), CAST(user_id % 90 AS DOUBLE),
  strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S'), value - 1, NULL FROM events""")
def s6_flatten_periods(spark, d):
    ev = S.read_table(spark, d, "events")
    p1 = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("dateTimeISO"), F.col("value").alias("tempC"),
                  (F.col("value") * 2).alias("windGustMPS"))
    p2 = F.struct(F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss").alias("dateTimeISO"),
                  (F.col("value") - 1).alias("tempC"), F.lit(None).cast("double").alias("windGustMPS"))
    rec = F.struct(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
                            F.lit("XX").alias("country")).alias("place"),
                   F.struct((F.col("user_id") % 90).cast("double").alias("lat"), F.lit(0.0).alias("long")).alias("loc"),
                   F.array(p1, p2).alias("periods"))
    js = ev.select(F.to_json(F.struct(F.array(rec).alias("response"))).alias("json"))
    parsed = js.select(F.from_json("json", _RESP).alias("j")).select("j.response")
    return SRC.flatten_periods(parsed, parent_fields=["place.name", "loc.lat"])


@register("s7_site_dim", S.with_sql("pred", "sites") + """
SELECT p.site, p.date, s.name, coalesce(CAST(strptime(s.start, '%Y%m%dT%H%M%SZ') AS DATE), DATE '2000-01-01') AS start,
  coalesce(CAST(strptime(s."end", '%Y%m%dT%H%M%SZ') AS DATE), DATE '2025-01-01') AS "end"
FROM pred p LEFT JOIN sites s ON p.site = s.site""")
def s7_site_dim(spark, d):
    dim = S.sites(spark, d).withColumn("site", F.col("site").cast("bigint"))
    out = SRC.with_site_dim(S.pred(spark, d), dim)
    return out.select("site", "date", "name", "start", "end")


@register("s8_cube_to_rows", """
SELECT vec_id, CAST((k - 1) // 8 AS INTEGER) AS i, CAST((k - 1) % 8 AS INTEGER) AS j,
  """ + S.r("CAST(embedding[k] AS DOUBLE)") + """ AS value FROM embeddings, range(1, 65) t(k)""")
def s8_cube_to_rows(spark, d):
    e = S.read_table(spark, d, "embeddings")
    cube = e.select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(7)),
                                          lambda i: F.slice("embedding", i * 8 + 1, 8)).alias("cube"))
    out = SRC.cube_to_rows(cube, "cube", ["i", "j"], keep=["vec_id"])
    return out.select("vec_id", "i", "j", rnd(F.col("value").cast("double")).alias("value"))


_TAGS = ["Malaga_WG_PT24H_MAX_rcp45_cnrm", "Malaga_TP_rcp85_ecearth", "Bremerhaven_TA_MAX_rcp45_mpi"]


@register("s9_read_keyed", S.with_sql("pred") + """
SELECT t.location, t.predictand, t.scenario, t.model, p.date, """ + S.r("p.obs", 4) + """ AS obs
FROM pred p JOIN (VALUES (0, 'Malaga', 'WG_PT24H_MAX', 'rcp45', 'cnrm'), (1, 'Malaga', 'TP', 'rcp85', 'ecearth'),
  (2, 'Bremerhaven', 'TA_MAX', 'rcp45', 'mpi')) t(site, location, predictand, scenario, model) ON p.site = t.site""")
def s9_read_keyed(spark, d):
    p = S.pred(spark, d)
    tag = F.element_at(F.array(*[F.lit(t) for t in _TAGS] + [F.lit("foreign")]), (F.col("site") + 1).cast("int"))
    path = stage_path(spark, "s9")
    p.withColumn("tag", tag).write.partitionBy("tag").option("header", True).csv(path)
    # a file of another layout in the same tree is skipped by the name pattern
    spark.createDataFrame([("x", 1.0)], "date string, obs double").write.option("header", True).csv(path + "/other")
    pattern = r"tag=([A-Za-z]+)_(.+)_(rcp\d+|ssp\d+)_([A-Za-z0-9]+)/"
    out = SRC.read_keyed(spark, path, pattern, ["location", "predictand", "scenario", "model"],
                         schema="site long, date date, obs double", path_col="file_path")
    return out.select("location", "predictand", "scenario", "model", "date", rnd("obs", 4).alias("obs"))


@register("s10_write_keyed", S.with_sql("pred") + "SELECT site, date, " + S.r("obs", 4) + " AS obs FROM pred")
def s10_write_keyed(spark, d):
    path = SRC.write_keyed(S.pred(spark, d), stage_path(spark, "s10"), ["site"])
    back = spark.read.parquet(path)
    return back.select(F.col("site").cast("bigint").alias("site"), "date", rnd("obs", 4).alias("obs"))


@register("s11_union_chunks", S.with_sql("pred") + "SELECT site, date, " + S.r("obs", 4) + " AS obs FROM pred")
def s11_union_chunks(spark, d):
    p = S.pred(spark, d)
    years = [r[0] for r in p.select(F.year("date")).distinct().collect()]  # a few rows: one per year
    chunks = [p.filter(F.year("date") == y) for y in sorted(years)]
    return SRC.union_chunks(chunks).withColumn("obs", rnd("obs", 4))


@register("s12_bbox_filter", S.with_sql("cells", "sites") + """
SELECT c.id, s.site, c.lat, c.lon FROM cells c JOIN sites s
  ON abs(c.lat - s.latitude) <= 0.2 AND abs(c.lon - s.longitude) <= 0.2""")
def s12_bbox_filter(spark, d):
    c = S.cells(spark, d).drop("site")
    out = SRC.bbox_filter(c, S.sites(spark, d), 0.2)
    return out.select("id", "site", "lat", "lon")


@register("s13_splice_runs", S.with_sql("pred", "grid") + """
SELECT site, date, """ + S.r("obs", 4) + """ AS value FROM pred WHERE date <= DATE '1999-12-31'
UNION ALL
SELECT site, date, """ + S.r("avg(price)") + """ FROM grid WHERE year(date) BETWEEN 2000 AND 2001 GROUP BY site, date""")
def s13_splice_runs(spark, d):
    hist = S.pred(spark, d).filter(F.col("date") <= F.lit(S.CUTOFF).cast("date")).select(
        "site", "date", rnd("obs", 4).alias("value"))
    scen = S.grid(spark, d).groupBy("site", "date").agg(rnd(F.avg("price")).alias("value"))
    return SRC.splice_runs(hist, scen, 2000, 2001)
