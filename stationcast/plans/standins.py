"""Map the driver's tables onto the reference data model.

Each builder returns a Spark DataFrame; ``SQL`` holds the matching DuckDB
CTE body under the same name so oracle queries are built from the same
definitions.  Keys: ``site`` is derived from an id column (a key, never a
filter), ``date`` is the day of a ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import read_table

# Fixed values of the stand-ins.
EVENT_SITES = 4          # site = user_id % 4
GRID_SITES = 3           # site = orderkey % 3
N_POINTS = 4             # grid point = (l_linenumber - 1) % 4 + 1
CUTOFF = "1999-12-31"    # past / future split of the gridded series

SQL = {
    "subdaily": """SELECT user_id % 4 AS site, ts AS time,
        CASE WHEN event_type = 'click' THEN value END AS WG_PT1H_MAX,
        CASE WHEN event_type = 'view' THEN value END AS WG_PT10M_MAX,
        CASE WHEN event_type = 'signup' THEN value END AS TA_PT12H_MIN,
        CASE WHEN event_type = 'signup' THEN value END AS TA_PT12H_MAX,
        CASE WHEN event_type = 'purchase' THEN value END AS PRA_PT12H_ACC,
        CASE WHEN event_type = 'error' THEN value END AS RH_PT1H_AVG
        FROM events""",
    "ens": """SELECT user_id % 4 AS site, user_id AS member, CAST(ts AS DATE) AS date,
        max(value) AS value FROM events GROUP BY 1, 2, 3""",
    "hourly": """SELECT user_id % 4 AS site, date_trunc('hour', ts) AS time,
        max(value) AS value FROM events GROUP BY 1, 2""",
    "grid": """SELECT l_orderkey % 3 AS site, CAST(l_shipdate AS DATE) AS date,
        (l_linenumber - 1) % 4 + 1 AS point, max(l_extendedprice) AS price, avg(l_quantity) AS qty
        FROM lineitem GROUP BY 1, 2, 3""",
    "pred": """SELECT o_orderkey % 3 AS site, CAST(o_orderdate AS DATE) AS date,
        avg(o_totalprice) AS obs FROM orders GROUP BY 1, 2""",
    "cells": """SELECT c_custkey AS id, c_nationkey AS site, c_mktsegment AS segment,
        CAST(c_nationkey * 3 - 30 AS DOUBLE) + CASE WHEN c_custkey % 2 = 1 THEN 0.25 ELSE 0.0 END::DOUBLE AS lat,
        CAST(c_nationkey * 2 - 20 AS DOUBLE) + CASE WHEN c_custkey % 4 >= 2 THEN 0.25 ELSE 0.0 END::DOUBLE AS lon,
        c_acctbal AS value FROM customer""",
    "sites": """SELECT n_nationkey AS site, n_name AS name,
        CAST(n_nationkey * 3 - 30 AS DOUBLE) AS latitude, CAST(n_nationkey * 2 - 20 AS DOUBLE) AS longitude,
        CASE WHEN n_nationkey % 2 = 0 THEN '19960101T000000Z' END AS start,
        CASE WHEN n_nationkey % 3 = 0 THEN '20001231T000000Z' END AS "end" FROM nation""",
    "temps": """SELECT s_suppkey AS id, s_nationkey AS site,
        CASE WHEN s_nationkey % 2 = 0 THEN s_acctbal / 500 ELSE 273.15 + s_acctbal / 500 END AS t,
        273.15 + s_acctbal / 500 AS tk, 273.15 + s_acctbal / 500 - s_nationkey / 10 AS tdk FROM supplier""",
}


def subdaily(spark: SparkSession, d: str) -> DataFrame:
    """Sub-daily station observations (wide, one column per source name)."""
    ev = read_table(spark, d, "events")
    v, t = F.col("value"), F.col("event_type")

    def pick(kind):
        return F.when(t == kind, v)
    return ev.select(
        (F.col("user_id") % EVENT_SITES).alias("site"), F.col("ts").alias("time"),
        pick("click").alias("WG_PT1H_MAX"), pick("view").alias("WG_PT10M_MAX"),
        pick("signup").alias("TA_PT12H_MIN"), pick("signup").alias("TA_PT12H_MAX"),
        pick("purchase").alias("PRA_PT12H_ACC"), pick("error").alias("RH_PT1H_AVG"))


def ens(spark: SparkSession, d: str) -> DataFrame:
    """Daily ensemble in long form (site, member, date, value)."""
    ev = read_table(spark, d, "events")
    return (ev.groupBy((F.col("user_id") % EVENT_SITES).alias("site"),
                       F.col("user_id").alias("member"),
                       F.to_date("ts").alias("date"))
            .agg(F.max("value").alias("value")))


def event_series(spark: SparkSession, d: str) -> DataFrame:
    """Daily maximum of every event series (user and type); days without events are absent."""
    return (read_table(spark, d, "events").groupBy(F.col("user_id").alias("site"), F.col("event_type").alias("kind"), F.to_date("ts").alias("date"))
            .agg(F.max("value").alias("value")))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hourly station series (site, time, value)."""
    ev = read_table(spark, d, "events")
    return (ev.groupBy((F.col("user_id") % EVENT_SITES).alias("site"),
                       F.date_trunc("hour", "ts").alias("time"))
            .agg(F.max("value").alias("value")))


def grid(spark: SparkSession, d: str) -> DataFrame:
    """Gridded daily predictors in long form (site, date, point, price, qty).

    ``price`` is the day's largest cent-valued price, so means built on it
    are short exact decimals: the DuckDB comparison then never meets a
    rounding tie caused by summation order.
    """
    li = read_table(spark, d, "lineitem")
    return (li.groupBy((F.col("l_orderkey") % GRID_SITES).alias("site"),
                         F.to_date("l_shipdate").alias("date"),
                       ((F.col("l_linenumber") - 1) % N_POINTS + 1).alias("point"))
            .agg(F.max("l_extendedprice").alias("price"), F.avg("l_quantity").alias("qty")))


def pred(spark: SparkSession, d: str) -> DataFrame:
    """Daily predictand observations (site, date, obs)."""
    o = read_table(spark, d, "orders")
    return (o.groupBy((F.col("o_orderkey") % GRID_SITES).alias("site"),
                      F.to_date("o_orderdate").alias("date"))
            .agg(F.avg("o_totalprice").alias("obs")))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Grid cells: four (lat, lon) cells per nation, one row per customer."""
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("id"), F.col("c_nationkey").alias("site"), F.col("c_mktsegment").alias("segment"),
        ((F.col("c_nationkey") * 3 - 30).cast("double") + F.when(k % 2 == 1, 0.25).otherwise(0.0)).alias("lat"),
        ((F.col("c_nationkey") * 2 - 20).cast("double") + F.when(k % 4 >= 2, 0.25).otherwise(0.0)).alias("lon"),
        F.col("c_acctbal").alias("value"))


def sites(spark: SparkSession, d: str) -> DataFrame:
    """Site dimension with compact-stamp bounds (some missing)."""
    n = read_table(spark, d, "nation")
    k = F.col("n_nationkey")
    return n.select(
        k.alias("site"), F.col("n_name").alias("name"),
        (k * 3 - 30).cast("double").alias("latitude"), (k * 2 - 20).cast("double").alias("longitude"),
        F.when(k % 2 == 0, F.lit("19960101T000000Z")).alias("start"),
        F.when(k % 3 == 0, F.lit("20001231T000000Z")).alias("end"))


def temps(spark: SparkSession, d: str) -> DataFrame:
    """Temperatures: ``t`` in Celsius for even nations and Kelvin for odd
    ones; ``tk`` / ``tdk`` temperature and dewpoint in Kelvin."""
    s = read_table(spark, d, "supplier")
    base = F.col("s_acctbal") / 500
    return s.select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("site"),
        F.when(F.col("s_nationkey") % 2 == 0, base).otherwise(F.lit(273.15) + base).alias("t"),
        (F.lit(273.15) + base).alias("tk"),
        (F.lit(273.15) + base - F.col("s_nationkey") / 10).alias("tdk"))


def r(expr: str, n: int = 6) -> str:
    """SQL twin of ``scalars.rnd``."""
    return f"round(({expr}) * 1e{n} + 0.4142135623730951) / 1e{n}"


def with_sql(*names: str) -> str:
    """``WITH`` clause defining the named stand-ins for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n"
