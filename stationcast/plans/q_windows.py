"""Catalogue: time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationcast.functions.scalars import rnd
from stationcast.operators import reshape as R
from stationcast.operators import windows as W
from stationcast.plans import standins as S
from stationcast.plans.q_frames import _PIVOT_SQL, wide_grid
from stationcast.plans.registry import register

_P = ['price-1', 'price-2', 'price-3', 'price-4']


def _q(c):
    return '"' + c + '"'


@register("w1_shift_days", _PIVOT_SQL + "SELECT w.site, w.date, " + ", ".join(
    f'{S.r("w." + _q(c))} AS {_q(c)}, {S.r("p." + _q(c))} AS {_q(c + "_lag")}' for c in _P)
    + " FROM wide w LEFT JOIN wide p ON p.site = w.site AND p.date + 1 = w.date")
def w1_shift_days(spark, d):
    w = wide_grid(spark, d).select("site", "date", *[F.col(f"`{c}`") for c in _P])
    out = W.shift_days(w, _P)
    return out.select("site", "date", *[rnd(F.col(f"`{c}`")).alias(c) for c in _P],
                      *[rnd(F.col(f"`{c}_lag`")).alias(f"{c}_lag") for c in _P])


@register("w1_shift_rows", _PIVOT_SQL + "SELECT site, date, " + S.r('"price-1"') + ' AS "price-1", '
          + S.r('lag("price-1") OVER (PARTITION BY site ORDER BY date)') + ' AS "price-1_lag" FROM wide')
def w1_shift_rows(spark, d):
    """Previous row within the site (D6: physical order on an irregular series)."""
    w = wide_grid(spark, d).select("site", "date", "`price-1`")
    out = W.shift_rows(w, ["price-1"])
    return out.select("site", "date", rnd("`price-1`").alias("price-1"), rnd("`price-1_lag`").alias("price-1_lag"))


@register("w2_delta", _PIVOT_SQL + "SELECT w.site, w.date, " + ", ".join(
    f'{S.r("w." + _q(c) + " - p." + _q(c))} AS {_q("D" + c)}' for c in _P)
    + " FROM wide w LEFT JOIN wide p ON p.site = w.site AND p.date + 1 = w.date")
def w2_delta(spark, d):
    w = wide_grid(spark, d).select("site", "date", *[F.col(f"`{c}`") for c in _P])
    out = W.delta(w, _P)
    return out.select("site", "date", *[rnd(F.col(f"`D{c}`")).alias(f"D{c}") for c in _P])


_W3_SQL = S.with_sql("hourly") + """,
t AS (SELECT site, time, {fn}(value) OVER (PARTITION BY site ORDER BY time
      RANGE BETWEEN (INTERVAL 1 DAY - INTERVAL 1 MICROSECOND) PRECEDING AND CURRENT ROW) AS v FROM hourly)
"""


@register("w3_trailing_24h_sampled", _W3_SQL.format(fn="max") + """
SELECT site, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, v AS max_24h FROM t WHERE hour(time) = 0""")
def w3_trailing_24h_sampled(spark, d):
    out = W.trailing_agg_sampled(S.hourly(spark, d), "value", "max")
    return out.select("site", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "max_24h")


@register("w3_trailing_24h", _W3_SQL.format(fn="sum") + """
SELECT site, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, """ + S.r("v") + """ AS sum_24h FROM t""")
def w3_trailing_24h(spark, d):
    out = W.trailing_agg(S.hourly(spark, d), "value", "sum")
    return out.select("site", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), rnd("sum_24h").alias("sum_24h"))


@register("w4_ffill", """
WITH p AS (SELECT user_id AS site, event_type AS kind, CAST(ts AS DATE) AS date, max(value) AS value
           FROM events GROUP BY 1, 2, 3),
b AS (SELECT site, kind, min(date) AS lo, max(date) AS hi FROM p GROUP BY 1, 2),
spine AS (SELECT site, kind, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
r AS (SELECT s.site, s.kind, s.date, p.value FROM spine s LEFT JOIN p USING (site, kind, date))
SELECT site, kind, date, value AS raw, last_value(value IGNORE NULLS) OVER (PARTITION BY site, kind ORDER BY date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM r""")
def w4_ffill(spark, d):
    keys = ["site", "kind"]
    r = R.reindex_daily(S.event_series(spark, d), keys).withColumn("raw", F.col("value"))
    return W.ffill(r, ["value"], keys, chunk="week").select("site", "kind", "date", "raw", "value")
