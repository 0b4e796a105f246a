"""Registry of catalogue queries and their DuckDB oracle SQL.

A catalogue query is ``fn(spark, sf_dir) -> DataFrame`` over the driver's
tables (through the stand-ins).  Oracle SQL, when given, must produce the
same column names, row count and values.

Dates leave both engines as ISO ``yyyy-MM-dd`` text: Spark and DuckDB hand
DATE values to Python as different types (``datetime.date`` versus a
timestamp in pandas), so text keeps the comparison exact whatever the
consumer does with the rows.  Operators themselves keep ``DateType``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    """DATE columns as ISO text, other columns unchanged and in place."""
    if not any(t == "date" for _, t in df.dtypes):
        return df
    return df.select(*[F.date_format(F.col(f"`{c}`"), "yyyy-MM-dd").alias(c) if t == "date"
                       else F.col(f"`{c}`") for c, t in df.dtypes])


def sql_dates_as_text(sql: str, cols: list[str]) -> str:
    """Wrap oracle SQL so the listed DATE columns come out as ISO text."""
    if not cols:
        return sql
    rep = ", ".join(f"strftime(\"{c}\", '%Y-%m-%d') AS \"{c}\"" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n)"


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        RAW_QUERIES[name] = fn

        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return dates_as_text(fn(spark, sf_dir))
        query.__name__ = fn.__name__
        query.__doc__ = fn.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def oracle_sql() -> dict[str, str]:
    """Oracle SQL of every query, with its DATE outputs as ISO text."""
    from stationcast.plans.date_columns import DATE_COLUMNS
    load_all()
    return {k: sql_dates_as_text(v, DATE_COLUMNS.get(k, [])) for k, v in ORACLE.items()}


def load_all() -> None:
    """Import every catalogue module so its queries register."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"stationcast.plans.{mod}")


MODULES = ["q_ensemble", "q_frames", "q_reshape", "q_sources", "q_windows", "q_joins",
           "q_climatology", "q_quality", "q_correction", "q_calendar", "q_models", "q_streaming",
           "q_flows"]
