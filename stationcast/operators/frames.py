"""Projection, filter and column-set operators.

Column-set decisions (P10, P11, P23) are metadata-only: they inspect
``df.columns`` and emit a ``select``, so Catalyst prunes the parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.functions.scalars import KELVIN_OFFSET, SECONDS_PER_DAY

# Default analysis window used when a site has no bounds.
DEFAULT_START = "2000-01-01"
DEFAULT_END = "2025-01-01"


# ------------------------------------------------------------------ P1
def add_date_parts(df: DataFrame, ts: str = "utctime",
                   parts: Sequence[str] = ("dayOfYear", "year", "month", "hour")) -> DataFrame:
    """Add day of year, year, month and hour columns."""
    fns = {"dayOfYear": F.dayofyear, "year": F.year, "month": F.month, "hour": F.hour,
           "day": F.dayofmonth}
    return df.withColumns({p: fns[p](F.col(ts)) for p in parts})


# ------------------------------------------------------------------ P2
def clip_period(df: DataFrame, sites: DataFrame | None = None, start: str | None = None,
                end: str | None = None, keys: Sequence[str] = ("site",), date: str = "date",
                open_end: bool = False) -> DataFrame:
    """Inclusive date-range filter.

    With ``sites`` (keys, start, end) each site has its own window; missing
    bounds, and sites without an entry, fall back to the defaults; ``open_end`` keeps everything from
    the start on (prediction window).  The site table is one row per site.
    """
    d = F.col(date)
    if sites is None:
        cond = F.lit(True)
        if start is not None:
            cond = cond & (d >= F.lit(start).cast(df.schema[date].dataType))
        if end is not None and not open_end:
            cond = cond & (d <= F.lit(end).cast(df.schema[date].dataType))
        return df.filter(cond)
    b = sites.select(*keys, F.col("start").cast("date").alias("_start"), F.col("end").cast("date").alias("_end"))
    cond = d.cast("date") >= F.coalesce("_start", F.lit(DEFAULT_START).cast("date"))
    if not open_end:
        cond = cond & (d.cast("date") <= F.coalesce("_end", F.lit(DEFAULT_END).cast("date")))
    return df.join(b, list(keys), "left").filter(cond).drop("_start", "_end")


# ------------------------------------------------------------------ P3
def null_if(df: DataFrame, cols: Iterable[str], predicate: Callable[[Column], Column]) -> DataFrame:
    """Replace values for which ``predicate(col)`` holds by null."""
    return df.withColumns({c: F.when(predicate(F.col(c)), F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def null_sentinel(df: DataFrame, cols: Iterable[str], sentinel: float = -9999) -> DataFrame:
    """Sentinel value (ECA&D ``-9999``) -> null."""
    return null_if(df, cols, lambda c: c == F.lit(sentinel))


# ------------------------------------------------------------------ P5
# Unit detection rules (statistic, test, conversion).
UNIT_RULES = {
    "C_to_K": ("median", lambda s: s < 100, lambda c: c + KELVIN_OFFSET),
    "K_to_C": ("median", lambda s: s > 100, lambda c: c - KELVIN_OFFSET),
    "K_to_C_by_max": ("max", lambda s: s > 200, lambda c: c - KELVIN_OFFSET),
    "mmday_to_ms": ("max", lambda s: s > 0.001, lambda c: c / (SECONDS_PER_DAY * 1000.0)),
    "ms_to_mmday": ("max", lambda s: (s > 0) & (s < 0.001), lambda c: c * SECONDS_PER_DAY * 1000.0),
    "flux_to_mmday": ("max", lambda s: s < 0.1, lambda c: c * SECONDS_PER_DAY),
}


def unit_stats(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Per-key median (bounded-memory sketch) and max of ``col``.

    The median only decides between unit systems that differ by orders of
    magnitude, so ``percentile_approx`` (fixed-size sketch, safe on a key
    holding a third of the data) decides exactly as the exact median would.
    """
    return df.groupBy(*keys).agg(
        F.percentile_approx(col, 0.5, 10000).cast("double").alias("_median"),
        F.max(col).alias("_max"))


def auto_units(df: DataFrame, col: str, rule: str, keys: Sequence[str] = ("site",),
               flag: str | None = None) -> DataFrame:
    """Detect the unit of ``col`` per key from a statistic and convert (P5).

    The statistic is taken over all rows of the key before any filter; the
    per-key table is one row per key.  ``flag`` names an optional boolean
    column recording whether the key was converted.
    """
    stat, test, conv = UNIT_RULES[rule]
    st = unit_stats(df, col, keys).select(
        *keys, F.coalesce(test(F.col("_median" if stat == "median" else "_max")), F.lit(False)).alias("_conv"))
    out = df.join(st, list(keys), "left").withColumn(
        col, F.when(F.col("_conv"), conv(F.col(col))).otherwise(F.col(col)))
    if flag:
        out = out.withColumnRenamed("_conv", flag)
    return out.drop("_conv")


# ------------------------------------------------------------------ P10/P11
def select_features(columns: Sequence[str], predictand: str, mapping: Mapping[str, str],
                    mode: str = "delimited", essentials: Sequence[str] = (),
                    strict_compat: bool = False) -> list[str]:
    """Leakage filter on column names (P10 ``contains``, P11 ``delimited``).

    ``mapping`` is predictand -> predictor parameter.  Columns naming any
    *other* predictand or its parameter are dropped.  ``contains`` drops on
    any substring match (so ``ewss-1`` goes with parameter ``ws``: Q1).
    ``delimited`` keeps ``essentials``, drops ``== key``, ``key_*``,
    ``key.*`` and names containing ``_val`` / ``.val``.  Empty parameters
    are ignored unless ``strict_compat`` (then ``"_"`` matches all: Q2).
    """
    keys = [k for k in mapping if k != predictand]
    vals = [v for k, v in mapping.items() if k != predictand]
    if not strict_compat:
        vals = [v for v in vals if v]
    out = []
    for col in columns:
        if mode == "contains":
            drop = any(k in col for k in keys) or any(v in col for v in vals)
        elif mode == "delimited":
            if col in essentials:
                out.append(col)
                continue
            drop = any(col == k or col.startswith(f"{k}_") or col.startswith(f"{k}.") for k in keys)
            drop = drop or any(f"_{v}" in col or f".{v}" in col for v in vals)
        else:
            raise ValueError(mode)
        if not drop:
            out.append(col)
    return out


def select_feature_frame(df: DataFrame, predictand: str, mapping: Mapping[str, str],
                         mode: str = "delimited", essentials: Sequence[str] = (),
                         strict_compat: bool = False) -> DataFrame:
    cols = select_features(df.columns, predictand, mapping, mode, essentials, strict_compat)
    return df.select(*[F.col(f"`{c}`") for c in cols])


# ------------------------------------------------------------------ P12
def rename_by(df: DataFrame, mapping: Mapping[str, str] | None = None,
              substrings: Mapping[str, str] | None = None) -> DataFrame:
    """Rename by exact mapping, then by substring replacement."""
    ren = {}
    for c in df.columns:
        new = (mapping or {}).get(c, c)
        for a, b in (substrings or {}).items():
            new = new.replace(a, b)
        if new != c:
            ren[c] = new
    return df.withColumnsRenamed(ren) if ren else df


def order_columns(df: DataFrame, spec: Sequence[str], rest: bool = True) -> DataFrame:
    """Fixed output order over the columns that exist; others after."""
    first = [c for c in spec if c in df.columns]
    tail = [c for c in df.columns if c not in first] if rest else []
    return df.select(*[F.col(f"`{c}`") for c in first + tail])


# ------------------------------------------------------------------ P13
def complete_cases(df: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Drop all-null columns, then rows with any null.

    One aggregation pass counts non-null values per column (a single row is
    brought to the driver); the row filter stays lazy.  Returns the frame
    and a one-row report (rows, kept, dropped, dropped_pct).
    """
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    cols = [c for c in df.columns if counts[c] > 0 or c in keep]
    sub = df.select(*[F.col(f"`{c}`") for c in cols])
    allnn = F.lit(True)
    for c in cols:
        allnn = allnn & F.col(f"`{c}`").isNotNull()
    report = sub.agg(F.count(F.lit(1)).alias("rows"), F.count_if(allnn).alias("kept")).select(
        "rows", "kept", (F.col("rows") - F.col("kept")).alias("dropped"),
        (F.lit(100.0) * (F.col("rows") - F.col("kept")) / F.nullif(F.col("rows"), F.lit(0))).alias("dropped_pct"))
    return sub.na.drop("any"), report


# ------------------------------------------------------------------ P14/P15
def round_cols(df: DataFrame, cols: Iterable[str], n: int = 2) -> DataFrame:
    """Round numeric columns to ``n`` decimals.

    As NumPy/pandas do: scale by 10^n, round ties of the scaled binary value
    to even, scale back.
    """
    k = float(10 ** n)
    return df.withColumns({c: F.bround(F.col(c) * F.lit(k)) / F.lit(k) for c in cols})


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Parse to double; invalid text -> null (P15, ``errors='coerce'``)."""
    return df.withColumns({c: F.expr(f"try_cast(trim(`{c}`) AS DOUBLE)") for c in cols})


# ------------------------------------------------------------------ P17
def point_mean(df: DataFrame, value: str, keys: Sequence[str] = ("site",),
               date: str = "date", n: int = 4, name: str | None = None) -> DataFrame:
    """Four-point mean with a fixed divisor: sum ignoring nulls / n.

    Long form in, one row per (keys, date) out.
    """
    return (df.groupBy(*keys, date)
            .agg((F.coalesce(F.sum(value), F.lit(0.0)) / F.lit(float(n))).alias(name or f"{value}_sum")))


def point_mean_wide(df: DataFrame, var: str, n: int = 4) -> DataFrame:
    """Wide form of P17: ``<var>_sum`` = (sum of ``<var>-1..n`` ignoring nulls) / n."""
    parts = [F.coalesce(F.col(f"`{var}-{i}`"), F.lit(0.0)) for i in range(1, n + 1)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return df.withColumn(f"{var}_sum", total / F.lit(float(n)))


# ------------------------------------------------------------------ P23
def align_features(df: DataFrame, features: Sequence[str], on_missing: str = "zero",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Align a frame to a model's feature list.

    Unknown columns are dropped, missing ones added as 0.0 (or an error with
    ``on_missing='error'``), and the order follows ``features``; ``keep``
    columns (keys) go first.
    """
    missing = [f for f in features if f not in df.columns]
    if missing and on_missing == "error":
        raise ValueError(f"missing required features: {missing}")
    cols = [F.col(f"`{k}`") for k in keep]
    for f in features:
        cols.append(F.col(f"`{f}`") if f in df.columns else F.lit(0.0).alias(f))
    return df.select(*cols)


# ------------------------------------------------------------------ P24/P25
def exceeds(df: DataFrame, col: str, threshold: float, op: str = "above") -> DataFrame:
    """Rows whose value is above / below a threshold."""
    c = F.col(col)
    return df.filter(c > threshold if op == "above" else c < threshold)


def stamp(df: DataFrame, consts: Mapping[str, object]) -> DataFrame:
    """Constant columns such as site name, latitude, longitude (P25)."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})
