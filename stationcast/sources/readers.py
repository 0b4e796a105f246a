"""Sources and sinks.

Text formats are read with ``spark.read.text``/``csv`` so every file split is
its own task; parsing is column expressions.  Nothing reads a file on the
driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationcast.operators.common import bounded

# Compact time stamp of the site configuration, ECA&D missing value.
COMPACT_STAMP = "yyyyMMdd'T'HHmmss'Z'"
BLEND_MISSING = -9999


# ------------------------------------------------------------------ S1
def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               columns: Sequence[str] | None = None, header: bool = True,
               date_cols: Sequence[str] = (), date_format: str | None = None) -> DataFrame:
    """Delimited table, plain or gzip (by extension), explicit schema,
    column subset and parsed dates (S1).  ``select`` prunes the CSV parse."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    for c in date_cols:
        df = df.withColumn(c, F.to_timestamp(F.col(c), date_format) if date_format else F.to_timestamp(F.col(c)))
    return df


# ------------------------------------------------------------------ S2
def with_line_numbers(lines: DataFrame) -> DataFrame:
    """1-based line number within each file, and the file's line count.

    Rows of one split keep file order and get consecutive ids; per
    (file, split) counts are a small table whose running sums give each
    split's offset.  No file is ever gathered into one task.
    """
    other = [c for c in lines.columns if c != "value"]  # e.g. partition columns
    df = lines.select("value", *other, F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_id"))
    blocks = df.groupBy("_file", "_block").agg(F.min("_id").alias("_min"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_file").orderBy("_block")
    blocks = blocks.select("_file", "_block", "_min",
                           (F.sum("_n").over(w) - F.col("_n")).alias("_off"),
                           F.sum("_n").over(Window.partitionBy("_file")).alias("n_lines"))
    return (df.join(blocks, ["_file", "_block"])
            .select("value", *other, F.col("_file").alias("file"),
                    (F.col("_off") + F.col("_id") - F.col("_min") + 1).alias("line"), "n_lines"))


def read_trimmed_csv(spark: SparkSession, path: str, head: int, tail: int,
                     schema: str, sep: str = ",", record_pattern: str | None = None) -> DataFrame:
    """Tool-made CSV with junk lines: drop the first ``head`` and last
    ``tail`` lines of every file, parse the rest with ``schema`` (S2).

    With ``record_pattern`` the lines matching that regular expression are
    kept instead, whatever their position (no line numbering pass).
    """
    if record_pattern is not None:
        keep = spark.read.text(path).filter(F.col("value").rlike(record_pattern))
    else:
        lines = with_line_numbers(spark.read.text(path))
        keep = lines.filter((F.col("line") > head) & (F.col("line") <= F.col("n_lines") - tail))
    other = [c for c in keep.columns if c not in ("value", "n_lines")]
    parsed = keep.select(F.from_csv("value", schema, {"sep": sep}).alias("r"), *other)
    return parsed.select("r.*", *other)


# ------------------------------------------------------------------ S3
def parse_station_blend(lines: DataFrame, element: str | None = None) -> DataFrame:
    """ECA&D blend text: ``STAID,SOUID,YYYYMMDD,value,...`` (S3).

    Lines that are not records (headers, notes, blank) are skipped: a record
    has an integer station id, a valid date at index 2 and a number at
    index 3.  ``-9999`` becomes null, values are in tenths.
    """
    parts = F.split(F.col("value"), ",")
    p = lines.select(parts.alias("p"))
    rec = p.select(
        F.expr("try_cast(trim(p[0]) AS INT)").alias("staid"),
        F.expr("try_to_date(trim(p[2]), 'yyyyMMdd')").alias("date"),
        F.expr("try_cast(trim(p[3]) AS DOUBLE)").alias("_raw"),
        F.size("p").alias("_n"))
    rec = rec.filter((F.col("_n") >= 4) & F.col("staid").isNotNull() & F.col("date").isNotNull()
                     & F.col("_raw").isNotNull())
    val = F.when(F.col("_raw") == BLEND_MISSING, F.lit(None)).otherwise(F.col("_raw") / 10.0)
    out = rec.select("staid", "date", val.alias("value"))
    return out.withColumn("element", F.lit(element)) if element else out


def read_station_blend(spark: SparkSession, path: str, element: str | None = None) -> DataFrame:
    return parse_station_blend(spark.read.text(path), element)


# ------------------------------------------------------------------ S4
def dms_to_degrees(col) -> "F.Column":
    """``+DD:MM:SS`` -> signed decimal degrees; not three parts -> null."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    parts = F.split(c, ":")

    def num(i):
        return F.try_element_at(parts, F.lit(i)).try_cast("double")
    deg = F.regexp_replace(F.try_element_at(parts, F.lit(1)), r"^[+-]", "").try_cast("double")
    sign = F.when(c.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(F.size(parts) == 3, sign * (deg + num(2) / 60.0 + num(3) / 3600.0))


def parse_station_catalog(lines: DataFrame) -> DataFrame:
    """Station catalogue lines ``STAID, STANAME, CN, LAT, LON, HGHT`` with DMS
    coordinates (S4).  A frame has no order, so every line with an integer id and
    six fields is a record; ``read_station_catalog`` knows what precedes the header."""
    p = F.split(F.col("value"), ",")
    rec = lines.select(p.alias("p")).filter(F.size("p") >= 6).select(
        F.expr("try_cast(trim(p[0]) AS INT)").alias("staid"),
        F.trim(F.col("p")[1]).alias("name"), F.trim(F.col("p")[2]).alias("country"),
        F.trim(F.col("p")[3]).alias("_lat"), F.trim(F.col("p")[4]).alias("_lon"),
        F.expr("try_cast(trim(p[5]) AS DOUBLE)").alias("height"))
    rec = rec.filter(F.col("staid").isNotNull())
    return rec.select("staid", "name", "country", dms_to_degrees("_lat").alias("lat"),
                      dms_to_degrees("_lon").alias("lon"), "height")


def read_station_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Station catalogue files: the records after each file's first ``STAID`` header
    line (S4).  A file without a header has none.  One place per file is joined back,
    so no file is gathered into a task."""
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())  # ids rise within a split
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), at.alias("_at"))
    header = lines.filter(F.col("value").rlike(r"^\s*STAID\s*,")).groupBy("_file").agg(F.min("_at").alias("_header"))
    return parse_station_catalog(lines.join(header, "_file").filter(F.col("_at") > F.col("_header")).select("value"))


def station_catalog(obs: DataFrame, catalog: DataFrame, key: str = "staid") -> DataFrame:
    """Attach station name and coordinates to observations (S4 join)."""
    return obs.join(bounded(catalog), key, "left")


# ------------------------------------------------------------------ S5
def explode_packed_series(df: DataFrame, cols: Sequence[str], time: str = "utctime",
                          uneven: str = "raise") -> DataFrame:
    """Per-timestamp packed strings ``[a b c]`` -> one row per cell.

    A row whose arrays differ in length fails the job; with ``uneven="drop"``
    such rows are left out (D11).  They are never padded with nulls.
    """
    if uneven not in ("raise", "drop"):
        raise ValueError(f"uneven must be 'raise' or 'drop', not {uneven!r}")
    arrs = {c: F.split(F.trim(F.regexp_replace(F.col(c), r"[\[\]]", "")), r"\s+") for c in cols}
    a = df.select(time, *[v.alias(c) for c, v in arrs.items()])
    size0 = F.size(cols[0])
    same = reduce(lambda x, y: x & y, [F.size(c) == size0 for c in cols[1:]], F.lit(True))
    if uneven == "raise":
        same = F.when(same, True).otherwise(F.raise_error(F.concat(
            F.lit("packed arrays of different length at "), F.coalesce(F.col(time).cast("string"), F.lit("null")))).cast("boolean"))
    z = a.filter(same).select(time, F.posexplode(F.arrays_zip(*cols)).alias("cell", "z"))
    return z.select(time, "cell", *[F.col(f"z.{c}").cast("double").alias(c) for c in cols])


# ------------------------------------------------------------------ S6
def flatten_periods(df: DataFrame, col: str = "response", child: str = "periods",
                    parent_fields: Sequence[str] = ()) -> DataFrame:
    """Nested record flatten: parent scalars x child rows.

    ``col`` is an array of structs each holding an array ``child``; output
    has one row per child element with the chosen parent fields.
    """
    top = df.select(F.explode(col).alias("_r"))
    rows = top.select(*[F.col(f"_r.{f}").alias(f.replace(".", "_")) for f in parent_fields],
                      F.explode(f"_r.{child}").alias("_c"))
    return rows.select(*[f.replace(".", "_") for f in parent_fields], "_c.*")


# ------------------------------------------------------------------ S7
def with_site_bounds(sites: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Parse the compact ``yyyyMMdd'T'HHmmss'Z'`` site bounds to dates."""
    def parse(c):
        return F.to_date(F.try_to_timestamp(F.col(c), F.lit(COMPACT_STAMP)))
    return sites.withColumns({start: parse(start), end: parse(end)})


def with_site_dim(df: DataFrame, sites: DataFrame, keys: Sequence[str] = ("site",),
                  default_start: str = "2000-01-01", default_end: str = "2025-01-01") -> DataFrame:
    """Join the site dimension to facts, with bounds defaulted.

    The dimension is one row per site; it is broadcast after a size check.
    Sites without an entry get the default bounds as well.
    """
    return df.join(bounded(with_site_bounds(sites)), list(keys), "left").withColumns({
        "start": F.coalesce(F.col("start"), F.lit(default_start).cast("date")),
        "end": F.coalesce(F.col("end"), F.lit(default_end).cast("date"))})


# ------------------------------------------------------------------ S8
def cube_to_rows(df: DataFrame, array_col: str, dims: Sequence[str],
                 keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """N-d array column -> one row per element with its index per dim.

    ``dims`` names the index columns from the outermost array inwards.
    """
    cur = df.select(*keep, F.col(array_col).alias("_a"))
    done: list[str] = []
    for d in dims:
        cur = cur.select(*keep, *done, F.posexplode("_a").alias(d, "_a"))
        done.append(d)
    return cur.select(*keep, *done, F.col("_a").alias(value))


# ------------------------------------------------------------------ S9
def read_keyed(spark: SparkSession, root: str, pattern: str, names: Sequence[str],
               schema: T.StructType | str | None = None, fmt: str = "csv",
               file_glob: str = "*.csv", path_col: str = "file_name") -> DataFrame:
    """Multi-file scan with keys parsed from the file name.

    Every file under ``root`` matching ``file_glob`` is read (no partition
    inference); ``pattern`` is a regular expression with one group per entry
    of ``names``, applied to the file name (or full path with
    ``path_col='file_path'``); files that do not match are skipped.
    """
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_glob)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    df = r.format(fmt).load(root)
    fname = F.col(f"_metadata.{path_col}")
    df = df.withColumn("_fname", fname).filter(F.col("_fname").rlike(pattern))
    return df.withColumns({n: F.regexp_extract("_fname", pattern, i + 1) for i, n in enumerate(names)}).drop("_fname")


# ------------------------------------------------------------------ S10
def write_keyed(df: DataFrame, path: str, keys: Sequence[str], fmt: str = "parquet",
                mode: str = "overwrite") -> str:
    """One output folder per key combination.

    Rows are clustered by the keys first so each task writes few files; the
    rebalance splits a key that holds much of the data over several tasks.
    """
    (df.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys).format(fmt)
     .option("header", True).save(path))
    return path


# ------------------------------------------------------------------ S11
def union_chunks(dfs: Iterable[DataFrame]) -> DataFrame:
    """Append year-chunked extracts into one series."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# ------------------------------------------------------------------ S12
def bbox_filter(df: DataFrame, sites: DataFrame, margin: float, lat: str = "lat", lon: str = "lon",
                site_lat: str = "latitude", site_lon: str = "longitude",
                keys: Sequence[str] = ("site",)) -> DataFrame:
    """Rows within ``margin`` degrees of a site in both lat and lon.

    A range join written as an equi-join: space is cut into cells of side
    2*margin, each site lists the (at most 2 x 2) cells its box touches,
    each row has exactly one cell; after the equi-join the exact box test
    runs.  A row near several sites is kept once per site.
    """
    cell = 2.0 * margin
    s = sites.select(*keys, F.col(site_lat).alias("_slat"), F.col(site_lon).alias("_slon"))
    s = s.select(*keys, "_slat", "_slon",
                 F.explode(F.sequence(F.floor((F.col("_slat") - margin) / cell),
                                      F.floor((F.col("_slat") + margin) / cell))).alias("_ci"))
    s = s.select(*keys, "_slat", "_slon", "_ci",
                 F.explode(F.sequence(F.floor((F.col("_slon") - margin) / cell),
                                      F.floor((F.col("_slon") + margin) / cell))).alias("_cj"))
    d = df.withColumns({"_ci": F.floor(F.col(lat) / cell), "_cj": F.floor(F.col(lon) / cell)})
    j = d.join(bounded(s), ["_ci", "_cj"])
    eps = 1e-9
    j = j.filter((F.abs(F.col(lat) - F.col("_slat")) <= margin + eps)
                 & (F.abs(F.col(lon) - F.col("_slon")) <= margin + eps))
    return j.drop("_ci", "_cj", "_slat", "_slon")


# ------------------------------------------------------------------ S13
def splice_runs(hist: DataFrame, scen: DataFrame, y0: int, y1: int, date: str = "date") -> DataFrame:
    """Historical run followed by the scenario run restricted to years
    [y0, y1] (S13)."""
    return hist.unionByName(scen.filter(F.year(date).between(y0, y1)), allowMissingColumns=True)
