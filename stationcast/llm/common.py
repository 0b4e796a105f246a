"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import checkpoint_dir

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows handed to Python at once.  Bounds a worker's memory: texts are long.
BATCH_ROWS = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workers_ready(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch, and lets Python workers that share the
    driver's disk import this package whatever the folder the session was started in.
    On a cluster the package comes with ``--py-files`` or an installed wheel."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` over Arrow batches of at most ``BATCH_ROWS`` rows."""
    workers_ready(df.sparkSession)
    # names with dots can't be handed to Python; the function takes such columns by their place
    df = df.toDF(*[f"__p{i}" if set(c) & {".", "`"} else c for i, c in enumerate(df.columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    reread: cuts lineage, survives lost executors, keeps column pruning."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def named(*names: str) -> list[Column]:
    """Columns of these names, whatever characters are in them."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in names]


def others(df: DataFrame, *new: str) -> list[str]:
    """Names of the columns of ``df`` that a result of the names ``new`` leaves as they
    are; Spark does not tell names apart by case."""
    taken = {c.lower() for c in new}
    return [c for c in df.columns if c.lower() not in taken]


def sheltered(df: DataFrame, names: list[str], **own: Column) -> tuple[DataFrame, list[Column]]:
    """(``df`` with the columns ``names`` under names that clash with nothing, and the
    columns ``own``; the columns that give ``names`` back)."""
    held = df.select(*[c.alias(f"__c{i}") for i, c in enumerate(named(*names))], *[c.alias(k) for k, c in own.items()])
    return held, [F.col(f"__c{i}").alias(c) for i, c in enumerate(names)]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null and empty give []."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words; null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other code point as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: Column) -> Column:
    """True for rows that no model may learn from: crc32(doc_id as text) mod 5 is 0.
    A null doc_id has no checksum; such rows are held out as well."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def bounded_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows of ``df``, one row a key, chosen by the key's hash: the same
    rows on every run, spread over the whole table.  Of a key's rows the least one stands
    for all, so repeated keys do not make the sample larger.

    Only the number of keys is taken first; rows are then filtered where they lie, so
    nothing but the sample leaves the tasks.  All keys when there are no more than
    ``size``; rows without a key are left out."""
    known = df.where(named(key)[0].isNotNull())
    n = known.agg(F.approx_count_distinct(named(key)[0], 0.02)).first()[0]
    if n > size:
        steps = 1 << 30
        known = known.where(F.pmod(F.xxhash64(named(key)[0], F.lit("sample")), F.lit(steps)) < int(steps * size / n))
    rest = [c for c in df.columns if c != key]
    return known.groupBy(named(key)[0].alias(key)).agg(F.min(F.struct(*named(*rest))).alias("__row")).select(*named(key), "__row.*")


def within_bytes(rows: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """The rows of a bounded sample whose texts, taken whole and in the order of a hash of
    their key, fit in ``most`` bytes together."""
    sizes = sorted((zlib.crc32(str(r[0]).encode()), str(r[0]), r[1]) for r in rows.select(F.col(key).cast("string"), F.coalesce(F.octet_length(text), F.lit(0))).collect())
    kept, total = [], 0
    for _, k, n in sizes:
        if total + n <= most:
            kept.append((k,))
            total += n
    few = rows.sparkSession.createDataFrame(kept, "__fits string")  # keys of the sample
    return rows.join(F.broadcast(few), F.col(key).cast("string") == F.col("__fits")).drop("__fits")
