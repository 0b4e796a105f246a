"""Helpers shared by operators: checked broadcast and shared staging paths."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationcast.session import checkpoint_dir

# A side is broadcast only when its values take at most this many bytes.
BROADCAST_MAX_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: one aggregation, combined in the tasks."""
    fixed = sum(16 for f in df.schema.fields if f.dataType.typeName() not in ("string", "binary"))
    sizes = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16 for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    return int(df.agg(F.coalesce(F.sum(sum(sizes, F.lit(fixed)).cast("long")), F.lit(0))).first()[0])


def bounded(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint for a side whose bytes are measured first.

    Larger inputs are returned unchanged and join by shuffle, where AQE can
    still broadcast at runtime from measured sizes or split skewed partitions.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key; the keys appear once, as
    in ``left``.  Without keys every row meets every row of ``right``, which is one row then."""
    rest = [F.col(f"`{c}`") for c in right.columns if c not in keys]
    other = right.select(*[F.col(f"`{k}`").alias(f"__on{i}") for i, k in enumerate(keys)], *rest)
    on = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(keys)], F.lit(True))
    return left.join(other, on, how).drop(*[f"__on{i}" for i in range(len(keys))])


def stage_path(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint directory for staged data."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
