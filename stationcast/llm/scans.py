"""Dense positions and running sums of a table in one global order.

A window over the whole table, or over one hot key, sorts it in one task.  Here
the rows are dealt to tasks by ranges of the order, every task numbers and sums
its own part, and the parts' totals, one row for each task, are added up on the
driver and sent back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import staged

#: Running sums are kept modulo this, so that they never leave a long.
MODULUS = 1 << 62


def _wrapped(values: np.ndarray) -> np.ndarray:
    return (values.astype(np.int64).view(np.uint64) & np.uint64(MODULUS - 1)).view(np.int64)


def scan(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``ix``, the row's number from 0 in ``order``, and for every long
    column c of ``sums`` ``c_upto``, the sum of c up to and with the row, modulo MODULUS.

    Rows equal in ``order`` are numbered in any order, once: the result is a
    written table.  The driver sees one row of totals for each task.  An empty
    table gives an empty result."""
    spark, n = df.sparkSession, len(sums)
    at = [df.columns.index(c) for c in sums]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, total = TaskContext.get().partitionId(), 0, np.zeros(n, np.uint64)
        for b in batches:
            ix = rows + np.arange(b.num_rows, dtype=np.int64)
            rows += b.num_rows
            cols = []
            for k in range(n):
                with np.errstate(over="ignore"):
                    upto = np.cumsum(b.column(at[k]).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) + total[k]
                if len(upto):
                    total[k] = upto[-1]
                cols.append(pa.array(_wrapped(upto.view(np.int64))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(ix), *cols],
                                             [*b.schema.names, "__part", "__ix", *[f"{c}_upto" for c in sums]])
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    extra = "".join(f", `{c}_upto` long" for c in sums)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = staged(sorted_.mapInArrow(number, f"{schema}, __part int, __ix long{extra}"), "scan")
    totals = parts.groupBy("__part").agg(F.count("*").alias("n"), *[F.max_by(f"{c}_upto", "__ix").alias(f"s{k}") for k, c in enumerate(sums)]).orderBy("__part").collect()
    before, rows = [0] * (n + 1), []
    for t in totals:
        rows.append((t["__part"], *before))
        before = [before[0] + t["n"], *[(before[k + 1] + t[f"s{k}"]) % MODULUS for k in range(n)]]
    offsets = spark.createDataFrame(rows, "__part int, __o long" + "".join(f", __o{k} long" for k in range(n)))
    out = parts.join(F.broadcast(offsets), "__part")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__ix") + F.col("__o")).alias("ix"),
                      *[F.pmod(F.col(f"`{c}_upto`") + F.col(f"__o{k}"), F.lit(MODULUS)).alias(f"{c}_upto") for k, c in enumerate(sums)])
