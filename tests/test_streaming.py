"""Streaming daily aggregation: results per micro-batch log, late data and
the watermark."""

import datetime as dt
import os
import time

from stationcast.streaming import daily as ST


def _write_batches(spark, root, batches):
    """Write each batch as its own file, in order (file streams follow
    modification time)."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "site string, time timestamp_ntz, WG_PT1H_MAX double")
        df.coalesce(1).write.mode("append").parquet(root)
        time.sleep(1.1)  # distinct modification times


def _run(spark, tmp_path, name, watermark):
    src = str(tmp_path / f"src-{name}")
    T = dt.datetime
    # Spark judges lateness against the previous batch's watermark, so the
    # late day-1 value comes two batches after the watermark moved on.
    _write_batches(spark, src, [
        [("s", T(2020, 1, 1, 6), 5.0), ("s", T(2020, 1, 2, 6), 6.0)],
        [("s", T(2020, 1, 10, 6), 7.0)],
        [("s", T(2020, 1, 11, 6), 1.0)],
        [("s", T(2020, 1, 1, 18), 2.0)],          # late: day 1 after days 10 and 11
    ])
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = ST.daily_agg_stream(stream, mapping={"WG_PT1H_MAX": "WG"}, rules={"WG": "sum"}, watermark=watermark)
    out = ST.read_latest(spark, ST.run_available(q, str(tmp_path / f"out-{name}"), f"t-{name}-{os.getpid()}"),
                         ["site", "date"])
    return {r.date: r.WG for r in out.collect()}


def test_late_day_dropped_by_short_watermark(spark, tmp_path):
    res = _run(spark, tmp_path, "short", "1 day")
    assert res == {dt.date(2020, 1, 1): 5.0, dt.date(2020, 1, 2): 6.0,   # late 2.0 dropped
                   dt.date(2020, 1, 10): 7.0, dt.date(2020, 1, 11): 1.0}


def test_late_day_kept_by_covering_watermark(spark, tmp_path):
    res = _run(spark, tmp_path, "long", "30 days")
    assert res == {dt.date(2020, 1, 1): 7.0, dt.date(2020, 1, 2): 6.0,   # 5 + late 2
                   dt.date(2020, 1, 10): 7.0, dt.date(2020, 1, 11): 1.0}
