"""Streams that break off, and bars of months by keyed state."""

from __future__ import annotations

import random
import shutil
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillstone.streaming import landing

SCHEMA = "k long, v string, at long"
TRADES = "coin string, time timestamp, px double, sz double, tid long"


def test_a_commit_that_breaks_off_loses_no_row(spark, tmp_path, monkeypatch):
    src, root, cp = (str(tmp_path / n) for n in ("src", "table", "cp"))

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = landing.stream_landing(spark, src, spark.createDataFrame([], SCHEMA).schema)
        landing.stream_upsert_table(stream, root, ["k"], "at", cp, buckets=4).awaitTermination()

    land([(i, "a", 1) for i in range(100)])
    run()
    land([(7, "b", 2), (900, "new", 1)])
    real = landing._replace_buckets

    def broken(rows, path):
        shutil.rmtree(next(Path(path).glob(f"bucket={rows.first().bucket}")))  # the old folder is gone, the new one is not there yet
        raise RuntimeError("the driver dies")

    monkeypatch.setattr(landing, "_replace_buckets", broken)
    with pytest.raises(Exception, match="the driver dies"):
        run()
    monkeypatch.setattr(landing, "_replace_buckets", real)
    assert spark.read.parquet(root).count() < 100
    run()
    got = {r.k: r.v for r in spark.read.parquet(root).collect()}
    assert got == {**{i: "a" for i in range(100)}, 7: "b", 900: "new"}
    land([(1, "c", 3)])
    run()
    assert sorted(p.name for p in (tmp_path / "cp/replacements").iterdir()) == ["2"]  # one is kept, the last


def trades(seed: int, months: int) -> list[tuple]:
    r = random.Random(seed)
    times = sorted(pd.Timestamp("2023-11-03") + pd.Timedelta(minutes=r.randrange(months * 30 * 24 * 60)) for _ in range(400))
    return [(r.choice(["A", "B"]), t.to_pydatetime(), float(r.randint(1, 99)), float(r.randint(1, 5)), i) for i, t in enumerate(times)]


@pytest.mark.parametrize("mode", ["update", "append"])
def test_month_bars_on_a_stream_equal_those_of_a_batch(spark, tmp_path, mode):
    rows = trades(5, 5)
    src, cp, out = (str(tmp_path / n) for n in ("src", "cp", "out"))
    parts = [rows[:150], rows[150:300], rows[300:]]
    last = pd.Timestamp("2024-08-01").to_pydatetime()  # moves the watermark past all months
    for n, part in enumerate([*parts, [("A", last, 1.0, 1.0, 999)], [("A", rows[0][1], 500.0, 1.0, -1), ("A", last, 2.0, 1.0, 1000)]]):
        spark.createDataFrame(part, TRADES).coalesce(1).write.mode("append").parquet(src)
        stream = landing.stream_landing(spark, src, spark.createDataFrame([], TRADES).schema)
        bars = landing.candles(stream, "1M", "1 hour", mode)

        def keep(batch, number, n=n):
            batch.withColumn("run", F.lit(n)).withColumn("batch", F.lit(number)).write.mode("append").parquet(out)

        # each part is a run of its own: the state outlives a restart
        q = bars.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", cp).trigger(availableNow=True).start()
        q.awaitTermination()
        held = q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None
    columns = ["coin", "start", "end", "open", "high", "low", "close", "volume", "n"]
    got = spark.read.parquet(out).where("start < '2024-08-01'")
    newest = got.groupBy("coin", "start").agg(F.max_by(F.struct(*columns), F.struct("run", "batch")).alias("b"), F.count("*").alias("times")).select("b.*", "times")
    want = landing.candles(spark.createDataFrame(rows, TRADES), "1M").select(*columns)
    assert sorted(map(tuple, newest.select(*columns).collect())) == sorted(map(tuple, want.collect()))  # the late trade of 500 is left out
    assert held == 1  # the states of all closed months are freed
    if mode == "append":
        assert newest.agg(F.max("times")).first()[0] == 1


def test_month_bars_on_a_stream_need_a_lateness(spark, tmp_path):
    spark.createDataFrame(trades(1, 1), TRADES).write.parquet(str(tmp_path / "src"))
    stream = landing.stream_landing(spark, str(tmp_path / "src"), spark.createDataFrame([], TRADES).schema)
    with pytest.raises(ValueError):
        landing.candles(stream, "1M")
