"""Streams over landed files: unseen files only, upserts of micro-batches, candles from trades."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

if TYPE_CHECKING:
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState


def stream_landing(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", glob: str = "*", files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the files of a folder whose names fit a pattern; which files were seen is kept in the query's checkpoint."""
    return spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).load(path)


def land_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends what has landed to a Parquet table, and ends; another run takes only what is new."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_upsert(stream: DataFrame, read: Callable[[], DataFrame], publish: Callable[[DataFrame], None], keys: Sequence[str], order: str, checkpoint: str) -> StreamingQuery:
    """Upserts each micro-batch: its last row of each key goes into what `read` returns, and the result to `publish`.

    A batch that is run again after a failure has the same effect as once. The whole table is read
    and published for every batch; stream_upsert_table() touches parts of it only.
    """
    from quillstone.operators.maintain import latest_by_key, upsert

    def apply(batch: DataFrame, _: int) -> None:
        publish(upsert(read(), latest_by_key(batch, keys, [F.col(order)]), keys))

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark._jsc.hadoopConfiguration()).exists(held)


def _delete(spark: SparkSession, path: str) -> None:
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).delete(held, True)


def _replace_buckets(rows: DataFrame, root: str) -> None:
    """Replaces the folders of the rows' buckets; what is in the way of a broken run is replaced by the next one."""
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(root)


def stream_upsert_table(stream: DataFrame, root: str, keys: Sequence[str], order: str, checkpoint: str, buckets: int = 256) -> StreamingQuery:
    """Upserts each micro-batch into a Parquet table in folders by `bucket`, a hash of the keys.

    Of a key's rows the last in `order` stays, whichever batch it came with, the later batch's on
    ties. Only the folders of the batch's keys are read and replaced (dynamic partition overwrite), so a
    batch costs what it touches. What replaces them is first stored under the batch's number in the
    stream's checkpoint folder. A batch that broke off while folders were replaced finds it there
    and does not read the table again, so no row is lost; the next batch deletes it.
    """
    from quillstone.operators.maintain import latest_by_key
    from quillstone.sources.landed import read_parquet_or_empty

    schema = StructType(list(stream.schema)).add("bucket", IntegerType())
    staged = f"{checkpoint.rstrip('/')}/replacements"

    def apply(batch: DataFrame, number: int) -> None:
        spark, path = batch.sparkSession, f"{staged}/{number}"
        if not _exists(spark, f"{path}/_SUCCESS"):
            last = latest_by_key(batch, keys, [F.col(order)]).withColumn("bucket", bucket_of(keys, buckets)).persist()
            touched = [r.bucket for r in last.select("bucket").distinct().collect()]  # at most `buckets` numbers
            old = read_parquet_or_empty(spark, root, schema).where(F.col("bucket").isin(touched))
            both = old.withColumn("_new", F.lit(0)).unionByName(last.withColumn("_new", F.lit(1)))
            latest_by_key(both, [*keys, "bucket"], [F.col(order), F.col("_new")]).drop("_new").write.mode("overwrite").parquet(path)
            last.unpersist()
        _replace_buckets(spark.read.schema(schema).parquet(path), root)
        _delete(spark, f"{staged}/{number - 1}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# Candle intervals.
INTERVALS = {
    "1m": "1 minute",
    "3m": "3 minutes",
    "5m": "5 minutes",
    "15m": "15 minutes",
    "30m": "30 minutes",
    "1h": "1 hour",
    "2h": "2 hours",
    "4h": "4 hours",
    "8h": "8 hours",
    "12h": "12 hours",
    "1d": "1 day",
    "3d": "3 days",
    "1w": "1 week",
    "1M": "1 month",
}
#: Weeks begin on Mondays; a window's start is counted from 1970-01-01, a Thursday.
WEEK_OFFSET = "4 days"


#: A month's bar so far; times are microseconds, and with the trade's id they tell the first trade from the last.
BAR_STATE = "first_at long, first_id long, open double, high double, low double, last_at long, last_id long, close double, volume double, n long"


def merged_bar(held: tuple | None, trades: pd.DataFrame) -> tuple:
    """The state of a bar after trades (at, tid, px, sz)."""
    t = trades.sort_values(["at", "tid"], kind="stable")
    first, last = t.iloc[0], t.iloc[-1]
    new = (int(first["at"]), int(first["tid"]), float(first["px"]), float(t["px"].max()), float(t["px"].min()), int(last["at"]), int(last["tid"]), float(last["px"]), float(t["sz"].sum()), len(t))
    if held is None:
        return new
    begin = min(held, new, key=lambda x: x[:2])
    end = max(held, new, key=lambda x: x[5:7])
    return (*begin[:3], max(held[3], new[3]), min(held[4], new[4]), *end[5:8], held[8] + new[8], held[9] + new[9])


def _month_bars(trades: DataFrame, lateness: str, mode: str) -> DataFrame:
    """Bars of calendar months by keyed state: one row of state for each coin and month, freed when the watermark passes the month's end."""
    import pandas as pd

    first = F.date_trunc("month", "time")
    rows = trades.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", lateness)
    rows = rows.select(
        "coin", F.unix_millis(first).alias("begin"), F.unix_millis((first + F.expr("interval 1 month")).cast("timestamp")).alias("finish"), "time", F.unix_micros("time").alias("at"), F.col("tid").cast("long").alias("tid"), F.col("px").cast("double").alias("px"), F.col("sz").cast("double").alias("sz")
    )

    def bar(key: tuple, held: tuple) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], key[2], held[2], held[3], held[4], held[7], held[8], held[9])], columns=["coin", "begin", "finish", "open", "high", "low", "close", "volume", "n"])

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = tuple(state.get) if state.exists else None
        if state.hasTimedOut:
            state.remove()
            if mode == "append":
                yield bar(key, held)
            return
        for trades in batches:
            held = merged_bar(held, trades)
        state.update(held)
        state.setTimeoutTimestamp(int(key[2]))
        if mode == "update":
            yield bar(key, held)

    out = rows.groupBy("coin", "begin", "finish").applyInPandasWithState(
        run, "coin string, begin long, finish long, open double, high double, low double, close double, volume double, n long", BAR_STATE, mode, "EventTimeTimeout"
    )
    return out.select("coin", F.lit("1M").alias("interval"), F.timestamp_millis("begin").alias("start"), F.timestamp_millis("finish").alias("end"), "open", "high", "low", "close", "volume", "n")


def candles(trades: DataFrame, interval: str, lateness: str | None = None, mode: str = "update") -> DataFrame:
    """Bars of trades (coin, time, px, sz, tid): start, end, open, high, low, close, volume and number; batch or stream.

    With a lateness, a stream closes a bar when the watermark has passed it; later trades are left out.
    Weeks begin on Mondays. Months differ in length and so are no windows: batches group them by
    their first day, and streams keep a state for each coin and month, which needs a lateness and
    the output mode that the stream is written in (update, or append: each bar once, when it
    closes). There a trade is left out if it is later than the lateness, though its month be open.
    """
    if interval == "1M":
        if trades.isStreaming:
            if not lateness or mode not in ("update", "append"):
                raise ValueError("bars of months on a stream need a lateness and a mode, update or append")
            return _month_bars(trades, lateness, mode)
        first = F.date_trunc("month", "time")
        window = F.struct(first.alias("start"), (first + F.expr("interval 1 month")).cast("timestamp").alias("end"))
    else:
        window = F.window("time", INTERVALS[interval], startTime=WEEK_OFFSET if interval == "1w" else None)
    rows = trades.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", lateness) if lateness else trades
    first = F.struct("time", "tid")
    bars = rows.groupBy("coin", window.alias("w")).agg(
        F.min_by("px", first).alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", first).alias("close"), F.sum("sz").alias("volume"), F.count("*").alias("n")
    )
    return bars.select("coin", F.lit(interval).alias("interval"), F.col("w.start").alias("start"), F.col("w.end").alias("end"), "open", "high", "low", "close", "volume", "n")
