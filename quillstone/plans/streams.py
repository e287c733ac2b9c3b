"""Stream queries: the events table as landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.checkpoints import new_folder
from quillstone.registry import register, table
from quillstone.streaming import landing

_BARS = """
SELECT event_type AS coin, date_trunc('hour', ts) AS start, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS n
FROM events GROUP BY 1, 2
"""


def _trades(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("coin"), F.col("ts").alias("time"), F.col("value").alias("px"), F.lit(1.0).alias("sz"), F.col("event_id").alias("tid"))


@register("r03_candles", _BARS)
def r03_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = landing.candles(_trades(table(spark, sf_dir, "events")), "1h")
    return bars.select("coin", "start", "open", "high", "low", "close", "n")


@register("r01_landed_candles", _BARS)
def r01_landed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bars over what a stream has landed."""
    folder = new_folder(spark, "landing")
    schema = table(spark, sf_dir, "events").schema
    stream = landing.stream_landing(spark, sf_dir, schema, glob="events*.parquet")
    landing.land_available(stream, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    bars = landing.candles(_trades(spark.read.schema(schema).parquet(f"{folder}/table")), "1h")
    return bars.select("coin", "start", "open", "high", "low", "close", "n")


@register(
    "r03_all_intervals",
    """
    WITH t AS (SELECT event_type AS coin, ts, value, event_id FROM events), b AS (
      SELECT coin, i.name AS interval, CASE WHEN i.name = '1M' THEN date_trunc('month', ts) WHEN i.name = '1w' THEN date_trunc('week', ts)
        ELSE make_timestamp(epoch_us(ts) // (i.minutes::BIGINT * 60000000) * (i.minutes::BIGINT * 60000000)) END AS start, value, event_id
      FROM t, (VALUES ('1m', 1), ('3m', 3), ('5m', 5), ('15m', 15), ('30m', 30), ('1h', 60), ('2h', 120), ('4h', 240), ('8h', 480), ('12h', 720), ('1d', 1440), ('3d', 4320), ('1w', 1), ('1M', 1)) i(name, minutes))
    SELECT coin, interval, start, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS n FROM b GROUP BY 1, 2, 3
    """,
)
def r03_all_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(table(spark, sf_dir, "events"))
    bars = [landing.candles(trades, i).select("coin", "interval", "start", "open", "high", "low", "close", "n") for i in landing.INTERVALS]
    for b in bars[1:]:
        bars[0] = bars[0].unionByName(b)
    return bars[0]


@register("r02_upserted_users", "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def r02_upserted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, as a stream of four files has upserted it into a table in buckets."""
    folder = new_folder(spark, "landing")
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    rows.repartition(4).write.parquet(f"{folder}/in")
    stream = landing.stream_landing(spark, f"{folder}/in", rows.schema, files_per_trigger=2)
    landing.stream_upsert_table(stream, f"{folder}/table", ["user_id"], "event_id", f"{folder}/checkpoint", buckets=8).awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("user_id", "event_type", "event_id")
