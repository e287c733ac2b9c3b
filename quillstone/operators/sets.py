"""Unions, differences and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def updated_today(summary: DataFrame, detailed: DataFrame, today: str | DataFrame, key: str = "ticker", stamp: str = "updated_at") -> DataFrame:
    """Distinct keys that either table updated today, which is a date or a table of one row with it."""
    def of(df: DataFrame) -> DataFrame:
        if isinstance(today, DataFrame):
            return df.join(F.broadcast(today.toDF("_today").limit(1)), F.to_date(stamp) == F.col("_today")).select(key)
        return df.where(F.to_date(stamp) == F.lit(today).cast("date")).select(key)

    return of(summary).union(of(detailed)).distinct()


def symbol_catalog(nasdaq: DataFrame, other: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Listings of two directories as one catalog (symbol, name, exchange, etf, source), without dollar symbols; the first source wins."""
    from quillstone.operators.joins import listed_with_exchange
    from quillstone.operators.maintain import dedupe_first

    a = nasdaq.select("symbol", F.col("security_name").alias("name"), F.lit("NASDAQ").alias("exchange"), "etf", F.lit("nasdaqlisted").alias("source"))
    b = listed_with_exchange(other, exchanges).select(F.col("act_symbol").alias("symbol"), F.col("security_name").alias("name"), F.col("exchange_name").alias("exchange"), "etf", F.lit("otherlisted").alias("source"))
    both = a.unionByName(b).where(~F.col("symbol").contains("$"))
    return dedupe_first(both, ["symbol", "exchange"], [F.col("source"), F.col("name")])


def recommendations(rec: DataFrame, upgrades: DataFrame) -> DataFrame:
    """Two kinds of analyst records as one, by the first known column of each synonym."""
    def one(df: DataFrame, source: str) -> DataFrame:
        def pick(*names: str):
            present = [F.col(n).cast("string") for n in names if n in df.columns]
            return F.coalesce(*present) if present else F.lit(None).cast("string")

        return df.select("symbol", pick("period", "date", "grade_date").alias("date"), pick("firm", "company").alias("firm"), pick("to_grade", "toGrade", "grade").alias("to_grade"), pick("from_grade", "fromGrade").alias("from_grade"), pick("action").alias("action"), F.lit(source).alias("source"))

    return one(rec, "recommendations").unionByName(one(upgrades, "upgrades"))


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, with all columns in order; missing ones are null."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return every.select(*sorted(every.columns))


def distinct_codes(df: DataFrame, code: str, name: str) -> DataFrame:
    """Distinct codes with their names, rows without a code left out; of several names the first in order."""
    return df.where(F.col(code).isNotNull()).groupBy(code).agg(F.min(name).alias(name))


def supplement_catalog(catalog: DataFrame, found: DataFrame, info: DataFrame) -> DataFrame:
    """The catalog with the ids that only a search found; their fields come from `info`, or are blank."""
    fresh = found.select("series_id").dropDuplicates().join(catalog, "series_id", "left_anti").join(info, "series_id", "left")
    out = []
    for c, t in catalog.dtypes:
        if c == "category_name":
            value = F.lit("Found via search")
        elif c in fresh.columns:
            value = F.coalesce(F.col(c), F.lit("")) if t == "string" and c != "series_id" else F.col(c)
        else:
            value = F.lit("" if t == "string" else None)
        out.append(value.cast(t).alias(c))
    return catalog.unionByName(fresh.select(*out))


def unpivot_properties(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, property, value): one row for each non-null property, values as text."""
    columns = [c for c in df.columns if c != key] if columns is None else list(columns)
    texts = df.select(key, *[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([key], columns, "property", "value").where("value is not null")


def statements_long(df: DataFrame) -> DataFrame:
    """(symbol, statement, item, period, value) from records (array of maps, the item under _index)."""
    r = df.select("symbol", "statement", F.explode("records").alias("r"))
    kv = r.select("symbol", "statement", F.try_element_at("r", F.lit("_index")).alias("item"), F.explode(F.map_filter("r", lambda k, v: k != "_index")).alias("period", "raw"))
    return kv.select("symbol", "statement", "item", "period", F.col("raw").try_cast("double").alias("value"))
