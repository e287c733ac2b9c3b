"""Stored tables with an inverted index: which buckets of rows hold a token.

Rows lie in folders by bucket, and the postings have one row for each token with its buckets, in
the tokens' order. A request looks up its tokens, intersects their buckets, and reads only those
folders; what it asks for is then tested on the rows, so an index never changes a result.
Two uses: cubes by (dimension, value), and text in any column by trigrams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.select import read_cube, search_any

#: Files that a bucket with very many rows is written to.
SPREAD = 8
GRAM = 3
_BUCKET, _BETWEEN = "bucket_no", "\x1f"


def write_indexed(df: DataFrame, root: str, tokens: Column, place: Column | None = None, buckets: int = 256) -> None:
    """Stores rows and the postings of their tokens (an array of strings, nulls left out).

    Rows of one `place` share a bucket; the more alike the tokens of a bucket's rows are, the fewer
    buckets a request reads. Without a place rows are dealt by all their columns. A token
    has as many postings as there are buckets at most, and a bucket is written by SPREAD tasks.
    """
    place = F.xxhash64(*df.columns) if place is None else place
    rows = df.withColumn(_BUCKET, F.pmod(F.xxhash64(place), F.lit(buckets)).cast("int"))
    rows.repartition(_BUCKET, F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).write.partitionBy(_BUCKET).parquet(f"{root}/rows")
    stored = df.sparkSession.read.parquet(f"{root}/rows")
    each = stored.select(F.explode(F.array_distinct(F.array_compact(tokens))).alias("token"), _BUCKET).distinct()
    found = each.groupBy("token").agg(F.array_sort(F.collect_list(_BUCKET)).alias("buckets"))
    found.repartitionByRange("token").sortWithinPartitions("token").write.parquet(f"{root}/postings")


def buckets_with(spark: SparkSession, root: str, tokens: Sequence[str]) -> list[int]:
    """The buckets that hold all of the tokens: a row of postings for each token at most is collected."""
    wanted = sorted(set(tokens))
    found = {r.token: set(r.buckets) for r in spark.read.parquet(f"{root}/postings").where(F.col("token").isin(*wanted)).collect()}
    return sorted(set.intersection(*(found.get(t, set()) for t in wanted)))


def read_indexed(spark: SparkSession, root: str, tokens: Sequence[str] = ()) -> DataFrame:
    """The rows of the buckets that hold all of the tokens; without tokens all rows."""
    rows = spark.read.parquet(f"{root}/rows")
    if tokens:
        found = buckets_with(spark, root, tokens)
        rows = rows.where(F.col(_BUCKET).isin(*found) if found else F.lit(False))
    return rows.drop(_BUCKET)


def index_cube(df: DataFrame, root: str, dimensions: str = "dimensions", buckets: int = 256) -> None:
    """Stores a cube by (dimension, value); rows with the same dimensions share a bucket."""
    pairs = F.map_entries(F.col(dimensions))
    tokens = F.transform(pairs, lambda e: F.concat(e["key"], F.lit(_BETWEEN), e["value"]))
    write_indexed(df, root, tokens, F.to_json(F.array_sort(pairs)), buckets)


def read_indexed_cube(spark: SparkSession, root: str, key: object = None, start: str | None = None, end: str | None = None, dims: Mapping[str, str] | None = None, **cols: str) -> DataFrame:
    """read_cube() of a stored cube, which reads only buckets with all given pairs."""
    rows = read_indexed(spark, root, [f"{k}{_BETWEEN}{v}" for k, v in (dims or {}).items()])
    return read_cube(rows, key, start, end, dims, **cols)


def _grams(c: Column) -> Column:
    text = F.lower(c.cast("string"))
    return F.when(F.length(text) >= GRAM, F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substring(text, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>"))


def index_text(df: DataFrame, root: str, place: Column | None = None, buckets: int = 256) -> None:
    """Stores rows by the trigrams of all their columns as lower-cased text."""
    each = [F.coalesce(_grams(F.col(f"`{c}`")), F.array().cast("array<string>")) for c in df.columns]
    write_indexed(df, root, F.flatten(F.array(*each)), place, buckets)


def search_indexed(spark: SparkSession, root: str, term: str) -> DataFrame:
    """search_any() of stored rows; terms of three characters or more read only buckets with all their trigrams, shorter ones all rows."""
    low = term.lower()
    return search_any(read_indexed(spark, root, [low[i : i + GRAM] for i in range(len(low) - GRAM + 1)]), term)
