"""Table maintenance: upserts, appends, replacement, ledgers and key/value metadata.

These take the table as it is and a batch, and return the table as it will be. write_version()
publishes a result beside the version it was computed from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key in the given order."""
    last = Window.partitionBy(*keys).orderBy(*[o.desc() for o in order])
    return df.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def _old(c: str) -> str:
    return f"_old_{c}"


#: Words of 64 bits of the filter that a batch's keys make: it has so many rows at most, whatever the batch has.
FILTER_WORDS = 1 << 17


def split_by_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The target's rows that a batch cannot touch, and those that it may.

    The hashes of the batch's keys set bits of a filter of fixed size, which is broadcast; a target
    row whose bit is not set has no key of the batch. So the first part needs no shuffle, and the
    second holds all rows with a key of the batch and, as the filter fills, some others.
    """
    def hashed(df: DataFrame) -> Column:
        return F.xxhash64(*[df[k].cast(target.schema[k].dataType) for k in keys])

    def word(h: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(h, 6), F.lit(FILTER_WORDS))

    few = batch.select(hashed(batch).alias("_h")).select(word(F.col("_h")).alias("_word"), F.expr("shiftleft(1L, CAST(_h & 63 AS INT))").alias("_bit"))
    bits = F.broadcast(few.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    h = hashed(target)
    may = (word(h) == bits["_word"]) & (F.call_function("getbit", bits["_bits"], h.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return target.join(bits, may, "left_anti"), target.join(bits, may, "left_semi")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    expressions: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """The target with the batch's rows: new keys are added, known ones get the `update` columns.

    By default all columns that are neither keys nor created_at are updated. `expressions` gives a
    function of (old, new) for a column. A batch has a key once at most (see latest_by_key).
    Null keys are equal to each other. Only rows that the batch may touch are joined with it (see
    split_by_keys); the others pass without a shuffle.
    """
    batch = batch.select(*target.columns)
    untouched, target = split_by_keys(target, batch, keys)
    update = [c for c in target.columns if c not in keys and c != "created_at"] if update is None else update
    old = target.select(*[F.col(c).alias(_old(c)) for c in target.columns], F.lit(True).alias("_had"))
    new = batch.withColumn("_has", F.lit(True))
    both = new.join(old, [new[k].eqNullSafe(old[_old(k)]) for k in keys], "full_outer")
    out = []
    for c in target.columns:
        was, now = F.col(_old(c)), F.col(c)
        if c in keys:
            value = F.when(F.col("_has"), now).otherwise(was)
        elif expressions and c in expressions:
            value = F.when(F.col("_has"), expressions[c](was, now)).otherwise(was)
        elif c in update:
            value = F.when(F.col("_has"), now).otherwise(was)
        else:
            value = F.when(F.col("_had"), was).otherwise(now)
        out.append(value.cast(target.schema[c].dataType).alias(c))
    return untouched.unionByName(both.select(*out))


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The target with the batch's rows of new keys; of rows with one key the first in order is taken."""
    fresh = dedupe_first(batch, keys, order) if order else batch.dropDuplicates(list(keys))
    held = split_by_keys(target, fresh, keys)[1].select(*keys)
    return target.unionByName(fresh.select(*target.columns).join(held, list(keys), "left_anti").select(*target.columns))


def append_new(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """insert_ignore() on one key; rows with a null or empty key are left out."""
    return insert_ignore(target, batch.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != "")), [key])


def replace_all(df: DataFrame, stamp: str | None = None) -> DataFrame:
    """A table's new contents, with updated_at set to the run's time."""
    return df.withColumn("updated_at", F.lit(stamp).cast("timestamp") if stamp else F.current_timestamp())


def replace_keys(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target with all rows of the batch's keys replaced by the batch."""
    untouched, maybe = split_by_keys(target, batch, [key])
    kept = maybe.join(batch.select(key).distinct(), key, "left_anti").select(*target.columns)
    return untouched.unionByName(kept).unionByName(batch.select(*target.columns))


def set_meta(meta: DataFrame, pairs: DataFrame) -> DataFrame:
    """Key/value metadata with new values."""
    return upsert(meta, pairs, ["key"])


def get_meta(meta: DataFrame, key: str | None = None) -> DataFrame:
    """One key's row, or all, by key."""
    return (meta.where(F.col("key") == key) if key is not None else meta).orderBy("key")


def ledger_apply(ledger: DataFrame, events: DataFrame) -> DataFrame:
    """The download ledger after events (year, quarter, status, error_message, at).

    A success resets the retry count and the error; a failure counts up and keeps its error.
    """
    failed = F.col("status") == "failed"
    batch = events.select(
        "year",
        "quarter",
        "status",
        F.when(F.col("status") == "success", F.col("at")).alias("downloaded_at"),
        F.when(failed, F.col("at")).alias("failed_at"),
        F.when(failed, F.col("error_message")).alias("error_message"),
        F.when(failed, 1).otherwise(0).alias("retry_count"),
        F.col("at").alias("last_attempt"),
    )
    return upsert(
        ledger,
        batch,
        ["year", "quarter"],
        expressions={
            "retry_count": lambda old, new: F.when(new > 0, F.coalesce(old, F.lit(0)) + 1).otherwise(0),
            "downloaded_at": lambda old, new: F.coalesce(new, old),
            "failed_at": lambda old, new: F.when(F.col("status") == "success", None).otherwise(F.coalesce(new, old)),
        },
    )


def sync_status_apply(status: DataFrame, events: DataFrame) -> DataFrame:
    """Status rows by survey after events (survey, status, code, error, rows, at): a failure is failed:<code>, errors are cut at 4000 characters."""
    batch = events.select(
        F.upper(F.trim("survey")).alias("survey"),
        F.when(F.col("status") == "failed", F.concat(F.lit("failed:"), F.coalesce(F.col("code").cast("string"), F.lit("")))).otherwise(F.col("status")).alias("status"),
        F.substring("error", 1, 4000).alias("error"),
        "rows",
        F.col("at").alias("updated_at"),
    )
    return upsert(status, batch, ["survey"])


def upsert_exchange(companies: DataFrame, batch: DataFrame) -> DataFrame:
    """Companies (cik, name, exchange, …) with the batch's exchanges; an unknown company is added by the name Unknown."""
    rows = batch.select("cik", F.lit("Unknown").alias("name"), "exchange")
    for c in companies.columns:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(companies.schema[c].dataType))
    return upsert(companies, rows, ["cik"], update=["exchange"])


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Writes a table's new version beside the ones it may have been read from, and returns its path."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return path


def export_csv(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """The columns as CSV with a header; nulls are empty, and quotes in a cell are doubled."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]).write.option("emptyValue", "").option("escape", '"').csv(path, header=True)


def export_per_key(df: DataFrame, key: str, path: str, fmt: str = "parquet") -> None:
    """One folder for each key, named by the key with unsafe characters replaced."""
    from quillstone.functions.ids import safe_key

    df.withColumn("safe_key", safe_key(F.col(key).cast("string"))).repartition("safe_key").write.partitionBy("safe_key").format(fmt).save(path)


def write_adj_json(df: DataFrame, path: str, by: Sequence[str] = ("form_type", "quarter")) -> None:
    """One JSON document for each filing, in folders by form and quarter."""
    rows = df.select(*by, F.to_json(F.struct(*[c for c in df.columns if c not in by])).alias("value"))
    rows.write.partitionBy(*by).text(path)


def write_files(df: DataFrame, root: str, name: str = "name", value: str = "value") -> int:
    """One text file for each row, of the name in the folder `root`; returns their number.

    Tasks write through the file system of the folder's address; a task that is run again writes
    the same files. A file is complete once it has its name.
    """

    def run(batches):
        import pyarrow as pa

        from quillstone.sources.files import file_system

        system, inner = file_system(root.rstrip("/"))
        for b in batches:
            for n, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                path = f"{inner}/{n}"
                part = f"{path}.{uuid.uuid4().hex}.part"
                system.create_dir(path.rsplit("/", 1)[0])
                with system.open_output_stream(part) as out:
                    out.write(text if isinstance(text, bytes) else (text or "").encode())
                system.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    return df.select(name, value).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def register_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    """Registers views in the given order."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def compact_filings(df: DataFrame, root: str) -> DataFrame:
    """Writes filings (accession, year, quarter, form_type, content) as Parquet by year, quarter and form.

    Returns the groups whose count or content hash differs after writing: none if all is well.
    """
    by = ["year", "quarter", "form_type"]
    df.repartition(*by, (F.abs(F.xxhash64("accession")) % 16)).write.partitionBy(*by).parquet(root)

    def digest(x: DataFrame) -> DataFrame:
        return x.select(*[F.col(c).cast("string").alias(c) for c in by], "accession", "content").groupBy(*by).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("accession", "content")).alias("h"))

    written = digest(df.sparkSession.read.option("basePath", root).parquet(root))
    return digest(df).exceptAll(written)


def restore_filings(spark: SparkSession, root: str, year: int, quarter: str, form_type: str) -> DataFrame:
    """The filings of one group of a compacted folder; only its files are read."""
    rows = spark.read.parquet(root)
    return rows.where((F.col("year") == year) & (F.col("quarter") == quarter) & (F.col("form_type") == form_type)).select("accession", "content")
