"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quillstone.operators.checkpoints import new_folder, use_checkpoints  # noqa: F401  (used by the operators too)

#: Texts are taken from an Arrow batch so many at a time, to bound what a worker holds.
SLICE = 500


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_udf(fields: str, make: Callable[[], Callable[[str], tuple]]) -> Callable[..., Column]:
    """A vectorised function from a text column to a struct of `fields`.

    `make` runs once in each task and returns the function for one text; null texts are
    handed over as empty ones.
    """
    struct = T._parse_datatype_string(f"struct<{fields}>")
    arrow = to_arrow_type(struct)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        for batch in batches:
            rows = [one(t or "") for i in range(0, len(batch), SLICE) for t in batch.slice(i, SLICE).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], fields=list(arrow))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(struct)(run)


def with_struct(df: DataFrame, struct: Column, names: list[str], hold: str = "_computed") -> DataFrame:
    """`df` with the fields of one computed struct as columns; columns of the same names are replaced."""
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    # the struct is a column of its own before it is taken apart, so it is computed once
    made = df.select("*", struct.alias(hold))
    return made.select(*[made[f"`{c}`"] for c in kept], *[F.col(f"{hold}.{n}").alias(n) for n in names])


#: Whether Spark removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the checkpoint folder.

    Its lineage is cut, it takes less room than a checkpoint, and the shuffle files that made it
    go once it is there: a lost executor takes nothing with it that the table would need.
    operators.checkpoints.drop_folders() deletes such tables when a result is stored.
    """
    spark = df.sparkSession
    path = new_folder(spark, "table")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
