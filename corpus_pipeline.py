"""The corpus pipeline: quality rules, near-dedup, decontamination, surrogates, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and reread as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import decontam, mixing, nearcopies, pii, rules, tokens
from quillstone.llm.common import load, new_folder


def _held(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the whole row apart, so that no column of the documents clashes with a computed one."""
    return docs.select(F.struct("*").alias("_row"), "doc_id", "text")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base conditions nor a learned rule reject."""
    judged = rules.quality_rules(_held(docs), load(spark, sf_dir, "labels"))
    return judged.where("kept").select("_row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word Jaccard of 0.8 or more), the one of the smallest doc_id."""
    return nearcopies.one_of_each(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is a test item within the edit budget."""
    return decontam.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced under the configured key, and n_chars of the new text."""
    new = pii.replace_entities(_held(docs), pii.configured_key(spark))
    chars = F.when(F.col("_row.n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
    made = {"text": F.col("text"), "n_chars": chars}
    return new.select(*[made.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The production mixture, in tokens of the vocabulary, with domain, n_tokens and epoch.

    A document's place is drawn from its doc_id alone, as the texts hold surrogates by now: the key
    changes the choice only as far as it changes numbers of tokens.
    """
    return mixing.mix_documents(docs, count=tokens.token_count, place_by=["doc_id"])


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii surrogates", surrogate_stage),
    ("source mixture", mixture_stage),
]

#: Learned rules, fingerprints and keyed surrogates have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others return is written to the checkpoint folder (see drop_folders())."""
    folder = new_folder(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
