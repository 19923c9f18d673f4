"""From raw documents to token ids: five stages, each a table of the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, mixing, near_duplicates, personal_data, quality
from tidemark.llm.queries import VOCABULARY
from tidemark.session import new_work_path, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null and empty texts go; rows equal in id
    and text all stay or go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_quality(docs, labels).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Rows
    without an id stay, and rows that repeat an id stay or go together; texts without words
    are in no group."""
    dropped = near_duplicates.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind. A null text stays null; ids do not
    matter and each repeated row is redacted."""
    found = personal_data.find_personal_data(docs, outputs=("redacted",))
    return (
        found.withColumn("text", F.col("redacted"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*COLUMNS)
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. Texts without words, null ones
    among them, are not taken; null ids and sources are values like others."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of ids and of what they decode to. A null
    text counts as empty; ids do not matter."""
    return byte_bpe.encode_texts(
        docs.select("doc_id", "text"),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256"),
        kept=100_000,  # the stages before have filled the executors' heaps
    ).drop("text")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: SQL has no byte-pair encoding and no multinomial draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read by the next. Texts are worked
    on whole, columns beside ``COLUMNS`` are left out, and an empty table stays empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), new_work_path(spark, f"stage-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
