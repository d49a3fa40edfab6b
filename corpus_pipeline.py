"""A training corpus from raw documents: stages that each keep the columns of documents.

Every stage works on rows, so repeated rows, missing or reused ids and further columns are no
hindrance to any, and no rows give no rows. A missing text counts as empty, and a text of any
length is worked on whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linecheck.llm import bpe, jaccard, mixing, quality, repeats
from linecheck.llm.common import ship, stored
from linecheck.llm.queries import MIXTURE, POLICY, RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy accepts; missing, empty and short texts are rejected, ids play no part."""
    ship(spark)
    return quality.accepted(docs, POLICY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id, without id only if none has any."""
    ship(spark)
    return jaccard.one_row_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 100 bytes or more that stand earlier in the corpus.

    Earlier are smaller ids (missing ones first), then smaller digests. Whole characters go; a text
    of which nothing is left stays as an empty one, a missing text stays missing.
    """
    ship(spark)
    cut = repeats.deduplicated(docs, length=100)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources uses them, with all their columns.

    Rows without source are a source of their own; rows that share id and source go together.
    Documents without words go with their source's block.
    """
    ship(spark)
    return mixing.mixture(docs, MIXTURE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as token ids, with the number of bytes that they decode to; of a missing or empty text, none."""
    ship(spark)
    tokenizer = bpe.Tokenizer(spark, RANKS, public_tokenizers.PATTERN)
    coded = tokenizer.counted(F.col("text"))
    rows = docs.select("doc_id", "lang", "source", coded.alias("coded"))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("coded.token_ids").cast("long").alias("n_tokens"),
        "coded.n_bytes",
        "coded.token_ids",
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("source mixing", source_mixing),
    ("byte-level bpe", tokens),
]

# The later stages are not expressible in SQL; tests compare them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage returns is stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
