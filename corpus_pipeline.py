"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; it is written as Parquet and read again by the next.  All stages but the
last return rows of ``documents`` with all its columns.

- language ID: rejects texts without a letter and those where no language holds
  ``MIN_SHARE`` of the words (by mean posterior); nothing else.  Without any
  usable label outside the held-out fold there is no language to tell, and only
  null texts and texts without a letter are rejected.
- exact dedup: of equal texts the row with the smallest doc_id stays.
- SimHash near-dedup: of each component (3-word shingles, 3 bits) the document
  with the smallest doc_id stays.
- packing: see ``skyfare.llm.packing``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.llm import lang_id
from skyfare.llm.common import keep_decided
from skyfare.llm.exact_dedup import exact_dedup
from skyfare.llm.queries import held_out, packed
from skyfare.llm.simhash import simhash_components
from skyfare.session import table_path, write_once

#: Least share of a text's words that its language must hold.
MIN_SHARE = 0.3
SHINGLE, BITS = 3, 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the model learns from labelled rows outside the held-out fold."""
    model = lang_id.fit(docs.filter(~held_out()))
    return lang_id.keep_clear(docs, model, MIN_SHARE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return keep_decided(docs, "doc_id", lambda rows, key: exact_dedup(rows, key).select(key, "kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of close fingerprints."""
    def decide(rows, key):
        found = simhash_components(rows, SHINGLE, BITS, key)
        return found.select(key, (F.col(key) == F.col("component_id")).alias("kept"))

    return keep_decided(docs, "doc_id", decide)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of all documents in length buckets and batches."""
    return packed(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("simhash_near_dedup", near), ("packing", packing)]

#: The language model and the DP of the packing stage have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = write_once(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
