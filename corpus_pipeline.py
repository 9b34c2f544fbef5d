"""The corpus pipeline: stages over `documents`, each written as Parquet and read again by the next.

Defined cases: a null text counts as empty in every stage and, where it stays to the last, is a piece of the
end id alone. Rows with a null id are documents like others; labels without an id teach nothing. Rows that
repeat are one group of near-duplicates, so one of them stays; so do texts without words, which share one
fingerprint. Ties between a group's documents go to the smallest id. Very long texts are read whole. Without a
labelled example the classifiers reject nothing. Other columns, also of names that a stage uses itself, are
carried as they are. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidescore.llm import packing, quality, simhash, substring_dedup, toxicity
from tidescore.llm.bpe_text import default_path
from tidescore.llm.queries import table
from tidescore.session import scratch_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least 0.5; empty texts are scored like others."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5; empty texts are scored like others."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id, a row without an id last."""
    return simhash.keep_first(docs, shingle=3, distance=3)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that occur elsewhere; no document goes, a text may become empty."""
    cleaned = substring_dedup.remove_duplicates(docs, window=35)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return packing.pack(docs, default_path(), size=1024, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("simhash", one_of_each_group),
    ("substrings", without_repeated_passages),
    ("packing", packed),
]

#: The classifiers and the tokenizer have no SQL form; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
