"""A corpus pipeline over the documents table: language, lines, near duplicates, benchmark, packing.

Every stage takes what its predecessor wrote. Rows with a NULL or wordless text leave in the first
stage (no language), so an empty table or one of such rows gives no rows at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.llm import decontaminate, language_id, line_dedup, near_dup, packing
from motorlake.llm.common import saved, table
from motorlake.llm.queries import vocabulary

PACK_CACHE = 250_000   # the executors' memory is near its height when packing begins
LEAST_SHARE = 0.5      # of a text's letters in one language; a text with less has no main language


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts of which most is in one language; drops texts without a letter and even mixtures."""
    found = language_id.identify(docs, language_id.train(docs))
    return found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts aligned blocks that an earlier document has too; a text that loses all its lines goes.

    ``n_chars`` follows the text where it changed.
    """
    cut = line_dedup.deduplicate_lines(docs).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", n)
    return cut.select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each near-duplicate class."""
    return near_dup.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), 1024, 2, PACK_CACHE)


STAGES = [
    ("language", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dup", without_near_duplicates),
    ("decontaminate", without_benchmark),
    ("pack", packed),
]

#: Viterbi paths, patience diffs, MinHash classes and best-fit plans have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
