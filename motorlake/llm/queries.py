"""The registered corpus queries: each applies its operator to its whole table."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.rule_ensemble import score_documents, train
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1024, 2)


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.surrogates import replace_personal_data
    # without a key of the session the run draws its own, which nobody can enumerate afterwards
    key = spark.conf.get("spark.motorlake.surrogateKey", None)
    return replace_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), key.encode() if key else secrets.token_bytes(32))


def op4_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.grammar_ids import encode_and_read
    return encode_and_read(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 1)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.line_dedup import deduplicate_lines
    return deduplicate_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.robust_outliers import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.common import held_out
    from motorlake.llm.language_id import identify, train
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_spans")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 512)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.near_dup import near_duplicate_classes
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.projected_neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.conversation_repair import repair_conversations
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from motorlake.llm.ngram_resampling import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_pack": op2_pack,
    "op3_surrogates": op3_surrogates,
    "op4_contaminated": op4_contaminated,
    "op5_token_ids": op5_token_ids,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_language": op8_language,
    "op9_token_counts": op9_token_counts,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_neighbours": op11_neighbours,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_resample": op13_resample,
}

ORACLE_SQL: dict[str, str] = {}
