"""The operators applied to the given tables: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propense.llm import (
    chat,
    decontaminate,
    language,
    lines,
    manifest,
    mixing,
    oracles,
    pii,
    pstable,
    secrets,
    simhash,
    substrings,
    urls,
    whitening,
)
from propense.llm.common import table


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document that leaks a benchmark item, and the item."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes the marks of a template, read back from what was formatted."""
    odd = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.read_back(chat.format_conversations(turns))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture as a reading order: a row per document and pass."""
    target = mixing.Target(entropy_share=mixing.ENTROPY_SHARE)
    return mixing.mix(table(spark, sf_dir, "documents"), target).drop("text_hash")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: (verdict, host and path)
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op8_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents")).drop("spans")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some documents are tampered with: their texts are in lower case."""
    docs = table(spark, sf_dir, "documents")
    some = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = {"text": F.translate("text", lines.UPPER, lines.LOWER)}
    return manifest.versions(docs, tampered=some, changes=lowered).drop("source", "copied")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation that no long can hold is null here; the operator has it as a decimal."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": op1_personal_data,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_source_mixing": op5_source_mixing,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_url_verdicts": op8_url_verdicts,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_line_dedup": op12_line_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op11_merkle_manifest": oracles.merkle_manifest(),
    "op12_line_dedup": oracles.LINE_DEDUP,
}
