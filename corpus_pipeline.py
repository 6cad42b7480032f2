"""Documents made ready for training: language ID, near-dedup, decontamination, secrets, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Null or empty texts, and texts without a letter, go with the first stage. Rows without a doc_id take part in
near-dedup by their texts, after all others; the other stages treat them like any row. Of rows that repeat a doc_id and its
text near-dedup keeps one; rows that repeat a doc_id with another text are documents of their own. An empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.bpe import bpe_encode
from gleaner.llm.common import documents, fresh_path, unused
from gleaner.llm.decontaminate import decontaminate
from gleaner.llm.langid import identify, learned_languages
from gleaner.llm.near_copies import heads
from gleaner.llm.secret_scan import redact


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    pred, sure = unused(docs, "_lang_pred"), unused(docs, "_lang_score")
    told = identify(docs, learned_languages(docs), pred=pred, sure=sure)
    return told.where(F.col(pred) != "und").select(docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each class of near copies (shingles of five words, a similarity of 0.8 or more)."""
    return heads(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, documents(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced and n_chars counted again."""
    clean = redact(docs, path="source" if "source" in docs.columns else None)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the ids (packed, little-endian unsigned 32-bit) and digests of ids and decoded text."""
    coded = bpe_encode(docs.select("doc_id", "lang", "source", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontaminate_stage),
    ("secret_scan", secrets_stage),
    ("bpe", bpe_stage),
]

#: SQL has no suffix automata, SimHash, edit distance over words, forests or BPE merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        at = fresh_path(spark, name)
        made = stage(spark, docs, sf_dir)
        made.write.parquet(at)
        docs = spark.read.schema(made.schema).parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
