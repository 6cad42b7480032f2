"""Structured Streaming: matching units as their files arrive, and recording votes once.

Segmentation, votes and term occurrences need one row at a time, so they stream unchanged and without state.
Clusters, caps and the dictionary need whole sources and are batch steps over what was stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from gleaner.functions.text import normalized
from gleaner.operators import annotate, packs, units, votes
from gleaner.registries import RULES, Rule


def stream_texts(spark: SparkSession, path: str, schema: str = "source_id string, text string", files: int = 64) -> DataFrame:
    """Texts of the Parquet files that appear in a folder, normalized."""
    from pyspark.sql import functions as F

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return rows.withColumn("text", normalized(F.col("text")))


def stream_votes(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rule votes of streamed texts."""
    return annotate.rule_votes(units.with_ids(units.segment(texts)), rules)


def store(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream's rows to Parquet, each once, and ends when what is there has been read."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def judge_stream(texts: DataFrame, judge: votes.Judge, lane: str, to: str, checkpoint: str, done: str | None = None) -> StreamingQuery:
    """Judges packs (candidate_ref, is_control, prompt, ...) as they arrive; those with a stored result are skipped.

    A batch's results are stored before anything reads them, under the batch's number, so a batch that runs again
    replaces its own results.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        if done:
            rows = packs.pending(rows, lane, spark.read.parquet(done))
        votes.called(rows, judge, lane).write.mode("overwrite").parquet(f"{to.rstrip('/')}/batch={number}")

    return texts.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
