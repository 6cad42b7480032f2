"""Tables as transcripts: one text for each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import normalized


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A scan of fewer bytes a core than this is dealt to all cores.
SMALL = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to all cores if there are too few bytes to keep these busy: a file of one row group is one task.

    What is exchanged is bounded by SMALL times the cores; larger inputs stay as they are scanned.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < SMALL * cores else df


def documents_as_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, panel (the document's source) and normalized text of every document."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        F.format_string("doc%d", "doc_id").alias("source_id"), F.col("source").alias("panel"), normalized(F.col("text")).alias("text")
    )


def conversations_as_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a conversation as a cue of its source; the turn is its time code."""
    turns = table(spark, sf_dir, "conversations")
    code = F.format_string("00:00:%02d,000", F.col("turn") % 60)
    cues = turns.select(
        F.format_string("conv%d", "conv_id").alias("source_id"),
        F.col("turn").cast("int").alias("cue_ord"),
        (F.col("turn") + 1).cast("int").alias("srt_index"),
        code.alias("tc_start"),
        code.alias("tc_end"),
        normalized(F.col("text")).alias("text"),
    )
    return cues.where("text <> ''")


def pages_as_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, panel (the host) and the text of every page without its markup."""
    bare = F.regexp_replace("html", r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[^>]*>", " ")
    return spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        F.format_string("page%d", "page_id").alias("source_id"),
        F.regexp_extract("url", "://([^/?#]*)", 1).alias("panel"),
        normalized(bare).alias("text"),
    )
