"""Subtitle files as cues, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions.text import normalized

#: A time line: hours, minutes, seconds and milliseconds of start and end.
TIME_LINE = r"(\d{2}:\d{2}:\d{2},\d{3})\s*-->\s*(\d{2}:\d{2}:\d{2},\d{3})"


def read_srt(spark: SparkSession, path: str) -> DataFrame:
    """source_id (the file's slug), path and text of every file; a file that is not UTF-8 is an error."""
    raw = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    text = F.when(F.expr("is_valid_utf8(CAST(content AS STRING))"), F.decode("content", "UTF-8"))
    text = F.coalesce(text, F.raise_error(F.concat(F.lit("not UTF-8: "), "path")))
    return raw.select(name.alias("source_id"), "path", text.alias("text"))


def parse_srt(files: DataFrame, text: str = "text", source: str = "source_id") -> DataFrame:
    """source_id, cue_ord, srt_index, tc_start, tc_end, text of every cue.

    A block without a time line, or without text, is no cue. The index is the number above the time line, or
    else the cue's ordinal among those kept.
    """
    body = F.regexp_replace(F.trim(F.regexp_replace(F.col(text), "^﻿+", "")), "^\\s+|\\s+$", "")
    blocks = files.select(F.col(source).alias("source_id"), F.posexplode(F.split(body, r"\r?\n\r?\n")).alias("block", "b"))
    lines = F.filter(F.split("b", r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"), lambda x: F.trim(normalized(x)) != "")
    at = F.array_position(F.transform("lines", lambda x: x.rlike(TIME_LINE)), True)
    cues = blocks.withColumn("lines", lines).withColumn("at", at.cast("int")).where("at > 0")
    time = F.element_at("lines", F.col("at"))
    above = F.when(F.col("at") > 1, F.trim(F.get("lines", F.col("at") - 2)))
    cues = cues.select(
        "source_id",
        "block",
        F.when(above.rlike(r"^\d+$"), above.cast("int")).alias("given"),
        F.regexp_extract(time, TIME_LINE, 1).alias("tc_start"),
        F.regexp_extract(time, TIME_LINE, 2).alias("tc_end"),
        normalized(F.array_join(F.slice("lines", F.col("at") + 1, F.size("lines")), " ")).alias("text"),
    ).where("text <> ''")
    order = Window.partitionBy("source_id").orderBy("block")
    cues = cues.withColumn("cue_ord", F.row_number().over(order) - 1)
    return cues.select("source_id", "cue_ord", F.coalesce("given", F.col("cue_ord") + 1).alias("srt_index"), "tc_start", "tc_end", "text")


def without_cues(files: DataFrame, cues: DataFrame) -> DataFrame:
    """The sources that have no cue."""
    return files.select("source_id").join(cues.select("source_id").distinct(), "source_id", "left_anti")


def require_cues(files: DataFrame, cues: DataFrame, shown: int = 20) -> DataFrame:
    """The cues; a source that has none is an error."""
    if rows := without_cues(files, cues).orderBy("source_id").limit(shown).collect():
        raise ValueError("no cues: " + ", ".join(r.source_id for r in rows))
    return cues
