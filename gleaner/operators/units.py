"""Transcripts and sentence units with character spans and time codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import ids
from gleaner.functions.text import TERMINAL, rounded, running_starts, sentences, words
from gleaner.sources.records import json_string, sorted_json

PROFILE = "norm_v0_1"
#: Shares of terminal and of short sentences that part the classes of segmentation quality.
CLEAN_TERMINAL, CLEAN_FRAGMENT, NOISY_TERMINAL, FRAGMENT_WORDS = 0.6, 0.25, 0.3, 4


def build_transcripts(cues: DataFrame) -> DataFrame:
    """source_id, text and cue_count: the cues' texts in order, a space between them."""
    ordered = F.array_sort(F.collect_list(F.struct("cue_ord", "text")))
    return cues.groupBy("source_id").agg(F.array_join(F.transform(ordered, lambda x: x.text), " ").alias("text"), F.count("*").alias("cue_count"))


def cue_ranges(cues: DataFrame) -> DataFrame:
    """The cues with c_start and c_end, their span in the transcript."""
    before = Window.partitionBy("source_id").orderBy("cue_ord").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0)).cast("int")
    return cues.withColumn("c_start", start).withColumn("c_end", (start + F.length("text")).cast("int"))


def segment(transcripts: DataFrame, context: int = 0, profiled: bool = False) -> DataFrame:
    """A row for each sentence of normalized text: the other columns, start, end and text. Nothing is shuffled.

    A transcript is one row, so its sentences' neighbours and its quality are at hand before the rows part:
    context adds sentences_before and sentences_after (that many at most) and their texts, context_before and
    context_after; profiled adds segmentation_quality. Both spare a window or a join over all sentences.
    """
    others = [c for c in transcripts.columns if c != "text"]
    held = transcripts.withColumn("_pieces", sentences(F.col("text"))).withColumn("_starts", running_starts(F.col("_pieces")))
    if profiled:
        held = held.withColumn("segmentation_quality", _rates(F.col("_pieces"))["segmentation_quality"])
        others.append("segmentation_quality")
    if context:
        held = held.withColumn("_all", F.transform("_pieces", lambda p: F.ltrim(p)))

    def unit(piece: Column, n: Column) -> Column:
        end = F.get("_starts", n) + F.length(piece)
        fields = {"start": end - F.length(F.ltrim(piece)), "end": end, "text": F.ltrim(piece)}
        if context:
            before, after = F.least(n, F.lit(context)), F.least(F.size("_all") - 1 - n, F.lit(context))
            fields |= {
                "sentences_before": before,
                "sentences_after": after,
                "context_before": F.array_join(F.slice("_all", n - before + 1, before), " "),
                "context_after": F.array_join(F.slice("_all", n + 2, F.lit(context)), " "),
            }
        return F.struct(*(c.alias(k) for k, c in fields.items()))

    # only a sentence's own struct goes into its row; the transcript's arrays stay behind
    return held.select(*others, F.inline(F.filter(F.transform("_pieces", unit), lambda u: u.text != "")))


def _rates(pieces: Column) -> Column:
    """sentence_count, fragment_rate, terminal_rate and segmentation_quality of the pieces of a normalized text."""
    kept = F.filter(pieces, lambda p: F.ltrim(p) != "")
    n = F.size(kept).cast("long")
    of = lambda test: rounded(F.coalesce(F.try_divide(F.size(F.filter(kept, test)), n), F.lit(0.0)), 4)
    fragment = of(lambda p: F.size(F.split(F.ltrim(p), " ")) < FRAGMENT_WORDS)
    terminal = of(lambda p: F.substring(p, -1, 1).isin(*TERMINAL))
    return F.struct(
        n.alias("sentence_count"), fragment.alias("fragment_rate"), terminal.alias("terminal_rate"), quality_class(terminal, fragment).alias("segmentation_quality")
    )


def profiles(transcripts: DataFrame) -> DataFrame:
    """The quality of every transcript, from its own row; one without sentences has rates 0."""
    held = transcripts.withColumn("_pieces", sentences(F.col("text")))
    return held.select("source_id", _rates(F.col("_pieces")).alias("q")).select("source_id", "q.*")


def with_ids(units: DataFrame) -> DataFrame:
    return units.withColumn("unit_id", ids.unit_id("source_id", "start"))


def with_cues(units: DataFrame, ranges: DataFrame) -> DataFrame:
    """The units with tc_start, tc_end and srt_index of the last cue that begins at or before the unit.

    An as-of join by a window over cues and units together: one shuffle by source, no range join. A unit before all
    cues gets the first one.
    """
    cue = F.struct("tc_start", "tc_end", "srt_index")
    both = ranges.select("source_id", F.col("c_start").alias("start"), F.lit(0).alias("_is"), cue.alias("_cue"), F.lit(None).alias("_unit"))
    rest = F.struct(*(c for c in units.columns if c not in ("source_id", "start")))
    mine = units.select("source_id", "start", F.lit(1).alias("_is"), F.lit(None).alias("_cue"), rest.alias("_unit"))
    order = Window.partitionBy("source_id").orderBy("start", "_is")
    whole = Window.partitionBy("source_id").orderBy("start", "_is").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = F.coalesce(F.last("_cue", ignorenulls=True).over(order), F.first("_cue", ignorenulls=True).over(whole))
    return both.unionByName(mine, allowMissingColumns=True).withColumn("_cue", found).where("_is = 1").select("source_id", "start", "_unit.*", "_cue.*")


def quality(units: DataFrame) -> DataFrame:
    """sentence_count, fragment_rate, terminal_rate and segmentation_quality of every source of any table of units."""
    short = F.size(words(F.col("text"))) < FRAGMENT_WORDS
    n = F.count("*")
    rates = units.groupBy("source_id").agg(
        n.alias("sentence_count"),
        rounded(F.count_if(short) / n, 4).alias("fragment_rate"),
        rounded(F.count_if(F.rtrim("text").rlike("[.!?]$")) / n, 4).alias("terminal_rate"),
    )
    return rates.withColumn("segmentation_quality", quality_class(F.col("terminal_rate"), F.col("fragment_rate")))


def quality_class(terminal: Column, fragment: Column) -> Column:
    """By the rounded rates."""
    return (
        F.when((terminal >= CLEAN_TERMINAL) & (fragment <= CLEAN_FRAGMENT), "punctuated_clean")
        .when(terminal >= NOISY_TERMINAL, "punctuated_noisy")
        .otherwise("unpunctuated")
    )


def with_quality(units: DataFrame, profiles: DataFrame) -> DataFrame:
    return units.join(profiles.select("source_id", "segmentation_quality"), "source_id")


def text_hash(text: Column | str) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def lockfile(transcripts: DataFrame, profiles: DataFrame, run_id: str, suffix: str = ".srt") -> DataFrame:
    """Hashes of every transcript and of its metadata, the counts, and the time of writing."""
    rows = transcripts.join(profiles.select("source_id", "sentence_count"), "source_id", "left").withColumn(
        "sentence_count", F.coalesce("sentence_count", F.lit(0))
    )
    number = lambda c: F.col(c).cast("string")
    meta = sorted_json(
        {
            "source_id": json_string(F.col("source_id")),
            "srt_filename": json_string(F.concat("source_id", F.lit(suffix))),
            "normalization_profile": json_string(F.lit(PROFILE)),
            "cue_count": number("cue_count"),
            "char_count": F.length("text").cast("string"),
            "sentence_count": number("sentence_count"),
        }
    )
    return rows.select(
        "source_id",
        F.lit(run_id).alias("run_id"),
        text_hash("text").alias("transcript_sha256"),
        text_hash(meta).alias("metadata_sha256"),
        "cue_count",
        F.length("text").alias("char_count"),
        "sentence_count",
        F.current_timestamp().alias("created_at"),
    )


def unit_records(units: DataFrame, run_id: str) -> DataFrame:
    """The units as nested records."""
    return units.select(
        "unit_id",
        "source_id",
        F.lit(run_id).alias("run_id"),
        F.struct(F.lit("ingest").alias("stage"), F.lit(PROFILE).alias("normalization_profile")).alias("method"),
        F.struct(
            F.array("start", "end").alias("char_span"),
            F.struct(F.col("tc_start").alias("start"), F.col("tc_end").alias("end"), "srt_index").alias("timecode"),
        ).alias("anchor"),
        "text",
        "segmentation_quality",
        F.lit("source_lockfile.json#transcript.sha256").alias("source_hash_ref"),
        F.lit("source").alias("authority_level"),
        F.lit("n/a").alias("review_state"),
    )
