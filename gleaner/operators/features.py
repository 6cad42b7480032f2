"""Standoff features of units. They refer to units and never gate anything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import ids
from gleaner.functions.text import rounded, words
from gleaner.operators.annotate import hits
from gleaner.registries import DEICTICS, FEATURE_STOPWORDS, MARKERS, Deictic, Marker, lexicon_version

SURFACE, MARKED, DEICTIC = "surface_complexity_profile", "discourse_marker_profile", "possible_visual_or_deictic_dependence"
VERSION = "1.0.0"
SUPPRESSED_QUALITIES, LEAST_TOKENS = ("unpunctuated", "window_mode"), 5
#: name: role, signal basis, presentation.
ABOUT = {
    SURFACE: ("measurement", "deterministic_surface", "pack_visible_when_triggered"),
    MARKED: ("cue", "deterministic_surface", "pack_visible_when_triggered"),
    DEICTIC: ("warning", "deterministic_surface", "pack_visible_when_triggered"),
}


def content_words(tokens: Column) -> Column:
    """Tokens that are neither punctuation alone nor stop words, in lower case and without punctuation."""
    bare = F.transform(tokens, lambda w: F.lower(F.regexp_replace(w, r"(?U)[^\w]", "")))
    return F.filter(bare, lambda w: (w != "") & ~w.isin(*FEATURE_STOPWORDS))


def lexical_density(tokens: Column) -> Column:
    """Content words over all words; 0 for none."""
    return rounded(F.coalesce(F.try_divide(F.size(content_words(tokens)), F.size(tokens)), F.lit(0.0)), 4)


def surface_complexity(units: DataFrame) -> DataFrame:
    """One row for each unit: tokens, characters and density, or why they are suppressed."""
    rows = units.withColumn("_tokens", words(F.col("text")))
    n, q = F.size("_tokens"), F.col("segmentation_quality")
    poor = F.coalesce(q.isin(*SUPPRESSED_QUALITIES), F.lit(False))
    reason = F.when(poor, F.concat(F.lit("segmentation_quality='"), q, F.lit("'"))).when(
        n < LEAST_TOKENS, F.concat(F.lit("length_tokens="), n.cast("string"), F.lit(f" < {LEAST_TOKENS}"))
    )
    shown = lambda c: F.when(reason.isNull(), c)
    return rows.select(
        "source_id",
        "unit_id",
        F.lit(SURFACE).alias("name"),
        F.lit(VERSION).alias("version"),
        reason.isNull().alias("triggered"),
        shown(n).alias("length_tokens"),
        shown(F.length("text")).alias("length_chars"),
        shown(lexical_density(F.col("_tokens"))).alias("lexical_density"),
        reason.isNotNull().alias("suppressed"),
        F.coalesce(reason, F.lit("")).alias("suppression_reason"),
    )


def discourse_markers(units: DataFrame, markers: tuple[Marker, ...] = MARKERS) -> DataFrame:
    """A row for each unit with a marker: the markers in the lexicon's order, one for each surface, and their categories."""
    first = {m.surface: m for m in reversed(markers)}
    made = [
        (
            m.regex,
            F.struct(
                F.lit(m.surface).alias("surface"), F.lit(m.category).alias("category"), F.lit(m.version).alias("lexicon_version"), F.lit(m.note).alias("fp_note")
            ),
        )
        for m in markers
        if first[m.surface] is m
    ]
    rows = units.withColumn("markers", hits(F.col("text"), made)).where(F.size("markers") > 0)
    return rows.select(
        "source_id",
        "unit_id",
        F.lit(MARKED).alias("name"),
        F.lit(lexicon_version(markers)).alias("version"),
        F.lit(True).alias("triggered"),
        "markers",
        F.array_sort(F.array_distinct(F.transform("markers", lambda m: m.category))).alias("categories_present"),
    )


def deictic_phrases(units: DataFrame, phrases: tuple[Deictic, ...] = DEICTICS) -> DataFrame:
    """A row for each unit with a phrase that depends on something seen or pointed at."""
    made = [(p.regex, F.struct(F.lit(p.surface).alias("surface"), F.lit(p.kind).alias("kind"))) for p in phrases]
    rows = units.withColumn("phrases", hits(F.col("text"), made)).where(F.size("phrases") > 0)
    return rows.select(
        "source_id",
        "unit_id",
        F.lit(DEICTIC).alias("name"),
        F.lit(VERSION).alias("version"),
        F.lit(True).alias("triggered"),
        "phrases",
        F.lit("high").alias("confidence"),
    )


def feature_records(units: DataFrame, run_id: str, markers=MARKERS, phrases=DEICTICS) -> DataFrame:
    """The records of all three features; the payload is a variant, without the fields that a feature lacks."""

    def record(rows: DataFrame, name: str, payload: Column) -> DataFrame:
        role, basis, presentation = ABOUT[name]
        return rows.select(
            ids.feature_record_id("unit_id", "name", "version").alias("feature_record_id"),
            F.col("unit_id").alias("unit_ref"),
            "source_id",
            F.lit(run_id).alias("run_id"),
            F.lit("unit").alias("scope"),
            F.struct(F.lit("enrich").alias("stage"), "name", "version").alias("method"),
            F.lit(role).alias("role"),
            F.lit(basis).alias("signal_basis"),
            F.lit(presentation).alias("presentation"),
            "triggered",
            F.parse_json(F.to_json(payload)).alias("payload"),
        )

    surface, marked, pointed = surface_complexity(units), discourse_markers(units, markers), deictic_phrases(units, phrases)
    # to_json leaves null fields out
    one = record(surface, SURFACE, F.struct("length_tokens", "length_chars", "lexical_density", "suppressed", "suppression_reason"))
    two = record(marked, MARKED, F.struct("markers", "categories_present"))
    three = record(pointed, DEICTIC, F.struct("phrases", "confidence"))
    return one.unionByName(two).unionByName(three)


def feature_counts(records: DataFrame) -> DataFrame:
    """records and triggered ones of each feature of a source."""
    return records.groupBy("source_id", F.col("method.name").alias("name")).agg(
        F.count("*").alias("records"), F.count_if("triggered").alias("triggered")
    )
