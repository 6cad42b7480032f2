"""Rule votes and term occurrences: one pass over the units, nothing shuffled.

All patterns are literals of one array expression, so each is compiled once and there is neither a cross join
nor a scan for each rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import ids
from gleaner.functions.text import first_match, matches
from gleaner.registries import RULES, TERMS, Rule, Term

#: Patterns of one array; longer registries make several.
AT_ONCE = 64


def hits(text: Column, patterns: list[tuple[str, Column]]) -> Column:
    """The structs whose pattern matches, in the registry's order."""
    found = []
    for at in range(0, max(1, len(patterns)), AT_ONCE):
        some = F.array(*(F.when(matches(text, p), made) for p, made in patterns[at : at + AT_ONCE]))
        found.append(F.filter(some, lambda x: x.isNotNull()))
    return found[0] if len(found) == 1 else F.concat(*found)


def rule_votes(units: DataFrame, rules: tuple[Rule, ...] = RULES, with_text: bool = False) -> DataFrame:
    """A row for each rule that matches a unit: the unit's other columns, and the vote; with_text: candidate_text too."""
    text, mode = F.col("text"), {"shadow": "shadow"}
    made = [
        (
            r.regex,
            F.struct(
                F.lit(n).alias("rule_ord"),
                F.lit(r.rule_id).alias("rule_id"),
                F.lit(r.version).alias("rule_version"),
                F.lit(r.family).alias("label_vote"),
                F.lit(r.kind).alias("pattern_type"),
                F.lit(r.mode).alias("authority_mode"),
                F.lit(mode.get(r.mode, "rule_vote")).alias("authority_level"),
                F.lit(r.gate or None).cast("string").alias("gate"),
                F.trim(first_match(text, r.regex)).alias("trigger_text"),
            ),
        )
        for n, r in enumerate(rules)
    ]
    others = [c for c in units.columns if c not in ("text", "unit_id")]
    held = [*others, F.col("unit_id").alias("unit_ref"), *([text.alias("candidate_text")] if with_text else [])]
    rows = units.select(*held, F.explode(hits(text, made)).alias("v")).select("*", "v.*").drop("v")
    return rows.withColumn("annotation_id", ids.annotation_id("source_id", "start", "end", "rule_id"))


def term_occurrences(units: DataFrame, terms: tuple[Term, ...] = TERMS) -> DataFrame:
    """A row for each term in a unit: the unit's columns but text, and the term's."""
    text = F.col("text")
    made = [
        (
            t.regex,
            F.struct(
                F.lit(t.term).alias("term"),
                F.lit(t.canonical_form or t.term).alias("canonical_form"),
                F.lit(t.category).alias("category"),
                first_match(text, t.regex).alias("trigger_text"),
            ),
        )
        for t in terms
    ]
    others = [c for c in units.columns if c not in ("text", "unit_id")]
    rows = units.select(*others, F.col("unit_id").alias("unit_ref"), F.explode(hits(text, made)).alias("t"))
    rows = rows.select(*others, "unit_ref", "t.*")
    return rows.withColumn("term_occurrence_id", ids.term_occurrence_id("source_id", "start", "end", "term"))


def merge_gazetteer(seeds: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """term, canonical_form and category: a full outer join of tables too large for a registry; the gazetteer wins."""
    left = seeds.select(F.lower("term").alias("key"), F.col("term").alias("s_term"), F.col("category").alias("s_category"))
    right = gazetteer.select(
        F.lower("term").alias("key"), F.col("term").alias("g_term"), F.col("category").alias("g_category"), F.col("canonical_form").alias("g_form")
    )
    both = left.join(right, "key", "full_outer")
    given = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return both.select(
        F.coalesce("g_term", "s_term").alias("term"),
        F.coalesce(given("g_form"), "g_term", "s_term").alias("canonical_form"),
        F.coalesce(given("g_category"), "s_category", F.lit("")).alias("category"),
    )


def annotation_records(votes: DataFrame, run_id: str) -> DataFrame:
    """The votes as nested records; gate is null (absent) if the rule has none."""
    return votes.select(
        "annotation_id",
        "source_id",
        F.lit(run_id).alias("run_id"),
        "unit_ref",
        F.struct(F.array("start", "end").alias("char_span"), F.col("tc_start").alias("timecode_ref")).alias("anchor"),
        F.struct(F.lit("annotate").alias("stage"), F.concat(F.lit("re_"), "pattern_type").alias("matcher")).alias("method"),
        "rule_id",
        "rule_version",
        "label_vote",
        F.lit("cue").alias("taxonomy"),
        "trigger_text",
        "authority_level",
        "authority_mode",
        "gate",
        F.lit("rule_matched").alias("review_state"),
    )


def term_records(terms: DataFrame, run_id: str) -> DataFrame:
    return terms.select(
        "term_occurrence_id",
        "source_id",
        F.lit(run_id).alias("run_id"),
        "unit_ref",
        F.struct(F.array("start", "end").alias("char_span"), F.col("tc_start").alias("timecode_ref")).alias("anchor"),
        F.struct(F.lit("annotate").alias("stage"), F.lit("re_phrase").alias("matcher")).alias("method"),
        "term",
        "canonical_form",
        "category",
        F.lit("rank_boost").alias("role"),
        "trigger_text",
        F.lit("shadow").alias("authority_level"),
        F.lit("rule_matched").alias("review_state"),
    )
