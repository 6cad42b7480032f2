"""The evidence pipeline from cues or texts to candidates and features, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import annotate, candidates, features, units, validate
from gleaner.operators.candidates import CONTEXT
from gleaner.registries import MARKERS, RULES, TERMS, Marker, Rule, Term
from gleaner.sources.records import write_jsonl


@dataclass
class Evidence:
    """The tables of a run; nothing is computed until one is read."""

    transcripts: DataFrame
    locks: DataFrame
    profiles: DataFrame
    units: DataFrame
    votes: DataFrame
    terms: DataFrame
    candidates: DataFrame
    markers: tuple[Marker, ...] = MARKERS

    def violations(self) -> DataFrame:
        return validate.run_all(self.transcripts, self.locks, self.units, self.votes, self.terms, self.candidates)

    def write(self, root: str, run_id: str, tier: str = "D", execute: bool = True) -> None:
        """The records as JSON lines below root, a folder for each source; a dry run writes nothing.

        Feature records are checked before anything is written; one that is not sound is an error.
        """
        records = features.feature_records(self.units, run_id, self.markers)
        if execute:
            validate.require_clean(validate.feature_violations(records))
        for name, rows in (
            ("transcripts", self.transcripts.select("source_id", "text", "cue_count")),
            ("units", units.unit_records(self.units, run_id)),
            ("annotations", annotate.annotation_records(self.votes, run_id)),
            ("term_occurrences", annotate.term_records(self.terms, run_id)),
            ("candidate_case_files", candidates.candidate_records(candidates.in_order(self.candidates), run_id, tier)),
            ("feature_records", records),
            ("quality_profiles", self.profiles),
            ("lockfiles", self.locks),
        ):
            write_jsonl(rows, f"{root.rstrip('/')}/{name}", execute)

    def counts(self) -> DataFrame:
        """units, annotations, candidates and routed ones of every source."""
        n = lambda df, name: df.groupBy("source_id").agg(F.count("*").alias(name))
        routed = self.candidates.where("authority_level = 'rule_vote'")
        out = n(self.units, "units")
        for more in (n(self.votes, "annotations"), n(self.candidates, "candidates"), n(routed, "routed")):
            out = out.join(more, "source_id", "left")
        return out.na.fill(0)


def from_cues(cues: DataFrame, run_id: str, rules: tuple[Rule, ...] = RULES, terms: tuple[Term, ...] = TERMS) -> Evidence:
    """From cues (source_id, cue_ord, srt_index, tc_start, tc_end, text)."""
    transcripts = units.build_transcripts(cues)
    cut = units.segment(transcripts.select("source_id", "text"), CONTEXT, profiled=True)
    plain = units.with_cues(units.with_ids(cut), units.cue_ranges(cues))
    return _from_units(transcripts, plain, run_id, rules, terms)


def from_texts(sources: DataFrame, run_id: str, rules: tuple[Rule, ...] = RULES, terms: tuple[Term, ...] = TERMS) -> Evidence:
    """From normalized texts (source_id, text), without time codes."""
    transcripts = sources.select("source_id", "text", F.lit(0).alias("cue_count"))
    cut = units.segment(transcripts.select("source_id", "text"), CONTEXT, profiled=True)
    plain = units.with_ids(cut).withColumn("tc_start", F.lit(None).cast("string"))
    return _from_units(transcripts, plain, run_id, rules, terms)


def _from_units(transcripts: DataFrame, plain: DataFrame, run_id: str, rules, terms) -> Evidence:
    profiles = units.profiles(transcripts)
    anchors = plain.select("source_id", "start", "end", "text", "unit_id", "tc_start", "sentences_before", "sentences_after", "segmentation_quality")
    votes = annotate.rule_votes(anchors, rules)
    found = candidates.capped(candidates.ready(candidates.assemble(votes)))
    return Evidence(transcripts, units.lockfile(transcripts, profiles, run_id), profiles, plain, votes, annotate.term_occurrences(anchors, terms), found)
