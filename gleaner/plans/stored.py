"""A run on disk: its JSON lines as tables again, stages run alone on them, and validation of what is stored.

A folder for each kind of record (units, annotations, ...), split by source_id, as Evidence.write leaves it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import annotate, candidates, features, units, validate
from gleaner.registries import DEICTICS, MARKERS, RULES, TERMS
from gleaner.sources.records import write_jsonl

_SPAN = "anchor struct<char_span: array<int>, timecode_ref: string>"
SCHEMAS = {
    "transcripts": "text string, cue_count bigint",
    "lockfiles": "run_id string, transcript_sha256 string, metadata_sha256 string, sentence_count bigint",
    "units": "unit_id string, text string, segmentation_quality string, "
    "anchor struct<char_span: array<int>, timecode: struct<start: string, end: string, srt_index: int>>",
    "annotations": f"annotation_id string, unit_ref string, rule_id string, rule_version int, label_vote string, authority_mode string, authority_level string, gate string, trigger_text string, {_SPAN}",
    "term_occurrences": f"term_occurrence_id string, unit_ref string, term string, canonical_form string, category string, trigger_text string, {_SPAN}",
    "candidate_case_files": "candidate_id string, vote_refs array<string>, segmentation_quality string, authority_level string, evidence_ready string, "
    "anchor struct<char_span: array<int>, timecode: string, unit_ref: string>, context_window struct<sentences_before: int, sentences_after: int>, "
    "routing struct<bucket: string, reason: string>, caps_applied struct<family: string, rank_in_family: int, kept: boolean>",
    "feature_records": "feature_record_id string, unit_ref string",
}
IDS = {"units": "unit_id", "annotations": "annotation_id", "term_occurrences": "term_occurrence_id", "candidate_case_files": "candidate_id", "feature_records": "feature_record_id"}


def lines(spark: SparkSession, root: str, name: str) -> DataFrame:
    """source_id and value of every stored line of a kind; none if the kind was never written."""
    try:
        rows = spark.read.text(f"{root.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], "value string")
    source = F.col("source_id").cast("string") if "source_id" in rows.columns else F.lit(None).cast("string")
    return rows.select(source.alias("source_id"), "value").where("trim(value) <> ''")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The records of a kind as a flat table; a line that does not parse is left out here and reported by violations()."""
    rows = lines(spark, root, name).select("source_id", F.from_json("value", SCHEMAS[name]).alias("r")).where("r IS NOT NULL").select("source_id", "r.*")
    if "anchor" not in rows.columns:
        return rows
    start, end = F.get("anchor.char_span", F.lit(0)).alias("start"), F.get("anchor.char_span", F.lit(1)).alias("end")
    others = [c for c in rows.columns if c != "anchor"]
    if name == "units":
        code = F.col("anchor.timecode")
        return rows.select(*others, start, end, code["start"].alias("tc_start"), code["end"].alias("tc_end"), code["srt_index"].alias("srt_index"))
    if name != "candidate_case_files":
        return rows.select(*others, start, end, F.col("anchor.timecode_ref").alias("tc_start"))
    nested = ("anchor", "context_window", "routing", "caps_applied", "evidence_ready")
    return rows.select(
        *(c for c in rows.columns if c not in nested),
        start,
        end,
        "anchor.unit_ref",
        F.col("anchor.timecode").alias("tc_start"),
        "context_window.sentences_before",
        "context_window.sentences_after",
        "routing.bucket",
        "routing.reason",
        "caps_applied.family",
        "caps_applied.rank_in_family",
        "caps_applied.kept",
        F.when(F.col("evidence_ready") != "true", F.col("evidence_ready")).alias("blocked_reason"),
    )


def required(spark: SparkSession, root: str, name: str) -> DataFrame:
    rows = table(spark, root, name)
    if rows.isEmpty():
        raise FileNotFoundError(f"no {name} in {root}")
    return rows


def annotate_run(spark: SparkSession, root: str, run_id: str, rules=RULES, terms=TERMS, execute: bool = True) -> DataFrame:
    """Votes and term occurrences of the stored units, stored; returns the votes."""
    held = required(spark, root, "units").select("source_id", "start", "end", "text", "unit_id", "tc_start", "segmentation_quality")
    votes = annotate.rule_votes(held, rules)
    write_jsonl(annotate.annotation_records(votes, run_id), f"{root}/annotations", execute)
    write_jsonl(annotate.term_records(annotate.term_occurrences(held, terms), run_id), f"{root}/term_occurrences", execute)
    return votes


def candidates_run(spark: SparkSession, root: str, run_id: str, tier: str = "D", execute: bool = True) -> DataFrame:
    """Candidates of the stored units and annotations, stored; returns them."""
    found = candidates.capped(candidates.with_units(candidates.assemble(table(spark, root, "annotations")), required(spark, root, "units")))
    write_jsonl(candidates.candidate_records(candidates.in_order(found), run_id, tier), f"{root}/candidate_case_files", execute)
    return found


def enrich_run(spark: SparkSession, root: str, run_id: str, markers=MARKERS, phrases=DEICTICS, execute: bool = True) -> DataFrame:
    """Feature records of the stored units, stored if all are sound; returns them."""
    records = features.feature_records(required(spark, root, "units"), run_id, markers, phrases)
    if execute:
        validate.require_clean(validate.feature_violations(records))
    return write_jsonl(records, f"{root}/feature_records", execute)


def violations(spark: SparkSession, root: str) -> DataFrame:
    """Violations of a stored run, as check, key and violation: lines, ids, references, hashes, spans and candidates."""
    bad: Column = F.from_json("value", "_bad string", {"columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull() | F.expr("try_parse_json(value)").isNull()
    found = []
    for name in SCHEMAS:
        broken = lines(spark, root, name).where(bad)
        found.append(broken.select(F.lit(name).alias("check"), F.col("value").alias("key"), F.lit("invalid JSON").alias("violation")))
    held = {name: table(spark, root, name) for name in SCHEMAS}
    # repeated ids of candidates, unique within their source only, are among candidate_violations
    found += [validate.duplicates(held[name], key) for name, key in IDS.items() if name != "candidate_case_files"]
    found += [validate.orphans(held[name], "unit_ref", held["units"], "unit_id") for name in ("annotations", "term_occurrences", "feature_records")]
    records = lines(spark, root, "feature_records").select("source_id", F.expr("try_parse_json(value)").alias("record"))
    found += [
        validate.gating_violations(records.where("record IS NOT NULL"), "record"),
        validate.transcript_violations(held["transcripts"], held["lockfiles"]),
        validate.anchor_violations(held["units"], held["transcripts"]),
        validate.vote_violations(held["annotations"], held["units"]),
        validate.candidate_violations(held["candidate_case_files"], held["annotations"], held["units"]),
    ]
    return reduce(DataFrame.unionByName, found)


def counts(spark: SparkSession, root: str) -> DataFrame:
    """How many records of each kind every source has."""
    each = [lines(spark, root, name).select("source_id", F.lit(name).alias("kind")) for name in IDS]
    return reduce(DataFrame.unionByName, each).groupBy("source_id").pivot("kind", [*IDS]).count().na.fill(0)


def profile_units(spark: SparkSession, root: str) -> DataFrame:
    """The segmentation quality of every stored source, from its units."""
    return units.quality(required(spark, root, "units"))
