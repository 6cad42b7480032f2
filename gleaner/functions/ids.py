"""Identifiers as Column expressions; they are the join keys of all records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA_VERSION = "0.1"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def schema_tag(version: str = SCHEMA_VERSION) -> str:
    return "s" + version.replace(".", "_")


def slug(text: Column | str) -> Column:
    """Lower case; each run of other characters is one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def short_hash(*parts: Column | str) -> Column:
    """Eight hex digits of the SHA-256 of the parts, a bar between them; null parts are empty."""
    joined = F.concat_ws("|", *(F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts))
    return F.substring(F.sha2(joined, 256), 1, 8)


def span(start: Column | str, end: Column | str) -> Column:
    return F.concat(_col(start).cast("string"), F.lit("-"), _col(end).cast("string"))


def source_id(text: Column | str, index: Column | str) -> Column:
    return F.format_string("src_%s_%02d", slug(text), _col(index))


def unit_id(source: Column | str, start: Column | str) -> Column:
    """The offset has six digits at least and is never cut."""
    return F.format_string("unit_%s_%06d", _col(source), _col(start))


def annotation_id(source, start, end, rule) -> Column:
    return F.concat(F.lit("ann_"), _col(source), F.lit("__"), span(start, end), F.lit("__"), _col(rule), F.lit("__" + schema_tag()))


def term_occurrence_id(source, start, end, term) -> Column:
    return F.concat(F.lit("term_"), _col(source), F.lit("__"), span(start, end), F.lit("__"), slug(term))


def candidate_id(source, start, end, rule) -> Column:
    return F.concat(F.lit("cand_"), short_hash(source, span(start, end), rule, F.lit(SCHEMA_VERSION)))


def llm_vote_id(run_short_: Column | str, pack: Column | str, seq: Column | str) -> Column:
    return F.format_string("llmv_run_%s_%s_%03d", _col(run_short_), _col(pack), _col(seq))


def evidence_id(candidate: Column | str) -> Column:
    return F.concat(F.lit("ev_"), _col(candidate))


def feature_record_id(unit: Column | str, name: Column | str, version: Column | str) -> Column:
    return F.concat(F.lit("feat_"), short_hash(unit, name, version))


def pack_id(prompt: str, version: int, candidate, before, text, after) -> Column:
    """Depends on the content alone, not on the model that judges it."""
    return F.concat(F.lit("pack_"), short_hash(F.lit(prompt), F.lit(version), candidate, before, text, after))


def run_short(run: Column | str) -> Column:
    return F.element_at(F.split(_col(run), "_"), -1)


def control_ref(control: Column | str) -> Column:
    """The candidate reference of a control that has none."""
    return F.concat(F.lit("cand_"), short_hash(control))
