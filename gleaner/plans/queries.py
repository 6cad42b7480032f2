"""Registered queries of the engine's own operators, over whole tables, with a registry whose rules fire there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import ids
from gleaner.functions.text import normalized
from gleaner.operators import annotate, candidates, dictionary, features, packs, units, validate, votes
from gleaner.registries import Deictic, Marker, Rule, Term
from gleaner.sources.tables import conversations_as_cues, documents_as_sources, pages_as_sources, table

RULES = (
    Rule("contrast_001", 1, "contrast", "regex", r"(?i)\bthat\b"),
    Rule("contrast_002", 1, "contrast", "regex", r"(?i)\bthis\b", "shadow"),
    Rule("deontic_001", 1, "deontic", "regex", r"(?i)\bwith\b"),
    Rule("deontic_002", 2, "deontic", "regex", r"(?i)\bfrom\b"),
    Rule("license_001", 1, "license", "phrase", "licensed under"),
    Rule("license_002", 1, "license", "phrase", "released under"),
    Rule("lang_fr_001", 1, "lang_fr", "regex", r"(?i)\bque\b", "shadow", "window_fallback"),
)
TERMS = (Term("license", "legal"), Term("the", "article"), Term("apache license", "legal", "Apache License"), Term("des", "article"))
SEEDS = (("The", "article"), ("license", "legal"), ("des", ""))
GAZETTEER = (("the", "", "the article"), ("License", "law", ""), ("apache license", "legal", "Apache License"))
MARKERS = (
    Marker("that", "contrast", "", "1.0.0"),
    Marker("with", "deontic", "", "1.2.0"),
    Marker("for", "hedging", "", "1.10.0"),
    Marker("que", "contrast", "", "1.0.0"),
)
DEICTICS = (Deictic("the", "deictic_pronoun"), Deictic("rights reserved", "visual_reference"))
CAP_ABOVE, CAP_KEEP, TOP_K = 8, 5, 60
RUN = "run_bench"


def doc_units_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, panel, start, end, text, unit_id and an empty time code of every sentence of every document."""
    return units.with_ids(units.segment(documents_as_sources(spark, sf_dir))).withColumn("tc_start", F.lit("00:00:00,000"))


def full_units_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_units_of with contexts and quality."""
    return units.with_ids(units.segment(documents_as_sources(spark, sf_dir), candidates.CONTEXT, profiled=True))


def votes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.rule_votes(doc_units_of(spark, sf_dir), RULES)


def candidates_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.assemble(votes_of(spark, sf_dir))


def carrying_candidates_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = full_units_of(spark, sf_dir).withColumn("tc_start", F.lit("00:00:00,000"))
    return candidates.assemble(annotate.rule_votes(held, RULES, with_text=True))


def tokens_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.tokenized(doc_units_of(spark, sf_dir), "panel")


def baseline_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark texts as the general-language baseline."""
    items = table(spark, sf_dir, "benchmark").select(F.lit("b").alias("source_id"), normalized(F.col("text")).alias("text"))
    return dictionary.baseline(dictionary.tokenized(items))


def keyness_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = tokens_of(spark, sf_dir)
    return dictionary.keyness(dictionary.unigrams(toks), baseline_of(spark, sf_dir), dictionary.totals(toks))


def lane_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as votes of two lanes: quality 1 confirms, 0 rejects; toxic 1 rejects, 0 confirms; every fifth document is a control."""
    labels = table(spark, sf_dir, "labels")
    ref = F.format_string("doc%d", "doc_id").alias("candidate_ref")
    control = (F.col("doc_id") % 5 == 0).alias("is_control")
    one = lambda lane, c, verdict: labels.select(
        F.lit(lane).alias("lane"), ref, control, verdict.alias("verdict"), F.col("doc_id").alias("seq"), (F.col("doc_id") % 100).alias("prompt_tokens"), F.col(c).cast("long").alias("completion_tokens")
    )
    quality = F.when(F.col("quality") == 1, "confirm").when(F.col("doc_id") % 7 == 0, "uncertain").otherwise("reject")
    toxic = F.when(F.col("toxic") == 1, "reject").otherwise("confirm")
    return one("quality", "quality", quality).unionByName(one("toxic", "toxic", toxic))


def malformed_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh label as a malformed reply, every thirteenth as a lane failure."""
    labels = table(spark, sf_dir, "labels")
    kind = F.when(F.col("doc_id") % 11 == 0, "model_malformed").when(F.col("doc_id") % 13 == 0, "lane_failure")
    rows = labels.select(F.lit("quality").alias("lane"), F.format_string("doc%d", "doc_id").alias("candidate_ref"), (F.col("doc_id") % 5 == 0).alias("is_control"), kind.alias("failure_type"))
    return rows.where("failure_type IS NOT NULL")


# units


def doc_units(spark, sf_dir):
    return doc_units_of(spark, sf_dir).select("source_id", "start", "end", "text")


def doc_unit_ids(spark, sf_dir):
    rows = doc_units_of(spark, sf_dir)
    return rows.select("unit_id", ids.feature_record_id("unit_id", F.lit("surface_complexity_profile"), F.lit("1.0.0")).alias("feature_record_id"), F.length("text").alias("n_chars"))


def page_units(spark, sf_dir):
    return units.segment(pages_as_sources(spark, sf_dir)).select("source_id", "start", "end", "text")


def quality_profile(spark, sf_dir):
    return units.profiles(documents_as_sources(spark, sf_dir)).where("sentence_count > 0")


def transcript_hash(spark, sf_dir):
    docs = documents_as_sources(spark, sf_dir)
    return docs.select("source_id", units.text_hash("text").alias("sha256"), F.length("text").alias("char_count"))


def conversation_transcript(spark, sf_dir):
    return units.build_transcripts(conversations_as_cues(spark, sf_dir)).select("source_id", units.text_hash("text").alias("sha256"), "cue_count")


def cue_ranges(spark, sf_dir):
    return units.cue_ranges(conversations_as_cues(spark, sf_dir)).select("source_id", "cue_ord", "c_start", "c_end")


def turn_asof(spark, sf_dir):
    cues = conversations_as_cues(spark, sf_dir)
    spoken = units.segment(units.build_transcripts(cues).select("source_id", "text"))
    return units.with_cues(spoken, units.cue_ranges(cues)).select("source_id", "start", "end", "srt_index")


# votes and terms


def rule_votes(spark, sf_dir):
    return votes_of(spark, sf_dir).select("annotation_id", "unit_ref", "rule_id", "label_vote", "authority_level", F.coalesce("gate", F.lit("")).alias("gate"), F.lower("trigger_text").alias("trigger_text"))


def votes_by_family(spark, sf_dir):
    return votes_of(spark, sf_dir).groupBy("label_vote", "rule_id").agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("n_sources"))


def shadow_split(spark, sf_dir):
    return votes_of(spark, sf_dir).groupBy("authority_mode").agg(F.count("*").alias("n"))


def term_occurrences(spark, sf_dir):
    rows = annotate.term_occurrences(doc_units_of(spark, sf_dir), TERMS)
    return rows.select("term_occurrence_id", "unit_ref", "canonical_form", "category", F.lower("trigger_text").alias("trigger_text"))


def gazetteer_merge(spark, sf_dir):
    seeds = spark.createDataFrame(SEEDS, "term string, category string")
    gazetteer = spark.createDataFrame(GAZETTEER, "term string, category string, canonical_form string")
    merged = annotate.merge_gazetteer(seeds, gazetteer)
    # how often each merged term stands in the documents
    counted = annotate.term_occurrences(doc_units_of(spark, sf_dir), tuple(Term(t) for t in ("the", "license", "apache license", "des")))
    counts = counted.groupBy(F.lower("term").alias("key")).agg(F.count("*").alias("n"))
    return merged.join(counts, F.lower("term") == F.col("key"), "left").select("term", "canonical_form", "category", F.coalesce("n", F.lit(0)).alias("n"))


# candidates


def clusters_touching(spark, sf_dir):
    """Unit spans widened by 40 characters, so that they overlap and touch."""
    wide = votes_of(spark, sf_dir).select("source_id", "label_vote", F.greatest(F.col("start") - 40, F.lit(0)).alias("start"), (F.col("end") + 40).alias("end"))
    placed = candidates.clusters(wide, ["source_id", "label_vote"])
    return placed.groupBy("source_id", "label_vote", "cluster").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("cluster")


def primary_pick(spark, sf_dir):
    return candidates_of(spark, sf_dir).select("source_id", "family", "start", "rule_id", "n_active")


def candidate_ids(spark, sf_dir):
    return candidates_of(spark, sf_dir).select("candidate_id", "unit_ref", "bucket", "reason", "authority_level", F.array_join("vote_refs", ",").alias("vote_refs"))


def candidates_by_bucket(spark, sf_dir):
    return candidates_of(spark, sf_dir).groupBy("family", "bucket").agg(F.count("*").alias("n"))


def family_caps(spark, sf_dir):
    return candidates.capped(candidates_of(spark, sf_dir), CAP_ABOVE, CAP_KEEP).select("source_id", "family", "start", "authority_level", "rank_in_family", "kept")


def cap_log(spark, sf_dir):
    return candidates.cap_log(candidates_of(spark, sf_dir), CAP_ABOVE, CAP_KEEP)


def context_counts(spark, sf_dir):
    return candidates.contexts(full_units_of(spark, sf_dir)).select("unit_id", "sentences_before", "sentences_after")


def context_text(spark, sf_dir):
    return candidates.contexts(full_units_of(spark, sf_dir)).select("unit_id", "context_before", "context_after")


def evidence_ready(spark, sf_dir):
    """Readiness when the first unit of every tenth document is lost."""
    held = doc_units_of(spark, sf_dir).where("NOT (start = 0 AND source_id LIKE '%0')").withColumn("segmentation_quality", F.lit("punctuated_clean"))
    rows = candidates.with_units(candidates_of(spark, sf_dir), held)
    return rows.groupBy(F.coalesce("blocked_reason", F.lit("ready")).alias("evidence_ready"), "sentences_before", "sentences_after").agg(F.count("*").alias("n"))


# features


def surface_complexity(spark, sf_dir):
    return features.surface_complexity(full_units_of(spark, sf_dir)).select("unit_id", "triggered", "length_tokens", "length_chars", "lexical_density", "suppression_reason")


def marker_profile(spark, sf_dir):
    rows = features.discourse_markers(doc_units_of(spark, sf_dir), MARKERS)
    surfaces = F.array_join(F.transform("markers", lambda m: m.surface), ",")
    return rows.select("unit_id", "version", surfaces.alias("surfaces"), F.array_join("categories_present", ",").alias("categories"))


def deictic_profile(spark, sf_dir):
    rows = features.deictic_phrases(doc_units_of(spark, sf_dir), DEICTICS)
    return rows.select("unit_id", F.array_join(F.transform("phrases", lambda p: F.concat(p.surface, F.lit(":"), p.kind)), ",").alias("phrases"))


def feature_counts(spark, sf_dir):
    return features.feature_counts(features.feature_records(full_units_of(spark, sf_dir), RUN, MARKERS, DEICTICS)).groupBy("name").agg(F.sum("records").alias("records"), F.sum("triggered").alias("triggered"))


# dictionary


def unigram_counts(spark, sf_dir):
    return dictionary.unigrams(tokens_of(spark, sf_dir))


def bigram_counts(spark, sf_dir):
    return dictionary.phrase_counts(tokens_of(spark, sf_dir), 2)


def trigram_counts(spark, sf_dir):
    return dictionary.phrase_counts(tokens_of(spark, sf_dir), 3)


def corpus_totals(spark, sf_dir):
    return dictionary.totals(tokens_of(spark, sf_dir))


def cap_counts(spark, sf_dir):
    return dictionary.capitalized(tokens_of(spark, sf_dir))


def keyness_topk(spark, sf_dir):
    return dictionary.top_terms(keyness_of(spark, sf_dir), dictionary.capitalized(tokens_of(spark, sf_dir)), top_k=TOP_K).drop("zipf")


def phrases_topk(spark, sf_dir):
    toks, keyed = tokens_of(spark, sf_dir), keyness_of(spark, sf_dir)
    return dictionary.top_phrases(dictionary.phrases(dictionary.phrase_counts(toks, 2), keyed), dictionary.phrases(dictionary.phrase_counts(toks, 3), keyed), TOP_K)


def collocates_top6(spark, sf_dir):
    return dictionary.collocates(keyness_topk(spark, sf_dir), bigram_counts(spark, sf_dir))


def kwic_top4(spark, sf_dir):
    """Examples of the most frequent terms and bigrams."""
    order = (F.desc("count"), F.col("term"))
    terms = unigram_counts(spark, sf_dir).orderBy(*order).limit(20)
    top = bigram_counts(spark, sf_dir).orderBy(F.desc("count"), "phrase").limit(10)
    return dictionary.examples(doc_units_of(spark, sf_dir), terms, top).select("term", "source_id", "start", "score", "rank")


def blind_spots(spark, sf_dir):
    probes = (("The law", ("license", "licensed"), "homograph"), ("Apache", ("apache license",), "tokenization"), ("none", ("zzzz",), "asr"))
    return dictionary.blind_spots(unigram_counts(spark, sf_dir), bigram_counts(spark, sf_dir), keyness_topk(spark, sf_dir).select("term"), probes)


# validators


def fk_orphans(spark, sf_dir):
    """Votes whose unit is lost: those of the first unit of every document."""
    held = doc_units_of(spark, sf_dir).where("start > 0")
    return validate.orphans(votes_of(spark, sf_dir), "unit_ref", held, "unit_id").groupBy("check", "key").agg(F.count("*").alias("n"))


def dup_ids(spark, sf_dir):
    """Units, those of every third document twice."""
    rows = doc_units_of(spark, sf_dir)
    twice = rows.unionByName(rows.where("source_id LIKE '%3'"))
    return validate.duplicates(twice, "unit_id")


def anchor_violations(spark, sf_dir):
    """Spans of the first unit of a document moved, of the second put out of bounds."""
    rows = doc_units_of(spark, sf_dir)
    moved = rows.withColumn("end", F.when(F.col("start") == 0, F.col("end") - 1).when(F.col("start") < 20, F.col("end") + 10_000_000).otherwise(F.col("end")))
    return validate.anchor_violations(moved, documents_as_sources(spark, sf_dir)).groupBy("violation").agg(F.count("*").alias("n"))


def metadata_hash(spark, sf_dir):
    """The hash of every document's metadata, each as a source of one cue."""
    docs = documents_as_sources(spark, sf_dir).select("source_id", "text", F.lit(1).alias("cue_count")).where("text IS NOT NULL")
    return units.lockfile(docs, units.profiles(docs), RUN).select("source_id", "metadata_sha256")


def vote_span_violations(spark, sf_dir):
    """Votes of the first unit of a document with another span, those of one rule with another trigger."""
    rows = votes_of(spark, sf_dir)
    moved = rows.withColumn("end", F.when(F.col("start") == 0, F.col("end") + 1).otherwise(F.col("end")))
    moved = moved.withColumn("trigger_text", F.when(F.col("rule_id") == "deontic_001", "zqzq").otherwise(F.col("trigger_text")))
    return validate.vote_violations(moved, doc_units_of(spark, sf_dir)).groupBy("violation").agg(F.count("*").alias("n"))


def candidate_violations(spark, sf_dir):
    """Candidates without a reason, of an unknown authority or with a stale readiness, by the document's last digit."""
    last = F.right("source_id", F.lit(1))
    rows = candidates.ready(carrying_candidates_of(spark, sf_dir))
    rows = rows.withColumns(
        {
            "reason": F.when(last == "1", F.lit("")).otherwise(F.col("reason")),
            "authority_level": F.when(last == "2", F.lit("judge")).otherwise(F.col("authority_level")),
            "blocked_reason": F.when(last == "4", F.lit("blocked:context_missing")).otherwise(F.col("blocked_reason")),
        }
    )
    found = validate.candidate_violations(rows, votes_of(spark, sf_dir), doc_units_of(spark, sf_dir))
    return found.groupBy("violation").agg(F.count("*").alias("n"))


def schema_violations(spark, sf_dir):
    """events.props against a schema that part of it breaks."""
    props = table(spark, sf_dir, "conversations").select(F.to_json(F.struct(F.col("conv_id"), F.col("turn"), F.col("role"))).alias("value"))
    schema = {
        "type": "object", "additionalProperties": False, "required": ["conv_id", "role", "text"],
        "properties": {"conv_id": {"type": "integer", "minimum": 10}, "role": {"type": "string", "enum": ["user"]}},
    }
    return validate.schema_violations(props, schema, "turns").groupBy("violation").agg(F.count("*").alias("n"))


# judged votes


def candidate_packs(spark, sf_dir):
    rows = packs.carried_packs(carrying_candidates_of(spark, sf_dir))
    return rows.select("candidate_ref", "family", "pack_id", F.length("candidate_text").alias("n_chars"))


def controls_union(spark, sf_dir):
    """Benchmark items as controls, beside the candidates' packs."""
    controls = table(spark, sf_dir, "benchmark").select(
        F.format_string("ctl_%d", "item_id").alias("control_id"), F.lit("contrast").alias("mimicked_family"), normalized(F.col("text")).alias("text"), F.lit(None).cast("string").alias("ref_candidate_id"), F.lit(None).cast("string").alias("ref_source_id"),
    )
    both = packs.carried_packs(carrying_candidates_of(spark, sf_dir)).unionByName(packs.control_packs(controls))
    return both.groupBy("family", "is_control").agg(F.count("*").alias("n"), F.min("candidate_ref").alias("least_ref"))


def resume_pending(spark, sf_dir):
    """Labelled documents as packs; those with a vote or a malformed reply are done."""
    docs = table(spark, sf_dir, "documents").select(F.format_string("doc%d", "doc_id").alias("candidate_ref"), (F.col("doc_id") % 5 == 0).alias("is_control"))
    done = lane_votes(spark, sf_dir).where("verdict <> 'uncertain' AND seq % 13 <> 0")
    return packs.pending(docs, "quality", done, malformed_of(spark, sf_dir))


def vote_summary(spark, sf_dir):
    return votes.summary(lane_votes(spark, sf_dir), malformed_of(spark, sf_dir))


def agreement(spark, sf_dir):
    return votes.lane_agreement(lane_votes(spark, sf_dir), ["quality", "toxic"])


def compared_of(spark, sf_dir):
    rows = lane_votes(spark, sf_dir).where("NOT is_control")
    return votes.compared(rows.where("lane = 'quality'"), rows.where("lane = 'toxic'"))


def adjudication(spark, sf_dir):
    return votes.adjudication(compared_of(spark, sf_dir))


def confusion(spark, sf_dir):
    return votes.confusion(compared_of(spark, sf_dir))


def flips(spark, sf_dir):
    return votes.flips(compared_of(spark, sf_dir))


def confirm_by_bucket(spark, sf_dir):
    """Votes by the candidates' places, every fifth a control, joined to their buckets."""
    found = candidates_of(spark, sf_dir)
    verdict = F.when(F.col("start") % 3 == 0, "confirm").when(F.col("start") % 3 == 1, "reject").otherwise("uncertain")
    cast = found.select(
        "source_id", "start", "end", "rule_id", F.col("candidate_id").alias("candidate_ref"), verdict.alias("verdict"), (F.col("start") % 5 == 0).alias("is_control")
    )
    return votes.by_bucket(cast, found)


def parse_responses(spark, sf_dir):
    """Turns wrapped as a judge's replies, some fenced, some cut off."""
    from gleaner.functions.responses import parse_response

    turns = table(spark, sf_dir, "conversations")
    body = F.to_json(F.struct(F.lit("confirm").alias("verdict"), F.col("text").alias("rationale")))
    reply = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(F.col("conv_id") % 3 == 1, F.concat(F.lit("Sure: "), body, F.lit(" done"))).otherwise(F.substring(body, 1, 40))
    rows = turns.select("conv_id", "turn", parse_response(reply).alias("p"))
    return rows.select("conv_id", "turn", F.col("p.object").isNotNull().alias("ok"), F.coalesce("p.reason", F.lit("")).alias("reason"), F.length("p.object").alias("size"))


QUERIES = {
    f.__name__: f
    for f in (
        doc_units, doc_unit_ids, page_units, quality_profile, transcript_hash, conversation_transcript, cue_ranges, turn_asof, rule_votes,
        votes_by_family, shadow_split, term_occurrences, gazetteer_merge, clusters_touching, primary_pick, candidate_ids,
        candidates_by_bucket, family_caps, cap_log, context_counts, context_text, evidence_ready, surface_complexity, marker_profile,
        deictic_profile, feature_counts, unigram_counts, bigram_counts, trigram_counts, corpus_totals, cap_counts, keyness_topk,
        phrases_topk, collocates_top6, kwic_top4, blind_spots, fk_orphans, dup_ids, anchor_violations, schema_violations,
        metadata_hash, vote_span_violations, candidate_violations,
        candidate_packs, controls_union, resume_pending, vote_summary, agreement, adjudication, confusion, flips, confirm_by_bucket,
        parse_responses,
    )
}
