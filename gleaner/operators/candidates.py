"""Candidates: clusters of votes, their primary vote, routing, context, readiness and caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import ids

#: Above so many routed candidates of a family in a source, only the first CAP_KEEP are kept.
CAP_ABOVE, CAP_KEEP, CONTEXT = 200, 100, 2


def clusters(spans: DataFrame, keys: list[str]) -> DataFrame:
    """spans (start, end) with their cluster's number within the keys: a maximal run that overlaps or touches.

    Gaps and islands: a row opens a cluster if it begins after every end before it.
    """
    order = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > before).cast("int"), F.lit(1))
    return spans.withColumn("_opens", opens).withColumn(
        "cluster", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("_opens")


def bucket_of(n_active: Column) -> Column:
    return F.when(n_active >= 2, "high").when(n_active == 1, "medium").otherwise("low")


def routing_reason(n_active: Column, family: Column) -> Column:
    voted = F.concat(n_active.cast("string"), F.lit(" active "), family, F.lit(" vote"), F.when(n_active == 1, "").otherwise("s"))
    return F.when(n_active > 0, voted).otherwise("shadow-only observational; excluded from routed caps + ablation")


#: What a unit can bring along through its votes, so that candidates need no join with all units.
CARRIED = ("sentences_before", "sentences_after", "segmentation_quality", "candidate_text", "context_before", "context_after")


def assemble(votes: DataFrame) -> DataFrame:
    """A row for each cluster of votes of one family in a source, with its primary vote's anchor and what its unit brings along."""
    carried = [c for c in CARRIED if c in votes.columns]
    placed = clusters(votes, ["source_id", "label_vote"])
    rank = F.when(F.col("authority_mode") == "active", 0).otherwise(1).alias("rank")
    primary = F.min(F.struct(rank, "rule_id", "start", "end", "unit_ref", "tc_start", *carried))
    rows = placed.groupBy("source_id", F.col("label_vote").alias("family"), "cluster").agg(
        primary.alias("p"),
        F.count_if(F.col("authority_mode") == "active").alias("n_active"),
        F.array_sort(F.collect_list("annotation_id")).alias("vote_refs"),
    )
    n = F.col("n_active")
    return rows.select(
        ids.candidate_id("source_id", "p.start", "p.end", "p.rule_id").alias("candidate_id"),
        "source_id",
        "family",
        F.col("p.rule_id").alias("rule_id"),
        F.col("p.start").alias("start"),
        F.col("p.end").alias("end"),
        F.col("p.unit_ref").alias("unit_ref"),
        F.col("p.tc_start").alias("tc_start"),
        "n_active",
        "vote_refs",
        bucket_of(n).alias("bucket"),
        routing_reason(n, F.col("family")).alias("reason"),
        F.when(n > 0, "rule_vote").otherwise("shadow").alias("authority_level"),
        *(F.col(f"p.{c}").alias(c) for c in carried),
    )


def contexts(units: DataFrame, n: int = CONTEXT) -> DataFrame:
    """unit_id with how many units stand before and after it (n at most), and their texts.

    Units that carry them already (see units.segment) are not shuffled; others need one window, no self-join.
    """
    if "context_before" in units.columns:
        return units.select("unit_id", "sentences_before", "sentences_after", "context_before", "context_after")
    order = Window.partitionBy("source_id").orderBy("start")
    whole = Window.partitionBy("source_id")
    at, size = F.row_number().over(order), F.count("*").over(whole)
    text = lambda a, b: F.array_join(F.collect_list("text").over(order.rowsBetween(a, b)), " ")
    return units.select(
        "unit_id",
        F.least(F.lit(n), at - 1).cast("int").alias("sentences_before"),
        F.least(F.lit(n), size - at).cast("int").alias("sentences_after"),
        text(-n, -1).alias("context_before"),
        text(1, n).alias("context_after"),
    )


def with_units(candidates: DataFrame, units: DataFrame, n: int = CONTEXT) -> DataFrame:
    """Candidates with context counts (0 for an unknown unit), segmentation quality and readiness.

    For candidates and units that were stored apart. Candidates whose votes carried these need no join: see ready.
    """
    counts = ["sentences_before", "sentences_after"]
    about = units
    if "sentences_before" not in units.columns:
        about = units.select("unit_id", "segmentation_quality").join(contexts(units, n).select("unit_id", *counts), "unit_id")
    about = about.select(F.col("unit_id").alias("unit_ref"), "segmentation_quality", *counts, F.lit(True).alias("known"))
    rows = candidates.join(about, "unit_ref", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select(
        *candidates.columns,
        none("sentences_before"),
        none("sentences_after"),
        "segmentation_quality",
        blocked_reason(F.col("known"), F.lit(True)).alias("blocked_reason"),
    )


def ready(candidates: DataFrame) -> DataFrame:
    """Candidates that carry their unit's counts, with readiness: their unit is known and has a context."""
    return candidates.withColumn("blocked_reason", blocked_reason(F.col("unit_ref").isNotNull(), F.col("sentences_before").isNotNull()))


def blocked_reason(unit_known: Column, has_context: Column) -> Column:
    """Why evidence is not ready; null if it is. Attribution never blocks."""
    return F.when(~F.coalesce(unit_known, F.lit(False)), "blocked:unit_ref_unresolved").when(
        ~F.coalesce(has_context, F.lit(False)), "blocked:context_missing"
    )


def capped(candidates: DataFrame, above: int = CAP_ABOVE, keep: int = CAP_KEEP) -> DataFrame:
    """Candidates with rank_in_family and kept. Shadow candidates are ranked apart and always kept."""
    routed = F.col("authority_level") == "rule_vote"
    level = F.when(routed, F.when(F.col("bucket") == "high", 0).when(F.col("bucket") == "medium", 1).otherwise(2)).otherwise(0)
    group = Window.partitionBy("source_id", "family", "_routed")
    rows = candidates.withColumn("_routed", routed).withColumn("_level", level)
    rows = rows.withColumn("rank_in_family", F.row_number().over(group.orderBy("_level", "start", "end", "candidate_id")))
    rows = rows.withColumn("_n", F.count("*").over(group))
    kept = ~F.col("_routed") | (F.col("_n") <= above) | (F.col("rank_in_family") <= keep)
    return rows.withColumn("kept", kept).drop("_routed", "_level", "_n")


def in_order(candidates: DataFrame) -> DataFrame:
    """Families by name; in each the routed ones by rank, then the shadow ones."""
    return candidates.orderBy("source_id", "family", (F.col("authority_level") != "rule_vote").cast("int"), "rank_in_family")


def cap_log(candidates: DataFrame, above: int = CAP_ABOVE, keep: int = CAP_KEEP) -> DataFrame:
    """total, routed and keep_k of every family of a source."""
    counted = candidates.groupBy("source_id", "family").agg(
        F.count("*").alias("total"), F.count_if(F.col("authority_level") == "rule_vote").alias("routed")
    )
    return counted.withColumn("keep_k", F.when(F.col("routed") > above, keep).otherwise(F.col("routed")).cast("long"))


def candidate_records(candidates: DataFrame, run_id: str, tier: str = "D") -> DataFrame:
    """Candidates as nested records; evidence_ready is true or the reason why not, as a variant."""
    ready = F.when(F.col("blocked_reason").isNull(), F.expr("parse_json('true')")).otherwise(
        F.parse_json(F.concat(F.lit('"'), "blocked_reason", F.lit('"')))
    )
    return candidates.select(
        "candidate_id",
        "source_id",
        F.lit(run_id).alias("run_id"),
        F.struct(F.array("start", "end").alias("char_span"), F.col("tc_start").alias("timecode"), "unit_ref").alias("anchor"),
        F.struct("sentences_before", "sentences_after").alias("context_window"),
        "segmentation_quality",
        "vote_refs",
        F.struct(F.lit("candidates").alias("stage"), F.lit("span_overlap_same_family").alias("dedup")).alias("method"),
        F.struct("bucket", "reason").alias("routing"),
        F.struct(F.lit(tier).alias("tier"), F.lit("").alias("speaker")).alias("attribution"),
        "authority_level",
        F.lit("candidate_assembled").alias("review_state"),
        ready.alias("evidence_ready"),
        F.struct("family", "rank_in_family", "kept").alias("caps_applied"),
    )
