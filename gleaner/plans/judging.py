"""Judged votes from packs to reports: resume, call, validate, record, summarize, adjudicate.

The store of a run is a folder of Parquet tables: calls (raw results, written before anything reads them), votes,
malformed and adjudication. A candidate's result in a lane is recorded once; only lane failures are tried again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import packs as P
from gleaner.operators import votes as V
from gleaner.sources.records import append_records, write_document, write_text

VOTES = (
    "llm_vote_id string, candidate_ref string, source_id string, run_id string, pack_id string, prompt_id string, prompt_version int, model string, "
    "lane string, injection_guard string, attempt int, tier string, is_control boolean, authority_level string, review_state string, "
    "vote struct<verdict:string,inference_type:string,confidence:string,rationale:string,rejection_reason:string,reason_note:string>, "
    "token_counts struct<prompt:bigint,completion:bigint>"
)
MALFORMED = "seq bigint, candidate_ref string, is_control boolean, pack_id string, lane string, model string, failure_type string, raw_text string, reason string"


def recorded(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the store; without rows if it was never written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def flat(votes: DataFrame) -> DataFrame:
    """lane, candidate_ref, is_control, verdict, seq, prompt_tokens, completion_tokens of vote records."""
    return votes.select(
        "lane",
        "candidate_ref",
        "is_control",
        F.col("vote.verdict").alias("verdict"),
        F.element_at(F.split("llm_vote_id", "_"), -1).cast("long").alias("seq"),
        F.col("token_counts.prompt").alias("prompt_tokens"),
        F.col("token_counts.completion").alias("completion_tokens"),
    )


def next_number(*tables: DataFrame) -> int:
    """One more than the largest number that a vote or a malformed reply of the store has."""
    found = [t.agg(F.max(F.col("seq") if "seq" in t.columns else F.element_at(F.split("llm_vote_id", "_"), -1).cast("long"))).first()[0] for t in tables]
    return max((n + 1 for n in found if n is not None), default=0)


def _call(rows: DataFrame, judge: V.Judge, lane: str, root: str) -> DataFrame:
    at = f"{root}/calls/{uuid.uuid4().hex}"
    V.called(rows, judge, lane).write.parquet(at)
    return V.judged(rows.sparkSession.read.parquet(at))


def run_lane(packs: DataFrame, judge: V.Judge, lane: str, root: str, run_id: str, execute: bool = False, fresh: bool = False) -> DataFrame:
    """Judges the packs of a lane that have no result yet; returns those. Without execute nothing is called or written."""
    spark, root = packs.sparkSession, root.rstrip("/")
    if fresh and execute:
        for name, schema in (("votes", VOTES), ("malformed", MALFORMED)):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/{name}")
    done, bad = recorded(spark, f"{root}/votes", VOTES), recorded(spark, f"{root}/malformed", MALFORMED)
    todo = P.pending(packs, lane, done, bad)
    if execute:
        results = _call(todo, judge, lane, root)
        first = next_number(done, bad)
        given = V.vote_records(results, run_id, recorded=first)
        given.write.mode("append").parquet(f"{root}/votes")
        V.malformed_records(results, first).write.mode("append").parquet(f"{root}/malformed")
        append_records(ledger(given), f"{root}/ledger")
        write_document(run_summary(spark, root), f"{root}/summary.json")
    return todo


def run_summary(spark: SparkSession, root: str) -> DataFrame:
    """A row for each lane of the store."""
    votes = recorded(spark, f"{root.rstrip('/')}/votes", VOTES)
    return V.summary(flat(votes), recorded(spark, f"{root.rstrip('/')}/malformed", MALFORMED))


def ledger(votes: DataFrame) -> DataFrame:
    """A row for each call that gave a vote: when, lane, model and tokens."""
    return votes.select(
        F.current_timestamp().alias("ts"), "lane", "model", F.col("token_counts.prompt").alias("prompt"), F.col("token_counts.completion").alias("completion")
    )


def adjudicate(packs: DataFrame, judge: V.Judge, model: str, lane: str, root: str, run_id: str, execute: bool = False) -> DataFrame:
    """A second, blind pass over candidates' packs by another model; returns base and strong verdicts. Failures are not recorded."""
    spark, root = packs.sparkSession, root.rstrip("/")
    base = recorded(spark, f"{root}/votes", VOTES).where("NOT is_control")
    if base.isEmpty():
        raise ValueError(f"no base votes in {root}/votes")
    at = f"{root}/adjudication"
    done = recorded(spark, at, VOTES)
    todo = V.unadjudicated(packs.where("NOT is_control"), done, model)
    if execute:
        results = _call(todo, judge, lane, root)
        V.vote_records(results, run_id, tier="escalation", recorded=next_number(done)).write.mode("append").parquet(at)
    pairs = V.compared(flat(base), flat(recorded(spark, at, VOTES)))
    if execute:
        write_text(spark, report(pairs, model), f"{root}/adjudication_report.json")
    return pairs


def report(pairs: DataFrame, model: str) -> str:
    """The adjudication report as a JSON document."""
    one = V.adjudication(pairs).first().asDict()
    changed = [r.asDict() for r in V.flips(pairs).orderBy("candidate_ref").collect()]
    table = {r.label: r.n for r in V.confusion(pairs).collect()}
    return json.dumps({"adjudicator_model": model} | one | {"flips": changed, "confusion": table}, indent=2, ensure_ascii=False)
