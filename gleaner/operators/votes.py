"""Votes of judges: the call, validation, summaries, agreement and adjudication."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions import ids
from gleaner.functions.responses import parse_response
from gleaner.functions.text import rounded
from gleaner.operators.packs import PROMPT_ID, PROMPT_VERSION
from gleaner.registries import ENUMS

#: Share of controls that a lane must reject.
CONTROL_BAR = 0.90
#: A judge: prompt -> (reply, usage, model, return code). usage: input, cached_input, output, reasoning.
Judge = Callable[[str], tuple[str, dict, str, int]]
_VOTE = "verdict string, inference_type string, confidence string, rationale string, rejection_reason string, reason_note string"


def called(packs: DataFrame, judge: Judge, lane: str) -> DataFrame:
    """The packs with reply, model, returncode, error and token counts; one call each, none repeated.

    Store the result before anything reads it: a lineage that is computed again would call again.
    """
    added = "lane string, reply string, model string, returncode int, error string, prompt_tokens long, completion_tokens long"
    columns = [*packs.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for prompt in pdf["prompt"]:
                try:
                    reply, usage, model, code = judge(prompt)
                    count = lambda *names, u=usage: sum(int(u.get(n) or 0) for n in names)
                    rows.append((lane, reply, model, code, None, count("input", "cached_input"), count("output", "reasoning")))
                except Exception as error:  # a transport failure is a result of its own
                    rows.append((lane, None, None, None, f"lane_exception: {error}", 0, 0))
            more = pd.DataFrame(rows, columns=[x.split()[0] for x in added.split(", ")], index=pdf.index)
            yield pd.concat([pdf[columns], more], axis=1)

    schema = ", ".join(f"{c} {t}" for c, t in packs.dtypes) + ", " + added
    return packs.mapInPandas(run, schema)


def vote_errors(vote: Column) -> Column:
    """What is wrong with a parsed vote (a variant), as an array; empty if nothing is."""
    get = lambda name: F.try_variant_get(vote, f"$.{name}", "string")
    checks = []
    for name in ("verdict", "inference_type", "confidence"):
        checks.append(F.when(get(name).isNull(), f"vote.vote: missing required field '{name}'").when(~get(name).isin(ENUMS[name]), F.concat(F.lit(f"vote.vote.{name}: "), get(name), F.lit(" not in enum"))))
    checks.append(F.when(get("rationale").isNull(), "vote.vote: missing required field 'rationale'").when(get("rationale") == "", "vote.vote.rationale: shorter than minLength 1"))
    reason = get("rejection_reason")
    checks.append(F.when(reason.isNotNull() & ~reason.isin(ENUMS["rejection_reason"]), F.concat(F.lit("vote.vote.rejection_reason: "), reason, F.lit(" not in enum"))))
    checks.append(F.when((get("verdict") == "reject") & reason.isNull(), "vote.vote: verdict=reject requires rejection_reason"))
    keys = F.json_object_keys(F.to_json(vote))
    extra = F.array_except(keys, F.array(*(F.lit(x.split()[0]) for x in _VOTE.split(", "))))
    checks.append(F.when(F.size(extra) > 0, F.concat(F.lit("vote.vote: unexpected field "), F.array_join(extra, ","))))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def judged(results: DataFrame) -> DataFrame:
    """Results of calls with vote (parsed), failure_type and reason; failure_type is null for a vote."""
    rows = results.withColumn("_parsed", parse_response(F.coalesce("reply", F.lit(""))))
    rows = rows.withColumn("_vote", F.try_parse_json("_parsed.object"))
    rows = rows.withColumn("_errors", F.when(F.col("_vote").isNotNull(), vote_errors(F.col("_vote"))))
    silent = (F.coalesce("returncode", F.lit(1)) != 0) | (F.trim(F.coalesce("reply", F.lit(""))) == "")
    lane = F.coalesce("error", F.concat(F.lit("returncode="), F.coalesce(F.col("returncode").cast("string"), F.lit("none"))))
    failed = F.when(silent, "lane_failure").when(F.col("_vote").isNull() | (F.size("_errors") > 0), "model_malformed")
    reason = F.when(silent, lane).when(F.col("_vote").isNull(), F.col("_parsed.reason")).when(
        F.size("_errors") > 0, F.concat(F.lit("schema_invalid: "), F.array_join("_errors", "; "))
    )
    vote = F.from_json("_parsed.object", _VOTE)
    # a reply that parses takes a number, valid or not
    return rows.withColumns({"failure_type": failed, "reason": reason, "vote": vote, "takes_number": ~silent & F.col("_vote").isNotNull()}).drop("_parsed", "_vote", "_errors")


def numbered(results: DataFrame, recorded: int = 0) -> DataFrame:
    """Results with seq, the running number of replies that parse (null for others)."""
    numbered = results.where("takes_number").withColumn("_part", F.pmod(F.xxhash64("lane", "pack_id"), F.lit(64)))
    # running numbers without one task for all: counts of the parts before, then numbers within a part
    parts = numbered.groupBy("lane", "_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("lane", "_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = Window.partitionBy("lane", "_part").orderBy("source_id", "candidate_ref", "is_control", "pack_id")
    rows = numbered.withColumn("_at", F.row_number().over(within) - 1).join(F.broadcast(parts), ["lane", "_part"])
    rows = rows.withColumn("seq", (F.lit(recorded) + F.col("_before") + F.col("_at")).cast("long")).select(*results.columns, "seq")
    return rows.unionByName(results.where("NOT takes_number").withColumn("seq", F.lit(None).cast("long")))


def vote_records(results: DataFrame, run_id: str, tier: str = "base", recorded: int = 0) -> DataFrame:
    """Valid votes as records. Numbers go on after the largest given so far (recorded), by lane, then a hash of the pack, then source
    and candidate; replies that parse but are not valid take a number too, which malformed records keep."""
    rows = numbered(results, recorded).where("failure_type IS NULL")
    return rows.select(
        ids.llm_vote_id(F.lit(run_id.rsplit("_", 1)[-1]), "pack_id", "seq").alias("llm_vote_id"),
        "candidate_ref",
        "source_id",
        F.lit(run_id).alias("run_id"),
        "pack_id",
        F.lit(PROMPT_ID).alias("prompt_id"),
        F.lit(PROMPT_VERSION).alias("prompt_version"),
        "model",
        "lane",
        F.lit("present").alias("injection_guard"),
        F.lit(1).alias("attempt"),
        F.lit(tier).alias("tier"),
        "is_control",
        F.lit("llm_vote").alias("authority_level"),
        F.lit("llm_reviewed").alias("review_state"),
        "vote",
        F.struct(F.col("prompt_tokens").alias("prompt"), F.col("completion_tokens").alias("completion")).alias("token_counts"),
    )


def malformed_records(results: DataFrame, recorded: int = 0) -> DataFrame:
    return numbered(results, recorded).where("failure_type IS NOT NULL").select(
        "seq", "candidate_ref", "is_control", "pack_id", "lane", "model", "failure_type", F.coalesce("reply", F.lit("")).alias("raw_text"), "reason"
    )


def summary(votes: DataFrame, malformed: DataFrame, bar: float = CONTROL_BAR) -> DataFrame:
    """A row for each lane. votes: lane, verdict, is_control, prompt_tokens, completion_tokens; malformed: lane, failure_type.

    A rate without a denominator is null, and the bar then is not passed.
    """
    verdict, control = F.col("verdict"), F.col("is_control")
    one = votes.groupBy("lane").agg(
        F.count("*").alias("votes"),
        *(F.count_if(verdict == v).alias(v) for v in ENUMS["verdict"]),
        F.count_if(control).alias("control_votes"),
        F.count_if(control & (verdict == "reject")).alias("control_rejects"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
    )
    kind = F.col("failure_type")
    two = malformed.groupBy("lane").agg(
        F.count_if(kind == "model_malformed").alias("model_malformed"), F.count_if(kind == "lane_failure").alias("lane_failures")
    )
    both = one.join(two, "lane", "full_outer").na.fill(0)
    share = lambda a, b: rounded(F.try_divide(F.col(a).cast("double"), b), 6)
    rows = both.withColumns(
        {
            "malformed_rate": share("model_malformed", F.col("votes") + F.col("model_malformed")),
            "uncertain_rate": share("uncertain", F.col("votes")),
            "control_rejection_rate": share("control_rejects", F.col("control_votes")),
        }
    )
    exact = F.try_divide(F.col("control_rejects").cast("double"), F.col("control_votes"))
    return rows.withColumn("control_bar_passed", F.coalesce(exact >= bar, F.lit(False)))


def latest(votes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last vote of each key."""
    return votes.groupBy(*keys).agg(F.max_by("verdict", order).alias("verdict"))


def lane_agreement(votes: DataFrame, lanes: list[str], order: str = "seq") -> DataFrame:
    """shared_candidates, fully_agreed and agreement_rate over candidates (no controls) that all lanes voted on."""
    own = latest(votes.where(~F.col("is_control") & F.col("lane").isin(lanes)), ["candidate_ref", "lane"], order)
    each = own.groupBy("candidate_ref").agg(F.count("*").alias("n"), F.countDistinct("verdict").alias("k")).where(F.col("n") == len(lanes))
    out = each.agg(F.count("*").alias("shared_candidates"), F.count_if(F.col("k") == 1).alias("fully_agreed"))
    return out.withColumn("agreement_rate", rounded(F.try_divide(F.col("fully_agreed").cast("double"), F.col("shared_candidates")), 6))


def compared(base: DataFrame, strong: DataFrame, order: str = "seq") -> DataFrame:
    """candidate_ref, base and strong verdicts of those that both judged; the last vote counts."""
    left = latest(base, ["candidate_ref"], order).withColumnRenamed("verdict", "base")
    right = latest(strong, ["candidate_ref"], order).withColumnRenamed("verdict", "strong")
    return left.join(right, "candidate_ref")


def adjudication(pairs: DataFrame) -> DataFrame:
    """n_compared, agree, agreement_rate and n_flips."""
    same = F.col("base") == F.col("strong")
    out = pairs.agg(F.count("*").alias("n_compared"), F.count_if(same).alias("agree"), F.count_if(~same).alias("n_flips"))
    return out.withColumn("agreement_rate", rounded(F.try_divide(F.col("agree").cast("double"), F.col("n_compared")), 6))


def confusion(pairs: DataFrame) -> DataFrame:
    """label (base_X__strong_Y) and n."""
    label = F.concat(F.lit("base_"), "base", F.lit("__strong_"), "strong")
    return pairs.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


def by_bucket(votes: DataFrame, candidates: DataFrame) -> DataFrame:
    """bucket, votes, confirmed and confirm_rate of votes on candidates (no controls).

    An id is unique within its source only, so votes are joined by source and id, and by whatever else they carry of what ids are
    made of (start, end, rule_id).
    """
    keys = ["source_id", "candidate_ref", *(c for c in ("start", "end", "rule_id") if c in votes.columns)]
    about = candidates.withColumnRenamed("candidate_id", "candidate_ref").select(*keys, "bucket")
    kept = votes.where(~F.col("is_control")).select(*keys, "verdict").join(about, keys)
    out = kept.groupBy("bucket").agg(F.count("*").alias("votes"), F.count_if(F.col("verdict") == "confirm").alias("confirmed"))
    return out.withColumn("confirm_rate", rounded(F.try_divide(F.col("confirmed").cast("double"), F.col("votes")), 6))


def flips(pairs: DataFrame) -> DataFrame:
    return pairs.where("base <> strong")


def undated(model: Column) -> Column:
    """A model's name without a date at its end."""
    return F.regexp_replace(F.coalesce(model, F.lit("")), r"-\d{8}$", "")


def lane_of(model: Column, lanes: dict[str, str], families: dict[str, str] | None = None) -> Column:
    """The lane of a model: equal name, then a lane's name within it, then a family's word within it, else the name.

    lanes: lane -> model, the first wins; families: word -> lane.
    """
    out = None
    tests = [(model == name, lane) for lane, name in lanes.items()]
    tests += [(F.contains(model, F.lit(name)), lane) for lane, name in lanes.items() if name]
    tests += [(F.contains(F.lower(model), F.lit(word)), lane) for word, lane in (families or {}).items()]
    for test, lane in tests:
        out = F.when(test, lane) if out is None else out.when(test, lane)
    return model if out is None else out.otherwise(model)


def unadjudicated(packs: DataFrame, done: DataFrame, model: str) -> DataFrame:
    """Packs that the model has not judged yet, whatever date its recorded name ends with."""
    mine = done.where(undated(F.col("model")) == re.sub(r"-\d{8}$", "", model)).select("candidate_ref").distinct()
    return packs.join(mine, "candidate_ref", "left_anti")


def fake_judge(prompt: str) -> tuple[str, dict, str, int]:
    """A deterministic judge for tests and dry runs: the prompt's length decides."""
    n = len(prompt)
    verdict = ("confirm", "reject", "uncertain")[n % 3]
    more = ', "rejection_reason": "other"' if verdict == "reject" else ""
    reply = f'```json\n{{"verdict": "{verdict}", "inference_type": "stated", "confidence": "low", "rationale": "length {n}"{more}}}\n```'
    return reply, {"input": n // 4, "output": 20}, "fake-judge-1", 0
