"""The sample transcript end to end, and faults that validators must see."""

import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators import candidates as C
from gleaner.operators import units as U
from gleaner.operators import validate as V
from gleaner.operators.features import feature_records
from gleaner.plans.evidence import from_cues
from gleaner.registries import Rule, Term, checked, merged_terms
from gleaner.sources.srt import parse_srt, read_srt, require_cues

LINES = [
    ("00:00:01,000 --> 00:00:05,000", "Welcome to our panel on the foundation model economy."),
    ("00:00:05,000 --> 00:00:09,500", "It's not a feature you bolt on at the end, it's the architecture you start from."),
    ("00:00:09,500 --> 00:00:13,000", "If you're building here, you need to focus on unit economics."),
    ("00:00:13,000 --> 00:00:17,000", "The risk is that inference cost eats your margin."),
    ("00:00:17,000 --> 00:00:20,500", "But who actually owns the model weights?"),
    ("00:00:20,500 --> 00:00:25,000", "For example, look at what the open source labs are doing."),
]
SAMPLE = "\n\n".join(f"{i}\n{time}\n{text}" for i, (time, text) in enumerate(LINES, 1)) + "\n"
SOURCE = "src_fixture_sample_01"
CANDIDATES = {
    "cand_fdcaa2e0": ("reframe", "high", 54, 134, 1, 2, "2 active reframe votes"),
    "cand_6f9a3ab9": ("advice", "medium", 135, 196, 2, 2, "1 active advice vote"),
    "cand_6f68bc50": ("caveat", "low", 197, 246, 2, 2, "shadow-only observational; excluded from routed caps + ablation"),
    "cand_a8e990e7": ("question", "medium", 247, 287, 2, 1, "1 active question vote"),
    "cand_06b4b35c": ("example", "low", 288, 345, 2, 0, "shadow-only observational; excluded from routed caps + ablation"),
}


@pytest.fixture(scope="module")
def run(spark):
    files = spark.createDataFrame([(SOURCE, SAMPLE)], "source_id string, text string")
    out = from_cues(parse_srt(files), "run_fixture")
    for name in ("units", "votes", "terms", "candidates", "transcripts", "locks"):
        setattr(out, name, getattr(out, name).cache())
    return out


def test_units(run):
    rows = run.units.orderBy("start").collect()
    assert [(r.start, r.end) for r in rows] == [(0, 53), (54, 134), (135, 196), (197, 246), (247, 287), (288, 345)]
    assert rows[1].unit_id == f"unit_{SOURCE}_000054"
    assert [(r.tc_start, r.tc_end, r.srt_index) for r in rows] == [(*t.split(" --> "), i) for i, (t, _) in enumerate(LINES, 1)]
    assert {r.segmentation_quality for r in rows} == {"punctuated_clean"}


def test_votes(run):
    got = {(r.start, r.rule_id, r.authority_mode, r.gate, r.trigger_text) for r in run.votes.collect()}
    assert got == {
        (54, "reframe_001", "active", None, "It's not a feature you bolt on at the end, it's"),
        (54, "reframe_v2a", "active", None, "It's not a feature you bolt on at the end, it's"),
        (135, "advice_001b", "active", None, "If you're building here, you need to f"),
        (197, "caveat_002", "shadow", None, "The risk is"),
        (197, "caveat_v2b", "shadow", None, "The risk is"),
        (247, "question_002", "shadow", "window_fallback", "But who actually owns the model weights?"),
        (247, "question_003", "active", None, "who actually owns"),
        (288, "example_001", "shadow", None, "For example"),
    }
    assert f"ann_{SOURCE}__54-134__reframe_001__s0_1" in {r.annotation_id for r in run.votes.collect()}


def test_terms(run):
    got = {(r.term_occurrence_id, r.category) for r in run.terms.collect()}
    assert got == {
        (f"term_{SOURCE}__0-53__foundation_model", "technology"),
        (f"term_{SOURCE}__135-196__unit_economics", "economics"),
        (f"term_{SOURCE}__197-246__inference_cost", "economics"),
        (f"term_{SOURCE}__288-345__open_source", "market-structure"),
    }


def test_candidates(run):
    rows = {r.candidate_id: r for r in run.candidates.collect()}
    assert {k: (r.family, r.bucket, r.start, r.end, r.sentences_before, r.sentences_after, r.reason) for k, r in rows.items()} == CANDIDATES
    assert all(r.kept and r.rank_in_family == 1 and r.blocked_reason is None for r in rows.values())
    assert rows["cand_a8e990e7"].vote_refs == [f"ann_{SOURCE}__247-287__question_002__s0_1", f"ann_{SOURCE}__247-287__question_003__s0_1"]


def test_records(run, spark, tmp_path):
    run.write(str(tmp_path / "dry"), "run_fixture", "C", execute=False)
    assert not (tmp_path / "dry").exists()
    run.write(str(tmp_path / "run"), "run_fixture", "C")
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "run/candidate_case_files/source_id=*")).collect()]
    assert len(rows) == 5 and all(r["evidence_ready"] is True and r["attribution"] == {"tier": "C", "speaker": ""} for r in rows)
    gates = [json.loads(r.value).get("gate") for r in spark.read.text(str(tmp_path / "run/annotations/source_id=*")).collect()]
    assert sorted(gates, key=str) == [None] * 7 + ["window_fallback"]
    feats = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "run/feature_records/source_id=*")).collect()]
    assert sum(f["method"]["name"] == "surface_complexity_profile" for f in feats) == 6


def test_features(run):
    rows = {(r.unit_ref[-6:], r.method.name): json.loads(str(r.payload)) for r in feature_records(run.units, "r").collect()}
    assert rows["000135", "discourse_marker_profile"]["categories_present"] == ["deontic"]
    assert [m["surface"] for m in rows["000247", "discourse_marker_profile"]["markers"]] == ["but"]
    surface = rows["000000", "surface_complexity_profile"]
    assert surface["length_tokens"] == 9 and surface["length_chars"] == 53 and surface["suppressed"] is False
    assert surface["lexical_density"] == 0.6667  # welcome our panel foundation model economy of nine words


def test_validators_green_and_tampered(run, spark):
    assert run.violations().count() == 0
    V.require_clean(run.violations())
    moved = run.units.withColumn("end", F.when(F.col("start") == 54, F.lit(130)).otherwise(F.col("end")))
    bad = V.anchor_violations(moved, run.transcripts).collect()
    assert [r.violation for r in bad] == ["text does not re-resolve at char_span"]
    far = run.units.withColumn("end", F.when(F.col("start") == 288, F.lit(999)).otherwise(F.col("end")))
    assert [r.violation for r in V.anchor_violations(far, run.transcripts).collect()] == ["char_span out of bounds"]
    assert V.vote_violations(run.votes, moved).count() == 2
    changed = run.transcripts.withColumn("text", F.concat("text", F.lit("!")))
    assert [r.violation for r in V.transcript_violations(changed, run.locks).collect()] == ["transcript hash mismatch"]
    stale = run.candidates.withColumn("blocked_reason", F.lit("blocked:context_missing"))
    assert V.candidate_violations(stale, run.votes, run.units).count() == 5
    fewer = run.units.where("start <> 288")
    assert {r.check for r in V.candidate_violations(run.candidates, run.votes, fewer).collect()} == {"candidate"}
    assert V.orphans(run.votes, "unit_ref", fewer, "unit_id").count() == 1
    renamed = run.candidates.withColumn("candidate_id", F.lit("cand_00000000"))
    found = {r.violation.split(",")[0] for r in V.candidate_violations(renamed, run.votes, run.units).collect()}
    assert any("does not re-derive" in x for x in found) and any("duplicate" in x for x in found)
    lost = run.votes.where("rule_id <> 'question_002'")
    assert any("vote_ref does not resolve" in r.violation for r in V.candidate_violations(run.candidates, lost, run.units).collect())
    with pytest.raises(ValueError, match="duplicate"):
        V.require_clean(V.duplicates(run.units.unionAll(run.units.limit(1)), "unit_id"))


def test_candidate_ids_are_unique_within_their_source(spark):
    from gleaner.operators.annotate import rule_votes
    from gleaner.plans.queries import RULES

    text, shared = "they came with these", "cand_58d3973b"  # the same eight digits for both sources
    rows = [(s, 0, 20, text, f"unit_{s}_000000", "00:00:00,000", 0, 0) for s in ("doc15733", "doc78380", "doc9")]
    units = spark.createDataFrame(rows, "source_id string, start int, end int, text string, unit_id string, tc_start string, sentences_before int, sentences_after int")
    votes = rule_votes(units, RULES)
    found = C.ready(C.assemble(votes)).cache()
    assert found.where(F.col("candidate_id") == shared).count() == 2
    said = lambda rows: sorted(r.violation.split(",")[0].split(":")[0] for r in V.candidate_violations(rows, votes, units).collect())
    assert said(found) == []
    assert said(found.unionAll(found.where("source_id = 'doc15733'"))) == ["duplicate candidate_id"]
    taken = found.withColumn("candidate_id", F.when(F.col("source_id") == "doc9", shared).otherwise(F.col("candidate_id")))
    assert said(taken) == ["does not re-derive"]
    moved = found.where("source_id = 'doc15733'").withColumn("source_id", F.lit("doc9"))
    assert said(found.unionAll(moved)) == ["vote_ref does not resolve"]


def test_lockfile_hash(run):
    import hashlib

    text = " ".join(t for _, t in LINES)
    row = run.locks.first()
    assert row.transcript_sha256 == "sha256:" + hashlib.sha256(text.encode()).hexdigest()
    meta = {
        "source_id": SOURCE, "srt_filename": SOURCE + ".srt", "normalization_profile": "norm_v0_1", "cue_count": 6, "char_count": len(text), "sentence_count": 6,
    }
    assert row.metadata_sha256 == "sha256:" + hashlib.sha256(json.dumps(meta, sort_keys=True).encode()).hexdigest()


def test_srt_forms(spark, tmp_path):
    text = (
        "﻿7\r\n00:00:01,000 --> 00:00:02,000\r\nfirst  line\r\nsecond\r\n\r\nno time here\r\n\r\n"
        "00:00:03,000 --> 00:00:04,000\r\n   \r\n\r\n00:00:05,000 --> 00:00:06,000\r\nwithout number\r\n\r\n\r\n9\r\n00:00:07,000 --> 00:00:08,000\r\nlast"
    )
    (tmp_path / "a talk.srt").write_bytes(text.encode())
    cues = parse_srt(read_srt(spark, str(tmp_path))).orderBy("cue_ord").collect()
    assert [(c.cue_ord, c.srt_index, c.tc_start, c.text) for c in cues] == [
        (0, 7, "00:00:01,000", "first line second"),
        (1, 2, "00:00:05,000", "without number"),
        (2, 9, "00:00:07,000", "last"),
    ]
    (tmp_path / "b.srt").write_bytes(b"\xff\xfe bad")
    with pytest.raises(Exception, match="not UTF-8"):
        read_srt(spark, str(tmp_path)).collect()
    files = spark.createDataFrame([("x", "nothing")], "source_id string, text string")
    with pytest.raises(Exception, match="no cues"):
        require_cues(files, parse_srt(files)).collect()


def test_sentence_spans(spark):
    import re

    texts = ["One. Two! Three?  tail", "3.5 e.g.x is fine... Next", "no end", "", "A?! B", "ends here.", "é. ß! 😀 x. y"]
    rows = spark.createDataFrame([(str(i), re.sub(r"\s+", " ", t).strip()) for i, t in enumerate(texts)], "source_id string, text string")
    got = {}
    for r in U.segment(rows).collect():
        got.setdefault(r.source_id, []).append((r.start, r.end, r.text))
    for i, t in rows.collect():
        want, at = [], 0
        for m in re.finditer(r"[.!?]+(?=\s|$)", t):
            s = at + len(t[at : m.end()]) - len(t[at : m.end()].lstrip())
            want.append((s, m.end(), t[s : m.end()]))
            at = m.end()
        rest = t[at:].strip()
        if rest:
            want.append((len(t) - len(rest), len(t), rest))
        assert sorted(got.get(i, [])) == want, t


def test_clusters_touch_and_overlap(spark):
    spans = [(0, 5), (5, 8), (9, 12), (10, 11), (12, 13), (20, 30), (22, 23), (31, 40)]
    df = spark.createDataFrame([("s", "f", a, b) for a, b in spans], "source_id string, family string, start int, end int")
    got = {}
    for r in C.clusters(df, ["source_id", "family"]).collect():
        got.setdefault(r.cluster, []).append((r.start, r.end))
    assert sorted(map(sorted, got.values())) == [[(0, 5), (5, 8)], [(9, 12), (10, 11), (12, 13)], [(20, 30), (22, 23)], [(31, 40)]]


def test_caps(spark):
    rows = [("s", "f", f"c{i:03d}", "rule_vote", "high" if i % 7 == 0 else "medium", i * 10, i * 10 + 5) for i in range(201)]
    rows += [("s", "f", f"x{i}", "shadow", "low", i * 10 + 6, i * 10 + 8) for i in range(3)]
    df = spark.createDataFrame(rows, "source_id string, family string, candidate_id string, authority_level string, bucket string, start int, end int")
    out = C.capped(df).collect()
    assert sum(r.kept for r in out if r.authority_level == "rule_vote") == 100
    assert all(r.kept for r in out if r.authority_level == "shadow")
    order = sorted((r for r in out if r.authority_level == "rule_vote"), key=lambda r: r.rank_in_family)
    assert [r.bucket for r in order[:29]] == ["high"] * 29 and order[29].bucket == "medium"
    log = C.cap_log(df).first()
    assert (log.total, log.routed, log.keep_k) == (204, 201, 100)
    assert all(r.kept for r in C.capped(df.where("candidate_id <> 'c000'")).collect())


@pytest.fixture(scope="module")
def on_disk(run, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored") / "run"
    run.write(str(root), "run_fixture", "C")
    return root


def test_a_stored_run_is_clean_and_stages_run_alone(spark, run, on_disk, tmp_path):
    import shutil

    from gleaner.plans import stored

    root = str(shutil.copytree(on_disk, tmp_path / "run"))
    assert stored.violations(spark, root).collect() == []
    names = ("annotations", "candidate_case_files", "feature_records")
    kept = {n: sorted(stored.lines(spark, root, n).select("value").collect()) for n in names}
    for n in (*names, "term_occurrences"):
        shutil.rmtree(f"{root}/{n}")
    stored.annotate_run(spark, root, "run_fixture", execute=False)
    assert stored.lines(spark, root, "annotations").count() == 0
    stored.annotate_run(spark, root, "run_fixture")
    stored.candidates_run(spark, root, "run_fixture", "C")
    stored.enrich_run(spark, root, "run_fixture")
    assert {n: sorted(stored.lines(spark, root, n).select("value").collect()) for n in names} == kept
    assert stored.violations(spark, root).collect() == []
    assert stored.counts(spark, root).first().asDict() == {"source_id": SOURCE, "units": 6, "annotations": 8, "term_occurrences": 4, "candidate_case_files": 5, "feature_records": len(kept["feature_records"])}
    with pytest.raises(FileNotFoundError):
        stored.annotate_run(spark, str(tmp_path / "none"), "r")


@pytest.mark.parametrize(
    "name, old, new, said",
    [
        ("units", "unit economics", "unit econ", "text does not re-resolve at char_span"),
        ("units", "00:00:09,500", "9.5", "does not parse"),
        ("annotations", "The risk is", "The gain is", "trigger_text is not in the unit"),
        ("annotations", '"rule_id":"advice_001b"', '"rule_id":"advice_999"', "does not re-derive"),
        ("candidate_case_files", '"evidence_ready":true', '"evidence_ready":"blocked:context_missing"', "evidence_ready does not re-derive"),
        ("candidate_case_files", '"vote_refs":[', '"vote_refs":["ann_0",', "vote_ref does not resolve"),
        ("feature_records", '"payload":{', '"payload":{"bucket":"high",', "gating field: bucket"),
        ("feature_records", f"unit_{SOURCE}_000054", "unit_x", "resolves to no unit_id"),
        ("transcripts", "Welcome", "Wellcome", "transcript hash mismatch"),
        ("term_occurrences", "}", "", "invalid JSON"),
    ],
)
def test_a_tampered_stored_run_is_seen(spark, on_disk, tmp_path, name, old, new, said):
    import shutil

    from gleaner.plans import stored

    root = shutil.copytree(on_disk, tmp_path / "run")
    hit = 0
    for file in (root / name).glob("*/*.json"):
        text = file.read_text()
        hit += old in text
        file.write_text(text.replace(old, new, 1))
    for crc in (root / name).glob("*/.*.crc"):
        crc.unlink()
    assert hit and any(said in r.violation for r in stored.violations(spark, str(root)).collect())


def test_feature_records_are_checked_before_they_are_written(spark, run, tmp_path):
    import dataclasses

    records = feature_records(run.units, "run_fixture")
    assert V.feature_violations(records).count() == 0
    bad = records.withColumn("role", F.lit("judge")).withColumn("payload", F.parse_json(F.lit('{"rank": 1}')))
    said = {r.violation for r in V.feature_violations(bad).collect()}
    assert "gating field: rank" in said and any("not in enums[feature_role]" in x for x in said)
    broken = dataclasses.replace(run, units=run.units.withColumn("unit_id", F.lit("u_1")))
    with pytest.raises(ValueError, match="does not match"):
        broken.write(str(tmp_path / "run"), "run_fixture")
    assert not (tmp_path / "run").exists()


def test_registries(spark, tmp_path):
    from gleaner.registries import MARKERS, RULES, lexicon_version
    from gleaner.sources.registry_files import read_markers, read_rules, read_terms

    with pytest.raises(ValueError, match="bad_rule"):
        checked((Rule("bad_rule", 1, "f", "regex", "(unclosed"),))
    merged = {t.term: t for t in merged_terms((Term("Moat", "m"), Term("evals", "x")), (Term("moat", "", "the moat"),))}
    assert merged["moat"] == Term("moat", "m", "the moat") and "Moat" not in merged and len(merged) == 2
    assert len(checked(RULES)) == 33 and lexicon_version(MARKERS) == "1.0.0"
    (tmp_path / "rules.csv").write_text('rule_id,version,cue_family,pattern_type,pattern,authority_mode,gate\nr1,2,fam,regex,"a,b",shadow,\n,1,fam,regex,x,,\nr2,,fam,phrase,take X now,,g\n')
    rules = read_rules(spark, str(tmp_path / "rules.csv"))
    assert rules == (Rule("r1", 2, "fam", "regex", "a,b", "shadow", ""), Rule("r2", 1, "fam", "phrase", "take X now", "active", "g"))
    (tmp_path / "terms.csv").write_text("term,category\n#note,x\nmoat,m\n")
    assert read_terms(spark, str(tmp_path / "terms.csv")) == (Term("moat", "m", ""),)
    (tmp_path / "bad.csv").write_text("surface,category\nbut,contrast\n")
    with pytest.raises(ValueError, match="fp_note"):
        read_markers(spark, str(tmp_path / "bad.csv"))


def test_ids(spark):
    from gleaner.functions import ids

    row = spark.range(1).select(
        ids.source_id(F.lit("AWS: Lux  Kickoff!"), F.lit(1)).alias("a"),
        ids.unit_id(F.lit("s"), F.lit(1234567)).alias("b"),
        ids.llm_vote_id(ids.run_short(F.lit("run_2026_a3f1")), F.lit("pack_07"), F.lit(1)).alias("c"),
        ids.evidence_id(F.lit("cand_1")).alias("d"),
    ).first()
    assert tuple(row) == ("src_aws_lux_kickoff_01", "unit_s_1234567", "llmv_run_a3f1_pack_07_001", "ev_cand_1")


def test_contexts_and_quality_of_any_units(spark, run):
    bare = run.units.drop("sentences_before", "sentences_after", "context_before", "context_after")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(C.contexts(bare)) == key(C.contexts(run.units))
    assert key(U.quality(bare).select("source_id", "sentence_count", "fragment_rate", "terminal_rate", "segmentation_quality")) == key(run.profiles)
    odd = spark.createDataFrame([("e", ""), ("x", "one two"), ("y", "A. B! cc dd ee ff?"), ("z", "no end here at all. Then")], "source_id string, text string")
    assert key(U.profiles(odd).where("sentence_count > 0")) == key(U.quality(U.segment(odd)).select(U.profiles(odd).columns))
    assert U.profiles(odd).where("source_id = 'e'").first().segmentation_quality == "unpunctuated"
