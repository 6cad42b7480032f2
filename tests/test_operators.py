"""Dictionary, packs, votes, responses, schema checks, sources and streaming against plain Python."""

import json
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleaner import registries as R
from gleaner.functions.responses import first_object, parse_response, parsed
from gleaner.functions.text import phrase_pattern, rounded
from gleaner.operators import annotate, dictionary, packs, units, validate, votes

TEXTS = {
    "a": ["The LLMs hallucinate when the context window is short.", "Our startups use AI's context window, and it is a moat.", "Speaker names and company names and company names."],
    "b": ["Context window limits are a moat.", "A startup's moat is distribution.", "Well-known Startups ship fast, I think."],
    "c": ["context window context window", "x y", ""],
}
STOP = set(R.DICTIONARY_STOPWORDS)


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(s, 100 * i, 100 * i + len(t), t) for s, ts in TEXTS.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "source_id string, start int, end int, text string").cache()


def plain_tokens(text):
    return [R.LEMMAS.get(t, t) for t in re.findall(r"[a-z][a-z'\-]*[a-z]|[a-z]", text.lower()) if len(t) > 1]


def plain_counts():
    uni, grams, df, cap, total, n = Counter(), {2: Counter(), 3: Counter()}, Counter(), Counter(), 0, 0
    for ts in TEXTS.values():
        seen = set()
        for t in ts:
            if t.strip().lower().startswith(R.BOILERPLATE):
                continue
            toks = plain_tokens(t)
            total, n = total + len(toks), n + 1
            own = [x for x in toks if x not in STOP]
            uni.update(own)
            seen.update(own)
            for k in grams:
                grams[k].update(" ".join(g) for i in range(len(toks) - k + 1) if (g := toks[i : i + k])[0] not in STOP and g[-1] not in STOP)
            for w in re.findall(r"\b[A-Z][A-Za-z'\-]*\b", t):
                if w.lower() not in STOP:
                    cap[R.LEMMAS.get(w.lower(), w.lower())] += 1
        df.update(seen)
    return uni, grams, df, cap, total, n


def test_dictionary_counts(spoken):
    uni, grams, df, cap, total, n = plain_counts()
    toks = dictionary.tokenized(spoken)
    assert {r.term: (r["count"], r.doc_freq) for r in dictionary.unigrams(toks).collect()} == {t: (c, df[t]) for t, c in uni.items()}
    for k in (2, 3):
        assert {r.phrase: r["count"] for r in dictionary.phrase_counts(toks, k).collect()} == dict(grams[k])
    assert {r.term: r.cap for r in dictionary.capitalized(toks).collect()} == dict(cap)
    assert tuple(dictionary.totals(toks).first()) == (total, n)


def test_keyness_and_cards(spark, spoken):
    uni, grams, df, cap, total, _ = plain_counts()
    base = spark.createDataFrame([("context", 0.001), ("window", 0.5), ("moat", 0.0)], "term string, p double")
    toks = dictionary.tokenized(spoken)
    keyed = dictionary.keyness(dictionary.unigrams(toks), base, dictionary.totals(toks))
    got = {r.term: (r.keyness, r.oov) for r in keyed.collect()}
    known = {"context": 0.001, "window": 0.5}
    for t, c in uni.items():
        want = math.log10(c / total / known.get(t, 1e-8))
        assert got[t][0] == pytest.approx(want, abs=0.00051) and got[t][1] == (t not in known)
    terms = dictionary.top_terms(keyed, dictionary.capitalized(toks), 2, 2, 10)
    rows = terms.collect()
    assert [r.term for r in rows] == sorted((t for t, c in uni.items() if c >= 2 and df[t] >= 2), key=lambda t: (-got[t][0], -uni[t], t))
    assert {r.term: r.category for r in rows}["startup"] == ("entity" if cap["startup"] / uni["startup"] >= 0.6 else "concept")
    bi = dictionary.phrase_counts(toks, 2)
    first = {r.term: r.phrase for r in dictionary.collocates(terms, bi).where("rank = 1").collect()}
    assert first["context"] == "context window"
    ph = dictionary.phrases(bi, keyed, least=2)
    assert {r.phrase for r in ph.collect()} >= {"context window"}
    kwic = dictionary.examples(spoken, terms, ph)
    best = {(r.term, r["rank"]): r for r in kwic.collect()}
    assert best["moat", 1].text == "Our startups use AI's context window, and it is a moat."
    assert max(k[1] for k in best) <= 4 and ("context window", 1) in best
    cards = dictionary.cards(terms, dictionary.collocates(terms, bi), kwic)
    text = dictionary.markdown([r.asDict(True) for r in cards.collect()], [r.asDict() for r in ph.collect()], {"n_sources": 3})
    assert "| moat |" in text and "| context window |" in text
    spots = dictionary.blind_spots(dictionary.unigrams(toks), bi, terms, (("cw", ("context window", "moat"), "x"), ("none", ("zzz",), "y")))
    assert {(r.form, r.in_dictionary) for r in spots.collect()} == {("context window", False), ("moat", True)}


def plain_score(text, term):
    text = text.strip()
    low, n, s = text.lower(), len(text), 0.0
    s += 3.0 if 45 <= n <= 165 else -2.5 - (45 - n) / 28 if n < 45 else -1.0 - (n - 165) / 90
    s += 0.8 * text[:1].isupper()
    s += 1.4 if text[-1:] in (".", "!") else 0.2 if text[-1:] == "?" else -2.2 if text[-1:] == "…" else -1.2
    s -= 1.8 if low.startswith(R.FILLER_OPEN_STRONG) else 0.8 if low.startswith(R.FILLER_OPEN_MILD) else 0
    s -= 0.7 * sum(low.count(f) for f in R.FILLER_INLINE)
    s -= 1.5 * (sum(map(low.count, ".!?")) >= 3) + 0.9 * (low.count(",") >= 4)
    s -= 1.5 * sum(c in low for c in R.ANNOUNCE_CUES) + 2.0 * sum(c in low for c in R.SELFID_CUES)
    s -= 1.5 * bool(re.search(R.DATE_PATTERN, low))
    words = re.findall(r"[a-z][a-z'\-]*", low)
    s -= 1.2 * bool(words and words[0] == term.split()[0])
    at = low.find(term.lower())
    if at >= 0:
        s += 0.6 * (at >= 12 and n - at - len(term) >= 12)
        s += 1.2 * any(c in low[max(0, at - 60) : at + len(term) + 60] for c in R.EXPLAIN_CUES)
    return s


def test_example_score(spark):
    texts = [
        "I think the moat is, like, distribution, right?", "So the moat is deep…", "moat moat", "Hosting a panel on moat at 10:30, Tuesday the 5th, rsvp, a, b, c!", "My name is X. I am founder of Y. Moat! Moat? Moat.",
        "A moat " + "is very " * 30 + "wide", "É moat lets you win because it compounds over a long time, you know.", "", "no term here at all but it is a long enough sentence to fit the band.",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("term", F.lit("moat"))
    got = {r.text: r.s for r in df.withColumn("s", dictionary.example_score(F.col("text"), F.col("term"))).collect()}
    for t in texts:
        assert got[t] == pytest.approx(plain_score(t, "moat")), t


def test_phrase_patterns():
    assert re.search(phrase_pattern("take X -- they"), "Take  them -- they go") and not re.search(phrase_pattern("who owns"), "whoowns")
    assert R.MARKERS[2].regex.startswith("(?i)\\bnot") and re.search(R.Term("product-market fit").regex, "a Product-Market fit.")


@pytest.mark.parametrize(
    "raw, verdict, reason",
    [
        ('{"verdict": "confirm"}', "confirm", None), ('Sure! {"verdict": "reject"} Thanks', "reject", None), ('```json\n{"verdict": "confirm"}\n```', "confirm", None),
        ('```\n{"verdict": "confirm"}```', "confirm", None), ('{"rationale": "use } and { \\" }", "verdict": "reject"} {"verdict": "x"}', "reject", None),
        ('{"verdict": "confirm",}', None, "json_parse_error"), ("", None, "no_json_object_found"), ("no braces", None, "no_json_object_found"), ('{"verdict": "open', None, "no_json_object_found"),
        ('\\{"verdict": "confirm"}', "confirm", None), ('say \\" {"verdict": {"a": "}"}}', None, None),
    ],
)
def test_parse_response(raw, verdict, reason):
    found, why = parsed(raw)
    assert (why or "").startswith(reason or "") and bool(found) == (why is None)
    if verdict:
        assert json.loads(found)["verdict"] == verdict


def test_first_object_like_a_state_machine():
    import random

    def plain(text):
        begin, depth, inside, escaped = text.find("{"), 0, False, False
        if begin < 0:
            return None
        for i in range(begin, len(text)):
            c = text[i]
            if inside:
                escaped, inside = (c == "\\" and not escaped), not (c == '"' and not escaped)
            elif c == '"':
                inside = True
            else:
                depth += (c == "{") - (c == "}")
                if c == "}" and not depth:
                    return text[begin : i + 1]
        return None

    r = random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice('{}"\\ax') for _ in range(r.randrange(14)))
        assert first_object(text) == plain(text), text


@pytest.fixture(scope="module")
def packed(spark):
    docs = spark.createDataFrame([("s1", "You should test this. Then rest. You should not. Why? You need to go."), ("s2", "Nothing here.")], "source_id string, text string")
    held = units.with_ids(units.segment(docs)).withColumn("tc_start", F.lit("00:00:00,000"))
    found = annotate.rule_votes(held)
    from gleaner.operators import candidates

    rows = packs.candidate_packs(candidates.assemble(found), held, found)
    full = units.with_ids(units.segment(docs, 2, profiled=True)).withColumn("tc_start", F.lit("00:00:00,000"))
    carried = packs.carried_packs(candidates.assemble(annotate.rule_votes(full, with_text=True)))
    assert sorted(map(tuple, carried.collect())) == sorted(map(tuple, rows.select(carried.columns).collect()))
    controls = spark.createDataFrame([("c1", "advice", "Garbled text", None, None), ("c2", "caveat", "Off family", "cand_12345678", "s9")], "control_id string, mimicked_family string, text string, ref_candidate_id string, ref_source_id string")
    return rows.unionByName(packs.control_packs(controls)).cache()


def test_packs(packed, spark):
    rows = packed.collect()
    by = {r.candidate_text: r for r in rows}
    first = by["You should test this."]
    assert first.context_before == "" and first.context_after == "Then rest. You should not." and "<candidate>You should test this.</candidate>" in first.prompt
    assert by["Garbled text"].source_id == "ctl_synthetic_c1" and by["Off family"].candidate_ref == "cand_12345678"
    bad = packs.packed(spark.createDataFrame([("c", "f", " ", "", "")], "candidate_ref string, family string, candidate_text string, context_before string, context_after string"))
    with pytest.raises(Exception, match="empty candidate text"):
        bad.collect()
    with pytest.raises(Exception, match="without its candidate"):
        packs.packed(packed.drop("prompt", "pack_id"), "just a title").collect()
    assert packs.parse_buckets("all") == ("high", "medium", "low") and packs.parse_buckets(" High, low,") == ("high", "low")


def test_judged_votes(packed, spark, tmp_path):
    def judge(prompt):
        if "Then rest. You" in prompt and "test this.</candidate>" in prompt:
            raise TimeoutError("slow")
        if "Garbled" in prompt:
            return "no json", {}, "m-20250101", 0
        if "Off family" in prompt:
            return '{"verdict": "reject", "inference_type": "stated", "confidence": "low", "rationale": "x", "more": 1}', {}, "m", 0
        return votes.fake_judge(prompt)

    votes.called(packed, judge, "lane").write.parquet(str(tmp_path / "calls"))
    results = votes.judged(spark.read.parquet(str(tmp_path / "calls"))).cache()
    kinds = Counter(r.failure_type for r in results.collect())
    assert kinds["lane_failure"] == 1 and kinds["model_malformed"] == 2 and kinds[None] == packed.count() - 3
    reasons = " ".join(r.reason for r in votes.malformed_records(results).collect())
    assert "lane_exception: slow" in reasons and "no_json_object_found" in reasons and "unexpected field more" in reasons
    records = votes.vote_records(results, "run_x_a3f1", recorded=5)
    rows = records.collect()
    assert len({r.llm_vote_id for r in rows}) == len(rows) == kinds[None] and all(r.llm_vote_id.startswith("llmv_run_a3f1_pack_") for r in rows)
    assert all(int(r.llm_vote_id.rsplit("_", 1)[1]) >= 5 for r in rows) and rows[0].token_counts.completion == 20
    left = packs.pending(packed, "lane", records, votes.malformed_records(results))
    assert left.count() == 1  # the lane failure alone is tried again
    lines = records.select(F.to_json(F.struct("*")).alias("value"))
    schema = {
        "type": "object", "required": ["llm_vote_id", "vote"], "properties": {"llm_vote_id": {"type": "string", "pattern": "^llmv_"}, "attempt": {"type": "integer", "minimum": 1}, "tier": {"type": "string", "enumRef": "vote_tier"},
        "vote": {"type": "object", "required": ["verdict"], "properties": {"verdict": {"enumRef": "verdict"}}}},
    }
    assert validate.schema_violations(lines, schema, "votes").count() == 0


def test_summaries(spark):
    rows = [("x", f"c{i}", i < 10, "reject" if i else "confirm", i, 1, 2) for i in range(10)] + [("x", "d1", False, "confirm", 11, 1, 1), ("y", "d1", False, "reject", 1, 1, 1), ("y", "d1", False, "confirm", 2, 1, 1)]
    df = spark.createDataFrame(rows, "lane string, candidate_ref string, is_control boolean, verdict string, seq int, prompt_tokens int, completion_tokens int")
    bad = spark.createDataFrame([("x", "model_malformed"), ("z", "lane_failure")], "lane string, failure_type string")
    got = {r.lane: r for r in votes.summary(df, bad).collect()}
    assert got["x"].control_rejection_rate == 0.9 and got["x"].control_bar_passed and got["x"].malformed_rate == rounded_plain(1 / 12)
    assert got["y"].control_rejection_rate is None and not got["y"].control_bar_passed
    assert got["z"].votes == 0 and got["z"].malformed_rate is None and got["z"].lane_failures == 1
    agreed = votes.lane_agreement(df, ["x", "y"]).first()
    assert (agreed.shared_candidates, agreed.fully_agreed, agreed.agreement_rate) == (1, 1, 1.0)  # the last vote counts
    none = votes.adjudication(votes.compared(df.limit(0), df)).first()
    assert none.n_compared == 0 and none.agreement_rate is None
    pairs = votes.compared(df.where("lane = 'x'"), df.where("lane = 'y'"))
    assert votes.confusion(pairs).first().label == "base_confirm__strong_confirm" and votes.flips(pairs).count() == 0
    lanes = votes.lane_of(F.col("m"), {"one": "small-model", "two": "small-model"}, {"large": "two"})
    models = spark.createDataFrame([("small-model",), ("small-model-20250101",), ("Large-9",), ("other",)], "m string")
    assert [r[0] for r in models.select(lanes).collect()] == ["one", "one", "two", "other"]
    assert models.select(votes.undated(F.col("m"))).collect()[1][0] == "small-model"


def test_a_vote_counts_once_in_its_own_candidates_bucket(spark):
    held = spark.createDataFrame(
        [("a", "cand_1", 0, "high"), ("b", "cand_1", 0, "low"), ("c", "cand_2", 0, "low"), ("c", "cand_2", 9, "medium")],
        "source_id string, candidate_id string, start int, bucket string",
    )
    rows = [("a", "cand_1", 0, "confirm", False), ("a", "cand_1", 0, "reject", False), ("b", "cand_1", 0, "reject", False), ("b", "cand_1", 0, "confirm", True)]
    schema = "source_id string, candidate_ref string, start int, verdict string, is_control boolean"
    given = spark.createDataFrame([*rows, ("c", "cand_2", 9, "confirm", False)], schema)
    # as vote records have it: source and reference
    counted = lambda df: {r.bucket: (r.votes, r.confirmed, r.confirm_rate) for r in votes.by_bucket(df, held).collect()}
    assert counted(given.where("source_id <> 'c'").drop("start")) == {"high": (2, 1, 0.5), "low": (1, 0, 0.0)}
    assert counted(given) == {"high": (2, 1, 0.5), "low": (1, 0, 0.0), "medium": (1, 1, 1.0)}


def rounded_plain(x):
    return math.floor(x * 1e6 + 0.5) / 1e6


def test_schema_keywords(spark):
    schema = {
        "type": "object", "additionalProperties": False, "required": ["id", "span"],
        "properties": {"id": {"type": "string", "pattern": "^x", "minLength": 2}, "span": {"type": "array", "items": {"type": "integer", "minimum": 0}, "minItems": 2, "maxItems": 2}, "kind": {"enum": ["a", "b"]}, "flag": {"type": ["boolean", "string"]}, "one": {"const": True}},
    }
    rows = {
        '{"id": "xy", "span": [0, 1], "kind": "a", "flag": true, "one": true}': set(),
        '{"id": "x", "span": [0], "kind": "c", "flag": 3}': {"r.id: shorter than minLength 2", "r.span: fewer than minItems 2", "r.kind: not in enum", "r.flag: expected type ['boolean', 'string'], got bigint"},
        '{"span": [0, -1, "z"], "more": 1, "one": false}': {"r: missing required field 'id'", "r.span: more than maxItems 2", "r.span[1]: less than minimum 0", "r.span[2]: expected type integer, got string", "r: unexpected field 'more'", "r.one: expected const True"},
        '[1]': {"r: expected type object, got array<bigint>"},
        'not json': {"r: invalid JSON"},
    }
    df = spark.createDataFrame([(k,) for k in rows], "value string")
    got = {k: set() for k in rows}
    for r in validate.schema_violations(df, schema, "r").collect():
        got[r.key].add(r.violation)
    assert got == rows
    odd = validate.schema_violations(df.limit(1), {"type": "object", "maximum": 3, "if": {}}, "r").collect()
    assert [r.violation for r in odd] == ["r: unsupported schema keyword 'maximum'"]


def test_rounding_and_gazetteer(spark):
    rows = spark.createDataFrame([(2.675,), (0.12345,), (-1.5,)], "x double").select(rounded(F.col("x"), 2).alias("r")).collect()
    assert [r.r for r in rows] == [math.floor(x * 100 + 0.5) / 100 for x in (2.675, 0.12345, -1.5)]
    seeds = spark.createDataFrame([("Moat", "m"), ("evals", "e")], "term string, category string")
    more = spark.createDataFrame([("moat", " ", "the moat"), ("RAG", "t", "")], "term string, category string, canonical_form string")
    assert {tuple(r) for r in annotate.merge_gazetteer(seeds, more).collect()} == {("moat", "the moat", "m"), ("RAG", "RAG", "t"), ("evals", "evals", "e")}


def test_records(spark, tmp_path):
    from gleaner.sources.records import append_records, bad_lines, discovered, document, read_jsonl, read_lines

    for name in ("b", "a"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "units.jsonl").write_text('{"x": 1}\n\n{"x": 2}\n' if name == "a" else '{"x": oops}\n')
    assert [r.source_id for r in discovered(spark, str(tmp_path)).collect()] == ["a", "b"]
    assert read_jsonl(spark, str(tmp_path / "a"), "x int").count() == 2
    with pytest.raises(Exception):
        read_jsonl(spark, str(tmp_path / "b"), "x int").collect()
    lines = read_lines(spark, str(tmp_path / "*" / "units.jsonl"))
    assert lines.count() == 3 and [(r.file, r.line) for r in bad_lines(lines).collect()] == [("units.jsonl", 0)]
    append_records(spark.range(2), str(tmp_path / "votes"))
    append_records(spark.range(3), str(tmp_path / "votes"))
    assert spark.read.parquet(str(tmp_path / "votes")).count() == 5
    assert json.loads(document(spark.range(1))) == {"id": 0}
    with pytest.raises(Exception, match="none.jsonl"):
        discovered(spark, str(tmp_path), "none.jsonl")


def test_streaming(spark, tmp_path):
    from gleaner.streaming.match import judge_stream, store, stream_texts, stream_votes

    src = str(tmp_path / "in")
    batch = lambda k: spark.createDataFrame([(f"s{k}", "You should  go. The risk is real.")], "source_id string, text string").write.mode("append").parquet(src)
    out, at = str(tmp_path / "out"), str(tmp_path / "cp")
    for k in (1, 2):
        batch(k)
        store(stream_votes(stream_texts(spark, src)), out, at).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 6 and rows.select("source_id").distinct().count() == 2  # each file once
    packs_dir = str(tmp_path / "packs")
    spark.createDataFrame([("c1", False, "pack_1", "prompt one"), ("c2", False, "pack_2", "prompt two!")], "candidate_ref string, is_control boolean, pack_id string, prompt string").write.parquet(packs_dir)
    stream = spark.readStream.schema("candidate_ref string, is_control boolean, pack_id string, prompt string").parquet(packs_dir)
    judge_stream(stream, votes.fake_judge, "l", str(tmp_path / "judged"), str(tmp_path / "cp2")).awaitTermination()
    judged = votes.judged(spark.read.parquet(str(tmp_path / "judged")))
    assert judged.count() == 2 and judged.where("failure_type IS NULL").count() == 2


def test_cli(spark, tmp_path, capsys):
    from gleaner.cli import main
    from test_evidence import SAMPLE

    (tmp_path / "talk.srt").write_text(SAMPLE)
    srt = str(tmp_path / "talk.srt")
    main(["validate", "--srt", srt])
    main(["run", "--srt", srt, "--out", str(tmp_path / "o")])
    main(["packs", "--srt", srt, "--buckets", "all"])
    main(["dictionary", "--srt", srt, "--min-count", "1", "--out", str(tmp_path / "d"), "--execute"])
    (tmp_path / "controls.jsonl").write_text('{"control_id": "c1", "mimicked_family": "advice", "text": "Garbled.", "expected_verdict": "reject", "rationale": "x"}\n')
    more = ["--srt", srt, "--out", str(tmp_path / "store"), "--controls", str(tmp_path / "controls.jsonl")]
    main(["judge", *more])
    main(["judge", *more, "--execute"])
    main(["adjudicate", *more, "--execute"])
    said = capsys.readouterr().out
    assert "4 packs to judge" in said and '"control_votes": 1' in said and '"n_compared": 3' in said
    assert "no violations" in said and '"candidates": 5' in said and "advice: 1" in said and "# Dictionary" in said
    assert not (tmp_path / "o").exists() and (tmp_path / "d" / "dictionary.md").exists()


def test_parse_response_column(spark):
    rows = spark.createDataFrame([('{"a": 1}',), ("x",), (None,)], "r string").select(parse_response(F.coalesce("r", F.lit(""))).alias("p")).collect()
    assert [r.p.object for r in rows] == ['{"a": 1}', None, None]


def test_judging_run_resumes(packed, spark, tmp_path):
    from gleaner.plans import judging as J

    root, calls = str(tmp_path / "store"), []
    flaky = lambda prompt: ("", {}, "m", 124) if "test this.</candidate>" in prompt else votes.fake_judge(prompt)
    assert J.run_lane(packed, flaky, "one", root, "run_a1b2").count() == packed.count()  # a dry run
    assert J.recorded(spark, root + "/votes", J.VOTES).count() == 0
    J.run_lane(packed, flaky, "one", root, "run_a1b2", execute=True)
    first = J.recorded(spark, root + "/votes", J.VOTES)
    assert first.count() == packed.count() - 1 and J.run_lane(packed, flaky, "one", root, "run_a1b2").count() == 1
    J.run_lane(packed, votes.fake_judge, "one", root, "run_a1b2", execute=True)
    rows = J.recorded(spark, root + "/votes", J.VOTES).collect()
    assert len(rows) == packed.count() == len({r.llm_vote_id for r in rows})
    one = J.run_summary(spark, root).first()
    assert one.votes == packed.count() and one.lane_failures == 1 and one.control_votes == 2 and one.malformed_rate == 0.0
    assert J.ledger(J.recorded(spark, root + "/votes", J.VOTES)).agg(F.sum("completion")).first()[0] == 20 * packed.count()
    strong = lambda p: (votes.fake_judge(p)[0].replace("uncertain", "confirm"), {}, "big-20250101", 0)
    pairs = J.adjudicate(packed, strong, "big", "two", root, "run_a1b2", execute=True)
    assert pairs.count() == packed.where("NOT is_control").count()
    again = J.adjudicate(packed, strong, "big-20260101", "two", root, "run_a1b2", execute=True)
    assert again.count() == pairs.count() and J.recorded(spark, root + "/adjudication", J.VOTES).count() == pairs.count()
    text = json.loads(J.report(pairs, "big"))
    assert text["n_compared"] == pairs.count() and sum(text["confusion"].values()) == pairs.count()
    J.run_lane(packed, votes.fake_judge, "one", root, "run_a1b2", execute=True, fresh=True)
    assert J.recorded(spark, root + "/votes", J.VOTES).count() == packed.count()
    with pytest.raises(ValueError, match="no base votes"):
        J.adjudicate(packed, strong, "big", "two", str(tmp_path / "none"), "r")


def test_structural(spark):
    unit = {"type": "object", "required": ["unit_id"], "properties": {"unit_id": {"type": "string", "pattern": "^unit_"}}}
    vote = {"type": "object", "properties": {"annotation_id": {"type": "string"}, "unit_ref": {"type": "string"}}}
    rows = [
        ("units.jsonl", '{"unit_id": "unit_1"}'), ("units.jsonl", '{"unit_id": "unit_1"}'), ("units.jsonl", '{"unit_id": "x"}'), ("annotations.jsonl", '{"annotation_id": "a", "unit_ref": "unit_1"}'),
        ("annotations.jsonl", '{"annotation_id": "b", "unit_ref": "unit_9"}'), ("other.txt", "zzz"),
    ]
    df = spark.createDataFrame([(f, i, v) for i, (f, v) in enumerate(rows)], "file string, line int, value string")
    found = validate.structural(df, {"units.jsonl": (unit, "unit_id"), "annotations.jsonl": (vote, "annotation_id")}).collect()
    assert {(r.check, r.violation) for r in found} == {
        ("units.jsonl", "units.jsonl.unit_id: does not match /^unit_/"), ("duplicate", "duplicate unit_id, rows: 2"), ("orphan", "unit_9 resolves to no unit_id"),
    }


def test_output_order(spark):
    from gleaner.operators import candidates as C

    rows = [("s", "b", "shadow", 1), ("s", "b", "rule_vote", 2), ("s", "b", "rule_vote", 1), ("s", "a", "shadow", 1)]
    df = spark.createDataFrame(rows, "source_id string, family string, authority_level string, rank_in_family int")
    assert [tuple(r) for r in C.in_order(df).collect()] == [rows[3], rows[2], rows[1], rows[0]]
