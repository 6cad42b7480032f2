"""DuckDB SQL for the registered queries, on the same tables.

Word boundaries are written out, because the oracle's own are ASCII only; rounding is a floor of doubles on both
sides.
"""

from __future__ import annotations

from gleaner.operators.candidates import CONTEXT
from gleaner.plans import queries as Q
from gleaner.registries import (
    ANNOUNCE_CUES,
    DATE_PATTERN,
    DICTIONARY_STOPWORDS,
    EXPLAIN_CUES,
    FEATURE_STOPWORDS,
    FILLER_INLINE,
    FILLER_OPEN_MILD,
    FILLER_OPEN_STRONG,
    GENERIC_PHRASES,
    LEMMAS,
    SELFID_CUES,
    TERM_STOP,
)

EDGE_LEFT, EDGE_RIGHT = r"(^|[^\p{L}\p{N}\p{M}_])", r"($|[^\p{L}\p{N}\p{M}_])"
SPACE = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def word(words: str) -> str:
    """A condition on text: these words stand there, white space between them."""
    return f"regexp_matches(text, '(?i){EDGE_LEFT}{words.replace(' ', r'\s+')}{EDGE_RIGHT}')"


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def split(source: str) -> str:
    """Sentences of the rows (source_id, panel, text) of a relation."""
    return f"""
  SELECT source_id, panel, CAST(start_ AS INTEGER) AS start, CAST(start_ + length(piece) AS INTEGER) AS "end", piece AS text,
         printf('unit_%s_%06d', source_id, CAST(start_ AS BIGINT)) AS unit_id
  FROM (
    SELECT source_id, panel, n, piece,
           coalesce(sum(length(piece) + 1) OVER (PARTITION BY source_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_
    FROM (SELECT source_id, panel, unnest(pieces) AS piece, unnest(range(len(pieces))) AS n
          FROM (SELECT source_id, panel, string_split(regexp_replace(text, '([.!?]) ', '\\1' || chr(31), 'g'), chr(31)) AS pieces FROM {source}))
  ) WHERE piece <> ''"""


DOCS = f"docs AS (SELECT printf('doc%d', doc_id) AS source_id, source AS panel, {norm('text')} AS text FROM documents WHERE text IS NOT NULL)"
UNITS = f"{DOCS}, units AS ({split('docs')})"

_CONDITION = {
    "contrast_001": "that", "contrast_002": "this", "deontic_001": "with", "deontic_002": "from", "license_001": "licensed under",
    "license_002": "released under", "lang_fr_001": "que",
}
VOTES = (
    UNITS
    + ", votes AS ("
    + " UNION ALL ".join(
        f"SELECT source_id, start, \"end\", text, unit_id AS unit_ref, {lit(r.rule_id)} AS rule_id, {lit(r.family)} AS label_vote, {lit(r.mode)} AS authority_mode, "
        f"{lit('shadow' if r.mode == 'shadow' else 'rule_vote')} AS authority_level, {lit(r.gate)} AS gate, {lit(_CONDITION[r.rule_id])} AS trigger_text, "
        f"'ann_' || source_id || '__' || start || '-' || \"end\" || '__' || {lit(r.rule_id)} || '__s0_1' AS annotation_id "
        f"FROM units WHERE {word(_CONDITION[r.rule_id])}"
        for r in Q.RULES
    )
    + ")"
)
# all votes of a cluster share one span, because units never touch
CANDIDATES = (
    VOTES
    + """, cand AS (
  SELECT source_id, label_vote AS family, start, "end", unit_ref, count(*) FILTER (authority_mode = 'active') AS n_active,
         (min(CASE WHEN authority_mode = 'active' THEN '0' ELSE '1' END || rule_id))[2:] AS rule_id, string_agg(annotation_id, ',' ORDER BY annotation_id) AS vote_refs
  FROM votes GROUP BY ALL),
candidates AS (
  SELECT *, 'cand_' || sha256(source_id || '|' || start || '-' || "end" || '|' || rule_id || '|0.1')[:8] AS candidate_id,
         CASE WHEN n_active >= 2 THEN 'high' WHEN n_active = 1 THEN 'medium' ELSE 'low' END AS bucket,
         CASE WHEN n_active > 0 THEN n_active || ' active ' || family || ' vote' || CASE WHEN n_active = 1 THEN '' ELSE 's' END
              ELSE 'shadow-only observational; excluded from routed caps + ablation' END AS reason,
         CASE WHEN n_active > 0 THEN 'rule_vote' ELSE 'shadow' END AS authority_level
  FROM cand)"""
)
CONTEXTS = f""", contexts AS (
  SELECT unit_id, CAST(least({CONTEXT}, row_number() OVER w - 1) AS INTEGER) AS sentences_before,
         CAST(least({CONTEXT}, count(*) OVER (PARTITION BY source_id) - row_number() OVER w) AS INTEGER) AS sentences_after,
         concat_ws(' ', lag(text, 2) OVER w, lag(text, 1) OVER w) AS context_before,
         concat_ws(' ', lead(text, 1) OVER w, lead(text, 2) OVER w) AS context_after
  FROM units WINDOW w AS (PARTITION BY source_id ORDER BY start))"""
QUALITY = """, profile AS (
  SELECT source_id, count(*) AS sentence_count,
         floor(CAST(count(*) FILTER (len(list_filter(string_split(text, ' '), lambda x: x <> '')) < 4) AS DOUBLE) / count(*) * 10000.0 + 0.5) / 10000.0 AS fragment_rate,
         floor(CAST(count(*) FILTER (regexp_matches(text, '[.!?]$')) AS DOUBLE) / count(*) * 10000.0 + 0.5) / 10000.0 AS terminal_rate
  FROM units GROUP BY source_id),
quality AS (SELECT *, CASE WHEN terminal_rate >= 0.6 AND fragment_rate <= 0.25 THEN 'punctuated_clean' WHEN terminal_rate >= 0.3 THEN 'punctuated_noisy'
                      ELSE 'unpunctuated' END AS segmentation_quality FROM profile)"""
TURNS = f"""cues AS (
  SELECT printf('conv%d', conv_id) AS source_id, '' AS panel, CAST(turn AS INTEGER) AS cue_ord, CAST(turn + 1 AS INTEGER) AS srt_index, {norm('text')} AS text
  FROM conversations WHERE {norm('text')} <> ''),
ranges AS (
  SELECT *, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY source_id ORDER BY cue_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS c_start FROM cues),
scripts AS (SELECT source_id, '' AS panel, string_agg(text, ' ' ORDER BY cue_ord) AS text, count(*) AS cue_count FROM cues GROUP BY source_id)"""

_STOP = ", ".join(map(lit, DICTIONARY_STOPWORDS))
_LEMMA = "CASE x " + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in LEMMAS.items()) + " ELSE x END"


def tokens(relation: str, panel: str = "panel") -> str:
    return f"""
  SELECT {panel} AS panel, source_id, start, "end", text,
         list_transform(list_filter(regexp_extract_all(lower(text), '([a-z][a-z''\\-]*[a-z]|[a-z])'), lambda x: length(x) > 1), lambda x: {_LEMMA}) AS tokens
  FROM {relation} WHERE NOT starts_with(lower(trim(text)), 'speaker names and company names')"""


def grams(n: int) -> str:
    joined = " || ' ' || ".join(f"tokens[i + {k}]" for k in range(n))
    return f"""(SELECT {joined} AS phrase, count(*) AS count FROM (SELECT tokens, unnest(range(1, len(tokens) - {n - 2})) AS i FROM toks)
  WHERE tokens[i] NOT IN ({_STOP}) AND tokens[i + {n - 1}] NOT IN ({_STOP}) GROUP BY phrase)"""


TOKENS = f"{UNITS}, toks AS ({tokens('units')})"
UNI = f""", uni AS (SELECT term, count(*) AS count, count(DISTINCT panel) AS doc_freq FROM (SELECT panel, unnest(tokens) AS term FROM toks)
  WHERE term NOT IN ({_STOP}) GROUP BY term)"""
# runs of word characters, apostrophes and hyphens; those that are capitalized ASCII words, without apostrophes and hyphens at their ends
CAPS = f""", caps AS (SELECT {_LEMMA} AS term, count(*) AS cap FROM (
    SELECT lower(w) AS x FROM (
      SELECT unnest(list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}\\p{{M}}_''\\-]+'), lambda r: regexp_replace(r, '^[''\\-]+|[''\\-]+$', '', 'g'))) AS w FROM toks)
    WHERE regexp_matches(w, '^[A-Z][A-Za-z''\\-]*$'))
  WHERE x NOT IN ({_STOP}) GROUP BY term)"""
GRAMS = f", bi AS {grams(2)}, tri AS {grams(3)}"
KEYED = f""", items AS (SELECT 'b' AS source_id, 'b' AS panel, {norm('text')} AS text FROM benchmark WHERE text IS NOT NULL), bunits AS ({split('items')}),
btoks AS ({tokens('bunits')}),
base AS (SELECT term, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM (SELECT unnest(tokens) AS term FROM btoks) GROUP BY term),
total AS (SELECT CAST(sum(len(tokens)) AS DOUBLE) AS n FROM toks),
keyed AS (SELECT u.*, floor(log10((u.count / total.n) / coalesce(b.p, 1e-8)) * 1000.0 + 0.5) / 1000.0 AS keyness, b.p IS NULL AS oov
          FROM uni u LEFT JOIN base b USING (term), total)"""
TOP = f""", top AS (SELECT * FROM (SELECT k.*, floor(coalesce(c.cap, 0) / CAST(k.count AS DOUBLE) * 100.0 + 0.5) / 100.0 AS cap_ratio FROM keyed k LEFT JOIN caps c USING (term)
  WHERE k.count >= 4 AND k.doc_freq >= 2 AND k.term NOT IN ({", ".join(map(lit, TERM_STOP))})) ORDER BY keyness DESC, count DESC, term LIMIT {Q.TOP_K})"""
LANES = """lanes AS (
  SELECT 'quality' AS lane, printf('doc%d', doc_id) AS candidate_ref, doc_id % 5 = 0 AS is_control,
         CASE WHEN quality = 1 THEN 'confirm' WHEN doc_id % 7 = 0 THEN 'uncertain' ELSE 'reject' END AS verdict, doc_id AS seq, doc_id % 100 AS prompt_tokens, CAST(quality AS BIGINT) AS completion_tokens FROM labels
  UNION ALL SELECT 'toxic', printf('doc%d', doc_id), doc_id % 5 = 0, CASE WHEN toxic = 1 THEN 'reject' ELSE 'confirm' END, doc_id, doc_id % 100, CAST(toxic AS BIGINT) FROM labels),
malformed AS (SELECT 'quality' AS lane, printf('doc%d', doc_id) AS candidate_ref, doc_id % 5 = 0 AS is_control,
                     CASE WHEN doc_id % 11 = 0 THEN 'model_malformed' WHEN doc_id % 13 = 0 THEN 'lane_failure' END AS failure_type
              FROM labels WHERE doc_id % 11 = 0 OR doc_id % 13 = 0)"""
PAIRS = f"""{LANES}, pairs AS (
  SELECT candidate_ref, b.verdict AS base, s.verdict AS strong FROM (SELECT candidate_ref, max_by(verdict, seq) AS verdict FROM lanes WHERE lane = 'quality' AND NOT is_control GROUP BY 1) b
  JOIN (SELECT candidate_ref, max_by(verdict, seq) AS verdict FROM lanes WHERE lane = 'toxic' AND NOT is_control GROUP BY 1) s USING (candidate_ref))"""


def share(a: str, b: str) -> str:
    return f"floor(CAST({a} AS DOUBLE) / nullif({b}, 0) * 1000000.0 + 0.5) / 1000000.0"


def _score(text: str = "t", low: str = "low", term: str = "term") -> str:
    """The example score, in the same order of sums."""
    n = f"length({text})"
    has = lambda c: f"CAST(contains({low}, {lit(c)}) AS INTEGER)"
    times = lambda c: f"CAST((length({low}) - length(replace({low}, {lit(c)}, ''))) // {len(c)} AS INTEGER)"
    total = lambda cues, f: "(" + " + ".join(f(c) for c in cues) + ")"
    starts = lambda cues: "(" + " OR ".join(f"starts_with({low}, {lit(c)})" for c in cues) + ")"
    at, size = f"instr({low}, lower({term}))", f"length({term})"
    window = f"substring({low}, greatest({at} - 60, 1), {at} + {size} + 60 - greatest({at} - 60, 1))"
    cues = "(" + " OR ".join(f"contains({window}, {lit(c)})" for c in EXPLAIN_CUES) + ")"
    head = f"substring({text}, 1, 1)"
    flag = lambda condition, value: f"CAST(CASE WHEN {condition} THEN {value} ELSE 0.0 END AS DOUBLE)"
    d = lambda x: f"CAST({x} AS DOUBLE)"
    return f"""(CASE WHEN {n} >= 45 AND {n} <= 165 THEN {d('3.0')} WHEN {n} < 45 THEN -({d('2.5')} + (45 - {n}) / {d('28.0')}) ELSE -({d('1.0')} + ({n} - 165) / {d('90.0')}) END
    + {flag(f'upper({head}) = {head} AND lower({head}) <> {head}', '0.8')}
    + CAST(CASE WHEN regexp_matches({text}, '[.!]$') THEN 1.4 WHEN regexp_matches({text}, '\\?$') THEN 0.2 WHEN ends_with({text}, '…') THEN -2.2 ELSE -1.2 END AS DOUBLE)
    + CAST(CASE WHEN {starts(FILLER_OPEN_STRONG)} THEN -1.8 WHEN {starts(FILLER_OPEN_MILD)} THEN -0.8 ELSE 0.0 END AS DOUBLE)
    - {d('0.7')} * {total(FILLER_INLINE, times)}
    - {flag(total('.!?', times) + ' >= 3', '1.5')}
    - {flag(times(',') + ' >= 4', '0.9')}
    - {d('1.5')} * {total(ANNOUNCE_CUES, has)}
    - {d('2.0')} * {total(SELFID_CUES, has)}
    - {flag(f"regexp_matches({low}, '{DATE_PATTERN}')", '1.5')}
    - {flag(f"regexp_extract({low}, '([a-z][a-z''\\-]*)', 1) = string_split({term}, ' ')[1]", '1.2')}
    + CASE WHEN {at} > 0 THEN {flag(f'{at} - 1 >= 12 AND {n} - ({at} - 1 + {size}) >= 12', '0.6')} + {flag(cues, '1.2')} ELSE {d('0.0')} END)"""


_BARE = r"lower(regexp_replace(w, '[^\p{L}\p{N}\p{M}_]', '', 'g'))"
_FSTOP = ", ".join(map(lit, FEATURE_STOPWORDS))
_WORDS = "list_filter(string_split(text, ' '), lambda x: x <> '')"
SURFACE = f""", surface AS (
  SELECT unit_id, segmentation_quality AS q, len({_WORDS}) AS n, length(text) AS chars,
         len(list_filter(list_transform({_WORDS}, lambda w: {_BARE}), lambda b: b <> '' AND b NOT IN ({_FSTOP}))) AS content
  FROM units JOIN quality USING (source_id)),
shown AS (SELECT *, CASE WHEN q = 'unpunctuated' THEN 'segmentation_quality=''unpunctuated''' WHEN n < 5 THEN 'length_tokens=' || n || ' < 5' ELSE '' END AS why FROM surface)"""


def _surfaces(found: list[tuple[str, str]]) -> str:
    """The labels whose condition holds, in order, comma-joined."""
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {word(w)} THEN {lit(x)} END" for w, x in found) + "], lambda x: x IS NOT NULL), ',')"


_MARKED = _surfaces([(m.surface, m.surface) for m in Q.MARKERS])
_CATEGORIES = "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {word(m.surface)} THEN {lit(m.category)} END" for m in Q.MARKERS) + "], lambda x: x IS NOT NULL))), ',')"
_POINTED = _surfaces([(p.surface, f"{p.surface}:{p.kind}") for p in Q.DEICTICS])
PACKS = (
    CANDIDATES
    + CONTEXTS
    + """, packs AS (
  SELECT candidate_id AS candidate_ref, family, length(u.text) AS n_chars,
         'pack_' || sha256(concat_ws('|', 'candidate_evaluate', '1', candidate_id, context_before, u.text, context_after))[:8] AS pack_id
  FROM candidates c JOIN units u ON u.unit_id = c.unit_ref JOIN contexts x ON x.unit_id = c.unit_ref WHERE bucket IN ('high', 'medium'))"""
)

_TERMS = [(t.term, t.canonical_form or t.term, t.category) for t in Q.TERMS]
ORACLE_SQL = {
    "doc_units": f'WITH {UNITS} SELECT source_id, start, "end", text FROM units',
    "doc_unit_ids": f"WITH {UNITS} SELECT unit_id, 'feat_' || sha256(unit_id || '|surface_complexity_profile|1.0.0')[:8] AS feature_record_id, CAST(length(text) AS INTEGER) AS n_chars FROM units",
    "page_units": f"""WITH pages_ AS (SELECT printf('page%d', page_id) AS source_id, '' AS panel, {norm("regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g')")} AS text FROM pages WHERE html IS NOT NULL)
SELECT source_id, start, "end", text FROM ({split('pages_')})""",
    "quality_profile": f"WITH {UNITS}{QUALITY} SELECT source_id, sentence_count, fragment_rate, terminal_rate, segmentation_quality FROM quality",
    "transcript_hash": f"WITH {DOCS} SELECT source_id, 'sha256:' || sha256(text) AS sha256, CAST(length(text) AS INTEGER) AS char_count FROM docs",
    "conversation_transcript": f"WITH {TURNS} SELECT source_id, 'sha256:' || sha256(text) AS sha256, cue_count FROM scripts",
    "cue_ranges": f"WITH {TURNS} SELECT source_id, cue_ord, c_start, CAST(c_start + length(text) AS INTEGER) AS c_end FROM ranges",
    "turn_asof": f"""WITH {TURNS}, spoken AS ({split('scripts')})
SELECT s.source_id, s.start, s."end", r.srt_index FROM spoken s ASOF JOIN ranges r ON s.source_id = r.source_id AND s.start >= r.c_start""",
    "rule_votes": f"WITH {VOTES} SELECT annotation_id, unit_ref, rule_id, label_vote, authority_level, gate, trigger_text FROM votes",
    "votes_by_family": f"WITH {VOTES} SELECT label_vote, rule_id, count(*) AS n, count(DISTINCT source_id) AS n_sources FROM votes GROUP BY ALL",
    "shadow_split": f"WITH {VOTES} SELECT authority_mode, count(*) AS n FROM votes GROUP BY ALL",
    "term_occurrences": f"WITH {UNITS} "
    + " UNION ALL ".join(
        f"SELECT 'term_' || source_id || '__' || start || '-' || \"end\" || '__{t.replace(' ', '_')}' AS term_occurrence_id, unit_id AS unit_ref, {lit(form)} AS canonical_form, {lit(cat)} AS category, {lit(t)} AS trigger_text FROM units WHERE {word(t)}"
        for t, form, cat in _TERMS
    ),
    "gazetteer_merge": f"WITH {UNITS}, merged(term, canonical_form, category) AS (VALUES ('the', 'the article', 'article'), ('License', 'License', 'law'), ('apache license', 'Apache License', 'legal'), ('des', 'des', '')), counts AS ("
    + " UNION ALL ".join(f"SELECT {lit(t)} AS key, count(*) AS n FROM units WHERE {word(t)}" for t in ("the", "license", "apache license", "des"))
    + ") SELECT term, canonical_form, category, coalesce(n, 0) AS n FROM merged LEFT JOIN counts ON key = lower(term)",
    "clusters_touching": f"""WITH {VOTES}, wide AS (SELECT source_id, label_vote, rule_id, greatest(start - 40, 0) AS s, "end" + 40 AS e FROM votes),
marked AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY source_id, label_vote ORDER BY s, e, rule_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM wide),
placed AS (SELECT *, sum(opens) OVER (PARTITION BY source_id, label_vote ORDER BY s, e, rule_id ROWS UNBOUNDED PRECEDING) AS island FROM marked)
SELECT source_id, label_vote, CAST(min(s) AS INTEGER) AS start, CAST(max(e) AS INTEGER) AS "end", count(*) AS n FROM placed GROUP BY source_id, label_vote, island""",
    "primary_pick": f"WITH {CANDIDATES} SELECT source_id, family, start, rule_id, n_active FROM candidates",
    "candidate_ids": f"WITH {CANDIDATES} SELECT candidate_id, unit_ref, bucket, reason, authority_level, vote_refs FROM candidates",
    "candidates_by_bucket": f"WITH {CANDIDATES} SELECT family, bucket, count(*) AS n FROM candidates GROUP BY ALL",
    "family_caps": f"""WITH {CANDIDATES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source_id, family, authority_level ORDER BY CASE WHEN authority_level = 'shadow' OR bucket = 'high' THEN 0 ELSE 1 END, start) AS r,
         count(*) OVER (PARTITION BY source_id, family, authority_level) AS n FROM candidates)
SELECT source_id, family, start, authority_level, CAST(r AS INTEGER) AS rank_in_family, authority_level = 'shadow' OR n <= {Q.CAP_ABOVE} OR r <= {Q.CAP_KEEP} AS kept FROM ranked""",
    "cap_log": f"""WITH {CANDIDATES}, c AS (SELECT source_id, family, count(*) AS total, count(*) FILTER (authority_level = 'rule_vote') AS routed FROM candidates GROUP BY ALL)
SELECT *, CAST(CASE WHEN routed > {Q.CAP_ABOVE} THEN {Q.CAP_KEEP} ELSE routed END AS BIGINT) AS keep_k FROM c""",
    "context_counts": f"WITH {UNITS}{CONTEXTS} SELECT unit_id, sentences_before, sentences_after FROM contexts",
    "context_text": f"WITH {UNITS}{CONTEXTS} SELECT unit_id, context_before, context_after FROM contexts",
    "evidence_ready": f"""WITH {CANDIDATES}, held AS (SELECT * FROM units WHERE NOT (start = 0 AND source_id LIKE '%0')){CONTEXTS.replace('FROM units', 'FROM held')},
j AS (SELECT CASE WHEN x.unit_id IS NULL THEN 'blocked:unit_ref_unresolved' ELSE 'ready' END AS evidence_ready, coalesce(sentences_before, 0) AS sentences_before, coalesce(sentences_after, 0) AS sentences_after
      FROM candidates c LEFT JOIN contexts x ON x.unit_id = c.unit_ref)
SELECT *, count(*) AS n FROM j GROUP BY ALL""",
    "surface_complexity": f"""WITH {UNITS}{QUALITY}{SURFACE} SELECT unit_id, why = '' AS triggered, CASE WHEN why = '' THEN CAST(n AS INTEGER) END AS length_tokens,
CASE WHEN why = '' THEN CAST(chars AS INTEGER) END AS length_chars, CASE WHEN why = '' THEN floor(CAST(content AS DOUBLE) / n * 10000.0 + 0.5) / 10000.0 END AS lexical_density, why AS suppression_reason FROM shown""",
    "marker_profile": f"WITH {UNITS}, m AS (SELECT unit_id, {_MARKED} AS surfaces, {_CATEGORIES} AS categories FROM units) SELECT unit_id, '1.10.0' AS version, surfaces, categories FROM m WHERE surfaces <> ''",
    "deictic_profile": f"WITH {UNITS}, m AS (SELECT unit_id, {_POINTED} AS phrases FROM units) SELECT * FROM m WHERE phrases <> ''",
    "feature_counts": f"""WITH {UNITS}{QUALITY}{SURFACE}, m AS (SELECT {_MARKED} AS a, {_POINTED} AS b FROM units)
SELECT 'surface_complexity_profile' AS name, CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (why = '') AS BIGINT) AS triggered FROM shown
UNION ALL SELECT 'discourse_marker_profile', count(*) FILTER (a <> ''), count(*) FILTER (a <> '') FROM m
UNION ALL SELECT 'possible_visual_or_deictic_dependence', count(*) FILTER (b <> ''), count(*) FILTER (b <> '') FROM m""",
    "unigram_counts": f"WITH {TOKENS}{UNI} SELECT * FROM uni",
    "bigram_counts": f"WITH {TOKENS}{GRAMS} SELECT * FROM bi",
    "trigram_counts": f"WITH {TOKENS}{GRAMS} SELECT * FROM tri",
    "corpus_totals": f"WITH {TOKENS} SELECT CAST(sum(len(tokens)) AS BIGINT) AS total_tokens, count(*) AS n_units FROM toks",
    "keyness_topk": f"WITH {TOKENS}{UNI}{CAPS}{KEYED}{TOP} SELECT term, count, doc_freq, keyness, oov, cap_ratio, CASE WHEN cap_ratio >= 0.6 THEN 'entity' ELSE 'concept' END AS category FROM top",
    "cap_counts": f"WITH {TOKENS}{CAPS} SELECT * FROM caps",
    "phrases_topk": f"""WITH {TOKENS}{UNI}{KEYED}{GRAMS}, good AS (SELECT term FROM keyed WHERE keyness >= 0.5),
b AS (SELECT * FROM bi WHERE count >= 3 AND phrase NOT IN ({", ".join(map(lit, GENERIC_PHRASES))}) AND EXISTS (SELECT 1 FROM good WHERE list_contains(string_split(phrase, ' '), term)) ORDER BY count DESC, phrase LIMIT {Q.TOP_K}),
t AS (SELECT * FROM tri WHERE count >= 3 AND phrase NOT IN ({", ".join(map(lit, GENERIC_PHRASES))}) AND EXISTS (SELECT 1 FROM good WHERE list_contains(string_split(phrase, ' '), term)) ORDER BY count DESC, phrase LIMIT {Q.TOP_K // 2})
SELECT phrase, count FROM b UNION ALL SELECT phrase, count FROM t""",
    "collocates_top6": f"""WITH {TOKENS}{UNI}{CAPS}{KEYED}{TOP}{GRAMS}, e AS (SELECT DISTINCT phrase, count, unnest(string_split(phrase, ' ')) AS term FROM bi),
r AS (SELECT e.term, e.phrase, e.count, row_number() OVER (PARTITION BY e.term ORDER BY e.count DESC, e.phrase) AS rank FROM e JOIN top USING (term))
SELECT term, phrase, count, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 6""",
    "kwic_top4": f"""WITH {TOKENS}{UNI}{GRAMS}, terms AS (SELECT term FROM uni ORDER BY count DESC, term LIMIT 20), ph AS (SELECT phrase FROM bi ORDER BY count DESC, phrase LIMIT 10),
alltoks AS ({tokens('units').rsplit('WHERE NOT', 1)[0]}),
found AS (SELECT DISTINCT term, source_id, start, "end", text FROM (SELECT source_id, start, "end", text, unnest(list_distinct(tokens)) AS term FROM alltoks) JOIN terms USING (term)
  UNION ALL SELECT phrase, source_id, start, "end", text FROM alltoks, ph WHERE contains(lower(text), phrase)),
near AS (SELECT *, trim(text) AS t, lower(trim(text)) AS low, row_number() OVER (PARTITION BY term ORDER BY source_id, start, "end") AS n FROM found),
scored AS (SELECT *, {_score()} AS raw FROM near WHERE n <= 80),
best AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY raw DESC, source_id, start, "end") AS rank FROM scored)
SELECT term, source_id, start, floor(raw * 1000000.0 + 0.5) / 1000000.0 AS score, CAST(rank AS INTEGER) AS rank FROM best WHERE rank <= 4""",
    "blind_spots": f"""WITH {TOKENS}{UNI}{CAPS}{KEYED}{TOP}{GRAMS}, probes(display, cause, form) AS (VALUES ('The law', 'homograph', 'license'), ('The law', 'homograph', 'licensed'), ('Apache', 'tokenization', 'apache license'), ('none', 'asr', 'zzzz')),
counts AS (SELECT term AS form, count FROM uni UNION ALL SELECT phrase, count FROM bi)
SELECT display, cause, form, count, form IN (SELECT term FROM top) AS in_dictionary FROM probes JOIN counts USING (form)""",
    "metadata_hash": f"""WITH {UNITS}, n AS (SELECT source_id, count(*) AS n FROM units GROUP BY source_id)
SELECT d.source_id, 'sha256:' || sha256('{{"char_count": ' || length(text) || ', "cue_count": 1, "normalization_profile": "norm_v0_1", "sentence_count": ' || coalesce(n, 0)
|| ', "source_id": "' || d.source_id || '", "srt_filename": "' || d.source_id || '.srt"}}') AS metadata_sha256 FROM docs d LEFT JOIN n ON n.source_id = d.source_id""",
    "vote_span_violations": f"""WITH {VOTES} SELECT violation, count(*) AS n FROM (
SELECT 'span is not the unit''s' AS violation FROM votes WHERE start = 0 UNION ALL SELECT 'trigger_text is not in the unit' FROM votes WHERE rule_id = 'deontic_001') GROUP BY violation""",
    "candidate_violations": f"""WITH {CANDIDATES} SELECT violation, count(*) AS n FROM (SELECT CASE right(source_id, 1) WHEN '1' THEN 'routing reason is empty'
WHEN '2' THEN 'authority_level is unknown' WHEN '4' THEN 'evidence_ready does not re-derive' END AS violation FROM candidates) WHERE violation IS NOT NULL GROUP BY violation""",
    "fk_orphans": f"WITH {VOTES} SELECT 'orphan' AS \"check\", unit_ref AS key, count(*) AS n FROM votes WHERE start = 0 GROUP BY unit_ref",
    "dup_ids": f"WITH {UNITS} SELECT 'duplicate' AS \"check\", unit_id AS key, 'duplicate unit_id, rows: 2' AS violation FROM units WHERE source_id LIKE '%3'",
    "anchor_violations": f"""WITH {UNITS} SELECT CASE WHEN start = 0 THEN 'text does not re-resolve at char_span' ELSE 'char_span out of bounds' END AS violation, count(*) AS n
FROM units WHERE (start = 0 AND "end" > 1) OR (start > 0 AND start < 20) GROUP BY violation
UNION ALL SELECT 'char_span out of bounds', count(*) FROM units WHERE start = 0 AND "end" <= 1 HAVING count(*) > 0""",
    "schema_violations": """SELECT violation, count(*) AS n FROM (
  SELECT unnest(['turns: missing required field ''text''', 'turns: unexpected field ''turn''', CASE WHEN conv_id < 10 THEN 'turns.conv_id: less than minimum 10' END,
                 CASE WHEN role <> 'user' THEN 'turns.role: not in enum' END]) AS violation FROM conversations) WHERE violation IS NOT NULL GROUP BY violation""",
    "candidate_packs": f"WITH {PACKS} SELECT candidate_ref, family, pack_id, CAST(n_chars AS INTEGER) AS n_chars FROM packs",
    "controls_union": f"""WITH {PACKS}, both_ AS (SELECT family, false AS is_control, candidate_ref FROM packs UNION ALL
  SELECT 'contrast', true, 'cand_' || sha256(printf('ctl_%d', item_id))[:8] FROM benchmark)
SELECT family, is_control, count(*) AS n, min(candidate_ref) AS least_ref FROM both_ GROUP BY ALL""",
    "resume_pending": f"""WITH {LANES}, done AS (SELECT candidate_ref, is_control FROM lanes WHERE lane = 'quality' AND verdict <> 'uncertain' AND seq % 13 <> 0
  UNION SELECT candidate_ref, is_control FROM malformed WHERE failure_type = 'model_malformed')
SELECT d.candidate_ref, d.is_control FROM (SELECT printf('doc%d', doc_id) AS candidate_ref, doc_id % 5 = 0 AS is_control FROM documents) d ANTI JOIN done USING (candidate_ref, is_control)""",
    "vote_summary": f"""WITH {LANES}, v AS (SELECT lane, count(*) AS votes, count(*) FILTER (verdict = 'confirm') AS confirm, count(*) FILTER (verdict = 'reject') AS reject, count(*) FILTER (verdict = 'uncertain') AS uncertain,
  count(*) FILTER (is_control) AS control_votes, count(*) FILTER (is_control AND verdict = 'reject') AS control_rejects, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens FROM lanes GROUP BY lane),
m AS (SELECT lane, count(*) FILTER (failure_type = 'model_malformed') AS model_malformed, count(*) FILTER (failure_type = 'lane_failure') AS lane_failures FROM malformed GROUP BY lane),
j AS (SELECT v.*, coalesce(model_malformed, 0) AS model_malformed, coalesce(lane_failures, 0) AS lane_failures FROM v LEFT JOIN m USING (lane))
SELECT *, {share('model_malformed', 'votes + model_malformed')} AS malformed_rate, {share('uncertain', 'votes')} AS uncertain_rate, {share('control_rejects', 'control_votes')} AS control_rejection_rate,
coalesce(CAST(control_rejects AS DOUBLE) / nullif(control_votes, 0) >= 0.9, false) AS control_bar_passed FROM j""",
    "agreement": f"""WITH {LANES}, own AS (SELECT candidate_ref, lane, max_by(verdict, seq) AS verdict FROM lanes WHERE NOT is_control GROUP BY ALL),
c AS (SELECT candidate_ref, count(*) AS n, count(DISTINCT verdict) AS k FROM own GROUP BY candidate_ref HAVING count(*) = 2)
SELECT count(*) AS shared_candidates, count(*) FILTER (k = 1) AS fully_agreed, {share('count(*) FILTER (k = 1)', 'count(*)')} AS agreement_rate FROM c""",
    "adjudication": f"WITH {PAIRS} SELECT count(*) AS n_compared, count(*) FILTER (base = strong) AS agree, count(*) FILTER (base <> strong) AS n_flips, {share('count(*) FILTER (base = strong)', 'count(*)')} AS agreement_rate FROM pairs",
    "flips": f"WITH {PAIRS} SELECT candidate_ref, base, strong FROM pairs WHERE base <> strong",
    "confirm_by_bucket": f"""WITH {CANDIDATES} SELECT bucket, count(*) AS votes, count(*) FILTER (start % 3 = 0) AS confirmed, {share('count(*) FILTER (start % 3 = 0)', 'count(*)')} AS confirm_rate
FROM candidates WHERE start % 5 <> 0 GROUP BY bucket""",
    "confusion": f"WITH {PAIRS} SELECT 'base_' || base || '__strong_' || strong AS label, count(*) AS n FROM pairs GROUP BY ALL",
    "parse_responses": """WITH r AS (SELECT conv_id, turn, CAST(to_json({'verdict': 'confirm', 'rationale': text}) AS VARCHAR) AS j FROM conversations),
o AS (SELECT *, conv_id % 3 <> 2 OR length(j) <= 40 AS ok FROM r)
SELECT conv_id, turn, ok, CASE WHEN ok THEN '' ELSE 'no_json_object_found' END AS reason, CASE WHEN ok THEN CAST(length(j) AS INTEGER) END AS size FROM o""",
}
