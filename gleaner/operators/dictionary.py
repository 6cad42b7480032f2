"""The keyness dictionary: counts, scored terms, phrases, collocates, usage examples and blind spots.

The general-language baseline is an input (term, p), so any corpus or frequency list can serve. Counts are
aggregated before they are shuffled; only the top terms and phrases, bounded by top_k, are sent to every task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import bound, occurrences, rounded
from gleaner.registries import (
    ANNOUNCE_CUES,
    BLIND_SPOTS,
    BOILERPLATE,
    DATE_PATTERN,
    DICTIONARY_STOPWORDS,
    EXPLAIN_CUES,
    FILLER_INLINE,
    FILLER_OPEN_MILD,
    FILLER_OPEN_STRONG,
    GENERIC_PHRASES,
    LEMMAS,
    SELFID_CUES,
    TERM_STOP,
)

WORD, CAPITALIZED = r"[a-z][a-z'\-]*[a-z]|[a-z]", r"(?U)\b[A-Z][A-Za-z'\-]*\b"
FLOOR, PHRASE_KEYNESS, ENTITY_SHARE, PHRASE_COUNT = 1e-8, 0.5, 0.6, 3
EXAMPLES, COLLOCATES, EXAMPLE_CANDIDATES = 4, 6, 80
SHORTEST, LONGEST = 45, 165


def lemma(word: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in LEMMAS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, word), word)


def is_stop(word: Column) -> Column:
    return word.isin(DICTIONARY_STOPWORDS)


def tokens(text: Column) -> Column:
    """Lower-case words of two letters or more, lemmatized."""
    found = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))
    return F.transform(F.filter(found, lambda w: F.length(w) > 1), lemma)


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams whose first and last words are no stop words. tokens: a column."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(F.array().cast("array<int>"))
    # each token is looked up once
    kept = lambda stop: F.filter(starts, lambda i: ~(F.get(stop, i - 1) | F.get(stop, i + (n - 2))))
    return F.transform(bound(F.transform(tokens, is_stop), kept), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))


def tokenized(units: DataFrame, panel: str = "source_id") -> DataFrame:
    """panel, text and tokens of every unit that is not boilerplate."""
    clean = units.where(~F.startswith(F.lower(F.trim("text")), F.lit(BOILERPLATE)))
    return clean.select(F.col(panel).alias("panel"), "text", tokens(F.col("text")).alias("tokens"))


def totals(toks: DataFrame) -> DataFrame:
    """total_tokens (stop words too) and n_units, in one row."""
    return toks.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0)).cast("long").alias("total_tokens"), F.count("*").alias("n_units"))


def unigrams(toks: DataFrame) -> DataFrame:
    """term, count and doc_freq (panels that have it)."""
    each = toks.select("panel", F.explode("tokens").alias("term")).where(~is_stop(F.col("term")))
    # two steps: a panel's count of a term is one row before the term's rows meet
    panels = each.groupBy("term", "panel").count()
    return panels.groupBy("term").agg(F.sum("count").alias("count"), F.count("*").alias("doc_freq"))


def phrase_counts(toks: DataFrame, n: int) -> DataFrame:
    """phrase and count of n-grams within a unit."""
    return toks.select(F.explode(ngrams(F.col("tokens"), n)).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("count"))


def capitalized(toks: DataFrame) -> DataFrame:
    """term and cap: how often a word stands with a capital."""
    found = toks.select(F.explode(F.regexp_extract_all("text", F.lit(f"({CAPITALIZED})"), F.lit(1))).alias("w")).select(F.lower("w").alias("w"))
    return found.where(~is_stop(F.col("w"))).select(lemma(F.col("w")).alias("term")).groupBy("term").agg(F.count("*").alias("cap"))


def baseline(toks: DataFrame) -> DataFrame:
    """term and p: shares of a baseline corpus."""
    each = toks.select(F.explode("tokens").alias("term")).groupBy("term").count()
    return each.select("term", (F.col("count") / each.agg(F.sum("count")).scalar()).alias("p"))


def keyness(counts: DataFrame, base: DataFrame, total: DataFrame) -> DataFrame:
    """counts (term, count, ...) with keyness, oov and zipf. total: one row."""
    rows = counts.join(base, "term", "left")
    known = F.coalesce(F.col("p") > 0, F.lit(False))
    share = F.col("count") / total.select("total_tokens").scalar()
    return rows.select(
        *counts.columns,
        rounded(F.log10(share / F.when(known, F.col("p")).otherwise(F.lit(FLOOR))), 3).alias("keyness"),
        (~known).alias("oov"),
        F.when(known, rounded(F.log10(F.col("p")) + 9.0, 2)).otherwise(F.lit(0.0)).alias("zipf"),
    )


def top_terms(scored: DataFrame, caps: DataFrame, min_count: int = 4, min_docfreq: int = 2, top_k: int = 120) -> DataFrame:
    """The top_k terms by keyness, count and name, with cap_ratio and category."""
    gated = scored.where((F.col("count") >= min_count) & (F.col("doc_freq") >= min_docfreq) & ~F.col("term").isin(*TERM_STOP))
    ratio = rounded(F.coalesce("cap", F.lit(0)) / F.col("count"), 2)
    rows = gated.join(caps, "term", "left").withColumn("cap_ratio", ratio).drop("cap")
    rows = rows.withColumn("category", F.when(F.col("cap_ratio") >= ENTITY_SHARE, "entity").otherwise("concept"))
    return rows.orderBy(F.desc("keyness"), F.desc("count"), "term").limit(top_k)


def phrases(counted: DataFrame, scored: DataFrame, least: int = PHRASE_COUNT) -> DataFrame:
    """phrase and count of those frequent enough, not generic, with a word that is distinctive."""
    rows = counted.where((F.col("count") >= least) & ~F.col("phrase").isin(*GENERIC_PHRASES))
    each = rows.select("phrase", F.explode(F.split("phrase", " ")).alias("term")).where(~is_stop(F.col("term")))
    keyed = each.join(scored.select("term", "keyness").where(F.col("keyness") >= PHRASE_KEYNESS), "term", "left_semi")
    return rows.join(keyed.select("phrase").distinct(), "phrase", "left_semi").select("phrase", "count")


def top_phrases(bigrams: DataFrame, trigrams: DataFrame, top_k: int = 120) -> DataFrame:
    """The first top_k bigrams and half as many trigrams, by count and name."""
    order = (F.desc("count"), F.col("phrase"))
    return bigrams.orderBy(*order).limit(top_k).unionByName(trigrams.orderBy(*order).limit(top_k // 2))


def collocates(terms: DataFrame, bigrams: DataFrame, n: int = COLLOCATES) -> DataFrame:
    """term, phrase, count and rank of the n most frequent bigrams with the term. terms: the top terms."""
    each = bigrams.select("phrase", "count", F.explode(F.array_distinct(F.split("phrase", " "))).alias("term"))
    held = each.join(F.broadcast(terms.select("term").distinct()), "term")
    order = Window.partitionBy("term").orderBy(F.desc("count"), "phrase")
    return held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("term", "phrase", "count", "rank")


def example_score(text: Column, term: Column) -> Column:
    """How well a text shows the term in use; sums are made in the listed order."""
    text = F.trim(text)
    low, n = F.lower(text), F.length(text)
    any_of = lambda cues, test: reduce(lambda a, b: a | b, (test(c) for c in cues))
    starts = lambda cues: any_of(cues, lambda c: F.startswith(low, F.lit(c)))
    flag = lambda condition, value: F.when(condition, value).otherwise(0.0)
    has = lambda cue: F.contains(low, F.lit(cue)).cast("int")
    total = lambda cues, f: reduce(lambda a, b: a + b, (f(c) for c in cues))
    length = (
        F.when((n >= SHORTEST) & (n <= LONGEST), 3.0)
        .when(n < SHORTEST, -(F.lit(2.5) + (SHORTEST - n) / 28.0))
        .otherwise(-(F.lit(1.0) + (n - LONGEST) / 90.0))
    )
    head = F.substring(text, 1, 1)
    ending = F.when(text.rlike("[.!]$"), 1.4).when(text.rlike(r"\?$"), 0.2).when(F.endswith(text, F.lit("…")), -2.2).otherwise(-1.2)
    opener = F.when(starts(FILLER_OPEN_STRONG), -1.8).when(starts(FILLER_OPEN_MILD), -0.8).otherwise(0.0)
    stops = total(".!?", lambda c: occurrences(low, c))
    first = F.regexp_extract(low, r"([a-z][a-z'\-]*)", 1)
    at = F.call_function("locate", F.lower(term), low)
    size = F.length(term)
    window = F.substring(low, F.greatest(at - 60, F.lit(1)), at + size + 60 - F.greatest(at - 60, F.lit(1)))
    placed = F.when(
        at > 0,
        flag((at - 1 >= 12) & (n - (at - 1 + size) >= 12), 0.6) + flag(any_of(EXPLAIN_CUES, lambda c: F.contains(window, F.lit(c))), 1.2),
    ).otherwise(0.0)
    return (
        length
        + flag((F.upper(head) == head) & (F.lower(head) != head), 0.8)
        + ending
        + opener
        - 0.7 * total(FILLER_INLINE, lambda c: occurrences(low, c))
        - flag(stops >= 3, 1.5)
        - flag(occurrences(low, ",") >= 4, 0.9)
        - 1.5 * total(ANNOUNCE_CUES, has)
        - 2.0 * total(SELFID_CUES, has)
        - flag(low.rlike(DATE_PATTERN), 1.5)
        - flag(first == F.element_at(F.split(term, " "), 1), 1.2)
        + placed
    )


def examples(units: DataFrame, terms: DataFrame, phrase_list: DataFrame, n: int = EXAMPLES, candidates: int = EXAMPLE_CANDIDATES) -> DataFrame:
    """term, source_id, start, end, text, score and rank of the best examples among each term's first candidates.

    Terms are found by their tokens (an equi-join), phrases within the lower-case text; both lists are bounded by
    top_k and reach every task. Units without a span are left out.
    """
    held = units.where("start IS NOT NULL AND end IS NOT NULL").select("source_id", "start", "end", "text", tokens(F.col("text")).alias("tokens"))
    each = held.select("source_id", "start", "end", "text", F.explode(F.array_distinct("tokens")).alias("term"))
    by_term = each.join(F.broadcast(terms.select("term").distinct()), "term")
    wanted = phrase_list.agg(F.collect_set("phrase")).scalar()  # top_k phrases
    found = held.withColumn("wanted", wanted).select(
        "source_id", "start", "end", "text", F.explode(bound(F.lower("text"), lambda low: F.filter("wanted", lambda p: F.contains(low, p)))).alias("term")
    )
    both = by_term.select(*found.columns).unionByName(found)
    first = Window.partitionBy("term").orderBy("source_id", "start", "end")
    near = both.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= candidates)
    scored = near.withColumn("score", example_score(F.col("text"), F.col("term")))
    best = Window.partitionBy("term").orderBy(F.desc("score"), "source_id", "start", "end")
    rows = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return rows.select("term", "source_id", "start", "end", F.trim("text").alias("text"), rounded(F.col("score"), 6).alias("score"), "rank")


def blind_spots(uni: DataFrame, bigrams: DataFrame, cards: DataFrame, probes: tuple = BLIND_SPOTS) -> DataFrame:
    """display, cause, form, count and in_dictionary of every probed form that occurs."""
    spark = uni.sparkSession
    asked = spark.createDataFrame([(d, c, f) for d, forms, c in probes for f in forms], "display string, cause string, form string")
    counts = uni.select(F.col("term").alias("form"), "count").unionByName(bigrams.select(F.col("phrase").alias("form"), "count"))
    found = counts.join(F.broadcast(asked), "form")
    known = F.broadcast(cards.select(F.col("term").alias("form"), F.lit(True).alias("known")))
    return found.join(known, "form", "left").select("display", "cause", "form", "count", F.coalesce("known", F.lit(False)).alias("in_dictionary"))


def blind_spot_report(found: list[dict], probes: tuple = BLIND_SPOTS, why: dict[str, str] | None = None) -> list[dict]:
    """Every probe with the forms of it that occur (rows of blind_spots) and, if given for its cause, an explanation."""
    out = []
    for display, forms, cause in probes:
        variants = [{k: r[k] for k in ("form", "count", "in_dictionary")} for f in forms for r in found if (r["display"], r["form"]) == (display, f)]
        out.append(
            {"display": display, "cause": cause, "why": (why or {}).get(cause, ""), "variants": variants, "in_dictionary": any(v["in_dictionary"] for v in variants)}
        )
    return out


def cards(terms: DataFrame, colloc: DataFrame, kwic: DataFrame) -> DataFrame:
    """The top terms with arrays of collocates and of examples."""
    listed = colloc.groupBy("term").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "phrase"))), lambda x: x.phrase).alias("collocates"))
    shown = kwic.groupBy("term").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "source_id", "start", "end", "text"))),
            lambda x: F.struct(x.source_id.alias("source_id"), F.array(x.start, x.end).alias("char_span"), x.text.alias("text")),
        ).alias("kwic")
    )
    return terms.join(listed, "term", "left").join(shown, "term", "left")


def markdown(card_rows: list, phrase_rows: list, about: dict, concepts: int = 50, entities: int = 40, top: int = 50) -> str:
    """The dictionary for readers, from its collected top rows."""

    def example(kwic) -> str:
        return kwic[0]["text"][:88] + "…" if kwic else ""

    def table(rows, n):
        lines = ["| Term | Count | Panels | Keyness | Example |", "|---|---|---|---|---|"]
        return lines + [f"| {r['term']} | {r['count']} | {r['doc_freq']} | {r['keyness']} | {example(r['kwic'])} |" for r in rows[:n]]

    by = {c: [r for r in card_rows if r["category"] == c] for c in ("concept", "entity")}
    lines = ["# Dictionary", "", ", ".join(f"{k}: {v:,}" for k, v in about.items()), "", "## Concepts", *table(by["concept"], concepts)]
    lines += ["", "## Entities", *table(by["entity"], entities), "", "## Phrases", "| Phrase | Count |", "|---|---|"]
    return "\n".join([*lines, *(f"| {r['phrase']} | {r['count']} |" for r in phrase_rows[:top])]) + "\n"
