"""Command line: python -m gleaner.cli run|annotate|candidates|enrich|validate|dictionary|packs|judge|adjudicate ...

annotate, candidates and enrich run one stage on a stored run (--run); validate checks a stored run, or with --srt what it makes.
"""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import functions as F

from gleaner.operators import dictionary, packs, validate
from gleaner.plans import judging, stored
from gleaner.plans.evidence import Evidence, from_cues
from gleaner.registries import MARKERS, RULES, TERMS, merged_terms
from gleaner.session import session
from gleaner.sources.records import document, read_controls, write_text
from gleaner.sources.registry_files import read_markers, read_rules, read_terms
from gleaner.sources.srt import parse_srt, read_srt, require_cues


def registries(spark, args) -> tuple:
    """Rules, terms (the gazetteer's override them) and markers, from files where these are named."""
    terms = read_terms(spark, args.terms) if args.terms else TERMS
    if args.gazetteer:
        terms = merged_terms(terms, read_terms(spark, args.gazetteer))
    return (read_rules(spark, args.rules) if args.rules else RULES), terms, (read_markers(spark, args.markers) if args.markers else MARKERS)


def evidence(spark, args) -> Evidence:
    rules, terms, markers = registries(spark, args)
    files = read_srt(spark, args.srt)
    found = from_cues(require_cues(files, parse_srt(files)), args.run_id, rules, terms)
    found.markers = markers
    return found


def build_dictionary(spark, found: Evidence, baseline, min_count: int, min_docfreq: int, top_k: int) -> tuple[list, list, dict, list]:
    """Collected cards and phrases (top_k rows), the corpus totals, and the blind spots."""
    toks = dictionary.tokenized(found.units).cache()
    uni, bi, tri = dictionary.unigrams(toks), dictionary.phrase_counts(toks, 2), dictionary.phrase_counts(toks, 3)
    keyed = dictionary.keyness(uni, baseline, dictionary.totals(toks))
    n_sources = found.units.select("source_id").distinct().count()
    terms = dictionary.top_terms(keyed, dictionary.capitalized(toks), min_count, 1 if n_sources == 1 else min_docfreq, top_k)
    top = dictionary.top_phrases(dictionary.phrases(bi, keyed), dictionary.phrases(tri, keyed), top_k)
    cards = dictionary.cards(terms, dictionary.collocates(terms, bi), dictionary.examples(found.units, terms, top))
    order = (F.desc("keyness"), F.desc("count"), "term")
    rows = [r.asDict(True) for r in cards.orderBy(*order).collect()]
    about = {"n_sources": n_sources, "vocab_size": uni.count()} | dictionary.totals(toks).first().asDict()
    kinds = [r["category"] for r in rows]
    about |= {"min_count": min_count, "min_docfreq": min_docfreq, "n_concepts": kinds.count("concept"), "n_entities": kinds.count("entity")}
    blind = dictionary.blind_spot_report([r.asDict() for r in dictionary.blind_spots(uni, bi, cards).collect()])
    return rows, [r.asDict() for r in top.orderBy(F.desc("count"), "phrase").collect()], about, blind


def loaded(name: str):
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=["run", "annotate", "candidates", "enrich", "validate", "dictionary", "packs", "judge", "adjudicate"])
    parser.add_argument("--srt", help="a file, folder or glob of subtitle files")
    parser.add_argument("--run", help="a stored run, for annotate, candidates, enrich and validate")
    parser.add_argument("--out", default="out")
    parser.add_argument("--run-id", default="run_local")
    parser.add_argument("--tier", default="D", choices=["A", "B", "C", "D"])
    parser.add_argument("--rules")
    parser.add_argument("--terms")
    parser.add_argument("--gazetteer", help="CSV of terms that override and extend the others")
    parser.add_argument("--markers", help="CSV of discourse markers")
    parser.add_argument("--baseline", help="Parquet of term and p: the general-language shares")
    parser.add_argument("--buckets", default="high,medium")
    parser.add_argument("--limit", type=int)
    parser.add_argument("--controls", help="JSON lines of planted controls")
    parser.add_argument("--max-controls", type=int)
    parser.add_argument("--judge", default="gleaner.operators.votes:fake_judge", help="module:function, prompt -> reply, usage, model, code")
    parser.add_argument("--lane", default="local")
    parser.add_argument("--model", default="strong", help="the adjudicator's name")
    parser.add_argument("--fresh", action="store_true", help="forget recorded votes")
    parser.add_argument("--min-count", type=int, default=4)
    parser.add_argument("--min-docfreq", type=int, default=2)
    parser.add_argument("--top-k", type=int, default=120)
    parser.add_argument("--master")
    parser.add_argument("--execute", action="store_true", help="write; without it nothing is written")
    args = parser.parse_args(argv)
    spark = session(args.master)
    if args.run:
        rules, terms, markers = registries(spark, args)
        if args.command == "annotate":
            stored.annotate_run(spark, args.run, args.run_id, rules, terms, args.execute)
        elif args.command == "candidates":
            stored.candidates_run(spark, args.run, args.run_id, args.tier, args.execute)
        elif args.command == "enrich":
            stored.enrich_run(spark, args.run, args.run_id, markers, execute=args.execute)
        elif args.command == "validate":
            validate.require_clean(stored.violations(spark, args.run))
            print("no violations")
        else:
            parser.error(f"{args.command} takes --srt")
        print(json.dumps([r.asDict() for r in stored.counts(spark, args.run).orderBy("source_id").collect()], indent=2))
        return
    if not args.srt:
        parser.error("--srt or --run is needed")
    found = evidence(spark, args)
    if args.command == "run":
        found.write(args.out, args.run_id, args.tier, args.execute)
        print(json.dumps([r.asDict() for r in found.counts().orderBy("source_id").collect()], indent=2))
    elif args.command == "validate":
        validate.require_clean(found.violations())
        print("no violations")
    elif args.command == "dictionary":
        empty = spark.createDataFrame([], "term string, p double")
        base = spark.read.parquet(args.baseline) if args.baseline else empty
        cards, top, about, blind = build_dictionary(spark, found, base, args.min_count, args.min_docfreq, args.top_k)
        text = dictionary.markdown(cards, top, about)
        if args.execute:
            to_json = lambda x: json.dumps(x, indent=2, ensure_ascii=False)
            lines = "\n".join(json.dumps(c, ensure_ascii=False) for c in cards)
            for name, body in (("dictionary.md", text), ("term_cards.jsonl", lines), ("freq_full.json", to_json(about)), ("blind_spots.json", to_json(blind))):
                write_text(spark, body, f"{args.out.rstrip('/')}/{name}")
        print(text)
    else:
        rows = packs.candidate_packs(found.candidates, found.units, found.votes, packs.parse_buckets(args.buckets), args.limit)
        if args.controls and args.command != "adjudicate":
            rows = rows.unionByName(packs.control_packs(read_controls(spark, args.controls), args.max_controls))
        if args.command == "judge":
            left = judging.run_lane(rows, loaded(args.judge), args.lane, args.out, args.run_id, args.execute, args.fresh)
            if args.execute:
                print(document(judging.run_summary(spark, args.out)))
            else:
                print(f"{left.count()} packs to judge")
            return
        if args.command == "adjudicate":
            pairs = judging.adjudicate(rows, loaded(args.judge), args.model, args.lane, args.out, args.run_id, args.execute)
            print(judging.report(pairs, args.model))
            return
        if args.execute:
            rows.write.mode("overwrite").parquet(args.out)
        for r in packs.families(rows).orderBy("family").collect():
            print(f"{r.family}: {r.packs}")


if __name__ == "__main__":
    main()
