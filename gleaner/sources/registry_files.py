"""Registries from CSV files, read by Spark; a few hundred rows that are collected to build expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.registries import Marker, Rule, Term, checked


def read_csv(spark: SparkSession, path: str, required: tuple[str, ...]) -> list[dict]:
    """The rows as dictionaries of strings; a missing column is an error that names the file."""
    rows: DataFrame = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    if missing := [c for c in required if c not in rows.columns]:
        raise ValueError(f"{path}: no column {missing}; it has {rows.columns}")
    return [{k: v or "" for k, v in r.asDict().items()} for r in rows.collect()]


def read_rules(spark: SparkSession, path: str) -> tuple[Rule, ...]:
    """Rows without rule_id or pattern are left out; a pattern that does not compile is an error."""
    rows = read_csv(spark, path, ("rule_id", "pattern", "cue_family"))
    return checked(
        tuple(
            Rule(
                r["rule_id"].strip(),
                int(r.get("version") or 1),
                r["cue_family"].strip(),
                (r.get("pattern_type") or "regex").strip(),
                r["pattern"],
                (r.get("authority_mode") or "active").strip(),
                (r.get("gate") or "").strip(),
            )
            for r in rows
            if r["rule_id"] and r["pattern"]
        )
    )


def read_terms(spark: SparkSession, path: str) -> tuple[Term, ...]:
    """Rows without a term, or that start with #, are left out."""
    rows = read_csv(spark, path, ("term",))
    return tuple(
        Term(t, (r.get("category") or "").strip(), (r.get("canonical_form") or "").strip())
        for r in rows
        if (t := r["term"].strip()) and not t.startswith("#")
    )


def read_markers(spark: SparkSession, path: str) -> tuple[Marker, ...]:
    rows = read_csv(spark, path, ("surface", "category", "fp_note", "version"))
    return tuple(
        Marker(r["surface"].strip(), r["category"].strip(), r["fp_note"].strip(), r["version"].strip()) for r in rows if r["surface"].strip()
    )
