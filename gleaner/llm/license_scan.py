"""License scans by diagonal voting.

Every text is split into words; the rolling hashes of each k consecutive words are joined to the
positions that the same k words have in license templates. A match votes for the diagonal (word in
the text minus word in the template); votes are counted for each diagonal, neighbouring diagonals
(words put in or left out) are merged, and a span is kept if the template's words that it covers
reach the template's share. Matches carry their words, and a vote counts only if these are the
template's own, so a colliding hash never makes a span. Phrases are templates that must be covered
whole on one diagonal, so each of their places is a diagonal.

Null or empty texts have no words and no labels. Repeated rows are judged one by one; an empty table
gives no rows. Template rows stay on the workers as long as there are fewer than BROADCAST_ROWS;
above that the scan passes every hash on and the join shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import ALNUM, LOWER, Words, checkpoint, documents, grams, slices, text_buffer

#: Words of a rolling hash (shorter templates: all their words).
GRAM = 4
#: Diagonals no further apart than this are merged.
SLACK = 6
#: Template rows that may be sent to every worker.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Template:
    """A label's text; share: the part of its words that a span must cover; exact: on one diagonal."""

    label: str
    text: str
    share: float = 0.95
    exact: bool = False


#: The phrases of the base labels.
PHRASES = (
    Template("cc-by", "cc by", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
    Template("reserved", "all rights reserved", 1.0, True),
)

#: Public license notices.
NOTICES = (
    Template("mit", "released under the mit license"),
    Template("mit", "licensed under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        0.6,
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
        0.6,
    ),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2"),
    Template(
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
        0.7,
    ),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-4.0", "licensed under cc by 4 0", 1.0),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", 1.0),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", 1.0),
    Template(
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        0.7,
    ),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        0.7,
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_rows(templates: tuple[Template, ...]) -> list[tuple[int, int, int, int, str]]:
    """(template, position, k, hash, words) of every k consecutive words."""
    rows = []
    for number, template in enumerate(templates):
        words = template.text.split()
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        hashes = Words(data, np.array([0, len(data)]), ALNUM).hashes
        k = min(GRAM, len(words))
        for position, hashed in enumerate(grams(hashes, k).view(np.int64).tolist()):
            rows.append((number, position, k, hashed, " ".join(words[position : position + k])))
    return rows


def scan(df: DataFrame, rows: list, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words and hits (place, hash, words) of every row; hits: those with a template's hash."""
    sizes = sorted({r[2] for r in rows})
    known = {k: np.unique(np.array([r[3] for r in rows if r[2] == k], np.int64)) for k in sizes}
    every = len(rows) >= BROADCAST_ROWS

    def run(batches):
        for batch in batches:
            whole, ends = text_buffer(batch.column(1))
            for i, j in slices(ends):
                data, offsets = LOWER[whole[ends[i] : ends[j]]], ends[i : j + 1] - ends[i]
                words = Words(data, offsets, ALNUM)
                doc, found = words.document(), []
                for k in sizes:
                    hashes = grams(words.hashes, k).view(np.int64)
                    own = doc[: len(hashes)] == doc[k - 1 :]  # not across documents
                    if not every:
                        near = np.searchsorted(known[k], hashes)
                        own &= known[k][np.minimum(near, len(known[k]) - 1)] == hashes
                    at = np.flatnonzero(own)
                    for p, h in zip(at.tolist(), hashes[at].tolist(), strict=True):
                        spelled = [data[words.starts[q] : words.ends[q]].tobytes() for q in range(p, p + k)]
                        found.append((int(doc[p]), {"place": p - int(words.first[doc[p]]), "hash": h, "words": b" ".join(spelled).decode(errors="replace")}))
                hits: list[list] = [[] for _ in range(j - i)]
                for d, hit in found:
                    hits[d].append(hit)
                kind = pa.list_(pa.struct([("place", pa.int64()), ("hash", pa.int64()), ("words", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts.astype(np.int64)), pa.array(hits, kind)],
                    ["id", "n_words", "hits"],
                )

    kind = dict(df.dtypes)[id_col]
    schema = f"id {kind}, n_words long, hits array<struct<place:long,hash:long,words:string>>"
    return df.select(F.col(id_col).alias("id"), text).mapInArrow(run, schema)


def spans(scanned: DataFrame, templates: tuple[Template, ...], rows: list) -> DataFrame:
    """rid, label, exact, first_word, n_words, coverage of every verified span."""
    spark = scanned.sparkSession
    table = spark.createDataFrame(rows, "template int, position int, k int, hash long, words string")
    about = spark.createDataFrame(
        [(n, t.label, len(t.text.split()), t.share, t.exact) for n, t in enumerate(templates)],
        "template int, label string, size int, share double, exact boolean",
    )
    small = F.broadcast if len(rows) < BROADCAST_ROWS else (lambda x: x)
    votes = (
        scanned.select("rid", F.explode("hits").alias("hit"))
        .select("rid", "hit.*")
        .join(small(table), ["hash", "words"])
        .select("rid", "template", "k", "position", (F.col("place") - F.col("position")).alias("diagonal"))
    )
    # a diagonal has no more votes than its template has positions
    diagonals = votes.groupBy("rid", "template", "diagonal").agg(F.collect_set("position").alias("seen"), F.first("k").alias("k"))
    diagonals = diagonals.join(small(about), "template")
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal", 1, -(10**9)).over(order) > SLACK)
    merged = diagonals.withColumn("apart", apart).withColumn("island", F.sum(F.col("apart").cast("int")).over(order))
    covered = F.array_distinct(F.flatten(F.transform("seen", lambda p: F.sequence(p, p + F.col("k") - 1))))
    low = F.col("diagonal") + F.array_min("seen")
    high = F.col("diagonal") + F.array_max("seen") + F.col("k")
    return (
        merged.select("rid", "template", "label", "exact", "size", "share", "island", low.alias("low"), high.alias("high"), F.explode(covered).alias("word"))
        .groupBy("rid", "template", "label", "exact", "size", "share", "island")
        .agg(F.min("low").alias("first_word"), F.max("high").alias("end_word"), F.countDistinct("word").alias("words"))
        .select("rid", "label", "exact", "first_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "share", (F.col("words") / F.col("size")).alias("coverage"))
        .where("coverage >= share")
    )


def license_scan(
    df: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, id_col: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The rows (rid, id, n_words), and the spans found in them by rid."""
    rows = template_rows(templates)
    scanned = checkpoint(scan(df, rows, id_col, text).withColumn("rid", F.monotonically_increasing_id()))
    return scanned.select("rid", "id", "n_words"), spans(scanned.where(F.size("hits") > 0), templates, rows)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and further license labels of every document."""
    docs, found = license_scan(documents(spark, sf_dir))
    base = F.col("exact")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    each = found.groupBy("rid").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    return docs.join(each, "rid", "left").select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
