"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most four bits if and only if some 64-bit value lies within two bits of
both. Every distinct fingerprint so stands for all its variants within half the radius; equal variants
meet, and each fingerprint that meets there is linked to the least one. A variant's shuffle key is its
leading PREFIX bits: a fingerprint is sent once to each key that one of its variants has (79 rows
instead of 2081), and the variants themselves are made where they meet. A key that holds more than
HOT rows is dealt again by the next PREFIX bits of its variants, and within a task large groups are
split by further bits, so memory stays bounded. Links form stars, never all pairs of a group, and
components come from joins (see graph). Exact copies share one fingerprint and are linked by it.

Null or empty text has fingerprint zero and is linked like any other. Rows are kept as they are,
repeated ones too; an empty table gives an empty result. Rows with a null id get the component's
least id (null if it has none).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import LOWER, SOLID, Words, checkpoint, documents, slices, text_buffer
from gleaner.llm.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
PREFIX, HOT = 12, 400_000
#: Parts in which the members of a component are told its name.
SALTS = 16
#: Variants made at once in a task.
AT_ONCE = 1_000_000


def simhash(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprints of documents: the bits set in over half of the shingles' hashes."""
    data = LOWER[data]
    words = Words(data, offsets, SOLID, hashed=False)
    sizes = words.ends - words.starts
    first = np.concatenate([[0], np.cumsum(sizes + 1)])  # words a space apart
    out = np.full(first[-1], 0x20, np.uint8)
    inside = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
    out[inside + np.arange(len(inside))] = data[SOLID[data]]
    text = out.tobytes()
    n = words.counts
    many = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(many)])
    doc = np.repeat(np.arange(len(n)), many)
    begin = words.first[:-1][doc] + np.arange(at[-1]) - at[:-1][doc]
    end = np.minimum(begin + shingle, words.first[1:][doc]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], seed) for a, b in zip(first[begin].tolist(), (first[end] + sizes[end]).tolist(), strict=True)),
        np.uint64,
        len(begin),
    )
    prints = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(many)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        counts = np.add.reduceat(bits, at[:-1][some], axis=0, dtype=np.int32)
        majority = counts * 2 > many[some, None]
        prints[some] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return prints


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and fp (the 64 bits as a signed long) of every row."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in slices(offsets):
                prints = simhash(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(prints.view(np.int64))], ["id", "fp"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), text).mapInArrow(run, f"id {kind}, fp long")


def flips(low: int, high: int, most: int) -> np.ndarray:
    """Masks of up to most of the bits low to high - 1."""
    found = [sum(1 << b for b in some) for k in range(most + 1) for some in combinations(range(low, high), k)]
    return np.array(found, np.uint64)


def meet(prints: np.ndarray, left: np.ndarray, free: int, at_once: int = AT_ONCE) -> np.ndarray:
    """Links (least, other) of fingerprints with a common variant.

    left: flips that each may still make among its free lowest bits.
    """
    sizes = {r: len(flips(0, free, r)) if free > 24 or r < 2 else 1 + free + free * (free - 1) // 2 for r in set(left.tolist())}
    if len(prints) < 2:
        return np.zeros((0, 2), np.uint64)
    if sum(sizes[r] * int((left == r).sum()) for r in sizes) > at_once and free > 0:
        step = min(4, free)
        rest, links = free - step, []
        own = (prints >> np.uint64(rest)) & np.uint64((1 << step) - 1)
        for value in range(1 << step):
            spent = np.bitwise_count(own ^ np.uint64(value)).astype(np.int64)
            # the bits above are as good as equal from here on; only the lower ones are still made
            if (fits := spent <= left).sum() > 1:
                links.append(meet(prints[fits], left[fits] - spent[fits], rest, at_once))
        return np.unique(np.concatenate(links), axis=0) if links else np.zeros((0, 2), np.uint64)
    low = np.uint64((1 << free) - 1) if free < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
    made, source = [], []
    for r in sizes:
        own = np.flatnonzero(left == r)
        masks = flips(0, free, r)
        made.append(((prints[own] & low)[:, None] ^ masks[None, :]).ravel())
        source.append(np.repeat(own, len(masks)))
    variant, source = np.concatenate(made), np.concatenate(source)
    order = np.argsort(variant)
    variant, who = variant[order], prints[source[order]]
    first = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]]))
    size = np.diff(np.append(first, len(variant)))
    shared = size > 1
    if not shared.any():
        return np.zeros((0, 2), np.uint64)
    keep = np.repeat(shared, size)
    who, size = who[keep], size[shared]
    least = np.repeat(np.minimum.reduceat(who, np.concatenate([[0], np.cumsum(size)[:-1]])), size)
    pairs = np.unique(np.stack([least, who], axis=1)[least != who], axis=0)
    return pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= RADIUS]


def links(prints: DataFrame, prefix: int = PREFIX, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints fp within the radius."""
    half = RADIUS // 2

    def dealt(df: DataFrame, used: int) -> DataFrame:
        """Rows for each value that a variant's next prefix bits can have."""
        masks = flips(0, prefix, half)
        choices = F.array(*(F.struct(F.lit(int(m)).cast("int").alias("m"), F.lit(int(m).bit_count()).alias("n")) for m in masks))
        own = F.shiftrightunsigned("fp", 64 - used - prefix).bitwiseAND((1 << prefix) - 1).cast("int")
        return (
            df.select("fp", "key", "left", own.alias("own"), F.explode(choices).alias("c"))
            .where("c.n <= left")
            .select("fp", F.concat_ws("-", "key", F.col("own").bitwiseXOR(F.col("c.m"))).alias("key"), (F.col("left") - F.col("c.n")).alias("left"))
        )

    first = dealt(prints.select("fp", F.lit("").alias("key"), F.lit(half).alias("left")), 0)
    # at most 2 ** prefix keys
    large = [r.key for r in first.groupBy("key").count().where(F.col("count") > hot).collect()]
    rows = first.withColumn("free", F.lit(64 - prefix))
    if large:
        again = dealt(first.where(F.col("key").isin(large)), prefix).withColumn("free", F.lit(64 - 2 * prefix))
        rows = rows.where(~F.col("key").isin(large)).unionByName(again)

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        found = meet(pdf["fp"].to_numpy().view(np.uint64), pdf["left"].to_numpy().astype(np.int64), int(pdf["free"].iloc[0]))
        return pd.DataFrame({"a": found[:, 0].astype(np.uint64).view(np.int64), "b": found[:, 1].astype(np.uint64).view(np.int64)})

    return rows.groupBy("key").applyInPandas(group, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, fp and component_id (the least id reachable) of every row."""
    prints = checkpoint(fingerprints(df, id_col, text))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    named = checkpoint(distinct.join(roots, "fp", "left").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")))
    # a large component is dealt by salt, for its head's id as for its members; fingerprints without links are their own
    heads = named.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("head"))
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    told = named.join(heads, ["root", "salt"], "left").select("fp", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("head")).alias("component_id"))
    # exact copies share a fingerprint: the prints' side of this join is the one that may be hot, and AQE splits it
    return prints.join(told, "fp", "left")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
