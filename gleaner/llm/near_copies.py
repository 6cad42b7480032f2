"""SimHash near copies above a similarity, by meet-in-the-middle ball hashing of a wide fingerprint.

At a similarity of 0.8 two texts differ in some 15 of 100 fingerprint bits, too many for one ball. So a fingerprint has
PARTS words of 32 bits, each a SimHash of its own of the distinct-or-not shingles of SHINGLE words, and each word has a ball
of half PART_RADIUS around it: two texts meet if any of their words lie within PART_RADIUS bits. Equal variants meet as in
simhash: by the leading bits of a variant first (packed), the variants themselves are made where they meet, in bounded
memory. Of those that meet the least stands for the others that are within FAR bits of it in the whole fingerprint; the
rest goes on among itself. So nothing is paired with all of its group, and what is far from the least is not lost with it.
Links that can't be as similar, by their numbers of shingles and by the parities of 256 shares of these, go no further.
Every such link is verified on the texts: the Jaccard similarity of their sets of shingles, exactly. There are two rounds. In the
first only equal leading bits meet, and each node is verified against the least that it meets there: a few rows a node. In the
second all meet, and only links between classes of the first are made: a group that is one class by then makes no more rows.
Classes are the components of verified links; texts of the same words (ASCII case apart) are one node.

Null and empty texts have no words and are one node. Texts of fewer words than a shingle have one shingle, all their words.
Repeated rows and rows with a null id take part like any other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import LOWER, SOLID, Words, checkpoint, grams, mix, parts, released, sieve, slices, stored, text_buffer
from gleaner.llm.graph import components
from gleaner.llm.simhash import flips

SHINGLE, SIMILARITY = 5, 0.8
PARTS, PART_RADIUS, FAR = 4, 4, 28
#: Nodes packed at once, variants made at once, and nodes aimed at for each leading value.
PACKED, AT_ONCE, AIM = 16_384, 1_000_000, 20_000
#: Shingles whose bits are counted at once, and rows of documents for each file of what is kept of nodes and links.
COUNTED, HELD = 65_536, 10_000
#: What is known of a node's shingles: both halves of the fingerprint, their parities and how many there are.
PRINT = ("one", "two", "parity", "many")
#: The parities of 64 shares of each quarter of the shingles but the last; with it they make parity.
FINE = ("fine0", "fine1", "fine2")
_U = np.uint64


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's shingles, and how many each has."""
    n = words.counts
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(many)])
    doc = np.repeat(np.arange(len(n)), many)
    begin = words.first[:-1][doc] + np.arange(at[-1]) - at[:-1][doc]
    out = np.zeros(len(doc), np.uint64)
    for k in range(1, size + 1):
        own = np.flatnonzero((n[doc] == k) if k < size else (n[doc] >= k))
        if len(own):
            out[own] = grams(words.hashes, k)[begin[own]]
    return out, many


def majorities(hashes: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The bits set in over half of each document's hashes (many of them). Runs of documents are counted in turn: the sums
    take five bytes for each bit of a run."""
    out, edge = np.zeros(len(many), np.uint64), np.append(0, np.cumsum(many))
    for i, j in slices(edge, COUNTED):
        some = i + np.flatnonzero(many[i:j])
        if len(some):
            bits = np.unpackbits(hashes[edge[i] : edge[j]].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
            counts = np.add.reduceat(bits, edge[some] - edge[i], axis=0, dtype=np.int32)
            out[some] = np.packbits(counts * 2 > many[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def wide_prints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """Node (a hash of the words), the two halves of the fingerprint, the parities of 64 shares of the different shingles
    and how many of these there are, of every document."""
    return fine_prints(data, offsets, size)[:5]


def fine_prints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """What wide_prints() gives, and the parities of each quarter of the shingles but the last."""
    words = Words(LOWER[data], offsets, SOLID)
    raw = words.hashes.tobytes()
    node = [xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)]
    hashes, many = shingles(words, size)
    some, halves = np.flatnonzero(many), [majorities(mix(hashes + _U(turn)), many) for turn in (0, 1)]
    doc = np.repeat(np.arange(len(many)), many)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    other = np.append(True, (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1]))[: len(doc)]
    hashes, doc = hashes[other], doc[other]
    kinds, parity = np.bincount(doc, minlength=len(many)), np.zeros((1 + len(FINE), len(many)), np.uint64)
    if len(doc):
        mixed, begin = mix(hashes), (np.cumsum(kinds) - kinds)[some]
        share, quarter = _U(1) << (mixed >> _U(58)), (mixed >> _U(56)) & _U(3)
        parity[0, some] = np.bitwise_xor.reduceat(share, begin)
        for k in range(len(FINE)):
            parity[1 + k, some] = np.bitwise_xor.reduceat(np.where(quarter == k, share, _U(0)), begin)
    return np.array(node, np.uint64), halves[0], halves[1], parity[0], kinds.astype(np.uint64), *parity[1:]


def differing(parity: np.ndarray, fine: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many parities of rows x and y differ: of 64 shares, or of 256 where the quarters are known."""
    if not fine:
        return np.bitwise_count(parity[x] ^ parity[y])
    return sum(np.bitwise_count(q[x] ^ q[y]).astype(np.int64) for q in (*fine, np.bitwise_xor.reduce([parity, *fine])))


def similar(x: np.ndarray, y: np.ndarray, apart: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of x and y shingles may be as similar, if the parities of apart of their shares differ.

    Each shingle that only one of them has changes one parity, so none that are as similar are left out.
    """
    return (np.minimum(x, y) >= similarity * np.maximum(x, y) - 1e-6) & (apart <= (x + y) * (1 - similarity) / (1 + similarity) + 1e-6)


def fingerprints(df: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """id, spelling (a hash of the text as it is), node, both halves of the fingerprint, parities (of quarters too) and count of the shingles of every row."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for i, j in slices(offsets):
                found = fine_prints(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                own = [batch.column(k).slice(i, j - i) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(x.view(np.int64)) for x in found)], ["id", "spelling", "node", *PRINT, *FINE])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), spelling(text).alias("spelling"), F.col(text).alias("text")).mapInArrow(
        released(run), f"id {kind}, spelling long, node long, " + ", ".join(f"{c} long" for c in (*PRINT, *FINE))
    )


def spelling(text: str) -> F.Column:
    """Tells texts apart, null from empty too."""
    return F.xxhash64(F.col(text).isNull(), text)


def colliding(values: np.ndarray, left: np.ndarray, free: int, at_once: int = AT_ONCE, who: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that have a variant in common, by variant, and how many each variant has.

    left: flips that a row may still make among its free lowest bits.
    """
    who = np.arange(len(values)) if who is None else who
    if len(values) < 2:
        return
    ball = [1, 1 + free, 1 + free + free * (free - 1) // 2]
    if sum(ball[r] * int((left == r).sum()) for r in range(3)) > at_once and free > 0:
        step = min(4, free)
        own = (values >> _U(free - step)) & _U((1 << step) - 1)
        for value in range(1 << step):
            spent = np.bitwise_count(own ^ _U(value)).astype(np.int64)
            # the bits above are as good as equal from here on; only the lower ones are still made
            if (fits := spent <= left).sum() > 1:
                yield from colliding(values[fits], left[fits] - spent[fits], free - step, at_once, who[fits])
        return
    made, source = [], []
    for r in range(3):
        own = np.flatnonzero(left == r)
        masks = flips(0, free, r)
        made.append(((values[own] & _U((1 << free) - 1))[:, None] ^ masks[None, :]).ravel())
        source.append(np.repeat(own, len(masks)))
    variant, source = np.concatenate(made), np.concatenate(source)
    order = np.argsort(variant)
    variant, source = variant[order], source[order]
    first = np.flatnonzero(np.append(True, variant[1:] != variant[:-1]))
    size = np.diff(np.append(first, len(variant)))
    keep = np.repeat(size > 1, size)
    if keep.any():
        yield who[source[keep]], size[size > 1]


def stars(who: np.ndarray, size: np.ndarray, node: np.ndarray, one: np.ndarray, two: np.ndarray, far: int) -> np.ndarray:
    """Links (least, other) of rows who, in groups of these sizes: the least takes those near it, the rest goes on."""
    group = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((node[who], group))
    who, group, out = who[order], group[order], []
    while len(who):
        opens = np.append(True, group[1:] != group[:-1])
        head = who[np.maximum.accumulate(np.where(opens, np.arange(len(who)), 0))]
        near = np.bitwise_count(one[who] ^ one[head]).astype(np.int16) + np.bitwise_count(two[who] ^ two[head]) <= far
        out.append(np.column_stack([head[near & ~opens], who[near & ~opens]]))
        who, group = who[~near], group[~near]
        lone = np.append(True, group[1:] != group[:-1]) & np.append(group[1:] != group[:-1], True)
        who, group = who[~lone[: len(who)]], group[~lone[: len(who)]]
    return np.unique(np.concatenate([np.zeros((0, 2), np.int64), *out]), axis=0)


def candidates(nodes: DataFrame, far: int = FAR, lead: int | None = None, at_once: int = AT_ONCE, similarity: float = SIMILARITY, own: bool = False) -> DataFrame:
    """Links (a, b) of nodes (node, one, two, parity, many; quarters of the parity and a class, root, if known) that a variant of
    some word brings together and that may be as similar, but for those within a class (0 is none).

    own: only of nodes with equal leading bits, and of each node b there only the link to the least a.
    """
    half = PART_RADIUS // 2
    lead = lead or max(6, min(16, ceil(log2(max(2, nodes.count()) / AIM))))
    masks = flips(0, lead, 0 if own else half)
    spent = np.bitwise_count(masks).astype(np.int64)
    known = [c for c in (*PRINT, *FINE, "root") if c in nodes.columns]
    kinds = {"node": "<i8"} | {c: {"many": "<u4", "root": "<i8"}.get(c, "<u8") for c in known}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PACKED):
                about = {c: batch.column(c).slice(at, PACKED).to_numpy() for c in kinds}
                for part in range(PARTS):
                    word = (about[("one", "two")[part // 2]].view(np.uint64) >> _U(32 * (part % 2))) & _U(0xFFFFFFFF)
                    key = ((word >> _U(32 - lead))[:, None] ^ masks[None, :]).ravel().astype(np.int64)
                    order = np.argsort(key, kind="stable")
                    edge, row = np.searchsorted(key[order], np.arange((1 << lead) + 1)), order // len(masks)
                    left = (half - spent)[order % len(masks)].astype(np.uint8)
                    used = np.flatnonzero(np.diff(edge)).tolist()
                    columns = *(about[c][row].astype(kind) if c == "many" else about[c][row] for c, kind in kinds.items()), left
                    packs = [pa.array([x[edge[k] : edge[k + 1]].tobytes() for k in used], pa.binary()) for x in columns]
                    keys = pa.array([(part << lead) + k for k in used], pa.int32())
                    yield pa.RecordBatch.from_arrays([keys, *packs], ["key", *kinds, "left"])

    def meet(key, table):
        joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        about = {c: joined(c, kind) for c, kind in kinds.items()}
        node, one, two, parity = (about[c] for c in ("node", *PRINT[:3]))
        many, fine, root = about["many"].astype(np.int64), [about[c] for c in FINE if c in about], about.get("root")
        part = key[0].as_py() >> lead
        word = ((one, two)[part // 2] >> _U(32 * (part % 2))) & _U((1 << 32 - lead) - 1)

        def least(pairs):
            pairs = np.unique(pairs, axis=0)
            if not own:
                return pairs
            pairs = pairs[np.lexsort((node[pairs[:, 0]], pairs[:, 1]))]
            return pairs[np.append(True, pairs[1:, 1] != pairs[:-1, 1])[: len(pairs)]]

        found = [np.zeros((0, 2), np.int64)]
        for who, size in colliding(word, joined("left", np.uint8).astype(np.int64), 32 - lead, at_once):
            pairs = stars(who, size, node, one, two, far)
            if root is not None:
                x, y = root[pairs.T]
                pairs = pairs[(x != y) | (x == 0)]
            x, y = pairs.T
            found.append(pairs[similar(many[x], many[y], differing(parity, fine, x, y), similarity)])
            if len(found) > 64:
                found = [least(np.concatenate(found))]
        pairs = least(np.concatenate(found))
        return pa.table({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    packed = nodes.select(*kinds).mapInArrow(released(run), "key int, " + ", ".join(f"{c} binary" for c in (*kinds, "left")))
    met = packed.groupBy("key").applyInArrow(meet, "a long, b long").where("a <> b")
    return met.groupBy("b").agg(F.min("a").alias("a")).select("a", "b") if own else met.distinct()


def texts_of(df: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """node and compressed text of these nodes (node), one text for each."""
    wanted = sieve(nodes)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for i, j in slices(offsets):
                own, at = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
                words = Words(own, at, SOLID)
                raw = words.hashes.tobytes()
                node = [xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)]
                node, first = np.unique(np.array(node, np.uint64).view(np.int64), return_index=True)
                some = wanted(node)
                packed = [zstandard.compress(own[at[k] : at[k + 1]].tobytes(), 3) for k in first[some].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(packed, pa.binary())], ["node", "packed"])

    # the other copies of a node go before the join
    return df.select(text).mapInArrow(released(run), "node long, packed binary").dropDuplicates(["node"]).join(nodes, "node", "left_semi")


def verified(near: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those of the links (a, b) whose texts are as similar; a bucket of links is sent a text once."""
    buckets = 4 * parts(near.sparkSession)
    bucket = F.pmod(F.xxhash64("a", F.lit(5)), F.lit(buckets)).cast("int").alias("bucket")
    members = near.select(bucket, F.col("a").alias("node")).distinct().unionAll(near.select(bucket, F.col("b").alias("node")).distinct()).distinct()
    sent = texts.join(members, "node").select("bucket", "node", "packed")

    def run(links, held):
        sets = {}
        for node, packed in zip(held.column("node").to_pylist(), held.column("packed").to_pylist(), strict=True):
            data = np.frombuffer(zstandard.decompress(packed), np.uint8)
            sets[node] = np.unique(shingles(Words(data, np.array([0, len(data)]), SOLID), size)[0])
        got = []
        for a, b in zip(links.column("a").to_pylist(), links.column("b").to_pylist(), strict=True):
            x, y = sets[a], sets[b]
            # what has too few shingles can't be as similar
            few, many = sorted((len(x), len(y)))
            both = len(np.intersect1d(x, y, assume_unique=True)) if few >= similarity * many else 0
            got.append(both >= similarity * (few + many - both))
        return pa.table({"a": links.column("a"), "b": links.column("b")}).filter(pa.array(got, pa.bool_()))

    return near.select(bucket, "a", "b").groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(run, "a long, b long")


def few(df: DataFrame, rows: int) -> DataFrame:
    """In no more parts than one for HELD rows of documents, or four a core: a small table is not strewn over a file for each
    shuffle partition. Each file takes buffers of the executor, and processes that set its mode on a local disk."""
    return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, ceil(rows / HELD)))


def true_links(df: DataFrame, text: str, near: DataFrame, size: int, similarity: float, rows: int) -> DataFrame:
    """Those of the links (a, b) whose texts, found in df, are as similar. rows: how many df has."""
    near = stored(few(near, rows), "copies-near")
    wanted = near.select(F.col("a").alias("node")).distinct().unionAll(near.select(F.col("b").alias("node")).distinct()).distinct()
    wanted = stored(few(wanted, rows), "copies-wanted")
    return verified(near, stored(few(texts_of(df, text, wanted), rows), "copies-texts"), size, similarity)


def near_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """id, spelling, node and root (the class) of every row."""
    prints = stored(fingerprints(df, id_col, text, size), "copies-prints")
    rows = prints.count()
    held = lambda now: checkpoint(few(now, rows))
    nodes = stored(few(prints.groupBy("node").agg(*(F.first(c).alias(c) for c in (*PRINT, *FINE))), rows), "copies-nodes")
    one = components(true_links(df, text, candidates(nodes, similarity=similarity, own=True), size, similarity, rows), held)
    # of what this joins, no further link is made
    told = stored(few(nodes.join(one, "node", "left").fillna(0, ["root"]), rows), "copies-told")
    links = true_links(df, text, candidates(told, similarity=similarity), size, similarity, rows)
    # a class of the first round is known by its root's links
    roots = components(one.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links), held)
    return prints.join(roots, "node", "left").select("id", "spelling", "node", F.coalesce("root", "node").alias("root"))


def heads(df: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of df, with all their columns: one of each class, that of least id (then of least spelling; null ids last).

    The row is known by id and text; of rows that repeat both, one stays.
    """
    rows = near_copies(df, id_col, text, **how)
    order = F.struct(F.col("id").isNull(), "id", "spelling")
    least = rows.groupBy("root").agg(F.min(order).alias("m"), F.count("*").alias("n")).select(F.col("m.id").alias("_id"), F.col("m.spelling").alias("_spelling"), "root")
    kept = stored(few(least, df.count()), "copies-heads")
    own = (df[id_col].eqNullSafe(kept["_id"])) & (spelling(text) == kept["_spelling"])
    found = df.join(kept, own, "left_semi")
    again = rows.join(kept, rows["id"].eqNullSafe(kept["_id"]) & (rows["spelling"] == kept["_spelling"]), "left_semi").groupBy("id", "spelling").count().where("count > 1")
    return found if again.isEmpty() else found.dropDuplicates([id_col, text])
