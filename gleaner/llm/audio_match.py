"""Chroma audio fingerprints of a media column, and recordings aligned by them.

Samples become frames, frames become the energy of the twelve pitch classes (a byte each), and filters over the integral
image of these give a 32-bit integer for each window of WINDOW frames (16 filters, two bits each). All from the frames on is
integer arithmetic, so equal frames give equal integers wherever they stand. The integers' landmarks (the least hash of
every LANDMARKS keys of KEY consecutive integers) meet by hash range, packed; those that several nodes (distinct fingerprints)
have are stored by class of the node (a hash's), and so are the nodes' frames. Each pair of classes is read by one task, which
has all that two nodes share: offsets at which landmarks agree (VOTES of them, or all landmarks of one that has fewer) with an
overlap of at least SHARE of the shorter one. At the offset with most votes the bits that differ over the whole overlap decide.
A link: at most ERRORS of the bits wrong. No vote is left out, however common a landmark is: comparisons grow with the square
of a group, but rows and what is stored do not, as a task gives the number of links of each node and stars that join the same
nodes. Classes of linked nodes are the components. Runs of LANDMARKS + KEY - 1 equal integers always share a landmark, if the sound
moves there: keys of a steady sound are no landmarks, but for the first one of a recording that has no others.

Integers are never stored: they are made again of the compressed frames where they are needed, in a task for those nodes that
have something to verify there.

The test tables hold no audio. The query therefore plays the texts of ``documents``: tones() gives a note
to every word, so copies sound alike and edits change a few notes.

Null or empty media, and those shorter than a window, have no integers and no links. Equal ones are one node, by a
hash of the media; a null or empty one is a class of its own. Repeated rows have equal fingerprints and share a class. A row
with a null id takes part like any other; its class is named by the least id in it (null if there is none). An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import LOWER, SOLID, Words, documents, fresh_path, mix, parts, slices, stored, text_buffer
from gleaner.llm.graph import components

#: Samples a second, samples of a frame, and the lowest note's bin.
RATE, FRAME, LOWEST = 4096, 128, 20
WINDOW, KEY, LANDMARKS = 12, 2, 4
#: What the energies of a frame's pitch classes add up to, windows made at once, and frames unpacked at once.
UNIT, CHUNK, UNPACKED = 255, 8192, 1 << 17
#: Levels of a filter's value; none is a value that equal areas have.
LEVELS = (-0.23, 0.013, 0.27)
SHARE, ERRORS, VOTES = 0.8, 0.15, 2
#: Landmarks that a task holds before it sends them.
HELD = 1_000_000
#: Integers, about, of the nodes of a class; classes at least; pairs of classes compared in one job.
CLASS, CLASSES, ROUND = 10 << 20, 4, 256
#: Votes summed at once, pairs verified at once, and pairs (or integers of pairs) made at once.
SUMMED, VERIFIED, PAIRS = 2 << 20, 1 << 18, 1 << 18
#: Parts in which the members of a class are told its name.
SALTS = 16

#: What is packed of the landmarks of a shard that several nodes of a class have: steps of the key's number, a table of nodes and
#: their integers (negative if they have fewer than VOTES landmarks), and each landmark's node and place.
SETS = {"numbers": "<i4", "nodes": "<i8", "sizes": "<i4", "index": "<i4", "places": "<i4"}

Scan = Callable[[Callable[[Iterator], Iterator], str], DataFrame]


def chroma_of_bins() -> np.ndarray:
    """The pitch class of each bin of a frame's spectrum, as a matrix."""
    out = np.zeros((FRAME // 2 + 1, 12), np.float32)
    for k in range(LOWEST // 2, FRAME // 2):
        out[k, round(12 * np.log2(k / LOWEST)) % 12] = 1
    return out


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first band, bands, frames) of the sixteen filters."""
    return [(i % 4, (5 * i) % 12, 2 + 2 * (i // 4 % 3), WINDOW - 2 * (i % 3)) for i in range(16)]


def notes() -> np.ndarray:
    """A frame of samples for each pitch class."""
    bins = np.round(LOWEST * 2 ** (np.arange(12) / 12))
    return (8000 * np.sin(2 * np.pi * bins[:, None] * np.arange(FRAME) / FRAME)).astype(np.int16)


def chroma(samples: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pitch-class frames of recordings (each class's share of UNIT), and each one's first frame."""
    count = np.diff(first) // FRAME
    at = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    begin = first[doc] + (np.arange(at[-1]) - at[doc]) * FRAME
    out = np.zeros((at[-1], 12), np.uint8)
    bands = chroma_of_bins()
    for i in range(0, len(begin), 8192):
        frames = samples[begin[i : i + 8192, None] + np.arange(FRAME)].astype(np.float32)
        spectrum = np.fft.rfft(frames, axis=1)
        energy = (spectrum.real**2 + spectrum.imag**2) @ bands
        out[i : i + 8192] = np.rint(UNIT * energy / np.maximum(energy.sum(1, keepdims=True), 1e-9))
    return out, at


#: The frame of each note, as chroma() hears it.
_HEARD = chroma(notes().ravel(), np.array([0, 12 * FRAME]))[0]


def tones(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pitch-class frames of texts, a note for every word, and each one's first frame."""
    data, offsets = text_buffer(column)
    words = Words(LOWER[data], offsets, SOLID)
    pitch = (words.hashes >> np.uint64(8)) % np.uint64(12)
    return _HEARD[pitch.astype(np.int64)], words.first - words.first[0]


def pcm16(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pitch-class frames of binary 16-bit mono recordings, and each one's first; an odd last byte is left out."""
    found = [np.frombuffer((x or b"")[: len(x or b"") // 2 * 2], "<i2") for x in column.to_pylist()]
    return chroma(np.concatenate([np.zeros(0, np.int16), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64))


def windows(image: np.ndarray, n: int) -> np.ndarray:
    """The integers of the first n windows of an integral image (bands, frames)."""
    out = np.zeros(n, np.uint32)

    def area(a, b, low, high):
        """Sum over frames t + a to t + b and bands low to high, which go on from 11 to 0."""
        if high > 12:
            return area(a, b, low, 12) + area(a, b, 0, high - 12)
        up, down = image[high], image[low]
        return up[b : b + n] - up[a : a + n] - down[b : b + n] + down[a : a + n]

    for i, (kind, low, bands, width) in enumerate(filters()):
        mid, half, high = low + bands // 2, width // 2, low + bands
        m, rest = mid - 12 if mid >= 12 else mid, bands - bands // 2
        if kind == 0:
            x, y = area(0, width, low, high), area(0, width, 0, 12) * np.float32(bands / 12)
        elif kind == 1:
            x, y = area(0, width, low, mid), area(0, width, m, m + rest)
        elif kind == 2:
            x, y = area(0, half, low, high), area(half, width, low, high)
        else:
            x = area(0, half, low, mid) + area(half, width, m, m + rest)
            y = area(half, width, low, mid) + area(0, half, m, m + rest)
        x, y = (x + UNIT).astype(np.float32), (y + UNIT).astype(np.float32)
        low_edge, mid_edge, high_edge = (x >= np.float32(np.exp(edge)) * y for edge in LEVELS)
        # the levels 0 to 3 in Gray code: 0, 1, 3, 2
        out |= (low_edge ^ high_edge).astype(np.uint32) << np.uint32(2 * i)
        out |= mid_edge.astype(np.uint32) << np.uint32(2 * i + 1)
    return out


def integers(frames: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed integers of all windows, and each recording's first."""
    count = np.maximum(np.diff(at) - WINDOW + 1, 0)
    first = np.concatenate([[0], np.cumsum(count)])
    n = len(frames) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.uint32), first
    image = np.zeros((13, len(frames) + 1), np.int32)  # sums wrap, their differences are small
    for k, band in enumerate(np.ascontiguousarray(frames.T)):
        np.cumsum(band, dtype=np.int32, out=image[k + 1, 1:])
        image[k + 1] += image[k]
    every = np.empty(n, np.uint32)  # windows that cross recordings too; these are left out below
    for i in range(0, n, CHUNK):
        every[i : i + CHUNK] = windows(image[:, i : i + CHUNK + WINDOW], min(CHUNK, n - i))
    doc = np.repeat(np.arange(len(count)), count)
    return every[at[doc] + np.arange(first[-1]) - first[doc]], first


def marked(ints: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, recording and place of all recordings' landmarks."""
    many = np.maximum(np.diff(first) - KEY + 1, 0)
    begin = np.concatenate([[0], np.cumsum(many)])
    doc = np.repeat(np.arange(len(many)), many)
    place = np.arange(begin[-1]) - begin[doc]
    key, at = np.zeros(len(doc), np.uint64), first[doc] + place
    for k in range(KEY):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + ints[at + k])
    chosen = np.zeros(len(key), bool)
    if (n := len(key) - LANDMARKS + 1) > 0:
        least, which = key[:n].copy(), np.zeros(n, np.int64)
        for k in range(1, LANDMARKS):
            less = key[k : k + n] < least
            least[less], which[less] = key[k : k + n][less], k
        inside = np.flatnonzero(place[:n] + LANDMARKS <= many[doc[:n]])
        chosen[inside + which[inside]] = True
    few = np.flatnonzero(many[doc] < LANDMARKS)  # recordings with fewer keys: the least one
    order = few[np.lexsort((few, key[few], doc[few]))]
    chosen[order[np.append(True, doc[order][1:] != doc[order][:-1])[: len(order)]]] = True
    # a steady sound says nothing of places: its keys are left out, but for the first of a recording that has no others
    steady = np.ones(len(key), bool)
    for k in range(1, KEY):
        steady &= ints[at] == ints[at + k]
    moving = np.bincount(doc[chosen & ~steady], minlength=len(many)) > 0
    lone = np.flatnonzero(chosen & ~moving[doc])
    chosen &= ~steady
    chosen[lone[np.append(True, doc[lone][1:] != doc[lone][:-1])[: len(lone)]]] = True
    at = np.flatnonzero(chosen)
    return key[at], doc[at], place[at]


def landmarks(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and places of one recording's landmarks."""
    key, _, place = marked(ints, np.array([0, len(ints)]))
    return key, place


def nodes_of(frames: np.ndarray, at: np.ndarray, sound: np.ndarray) -> np.ndarray:
    """The node of each recording: a hash of its frames, or sound if they are fewer than a window."""
    raw = frames.tobytes()
    node = [xxhash.xxh3_64_intdigest(raw[12 * a : 12 * b]) if b - a >= WINDOW else 0 for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return np.where(np.diff(at) >= WINDOW, np.array(node, np.uint64).view(np.int64), sound)


#: Tells frames apart by one product (packed_frames looks whether it does).
_MIXED = mix(np.arange(1, 13, dtype=np.uint64))


def kinds_of(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The different frames and which of these each is, if they are few."""
    _, at, which = np.unique(frames @ _MIXED, return_index=True, return_inverse=True)
    kinds, which = frames[at], which.astype(np.uint8)
    return (kinds, which) if len(kinds) <= 256 and np.array_equal(kinds[which], frames) else None


def packed_frames(frames: np.ndarray, found: tuple[np.ndarray, np.ndarray] | None = None) -> bytes:
    """Frames, compressed; if few differ, as their numbers in a list of these (found, if it is known)."""
    found = found or kinds_of(frames)
    kinds, which = found or (frames, None)
    if found is None:
        body = b"\x00" + frames.tobytes()
    elif len(kinds) <= 16:
        body = bytes([len(kinds)]) + kinds.tobytes() + (np.append(which, np.uint8(0))[: (len(which) + 1) // 2 * 2].reshape(-1, 2) @ np.array([1, 16], np.uint8)).tobytes()
    else:
        body = bytes([17, len(kinds) - 1]) + kinds.tobytes() + which.tobytes()
    return len(frames).to_bytes(4, "little") + zstandard.compress(body, 1)


def unpacked_frames(x: bytes) -> np.ndarray:
    n, body = int.from_bytes(x[:4], "little"), zstandard.decompress(x[4:])
    if body[0] == 0:
        return np.frombuffer(body, np.uint8, offset=1).reshape(-1, 12)
    many, at = (body[0], 1) if body[0] <= 16 else (body[1] + 1, 2)
    kinds, which = np.frombuffer(body, np.uint8, 12 * many, at).reshape(-1, 12), np.frombuffer(body, np.uint8, offset=at + 12 * many)
    if body[0] <= 16:
        which = np.column_stack([which & 15, which >> 4]).ravel()[:n]
    return kinds[which]


def sound_of(media: str) -> F.Column:
    """A hash of the media; null for null and empty ones."""
    return F.when(F.octet_length(media) > 0, F.xxhash64(F.lit("media"), media)).alias("sound")


def fingerprints(df: DataFrame, id_col: str, media: str, decode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]] = pcm16) -> DataFrame:
    """id, n_frames, n_ints and node (null for null and empty media) of every recording."""

    def run(batches):
        for batch in batches:
            column, sound = batch.column(1), batch.column(2)
            _, offsets = text_buffer(column)
            for i, j in slices(offsets):
                frames, at = decode(column.slice(i, j - i))
                none = sound.slice(i, j - i).is_null().to_numpy(zero_copy_only=False)
                node, many = nodes_of(frames, at, sound.slice(i, j - i).fill_null(0).to_numpy()), np.diff(at)
                n_ints = np.maximum(many - WINDOW + 1, 0)
                counts = [pa.array(x.astype(np.int64)) for x in (many, n_ints)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *counts, pa.array(node, mask=none & (n_ints == 0))], ["id", "n_frames", "n_ints", "node"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(media).alias("media"), sound_of(media)).mapInArrow(
        run, f"id {kind}, n_frames long, n_ints long, node long"
    )


def hearing(df: DataFrame, media: str, decode: Callable = pcm16) -> Scan:
    """Runs a function over the recordings: it is given nodes, frames and each one's first frame, of some at a time."""

    def scan(f: Callable, schema: str) -> DataFrame:
        def heard(batches):
            for batch in batches:
                column, sound = batch.column(0), batch.column(1)
                _, offsets = text_buffer(column)
                for i, j in slices(offsets):
                    frames, at = decode(column.slice(i, j - i))
                    yield nodes_of(frames, at, sound.slice(i, j - i).fill_null(0).to_numpy()), frames, at

        return df.select(F.col(media).alias("media"), sound_of(media)).mapInArrow(lambda batches: f(heard(batches)), schema)

    return scan


def hearing_frames(nodes: DataFrame) -> Scan:
    """The same over node and frames (binary)."""

    def scan(f: Callable, schema: str) -> DataFrame:
        def heard(batches):
            for batch in batches:
                found = [np.frombuffer(x, np.uint8).reshape(-1, 12) for x in batch.column(1).to_pylist()]
                at = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
                frames = np.concatenate([np.zeros((0, 12), np.uint8), *found])
                yield batch.column(0).to_numpy(), frames, at

        return nodes.select("node", "frames").mapInArrow(lambda batches: f(heard(batches)), schema)

    return scan


def planes(x: np.ndarray) -> bytes:
    """Compressed numbers, byte by byte of all of them."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())


def unplaned(x: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def class_of(nodes: np.ndarray, classes: int) -> np.ndarray:
    """The class of each node: a hash's, so classes are of one size."""
    return (mix(nodes.view(np.uint64) + np.uint64(classes)) % np.uint64(classes)).astype(np.int32)


def class_frames(scan: Scan, classes: int) -> DataFrame:
    """Compressed frames of nodes, by class; a node that several tasks hear may come again."""

    def run(heard):
        seen = np.zeros(0, np.int64)
        for node, frames, at in heard:
            fresh = np.zeros(len(node), bool)
            fresh[np.unique(node, return_index=True)[1]] = True
            some = np.flatnonzero(fresh & (np.diff(at) >= WINDOW) & ~np.isin(node, seen))
            seen = np.union1d(seen, node[some])
            found = kinds_of(frames)
            if found and len(found[0]) > 16:  # a node has fewer, perhaps
                found = None
            packed = [packed_frames(frames[a:b], found and (found[0], found[1][a:b])) for a, b in zip(at[some].tolist(), at[some + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(class_of(node[some], classes)), pa.array(node[some], pa.int64()), pa.array(packed, pa.binary())], ["class", "node", "frames"])

    frames = scan(run, "class int, node long, frames binary")
    return frames.select("*", F.lit(None).cast("int").alias("shard"), *(F.lit(None).cast("binary").alias(c) for c in SETS))


def stored_frames(rows: DataFrame) -> Scan:
    """Runs a function over stored compressed frames (node, frames), some at a time."""

    def scan(f: Callable, schema: str) -> DataFrame:
        def heard(batches):
            for batch in batches:
                node, at = batch.column(0).to_numpy(), 0
                held, n = [], 0
                for i, x in enumerate(batch.column(1).to_pylist()):
                    held.append(unpacked_frames(x))
                    n += len(held[-1])
                    if n >= UNPACKED or i == len(node) - 1:
                        yield node[at : i + 1], np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
                        held, n, at = [], 0, i + 1

        return rows.where("frames IS NOT NULL").select("node", "frames").mapInArrow(lambda batches: f(heard(batches)), schema)

    return scan


def shared_landmarks(scan: Scan, shards: int, classes: int) -> DataFrame:
    """Landmarks that several nodes have, packed by shard and class of the node: which key of its shard, which node, and place."""
    kinds = {"keys": "<u4", "nodes": "<i8", "counts": "<u4", "places": "<u4", "sizes": "<i4"}

    def send(held):
        keys, nodes, places, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
        shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        order = np.argsort(shard, kind="stable")
        # within a shard the lower half of the key is enough: what else meets is told apart by its bits
        keys = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
        nodes, places, sizes = nodes[order], places[order], sizes[order]
        edge = np.searchsorted(shard[order], np.arange(shards + 1))
        rows = []
        for s in np.flatnonzero(np.diff(edge)).tolist():
            own = slice(edge[s], edge[s + 1])
            start = np.flatnonzero(np.append(True, nodes[own][1:] != nodes[own][:-1]))
            counts = np.diff(np.append(start, edge[s + 1] - edge[s]))
            columns = keys[own], nodes[own][start], counts, places[own], sizes[own][start]
            rows.append((s, *(planes(x.astype(k)) for x, k in zip(columns, kinds.values(), strict=True))))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(x, pa.binary()) for x in columns[1:])], ["shard", *kinds])

    def run(heard):
        held, n = [], 0
        for node, frames, at in heard:
            ints, first = integers(frames, at)
            key, doc, place = marked(ints, first)
            size = np.diff(first)
            size = np.where(np.bincount(doc, minlength=len(node)) < VOTES, -size, size)
            if len(key):
                held.append((key, node[doc], place.astype(np.int32), size[doc].astype(np.int32)))
                n += len(key)
            if n >= HELD:
                yield from send(held)
                held, n = [], 0
        if held:
            yield from send(held)

    def meet(key, table):
        found = []
        for row in zip(*(table.column(c).to_pylist() for c in kinds), strict=True):
            keys, nodes, counts, places, sizes = (unplaned(x, k) for x, k in zip(row, kinds.values(), strict=True))
            each = lambda x, n=counts.astype(np.int64): np.repeat(x, n)
            found.append((keys, each(nodes), places, each(sizes)))
        keys, nodes, places, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        # most keys are one node's alone: only what meets goes on
        order = np.argsort(keys, kind="stable")
        alone = keys[order]
        again = np.append(False, alone[1:] == alone[:-1])
        order = order[again | np.append(again[1:], False)]
        del alone, again
        keys, nodes, places, sizes = (x[order] for x in (keys, nodes, places, sizes))
        order = np.lexsort((places, nodes, keys))
        keys, nodes, places, sizes = (x[order] for x in (keys, nodes, places, sizes))
        again = np.append(False, (keys[1:] == keys[:-1]) & (nodes[1:] == nodes[:-1]) & (places[1:] == places[:-1]))[: len(keys)]
        keys, nodes, places, sizes = (x[~again] for x in (keys, nodes, places, sizes))
        group = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        end = np.append(group[1:], len(keys))[: len(group)]
        shared = nodes[end - 1] != nodes[group]
        keep, number = np.repeat(shared, end - group), np.repeat(np.cumsum(shared) - 1, end - group)
        number, nodes, places, sizes = number[keep], nodes[keep], places[keep], sizes[keep]
        of, rows = class_of(nodes, classes), []
        for c in np.unique(of).tolist():
            own = np.flatnonzero(of == c)
            table_of, at, index = np.unique(nodes[own], return_index=True, return_inverse=True)
            columns = np.diff(number[own], prepend=0), table_of, sizes[own][at], index, places[own]
            rows.append((c, key[0].as_py(), *(planes(x.astype(k)) for x, k in zip(columns, SETS.values(), strict=True))))
        names = ["class", "shard", *SETS]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.table({n: pa.array(x, pa.int32() if n in ("class", "shard") else pa.binary()) for n, x in zip(names, columns, strict=True)})

    packed = scan(run, "shard int, " + ", ".join(f"{c} binary" for c in kinds))
    met = packed.groupBy("shard").applyInArrow(meet, "class int, shard int, " + ", ".join(f"{c} binary" for c in SETS))
    return met.select("class", F.lit(None).cast("long").alias("node"), F.lit(None).cast("binary").alias("frames"), "shard", *SETS)


def heads(one: tuple, other: tuple, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each key and node a of one that any node b > a of other has a vote for, where these begin in other, and how many they are.

    Both are key and node (key * total + node, in order), node, and place.
    """
    code = one[0]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
    low, high = (np.searchsorted(other[0], x) for x in (code[first] + 1, (code[first] // total + 1) * total))
    some = high > low
    return first[some].astype(np.int32), low[some].astype(np.int32), (high - low)[some].astype(np.int32)


def pairings(one: tuple, other: tuple, heads: tuple[np.ndarray, np.ndarray, np.ndarray], sizes: np.ndarray):
    """Nodes a of one and b > a of other that share a key, and the offset, some at a time: each place of b against a's first place,
    if they overlap enough."""
    (_, who, place), (first, low, many) = one, heads
    turn = np.cumsum(many, dtype=np.int64) // PAIRS
    for own in np.split(np.arange(len(first)), np.flatnonzero(turn[1:] != turn[:-1]) + 1):
        m = many[own].astype(np.int64)
        y = np.repeat(low[own] - np.cumsum(m) + m, m) + np.arange(m.sum())
        x = np.repeat(first[own], m)
        a, b, p, q = who[x], other[1][y], place[x], other[2][y]
        m, n = sizes[a], sizes[b]
        fits = np.minimum(p, q) + np.minimum(m - p, n - q) >= SHARE * np.minimum(m, n)
        yield a[fits].astype(np.int64), b[fits].astype(np.int64), (q - p)[fits].astype(np.int64)


def integers_of(packed: list[bytes]) -> list[np.ndarray]:
    """The integers of compressed frames, made for some recordings at a time."""
    out: list[np.ndarray] = []
    held, n = [], 0
    for i, x in enumerate(packed):
        held.append(unpacked_frames(x))
        n += len(held[-1])
        if n >= UNPACKED or i == len(packed) - 1:
            ints, first = integers(np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64))
            out += [ints[a:b].copy() for a, b in zip(first[:-1], first[1:], strict=True)]
            held, n = [], 0
    return out


def errors(x: np.ndarray, y: np.ndarray, offset: int) -> tuple[float, float]:
    """Share of the shorter fingerprint that overlaps if y starts offset before x, and share of wrong bits there."""
    low, high = max(0, -offset), min(len(x), len(y) - offset)
    if high <= low:
        return 0.0, 1.0
    wrong = np.bitwise_count(x[low:high] ^ y[low + offset : high + offset]).sum()
    return (high - low) / min(len(x), len(y)), float(wrong) / (32 * (high - low))


def all_errors(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """errors() of many pairs of nodes, whose integers are size of flat from begin on, some bits at a time; of a pair with more errors than ERRORS, only some may be counted."""
    low, high = np.maximum(0, -offset), np.minimum(size[a], size[b] - offset)
    span = np.maximum(high - low, 0)
    wrong = np.zeros(len(a), np.int64)
    rest = span > 0
    # every second integer first: a pair that has too many wrong bits there needs no more
    for half in (0, 1):
        left = np.flatnonzero(rest & (span > half))
        turn = np.cumsum((span[left] + 1 - half) // 2) // PAIRS
        for own in np.split(left, np.flatnonzero(turn[1:] != turn[:-1]) + 1):
            if not len(own):
                continue
            n = (span[own] + 1 - half) // 2
            start = np.cumsum(n) - n
            at = 2 * (np.arange(n.sum()) - np.repeat(start, n)) + half + np.repeat(begin[a[own]] + low[own], n)
            bits = flat[at]
            at += np.repeat(begin[b[own]] - begin[a[own]] + offset[own], n)
            bits ^= flat[at]
            wrong[own] += np.add.reduceat(np.bitwise_count(bits), start, dtype=np.int64)
        rest &= wrong <= ERRORS * 32 * span
    return span / np.maximum(np.minimum(size[a], size[b]), 1), np.where(span > 0, wrong / (32 * np.maximum(span, 1)), 1.0)


class Sides:
    """The nodes of two classes (or of one): their shared landmarks, and their integers once they are asked for."""

    def __init__(self, batches: Iterator, classes: int):
        self.frames, packs, self.one = {}, {}, True
        for batch in batches:
            first, second = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            self.one, left = first == second, first
            heard = batch.select(["node", "frames"]).filter(batch.column("frames").is_valid())
            self.frames.update(zip(heard.column(0).to_pylist(), heard.column(1).to_pylist(), strict=True))
            sets = batch.filter(batch.column("shard").is_valid())
            for shard, *row in zip(*(sets.column(c).to_pylist() for c in ("shard", *SETS)), strict=True):
                packs.setdefault(shard, []).append([unplaned(x, k) for x, k in zip(row, SETS.values(), strict=True)])
        pa.default_memory_pool().release_unused()
        held = [x for pack in packs.values() for x in pack]
        self.nodes, at = np.unique(np.concatenate([np.zeros(0, np.int64), *(x[1] for x in held)]), return_index=True)
        sizes = np.concatenate([np.zeros(0, np.int64), *(x[2].astype(np.int64) for x in held)])[at]
        del held
        self.size, self.few = np.abs(sizes), sizes < 0
        self.left = class_of(self.nodes, classes) == left if len(self.nodes) else np.zeros(0, bool)
        # of each shard what the first class has and what the other has
        self.sets = []
        while packs:
            sides = [], []
            for numbers, nodes, _, index, places in packs.popitem()[1]:
                who = np.searchsorted(self.nodes, nodes)
                sides[not self.left[who[0]]].append((np.cumsum(numbers, dtype=np.int64) * len(self.nodes) + who[index], who.astype(np.int32)[index], places))
            if self.one or all(sides):
                self.sets += [(sides[0][0], sides[0][0])] if self.one else [(sides[0][0], sides[1][0]), (sides[1][0], sides[0][0])]
        # room for all integers; what is not asked for is never touched
        self.flat, self.begin, self.used = np.empty(int(self.size.sum()), np.uint32), np.full(len(self.nodes), -1), 0

    def candidates(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """a, b and offset of pairs to verify: the offset with most votes, if these are enough. About most votes are summed at once."""
        total, bits = len(self.nodes), int(self.size.max(initial=0)).bit_length() + 1
        half = 1 << (bits - 1)
        # each node is tried against those behind it; the nodes take turns, by the votes that they really have: a key that stands
        # often in a node has many places there, but only its first is tried
        tries, many = [heads(one, other, total) for one, other in self.sets], np.zeros(total, np.int64)
        for (one, _), (first, _, n) in zip(self.sets, tries, strict=True):
            np.add.at(many, one[1][first], n)
        turn = (np.cumsum(many) - many) // most
        turns, edges = np.unique(turn[many > 0]), []
        for k, ((one, _), (first, *_)) in enumerate(zip(self.sets, tries, strict=True)):
            when = turn[one[1][first]]
            order = np.argsort(when, kind="stable")
            tries[k] = tuple(x[order] for x in tries[k])
            edges.append(np.searchsorted(when[order], np.append(turns, turns[-1:] + 1)))
        for t in range(len(turns)):
            held = [np.zeros(0, np.int64)]
            for (one, other), found, edge in zip(self.sets, tries, edges, strict=True):
                if edge[t] < edge[t + 1]:
                    for a, b, offset in pairings(one, other, tuple(x[edge[t] : edge[t + 1]] for x in found), self.size):
                        held.append((a * total + b << bits) + (offset + half))
            code = np.concatenate(held)
            del held
            code.sort()
            start = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
            votes, code = np.diff(np.append(start, len(code))), code[start]
            enough = votes >= VOTES
            if self.few.any():  # one vote is enough if one of them has no more landmarks
                pair = code >> bits
                enough |= self.few[pair // total] | self.few[pair % total]
            votes, code = votes[enough], code[enough]
            order = np.lexsort((code, votes, code >> bits))  # the best offset of each pair comes last
            code = code[order]
            code = code[np.append(code[1:] >> bits != code[:-1] >> bits, True)[: len(code)]]
            pair = code >> bits
            yield pair // total, pair % total, (code & ((1 << bits) - 1)) - half

    def verified(self, a: np.ndarray, b: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs are links, and the errors of all."""
        wanted = np.zeros(len(self.nodes), bool)
        wanted[a], wanted[b] = True, True
        new = np.flatnonzero(wanted & (self.begin < 0))
        turn = np.cumsum(self.size[new]) // UNPACKED
        for own in np.split(new, np.flatnonzero(turn[1:] != turn[:-1]) + 1):
            for x, ints in zip(own.tolist(), integers_of([self.frames.pop(x) for x in self.nodes[own].tolist()]), strict=True):
                self.begin[x], self.used = self.used, self.used + len(ints)
                self.flat[self.begin[x] : self.used] = ints
        share, error = all_errors(self.flat, self.begin, self.size, a, b, offset)
        return (share >= SHARE) & (error <= ERRORS), error


def joined(edges: np.ndarray) -> np.ndarray:
    """Edges (least, other) that join what these edges (a, b) join: a star for each component."""
    nodes, at = np.unique(edges, return_inverse=True)
    u, v = at.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        least = np.minimum(label[u], label[v])
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        if np.array_equal(label, before):
            others = np.flatnonzero(label != np.arange(len(nodes)))
            return np.column_stack([nodes[label[others]], nodes[others]])


def linked(rows: DataFrame, i: int, j: int) -> DataFrame:
    """What is stored of two classes (of one, if they are the same), read by one task."""
    own = rows.where(F.col("class").isin(i, j)).coalesce(1)
    return own.select(F.lit(i).alias("i"), F.lit(j).alias("j"), "node", "frames", "shard", *SETS)


def compared(sides: DataFrame, classes: int, most: int, size: int, every: bool) -> DataFrame:
    """Links within pairs of classes: all (a, b, offset, error), or edges that join as they do (a, b) and the links of each node (a, n)."""

    def run(batches):
        side = Sides(batches, classes)
        tree, each = [np.zeros((0, 2), np.int64)], np.zeros(len(side.nodes), np.int64)
        for found in side.candidates(most):
            for at in range(0, len(found[0]), size):
                a, b, offset = (x[at : at + size] for x in found)
                keep, error = side.verified(a, b, offset)
                a, b, offset, error = a[keep], b[keep], offset[keep], error[keep]
                if every:
                    yield pa.RecordBatch.from_arrays([pa.array(side.nodes[a]), pa.array(side.nodes[b]), pa.array(offset), pa.array(error)], ["a", "b", "offset", "error"])
                    continue
                each += np.bincount(a, minlength=len(each)) + np.bincount(b, minlength=len(each))
                tree = [joined(np.concatenate([*tree, np.column_stack([a, b])]))]
        if not every:
            tree, some = tree[0], np.flatnonzero(each)
            none = lambda k: pa.nulls(k, pa.int64())
            for columns in ((pa.array(side.nodes[tree[:, 0]]), pa.array(side.nodes[tree[:, 1]]), none(len(tree))), (pa.array(side.nodes[some]), none(len(some)), pa.array(each[some]))):
                yield pa.RecordBatch.from_arrays(list(columns), ["a", "b", "n"])

    return sides.mapInArrow(run, "a long, b long, offset long, error double" if every else "a long, b long, n long")


def links(spark: SparkSession, scan: Scan, most: int = SUMMED, size: int = VERIFIED, classes: int = CLASSES, every: bool = True) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Links between nodes: edges that join what they join (a, b), how many each node has (node, n_links), and all (a, b, offset, error; if every).

    most votes are summed and size pairs verified at once; these, and classes, do not change the links.
    """
    at = fresh_path(spark, "audio-classes")
    frames = class_frames(scan, classes)
    schema = f"class int, node long, frames binary, shard int, {', '.join(f'{c} binary' for c in SETS)}"
    frames.write.partitionBy("class").parquet(at)
    heard = stored_frames(spark.read.schema(schema).parquet(at))
    shared = shared_landmarks(heard, max(1, parts(spark) // 2), classes)
    shared.write.mode("append").partitionBy("class").parquet(at)
    rows = spark.read.schema(schema).parquet(at)
    nothing = rows.where("class < 0").select(F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "frames", "shard", *SETS)
    pairs = [(i, j) for i in range(classes) for j in range(i, classes)]
    # beside a read of no class, as Spark would put single partitions alone into one
    rounds = [reduce(DataFrame.unionAll, [linked(rows, *x) for x in pairs[k : k + ROUND]], nothing) for k in range(0, len(pairs), ROUND)]
    busy = reduce(DataFrame.unionAll, [stored(compared(x, classes, most, size, False), "audio-links") for x in rounds])
    each = busy.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    found = reduce(DataFrame.unionAll, [compared(x, classes, most, size, True) for x in rounds]) if every else None
    return busy.where("b IS NOT NULL").select("a", "b"), each, found


def align(df: DataFrame, id_col: str, media: str, decode: Callable = pcm16, every: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The recordings (id, n_frames, n_ints, node, component_id, n_links), and the links between nodes (if every)."""
    prints = stored(fingerprints(df, id_col, media, decode), "audio-prints")
    classes = max(CLASSES, -(-(prints.agg(F.sum("n_ints")).first()[0] or 0) // CLASS))
    tree, each, found = links(df.sparkSession, hearing(df, media, decode), classes=classes, every=every)
    nodes = prints.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    linked = nodes.join(components(tree), "node", "left")
    # a large class is dealt by salt, for its head's id as for its members
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    heads = linked.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("head"))
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    named = linked.withColumn("salt", salt).join(heads, ["root", "salt"], "left").select("node", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("head")).alias("component_id"))
    about = named.join(each, "node", "left")
    rows = prints.join(about, "node", "left").select(
        "id", "n_frames", "n_ints", "node", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )
    return rows, found


def op8_audio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_frames, n_ints, component_id and n_links of every document, played as tones."""
    rows, _ = align(documents(spark, sf_dir), "doc_id", "text", tones, every=False)
    return rows.select(F.col("id").alias("doc_id"), "n_frames", "n_ints", "component_id", "n_links")
