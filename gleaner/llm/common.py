"""What the corpus operators share: shared storage, Arrow text access and vectorised words.

Texts reach Python only as Arrow buffers. Words are byte classes, so a whole batch of documents
is split and hashed by a few numpy passes over its UTF-8 bytes; work is done in slices of a few
MB, so memory does not depend on how many rows or how long a batch is (one document is never cut).
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text handled at once.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that is unset and all runs on one machine (tests) a temporary folder takes its place.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not at:
        held = context._jsc.sc().getCheckpointDir()
        if held.isDefined():
            at = held.get()
        elif context.master.split("[")[0] == "local":
            at = tempfile.mkdtemp(prefix="gleaner-")
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(at)
    return at


_made: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    _made.append(f"{shared_dir(spark).rstrip('/')}/gleaner-{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clear(spark: SparkSession) -> int:
    """Removes the intermediate tables that this driver has made; what is lazily read from them must be done. How many there were."""
    paths, _made[:] = _made[:], []
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: lost executors don't lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: compressed, and lost executors don't lose it."""
    at = fresh_path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, (_, offsets, data) = len(column), column.buffers()
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents [i, j) of up to most bytes, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def give_back() -> None:
    """Returns freed memory to the system: Arrow's pool and the C library else hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over a task's batches, and then give_back(): the worker stays for other tasks, next to the executor's heap."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans that is true within the spans."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ over lower-cased text: digits, a-z and all that is not ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: [^\x20\x09-\x0D]+: all but ASCII white space.
SOLID = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random odd multiplier.
_P = 0x9E3779B97F4A7C15
#: Leading bytes of a little-endian block of eight.
_LEADING = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Spans longer than this are hashed one by one.
LONG_SPAN = 256


def blocks_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as integers (behind the end: zeros)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:8].view("<u8"), (len(data) + 1,), (1,), writeable=False) if len(data) else np.zeros(1, np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each span, block by block of eight bytes. Not linear in the bytes, but equal hashes don't
    prove equal bytes: see distinct_spans."""
    sizes = ends - starts
    out = mix((sizes.astype(np.uint64) + np.uint64(seed)) * np.uint64(_P))
    blocks = blocks_of(data)
    if len(sizes) and (most := int(sizes.max())) > LONG_SPAN:
        raw = data.tobytes()
        for i in np.flatnonzero(sizes > LONG_SPAN).tolist():
            out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]], seed)
        few = np.flatnonzero(sizes <= LONG_SPAN)
    else:
        few, most = np.arange(len(sizes)), int(sizes.max(initial=0))
    left, at = sizes[few], starts[few]
    hashed = out[few]
    live = np.arange(len(few))
    for _ in range(0, min(most, LONG_SPAN), 8):
        live = live[left[live] > 0]
        if not len(live):
            break
        block = blocks[at[live]] & _LEADING[np.minimum(left[live], 8)]
        hashed[live] = mix((hashed[live] ^ block) * np.uint64(_P) + np.uint64(1))
        at[live] += 8
        left[live] -= 8
    out[few] = hashed
    return out


def same_spans(one: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the sizes[i] bytes of one from a[i] on are those of other from b[i] on."""
    out = np.ones(len(sizes), bool)
    x, y = blocks_of(one), blocks_of(other)
    live, done = np.arange(len(sizes)), 0
    while True:
        live = live[sizes[live] > done]
        if not len(live):
            return out
        if done >= LONG_SPAN:
            for i in live.tolist():
                out[i] = np.array_equal(one[a[i] + done : a[i] + sizes[i]], other[b[i] + done : b[i] + sizes[i]])
            return out
        mask = _LEADING[np.minimum(sizes[live] - done, 8)]
        equal = (x[a[live] + done] ^ y[b[live] + done]) & mask == 0
        out[live[~equal]] = False
        live, done = live[equal], done + 8


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each different span, one that spells it, and which of these each span is.

    Spans of one hash are compared byte by byte; those that differ from the first are told apart by their bytes.
    """
    hashes, at, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    sizes = ends - starts
    same = sizes == sizes[at[which]]
    same[same] = same_spans(data, starts[same], data, starts[at[which[same]]], sizes[same])
    if not same.all():
        raw, more = data.tobytes(), {}
        for i in np.flatnonzero(~same).tolist():
            which[i] = more.setdefault(raw[starts[i] : ends[i]], (len(at) + len(more), i))[0]
        first = np.array([i for _, i in more.values()], np.int64)
        hashes, at = np.concatenate([hashes, span_hashes(data, starts[first], ends[first])]), np.concatenate([at, first])
    return hashes, at, which


class Words:
    """The words of consecutive documents: first and past-last byte, hash, words before each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, hashed: bool = True):
        n = len(data)
        inside = is_word[data]
        edge = np.zeros(n + 1, np.int8)
        edge[:n] = inside
        before = np.empty(n + 1, np.int8)
        before[0], before[1:] = 0, edge[:n]
        before[offsets[offsets < n]] = 0
        self.starts = np.flatnonzero((edge == 1) & (before == 0))
        after = edge.copy()
        after[offsets] = 0  # a word ends where its document ends
        self.ends = np.flatnonzero(inside & (after[1:] == 0)) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.hashes = span_hashes(data, self.starts, self.ends) if hashed else np.zeros(0, np.uint64)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each k consecutive words, by first word (those that cross documents too)."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_P) + hashes[i : i + n])
    return out


def word_hash(text: str) -> int:
    """The hash that Words gives a single word."""
    data = np.frombuffer(text.encode(), np.uint8)
    return int(Words(data, np.array([0, len(data)]), np.ones(256, bool)).hashes[0])


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parts(spark: SparkSession, least: int = 1) -> int:
    """Shuffle partitions, as configured for the size of the input."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: The largest filter of nodes that is sent to every worker.
SIEVE_BYTES = 16 << 20


def sieve(nodes: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test for these nodes (node) that errs only by taking others too: a Bloom filter of at most SIEVE_BYTES, made in shares."""
    spark, shares = nodes.sparkSession, 32
    words = min(SIEVE_BYTES // 8, max(1024, nodes.count() // 4)) // shares

    def places(x):
        h = mix(x.view(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        word = ((h >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
        return (h & np.uint64(31)).astype(np.int64), word.astype(np.int64), (np.uint64(1) << ((h >> np.uint64(5)) & np.uint64(63))) | (np.uint64(1) << ((h >> np.uint64(11)) & np.uint64(63))) | (np.uint64(1) << ((h >> np.uint64(17)) & np.uint64(63)))

    def partial(batches):
        bits = np.zeros((shares, words), np.uint64)
        for batch in batches:
            share, word, mask = places(batch.column(0).to_numpy())
            np.bitwise_or.at(bits, (share, word), mask)
        for share in np.flatnonzero(bits.any(1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([share], pa.int32()), pa.array([zstandard.compress(bits[share].tobytes())], pa.binary())], ["share", "bits"])

    def join(key, table):
        bits = np.zeros(words, np.uint64)
        for x in table.column("bits").to_pylist():
            bits |= np.frombuffer(zstandard.decompress(x), np.uint64)
        return pa.table({"share": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    whole = np.zeros((shares, words), np.uint64)
    for row in nodes.select("node").mapInArrow(partial, "share int, bits binary").groupBy("share").applyInArrow(join, "share int, bits binary").collect():
        whole[row.share] = np.frombuffer(row.bits, np.uint64)
    sent = spark.sparkContext.broadcast(whole)

    def test(x):
        share, word, mask = places(np.ascontiguousarray(x))
        return sent.value[share, word] & mask == mask

    return test
