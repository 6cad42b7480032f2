"""LM scoring with a log-frequency Bloom filter of n-gram counts.

Training tokens are counted as words and as word pairs. A count c is quantised to level 1 + floor(log2 c),
and the filter holds (n-gram, 1) to (n-gram, level); a count is read back by probing levels until one is
absent. A text's probability is smoothed: p(w | v) = (c(v, w) + M p(w)) / (c(v) + M), with
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), all counts from the filter. Exact word counts are kept too, for the
base score and for n_known. As counts are the middles of their levels, what a context gives to all words adds up to one only
about (0.6 to 1.6, see tests); a probability is never more than 1.

What the model gathers grows with the corpus, so it lives in shards by hash range, made and kept in the
shared folder. Word counts are looked up by shard: each chunk of documents (rows dealt evenly) sends its
distinct words there as packed arrays, and the counts come back. Words are known by a 64-bit hash. A filter of at most FILTER_BYTES is sent to
every worker; a larger one is probed by shard, in the same way as the words. Both paths give the same result.

Null text is empty: its only token is the end. Rows with a null id count as training rows. Repeated rows are
scored and counted each. An empty training set gives every token the unseen probability; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import LOWER, SOLID, Words, checkpoint, documents, mix, parts, slices, text_buffer

#: Bits of the filter for each (n-gram, level), and bits set for each within one 64-bit word.
BITS, PROBES = 12, 4
#: Largest filter that is sent to every worker.
FILTER_BYTES = 192 << 20
#: Weight of the word probability, and distinct n-grams that a task holds before it sends them.
WEIGHT, HELD = 4.0, 3_000_000
#: Hashes of the end, and of the start as a context.
END, START = (int(x) for x in mix(np.array([101, 102], np.uint64)))
_U = np.uint64


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and context hash of every token, and the tokens before each document; each ends with END."""
    words = Words(LOWER[data], offsets, SOLID)
    n = words.counts + 1
    first = np.concatenate([[0], np.cumsum(n)])
    out = np.full(first[-1], END, np.uint64)
    out[np.arange(len(words.hashes)) + words.document()] = words.hashes
    context = np.empty_like(out)
    context[1:] = out[:-1]
    context[first[:-1]] = START
    return out, context, first


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * _U(0x9E3779B97F4A7C15) + word)


def place(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard by hash range, and the place within it (48 bits), both in order of the hash."""
    s, low = _U(shards), hashes & _U(0xFFFFFFFF)
    shard = ((hashes >> _U(32)) * s + ((low * s) >> _U(32))) >> _U(32)
    return shard.astype(np.int64), (hashes * s) >> _U(16)


def pack(x: np.ndarray) -> bytes:
    """48-bit places."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    if not len(key):
        return key, count
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[first], np.diff(np.append(first, len(x)))


def probe(at: np.ndarray, level: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter word and the mask of (n-gram, level) in a filter of so many 64-bit words."""
    h = mix(at * _U(0xD1B54A32D192ED03) + _U(level))
    word = ((h >> _U(32)) * _U(words)) >> _U(32)
    mask = np.zeros(len(h), np.uint64)
    for i in range(PROBES):
        mask |= _U(1) << ((h >> _U(6 * i)) & _U(63))
    return word.astype(np.int64), mask


def build_filter(at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    levels = np.log2(np.maximum(counts, 1)).astype(np.int64) + 1
    bits = np.zeros(int(levels.sum()) * BITS // 64 + 1, np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        word, mask = probe(at[levels >= level], level, len(bits))
        np.bitwise_or.at(bits, word, mask)
    return bits


def read_levels(bits: np.ndarray, begin: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Levels of n-grams by repeated probes. begin, words: each one's filter within bits."""
    out = np.zeros(len(at), np.uint8)
    left = np.arange(len(at))
    level = 1
    while len(left) and level < len(COUNT_OF):
        h = mix(at[left] * _U(0xD1B54A32D192ED03) + _U(level))
        word = ((h >> _U(32)) * words[left].astype(np.uint64)) >> _U(32)
        mask = np.zeros(len(h), np.uint64)
        for i in range(PROBES):
            mask |= _U(1) << ((h >> _U(6 * i)) & _U(63))
        left = left[(bits[begin[left] + word.astype(np.int64)] & mask) == mask]
        out[left] = level
        level += 1
    return out


#: The middle of the counts of each level.
COUNT_OF = np.concatenate([[0.0], 1.5 * 2.0 ** np.arange(64) - 0.5])
COUNT_OF[1] = 1.0


def count_rows(train: DataFrame, shards: int) -> DataFrame:
    """shard and packed words, their counts, and packed n-grams with theirs, as found by each task."""

    def send(words, pairs):
        one, n_one = summed(*words) if words[0] else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        two, n_two = summed(*pairs) if pairs[0] else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        s1, s2 = place(one, shards)[0], place(two, shards)
        e1 = np.searchsorted(s1, np.arange(shards + 1))
        e2 = np.searchsorted(s2[0], np.arange(shards + 1))
        rows = [
            (
                s,
                one[a:b].tobytes(),
                n_one[a:b].astype("<u4").tobytes(),
                pack(s2[1][c:d]),
                n_two[c:d].astype("<u4").tobytes(),
            )
            for s, a, b, c, d in zip(range(shards), e1[:-1], e1[1:], e2[:-1], e2[1:], strict=True)
            if b > a or d > c
        ]
        for at in range(0, len(rows), 64):
            some = list(zip(*rows[at : at + 64], strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some[0], pa.int32()), *(pa.array(x, pa.binary()) for x in some[1:])],
                ["shard", "words", "n_words", "pairs", "n_pairs"],
            )

    def run(batches):
        words, pairs = ([], []), ([], [])
        for batch in batches:
            data, ends = text_buffer(batch.column(0))
            for i, j in slices(ends):
                token, context, _ = tokens(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
                for held, x in ((words, token), (pairs, pair_hash(context, token))):
                    key, n = distinct(x)
                    held[0].append(key)
                    held[1].append(n)
                for held in (words, pairs):
                    if len(held[0]) > 24:
                        key, n = summed(*held)
                        held[0][:], held[1][:] = [key], [n]
                if sum(map(len, pairs[0])) > HELD:
                    yield from send(words, pairs)
                    words, pairs = ([], []), ([], [])
        if words[0]:
            yield from send(words, pairs)

    return train.select("text").mapInArrow(run, "shard int, words binary, n_words binary, pairs binary, n_pairs binary")


def model_rows(counted: DataFrame, shards: int, starts: int) -> DataFrame:
    """One row for each shard: its words in order, their counts, its filter, and its sums."""
    start_shard, start_at = place(np.array([START], np.uint64), shards)

    def run(key, table):
        shard = key[0].as_py()
        n = table.column("n_words").to_pylist(), table.column("n_pairs").to_pylist()
        word, count = summed(
            [np.frombuffer(x, "<u8") for x in table.column("words").to_pylist()],
            [np.frombuffer(x, "<u4").astype(np.int64) for x in n[0]],
        )
        pair, times = summed(
            [unpack(x) for x in table.column("pairs").to_pylist()], [np.frombuffer(x, "<u4").astype(np.int64) for x in n[1]]
        )
        at = np.concatenate([place(word, shards)[1], pair])
        all_counts = np.concatenate([count, times])
        if shard == start_shard[0]:
            at, all_counts = np.append(at, start_at), np.append(all_counts, starts)
        bits = build_filter(at, all_counts)
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "words": pa.array([word.tobytes()], pa.binary()),
                "counts": pa.array([count.astype("<i8").tobytes()], pa.binary()),
                "bits": pa.array([bits.tobytes()], pa.binary()),
                "n_tokens": pa.array([int(count.sum())], pa.int64()),
                "n_distinct": pa.array([len(word)], pa.int64()),
            }
        )

    schema = "shard int, words binary, counts binary, bits binary, n_tokens long, n_distinct long"
    return counted.groupBy("shard").applyInArrow(run, schema)


def score(
    df: DataFrame, train: F.Column, id_col: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score of every row; train: which rows to learn from."""
    spark = df.sparkSession
    shards = chunks = parts(spark)
    learned = df.where(train)
    starts = learned.count()
    model = checkpoint(model_rows(count_rows(learned.select(F.col(text).alias("text")), shards), shards, starts))
    totals = model.agg(F.sum("n_tokens"), F.sum("n_distinct"), F.sum(F.octet_length("bits"))).first()
    n_all, n_distinct, size = (int(x or 0) for x in totals)
    unseen = n_all + 0.5 * (n_distinct + 1)
    sent = None
    if size <= filter_bytes:
        # one array, filled shard by shard: the driver holds the filter once
        lengths = np.ones(shards, np.int64)
        for r in model.select("shard", F.octet_length("bits").alias("n")).collect():
            lengths[r.shard] = r.n // 8
        ends = np.cumsum(lengths)
        joined = np.zeros(ends[-1], np.uint64)
        for r in model.select("shard", "bits").toLocalIterator():
            joined[ends[r.shard] - lengths[r.shard] : ends[r.shard]] = np.frombuffer(r.bits, np.uint64)
        sent = spark.sparkContext.broadcast((lengths, joined))
        del joined
    id_kind = dict(df.dtypes)[id_col]
    # by row, not by id: rows that repeat an id, or have none, are spread like any others
    chunk = F.pmod(F.monotonically_increasing_id(), F.lit(chunks)).cast("int")
    dealt = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"), chunk.alias("chunk")).repartition(chunks, "chunk")

    def each_slice(table):
        column = table.column("text").combine_chunks()
        at = 0
        for piece in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
            data, ends = text_buffer(piece)
            for i, j in slices(ends):
                yield at + i, at + j, tokens(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
            at += len(piece)

    def ask(key, table):
        """The distinct words (and n-grams, if the filter is not at hand) of a chunk, by shard."""
        words, grams = [np.array([START], np.uint64)], []
        for _, _, (token, context, _) in each_slice(table):
            words.append(distinct(token)[0])
            if sent is None:
                grams.append(distinct(pair_hash(context, token))[0])
        word = distinct(np.concatenate(words))[0]
        gram = distinct(np.concatenate([*grams, word]))[0] if sent is None else np.zeros(0, np.uint64)
        e1 = np.searchsorted(place(word, shards)[0], np.arange(shards + 1))
        s2, at2 = place(gram, shards)
        e2 = np.searchsorted(s2, np.arange(shards + 1))
        rows = [s for s in range(shards) if e1[s + 1] > e1[s] or e2[s + 1] > e2[s]]
        return pa.table(
            {
                "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "shard": pa.array(rows, pa.int32()),
                "words": pa.array([word[e1[s] : e1[s + 1]].tobytes() for s in rows], pa.binary()),
                "grams": pa.array([pack(at2[e2[s] : e2[s + 1]]) for s in rows], pa.binary()),
            }
        )

    def answer(key, asked, own):
        """The counts of the words, and the levels of the n-grams."""
        if own.num_rows:
            known, counts = np.frombuffer(own.column("words")[0].as_py(), "<u8"), np.frombuffer(own.column("counts")[0].as_py(), "<i8")
            bits = np.frombuffer(own.column("bits")[0].as_py(), np.uint64)
        else:
            known, counts, bits = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.uint64)
        found, levels = [], []
        for words, grams in zip(asked.column("words").to_pylist(), asked.column("grams").to_pylist(), strict=True):
            word = np.frombuffer(words, "<u8")
            got = np.zeros(len(word), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, word), len(known) - 1)
                got = np.where(known[at] == word, counts[at], 0)
            found.append(got.astype("<i8").tobytes())
            gram = unpack(grams)
            levels.append(read_levels(bits, np.zeros(len(gram), np.int64), np.full(len(gram), len(bits)), gram).tobytes())
        return pa.table(
            {
                "chunk": asked.column("chunk").combine_chunks(),
                "shard": asked.column("shard").combine_chunks(),
                "words": asked.column("words").combine_chunks(),
                "counts": pa.array(found, pa.binary()),
                "grams": asked.column("grams").combine_chunks(),
                "levels": pa.array(levels, pa.binary()),
            }
        )

    def finish(key, table, answers):
        order = np.argsort(answers.column("shard").to_numpy())
        column = lambda name: [x for x in np.array(answers.column(name).to_pylist(), object)[order]]
        known = np.frombuffer(b"".join(column("words")), "<u8")
        count = np.frombuffer(b"".join(column("counts")), "<i8")
        if sent is None:
            asked, given = column("grams"), column("levels")
            shard_of = np.sort(answers.column("shard").to_numpy())
            sizes = [len(x) for x in given]
            # 48-bit places in order within ordered shards
            grams = [unpack(x) for x in asked]
            levels = [np.frombuffer(x, np.uint8) for x in given]
            row_of = np.full(shards, -1)
            row_of[shard_of] = np.arange(len(shard_of))

            def level(hashes):
                s, at = place(hashes, shards)
                out = np.zeros(len(hashes), np.uint8)
                order = np.argsort(s, kind="stable")
                edges = np.searchsorted(s[order], np.arange(shards + 1))
                for k in range(shards):
                    some = order[edges[k] : edges[k + 1]]
                    if len(some) and row_of[k] >= 0 and sizes[row_of[k]]:
                        out[some] = levels[row_of[k]][np.searchsorted(grams[row_of[k]], at[some])]
                return out

        else:
            lengths, bits = sent.value
            begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]

            def level(hashes):
                s, at = place(hashes, shards)
                return read_levels(bits, begins[s], lengths[s], at)

        start = COUNT_OF[level(np.array([START], np.uint64))[0]]
        # by distinct word of the chunk, once
        c_word = COUNT_OF[level(known)]
        p_word = (c_word + 0.5) / unseen
        base = np.log10((count + 0.5) / unseen)
        out = []
        for i, j, (token, context, first) in each_slice(table):
            at = np.searchsorted(known, token)
            before = np.empty(len(token))
            before[1:] = c_word[at[:-1]]
            before[first[:-1]] = start
            c_pair = COUNT_OF[level(pair_hash(context, token))]
            p = np.minimum(1.0, (np.minimum(c_pair, before) + WEIGHT * p_word[at]) / (before + WEIGHT))
            add = lambda x, f=first: np.add.reduceat(x, f[:-1])
            out.append((np.diff(first), add((count[at] > 0).astype(np.int64)), add(base[at]), add(np.log10(p))))
        joined = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pa.table(
            {
                "id": table.column("id").combine_chunks(),
                "n_tokens": pa.array(joined[0].astype(np.int64)),
                "n_known": pa.array(joined[1].astype(np.int64)),
                "train_tokens": pa.array(np.full(len(joined[0]), n_all, np.int64)),
                "base_score": pa.array(joined[2]),
                "score": pa.array(joined[3]),
            }
        )

    asked = dealt.groupBy("chunk").applyInArrow(ask, "chunk int, shard int, words binary, grams binary")
    told = asked.groupBy("shard").cogroup(model.select("shard", "words", "counts", "bits").groupBy("shard"))
    answers = told.applyInArrow(answer, "chunk int, shard int, words binary, counts binary, grams binary, levels binary")
    schema = f"id {id_kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of those whose remainder is not 1."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    held_out = F.coalesce(rest == 1, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = score(docs, ~held_out)
    return out.select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
