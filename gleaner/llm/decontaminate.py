"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

A benchmark item and each window of a document are sequences of symbols (SYMBOL consecutive words; single words for items
of 5 to SHORT - 1 words). A CGK walk reads a sequence with one pointer: at step j it puts out the symbol under the pointer,
which then stays or moves on by a random bit of (j, symbol). Sequences a few edits apart put out mostly equal symbols, so
their edit distance becomes a Hamming distance, and a sample of the walk's coordinates is an LSH key. Each of REPEATS walks
starts at another place of the item (the window starts as far into the passage), with coordinates of its own: coordinate 0
and two later ones (short items: one). The walks of the last third are as long as the item (twice its symbols, rounded up to
a power of two); the others sample their first NEAR steps, which many edits leave alone. Windows of every word of every
document are compared; those whose first sampled coordinate no item has end there, so only few walk on. An item that ends
before a coordinate is keyed by those before it. Every candidate is then verified: the least number of word edits that
turns the item into some passage around the window (bit-parallel, exact) must be at most 1 - SIMILARITY of the item's words.

An exact passage is always found; for the share of edited ones by length see the README and the tests.

Null or empty texts and items match nothing. Ties: of overlapping places of an item the one with fewer
edits, then the earlier, is given. Repeated rows each give their own rows; a null id is kept as null; other columns are
never read. Items reach the workers in rounds of up to ITEM_BYTES of text, one round at a time; each is a pass over the
documents, and what it gives is stored if there is more than one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import ALNUM, LOWER, Words, documents, grams, mix, slices, stored, text_buffer

SYMBOL, SIMILARITY = 3, 0.8
#: Items of fewer words are read word by word.
SHORT = 12
#: Walks, and the steps that those of the first two thirds sample.
REPEATS, NEAR = 48, 24
ITEM_BYTES = 8 << 20
#: Leading bits by which most windows are put aside.
SIEVE_BITS = 18


def walk_bits(symbols: np.ndarray, repeat: int, step: int) -> np.ndarray:
    """The random bit of each symbol at a step of a walk."""
    key = mix(np.array([repeat * 1009 + step + 1], np.uint64))[0] | np.uint64(1)
    return ((symbols * key) >> np.uint64(63)).astype(np.int64)


def coordinates(repeat: int, steps: int) -> list[int]:
    """The sampled steps of a walk over so many steps; 0: over single words."""
    a, b = mix(np.array([2 * repeat + 1, 2 * repeat + 2], np.uint64)).tolist()
    if not steps:
        return [0, 1 + a % 5]
    return [0, 1 + a % (steps // 3), steps // 3 + 1 + b % (steps - steps // 3)]


def shape(words: int, repeat: int) -> tuple[int, int]:
    """Words of a symbol, and steps, of an item's walk."""
    if 5 <= words < SHORT:
        return 1, 0
    size = min(SYMBOL, words)
    return size, NEAR if repeat < 2 * REPEATS // 3 else max(NEAR, 1 << (2 * (words - size + 1) - 1).bit_length())


def join_key(keys: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return mix(keys * np.uint64(0x9E3779B97F4A7C15) + symbols)


class Item:
    def __init__(self, item_id, hashes: np.ndarray):
        self.id, self.size = item_id, len(hashes)
        self.most = int((1 - SIMILARITY) * self.size + 1e-9)
        self.masks: dict[int, int] = {}
        for i, h in enumerate(hashes.tolist()):
            self.masks[h] = self.masks.get(h, 0) | 1 << i

    def best(self, words: list[int]) -> tuple[int, int]:
        """(edits, past-last word) of the passage of words that needs the fewest edits; the first of these."""
        m, masks = self.size, self.masks
        top, full = 1 << (m - 1), (1 << m) - 1
        plus, minus, score = full, 0, m
        least = (m, 0)
        for at, word in enumerate(words, 1):
            eq = masks.get(word, 0)
            x = eq | minus
            d = (((eq & plus) + plus) ^ plus) | eq
            high = minus | ~(d | plus) & full
            low = plus & d
            score += bool(high & top) - bool(low & top)
            high, low = (high << 1) & full, (low << 1) & full
            plus = (low | ~(x | high)) & full
            minus = high & x
            if score < least[0]:
                least = (score, at)
        return least

    def span(self, words: list[int]) -> tuple[int, int, int]:
        """(edits, first, past-last) of the best passage of words."""
        edits, end = self.best(words)
        back = Item.__new__(Item)
        back.size, back.masks = self.size, {h: int(f"{m:0{self.size}b}"[::-1], 2) for h, m in self.masks.items()}
        _, length = back.best(words[:end][::-1])
        return edits, end - length, end


@lru_cache(1)
def lsh(items: tuple) -> "Lsh":
    return Lsh(items)


class Lsh:
    """The keys of all items for each walk."""

    def __init__(self, items: tuple):
        self.items: list[Item] = []
        # (symbol size, steps, repeat) -> level -> key -> [(item, words from the passage's start to the window's)]
        self.tables: dict[tuple[int, int, int], list[dict[int, list]]] = {}
        for item_id, text in items:
            data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            hashes = Words(data, np.array([0, len(data)]), ALNUM).hashes
            if not len(hashes):
                continue
            self.items.append(Item(item_id, hashes))
            symbols = {k: grams(hashes, k) for k in {shape(len(hashes), r)[0] for r in range(REPEATS)}}
            for repeat in range(REPEATS):
                k, steps = shape(len(hashes), repeat)
                self.add(len(self.items) - 1, symbols[k], k, steps, repeat)
        # coordinate 0 has the same key in every walk
        self.walks = sorted(self.tables)
        self.sieve: dict[int, np.ndarray] = {}
        self.first: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in {w[0] for w in self.walks}:
            pairs = sorted((key, n) for n, w in enumerate(self.walks) if w[0] == k for key in self.tables[w][0])
            keys = np.array([p[0] for p in pairs], np.uint64)
            self.first[k] = keys, np.array([p[1] for p in pairs], np.int64)
            self.sieve[k] = np.zeros(1 << SIEVE_BITS, bool)
            self.sieve[k][(keys >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True
        self.wanted = {w: [np.fromiter(t, np.uint64, len(t)) for t in tables] for w, tables in self.tables.items()}

    def add(self, number: int, symbols: np.ndarray, k: int, steps: int, repeat: int) -> None:
        """The keys of an item's walk."""
        chosen = coordinates(repeat, steps)
        # walks over single words start at every word but the last
        begin = repeat % (len(symbols) - 1) if not steps else repeat * (len(symbols) - 1) // REPEATS
        at, key, step, level, made = begin, np.zeros(1, np.uint64), 0, -1, []
        while at < len(symbols) and level < len(chosen) - 1:
            if step == chosen[level + 1]:
                level += 1
                key = join_key(key, symbols[at : at + 1])
                made.append(int(key[0]))
            at += int(walk_bits(symbols[at : at + 1], repeat, step)[0])
            step += 1
        if not steps and (level < 1 or at == begin):
            return  # a single word says too little; other walks go further
        tables = self.tables.setdefault((k, steps, repeat), [{}, {}, {}])
        for level, key in enumerate(made):
            tables[level].setdefault(key, [])
        tables[len(made) - 1][made[-1]].append((number, begin))

    def candidates(self, hashes: np.ndarray):
        """(word, item, words before it in the passage) of windows that share a key with an item."""
        for k, (keys, numbers) in self.first.items():
            symbols = grams(hashes, k)
            start = join_key(np.zeros(1, np.uint64), symbols)
            near = np.flatnonzero(self.sieve[k][(start >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
            low, high = np.searchsorted(keys, start[near]), np.searchsorted(keys, start[near], side="right")
            near, low, count = near[high > low], low[high > low], (high - low)[high > low]
            window = np.repeat(near, count)
            entry = np.repeat(low - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(len(window))
            walk = numbers[entry]
            order = np.argsort(walk, kind="stable")
            edges = np.searchsorted(walk[order], np.arange(len(self.walks) + 1))
            for number in np.unique(walk).tolist():
                _, steps, repeat = self.walks[number]
                tables, wanted = self.tables[self.walks[number]], self.wanted[self.walks[number]]
                own = window[order[edges[number] : edges[number + 1]]]
                chosen, at, key = coordinates(repeat, steps), own.copy(), start[own]
                for level in range(len(chosen)):
                    if level:
                        for step in range(chosen[level - 1], chosen[level]):
                            at = at + walk_bits(symbols[at], repeat, step)
                            inside = at < len(symbols)
                            own, at, key = own[inside], at[inside], key[inside]
                        key = join_key(key, symbols[at])
                        some = np.isin(key, wanted[level])
                        own, at, key = own[some], at[some], key[some]
                    if not len(own):
                        break
                    for word, found in zip(own.tolist(), key.tolist(), strict=True):
                        for item, begin in tables[level].get(found, ()):
                            yield word, item, begin

    def places(self, hashes: np.ndarray, first: np.ndarray):
        """(document, item, first word, past-last word, edits) of every verified passage."""
        seen, doc_of = {}, np.searchsorted(first, np.arange(len(hashes)), side="right") - 1
        for word, number, begin in self.candidates(hashes):
            seen.setdefault((int(doc_of[word]), number), set()).add(word - begin)
        for (doc, number), starts in sorted(seen.items()):
            item, found = self.items[number], []
            low, high = int(first[doc]), int(first[doc + 1])
            done = low - item.size  # no start lies before that
            for start in sorted(starts):
                if start <= done:
                    continue  # the passage before reaches as far
                a, b = max(low, start - item.most), min(high, start + item.size + item.most)
                edits, left, right = item.span(hashes[a:b].tolist())
                if edits <= item.most and right > left:
                    found.append((edits, a + left, a + right))
                    if edits == 0:
                        done = start
            taken: list[tuple[int, int]] = []
            for edits, a, b in sorted(found):
                if all(b <= x or a >= y for x, y in taken):
                    taken.append((a, b))
                    yield doc, item, a - low, b - low, edits


def rounds_of(items: DataFrame, most: int) -> tuple[int, Iterator[tuple]]:
    """How many rounds there are, and the items (item_id, text) of each, up to about most bytes, when it is asked for."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, ceil(size / most))
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds))
    each = (items.select("item_id", "text").where(group == n).collect() for n in range(rounds))
    return rounds, (tuple(sorted((tuple(r) for r in rows), key=str)) for rows in each)


def found_in(index: Lsh, column: pa.Array):
    """(row, item, first word, past-last word, edits, passage) of every place in a column of texts."""
    whole, ends = text_buffer(column)
    for i, j in slices(ends):
        data, offsets = LOWER[whole[ends[i] : ends[j]]], ends[i : j + 1] - ends[i]
        words = Words(data, offsets, ALNUM)
        for doc, item, a, b, edits in index.places(words.hashes, words.first):
            at = int(words.first[doc])
            raw = whole[ends[i] + words.starts[at + a] : ends[i] + words.ends[at + b - 1]].tobytes()
            yield i + doc, item, a, b, edits, raw.decode(errors="replace")


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """id, item_id, start_word, end_word, edits, similarity and passage of every item's places in the texts.

    items: item_id and text.
    """
    kind = dict(items.dtypes)["item_id"]
    names = ["id", "item_id", "start_word", "end_word", "edits", "similarity", "passage"]
    schema = f"id {dict(df.dtypes)[id_col]}, item_id {kind}, start_word long, end_word long, edits long, similarity double, passage string"
    item_type = {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())

    def scan(some: tuple) -> DataFrame:
        def run(batches):
            index = lsh(some)
            for batch in batches:
                ids = batch.column(0)
                rows = [
                    (ids[row].as_py(), item.id, a, b, edits, 1 - edits / item.size, passage)
                    for row, item, a, b, edits, passage in found_in(index, batch.column(1))
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                kinds = [ids.type, item_type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        return df.select(F.col(id_col).alias("id"), text).mapInArrow(run, schema)

    rounds, each = rounds_of(items, item_bytes)
    keep = (lambda x: x) if rounds == 1 else (lambda x: stored(x, "places"))
    return reduce(DataFrame.unionByName, (keep(scan(some)) for some in each))


def decontaminate(df: DataFrame, items: DataFrame, text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of df, with all their columns, whose text holds no item."""

    def clean(df: DataFrame, some: tuple) -> DataFrame:
        def run(batches):
            index = lsh(some)
            for batch in batches:
                hit = {found[0] for found in found_in(index, batch.column(batch.schema.get_field_index(text)))}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        return df.mapInArrow(run, df.schema)

    rounds, each = rounds_of(items, item_bytes)
    for some in each:
        df = clean(df, some) if rounds == 1 else stored(clean(df, some), "clean")
    return df


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a benchmark item in a document."""
    found = contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "start_word", "end_word", "edits", "similarity", "passage")
