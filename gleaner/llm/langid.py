"""Language ID by cross-parsing entropy.

For each language a suffix automaton of labelled text accepts every substring of it. A text is parsed
greedily into the longest phrases that the automaton accepts; a phrase costs the logarithm of the
labelled text's length, and the language that needs the fewest bits a byte wins (ties: the name
that sorts first). All automata are flat transition tables, and the parse runs over thousands of
lanes (LANE bytes of a text) in step, so a byte costs a few array operations. Lanes do not cut phrases: each is
first parsed as if a phrase began with it, then again from the state in which the lane before ends, until both
parses stand in one state; from there on they are the same. The result is the parse of the whole text.

Defined results: null text, or text without a letter, gives ``und`` with score 0. With one learned
language the score is 1 minus its bits a byte over 8. Otherwise it is 1 minus the ratio of the best
and the second-best cost. Repeated rows are judged alike; an empty table gives no rows; with no
labelled text at all everything is ``und``. Columns called like an output are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.common import LOWER, documents, released, slices, text_buffer

#: Bounds of the labelled sample: documents and characters for each language.
TRAIN_DOCS, TRAIN_CHARS = 60, 40_000
#: Bytes of a text that one lane holds; no result depends on it.
LANE = 512
_LETTER = regex.compile(r"\p{L}")
#: Symbols: 0 for all but letters, 1 to 26 for a-z, 27 to 154 for the other bytes, and padding.
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[0x61:0x7B] = np.arange(1, 27)
_SYMBOL[0x80:] = np.arange(27, 155)


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the two-byte Latin letters that follow 0xC3."""
    out = LOWER[data]
    if len(out) > 1:
        latin = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][latin] += 0x20
    return out


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all suffixes; state 0 is the start."""
    size, link, go = [0], [-1], [{}]
    last = 0
    for c in text:
        now = len(size)
        size.append(size[last] + 1)
        link.append(0)
        go.append({})
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = now
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if size[p] + 1 == size[q]:
                link[now] = q
            else:
                copy = len(size)
                size.append(size[p] + 1)
                link.append(link[q])
                go.append(dict(go[q]))
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return go


class Parser:
    """Phrase counts of pieces of text against one language's labelled text."""

    def __init__(self, text: str):
        data = _SYMBOL[lowered(np.frombuffer(text.encode(), np.uint8))]
        used = np.unique(data)
        self.code = np.full(256, len(used), np.uint16)  # a symbol that the text lacks
        self.code[used] = np.arange(len(used))
        self.width = len(used) + 2
        self.pad = len(used) + 1
        go = suffix_automaton(self.code[data].tolist())
        # an entry: the next state's row, and in the two upper bits how many phrases end
        table = np.zeros((len(go), self.width), np.uint32)
        start = go[0]
        table[:, :] = 2 << 30
        table[0, :] = 1 << 30
        for c, to in start.items():
            table[:, c] = (1 << 30) | (to * self.width)
            table[0, c] = to * self.width
        for state, moves in enumerate(go):
            for c, to in moves.items():
                table[state, c] = to * self.width
        table[:, self.pad] = np.arange(len(go), dtype=np.uint32) * self.width
        self.table = table.ravel()
        self.cost = float(np.log2(max(2, len(data))))

    def phrases(self, lanes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Phrases that end in each lane. lanes: symbols, a row for each step and a column for each lane, 255 is padding;
        first: whether a text begins with the lane (the others go on with the text of the lane before)."""
        code = self.code.copy()
        code[255] = self.pad
        low = np.uint32(0x3FFFFFFF)
        state, count = np.zeros(lanes.shape[1], np.uint32), np.zeros(lanes.shape[1], np.int64)
        for row in lanes:
            entry = self.table.take(state + code.take(row))
            count += entry >> np.uint32(30)
            state = entry & low
        own, total = state, count.copy()  # state: where each lane ends, as known so far
        state = own.copy()
        entered = np.zeros_like(own)  # the state in which a lane was last entered
        while True:
            enters = np.where(first, np.uint32(0), np.append(np.uint32(0), state[:-1]))
            live = np.flatnonzero(enters != entered)
            if not len(live):
                break
            entered[live] = enters[live]
            total[live], state[live] = count[live], own[live]
            mine, other = np.zeros(len(live), np.uint32), enters[live]
            for step, row in enumerate(lanes):
                symbol = code.take(row.take(live))
                here, there = self.table.take(mine + symbol), self.table.take(other + symbol)
                total[live] += (there >> np.uint32(30)).astype(np.int64) - (here >> np.uint32(30))
                mine, other = here & low, there & low
                if step % 8 == 7 or step == len(lanes) - 1:
                    apart = mine != other
                    live, mine, other = live[apart], mine[apart], other[apart]
                    if not len(live):
                        break
            state[live] = other
        last = np.append(first[1:], True) if len(first) else first
        return total + (last & (state > 0))


class Languages:
    """The parsers of all learned languages."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in texts]
        self.parsers = [Parser(text) for _, text in texts]

    def costs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits a byte: a row for each document, a column for each language."""
        sizes = np.diff(offsets)
        lanes = -(-sizes // LANE)
        first = np.concatenate([[0], np.cumsum(lanes)])
        doc = np.repeat(np.arange(len(sizes)), lanes)
        start = offsets[doc] + (np.arange(first[-1]) - first[doc]) * LANE
        length = np.minimum(LANE, offsets[doc + 1] - start)
        symbols = np.append(_SYMBOL[lowered(data)], np.uint8(255))
        steps = np.arange(LANE)[:, None]
        at = np.where(steps < length, start + steps, len(data))
        pieces = symbols[at]
        begins = np.append(True, doc[1:] != doc[:-1])[: len(doc)]
        out = np.zeros((len(sizes), len(self.parsers)))
        for i, parser in enumerate(self.parsers):
            got = np.concatenate([[0], np.cumsum(parser.phrases(pieces, begins))])
            out[:, i] = (got[first[1:]] - got[first[:-1]]) * parser.cost / np.maximum(sizes, 1)
        return out


@lru_cache(1)
def languages(texts: tuple[tuple[str, str], ...]) -> Languages:
    return Languages(texts)


def fit_languages(
    labelled: DataFrame, docs: int = TRAIN_DOCS, chars: int = TRAIN_CHARS
) -> tuple[tuple[str, str], ...]:
    """(language, text) pairs from a bounded sample of doc_id, text, lang rows.

    For each language the ``docs`` documents of smallest hashed id that have a text give ``chars // docs`` characters
    each; what reaches the driver is bounded by languages x chars. One scan; each task sends at most ``docs``
    rows of a language. Rows that repeat an id and text use up places.
    """
    known = labelled.where("lang IS NOT NULL AND doc_id IS NOT NULL AND trim(text) <> ''")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    some = known.select("lang", "doc_id", F.substring("text", 1, max(1, chars // docs)).alias("text"))
    rows = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= docs)
    texts: dict[str, list] = {}
    for row in rows.orderBy("lang", "place").collect():
        texts.setdefault(row.lang, []).append(row.text)
    return tuple((name, " ".join(found)) for name, found in sorted(texts.items()))


def identify(
    df: DataFrame, model: tuple[tuple[str, str], ...], text: str = "text", pred: str = "lang_pred", sure: str = "score"
) -> DataFrame:
    """Adds the language (pred) and its score (sure); reads nothing but the text."""
    stays = [c for c in df.columns if c not in (pred, sure)]
    schema = T.StructType([df.schema[c] for c in stays] + [T.StructField(pred, T.StringType()), T.StructField(sure, T.DoubleType())])

    def run(batches):
        learned = languages(model)
        names = np.array([*learned.names, "und"], dtype=object)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            data, offsets = text_buffer(column)
            for i, j in slices(offsets):
                costs = learned.costs(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                lettered = np.array([bool(_LETTER.search(x or "")) for x in column.slice(i, j - i).to_pylist()], bool)
                if not learned.names:
                    best, score = np.zeros(j - i, int), np.zeros(j - i)
                else:
                    best = costs.argmin(1)
                    low = costs[np.arange(j - i), best]
                    high = np.partition(costs, 1, axis=1)[:, 1] if costs.shape[1] > 1 else np.full(j - i, 8.0)
                    score = np.clip(1 - low / np.maximum(high, 1e-9), 0, 1)
                best = np.where(lettered, best, len(names) - 1)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(batch.schema.get_field_index(c)) for c in stays]
                    + [pa.array(names[best], pa.string()), pa.array(np.where(lettered, score, 0.0))],
                    schema.names,
                )

    return df.select(*(F.col(f"`{c}`") for c in stays)).mapInArrow(released(run), schema)


def remainder(modulus: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def learned_languages(docs: DataFrame) -> tuple[tuple[str, str], ...]:
    """The model of op10: labelled documents whose remainder is not 2."""
    return fit_languages(docs.select("doc_id", "text", "lang").where(remainder(4) != 2))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    docs = documents(spark, sf_dir)
    told = identify(docs.select("doc_id", "text"), learned_languages(docs))
    return told.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
