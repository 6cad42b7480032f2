"""BPE encoding and decoding by a priority queue of merge ranks over a doubly linked symbol list.

The vocabulary file is a parameter and is read on every worker (it is part of the installed
tokenizer package, a few MB whatever the corpus). Each distinct piece of text goes through the merges once, see
pieces.

Null text is empty text and has no ids. Rows, order and other columns stay as they are; where a
column is called like an output, the output replaces it. Texts may be of any length.
"""

from __future__ import annotations

import heapq
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers

from gleaner.llm.common import documents, released, slices, text_buffer
from gleaner.llm.pieces import Pieces

WORD_BPE = "word_bpe_49k.json"
#: White space of the normaliser's pattern (Unicode White_Space).
_SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe(Pieces):
    """Encoder and decoder for a vocabulary file of the word-end kind."""

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec["model"]
        vocab = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        chars = byte_chars()
        self.inner = [vocab[c] for c in chars]
        self.final = [vocab[c + suffix] for c in chars]
        self.names = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        del self.spec

    def merge(self, ids: list[int]) -> list[int]:
        """Applies the merges of lowest rank first, leftmost first among equals."""
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                queue.append((found[0], i, found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, made = heapq.heappop(queue)
            if ids[i] < 0 or (j := after[i]) < 0:
                continue  # stale: the symbol is gone or is the last one now
            found = merges.get((ids[i], ids[j]))
            if not found or found[1] != made:
                continue  # stale: another pair stands here now
            ids[i], ids[j] = made, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((made, ids[k])):
                    heapq.heappush(queue, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := merges.get((ids[h], made))):
                heapq.heappush(queue, (found[0], h, found[1]))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> list[int]:
        data = word.encode()
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        return self.merge(ids)

    def words(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(self.word(w), np.int32) for w in words]

    def whole(self, text: str) -> np.ndarray:
        ids: list[int] = []
        for part in self.specials.split(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                for chunk in _SPACE.split(part):
                    for word in self.pattern(chunk):
                        ids += self.word(word)
        return np.array(ids, np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Vocabulary strings, a space between them (the file names no decoder)."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist()])


@lru_cache(2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def bpe_encode(
    df: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Adds binary ids (little-endian unsigned 32-bit) and, if named, their decoded text."""
    path = path or public_tokenizers.path(WORD_BPE)
    outputs = [ids, *([decoded] if decoded else [])]
    kept = [c for c in df.columns if c not in outputs or c == text]
    stays = [c for c in kept if c not in outputs]
    fields = [df.schema[c] for c in stays] + [T.StructField(ids, T.BinaryType())]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType()))

    def run(batches):
        coder = bpe(path)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            data, offsets = text_buffer(batch.column(at))
            for i, j in slices(offsets):
                got, n = coder.encode_bytes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ends = np.concatenate([[0], np.cumsum(n)])
                packed = [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(got.astype("<u4"))]
                part = batch.slice(i, j - i)
                arrays = [part.column(batch.schema.get_field_index(c)) for c in stays]
                arrays.append(pa.Array.from_buffers(pa.binary(), j - i, packed))
                if decoded:
                    arrays.append(pa.array([coder.decode(got[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [*stays, *outputs])

    return df.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(released(run), T.StructType(fields))


def bpe_decode(df: DataFrame, ids: str = "ids", path: str | None = None, decoded: str = "decoded") -> DataFrame:
    """Adds the decoded text of binary ids; null ids give empty text."""
    path = path or public_tokenizers.path(WORD_BPE)
    stays = [c for c in df.columns if c != decoded]
    schema = T.StructType([df.schema[c] for c in stays] + [T.StructField(decoded, T.StringType())])

    def run(batches):
        coder = bpe(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            texts = pa.array([coder.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in column], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*stays, decoded])

    return df.select(*(F.col(f"`{c}`") for c in stays)).mapInArrow(run, schema)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of every document."""
    coded = bpe_encode(documents(spark, sf_dir).select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
