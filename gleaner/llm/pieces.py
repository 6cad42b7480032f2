"""Tokenizers that give each piece of text to their merges once, and keep the ids in arrays.

White space separates chunks, and in plain ASCII the words of the vocabulary's pattern are runs of letters,
single digits and runs of other signs, none of which depends on what stands beside it; a chunk with an apostrophe
or other bytes is one piece. Pieces are found and told apart by vectorised passes over the bytes: equal ones by a
64-bit hash, then by their bytes. Only pieces not seen before become strings. What is kept is bounded (KEPT, and
KEPT_BYTES of their spelling).
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex

from gleaner.llm.common import LOWER, SOLID, Words, distinct_spans, same_spans

#: Pieces that a worker keeps, and the bytes that spell them.
KEPT, KEPT_BYTES = 1_500_000, 24 << 20
#: Classes of bytes: white space, letters, digits, other ASCII, and what only the pattern itself can split.
SPACE, LETTER, DIGIT, OTHER, HARD = range(5)
_CLASS = np.full(256, OTHER, np.int8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_CLASS[0x30:0x3A] = DIGIT
_CLASS[[*range(0x1C, 0x20), ord("'"), *range(0x80, 0x100)]] = HARD
#: Four separators that Python takes for white space and the normaliser does not.
ODD_SPACE = regex.compile("[\x1c-\x1f]")


class Pieces:
    """The encoder of a vocabulary file of the word-end kind; subclasses say how words and whole texts are encoded."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        split = next(p for p in self.spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"]).findall
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.marks = [m.encode() for m in self.special]
        self.clear()

    def clear(self) -> None:
        """Nothing is kept: the sorted hashes of pieces, where each is spelled, and where in the ids it begins and how many it has."""
        self.known, self.begin = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.size, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.spelled, self.length = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.bytes = np.zeros(0, np.uint8)

    def whole(self, text: str) -> np.ndarray:
        """The ids of any text."""
        raise NotImplementedError

    def words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of normalised words of the pattern."""
        raise NotImplementedError

    def split(self, piece: str) -> list[str] | None:
        """The words of a piece that holds no special token; None: only whole() can tell."""
        if ODD_SPACE.search(piece):
            return None
        if piece.isascii() and "'" not in piece:
            return [piece]
        # as the normaliser does, to which a final sigma is not special
        return self.pattern(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())

    def fresh(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of pieces not seen before."""
        parts = [self.split(p) for p in pieces]
        ids = iter(self.words([w for words in parts if words for w in words]))
        none = np.zeros(0, np.int32)
        return [
            self.whole(p) if words is None else next(ids) if len(words) == 1 else np.concatenate([none, *(next(ids) for _ in words)])
            for p, words in zip(pieces, parts, strict=True)
        ]

    @staticmethod
    def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and past-last byte of every piece, and the pieces before each document."""
        chunks = Words(data, offsets, SOLID, hashed=False)
        kind = _CLASS[data]
        hard = np.concatenate([[0], np.cumsum(kind == HARD)])
        whole = np.flatnonzero(hard[chunks.ends] > hard[chunks.starts])
        cover = np.zeros(len(data) + 1, np.int8)  # bytes of chunks that stay in one piece
        cover[chunks.starts[whole]] = 1
        cover[chunks.ends[whole]] -= 1
        kind[np.cumsum(cover[:-1], dtype=np.int8) > 0] = HARD
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        cut[chunks.starts] = True
        cut &= kind != SPACE
        starts = np.flatnonzero(cut)
        # a piece ends where the next one starts or where its chunk ends
        chunk = np.searchsorted(chunks.starts, starts, side="right") - 1
        ends = np.minimum(np.append(starts[1:], len(data)), chunks.ends[chunk])
        return starts, ends, np.searchsorted(starts, offsets)

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive documents, and how many each has."""
        raw = data.tobytes()
        if marked := any(m in raw for m in self.marks):
            # case matters to special tokens: chunks as they are, and none of them is kept
            chunks = Words(data, offsets, SOLID, hashed=False)
            starts, ends, first = chunks.starts, chunks.ends, chunks.first
            self.clear()
        else:
            data = LOWER[data]
            raw = data.tobytes()
            starts, ends, first = self.spans(data, offsets)
        unique, at, which = distinct_spans(data, starts, ends)
        first_byte, length = starts[at], (ends - starts)[at]
        near = np.searchsorted(self.known, unique)
        begin, size = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
        new, alien = np.ones(len(unique), bool), np.zeros(len(unique), bool)
        if len(self.known):
            held = np.minimum(near, len(self.known) - 1)
            new = self.known[held] != unique
            alien = ~new & (self.length[held] != length)
            same = np.flatnonzero(~new & ~alien)
            alien[same] = ~same_spans(data, first_byte[same], self.bytes, self.spelled[held[same]].astype(np.int64), length[same])
            begin, size = self.begin[held].astype(np.int64), self.size[held].astype(np.int64)
        # of pieces that share a hash one is kept, the others are encoded each time
        fresh = new | alien
        later = np.flatnonzero(new)
        new[later[np.setdiff1d(np.arange(len(later)), np.unique(unique[later], return_index=True)[1])]] = False
        ids = self.ids
        if fresh.any():
            texts = [raw[a:b].decode() for a, b in zip(first_byte[fresh].tolist(), (first_byte + length)[fresh].tolist(), strict=True)]
            got = [self.whole(t) for t in texts] if marked else self.fresh(texts)
            size[fresh] = [len(x) for x in got]
            begin[fresh] = len(ids) + np.cumsum(size[fresh]) - size[fresh]
            ids = np.concatenate([ids, *got])
        n = size[which]
        before = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.repeat(begin[which] - before[:-1], n) + np.arange(before[-1])]
        if marked or len(self.known) + new.sum() > KEPT or len(self.bytes) + length[new].sum() > KEPT_BYTES:
            self.clear()
        elif new.any():
            order = np.flatnonzero(new)[np.argsort(unique[new])]
            spelling = length[order]
            inside = np.repeat(first_byte[order] - np.cumsum(spelling) + spelling, spelling) + np.arange(spelling.sum())
            place = near[order]
            self.spelled = np.insert(self.spelled, place, len(self.bytes) + np.cumsum(spelling) - spelling)
            self.bytes = np.concatenate([self.bytes, data[inside]])
            for name, values in (("known", unique), ("begin", begin), ("size", size), ("length", length)):
                setattr(self, name, np.insert(getattr(self, name), place, values[order]))
            self.ids = ids
        return out, np.diff(before[first])
