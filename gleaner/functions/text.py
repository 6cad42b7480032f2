"""Text expressions: normal form, sentences, tokens, rounding and patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, with the four separators that Java leaves out.
SPACE = r"(?U)[\s\x1c-\x1f]+"
TERMINAL = ".!?"


def normalized(text: Column) -> Column:
    """Each run of white space is one space, none at the ends; case and punctuation stay."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def sentences(text: Column) -> Column:
    """Pieces of normalized text: a sentence ends after `.`, `!` or `?` before white space or at the end.

    Every piece but the first keeps the space before it, so the pieces' lengths add up to the text's.
    """
    return F.split(text, r"(?<=[.!?])(?=\s)", -1)


#: Pieces whose lengths are summed at once.
BLOCK = 128


def bound(value: Column, f) -> Column:
    """f of a value that is computed once, however often f mentions it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def running_starts(pieces: Column) -> Column:
    """Where each piece begins. pieces: a column, so that it is split once. Sums go block by block: linear in the pieces."""
    block = lambda b: F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK))
    longer = lambda starts, n: F.concat(starts, F.array(F.element_at(starts, -1) + n))
    blocks = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda n, p: n + F.length(p)))
    within = lambda base, b: F.aggregate(block(b), F.array(base), lambda starts, p: longer(starts, F.length(p)))
    starts = lambda bases: F.transform(blocks, lambda b: F.slice(within(F.get(bases, b), b), F.lit(1), F.size(block(b))))
    return F.flatten(bound(F.aggregate(sums, F.array(F.lit(0)), longer), starts))


def words(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def rounded(x: Column, digits: int) -> Column:
    """Half up by a floor of doubles: the form on which engines agree."""
    scale = float(10**digits)
    return F.floor(x.cast("double") * scale + 0.5) / scale


def quoted(literal: str) -> str:
    """A literal as a pattern for Java and Python."""
    return re.sub(r"([^\w\s])", r"\\\1", literal)


def phrase_pattern(phrase: str) -> str:
    """Words with white space between; X, Y and Z stand for any word; a word boundary at a letter or digit."""
    body = r"\s+".join(r"\w+" if w in ("X", "Y", "Z") else quoted(w) for w in phrase.split())
    left, right = (r"\b" if c.isalnum() else "" for c in (phrase[:1], phrase[-1:]))
    return f"(?i){left}{body}{right}"


def term_pattern(term: str) -> str:
    return rf"(?i)\b{quoted(term)}\b"


def java(pattern: str) -> str:
    """A Python pattern for Java: Unicode classes, and only a newline ends a line."""
    return "(?Ud)" + pattern


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(java(pattern))


def first_match(text: Column, pattern: str) -> Column:
    """The first match; empty if there is none."""
    return F.regexp_extract(text, java(f"({pattern})"), 1)


def occurrences(text: Column, literal: str) -> Column:
    """How often a literal stands in a text, without overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal)).cast("int")
