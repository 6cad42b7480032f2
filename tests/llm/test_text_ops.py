"""op1, op2, op9, op10 and shared parts against brute force, and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.llm import common, langid, license_scan, simhash
from gleaner.llm.bpe import Bpe, bpe_decode, bpe_encode, op9_bpe
from gleaner.llm.common import ALNUM, LOWER, SOLID, Words, byte_class, grams, slices, text_buffer
from gleaner.llm.graph import components
from gleaner.llm.token_files import Encoder

import public_tokenizers

ODD = ["", None, "   \n\t", "a", "Straße É'S İx ΣΑΣ. e\u0301", "x" * 30_000, "word " * 9_000, "<|endoftext|> <|EndOfText|>", "\x1c\x1d \x85 \xa0　", "你好 世界 😀", "don't 123 a,b"]
#: A column of the outputs' names, in another type, must not disturb anything.
CLASH = ("ids", "score", "lang_pred", "id", "hits", "start")


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def find_components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# words and slices


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words(texts):
    data, offsets = text_buffer(pa.array(texts, pa.string()))
    for table, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (SOLID, r"[^\x20\x09-\x0D]+")):
        words = Words(LOWER[data] if len(data) else data, offsets, table)
        want = [re.findall(pattern, lower_ascii(t)) for t in texts]
        raw = LOWER[data].tobytes() if len(data) else b""
        got = [raw[a:b].decode() for a, b in zip(words.starts, words.ends)]
        assert got == [w for ws in want for w in ws] and words.counts.tolist() == [len(w) for w in want]
        assert len({*zip(got, words.hashes.tolist())}) == len(set(got)) == len(set(words.hashes.tolist()))


def test_slices_and_grams():
    offsets = np.array([0, 3, 3, 50, 51, 52])
    assert list(slices(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert byte_class((1, 2))[1] and not byte_class((1, 2))[3]
    h = np.arange(5, dtype=np.uint64)
    assert len(grams(h, 3)) == 3 and len(grams(h[:2], 3)) == 0 and grams(h, 1)[0] != grams(h, 1)[1]


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(500 + i, 501 + i) for i in range(60)]
    df = spark.createDataFrame([e for e in edges if e[0] != e[1]], "a long, b long")
    want = find_components({x for a, b in edges if a != b for x in (a, b)}, edges)
    assert {x.node: x.root for x in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


# op1


def brute_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_op1(spark, tables):
    r = random.Random(1)
    filler = "cc by general public license all rights reserved the of Cc-BY ALL é 1".split()
    docs = [" ".join(r.choice(filler) for _ in range(r.randrange(60))) for _ in range(80)]
    docs += ["This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0."]
    docs += [(0, "all rights reserved. All Rights Reserved"), (0, docs[0]), (None, "cc by"), *((100 + i, x) for i, x in enumerate(ODD))]
    at = tables(docs)
    rows = license_scan.op1_license_scan(spark, at).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    want = sorted(((i if not isinstance(d, tuple) else d[0], *brute_license(d if not isinstance(d, tuple) else d[1])) for i, d in enumerate(docs)), key=str)
    assert got == want
    labels = {r.doc_id: (r.labels, r.score) for r in rows}
    assert labels[80] == ("gpl,gpl-3.0", 1.0) and labels[81] == ("mit", 1.0)
    assert labels[82] == ("cc-by,cc-by-nc-4.0", 1.0) and labels[83] == ("apache-2.0", 1.0)
    assert all({*r.base_labels.split(",")} - {""} <= {*r.labels.split(",")} and 0 <= r.score <= 1 for r in rows)


def test_op1_clashing_columns_and_shuffled_join(spark, tables, monkeypatch):
    r = random.Random(8)
    filler = "cc by general public license all rights reserved the of mit".split()
    docs = [(i % 20, " ".join(r.choice(filler) for _ in range(r.randrange(40)))) for i in range(30)] + [(None, None), (None, "cc by"), (1, "x " * 20_000 + "all rights reserved")]
    at = tables(docs, **{k: [1] * len(docs) for k in (*CLASH, "rid", "n_words", "label")})
    rows = lambda: sorted(map(tuple, license_scan.op1_license_scan(spark, at).collect()), key=str)
    few = rows()
    assert sorted((x[0], *x[1:6]) for x in few if x[0] is not None) == sorted((i, *brute_license(t)) for i, t in docs if i is not None)
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", 1)  # every hash goes on and the join shuffles
    assert rows() == few


def test_op1_merges_neighbouring_diagonals(spark, tables):
    mit = next(t.text for t in license_scan.NOTICES if t.text.startswith("permission is hereby granted"))
    words = mit.split()
    edited = " ".join(words[:10] + ["put", "in"] + words[10:25] + words[27:])
    _, found = license_scan.license_scan(spark.read.parquet(tables([edited, " ".join(words[:9])]) + "/documents.parquet"))
    rows = [r for r in found.collect() if r.label == "mit"]
    assert len(rows) == 1 and 0.8 < rows[0].coverage < 1 and rows[0].first_word == 0


# op2


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_op2(spark, tables):
    r = random.Random(2)
    base = [" ".join(r.choice("abcdefgh") + str(r.randrange(9)) for _ in range(r.randrange(3, 120))) for _ in range(25)]
    docs = base + base[:5]
    for t in base[:15]:
        words = t.split()
        words[r.randrange(len(words))] = "edited"
        docs += [" ".join(words), t + " more", t.upper()]
    docs = [(i + 10, d) for i, d in enumerate(docs)] + [(1000 + i, x) for i, x in enumerate(ODD)] + [(10, base[0])]
    rows = simhash.op2_simhash(spark, tables(docs)).collect()
    prints = [(i, brute_fingerprint(t)) for i, t in docs]
    assert sorted((r.doc_id, r.fingerprint) for r in rows) == sorted((i, f"{p:016x}") for i, p in prints)
    ids = {}
    for i, p in prints:
        ids.setdefault(p, []).append(i)
    distinct = sorted(ids)
    comp = find_components(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for p in distinct:
        least[comp[p]] = min([least.get(comp[p], 10**9), *ids[p]])
    assert sorted((r.doc_id, r.component_id) for r in rows) == sorted((i, least[comp[p]]) for i, p in prints)
    assert len({r.component_id for r in rows}) < len(distinct)


def test_op2_null_ids_and_clashing_columns(spark, tables):
    text = lambda k: " ".join(f"w{k * 31 + i}" for i in range(60))
    docs = [(None, text(1)), (4, text(1)), (3, text(1).upper()), (None, text(2)), (None, text(2)), (7, None), (None, "")]
    rows = simhash.op2_simhash(spark, tables(docs, **{k: [1] * 7 for k in (*CLASH, "fp", "root", "salt", "least")})).collect()
    assert sorted(((x.doc_id, x.component_id) for x in rows), key=str) == sorted([(None, 3), (4, 3), (3, 3), (None, None), (None, None), (7, 7), (None, 7)], key=str)


def test_intermediate_tables_are_cleared(spark, tables):
    import os

    simhash.checkpoint(spark.range(3))
    df = common.stored(spark.range(3), "some")
    path = common._made[-1]
    assert df.count() == 3 and os.path.isdir(path)
    assert common.clear(spark) >= 1 and not os.path.exists(path) and common.clear(spark) == 0


def test_a_cluster_needs_a_shared_folder(monkeypatch, spark):
    class Context:
        master = "spark://host:7077"
        _jsc = spark.sparkContext._jsc

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})()

    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(Session())


def test_op2_hot_keys_give_the_same_links(spark):
    r = random.Random(5)
    prints = set()
    for center in (r.getrandbits(64), r.getrandbits(64)):
        for _ in range(60):
            x = center
            for _ in range(r.randrange(8)):
                x ^= 1 << r.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = find_components(prints, [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4])
    for hot in (10**9, 5):
        edges = [(e.a, e.b) for e in simhash.links(df, hot=hot).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in edges)
        got = find_components(prints, edges)
        groups = lambda c: sorted(sorted(k for k in c if c[k] == v) for v in set(c.values()))
        assert groups(got) == groups(want)


@pytest.mark.parametrize("at_once", [100, 5_000, 10**8])
def test_meet_in_bounded_memory(at_once):
    rng = np.random.default_rng(1)
    center = rng.integers(0, 2**63, dtype=np.uint64)
    prints = np.unique(center ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)))
    found = simhash.meet(prints, np.full(len(prints), 2), 64, max(at_once, 3000))
    want = find_components(prints.tolist(), [(a, b) for a in prints.tolist() for b in prints.tolist() if (a ^ b).bit_count() <= 4])
    assert len(set(find_components(prints.tolist(), found.tolist()).values())) == len(set(want.values()))


# op9


@pytest.fixture(scope="module")
def library():
    import tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=("Cs", "Cn", "Co")), max_size=60))
@settings(max_examples=150, deadline=None)
def test_bpe_is_the_librarys(library, text):
    coder = test_bpe_is_the_librarys.__dict__.setdefault("coder", Bpe(public_tokenizers.path("word_bpe_49k.json")))
    data, offsets = text_buffer(pa.array([text, text + " x"]))
    ids, n = coder.encode_bytes(data, offsets)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids[: n[0]].tolist() == coder.whole(text).tolist() == want
    assert coder.decode(ids[: n[0]]) == library.decode(want, skip_special_tokens=False)


@given(st.lists(st.text(alphabet="aB'é,. 1<|endoftext>ΣİÉ\x1c\u0301s", max_size=30), max_size=5))
@settings(max_examples=150, deadline=None)
def test_pieces_are_the_librarys(library, texts):
    for kind in (Bpe, Encoder):
        coder = test_pieces_are_the_librarys.__dict__.setdefault(kind, kind(public_tokenizers.path("word_bpe_49k.json")))
        ids, n = coder.encode_bytes(*text_buffer(pa.array(texts, pa.string())))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for x in want for i in x] and n.tolist() == [len(x) for x in want]


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def test_pieces_of_one_hash_are_told_apart(library, monkeypatch):
    r = random.Random(1)
    texts = [thue_morse(n, x) for n in (7, 8, 9, 255, 256, 257, 1024, 2048, 4096) for x in ("ab", "ba")]
    texts += [" ".join("".join(r.choice("abcdeé'.,9") for _ in range(r.randrange(1, 12))) for _ in range(40)) for _ in range(30)] + ["", "<|endoftext|> x"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    plain = common.span_hashes
    for bits in (64, 4, 0):
        monkeypatch.setattr(common, "span_hashes", lambda *a, bits=bits, **k: plain(*a, **k) & np.uint64((1 << bits) - 1))
        for kind in (Bpe, Encoder):
            coder = kind(public_tokenizers.path("word_bpe_49k.json"))
            for step in (1, 9, len(texts)) * 2:
                got = []
                for i in range(0, len(texts), step):
                    ids, n = coder.encode_bytes(*text_buffer(pa.array(texts[i : i + step])))
                    got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
                assert got == want


def test_op9(spark, tables, library):
    docs = [(i, x) for i, x in enumerate([*ODD, "Thatiin lyor. É ñandú", "aaaa" * 50])] + [(None, "x"), (0, "twice")]
    rows = op9_bpe(spark, tables(docs, ids=[7] * len(docs), decoded=["x"] * len(docs))).collect()
    want = []
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_bpe_operators_keep_columns(spark, tables):
    df = spark.read.parquet(tables(["ab cd", None], ids=["k", "l"]) + "/documents.parquet")
    coded = bpe_encode(df, decoded="text")
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "ids", "text"] and coded.count() == 2
    assert [r.decoded for r in bpe_decode(coded).orderBy("doc_id").collect()] == [r.text for r in coded.orderBy("doc_id").collect()]


# op10


def phrases(text, sample):
    """Longest-match parsing of the whole text as defined, by substring search."""
    count = i = 0
    code = lambda s: "".join(c if c.isalpha() else " " for c in s.lower())
    text, sample = code(text), code(sample)
    while i < len(text):
        n = 1
        while i + n <= len(text) and text[i : i + n] in sample:
            n += 1
        i += max(1, n - 1)
        count += 1
    return count


@pytest.mark.parametrize("lane", [3, 64, 512])
def test_phrase_counts_are_longest_matches(monkeypatch, lane):
    monkeypatch.setattr(langid, "LANE", lane)
    r = random.Random(4)
    sample = "".join(r.choice("abcd ef") for _ in range(400))
    texts = ["".join(r.choice("abcd efxz") for _ in range(n)) for n in (0, 1, 5, 100, 511, 512, 513, 1500)]
    texts += [sample, sample[7:] + sample[:90], sample[3:200] * 4, ""]  # phrases longer than a lane
    learned = langid.Languages((("l", sample),))
    data, offsets = text_buffer(pa.array(texts))
    costs = learned.costs(data, offsets)[:, 0]
    cost = learned.parsers[0].cost
    assert [round(c * max(1, len(t)) / cost) for c, t in zip(costs, texts)] == [phrases(t, sample) for t in texts]


def test_languages_are_learned_from_texts_alone(spark):
    rows = [(i, None if i % 2 else "", "aa") for i in range(200)] + [(200 + i, f"balona {i} " * 50, "aa") for i in range(9)] + [(300, "krz", "bb"), (301, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = dict(langid.fit_languages(df, docs=5, chars=100))
    assert [*learned] == ["aa", "bb"] and len(learned["aa"]) == 5 * 20 + 4 and learned["bb"] == "krz"


def test_op10(spark, tables):
    r = random.Random(6)
    made = {"aa": ["ba", "na", "lo", "mi"], "bb": ["ströh", "krz", "pf", "enz"], "cc": ["què", "ñu", "sí", "tor"]}
    docs = []
    for i in range(240):
        lang = r.choice(list(made))
        docs.append((i, " ".join("".join(r.choice(made[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(20, 60))), lang))
    docs += [(300, None, "aa"), (301, "123 ... !", "bb"), (302, "", "cc"), (303, "balona " * 5000, None), (None, "strohkrz pfenz", "bb"), (5, docs[5][1], docs[5][2])]
    rows = langid.op10_language_id(spark, tables(docs, score=[1] * len(docs), lang_pred=["zz"] * len(docs))).collect()
    by = {}
    for x in rows:
        by.setdefault(x.doc_id, []).append(x)
    assert len(rows) == len(docs) and len(by[5]) == 2 and by[5][0] == by[5][1]
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    assert {by[k][0].lang_pred for k in (300, 301, 302)} == {"und"} and by[303][0].lang_pred == "aa"
    held = [x for x in rows if x.held_out and x.doc_id is not None and x.doc_id < 240]
    right = sum(x.lang_pred == docs[x.doc_id][2] for x in held)
    assert len(held) > 40 and right / len(held) > 0.97 and all(0 <= x.score <= 1 for x in rows)


def test_empty_tables(spark, tables):
    at = tables([])
    for query in (license_scan.op1_license_scan, simhash.op2_simhash, op9_bpe, langid.op10_language_id):
        assert query(spark, at).count() == 0
    at = tables([(1, "no label here", None)])
    assert langid.op10_language_id(spark, at).first().lang_pred == "und"
