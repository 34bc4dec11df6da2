"""Prefix dynamic programming against plain merging and against tiktoken."""
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import LONG, ROWS, docs
from vigil.llm import bpe
from vigil.llm.common import ship
from vigil.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def small(*merged: bytes) -> dict[bytes, int]:
    return {bytes([i]): i for i in range(256)} | {t: 256 + k for k, t in enumerate(merged)}


@pytest.mark.parametrize("ranks_", [
    small(b"aa", b"aaa", b"ab", b"aab"), small(b"ab", b"bc", b"abc", b"cd"), small(b"bc", b"ab", b"abc"),
    small(b"aa", b"aaaa", b"aaaaaaaa"), small(b"ba", b"ab", b"aba", b"bab", b"abab")])
def test_table_equals_plain_merging(ranks_):
    v, rnd = bpe.Vocabulary(ranks_), random.Random(7)
    for _ in range(1500):
        data = bytes(rnd.choice(b"abcd"[:rnd.randrange(1, 5)]) for _ in range(rnd.randrange(30)))
        table = bpe.PrefixTable(v, data)
        want = [ranks_[t] for t in bpe.merge_by_rank(data, ranks_)]
        assert table.ids() == want
        for end in range(len(data) + 1):                      # every prefix is in the table
            assert table.ids(end) == [ranks_[t] for t in bpe.merge_by_rank(data[:end], ranks_)]


def test_a_token_that_no_merge_reaches_is_used_for_a_whole_match_only():
    ranks_ = small(b"abc")                                     # neither ab nor bc: merges never make abc
    e = bpe.Encoder(bpe.Vocabulary(ranks_), PATTERN)
    t = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks_, special_tokens={})
    for text in ("abc", "abcabc", "abc abc"):
        assert e.ids(text) == t.encode_ordinary(text)


def test_texts_equal_tiktoken(vocabulary, reference):
    e, rnd = bpe.Encoder(vocabulary, PATTERN), random.Random(3)
    bits = ["a", "the", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "é", "é", "日本", "Ж", "😀", "‍",
            "0", "12", "٣", "'", "'s", "'ll", "-", "==", "ſ", "ß", "\x00", "﻿"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(60)))
        assert e.ids(text) == reference.encode_ordinary(text), text


def test_every_kind_of_code_point_splits_as_tiktoken_does(vocabulary, reference):
    e = bpe.Encoder(vocabulary, PATTERN)
    points = [*range(0x3000), *range(0x3000, 0xD800, 7), *range(0xE000, 0x20000, 11), *range(0x20000, 0x110000, 997)]
    for c in points:
        text = f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 '{chr(c)}s  {chr(c)}"
        assert e.ids(text) == reference.encode_ordinary(text), hex(c)


def test_both_patterns_split_alike():
    import regex

    plain, full, rnd = bpe.plain_pattern(PATTERN), regex.compile(PATTERN), random.Random(9)
    points = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for c in points:
        text = f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 '{chr(c)}s  {chr(c)}"
        assert plain.findall(text) == full.findall(text), hex(c)
    for _ in range(300):
        text = "".join(chr(rnd.choice(points)) for _ in range(200))
        assert plain.findall(text) == full.findall(text)
    assert bpe.plain_pattern(r"\p{Lu}+") is None and bpe.plain_pattern(r"\w+") is None


@pytest.mark.parametrize("text,n", [(" " * 1_000_000, None), ("\n" * 1_000_000 + "x", None), ("a" * 400_000, None), ("日本" * 150_000, None)])
def test_very_long_matches(vocabulary, text, n):
    ids = bpe.Encoder(vocabulary, PATTERN).ids(text)
    assert b"".join(vocabulary.bytes_of[i] for i in ids).decode() == text
    head = bpe.merge_by_rank(text[:40].encode(), vocabulary.ranks)      # far from the end, the start is merged the same
    assert [vocabulary.bytes_of[i] for i in ids[:3]] == head[:3] or len(set(text)) == 1


def test_appends_and_edits_of_the_table(vocabulary, ranks):
    rnd = random.Random(5)
    word = lambda n: bytes(rnd.choice(b"aabcdeinrst heon") for _ in range(n))     # noqa: E731
    for _ in range(60):
        table, data = bpe.PrefixTable(vocabulary), b""
        for _ in range(4):
            piece = word(rnd.randrange(20))
            table.append(piece)
            data += piece
        assert table.ids() == bpe.PrefixTable(vocabulary, data).ids()
        for _ in range(4):
            a = rnd.randrange(len(data) + 1)
            b = min(len(data), a + rnd.randrange(6))
            new = word(rnd.randrange(6))
            table.replace(a, b, new)
            data = data[:a] + new + data[b:]
            assert bytes(table.data) == data
            assert table.last == bpe.PrefixTable(vocabulary, data).last
    assert table.ids() == [ranks[t] for t in bpe.merge_by_rank(data, ranks)]


def test_an_edit_fills_in_only_what_is_near(vocabulary):
    data = b"the rain in spain stays mainly in the plain " * 500
    table = bpe.PrefixTable(vocabulary, data)
    assert table.replace(10_000, 10_003, b"snow") < 20 * vocabulary.longest
    assert table.last == bpe.PrefixTable(vocabulary, data[:10_000] + b"snow" + data[10_003:]).last


def test_edits_of_texts(vocabulary, reference):
    e, rnd = bpe.Encoder(vocabulary, PATTERN), random.Random(11)
    bits = ["word", " ", "  ", "'", "s", "'ll", "12", "\n\n", "é", "-", "x"]
    text = bpe.EditableText(e, "")
    for _ in range(400):
        a = rnd.randrange(len(text.text) + 1)
        b = min(len(text.text), a + rnd.randrange(8))
        text.replace(a, b, "".join(rnd.choice(bits) for _ in range(rnd.randrange(7))))
        assert text.ids() == reference.encode_ordinary(text.text)
    text = bpe.EditableText(e, "some words of a longer text " * 300)
    assert text.replace(4000, 4004, "other") < 8
    assert text.append(" and an end") < 8
    assert text.ids() == reference.encode_ordinary(text.text)


@pytest.fixture(scope="module")
def shared(spark):
    ship(spark)
    return bpe.share(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_null_empty_long_and_repeated_rows(spark, shared, reference):
    got = bpe.decode(bpe.encode(docs(spark), shared, PATTERN), shared).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded)) for r in got) == \
        sorted((i is None, i or 0, (t or "").encode()) for i, t, _ in ROWS)
    for r in got:
        assert r.ids == reference.encode_ordinary(bytes(r.decoded).decode())
    assert any(bytes(r.decoded).decode() == LONG for r in got)
    assert bpe.decode(bpe.encode(docs(spark, []), shared, PATTERN), shared).count() == 0


def test_edited_rows(spark, shared, reference):
    rows = [(1, "one two three", [(4, 7, "2"), (0, 0, ">> ")]), (2, None, None), (3, "same", []), (None, "gone", [(0, 4, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    got = {r.doc_id: r.ids for r in bpe.reencode(df, shared, PATTERN).collect()}
    assert got == {1: reference.encode_ordinary(">> one 2 three"), 2: [], 3: reference.encode_ordinary("same"), None: []}


def test_query_equals_tiktoken(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = REGISTRY["op11_bpe_prefix"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
