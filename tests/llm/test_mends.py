"""Hard inputs: very long runs, languages of few long texts, shared articles, broken pages, many scripts, license families,
sharding laws for every count."""
import math
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm import embeddup, htmlmain, langid, licenses, packing, pii, sharding
from vigil.llm.common import ship

TOK = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def sp(spark):
    ship(spark)
    return spark


# ----------------------------------------------------------------- packing --
@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000, "a" * 1_000_000, "word " + " " * 700_000 + "end" + "\r\n" * 300_000,
                                  "x" * 60_000 + " y" * 1000, " " * 49_999 + "z"], ids=["blanks", "breaks", "letters", "mixed", "edge", "below"])
def test_ids_of_very_long_runs(text):
    got = np.frombuffer(packing.Encoder(TOK).ids(text), "<u4").tolist()
    assert got == Tokenizer.from_file(TOK).encode(text, add_special_tokens=False).ids


def test_packing_of_very_long_runs(sp):
    df = sp.createDataFrame([(1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "short")], "doc_id long, text string")
    rows = packing.pack_documents(df, TOK).collect()
    total = {i: len(Tokenizer.from_file(TOK).encode(t, add_special_tokens=False).ids) + 1 for i, t in ((1, " " * 1_000_000), (2, "\n" * 1_000_000), (3, "short"))}
    sizes = Counter()
    for r in rows:
        sizes[r.doc_id] += r.length
    assert sizes == total


# ---------------------------------------------------------------- language --
def slow_bits(counts, text):
    """Code length of a folded text, byte by byte, from successor counts per context (method C)."""
    data, bits = b" " * langid.ORDER + text.encode(), 0.0
    for at in range(langid.ORDER, len(data)):
        for order in range(langid.ORDER, -1, -1):
            seen = counts.get(data[at - order:at], Counter()) if order else counts[b""]
            n, q = sum(seen.values()), len(seen)
            if seen[data[at]]:
                bits -= math.log2(seen[data[at]] / (n + q))
                break
            if n:
                bits -= math.log2(q / (n + q))
        else:
            bits += 8.0
    return bits


def slow_counts(texts):
    counts = defaultdict(Counter)
    for t in texts:
        data = b" " * langid.ORDER + t.encode()
        for at in range(langid.ORDER, len(data)):
            for order in range(langid.ORDER + 1):
                counts[data[at - order:at]][data[at]] += 1
    return counts


def test_code_lengths_equal_a_plain_ppm():
    learned = {"aa": ["tuli mene koti talo maa", "talo on maa ja koti"], "bb": ["the house is a home", "a home by the sea is a house"]}
    scorer = langid.Scorer({g: langid.train(t) for g, t in learned.items()})
    texts = ["koti", "the sea", "talo the home maa zzz", "öäü ß", "a", "house " * 50]
    got = scorer.total_bits(texts)
    for i, t in enumerate(texts):
        for k, g in enumerate(scorer.langs):
            assert abs(got[i][k] - slow_bits(slow_counts(learned[g]), t)) < 1e-9 * max(1.0, got[i][k])


@pytest.mark.parametrize("n", [1, 6])
def test_a_language_of_few_long_texts_is_learned(sp, n):
    long = "tuli mene koti talo maa vesi ilma " * 180_000                      # about 6 MB
    rows = [(i, f"{long}{i}", "aa") for i in range(n)] + [(100 + i, f"the house number {i} is a home by the sea", "bb") for i in range(400)]
    model = langid.fit(sp.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(model) == ["aa", "bb"]
    got = langid.predict(sp.createDataFrame([(1, "tuli mene koti talo"), (2, "the home by the sea")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "aa", 2: "bb"}


def test_the_sample_is_bounded_and_equal_rows_count_once(sp):
    rows = [(None, "same words again", "aa")] * 3000 + [(i, f"talo {i} koti " * 40, "aa") for i in range(300)]
    df = sp.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, sample_bytes=20_000)
    seen = model["aa"][0]
    n = sum(1 / (2 ** c) for c in seen["cost"])                                # share of all bytes: below 1 by the escape
    assert 0.9 < n < 1.0
    one = langid.fit(sp.createDataFrame(rows[:1] + rows[3000:], df.schema))
    all_ = langid.fit(df)
    assert all((a["keys"] == b["keys"]).all() and (a["cost"] == b["cost"]).all() for a, b in zip(one["aa"], all_["aa"]))


# -------------------------------------------------------------------- html --
def site(k, body):
    return (f"<html><head><title>t{k}</title></head><body><div class='top'><a href='/'>Home</a> <a href='/n'>News</a></div>{body}"
            f"<div class='low'>Printed by the daily <b>press</b> of town</div></body></html>")


@pytest.mark.parametrize("copies", [4, 40])
@pytest.mark.parametrize("box", ["article", "div"])
def test_an_article_that_some_pages_share_is_kept(sp, copies, box):
    shared = (f"<{box} id='a'><h1>A shared title</h1><p>First words of the shared text.</p><table><tr><td>cell one</td><td>cell two</td></tr></table>"
              "<blockquote>As somebody said.</blockquote><p class='time'>Printed at {k}</p><p>Last words.</p></" + box + ">")
    rows = [(k, f"http://h.example/{k}", site(k, shared.replace("{k}", f"10:{k:02d}"))) for k in range(copies)]
    rows += [(1000 + k, f"http://h.example/x{k}", site(k, f"<{box} id='a'><h1>Title {k} alone</h1><p>Own words {k * 7} of page {k}.</p></{box}>"))
             for k in range(400 if copies == 40 else 40)]
    got = {r.page_id: r.text for r in htmlmain.main_text(sp.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "A shared title\nFirst words of the shared text.\ncell one\ncell two\nAs somebody said.\nPrinted at 10:{k:02d}\nLast words."
    for k in range(copies):
        assert got[k] == want.replace("{k:02d}", f"{k:02d}")
    assert all(got[i] == f"Title {i - 1000} alone\nOwn words {(i - 1000) * 7} of page {i - 1000}." for i in got if i >= 1000)


BROKEN = {"open quotes": '<a href="x ' * 90_000, "odd quotes": '<a href="x ' * 90_001, "nested": "<div>" * 200_000, "nested text": "<div>x " * 120_000,
          "inline": "<b>x " * 200_000, "paragraph": "<p><button>" + "<div>x " * 100_000, "single quotes": "<a '>" * 150_000, "comments": "<!--" * 200_000,
          "scripts": "<script x='" * 80_000, "less than": "<" * 500_000, "ends": "</div>" * 150_000, "items": "<li>x" * 150_000}


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_broken_pages_take_linear_time(name):
    start = time.process_time()
    htmlmain.extract(BROKEN[name], {})
    assert time.process_time() - start < 12                                    # about 1 MB; under 5 s on an idle core


def test_a_quote_that_is_never_closed_takes_no_text():
    page = "<body><article><p>one</p><p class='x>two</p><p>three</p></article></body>"
    assert htmlmain.extract(page, {})[0].split("\n")[0] == "one"
    assert htmlmain.extract("<article><p title=\"a'b\">kept it's text</p></article>", {})[0] == "kept it's text"


# --------------------------------------------------------------------- pii --
#: text, and the marked entities (kind, text)
MARKED = [
    ("Call 020 7946 0958 today", [("phone", "020 7946 0958")]), ("Tel. 030 1234567 or 0171/1234567", [("phone", "030 1234567"), ("phone", "0171/1234567")]),
    ("Tél. 01 23 45 67 89.", [("phone", "01 23 45 67 89")]), ("call (030) 1234567", [("phone", "(030) 1234567")]),
    ("+1 (212) 555-0187 and 212-555-0187", [("phone", "+1 (212) 555-0187"), ("phone", "212-555-0187")]),
    ("host fe80::1ff:fe23:4567:890a up", [("ipv6", "fe80::1ff:fe23:4567:890a")]), ("2001:db8:85a3:0:0:8a2e:370:7334", [("ipv6", "2001:db8:85a3:0:0:8a2e:370:7334")]),
    ("mac 00:1A:2B:3C:4D:5E.", [("mac", "00:1A:2B:3C:4D:5E")]), ("mac 00-1a-2b-3c-4d-5e", [("mac", "00-1a-2b-3c-4d-5e")]),
    ("mail a.b@example.org now", [("email", "a.b@example.org")]), ("from 84.17.3.9 to", [("ip", "84.17.3.9")]),
    ("ssn 123-45-6789", [("ssn", "123-45-6789")]), ("card 4111 1111 1111 1111", [("card", "4111 1111 1111 1111")]),
    ("DE89 3704 0044 0532 0130 00", [("iban", "DE89 3704 0044 0532 0130 00")]), ("token = abcd1234efgh5678", [("secret", "abcd1234efgh5678")]),
    ("Mr. 田中 came. 田中 left.", [("surname", "田中"), ("surname", "田中")]), ("Mrs. Παπαδοπούλου is here", [("surname", "Παπαδοπούλου")]),
    ("госпожа Анна Иванова", [("givenf", "Анна"), ("surname", "Иванова")]), ("Mr. محمد here", [("surname", "محمد")]),
    ("Dr. כהן said", [("surname", "כהן")]), ("Mr. 김민수 said", [("surname", "김민수")]), ("Mr. शर्मा said", [("surname", "शर्मा")]),
    ("on 05-12-2024 10:30 we met", []), ("at 12:30:45 and 10:20", []), ("std::vector and a::b", []), ("ratio 1:2:3", []), ("::1", []),
    ("page 0123 4567", []), ("id 0001234567", []), ("0.25 and 01.02.2024", []), ("sum 012 345", []), ("", [])]


@pytest.mark.parametrize("text,marked", MARKED, ids=[m[0][:24] for m in MARKED])
def test_marked_entities(text, marked):
    got = pii.detect(text)
    assert [(k, text[s:e]) for s, e, k, _ in got] == marked
    for s, e, kind, value in got:
        new = pii.written(kind, text[s:e], pii.surrogate(kind, value, 0, "key"))
        assert new != text[s:e] and pii.surrogate(kind, value, 0, "key") != pii.surrogate(kind, value, 0, "other key")
        if kind in ("phone", "card", "ssn", "iban", "mac"):                     # digits for digits, separators where they were
            assert [c if not c.isalnum() else "x" for c in new] == [c if not c.isalnum() else "x" for c in text[s:e]]
            assert [(k, n) for *_, k, n in pii.detect(text[:s] + new + text[e:])][:1] == [(k, n) for *_, k, n in pii.detect(text[:s] + new + text[e:])
                                                                                          if k == kind][:1]
        if kind in ("surname", "givenf"):
            assert pii.script_of(new) == pii.script_of(text[s:e])


@pytest.mark.parametrize("name,script", [("Smith", "latin"), ("Łukasik", "latin"), ("Иванов", "cyrillic"), ("Παππάς", "greek"), ("כהן", "hebrew"),
                                         ("محمد", "arabic"), ("शर्मा", "devanagari"), ("田中", "han"), ("さとう", "kana"), ("サトウ", "kana"), ("김", "hangul")])
def test_scripts(name, script):
    for kind in ("surname", "given", "givenm", "givenf"):
        for attempt in range(3):
            drawn = pii.surrogate(kind, pii._canonical(name), attempt, "key")
            assert pii.script_of(drawn) == script and drawn != name


@pytest.mark.parametrize("text", ["Mr. " * 60_000, "Mr. A. " * 30_000, "my name is " * 30_000, "1:" * 200_000, "0123 " * 60_000, "Mr. van der " * 20_000])
def test_detection_takes_linear_time(text):
    start = time.process_time()
    pii.detect(text)
    assert time.process_time() - start < 3                                     # under 1 s on an idle core


def test_the_key_is_the_callers(sp):
    df = sp.createDataFrame([(1, "mail a.b@example.org")], "doc_id long, text string")
    texts = [pii.anonymise(df, key=k).first().text for k in ("one", "two", "one")]
    assert texts[0] == texts[2] != texts[1]
    assert len(pii.session_key(sp)) == 64 and pii.session_key(sp) == pii.session_key(sp)
    assert pii.anonymise(df).first().text == pii.anonymise(df, key=pii.session_key(sp)).first().text
    sp.conf.set(pii.KEY_SETTING, "given")
    try:
        assert pii.session_key(sp) == "given"
    finally:
        sp.conf.unset(pii.KEY_SETTING)


# ---------------------------------------------------------------- licenses --
def found(text):
    return sorted({m["license"] for m in licenses.find(text, licenses.classify)[1]})


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_every_template_gives_its_own_license_alone(name):
    for text in licenses.TEMPLATES[name]:
        assert found(text) == [name]
        assert found(f"Some words before it.\n\n{text}\n\nAnd some after.") == [name]


def test_pairs_of_licenses_give_both():
    short = {n: t[0] for n, t in licenses.TEMPLATES.items()}
    names = sorted(short)
    for a, b in zip(names, names[5:] + names[:5]):
        assert found(f"{short[a]}\n\nA paragraph between the two of them.\n\n{short[b]}") == sorted([a, b])


@pytest.mark.parametrize("line,want", [
    ("MIT", ["MIT"]), ("banana", []), ("Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]), ("(MIT OR GPL-2.0-only) AND BSD-3-Clause", ["BSD-3-Clause", "GPL-2.0-only", "MIT"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0", ["GPL-2.0-only"]), ("(MIT", []), ("MIT OR", []), ("OR MIT", []), ("MIT OR banana", ["MIT"]), ("", []), ("apache-2.0", ["Apache-2.0"])])
def test_spdx_lines(line, want):
    text = f"/* SPDX-License-Identifier: {line}\n * other words */"
    assert found(text) == want
    assert all(text[m["start"]:m["end"]].lower() == m["license"].lower() for m in licenses.find(text, licenses.classify)[1])


# ---------------------------------------------------------------- sharding --
def drawn(key, node):
    """The law by itself: the least of the shards' draws, from the hash alone."""
    if node.shard is None:
        return min(drawn(key, c) for c in node.children)
    h = xxhash.xxh64_intdigest(key.encode(), xxhash.xxh64_intdigest(node.name.encode(), 42))
    u = ((h >> 11) + 0.5) * 2.0 ** -53
    return -math.log(u) / node.weight, node.shard


def test_draws_by_hand(sp):
    got = sharding.assign(sp.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), n_shards=24).collect()
    tree, grown = sharding.topology(24), sharding.topology(25)
    for r in got:
        assert r.shard == drawn(str(r.doc_id), tree)[1] and r.grown_shard == drawn(str(r.doc_id), grown)[1]


def test_one_more_shard_takes_rows_only_into_itself(sp):
    keys = sp.range(4000).select(F.col("id").cast("string").alias("k"))
    counts = list(range(1, 42))
    rows = keys.select(*[sharding.descend(F.col("k"), sharding.topology(n)).alias(f"n{n}") for n in counts]).collect()
    for n in counts[:-1]:
        moved = [(r[f"n{n}"], r[f"n{n + 1}"]) for r in rows if r[f"n{n}"] != r[f"n{n + 1}"]]
        assert all(new == n for _, new in moved)
        assert abs(len(moved) - 4000 / (n + 1)) < 6 * math.sqrt(4000 / (n + 1)) + 1
    for n in (10, 24):
        load = Counter(r[f"n{n}"] for r in rows)
        assert sorted(load) == list(range(n)) and all(abs(v - 4000 / n) < 6 * math.sqrt(4000 / n) for v in load.values())


def test_weights_and_movement_between_subtrees(sp):
    keys = sp.range(6000).select(F.col("id").cast("string").alias("k"))
    old, new = sharding.topology(16), sharding.topology(16, weights={3: 3.0})
    rows = keys.select(sharding.descend(F.col("k"), old).alias("a"), sharding.descend(F.col("k"), new).alias("b")).collect()
    assert all(r.a == r.b or r.b == 3 for r in rows)
    assert abs(Counter(r.b for r in rows)[3] - 6000 * 3 / 18) < 6 * math.sqrt(1000)


# -------------------------------------------------------------- embeddings --
def test_tiles_of_blocks_give_the_same_links(sp, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 8))[rng.integers(0, 12, 900)] + 0.25 * rng.normal(size=(900, 8))
    df = sp.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    links = (u @ u.T >= 0.9).sum(axis=1) - 1
    monkeypatch.setattr(embeddup, "TILE", 2)
    got = {r.vec_id: r.n_links for r in embeddup.near_duplicates(df, block_rows=20).collect()}
    assert got == {i: int(n) for i, n in enumerate(links)}


# ----------------------------------------------------------------- scratch --
def test_a_query_leaves_only_the_tables_that_its_result_reads(spark):
    import os

    from vigil.llm.queries import REGISTRY
    from vigil.session import shared_path
    base = shared_path(spark).removeprefix("file:")
    before = set(os.listdir(base))
    out = REGISTRY["op6_simhash_tiles"](spark, "/root/testdata/sf0.001")
    left = {d for d in set(os.listdir(base)) - before if d.startswith("llm-")}
    read = {f.split("/llm-", 1)[1].split("/", 1)[0] for f in out.inputFiles() if "/llm-" in f}
    assert left == {f"llm-{d}" for d in read} and out.count() == 200


def test_threads_have_scratch_lists_of_their_own(sp):
    import threading

    from vigil.llm import common
    mark = common.made()
    kept = common.staged(sp.range(3).toDF("a"), "mine")

    def other():
        assert common.made() == 0
        common.staged(sp.range(2).toDF("a"), "other")
        common.release(sp, 0, keep=0)
    t = threading.Thread(target=other)
    t.start()
    t.join()
    assert common.made() == mark + 1 and kept.count() == 3
