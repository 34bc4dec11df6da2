"""The registered queries against SQL, brute force or held-out accuracy."""
import hashlib
import html
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from vigil.llm import pii
from vigil.llm.queries import REGISTRY, SQL

SF = "/root/testdata/sf0.001"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def documents(db):
    return db.sql("select doc_id, text, lang from documents order by doc_id").fetchall()


def test_every_query_is_registered():
    names = entry.queries()
    assert set(REGISTRY) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, db, name):
    got, rel = REGISTRY[name](spark, SF), db.sql(SQL[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(tuple(r[c] for c in rel.columns) for r in got.collect()) == sorted(rel.fetchall())


def tokenised(text):
    t = tokenised.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return np.asarray(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def check_packing(rows, texts):
    """Pieces are the documents' tokens, sequences gapless and at most 1024, their number close to the least possible."""
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(docs) == sorted(texts)
    total = 0
    for d, own in docs.items():
        ids, at = tokenised(texts[d]), 0
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(ids) > 1024 or len(own) == 1
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            assert r.length == 1024 or r.piece == 0
            at += r.length
        assert at == len(ids)
        total += at
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    assert len(seqs) <= math.ceil(total / 1024) * 1.01 + 1


def test_packing(spark, documents):
    check_packing(REGISTRY["op2_pack_swap"](spark, SF).collect(), {d: t for d, t, _ in documents})


def test_html(spark, db):
    got = {r.page_id: r.text for r in REGISTRY["op3_html_template"](spark, SF).collect()}
    for i, page in db.sql("select page_id, html from pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        assert got[i] == "\n".join(b for b in blocks if b)


def test_langid_held_out(spark, documents):
    got = {r.doc_id: r for r in REGISTRY["op4_langid_ppm"](spark, SF).collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, _, _ in documents)
    held = [(got[d].lang_pred, g) for d, _, g in documents if got[d].held_out and g]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """{id: least id reachable} over fingerprints at 3 or fewer differing bits."""
    ids, left, out = sorted(prints), set(prints), {}
    for i in ids:
        if i in left:
            left.discard(i)
            todo = [i]
            while todo:
                k = todo.pop()
                out[k] = i
                near = [j for j in left if (prints[j] ^ prints[k]).bit_count() <= 3]
                left.difference_update(near)
                todo += near
    return out


def test_simhash(spark, documents):
    prints = {d: fingerprint(t) for d, t, _ in documents}
    group = components(prints)
    got = REGISTRY["op6_simhash_tiles"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{prints[d]:016x}", group[d]) for d in prints}


def test_sharding(spark, documents):
    got = REGISTRY["op8_shard_tree"](spark, SF).collect()
    assert {(r.doc_id, r["size"], r.text_crc32, r.law) for r in got} == {
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "key") for d, t, _ in documents}
    assert all(r.grown_shard in (r.shard, 24) for r in got)


def test_licenses(spark, documents):
    known = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    got = {r.doc_id: r for r in REGISTRY["op1_license_zstd"](spark, SF).collect()}
    for d, t, _ in documents:
        want = {v for k, v in known.items() if k in (t or "")}
        assert set(filter(None, got[d].licenses.split(","))) >= want
        assert bool(got[d].matches) == ("licen" in (t or "").lower())


def test_pii(spark, documents):
    got = {r.doc_id: r for r in REGISTRY["op10_pii_surrogates"](spark, SF).collect()}
    real, given = {}, {}
    for d, t, _ in documents:
        own = pii.detect(t)
        assert got[d].n_entities == len(own)
        if not own:
            assert got[d].text == t
        for (s, e, kind, value), x in zip(own, got[d].entities):
            assert (x.kind, x.start, x.end) == (kind, s, e) and t[s:e] not in got[d].text
            real.setdefault((kind, value), set()).add(x.surrogate.lower())
            given.setdefault((kind, x.surrogate.lower()), set()).add(value)
        assert [k for *_, k, _ in pii.detect(got[d].text)] == [k for *_, k, _ in own]        # same kinds again
    assert real and all(len(v) == 1 for v in real.values())              # one entity, one surrogate
    assert all(len(v) == 1 for v in given.values())                      # one surrogate, one entity
    assert not {s for s in given} & {k for k in real}                    # no surrogate is a real value


def test_pii_collisions_are_resolved(spark, monkeypatch):
    from vigil.llm.common import ship

    ship(spark)
    names = ["Mr. " + a + b.lower() + " Smith" for a in ("Al", "Be", "Ce", "De", "Fe", "Ge") for b in ("ron", "lin", "mar", "tos", "vek")]
    rows = [(i, f"{n} met Mrs. {n.split()[1]}a Jones and 4111111111111111") for i, n in enumerate(names * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    again = pii.overrides(pii.entities(df))
    tried = {(r.kind, r.value): r.attempt for r in again.collect()}
    drawn = {}
    for r in pii.entities(df).collect():
        drawn.setdefault((r.kind[:5], pii.surrogate(r.kind, r.value, tried.get((r.kind, r.value), 0), pii.session_key(spark))), []).append(r.value)
    assert tried and all(len(v) == 1 for v in drawn.values())
    one = sorted(map(tuple, pii.anonymise(df).select("doc_id", "text").collect()))
    assert one == sorted(map(tuple, pii.anonymise(df, broadcast_rows=0).select("doc_id", "text").collect()))


def test_pipeline_against_brute_force(spark, db, documents):
    docs = {d: t for d, t, _ in documents if t and any(map(str.isalpha, t))}
    group = components({d: fingerprint(t) for d, t in docs.items()})
    docs = {d: t for d, t in docs.items() if group[d] == d}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))
    windows = set()
    for (t,) in db.sql("select text from benchmark").fetchall():
        w = words(t)
        windows |= {tuple(w[i:i + min(10, len(w))]) for i in range(max(0, len(w) - 9) or bool(w))}
    sizes = {len(w) for w in windows}
    docs = {d: t for d, t in docs.items() if not any(tuple(w[i:i + m]) in windows for w in [words(t)] for m in sizes
                                                     for i in range(len(w) - m + 1))}
    stages = dict(corpus_pipeline.STAGES)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    columns = df.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = corpus_pipeline.staged(stage(spark, df, SF), "test")
        assert df.columns == columns
    kept = {r.doc_id: r for r in df.collect()}
    assert sorted(kept) == sorted(docs)
    for d, r in kept.items():
        assert (r.text == docs[d]) == (not pii.detect(docs[d])) and r.n_chars == len(r.text)
    rows = corpus_pipeline.run(spark, SF).collect()
    check_packing(rows, {d: r.text for d, r in kept.items()})
    digest = hashlib.sha256(repr(sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)).encode())
    again = stages["best-fit packing"](spark, df, SF).collect()
    assert digest.digest() == hashlib.sha256(repr(sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in again)).encode()).digest()
