"""Parts of the operators against brute force, without or with little Spark."""
import hashlib
import re
import textwrap

import numpy as np
import pytest

from vigil.llm import components, decontam, embeddup, licenses, packing, pii, warc


def labels(n, u, v):
    root = np.arange(n)
    a, b = components.spanning_links(np.asarray(u), np.asarray(v))
    root[a] = b
    return root.tolist()


@pytest.mark.parametrize("seed", range(24))
def test_dual_traversal_finds_exactly_the_links(seed):
    rng = np.random.default_rng(seed)
    dim, n, m = (int(x) for x in rng.integers((2, 1, 1), (10, 120, 120)))
    base, spread = rng.normal(size=(int(rng.integers(1, 8)), dim)), rng.choice([.01, .1, .4, 1.5])
    threshold = [.9, .5, .99][seed % 3]
    trees = [embeddup.Tree(embeddup.unit(base[rng.integers(0, len(base), k)] + spread * rng.normal(size=(k, dim)))) for k in (n, m)]
    (a, b), (wa, wb) = trees, (rng.integers(1, 4, n), rng.integers(1, 4, m))
    hit = a.vectors @ b.vectors.T >= threshold
    ca, cb, x, y = embeddup.dual(a, b, wa, wb, threshold)
    assert (ca == hit @ wb).all() and (cb == wa @ hit).all() and hit[x, y].all()
    p, q = np.nonzero(hit)
    assert labels(n + m, p, q + n) == labels(n + m, x, y + n)
    own = a.vectors @ a.vectors.T >= threshold
    np.fill_diagonal(own, False)
    ca, cb, x, y = embeddup.dual(a, a, wa, wa, threshold)
    assert (ca + cb == own @ wa).all()
    assert labels(n, *np.nonzero(own)) == labels(n, x, y)


@pytest.mark.parametrize("seed", range(12))
def test_local_search_keeps_items_and_never_adds_bins(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(*[(1, 100), (200, 600), (400, 1023)][seed % 3], size=300).tolist()
    first = packing.best_fit(sizes, 1024)
    fill = sum(sum(sizes[i] for i in b) ** 2 for b in first)
    after = packing.improve([list(b) for b in first], sizes, 1024)
    assert sorted(i for b in after for i in b) == list(range(300))
    assert all(sum(sizes[i] for i in b) <= 1024 for b in after)
    assert len(after) <= len(first) and sum(sum(sizes[i] for i in b) ** 2 for b in after) >= fill


def test_local_search_empties_a_bin_by_swaps():
    sizes = [5, 4, 5, 3, 3]
    assert len(packing.improve([[0, 1], [2, 3], [4]], sizes, 10)) == 2


def test_cut():
    assert packing.cut(5) == [(0, 5)] and packing.cut(1024) == [(0, 1024)]
    assert packing.cut(2048) == [(0, 1024), (1024, 1024)]
    assert packing.cut(2050) == [(0, 2), (2, 1024), (1026, 1024)]


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    keep = [e for e in edges if e[0] != e[1]]
    want = labels(200, [e[0] for e in keep], [e[1] for e in keep])
    assert got == {n: want[n] for e in keep for n in e}


def test_surt_and_record_round_trip():
    assert warc.surt("http://a.B.com:80/x?y#z") == "com,b,a)/x?y" and warc.surt(None) == ")"
    assert warc.surt("https://u@h.org:8080") == "org,h:8080)/"
    data = "é\r\n\r\nx".encode()
    digest = "da39a3ee5e6b4b0d3255bfef95601890afd80709"
    headers, payload = warc.parse(warc.record(4, "http://h/é", data, digest, None, None, False))
    assert payload == data and headers["warc-type"] == "response" and warc._page(headers["warc-record-id"]) == 4
    headers, payload = warc.parse(warc.record(4, None, data, digest, 9, "http://h/", True))
    assert payload == b"" and warc._page(headers["warc-refers-to"]) == 9


def test_revisits_of_urls_with_percent_escapes(spark):
    from vigil.llm.common import ship

    ship(spark)
    rows = [(1, "http://b.com/", "y" * 2000), (2, "http://a.com/caf%C3%A9?q=%25%2F", "y" * 2000), (3, "http://É.com/é%zz", "k" * 1500),
            (4, "http://É.com/é%zz#%41", "k" * 1500), (5, "http://a.com/%C3%A9", "m" * 1000), (6, "http://a.com/é", "m" * 1000),
            (6, "http://a.com/%C3%A9", "n" * 1000), (5, "http://a.com/é", "n" * 1000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_and_read(df).collect())
    top = {"y" * 2000: 2, "k" * 1500: 4, "m" * 1000: 6, "n" * 1000: 6}
    assert got == sorted((i, hashlib.sha1(h.encode()).hexdigest(), "response" if i == top[h] else "revisit", None if i == top[h] else top[h])
                         for i, _, h in rows)
    headers, _ = warc.parse(warc.record(1, rows[0][1], b"", "00" * 20, 2, rows[1][1], True))
    assert headers["warc-refers-to-target-uri"] == rows[1][1]              # as the response's own header has it


def packed(spark, sizes, group_items):
    """(sequence_id, offset, length) of the pieces, their sequences checked."""
    from vigil.llm.common import ship

    ship(spark)
    parts = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long").repartition(3)
    got = packing.pack(parts, 1024, group_items).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(sizes)))
    seqs = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == seqs.get(r.sequence_id, 0)
        seqs[r.sequence_id] = r.offset + r.length
    assert max(seqs.values()) <= 1024
    return seqs


def test_packing_ends_when_no_pieces_fit_together(spark):
    assert len(packed(spark, [600] * 60, 16)) == 60
    rng = np.random.default_rng(2)
    sizes = [700] * 60 + rng.integers(1, 1024, 60).tolist()
    assert len(packed(spark, sizes, 16)) <= len(packing.best_fit(sizes, 1024)) * 1.1 + 1


def test_packing_levels_pair_a_hot_size(spark):
    assert len(packed(spark, [700] * 100 + [324] * 100, 16)) <= 105


def test_added_tokens_get_their_own_id():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = packing.Encoder(path), Tokenizer.from_file(path)
    for text in ["one<|endoftext|>two <|endoftext|>", "<|endoftext|>", "<|endoftext|", "plain words", ""]:
        encoder.check(text)
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert 50256 in np.frombuffer(encoder.ids("a<|endoftext|>b"), "<u4")


@pytest.mark.parametrize("text", [          # hand-marked: what stands in braces is personal
    "My name is {Anna} {Lopez}. I write. {Anna} said; {Lopez} left. {LOPEZ}'s car, the {Lopez}-led team, a lopez.",
    "Mr. {McDonald} and Mr. {O'Brien} met Mrs. {Łukasik}. {O’Brien}'s hat, said {Łukasik} to {McDonald}.",
    "{Maria} wrote. My name is {Anna} {Maria} {Lopez}, not Anna2 or Annabel.",
    "Herr Dr. {Müller} sah Frau von {Trapp}. {Trapp} und {Müller} gingen.",
    "Prof. T. S. {Eliot-Jones} read it. {Eliot-Jones}! Dr. J. {Smith}'s dog, '{Smith}' said.",
    "господин {Иванов} и {Иванов}", "No title: Anna Lopez stays."])
def test_names_and_all_their_mentions(text):
    plain, want, at = text.replace("{", "").replace("}", ""), [], 0
    for k, part in enumerate(text.replace("}", "{").split("{")):
        if k % 2:
            want.append((at, at + len(part)))
        at += len(part)
    got = pii.detect(plain)
    assert [(s, e) for s, e, *_ in got] == want
    kinds = {}
    for _, _, kind, value in got:
        assert kinds.setdefault(value, kind) == kind


def test_decontam_compares_the_last_candidate_of_a_full_slice():
    search, = decontam.build([b"x"])
    at, item = search.occurrences(decontam.Words([b"x " * (1 << 18)]))
    assert len(at) == len(item) == 1 << 18 and sorted(at.tolist()) == list(range(1 << 18))


def test_decontam_blocks_hold_each_item_once(spark):
    rows = [("a", "one two three four")] * 50 + [("b", "five six"), ("c", "five six")]
    got = list(decontam._blocks(spark.createDataFrame(rows, "item string, text string"), "item", "text", 40))
    assert len(got) == 1 and got[0][1] == ["a", "b", "c"]


LAYOUT = re.compile(r"(?<=[.:;]) (?=The above|THE SOFTWARE|This program is distributed|See the GNU|You may|Unless|[123]\. |If a copy)")


@pytest.mark.parametrize("name, long", [(name, t) for name, own in licenses.TEMPLATES.items() for t in own if len(t.split()) > 20])
@pytest.mark.parametrize("around", ["{}", "A tool.\n\nCopyright (c) 2020 Someone\n\n{}\n\nProse follows that says copyright is a right.\n\nEnd."])
def test_licenses_in_their_usual_layout(name, long, around):
    text = around.format("\n\n".join(textwrap.fill(p, 70) for p in LAYOUT.split(long)))
    m, = licenses.find(text, licenses.classify)[1]
    assert m["license"] == name and m["added"] + m["missing"] <= 1
    stated = licenses.words(text[m["start"]:m["end"]])
    assert abs(len(stated) - len(licenses.words(long))) <= 1
