"""Defined results for nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.helpers import LONG, ROWS, docs
from vigil.llm import decontam, embeddup, htmlmain, langid, licenses, packing, pii, sharding, simhash, warc
from vigil.llm.common import ship

TOK = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def sp(spark):
    ship(spark)
    return spark


def test_sharding(sp):
    got = sharding.assign(docs(sp)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _, _ in ROWS)
    by_id = {}
    for r in got:
        assert by_id.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    text = {(i, t) for i, t, _ in ROWS}
    want = {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in text}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in got} == want
    assert sharding.assign(docs(sp, [])).count() == 0


def test_simhash(sp):
    got = simhash.near_duplicates(docs(sp)).collect()
    assert len(got) == len(ROWS)
    group = {}
    for r in got:
        group.setdefault(r.doc_id, set()).add(r.component_id)
    assert group[1] == group[2] == {1}
    assert group[3] == group[4] == group[5] == {3}            # no words: fingerprint zero
    assert group[9] == group[10] == {9}
    assert simhash.near_duplicates(docs(sp, [])).count() == 0


def test_langid(sp):
    model = langid.fit(docs(sp))
    got = langid.predict(docs(sp), model).collect()
    assert len(got) == len(ROWS)
    for r, (i, t, _) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(ROWS, key=lambda x: (x[0] is None, x[0] or 0))):
        assert 0 <= r.score <= 1
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id}
    assert all(by[i] == "und" for i in (3, 4, 5, 6)) and by[7] == "de" and by[1] == "en" and by[9] == "en"
    assert langid.fit(docs(sp, [])) == {}
    assert {r.lang_pred for r in langid.predict(docs(sp), {}).collect()} == {"und"}
    assert langid.predict(docs(sp, []), model).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_decontam(sp, block_bytes):
    items = [(1, "quick brown fox jumps over the lazy dog and runs"), (2, "lazy dog"), (3, None), (4, "!!"),
             (None, "QUICK Brown"), (2, "hunter"), (5, "long.tail")]
    bench = sp.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, items int")
    got = decontam.contamination(docs(sp), bench, block_bytes=block_bytes).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got if r.doc_id}
    assert (by[1].n_words, by[1].n_hit, by[1]["items"]) == (15, 11, ["1", "2", "null"])
    assert (by[3].n_words, by[3].n_hit, by[3]["items"]) == (0, 0, [])
    assert by[9]["items"] == ["5"] and by[9].n_hit == 2 * 9000
    assert by[6].n_words == 1
    none = decontam.contamination(docs(sp), bench.limit(0), block_bytes=block_bytes).collect()
    assert len(none) == len(ROWS) and not any(r.n_hit for r in none)
    assert decontam.contamination(docs(sp, []), bench, block_bytes=block_bytes).count() == 0


def test_pii(sp):
    got = pii.anonymise(docs(sp)).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got if r.doc_id}
    assert by[1].text == ROWS[0][1] and by[3].text is None and by[4].text == ""
    assert len(by[9].entities) == 9000 and "long.tail@example.com" not in by[9].text
    assert len({e.surrogate for e in by[9].entities}) == 1 and by[9].text == by[10].text
    odd = next(r for r in got if r.doc_id is None and r.text)
    assert [e.kind for e in odd.entities] == ["email", "phone"] and "+1 (" in odd.text
    assert pii.anonymise(docs(sp, [])).count() == 0


def test_packing(sp):
    got = packing.pack_documents(docs(sp), TOK).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got if r.piece == 0) == sorted((i is None, i or 0) for i, _, _ in ROWS)
    assert {r.length for r in got if r.doc_id in (3, 4)} == {1}       # the end mark alone
    long = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 9)
    assert all(n == 1024 for _, _, n in long[1:]) and [s for _, s, _ in long] == list(np.cumsum([0] + [n for *_, n in long])[:-1])
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    assert packing.pack_documents(docs(sp, []), TOK).count() == 0


def test_licenses(sp):
    rows = ROWS + [(20, "x\nReleased under the MIT License.\ny\nReleased under the MIT License.", None),
                   (21, LONG + "Licensed under CC BY-NC 4.0. " + LONG, None)]
    got = licenses.scan(docs(sp, rows)).collect()
    by = {r.doc_id: r for r in got if r.doc_id}
    assert len(got) == len(rows) and not any(r.matches for r in got if r.doc_id not in (20, 21))
    assert [m.license for m in by[20].matches] == ["MIT", "MIT"]
    assert [m.license for m in by[21].matches] == ["CC-BY-NC-4.0"]
    m = by[21].matches[0]
    assert (LONG + "Licensed under CC BY-NC 4.0. ")[m.start:m.end] == "Licensed under CC BY-NC 4.0"
    assert licenses.scan(docs(sp, [])).count() == 0


def test_html(sp):
    page = ("<html><body><nav class=menu><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div><article><header>"
            "<h1>A &amp; B&nbsp;C</h1></header><p>One  two<br>three<p>Four <b>five</b>.<ul><li>x<li>y</ul><aside>skip</aside>"
            "<form><input>no</form><script>p('</p>')</script><section id=comments><p>first!</p></section></article>"
            "<footer>&copy; me</footer></body></html>")
    plain = "<div><div id=sidebar>" + "<a href=x>link text here</a> " * 30 + "</div><div><p>Real words of the page &lt;here&gt;.</p>" \
            "<p>More of them.</p></div><div class=ads><p>Buy</p></div></div>"
    rows = [(1, "http://a.org/1", page), (2, "http://a.org/2", None), (3, None, ""), (4, "http://b.org", plain),
            (5, "http://c.org", "no markup at all"), (5, "http://c.org", "no markup at all"), (None, "x", "<p>" + "w " * 200_000),
            (6, "http://a.org/3", "<<p a='x>broken")]
    cols = "page_id long, url string, html string"
    df = sp.createDataFrame([(*r, "h", 1) for r in rows], cols + ", host string, row int")
    got = htmlmain.main_text(df).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert by[1].text == "A & B C\nOne two three\nFour five.\nx\ny"
    assert by[2].text == by[3].text == "" and by[4].text == "Real words of the page <here>.\nMore of them."
    assert by[5].text == "no markup at all" and by[None].n_chars == 399_999
    assert htmlmain.main_text(df.limit(0)).count() == 0


def test_html_template_drops_the_hosts_own_words(sp):
    rows = [(i, f"http://t.org/{i}", f"<body><div>Site name</div><div><p>Story {i} has {i * 7} parts and much to tell.</p></div>"
             f"<div>All rights</div></body>") for i in range(8)]
    got = {r.page_id: r.text for r in htmlmain.main_text(sp.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Story {i} has {i * 7} parts and much to tell." for i in range(8)}


def test_warc(sp):
    rows = [(1, "http://a.com/x", "y" * 2000), (2, "http://b.com/", "y" * 2000), (3, None, "y" * 2000), (4, "http://a.com/x", "z"),
            (5, "http://a.com/x", "z"), (6, "bad\turl \n", None), (6, "bad\turl \n", None), (None, "http://q.org", "k" * 1500),
            (9, "http://[::1]:80/é?ü", "é" * 700), (8, "//u@H.Com:8080", "é" * 700), (10, "", "\r\n\r\n" * 300)]
    df = sp.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, key string, file int")
    got = sorted((tuple(r) for r in warc.archive_and_read(df).collect()), key=lambda r: (r[0] is None, r))
    first = {"y" * 2000: 3, "é" * 700: 9}
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        rep = first.get(h)
        revisit = rep is not None and rep != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", rep if revisit else None))
    assert got == sorted(want, key=lambda r: (r[0] is None, r))
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_embeddings(sp):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [(i, (base[i % 20] * (1 + i) + 0.05 * base[i]).tolist()) for i in range(60)]
    rows += [(60, base[0].tolist()), (60, base[0].tolist()), (None, base[0].tolist()), (61, None), (62, []), (63, [0.0] * 16),
             (64, [None] + [1.0] * 15), (65, [float("nan")] + [1.0] * 15), (66, [float("inf")] + [1.0] * 15), (67, [1.0] * 8),
             (68, [1e200] * 8)]
    df = sp.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, rep string, label int")
    got = sorted((tuple(r) for r in embeddup.near_duplicates(df, block_rows=16).collect()), key=lambda r: (r[0] is None, r))
    ok = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.asarray(rows[k][1]) / np.abs(rows[k][1]).max() for k in ok}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near = {k: [j for j in ok if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.9] for k in ok}
    want = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        want.append((i, len(near.get(k, [])), min(ids) if ids else None))
    assert got == sorted(want, key=lambda r: (r[0] is None, r))
    assert embeddup.near_duplicates(df.limit(0)).count() == 0


def story(i):
    return f"Story {i} has <b>{i * 7}</b> parts and <i>much</i> to tell."


def words(i):
    return f"Story {i} has {i * 7} parts and much to tell."


def main_texts(sp, pages):
    rows = [(i, f"http://{h}/{i}", p) for i, (h, p) in enumerate(pages)]
    return [r.text for r in sorted(htmlmain.main_text(sp.createDataFrame(rows, "page_id long, url string, html string")).collect(),
                                   key=lambda r: r.page_id)]


def test_html_template_decides_inside_the_article(sp):
    box = "<div class='x7'>Get our daily letter</div>"
    pages = [("a.org", f"<body><article><h1>Title {i}</h1><p>{story(i)}</p>{box}<p>{'More on it. ' * (i + 1)}"
              f"<span class='q2'>Read on</span></p></article><div>All rights</div></body>") for i in range(6)]
    pages += [("b.org", f"<body><div>Day {i}</div><main><p>The same text.</p>{box}</main></body>") for i in range(5)]
    got = main_texts(sp, pages)
    assert got[:6] == [f"Title {i}\n{words(i)}\n{('More on it. ' * (i + 1)).strip()}" for i in range(6)]
    assert got[6:] == ["The same text.\nGet our daily letter"] * 5          # nothing varies: the article stays whole


def test_html_keeps_all_sections_without_an_article(sp):
    two = "<body><div><section><p>{a}</p></section><section><p>{b}</p><p><a href=x>Source of it all, a link</a></p></section></div></body>"
    pages = [("a.org", two.format(a=story(i), b=f"Second part {i * 3}, longer than the first, to be kept beside it.")
              .replace("Source", f"Source {i}")) for i in range(6)]
    pages += [("c.org", "<body><ul><li><a href=/>Home</a><li><a href=/n>News of the day</a></ul><div><div><h1>A title</h1></div>"
               "<div><p>The body of the text, <a href=x>with a link</a>.</p><ul><li><a href=y>One reference</a></ul></div></div></body>")]
    got = main_texts(sp, pages)
    assert got[:6] == [f"{words(i)}\nSecond part {i * 3}, longer than the first, to be kept beside it.\nSource {i} of it all, a link"
                       for i in range(6)]
    assert got[6] == "A title\nThe body of the text, with a link.\nOne reference"
