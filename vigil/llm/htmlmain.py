"""Main text of pages by template deduction from token equivalence classes.

A page is a sequence of tokens (start tags, end tags, text nodes), each told
apart by its path of tags and class names.  Over the distinct pages of a host,
tokens with the same occurrence vector (how often they occur on every page)
form an equivalence class.  Large and frequent classes that hold markup are
kept: on ``SUPPORT`` of the host's pages, and spanning the page, which is to say not
within one child of its body (an article that some pages share is no template);
a class is valid if its tokens come in the same cyclic order on all pages
and its spans nest with those of the other classes.  The valid, nested classes
are the host's template: their text nodes are the template's own words, and
what stands between their tokens are slots.  The template's words are left out
where a whole block, or a whole inline element with a class, has no others, so
that a sentence keeps an "and" that happens to stand on every page; an
``article`` or ``main`` without a word of its own is kept.  From the slots the article's are taken: those inside ``article`` or
``main`` if a page has them, else all.  Slots under menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments are left
out.

Occurrence vectors are compared by a 64-bit exclusive-or of (page, count)
hashes, so they are aggregated like sums: no page list is gathered, and a host
with a third of all pages is pre-aggregated in every task.  A host with fewer
than ``MIN_PAGES`` distinct pages has no template; its slots are its text nodes, and
without ``article`` or ``main`` those in containers that are mostly links go.

Null or empty html gives an empty text; repeated pages give repeated rows and
count once in a template; urls without a host share one host; an empty table
gives an empty result.  Extra columns are ignored.
"""
from __future__ import annotations

import html as htmllib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import staged

MIN_PAGES = 4          # distinct pages of a host that a template needs
SUPPORT = 0.3          # share of a host's distinct pages that a class must occur on
MIN_CLASS = 3          # tokens of a class

# --- fixed values -----------------------------------------------------------
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select",
         "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
#: start tags that end an open paragraph
ENDS_P = BLOCK - {"option", "select", "caption", "legend", "summary", "body", "head", "html", "title"}
#: start tag -> open elements that it ends, up to the given boundary elements
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
#: blocks whose text belongs to the block around them
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "dd", "dt", "td", "th", "tr"}
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp")
NOT_TEXT = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "button", "select",
            "option", "textarea", "label", "input", "svg", "head", "title", "menu", "dialog", "object", "canvas", "xmp"}
#: words of class, id and role values that mark what is not article
NOT_ARTICLE = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
               "comment", "comments", "commentlist", "complementary", "consent", "contentinfo", "cookie", "cookies",
               "copyright", "disclaimer", "discussion", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu",
               "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pagination",
               "popup", "promo", "promoted", "promotion", "recommended", "related", "reply", "replies", "search", "share",
               "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription",
               "toolbar", "topbar", "trending", "widget"}
#: of these, the ones that an article's own parts may carry
ARTICLE_PARTS = {"copyright", "disclaimer", "header"}
# ---------------------------------------------------------------------------

#: attributes up to the end of the tag; a quote that is never closed is a character like others.  Possessive: read once
_ATTR = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s>/])(?P<rawattr>" + _ATTR + r")(?:>(?P<rawtext>.*?)(?:</(?P=raw)\s*+>|$)|$)"
    r"|<(?P<close>/)?(?P<tag>[A-Za-z][^\s>/]*+)(?P<attr>" + _ATTR + r")(?:>|$)"
    r"|<[!?/][^>]*+(?:>|$)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_MARKS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_INTO = xxhash.xxh3_64_intdigest


class Marks(NamedTuple):
    """What a start tag says by itself: class names, words that mark it as no article (outside and inside one), main, hidden."""
    names: str
    outside: bool
    inside: bool
    main: bool
    hidden: bool


_KEPT = 5_000              # start tags, and paths, whose reading a worker keeps
_read: dict[tuple[str, str], Marks] = {}
_paths: dict[tuple[int, str, str], tuple[int, int, int]] = {}


def _marks(tag: str, attr: str) -> Marks:
    """The marks of a start tag; pages repeat their tags, so the readings are kept."""
    key = (tag, attr)
    known = _read.get(key)
    if known is None:
        names, words, main = "", set(), tag in ("article", "main")
        for kind, a, b, c in _MARKS.findall(attr) if attr else ():
            value = (a or b or c).lower()
            words.update(w for w in re.split(r"[^a-z0-9]+", value) if w)
            if kind.lower() == "class":
                names = value
            elif kind.lower() == "role" and value == "main":
                main = True
        free = main or tag in ("html", "body")
        known = Marks(names, not free and not words.isdisjoint(NOT_ARTICLE),
                      not free and not words.isdisjoint(NOT_ARTICLE - ARTICLE_PARTS), main, bool(attr) and bool(_HIDDEN.search(attr)))
        if len(attr) < 200:
            if len(_read) >= _KEPT:
                _read.clear()
            _read[key] = known
    return known


class Element:
    __slots__ = ("tag", "path", "start", "end", "out", "article", "link", "parent", "block", "whole", "varies", "box", "top")

    def __init__(self, tag: str, marks: Marks, parent: "Element | None", hidden: bool = False):
        self.tag, self.parent = tag, parent
        key = (parent.path if parent else 0, tag, marks.names)
        path = _paths.get(key)
        if path is None:
            own = _INTO(f"{key[0]}/{tag}.{marks.names}")
            path = own, _INTO(f"{own}<"), _INTO(f"{own}/")
            if len(marks.names) < 200:
                if len(_paths) >= _KEPT:
                    _paths.clear()
                _paths[key] = path
        #: path, and the tokens of its start and end tag
        self.path, self.start, self.end = path
        self.block = tag in BLOCK
        self.varies = False          # holds text that is not the template's
        if parent is None:
            self.article = self.out = self.link = False
            #: the inline element with a class that this one is, or is part of
            self.whole: "Element | None" = None
            #: the container of its text: the nearest block that holds blocks
            self.box: "Element" = self
            #: the child of the page's body that it is in (its path); 0 for the body itself and what is around it
            self.top = 0
            return
        inside = parent.article
        self.article = inside or marks.main
        self.out = parent.out or hidden or marks.hidden or tag in NOT_TEXT or tag == "header" and not inside \
            or (marks.inside if inside else marks.outside)
        self.link = parent.link or tag == "a"
        self.whole = None if self.block else self if marks.names else parent.whole
        self.box = self if self.block and tag not in TEXT_BLOCKS else parent.box
        self.top = 0 if tag in ("html", "body", "head") else parent.top or self.path


def tokens(page: str) -> Iterator[tuple[int, str, Element | None, str]]:
    """(token, kind, element, text) of a page in order; kind is ``<`` (start), ``/`` (end), ``t`` (text) or ``b`` (break)."""
    stack = [Element("#", _marks("#", ""), None)]
    places: dict[str, list[int]] = defaultdict(list)         # of the open elements, by name
    paragraphs = places["p"]

    def close(at: int) -> None:
        for e in stack[at:]:
            places[e.tag].pop()
        del stack[at:]

    def ended(tags, bounds) -> int:
        """The innermost open element of these tags, unless one of the bounds is further in; 0: none."""
        at = 0
        for t in tags:
            if places[t] and places[t][-1] > at:
                at = places[t][-1]
        for t in bounds if at else ():
            if places[t] and places[t][-1] > at:
                return 0
        return at

    for m in _TOKEN.finditer(page):
        raw, _, _, closing, tag, attr, text = m.groups()
        if text is not None:
            here = stack[-1]
            yield _INTO(f"{here.path}t{text.strip()}"), "t", here, text
        elif tag:
            tag = tag.lower()
            if closing:
                own = places.get(tag)
                if own:
                    e = stack[own[-1]]
                    close(own[-1])
                    yield e.end, "/", e, ""
                elif tag in BLOCK:
                    yield 0, "b", None, ""
                continue
            if paragraphs and tag in ENDS_P:
                at = ended(("p",), ("table", "button", "td", "th"))
                if at:
                    close(at)
            if tag in ENDS:
                at = ended(*ENDS[tag])
                if at:
                    close(at)
            e = Element(tag, _marks(tag, attr), stack[-1])
            yield e.start, "<", e, ""
            if tag not in VOID and not attr.endswith("/") or tag in ("p", "div", "li", "article"):
                places[tag].append(len(stack))
                stack.append(e)
        elif raw:
            e = Element(raw.lower(), _marks(raw.lower(), m.group("rawattr")), stack[-1], True)
            yield e.start, "<", e, ""
            yield e.end, "/", e, ""


def _long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


# ------------------------------------------------------------------ learning
def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, markup, vec, top): one row per distinct token of a page; vec hashes (page, count)."""
    for b in batches:
        host, tok, markup, vec, top = [], [], [], [], []
        for h, page_hash, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            count: Counter = Counter()
            kinds, tops = {}, {}
            for t, kind, e, text in tokens(page.as_py() or ""):
                if kind in "</" or kind == "t" and not text.isspace():
                    count[t] += 1
                    kinds[t], tops[t] = kind != "t", e.top
            for t, n in count.items():
                host.append(h)
                tok.append(_long(t))
                markup.append(kinds[t])
                vec.append(_long(_INTO(f"{page_hash}:{n}")))
                top.append(_long(tops[t]))
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(tok, pa.int64()), pa.array(markup, pa.bool_()),
                                          pa.array(vec, pa.int64()), pa.array(top, pa.int64())],
                                         names=["host", "token", "markup", "vec", "top"])


def _order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, cls, cycle, nests) of every class on every page: its cyclic token order, and whether its spans nest."""
    for b in batches:
        host, cls_out, cycle, nests = [], [], [], []
        for i, h in enumerate(b.column(0).to_pylist()):
            cls = dict(zip(b.column(2)[i].as_py(), b.column(3)[i].as_py()))
            seq: dict[int, list[int]] = defaultdict(list)
            at: dict[int, list[int]] = defaultdict(list)
            for k, (t, kind, _, _) in enumerate(tokens(b.column(1)[i].as_py() or "")):
                c = cls.get(_long(t)) if kind != "b" else None
                if c is not None:
                    seq[c].append(t)
                    at[c].append(k)
            spans, bad = [], set()
            for c, s in seq.items():
                size = len(set(s))
                if any(t != s[j % size] for j, t in enumerate(s)) or len(s) % size:
                    bad.add(c)
                else:
                    spans += [(at[c][j], at[c][j + size - 1], c) for j in range(0, len(s), size)]
            open_: list[tuple[int, int]] = []
            for lo, hi, c in sorted(spans, key=lambda x: (x[0], -x[1])):
                while open_ and open_[-1][0] < lo:
                    open_.pop()
                if open_ and open_[-1][0] < hi:
                    bad.add(c)                       # crosses a span that began earlier
                    continue
                open_.append((hi, c))
            for c, s in seq.items():
                host.append(h)
                cls_out.append(c)
                cycle.append(_long(_INTO(repr(s[:len(set(s))]))))
                nests.append(c not in bad)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(cls_out, pa.int64()), pa.array(cycle, pa.int64()),
                                          pa.array(nests, pa.bool_())], names=["host", "cls", "cycle", "nests"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS, support: float = SUPPORT) -> DataFrame:
    """(host, tokens, classes) of every host with a template: token hashes and the valid class of each.

    ``pages`` has host, page hash and html.
    """
    # exact copies of a page count once: all but one row of a repeated page go
    copies = staged(pages.groupBy("host", "page_hash").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
                    .where("n > 1").select("host", "page_hash", "first"), "html-copies")
    marked = pages.join(copies, ["host", "page_hash"], "left")
    distinct = (marked.where("first IS NULL").select("host", "page_hash", "html")
                .union(marked.where("row = first").select("host", "page_hash", "html").dropDuplicates(["host", "page_hash"])))
    counted = (distinct
               .mapInArrow(_occurrences, "host string, token long, markup boolean, vec long, top long")
               .groupBy("host", "token").agg(F.bit_xor("vec").alias("vec"), F.count(F.lit(1)).alias("n_pages"),
                                             F.max("markup").alias("markup"), F.min("top").alias("top"))
               .where(F.col("n_pages") >= min_pages))
    counted = staged(counted, "html-tokens")
    per_host_pages = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    large = (counted.groupBy("host", "vec", "n_pages")
             .agg(F.count(F.lit(1)).alias("size"), F.max("markup").alias("anchored"),
                  F.min("top").alias("a"), F.max("top").alias("b"), F.max(F.col("top") == 0).alias("around"))
             .where((F.col("size") >= min_class) & F.col("anchored") & (F.col("around") | (F.col("a") != F.col("b"))))
             .join(staged(per_host_pages, "html-hosts"), "host").where(F.col("n_pages") >= F.lit(support) * F.col("pages"))
             .select("host", "vec", "n_pages"))
    classes = counted.join(large, ["host", "vec", "n_pages"]).select("host", "token", F.xxhash64("vec", "n_pages").alias("cls"))

    def per_host(rows: DataFrame, name: str) -> DataFrame:
        # a host's list has its template's tokens only: as long as its page layout, whatever its number of pages
        return staged(rows.groupBy("host").agg(F.collect_list(F.struct("token", "cls")).alias("t"))
                      .select("host", F.col("t.token").alias("tokens"), F.col("t.cls").alias("classes")), name)

    candidate = per_host(classes, "html-candidates")
    seen = (distinct.join(candidate, "host").select("host", "html", "tokens", "classes")
            .mapInArrow(_order, "host string, cls long, cycle long, nests boolean"))
    valid = (seen.groupBy("host", "cls").agg(F.min("cycle").alias("a"), F.max("cycle").alias("b"), F.min("nests").alias("nests"))
             .where("a = b AND nests").select("host", "cls"))
    return per_host(classes.join(staged(valid, "html-valid"), ["host", "cls"]), "html-templates")


# ------------------------------------------------------------------ extraction
def extract(page: str | None, template: dict[int, int]) -> tuple[str, int]:
    """(main text, number of slots with text) of a page under its host's template (token -> class)."""
    blocks: list[list] = []                 # [parts (text, element of template words), container, in article, link chars, slot]
    slot, slots_used = 0, set()
    open_block: list | None = None

    for t, kind, e, text in tokens(page or ""):
        own = template.get(_long(t)) if kind != "b" else None
        if own is not None:
            slot += 1                       # a template token ends a slot
        if kind == "t":
            if e.out:
                if not text.isspace():
                    open_block = None if e.block else open_block
                continue
            if open_block is None:
                open_block = [[], e.box, e.article, 0, slot]
                blocks.append(open_block)
            if own is None and not text.isspace():
                up = e
                while up is not None and not up.varies:
                    up.varies, up = True, up.parent
            open_block[0].append((text, e if own is not None and not text.isspace() else None))
            if e.link:
                open_block[3] += len(text)
        elif kind == "b" or e.block:
            open_block = None
        elif e.tag in ("br", "wbr") and open_block is not None:
            open_block[0].append((" " if e.tag == "br" else "", None))

    def joined(parts: list, template_too: bool) -> str:
        if not template_too and all(e is not None or text.isspace() for text, e in parts):
            return ""                       # the template's own words
        return _SPACE.sub(" ", htmllib.unescape("".join(
            text for text, e in parts if e is None or template_too or e.whole is None or e.whole.varies))).strip()

    # an article without a varying word (say, one text on all pages of a host) is kept as it is
    alike = not any(joined(parts, False) for parts, _, article, _, _ in blocks if article)
    cleaned = []
    for parts, box, article, link, s in blocks:
        text = joined(parts, article and alike)
        if text:
            cleaned.append((text, box, article, link, s))
    if any(c[2] for c in cleaned):
        kept = [c for c in cleaned if c[2]]
    elif template:
        kept = cleaned
    else:
        # no template tells menus from text: a container counts if its own text, or that of one around it, is not mostly links
        weight: Counter = Counter()
        for text, box, _, link, _ in cleaned:
            weight[box] += len(text) - 2 * link

        known: dict[Element, bool] = {}

        def rich(e: Element) -> bool:
            way = []
            while e is not None and e.parent is not None and e.tag not in ("body", "html") and e not in known:
                way.append(e)
                if weight.get(e, -1) >= 0:
                    known[e] = True
                    break
                e = e.parent
            found = known.get(e, False) if e is not None else False
            known.update((x, found) for x in way)
            return found
        kept = [c for c in cleaned if weight[c[1]] >= 0 or rich(c[1])]
    slots_used = {c[4] for c in kept}
    return "\n".join(c[0] for c in kept), len(slots_used)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for i in range(b.num_rows):
            tok, cls = b.column(1)[i].as_py(), b.column(2)[i].as_py()
            out.append(extract(b.column(0)[i].as_py(), dict(zip(tok, cls)) if tok else {}))
        yield pa.RecordBatch.from_arrays([b.column(3), b.column(4), pa.array([o[0] for o in out], pa.string()),
                                          pa.array([len(o[0]) for o in out], pa.int64()),
                                          pa.array([o[1] for o in out], pa.int32())],
                                         names=["page_id", "url", "text", "n_chars", "n_slots"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, n_slots) of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    marked = rows.select(host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page_hash"), "html",
                         F.coalesce("page_id", F.lit(-1)).alias("row"))
    known = templates(marked, min_pages)
    return (rows.withColumn("host", host_of(F.col("url"))).join(known, "host", "left")
            .select("html", "tokens", "classes", "page_id", "url")
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long, n_slots int"))
