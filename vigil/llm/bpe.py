"""Byte-level BPE by prefix dynamic programming.

The encoding of a prefix ends in exactly one token, and without that token it is
the encoding of the shorter prefix.  So a byte string is encoded by a table that
holds the last token of every prefix: of the tokens that end at a position (an
Aho-Corasick automaton lists them) the one is taken that the merges leave beside
the last token of the prefix before it.  Whether two tokens stay side by side is
read off their merge trees: the merges along the common border are undone from
the last one back, and no merge across the border may come before the one undone.

The table makes appends exact (only new prefixes are filled in) and edits cheap:
behind an edit, prefixes are filled in again until as many last tokens as the
longest token has bytes are the old ones; the rest of the table still holds.

Texts are split by a pattern first, and each match is encoded by itself, as
``tiktoken`` does: a match that is a token is that token, any other one goes
through the table.  No special tokens.  Null text counts as empty and has no
ids; repeated rows and null ids are kept; an empty table gives an empty result;
texts of any length are encoded whole, long matches in blocks by appending.
Extra columns are ignored.
"""
from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16            # bytes of a long match that are appended at a time
KEPT_MATCHES = 200_000     # encodings of short matches in each of the two generations that a task keeps
KEPT_PAIRS = 250_000       # token pairs whose verdict a task keeps
SHORT = 64                 # matches of more characters are not kept
OUT_IDS = 1 << 20          # ids of an output batch

_NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_by_rank(data: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[bytes]:
    """Plain BPE: the adjacent pair of least rank is merged, the leftmost first, while that rank is under ``below``."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below or rank == _NEVER:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Ranks with the last merge of every token; small enough to broadcast (its size is that of the file)."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        if len(self.bytes_of) != len(ranks):
            raise ValueError("two tokens share a rank")
        self.longest = max(map(len, ranks))
        #: the two tokens whose merge makes a token; absent for bytes and for tokens that no merge reaches
        self.halves: dict[int, tuple[int, int]] = {}
        for token, i in ranks.items():
            if len(token) > 1:
                parts = merge_by_rank(token, ranks, below=i)
                if len(parts) == 2:
                    self.halves[i] = (ranks[parts[0]], ranks[parts[1]])
        #: tokens that merges reach; of each its length and the longest shorter one that it starts with (-1: none)
        self.whole = {t: i for t, i in ranks.items() if len(t) == 1 or i in self.halves}
        self.size, self.shorter = [0] * (max(self.bytes_of) + 1), [-1] * (max(self.bytes_of) + 1)
        #: the length of the longest one that starts with given four bytes
        self.reach: dict[bytes, int] = {}
        for t, i in self.whole.items():
            self.size[i] = len(t)
            self.shorter[i] = next((self.whole[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.whole), -1)
            if len(t) > 3:
                self.reach[t[:4]] = max(len(t), self.reach.get(t[:4], 0))
        self._automaton = None
        #: per left token, the right tokens judged so far
        self.verdicts: dict[int, dict[int, bool]] = defaultdict(dict)
        self._known = 0

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None, "verdicts": defaultdict(dict), "_known": 0}

    @property
    def automaton(self):
        """All tokens that merges reach, with (id, number of bytes), over bytes written as Latin-1."""
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for token, i in self.whole.items():
                self._automaton.add_word(token.decode("latin-1"), (i, len(token)))
            self._automaton.make_automaton()
        return self._automaton

    def beside(self, a: int, b: int) -> bool:
        """Do the merges of the bytes of a and b end in just these two tokens?"""
        row = self.verdicts[a]
        known = row.get(b)
        if known is None:
            self._known += 1
            if self._known > KEPT_PAIRS:
                self.verdicts.clear()
                self._known = 1
                row = self.verdicts[a]
            known = row[b] = self._stay(a, b)
        return known

    def short(self, data: bytes) -> list[int]:
        """The encoding of a short string, through the entries of its prefix table that lie on the way.

        A prefix's last token is known as soon as one token behind an encoded prefix stays beside that prefix's last
        token.  So the table is filled in from the left, the longest token first; an entry from which no token leads on
        is kept as such and not entered again.
        """
        n, whole, reach, size, shorter, verdicts = len(data), self.whole, self.reach, self.size, self.shorter, self.verdicts
        table: list[int] = [-1] * (n + 1)
        out, at, left, token = [], 0, -1, -2
        while at < n:
            if token == -2:                               # the longest token from here on
                k = reach.get(data[at:at + 4], 3)
                if k > n - at:
                    k = n - at
                token = whole.get(data[at:at + k])
                while token is None:
                    k -= 1
                    token = whole.get(data[at:at + k])
            while token >= 0:
                if table[at + size[token]] < 0:
                    if left < 0:
                        break
                    stay = verdicts[left].get(token)
                    if stay or (stay is None and self.beside(left, token)):
                        break
                token = shorter[token]
            if token >= 0:
                at += size[token]
                table[at] = left = token
                out.append(token)
                token = -2
            else:
                token = out.pop()
                at -= size[token]
                left = out[-1] if out else -1
                token = shorter[token]
        return out

    def _stay(self, a: int, b: int) -> bool:
        halves, ranks, text = self.halves, self.ranks, self.bytes_of
        ends_a = ends_b = _NEVER                     # ranks of the merges that use up the parts at the border
        while True:
            across = ranks.get(text[a] + text[b], _NEVER)
            # at equal ranks the left merge comes first: a's own before the one across, that before b's
            if across < ends_a and across <= ends_b and across != _NEVER:
                return False
            born_a = a if a in halves else -1
            born_b = b if b in halves else -1
            if born_a < 0 and born_b < 0:
                return True
            if born_a > born_b:
                ends_a, a = a, halves[a][1]
            else:
                ends_b, b = b, halves[b][0]


class PrefixTable:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []                    # last[i]: last token of data[:i + 1]
        self.append(data)

    def append(self, data: bytes) -> None:
        """The string with ``data`` behind it; only the new prefixes are filled in."""
        for at in range(0, len(data), BLOCK):
            start = len(self.data)
            self.data += data[at:at + BLOCK]
            self.last += [-1] * (len(self.data) - start)
            self._fill(start, len(self.data))

    def _fill(self, start: int, stop: int) -> None:
        """The last tokens of the prefixes that end at start .. stop - 1."""
        last, beside = self.last, self.vocabulary.beside
        begin = max(0, start - self.vocabulary.longest + 1)
        done = start - 1
        for end, (token, n) in self.vocabulary.automaton.iter(self.data[begin:stop].decode("latin-1")):
            end += begin
            if end <= done:
                continue
            before = end - n
            if before < 0:                           # the token is the whole prefix
                last[end], done = token, end
                continue
            if beside(last[before], token):
                last[end], done = token, end

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Bytes start .. stop - 1 become ``data``; returns how many prefixes were filled in again."""
        tail, tail_last = self.data[stop:], self.last[stop:]
        del self.data[start:], self.last[start:]
        self.append(bytes(data))
        filled, same, at, step = len(data), 0, 0, 4 * self.vocabulary.longest
        while at < len(tail):
            base = len(self.data)
            self.data += tail[at:at + step]
            self.last += [-1] * (len(self.data) - base)
            self._fill(base, len(self.data))
            filled += len(self.data) - base
            for i in range(base, len(self.data)):
                # an old last token counts only where it does not reach back over the edit's border
                new = self.last[i]
                same = same + 1 if new == tail_last[at + i - base] else 0
            at += step
            if same >= self.vocabulary.longest and at < len(tail):
                self.data += tail[at:]
                self.last += tail_last[at:]
                break
        return filled

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of data[:end]: the last tokens, walked back."""
        at, out, text = (len(self.data) if end is None else end), [], self.vocabulary.bytes_of
        while at > 0:
            token = self.last[at - 1]
            out.append(token)
            at -= len(text[token])
        return out[::-1]


class _Kept(dict):
    """Ids of matches as little-endian 32-bit numbers; a missing one is encoded, a short one kept.

    Kept in two generations: when the young one is full it becomes the old one, and what is asked for again moves over.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.old: dict[str, bytes] = {}

    def __missing__(self, match: str) -> bytes:
        out = self.old.get(match)
        if out is None:
            data = match.encode("utf-8")
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                ids = [whole]
            elif len(data) <= 4 * SHORT:
                ids = self.vocabulary.short(data)
            else:
                ids = PrefixTable(self.vocabulary, data).ids()
            out = pack(f"<{len(ids)}i", *ids)
        if len(match) <= SHORT:
            if len(self) >= KEPT_MATCHES:
                self.old = dict(self)
                self.clear()
            self[match] = out
        return out


def plain_pattern(pattern: str):
    """The pattern for the standard ``re``, with its Unicode classes written out for the code points below 65536.

    ``re`` is the faster one on such texts; None where the pattern holds a class that is not written out.
    """
    import re

    import regex

    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    classes = {}
    for name in (r"\p{L}", r"\p{N}", r"\s", r"\S"):
        runs = regex.finditer(f"{name}+", every, regex.V0)
        classes[name] = "".join(f"\\u{ord(m.group()[0]):04x}-\\u{ord(m.group()[-1]):04x}" for m in runs)
    out, at, inside = [], 0, False
    while at < len(pattern):
        name = next((n for n in classes if pattern.startswith(n, at)), None)
        if name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
            at += len(name)
        elif pattern[at] == "\\":
            if pattern[at + 1:at + 2].isalnum():
                return None
            out.append(pattern[at:at + 2])
            at += 2
        else:
            inside = pattern[at] == "[" or (inside and pattern[at] != "]")
            out.append(pattern[at])
            at += 1
    return re.compile("".join(out))


class Encoder:
    """Texts to ids: split by the pattern, each match by the table; short matches are kept."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.plain = plain_pattern(pattern)
        self.kept = _Kept(vocabulary)

    def match_ids(self, match: str) -> list[int]:
        return np.frombuffer(self.kept[match], "<i4").tolist()

    def packed(self, text: str) -> bytes:
        plain = self.plain is not None and (text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text))
        split = self.plain if plain else self.pattern
        return b"".join(map(self.kept.__getitem__, split.findall(text)))

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()


class EditableText:
    """A text with its matches and their ids; edits split and encode again only near the change.

    Splitting goes left to right and looks at most one character past the one
    behind a match, so matches that end two characters before an edit stay; from
    the first border behind the edit that was a border before, the rest stays too.
    """

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.text = ""
        self.ends: list[int] = []
        self.parts: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> int:
        """Characters start .. stop - 1 become ``text``; returns the number of matches encoded."""
        from bisect import bisect_left, bisect_right

        keep = bisect_right(self.ends, start - 2)
        shift = len(text) - (stop - start)
        self.text = self.text[:start] + text + self.text[stop:]
        ends, parts = [], []
        at, rest = self.ends[keep - 1] if keep else 0, len(self.ends)
        for m in self.encoder.pattern.finditer(self.text, at):
            ends.append(m.end())
            parts.append(self.encoder.match_ids(m.group()))
            old = m.end() - shift
            if old >= stop and m.end() >= start + len(text):
                i = bisect_left(self.ends, old)
                if i < len(self.ends) and self.ends[i] == old:
                    rest = i + 1
                    break
        self.ends = self.ends[:keep] + ends + [e + shift for e in self.ends[rest:]]
        self.parts = self.parts[:keep] + parts + self.parts[rest:]
        return len(parts)

    def ids(self) -> list[int]:
        return [i for part in self.parts for i in part]


# ------------------------------------------------------------------ Spark
_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder a worker, so that what it keeps serves all its tasks."""
    key = shared.value.key
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, pattern)
    return _ENCODERS[key]


def _batches(rows: Iterator[tuple[int | None, bytes]]) -> Iterator[pa.RecordBatch]:
    """(id, packed ids) as record batches of about ``OUT_IDS`` ids."""
    keys, sizes, arrays, held = [], [0], [], 0
    for key, ids in rows:
        keys.append(key)
        arrays.append(ids)
        sizes.append(len(ids) // 4)
        held += len(ids) // 4
        if held >= OUT_IDS or len(keys) >= 10_000:
            yield _batch(keys, sizes, arrays)
            keys, sizes, arrays, held = [], [0], [], 0
    if keys:
        yield _batch(keys, sizes, arrays)


def _batch(keys, sizes, arrays) -> pa.RecordBatch:
    ids = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.frombuffer(b"".join(arrays), "<i4")))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids], names=["doc_id", "ids"])


def _encode(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)
        yield from _batches((d.as_py(), encoder.packed(t.as_py() or "")) for b in batches
                            for d, t in zip(b.column(0), b.column(1)))
    return run


def _reencode(shared, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, pattern)

        def rows():
            for b in batches:
                for r in b.to_pylist():
                    text = EditableText(encoder, r["text"] or "")
                    for e in r["edits"] or []:
                        text.replace(e["start"], e["stop"], e["text"] or "")
                    yield r["doc_id"], np.asarray(text.ids(), "<i4").tobytes()
        yield from _batches(rows())
    return run


def _decode(tokens):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = tokens.value
        for b in batches:
            offsets, values = b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy()
            data = [b"".join(map(text.__getitem__, values[i:j].tolist())) for i, j in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(data, pa.large_binary()).cast(pa.binary())],
                                             names=["doc_id", "ids", "decoded"])
    return run


def share(spark, path: str):
    """The vocabulary of a rank file as a broadcast (its size is bounded by the file)."""
    import hashlib

    vocabulary = Vocabulary(read_ranks(path))
    vocabulary.key = hashlib.sha1(repr(sorted(vocabulary.ranks.items())).encode()).hexdigest()
    return spark.sparkContext.broadcast(vocabulary)


def encode(docs: DataFrame, vocabulary, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row; ``vocabulary`` comes from ``share``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encode(vocabulary, pattern), "doc_id long, ids array<int>")


def reencode(docs: DataFrame, vocabulary, pattern: str) -> DataFrame:
    """(doc_id, ids) of texts after their edits: ``edits array<struct<start, stop, text>>``, in characters, one after the
    other, each in the text that the one before left."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "edits")
    return rows.mapInArrow(_reencode(vocabulary, pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids."""
    known = vocabulary.value.bytes_of
    tokens = encoded.sparkSession.sparkContext.broadcast([known.get(i, b"") for i in range(max(known) + 1)])
    return encoded.select("doc_id", "ids").mapInArrow(_decode(tokens), "doc_id long, ids array<int>, decoded binary")
