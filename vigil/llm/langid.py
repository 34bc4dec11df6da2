"""Language identification by prediction by partial matching (PPM).

Per language, a tree of byte contexts up to ``ORDER`` bytes is counted on a
bounded sample of labelled texts and then frozen.  The code length of a byte is
taken from the longest context that has seen it; every context that has not
seen it adds the cost of its escape (method C: a context with n observations
and q different successors codes a successor seen k times with k/(n+q) and
escapes with q/(n+q)); below order 0 a byte costs 8 bits.  A text gets the
language with the shortest exact code length of the whole text.

Texts are folded first: lower case, every run of non-letters one space.

Fitting sample (documented bound): per language ``SAMPLE_BYTES`` UTF-8 bytes, and
``SAMPLE_TOTAL`` over all languages, taken in the order of a hash of id and text
until the bound is reached (the last text may pass it by its own length, itself
cut to the bound), so that the frozen tables have a size that does not grow with
the corpus.  Every language with a labelled text is in the sample, whatever the
number and length of its texts; equal rows count once.

Null text, empty text and text without a letter give ``und`` with score 0; so
does everything when no labelled text exists.  Ties go to the first language in
alphabetical order.  Extra columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import held

UNDETERMINED = "und"
ORDER = 4
SAMPLE_BYTES = 1_000_000
SAMPLE_TOTAL = 8_000_000
_NON_LETTERS = re.compile(r"[\W\d_]+")
_PAD = b" " * ORDER
_CHUNK = 1 << 19
_SLOT_BITS = 21
_MIX = np.uint64(0x9E3779B97F4A7C15)


def fold(text: str) -> str:
    return _NON_LETTERS.sub(" ", text.lower()).strip()


def _codes(data: np.ndarray, order: int) -> np.ndarray:
    """For every byte from position ORDER on: the byte and its ``order`` predecessors as one integer."""
    out = np.zeros(len(data) - ORDER, np.uint64)
    for back in range(order, -1, -1):
        out = (out << np.uint64(8)) | data[ORDER - back:len(data) - back].astype(np.uint64)
    return out


def train(folded: list[str]) -> list[dict]:
    """Frozen tables per order: successor codes with their cost, contexts with their escape cost (bits)."""
    raw = [np.frombuffer(_PAD + t.encode("utf-8", "replace"), np.uint8) for t in folded]
    tables = []
    for order in range(ORDER + 1):
        codes = np.concatenate([_codes(r, order) for r in raw]) if raw else np.empty(0, np.uint64)
        keys, count = np.unique(codes, return_counts=True)
        ctx, first = np.unique(keys >> np.uint64(8), return_index=True)
        q = np.diff(np.append(first, len(keys)))
        n = np.add.reduceat(count, first) if len(keys) else np.empty(0)
        tables.append({"keys": keys, "cost": -np.log2(count / np.repeat(n + q, q)) if len(keys) else np.empty(0),
                       "ctx": ctx, "escape": -np.log2(q / (n + q)) if len(keys) else np.empty(0)})
    return tables


def _find(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return at, sorted_keys[at] == x


def code_lengths(tables: list[dict], codes: np.ndarray) -> np.ndarray:
    """Bits for each (context, byte) code of full order."""
    bits = np.zeros(len(codes))
    open_ = np.arange(len(codes))
    for order in range(ORDER, -1, -1):
        if not len(open_):
            return bits
        x = codes[open_] & np.uint64((1 << 8 * (order + 1)) - 1)
        at, seen = _find(tables[order]["keys"], x)
        bits[open_[seen]] += tables[order]["cost"][at[seen]]
        open_, x = open_[~seen], x[~seen]
        at, known = _find(tables[order]["ctx"], x >> np.uint64(8))
        bits[open_[known]] += tables[order]["escape"][at[known]]
    bits[open_] += 8.0
    return bits


class Scorer:
    """Code lengths of texts under all languages, with a lookup table of the codes seen in training."""

    def __init__(self, model: dict[str, list[dict]]):
        self.model = model
        self.langs = sorted(model)
        self.keys = np.unique(np.concatenate([model[g][ORDER]["keys"] for g in self.langs]))
        self.costs = np.stack([code_lengths(model[g], self.keys) for g in self.langs], axis=1)
        self.slots = np.zeros(1 << _SLOT_BITS, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(self.keys), dtype=np.int32)

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * _MIX) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def costs_of(self, codes: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(codes)]
        out = self.costs[at]
        miss = np.nonzero(self.keys[at] != codes)[0]
        if len(miss):
            uniq, inv = np.unique(codes[miss], return_inverse=True)
            idx, seen = _find(self.keys, uniq)
            part = self.costs[idx]
            if not seen.all():
                new = uniq[~seen]
                part[~seen] = np.stack([code_lengths(self.model[g], new) for g in self.langs], axis=1)
            out[miss] = part[inv]
        return out

    def total_bits(self, folded: list[str]) -> np.ndarray:
        """(texts, languages) code length of every whole text, in double precision."""
        bits = np.zeros((len(folded), len(self.langs)))
        held, owners, size = [], [], 0

        def flush():
            codes = np.concatenate([_codes(h, ORDER) for h in held])
            cost = self.costs_of(codes)
            starts = np.concatenate([[0], np.cumsum([len(h) - ORDER for h in held])[:-1]])
            sums = np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
            np.add.at(bits, owners, sums)

        for i, t in enumerate(folded):
            data = np.frombuffer(_PAD + t.encode("utf-8", "replace"), np.uint8)
            for k in range(0, len(data) - ORDER, _CHUNK):      # a very long text goes in pieces that overlap by a context
                held.append(data[k:k + _CHUNK + ORDER])
                owners.append(i)
                size += len(held[-1])
                if size >= _CHUNK:
                    flush()
                    held, owners, size = [], [], 0
        if held:
            flush()
        return bits


def is_held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_bytes: int = SAMPLE_BYTES, sample_total: int = SAMPLE_TOTAL) -> dict[str, list[dict]]:
    """Frozen tables per language, counted on a bounded sample of the rows given.

    Each language is counted in one task of at most twice ``sample_bytes`` of text.
    """
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                    F.xxhash64(F.col(id_col).cast("string"), F.col(text_col), F.lit("sample")).alias("h")))
    n_langs = rows.select("lang").distinct().count()
    if not n_langs:
        return {}
    bound = max(1, min(sample_bytes, sample_total // n_langs))
    # a hash below 2^-k of the range is on level k: half of the rows of the levels from k on are above k, and so on.
    # The sample is looked for on the highest levels that hold the bound together: about twice the bound, in one task a language
    cut = F.least(F.octet_length("text"), F.lit(bound)).cast("long")
    share = (F.col("h").bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(1)) / F.lit(float(1 << 52))
    level = F.floor(-F.log2(share)).cast("int")
    held = rows.groupBy("lang", level.alias("level")).agg(F.sum(cut).alias("n"))               # at most 53 rows a language
    above = Window.partitionBy("lang").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    needed = (held.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0))).where(F.col("above") < bound)
              .groupBy("lang").agg(F.min("level").alias("lowest")))
    before = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    sample = (rows.join(F.broadcast(needed), "lang").where(level >= F.col("lowest"))
              .select("lang", share.alias("h"), F.substring("text", 1, bound).alias("text"))
              .groupBy("lang", "h").agg(F.min("text").alias("text"))
              .withColumn("used", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
              .where(F.col("used") < bound)
              .select("lang", "text"))

    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for order, t in enumerate(train([fold(x) for x in pdf["text"]])):
            out.append({"lang": key[0], "ord": order, **{k: v.astype("<u8" if v.dtype == np.uint64 else "<f8").tobytes()
                                                         for k, v in t.items()}})
        return pd.DataFrame(out)

    model: dict[str, list[dict]] = {}
    got = sample.groupBy("lang").applyInPandas(
        count, "lang string, ord int, keys binary, cost binary, ctx binary, escape binary").collect()
    for r in sorted(got, key=lambda r: (r["lang"], r["ord"])):
        model.setdefault(r["lang"], []).append(
            {k: np.frombuffer(r[k], "<u8" if k in ("keys", "ctx") else "<f8") for k in ("keys", "cost", "ctx", "escape")})
    return {g: t for g, t in model.items() if len(t[0]["keys"])}


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value
        scorer = held(("langid", id(tables)), lambda: Scorer(tables)) if tables else None
        for b in batches:
            folded = [fold(t.as_py() or "") for t in b.column(1)]
            langs, score, bpb = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows), [None] * b.num_rows
            real = [i for i, t in enumerate(folded) if t and any(map(str.isalpha, t))]
            if scorer and real:
                bits = scorer.total_bits([folded[i] for i in real])
                best = bits.argmin(axis=1)
                low = bits[np.arange(len(real)), best]
                # posterior of the best language under equal priors
                share = 1.0 / np.exp2(np.maximum(low[:, None] - bits, -1000.0)).sum(axis=1)
                for i, g, s, x in zip(real, best, share, low):
                    langs[i], score[i] = scorer.langs[g], s
                    bpb[i] = x / len(folded[i].encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(score), pa.array(bpb, pa.float64())],
                names=["doc_id", "lang_pred", "score", "bits_per_byte"])
    return run


def predict(docs: DataFrame, model: dict[str, list[dict]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, bits_per_byte) of every row; only the text decides.

    ``id_col`` may be of any type (a struct carries whole rows).  The frozen
    tables are broadcast: their size is bounded by the fitting sample.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_predict(shared), f"doc_id {id_type}, lang_pred string, score double, bits_per_byte double") \
        .withColumnRenamed("doc_id", id_col)
