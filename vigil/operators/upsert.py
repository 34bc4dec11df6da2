"""Keyed upsert and write-back into the snapshot.

``upsert`` and ``write_back`` are plans over frames; ``upsert_into`` and
``write_back_into`` apply them to the stored table, reading and writing only the
buckets that the batch's ids fall into (see ``sources.store``).

No ``MERGE INTO`` on plain Parquet, so an upsert is one full outer join of the
snapshot and the batch on the key, with a pick per column:

    only stored  -> the stored row            only in the batch -> the batch row
    both         -> kept columns from the stored row, the others from the batch

Either side is read once.  A key that repeats in the batch or in an update is
settled first, the last position winning, so the snapshot keeps one row per id.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.schemas import STORED_FIELDS, UPSERT_KEEP
from vigil.session import shared_path
from vigil.sources import store as ST


def join_key(df: DataFrame, side: str) -> DataFrame:
    """``_k`` = id, or for a NULL id a unique token of this side.

    NULL ids never match anything, but as a shuffle key they would all land in
    one reducer (a third of the rows may carry no id).  A per-row token keeps
    them spread and still never equal to a real id or to the other side.
    """
    token = F.concat(F.lit(f"\u0000{side}:"),
                     F.coalesce(F.col("batch_id"), F.lit(-1)).cast("string"), F.lit(":"),
                     F.coalesce(F.col("seq"), F.lit(-1)).cast("string"))
    return df.withColumn("_k", F.coalesce(F.col("id"), token))


def upsert(store: DataFrame, batch: DataFrame, only_if_newer: bool = False, first: bool = False) -> DataFrame:
    """K2.  ``batch`` is in stored layout (see ``store.to_stored``); of rows that repeat
    an id the last by (batch_id, seq) counts.

    New id → inserted with NULL write-back columns.  Existing id → the
    overwrite columns (title, description, severity, report_count, last_seen,
    reliability, exploited, extra) come from the batch; threat_type,
    first_seen, source, predictions, label and insertion order are kept.
    ``only_if_newer`` adds the freshness test the upstream table lacks (off by
    default to match it: an older batch overwrites newer values).  NULL keys
    are always new.  ``first`` says that the store is empty: the batch is then grouped by the id itself (and a token
    where there is none), so a batch that comes partitioned by id, as from ``keep_latest``, is not shuffled again.
    """
    row, last = F.struct(*STORED_FIELDS), F.max_by(F.struct(*STORED_FIELDS), F.struct("batch_id", "seq")).alias("_new")
    keyed = join_key(batch, "b")
    new = keyed.groupBy("id", F.when(F.col("id").isNull(), F.col("_k")).alias("_t")).agg(last) \
        .select(F.coalesce("id", "_t").alias("_k"), "_new") if first else keyed.groupBy("_k").agg(last)
    old = join_key(store, "s").select("_k", row.alias("_old"))
    stored, incoming = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    fresh = ~F.lit(only_if_newer) | (F.coalesce("_new.last_seen", F.lit(""))
                                     >= F.coalesce("_old.last_seen", F.lit("")))
    cols = []
    for c in STORED_FIELDS:
        a, b = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        take_new = ~stored if c in UPSERT_KEEP or c == "id" else ~stored | (incoming & fresh)
        cols.append(F.when(take_new, b).otherwise(a).alias(c))
    return old.join(new, "_k", "full_outer").select(*cols)


def write_back(store: DataFrame, updates: DataFrame, columns: list[str],
               position: str | None = None) -> DataFrame:
    """K3/K4: set ``columns`` from ``updates`` (id + columns) for matching ids only.

    Unmatched update ids are ignored; rows without an update keep their
    values; a NULL id never matches.  Of updates that repeat an id the last
    counts, by the column ``position``.  A frame has no order of its own, so without a position
    the greatest values win: the same ones in every run and on every layout.
    """
    place = F.col(position) if position else F.struct(*columns)
    u = (updates.filter(F.col("id").isNotNull())
         .select(F.col("id").alias("_k"), F.struct(*columns).alias("_new"), place.alias("_at"))
         .groupBy("_k").agg(F.max_by("_new", "_at").alias("_new")))
    j = join_key(store, "s").join(u, "_k", "left")
    out = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
           if c in columns else F.col(c) for c in STORED_FIELDS]
    return j.select(*out)


def write_labels(store: DataFrame, labels: DataFrame, position: str | None = None) -> DataFrame:
    """K3: ``labels`` has (id, heuristic_label)."""
    return write_back(store, labels, ["heuristic_label"], position)


def write_predictions(store: DataFrame, predictions: DataFrame, position: str | None = None) -> DataFrame:
    """K4: ``predictions`` has (id, predicted_priority, predicted_priority_score)."""
    return write_back(store, predictions, ["predicted_priority", "predicted_priority_score"], position)


# ------------------------------------------------------------- stored table --
def _landed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The batch as a table: its buckets and its rows are read from the same copy, whatever happens to an executor."""
    path = shared_path(df.sparkSession, f"vigil-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def touched(keys: DataFrame, n_buckets: int) -> list[int]:
    """The buckets of these rows (id, batch_id, seq); at most ``n_buckets`` numbers."""
    return sorted(r["b"] for r in keys.select(ST.bucket_of(n_buckets).alias("b")).distinct().collect())


def _touched_types(held: DataFrame, batch: DataFrame, stored: set[str | None]) -> set[str | None]:
    """The threat types that the batch brings or whose stored rows it matches; types are few, being folders."""
    hit = {r["threat_type"] or None for r in batch.select("threat_type").distinct().collect()}
    if stored - hit:
        ids = batch.select("id").filter(F.col("id").isNotNull()).distinct()
        rest = held.filter(~F.coalesce(F.col("threat_type").isin(*[t for t in hit if t]), F.lit(False)))
        hit |= {r["threat_type"] for r in rest.select("id", "threat_type").join(ids, "id", "left_semi")
                .select("threat_type").distinct().collect()}
    return hit


def upsert_into(spark: SparkSession, root: str, batch: DataFrame, only_if_newer: bool = False, n_buckets: int | None = None,
                source: str | None = None, batch_no: int | None = None) -> int:
    """K2 on the stored table: the buckets of the batch's ids are merged and written as the next version.

    Of these buckets, the types that the batch neither brings nor matches by id stay where they are.
    A batch that the ledger holds for its source is not applied again; the current version is returned.
    """
    base = ST.record(spark, root)
    if base is None:
        return ST.commit(spark, root, upsert(ST.empty_snapshot(spark), batch, only_if_newer, first=True), n_buckets, source, batch_no)
    if base.holds(source, batch_no):
        return base.version
    batch, path = _landed(batch, "batch")
    buckets = touched(batch, base.n_buckets)
    held = [b for b in buckets if b in base.buckets]
    found = ST.partitions(spark, root, base, held)
    whole = ST.scan(spark, root, base.version, held)
    hit = _touched_types(whole, batch, {t for t, _ in found.values()}) if held else set()
    kept = {p: v for p, (t, v) in found.items() if t not in hit}
    if kept:
        named = F.coalesce(F.col("threat_type").isin(*[t for t in hit if t]), F.lit(False))
        whole = whole.filter(named | F.col("threat_type").isNull() if None in hit else named)
    part, obs = ST.observed_rows(whole, f"held-{uuid.uuid4().hex}")
    merged = upsert(part, batch, only_if_newer) if held else upsert(ST.empty_snapshot(spark), batch, only_if_newer)
    v = ST.commit_buckets(spark, root, base, merged, buckets, obs if held else 0, source, batch_no, kept)
    ST.remove(spark, path)
    return v


def write_back_into(spark: SparkSession, root: str, updates: DataFrame, columns: list[str], position: str | None = None,
                    source: str | None = None, batch_no: int | None = None) -> int:
    """K3/K4 on the stored table: only the buckets that hold ids of the updates are written."""
    base = ST.record(spark, root)
    if base is None:
        raise RuntimeError("nothing is stored yet")
    if base.holds(source, batch_no):
        return base.version
    updates, path = _landed(updates.filter(F.col("id").isNotNull()), "updates")
    none = F.lit(None).cast("bigint")
    buckets = [b for b in touched(updates.select("id", none.alias("batch_id"), none.alias("seq")), base.n_buckets)
               if b in base.buckets]
    changed = write_back(ST.scan(spark, root, base.version, buckets), updates, columns, position) if buckets \
        else ST.empty_snapshot(spark)
    v = ST.commit_buckets(spark, root, base, changed, buckets, None, source, batch_no)
    ST.remove(spark, path)
    return v
