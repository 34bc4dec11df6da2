"""End-to-end plans as functions DataFrame → DataFrame (R1–R4).

Everything here is lazy until a caller writes or collects; Catalyst sees the
whole chain (normalise → dedup → upsert → features → labels) as one plan.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import rounding as R
from vigil.operators import dedup, features, labels
from vigil.operators import normalize as N
from vigil.operators import upsert as U
from vigil.sources import store as ST
from vigil.sources.fixtures import FIXTURE_NOW, raw_feeds
from vigil.session import configure


def ingest(cve_raw: DataFrame, ip_raw: DataFrame, batch_id: int = 0
           ) -> tuple[DataFrame, DataFrame]:
    """normalise → quarantine split → keep-latest → stored layout.  Returns (batch, quarantine)."""
    norm = N.normalize_batch(cve_raw, ip_raw)
    good, bad = N.split_rejects(norm)
    return ST.to_stored(dedup.keep_latest(good), batch_id), bad


def label_snapshot(snapshot: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Stored rows + nine features + priority_score + heuristic_label."""
    return labels.apply_heuristic_labels(features.with_features(snapshot, now))


FILLED = ["report_count", "exploited_flag", "severity_raw", "source_reliability"]


def labelled_in_place(snapshot: DataFrame, now: dt.datetime | str, keep_features: bool = False) -> DataFrame:
    """Snapshot rows + features + ``priority_score`` with the *stored* values of the
    columns feature filling overwrites kept intact, and ``heuristic_label`` set.

    Equivalent to writing the labels back by id (labels come from these very
    rows) but without a join: at table scale that saves a full shuffle of the
    snapshot on both sides.  NULL-id rows keep a NULL label, as a keyed update
    never matches them.  ``keep_features`` leaves the filled columns filled (for
    training), the stored values in ``_s_*`` and every row's label in ``any_label``.
    """
    stash = snapshot.withColumns({f"_s_{c}": F.col(c) for c in FILLED})
    lab = label_snapshot(stash, now)
    if keep_features:
        return lab.withColumns({"any_label": F.col("heuristic_label"),
                                "heuristic_label": F.when(F.col("id").isNotNull(), F.col("heuristic_label"))})
    return lab.withColumns({
        **{c: F.col(f"_s_{c}") for c in FILLED},
        "heuristic_label": F.when(F.col("id").isNotNull(), F.col("heuristic_label")),
        "priority_score": F.when(F.col("id").isNotNull(), F.col("priority_score")),
    }).drop(*[f"_s_{c}" for c in FILLED])


_FEEDS: dict = {}


def landed_feeds(spark: SparkSession, sf_dir: str, defects: bool = False) -> tuple[DataFrame, DataFrame]:
    """The driver tables mapped to raw feeds, landed once per session as JSON text.

    Queries and benchmarks then start from landed records, as a job does, and do
    not build JSON from tables each time.
    """
    import uuid

    from vigil.session import shared_path
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, defects)
    if key not in _FEEDS:
        path = shared_path(spark, "vigil-feeds", uuid.uuid4().hex)
        for name, raw in zip(("cve", "ip"), raw_feeds(spark, sf_dir, defects)):
            raw.write.parquet(f"{path}/{name}", compression="zstd")
        _FEEDS[key] = path
    return tuple(spark.read.schema("seq bigint, raw string").parquet(f"{_FEEDS[key]}/{name}") for name in ("cve", "ip"))


def fixture_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed feeds ingested as batch 0."""
    return ingest(*landed_feeds(spark, sf_dir))[0]


def fixture_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 0 upserted into an empty store (lazy: no write)."""
    return U.upsert(ST.empty_snapshot(spark), fixture_batch(spark, sf_dir), first=True)


_STORES: dict = {}


def with_predictions_from_heuristic(snapshot: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Snapshot with labels written back and the heuristic (label, score) as the
    prediction columns — a deterministic scorer, so serving queries have exact
    SQL oracles (scores at 6 decimals: exp() differs in the last bit between engines,
    and ranking must not depend on it).  Written in place (see ``labelled_in_place``): no join back."""
    lab = labelled_in_place(snapshot, now)
    return lab.select(*[F.col("heuristic_label").alias(c) if c == "predicted_priority"
                        else R.scaled(F.col("priority_score"), 6).alias(c) if c == "predicted_priority_score"
                        else F.col(c) for c in ST.STORED_FIELDS])


def fixture_store(spark: SparkSession, sf_dir: str, served: bool = False) -> dict:
    """Run the fixture pipeline once per session and keep its snapshot table.

    v1 = ingested batch upserted into an empty store; v2 = v1 with labels and
    predictions written back, made when a query first asks for what is ``served``.  Both are Parquet versions under a fresh folder of
    the shared checkpoint directory, so every later query scans a table (with
    partition pruning and pushed filters) instead of re-running ingestion.
    """
    import uuid

    from vigil.session import shared_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        root = shared_path(spark, "vigil-store", uuid.uuid4().hex)
        v1 = ST.commit(spark, root, fixture_upserted(spark, sf_dir))
        _STORES[key] = {"root": root, "ingested": v1}
    st = _STORES[key]
    if served and "served" not in st:
        snap = ST.scan(spark, st["root"], st["ingested"])
        st["served"] = ST.commit(spark, st["root"], with_predictions_from_heuristic(snap, FIXTURE_NOW))
    return st


def fixture_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed ingest snapshot (v1)."""
    st = fixture_store(spark, sf_dir)
    return ST.scan(spark, st["root"], st["ingested"])


def fixture_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_snapshot(fixture_snapshot(spark, sf_dir), FIXTURE_NOW)


def served_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed snapshot with labels and predictions (v2), as serving reads it."""
    st = fixture_store(spark, sf_dir, served=True)
    return ST.scan(spark, st["root"], st["served"])


def served_lookup(spark: SparkSession, sf_dir: str, threat_id: str) -> DataFrame:
    """The served rows of one id, read from its bucket."""
    st = fixture_store(spark, sf_dir, served=True)
    return ST.lookup(spark, st["root"], threat_id, st["served"])


def write_copy(spark: SparkSession, sf_dir: str) -> str:
    """A store of its own with the ingest snapshot, for a query that writes."""
    import uuid

    from vigil.session import shared_path
    root = shared_path(spark, "vigil-store", uuid.uuid4().hex)
    ST.commit(spark, root, fixture_snapshot(spark, sf_dir))
    return root


UPSERT_SPLIT_TS = "2024-01-16 00:00:00"
REPEAT_SEQ = 1 << 40


def two_batch_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1: all vulnerability records + address reports from 16 Jan on;
    batch 2: the *older* reports (1–15 Jan), upserted afterwards.  Exercises
    insert, overwrite-with-older (no freshness test) and kept columns."""
    from vigil.sources.fixtures import cve_records, ip_records
    from vigil.sources.tables import read_table
    configure(spark)
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice",
                        "o_orderpriority", "o_orderstatus")
    lineitem = read_table(spark, sf_dir, "lineitem",
                          "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    events = read_table(spark, sf_dir, "events",
                        "event_id", "ts", "user_id", "event_type", "value", "props")
    late = events.filter(F.col("ts") >= F.lit(UPSERT_SPLIT_TS).cast("timestamp_ntz"))
    early = events.filter(F.col("ts") < F.lit(UPSERT_SPLIT_TS).cast("timestamp_ntz"))
    import uuid

    from vigil.session import shared_path
    b1, _ = ingest(cve_records(orders, lineitem), ip_records(late), batch_id=1)
    b2 = ST.to_stored(dedup.keep_latest(N.valid(N.normalize_ip(ip_records(early)))), batch_id=2)
    # every third id comes again, later in the batch: the last one counts
    one, twice = F.struct("severity_raw", "seq"), F.struct(F.lit(1.5).alias("severity_raw"), (F.col("seq") + REPEAT_SEQ).alias("seq"))
    b2 = b2.withColumn("_row", F.explode(F.when(F.col("seq") % 3 == 0, F.array(one, twice)).otherwise(F.array(one)))) \
        .withColumns({"severity_raw": F.col("_row.severity_raw"), "seq": F.col("_row.seq")}).drop("_row")
    root = shared_path(spark, "vigil-store", uuid.uuid4().hex)
    U.upsert_into(spark, root, b1)
    U.upsert_into(spark, root, b2)
    return ST.scan(spark, root)
