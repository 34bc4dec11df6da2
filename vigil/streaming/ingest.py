"""Continuous ingestion: landed page files → normalise → keyed upsert per micro-batch.

``readStream`` over the two landing folders (one JSON envelope per file),
records exploded and normalised with the same column expressions as the
batch path; each micro-batch is deduplicated (keep-latest) and upserted into
the snapshot table inside ``foreachBatch``.  The stream's checkpoint makes a
restarted query resume after the last committed micro-batch.  The table's ledger
holds the last micro-batch of every stream, written with the batch in one commit:
a replayed one is skipped, whatever it had changed, and a stream with a new
checkpoint, or a job, has numbers of its own.  Only the buckets that a micro-batch
touches are rewritten.  Rejects, corrupt pages among them, are kept beside the
table, one folder per stream and micro-batch.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.functions import variant as V
from vigil.operators import dedup
from vigil.operators import normalize as N
from vigil.operators import upsert as U
from vigil.plans.job import write_rejects
from vigil.sources import store as ST
from vigil.sources.landed import position


def _records(pages: DataFrame, key: str, source_rank: int) -> DataFrame:
    """(file, body) → (seq, raw).  seq orders records by (feed, file, position)."""
    doc = V.parse(F.col("value"))
    # a page that is no JSON becomes one record of an undecodable text
    items = F.when(doc.isNull(), F.array(F.lit(None).cast("variant"))).otherwise(V.as_array(V.field(doc, f"$.{key}")))
    rows = pages.select(F.col("_metadata.file_path").alias("_file"), F.posexplode(items).alias("pos", "raw"))
    # feed (1 bit) | file-name hash (30 bits) | position in the file (32 bits): reproducible on replay
    order = F.pmod(F.xxhash64("_file"), F.lit(1 << 30))
    return rows.select(position(source_rank, order, F.col("pos")).alias("seq"), "raw")


def start(spark: SparkSession, cve_dir: str, ip_dir: str, root: str, checkpoint: str,
          available_now: bool = True) -> StreamingQuery:
    """Start the ingest stream (``available_now`` processes what has landed, then stops)."""
    read = spark.readStream.format("text").option("wholetext", "true")
    cve = _records(read.load(cve_dir), "vulnerabilities", 0)
    ip = _records(read.load(ip_dir), "data", 1)
    norm = N.normalize_cve(cve).unionByName(N.normalize_ip(ip))

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # the id that a stream keeps in its checkpoint, whatever folder that is
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        store_batch(spark, root, batch, batch_id, f"stream-{stream or checkpoint.rstrip('/').replace('/', '_')}")

    w = norm.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def store_batch(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, source: str = "stream") -> bool:
    """Keep the rejects of a normalised micro-batch and upsert its rows; False if the ledger holds the batch already."""
    rec = ST.record(spark, root)
    if rec is not None and rec.holds(source, batch_id):
        return False
    batch.persist()
    try:
        write_rejects(N.quarantine(batch), root, source, batch_id)
        rows = ST.to_stored(dedup.keep_latest(N.valid(batch)), ST.next_version(spark, root))
        U.upsert_into(spark, root, rows, source=source, batch_no=batch_id)
        ST.vacuum(spark, root)
    finally:
        batch.unpersist()
    return True
