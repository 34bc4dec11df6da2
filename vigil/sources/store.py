"""Snapshot table: the one keyed table everything reads and writes.

Layout: ``<root>/v=<version>/bucket=<b>/threat_type=<t>/`` Parquet files.  Rows
are bucketed by a hash of their id; a version holds the buckets that its write
touched, whole, and the commit record ``v=<version>/_commit.json`` says in which
version each bucket's rows are.  So an update of few ids rewrites few buckets, and
the rest of the table stays where it is.  Of a touched bucket, the types that hold
none of the ids stay in the version they are in, by the record's ``kept``.

The record is written last and appears at once (one renamed file): readers go by
the newest record, so they see a write whole or not at all, and a failed or lost
job leaves a folder without a record, which nobody reads.  The same record is the
ingest ledger: per source the last batch stored, apart from any row value, so a
replayed batch is known even if it inserted nothing, and two sources that number
their batches alike never meet.  It is small whatever the table holds (a number
per bucket and per source).

One writer at a time: a write that finds another one committed since it read the
table raises ``ConcurrentWrite`` and leaves nothing behind.
"""
from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vigil.schemas import STORED, STORED_FIELDS

N_BUCKETS = 16                 # of a new table, unless asked for otherwise
ROWS_PER_BUCKET = 2_000_000    # a full rewrite of a larger table takes more buckets
KEEP_VERSIONS = 8              # committed versions that ``vacuum`` leaves readable
RECORD = "_commit.json"        # the underscore hides it from table scans


class ConcurrentWrite(RuntimeError):
    """Another write was committed after this one had read the table."""


@dataclass
class Commit:
    """What a version's record says: where each bucket is, the ledger, the row count."""
    version: int
    n_buckets: int
    buckets: dict[int, int] = field(default_factory=dict)      # bucket → version that holds its rows
    batches: dict[str, int] = field(default_factory=dict)      # source → last batch stored
    rows: int = 0
    written: list[int] = field(default_factory=list)           # buckets that this version wrote
    kept: dict[str, int] = field(default_factory=dict)         # bucket=<b>/threat_type=<t> → older version that still holds it

    def holds(self, source: str | None, batch: int | None) -> bool:
        """Is this batch of the source stored already?"""
        return source is not None and batch is not None and self.batches.get(source, -1) >= batch


def empty_snapshot(spark: SparkSession) -> DataFrame:
    """K1: the table definition as an empty frame with the stored schema.

    Built as ``LIMIT 0`` over typed NULLs, which the optimizer folds into an
    empty local relation, so joins against a new table are pruned at plan time.
    """
    return spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in STORED.fields]).limit(0)


def to_stored(batch: DataFrame, batch_id: int = 0) -> DataFrame:
    """Common-schema rows (+ seq) → stored layout, write-back columns NULL."""
    def no_nan(c: str):
        # A NaN binds as NULL in a keyed SQL table; keep the same rule here.
        return F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)

    return batch.select(
        *[F.col(c) for c in ("id", "threat_type", "title", "description")],
        no_nan("severity_raw"),
        *[F.col(c) for c in ("report_count", "first_seen", "last_seen", "source")],
        no_nan("source_reliability"),
        F.col("exploited_flag").cast("int").alias("exploited_flag"),
        F.col("extra"),
        F.lit(None).cast("string").alias("predicted_priority"),
        F.lit(None).cast("double").alias("predicted_priority_score"),
        F.lit(None).cast("string").alias("heuristic_label"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("seq").cast("bigint").alias("seq"),
    )


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, root: str) -> list[int]:
    """All version folders, committed or not."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v="))


def _folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:06d}"


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    fs, _ = _fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    return [v for v in _versions(spark, root) if fs.exists(path(f"{_folder(root, v)}/{RECORD}"))]


def current_version(spark: SparkSession, root: str) -> int | None:
    fs, _ = _fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for v in reversed(_versions(spark, root)):
        if fs.exists(path(f"{_folder(root, v)}/{RECORD}")):
            return v
    return None


def next_version(spark: SparkSession, root: str) -> int:
    """Past every folder that exists: one that a lost write left is never written into."""
    return max(_versions(spark, root), default=0) + 1


def record(spark: SparkSession, root: str, version: int | None = None) -> Commit | None:
    """The commit record of a version (default: the newest), None for a new table."""
    v = version if version is not None else current_version(spark, root)
    if v is None:
        return None
    fs, p = _fs(spark, f"{_folder(root, v)}/{RECORD}")
    stream = fs.open(p)
    try:
        doc = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    doc["buckets"] = {int(b): w for b, w in doc["buckets"].items()}
    return Commit(**doc)


def _write_record(spark: SparkSession, root: str, c: Commit) -> None:
    fs, p = _fs(spark, f"{_folder(root, c.version)}/{RECORD}")
    draft = p.suffix(".tmp")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(asdict(c)).encode()))
    finally:
        out.close()
    if not fs.rename(draft, p):
        raise OSError(f"the record of version {c.version} could not be put in place")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder that the caller made."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def bucket_of(n_buckets: int) -> Column:
    """A row's bucket: a hash of its id, or of its own position where it has none (such rows never match)."""
    return F.pmod(F.when(F.col("id").isNotNull(), F.xxhash64("id")).otherwise(F.xxhash64("batch_id", "seq")),
                  F.lit(n_buckets)).cast("int")


def scan(spark: SparkSession, root: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """S6: the current (or a given) snapshot, or only some of its buckets; empty with schema when there is none."""
    rec = record(spark, root, version)
    paths = _paths(root, rec, buckets)
    if not paths:
        return empty_snapshot(spark)
    return spark.read.schema(STORED).option("basePath", root).parquet(*paths).select(*STORED_FIELDS)


def _paths(root: str, rec: Commit | None, buckets: list[int] | None = None) -> list[str]:
    """The folders that hold the rows of a version, or of some of its buckets."""
    live = {} if rec is None else {b: v for b, v in rec.buckets.items() if buckets is None or b in set(buckets)}
    kept = _kept(rec, live)
    if live and not kept and set(live.values()) == {rec.version} and set(live) == set(rec.written):
        return [_folder(root, rec.version)]
    return [f"{_folder(root, v)}/bucket={b}" for b, v in sorted(live.items())] + [f"{_folder(root, v)}/{p}" for p, v in sorted(kept.items())]


def _kept(rec: Commit | None, buckets) -> dict[str, int]:
    """The record's kept partitions in these buckets."""
    return {} if rec is None else {p: v for p, v in rec.kept.items() if _bucket(p) in buckets}


def _bucket(partition: str) -> int:
    return int(partition.split("/")[0][len("bucket="):])


def partitions(spark: SparkSession, root: str, rec: Commit, buckets: list[int]) -> dict[str, tuple[str | None, int]]:
    """bucket=<b>/threat_type=<t> → (type, version) of all rows in these buckets."""
    out = {}
    for b in buckets:
        fs, p = _fs(spark, f"{_folder(root, rec.buckets[b])}/bucket={b}")
        for s in fs.listStatus(p):
            if s.getPath().getName().startswith("threat_type="):
                out[f"bucket={b}/{s.getPath().getName()}"] = rec.buckets[b]
    out |= _kept(rec, buckets)
    types = {p: unquote(p.split("/", 1)[1][len("threat_type="):]) for p in out}
    return {p: (None if types[p] == "__HIVE_DEFAULT_PARTITION__" else types[p], v) for p, v in out.items()}


def footer_stats(spark: SparkSession, root: str, version: int | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """S7 from the files' footers: ``n_threats``, and ``<c>_min``, ``<c>_max`` and ``<c>_n`` (values) of flat columns.

    The aggregate is pushed into the Parquet reader, which no column chunk leaves; a session of its own carries the
    two settings that this takes, so the caller's stay as they are.
    """
    aggs = [F.count(F.lit(1)).alias("n_threats")]
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count(c).alias(f"{c}_n")]
    paths = _paths(root, record(spark, root, version))
    if not paths:
        return empty_snapshot(spark).agg(*aggs)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(STORED).option("basePath", root).parquet(*paths).agg(*aggs)


def lookup(spark: SparkSession, root: str, threat_id: str, version: int | None = None) -> DataFrame:
    """The rows of one id: its bucket's files only, of these the row groups that its Parquet filters let pass."""
    rec = record(spark, root, version)
    if rec is None:
        return empty_snapshot(spark)
    # a literal is folded: no job
    b = spark.range(1).select(F.pmod(F.xxhash64(F.lit(threat_id)), F.lit(rec.n_buckets)).alias("b")).first()["b"]
    return scan(spark, root, rec.version, [int(b)]).filter(F.col("id") == threat_id)


def count(snapshot: DataFrame) -> DataFrame:
    """S7: row count as a one-row frame."""
    return snapshot.agg(F.count(F.lit(1)).alias("n_threats"))


def _write(df: DataFrame, path: str, n_buckets: int, parts: int, ids: int) -> None:
    """Rows into bucket folders, each file in id order with a bloom filter on the id.

    The rows are rebalanced by bucket, into ``parts`` tasks to begin with: a bucket too large for one task (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)
    is written by several, each a file, so a task's sort stays as it is when the table grows.
    """
    (df.select(*STORED_FIELDS).withColumn("bucket", bucket_of(n_buckets))
     .hint("rebalance", max(1, parts), "bucket").sortWithinPartitions("bucket", "threat_type", "id")
     .write.option("parquet.bloom.filter.enabled#id", "true")
     .option("parquet.bloom.filter.expected.ndv#id", str(max(1024, ids)))
     .partitionBy("bucket", "threat_type").parquet(path))


def _finish(spark: SparkSession, root: str, base: Commit | None, new: Commit, source: str | None, batch: int | None) -> int:
    """The record of a written version, unless another write came in between."""
    new.batches = dict(base.batches if base else {})
    if source is not None and batch is not None:
        new.batches[source] = max(batch, new.batches.get(source, batch))
    if current_version(spark, root) != (base.version if base else None):
        remove(spark, _folder(root, new.version))
        raise ConcurrentWrite(f"version {current_version(spark, root)} of {root} was committed meanwhile")
    _write_record(spark, root, new)
    return new.version


def _written(spark: SparkSession, folder: str) -> list[int]:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[7:]) for n in names if n.startswith("bucket="))


def observed_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def commit(spark: SparkSession, root: str, snapshot: DataFrame, n_buckets: int | None = None,
           source: str | None = None, batch: int | None = None) -> int:
    """Write ``snapshot`` as the whole next version; returns the version number.

    The number of buckets stays unless ``n_buckets`` asks for another or the table has outgrown it.
    ``source`` and ``batch`` go into the ledger.
    """
    base = record(spark, root)
    rows = base.rows if base else 0
    n = n_buckets or max(base.n_buckets if base else N_BUCKETS, -(-rows // ROWS_PER_BUCKET))
    v = next_version(spark, root)
    counted, obs = observed_rows(snapshot, f"commit-{v}")
    _write(counted, _folder(root, v), n, min(n, 20_000), rows // n)
    written = _written(spark, _folder(root, v))
    return _finish(spark, root, base, Commit(v, n, {b: v for b in written}, rows=obs.get["rows"] if written else 0,
                                             written=written), source, batch)


def commit_buckets(spark: SparkSession, root: str, base: Commit, changed: DataFrame, buckets: list[int],
                   held: Observation | int | None = None, source: str | None = None, batch: int | None = None,
                   kept: dict[str, int] | None = None) -> int:
    """Write the rows of ``buckets`` (all rows that they shall hold, but for the partitions ``kept`` in the versions that
    hold them) as the next version; the others stay where they are.

    ``held`` is how many rows these buckets held before (or the observation of reading them); without it the row
    count stays as it was.
    """
    v = next_version(spark, root)
    total, written = base.rows, []
    if buckets:
        counted, obs = observed_rows(changed, f"commit-{v}")
        _write(counted, _folder(root, v), base.n_buckets, min(len(buckets), 20_000), base.rows // base.n_buckets)
        written = _written(spark, _folder(root, v))
        if held is not None:
            before = held.get["rows"] if isinstance(held, Observation) else held
            total += (obs.get["rows"] if written else 0) - before
    where = {b: w for b, w in base.buckets.items() if b not in set(buckets)} | {b: v for b in written}
    stay = {p: w for p, w in base.kept.items() if _bucket(p) not in set(buckets)} | (kept or {})
    return _finish(spark, root, base, Commit(v, base.n_buckets, where, rows=total, written=written, kept=stay), source, batch)


def vacuum(spark: SparkSession, root: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Remove what the last ``keep`` committed versions do not read; returns the folders removed."""
    done = committed_versions(spark, root)
    kept = [record(spark, root, v) for v in done[-keep:]]
    if not kept:
        return []
    live = {(v, b) for c in kept for b, v in c.buckets.items()} | {(v, _bucket(p)) for c in kept for p, v in c.kept.items()}
    versions, gone = {c.version for c in kept}, []
    for v in _versions(spark, root):
        if v in versions or v > kept[-1].version:          # a later folder may be a write under way
            continue
        folder, mine = _folder(root, v), _written(spark, _folder(root, v))
        dead = [b for b in mine if (v, b) not in live]
        gone += [folder] if len(dead) == len(mine) else [f"{folder}/bucket={b}" for b in dead]
        if len(dead) < len(mine) and v in done:
            gone.append(f"{folder}/{RECORD}")              # no longer a version of its own, only a home of buckets
    for path in gone:
        remove(spark, path)
    return gone
