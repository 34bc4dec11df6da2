"""Session helpers: configuration and the shared checkpoint folder."""
from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on.  Applied only where the session leaves them
# unset, so a cluster's own choices win.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method of more bytecode: such a stage is generated in smaller pieces instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "vigil", extra_conf: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (never used on a cluster)."""
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.driver.memory", os.environ.get("VIGIL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**ENGINE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply ENGINE_CONF keys the session has not set (UTC zone first)."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    # The zone matters for every text timestamp we render; force UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When
    neither is set, a fresh temporary folder is made on a ``local`` master only;
    on a cluster every executor would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="vigil-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (visible to all executors)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


#: Tables made inside the innermost ``scratch_scope`` of this thread of work (None: outside of any).
_SCOPE: ContextVar[list[str] | None] = ContextVar("vigil_scratch", default=None)


def scratch_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: lineage is cut, and a later pass reads only its columns.
    ``compression``: of the files, if not the session's (zstd for long texts).

    Inside a ``scratch_scope`` the table goes when the scope ends; outside, the caller's session keeps it.
    """
    path = shared_path(df.sparkSession, f"vigil-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that ``scratch_table`` makes inside are removed at the end; scopes of other threads are not touched."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
