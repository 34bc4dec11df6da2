"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.session import shared_path
from vigil.sources.store import remove

#: Paths of the tables written by ``staged``, in order; every thread of the driver has its own list.
_MADE: ContextVar[list[str] | None] = ContextVar("vigil_llm_staged", default=None)


def _made() -> list[str]:
    if _MADE.get() is None:
        _MADE.set([])
    return _MADE.get()


#: What this Python worker keeps from one task to the next: the tables of one operator, under their key.
_HELD: dict = {}


def held(key, make: Callable):
    """``make()``, kept in the Python worker until another key is asked for.

    Spark reuses a worker for the tasks of all operators, so what each of them
    kept in a place of its own would add up: frozen tables, encoders, indexes.
    """
    if key not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[key] = make()
    return _HELD[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder."""
    return shared_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")


#: Rows that a file of a scratch table holds at least, where their number is known.
ROWS_PER_FILE = 16_384


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files, nothing is recomputed) and
    gives the next join fresh exchanges, which AQE can split when a key is hot.

    ``rows``: how many rows there are at most, for narrow tables.  They are written by no more tasks than
    that fills, however many shuffle partitions the session holds; every file costs its executor forked processes.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    path = scratch(df.sparkSession, name)
    _made().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def made() -> int:
    """How many tables ``staged`` has written; a mark for ``release`` and ``sweep``."""
    return len(_made())


def release(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete the tables staged after the mark ``since``, but for the last ``keep``.

    For a caller that has written an operator's result: the scratch tables that
    the operator left (its result read them) are no longer needed.
    """
    own = _made()
    gone = own[since:len(own) - keep]
    for path in gone:
        remove(spark, path)
    del own[since:len(own) - keep]


def sweep(result: DataFrame, since: int) -> DataFrame:
    """Delete the tables staged after the mark ``since`` that ``result`` does not read; the result itself."""
    own = _made()
    read = {f.split("/llm-", 1)[1].split("/", 1)[0] for f in result.inputFiles() if "/llm-" in f}
    gone = [p for p in own[since:] if p.rsplit("/llm-", 1)[1] not in read]
    for path in gone:
        remove(result.sparkSession, path)
    own[since:] = [p for p in own[since:] if p not in gone]
    return result


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark`` (once per context)."""
    import os
    import tempfile
    import zipfile

    import vigil

    sc = spark.sparkContext
    if getattr(sc, "_vigil_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(vigil.__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="vigil-ship-"), "vigil_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "vigil")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._vigil_shipped = True
