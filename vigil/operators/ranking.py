"""Global ordinal position without a single-partition window.

``row_number() OVER (ORDER BY …)`` with no partition key moves every row
into one task.  Instead: range-partition on the sort keys (explicit
partition count, so AQE keeps the layout), sort within partitions, count the
rows of each partition (one tiny row per partition), turn the counts into
offsets and add each row's index inside its partition.

Range bounds are sampled when the exchange runs, so two evaluations of the
same plan may partition differently.  The tagged rows are therefore written
once as a table under the cluster's checkpoint folder: counts and rows are both
read from it (columns that are not asked for are never read back), and a lost
executor re-reads it instead of recomputing a different layout.  Inside a
``scratch_scope`` the table goes with the scope.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import scratch_table


def with_position(df: DataFrame, order: list[Column], name: str = "position",
                  num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based position following ``order`` (which must be a total order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = scratch_table(ranged.withColumns({"_pid": F.spark_partition_id(),
                                               "_mid": F.monotonically_increasing_id()}), "ranked")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a keyless window over it is tiny by construction.
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + local + 1)
            .drop("_pid", "_mid", "_off"))


# ------------------------------------------------------ published rankings --
DIRECTORY = "_ranges.json"     # the underscore hides it from table scans


def publish(df: DataFrame, order: list[Column], path: str, num_partitions: int) -> int:
    """Write ``df`` in ``order`` as a table of ranges, and a directory with the rows before each range; the row count.

    ``_range`` folders hold consecutive pieces of the order, ``_at`` is a row's place in its piece.  The directory (a
    number per range) is written last: a ranking without one is not there.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged.select("*", F.spark_partition_id().alias("_range"), at.alias("_at")) \
        .write.mode("overwrite").partitionBy("_range").parquet(path)
    written = spark.read.schema("_at bigint, _range int").parquet(path)
    counts = written.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    before, ranges = 0, []
    for r in sorted(counts, key=lambda r: r["_range"]):
        ranges.append([r["_range"], before, r["n"]])
        before += r["n"]
    fs, p = _file(spark, f"{path.rstrip('/')}/{DIRECTORY}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps({"columns": df.schema.jsonValue(), "ranges": ranges}).encode()))
    finally:
        out.close()
    return before


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _directory(spark: SparkSession, path: str) -> dict:
    fs, p = _file(spark, f"{path.rstrip('/')}/{DIRECTORY}")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def ranges_of(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """(range, rows before it, rows) of a published ranking."""
    return [tuple(r) for r in _directory(spark, path)["ranges"]]


def published_rows(spark: SparkSession, path: str, start: int, end: int, name: str = "position") -> DataFrame:
    """Rows start .. end - 1 (from 0) of a published ranking with their 1-based position: only the ranges that hold them
    are opened, and of these the row groups that the place in the range lets pass."""
    doc = _directory(spark, path)
    columns = T.StructType.fromJson(doc["columns"])
    out = spark.createDataFrame([], T.StructType([*columns.fields, T.StructField(name, T.LongType())]))
    first = True
    for number, before, n in doc["ranges"]:
        if before < end and start < before + n:
            part = spark.read.schema(T.StructType([*columns.fields, T.StructField("_at", T.LongType())])) \
                .parquet(f"{path.rstrip('/')}/_range={number}")
            part = part.filter((F.col("_at") >= F.lit(start - before)) & (F.col("_at") < F.lit(end - before)))
            part = part.withColumn(name, F.col("_at") + F.lit(before + 1).cast("bigint")).drop("_at")
            out, first = part if first else out.unionByName(part), False
    return out
