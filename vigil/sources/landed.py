"""Landed feed pages → raw records (S1, S2).

The collectors of the original design fetch pages over HTTP.  Here the pages
are *landed* files (one JSON envelope per file) and readers are DataFrame
jobs: ``{"vulnerabilities": [...]}`` for vulnerability pages,
``{"data": [...]}`` for address reports.  Output is ``(seq, raw)`` — the
shape ``normalize`` consumes, with ``raw`` handed on as VARIANT — and ``seq``
unique whatever the page sizes: feed, page order and position have 1, 30 and
32 bits of it.

Nothing landed is lost silently: there is no default bound, and a page that is
no JSON does not count as the end of the feed: with ``keep_corrupt`` it becomes a
record without content, which ends in the quarantine; it raises with
``strict=True``; and ``corrupt_pages`` lists such pages.

Every body is read once.  The order of the files comes from a listing of their
names, ranked in parallel; what a later step needs of all pages (where the feed
ends) is read from the parsed pages' own table, without their content.
"""
from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.functions import variant as V
from vigil.operators.ranking import with_position
from vigil.session import scratch_table

#: The one number of a page file's base name: page-3.json, 0003.txt, nvd_12.json.
PAGE_NAME = r"^\D*(\d+)\D*$"
POSITION_BITS = 32
FEED_BIT = 62
BROADCAST_FILES = 1_000_000  # hashed file names with their order, about 70 MB, that are broadcast at most
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextlib.contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by four tasks a core inside, for a folder holds one page: Spark's own number, 10,000, would
    start a task for every folder or few, which costs the driver more than the listing costs the tasks."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def position(feed: int, order: Column, pos: Column) -> Column:
    """Unique input position of a record: feed, page order, position in the page."""
    return (F.lit(feed << FEED_BIT) + order.cast("bigint") * F.lit(1 << POSITION_BITS) + pos).cast("bigint")


def list_pages(spark: SparkSession, path: str, pattern: str = PAGE_NAME) -> DataFrame:
    """(page, file, order) of the landed files, from their names alone: no body is opened.

    ``order`` numbers the files by (page, folder, file) from 0, so equal page numbers in two folders stay apart.  The
    names are ranked by range partitions and one offset per partition.
    """
    with _listing(spark):
        df = spark.read.format("binaryFile").load(path)
    file = F.col("_metadata.file_path")
    if "page" in df.columns:
        number = F.col("page").cast("int")
    else:
        found = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)
        number = F.when(found == "", F.raise_error(F.concat(F.lit("no page number in the file name: "), file))) \
            .otherwise(found).cast("int")
    names = df.select(number.alias("page"), file.alias("file"))
    ranked = with_position(names, [F.col("page").asc_nulls_first(), F.col("file").asc()], "order")
    return scratch_table(ranked.select("page", "file", (F.col("order") - 1).alias("order")), "page-order")


def read_pages(spark: SparkSession, path: str, pattern: str = PAGE_NAME) -> DataFrame:
    """Landed page files → (page, order, body); each file is read whole (one page), once.

    The page number comes from a ``page=<n>`` folder (as ``write_pages`` lands
    them) or else from the file's base name, which must match ``pattern``; a
    file without one raises.  Bodies are not shuffled while the names, as hashes that are known to differ, fit a broadcast
    of known size.
    """
    names = list_pages(spark, path, pattern)
    with _listing(spark):
        texts = spark.read.text(path, wholetext=True)
    bodies = texts.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))
    found = names.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.xxhash64("file")).alias("hashes")).first()
    if found["n"] > BROADCAST_FILES or found["hashes"] < found["n"]:
        return bodies.join(names, "file").select("page", "order", "body")
    short = names.select(F.xxhash64("file").alias("_file"), "page", "order")
    return bodies.select(F.xxhash64("file").alias("_file"), "body").join(F.broadcast(short), "_file").select("page", "order", "body")


def _ordered(pages: DataFrame) -> DataFrame:
    """Pages without an ``order`` column are ordered by their page number."""
    return pages if "order" in pages.columns else pages.withColumn("order", F.col("page"))


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """(page, order, reject_reason) of the pages that are no JSON."""
    return (_ordered(pages).filter(V.parse(F.col("body")).isNull())
            .select("page", "order", F.lit("corrupt_page").alias("reject_reason")))


def _refuse_corrupt(pages: DataFrame, strict: bool) -> None:
    if strict:
        bad = corrupt_pages(pages).orderBy("order").limit(1).collect()
        if bad:
            raise ValueError(f"page {bad[0]['page']} is no JSON")


def _items(pages: DataFrame, key: str, keep_corrupt: bool) -> DataFrame:
    """(page, order, _corrupt, items); a corrupt page has no items, or with ``keep_corrupt`` one without content."""
    doc = V.parse(F.col("body"))
    items = V.as_array(V.field(doc, f"$.{key}"))
    if keep_corrupt:
        items = F.when(doc.isNull(), F.array(F.lit(None).cast("variant"))).otherwise(items)
    return pages.select("page", "order", doc.isNull().alias("_corrupt"), items.alias("items"))


def cve_pages_to_records(pages: DataFrame, max_pages: int | None = None, strict: bool = False,
                         keep_corrupt: bool = False) -> DataFrame:
    """S1: explode ``vulnerabilities``; a page without the key is empty; reading
    stops at the first empty page.  ``max_pages`` bounds the page numbers only
    when given, before anything is parsed."""
    pages = _ordered(pages)
    if max_pages is not None:
        pages = pages.filter(F.col("page") < F.lit(max_pages))
    _refuse_corrupt(pages, strict)
    # parsed once: the end of the feed is found in the order column, the records in the items
    env = scratch_table(_items(pages, "vulnerabilities", keep_corrupt)
                        .withColumn("_empty", ~F.col("_corrupt") & (F.coalesce(F.size("items"), F.lit(0)) <= 0)), "pages", "zstd")
    stop = env.agg(F.min(F.when(F.col("_empty"), F.col("order"))).alias("stop")).first()["stop"]
    kept = env if stop is None else env.filter(F.col("order") < F.lit(stop))
    rec = kept.select("page", "order", F.posexplode("items").alias("pos", "raw"))
    return rec.select(position(0, F.col("order"), F.col("pos")).alias("seq"), "raw", "page", "pos")


def ip_pages_to_records(pages: DataFrame, confidence_minimum: int | None = None,
                        limit: int | None = None, strict: bool = False, keep_corrupt: bool = False) -> DataFrame:
    """S2: explode ``data``, keep confidence ≥ floor (default 50; 0 keeps all).

    ``limit`` caps the reports only when given (the remote service returns at
    most 500): highest confidence first, then address, then input position, so
    the cut is deterministic; ``orderBy`` + ``limit`` plans as a top-k.  Corrupt pages don't count for it.
    """
    floor = C.IP_CONFIDENCE_MINIMUM if confidence_minimum is None else confidence_minimum
    pages = _ordered(pages)
    _refuse_corrupt(pages, strict)
    env = _items(pages, "data", keep_corrupt).select("order", "_corrupt", F.posexplode("items").alias("pos", "raw"))
    conf = V.as_double(V.field(F.col("raw"), "$.abuseConfidenceScore"))
    ip = V.as_string(V.field(F.col("raw"), "$.ipAddress"))
    top = (env.select("_corrupt", position(1, F.col("order"), F.col("pos")).alias("seq"), "raw",
                      conf.alias("confidence"), ip.alias("ip"))
           .filter(F.col("_corrupt") | (F.col("confidence") >= floor)))
    if limit is None:
        return top.drop("_corrupt")
    order = [F.col("confidence").desc(), F.col("ip").asc_nulls_last(), F.col("seq")]
    if not keep_corrupt:
        return top.drop("_corrupt").orderBy(*order).limit(limit)
    top = scratch_table(top, "reports")
    best = top.filter(~F.col("_corrupt")).orderBy(*order).limit(limit)
    return best.unionByName(top.filter("_corrupt")).drop("_corrupt")


def envelope(records: DataFrame, key: str, page_of) -> DataFrame:
    """(seq, raw) records → landed page envelopes (page, body) in ``seq`` order
    (a group holds one page)."""
    r = records.withColumn("page", page_of(F.col("seq")).cast("int"))
    g = r.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("seq", "raw"))).alias("_r"))
    return g.select("page", F.concat(F.lit('{"' + key + '":['),
                                     F.array_join(F.col("_r.raw"), ","), F.lit("]}")).alias("body"))


def write_pages(pages: DataFrame, path: str) -> None:
    """Land pages as one text file per page under ``page=<n>/`` (one distributed write).  The files are gzipped: JSON text
    takes many times the space, and readers unpack by the file's name."""
    pages.repartition("page").write.mode("overwrite").partitionBy("page").text(path, compression="gzip")
