"""WARC archives with a two-level capture index.

Writing: one gzip member per record in ``*.warc.gz`` files of the shared
folder.  Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the
one with the largest page id is the response, the others are revisits without
payload that refer to it.  A task returns one index row per record it wrote;
files left by a lost attempt are named by no row and are never read.

Index: the rows are sorted by reversed-host URL key over range partitions (key
and page id, so one hot URL spreads); each partition becomes a file of
compressed blocks of ``BLOCK_LINES`` lines and a sparse directory with the
first key of every block.  The top level holds one row per index file.

Reading: a lookup bisects the top level, then the file's directory, reads and
unpacks one block by its byte range, bisects its lines, and range-reads the
record.  A revisit is resolved by a lookup of the record that it refers to.

Null html is an empty payload, null urls share the key ``)``, a null page id is
kept as null.  Rows that repeat a page id are separate records (all that carry
the largest id of their payload are responses).  An empty table gives no files
and an empty result.  Extra columns are ignored.
"""
from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import scratch, staged

REVISIT_BYTES = 1000
BLOCK_LINES = 256
FILE_BYTES = 1 << 30
INDEX_ROWS = 200_000       # index lines per index file, about
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: characters of a url that stay as they are in a header; "%" is one, so that quoting twice is quoting once
_PLAIN = ":/?#[]@!$&'()*+,;=%-._~"
_URL = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)")


@lru_cache(maxsize=64)
def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it of a folder of the shared store."""
    local = re.match(r"file:/+(.*)", path)
    return pafs.FileSystem.from_uri("/" + local.group(1) if local else path)


def surt(url: str | None) -> str:
    """Reversed-host key: ``http://a.b.com:80/x?y#z`` -> ``com,b,a)/x?y``.

    The key is made from the url as headers write it, so a url and its header give the same key.
    """
    url = quote(url or "", safe=_PLAIN)
    m = _URL.match(url)
    if m:
        port = f":{m.group(2)}" if m.group(2) not in (None, "", "80", "443") else ""
        key = ",".join(reversed(m.group(1).lower().split("."))) + port + ")" + (m.group(3) or "/")
    else:
        key = ")" + url
    return key


def _b32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    n = uri.strip("<>").rpartition(":")[2]
    return int(n) if n else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None,
           original_url: str | None, is_revisit: bool) -> bytes:
    """One WARC record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if is_revisit else http + payload
    target = quote(url or "", safe=_PLAIN)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{_b32(digest)}"]
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(original)}",
                  f"WARC-Refers-To-Target-URI: {quote(original_url or '', safe=_PLAIN)}",
                  f"WARC-Refers-To-Date: {DATE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(WARC headers by lower-case name, payload without HTTP headers) of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('warc-record-id')} does not end after {n} bytes")
    return headers, rest[:n].partition(b"\r\n\r\n")[2]


def _member(raw: bytes) -> bytes:
    z = zlib.compressobj(5, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


# ------------------------------------------------------------------ writing
def _write(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        out, name, at = None, "", 0
        try:
            for b in batches:
                rows = []
                for r in b.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                        info = b"software: vigil\r\nformat: WARC File Format 1.1\r\n"
                        head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                                f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n")
                        at += out.write(_member(head.encode() + info + b"\r\n\r\n"))
                    data = _member(record(r["page_id"], r["url"], r["payload"], r["digest"], r["original"],
                                          r["original_url"], r["is_revisit"]))
                    out.write(data)
                    rows.append((surt(r["url"]), r["page_id"], name, at, len(data)))
                    at += len(data)
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    names=["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write the records below ``root``; (key, page_id, file, offset, length) of each record written."""
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    groups = (base.where(F.col("n") >= revisit_bytes).groupBy("digest", "n")
              .agg(F.max("page_id").alias("original"), F.max_by("url", "page_id").alias("original_url"),
                   F.count(F.lit(1)).alias("members"))
              .where("members > 1").drop("members"))
    groups = staged(groups, "warc-groups")
    rows = base.join(groups, ["digest", "n"], "left").select(
        "page_id", "url", "payload", "digest", "original", "original_url",
        F.coalesce(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.lit(False)).alias("is_revisit"))
    return staged(rows.mapInArrow(_write(root), "key string, page_id long, file string, offset long, length long"), "warc-records")


# ------------------------------------------------------------------ index
def _sort_key(key: str, page_id: int | None) -> tuple[bytes, int]:
    return key.encode("utf-8", "surrogatepass"), -(1 << 63) if page_id is None else page_id


def _write_index(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        name, at, out, firsts, lines, first = f"{uuid.uuid4().hex}.idx", 0, None, [], [], None

        def flush():
            nonlocal at, lines
            data = zlib.compress("\n".join(lines).encode(), 6)
            out.write(data)
            head = lines[0].split("\t")
            firsts.append("\t".join([head[0], head[1], str(at), str(len(data))]))
            at += len(data)
            lines = []

        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    first = r
                lines.append("\t".join([r["key"], "" if r["page_id"] is None else str(r["page_id"]), r["file"],
                                        str(r["offset"]), str(r["length"])]))
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            out.close()
            with fs.open_output_stream(f"{base}/{name}.dir", compression=None) as d:
                d.write(zlib.compress("\n".join(firsts).encode(), 6))
            yield pa.RecordBatch.from_arrays(
                [pa.array([first["key"]], pa.string()), pa.array([first["page_id"]], pa.int64()), pa.array([name], pa.string()),
                 pa.array([len(firsts)], pa.int64())], names=["key", "page_id", "file", "blocks"])
    return run


def build_index(records: DataFrame, root: str, index_rows: int = INDEX_ROWS) -> DataFrame:
    """Sort the records by key into block files; one row (first key, file, blocks) per index file."""
    parts = max(1, -(-records.count() // index_rows))
    ordered = records.repartitionByRange(parts, F.col("key"), F.col("page_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("key"), F.col("page_id").asc_nulls_first())
    return staged(ordered.mapInArrow(_write_index(root), "key string, page_id long, file string, blocks long"), "warc-top")


class Reader:
    """Lookups of one task: directories, blocks and open files are kept for neighbouring requests."""

    def __init__(self, warc_root: str, index_root: str, top: list[tuple[str, int | None, str]]):
        self.fs, self.warc = filesystem(warc_root)
        self.index = filesystem(index_root)[1]
        self.top = sorted((_sort_key(k, p), f) for k, p, f in top)
        self.top_keys = [t[0] for t in self.top]
        self.kept: OrderedDict = OrderedDict()
        self.payloads: OrderedDict = OrderedDict()

    def _keep(self, what, make, most: int = 24):
        if what in self.kept:
            self.kept.move_to_end(what)
            return self.kept[what]
        value = self.kept[what] = make()
        if len(self.kept) > most:
            self.kept.popitem(last=False)
        return value

    def _read(self, path: str, offset: int, length: int) -> bytes:
        handle = self._keep(("open", path), lambda: self.fs.open_input_file(path))
        handle.seek(offset)
        return handle.read(length)

    def _directory(self, name: str):
        def load():
            with self.fs.open_input_stream(f"{self.index}/{name}.dir", compression=None) as f:
                rows = [x.split("\t") for x in zlib.decompress(f.read()).decode().split("\n")]
            return [_sort_key(k, int(p) if p else None) for k, p, _, _ in rows], [(int(o), int(n)) for _, _, o, n in rows]
        return self._keep(("dir", name), load)

    def _block(self, name: str, offset: int, length: int):
        def load():
            rows = [x.split("\t") for x in zlib.decompress(self._read(f"{self.index}/{name}", offset, length)).decode().split("\n")]
            return [_sort_key(k, int(p) if p else None) for k, p, *_ in rows], rows
        return self._keep(("block", name, offset), load)

    def locate(self, key: str, page_id: int | None) -> list[tuple[str, int, int]]:
        """(file, offset, length) of the records of a capture: bisect files, blocks and lines."""
        want, found = _sort_key(key, page_id), []
        f = max(0, bisect.bisect_left(self.top_keys, want) - 1)
        while f < len(self.top) and self.top_keys[f] <= want:
            firsts, blocks = self._directory(self.top[f][1])
            b = max(0, bisect.bisect_left(firsts, want) - 1)
            while b < len(firsts) and firsts[b] <= want:
                keys, rows = self._block(self.top[f][1], *blocks[b])
                i = bisect.bisect_left(keys, want)
                while i < len(keys) and keys[i] == want:
                    found.append((rows[i][2], int(rows[i][3]), int(rows[i][4])))
                    i += 1
                b += 1
            f += 1
        return found

    def fetch(self, place: tuple[str, int, int]) -> tuple[dict[str, str], bytes]:
        return parse(zlib.decompress(self._read(f"{self.warc}/{place[0]}", place[1], place[2]), 31))

    def payload(self, headers: dict[str, str], payload: bytes) -> tuple[int, str]:
        """(bytes, SHA-1) of the full payload, checked against the record's digest."""
        if headers["warc-type"] == "revisit":
            what = (headers["warc-refers-to-target-uri"], headers["warc-refers-to"], headers["warc-payload-digest"])
            if what not in self.payloads:
                # spellings of one url share a key: of the records found, the one with this payload
                own = [r for r in map(self.fetch, self.locate(surt(what[0]), _page(what[1])))
                       if r[0]["warc-type"] == "response" and r[0]["warc-payload-digest"] == what[2]]
                if not own:
                    raise ValueError(f"{headers['warc-record-id']} refers to {what}, which the index does not hold")
                self.payloads[what] = self.payload(*own[0])
                if len(self.payloads) > 1000:
                    self.payloads.popitem(last=False)
            n, digest = self.payloads[what]
        else:
            n, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if headers["warc-payload-digest"] != f"sha1:{_b32(digest)}":
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
        return n, digest


def _lookup(warc_root: str, index_root: str, top):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for b in batches:
            reader = reader or Reader(warc_root, index_root, top.value)
            rows = []
            for key, page_id in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for place in reader.locate(key, page_id):
                    headers, payload = reader.fetch(place)
                    n, digest = reader.payload(headers, payload)
                    rows.append((_page(headers["warc-record-id"]), n, digest, headers["warc-type"],
                                 _page(headers["warc-refers-to"]) if "warc-refers-to" in headers else None))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return run


def lookup(requests: DataFrame, warc_root: str, index_root: str, top: DataFrame, id_col: str = "page_id",
           url_col: str = "url", rows_per_task: int = 20_000) -> DataFrame:
    """The records of the captures asked for, read from the archives through the index.

    The top level (one row per index file) is broadcast; an index file holds
    about ``INDEX_ROWS`` lines, so it has one row for that many records.
    """
    spark = requests.sparkSession
    key = F.pandas_udf(lambda u: u.map(surt), "string")
    asked = requests.select(F.col(url_col).cast("string").alias("url"), F.col(id_col).cast("long").alias("page_id")) \
        .withColumn("key", key(F.coalesce("url", F.lit("")))).select("key", "page_id").distinct()
    asked = staged(asked, "warc-asked")
    parts = max(1, -(-asked.count() // rows_per_task))
    asked = asked.repartitionByRange(max(parts, spark.sparkContext.defaultParallelism), "key", "page_id") \
        .sortWithinPartitions("key", "page_id")
    files = spark.sparkContext.broadcast([(r["key"], r["page_id"], r["file"]) for r in top.collect()])
    return asked.mapInArrow(_lookup(warc_root, index_root, files),
                            "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_and_read(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write all pages as WARC records, index them, and read every record back through the index."""
    root = root or scratch(pages.sparkSession, "warc")
    records = write_archives(pages, f"{root}/warc")
    top = build_index(records, f"{root}/index")
    return lookup(pages, f"{root}/warc", f"{root}/index", top)
