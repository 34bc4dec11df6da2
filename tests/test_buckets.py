"""The bucketed table: touched-bucket writes, the ledger, paging in mass ties, rounding."""
import math
import os
import random
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import cve, raw_frame
from tests.test_store_serve import _row
from vigil.functions import rounding as R
from vigil.operators import normalize as N
from vigil.operators import serve as V
from vigil.operators import upsert as U
from vigil.plans import job
from vigil.schemas import STORED
from vigil.sources import store as ST
from vigil.streaming import ingest as STREAM


def _rows(spark, ids, batch=1, **kw):
    return spark.createDataFrame([_row(i, t, "2025-01-01", batch=batch, seq=k, **kw) for k, (i, t) in enumerate(ids)], STORED)


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_an_update_writes_the_buckets_of_its_ids_only(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    v1 = ST.commit(spark, root, _rows(spark, [(i, f"id{i}") for i in range(600)]), n_buckets=64)
    before = _files(root)
    delta = _rows(spark, [(900 + i, f"id{i * 100}") for i in range(6)] + [(7, "new")], batch=2)
    v2 = U.upsert_into(spark, root, delta)
    rec, old = ST.record(spark, root), ST.record(spark, root, v1)
    hit = set(U.touched(delta, 64))
    assert 1 < len(hit) <= 7 and set(rec.written) == hit
    assert {b for b, v in rec.buckets.items() if v == v2} == hit
    assert all(rec.buckets[b] == v1 for b in old.buckets if b not in hit)
    assert {p for p in _files(root) - before if "/v=000002/" not in p} == set() and before <= _files(root)
    got = {r.id: r for r in ST.scan(spark, root).collect()}
    assert len(got) == 601 == rec.rows and got["id300"].title == "t903" and got["id300"].batch_id == 1 and got["id301"].title == "t301"
    assert ST.scan(spark, root, v1).count() == 600                     # the version before is still whole


def _typed(spark, rows, batch):
    """Rows (position, id, type) of a batch."""
    kind = F.element_at(F.create_map(*[F.lit(x) for i, t, k in rows for x in (t, k)]), F.col("id"))
    return _rows(spark, [(i, t) for i, t, _ in rows], batch).withColumn("threat_type", kind)


def test_an_update_leaves_types_that_it_does_not_touch(spark, tmpdir_path):
    """reports of addresses rewrote all vulnerabilities of their buckets."""
    root = tmpdir_path + "/store"
    first = _typed(spark, [(i, f"c{i}", "cve") for i in range(40)] + [(100 + i, f"a{i}", "a b/%ip") for i in range(40)], 1)
    second = _typed(spark, [(200 + i, f"a{i}", "a b/%ip") for i in range(20, 60)], 2)
    third = _typed(spark, [(300, "c3", "a b/%ip"), (301, "new", "other")], 3)          # an id that is stored under another type
    snapshot = ST.empty_snapshot(spark)
    for batch, wrote in ((first, {"cve", "a b/%ip"}), (second, {"a b/%ip"}), (third, {"cve", "a b/%ip", "other"})):
        v = U.upsert_into(spark, root, batch, n_buckets=2)
        snapshot = U.upsert(snapshot, batch)
        assert sorted(map(str, ST.scan(spark, root).collect())) == sorted(map(str, snapshot.select(*ST.scan(spark, root).columns).collect()))
        got = spark.read.schema(STORED).option("basePath", root).parquet(f"{root}/v={v:06d}")
        assert {r.threat_type for r in got.select("threat_type").distinct().collect()} <= wrote
        assert ST.record(spark, root).rows == snapshot.count() == ST.footer_stats(spark, root).first()["n_threats"]
        if batch is second:
            rec = ST.record(spark, root)
            assert set(rec.kept.values()) == {1} and {p.split("=")[-1] for p in rec.kept} == {"cve"} and len(rec.kept) == 2
            assert ST.lookup(spark, root, "c7").count() == ST.lookup(spark, root, "a50").count() == 1
    ST.vacuum(spark, root, keep=1)
    assert ST.scan(spark, root).count() == 40 + 60 + 1
    U.upsert_into(spark, root, second)                                  # kept once more, from the versions that are left
    U.write_back_into(spark, root, ST.scan(spark, root).select("id", F.lit("Low").alias("heuristic_label")), ["heuristic_label"])
    rec = ST.record(spark, root)
    assert not rec.kept and ST.scan(spark, root).filter("heuristic_label = 'Low'").count() == rec.rows == 101


def test_write_back_touches_matching_buckets(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    ST.commit(spark, root, _rows(spark, [(i, f"id{i}") for i in range(300)] + [(1, None), (2, None)]), n_buckets=32)
    up = spark.createDataFrame([("id5", "High", 1), ("id5", "Low", 2), ("nobody", "Low", 1), (None, "Low", 1)],
                               "id string, heuristic_label string, at int")
    U.write_back_into(spark, root, up, ["heuristic_label"], "at")
    rec = ST.record(spark, root)
    assert len(rec.written) <= 2 and rec.rows == 302
    assert {(r.id, r.heuristic_label) for r in ST.scan(spark, root).filter("heuristic_label is not null").collect()} == {("id5", "Low")}
    with pytest.raises(RuntimeError):
        U.write_back_into(spark, tmpdir_path + "/none", up, ["heuristic_label"])


def test_equal_to_the_frame_plans(spark, tmpdir_path):
    root, rnd = tmpdir_path + "/store", random.Random(2)
    frame = ST.empty_snapshot(spark)
    for b in range(4):
        batch = _rows(spark, [(100 * b + k, rnd.choice([None, *(f"id{j}" for j in range(40))])) for k in range(25)], batch=b + 1)
        frame = spark.createDataFrame(U.upsert(frame, batch).collect(), STORED)
        U.upsert_into(spark, root, batch, n_buckets=8)
        assert sorted(map(str, ST.scan(spark, root).collect())) == sorted(map(str, frame.collect()))
        assert ST.record(spark, root).rows == frame.count()


def test_half_a_write_is_never_read(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    ST.commit(spark, root, _rows(spark, [(1, "A"), (2, "B")]))
    # a write that died before its record: all its files are there
    ST._write(_rows(spark, [(9, "A"), (9, "C")]), ST._folder(root, 2), 16, 4, 2)
    assert ST.current_version(spark, root) == 1 and sorted(r.id for r in ST.scan(spark, root).collect()) == ["A", "B"]
    assert U.upsert_into(spark, root, _rows(spark, [(3, "C")], batch=3)) == 3
    assert sorted((r.id, r.title) for r in ST.scan(spark, root).collect()) == [("A", "t1"), ("B", "t2"), ("C", "t3")]
    assert ST.vacuum(spark, root, keep=1) and ST.committed_versions(spark, root) == [3]
    assert sorted(r.id for r in ST.scan(spark, root).collect()) == ["A", "B", "C"]


def test_a_write_that_was_overtaken_is_refused(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    ST.commit(spark, root, _rows(spark, [(1, "A")]))
    base = ST.record(spark, root)
    ST.commit(spark, root, _rows(spark, [(1, "A"), (2, "B")]))
    with pytest.raises(ST.ConcurrentWrite):
        ST.commit_buckets(spark, root, base, _rows(spark, [(3, "C")]), [0])
    assert sorted(r.id for r in ST.scan(spark, root).collect()) == ["A", "B"]


def test_vacuum_keeps_what_the_last_versions_read(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    ST.commit(spark, root, _rows(spark, [(i, f"id{i}") for i in range(100)]), n_buckets=16)
    for k in range(5):
        U.upsert_into(spark, root, _rows(spark, [(1000 + k, f"id{k}")], batch=k + 2))
    want = sorted(map(str, ST.scan(spark, root).collect()))
    older = sorted(map(str, ST.scan(spark, root, 5).collect()))
    n = len(_files(root))
    ST.vacuum(spark, root, keep=2)
    assert len(_files(root)) < n and ST.committed_versions(spark, root) == [5, 6]
    assert sorted(map(str, ST.scan(spark, root).collect())) == want and sorted(map(str, ST.scan(spark, root, 5).collect())) == older
    assert ST.vacuum(spark, root, keep=2) == []


def test_empty_batches_and_tables(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    U.upsert_into(spark, root, ST.empty_snapshot(spark), source="s", batch_no=1)
    assert ST.scan(spark, root).count() == 0 and ST.record(spark, root).holds("s", 1)
    U.upsert_into(spark, root, _rows(spark, [(1, "A")]), source="s", batch_no=2)
    U.upsert_into(spark, root, ST.empty_snapshot(spark), source="s", batch_no=3)
    rec = ST.record(spark, root)
    assert rec.batches == {"s": 3} and rec.rows == 1 and ST.scan(spark, root).count() == 1


def test_buckets_grow_with_the_table(spark, tmpdir_path, monkeypatch):
    root = tmpdir_path + "/store"
    monkeypatch.setattr(ST, "ROWS_PER_BUCKET", 10)
    ST.commit(spark, root, _rows(spark, [(i, f"id{i}") for i in range(300)]), n_buckets=4)
    U.upsert_into(spark, root, _rows(spark, [(7, "id7")], batch=2))
    assert ST.record(spark, root).n_buckets == 4
    ST.commit(spark, root, ST.scan(spark, root))
    assert ST.record(spark, root).n_buckets == 30 and ST.scan(spark, root).count() == 300
    U.upsert_into(spark, root, _rows(spark, [(8, "id7")], batch=3))
    assert {r.title for r in ST.scan(spark, root).filter("id = 'id7'").collect()} == {"t8"}


# ------------------------------------------------------------------ ledger --
def _batch(spark, *ids, bad=0):
    return N.normalize_batch(raw_frame(spark, [*[cve(id=i) for i in ids], *["no json"] * bad]),
                             raw_frame(spark, [{"ipAddress": "1.1.1.1", "abuseConfidenceScore": 50}], start=100))


def test_job_then_stream_keep_all_rows(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    rep = job.RunReport(version=0)
    job.ingest_into(spark, root, raw_frame(spark, [cve(id="a"), "bad"]), raw_frame(spark, [{"ipAddress": "9.9.9.9", "abuseConfidenceScore": 50}], 50), rep)
    assert rep.counts == {"raw_and_rejects": 3, "rejected": 1, "deduplicated": 2, "stored": 2}
    assert STREAM.store_batch(spark, root, _batch(spark, "b", None, bad=1), 0, "stream-x")
    assert STREAM.store_batch(spark, root, _batch(spark, "c"), 1, "stream-x")
    # a stream with a new checkpoint starts at 0 again
    assert STREAM.store_batch(spark, root, _batch(spark, "d", bad=2), 0, "stream-y")
    assert sorted(str(r.id) for r in ST.scan(spark, root).collect()) == ["1.1.1.1", "9.9.9.9", "None", "a", "b", "c", "d"]
    kept = {(r.origin, r.batch_id): r["count"] for r in spark.read.parquet(job.rejects_path(root)).groupBy("origin", "batch_id").count().collect()}
    assert kept == {("job", 1): 1, ("stream-x", 0): 1, ("stream-y", 0): 2}
    # replays write nothing, also of a batch that had only updated
    before, version = sorted(map(str, ST.scan(spark, root).collect())), ST.current_version(spark, root)
    for source, n in (("stream-x", 0), ("stream-x", 1), ("stream-y", 0)):
        assert not STREAM.store_batch(spark, root, _batch(spark, "b", None), n, source)
    assert ST.current_version(spark, root) == version and sorted(map(str, ST.scan(spark, root).collect())) == before
    assert ST.record(spark, root).rows == 7


def test_a_repeated_run_with_a_number_is_stored_once(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    feeds = raw_frame(spark, [cve(id="a"), cve(id=None)]), raw_frame(spark, [{"ipAddress": "9.9.9.9", "abuseConfidenceScore": 50}], 50)
    for _ in range(2):
        rep = job.RunReport(version=0)
        v = job.ingest_into(spark, root, *feeds, rep, batch_no=4)
        assert v == 1 and rep.counts["stored"] == 3
    job.ingest_into(spark, root, *feeds, rep)                      # without one, rows without an id come again
    assert ST.record(spark, root).rows == 4


def test_a_stream_is_known_by_the_id_in_its_checkpoint(spark, tmpdir_path):
    import json
    for name, key, item in (("cve", "vulnerabilities", cve(id="A")), ("ip", "data", {"ipAddress": "1.1.1.1", "abuseConfidenceScore": 50})):
        os.makedirs(f"{tmpdir_path}/{name}")
        with open(f"{tmpdir_path}/{name}/p0.json", "w") as f:
            json.dump({key: [item]}, f)
    root = tmpdir_path + "/store"
    for ckpt in ("c1", "c1", "c2"):
        q = STREAM.start(spark, tmpdir_path + "/cve", tmpdir_path + "/ip", root, f"{tmpdir_path}/{ckpt}")
        q.awaitTermination(180)
    batches = ST.record(spark, root).batches
    ids = {json.loads(open(f"{tmpdir_path}/{c}/metadata").read().splitlines()[-1])["id"] for c in ("c1", "c2")}
    assert set(batches) == {f"stream-{i}" for i in ids} and ST.scan(spark, root).count() == 2


# ------------------------------------------------------------------ lookup --
def test_lookup_reads_one_bucket(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    ST.commit(spark, root, _rows(spark, [(i, f"id{i}") for i in range(500)]), n_buckets=16)
    hit = ST.lookup(spark, root, "id123")
    assert [r.title for r in hit.collect()] == ["t123"] and len(hit.inputFiles()) == 1
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,id123)" in plan
    assert ST.lookup(spark, root, "nobody").count() == 0 and ST.lookup(spark, tmpdir_path + "/x", "id1").count() == 0


def test_counts_and_ranges_come_from_the_footers(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    rows = [_row(i, f"id{i}", "x") for i in range(300)] + [_row(5, None, "x", report_count=None, seq=999)]
    ST.commit(spark, root, spark.createDataFrame(rows, STORED))
    U.upsert_into(spark, root, _rows(spark, [(1000, "id7"), (3, "new")], batch=2))
    stats = ST.footer_stats(spark, root, columns=("report_count",))
    assert stats.first().asDict() == {"n_threats": 302, "report_count_min": 0, "report_count_max": 1000, "report_count_n": 301}
    plan = stats._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedAggregation: [COUNT(*), MIN(report_count), MAX(report_count), COUNT(report_count)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert ST.footer_stats(spark, tmpdir_path + "/none").first()[0] == 0


# ------------------------------------------------------------------ paging --
def _scored(spark, rows):
    return spark.createDataFrame([_row(i, f"id{i:05d}", "x", batch=b, seq=s, predicted_priority=p, predicted_priority_score=c)
                                  for i, (p, c, b, s) in enumerate(rows)], STORED)


def _check_pages(df, desc, pages, size=20, sort_rows=30):
    order = V.rank_keys(df, desc)
    every = [r.id for r in df.orderBy(*order).collect()]
    for no in pages:
        got = V.page(df, no, size, desc, sort_rows=sort_rows).orderBy("position").collect()
        lo = (no - 1) * size
        assert [r.id for r in got] == every[lo:lo + size]
        assert [r.position for r in got] == list(range(lo + 1, lo + len(got) + 1))


@pytest.mark.parametrize("desc", [True, False])
def test_pages_of_one_single_score(spark, desc):
    rnd = random.Random(1)
    seqs = list(range(1200))
    rnd.shuffle(seqs)
    df = _scored(spark, [("High", 0.5, 1 + s % 3, (1 << 62) + s * 7) for s in seqs])
    _check_pages(df, desc, (1, 2, 17, 40, 60))


@pytest.mark.parametrize("desc", [True, False])
def test_pages_of_close_scores_nulls_and_ties(spark, desc):
    rnd = random.Random(4)
    scores = [0.5, 0.5 + 1e-16, 0.5 + 2e-16, 0.50001, 0.5000100001, None, 0.50000000001, -3.0, 1e300, 0.0]
    rows = [(rnd.choice(["High", "High", "Low", None]), rnd.choice(scores), rnd.choice([1, 2, None]), s) for s in range(1500)]
    _check_pages(_scored(spark, rows), desc, (1, 5, 20, 33, 50, 75))


def test_deep_page_sorts_a_bounded_number_of_rows(spark):
    df = _scored(spark, [("High", 0.5, 1, s) for s in range(3000)])
    top = V.page(df, 100, 20, sort_rows=50)
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    limits = [int(x.split()[1].rstrip(",")) for x in plan.splitlines() for x in [x.strip(" +-:")] if x.startswith("GlobalLimit")]
    assert limits and max(limits) <= 50 + 20


# ---------------------------------------------------------------- rounding --
def _halves():
    rnd = random.Random(3)
    out = [0.65875, 0.00005, 0.00015, 0.5, 2.5, 1.00005, 0.0, -0.65875, 1e-9, 123456.78905, 0.99995, 1e15 + 0.5, 3e20]
    out += [k / 20000 for k in range(0, 20001, 137)] + [rnd.random() for _ in range(300)]
    return out + [(2 * k + 1) / 2 / 10000 for k in range(0, 10000, 53)]


@pytest.mark.parametrize("digits", [2, 4])
def test_rounding_rules(spark, digits):
    xs = _halves()
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, a, b in df.select("x", R.scaled(F.col("x"), digits), R.exact(F.col("x"), digits)).collect():
        assert a == float(np.round(np.float64(x), digits))
        want = float(Decimal(x).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_EVEN)) if abs(x) < 1e12 else round(x, digits)
        assert b == want == round(x, digits), x
    null = spark.sql("select cast(null as double) x").select(R.scaled(F.col("x"), 2), R.exact(F.col("x"), 2)).first()
    assert list(null) == [None, None] and math.isfinite(xs[0])


def test_rounding_rules_in_sql(spark):
    import duckdb
    con, xs = duckdb.connect(), _halves()[:9] + _halves()[13:]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", R.scaled(F.col("x"), 4).alias("a"), R.exact(F.col("x"), 4).alias("b"))
    for x, a, b in df.collect():
        assert con.sql(f"SELECT round_even({x!r}::DOUBLE * 1e4, 0) / 1e4, CAST(printf('%.4f', {x!r}::DOUBLE) AS DOUBLE)").fetchall() == [(a, b)], x


def test_a_large_bucket_is_written_by_several_tasks(spark, tmpdir_path):
    root, setting = tmpdir_path + "/store", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = _rows(spark, [(i, f"id{i * 7919 % 30011}") for i in range(6000)])
    spark.conf.set(setting, "20000")
    try:
        ST.commit(spark, root, rows.repartition(6), n_buckets=1)
    finally:
        spark.conf.unset(setting)
    assert len(_files(root)) > 1 and ST.record(spark, root).rows == 6000
    assert sorted(r.id for r in ST.scan(spark, root).collect()) == sorted(r.id for r in rows.collect())
    assert ST.lookup(spark, root, "id7919").count() == 1


def test_a_first_batch_by_id_is_shuffled_once(spark):
    from vigil.operators import dedup
    batch = ST.to_stored(dedup.keep_latest(_rows(spark, [(i, f"id{i % 50}") for i in range(200)] + [(300, None), (301, None)])), 1)
    first = U.upsert(ST.empty_snapshot(spark), batch, first=True)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sorted(map(str, first.collect())) == sorted(map(str, U.upsert(ST.empty_snapshot(spark), batch).collect()))


def test_rows_without_an_id_stay_apart_in_a_first_batch(spark):
    batch = _rows(spark, [(i, None) for i in range(3)] + [(5, "a"), (6, "a")])
    got = U.upsert(ST.empty_snapshot(spark), batch, first=True).collect()
    assert sorted((r.id or "", r.seq) for r in got) == sorted([("", 0), ("", 1), ("", 2), ("a", 4)])
