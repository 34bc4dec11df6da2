"""Landed pages: order from names, one read of a body, corrupt pages in the run's rejects."""
import json
import os

from pyspark.sql import functions as F

from tests.helpers import cve
from vigil.plans import job
from vigil.session import scratch_scope, scratch_table, shared_path
from vigil.sources import landed as LD
from vigil.sources import store as ST


def _land(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, body in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(body if isinstance(body, str) else json.dumps(body))
    return folder


def _page(*ids):
    return {"vulnerabilities": [cve(id=i) for i in ids]}


def _ips(*pairs):
    return {"data": [{"ipAddress": a, "abuseConfidenceScore": c} for a, c in pairs]}


def test_order_of_many_files_from_their_names(spark, tmpdir_path):
    d = _land(tmpdir_path + "/a", {f"page-{n:05d}.json": _page(f"c{n}") for n in range(0, 120, 3)})
    names = LD.list_pages(spark, d).orderBy("order").collect()
    assert [(r.page, r.order) for r in names] == [(n, k) for k, n in enumerate(range(0, 120, 3))]
    got = LD.cve_pages_to_records(LD.read_pages(spark, d))
    assert sorted(got.select("seq").toPandas()["seq"]) == [k << LD.POSITION_BITS for k in range(40)]


def test_a_body_is_read_once_and_no_keyless_window(spark, tmpdir_path):
    d = _land(tmpdir_path + "/a", {f"{n}.json": _page(f"c{n}") for n in range(5)})
    pages = LD.read_pages(spark, d)
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1 and "Scan binaryFile" not in plan and "Exchange SinglePartition" not in plan
    # the records come from the parsed pages' table: no further scan of the bodies, no join for the end of the feed
    plan = LD.cve_pages_to_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and "Join" not in plan and plan.count("Scan parquet") == 1
    # the listing itself never opens a body
    listed = spark.read.format("binaryFile").load(d).select(F.col("_metadata.file_path"))
    assert "ReadSchema: struct<>" in listed._jdf.queryExecution().executedPlan().toString()


def test_many_files_are_joined_without_a_broadcast(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(LD, "BROADCAST_FILES", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = _land(tmpdir_path + "/a", {f"{n}.json": _page(f"c{n}") for n in range(7)})
        pages = LD.read_pages(spark, d)
        assert "Broadcast" not in pages._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.page, r.order) for r in pages.collect()) == [(n, n) for n in range(7)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_feed_ends_at_the_first_empty_page_not_at_a_corrupt_one(spark, tmpdir_path):
    d = _land(tmpdir_path + "/a", {"0.json": _page("a"), "1.json": '{"vulnerabilities": [', "2.json": _page("b"),
                                   "3.json": {"other": 1}, "4.json": _page("c")})
    recs = LD.cve_pages_to_records(LD.read_pages(spark, d), keep_corrupt=True).orderBy("seq").collect()
    assert [(r.page, r.raw is None) for r in recs] == [(0, False), (1, True), (2, False)]
    plain = LD.cve_pages_to_records(LD.read_pages(spark, d)).orderBy("seq").collect()
    assert [r.page for r in plain] == [0, 2]


def test_the_cap_does_not_count_corrupt_pages(spark, tmpdir_path):
    d = _land(tmpdir_path + "/a", {"0.json": _ips(("1.1.1.1", 90), ("1.1.1.2", 80), ("1.1.1.3", 10)), "1.json": "nope"})
    recs = LD.ip_pages_to_records(LD.read_pages(spark, d), limit=2, keep_corrupt=True).collect()
    assert sorted((r.ip or "", r.raw is None) for r in recs) == [("", True), ("1.1.1.1", False), ("1.1.1.2", False)]


def test_run_stores_corrupt_pages(spark, tmpdir_path):
    c = _land(tmpdir_path + "/cve", {f"{n}.json": {"vulnerabilities": [
        cve(id=f"c{n}-{k}", metrics={"cvssMetricV31": [{"cvssData": {"baseScore": float(k)}}]}) for k in range(10)]} for n in range(6)})
    _land(c, {"6.json": "<html>gateway timeout</html>", "7.json": _page("late")})
    i = _land(tmpdir_path + "/ip", {"0.json": _ips(*((f"9.9.9.{k}", 50 + k) for k in range(40))), "1.json": '{"data": [{'})
    root = tmpdir_path + "/store"
    rep = job.run_landed(spark, root, c, i, "2025-02-01T00:00:00Z", num_trees=3)
    assert rep.counts["stored"] == 61 + 40 and rep.counts["rejected"] == 2
    rejects = spark.read.parquet(job.rejects_path(root)).collect()
    assert sorted((r.seq >> LD.FEED_BIT, (r.seq >> LD.POSITION_BITS) & ((1 << 30) - 1), r.reject_reason) for r in rejects) == \
        [(0, 6, "unparsable_json"), (1, 1, "unparsable_json")]
    assert ST.scan(spark, root).filter(F.col("id") == "late").count() == 1


def test_scratch_tables_go_with_their_scope(spark):
    def there(df):
        return [os.path.exists(p.removeprefix("file://").removeprefix("file:")) for p in df.inputFiles()]
    kept = scratch_table(spark.range(3), "test")
    with scratch_scope(spark):
        outer = scratch_table(spark.range(3), "test")
        files = outer.inputFiles()
        with scratch_scope(spark):
            inner = scratch_table(spark.range(4), "test").inputFiles()
        assert not any(os.path.exists(p.removeprefix("file://").removeprefix("file:")) for p in inner)
        assert all(there(outer))
    assert not any(os.path.exists(p.removeprefix("file://").removeprefix("file:")) for p in files)
    assert all(there(kept)) and shared_path(spark)


def test_folders_of_pages_are_listed_by_few_tasks(spark, tmpdir_path):
    rows = spark.range(0, 120).select(F.col("id").alias("seq"), F.concat(F.lit('{"cve":{"id":"c'), "id", F.lit('"}}')).alias("raw"))
    LD.write_pages(LD.envelope(rows, "vulnerabilities", lambda s: F.floor(s / 2)), tmpdir_path + "/pages")
    sc, before = spark.sparkContext, spark.conf.get(LD.LISTING)
    sc.setJobGroup("listed", "")
    try:
        pages = LD.read_pages(spark, tmpdir_path + "/pages")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    track = sc.statusTracker()
    stages = [track.getStageInfo(s) for j in track.getJobIdsForGroup("listed") for s in track.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 4 * sc.defaultParallelism < 60
    assert spark.conf.get(LD.LISTING) == before
    got = LD.cve_pages_to_records(pages)
    assert sorted(got.select("page", "pos").collect()) == [(p, k) for p in range(60) for k in range(2)]


def test_landed_pages_are_packed_and_read_back_whole(spark, tmpdir_path):
    rows = spark.range(0, 40).select(F.col("id").alias("seq"), F.concat(
        F.lit('{"cve":{"id":"c'), "id", F.lit('","text":"'), F.repeat(F.lit("lorem ipsum "), F.lit(300)), F.lit('"}}')).alias("raw"))
    LD.write_pages(LD.envelope(rows, "vulnerabilities", lambda s: F.floor(s / 20)), tmpdir_path + "/pages")
    files = [os.path.join(d, f) for d, _, names in os.walk(tmpdir_path + "/pages") for f in names if f.startswith("part-")]
    assert len(files) == 2 and sum(map(os.path.getsize, files)) * 10 < 40 * 3600
    pages = LD.read_pages(spark, tmpdir_path + "/pages")
    assert [json.loads(r.body)["vulnerabilities"] for r in pages.orderBy("order").collect()] \
        == [[json.loads(r.raw) for r in rows.filter(f"seq div 20 = {p}").orderBy("seq").collect()] for p in range(2)]
    # packed and plain files of one folder are read alike
    with open(tmpdir_path + "/pages/page=1/extra.txt", "w") as f:
        json.dump(_page("z"), f)
    assert sorted((r.page, r.order) for r in LD.read_pages(spark, tmpdir_path + "/pages").collect()) == [(0, 0), (1, 1), (1, 2)]


def test_file_names_are_broadcast_as_hashes_that_differ(spark, tmpdir_path, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = _land(tmpdir_path + "/a", {f"{n}.json": _page(f"c{n}") for n in range(7)})
        pages = LD.read_pages(spark, d)
        plan = pages._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" in plan and "xxhash64(file" in plan
        monkeypatch.setattr(LD.F, "xxhash64", lambda *cols: F.length(*cols).cast("bigint"))      # all hashes alike
        same = LD.read_pages(spark, d)
        assert "strategy=broadcast" not in same._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, same.collect())) == sorted(map(tuple, pages.collect())) and same.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
