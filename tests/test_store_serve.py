from pyspark.sql import functions as F

from tests.test_dedup_labels import golden_snapshot
from vigil.operators import serve as V
from vigil.operators import upsert as U
from vigil.schemas import STORED
from vigil.sources import store as ST


def _row(i, tid, last, batch=1, seq=None, **kw):
    base = dict(id=tid, threat_type="cve", title=f"t{i}", description="d", severity_raw=float(i),
                report_count=i, first_seen=last, last_seen=last, source="nvd",
                source_reliability=0.9, exploited_flag=0, extra=None, predicted_priority=None,
                predicted_priority_score=None, heuristic_label=None, batch_id=batch,
                seq=seq if seq is not None else i)
    base.update(kw)
    return tuple(base[f.name] for f in STORED.fields)


def test_upsert_rules(spark):
    store = spark.createDataFrame([_row(1, "A", "2025-02-01", predicted_priority="High",
                                        heuristic_label="High", first_seen="2025-01-01"),
                                   _row(2, "B", "2025-01-01"), _row(3, None, "x")], STORED)
    batch = spark.createDataFrame([_row(9, "A", "2024-01-01", batch=2, first_seen="2024-01-01",
                                        source="other", threat_type="zzz"),
                                   _row(8, "C", "2025-03-01", batch=2), _row(7, None, "y", batch=2)],
                                  STORED)
    out = U.upsert(store, batch).collect()
    by = {}
    for r in out:
        by.setdefault(r.id, []).append(r)
    a = by["A"][0]
    assert a.last_seen == "2024-01-01" and a.title == "t9"          # older batch still overwrites
    assert a.first_seen == "2025-01-01" and a.source == "nvd" and a.threat_type == "cve"
    assert a.predicted_priority == "High" and a.heuristic_label == "High" and a.batch_id == 1
    assert by["B"][0].title == "t2" and by["C"][0].batch_id == 2
    assert len(by[None]) == 2 and len(out) == 5                      # NULL ids always inserted
    fresh = {r.id: r for r in U.upsert(store, batch, only_if_newer=True).collect() if r.id}
    assert fresh["A"].last_seen == "2025-02-01"


def test_upsert_idempotent(spark):
    batch = spark.createDataFrame([_row(1, "A", "a"), _row(2, "B", "b")], STORED)
    once = U.upsert(ST.empty_snapshot(spark), batch)
    twice = U.upsert(once, batch)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_write_back(spark):
    store = spark.createDataFrame([_row(1, "A", "a"), _row(2, "B", "b"), _row(3, None, "c")], STORED)
    upd = spark.createDataFrame([("A", "High"), ("Z", "Low"), (None, "Low")],
                                "id string, heuristic_label string")
    r = {x.id: x.heuristic_label for x in U.write_labels(store, upd).collect()}
    assert r == {"A": "High", "B": None, None: None}


def test_commit_and_scan(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    assert ST.scan(spark, root).count() == 0
    v1 = ST.commit(spark, root, golden_snapshot(spark))
    v2 = ST.commit(spark, root, golden_snapshot(spark).limit(3))
    assert (v1, v2) == (1, 2) and ST.committed_versions(spark, root) == [1, 2]
    assert ST.count(ST.scan(spark, root)).first()[0] == 3
    assert ST.scan(spark, root, 1).count() == 8
    plan = ST.scan(spark, root).filter(F.col("threat_type") == "cve")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan or "threat_type" in plan


def _served(spark):
    rows = []
    labels = ["Low", "High", "Critical", None, "Medium", "High", "High", "Low"]
    scores = [0.1, 0.6, 0.9, 0.5, 0.4, None, 0.6, 0.1]
    for i in range(8):
        rows.append(_row(i, f"id{i}", "x", predicted_priority=labels[i],
                         predicted_priority_score=scores[i],
                         threat_type="cve" if i % 2 else "malicious_ip"))
    return spark.createDataFrame(rows, STORED)


def test_rank_and_pages(spark):
    f = V.filter_threats(_served(spark))
    assert f.count() == 7                                           # no prediction → never shown
    ranked = [r.id for r in V.rank_threats(f).orderBy("position").collect()]
    assert ranked == ["id2", "id1", "id6", "id5", "id4", "id0", "id7"]   # NULL score last; ties by seq
    asc = [r.id for r in V.rank_threats(f, desc=False).orderBy("position").collect()]
    assert asc[:2] == ["id0", "id7"] and asc[-1] == "id2"
    pages = []
    for p in (1, 2, 3):
        pages += [r.id for r in V.page(f, p, 3).orderBy("position").collect()]
    assert pages == ranked                                          # concatenated pages = ranking
    assert [r.id for r in V.page(f, 99, 3).collect()] == [r.id for r in V.page(f, 1, 3).collect()]
    info = V.page_info(f, 3, 3).first()
    assert (info.start_row, info.end_row, info.total_rows, info.total_pages) == (7, 7, 7, 3)
    empty = V.page_info(f.filter("false"), 1, 25).first()
    assert (empty.start_row, empty.end_row, empty.total_rows, empty.total_pages) == (1, 0, 0, 1)


def test_pages_of_any_size_and_ties_concatenate_to_the_ranking(spark):
    rows = [_row(i, f"t{i:03d}", "a", batch=1 + i % 2, seq=i // 4, predicted_priority=["High", "Low", None][i % 3],
                 predicted_priority_score=[0.5, 0.5, None, 0.501][i % 4]) for i in range(120)]
    s = spark.createDataFrame(rows, STORED)
    for desc in (True, False):
        ranked = [r.id for r in V.rank_threats(s, desc).orderBy("position").collect()]
        for size in (7, 50):
            got = [r.id for p in range(1, -(-120 // size) + 1) for r in V.page(s, p, size, desc).orderBy("position").collect()]
            assert got == ranked


def test_without_prediction_columns_severity_ranks(spark):
    s = _served(spark).drop("predicted_priority", "predicted_priority_score")
    f = V.filter_threats(s, priorities=["High"])
    assert f.count() == s.count()
    ranked = [r.severity_raw for r in V.rank_threats(f, columns=["severity_raw"]).orderBy("position").collect()]
    assert ranked == sorted(ranked, reverse=True)
    first = V.page(f, 1, 3).orderBy("position").collect()
    assert [r.severity_raw for r in first + V.page_after(f, V.cursor_of(first[-1]), 100).collect()] == ranked


def test_keyset_walks_over_rows_that_differ_in_id_only(spark):
    s = spark.createDataFrame([_row(0, i, "a", seq=1, predicted_priority="High", predicted_priority_score=0.5)
                               for i in "ABC"], STORED)
    got, last = [], V.page(s, 1, 1).collect()
    while last:
        got.append(last[0].id)
        last = V.page_after(s, V.cursor_of(last[0]), 1).collect()
    assert got == ["A", "B", "C"]


def test_repeated_ids_keep_one_row_per_key(spark):
    store = spark.createDataFrame([_row(0, "a", "x"), _row(1, "b", "x")], STORED)
    batch = spark.createDataFrame([_row(5, "a", "y", batch=2, seq=9), _row(4, "a", "z", batch=2, seq=3),
                                   _row(6, "n", "y", batch=2, seq=1), _row(7, "n", "z", batch=2, seq=2)], STORED)
    got = {r.id: r for r in U.upsert(store, batch).collect()}
    assert sorted(got) == ["a", "b", "n"] and got["a"].title == "t5" and got["n"].title == "t7"
    up = spark.createDataFrame([("a", "Low", 1), ("a", "High", 7), ("a", "Medium", 3), ("zz", "Low", 1), (None, "Low", 1)],
                               "id string, heuristic_label string, at int")
    got = {r.id: r.heuristic_label for r in U.write_labels(store, up, "at").collect()}
    assert got == {"a": "High", "b": None}
    plan = U.upsert(store, batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2              # either side once


def test_counters_and_lookup(spark):
    s = _served(spark)
    r = V.summary(s).first()
    assert (r.total_threats, r.cves, r.malicious_ips, r.critical_priority) == (8, 4, 4, 1)
    assert [x.threat_type for x in V.distinct_types(s).collect()] == ["cve", "malicious_ip"]
    assert [x.priority for x in V.available_priorities(s).orderBy("display_order").collect()] == \
        ["Critical", "High", "Medium", "Low"]
    none = s.withColumn("predicted_priority", F.lit(None).cast("string"))
    assert V.available_priorities(none).count() == 4
    only = s.filter(F.col("predicted_priority") == "High")
    assert [x.priority for x in V.available_priorities(only).collect()] == ["High"]
    hit = V.inspect(V.filter_threats(s), "id5").first()
    assert hit.ml_rank_score == 0.0
    assert V.inspect(V.filter_threats(s), "id3").count() == 0        # searches the filtered set
    cols = V.display_projection(s).columns
    assert cols[:4] == ["ID", "Type", "Title", "Severity"]


def test_upsert_null_id_heavy_batch_without_broadcast(spark):
    """A third of the batch has no id; joins forced to shuffle (no broadcast)."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        store = spark.createDataFrame([_row(i, f"s{i}", "a") for i in range(30)]
                                      + [_row(100 + i, None, "a") for i in range(10)], STORED)
        batch = spark.createDataFrame(
            [_row(200 + i, f"s{i}", "b", batch=2) for i in range(20)]
            + [_row(300 + i, f"n{i}", "b", batch=2) for i in range(10)]
            + [_row(400 + i, None, "b", batch=2) for i in range(15)], STORED)
        out = U.upsert(store, batch)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        rows = out.collect()
        assert len(rows) == 30 + 10 + 10 + 15
        assert sum(1 for r in rows if r.id is None) == 25
        upd = {r.id: r for r in rows if r.id and r.id.startswith("s")}
        assert sum(1 for r in upd.values() if r.last_seen == "b") == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        if prev_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev_aqe)


def test_empty_snapshot_features_keep_schema(spark):
    from vigil.plans.pipeline import label_snapshot
    out = label_snapshot(ST.empty_snapshot(spark), "2024-01-31T00:00:00Z")
    assert out.count() == 0
    assert {"report_count_norm", "recency_score", "priority_score", "heuristic_label"} <= set(out.columns)


def test_keyset_pages_follow_ranking(spark):
    f = V.filter_threats(_served(spark))
    ranked = [r.id for r in V.rank_threats(f).orderBy("position").collect()]
    got, cursor = [], None
    first = V.page(f, 1, 2).orderBy("position").collect()
    got += [r.id for r in first]
    cursor = V.cursor_of(first[-1])
    while True:
        nxt = V.page_after(f, cursor, 2).collect()
        if not nxt:
            break
        got += [r.id for r in nxt]
        cursor = V.cursor_of(nxt[-1])
    assert got == ranked                     # includes crossing the NULL-score row
