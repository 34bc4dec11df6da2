import json

from pyspark.sql import functions as F

from pyspark.ml import PipelineModel

from tests.helpers import cve, raw_frame
from vigil.operators import normalize as N
from vigil.plans import job
from vigil.plans.pipeline import labelled_in_place
from vigil.sources import fixtures as FX
from vigil.sources import store as ST
from vigil.streaming import ingest as STREAM

SF = "/root/testdata/sf0.001"


def test_run_and_retrain(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    cve_raw, ip_raw = FX.raw_feeds(spark, SF)
    rep = job.run(spark, root, cve_raw, ip_raw, FX.FIXTURE_NOW, num_trees=5,
                  metrics_path=tmpdir_path + "/metrics")
    assert rep.version == 2 and rep.counts["stored"] == rep.counts["deduplicated"]
    assert set(rep.metrics) == {"logistic_regression", "decision_tree", "random_forest"}
    snap = ST.scan(spark, root)
    assert snap.filter(F.col("predicted_priority").isNull()).count() == 0
    assert snap.filter(F.col("heuristic_label").isNull()).count() == 0
    m = spark.read.json(tmpdir_path + "/metrics")
    assert m.count() == 3
    assert {"classification_report", "confusion_matrix", "labels_order", "feature_importance"} <= set(m.columns)
    saved = PipelineModel.load(f"{job.models_path(root, 2)}/logistic_regression")
    lab = labelled_in_place(ST.scan(spark, root, 1), FX.FIXTURE_NOW, keep_features=True)
    assert saved.transform(lab.limit(5)).count() == 5                # the scaling travels with the model
    # A second run of the same feeds changes nothing but the version.
    rep2 = job.run(spark, root, cve_raw, ip_raw, FX.FIXTURE_NOW, num_trees=5)
    assert rep2.counts["stored"] == rep.counts["stored"]
    first_seen = ST.scan(spark, root, 1).select("id", "first_seen")
    now_seen = ST.scan(spark, root).select("id", F.col("first_seen").alias("f2"))
    assert first_seen.join(now_seen, "id").filter("first_seen <> f2").count() == 0
    rep3 = job.retrain(spark, root, FX.FIXTURE_NOW, num_trees=5)
    assert rep3.version == rep2.version + 1


def test_rejects_are_kept_and_strict_raises(spark, tmpdir_path):
    import pytest
    root = tmpdir_path + "/store"
    good = [cve(id=f"c{i}") for i in range(3)]
    cve_raw = raw_frame(spark, [*good, "not json", cve(id="n", reportCount="n/a")])
    ip_raw = raw_frame(spark, [{"ipAddress": "1.1.1.1", "abuseConfidenceScore": 50}, {"abuseConfidenceScore": 1}], start=10)
    rep = job.RunReport(version=0)
    assert job.ingest_into(spark, root, cve_raw, ip_raw, rep) == 1 and rep.counts["stored"] == 4
    kept = sorted(r.reject_reason for r in spark.read.parquet(job.rejects_path(root)).collect())
    assert kept == ["fatal:bad_report_count", "missing_id", "unparsable_json"] and rep.counts["rejected"] == 3
    with pytest.raises(ValueError):
        job.ingest_into(spark, root, cve_raw, ip_raw, rep, strict=True)
    assert ST.current_version(spark, root) == 1


def test_replayed_batch_is_skipped(spark, tmpdir_path):
    root = tmpdir_path + "/store"
    norm = N.normalize_batch(raw_frame(spark, [cve(id="a"), cve(id=None), {"cve": {}}]),
                             raw_frame(spark, [{"ipAddress": "1.1.1.1", "abuseConfidenceScore": 50}], start=10))
    assert STREAM.store_batch(spark, root, norm, 1)
    before = sorted(map(str, ST.scan(spark, root).collect()))
    assert not STREAM.store_batch(spark, root, norm, 1)
    assert sorted(map(str, ST.scan(spark, root).collect())) == before
    assert spark.read.parquet(root + "-rejects").count() >= 1


def test_retrain_empty_store_fails(spark, tmpdir_path):
    import pytest
    with pytest.raises(RuntimeError):
        job.retrain(spark, tmpdir_path + "/empty", FX.FIXTURE_NOW)


def test_streaming_ingest(spark, tmpdir_path):
    cdir, idir = tmpdir_path + "/cve", tmpdir_path + "/ip"
    import os
    os.makedirs(cdir)
    os.makedirs(idir)
    with open(cdir + "/p0.json", "w") as f:
        json.dump({"vulnerabilities": [cve(id="A"), cve(id="B")]}, f)
    with open(idir + "/p0.json", "w") as f:
        json.dump({"data": [{"ipAddress": "1.1.1.1", "abuseConfidenceScore": 90,
                             "lastReportedAt": "2024-01-01T00:00:00Z"}]}, f)
    root = tmpdir_path + "/store"
    q = STREAM.start(spark, cdir, idir, root, tmpdir_path + "/ckpt")
    q.awaitTermination(180)
    assert sorted(r.id for r in ST.scan(spark, root).collect()) == ["1.1.1.1", "A", "B"]
    with open(cdir + "/p1.json", "w") as f:
        json.dump({"vulnerabilities": [cve(id="A", lastModified="2025-01-01T00:00:00.000")]}, f)
    q = STREAM.start(spark, cdir, idir, root, tmpdir_path + "/ckpt")
    q.awaitTermination(180)
    snap = {r.id: r for r in ST.scan(spark, root).collect()}
    assert len(snap) == 3 and snap["A"].last_seen == "2025-01-01T00:00:00.000"
