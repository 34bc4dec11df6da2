import math

import pytest
from pyspark.sql import functions as F

from vigil.operators import dedup, features, labels
from vigil.plans.pipeline import label_snapshot
from vigil.sources import store as ST

NOW = "2024-01-31T00:00:00Z"


def _norm(spark, rows):
    """rows: (seq, id, last_seen) → minimal common-schema frame."""
    df = spark.createDataFrame(rows, "seq bigint, id string, last_seen string")
    return df.withColumn("title", F.concat(F.lit("t"), F.col("seq").cast("string")))


def test_keep_latest(spark):
    d = dedup.keep_latest(_norm(spark, [(1, "A", "2025-01-01"), (2, "A", "2025-02-01"),
                                        (3, "B", "2025-01-01"), (4, "B", "2025-01-01"),
                                        (5, "C", None), (6, "C", "2024"),
                                        (7, "D", "2025-01-01T12:00:00+00:00"),
                                        (8, "D", "2025-01-01T12:00:00.000"),
                                        (9, None, "x"), (10, None, "y")]))
    r = {x.id: x for x in d.collect()}
    assert r["A"].last_seen == "2025-02-01" and r["A"].seq == 1      # first appearance kept as seq
    assert r["B"].title == "t3"                                     # tie: first input wins
    assert r["C"].last_seen == "2024"                               # NULL loses to any text
    assert r["D"].last_seen == "2025-01-01T12:00:00.000"            # text order, not time
    assert r[None].last_seen == "y" and d.count() == 5              # NULL ids form one group


GOLDEN = [
    # id, severity, exploited, reports, last_seen, reliability, cwe, refs, country, type
    ("CVE-A", 9.8, 1, 40, "2024-01-31T00:00:00.000", .9, "CWE-89", 20, None, "cve"),
    ("CVE-B", 7.5, 0, 10, "2024-01-01T00:00:00.000", .9, "CWE-79", 2, None, "cve"),
    ("CVE-C", 5.0, 0, 0, "2023-01-31T00:00:00.000", .9, "NVD-CWE-Other", 0, None, "cve"),
    ("CVE-D", 6.1, 1, 3, "2023-12-02T00:00:00.000", .9, "CWE-1333", 1, None, "cve"),
    ("IP-E", 10.0, 0, 120, "2024-01-30T00:00:00.000", .6, None, None, "CN", "malicious_ip"),
    ("IP-F", 4.0, 0, 15, "2024-01-21T00:00:00.000", .6, None, None, "RU", "malicious_ip"),
    ("IP-G", 3.9, 0, 15, "2024-01-21T00:00:00.000", .6, None, None, "RU", "malicious_ip"),
    ("IP-H", 9.0, 0, 120, "garbage", .6, None, None, "US", "malicious_ip"),
]
EXPECTED = {  # report_norm, recency, ref_norm, score, label
    "CVE-A": (0.774340, 1.000000, 1.000000, 0.963434, "Critical"),
    "CVE-B": (0.500000, 0.367879, 0.360849, 0.513015, "Medium"),
    "CVE-C": (0.000000, 0.000005, 0.000000, 0.262000, "Low"),
    "CVE-D": (0.289065, 0.135335, 0.227670, 0.567000, "High"),
    "IP-E": (1.000000, 0.967216, 0.000000, 0.643377, "High"),
    "IP-F": (0.578130, 0.716531, 0.000000, 0.371135, "Low"),
    "IP-G": (0.578130, 0.716531, 0.000000, 0.317635, "Low"),
    "IP-H": (1.000000, 0.300000, 0.000000, 0.505000, "Medium"),
}


def golden_snapshot(spark):
    rows = []
    for i, (tid, sev, ex, rep, seen, rel, cwe, refs, cc, tt) in enumerate(GOLDEN):
        rows.append((tid, tt, tid, "", sev, rep, seen, seen, "nvd" if tt == "cve" else "abuseipdb",
                     rel, ex, (None, cwe, refs, cc, None), None, None, None, 0, i))
    return spark.createDataFrame(rows, ST.STORED)


def test_golden_labels(spark):
    lab = {r.id: r for r in label_snapshot(golden_snapshot(spark), NOW).collect()}
    for tid, (rn, rec, refn, score, label) in EXPECTED.items():
        r = lab[tid]
        assert r.report_count_norm == pytest.approx(rn, abs=1e-6), tid
        assert r.recency_score == pytest.approx(rec, abs=1e-6), tid
        assert r.reference_count_norm == pytest.approx(refn, abs=1e-6), tid
        assert r.priority_score == pytest.approx(score, abs=1e-6), tid
        assert r.heuristic_label == label, tid


def test_feature_edges(spark):
    rows = [("a", "cve", 5.0, 3, "", None), ("b", "cve", None, 3, "2025", None),
            ("c", "malicious_ip", 1.0, 3, "2030-01-01T00:00:00Z", "cn"),
            ("d", "other", 1.0, 3, "2024-01-30T00:00:00.000", "PH")]
    df = spark.createDataFrame(rows, "id string, threat_type string, severity_raw double, "
                                     "report_count bigint, last_seen string, cc string")
    df = df.select("*", F.struct(F.lit(None).cast("string").alias("vendor"),
                                 F.lit(None).cast("string").alias("cwe"),
                                 F.lit(None).cast("bigint").alias("reference_count"),
                                 F.col("cc").alias("country_code"),
                                 F.lit(None).cast("string").alias("isp")).alias("extra"),
                   F.lit(None).cast("double").alias("source_reliability"),
                   F.lit(None).cast("boolean").alias("exploited_flag"))
    f = {r.id: r for r in features.with_features(df, NOW).collect()}
    assert f["a"].recency_score == 0.3 and f["b"].recency_score == 0.3   # '' and '2025'
    assert f["c"].recency_score == 1.0                                   # future date
    assert f["a"].report_count_norm == 0.0                               # all counts equal
    assert f["b"].severity_raw == 0.0 and f["a"].source_reliability == 0.5
    assert f["c"].high_risk_country == 0 and f["d"].high_risk_country == 1   # case-sensitive
    assert (f["d"].is_cve, f["d"].is_malicious_ip) == (0, 0)


def test_no_ip_is_critical_and_scores_bounded(spark):
    from vigil.plans import pipeline as P
    lab = P.fixture_labelled(spark, "/root/testdata/sf0.001")
    bad = lab.filter((F.col("threat_type") == "malicious_ip") & (F.col("heuristic_label") == "Critical"))
    assert bad.count() == 0
    mm = lab.agg(F.min("priority_score"), F.max("priority_score")).first()
    assert 0.0 <= mm[0] <= mm[1] <= 1.0
    counts = labels.label_counts(lab).collect()
    assert [r.n for r in counts] == sorted([r.n for r in counts], reverse=True)
    assert not math.isnan(mm[1])
