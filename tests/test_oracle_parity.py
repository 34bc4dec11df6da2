"""Spark queries versus their DuckDB oracle SQL at sf0.001 (the driver's gate, smaller)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = ["normalize_union", "quarantine", "dedup_latest", "feature_matrix", "label_all",
        "upsert_threats", "write_labels", "summary", "available_priorities", "rank_threats",
        "page", "page_deep", "page_info", "display_projection", "inspect", "stratified_split",
        "standardize", "classification_report", "confusion_matrix", "expected_severity",
        "read_cve_pages", "read_ip_min_confidence", "date_fallback", "report_count_fallback", "fill_defaults",
        "parse_date", "parse_extra", "recency_score", "write_labels_partial", "write_predictions", "rank_fallback",
        "page_keyset", "metrics_summary", "page_hot", "page_published", "upsert_delta", "logreg_certificate"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 50


@pytest.mark.parametrize("key", KEYS)
def test_parity(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["ID", "Type", "Title"]
    assert 0 < df.count() <= 25
