import json


def raw_frame(spark, docs, start=0):
    """(seq, raw) from Python objects (dumped) or raw strings."""
    rows = [(start + i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "seq bigint, raw string")


def cve(**over):
    base = {
        "id": "CVE-X-1", "published": "2024-01-01T00:00:00.000",
        "lastModified": "2024-01-02T00:00:00.000",
        "descriptions": [{"lang": "en", "value": "desc"}],
        "metrics": {"cvssMetricV31": [{"cvssData": {"baseScore": 7.5}}]},
        "weaknesses": [{"description": [{"lang": "en", "value": "CWE-79"}]}],
        "references": [{"url": "u", "tags": ["Patch"]}],
    }
    for k, v in over.items():
        if v is ...:
            base.pop(k, None)
        else:
            base[k] = v
    return {"cve": base}


def rows_by_id(df):
    return {r["id"]: r for r in df.collect()}


def col_values(df, c):
    return [r[c] for r in df.orderBy("seq").select(c, "seq").collect()]

