from tests.helpers import cve, raw_frame
from vigil.operators import normalize as N


def _one(spark, doc, ip=False):
    df = raw_frame(spark, [doc])
    out = (N.normalize_ip(df) if ip else N.normalize_cve(df)).collect()
    assert len(out) == 1
    return out[0]


def test_happy_cve(spark):
    r = _one(spark, cve())
    assert r.reject_reason is None
    assert (r.id, r.threat_type, r.title, r.source) == ("CVE-X-1", "cve", "CVE-X-1", "nvd")
    assert r.severity_raw == 7.5 and r.source_reliability == 0.9
    assert r.report_count == 1 and r.extra.reference_count == 1
    assert r.extra.vendor == "unknown" and r.extra.cwe == "CWE-79"
    assert r.first_seen == "2024-01-01T00:00:00.000" and r.last_seen == "2024-01-02T00:00:00.000"
    assert r.exploited_flag is False


def test_cvss_cascade(spark):
    v30 = {"cvssMetricV31": [], "cvssMetricV30": [{"cvssData": {"baseScore": 6.1}}]}
    assert _one(spark, cve(metrics=v30)).severity_raw == 6.1
    no_score = {"cvssMetricV31": [{"cvssData": {}}], "cvssMetricV30": [{"cvssData": {"baseScore": 6.1}}]}
    assert _one(spark, cve(metrics=no_score)).severity_raw == 0.0
    assert _one(spark, cve(metrics={"cvssMetricV2": [{"cvssData": {"baseScore": "9.8"}}]})).severity_raw == 9.8
    assert _one(spark, cve(metrics=...)).severity_raw == 0.0
    r = _one(spark, cve(metrics={"cvssMetricV31": [{"other": 1}]}))
    assert r.reject_reason == "bad_metrics"
    assert _one(spark, cve(metrics={"cvssMetricV31": [{"cvssData": None}]})).reject_reason.startswith("fatal:")


def test_descriptions(spark):
    assert _one(spark, cve(descriptions=[{"lang": "es", "value": "hola"}])).description == ""
    long = "x" * 600
    r = _one(spark, cve(descriptions=[{"lang": "fr", "value": "a"}, {"lang": "en", "value": long}]))
    assert r.description == "x" * 500
    assert _one(spark, cve(descriptions=[{"lang": "en"}])).description == ""
    assert _one(spark, cve(descriptions=None)).reject_reason == "bad_descriptions"
    assert _one(spark, cve(descriptions=[{"lang": "en", "value": None}])).reject_reason == "bad_description"


def test_report_count_and_references(spark):
    r = _one(spark, cve(references=[]))
    assert r.report_count == 0 and r.extra.reference_count == 0
    assert _one(spark, cve(reportCount=None)).reject_reason == "bad_report_count"
    assert _one(spark, cve(reportCount="12")).report_count == 12
    assert _one(spark, cve(reportCount="n/a")).reject_reason == "fatal:bad_report_count"
    refs = [{"url": "a", "tags": ["Exploit"]}, {"url": "b", "tags": None}]
    assert _one(spark, cve(references=refs)).exploited_flag is True   # match before the bad tags
    refs2 = [{"url": "b", "tags": None}, {"url": "a", "tags": ["Exploit"]}]
    assert _one(spark, cve(references=refs2)).reject_reason == "bad_reference_tags"
    assert _one(spark, cve(references=[{"url": "a", "tags": "Known Exploit"}])).exploited_flag is True
    assert _one(spark, cve(references=[{"url": "a"}])).exploited_flag is False


def test_dates_and_cwe(spark):
    r = _one(spark, cve(lastModified=...))
    assert r.last_seen == "2024-01-01T00:00:00.000"
    assert _one(spark, cve(lastModified=None)).last_seen is None
    assert _one(spark, cve(published=..., lastModified=...)).last_seen == ""
    two = [{"description": [{"lang": "es", "value": "x"}]},
           {"description": [{"lang": "en", "value": "CWE-89"}]}]
    assert _one(spark, cve(weaknesses=two)).extra.cwe == "unknown"
    assert _one(spark, cve(weaknesses=[])).extra.cwe == "unknown"


def test_missing_and_null_ids(spark):
    assert _one(spark, {"cve": {"descriptions": []}}).reject_reason == "missing_id"
    assert _one(spark, {"nope": 1}).reject_reason == "missing_cve"
    assert _one(spark, "{not json").reject_reason == "unparsable_json"
    r = _one(spark, cve(id=None))
    assert r.reject_reason is None and r.id is None
    assert _one(spark, {"abuseConfidenceScore": 5}, ip=True).reject_reason == "missing_id"
    r = _one(spark, {"ipAddress": None}, ip=True)
    assert r.reject_reason is None and r.id is None


def test_ip_record(spark):
    doc = {"ipAddress": "1.2.3.4", "abuseConfidenceScore": 87, "totalReports": 154,
           "lastReportedAt": "2024-01-01T12:00:00+00:00", "countryCode": "CN", "isp": "X"}
    r = _one(spark, doc, ip=True)
    assert r.severity_raw == 8.7 and r.report_count == 154
    assert r.title == "Malicious IP 1.2.3.4"
    assert r.description == "IP reported 154 times with 87% abuse confidence."
    assert r.first_seen == r.last_seen == "2024-01-01T12:00:00+00:00"
    assert r.extra.country_code == "CN" and r.exploited_flag is False
    assert _one(spark, {"ipAddress": "a", "abuseConfidenceScore": 7}, ip=True).severity_raw == 0.7
    m = _one(spark, {"ipAddress": "a"}, ip=True)
    assert m.severity_raw == 0.0 and m.report_count == 0 and m.last_seen == ""
    assert _one(spark, {"ipAddress": "a", "abuseConfidenceScore": "87"}, ip=True).reject_reason \
        == "bad_confidence"


def test_union_and_quarantine(spark):
    c = raw_frame(spark, [cve(), cve(reportCount=None)])
    i = raw_frame(spark, [{"ipAddress": "1.1.1.1"}], start=10)
    good, bad = N.split_rejects(N.normalize_batch(c, i))
    assert good.count() == 2 and bad.count() == 1
    assert bad.first().reject_reason == "bad_report_count"


def test_plain_records_are_read_in_one_walk(spark, monkeypatch):
    """a record without oddities skips the staged reading, and what is read is the same."""
    from pyspark.sql import functions as F

    def entry(value, lang="en"):
        return [{"lang": "es", "value": "x"}, {"lang": lang, "value": value}]

    base = {"baseScore": 4}
    plain = [cve(), cve(lastModified=..., vendor="v", reportCount=7), cve(reportCount="8"), cve(vendor=None), cve(lastModified=None),
             cve(descriptions=[]), cve(descriptions=[{"lang": "en"}]), cve(descriptions=entry("y" * 600)), cve(weaknesses=[]),
             cve(metrics={}), cve(metrics={"cvssMetricV31": None, "cvssMetricV30": [], "cvssMetricV2": [{"cvssData": base}]}),
             cve(metrics={"cvssMetricV31": [{"cvssData": {}}], "cvssMetricV30": [{"cvssData": base}]}), cve(references=[]),
             cve(weaknesses=[{"description": entry(None)}]), cve(weaknesses=[{"description": entry(5)}]), cve(weaknesses=[{"description": []}]),
             cve(references=[{"tags": ["Exploit", None]}, {"tags": []}]), cve(id=5), cve(published=6)]
    odd = ["{", "5", "[]", {"cve": 3}, {"cve": None}, cve(id=None), cve(id=...), cve(published=None), cve(published=...),
           cve(reportCount="x"), cve(reportCount=None), cve(reportCount={}), cve(descriptions=None), cve(descriptions="en"),
           cve(descriptions=entry(5)), cve(descriptions=entry(None)), cve(descriptions=[3, *entry("z")]), cve(descriptions=[*entry("z"), None]),
           cve(descriptions=[{"value": "no language"}, *entry("z")]), cve(descriptions=...), cve(metrics=...), cve(metrics=None), cve(metrics="m"),
           cve(metrics={"cvssMetricV31": {"a": 1}}), cve(metrics={"cvssMetricV31": 1, "cvssMetricV30": [{"cvssData": base}]}), cve(metrics=[]),
           cve(metrics={"cvssMetricV2": "m"}), cve(metrics={"cvssMetricV31": [None]}), cve(metrics={"cvssMetricV2": [{}]}),
           cve(metrics={"cvssMetricV2": [{"cvssData": {"baseScore": None}}]}), cve(metrics={"cvssMetricV2": [{"cvssData": {"baseScore": "q"}}]}),
           cve(references=None), cve(references=...), cve(references=[{"url": "u"}]), cve(references=[{"tags": "Exploit"}]), cve(references=[None]),
           cve(weaknesses=None), cve(weaknesses=...), cve(weaknesses="CWE"), cve(weaknesses=[3]), cve(weaknesses=[{}]),
           cve(weaknesses=[{"description": None}]), cve(weaknesses=[{"description": [7]}]),
           '{"cve":{"id":"a","id":"b"}}']
    raw = raw_frame(spark, plain + odd)
    df = raw.select("seq", N.V.parse(F.col("raw")).alias("_v"))
    for stage in N._plain_stages()[0]:
        df = df.withColumns(stage)
    taken = {r.seq for r in df.filter("_plain").collect()}
    assert [(plain + odd)[i] for i in sorted(taken ^ set(range(len(plain))))] == []
    got = N.normalize_cve(raw).sort("seq").collect()
    first, columns = N._plain_stages()
    monkeypatch.setattr(N, "_plain_stages", lambda: ([first[0], *first[1:-2], {"_plain": F.lit(False)}], columns))
    monkeypatch.setattr(N, "_STAGES", {})
    assert got == N.normalize_cve(raw).sort("seq").collect()
    assert all(r.reject_reason is None for r in got[:len(plain)])
