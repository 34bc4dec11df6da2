"""DuckDB SQL oracles for the registered queries.

Each string recomputes a query's result directly from the driver tables
(pre-registered views), via the same fixture mapping but without JSON, so
the Spark path (JSON → VARIANT → normalise → …) is checked end to end.
Float literals are cast to DOUBLE so DuckDB never does DECIMAL arithmetic.
"""
from __future__ import annotations

# The values below are written out, not taken from vigil.constants, so that a wrong constant shows as a mismatch.
HIGH_RISK = ["CN", "RU", "BR", "IN", "VN", "KR", "UA", "TR", "IR", "PK", "ID", "TH", "NG", "BD", "PH"]
CWE_HIGH = ["CWE-78", "CWE-89", "CWE-94", "CWE-77", "CWE-502", "CWE-434", "CWE-611", "CWE-918"]
CWE_MEDIUM = ["CWE-79", "CWE-352", "CWE-287", "CWE-200", "CWE-22", "CWE-416", "CWE-787", "CWE-120", "CWE-125"]
CWE_UNNAMED = ["unknown", "NVD-CWE-Other", "NVD-CWE-noinfo"]
WEIGHT = {"severity": 0.35, "exploited_flag": 0.18, "report_count_norm": 0.10, "recency_score": 0.08,
          "source_reliability": 0.07, "cwe_risk": 0.12, "reference_bonus": 0.10}
BUCKETS = [("Critical", 0.72), ("High", 0.52), ("Medium", 0.38)]
FEATURE_ORDER = ["severity_raw", "report_count_norm", "recency_score", "source_reliability", "exploited_flag",
                 "reference_count_norm", "high_risk_country", "is_cve", "is_malicious_ip"]


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


ISO = "'%Y-%m-%dT%H:%M:%S.%g'"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"

CVE = f"""
li AS (
  SELECT l_orderkey, count(*) AS n_refs,
         count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity >= 40)
           AS n_exploit
  FROM lineitem GROUP BY l_orderkey),
cve AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS seq,
         'CVE-2025-' || CAST(o.o_orderkey AS VARCHAR) AS id,
         'cve' AS threat_type,
         'CVE-2025-' || CAST(o.o_orderkey AS VARCHAR) AS title,
         substr('Order ' || CAST(o.o_orderkey AS VARCHAR) || ' ' || o.o_orderpriority || ': '
                || repeat('lorem ipsum ', CAST(30 + o.o_orderkey % 20 AS INTEGER)), 1, 500)
           AS description,
         CAST(CAST(round(o.o_totalprice * 100) AS BIGINT) % 101 AS DOUBLE) / {_d(10.0)}
           AS severity_raw,
         CASE WHEN o.o_orderkey % 13 = 0 THEN CAST(o.o_orderkey % 50 AS BIGINT)
              WHEN o.o_orderkey % 13 = 1 THEN CAST(o.o_orderkey % 40 AS BIGINT)
              ELSE CAST(coalesce(li.n_refs, 0) AS BIGINT) END AS report_count,
         strftime(CAST(DATE '2024-01-30' - CAST(o.o_orderkey % 365 AS INTEGER) AS TIMESTAMP), {ISO})
           AS first_seen,
         CASE o.o_orderkey % 11
           WHEN 0 THEN strftime(CAST(DATE '2024-01-30' - CAST(o.o_orderkey % 365 AS INTEGER) AS TIMESTAMP), {ISO})
           WHEN 3 THEN strftime(CAST(DATE '2024-01-30' - CAST(o.o_orderkey % 365 AS INTEGER) AS TIMESTAMP), {ISO}) || 'Z'
           WHEN 4 THEN strftime(CAST(DATE '2024-01-30' - CAST(o.o_orderkey % 365 AS INTEGER) AS TIMESTAMP), {ISO}) || '+02:00'
           WHEN 5 THEN '2024-03-01T00:00:00.000'
           WHEN 6 THEN strftime(CAST(DATE '2024-01-30' - CAST(o.o_orderkey % 365 AS INTEGER) AS TIMESTAMP), '%Y%m%dT%H%M%S')
           WHEN 7 THEN 'not-a-date' WHEN 8 THEN ''
           ELSE strftime(CAST(DATE '2024-01-31' - CAST(o.o_orderkey % 365 AS INTEGER) AS TIMESTAMP), {ISO}) END
           AS last_seen,
         'nvd' AS source,
         {_d(0.9)} AS source_reliability,
         coalesce(li.n_exploit, 0) > 0 AS exploited_flag,
         CASE WHEN o.o_orderkey % 7 <> 0 THEN 'vendor-' || CAST(o.o_custkey % 8 AS VARCHAR)
              ELSE 'unknown' END AS vendor,
         CASE o.o_orderkey % 5 WHEN 0 THEN 'CWE-89' WHEN 1 THEN 'CWE-79' WHEN 2 THEN 'CWE-1'
              WHEN 3 THEN 'CWE-78' ELSE 'unknown' END AS cwe,
         CAST(coalesce(li.n_refs, 0) AS BIGINT) AS reference_count,
         CAST(NULL AS VARCHAR) AS country_code,
         CAST(NULL AS VARCHAR) AS isp
  FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey)"""

IP = f"""
ip0 AS (
  SELECT *, CAST(floor(value) AS BIGINT) % 101 AS conf,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(10 + user_id // 65536 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) || '.'
           || CAST(user_id // 256 % 256 AS VARCHAR) || '.'
           || CAST(user_id % 256 AS VARCHAR) AS ip
  FROM events),
ip AS (
  SELECT CAST(4611686018427387904 + event_id AS BIGINT) AS seq,
         ip AS id,
         'malicious_ip' AS threat_type,
         'Malicious IP ' || ip AS title,
         'IP reported ' || CAST(k AS VARCHAR) || ' times with ' || CAST(conf AS VARCHAR)
           || '% abuse confidence.' AS description,
         round((CAST(conf AS DOUBLE) / {_d(100.0)}) * {_d(10.0)}, 2) AS severity_raw,
         k AS report_count,
         strftime(ts, {ISO}) AS first_seen,
         strftime(ts, {ISO}) AS last_seen,
         'abuseipdb' AS source,
         {_d(0.6)} AS source_reliability,
         false AS exploited_flag,
         CAST(NULL AS VARCHAR) AS vendor,
         CAST(NULL AS VARCHAR) AS cwe,
         CAST(NULL AS BIGINT) AS reference_count,
         CASE user_id % 4 WHEN 0 THEN 'CN' WHEN 1 THEN 'US' WHEN 2 THEN 'RU' ELSE 'DE' END
           AS country_code,
         event_type AS isp
  FROM ip0)"""

UNION = """
u AS (SELECT * FROM cve UNION ALL BY NAME SELECT * FROM ip)"""

DEDUP = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(last_seen, '') DESC, seq) AS rn,
         min(seq) OVER (PARTITION BY id) AS first_seq
  FROM u),
d AS (SELECT * EXCLUDE (rn, seq, first_seq), first_seq AS seq FROM ranked WHERE rn = 1)"""

HR = _in(HIGH_RISK)
CWE_RISK = (f"CASE WHEN cwe IN {_in(CWE_HIGH)} THEN {_d(1.0)} "
            f"WHEN cwe IN {_in(CWE_MEDIUM)} THEN {_d(0.6)} "
            f"WHEN cwe IS NOT NULL AND cwe <> '' AND cwe NOT IN {_in(CWE_UNNAMED)} THEN {_d(0.4)} "
            f"ELSE {_d(0.2)} END")
REF_BONUS = (f"least({_d(1.0)}, ln({_d(1.0)} + CAST(coalesce(reference_count, 0) AS DOUBLE))"
             f" / ln({_d(21.0)}))")
GEO = (f"CASE WHEN country_code IN {HR} AND severity_raw >= {_d(4.0)} THEN {_d(0.05)} "
       f"ELSE {_d(0.0)} END")
INSTANT = ("CASE WHEN regexp_matches(last_seen, '^[0-9]{8}T[0-9]{6}$') THEN strptime(last_seen, '%Y%m%dT%H%M%S') "
           "WHEN last_seen LIKE '%Z' THEN TRY_CAST(replace(last_seen, 'Z', '') AS TIMESTAMP) "
           "WHEN last_seen LIKE '%+02:00' THEN TRY_CAST(replace(last_seen, '+02:00', '') AS TIMESTAMP) - INTERVAL 2 HOUR "
           "ELSE TRY_CAST(last_seen AS TIMESTAMP) END")
RECENCY = (f"CASE WHEN ({INSTANT}) IS NULL THEN {_d(0.3)} ELSE "
           f"exp(-greatest({_d(0.0)}, ((epoch_us({NOW}) - epoch_us({INSTANT}))"
           f" / {_d(1e6)}) / {_d(86400.0)}) / {_d(30.0)}) END")

FEATURES = f"""
f0 AS (
  SELECT *, ln({_d(1.0)} + CAST(coalesce(report_count, 0) AS DOUBLE)) AS lrc,
            ln({_d(1.0)} + CAST(coalesce(reference_count, 0) AS DOUBLE)) AS lref
  FROM d),
mm AS (SELECT min(lrc) AS rc_min, max(lrc) AS rc_max, min(lref) AS ref_min, max(lref) AS ref_max
       FROM f0),
feat AS (
  SELECT f0.* EXCLUDE (exploited_flag),
         CAST(exploited_flag AS INTEGER) AS exploited_flag,
         CASE WHEN rc_max > rc_min THEN (lrc - rc_min) / (rc_max - rc_min) ELSE {_d(0.0)} END
           AS report_count_norm,
         {RECENCY} AS recency_score,
         CASE WHEN ref_max > ref_min THEN (lref - ref_min) / (ref_max - ref_min) ELSE {_d(0.0)} END
           AS reference_count_norm,
         CASE WHEN country_code IN {HR} THEN 1 ELSE 0 END AS high_risk_country,
         CASE WHEN threat_type = 'cve' THEN 1 ELSE 0 END AS is_cve,
         CASE WHEN threat_type = 'malicious_ip' THEN 1 ELSE 0 END AS is_malicious_ip
  FROM f0 CROSS JOIN mm)"""

_W = WEIGHT
SCORE = (f"least({_d(1.0)}, greatest({_d(0.0)}, "
         f"{_d(_W['severity'])} * (severity_raw / {_d(10.0)})"
         f" + {_d(_W['exploited_flag'])} * CAST(exploited_flag AS DOUBLE)"
         f" + {_d(_W['report_count_norm'])} * report_count_norm"
         f" + {_d(_W['recency_score'])} * recency_score"
         f" + {_d(_W['source_reliability'])} * source_reliability"
         f" + {_d(_W['cwe_risk'])} * ({CWE_RISK})"
         f" + {_d(_W['reference_bonus'])} * {REF_BONUS}"
         f" + {GEO}))")
BUCKET = ("CASE " + " ".join(f"WHEN priority_score >= {_d(t)} THEN '{lab}'"
                             for lab, t in BUCKETS) + f" ELSE 'Low' END")

LABELS = f"""
lab0 AS (SELECT *, {SCORE} AS priority_score FROM feat),
lab AS (SELECT *, {BUCKET} AS heuristic_label FROM lab0)"""


def with_ctes(*parts: str, tail: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + tail


BASE = (CVE, IP, UNION, DEDUP)
LABELLED = BASE + (FEATURES, LABELS)


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, 6) AS {alias or col}"


COMMON_SEL = ("id, threat_type, title, description, round(severity_raw, 6) AS severity_raw, "
              "report_count, first_seen, last_seen, source, "
              "round(source_reliability, 6) AS source_reliability, exploited_flag, seq, "
              "vendor, cwe, reference_count, country_code, isp")

LABEL_SEL = ", ".join([
    "id", "threat_type", r6("severity_raw"), "exploited_flag", r6("report_count_norm"),
    r6("recency_score"), r6("source_reliability"), r6("reference_count_norm"),
    "high_risk_country", "is_cve", "is_malicious_ip", r6("priority_score"), "heuristic_label"])

SQL: dict[str, str] = {
    "normalize_cve": with_ctes(CVE, tail=f"SELECT {COMMON_SEL} FROM cve"),
    "normalize_ip": with_ctes(IP, tail=f"SELECT {COMMON_SEL} FROM ip"),
    "normalize_union": with_ctes(CVE, IP, UNION, tail=f"SELECT {COMMON_SEL} FROM u"),
    "quarantine": with_ctes(IP, tail="""
SELECT * FROM (
  SELECT o_orderkey AS seq, 'nvd' AS source,
         CASE WHEN o_orderkey % 17 NOT IN (3, 5, 7) THEN 'CVE-2025-' || CAST(o_orderkey AS VARCHAR) END AS id,
         CASE WHEN o_orderkey % 17 = 3 THEN 'unparsable_json' WHEN o_orderkey % 17 = 5 THEN 'missing_cve'
              WHEN o_orderkey % 17 = 7 THEN 'missing_id' WHEN o_orderkey % 17 = 9 THEN 'bad_descriptions'
              WHEN o_orderkey % 17 = 11 THEN 'bad_metrics' WHEN o_orderkey % 17 = 13 THEN 'bad_references'
              WHEN o_orderstatus = 'P' THEN 'fatal:bad_report_count'
              WHEN o_orderkey % 17 = 15 THEN 'fatal:bad_weaknesses' END AS reject_reason FROM orders)
WHERE reject_reason IS NOT NULL
UNION ALL
SELECT * FROM (
  SELECT CAST(4611686018427387904 + event_id AS BIGINT) AS seq, 'abuseipdb' AS source,
         CASE WHEN event_id % 17 NOT IN (3, 6, 8) THEN ip END AS id,
         CASE WHEN event_id % 17 = 3 THEN 'unparsable_json' WHEN event_id % 17 = 8 THEN 'bad_record'
              WHEN event_id % 17 = 6 THEN 'missing_id' WHEN event_type = 'error' THEN 'bad_confidence'
              WHEN event_id % 17 = 4 THEN 'bad_total_reports' END AS reject_reason FROM ip0)
WHERE reject_reason IS NOT NULL"""),
    "first_en_description": with_ctes(CVE, tail="SELECT id, description FROM cve"),
    "cvss_cascade": with_ctes(CVE, tail="SELECT id, round(severity_raw, 6) AS severity_raw FROM cve"),
    "exploited_flag": with_ctes(CVE, tail="SELECT id, exploited_flag FROM cve"),
    "report_count_fallback": with_ctes(CVE, tail="SELECT id, report_count, reference_count FROM cve"),
    "date_fallback": with_ctes(CVE, tail="SELECT id, first_seen, last_seen FROM cve"),
    "extract_cwe": with_ctes(CVE, tail="SELECT id, cwe FROM cve"),
    "rescale_confidence": with_ctes(
        IP, tail="SELECT seq, id, round(severity_raw, 6) AS severity_raw, description FROM ip"),
    "source_reliability": with_ctes(
        CVE, IP, UNION, tail="SELECT source, round(max(source_reliability), 6) AS source_reliability,"
                             " count(*) AS n FROM u GROUP BY source"),
    "dedup_latest": with_ctes(*BASE, tail=f"SELECT {COMMON_SEL} FROM d"),
    "fill_defaults": with_ctes(*BASE, tail=f"""
SELECT id, round(CASE WHEN seq % 5 = 0 THEN {_d(0.0)} ELSE CAST(report_count AS DOUBLE) END, 6) AS report_count,
       CASE WHEN seq % 7 = 0 THEN 0 ELSE CAST(exploited_flag AS INTEGER) END AS exploited_flag,
       round(CASE WHEN seq % 3 = 0 THEN {_d(0.0)} ELSE severity_raw END, 6) AS severity_raw,
       round(CASE WHEN seq % 4 = 0 THEN {_d(0.5)} ELSE source_reliability END, 6) AS source_reliability
FROM d"""),
    "report_count_norm": with_ctes(*BASE, FEATURES, tail="""
SELECT id, round(CAST(coalesce(report_count, 0) AS DOUBLE), 6) AS report_count,
       round(report_count_norm, 6) AS report_count_norm FROM feat"""),
    "reference_count_norm": with_ctes(*BASE, FEATURES, tail="""
SELECT id, reference_count, round(reference_count_norm, 6) AS reference_count_norm FROM feat"""),
    "parse_date": with_ctes(*BASE, tail=f"""
SELECT id, last_seen, epoch_us({INSTANT}) AS last_seen_us FROM d"""),
    "recency_score": with_ctes(*BASE, FEATURES, tail="""
SELECT id, last_seen, round(recency_score, 6) AS recency_score FROM feat"""),
    "parse_extra": with_ctes(*BASE, tail="""
SELECT id, CASE WHEN seq % 6 > 2 THEN vendor END AS vendor, CASE WHEN seq % 6 > 2 THEN cwe END AS cwe,
       CASE WHEN seq % 6 > 2 THEN reference_count END AS reference_count,
       CASE WHEN seq % 6 > 2 THEN country_code END AS country_code, CASE WHEN seq % 6 > 2 THEN isp END AS isp FROM d"""),
    "high_risk_country": with_ctes(*BASE, FEATURES, tail="""
SELECT id, country_code, high_risk_country FROM feat"""),
    "type_onehot": with_ctes(*BASE, FEATURES, tail="""
SELECT id, threat_type, is_cve, is_malicious_ip FROM feat"""),
    "feature_matrix": with_ctes(*BASE, FEATURES, tail=f"""
SELECT id, threat_type, title, vendor, cwe, reference_count, country_code, isp,
       {r6('severity_raw')}, {r6('report_count_norm')}, {r6('recency_score')},
       {r6('source_reliability')}, exploited_flag, {r6('reference_count_norm')},
       high_risk_country, is_cve, is_malicious_ip
FROM feat"""),
    "label_all": with_ctes(*LABELLED, tail=f"SELECT {LABEL_SEL} FROM lab"),
    "cwe_risk": with_ctes(*BASE, tail=f"SELECT id, cwe, round({CWE_RISK}, 6) AS cwe_risk FROM d"),
    "reference_bonus": with_ctes(
        *BASE, tail=f"SELECT id, reference_count, round({REF_BONUS}, 6) AS reference_bonus FROM d"),
    "priority_score": with_ctes(*LABELLED, tail="SELECT id, round(priority_score, 6) AS priority_score FROM lab"),
    "geo_boost": with_ctes(*BASE, tail=f"""
SELECT id, country_code, round(severity_raw, 6) AS severity_raw, round({GEO}, 6) AS geo_boost FROM d"""),
    "bucket": with_ctes(*LABELLED, tail="""
SELECT id, round(priority_score, 6) AS priority_score, heuristic_label FROM lab"""),
    "label_counts": with_ctes(*LABELLED, tail="""
SELECT heuristic_label, count(*) AS n FROM lab GROUP BY heuristic_label"""),
}


# ---------------------------------------------------------------- store -----
STORE_SEL = ("id, threat_type, title, description, round(severity_raw, 6) AS severity_raw, "
             "report_count, first_seen, last_seen, source, "
             "round(source_reliability, 6) AS source_reliability, "
             "CAST(exploited_flag AS INTEGER) AS exploited_flag, "
             "CAST(NULL AS VARCHAR) AS predicted_priority, "
             "CAST(NULL AS DOUBLE) AS predicted_priority_score, "
             "CAST(NULL AS VARCHAR) AS heuristic_label, CAST({b} AS BIGINT) AS batch_id, seq, "
             "vendor, cwe, reference_count, country_code, isp")

SPLIT_TS = "TIMESTAMP '2024-01-16 00:00:00'"
TWO_BATCH = f"""
ipl AS (SELECT ip.* FROM ip JOIN events e ON ip.seq = 4611686018427387904 + e.event_id
        WHERE e.ts >= {SPLIT_TS}),
ipe AS (SELECT ip.* FROM ip JOIN events e ON ip.seq = 4611686018427387904 + e.event_id
        WHERE e.ts < {SPLIT_TS}),
u1 AS (SELECT * FROM cve UNION ALL BY NAME SELECT * FROM ipl),
r1 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(last_seen, '') DESC, seq) AS rn,
              min(seq) OVER (PARTITION BY id) AS first_seq FROM u1),
b1 AS (SELECT * EXCLUDE (rn, seq, first_seq), first_seq AS seq FROM r1 WHERE rn = 1),
r2 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(last_seen, '') DESC, seq) AS rn,
              min(seq) OVER (PARTITION BY id) AS first_seq FROM ipe),
b2 AS (SELECT * EXCLUDE (rn, seq, first_seq), first_seq AS seq FROM r2 WHERE rn = 1),
s1 AS (SELECT {STORE_SEL.format(b=1)} FROM b1),
b2r AS (SELECT * EXCLUDE (severity_raw, seq), CASE WHEN seq % 3 = 0 THEN {_d(1.5)} ELSE severity_raw END AS severity_raw,
               CASE WHEN seq % 3 = 0 THEN seq + 1099511627776 ELSE seq END AS seq FROM b2),
s2 AS (SELECT {STORE_SEL.format(b=2)} FROM b2r),
merged AS (
  SELECT s1.* FROM s1 WHERE id NOT IN (SELECT id FROM s2 WHERE id IS NOT NULL) OR id IS NULL
  UNION ALL
  SELECT s2.id, coalesce(s1.threat_type, s2.threat_type) AS threat_type, s2.title, s2.description,
         s2.severity_raw, s2.report_count, coalesce(s1.first_seen, s2.first_seen) AS first_seen,
         s2.last_seen, CASE WHEN s1.id IS NULL THEN s2.source ELSE s1.source END AS source,
         s2.source_reliability, s2.exploited_flag,
         s1.predicted_priority, s1.predicted_priority_score, s1.heuristic_label,
         CASE WHEN s1.id IS NULL THEN s2.batch_id ELSE s1.batch_id END AS batch_id,
         CASE WHEN s1.id IS NULL THEN s2.seq ELSE s1.seq END AS seq,
         s2.vendor, s2.cwe, s2.reference_count, s2.country_code, s2.isp
  FROM s2 LEFT JOIN s1 ON s1.id = s2.id)"""

SERVED = """
srv AS (SELECT *, heuristic_label AS predicted_priority, round_even(priority_score * 1e6, 0) / 1e6 AS predicted_priority_score,
               0 AS batch_id FROM lab),
flt AS (SELECT * FROM srv
        WHERE threat_type IS NOT NULL AND predicted_priority IN ('Low', 'Medium', 'High', 'Critical'))"""

RANK_EXPR = ("CASE predicted_priority WHEN 'Critical' THEN 3 WHEN 'High' THEN 2 "
             "WHEN 'Medium' THEN 1 WHEN 'Low' THEN 0 ELSE -1 END")


def _rank(desc: bool) -> str:
    d = "DESC" if desc else "ASC"
    return (f"row_number() OVER (ORDER BY {RANK_EXPR} {d}, predicted_priority_score {d} NULLS LAST, "
            f"batch_id, seq, id)")


RANK_SEL = ("id, threat_type, predicted_priority, round(predicted_priority_score, 6) "
            "AS predicted_priority_score, position")


def _ranked(desc: bool = True) -> str:
    return f"\nrk AS (SELECT *, {_rank(desc)} AS position FROM flt)"


def _page_filter(page_no: int, size: int) -> str:
    return f"""
tot AS (SELECT count(*) AS n FROM flt),
pb AS (SELECT CASE WHEN {page_no} > greatest(1, CAST(ceil(n / {size}) AS BIGINT)) THEN 1
                   ELSE {page_no} END AS pg FROM tot)"""


def _page_rows(page_no: int, size: int) -> str:
    return (f"SELECT {RANK_SEL} FROM rk, pb WHERE position > (pg - 1) * {size} "
            f"AND position <= pg * {size}")


SERVE_BASE = LABELLED + (SERVED,)
DISPLAY_SEL = ('id AS "ID", threat_type AS "Type", title AS "Title", '
               'round_even(severity_raw * 1e2, 0) / 1e2 AS "Severity", predicted_priority AS "ML Priority", '
               'round_even(predicted_priority_score * 1e4, 0) / 1e4 AS "ML Rank Score", '
               'heuristic_label AS "Heuristic Label", source AS "Source", '
               'last_seen AS "Last Seen", position')

SQL.update({
    "scan_threats": with_ctes(*BASE, tail=f"SELECT {STORE_SEL.format(b=0)} FROM d"),
    "count_threats": with_ctes(*BASE, tail="SELECT count(*) AS n_threats FROM d"),
    "upsert_threats": with_ctes(CVE, IP, TWO_BATCH, tail="SELECT * FROM merged"),
    "write_labels": with_ctes(*LABELLED, tail="""
SELECT id, threat_type, heuristic_label, CAST(NULL AS VARCHAR) AS predicted_priority FROM lab"""),
    "summary": with_ctes(*SERVE_BASE, tail="""
SELECT count(*) AS total_threats, count(*) FILTER (WHERE threat_type = 'cve') AS cves,
       count(*) FILTER (WHERE threat_type = 'malicious_ip') AS malicious_ips,
       count(*) FILTER (WHERE predicted_priority = 'Critical') AS critical_priority FROM srv"""),
    "distinct_types": with_ctes(*SERVE_BASE, tail="""
SELECT DISTINCT threat_type FROM srv WHERE threat_type IS NOT NULL"""),
    "available_priorities": with_ctes(*SERVE_BASE, tail="""
, fixed AS (SELECT * FROM (VALUES (0, 'Critical'), (1, 'High'), (2, 'Medium'), (3, 'Low'))
                  t(display_order, priority)),
present AS (SELECT DISTINCT predicted_priority AS priority FROM srv)
SELECT CAST(display_order AS INTEGER) AS display_order, priority FROM fixed
WHERE priority IN (SELECT priority FROM present)
   OR NOT EXISTS (SELECT 1 FROM present WHERE priority IN ('Low', 'Medium', 'High', 'Critical'))"""),
    "filter_threats": with_ctes(*SERVE_BASE, tail="""
SELECT id, threat_type, predicted_priority, round(predicted_priority_score, 6)
       AS predicted_priority_score FROM srv
WHERE threat_type IN ('cve', 'malicious_ip') AND predicted_priority IN ('Critical', 'High')"""),
    "rank_threats": with_ctes(*SERVE_BASE, _ranked(True), tail=f"SELECT {RANK_SEL} FROM rk"),
    "rank_threats_ascending": with_ctes(*SERVE_BASE, _ranked(False),
                                        tail=f"SELECT {RANK_SEL} FROM rk"),
    "page": with_ctes(*SERVE_BASE, _ranked(True), _page_filter(3, 25), tail=_page_rows(3, 25)),
    "page_deep": with_ctes(*SERVE_BASE, _ranked(True), _page_filter(250, 50),
                           tail=_page_rows(250, 50)),
    "page_published": with_ctes(*SERVE_BASE, _ranked(True), _page_filter(250, 50), tail=_page_rows(250, 50)),
    "page_hot": with_ctes(*LABELLED, f"""
srv AS (SELECT *, CASE WHEN seq % 10 <> 0 THEN 'High' ELSE heuristic_label END AS predicted_priority,
               CASE WHEN seq % 10 <> 0 THEN {_d(0.5)} ELSE round_even(priority_score * 1e6, 0) / 1e6 END AS predicted_priority_score,
               0 AS batch_id FROM lab),
flt AS (SELECT * FROM srv WHERE threat_type IS NOT NULL AND heuristic_label IN ('Low', 'Medium', 'High', 'Critical'))""",
                          _ranked(True), _page_filter(40, 50), tail=_page_rows(40, 50)),
    "upsert_delta": with_ctes(*BASE, tail=f"""
SELECT id, CASE WHEN seq % 100 = 7 THEN {_d(9.75)} ELSE round(severity_raw, 6) END AS severity_raw, first_seen,
       CAST(0 AS BIGINT) AS batch_id, seq FROM d
UNION ALL
SELECT 'new-' || id, round(severity_raw, 6), first_seen, CAST(2 AS BIGINT), seq FROM d WHERE seq % 100 = 7"""),
    "page_info": with_ctes(*SERVE_BASE, _page_filter(3, 25), tail="""
SELECT CAST(pg AS BIGINT) AS page, CAST(25 AS BIGINT) AS page_size,
       CAST((pg - 1) * 25 + 1 AS BIGINT) AS start_row,
       CAST(least(pg * 25, n) AS BIGINT) AS end_row, n AS total_rows,
       CAST(greatest(1, CAST(ceil(n / 25) AS BIGINT)) AS BIGINT) AS total_pages FROM tot, pb"""),
    "display_projection": with_ctes(*SERVE_BASE, _ranked(True), _page_filter(2, 50), tail=f"""
SELECT {DISPLAY_SEL} FROM rk, pb WHERE position > (pg - 1) * 50 AND position <= pg * 50"""),
    "inspect": with_ctes(*SERVE_BASE, tail="""
SELECT id, title, threat_type, source, round(severity_raw, 6) AS severity_raw, report_count, predicted_priority,
       CAST(printf('%.4f', coalesce(predicted_priority_score, 0.0)) AS DOUBLE) AS ml_rank_score, heuristic_label,
       first_seen, last_seen, description, vendor, cwe, reference_count, country_code, isp
FROM flt WHERE id = 'CVE-2025-1' LIMIT 1"""),
})


# ------------------------------------------------------------------- ML -----
SPLIT = f"""
sc AS (SELECT heuristic_label AS lbl, count(*) AS cnt FROM lab GROUP BY heuristic_label),
tot AS (SELECT sum(cnt) AS n, CAST(ceil({_d(0.25)} * sum(cnt)) AS BIGINT) AS n_test FROM sc),
al AS (SELECT lbl, cnt, n, n_test, ((n - n_test) * cnt) // n AS base,
              ((n - n_test) * cnt) % n AS rem FROM sc, tot),
al2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, lbl) AS rr,
               (n - n_test) - sum(base) OVER () AS leftover FROM al),
alloc AS (SELECT lbl, cnt - (base + CASE WHEN rr <= leftover THEN 1 ELSE 0 END) AS n_test_c FROM al2),
hashed AS (SELECT lab.*, md5('42:' || coalesce(id, '')) AS hsh FROM lab),
spl AS (SELECT hashed.*,
               row_number() OVER (PARTITION BY heuristic_label ORDER BY hsh, seq) <= alloc.n_test_c
                 AS is_test
        FROM hashed JOIN alloc ON alloc.lbl = hashed.heuristic_label),
tr AS (SELECT * FROM spl WHERE NOT is_test)"""

_RANK = ("CASE heuristic_label WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 "
         "WHEN 'Critical' THEN 3 END")
_BAND = (f"CASE WHEN severity_raw >= {_d(9.0)} THEN 3 WHEN severity_raw >= {_d(7.0)} THEN 2 "
         f"WHEN severity_raw >= {_d(4.0)} THEN 1 ELSE 0 END")
BAND = f"""
btr AS (SELECT {_BAND} AS band, {_RANK} AS r FROM tr),
bt AS (SELECT band, {', '.join(f'count(*) FILTER (WHERE r = {r}) / count(*) AS p{r}' for r in range(4))}
       FROM btr GROUP BY band),
ball AS (SELECT spl.*, {_BAND} AS band, CAST({_RANK} AS DOUBLE) AS label FROM spl),
pr0 AS (SELECT ball.*, {', '.join(f'coalesce(bt.p{r}, {_d(0.0)}) AS q{r}' for r in range(4))}
        FROM ball LEFT JOIN bt ON bt.band = ball.band),
pr_all AS (SELECT *, CAST(CASE WHEN q0 >= q1 AND q0 >= q2 AND q0 >= q3 THEN 0
                          WHEN q1 >= q2 AND q1 >= q3 THEN 1 WHEN q2 >= q3 THEN 2 ELSE 3 END
                          AS DOUBLE) AS prediction FROM pr0),
pr AS (SELECT * FROM pr_all WHERE is_test)"""

_LABEL_OF = ("CASE {x} WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' "
             "WHEN 3 THEN 'Critical' END")
ML_BASE = LABELLED + (SPLIT,)
_ZCOLS = FEATURE_ORDER
STATS = ("\nst AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _ZCOLS)
         + " FROM tr)")
Z_SEL = ", ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN {_d(1.0)} ELSE s_{c} END, 6)"
    f" AS {c}_z" for c in _ZCOLS)

PAIRS = """
grid AS (SELECT t.r AS t, p.r AS p FROM (VALUES (0), (1), (2), (3)) t(r),
                                      (VALUES (0), (1), (2), (3)) p(r)),
pc AS (SELECT CAST(label AS INTEGER) AS t, CAST(prediction AS INTEGER) AS p, count(*) AS n
       FROM pr GROUP BY 1, 2),
pairs AS (SELECT grid.t, grid.p, coalesce(pc.n, 0) AS n FROM grid LEFT JOIN pc
          ON pc.t = grid.t AND pc.p = grid.p),
per AS (SELECT t AS r, sum(CASE WHEN t = p THEN n ELSE 0 END) AS tp, sum(n) AS support
        FROM pairs GROUP BY t),
npred AS (SELECT p AS r, sum(n) AS n_pred FROM pairs GROUP BY p),
m0 AS (SELECT per.r, tp, support, n_pred,
              CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
       FROM per JOIN npred ON per.r = npred.r),
m AS (SELECT *, CASE WHEN precision + recall > 0
                     THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score
      FROM m0)"""

SQL.update({
    "stratified_split": with_ctes(*ML_BASE, tail="SELECT id, heuristic_label, is_test FROM spl"),
    "standardize": with_ctes(*ML_BASE, STATS, tail=f"SELECT id, is_test, {Z_SEL} FROM spl, st"),
    "predict_relational": with_ctes(*LABELLED, tail="""
SELECT model, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_labels_differ, CAST(0 AS BIGINT) AS n_scores_differ
FROM lab, (VALUES ('decision_tree'), ('random_forest')) t(model) GROUP BY model"""),
    "logreg_certificate": with_ctes(*ML_BASE, tail="""
, names AS (SELECT * FROM (VALUES ('Low'), ('Medium'), ('High'), ('Critical')) t(class))
SELECT class, count(heuristic_label) AS n, true AS optimal FROM names LEFT JOIN tr ON heuristic_label = class GROUP BY class"""),
    "class_weights": with_ctes(*ML_BASE, tail="""
, cw AS (SELECT heuristic_label, count(*) AS n_class FROM tr GROUP BY heuristic_label)
SELECT heuristic_label, n_class,
       round((SELECT count(*) FROM tr) / ((SELECT count(*) FROM cw) * n_class), 6) AS weight
FROM cw"""),
    "accuracy": with_ctes(*ML_BASE, BAND, tail="""
SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n_test FROM pr"""),
    "confusion_matrix": with_ctes(*ML_BASE, BAND, PAIRS, tail=f"""
SELECT {_LABEL_OF.format(x='t')} AS true_label,
       CAST(sum(n) FILTER (WHERE p = 0) AS BIGINT) AS "Low",
       CAST(sum(n) FILTER (WHERE p = 1) AS BIGINT) AS "Medium",
       CAST(sum(n) FILTER (WHERE p = 2) AS BIGINT) AS "High",
       CAST(sum(n) FILTER (WHERE p = 3) AS BIGINT) AS "Critical"
FROM pairs GROUP BY t"""),
    "classification_report": with_ctes(*ML_BASE, BAND, PAIRS, tail=f"""
SELECT {_LABEL_OF.format(x='r')} AS class, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support
FROM m
UNION ALL
SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
       round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6),
       CAST(sum(support) AS BIGINT) FROM m
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6),
       round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m"""),
    "expected_severity": with_ctes(*ML_BASE, BAND, tail=f"""
SELECT id, {_LABEL_OF.format(x='CAST(prediction AS INTEGER)')} AS predicted_priority,
       round((q0 * {_d(0.0)} + q1 * {_d(1.0)} + q2 * {_d(2.0)} + q3 * {_d(3.0)}) / {_d(3.0)}, 6)
         AS predicted_priority_score
FROM pr_all"""),
})


# -------------------------------------------------------------- sources -----
SQL.update({
    "read_cve_pages": with_ctes(CVE, tail="""
, pg AS (SELECT seq AS k, id, severity_raw, (seq // 500) * 2 + CASE WHEN seq % 500 >= 300 THEN 1 ELSE 0 END AS page
         FROM cve),
pp AS (SELECT *, dense_rank() OVER (ORDER BY page) - 1 AS page_order,
              row_number() OVER (PARTITION BY page ORDER BY k) - 1 AS pos FROM pg)
SELECT page_order * 4294967296 + pos AS seq, page_order, pos, id, round(severity_raw, 6) AS severity_raw FROM pp"""),
    "read_ip_min_confidence": with_ctes(IP, tail="""
, pg AS (SELECT ip0.*, CAST(floor(event_id / 1000) AS BIGINT) AS page FROM ip0),
pp AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY event_id) - 1 AS pos FROM pg)
SELECT CAST(4611686018427387904 + page * 4294967296 + pos AS BIGINT) AS seq, ip, round(CAST(conf AS DOUBLE), 6) AS confidence
FROM pp WHERE conf >= 50
ORDER BY conf DESC, ip, seq LIMIT 500"""),
    "rank_fallback": with_ctes(*BASE, tail="""
SELECT id, round(severity_raw, 6) AS severity_raw,
       row_number() OVER (ORDER BY severity_raw DESC NULLS LAST, seq, id) AS position FROM d"""),
    "write_labels_partial": with_ctes(*LABELLED, tail="""
SELECT id, threat_type, CASE WHEN seq % 5 = 0 THEN 'Critical' WHEN seq % 4 <> 0 THEN heuristic_label END AS heuristic_label
FROM lab"""),
    "write_predictions": with_ctes(*ML_BASE, BAND, tail=f"""
SELECT id, threat_type,
       CASE WHEN seq % 5 = 0 THEN 'Low' WHEN seq % 4 <> 0 THEN {_LABEL_OF.format(x='CAST(prediction AS INTEGER)')} END
         AS predicted_priority,
       CASE WHEN seq % 5 = 0 THEN {_d(0.125)} WHEN seq % 4 <> 0 THEN
         round((q0 * {_d(0.0)} + q1 * {_d(1.0)} + q2 * {_d(2.0)} + q3 * {_d(3.0)}) / {_d(3.0)}, 6) END
         AS predicted_priority_score
FROM pr_all"""),
    "metrics_summary": with_ctes(*ML_BASE, BAND, tail="""
SELECT 'Band Baseline' AS model_name,
       round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) * 100, 1) AS accuracy_pct FROM pr"""),
})

SQL["page_keyset"] = with_ctes(*SERVE_BASE, _ranked(True), _page_filter(3, 25), tail="""
SELECT id, threat_type, predicted_priority, round(predicted_priority_score, 6)
       AS predicted_priority_score
FROM rk, pb WHERE position > (pg - 1) * 25 AND position <= pg * 25""")
