"""Driver tables → raw feed records.

The driver tables hold no security data, so a fixed mapping turns them into
the two raw JSON shapes the engine ingests (see FIXTURES.md §3):

* one vulnerability record per ``orders`` row, with one reference per
  ``lineitem`` of that order;
* one address report per ``events`` row.

Records are emitted as JSON *text* (``to_json`` drops NULL fields, which is
how optional keys are left out), so ingestion pays the same parse cost as
landed feed files.  Each record carries ``seq``, its reproducible input
position: vulnerability rows first (``o_orderkey``), then address reports
(``2^62 + event_id``).  Dates, report counts and weaknesses come in every
shape that a branch of the normaliser looks for, by rules on the key.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.dates import iso_text_ms
from vigil.sources.tables import read_table

IP_SEQ_BASE = 1 << 62

# Fixed mapping values (FIXTURES.md §3).
FIXTURE_CVE_PREFIX = "CVE-2025-"
FIXTURE_ANCHOR_DATE = "2024-01-30"
FIXTURE_CWE_BY_KEY_MOD5 = ["CWE-89", "CWE-79", "CWE-1", "CWE-78", "unknown"]
FIXTURE_COUNTRY_BY_USER_MOD4 = ["CN", "US", "RU", "DE"]
FIXTURE_NOW = "2024-01-31T00:00:00Z"

_CVSS = "struct<cvssData:struct<baseScore:double,baseSeverity:string>>"
_REF = "struct<url:string,tags:array<string>>"


def _pick(idx: Column, values: list[str]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(idx == i, F.lit(v)) if out is None else out.when(idx == i, F.lit(v))
    return out


def reference_counts(lineitem: DataFrame) -> DataFrame:
    """Per order: number of references and of exploit-tagged ones.

    A partial (map-side) aggregate, so a hot order key collapses before the
    shuffle; no per-order list is ever collected.
    """
    exploit = ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
               & (F.col("l_quantity") >= 40))
    return (lineitem.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_refs"),
                 F.count_if(exploit).alias("n_exploit")))


def cve_records(orders: DataFrame, lineitem: DataFrame, defects: bool = False) -> DataFrame:
    """(seq, raw) — one raw vulnerability record per order.

    ``defects``: orders with status 'P' carry a non-numeric ``reportCount``
    text (a record the upstream pipeline would abort on), and ``CVE_DAMAGE``
    breaks other records.
    """
    refs = reference_counts(lineitem)
    o = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                      "o_orderstatus").repartition("o_orderkey")
    j = o.join(refs, o.o_orderkey == refs.l_orderkey, "left")
    k = F.col("o_orderkey")
    cve_id = F.concat(F.lit(FIXTURE_CVE_PREFIX), k.cast("string"))
    score = (F.round(F.col("o_totalprice") * 100).cast("bigint") % 101) / F.lit(10.0)
    band = (F.when(score >= 9, "CRITICAL").when(score >= 7, "HIGH")
            .when(score >= 4, "MEDIUM").otherwise("LOW"))
    cvss = F.array(F.struct(F.struct(score.alias("baseScore"),
                                     band.alias("baseSeverity")).alias("cvssData")))
    empty_cvss = F.expr(f"cast(array() as array<{_CVSS}>)")
    # Cascade coverage: V3.1 present / V3.1 empty and V3.0 present / only V2.
    m3 = k % 3
    metrics = F.struct(
        F.when(m3 == 0, cvss).when(m3 == 1, empty_cvss).alias("cvssMetricV31"),
        F.when(m3 == 1, cvss).alias("cvssMetricV30"),
        F.when(m3 == 2, cvss).alias("cvssMetricV2"),
    )
    n_refs = F.coalesce(F.col("n_refs"), F.lit(0))
    n_exploit = F.coalesce(F.col("n_exploit"), F.lit(0))
    url = F.concat(F.lit("https://advisories.example/"), cve_id)
    exploit_ref = F.struct(url.alias("url"), F.array(F.lit("Exploit")).alias("tags"))
    patch_ref = F.struct(url.alias("url"), F.array(F.lit("Patch")).alias("tags"))
    references = F.concat(F.array_repeat(exploit_ref, n_exploit.cast("int")),
                          F.array_repeat(patch_ref, (n_refs - n_exploit).cast("int")))
    day = F.date_sub(F.to_date(F.lit(FIXTURE_ANCHOR_DATE)), (k % 365).cast("int")).cast("timestamp_ntz")
    date = iso_text_ms(day)
    # last change: absent, zoned, offset, in the future, compact, no date, empty, else a day after publication
    m11 = k % 11
    changed = (F.when(m11 == 0, F.lit(None).cast("string"))
               .when(m11 == 3, F.concat(date, F.lit("Z")))
               .when(m11 == 4, F.concat(date, F.lit("+02:00")))
               .when(m11 == 5, F.lit("2024-03-01T00:00:00.000"))
               .when(m11 == 6, F.date_format(day, "yyyyMMdd'T'HHmmss"))
               .when(m11 == 7, F.lit("not-a-date"))
               .when(m11 == 8, F.lit(""))
               .otherwise(iso_text_ms(day + F.expr("INTERVAL 1 DAY"))))
    # report count: absent, a number, or the text of one
    m13 = k % 13
    reports = (F.when(m13 == 0, (k % 50).cast("string"))
               .when(m13 == 1, F.concat(F.lit('"'), (k % 40).cast("string"), F.lit('"'))))
    if defects:
        reports = F.when(F.col("o_orderstatus") == "P", F.lit('"n/a"')).otherwise(reports)
    descriptions = F.array(
        F.struct(F.lit("es").alias("lang"),
                 F.concat(F.lit("Pedido "), k.cast("string")).alias("value")),
        F.struct(F.lit("en").alias("lang"),
                 F.concat(F.lit("Order "), k.cast("string"), F.lit(" "),
                          F.col("o_orderpriority"), F.lit(": "),
                          F.repeat(F.lit("lorem ipsum "), (F.lit(30) + k % 20).cast("int"))
                          ).alias("value")))
    cwe = _pick(k % 5, FIXTURE_CWE_BY_KEY_MOD5)
    english = F.struct(F.lit("en").alias("lang"), cwe.alias("value"))
    spanish = F.struct(F.lit("es").alias("lang"), F.lit("CWE-000").alias("value"))
    weakness = F.array(F.struct(F.when(k % 10 < 5, F.array(spanish, english)).otherwise(F.array(english))
                                .alias("description")))
    weaknesses = F.when(k % 5 == 4, F.expr(
        "cast(array() as array<struct<description:array<struct<lang:string,value:string>>>>)")
    ).otherwise(weakness)
    vendor = F.when(k % 7 != 0, F.concat(F.lit("vendor-"), (F.col("o_custkey") % 8).cast("string")))
    cve = F.struct(
        cve_id.alias("id"), date.alias("published"), changed.alias("lastModified"),
        descriptions.alias("descriptions"), metrics.alias("metrics"),
        weaknesses.alias("weaknesses"), references.alias("references"),
        vendor.alias("vendor"), F.parse_json(reports).alias("reportCount"))
    raw = F.to_json(F.struct(cve.alias("cve")))
    return j.select(k.alias("seq"), (_damaged(raw, k, CVE_DAMAGE) if defects else raw).alias("raw"))


#: key modulo 17 -> (text in the record, text put in its place); None cuts the record's last character
CVE_DAMAGE = {3: None, 5: ('"cve":{', '"cvx":{'), 7: ('"id":"', '"idx":"'),
              9: ('"descriptions":[', '"descriptions":null,"x":['), 11: ('"metrics":{', '"metrics":5,"x":{'),
              13: ('"references":[', '"references":"none","x":['), 15: ('"weaknesses":[', '"weaknesses":"CWE-79","x":[')}
IP_DAMAGE = {3: None, 4: ('"totalReports":', '"totalReports":null,"x":'), 6: ('"ipAddress":', '"addr":'),
             8: ('{"', '[{"')}


def _damaged(raw: Column, key: Column, rules: dict) -> Column:
    out = raw
    for m, change in rules.items():
        bad = F.substring(raw, F.lit(1), F.length(raw) - 1) if change is None else F.replace(
            raw, F.lit(change[0]), F.lit(change[1]))
        if change is not None and change[1].startswith("["):
            bad = F.concat(bad, F.lit("]"))
        out = F.when(key % 17 == m, bad).otherwise(out)
    return out


def ip_address(user_id: Column) -> Column:
    return F.concat((F.lit(10) + F.floor(user_id / 65536)).cast("string"), F.lit("."), (user_id % 7).cast("string"),
                    F.lit("."), (F.floor(user_id / 256) % 256).cast("string"), F.lit("."),
                    (user_id % 256).cast("string"))


def ip_records(events: DataFrame, defects: bool = False) -> DataFrame:
    """(seq, raw) — one raw address report per event.

    ``defects``: 'error' events carry their confidence as JSON text, which the
    reports format does not allow (the record is skipped upstream).
    """
    u = F.col("user_id")
    conf = F.floor(F.col("value")).cast("bigint") % 101
    if defects:
        conf = F.parse_json(F.when(F.col("event_type") == "error",
                                   F.concat(F.lit('"'), conf.cast("string"), F.lit('"')))
                            .otherwise(conf.cast("string")))
    rec = F.struct(
        ip_address(u).alias("ipAddress"),
        conf.alias("abuseConfidenceScore"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("totalReports"),
        iso_text_ms(F.col("ts")).alias("lastReportedAt"),
        _pick(u % 4, FIXTURE_COUNTRY_BY_USER_MOD4).alias("countryCode"),
        F.col("event_type").alias("isp"),
        F.lit(False).alias("isWhitelisted"),
    )
    return events.repartition("event_id").select((F.lit(IP_SEQ_BASE) + F.col("event_id")).alias("seq"),
                         (_damaged(F.to_json(rec), F.col("event_id"), IP_DAMAGE) if defects else F.to_json(rec)).alias("raw"))


def raw_feeds(spark: SparkSession, sf_dir: str, defects: bool = False
              ) -> tuple[DataFrame, DataFrame]:
    """(cve_raw, ip_raw) from the driver tables at ``sf_dir``."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice",
                        "o_orderpriority", "o_orderstatus")
    lineitem = read_table(spark, sf_dir, "lineitem",
                          "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    events = read_table(spark, sf_dir, "events",
                        "event_id", "ts", "user_id", "event_type", "value", "props")
    return cve_records(orders, lineitem, defects), ip_records(events, defects)
