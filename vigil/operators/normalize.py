"""Raw feed records → the common 12-field schema (plus ``seq``), with a quarantine.

Input frames have ``(seq bigint, raw string)``: one JSON document per row.
Every rule is a column expression over a VARIANT, so a record is parsed once
and mapped in one projection; nothing leaves the JVM.

Reject handling.  The reference skips a record on KeyError / TypeError /
IndexError and aborts the whole run on other errors.  Here every failing
record gets a ``reject_reason``; reasons that would have aborted the run are
prefixed ``fatal:``.  ``split_rejects(strict=True)`` raises on those instead.
"""
from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.functions import variant as V

FATAL = "fatal:"


def reliability_of(source: Column) -> Column:
    """Source reliability lookup from the fixed literal map."""
    m = F.create_map(*[x for k, v in C.SOURCE_RELIABILITY.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, source)


def _first_reason(*pairs: tuple[Column, str]) -> Column:
    out = None
    for cond, reason in pairs:
        out = F.when(cond, F.lit(reason)) if out is None else out.when(cond, F.lit(reason))
    return out


def _first_true(arr: Column, pred) -> Column:
    """1-based position of the first element satisfying ``pred`` (0 = none)."""
    return F.coalesce(F.array_position(F.transform(arr, pred), True), F.lit(0))


def _first_en(elems: Column) -> tuple[Column, Column]:
    """(position of the first object element whose lang is 'en', position of the
    first non-object element) — iteration stops at the first English entry."""
    en = _first_true(elems, lambda e: V.is_object(e)
                     & (F.coalesce(V.as_string(V.field(e, "$.lang")), F.lit("")) == "en"))
    bad = _first_true(elems, lambda e: ~V.is_object(e))
    return en, bad


def _stops_before(err_pos: Column, hit_pos: Column) -> Column:
    """An error at ``err_pos`` is reached before the scan stops at ``hit_pos``."""
    return (err_pos > 0) & ((hit_pos == 0) | (err_pos < hit_pos))


def _c(name: str) -> Column:
    return F.col(name)


_EMPTY_VARIANTS = "cast(array() as array<variant>)"
_LANG_VALUE = "array<struct<lang:string,value:string>>"
_REF_TAGS = "array<struct<tags:array<string>>>"


def _no_nulls(arr: Column) -> Column:
    return F.size(F.array_compact(arr)) == F.size(arr)


def _typed_ok(arr: Column) -> Column:
    """The typed cast succeeded and has no NULL entries (every entry an object)."""
    return arr.isNotNull() & _no_nulls(arr)


# A vulnerability record without oddities, read in one walk over the document.  What may be absent or of another type
# without a reject stays a VARIANT.
_ENTRIES = "array<struct<lang:string,value:variant>>"
_SCORES = "array<struct<cvssData:struct<baseScore:variant>>>"
_PLAIN_CVE = (f"struct<id:string,published:string,lastModified:variant,vendor:variant,reportCount:variant,descriptions:{_ENTRIES},"
              f"metrics:struct<cvssMetricV31:{_SCORES},cvssMetricV30:{_SCORES},cvssMetricV2:{_SCORES}>,"
              f"references:{_REF_TAGS},weaknesses:array<struct<description:{_ENTRIES}>>>")


def _all_lang(entries: Column) -> Column:
    """Every entry has a language, so is an object (``array_contains`` is NULL where a language is)."""
    return F.coalesce(~F.array_contains(entries.getField("lang"), "\u0000"), F.lit(False))


def _english(entries: Column) -> tuple[Column, Column]:
    """(position of the first English entry or 0, its value)"""
    pos = F.coalesce(F.array_position(entries.getField("lang"), "en"), F.lit(0))
    return pos, F.get(entries, pos - 1).getField("value")


def _plain_stages() -> tuple[list[dict[str, Column]], dict[str, Column]]:
    """(stages, common-schema columns) of the records that ``_plain`` is true for.

    Such a record casts to ``_PLAIN_CVE`` without a NULL where a missing key, a JSON null and a value of another type
    differ, and has nothing that rejects it.  The last stage takes the document of a plain record away, so the stages after it cost it nothing;
    any other record keeps its document and is decided by them.
    """
    def t(name: str) -> Column:
        return _c("_t").getField(name)

    # a NULL inside the cast is an absent key, a JSON null or a value of another type; only the last one is chosen, and odd
    m_ok, chosen, scored = F.when(t("metrics").isNull(), F.lit(False)), F, F.lit(False)
    for name in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2"):
        m = t("metrics").getField(name)
        some, there = F.size(m) > 0, V.field(_c("_v"), f"$.cve.metrics.{name}")
        chosen, scored = chosen.when(some, F.get(m, 0)), scored | F.coalesce(some, F.lit(False))
        m_ok = m_ok.when(some, F.lit(True)).when(m.isNull() & V.present(there), F.lit(False))
    m_ok = m_ok.otherwise(F.lit(True))
    d_en, d_val = _english(t("descriptions"))
    p1 = {"_t": F.try_variant_get(_c("_v"), "$.cve", _PLAIN_CVE)}
    p2 = {
        "_p_id": t("id"), "_p_pub": t("published"), "_p_lm": t("lastModified"), "_p_vend": t("vendor"), "_p_rc": t("reportCount"),
        "_p_d_ok": _all_lang(t("descriptions")), "_p_d_en": d_en, "_p_d": d_val,
        "_p_m_ok": m_ok, "_p_scored": scored, "_p_cvss": chosen.getField("cvssData"),
        "_p_tags": F.flatten(t("references").getField("tags")), "_p_refs": F.size(t("references")).cast("bigint"),
        "_p_weak": F.size(t("weaknesses")), "_p_w": F.get(t("weaknesses"), 0).getField("description"),
    }
    w_en, w_val = _english(_c("_p_w"))
    base = _c("_p_cvss").getField("baseScore")
    p3 = {
        "_p_cwe": (F.when((_c("_p_weak") == 0) | (w_en == 0) | V.missing(w_val), F.lit("unknown"))
                   .otherwise(V.as_string(w_val))),
        "_p_score": F.when(~_c("_p_scored") | V.missing(base), F.lit(0.0)).otherwise(V.as_double(base)),
        "_p_rc_long": F.when(V.missing(_c("_p_rc")), _c("_p_refs")).otherwise(V.as_long(_c("_p_rc"))),
        "_p_text": (F.when((_c("_p_d_en") == 0) | V.missing(_c("_p_d")), F.lit(""))
                    .when(V.is_string(_c("_p_d")), V.as_string(_c("_p_d")))),
        "_p_last": F.when(V.missing(_c("_p_lm")), _c("_p_pub")).otherwise(V.as_string(_c("_p_lm"))),
        "_p_vendor": F.when(V.missing(_c("_p_vend")), F.lit("unknown")).otherwise(V.as_string(_c("_p_vend"))),
        "_p_exploited": F.coalesce(F.array_contains(_c("_p_tags"), "Exploit"), F.lit(False)),
        "_p_ok": (_c("_p_d_ok") & _c("_p_m_ok") & (~_c("_p_scored") | _c("_p_cvss").isNotNull())
                  & F.coalesce((_c("_p_weak") == 0) | _all_lang(_c("_p_w")), F.lit(False))),
    }
    p4 = {"_plain": (_c("_p_id").isNotNull() & _c("_p_pub").isNotNull() & _c("_p_tags").isNotNull() & _c("_p_ok")
                     & _c("_p_score").isNotNull() & _c("_p_rc_long").isNotNull() & _c("_p_text").isNotNull())}
    p5 = {"_v": F.when(~_c("_plain"), _c("_v"))}
    columns = {
        "id": _c("_p_id"), "title": _c("_p_id"),
        "description": F.substring(_c("_p_text"), 1, C.DESCRIPTION_MAX_CHARS),
        "severity_raw": _c("_p_score"), "report_count": _c("_p_rc_long"), "first_seen": _c("_p_pub"), "last_seen": _c("_p_last"),
        "exploited_flag": _c("_p_exploited"),
        "extra": F.struct(_c("_p_vendor").alias("vendor"), _c("_p_cwe").alias("cwe"), _c("_p_refs").alias("reference_count"),
                          F.lit(None).cast("string").alias("country_code"), F.lit(None).cast("string").alias("isp")),
        "reject_reason": F.lit(None).cast("string"),
    }
    return [p1, p2, p3, p4, p5], columns


def _cve_stages() -> list[dict[str, Column]]:
    """Staged projections: each intermediate value is a named column, computed once.

    (A single projection would inline every shared sub-expression into each
    consumer, multiplying the expression tree; named stages keep it linear.)
    """
    s1 = {"_cve": V.field(_c("_v"), "$.cve")}
    s2 = {
        "_id": V.field(_c("_cve"), "$.id"),
        "_d": V.field(_c("_cve"), "$.descriptions"),
        "_m": V.field(_c("_cve"), "$.metrics"),
        "_r": V.field(_c("_cve"), "$.references"),
        "_rc": V.field(_c("_cve"), "$.reportCount"),
        "_pub": V.field(_c("_cve"), "$.published"),
        "_lm": V.field(_c("_cve"), "$.lastModified"),
        "_vend": V.field(_c("_cve"), "$.vendor"),
        "_w": V.field(_c("_cve"), "$.weaknesses"),
        "_head": _first_reason((_c("_v").isNull(), "unparsable_json"),
                               (~V.is_object(_c("_v")) | ~V.is_object(_c("_cve")), "missing_cve")),
    }
    s3 = {
        "_d_arr": V.as_array(_c("_d")),
        "_r_arr": V.as_array(_c("_r")),
        "_w_arr": V.as_array(_c("_w")),
        "_m31": V.field(_c("_m"), "$.cvssMetricV31"),
        "_m30": V.field(_c("_m"), "$.cvssMetricV30"),
        "_m2": V.field(_c("_m"), "$.cvssMetricV2"),
        "_rc_long": V.as_long(_c("_rc")),
    }
    s3b = {
        "_d_typed": F.try_variant_get(_c("_d"), "$", _LANG_VALUE),
        "_r_typed": F.try_variant_get(_c("_r"), "$", _REF_TAGS),
        "_d_elems": F.coalesce(_c("_d_arr"), F.expr(_EMPTY_VARIANTS)),
        "_r_elems": F.coalesce(_c("_r_arr"), F.expr(_EMPTY_VARIANTS)),
        "_w_on": V.py_truthy(_c("_w")),
        "_w0": F.get(_c("_w_arr"), 0),
    }

    def tag_hit(ref: Column) -> Column:
        tags = V.field(ref, "$.tags")
        return (F.when(~V.is_object(ref), F.lit(None).cast("boolean"))
                .when(V.missing(tags), F.lit(False))
                .when(V.is_array(tags),
                      F.exists(V.as_array(tags), lambda t: F.coalesce(
                          V.as_string(t) == "Exploit", F.lit(False))))
                .when(V.scalar_kind(tags) == "STRING", V.as_string(tags).contains("Exploit"))
                .when(V.is_object(tags), F.map_contains_key(V.as_object(tags), "Exploit"))
                .otherwise(F.lit(None).cast("boolean")))

    # Fast path: a well-formed array casts to a typed array of structs, and the
    # scans become code-generated array functions.  Anything else (non-object
    # entries, NULL or missing tags, string tags …) takes the lambda path,
    # which CASE WHEN evaluates only for those rows.
    r_tags = _c("_r_typed").getField("tags")
    fast_r = (_c("_r_typed").isNotNull() & _no_nulls(_c("_r_typed")) & _no_nulls(r_tags))
    hits = F.transform(_c("_r_elems"), tag_hit)
    s4 = {
        "_d_en": F.when(_typed_ok(_c("_d_typed")),
                        F.coalesce(F.array_position(_c("_d_typed").getField("lang"), "en"), F.lit(0)))
                  .otherwise(_first_en(_c("_d_elems"))[0]),
        "_d_bad": F.when(_typed_ok(_c("_d_typed")), F.lit(0).cast("bigint"))
                   .otherwise(_first_en(_c("_d_elems"))[1]),
        "_chosen": (F.when(V.py_truthy(_c("_m31")), _c("_m31"))
                    .when(V.py_truthy(_c("_m30")), _c("_m30"))
                    .when(V.py_truthy(_c("_m2")), _c("_m2"))),
        "_r_hit": F.when(fast_r, F.when(F.coalesce(F.array_contains(F.flatten(r_tags), "Exploit"),
                                                    F.lit(False)), F.lit(1)).otherwise(F.lit(0))
                         .cast("bigint"))
                   .otherwise(F.coalesce(F.array_position(hits, True), F.lit(0))),
        "_r_err": F.when(fast_r, F.lit(0).cast("bigint"))
                   .otherwise(_first_true(hits, lambda h: h.isNull())),
        "_w_desc": V.field(_c("_w0"), "$.description"),
    }
    s5 = {
        "_d_val": V.field(F.get(_c("_d_elems"), _c("_d_en") - 1), "$.value"),
        "_chosen_arr": V.as_array(_c("_chosen")),
        "_w_desc_arr": V.as_array(_c("_w_desc")),
        "_w_typed": F.try_variant_get(_c("_w_desc"), "$", _LANG_VALUE),
    }
    s5b = {
        "_metric0": F.get(_c("_chosen_arr"), 0),
        "_w_elems": F.coalesce(_c("_w_desc_arr"), F.expr(_EMPTY_VARIANTS)),
    }
    s6 = {
        "_cvss": V.field(_c("_metric0"), "$.cvssData"),
        "_w_en": F.when(_typed_ok(_c("_w_typed")),
                        F.coalesce(F.array_position(_c("_w_typed").getField("lang"), "en"), F.lit(0)))
                  .otherwise(_first_en(_c("_w_elems"))[0]),
        "_w_bad": F.when(_typed_ok(_c("_w_typed")), F.lit(0).cast("bigint"))
                   .otherwise(_first_en(_c("_w_elems"))[1]),
    }
    s7 = {
        "_base": V.field(_c("_cvss"), "$.baseScore"),
        "_w_val": V.field(F.get(_c("_w_elems"), _c("_w_en") - 1), "$.value"),
    }
    s8 = {"_base_d": V.as_double(_c("_base"))}

    d, d_en, d_val = _c("_d"), _c("_d_en"), _c("_d_val")
    d_reject = _first_reason(
        (V.json_null(d), "bad_descriptions"),
        (V.present(d) & _c("_d_arr").isNull(), "bad_descriptions"),
        (_stops_before(_c("_d_bad"), d_en), FATAL + "bad_description_entry"),
        ((d_en > 0) & V.present(d_val) & ~V.is_string(d_val), "bad_description"),
        ((d_en > 0) & V.json_null(d_val), "bad_description"),
    )
    m, chosen, cvss, base = _c("_m"), _c("_chosen"), _c("_cvss"), _c("_base")
    on = chosen.isNotNull()
    m_reject = _first_reason(
        (V.json_null(m), "bad_metrics"),
        (V.present(m) & ~V.is_object(m) & ~V.is_array(m) & ~V.is_string(m), "bad_metrics"),
        (on & _c("_chosen_arr").isNull(), "bad_metrics"),
        (on & ~V.is_object(_c("_metric0")), "bad_metrics"),
        (on & V.missing(cvss), "bad_metrics"),
        (on & ~V.is_object(cvss), FATAL + "bad_cvss_data"),
        (on & V.json_null(base), "bad_base_score"),
        (on & V.present(base) & _c("_base_d").isNull() & V.is_string(base),
         FATAL + "bad_base_score"),
        (on & V.present(base) & _c("_base_d").isNull(), "bad_base_score"),
    )
    r, r_hit, r_err = _c("_r"), _c("_r_hit"), _c("_r_err")
    r_reject = _first_reason(
        (V.json_null(r), "bad_references"),
        (V.present(r) & _c("_r_arr").isNull(), "bad_references"),
        (_stops_before(r_err, r_hit), "bad_reference_tags"),
    )
    rc, rc_long = _c("_rc"), _c("_rc_long")
    rc_reject = _first_reason(
        (V.json_null(rc), "bad_report_count"),
        (V.present(rc) & rc_long.isNull() & V.is_string(rc), FATAL + "bad_report_count"),
        (V.present(rc) & rc_long.isNull(), "bad_report_count"),
    )
    w, w_on, w_desc = _c("_w"), _c("_w_on"), _c("_w_desc")
    w_reject = _first_reason(
        (w_on & V.is_object(w), "bad_weaknesses"),
        (w_on & _c("_w_arr").isNull() & V.is_string(w), FATAL + "bad_weaknesses"),
        (w_on & _c("_w_arr").isNull(), "bad_weaknesses"),
        (w_on & ~V.is_object(_c("_w0")), FATAL + "bad_weakness_entry"),
        (w_on & V.json_null(w_desc), "bad_weakness_description"),
        (w_on & V.present(w_desc) & _c("_w_desc_arr").isNull(), "bad_weakness_description"),
        (w_on & _stops_before(_c("_w_bad"), _c("_w_en")), FATAL + "bad_weakness_description"),
    )
    reject = F.coalesce(
        _c("_head"), _first_reason((V.missing(_c("_id")), "missing_id")),
        d_reject, m_reject, r_reject, rc_reject, w_reject)

    description = (F.when(d_en == 0, F.lit("")).when(V.missing(d_val), F.lit(""))
                   .otherwise(V.as_string(d_val)))
    base_score = (F.when(chosen.isNull(), F.lit(0.0)).when(V.missing(base), F.lit(0.0))
                  .otherwise(_c("_base_d")))
    n_refs = F.size(_c("_r_elems")).cast("bigint")
    exploited = (r_hit > 0) & ((r_err == 0) | (r_hit < r_err))
    report_count = F.when(V.missing(rc), n_refs).otherwise(rc_long)
    published = F.when(V.missing(_c("_pub")), F.lit("")).otherwise(V.as_string(_c("_pub")))
    last_modified = F.when(V.missing(_c("_lm")), published).otherwise(V.as_string(_c("_lm")))
    vendor = F.when(V.missing(_c("_vend")), F.lit("unknown")).otherwise(V.as_string(_c("_vend")))
    w_val = _c("_w_val")
    cwe = (F.when(~w_on | (_c("_w_en") == 0), F.lit("unknown"))
           .when(V.missing(w_val), F.lit("unknown")).otherwise(V.as_string(w_val)))
    cve_id = V.as_string(_c("_id"))
    final = {
        "id": cve_id,
        "threat_type": F.lit(C.TYPE_CVE),
        "title": cve_id,
        "description": F.substring(description, 1, C.DESCRIPTION_MAX_CHARS),
        "severity_raw": base_score.cast("double"),
        "report_count": report_count,
        "first_seen": published,
        "last_seen": last_modified,
        "source": F.lit(C.SOURCE_CVE),
        "source_reliability": reliability_of(F.lit(C.SOURCE_CVE)),
        "exploited_flag": exploited,
        "extra": F.struct(vendor.alias("vendor"), cwe.alias("cwe"),
                          n_refs.alias("reference_count"),
                          F.lit(None).cast("string").alias("country_code"),
                          F.lit(None).cast("string").alias("isp")),
        "reject_reason": reject,
    }
    first, plain = _plain_stages()
    final |= {c: F.when(_c("_plain"), v).otherwise(final[c]) for c, v in plain.items()}
    return [*first, s1, s2, s3, s3b, s4, s5, s5b, s6, s7, s8, final]


def _py_str(v: Column) -> Column:
    """str() of a JSON scalar as Python prints it (True/False capitalised)."""
    kind = V.scalar_kind(v)
    return (F.when(kind == "BOOLEAN", F.initcap(V.as_string(v)))
            .otherwise(V.as_string(v)))


def _ip_stages() -> list[dict[str, Column]]:
    v = _c("_v")
    s1 = {"_ip": V.field(v, "$.ipAddress"), "_conf": V.field(v, "$.abuseConfidenceScore"),
          "_tot": V.field(v, "$.totalReports"), "_last": V.field(v, "$.lastReportedAt")}
    return [s1, _ip_final(v, _c("_ip"), _c("_conf"), _c("_tot"), _c("_last"))]


def _ip_final(v: Column, ip: Column, conf_v: Column, tot_v: Column, last_v: Column
              ) -> dict[str, Column]:
    conf = F.when(V.missing(conf_v), F.lit(0.0)).otherwise(V.as_double(conf_v))
    conf_txt = F.when(V.missing(conf_v), F.lit("0")).otherwise(_py_str(conf_v))
    total = F.when(V.missing(tot_v), F.lit(0).cast("bigint")).otherwise(V.as_long(tot_v))
    tot_txt = F.when(V.missing(tot_v), F.lit("0")).otherwise(_py_str(tot_v))
    last = F.when(V.missing(last_v), F.lit("")).otherwise(V.as_string(last_v))
    ip_id = V.as_string(ip)
    reject = _first_reason(
        (v.isNull(), "unparsable_json"),
        (~V.is_object(v), "bad_record"),
        (V.missing(ip), "missing_id"),
        (V.present(conf_v) & ~V.is_number(conf_v), "bad_confidence"),
        (V.json_null(conf_v), "bad_confidence"),
        (V.json_null(tot_v), "bad_total_reports"),
        (V.present(tot_v) & V.as_long(tot_v).isNull() & V.is_string(tot_v),
         FATAL + "bad_total_reports"),
        (V.present(tot_v) & V.as_long(tot_v).isNull(), "bad_total_reports"),
    )
    return {
        "id": ip_id,
        "threat_type": F.lit(C.TYPE_IP),
        "title": F.concat(F.lit("Malicious IP "), F.coalesce(ip_id, F.lit("None"))),
        "description": F.concat(F.lit("IP reported "), F.coalesce(tot_txt, F.lit("None")),
                                F.lit(" times with "), F.coalesce(conf_txt, F.lit("None")),
                                F.lit("% abuse confidence.")),
        "severity_raw": F.round((conf / F.lit(100.0)) * F.lit(10.0), 2),
        "report_count": total,
        "first_seen": last,
        "last_seen": last,
        "source": F.lit(C.SOURCE_IP),
        "source_reliability": reliability_of(F.lit(C.SOURCE_IP)),
        "exploited_flag": F.lit(False),
        "extra": F.struct(F.lit(None).cast("string").alias("vendor"),
                          F.lit(None).cast("string").alias("cwe"),
                          F.lit(None).cast("bigint").alias("reference_count"),
                          V.as_string(V.field(v, "$.countryCode")).alias("country_code"),
                          V.as_string(V.field(v, "$.isp")).alias("isp")),
        "reject_reason": reject,
    }


OUTPUT = ["id", "threat_type", "title", "description", "severity_raw", "report_count",
          "first_seen", "last_seen", "source", "source_reliability", "exploited_flag",
          "extra", "seq", "reject_reason"]


_OBSERVATIONS = itertools.count(1)
_STAGES: dict = {}


def _stages(name: str, builder) -> list[dict[str, Column]]:
    """Stage expressions are unresolved Columns, reusable by any DataFrame:
    build them once per JVM (thousands of py4j calls) instead of per query."""
    from pyspark import SparkContext
    # keyed by the gateway itself: a restarted one can't be taken for an old one
    held = _STAGES.get(name)
    if held is None or held[0] is not SparkContext._gateway:
        held = _STAGES[name] = (SparkContext._gateway, builder())
    return held[1]


def _apply(raw: DataFrame, stages: list[dict[str, Column]], name: str) -> DataFrame:
    # landed readers hand on a VARIANT, everything else JSON text
    doc = F.col("raw") if raw.schema["raw"].dataType.typeName() == "variant" else V.parse(F.col("raw"))
    df = raw.select(F.col("seq"), doc.alias("_v"))
    for stage in stages[:-1]:
        df = df.withColumns(stage)
    final = stages[-1]
    out = df.select(*[final[c].alias(c) if c != "seq" else F.col("seq") for c in OUTPUT])
    # Row / reject counters (free: computed while the rows stream past).  The
    # CollectMetrics node is also a deliberate optimizer boundary: without it
    # a later ``reject_reason IS NULL`` filter is pushed through every staged
    # projection with all aliases inlined, growing the predicate exponentially.
    name = f"{name}_{next(_OBSERVATIONS)}"
    return out.observe(name, F.count(F.lit(1)).alias("records"),
                       F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))


def normalize_cve(raw: DataFrame) -> DataFrame:
    """(seq, raw) vulnerability records → common schema + seq + reject_reason."""
    return _apply(raw, _stages("cve", _cve_stages), "normalize_cve")


def normalize_ip(raw: DataFrame) -> DataFrame:
    """(seq, raw) address reports → common schema + seq + reject_reason."""
    return _apply(raw, _stages("ip", _ip_stages), "normalize_ip")


def normalize_batch(cve_raw: DataFrame, ip_raw: DataFrame) -> DataFrame:
    """UNION ALL of both feeds (vulnerability rows first by ``seq``), rejects included."""
    return normalize_cve(cve_raw).unionByName(normalize_ip(ip_raw))


def valid(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(normalized: DataFrame) -> DataFrame:
    """Rejected records with their reason (seq identifies the raw input row)."""
    return (normalized.filter(F.col("reject_reason").isNotNull())
            .select("seq", "source", "id", "reject_reason"))


def split_rejects(normalized: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine).  ``strict`` raises when a record would have
    aborted the reference run (one extra pass over the rejects only)."""
    q = quarantine(normalized)
    if strict:
        bad = q.filter(F.col("reject_reason").startswith(FATAL)).limit(1).collect()
        if bad:
            raise ValueError(f"malformed record at seq={bad[0]['seq']}: {bad[0]['reject_reason']}")
    return valid(normalized), q
