"""Feature matrix: fills, log + table-wide min–max, recency, country flag, one-hot."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.functions import scoring as S
from vigil.functions.dates import recency_score, to_epoch_micros
from vigil.schemas import EXTRA

CARRIED = ["id", "threat_type", "title"]
EXTRA_FIELDS = ["vendor", "cwe", "reference_count", "country_code", "isp"]


def fill_defaults(df: DataFrame) -> DataFrame:
    """report_count 0, exploited 0, severity 0.0, reliability 0.5."""
    return df.withColumns({
        "report_count": F.coalesce(F.col("report_count").cast("double"), F.lit(0.0)),
        "exploited_flag": F.coalesce(F.col("exploited_flag").cast("int"), F.lit(0)),
        "severity_raw": F.coalesce(F.col("severity_raw"), F.lit(0.0)),
        "source_reliability": F.coalesce(F.col("source_reliability"), F.lit(C.DEFAULT_RELIABILITY)),
    })


def parse_extra(text: Column) -> Column:
    """Extra JSON text → struct; empty, malformed or non-object text → all-NULL fields ({})."""
    parsed = F.from_json(text, EXTRA, {"mode": "PERMISSIVE"})
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in EXTRA.fields])
    return F.when(text.isNull() | (text == "") | parsed.isNull(), empty).otherwise(parsed)


def minmax_stats(df: DataFrame) -> DataFrame:
    """One-row table of the log-count bounds over the *whole* table (one shared aggregate)."""
    return df.agg(F.min("_lrc").alias("_rc_min"), F.max("_lrc").alias("_rc_max"),
                  F.min("_lref").alias("_ref_min"), F.max("_lref").alias("_ref_max"))


def _scaled(x: str, lo: str, hi: str) -> Column:
    return F.when(F.col(hi) > F.col(lo),
                  (F.col(x) - F.col(lo)) / (F.col(hi) - F.col(lo))).otherwise(F.lit(0.0))


def with_features(df: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Add the nine model features to a stored/common-schema frame (all columns kept).

    The two min–max features need table-wide bounds: one global aggregate
    produces a single row, which is broadcast into a cross join (size proven:
    exactly one row).  No ``Window.partitionBy()`` without keys, which would
    pull the table into one task.
    """
    now_us = to_epoch_micros(now)
    base = fill_defaults(df).withColumns({
        "_lrc": F.log1p(F.col("report_count")),
        "_lref": F.log1p(F.coalesce(F.col("extra.reference_count").cast("double"), F.lit(0.0))),
    })
    stats = minmax_stats(base)
    joined = base.crossJoin(F.broadcast(stats))
    return joined.withColumns({
        "report_count_norm": _scaled("_lrc", "_rc_min", "_rc_max"),
        "recency_score": recency_score(F.col("last_seen"), now_us),
        "reference_count_norm": _scaled("_lref", "_ref_min", "_ref_max"),
        "high_risk_country": S.high_risk_country(F.col("extra.country_code")).cast("int"),
        "is_cve": F.coalesce((F.col("threat_type") == C.TYPE_CVE).cast("int"), F.lit(0)),
        "is_malicious_ip": F.coalesce((F.col("threat_type") == C.TYPE_IP).cast("int"), F.lit(0)),
    }).drop("_lrc", "_lref", "_rc_min", "_rc_max", "_ref_min", "_ref_max")


def feature_matrix(df: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Carried columns, the extra fields (flattened) and the nine features in model order."""
    f = with_features(df, now)
    return f.select(*CARRIED, *[F.col(f"extra.{x}").alias(x) for x in EXTRA_FIELDS],
                    *C.FEATURE_COLS)
