"""Heuristic priority score: CWE tier, reference bonus, weighted sum, boost, bucket."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import constants as C


def cwe_risk(cwe: Column) -> Column:
    """1.0 high tier, 0.6 medium tier, 0.4 other named CWE, 0.2 unknown/generic/empty."""
    return (F.when(cwe.isin(*C.CWE_HIGH_RISK), F.lit(C.CWE_TIER_SCORE["high"]))
            .when(cwe.isin(*C.CWE_MEDIUM_RISK), F.lit(C.CWE_TIER_SCORE["medium"]))
            .when(cwe.isNotNull() & (cwe != "") & ~cwe.isin(*C.CWE_GENERIC),
                  F.lit(C.CWE_TIER_SCORE["named"]))
            .otherwise(F.lit(C.CWE_TIER_SCORE["generic"])))


def reference_bonus(ref_count: Column) -> Column:
    """min(1, log1p(n) / log1p(20)) on the raw reference count (missing = 0)."""
    n = F.coalesce(ref_count.cast("double"), F.lit(0.0))
    return F.least(F.lit(1.0), F.log1p(n) / F.lit(math.log1p(C.REFERENCE_BONUS_FULL_AT)))


def high_risk_country(country: Column) -> Column:
    return F.coalesce(country.isin(*C.HIGH_RISK_COUNTRIES), F.lit(False))


def geo_boost(country: Column, severity_raw: Column) -> Column:
    """+0.05 for a high-risk country with severity >= 4.0, else 0."""
    return F.when(high_risk_country(country) & (severity_raw >= F.lit(C.GEO_BOOST_MIN_SEVERITY)),
                  F.lit(C.GEO_BOOST)).otherwise(F.lit(0.0))


def weighted_sum(terms: dict[str, Column]) -> Column:
    """Sum weight·term left to right in the fixed order (float sums near a threshold depend on it)."""
    total = None
    for name, w in C.WEIGHTS:
        t = F.lit(w) * terms[name]
        total = t if total is None else total + t
    return total


def priority_score(severity_raw: Column, exploited: Column, report_count_norm: Column,
                   recency: Column, reliability: Column, cwe: Column, ref_count: Column,
                   country: Column) -> Column:
    raw = weighted_sum({
        "severity": severity_raw / F.lit(10.0),
        "exploited_flag": exploited.cast("double"),
        "report_count_norm": report_count_norm,
        "recency_score": recency,
        "source_reliability": reliability,
        "cwe_risk": cwe_risk(cwe),
        "reference_bonus": reference_bonus(ref_count),
    }) + geo_boost(country, severity_raw)
    return clamp01(raw)


def clamp01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def bucket(score: Column) -> Column:
    out = None
    for label, threshold in C.THRESHOLDS:
        out = (F.when(score >= F.lit(threshold), F.lit(label)) if out is None
               else out.when(score >= F.lit(threshold), F.lit(label)))
    return out.otherwise(F.lit(C.FALLBACK_LABEL))


def label_rank(label: Column) -> Column:
    """Ordinal rank Low 0 … Critical 3; NULL for anything else."""
    out = None
    for name in C.PRIORITY_LABELS:
        r = F.lit(C.SEVERITY_RANK[name])
        out = F.when(label == name, r) if out is None else out.when(label == name, r)
    return out


def rank_label(rank: Column) -> Column:
    out = None
    for name in C.PRIORITY_LABELS:
        r = C.SEVERITY_RANK[name]
        out = F.when(rank == r, F.lit(name)) if out is None else out.when(rank == r, F.lit(name))
    return out
