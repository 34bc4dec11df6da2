"""Heuristic priority labels over a feature frame."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import scoring as S


def _extra(df: DataFrame, name: str):
    # Works on both the stored layout (struct ``extra``) and the flat feature matrix.
    return F.col(f"extra.{name}") if "extra" in df.columns else F.col(name)


def apply_heuristic_labels(df: DataFrame) -> DataFrame:
    """Add ``priority_score`` and ``heuristic_label`` (built-in expressions, row-local)."""
    score = S.priority_score(
        F.col("severity_raw"), F.col("exploited_flag"), F.col("report_count_norm"),
        F.col("recency_score"), F.col("source_reliability"), _extra(df, "cwe"),
        _extra(df, "reference_count"), _extra(df, "country_code"))
    return df.withColumn("priority_score", score) \
             .withColumn("heuristic_label", S.bucket(F.col("priority_score")))


def label_counts(labeled: DataFrame) -> DataFrame:
    """Label distribution, most frequent first (a partial aggregate, four output rows)."""
    return (labeled.groupBy("heuristic_label").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("heuristic_label")))
