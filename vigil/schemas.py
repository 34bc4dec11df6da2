"""Struct types of the common schema, the stored snapshot and the features."""
from pyspark.sql import types as T

EXTRA = T.StructType([
    T.StructField("vendor", T.StringType()),
    T.StructField("cwe", T.StringType()),
    T.StructField("reference_count", T.LongType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("isp", T.StringType()),
])

COMMON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("threat_type", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("severity_raw", T.DoubleType()),
    T.StructField("report_count", T.LongType()),
    T.StructField("first_seen", T.StringType()),
    T.StructField("last_seen", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_reliability", T.DoubleType()),
    T.StructField("exploited_flag", T.BooleanType()),
    T.StructField("extra", EXTRA),
])

# Normalised rows also carry their input position, used for tie-breaks.
NORMALIZED = T.StructType(list(COMMON.fields) + [T.StructField("seq", T.LongType())])

# Snapshot table: common fields (exploited as int), write-back columns and
# the insertion order (batch_id, seq) that stands in for table row order.
STORED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("threat_type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("severity_raw", T.DoubleType()),
    T.StructField("report_count", T.LongType()),
    T.StructField("first_seen", T.StringType()),
    T.StructField("last_seen", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_reliability", T.DoubleType()),
    T.StructField("exploited_flag", T.IntegerType()),
    T.StructField("extra", EXTRA),
    T.StructField("predicted_priority", T.StringType()),
    T.StructField("predicted_priority_score", T.DoubleType()),
    T.StructField("heuristic_label", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("seq", T.LongType()),
])
STORED_FIELDS = [f.name for f in STORED.fields]

# Columns an upsert of an existing id replaces; the rest are kept.
UPSERT_OVERWRITE = [
    "title", "description", "severity_raw", "report_count", "last_seen",
    "source_reliability", "exploited_flag", "extra",
]
UPSERT_KEEP = ["threat_type", "first_seen", "source", "predicted_priority",
               "predicted_priority_score", "heuristic_label", "batch_id", "seq"]
