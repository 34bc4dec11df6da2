"""vigil — a Spark-native indicator-prioritisation engine.

Raw vulnerability records and malicious-address reports (nested JSON) are
normalised into one common schema, deduplicated per indicator, upserted into
a snapshot table, turned into scaled and time-decayed features, labelled by a
documented heuristic, used to train ``pyspark.ml`` classifiers and served
through ranking / paging / lookup queries.  Every step is a DataFrame job.
"""

__version__ = "0.1.0"
