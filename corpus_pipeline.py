"""Corpus pipeline: language ID, SimHash near-dedup, decontamination, PII surrogates, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its
predecessor kept and returns a DataFrame, which ``run`` writes as Parquet in
the shared folder and reads again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.

Null and empty texts, repeated rows, empty tables and extra columns are treated
as the operators state; stages that keep rows keep extra columns untouched.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontam, langid, packing, pii, simhash
from vigil.llm.common import made, release, ship, staged, table
from vigil.llm.queries import TOKENIZER


_ROW = "_pipeline_row"


def _whole(docs: DataFrame) -> DataFrame:
    """Every row as one struct beside its text, so that a stage hands on whole rows without a join."""
    return docs.select(F.struct(*docs.columns).alias(_ROW), F.col("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without a letter (``und``) go.

    Learns from the labelled rows given, as the query does; a prediction uses
    the text alone.
    """
    ship(spark)
    model = langid.fit(docs.where(~langid.is_held_out("doc_id")))
    told = langid.predict(_whole(docs), model, id_col=_ROW)
    return told.where(F.col("lang_pred") != langid.UNDETERMINED).select(f"{_ROW}.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the least doc_id (null last, then any one row)."""
    ship(spark)
    rows = staged(docs.withColumn(_ROW, F.monotonically_increasing_id()), "pipeline-rows")
    n = rows.count()
    classes = simhash.near_duplicates(rows, id_col=_ROW)
    # the component's least row number names it; rows of one component may still differ in doc_id
    named = staged(classes.select(F.col("doc_id").alias(_ROW), "component_id"), "pipeline-classes", n)
    first = (rows.select(_ROW, "doc_id").join(named, _ROW)
             .groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", _ROW)).alias("first"))
             .select(F.col(f"first.{_ROW}").alias(_ROW)))
    # both sides are shuffled on the row number at every size: what stays is most of the table
    kept = staged(first, "pipeline-kept", n)
    return rows.join(kept.hint("merge"), _ROW, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    ship(spark)
    found = decontam.contamination(_whole(docs), table(spark, sf_dir, "benchmark"), id_col=_ROW)
    return found.where("n_hit = 0").select(f"{_ROW}.*")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; n_chars follows the text."""
    ship(spark)
    out = pii.anonymise(docs.withColumn("_others", F.struct(*[c for c in docs.columns if c != "text"])),
                        id_col="_others")
    kept = {c: F.col(f"_others.`{c}`").alias(c) for c in docs.columns if c != "text"}
    if "n_chars" in kept:
        kept["n_chars"] = F.when(F.size("entities") > 0, F.char_length("text").cast("long")) \
            .otherwise(F.col("_others.n_chars")).alias("n_chars")
    return out.select(*[F.col("text") if c == "text" else kept[c] for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, each with its sequence and offset."""
    import public_tokenizers

    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("PII", surrogates),
    ("best-fit packing", pack),
]

#: Fingerprints, frozen byte-context statistics, keyed surrogates and sub-word ids have no SQL form;
#: tests/llm checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), made()
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
        release(spark, mark)      # the stage's scratch tables and its predecessor's result
    return docs
