"""Registered queries: (spark, sf_dir) → DataFrame, one per operator key.

All of them read the driver tables through the fixture mapping and run over
the whole tables.  Output doubles are rounded to 6 decimals here (and only
here) so results compare exactly with the SQL oracles.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import constants as C
from vigil.functions import dates as D
from vigil.functions import scoring as S
from vigil.operators import dedup, features, labels
from vigil.operators import normalize as N
from vigil.plans import pipeline as P
from vigil.sources import fixtures as FX
from vigil.sources import store as ST

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (output presentation only)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def flat(df: DataFrame) -> DataFrame:
    """Replace the ``extra`` struct with its fields."""
    if "extra" not in df.columns:
        return df
    rest = [c for c in df.columns if c != "extra"]
    return df.select(*rest, *[F.col(f"extra.{x}").alias(x) for x in features.EXTRA_FIELDS])


def _feeds(spark: SparkSession, sf_dir: str):
    return P.landed_feeds(spark, sf_dir)


def _norm_cve(spark, sf_dir):
    return N.valid(N.normalize_cve(_feeds(spark, sf_dir)[0]))


def _norm_ip(spark, sf_dir):
    return N.valid(N.normalize_ip(_feeds(spark, sf_dir)[1]))


COMMON_OUT = ["id", "threat_type", "title", "description", "severity_raw", "report_count",
              "first_seen", "last_seen", "source", "source_reliability", "exploited_flag"]


def _common(df: DataFrame) -> DataFrame:
    return flat(df.select(*COMMON_OUT, "extra", "seq"))


# ---------------------------------------------------------------- normalise --
@query("normalize_cve")
def q_normalize_cve(spark, sf_dir):
    return finish(_common(_norm_cve(spark, sf_dir)))


@query("normalize_ip")
def q_normalize_ip(spark, sf_dir):
    return finish(_common(_norm_ip(spark, sf_dir)))


@query("normalize_union")
def q_normalize_union(spark, sf_dir):
    cve, ip = _feeds(spark, sf_dir)
    return finish(_common(N.valid(N.normalize_batch(cve, ip))))


@query("quarantine")
def q_quarantine(spark, sf_dir):
    return N.quarantine(N.normalize_batch(*P.landed_feeds(spark, sf_dir, defects=True)))


@query("first_en_description")
def q_first_en(spark, sf_dir):
    return _norm_cve(spark, sf_dir).select("id", "description")


@query("cvss_cascade")
def q_cvss(spark, sf_dir):
    return finish(_norm_cve(spark, sf_dir).select("id", "severity_raw"))


@query("exploited_flag")
def q_exploited(spark, sf_dir):
    return _norm_cve(spark, sf_dir).select("id", "exploited_flag")


@query("report_count_fallback")
def q_rc_fallback(spark, sf_dir):
    return _norm_cve(spark, sf_dir).select("id", "report_count",
                                            F.col("extra.reference_count").alias("reference_count"))


@query("date_fallback")
def q_date_fallback(spark, sf_dir):
    return _norm_cve(spark, sf_dir).select("id", "first_seen", "last_seen")


@query("extract_cwe")
def q_cwe(spark, sf_dir):
    return _norm_cve(spark, sf_dir).select("id", F.col("extra.cwe").alias("cwe"))


@query("rescale_confidence")
def q_rescale(spark, sf_dir):
    return finish(_norm_ip(spark, sf_dir).select("seq", "id", "severity_raw", "description"))


@query("source_reliability")
def q_reliability(spark, sf_dir):
    cve, ip = _feeds(spark, sf_dir)
    u = N.valid(N.normalize_batch(cve, ip))
    return finish(u.groupBy("source").agg(F.max("source_reliability").alias("source_reliability"),
                                          F.count(F.lit(1)).alias("n")))


# -------------------------------------------------------------------- dedup --
@query("dedup_latest")
def q_dedup(spark, sf_dir):
    cve, ip = _feeds(spark, sf_dir)
    return finish(_common(dedup.keep_latest(N.valid(N.normalize_batch(cve, ip)))))


# ----------------------------------------------------------------- features --
def _feat(spark, sf_dir):
    return features.with_features(P.fixture_snapshot(spark, sf_dir), FX.FIXTURE_NOW)


@query("fill_defaults")
def q_fill(spark, sf_dir):
    # every filled column has gaps, by rules on the position
    gaps = {"report_count": 5, "exploited_flag": 7, "severity_raw": 3, "source_reliability": 4}
    s = P.fixture_snapshot(spark, sf_dir)
    f = features.fill_defaults(s.withColumns({c: F.when(F.col("seq") % m != 0, F.col(c)) for c, m in gaps.items()}))
    return finish(f.select("id", "report_count", "exploited_flag", "severity_raw",
                           "source_reliability"))


@query("report_count_norm")
def q_rc_norm(spark, sf_dir):
    return finish(_feat(spark, sf_dir).select("id", "report_count", "report_count_norm"))


@query("reference_count_norm")
def q_ref_norm(spark, sf_dir):
    return finish(_feat(spark, sf_dir).select(
        "id", F.col("extra.reference_count").alias("reference_count"), "reference_count_norm"))


@query("parse_date")
def q_parse_date(spark, sf_dir):
    s = P.fixture_snapshot(spark, sf_dir)
    return s.select("id", "last_seen", D.parse_iso_micros(F.col("last_seen")).alias("last_seen_us"))


@query("recency_score")
def q_recency(spark, sf_dir):
    return finish(_feat(spark, sf_dir).select("id", "last_seen", "recency_score"))


@query("parse_extra")
def q_parse_extra(spark, sf_dir):
    s = P.fixture_snapshot(spark, sf_dir)
    # one text in six is empty, cut off or absent
    m, text = F.col("seq") % 6, F.to_json(F.col("extra"))
    parsed = features.parse_extra(F.when(m == 0, F.lit("")).when(m == 1, F.substring(text, F.lit(1), F.length(text) - 1))
                                  .when(m == 2, F.lit(None).cast("string")).otherwise(text))
    return s.select("id", *[parsed[x].alias(x) for x in features.EXTRA_FIELDS])


@query("high_risk_country")
def q_hrc(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", F.col("extra.country_code").alias("country_code"),
                                       "high_risk_country")


@query("type_onehot")
def q_onehot(spark, sf_dir):
    return _feat(spark, sf_dir).select("id", "threat_type", "is_cve", "is_malicious_ip")


@query("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    return finish(features.feature_matrix(P.fixture_snapshot(spark, sf_dir), FX.FIXTURE_NOW))


# ------------------------------------------------------------------- labels --
LABEL_OUT = ["id", "threat_type", "severity_raw", "exploited_flag", "report_count_norm",
             "recency_score", "source_reliability", "reference_count_norm",
             "high_risk_country", "is_cve", "is_malicious_ip", "priority_score",
             "heuristic_label"]


@query("label_all")
def q_label_all(spark, sf_dir):
    return finish(P.fixture_labelled(spark, sf_dir).select(*LABEL_OUT))


@query("cwe_risk")
def q_cwe_risk(spark, sf_dir):
    s = P.fixture_snapshot(spark, sf_dir)
    return finish(s.select("id", F.col("extra.cwe").alias("cwe"),
                           S.cwe_risk(F.col("extra.cwe")).alias("cwe_risk")))


@query("reference_bonus")
def q_ref_bonus(spark, sf_dir):
    s = P.fixture_snapshot(spark, sf_dir)
    return finish(s.select("id", F.col("extra.reference_count").alias("reference_count"),
                           S.reference_bonus(F.col("extra.reference_count")).alias("reference_bonus")))


@query("priority_score")
def q_score(spark, sf_dir):
    return finish(P.fixture_labelled(spark, sf_dir).select("id", "priority_score"))


@query("geo_boost")
def q_geo(spark, sf_dir):
    s = P.fixture_snapshot(spark, sf_dir)
    return finish(s.select("id", F.col("extra.country_code").alias("country_code"), "severity_raw",
                           S.geo_boost(F.col("extra.country_code"), F.col("severity_raw"))
                           .alias("geo_boost")))


@query("bucket")
def q_bucket(spark, sf_dir):
    return finish(P.fixture_labelled(spark, sf_dir).select("id", "priority_score", "heuristic_label"))


@query("label_counts")
def q_label_counts(spark, sf_dir):
    return labels.label_counts(P.fixture_labelled(spark, sf_dir))


# -------------------------------------------------------------------- store --
STORE_OUT = ["id", "threat_type", "title", "description", "severity_raw", "report_count",
             "first_seen", "last_seen", "source", "source_reliability", "exploited_flag",
             "predicted_priority", "predicted_priority_score", "heuristic_label",
             "batch_id", "seq"]


def _store_flat(df: DataFrame) -> DataFrame:
    return finish(flat(df.select(*STORE_OUT, "extra")))


@query("scan_threats")
def q_scan(spark, sf_dir):
    return _store_flat(P.fixture_snapshot(spark, sf_dir))


@query("count_threats")
def q_count(spark, sf_dir):
    st = P.fixture_store(spark, sf_dir)
    return ST.footer_stats(spark, st["root"], st["ingested"])


@query("upsert_threats")
def q_upsert(spark, sf_dir):
    return _store_flat(P.two_batch_store(spark, sf_dir))


@query("upsert_delta")
def q_upsert_delta(spark, sf_dir):
    """K2 on the stored table: one id in a hundred comes again with new values, and as many new ids; the buckets of these
    ids are rewritten, the others keep their files."""
    from vigil.operators import upsert as U
    root = P.write_copy(spark, sf_dir)
    old = P.fixture_snapshot(spark, sf_dir).filter(F.col("seq") % 100 == 7)
    changed = old.withColumns({"severity_raw": F.lit(9.75), "first_seen": F.lit("never"), "batch_id": F.lit(2).cast("bigint")})
    new = old.withColumns({"id": F.concat(F.lit("new-"), "id"), "batch_id": F.lit(2).cast("bigint")})
    U.upsert_into(spark, root, changed.unionByName(new), source="delta", batch_no=1)
    U.upsert_into(spark, root, changed.unionByName(new).withColumn("severity_raw", F.lit(0.0)), source="delta", batch_no=1)
    return finish(ST.scan(spark, root).select("id", "severity_raw", "first_seen", "batch_id", "seq"))


@query("write_labels")
def q_write_labels(spark, sf_dir):
    from vigil.operators import upsert as U
    root = P.write_copy(spark, sf_dir)
    lab = P.label_snapshot(ST.scan(spark, root), FX.FIXTURE_NOW).select("id", "heuristic_label")
    U.write_back_into(spark, root, lab, ["heuristic_label"])
    return ST.scan(spark, root).select("id", "threat_type", "heuristic_label", "predicted_priority")


# ------------------------------------------------------------------ serving --
from vigil.operators import serve as V  # noqa: E402

INSPECT_ID = "CVE-2025-1"


@query("summary")
def q_summary(spark, sf_dir):
    return V.summary(P.served_store(spark, sf_dir))


@query("distinct_types")
def q_types(spark, sf_dir):
    return V.distinct_types(P.served_store(spark, sf_dir))


@query("available_priorities")
def q_avail(spark, sf_dir):
    return V.available_priorities(P.served_store(spark, sf_dir))


@query("filter_threats")
def q_filter(spark, sf_dir):
    f = V.filter_threats(P.served_store(spark, sf_dir), [C.TYPE_CVE, C.TYPE_IP],
                         ["Critical", "High"])
    return finish(f.select("id", "threat_type", "predicted_priority", "predicted_priority_score"))


RANK_OUT = ["id", "threat_type", "predicted_priority", "predicted_priority_score", "position"]


@query("rank_threats")
def q_rank(spark, sf_dir):
    return finish(V.rank_threats(V.filter_threats(P.served_store(spark, sf_dir))))


@query("rank_threats_ascending")
def q_rank_asc(spark, sf_dir):
    return finish(V.rank_threats(V.filter_threats(P.served_store(spark, sf_dir)), desc=False))


@query("page")
def q_page(spark, sf_dir):
    return finish(V.page(V.filter_threats(P.served_store(spark, sf_dir)), 3, 25).select(*RANK_OUT))


@query("page_deep")
def q_page_deep(spark, sf_dir):
    return finish(V.page(V.filter_threats(P.served_store(spark, sf_dir)), 250, 50)
                  .select(*RANK_OUT))


_RANKINGS: dict = {}


@query("page_published")
def q_page_published(spark, sf_dir):
    """V5 and V6 from a ranking kept as a sorted table with a directory of its ranges (published once per session)."""
    import uuid

    from vigil.session import shared_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RANKINGS:
        path = shared_path(spark, "vigil-ranking", uuid.uuid4().hex)
        V.publish_ranking(V.filter_threats(P.served_store(spark, sf_dir)), path)
        _RANKINGS[key] = path
    return finish(V.published_page(spark, _RANKINGS[key], 250, 50).select(*RANK_OUT))


@query("page_hot")
def q_page_hot(spark, sf_dir):
    """V6 deep in a table where nine rows in ten have one score and label: found by counting, 400 rows sorted at most."""
    hot = V.filter_threats(P.served_store(spark, sf_dir)).withColumns({
        "predicted_priority": F.when(F.col("seq") % 10 != 0, F.lit("High")).otherwise(F.col("predicted_priority")),
        "predicted_priority_score": F.when(F.col("seq") % 10 != 0, F.lit(0.5)).otherwise(F.col("predicted_priority_score"))})
    return finish(V.page(hot, 40, 50, sort_rows=400).select(*RANK_OUT))


@query("page_info")
def q_page_info(spark, sf_dir):
    return V.page_info(V.filter_threats(P.served_store(spark, sf_dir)), 3, 25)


@query("display_projection")
def q_display(spark, sf_dir):
    pg = V.page(V.filter_threats(P.served_store(spark, sf_dir)), 2, 50)
    return V.display_projection(pg)


@query("inspect")
def q_inspect(spark, sf_dir):
    return V.inspect(V.filter_threats(P.served_lookup(spark, sf_dir, INSPECT_ID)), INSPECT_ID)


@query("entry_first_page")
def q_entry(spark, sf_dir):
    pg = V.page(V.filter_threats(P.served_store(spark, sf_dir)), 1, C.DEFAULT_PAGE_SIZE)
    return V.display_projection(pg)


# ----------------------------------------------------------------------- ML --
from vigil.operators import evaluate as EV  # noqa: E402
from vigil.operators import ml as ML  # noqa: E402
from vigil.operators import split as SP  # noqa: E402

_ML: dict = {}
Z = ML.Z_COLS


def _ml_data(spark, sf_dir) -> dict:
    """Labelled rows + split as a table, once per session: model fitting makes many
    passes and every evaluation query builds small plans on top."""
    import uuid

    from vigil.session import shared_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ML:
        path = shared_path(spark, f"vigil-split-{uuid.uuid4().hex}")
        SP.stratified_split(P.fixture_labelled(spark, sf_dir)).write.parquet(path)
        sp = spark.read.parquet(path)
        train = ML.with_label(sp.filter(~F.col("is_test")))
        weights = ML.weight_table(train)
        ML.require_classes(weights)
        _ML[key] = {"split": sp, "train": ML.with_weights(train, weights), "plain_train": train,
                    "test": ML.with_label(sp.filter(F.col("is_test"))), "stats": ML.scaler_values(train),
                    "models": {}, "n_train": train.count()}
    return _ML[key]


def _model(spark, sf_dir, name: str):
    d = _ml_data(spark, sf_dir)
    if name not in d["models"]:
        d["models"][name] = ML.fit_model(name, d["train"], d["stats"], d["n_train"])
    return d["models"][name]


def _test_predictions(spark, sf_dir, name: str) -> DataFrame:
    return _model(spark, sf_dir, name).transform(_ml_data(spark, sf_dir)["test"])


@query("stratified_split")
def q_split(spark, sf_dir):
    return _ml_data(spark, sf_dir)["split"].select("id", "heuristic_label", "is_test")


@query("standardize")
def q_standardize(spark, sf_dir):
    d = _ml_data(spark, sf_dir)
    z = ML.standardize(d["split"], d["stats"])
    return finish(z.select("id", "is_test", *Z))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    return finish(ML.class_weights(_ml_data(spark, sf_dir)["plain_train"]))


def _baseline_test(spark, sf_dir) -> DataFrame:
    d = _ml_data(spark, sf_dir)
    table = ML.fit_band_baseline(d["train"])
    return ML.predict_band_baseline(d["test"], table)


@query("accuracy")
def q_accuracy(spark, sf_dir):
    return finish(EV.accuracy(EV.contingency(_baseline_test(spark, sf_dir))))


@query("classification_report")
def q_report(spark, sf_dir):
    return finish(EV.classification_report(EV.contingency(_baseline_test(spark, sf_dir))))


@query("confusion_matrix")
def q_confusion(spark, sf_dir):
    return EV.confusion_matrix(EV.contingency(_baseline_test(spark, sf_dir)))


@query("expected_severity")
def q_expected(spark, sf_dir):
    d = _ml_data(spark, sf_dir)
    table = ML.fit_band_baseline(d["train"])
    p = ML.predict_band_baseline(d["split"], table)
    return finish(p.select("id", S.rank_label(F.col("prediction").cast("int")).alias("predicted_priority"),
                           ML.expected_severity(F.col("probability")).alias("predicted_priority_score")))


def _pred_rows(spark, sf_dir, name):
    p = _test_predictions(spark, sf_dir, name)
    return p.select("id", "heuristic_label",
                    S.rank_label(F.col("prediction").cast("int")).alias("predicted_label"))


@query("train_logreg")
def q_train_lr(spark, sf_dir):
    return _pred_rows(spark, sf_dir, "logistic_regression")


@query("train_dtree")
def q_train_dt(spark, sf_dir):
    return _pred_rows(spark, sf_dir, "decision_tree")


@query("train_rf")
def q_train_rf(spark, sf_dir):
    return _pred_rows(spark, sf_dir, "random_forest")


@query("feature_importance")
def q_importance(spark, sf_dir):
    rows = []
    for name in ML.MODELS:
        fi = ML.feature_importance(_model(spark, sf_dir, name), ML.model_columns(name)) or {}
        rows += [(name, f.removesuffix("_z"), float(v)) for f, v in fi.items()]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


@query("evaluate_all")
def q_evaluate_all(spark, sf_dir):
    """E5: the whole document, one row per model: accuracy, per-class report, confusion
    matrix with its label order, importances.  Each model scores the test rows once."""
    from vigil.plans import job
    docs = {name: job.model_document(_model(spark, sf_dir, name), name, EV.contingency(_test_predictions(spark, sf_dir, name)))
            for name in ML.MODELS}
    return job.metrics_frame(spark, docs)


def _rf_scored(spark, sf_dir) -> DataFrame:
    d = _ml_data(spark, sf_dir)
    return ML.score_all(_model(spark, sf_dir, "random_forest"), d["split"])


@query("predict_all")
def q_predict_all(spark, sf_dir):
    return finish(_rf_scored(spark, sf_dir).select("id", "predicted_priority",
                                                   "predicted_priority_score"))


CLOSE = 1e-9


@query("predict_relational")
def q_predict_relational(spark, sf_dir):
    """P1 by joins on the saved trees' node tables, for every row: how many rows get another label or score than from the
    fitted model (none; labels are compared where the two best classes are further apart than rounding)."""
    import uuid

    from vigil.session import scratch_scope, scratch_table, shared_path
    out = []
    for name in ("decision_tree", "random_forest"):
        path = shared_path(spark, "vigil-models", uuid.uuid4().hex, name)
        model = _model(spark, sf_dir, name)
        model.write().overwrite().save(path)
        with scratch_scope(spark):
            rows = _ml_data(spark, sf_dir)["split"]
            nodes = scratch_table(ML.node_table(spark, path), "nodes")
            own = ML.walk_trees(rows, nodes, "seq").select(
                "seq", "prediction", ML.expected_severity(F.col("probability")).alias("score"),
                F.sort_array("probability", asc=False).alias("p"))
            # dealt like the walked rows: scored in as many tasks, and joined without another shuffle
            fitted = ML.score_all(model, ML.spread_rows(rows, "seq")).select(
                "seq", F.col("prediction").alias("prediction_m"), F.col("predicted_priority_score").alias("score_m"))
            out += own.join(fitted, "seq", "full_outer").agg(
                F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"),
                F.count_if((F.col("prediction") != F.col("prediction_m")) & (F.col("p")[0] - F.col("p")[1] > CLOSE)
                           | F.col("prediction").isNull() | F.col("prediction_m").isNull()).alias("n_labels_differ"),
                F.count_if(F.abs(F.col("score") - F.col("score_m")) > CLOSE).alias("n_scores_differ")).collect()
        ST.remove(spark, path)
    return spark.createDataFrame(out, "model string, n_rows bigint, n_labels_differ bigint, n_scores_differ bigint")


#: largest entry of the gradient, of a loss averaged over the rows on standardised features, that counts as optimal
OPTIMAL = 1e-4


@query("logreg_certificate")
def q_logreg_certificate(spark, sf_dir):
    """M4: the fitted logistic regression is the optimum: its gradient vanishes for every class."""
    g = ML.logistic_gradient(_model(spark, sf_dir, "logistic_regression"), _ml_data(spark, sf_dir)["train"])
    return g.select("class", "n", (F.col("gradient") < OPTIMAL).alias("optimal"))


def _updates(rows: DataFrame, columns: list[str], other: dict[str, Column]) -> DataFrame:
    """Updates with a position: three rows in four, every fifth again with the values
    ``other`` (which must win), and one unknown id for every seventh."""
    first = rows.filter(F.col("seq") % 4 != 0).select("id", *columns, F.col("seq").alias("at"))
    again = rows.filter(F.col("seq") % 5 == 0).select(
        "id", *[other[c].alias(c) for c in columns], (F.col("seq") + F.lit(1 << 40)).alias("at"))
    unknown = rows.filter(F.col("seq") % 7 == 0).select(
        F.concat(F.lit("unknown-"), F.col("id")).alias("id"), *columns, F.col("seq").alias("at"))
    return first.unionByName(again).unionByName(unknown)


@query("write_labels_partial")
def q_write_labels_partial(spark, sf_dir):
    """K3 with missing, repeated and unmatched update ids."""
    from vigil.operators import upsert as U
    root = P.write_copy(spark, sf_dir)
    lab = P.label_snapshot(ST.scan(spark, root), FX.FIXTURE_NOW).select("id", "heuristic_label", "seq")
    up = _updates(lab, ["heuristic_label"], {"heuristic_label": F.lit("Critical")})
    U.write_back_into(spark, root, up, ["heuristic_label"], "at")
    return ST.scan(spark, root).select("id", "threat_type", "heuristic_label")


@query("write_predictions")
def q_write_predictions(spark, sf_dir):
    """K4 with the band baseline's predictions; missing, repeated and unmatched update ids."""
    from vigil.operators import upsert as U
    d = _ml_data(spark, sf_dir)
    p = ML.predict_band_baseline(d["split"], ML.fit_band_baseline(d["train"]))
    rows = p.select("id", "seq", S.rank_label(F.col("prediction").cast("int")).alias("predicted_priority"),
                    ML.expected_severity(F.col("probability")).alias("predicted_priority_score"))
    up = _updates(rows, ["predicted_priority", "predicted_priority_score"],
                  {"predicted_priority": F.lit("Low"), "predicted_priority_score": F.lit(0.125)})
    root = P.write_copy(spark, sf_dir)
    U.write_back_into(spark, root, up, ["predicted_priority", "predicted_priority_score"], "at")
    return finish(ST.scan(spark, root).select("id", "threat_type", "predicted_priority", "predicted_priority_score"))


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """K6: all three models saved with their scaling and reloaded; both predictions per test row."""
    import uuid

    from pyspark.ml import PipelineModel

    from vigil.session import shared_path
    root, out = shared_path(spark, "vigil-models", uuid.uuid4().hex), None
    for name in ML.MODELS:
        model = _model(spark, sf_dir, name)
        model.write().overwrite().save(f"{root}/{name}")
        test = _ml_data(spark, sf_dir)["test"]
        a = model.transform(test).select(F.lit(name).alias("model"), "id", "seq", F.col("prediction"))
        b = PipelineModel.load(f"{root}/{name}").transform(test).select("seq", F.col("prediction").alias("prediction_reloaded"))
        both = a.join(b, "seq").drop("seq")
        out = both if out is None else out.unionByName(both)
    return out


@query("metrics_summary")
def q_metrics_summary(spark, sf_dir):
    """K5 then S8 for the band baseline: the document written as JSON, read back, names
    title-cased, accuracy in %."""
    import uuid

    from vigil.plans import job
    from vigil.session import shared_path
    path = shared_path(spark, "vigil-reports", uuid.uuid4().hex, "metrics")
    doc = job.model_document(None, "band_baseline", EV.contingency(_baseline_test(spark, sf_dir)))
    job.write_metrics(spark, {"band_baseline": doc}, path)
    return V.read_metrics(spark, path)


# ------------------------------------------------------------------ sources --
from vigil.sources import landed as LD  # noqa: E402

# Landed vulnerability pages alternate between 300 and 200 keys.
PAGE_KEYS, PAGE_CUT = 500, 300


@query("read_cve_pages")
def q_read_cve_pages(spark, sf_dir):
    """S1 over the whole table: records landed as page files of mixed size, read back.
    ``seq`` holds page order and position, so neither needs a join."""
    import uuid

    from vigil.session import shared_path
    cve, _ = _feeds(spark, sf_dir)
    path = shared_path(spark, "vigil-landed", uuid.uuid4().hex)
    LD.write_pages(LD.envelope(cve, "vulnerabilities", lambda s: (
        F.floor(s / PAGE_KEYS) * 2 + F.when(s % PAGE_KEYS >= PAGE_CUT, 1).otherwise(0))), path)
    rec = LD.cve_pages_to_records(LD.read_pages(spark, path))
    norm = N.valid(N.normalize_cve(rec.select("seq", "raw")))
    return finish(norm.select("seq", F.shiftright("seq", LD.POSITION_BITS).alias("page_order"),
                              F.col("seq").bitwiseAND(F.lit((1 << LD.POSITION_BITS) - 1)).alias("pos"),
                              "id", "severity_raw"))


@query("read_ip_min_confidence")
def q_read_ip(spark, sf_dir):
    """S2: report envelopes of 1,000 events; floor 50, cap 500 (the cap is the feature)."""
    _, ip = _feeds(spark, sf_dir)
    pages = LD.envelope(ip, "data", lambda s: F.floor((s - FX.IP_SEQ_BASE) / 1000))
    top = LD.ip_pages_to_records(pages, limit=C.IP_LIMIT)
    return finish(top.select("seq", "ip", "confidence"))


@query("rank_fallback")
def q_rank_fallback(spark, sf_dir):
    """V4/V5 on a table without prediction columns: type filter only, severity ranks."""
    plain = P.fixture_snapshot(spark, sf_dir).drop("predicted_priority", "predicted_priority_score")
    r = V.rank_threats(V.filter_threats(plain, [C.TYPE_CVE, C.TYPE_IP], ["High"]), columns=["id", "severity_raw"])
    return finish(r)


@query("page_keyset")
def q_page_keyset(spark, sf_dir):
    """Page 3 reached by keyset paging from the last row of page 2 (same rows as page 3)."""
    f = V.filter_threats(P.served_store(spark, sf_dir))
    last = V.page(f, 2, 25).orderBy(F.col("position").desc()).first()
    nxt = V.page_after(f, V.cursor_of(last), 25)
    return finish(nxt.select("id", "threat_type", "predicted_priority", "predicted_priority_score"))
