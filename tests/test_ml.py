import pytest
from pyspark.sql import functions as F

from vigil.operators import evaluate as EV
from vigil.operators import ml as ML
from vigil.operators import split as SP


def test_apportion_and_allocation():
    assert SP.apportion({"a": 5, "b": 5}, 7) == {"a": 4, "b": 3}
    alloc, strat = SP.allocation({"Low": 50, "High": 30, "Critical": 20})
    assert strat and sum(alloc.values()) == 25
    alloc, strat = SP.allocation({"Low": 10, "High": 1})
    assert not strat and alloc == {"*": 3}
    with pytest.raises(ValueError):
        SP.allocation({"a": 2, "b": 2, "c": 2, "d": 2, "e": 2}, test_size=0.1)


def _labelled(spark, n=400):
    df = spark.range(n).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("id"),
                               F.col("id").alias("seq"))
    lab = F.when(F.col("seq") % 10 < 5, "Low").when(F.col("seq") % 10 < 8, "Medium") \
           .when(F.col("seq") % 10 < 9, "High").otherwise("Critical")
    return df.withColumn("heuristic_label", lab)


def test_split_exact_per_class(spark):
    df = _labelled(spark)
    sp = SP.stratified_split(df).cache()
    counts = {r.heuristic_label: (r.n, r.t) for r in sp.groupBy("heuristic_label").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert sum(t for _, t in counts.values()) == 100
    alloc, _ = SP.allocation({k: v[0] for k, v in counts.items()})
    assert {k: v[1] for k, v in counts.items()} == alloc
    again = {r.id for r in SP.stratified_split(df).filter("is_test").collect()}
    assert again == {r.id for r in sp.filter("is_test").collect()}    # reproducible


def test_models_and_reports(spark):
    from vigil.plans import pipeline as P
    lab = P.fixture_labelled(spark, "/root/testdata/sf0.001").cache()
    sp = SP.stratified_split(lab)
    train = ML.with_label(sp.filter(~F.col("is_test")))
    test = ML.with_label(sp.filter("is_test"))
    w = ML.class_weights(train)
    assert sum(r.weight * r.n_class for r in w.collect()) == pytest.approx(train.count())
    train = ML.with_weights(train, ML.weight_table(train)).cache()
    rf = ML.fit_pipeline(train, ML.random_forest(num_trees=10))
    scored = ML.score_all(rf, test)
    from pyspark.ml.functions import vector_to_array
    p = scored.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b)
                      .alias("s"), "predicted_priority_score").collect()
    assert all(abs(r.s - 1) < 1e-9 and 0 <= r.predicted_priority_score <= 1 for r in p)
    pred = EV.contingency(rf.transform(test))
    cm = EV.confusion_matrix(pred).collect()
    assert len(cm) == 4 and sum(sum(r[1:]) for r in cm) == test.count()
    rep = {r["class"]: r for r in EV.classification_report(pred).collect()}
    assert set(rep) == {"Low", "Medium", "High", "Critical", "accuracy", "macro avg", "weighted avg"}
    acc = EV.accuracy(pred).first().accuracy
    assert rep["accuracy"].f1_score == acc and rep["accuracy"].support == test.count()
    majority = max(r.n_class for r in ML.class_weights(test).collect()) / test.count()
    assert acc > majority
    fi = ML.feature_importance(rf)
    assert set(fi) == set(ML.C.FEATURE_COLS) and sum(fi.values()) == pytest.approx(1.0)
    z = ML.standardize(train, ML.scaler_values(train)).agg(F.avg("severity_raw_z"),
                                                      F.stddev_pop("severity_raw_z")).first()
    assert abs(z[0]) < 1e-9 and z[1] == pytest.approx(1.0)


def test_expected_severity(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0, 1.0],), ([1.0, 0.0, 0.0, 0.0],),
                                ([0.25, 0.25, 0.25, 0.25],), ([0.5, 0.5, 0.0],)], "p array<double>")
    got = [r.e for r in df.select(ML.expected_severity(F.col("p")).alias("e")).collect()]
    assert got == pytest.approx([1.0, 0.0, 0.5, 0.5 / 3])


def test_model_roundtrip(spark):
    import __spark_entry__ as E
    df = E.queries()["model_roundtrip"](spark, "/root/testdata/sf0.001")
    assert {r.model for r in df.select("model").distinct().collect()} == set(ML.MODELS)
    assert df.filter("prediction <> prediction_reloaded").count() == 0


def test_single_class_refused_and_absent_metrics(spark, tmpdir_path):
    from vigil.operators import serve as V
    one = _labelled(spark, 20).withColumn("heuristic_label", F.lit("Low"))
    one = ML.with_label(one.select("*", *[F.lit(0.0).alias(c) for c in ML.C.FEATURE_COLS])) \
        .withColumn("weight", F.lit(1.0))
    with pytest.raises(ValueError):
        ML.require_classes(ML.weight_table(one))
    assert V.read_metrics(spark, tmpdir_path + "/nothing-here") is None
