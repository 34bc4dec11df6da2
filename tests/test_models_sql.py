"""Fitted models as tables: trees walked by joins, the gradient at the fitted coefficients; rankings kept as tables."""
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.test_buckets import _scored
from vigil import constants as C
from vigil.operators import ml as ML
from vigil.operators import ranking as RK
from vigil.operators import serve as V


def _train(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rnd.choice([0.0, 0.5, 1.0, rnd.random()]) for _ in C.FEATURE_COLS]
        score = x[0] + x[1] * x[2] + rnd.gauss(0, 0.2)
        label = "Low" if score < 0.4 else "Medium" if score < 0.8 else "High" if score < 1.2 else "Critical"
        rows.append((i, *x, label))
    df = spark.createDataFrame(rows, ["seq", *C.FEATURE_COLS, "heuristic_label"])
    t = ML.with_label(df)
    return ML.with_weights(t, ML.weight_table(t))


@pytest.mark.parametrize("kind", ["tree", "stump", "forest", "leaf"])
def test_walked_trees_equal_the_model(spark, tmpdir_path, kind):
    train = _train(spark)
    est = {"tree": ML.decision_tree(), "stump": DecisionTreeClassifier(maxDepth=1, weightCol="weight"), "leaf": DecisionTreeClassifier(maxDepth=0),
           "forest": RandomForestClassifier(numTrees=7, maxDepth=5, seed=3, weightCol="weight")}[kind]
    model = ML.fit_pipeline(train, est)
    model.write().overwrite().save(tmpdir_path + "/m")
    nodes = ML.node_table(spark, tmpdir_path + "/m")
    got = {r.seq: r for r in ML.walk_trees(train, nodes, "seq").collect()}
    want = model.transform(train).select("seq", "prediction", vector_to_array("probability").alias("p")).collect()
    assert len(got) == len(want) == 400
    for r in want:
        assert max(abs(a - b) for a, b in zip(got[r.seq].probability, r.p)) < 1e-12
        assert got[r.seq].prediction == r.prediction or sorted(r.p)[-1] - sorted(r.p)[-2] < 1e-12


def test_a_join_walks_a_block_of_levels(spark, tmpdir_path):
    train = _train(spark)
    model = ML.fit_pipeline(train, DecisionTreeClassifier(maxDepth=9, minInstancesPerNode=1, weightCol="weight"))
    model.write().overwrite().save(tmpdir_path + "/m")
    nodes = ML.node_table(spark, tmpdir_path + "/m")
    depth = model.stages[-1].depth
    assert depth > ML.BLOCK_LEVELS and len(ML.tree_blocks(nodes)) == -(-depth // ML.BLOCK_LEVELS)
    # values that are missing or no number go the model's way or, missing, to the right
    odd = train.withColumn(C.FEATURE_COLS[0], F.when(F.col("seq") % 5 == 0, F.lit(None)).when(F.col("seq") % 5 == 1, F.lit(float("nan")))
                           .otherwise(F.col(C.FEATURE_COLS[0])))
    walk = ML.walk_trees(odd, nodes, "seq")
    assert walk._jdf.queryExecution().optimizedPlan().toString().count("Join ") == -(-depth // ML.BLOCK_LEVELS) + 1
    got = {r.seq: r.prediction for r in walk.collect()}
    want = {r.seq: r.prediction for r in model.transform(odd.fillna({C.FEATURE_COLS[0]: 1e9})).collect()}
    assert got == want


def test_training_rows_are_spread_over_the_tasks(spark, monkeypatch):
    class Fit:
        def fit(self, data):
            self.sizes = data.rdd.glom().map(len).collect()
            return ML.assembler()
    train, est = _train(spark).coalesce(1), Fit()
    ML.fit_pipeline(train, est, n_train=400)
    assert len(est.sizes) == 1                                          # few rows stay as they are
    monkeypatch.setattr(ML, "SPREAD_ROWS", 400)
    monkeypatch.setattr(ML, "TASK_ROWS", 10)
    ML.fit_pipeline(train, est, n_train=400)
    assert len(est.sizes) >= 40 and sum(est.sizes) == 400 and max(est.sizes) <= 20


def test_a_forest_on_many_rows_grows_in_groups_of_trees(spark, tmpdir_path, monkeypatch):
    train, sizes, fit = _train(spark), [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, data: sizes.append(self.getNumTrees()) or fit(self, data))
    forest = RandomForestClassifier(numTrees=7, maxDepth=4, seed=3, weightCol="weight")
    plain = ML.fit_pipeline(train, forest, n_train=400).stages[-1]
    monkeypatch.setattr(ML, "GROUP_ROWS", 401)
    monkeypatch.setattr(ML, "GROUP_TREES", 3)
    below = ML.fit_pipeline(train, forest, n_train=400).stages[-1]
    shape = lambda forest: [t.toDebugString.split("\n", 1)[1] for t in forest.trees]  # noqa: E731  (without the tree's name)
    assert sizes == [7, 7] and shape(below) == shape(plain)
    monkeypatch.setattr(ML, "GROUP_ROWS", 400)
    model = ML.fit_pipeline(train, forest, n_train=400)
    assert sizes[2:] == [2, 2, 3]
    last = model.stages[-1]
    assert last.getNumTrees == len(last.trees) == 7 and len(set(shape(last))) == 7
    assert (last.numFeatures, last.numClasses, last.getMaxDepth()) == (len(C.FEATURE_COLS), 4, 4)
    assert sum(last.featureImportances.toArray()) == pytest.approx(1.0)
    model.write().overwrite().save(tmpdir_path + "/m")
    want = sorted(model.transform(train).select("seq", "prediction", vector_to_array("probability").alias("p")).collect())
    again = PipelineModel.load(tmpdir_path + "/m")
    assert again.stages[-1].getNumTrees == 7
    assert sorted(again.transform(train).select("seq", "prediction", vector_to_array("probability")).collect()) == want
    walked = sorted(ML.walk_trees(train, ML.node_table(spark, tmpdir_path + "/m"), "seq").select("seq", "probability").collect())
    assert all(a.seq == b.seq and a.probability == pytest.approx(b.p, abs=1e-12) for a, b in zip(walked, want, strict=True))


def test_small_rows_that_every_tree_walks_are_dealt_to_all_cores(spark):
    n = 4 * spark.sparkContext.defaultParallelism
    train = _train(spark)
    spread = ML.spread_rows(train.coalesce(1), "seq")
    assert spread.columns == ["seq", *C.FEATURE_COLS] and spread.rdd.getNumPartitions() >= n
    assert spread.count() == 400


def test_nodes_beyond_the_broadcast_bound_are_joined_by_shuffle(spark, tmpdir_path, monkeypatch):
    train = _train(spark, 100)
    model = ML.fit_pipeline(train, DecisionTreeClassifier(maxDepth=3))
    model.write().overwrite().save(tmpdir_path + "/m")
    nodes = ML.node_table(spark, tmpdir_path + "/m")
    one = sorted(map(tuple, ML.walk_trees(train, nodes, "seq").collect()))
    monkeypatch.setattr(ML, "BROADCAST_NODES", 1)
    assert sorted(map(tuple, ML.walk_trees(train, nodes, "seq").collect())) == one


def test_the_gradient_vanishes_at_the_optimum_only(spark):
    train = _train(spark)
    stats, n = ML.scaler_values(train), train.count()
    fitted = ML.fit_model("logistic_regression", train, stats, n)
    g = {r["class"]: r for r in ML.logistic_gradient(fitted, train).collect()}
    assert [g[c].n for c in C.PRIORITY_LABELS] == [train.filter(F.col("heuristic_label") == c).count() for c in C.PRIORITY_LABELS]
    assert max(r.gradient for r in g.values()) < 1e-4
    early = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", family="multinomial", maxIter=2,
                               regParam=1.0 / n, standardization=False)
    poor = ML.fit_pipeline(train, early, ML.Z_COLS, before=[ML.scaler(stats)])
    assert max(r.gradient for r in ML.logistic_gradient(poor, train).collect()) > 1e-3


# ----------------------------------------------------------------- ranking --
def test_pages_of_a_published_ranking(spark, tmpdir_path):
    rnd = random.Random(8)
    df = _scored(spark, [(rnd.choice(["High", "Low", None]), rnd.choice([0.5, None, rnd.random()]), 1, s) for s in range(700)])
    path = tmpdir_path + "/ranking"
    assert V.publish_ranking(df, path, num_partitions=9) == 700
    every = [r.id for r in df.orderBy(*V.rank_keys(df)).collect()]
    for no in (1, 2, 10, 35, 36, 99):
        got = V.published_page(spark, path, no, 20).orderBy("position").collect()
        lo = (no - 1) * 20 if no <= 35 else 0
        assert [(r.position, r.id) for r in got] == [(lo + k + 1, i) for k, i in enumerate(every[lo:lo + 20])]
    ranges = RK.ranges_of(spark, path)
    assert sum(n for _, _, n in ranges) == 700 and len(ranges) > 3
    files = V.published_page(spark, path, 10, 20).inputFiles()
    holding = [r for r, before, n in ranges if before < 200 and before + n > 180]
    assert {int(f.split("_range=")[1].split("/")[0]) for f in files} == set(holding)
    plan = V.published_page(spark, path, 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "PushedFilters: [IsNotNull(_at), GreaterThanOrEqual(_at" in plan


def test_published_ranking_of_nothing(spark, tmpdir_path):
    df = _scored(spark, [("High", 0.5, 1, 1)])
    V.publish_ranking(df, tmpdir_path + "/r", num_partitions=4)
    assert V.published_page(spark, tmpdir_path + "/r", 1, 10).count() == 1
    assert RK.published_rows(spark, tmpdir_path + "/r", 5, 9).count() == 0
    assert V.publish_ranking(df.limit(0), tmpdir_path + "/none", num_partitions=4) == 0
    assert V.published_page(spark, tmpdir_path + "/none", 1, 10).count() == 0
