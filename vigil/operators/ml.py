"""Model training and scoring with ``pyspark.ml``.

Labels use a fixed ordinal index (Low 0 … Critical 3) with nominal metadata
declaring four classes, so probability vectors always have four entries in
rank order — even when a class is absent from the training rows.
"""
from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.functions import scoring as S
from vigil.session import scratch_table

LABEL_META = {"ml_attr": {"type": "nominal", "name": "label", "vals": list(C.PRIORITY_LABELS)}}


def with_label(df: DataFrame, label_col: str = "heuristic_label") -> DataFrame:
    """Ordinal double ``label`` carrying four-class nominal metadata."""
    return df.withColumn("label", S.label_rank(F.col(label_col)).cast("double")
                         .alias("label", metadata=LABEL_META))


def class_weights(train: DataFrame, label_col: str = "heuristic_label") -> DataFrame:
    """M7: balanced weights n / (k · count_c) from the training rows (one row per class)."""
    counts = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_class"))
    tot = counts.agg(F.sum("n_class").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return (counts.crossJoin(F.broadcast(tot))
            .select(label_col, "n_class",
                    (F.col("_n") / (F.col("_k") * F.col("n_class"))).alias("weight")))


def with_weights(df: DataFrame, weights: dict[str, float], label_col: str = "heuristic_label") -> DataFrame:
    """The class weights (one per label) written into the plan as literals."""
    w = F.lit(None).cast("double")
    for name, value in weights.items():
        w = F.when(F.col(label_col) == name, F.lit(value)).otherwise(w)
    return df.withColumn("weight", F.coalesce(w, F.lit(1.0)))


def scaler_stats(train: DataFrame, cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """M3 fit: one row of mean and population std per feature (train rows only)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return train.agg(*aggs)


def scaler(stats: dict[str, float], cols: list[str] = C.FEATURE_COLS, suffix: str = "_z") -> SQLTransformer:
    """M3 as a pipeline stage: (x − mean) / std with std = 0 replaced by 1 (population
    std).  The statistics are literals of the stage, so they are saved with the model."""
    exprs = [f"(`{c}` - {_double(stats[f'{c}__mean'] or 0.0)}) / {_double(stats[f'{c}__std'] or 1.0)} AS `{c}{suffix}`"
             for c in cols]
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def _double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def standardize(df: DataFrame, stats: dict[str, float], cols: list[str] = C.FEATURE_COLS,
                suffix: str = "_z") -> DataFrame:
    """M3 transform: adds the standardised columns."""
    return scaler(stats, cols, suffix).transform(df)


def assembler(cols: list[str] = C.FEATURE_COLS, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def logistic_regression(n_train: int) -> LogisticRegression:
    """M4: multinomial, L2 with C = 1 on a weighted sum ⇒ regParam = 1 / Σweights = 1 / n."""
    return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                              family="multinomial", maxIter=C.LOGREG_MAX_ITER,
                              regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                              standardization=False)


def decision_tree() -> DecisionTreeClassifier:
    """M5: depth 6, gini, class-balanced weights; more bins than default for finer splits."""
    return DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                  maxDepth=C.DTREE_MAX_DEPTH, impurity="gini", maxBins=128,
                                  seed=C.RANDOM_SEED)


def random_forest(num_trees: int = C.RF_NUM_TREES) -> RandomForestClassifier:
    """M6: 200 trees, depth 10, sqrt features per split, class-balanced weights.

    Deep forests: node ids are cached per row (no re-walk from the root at each
    level, periodically checkpointed) and a larger node-batch budget lets one
    data pass grow more nodes, so a level costs fewer passes."""
    return RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                  numTrees=num_trees, maxDepth=C.RF_MAX_DEPTH,
                                  featureSubsetStrategy="sqrt", impurity="gini", maxBins=128,
                                  cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1024,
                                  seed=C.RANDOM_SEED)


def require_classes(weights: dict[str, float], minimum: int = 2) -> None:
    """Refuse to fit on fewer than two classes."""
    k = len(weights)
    if k < minimum:
        raise ValueError(f"training rows hold {k} class(es); a classifier needs at least {minimum}")


SPREAD_ROWS = 50_000              # training rows from which on they are spread evenly over the tasks
TASK_ROWS = 250_000               # of these in a task at most
GROUP_ROWS = 500_000              # training rows from which on a forest grows GROUP_TREES trees at a time
GROUP_TREES = 50                  # (growing keeps 17 bytes a row and tree: 3.4 KB a row for 200 trees at once)
GROUP_SEEDS = 1_000_003           # between the seeds of two groups; rows are drawn by seed + task

MODELS = ["logistic_regression", "decision_tree", "random_forest"]
Z_COLS = [f"{c}_z" for c in C.FEATURE_COLS]


def weight_table(train: DataFrame, label_col: str = "heuristic_label") -> dict[str, float]:
    """M7 as values (one per class)."""
    return {r[label_col]: r["weight"] for r in class_weights(train, label_col).collect()}


def scaler_values(train: DataFrame) -> dict[str, float]:
    """M3's statistics as values (two per feature)."""
    return scaler_stats(train).first().asDict()


def fit_model(name: str, train: DataFrame, stats: dict[str, float], n_train: int,
              num_trees: int = C.RF_NUM_TREES) -> PipelineModel:
    """One of ``MODELS`` on weighted training rows."""
    if name == "logistic_regression":
        return fit_pipeline(train, logistic_regression(n_train), Z_COLS, persist=True, before=[scaler(stats)], n_train=n_train)
    return fit_pipeline(train, decision_tree() if name == "decision_tree" else random_forest(num_trees), n_train=n_train)


def model_columns(name: str) -> list[str]:
    return Z_COLS if name == "logistic_regression" else C.FEATURE_COLS


def fit_pipeline(train: DataFrame, estimator, cols: list[str] = C.FEATURE_COLS,
                 persist: bool = False, before: list | None = None, n_train: int = 0) -> PipelineModel:
    """Assemble, fit, and return the stages ``before`` (scaling), the assembler and
    the model as one ``PipelineModel``, which scores rows of the plain features.

    ``persist`` keeps the narrow (features, label, weight) frame cached for an
    iterative optimiser's many passes (logistic regression).  Tree learners
    cache their own binned input, so they skip it, but for a forest grown in groups (``fit_forest``).

    From ``SPREAD_ROWS`` training rows on (``n_train``) the narrow frame is spread evenly: the partitions of a scan follow
    the row groups of the files, some hold several and some none, and every pass would take as long as the fullest."""
    from pyspark import StorageLevel
    asm = assembler(cols)
    keep = ["features"] + [c for c in ("label", "weight") if c in train.columns]
    for stage in before or []:
        train = stage.transform(train)
    data = asm.transform(train).select(*keep)
    if n_train >= SPREAD_ROWS:
        data = data.repartition(max(2 * data.sparkSession.sparkContext.defaultParallelism, -(-n_train // TASK_ROWS)))
    grouped = isinstance(estimator, RandomForestClassifier) and n_train >= GROUP_ROWS
    if persist or grouped:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_forest(data, estimator) if grouped else estimator.fit(data)
    finally:
        if persist or grouped:
            data.unpersist()
    return PipelineModel(stages=[*(before or []), asm, model])


def fit_forest(data: DataFrame, forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """M6 on many rows: the forest's trees grown in groups of ``GROUP_TREES`` at most, then put into one model.

    While trees grow, the learner keeps for every row a draw count per tree and its place in every tree, of three passes:
    what it holds, and on large tables writes to local disks, grows with rows times trees.  A tree does not depend on
    the others, so a group at a time is the same method with that much less held.  Every group draws by a seed of its own."""
    n = forest.getNumTrees()
    k = -(-n // GROUP_TREES)
    groups = [forest.copy({forest.numTrees: n * (g + 1) // k - n * g // k, forest.seed: forest.getSeed() + g * GROUP_SEEDS}).fit(data)
              for g in range(k)]
    if k == 1:
        return groups[0]
    sc = data.sparkSession.sparkContext
    kind = sc._jvm.org.apache.spark.ml.classification
    trees = [t._java_obj for g in groups for t in g.trees]
    held = sc._gateway.new_array(kind.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        held[i] = t
    whole = kind.RandomForestClassificationModel(groups[0].uid, held, groups[0].numFeatures, groups[0].numClasses)
    model = forest._copyValues(RandomForestClassificationModel(whole))
    model._transfer_params_to_java()                             # saving asks the JVM's model for the number of trees
    return model


def expected_severity(prob: Column) -> Column:
    """P2: Σ p_i · rank_i / 3 over a rank-ordered probability array (always ÷ 3)."""
    top = max(C.SEVERITY_RANK.values())
    total = None
    for name in C.PRIORITY_LABELS:
        r = C.SEVERITY_RANK[name]
        term = F.coalesce(F.get(prob, r), F.lit(0.0)) * F.lit(float(r))
        total = term if total is None else total + term
    return total / F.lit(float(top))


def score_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """P1: predicted label and expected-severity score for every row."""
    p = model.transform(df.drop("predicted_priority", "predicted_priority_score"))
    return p.select("*", S.rank_label(F.col("prediction").cast("int")).alias("predicted_priority"),
                    expected_severity(vector_to_array(F.col("probability")))
                    .alias("predicted_priority_score"))


def feature_importance(model: PipelineModel, cols: list[str] = C.FEATURE_COLS) -> dict[str, float] | None:
    """E4: tree models → featureImportances; logistic → mean |coefficient| over classes."""
    m = model.stages[-1]
    if hasattr(m, "featureImportances"):
        v = m.featureImportances.toArray()
    elif hasattr(m, "coefficientMatrix"):
        import numpy as np
        v = np.abs(m.coefficientMatrix.toArray()).mean(axis=0)
    else:
        return None
    return {c: float(x) for c, x in zip(cols, v)}


# ------------------------------------------------- fitted trees as tables --
BROADCAST_NODES = 2_000_000       # nodes of all trees, about 150 MB, that are broadcast at most


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved decision tree or forest (a ``PipelineModel`` folder) as rows: where a row goes from each node,
    and the class shares of the training rows there.  Leaves have no feature."""
    jvm = spark._jvm
    stages = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/stages")
    names = [s.getPath().getName() for s in stages.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(stages)]
    last = max(names, key=lambda n: int(n.split("_")[0]))
    data = spark.read.parquet(f"{path.rstrip('/')}/stages/{last}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    leaf = F.col("leftChild") < 0
    return data.select(
        "tree", F.col("id").alias("node"), F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.transform("impurityStats", lambda x: F.when(total != 0, x / total).otherwise(F.lit(0.0))).alias("shares"))


BLOCK_LEVELS = 5                  # levels of a tree that one join walks


def spread_rows(rows: DataFrame, key: str, cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """The key and the features, dealt by key into four tasks a core at least.  The number is given, as a row here is small but
    stands for a walk of every tree: by size alone adaptive execution would put them into few and uneven tasks."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.select(key, *cols).repartition(n, key)


def walk_trees(rows: DataFrame, nodes: DataFrame, key: str, cols: list[str] = C.FEATURE_COLS) -> DataFrame:
    """P1 as joins: every row walks every tree from its root, one join a block of ``BLOCK_LEVELS`` levels, and the leaves'
    class shares are averaged.

    (key, probability, prediction).  The node table has a size that the training parameters bound; below
    ``BROADCAST_NODES`` the blocks are map-side joins of one stage.  The rows are shuffled by key once, before they are
    multiplied: evenly spread, and a row's trees are summed where they were walked.  A join a level would make one generated method of all of them, too long for the JVM
    to compile.
    """
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("tree").alias("t")).first()
    small = size["n"] <= BROADCAST_NODES
    spread = spread_rows(rows, key, cols).select(F.col(key).alias("_key"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    at = spread.select("_key", "_x", F.explode(F.sequence(F.lit(0), F.lit(size["t"]))).alias("tree"), F.lit(0).alias("node"))
    for level in tree_blocks(nodes):
        at = at.join(F.broadcast(level) if small else level, ["tree", "node"], "left") \
            .select("_key", "_x", "tree", "node", "_f", "_t", "_n", F.lit(0).alias("_p"))
        for _ in range(BLOCK_LEVELS):
            f = F.get("_f", F.col("_p"))
            left = F.get("_x", f) <= F.get("_t", F.col("_p"))
            at = at.select("_key", "_x", "tree", "node", "_f", "_t", "_n", F.when(f.isNull(), F.col("_p"))
                           .when(left, F.col("_p") * 2 + 1).otherwise(F.col("_p") * 2 + 2).alias("_p"))
        # a row whose leaf came in an earlier block stays there
        at = at.select("_key", "_x", "tree", F.coalesce(F.get("_n", F.col("_p")), F.col("node")).alias("node"))
    shares = nodes.select("tree", "node", "shares")
    ends = at.join(F.broadcast(shares) if small else shares, ["tree", "node"])
    k = len(C.PRIORITY_LABELS)
    summed = ends.groupBy("_key").agg(*[F.sum(F.get("shares", i)).alias(f"_p{i}") for i in range(k)])
    total = sum((F.col(f"_p{i}") for i in range(1, k)), F.col("_p0"))
    p = [F.col(f"_p{i}") / total for i in range(k)]
    best = F.lit(k - 1)
    for i in range(k - 2, -1, -1):                               # the first of equal ones
        best = F.when(F.col(f"_p{i}") >= F.greatest(*[F.col(f"_p{j}") for j in range(k) if j != i]), F.lit(i)).otherwise(best)
    return summed.select(F.col("_key").alias(key), F.array(*p).alias("probability"), best.cast("double").alias("prediction"))


def tree_blocks(nodes: DataFrame) -> list[DataFrame]:
    """The trees cut into blocks of ``BLOCK_LEVELS`` levels, a frame for each depth of blocks, from the roots down.

    (tree, node, _f, _t, _n): a block's first node, and by place in it (the children of p are 2p+1 and 2p+2) the feature,
    the threshold and the node; a leaf and the first nodes of the blocks below have no feature.
    """
    inner = nodes.where("feature IS NOT NULL").select("tree", F.col("node").alias("_n"), "feature", "threshold", "left", "right")
    out, heads = [], inner.where("_n = 0").select("tree", F.col("_n").alias("node"))
    while not heads.isEmpty():
        places = heads.select("tree", "node", F.lit(0).alias("_p"), F.col("node").alias("_n"))
        entries = []
        for _ in range(BLOCK_LEVELS):
            split = places.join(inner, ["tree", "_n"], "left")
            entries.append(split.select("tree", "node", "_p", "_n", "feature", "threshold"))
            places = scratch_table(split.where("feature IS NOT NULL").select(
                "tree", "node", F.posexplode(F.array("left", "right")).alias("_side", "_c"), "_p")
                .select("tree", "node", (F.col("_p") * 2 + 1 + F.col("_side")).alias("_p"), F.col("_c").alias("_n")), "places")
        entries.append(places.select("tree", "node", "_p", "_n", F.lit(None).cast("int").alias("feature"),
                                     F.lit(None).cast("double").alias("threshold")))
        every = entries[0]
        for e in entries[1:]:
            every = every.unionByName(e)
        at = F.map_from_entries(F.collect_list(F.struct("_p", F.struct("feature", "threshold", "_n"))))
        block = every.groupBy("tree", "node").agg(at.alias("_m"))
        spots = F.transform(F.sequence(F.lit(0), F.lit(2 ** (BLOCK_LEVELS + 1) - 2)), lambda i: F.try_element_at("_m", i))
        out.append(scratch_table(block.select("tree", "node", spots.alias("_s")).select(
            "tree", "node", F.col("_s.feature").alias("_f"), F.col("_s.threshold").alias("_t"), F.col("_s._n").alias("_n")), "blocks"))
        heads = places.join(inner.select("tree", "_n"), ["tree", "_n"], "left_semi").select("tree", F.col("_n").alias("node"))
    return out


# --------------------------------------------- optimality of the logistic --
def logistic_gradient(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """M4's certificate: per class, the gradient of the weighted, regularised loss at the fitted coefficients.

    (class, n, gradient): ``gradient`` is its largest absolute entry over the features and the intercept, zero at the
    optimum.  One aggregate over the training rows; the softmax is written out from the coefficients.
    """
    m = model.stages[-1]
    for stage in model.stages[:-2]:
        rows = stage.transform(rows)
    beta, bias = m.coefficientMatrix.toArray(), m.interceptVector.toArray()
    reg, k = float(m.getOrDefault("regParam")), len(bias)
    margin = [sum((F.col(c) * F.lit(float(b)) for c, b in zip(Z_COLS, beta[i])), F.lit(float(bias[i]))) for i in range(k)]
    rows = rows.select("label", "weight", *Z_COLS, *[v.alias(f"_m{i}") for i, v in enumerate(margin)])
    top = F.greatest(*[F.col(f"_m{i}") for i in range(k)])
    rows = rows.select("label", "weight", *Z_COLS, *[F.exp(F.col(f"_m{i}") - top).alias(f"_e{i}") for i in range(k)])
    total = sum((F.col(f"_e{i}") for i in range(1, k)), F.col("_e0"))
    sums = [F.sum("weight").alias("w")]
    for i in range(k):
        off = F.col("weight") * (F.col(f"_e{i}") / total - F.when(F.col("label") == i, F.lit(1.0)).otherwise(F.lit(0.0)))
        sums += [F.sum(off).alias(f"g{i}_b"), F.count_if(F.col("label") == i).alias(f"n{i}")]
        sums += [F.sum(off * F.col(c)).alias(f"g{i}_{j}") for j, c in enumerate(Z_COLS)]
    r = rows.agg(*sums).first()
    out = []
    for i, name in enumerate(C.PRIORITY_LABELS):
        entries = [r[f"g{i}_{j}"] / r["w"] + reg * float(beta[i][j]) for j in range(len(Z_COLS))] + [r[f"g{i}_b"] / r["w"]]
        out.append((name, r[f"n{i}"], max(map(abs, entries))))
    return rows.sparkSession.createDataFrame(out, "class string, n bigint, gradient double")


# ---------------------------------------------------------- band baseline --
# A deterministic reference classifier: P(label | CVSS qualitative band), the
# class frequencies of each severity band in the training rows.  Its outputs
# are exactly reproducible in SQL, which gives the evaluation operators and the
# expected-severity score an exact oracle.
BAND_EDGES = [(9.0, 3), (7.0, 2), (4.0, 1)]


def severity_band(sev: Column) -> Column:
    out = None
    for edge, b in BAND_EDGES:
        out = F.when(sev >= edge, F.lit(b)) if out is None else out.when(sev >= edge, F.lit(b))
    return out.otherwise(F.lit(0))


def fit_band_baseline(train: DataFrame, label_col: str = "heuristic_label") -> DataFrame:
    """One row per band: p0..p3 = class frequencies (at most 4 rows)."""
    t = train.select(severity_band(F.col("severity_raw")).alias("band"),
                     S.label_rank(F.col(label_col)).alias("_r"))
    aggs = [F.count_if(F.col("_r") == r).alias(f"_c{r}") for r in range(4)]
    c = t.groupBy("band").agg(F.count(F.lit(1)).alias("_n"), *aggs)
    return c.select("band", *[(F.col(f"_c{r}") / F.col("_n")).alias(f"p{r}") for r in range(4)])


def predict_band_baseline(df: DataFrame, table: DataFrame) -> DataFrame:
    """Adds ``probability`` (array, rank order), ``prediction`` (argmax, lowest rank on ties)."""
    j = df.withColumn("band", severity_band(F.col("severity_raw"))) \
          .join(F.broadcast(table), "band", "left")
    p = [F.coalesce(F.col(f"p{r}"), F.lit(0.0)) for r in range(4)]
    arg = (F.when((p[0] >= p[1]) & (p[0] >= p[2]) & (p[0] >= p[3]), F.lit(0))
           .when((p[1] >= p[2]) & (p[1] >= p[3]), F.lit(1))
           .when(p[2] >= p[3], F.lit(2)).otherwise(F.lit(3)))
    return j.withColumns({"probability": F.array(*p), "prediction": arg.cast("double")}) \
            .drop("p0", "p1", "p2", "p3")
