"""Model training, selection, evaluation and the run log (``pyspark.ml``).

Candidates mirror the reference: L2 logistic regression (C = 1, 1000
iterations, balanced class weights), a balanced random forest (100 trees,
depth 10) and gradient-boosted trees (100 rounds, depth 5, step 0.1,
unweighted). sklearn's objective is C * sum(w * loss) + |b|^2 / 2 on raw
features; Spark averages the weighted loss, so the equal optimum has
``regParam = 1 / (C * sum(w))`` with ``standardization=False``.

Distributed parts: feature encoding, fitting, scoring and every metric. Candidates
are fitted at the same time: a fit is hundreds of short jobs one after the other, and
the cores that one leaves idle do another's. The driver only receives one metric row per candidate (to pick the best), the
class counts of the guards and the feature-importance vectors (one number
per feature).
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.config import DEFAULT_PARAMS, ChurnParams
from sellerscope.operators import evaluation as EV
from sellerscope.operators.ranking import materialize, scaled_buckets, stratified_split
from sellerscope.operators.scalars import attach_scalars
from sellerscope.plans import features as FE

MIN_ROWS = 10
#: partitions of the training rows in a fit: FIT_PARTITIONS up to four times FIT_ROWS rows, then one per FIT_ROWS until
#: there are MOST_WAVES of them, which then grow to FIT_ROWS_MOST rows each (every partition of a forest sends the
#: statistics of all nodes of a level). A number of the rows alone, not of the cores, as forests depend on it
FIT_PARTITIONS, FIT_ROWS, MOST_WAVES, FIT_ROWS_MOST = 4, 50_000, 24, 300_000
#: rows of a bucket of the splits; the held-out rows are scored in as many tasks
SPLIT_ROWS = 100_000
ALGORITHMS = ("LogisticRegression", "RandomForest", "GradientBoosting")


def fit_partitions(rows: int) -> int:
    return max(FIT_PARTITIONS, min(MOST_WAVES, math.ceil(rows / FIT_ROWS)), math.ceil(rows / FIT_ROWS_MOST))


def class_weights(df: DataFrame, label_col: str, out_col: str = "weight") -> DataFrame:
    """'balanced' weights n / (k * n_c), joined from a per-class table."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    totals = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    weights = attach_scalars(counts, totals).select(
        label_col, (F.col("_n").cast("double") / (F.col("_k") * F.col("_nc"))).alias(out_col))
    return df.join(weights, label_col, "left")


def make_estimator(name: str, n_train: int, params: ChurnParams = DEFAULT_PARAMS,
                   label_col: str = "label"):
    if name == "LogisticRegression":
        return LogisticRegression(featuresCol=FE.FEATURES_COL, labelCol=label_col, weightCol="weight",
                                  maxIter=1000, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                  standardization=False)
    if name == "RandomForest":
        return RandomForestClassifier(featuresCol=FE.FEATURES_COL, labelCol=label_col, weightCol="weight",
                                      numTrees=100, maxDepth=10, featureSubsetStrategy="sqrt",
                                      # the node that each row has reached is kept, not found anew from the root at every level
                                      cacheNodeIds=True, seed=params.seed)
    if name == "GradientBoosting":
        return GBTClassifier(featuresCol=FE.FEATURES_COL, labelCol=label_col, maxIter=100, maxDepth=5,
                             stepSize=0.1, seed=params.seed)
    raise ValueError(name)


def positive_probability(model: PipelineModel, df: DataFrame, out_col: str) -> DataFrame:
    """``df`` plus P(class 1) of the fitted pipeline (intermediate columns dropped)."""
    scored = model.transform(df)
    return scored.select(*[F.col(c) for c in df.columns],
                         vector_to_array("probability")[1].alias(out_col))


def _estimator_params(est) -> dict[str, str]:
    return {p.name: str(v) for p, v in est.extractParamMap().items()
            if p.name in ("maxIter", "regParam", "numTrees", "maxDepth", "stepSize", "seed",
                          "featureSubsetStrategy", "standardization", "weightCol")}


@dataclass
class StageResult:
    stage: str
    feature_cols: list[str]
    model: PipelineModel | None = None
    best: str | None = None
    metrics: list[dict] = field(default_factory=list)
    importance: dict[str, list[tuple[str, float]]] = field(default_factory=dict)
    outer_test: DataFrame | None = None
    skipped: str | None = None
    sizes: dict[str, int] = field(default_factory=dict)
    train: DataFrame | None = None
    fitted: dict[str, PipelineModel] = field(default_factory=dict)
    held_out: DataFrame | None = None
    encoder: PipelineModel | None = None
    test: DataFrame | None = None


def at_once(spark: SparkSession, *calls) -> list:
    """The results of ``calls``, whose Spark jobs run side by side."""
    with ThreadPoolExecutor(max(len(calls), 1)) as pool:
        return [x.result() for x in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]


def _label_counts(df: DataFrame, label_col: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}


def train_stage(data: DataFrame, stage: str, label_col: str, feature_pipeline: Pipeline,
                feature_cols: list[str], params: ChurnParams = DEFAULT_PARAMS,
                algorithms=ALGORITHMS, earlier: StageResult | None = None) -> StageResult:
    """Fit the candidates of one stage and keep the best by held-out AUC.

    Outer stratified split (75/25, seeded hash) -> inner split of the outer
    train part -> candidates fitted on inner train, scored on inner test ->
    best by AUC (first listed wins ties). Guards: <= 10 rows or a single
    class -> no model (feature list still returned). ``data`` is read by the guards, the dictionary and
    the split: callers give a written table. ``earlier`` is a result of the same data, stage and parameters with other
    candidates: its split, encoded rows and fits are used again.
    """
    res = StageResult(stage, list(feature_cols))
    if earlier is None:
        _split_and_encode(res, data, label_col, feature_pipeline, params)
    else:
        for x in ("skipped", "encoder", "outer_test", "sizes", "train", "test"):
            setattr(res, x, getattr(earlier, x))
    if res.skipped:
        return res
    n_train = res.sizes["train_rows"]
    known = earlier.fitted if earlier else {}
    new = [name for name in algorithms if name not in known]
    clfs = dict(zip(new, at_once(data.sparkSession, *(lambda name=name: make_estimator(name, n_train, params).fit(res.train) for name in new))))
    scored = res.test
    for name in algorithms:
        clf = clfs[name] if name in clfs else known[name].stages[-1]
        res.fitted[name] = known.get(name) or PipelineModel(stages=[*res.encoder.stages, clf])
        scored = positive_probability(clf, scored, f"_p_{name}")
        res.metrics.append({"stage": stage, "algorithm": name, "params": _estimator_params(make_estimator(name, n_train, params))})
        if hasattr(clf, "featureImportances"):
            imp = clf.featureImportances.toArray().tolist()
            res.importance[name] = sorted(zip(feature_cols, imp), key=lambda t: -t[1])
    # one evaluation for all candidates: their scores side by side, unpivoted, ranked per candidate
    long = scored.select("label", F.explode(F.array(*[F.struct(F.lit(a).alias("algorithm"), F.col(f"_p_{a}").alias("p")) for a in res.fitted])).alias("x"))
    found = {r["algorithm"]: r.asDict() for r in EV.candidate_metrics(long.select("label", "x.*"), "algorithm", "label", "p").collect()}
    for m in res.metrics:  # a row per candidate
        m.update(found.get(m["algorithm"], {"roc_auc": None, "accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}))
    best = select_best_name(res.metrics)
    res.best = best
    res.model = res.fitted[best]
    for m in res.metrics:
        m["is_best"] = m["algorithm"] == best
    return res


def _split_and_encode(res: StageResult, data: DataFrame, label_col: str, feature_pipeline: Pipeline, params: ChurnParams) -> None:
    base = data.withColumn("label", F.col(label_col).cast("double"))
    counts = _label_counts(base, "label")
    n = sum(counts.values())
    if n <= MIN_ROWS:
        res.skipped = f"{n} rows"
        return
    if len([c for c in counts.values() if c > 0]) < 2:
        res.skipped = "single class"
        return
    res.encoder = feature_pipeline.fit(base)
    # both splits feed every candidate: written once, and read where they are needed
    buckets = scaled_buckets(n, size=SPLIT_ROWS)
    split = materialize(stratified_split(base, "label", "seller_id", params.test_size, params.seed, buckets))
    outer_train = split.filter(F.col("is_test") == 0).drop("is_test")
    res.outer_test = split.filter(F.col("is_test") == 1).drop("is_test")
    inner = materialize(stratified_split(outer_train, "label", "seller_id", params.test_size, params.seed, buckets))
    inner_train = class_weights(inner.filter(F.col("is_test") == 0).drop("is_test"), "label")
    inner_test = inner.filter(F.col("is_test") == 1).drop("is_test")
    res.sizes = {r["is_test"]: r["count"] for r in inner.groupBy("is_test").count().collect()}
    res.sizes = {"outer_test_rows": n - sum(res.sizes.values()), "train_rows": res.sizes.get(0, 0), "test_rows": res.sizes.get(1, 0)}
    # encoded once: the fits and their certificates read the rows back, every candidate scores the same test rows
    inner_train = inner_train.repartition(fit_partitions(res.sizes["train_rows"]), "seller_id")
    res.train = materialize(res.encoder.transform(inner_train).select("seller_id", "label", "weight", FE.FEATURES_COL))
    res.test = res.encoder.transform(inner_test).select("label", FE.FEATURES_COL)


def select_best_name(metrics: list[dict]) -> str:
    """Highest AUC; the first listed candidate wins ties."""
    best = None
    for m in metrics:
        auc = m.get("roc_auc")
        if auc is not None and (best is None or auc > best["roc_auc"]):
            best = m
    return (best or metrics[0])["algorithm"]


def select_best(metrics: DataFrame) -> DataFrame:
    """DataFrame form: the row with the highest AUC (candidate order breaks ties)."""
    return metrics.agg(F.max_by(F.struct(*metrics.columns),
                                F.struct(F.col("roc_auc"), -F.col("candidate_order"))).alias("b")).select("b.*")


def pre_activation(master: DataFrame, params: ChurnParams = DEFAULT_PARAMS, wide: bool = False,
                   algorithms=ALGORITHMS, earlier: StageResult | None = None) -> StageResult:
    cols = list(C.PRE_ACTIVATION_FEATURES) + (list(C.WIDE_EXTRA_FEATURES) if wide else [])
    return train_stage(master, "pre_activation", "never_activated", FE.pre_activation_pipeline(wide),
                       cols, params, algorithms, earlier)


def retention(master: DataFrame, params: ChurnParams = DEFAULT_PARAMS, eleven: bool = False,
              wide: bool = False, algorithms=ALGORITHMS, earlier: StageResult | None = None) -> StageResult:
    activated = master.filter(F.col("never_activated") == 0)
    cols = FE.retention_feature_list(eleven, wide)
    return train_stage(activated, "retention", "dormant", FE.retention_pipeline(eleven, wide),
                       cols, params, algorithms, earlier)


def held_out(res: StageResult) -> DataFrame:
    """(label, p, prediction) of the outer test rows by the chosen model: scored once, for every measure taken of them."""
    if res.held_out is None:
        scored = positive_probability(res.model, res.outer_test, "p").select("label", "p")
        res.held_out = materialize(EV.with_prediction(scored, "p"))
    return res.held_out


def evaluate_model(res: StageResult) -> DataFrame:
    """Held-out (outer split) metrics of the chosen model as one row."""
    scored = held_out(res)
    out = attach_scalars(EV.binary_metrics(scored, "label"), EV.roc_auc(scored, "label", "p"))
    n = res.outer_test.agg(F.count(F.lit(1)).alias("test_rows"))
    return attach_scalars(out, n).select(F.lit(res.stage).alias("stage"), F.lit(res.best).alias("algorithm"), "*")


def metrics_frame(spark, results: list[StageResult], run_id: str | None = None,
                  params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """Run log rows: run id, stage, algorithm, params, five metrics, is_best, and the run's configuration."""
    run_id = run_id or "run-" + uuid.uuid4().hex
    config = {k: str(v) for k, v in params.as_dict().items()}
    rows = []
    for res in results:
        for i, m in enumerate(res.metrics):
            rows.append((run_id, m["stage"], m["algorithm"], i, m["params"], None if m["roc_auc"] is None else float(m["roc_auc"]),
                         float(m["accuracy"]), float(m["precision"]), float(m["recall"]), float(m["f1_score"]),
                         bool(m["is_best"]), config))
    schema = ("run_id string, stage string, algorithm string, candidate_order int, params map<string,string>, "
              "roc_auc double, accuracy double, precision double, recall double, f1_score double, "
              "is_best boolean, config map<string,string>")
    return spark.createDataFrame(rows, schema)


def importance_frame(spark, res: StageResult, algorithm: str | None = None) -> DataFrame:
    """Feature / importance table (desc) of a tree model: by default the
    first tree candidate, which is the one the reference reports."""
    if not res.importance:
        return spark.createDataFrame([], "feature string, importance double")
    name = algorithm or next(iter(res.importance))
    return spark.createDataFrame([(f, float(v)) for f, v in res.importance[name]],
                                 "feature string, importance double").orderBy(F.col("importance").desc())


def log_run(metrics: DataFrame, path: str) -> None:
    """Add the run's candidate rows to the ``model_runs`` table; a run that is
    logged again replaces its own rows."""
    (metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def publish_model(model: PipelineModel, root: str, name: str) -> int:
    """Save ``model`` as the next version of ``name`` below ``root``; returns the version.

    The model folder is written first, under a name of its own; one manifest row that points
    to it is published last. A version whose manifest row is missing does not exist, and a
    number that another run has taken meanwhile is not overwritten: the next one is tried."""
    spark = SparkSession.getActiveSession()
    folder = f"{name}-{uuid.uuid4().hex}"
    model.write().save(f"{root}/models/{folder}")
    version = max([r["version"] for r in model_versions(spark, root, name).collect()], default=0) + 1  # a row per version
    while True:
        row = spark.createDataFrame([(folder,)], "folder string").coalesce(1)
        try:
            row.write.mode("error").parquet(f"{root}/manifest/name={name}/version={version}")
            return version
        except AnalysisException as e:
            if "EXISTS" not in str(e.getCondition()):
                raise
            version += 1


def model_versions(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """(name, version, folder) of the published versions."""
    from sellerscope.sources.registry import _path_exists
    schema = "folder string, name string, version int"
    if not _path_exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], schema).select("name", "version", "folder")
    out = spark.read.schema(schema).parquet(f"{root}/manifest").filter(F.col("folder").isNotNull())
    return (out if name is None else out.filter(F.col("name") == name)).select("name", "version", "folder")


def load_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel:
    """The published model ``name``: the given version, or the latest."""
    found = model_versions(spark, root, name)
    found = found if version is None else found.filter(F.col("version") == version)
    row = found.orderBy(F.col("version").desc()).first()
    if row is None:
        raise ValueError(f"no published model {name}" + ("" if version is None else f" version {version}"))
    return load_model(f"{root}/models/{row['folder']}")


def logreg_gradient(train: DataFrame, coefficients: list[float], intercept: float) -> DataFrame:
    """(term, gradient, scale): the gradient of sum(weight * log loss) + |b|^2 / 2 at the given
    coefficients, by one aggregate over ``train`` (label, weight, features); term 0 is the
    intercept. ``scale`` sums the absolute terms, so gradient / scale is free of units."""
    x = vector_to_array(FE.FEATURES_COL)
    z = F.lit(float(intercept))
    for j, b in enumerate(coefficients):
        z = z + x[j] * float(b)
    rows = train.select(x.alias("x"), (F.col("weight") * (1 / (1 + F.exp(-z)) - F.col("label"))).alias("r"))
    aggs = [F.sum("r").alias("g0"), F.sum(F.abs("r")).alias("s0")]
    for j in range(len(coefficients)):
        part = F.col("r") * F.col("x")[j]
        aggs += [F.sum(part).alias(f"g{j + 1}"), F.sum(F.abs(part)).alias(f"s{j + 1}")]
    penalty = [0.0, *map(float, coefficients)]
    terms = [F.struct(F.lit(j).alias("term"), (F.col(f"g{j}") + b).alias("gradient"), (F.col(f"s{j}") + abs(b)).alias("scale"))
             for j, b in enumerate(penalty)]
    return rows.agg(*aggs).select(F.explode(F.array(*terms)).alias("t")).select("t.*")


def cross_validate(data: DataFrame, label_col: str, feature_pipeline: Pipeline, algorithm: str,
                   params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """Mean and (population) std of the exact AUC over stratified hash folds: one row
    (algorithm, cv_auc_mean, cv_auc_std), from ``fold_metrics``."""
    return fold_metrics(data, label_col, feature_pipeline, algorithm, params).agg(
        F.lit(algorithm).alias("algorithm"), F.avg("roc_auc").alias("cv_auc_mean"), F.stddev_pop("roc_auc").alias("cv_auc_std"))


def fold_metrics(data: DataFrame, label_col: str, feature_pipeline: Pipeline, algorithm: str,
                 params: ChurnParams = DEFAULT_PARAMS) -> DataFrame:
    """One row per fold: its rows and the metrics of the model fitted on the other folds.
    The folds' scores are one table, ranked by fold in one evaluation."""
    from sellerscope.operators.ranking import stratified_folds

    base = data.withColumn("label", F.col(label_col).cast("double"))
    folded = materialize(stratified_folds(base, "label", "seller_id", params.cv_folds, params.seed))
    scored = None
    for k in range(params.cv_folds):
        rest = class_weights(folded.filter(F.col("fold") != k), "label")
        features = feature_pipeline.fit(rest)
        train = materialize(features.transform(rest).select("label", "weight", FE.FEATURES_COL))
        model = make_estimator(algorithm, train.count(), params).fit(train)
        own = features.transform(folded.filter(F.col("fold") == k)).select("fold", "label", FE.FEATURES_COL)
        own = positive_probability(model, own, "p").select("fold", "label", "p")
        scored = own if scored is None else scored.unionByName(own)
    scored = materialize(scored)
    rows = scored.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(EV.candidate_metrics(scored, "fold", "label", "p"), "fold")
