"""Registered queries whose result comes from a model fit (SURVEY 2.11,
2.1 persistence). SQL has no equal of a fit; the ``*_facts`` ids state what
must hold of any fit (split sizes, ranges, consistency) and have oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sellerscope.operators import evaluation as EV
from sellerscope.operators.ranking import materialize
from sellerscope.operators.scalars import attach_scalars
from sellerscope.oracle.base import with_ctes
from sellerscope.plans import features as FE
from sellerscope.plans import scoring as SC
from sellerscope.plans import training as TR
from sellerscope.plans.catalog import register
from sellerscope.plans.queries_ranking import HASH
from sellerscope.session import scratch_path

_FITS: dict = {}
_LABELLED: dict = {}


def _labelled(inp):
    """The labelled master, written once: the fits of both stages and every scoring read it back."""
    key = (inp.spark.sparkContext.applicationId, inp.sf_dir, inp.params)
    if key not in _LABELLED:
        path = scratch_path(inp.spark, "labelled")
        inp.labelled.write.parquet(path)
        _LABELLED[key] = inp.spark.read.schema(inp.labelled.schema).parquet(path)
    return _LABELLED[key]


def _stage(inp, stage: str, algorithms=TR.ALGORITHMS):
    """The stage with the given candidates; splits and fits that the session has made for it are used again."""
    key = (inp.spark.sparkContext.applicationId, inp.sf_dir, stage, inp.params)
    kept = _FITS.setdefault(key, {})
    if tuple(algorithms) not in kept:
        fit = TR.pre_activation if stage == "pre_activation" else TR.retention
        most = max(kept.values(), key=lambda r: len(r.fitted), default=None)
        kept[tuple(algorithms)] = fit(_labelled(inp), inp.params, algorithms=algorithms, earlier=most)
    return kept[tuple(algorithms)]


def _stages(inp, algorithms=TR.ALGORITHMS) -> list:
    """Both stages, fitted side by side."""
    _labelled(inp)
    return TR.at_once(inp.spark, *(lambda stage=stage: _stage(inp, stage, algorithms) for stage in ("pre_activation", "retention")))


def _metrics(inp, results):
    return TR.metrics_frame(inp.spark, results, run_id="sf:" + inp.sf_dir, params=inp.params)


for _name, _algo in (("train_logreg", "LogisticRegression"), ("train_rf", "RandomForest"),
                     ("train_gbt", "GradientBoosting")):
    def _mk(name, algo):
        @register(name)
        def _q(inp):
            return _metrics(inp, [_stage(inp, "pre_activation", (algo,))])
        return _q
    _mk(_name, _algo)


@register("train_pre_activation")
def q_train_pre_activation(inp):
    return _metrics(inp, [_stage(inp, "pre_activation")])


@register("train_retention")
def q_train_retention(inp):
    return _metrics(inp, [_stage(inp, "retention")])


@register("run_metrics_log")
def q_run_metrics_log(inp):
    path = scratch_path(inp.spark, "model_runs")
    TR.log_run(_metrics(inp, _stages(inp)), path)
    return inp.spark.read.parquet(path)


@register("feature_importance")
def q_feature_importance(inp):
    # of the forest, which is the first tree candidate: no other fit is read
    return TR.importance_frame(inp.spark, _stage(inp, "pre_activation", ("RandomForest",)))


@register("top_features")
def q_top_features(inp):
    imp = TR.importance_frame(inp.spark, _stage(inp, "retention", ("RandomForest",)))
    from sellerscope.functions import pretty_feature_name
    return imp.orderBy(F.col("importance").desc(), "feature").limit(10).withColumn(
        "feature_name", pretty_feature_name("feature"))


@register("evaluate_model")
def q_evaluate_model(inp):
    pre, ret = _stages(inp)
    return TR.evaluate_model(pre).unionByName(TR.evaluate_model(ret))


@register("model_performance")
def q_model_performance(inp):
    rows = []
    for res in _stages(inp):
        scored = TR.held_out(res)
        top = EV.precision_at_top(scored, "label", "p", 0.2).select("precision_at_top")
        ev = attach_scalars(TR.evaluate_model(res), top)
        rows.append(ev.withColumn("train_rows", F.lit(res.sizes["train_rows"]).cast("long")))
    return rows[0].unionByName(rows[1])


@register("cross_validate")
def q_cross_validate(inp):
    return TR.cross_validate(inp.labelled, "never_activated", FE.pre_activation_pipeline(), "LogisticRegression",
                             inp.params)


@register("score_sellers")
def q_score_sellers(inp):
    pre, ret = _stages(inp)
    return SC.score_columns(SC.score_sellers(_labelled(inp), pre.model, ret.model))


@register("model_save_load")
def q_model_save_load(inp):
    pre = _stage(inp, "pre_activation")
    path = scratch_path(inp.spark, "pre_activation_model")
    TR.save_model(pre.model, path)
    loaded = TR.load_model(path)
    return TR.positive_probability(loaded, _labelled(inp), "never_activated_risk").select(
        "seller_id", "never_activated", "never_activated_risk")


def _facts_sql(stage: str, label: str, rows: str) -> str:
    """Rows of the outer test part and of the inner parts, from the md5 splits."""
    split = f"(row_number() OVER (PARTITION BY {label} ORDER BY {HASH}, seller_id) <= ceil(count(*) OVER (PARTITION BY {label}) * 0.25))"
    return f"""
SELECT '{stage}' AS stage, CAST((SELECT count(*) FROM o WHERE t) AS BIGINT) AS outer_test_rows,
  CAST(sum(CAST(NOT i AS INTEGER)) AS BIGINT) AS train_rows, CAST(sum(CAST(i AS INTEGER)) AS BIGINT) AS test_rows,
  3::BIGINT AS candidates, 1::BIGINT AS best, TRUE AS best_has_highest_auc, TRUE AS metrics_in_range, TRUE AS importance_sums_to_one
FROM (SELECT *, {split} AS i FROM (SELECT seller_id, {label} FROM o WHERE NOT t))""".replace("FROM o", f"FROM o_{stage}"), f"""
SELECT seller_id, {label}, {split} AS t FROM f_labelled WHERE {rows}"""


_PRE, _O_PRE = _facts_sql("pre_activation", "never_activated", "TRUE")
_RET, _O_RET = _facts_sql("retention", "dormant", "never_activated = 0")


@register("train_facts", sql=with_ctes(f"{_PRE} UNION ALL {_RET}", o_pre_activation=_O_PRE, o_retention=_O_RET))
def q_train_facts(inp):
    rows = []
    for stage, res in zip(("pre_activation", "retention"), _stages(inp)):
        best = [m for m in res.metrics if m["is_best"]]
        rows.append((stage, *(res.sizes[k] for k in ("outer_test_rows", "train_rows", "test_rows")), len(res.metrics), len(best),
                     best[0]["roc_auc"] == max(m["roc_auc"] for m in res.metrics),
                     all(0 <= m[k] <= 1 for m in res.metrics for k in ("roc_auc", "accuracy", "precision", "recall", "f1_score")),
                     all(abs(sum(v for _, v in x) - 1) < 1e-9 for x in res.importance.values())))
    return inp.spark.createDataFrame(rows, (
        "stage string, outer_test_rows long, train_rows long, test_rows long, candidates long, best long, "
        "best_has_highest_auc boolean, metrics_in_range boolean, importance_sums_to_one boolean"))


@register("score_sellers_facts", sql=with_ctes("""
SELECT seller_id, never_activated = 0 AS has_dormancy_risk, TRUE AS in_range, TRUE AS overall_is_max, TRUE AS category_is_bin
FROM f_labelled"""))
def q_score_sellers_facts(inp):
    from sellerscope.functions import risk_category
    pre, ret = _stages(inp)
    scored = SC.score_sellers(_labelled(inp), pre.model, ret.model)
    never, dormant, overall = F.col("never_activated_risk"), F.col("dormancy_risk"), F.col("overall_churn_risk")
    return scored.select(
        "seller_id", dormant.isNotNull().alias("has_dormancy_risk"),
        (never.between(0, 1) & F.coalesce(dormant, never).between(0, 1)).alias("in_range"),
        (overall == F.greatest(never, dormant)).alias("overall_is_max"),
        F.col("risk_category").eqNullSafe(risk_category("overall_churn_risk")).alias("category_is_bin"))


@register("model_reload_facts", sql=with_ctes("SELECT count(*) AS sellers, TRUE AS reloaded_scores_are_equal FROM f_labelled"))
def q_model_reload_facts(inp):
    pre = _stage(inp, "pre_activation")
    path = scratch_path(inp.spark, "pre_activation_model")
    TR.save_model(pre.model, path)
    both = TR.positive_probability(TR.load_model(path), TR.positive_probability(pre.model, _labelled(inp), "_a"), "_b")
    return both.agg(F.count("*").alias("sellers"), F.bool_and(F.col("_a") == F.col("_b")).alias("reloaded_scores_are_equal"))


def _held_out(inp, stage: str):
    return TR.held_out(_stage(inp, stage))


for _stage_name in ("pre_activation", "retention"):
    def _mk_fitted(stage):
        @register(f"fitted_report_{stage}")
        def _report(inp):
            return EV.classification_report(_held_out(inp, stage), "label")

        @register(f"fitted_confusion_{stage}")
        def _confusion(inp):
            return EV.confusion_matrix(_held_out(inp, stage), "label")

        @register(f"fitted_roc_{stage}")
        def _roc(inp):
            return EV.roc_curve(_held_out(inp, stage), "label", "p")

        @register(f"fitted_pr_{stage}")
        def _pr(inp):
            return EV.pr_curve(_held_out(inp, stage), "label", "p")
    _mk_fitted(_stage_name)


@register("label_dictionary", sql=with_ctes(" UNION ALL ".join(
    f"SELECT '{c}_text' AS \"column\", v AS value, dense_rank() OVER (ORDER BY v) - 1 AS code "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM f_labelled WHERE {c} IS NOT NULL)" for c in FE.CATEGORICALS)))
def q_label_dictionary(inp):
    """The codes of every category column, as the table that is saved with the models."""
    encoder = FE.pre_activation_pipeline().fit(inp.labelled).stages[1]
    return encoder.dictionary


@register("cross_validate_facts", sql=with_ctes(f"""
SELECT fold, count(*) AS rows, TRUE AS auc_in_range FROM (
  SELECT CAST((row_number() OVER (PARTITION BY never_activated ORDER BY {HASH}, seller_id) - 1) % 5 AS INTEGER) AS fold FROM f_labelled)
GROUP BY fold"""))
def q_cross_validate_facts(inp):
    folds = TR.fold_metrics(inp.labelled, "never_activated", FE.pre_activation_pipeline(), "LogisticRegression", inp.params)
    return folds.select("fold", "rows", F.col("roc_auc").between(0, 1).alias("auc_in_range"))


# the largest unit-free gradient of an optimum, which coefficients moved by a twentieth exceed
GRADIENT = 1e-3


@register("train_logreg_facts", sql=with_ctes("""
SELECT 'pre_activation' AS stage, 10::BIGINT AS terms, TRUE AS is_optimal, FALSE AS moved_is_optimal
UNION ALL SELECT 'retention', 10::BIGINT, TRUE, FALSE"""))
def q_train_logreg_facts(inp):
    """Whether the gradient vanishes at the fitted coefficients, and at ones moved by 5 %."""
    out = None
    for stage, res in zip(("pre_activation", "retention"), _stages(inp, ("LogisticRegression",))):
        fit = res.fitted["LogisticRegression"].stages[-1]
        beta, b0 = fit.coefficients.toArray().tolist(), fit.intercept
        small = F.max(F.abs(F.try_divide(F.col("gradient"), F.col("scale")))) < GRADIENT
        one = TR.logreg_gradient(res.train, beta, b0).agg(F.count("*").alias("terms"), small.alias("is_optimal"))
        moved = TR.logreg_gradient(res.train, [1.05 * b for b in beta], b0).agg(small.alias("moved_is_optimal"))
        one = attach_scalars(one, moved).select(F.lit(stage).alias("stage"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _outer_sql(stage: str) -> str:
    return f"(SELECT count(*) FROM o_{stage} WHERE t)"


@register("forest_facts", sql=with_ctes(" UNION ALL ".join(
    f"SELECT '{stage}' AS stage, '{algo}' AS algorithm, 100::BIGINT AS trees, TRUE AS depth_in_bound, TRUE AS every_leaf_has_rows, "
    f"{_outer_sql(stage)} AS scored, TRUE AS scores_equal" for stage in ("pre_activation", "retention")
    for algo in ("RandomForest", "GradientBoosting")), o_pre_activation=_O_PRE, o_retention=_O_RET))
def q_forest_facts(inp):
    """The saved ensembles as tables, and their scores by joins against the models' own."""
    from pyspark.ml.functions import vector_to_array

    from sellerscope.operators import forest
    out = None
    for stage, res in zip(("pre_activation", "retention"), _stages(inp)):
        for algo, depth in (("RandomForest", 10), ("GradientBoosting", 5)):
            model = res.fitted[algo]
            path = scratch_path(inp.spark, "forest")
            model.stages[-1].save(path)
            nodes = materialize(forest.read_forest(inp.spark, path))
            rows = materialize(model.transform(res.outer_test).select("seller_id", vector_to_array(FE.FEATURES_COL).alias("x"),
                                                                      vector_to_array("probability")[1].alias("p")))
            scores = forest.tree_scores(rows, "seller_id", "x", nodes, 100, depth, boosted=algo == "GradientBoosting")
            same = rows.join(scores, "seller_id").agg(F.count("*").alias("scored"), (F.max(F.abs(F.col("p") - F.col("score"))) < 1e-9).alias("scores_equal"))
            shape = forest.node_depths(nodes, depth).agg(
                F.countDistinct("tree").alias("trees"), F.count("*").alias("reached"), F.min(F.when(F.col("left").isNull(), F.col("support"))).alias("least"))
            total = nodes.agg(F.count("*").alias("nodes"))
            one = attach_scalars(attach_scalars(shape, total), same).select(
                F.lit(stage).alias("stage"), F.lit(algo).alias("algorithm"), "trees", (F.col("reached") == F.col("nodes")).alias("depth_in_bound"),
                (F.col("least") > 0).alias("every_leaf_has_rows"), "scored", "scores_equal")
            out = one if out is None else out.unionByName(one)
    return out


@register("fitted_facts", sql=with_ctes(" UNION ALL ".join(
    f"SELECT '{stage}' AS stage, count(*) AS test_rows, CAST(sum({label}) AS BIGINT) AS positives, TRUE AS report_agrees, "
    f"TRUE AS roc_monotone, TRUE AS area_is_auc, TRUE AS recall_monotone, TRUE AS importance_is_share FROM o_{stage} WHERE t"
    for stage, label in (("pre_activation", "never_activated"), ("retention", "dormant"))), o_pre_activation=_O_PRE, o_retention=_O_RET))
def q_fitted_facts(inp):
    """Certificates of the held-out report, confusion table, curves and importances of both winners."""
    out = None
    for stage, res in zip(("pre_activation", "retention"), _stages(inp)):
        held = TR.held_out(res)
        cells = EV.confusion_matrix(held, "label").agg(F.sum("count").alias("test_rows"),
                                                       F.sum(F.when(F.col("label") == 1, F.col("count"))).alias("positives"))
        report = EV.classification_report(held, "label")
        support = report.agg(F.max(F.when(F.col("class_label") == "1", F.col("support"))).alias("r1"),
                             F.max(F.when(F.col("class_label") == "macro avg", F.col("support"))).alias("rn"))
        roc = EV.curve_certificate(EV.roc_curve(held, "label", "p"), "fpr", "tpr").select("monotone", "area")
        recall = EV.curve_certificate(EV.pr_curve(held, "label", "p"), "recall", "recall").select(F.col("monotone").alias("recall_monotone"))
        auc = EV.roc_auc(held, "label", "p")
        one = cells
        for more in (support, roc, recall, auc):
            one = attach_scalars(one, more)
        shares = [v for x in res.importance.values() for _, v in x]
        fine = all(0 <= v <= 1 for v in shares) and abs(sum(shares) - len(res.importance)) < 1e-9
        one = one.select(F.lit(stage).alias("stage"), "test_rows", "positives",
                         ((F.col("r1") == F.col("positives")) & (F.col("rn") == F.col("test_rows"))).alias("report_agrees"),
                         F.col("monotone").alias("roc_monotone"), (F.abs(F.col("area") - F.col("roc_auc")) < 1e-9).alias("area_is_auc"),
                         "recall_monotone", F.lit(fine).alias("importance_is_share"))
        out = one if out is None else out.unionByName(one)
    return out


@register("model_versions", sql=with_ctes("""
SELECT name, version, sellers, TRUE AS loads, latest FROM (VALUES ('pre_activation', 1, FALSE), ('pre_activation', 2, TRUE), ('retention', 1, TRUE))
  AS v(name, version, latest), (SELECT count(*) AS sellers FROM f_labelled)"""))
def q_model_versions(inp):
    """Three published versions beside a half-written one, loaded by name and number; sellers scored by each."""
    root = scratch_path(inp.spark, "registry")
    pre, ret = _stages(inp)
    for model, name in ((pre.fitted["LogisticRegression"], "pre_activation"), (pre.model, "pre_activation"), (ret.model, "retention")):
        TR.publish_model(model, root, name)
    pre.model.stages[0].save(f"{root}/models/pre_activation-half")  # a folder, but no manifest row
    versions = TR.model_versions(inp.spark, root)
    out = None
    for name, number in (("pre_activation", 1), ("pre_activation", 2), ("retention", 1)):
        scored = TR.positive_probability(TR.load_version(inp.spark, root, name, number), _labelled(inp), "_p")
        latest = TR.positive_probability(TR.load_version(inp.spark, root, name), scored, "_q")
        one = latest.agg(F.count("_p").alias("sellers"), F.bool_and(F.col("_p").between(0, 1)).alias("loads"),
                         F.bool_and(F.col("_p") == F.col("_q")).alias("latest")).select(
            F.lit(name).alias("n"), F.lit(number).alias("v"), "*")
        out = one if out is None else out.unionByName(one)
    return versions.join(out, (F.col("name") == F.col("n")) & (F.col("version") == F.col("v"))).select(
        "name", "version", "sellers", "loads", "latest")
