"""Binary-classifier evaluation as DataFrame aggregations.

Scores and labels stay distributed: counts per distinct score are
pre-aggregated and accumulated with ``ranking.prefix_sums`` (bucketed, no
single-task window), so AUC, ROC and PR share one primitive. A prediction is
the positive class when the score is strictly above the threshold (what a
probabilistic classifier's ``predict`` does at 0.5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope import config as C
from sellerscope.operators.ranking import exact_quantile, prefix_sums
from sellerscope.operators.scalars import attach_scalars


def with_prediction(df: DataFrame, score_col: str, threshold: float = C.DECISION_THRESHOLD,
                    out_col: str = "prediction") -> DataFrame:
    return df.withColumn(out_col, F.coalesce(F.col(score_col) > threshold, F.lit(False)).cast("int"))


def _counts(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    y, p = F.col(label_col) == 1, F.col(pred_col) == 1
    return df.agg(F.sum((y & p).cast("long")).alias("tp"),
                  F.sum((~y & p).cast("long")).alias("fp"),
                  F.sum((y & ~p).cast("long")).alias("fn"),
                  F.sum((~y & ~p).cast("long")).alias("tn"))


def _div0(a, b):
    """a / b, 0 when b is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label_col: str, pred_col: str = "prediction") -> DataFrame:
    """All four (label, prediction, count) cells, zeros included."""
    c = _counts(df, label_col, pred_col)
    cells = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit(pr).alias("prediction"),
                               F.coalesce(F.col(n), F.lit(0)).alias("count"))
                      for lab, pr, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(F.explode(cells).alias("x")).select("x.*")


def binary_metrics(df: DataFrame, label_col: str, pred_col: str = "prediction") -> DataFrame:
    """One row: accuracy, precision, recall, F1 (0 on zero division)."""
    c = _counts(df, label_col, pred_col).na.fill(0)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    return c.select(
        _div0(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def score_table(df: DataFrame, label_col: str, score_col: str, descending: bool = True) -> DataFrame:
    """Per distinct score: positives/negatives at the score and before it
    (descending: strictly higher scores) plus totals."""
    y = F.col(label_col) == 1
    return prefix_sums(df.filter(F.col(label_col).isNotNull()), score_col,
                       {"pos": y.cast("long"), "neg": (~y).cast("long")}, descending=descending)


def roc_auc(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """One row ``roc_auc``: P(score_pos > score_neg) + 0.5 P(tie), i.e. the
    area under the ROC curve with tied scores as diagonal segments."""
    t = score_table(df, label_col, score_col, descending=False)
    one = t.agg(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("_s"),
                F.max("pos_total").alias("_p"), F.max("neg_total").alias("_n"))
    return one.select(F.try_divide(F.col("_s"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc"))


def candidate_metrics(df: DataFrame, by: str, label_col: str, score_col: str,
                      threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """One row per value of ``by`` (a candidate, a fold): roc_auc, accuracy, precision,
    recall and f1_score at ``threshold``, from one table of prefix sums partitioned by it."""
    y = F.col(label_col) == 1
    t = prefix_sums(df.filter(F.col(label_col).isNotNull()), score_col,
                    {"pos": y.cast("long"), "neg": (~y).cast("long")}, partition_cols=(by,))
    hit = F.col(score_col) > threshold

    def total(c: str, pred) -> F.Column:
        return F.coalesce(F.sum(F.when(pred, F.col(c))), F.lit(0))

    one = t.groupBy(by).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("_s"),
        F.max("pos_total").alias("_p"), F.max("neg_total").alias("_n"),
        total("pos", hit).alias("tp"), total("neg", hit).alias("fp"), total("pos", ~hit).alias("fn"), total("neg", ~hit).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return one.select(
        by, F.try_divide(F.col("_s"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc"),
        _div0(tp + tn, tp + fp + fn + tn).alias("accuracy"), _div0(tp, tp + fp).alias("precision"),
        _div0(tp, tp + fn).alias("recall"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def roc_curve(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (a seller is positive at
    score >= threshold), plus the origin at threshold +inf. Intermediate
    collinear points are kept."""
    t = score_table(df, label_col, score_col, descending=True)
    tps = F.col("pos_before") + F.col("pos")
    fps = F.col("neg_before") + F.col("neg")
    pts = t.select(F.col(score_col).cast("double").alias("threshold"),
                   F.try_divide(fps.cast("double"), F.col("neg_total")).alias("fpr"),
                   F.try_divide(tps.cast("double"), F.col("pos_total")).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts).orderBy(F.col("threshold").desc())


def pr_curve(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """(threshold, precision, recall) for distinct scores from the highest
    down to the first that reaches full recall."""
    t = score_table(df, label_col, score_col, descending=True)
    tps = F.col("pos_before") + F.col("pos")
    fps = F.col("neg_before") + F.col("neg")
    return (t.filter(F.col("pos_before") < F.col("pos_total"))
            .select(F.col(score_col).cast("double").alias("threshold"),
                    (tps.cast("double") / (tps + fps).cast("double")).alias("precision"),
                    F.try_divide(tps.cast("double"), F.col("pos_total")).alias("recall"))
            .orderBy(F.col("threshold").desc()))


def curve_certificate(curve: DataFrame, x: str, y: str, buckets: int = 1000) -> DataFrame:
    """One row for a curve of (threshold, x, y): points, whether x and y never fall as the
    threshold does, and the trapezoid area under y over x. It trusts the curve's rows
    only: neighbours are taken inside ranges of the threshold, and the ranges' ends meet in a
    table of at most ``buckets`` + 2 rows."""
    part = F.when(F.col("threshold") > 1, buckets + 1).otherwise(F.floor(F.col("threshold") * buckets)).cast("int")
    rows = curve.select("threshold", F.col(x).alias("x"), F.col(y).alias("y"), part.alias("part"))
    inside = Window.partitionBy("part").orderBy(F.col("threshold").desc())
    rows = rows.withColumns({"x0": F.lag("x").over(inside), "y0": F.lag("y").over(inside)})
    step = (F.col("x") - F.col("x0")) * (F.col("y") + F.col("y0")) / 2
    ok = F.coalesce((F.col("x") >= F.col("x0")) & (F.col("y") >= F.col("y0")), F.lit(True))
    at = F.struct("x", "y")
    ends = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("points"), F.bool_and(ok).alias("ok"), F.coalesce(F.sum(step), F.lit(0.0)).alias("area"),
        F.max_by(at, "threshold").alias("first"), F.min_by(at, "threshold").alias("last"))
    last = F.lag("last").over(Window.partitionBy().orderBy(F.col("part").desc()))
    ends = ends.withColumn("before", last)
    dx, h = F.col("first.x") - F.col("before.x"), F.col("first.y") + F.col("before.y")
    joined = F.coalesce((dx >= 0) & (F.col("first.y") >= F.col("before.y")), F.lit(True))
    return ends.agg(F.sum("points").alias("points"), F.bool_and(F.col("ok") & joined).alias("monotone"),
                    (F.sum("area") + F.coalesce(F.sum(dx * h / 2), F.lit(0.0))).alias("area"))


def pr_auc(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """One row: trapezoid area under the PR curve (starting at precision 1,
    recall 0) and the base rate. Each threshold contributes the trapezoid
    from the previous (higher-threshold) point, whose counts are the
    ``before`` sums, so no ordered pass over all thresholds is needed."""
    t = score_table(df, label_col, score_col, descending=True)
    tp1 = F.col("pos_before") + F.col("pos")
    fp1 = F.col("neg_before") + F.col("neg")
    p_tot = F.col("pos_total").cast("double")
    prec1 = tp1.cast("double") / (tp1 + fp1).cast("double")
    prec0 = F.when(F.col("pos_before") + F.col("neg_before") == 0, F.lit(1.0)).otherwise(
        F.col("pos_before").cast("double") / (F.col("pos_before") + F.col("neg_before")).cast("double"))
    area = (tp1 - F.col("pos_before")).cast("double") / p_tot * (prec1 + prec0) / 2.0
    one = t.filter(F.col("pos_before") < F.col("pos_total")).agg(F.sum(area).alias("pr_auc"))
    base = df.agg(F.avg(F.col(label_col).cast("double")).alias("base_rate"))
    return attach_scalars(one, base)


def classification_report(df: DataFrame, label_col: str, pred_col: str = "prediction") -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and weighted
    means (rows '0', '1', 'accuracy', 'macro avg', 'weighted avg')."""
    c = _counts(df, label_col, pred_col).na.fill(0)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def stats(tp_, fp_, fn_):
        p = _div0(tp_, tp_ + fp_)
        r = _div0(tp_, tp_ + fn_)
        f = _div0(2 * tp_, 2 * tp_ + fp_ + fn_)
        return p, r, f

    p1, r1, f1 = stats(tp, fp, fn)
    p0, r0, f0 = stats(tn, fn, fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    n = s0 + s1
    acc = _div0(tp + tn, tp + tn + fp + fn)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("long").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div0(p0 * s0 + p1 * s1, n), _div0(r0 * s0 + r1 * s1, n),
            _div0(f0 * s0 + f1 * s1, n), n))
    return c.select(F.explode(rows).alias("x")).select("x.*")


def precision_at_top(df: DataFrame, label_col: str, score_col: str, top: float = 0.2) -> DataFrame:
    """One row: the (1 - top) quantile of the scores and the mean label of
    rows scoring at or above it (the top fraction's precision)."""
    q = exact_quantile(df, score_col, 1.0 - top, "threshold")
    flagged = attach_scalars(df, q).filter(F.col(score_col) >= F.col("threshold"))
    return flagged.groupBy("threshold").agg(
        F.avg(F.col(label_col).cast("double")).alias("precision_at_top"),
        F.count(F.lit(1)).alias("flagged"))


def combined_metrics(scored: DataFrame, score_col: str = "overall_churn_risk",
                     label_col: str = "churned") -> DataFrame:
    """Dashboard metrics of the overall risk against churned (missing -> 0):
    AUC plus accuracy / precision / recall / F1 at > 0.5, rounded to 3 dp."""
    d = scored.select(F.coalesce(F.col(score_col), F.lit(0.0)).alias("s"),
                      F.coalesce(F.col(label_col), F.lit(0)).alias("y"))
    auc = roc_auc(d, "y", "s")
    m = binary_metrics(with_prediction(d, "s"), "y")
    out = attach_scalars(auc, m)
    return out.select(*[F.bround(c, 3).alias(c) for c in out.columns])
