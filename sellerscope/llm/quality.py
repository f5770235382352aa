"""Quality classifier: document evidence combined with site posteriors, by hierarchical empirical Bayes.

A logistic regression on text statistics, fitted to all labelled documents by Newton steps
whose sums Spark aggregates, gives each document's evidence. Hosts (``source``) and paths
below them (``lang``, the first part of a page's path) get posterior rates: a path is
shrunk toward its host and a host toward the global rate, with the strengths that the
spread between sites shows (method of moments on grouped counts). A sparse site so keeps
its parent's rate. A document's own evidence is left out of its site's rate.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerscope.llm.common import cut, text_or_empty, unused

NAMES = ("log_words", "upper", "symbols", "bars", "exclamations", "digits", "stops", "distinct", "top_word", "repeats",
         "repeated_lines", "word_length", "marks", "log_lines", "one")
KEEP = 0.5
#: bound of the evidence's log odds, and the ridge of the fit
MOST_LOGIT, RIDGE, STEPS = 12.0, 1e-2, 10


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw) or 1
    upper, letters = n[65:91].sum(), (n[65:91].sum() + n[97:123].sum() + n[128:].sum())
    digits, white, stops = n[48:58].sum(), n[9:14].sum() + n[32], n[44] + n[46]
    words, lines = raw.split(), raw.split(b"\n")
    k = len(words) or 1
    count = Counter(words)
    return [np.log1p(len(words)), upper / max(1, letters), (size - letters - digits - white - stops) / size, n[124] / k,
            n[33] / k, digits / size, stops / k, len(count) / k, max(count.values(), default=0) / k,
            sum(map(operator.eq, words, words[1:])) / k, 1 - len(set(lines)) / len(lines), size / k / 10,
            (n[35] + n[36] + n[37] + n[38] + n[42]) / k, np.log1p(len(lines)), 1.0]


def _featured(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "host": pdf["host"], "path": pdf["path"],
                            "x": [features(t) for t in pdf["text"]]})


def featured(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), F.coalesce("lang", F.lit("")).alias("path"),
                       text_or_empty().alias("text")).mapInPandas(
        _featured, f"doc_id {kind}, host string, path string, x array<double>")


def _summed(rows: DataFrame, f) -> np.ndarray:
    """The sum over all rows of f(x, y), a vector whose length does not depend on the rows."""
    def partial(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for pdf in batches:
            if len(pdf):
                total = total + f(np.array(pdf["x"].tolist()), pdf["y"].to_numpy(float))
        if np.ndim(total):
            yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

    got = {r["i"]: r["v"] for r in rows.mapInPandas(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return np.array([got[i] for i in sorted(got)])


def fit(labelled: DataFrame) -> np.ndarray | None:
    """(weights, means, deviations) of a logistic regression on (x, y); None without both classes."""
    m = len(NAMES)
    sums = _summed(labelled, lambda x, y: np.concatenate([x.sum(0), (x * x).sum(0), [len(y), y.sum()]]))
    if not len(sums) or sums[-1] in (0, sums[-2]):
        return None
    rows = sums[-2]
    mean = sums[:m] / rows
    deviation = np.sqrt(np.maximum(sums[m:2 * m] / rows - mean ** 2, 0)) + 1e-9
    mean[-1], deviation[-1] = 0, 1
    w = np.zeros(m)

    for _ in range(STEPS):
        def part(x, y, w=w):
            z = np.clip((x - mean) / deviation, -8, 8)
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            return np.concatenate([z.T @ (p - y), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])

        s = _summed(labelled, part)
        step = np.linalg.solve(s[m:].reshape(m, m) + RIDGE * np.eye(m), s[:m] + RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    return np.array([w, mean, deviation])


def evidence(model: np.ndarray | None) -> Column:
    """Log odds of the document's own evidence, as a column of ``x``."""
    if model is None:
        return F.lit(0.0)
    total = F.lit(0.0)
    for i, (w, mean, deviation) in enumerate(model.T.tolist()):
        z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col("x")[i] - mean) / deviation))
        total = total + z * w
    return F.greatest(F.lit(-MOST_LOGIT), F.least(F.lit(MOST_LOGIT), total))


def _sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def _logit(c: Column) -> Column:
    c = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    return F.log(c / (1 - c))


def strength(rate: float, rows: float, squares: float, spread: float, sites: float) -> float:
    """Beta-binomial prior strength from the weighted spread of ``sites`` rates around ``rate``."""
    noise = rate * (1 - rate)
    room = noise * (rows - squares / max(rows, 1) - sites)
    if noise <= 0 or room <= 0:
        return 1e6
    rho = min(0.99, max(1e-6, (spread - noise * sites) / room))
    return (1 - rho) / rho


def quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """One row per row of ``docs``: doc_id, evidence, host_rate, path_rate, posterior, kept.

    Reads doc_id, text, source and lang of ``docs`` and doc_id and quality of ``labels``; a
    document labelled several times counts with its majority, ties as good. Null texts count
    as empty; null sources and langs are sites of their own. Without labels of both classes
    the evidence is neutral and all rows are kept. An empty table gives an empty result.
    """
    found = cut(featured(docs), "features")
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("l")).agg(
        (F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = cut(found.join(known, F.col("doc_id") == F.col("l")).select("doc_id", "x", "y"), "labelled")
    model = fit(known)
    seen = known.groupBy(F.col("doc_id").alias("l")).agg(F.max("y").alias("y"))
    scored = found.select("doc_id", "host", "path", evidence(model).alias("evidence")).join(
        seen, F.col("doc_id") == F.col("l"), "left").select(
        "doc_id", "host", "path", "evidence", F.coalesce("y", _sigmoid(F.col("evidence"))).alias("e"))
    scored = cut(scored, "scored")
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("e").alias("good"))
    paths = cut(paths, "paths")
    hosts = paths.groupBy(F.col("host").alias("h")).agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    one = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good"), F.count("*").alias("sites"),
                    F.sum(F.col("host_n") * F.col("host_n")).alias("squares"),
                    F.sum(F.col("host_good") * F.col("host_good") / F.col("host_n")).alias("spread")).first()
    rows = one["n"] or 0
    rate = min(1 - 1e-6, max(1e-6, one["good"] / rows)) if rows else 0.5
    by_host = strength(rate, rows, one["squares"] or 0, (one["spread"] or 0) - rows * rate * rate, one["sites"] - 1)
    host_rate = (F.col("host_good") + by_host * rate) / (F.col("host_n") + by_host)
    sites = cut(paths.join(hosts, F.col("host") == F.col("h")).select(
        F.col("host").alias("h"), F.col("path").alias("p"), "n", "good", "host_n", "host_good",
        host_rate.alias("m")), "sites")
    two = sites.agg(F.sum(F.col("n") * F.col("n")).alias("squares"), F.count("*").alias("sites"),
                    F.sum(F.col("n") * (F.col("good") / F.col("n") - F.col("m")) ** 2).alias("spread")).first()
    by_path = strength(rate, rows, two["squares"] or 0, two["spread"] or 0, max(1, two["sites"] - one["sites"]))
    # rates without the document's own evidence
    own_host = (F.col("host_good") - F.col("e") + by_host * rate) / (F.col("host_n") - 1 + by_host)
    own_path = (F.col("good") - F.col("e") + by_path * F.col("host_rate")) / (F.col("n") - 1 + by_path)
    prior = float(np.log(rate / (1 - rate)))
    joined = scored.join(sites, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
    return (joined.withColumn("host_rate", own_host).withColumn("path_rate", own_path)
            .withColumn("posterior", _sigmoid(F.col("evidence") + _logit(F.col("path_rate")) - prior))
            .select("doc_id", "evidence", "host_rate", "path_rate", "posterior",
                    (F.lit(model is None) | (F.col("posterior") >= keep)).alias("kept")))


def drop_low_quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns; a doc_id goes if all its rows do."""
    gone = unused("rejected")
    out = quality(docs, labels, keep).groupBy(F.col("doc_id").alias(gone)).agg(F.max("kept").alias("kept")).where("not kept")
    return docs.join(cut(out.select(gone), "rejected"), F.col("doc_id").eqNullSafe(F.col(gone)), "left_anti")
