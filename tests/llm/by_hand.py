"""The quality posterior of small tables without Spark: one pass of plain loops over all rows."""

import math
from collections import defaultdict

import numpy as np

from sellerscope.llm import quality


def logistic(x, y):
    """Weights, means and deviations of the ridge logistic regression, by Newton steps over the whole matrix."""
    mean, deviation = x.mean(0), np.sqrt(np.maximum((x * x).mean(0) - x.mean(0) ** 2, 0)) + 1e-9
    mean[-1], deviation[-1] = 0, 1
    z, w = np.clip((x - mean) / deviation, -8, 8), np.zeros(x.shape[1])
    for _ in range(quality.STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + quality.RIDGE * np.eye(len(w)), z.T @ (p - y) + quality.RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    return w, mean, deviation


def spread_strength(groups, rate, degrees, rows):
    """Strength of the beta prior by moments: the spread of group rates around their parents', less what chance gives."""
    noise = rate * (1 - rate)
    room = noise * (rows - sum(n * n for n, _, _ in groups) / rows - degrees)
    if noise <= 0 or room <= 0:
        return 1e6
    spread = sum(n * (good / n - parent) ** 2 for n, good, parent in groups)
    rho = min(0.99, max(1e-6, (spread - noise * degrees) / room))
    return (1 - rho) / rho


def posteriors(rows, labels):
    """[(doc_id, posterior)] of rows (doc_id, text, lang, source) by labels {doc_id: 0 or 1}."""
    x = np.array([quality.features(t or "") for _, t, _, _ in rows])
    known = [i for i, r in enumerate(rows) if r[0] in labels]
    w, mean, deviation = logistic(x[known], np.array([labels[rows[i][0]] for i in known], float))
    own = np.clip(np.clip((x - mean) / deviation, -8, 8) @ w, -quality.MOST_LOGIT, quality.MOST_LOGIT)
    e = [labels.get(r[0], 1 / (1 + math.exp(-z))) for r, z in zip(rows, own)]
    host, path = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for r, v in zip(rows, e):
        for site in (host[r[3] or ""], path[r[3] or "", r[2] or ""]):
            site[0] += 1
            site[1] += v
    n = len(rows)
    rate = min(1 - 1e-6, max(1e-6, sum(e) / n))
    a = spread_strength([(k, g, rate) for k, g in host.values()], rate, len(host) - 1, n)
    shrunk = {h: (g + a * rate) / (k + a) for h, (k, g) in host.items()}
    b = spread_strength([(k, g, shrunk[h]) for (h, _), (k, g) in path.items()], rate, max(1, len(path) - len(host)), n)
    out = []
    for r, z, v in zip(rows, own, e):
        hk, hg = host[r[3] or ""]
        pk, pg = path[r[3] or "", r[2] or ""]
        above = (hg - v + a * rate) / (hk - 1 + a)
        site = min(1 - 1e-6, max(1e-6, (pg - v + b * above) / (pk - 1 + b)))
        out.append((r[0], 1 / (1 + math.exp(-(z + math.log(site / (1 - site)) - math.log(rate / (1 - rate)))))))
    return out


def labels_of(rows):
    """Labels of both classes for a third of the rows: texts of under 30 words are poor."""
    return {r[0]: int(len((r[1] or "").split()) >= 30) for r in rows if r[0] % 3 == 0}
