"""Language identification by interpolated Kneser-Ney character models.

Words (maximal runs of letters, lower-cased) are scored character by character, a space
before and after; contexts end at the word's start. Each language has a model of order
``ORDER``: the highest order has counts, the lower ones count distinct characters to the
left, and every order is interpolated with the next by absolute discounting. A model is a
set of sorted arrays, of n-gram hashes and their values, searched by bisection. A text gets
the language with the lowest cross-entropy per character; its score is the calibrated
probability of that choice, and ``rejected`` marks texts worse than nearly all
calibration texts.

The models are fitted to a bounded sample: about ``SAMPLE`` training rows per language,
drawn by a hash of doc_id, whole texts. Every text is then scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerscope.llm.common import cut, ship, shipped, text_or_empty

ORDER = 4
#: training rows per language; a fifth of them calibrates scores instead
SAMPLE = 1000
#: words whose scores a task keeps
MEMO = 300_000
#: share of calibration texts of the right language that are rejected
REJECTED = 0.002
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    """Per predicted character: the n-gram that ends there, shorter at the word's start."""
    w = f" {word} "
    return [w[max(0, i - n + 1):i + 1] for i in range(1, len(w))]


_ODD = np.random.default_rng(5).integers(1 << 40, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hash(g: str) -> int:
    """Sum of code points times the multiplier of their distance from the end."""
    return sum((ord(c) + 1) * int(m) for c, m in zip(reversed(g), _ODD)) & 0xFFFFFFFFFFFFFFFF


class KneserNey:
    """Interpolated probabilities of a language's n-grams, and their contexts' back-off weights."""

    def __init__(self, words: dict[str, int], order: int = ORDER):
        self.order = order
        self.prob: list[dict[str, float]] = []
        self.rest: list[dict[str, float]] = []
        counts: Counter[str] = Counter()
        for word, n in words.items():
            for g in grams(word, order):
                counts[g] += n
        levels = [counts]
        for _ in range(order - 1):  # distinct longer n-grams that end in this one
            lower: Counter[str] = Counter()
            for g in levels[0]:
                if len(g) > 1:
                    lower[g[1:]] += 1
            # an n-gram at a word's start has no longer one above it and keeps its count
            for g, c in levels[0].items():
                if len(g) < order - len(levels) + 1:
                    lower[g] = max(lower[g], c)
            levels.insert(0, lower)
        self.characters = len(levels[0]) + 1
        below: dict[str, float] = {}
        for level in levels:
            ones, twos = sum(c == 1 for c in level.values()), sum(c == 2 for c in level.values())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total, kinds = Counter(), Counter()
            for g, c in level.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            rest = {h: discount * kinds[h] / total[h] for h in total}
            prob = {g: (c - discount) / total[g[:-1]] + rest[g[:-1]] * (
                below.get(g[1:], 1 / self.characters) if len(g) > 1 else 1 / self.characters) for g, c in level.items()}
            self.prob.append(prob)
            self.rest.append(rest)
            below = below | prob


class Tables:
    """The languages' models as sorted hash arrays: per order the n-grams of any language, and
    for each a row of values by language (0: the language lacks the n-gram; contexts: 1)."""

    def __init__(self, models: list[KneserNey]):
        self.order, self.languages = models[0].order, len(models)
        self.uniform = np.array([1 / m.characters for m in models])
        self.prob = [self._table([m.prob[n] for m in models], n + 1, 0.0) for n in range(self.order)]
        self.rest = [self._table([m.rest[n] for m in models], n, 1.0) for n in range(self.order)]

    @staticmethod
    def _table(values: list[dict[str, float]], length: int, missing: float) -> tuple[np.ndarray, np.ndarray]:
        names = sorted({g for v in values for g in v if len(g) == length})
        keys = np.array([gram_hash(g) for g in names], np.uint64)
        order = np.argsort(keys)
        rows = np.array([[v.get(names[i], missing) for v in values] for i in order.tolist()]).reshape(-1, len(values))
        # a last row that no n-gram has, for what is not found
        return np.append(keys[order], np.uint64(0xFFFFFFFFFFFFFFFF)), np.vstack([rows, np.full((1, len(values)), missing)])

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(table[0], keys)
        return table[1][np.where(table[0][at] == keys, at, len(table[0]) - 1)]

    def log2(self, words: list[str]) -> np.ndarray:
        """log2 probability of each word and the space after it, by language."""
        code = np.frombuffer(" ".join(["", *words, ""]).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        space = np.flatnonzero(code == 33)
        depth = np.arange(1, len(code)) - space[np.searchsorted(space, np.arange(1, len(code))) - 1]
        # hashes of the n-grams that end at each character, n from 0 on
        ends = [np.zeros(len(code), np.uint64)]
        for n in range(self.order):
            shifted = np.concatenate([np.zeros(min(n, len(code)), np.uint64), code[:max(0, len(code) - n)]])
            ends.append(ends[-1] + shifted * _ODD[n])
        value = np.zeros((len(depth), self.languages))
        weight = np.ones_like(value)
        rows = np.arange(len(depth))  # characters that some language has not found yet
        for n in range(self.order, 0, -1):
            deep = rows[depth[rows] >= n - 1]
            open_ = value[deep] == 0
            p = self._find(self.prob[n - 1], ends[n][deep + 1])
            value[deep] = np.where(open_, weight[deep] * p, value[deep])
            still = open_ & (p == 0)
            left = still.any(axis=1)
            deep, still = deep[left], still[left]
            weight[deep] *= np.where(still, self._find(self.rest[n - 1], ends[n - 1][deep]), 1.0)
            rows = rows[(value[rows] == 0).any(axis=1)]
        value = np.where(value == 0, weight * self.uniform, value)
        return np.add.reduceat(np.log2(value), space[:-1], axis=0)


#: texts whose new words are scored at once
TOGETHER = 128


class Scorer:
    """Bits and characters of texts under each language, with a bounded memory of words."""

    def __init__(self, tables: Tables):
        self.tables, self.memo, self.rows = tables, {}, np.zeros((0, tables.languages + 1))

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Per text: bits by language, and last the number of scored characters (0: no letter)."""
        tokens = [t.lower().split() for t in texts]
        memo = self.memo
        new = list({w for t in tokens for w in t if w not in memo})
        if len(memo) + len(new) > MEMO:
            memo.clear()
            self.rows, new = self.rows[:0], list({w for t in tokens for w in t})
        if new:
            parts = [LETTERS.findall(t) for t in new]
            added = np.zeros((len(new), self.rows.shape[1]))
            words = list({w for p in parts for w in p})
            if words:
                place = dict(zip(words, range(len(words))))
                score = np.column_stack([self.tables.log2(words), [len(w) + 1.0 for w in words]])
                of = np.array([place[w] for p in parts for w in p])
                owner = np.repeat(np.arange(len(new)), [len(p) for p in parts])
                for j in range(added.shape[1]):
                    added[:, j] = np.bincount(owner, score[of, j], len(new))
            memo.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.concatenate([self.rows, added])
        return np.array([self.rows[np.fromiter(map(memo.__getitem__, t), np.int64, len(t))].sum(axis=0) for t in tokens])


class Model:
    def __init__(self, languages: list[str], tables: Tables):
        self.languages, self.tables, self.scale, self.worst = languages, tables, 1.0, np.inf

    def calibrate(self, texts: list[tuple[str, str]]) -> None:
        """The scale of entropy differences that makes scores probabilities, and the rejection bound."""
        scorer, gaps, right, own = Scorer(self.tables), [], [], []
        for lang, text in texts:
            s = scorer([text])[0]
            if s[-1]:
                bits = -s[:-1] / s[-1]
                gaps.append(bits - bits.min())
                right.append(self.languages.index(lang))
                own.append(bits.min())
        if not gaps:
            return
        gaps, right = np.array(gaps), np.array(right)

        def loss(scale: float) -> float:
            z = -scale * gaps
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), right]).mean())

        self.scale = min(2.0 ** np.arange(-3, 6.25, 0.25), key=loss)
        self.worst = float(np.quantile(own, 1 - REJECTED))


def training_words(sample: DataFrame) -> dict[str, Counter]:
    """Counts of each language's words, combined in tasks."""
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                seen.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
        rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
        yield pd.DataFrame(rows, columns=["lang", "word", "n"])

    counts = sample.select("lang", "text").mapInPandas(count, "lang string, word string, n long")
    out: dict[str, Counter] = {}
    for r in counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).toLocalIterator():  # of the bounded sample
        out.setdefault(r["lang"], Counter())[r["word"]] = r["n"]
    return out


def fit(docs: DataFrame, training: Column, sample: int = SAMPLE) -> Model | None:
    """Models of the languages of the training rows; None if no row has a language and a letter."""
    rows = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not sizes:
        return None
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    draw = (F.xxhash64(F.lit("draw"), "doc_id").cast("double") + 2.0 ** 63) / 2.0 ** 64
    drawn = cut(rows.where(draw < share), "sample")
    calibrates = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5)) == 0
    words = training_words(drawn.where(~calibrates))
    words = words if words and set(words) == set(sizes) else training_words(drawn)
    words = {lang: c for lang, c in words.items() if c}
    if not words:
        return None
    languages = sorted(words)
    model = Model(languages, Tables([KneserNey(words[lang]) for lang in languages]))
    model.calibrate([(r["lang"], r["text"]) for r in drawn.where(calibrates).toLocalIterator() if r["lang"] in words])
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, bits, rejected.

    ``und`` with score 0 if the text is null, empty or has no letter, or nothing was learned;
    of equal entropies the first language by name wins. Nothing but the text decides.
    """
    shared = ship(docs.sparkSession, model)  # bounded by the sample

    def predict(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shipped(shared)
        scorer = Scorer(m.tables) if m else None
        for pdf in batches:
            rows, texts = [], pdf["text"].tolist()
            sums = [x for i in range(0, len(texts), TOGETHER) for x in scorer(texts[i:i + TOGETHER])] if m else [np.zeros(1)] * len(texts)
            for doc_id, s in zip(pdf["doc_id"], sums):
                if not s[-1]:
                    rows.append((doc_id, UNDETERMINED, 0.0, None, False))
                    continue
                bits = -s[:-1] / s[-1]
                best = int(bits.argmin())
                rows.append((doc_id, m.languages[best], float(1 / np.exp(-m.scale * (bits - bits[best])).sum()),
                             float(bits[best]), bool(bits[best] > m.worst)))
            yield pd.DataFrame(rows, columns=["doc_id", "lang_pred", "score", "bits", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(
        predict, f"doc_id {kind}, lang_pred string, score double, bits double, rejected boolean")
