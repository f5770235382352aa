"""Scores of texts under a Brown class-based bigram model.

Words are counted over all training texts. Those seen ``LEAST`` times or more, among the
``FREQUENT`` most frequent that fit a task's memory, are put into ``CLASSES`` classes by exchange
clustering. The ``SEEDS`` most frequent words are exchanged one after the other in the driver;
then, in sweeps, each word moves to the class that raises the class bigram likelihood most, with
the others where they are. Spark counts every word's neighbour classes and the moves are
found in tasks. Where a sweep's moves together do not raise the likelihood, those of every second
word are tried; if these do not either, the clustering ends.
Every other word belongs to the tail class of its last character's kind, and the end of a text
is a class of its own. A word's probability is that of its class after the class before it, times
that of the word within its class.

Transitions are smoothed with the classes' own frequencies (Witten and Bell); within a tail
class, absolute discounting leaves a share for unknown words, which are one outcome. So the
probabilities of all outcomes after any word sum to one.

The ``FREQUENT`` most frequent words, a bounded number, are looked up where the texts are; the
rest, per document and word, is joined with the whole table of counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerscope.llm.common import cut, ship, shipped, text_or_empty

FREQUENT, SEEDS, CLASSES, SEED_SWEEPS = 200_000, 512, 32, 8
#: occurrences from which on a word is clustered, and sweeps over all clustered words
LEAST, SWEEPS = 3, 2
#: words that a task counts, and neighbours that it gathers, before it hands them on
FLUSH, GATHERED = 250_000, 2_000_000
#: neighbour counts whose moves a task judges at once
JUDGED = 50_000
#: kinds of a tail word's last byte: letter, digit, stop, comma, other mark
TAILS = 5


def tail_of(word: bytes) -> int:
    last = word[-1]
    if last == 46:
        return 2
    if last == 44:
        return 3
    if last >= 128 or 97 <= last <= 122:
        return 0
    return 1 if 48 <= last <= 57 else 4


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8").lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows; tasks hand on what they have counted whenever it fills their bound."""
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()

        def out() -> pd.DataFrame:
            frame = pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())}).astype({"n": "int64"})
            seen.clear()
            return frame

        for pdf in batches:
            for text in pdf["text"]:
                seen.update(words_of(text))
                if len(seen) >= FLUSH:
                    yield out()
        if seen:
            yield out()

    return texts.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def encode(texts: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """(states): per text its 32-bit states: clustered words, tails, and the end (which also begins a text)."""
    shared, tails = texts.sparkSession.sparkContext.broadcast(ids), len(ids)

    def states(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, end = shared.value, tails + TAILS

        def one(text: str) -> bytes:
            words = words_of(text)
            found = list(map(known.get, words))
            if None in found:
                found = [tails + tail_of(w) if i is None else i for w, i in zip(words, found)]
            return np.array([end, *found, end], np.int32).tobytes()

        for pdf in batches:
            yield pd.DataFrame({"states": [one(text) for text in pdf["text"]]})

    return texts.select("text").mapInPandas(states, "states binary")


def pair_counts(encoded: DataFrame, of: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes; ``of`` has the class of every state."""
    shared, classes = encoded.sparkSession.sparkContext.broadcast(of), int(of.max()) + 1

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(classes * classes, np.int64)
        for pdf in batches:
            for states in pdf["states"]:
                c = shared.value[np.frombuffer(states, np.int32)]
                at, n = np.unique(c[:-1] * classes + c[1:], return_counts=True)
                total[at] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    rows = encoded.mapInPandas(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    pairs, found = np.zeros(classes * classes), rows.toArrow()  # classes squared at most
    pairs[found["at"].to_numpy()] = found["n"].to_numpy()
    return pairs.reshape(classes, classes)


def neighbours(encoded: DataFrame, of: np.ndarray, words: int) -> DataFrame:
    """(state, at, n) of the clustered words: how often class ``at`` follows, and class ``at - classes`` precedes."""
    shared, classes = encoded.sparkSession.sparkContext.broadcast(of), int(of.max()) + 1

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def out() -> pd.DataFrame:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pd.DataFrame({"state": (at // (2 * classes)).astype(np.int32), "at": (at % (2 * classes)).astype(np.int32), "n": n})

        for pdf in batches:
            for states in pdf["states"]:
                s = np.frombuffer(states, np.int32).astype(np.int64)
                c = shared.value[s]
                keys = np.concatenate([s[:-1] * 2 * classes + c[1:], s[1:] * 2 * classes + classes + c[:-1]])
                held.append(keys[keys < words * 2 * classes])
                size += len(keys)
                if size >= GATHERED:
                    yield out()
                    size = 0
        if held:
            yield out()

    return encoded.mapInPandas(count, "state int, at int, n long").groupBy("state", "at").agg(F.sum("n").alias("n"))


def moves(counted: DataFrame, of: np.ndarray, table: np.ndarray, classes: int) -> np.ndarray:
    """The classes after one sweep: every word's best of the first ``classes`` classes, the neighbours where they are
    (where a word follows itself, its own old class)."""
    shared, m = counted.sparkSession.sparkContext.broadcast((of, table)), len(table)

    def gain(have: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What n more add to x log x."""
        have = np.maximum(have, 0)
        return _xlogx(have + n[:, None]) - _xlogx(have)

    def judge(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, table = shared.value
        frames = [pdf for pdf in batches if len(pdf)]
        if not frames:
            return
        rows = pd.concat(frames).sort_values("state", kind="stable")
        state, at, n = rows["state"].to_numpy(), rows["at"].to_numpy(), rows["n"].to_numpy().astype(float)
        first = np.flatnonzero(np.r_[True, state[1:] != state[:-1]])
        edges = np.append(first, len(state))
        i = 0
        while i < len(first):  # whole words, about JUDGED counts at once
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + JUDGED, "right")) - 1)
            part, word = slice(edges[i], edges[j]), state[first[i:j]]
            row = np.repeat(np.arange(j - i), np.diff(edges[i:j + 1]))
            near = np.zeros((j - i, 2 * m))
            near[row, at[part]] = n[part]
            after, before = near[:, :m], near[:, m:]
            total = np.zeros((j - i, classes))
            for x, y, cells in ((after, before, table[:classes].T), (before, after, table[:, :classes])):
                r, c = np.nonzero(x)
                own, have, all_ = of[word[r]], cells[c], np.arange(len(r))
                old = own < classes  # the word leaves its own class first, on both sides
                have[all_[old], own[old]] -= x[r, c][old]
                have[c == own] -= y[r[c == own], :classes]
                if x is before:  # a class before itself has got the other side already
                    same = c < classes
                    have[all_[same], c[same]] += y[r, c][same]
                np.add.at(total, r, gain(have, x[r, c]))
                size, times = np.repeat(cells.sum(0)[None], j - i, axis=0), x.sum(1)
                old = of[word] < classes
                size[np.flatnonzero(old), of[word][old]] -= times[old]
                total -= gain(size, times)
            yield pd.DataFrame({"state": word, "class": total.argmax(1).astype(np.int32)})
            i = j

    moved, found = of.copy(), counted.repartition("state").mapInPandas(judge, "state int, class int").toArrow()  # FREQUENT rows
    moved[found["state"].to_numpy()] = found["class"].to_numpy()
    return moved


def cluster(encoded: DataFrame, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The class of every state (words, tails, end) and the counts of neighbouring classes."""
    seeds = min(SEEDS, len(words))
    fixed = np.array([seeds + tail_of(w) for w in words[seeds:]] + [seeds + t for t in range(TAILS + 1)])
    alone = np.concatenate([np.arange(seeds), fixed]).astype(np.int64)
    of = exchange(pair_counts(encoded, alone), seeds)
    classes = int(of[seeds])  # tails and the end follow
    of = of[alone]
    table = pair_counts(encoded, of)
    for _ in range(SWEEPS if len(words) > seeds else 0):
        moved = moves(neighbours(encoded, of, len(words)), of, table, classes)
        for taken in (np.ones(len(of), bool), np.arange(len(of)) % 2 == 0):  # words that follow each other may move past each other
            now = np.where(taken, moved, of)
            after = pair_counts(encoded, now)
            if rises := likelihood(after) > likelihood(table):
                of, table = now, after
                break
        if not rises:
            break
    return of, table


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """The class bigram log likelihood, up to a constant of the texts."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def exchange(pairs: np.ndarray, words: int, classes: int = CLASSES, sweeps: int = SEED_SWEEPS) -> np.ndarray:
    """The class of every state: words by exchange, the other states each their own."""
    others = len(pairs) - words
    classes = max(1, min(classes, words)) if words else 0
    of = np.concatenate([np.arange(words) % max(1, classes), classes + np.arange(others)])
    m = classes + others
    one = np.eye(m)
    table = one[of].T @ pairs @ one[of]

    def loss(t: np.ndarray) -> np.ndarray:  # of a stack of tables: what the likelihood lacks
        return _xlogx(t.sum(-1)).sum(-1) + _xlogx(t.sum(-2)).sum(-1) - _xlogx(t).sum((-1, -2))

    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            was = of[w]
            after, before, own = pairs[w] @ one[of], pairs[:, w] @ one[of], pairs[w, w]
            after[was] -= own
            before[was] -= own
            rest = table.copy()
            rest[was] -= after
            rest[:, was] -= before
            rest[was, was] -= own
            tried = np.repeat(rest[None], classes, axis=0)
            k = np.arange(classes)
            tried[k, k] += after
            tried[k, :, k] += before
            tried[k, k, k] += own
            best = int(loss(tried).argmin())
            table = tried[best]
            moved += best != was
            of[w] = best
        if not moved:
            break
    return of


def frequent(counts: DataFrame) -> tuple[dict[bytes, int], Column]:
    """About FREQUENT of the most frequent words, most frequent first, and which rows of ``counts`` they are: all whose count
    reaches a step of a logarithmic scale, and of the next step a hashed share. The scale's sizes, and then only those
    words, come to the driver."""
    step = F.floor(F.log2("c") * 16).cast("int")
    sizes = {r["s"]: r["n"] for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()}  # 16 a doubling
    taken, least, share = 0, max(sizes, default=0) + 1, F.lit(False)
    for s in sorted(sizes, reverse=True):
        if taken + sizes[s] > FREQUENT:
            share = (step == s) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < (FREQUENT - taken) * (1 << 20) // sizes[s])
            break
        taken, least = taken + sizes[s], s
    chosen = (step >= least) | share
    rows = counts.where(chosen).select("word", "c").toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    return {w.encode(): c for w, c in zip(rows["word"].to_pylist(), rows["c"].to_pylist())}, chosen


class Model:
    """What the scoring tasks need; its size is bounded by FREQUENT."""

    def __init__(self, counts: DataFrame, training: DataFrame):
        one = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.texts = training.count()
        self.tokens, self.types = (one["n"] or 0) + self.texts, one["v"] + (self.texts > 0)
        self.count, chosen = frequent(counts)
        ids = {w: i for i, w in enumerate(w for w, c in self.count.items() if c >= LEAST)}
        of, n = cluster(cut(encode(training, ids), "states"), list(ids))
        follow, own = n.sum(1, keepdims=True), (n.sum(0) + 1) / (n.sum() + len(n))
        kinds = np.maximum((n > 0).sum(1, keepdims=True), 1)
        self.move = np.log10((n + kinds * own) / (follow + kinds))
        self.of = {w: int(of[i]) for w, i in ids.items()}
        self.first_tail, self.end = int(of[len(ids)]), int(of[-1])
        size = n.sum(0)
        self.inside = {w: float(np.log10(self.count[w] / size[c])) for w, c in self.of.items()}
        # tails: how many words and types, and how many of them once and twice
        tails = counts.where(~(chosen & (F.col("c") >= LEAST))).select(
            tail_column("word").alias("t"), "c").groupBy("t").agg(
            F.sum("c").alias("n"), F.count("*").alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("once"),
            F.sum((F.col("c") == 2).cast("long")).alias("twice")).collect()
        self.tail = {t: (1, 0, 1.0) for t in range(TAILS)}  # words, types, discount
        for r in tails:
            self.tail[r["t"]] = (r["n"], r["v"], r["once"] / (r["once"] + 2 * r["twice"]) if r["once"] else 0.5)

    def unknown(self, t: int) -> float:
        n, v, discount = self.tail[t]
        return float(np.log10(discount * v / n)) if v else 0.0


def tail_column(word: str) -> Column:
    last = F.substring(F.col(word), -1, 1)
    return (F.when(last == ".", 2).when(last == ",", 3)
            .when((F.octet_length(last) > 1) | last.between("a", "z"), 0).when(last.between("0", "9"), 1).otherwise(4))


def score(docs: DataFrame, training: Column) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is one end token. Without a training row every token has base
    probability 1 and the model's score is the base score. Repeated rows are counted and
    scored each. Other columns are not read; an empty table gives an empty result.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    learned = docs.where(training).select(text_or_empty().alias("text"))
    counts = cut(word_counts(learned), "counts")
    model = Model(counts, learned)
    shared = ship(spark, model)

    def look_up(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shipped(shared)
        base = np.log10(m.tokens + m.types + 1)
        row = TaskContext.get().partitionId() << 40
        end_known, ends = int(m.tokens > 0), np.log10(m.texts + 1) - base

        def entry(w: bytes, c: int) -> tuple[int, float, float]:
            """Class, base and inner log probability."""
            if w in m.of:
                return m.of[w], np.log10(c + 1) - base, m.inside[w]
            t = tail_of(w)
            n, _, discount = m.tail[t]
            return m.first_tail + t, np.log10(c + 1) - base, np.log10((c - discount) / n)

        # the words' numbers; those of a tail whose counts are not here follow
        place, unseen = {w: i for i, w in enumerate(m.count)}, len(m.count)
        known = [entry(w, c) for w, c in m.count.items()] + [(m.first_tail + t, 0.0, 0.0) for t in range(TAILS)]
        of, word_base, inside = (np.array(x) for x in zip(*known))
        for pdf in batches:
            docs, rows, tokens, rares, sums, scores = [], [], [], [], [], []
            rare_row, rare_word, rare_times = [], [], []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                words = words_of(text)
                row += 1
                found = list(map(place.get, words))
                rare = 0
                if None in found:
                    more = Counter(w for w, i in zip(words, found) if i is None)
                    found = [unseen + tail_of(w) if i is None else i for w, i in zip(words, found)]
                    rare = more.total()
                    rare_row += [row] * len(more)
                    rare_word += [w.decode() for w in more]
                    rare_times += more.values()
                at = np.array(found, np.int64)
                state = np.concatenate(([m.end], of[at], [m.end]))
                docs.append(doc_id)
                rows.append(row)
                tokens.append(len(words) + 1)
                rares.append(rare)
                sums.append(float(word_base[at].sum()) + ends)
                scores.append(float(m.move[state[:-1], state[1:]].sum()) + float(inside[at].sum()))
            n, k = np.array(tokens, np.int64), np.array(rares, np.int64)
            yield pd.DataFrame({"row": rows, "doc_id": pd.Series(docs, dtype=pdf["doc_id"].dtype), "word": None, "times": 0, "n_tokens": n,
                                "n_known": n - 1 - k + end_known, "base": sums, "score": scores})
            if rare_row:
                yield pd.DataFrame({"row": rare_row, "doc_id": None, "word": rare_word, "times": rare_times, "n_tokens": 0, "n_known": 0,
                                    "base": 0.0, "score": 0.0})

    parts = cut(texts.mapInPandas(look_up, f"row long, doc_id {kind}, word string, times long, n_tokens long, "
                                           "n_known long, base double, score double"), "parts")
    n, discount, unknown = (F.create_map(*[x for t in range(TAILS) for x in (F.lit(t), F.lit(float(value(t))))]) for value in (
        lambda t: model.tail[t][0], lambda t: model.tail[t][2], model.unknown))
    rare = parts.where("word is not null").select("row", "word", "times").join(
        counts.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left").withColumn("t", tail_column("word"))
    inner = F.when(F.col("c").isNull(), unknown[F.col("t")]).otherwise(F.log10((F.col("c") - discount[F.col("t")]) / n[F.col("t")]))
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - float(np.log10(model.tokens + model.types + 1)))).alias("more_base"),
        F.sum(F.col("times") * inner).alias("more_score")).withColumnRenamed("row", "r")
    whole = parts.where("word is null").join(rare, F.col("row") == F.col("r"), "left")
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0))
    return whole.select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
                        (F.col("score") + F.coalesce("more_score", F.lit(0.0)) if model.tokens else base).alias("score"))
