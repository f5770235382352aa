import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sellerscope.llm import ann, classlm, langid, licenses, quality
from tests.llm import by_hand


def fold(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


# ---- language identification

def test_kneser_ney_sums_to_one():
    models = [langid.KneserNey({"abc": 5, "abd": 3, "cab": 2, "a": 1}), langid.KneserNey({"dd": 2, "é": 1, "cab": 1})]
    tables = langid.Tables(models)

    def probability(model, context, c):
        gram, value = (context + c)[-4:], 1.0
        for n in range(len(gram), 0, -1):
            if (p := model.prob[n - 1].get(gram[-n:])) is not None:
                return value * p
            value *= model.rest[n - 1].get(gram[-n:-1], 1)
        return value / model.characters

    for model, letters in ((models[0], "abcd ?"), (models[1], "cabdé ?")):  # "?": every unseen character
        for context in (" ", " a", " ab", "abc", "zzz"):
            assert math.isclose(sum(probability(model, context, c) for c in letters), 1)
    for word, got in zip(["abd", "q", "é", "cabcab"], tables.log2(["abd", "q", "é", "cabcab"])):
        w = f" {word} "
        assert np.allclose(got, [sum(math.log2(probability(m, w[max(0, i - 3):i], w[i])) for i in range(1, len(w))) for m in models])


def test_identify(spark, docs):
    rng = random.Random(1)
    sound = {"aa": "bato kule miro sana", "bb": "schwei grund keit pfer", "cc": "eaux oui tion ment"}
    rows = []
    for i in range(300):
        lang = rng.choice(list(sound))
        text = " ".join("".join(rng.choice(sound[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(20))
        rows.append((i, text, lang if rng.random() < 0.9 else None))
    edge = [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", "bb"), (903, None, None)]
    df = spark.createDataFrame(rows + edge, "doc_id long, text string, lang string").withColumn("bits", F.lit(0))
    got = {r.doc_id: r for r in langid.identify(df, langid.fit(df, fold(4) != 2)).collect()}
    held = [r for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902, 903))
    # predictions rest on the text alone
    other = {r.doc_id: r for r in langid.identify(df.withColumn("lang", F.lit("cc")), langid.fit(df, fold(4) != 2)).collect()}
    assert {i: r.lang_pred for i, r in got.items()} == {i: r.lang_pred for i, r in other.items()}
    assert langid.identify(docs, langid.fit(docs, F.lit(True))).count() == docs.count()


def test_identify_without_labels(spark, empty):
    assert langid.fit(empty, F.lit(True)) is None
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.identify(df, langid.fit(df, F.lit(True))).first().lang_pred == "und"


# ---- licences

@pytest.fixture(scope="module")
def model():
    rng = random.Random(6)
    words = "the of and to in that was on are with water house green people under made work time free all".split()
    return licenses.train([" ".join(rng.choice(words) for _ in range(rng.randint(3, 50))) for _ in range(800)])


def test_scan(spark, docs, model):
    filler = "people made green water under the house and that was free time for all of the work " * 20
    cases = {1: ("Released under the MIT License.", ["mit"]), 2: ("x\nLicensed under the Apache License, Version 2.0.\ny", ["apache"]),
             3: ("This work is licensed under the GNU General Public License, version 3.", ["gpl"]),
             4: ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]), 5: ("All rights reserved.\nMore text here", ["proprietary"]),
             6: (filler + "Licensed under the Apache License, Version 2.0. " + filler, ["apache"]), 7: (filler, []), 8: (None, []), 9: ("", []),
             10: ("He got his driving license in June.", []),
             11: ("Released under the MIT License.\n" + filler + "\nAll rights reserved.", ["mit", "proprietary"])}
    df = spark.createDataFrame([(i, t) for i, (t, _) in cases.items()], "doc_id long, text string").withColumn("families", F.lit(0))
    got = {r.doc_id: r for r in licenses.scan(df, model).collect()}
    assert {i: r.families for i, r in got.items()} == {i: f for i, (_, f) in cases.items()}
    assert [(x.paragraph, x.word) for x in got[2].findings] == [(1, 0)]
    whole = licenses.scan(docs, licenses.fit(docs))
    assert whole.count() == docs.count() and not [r for r in whole.collect() if r.families]


# the notices as published, with their line ends
PUBLISHED = {
    "agpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "cc-by": "This work is licensed under a Creative Commons\nAttribution 4.0 International License.",
    "cc-by-nc": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
    "cc0": "This is free and unencumbered software released\ninto the public domain.",
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "proprietary": "Unauthorized copying or distribution of this file\nis strictly prohibited. Proprietary and confidential.",
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_scan_wrapped(spark, model, mark):
    assert sorted(PUBLISHED) == licenses.FAMILIES
    rows = [(f, "\n".join((mark + x).rstrip() for x in ["people made green water", "", *t.split("\n"), "", "under the house"])) for f, t in PUBLISHED.items()]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string"), model).collect()
    assert {r.doc_id: r.families for r in got} == {f: [f] for f in PUBLISHED}


def test_scan_nothing(empty):
    assert licenses.scan(empty, licenses.fit(empty)).count() == 0


# ---- language-model scores

def words_of(text):
    return (text or "").encode().lower().split() + [None]


@pytest.mark.parametrize("frequent", [200_000, 7])
def test_scores(docs, rows, monkeypatch, frequent):
    monkeypatch.setattr(classlm, "FREQUENT", frequent)  # few: most words are joined
    monkeypatch.setattr(classlm, "SEEDS", 6)
    got = classlm.score(docs, fold(7) != 2).collect()
    count = Counter(w for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in words_of(t))
    n, v = sum(count.values()), len(count)
    expected = sorted((i, len(w), sum(x in count for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
                      for i, t, *_ in rows for w in [words_of(t)])
    found = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [x[:4] for x in found] == [x[:4] for x in expected]
    assert np.allclose([x[4] for x in found], [x[4] for x in expected], rtol=1e-9)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_sums_to_one(docs, rows, monkeypatch):
    """After any class, the known words, each tail's unknown word and the end have probability one together."""
    monkeypatch.setattr(classlm, "SEEDS", 6)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    counts = classlm.word_counts(texts)
    model = classlm.Model(counts, texts)
    inside = Counter()
    for r in counts.collect():
        w = r.word.encode()
        if w in model.of:
            inside[model.of[w]] += 10 ** model.inside[w]
        else:
            t = classlm.tail_of(w)
            n, _, discount = model.tail[t]
            inside[model.first_tail + t] += (r.c - discount) / n
    for t in range(classlm.TAILS):
        if model.tail[t][1]:
            inside[model.first_tail + t] += 10 ** model.unknown(t)
    assert np.allclose(list(inside.values()), 1)
    assert np.allclose((10 ** model.move).sum(axis=1), 1)


def test_exchange_finds_classes():
    rng = np.random.default_rng(1)
    pairs = np.zeros((13, 13))
    for _ in range(4000):  # words 0-5 and 6-11 alternate
        a, b = rng.integers(0, 6), rng.integers(6, 12)
        pairs[a, b] += 1
        pairs[b, rng.integers(0, 6)] += 1
    of = classlm.exchange(pairs, 12, classes=2)
    assert len(set(of[:6])) == 1 and len(set(of[6:12])) == 1 and of[0] != of[6]


def sequences(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)


def test_moves_are_the_best_ones(spark):
    """Every word's move against the likelihood of each class it could go to, counted anew."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    texts = []
    for _ in range(80):  # a word never follows itself
        text = [rng.choice(words)]
        for _ in range(rng.randrange(1, 30)):
            text.append(rng.choice([w for w in words[:rng.choice([5, 30])] if w != text[-1]]))
        texts.append(text)
    ids = {w.encode(): i for i, w in enumerate(words)}
    encoded = classlm.encode(sequences(spark, [" ".join(t + ["zz"]) for t in texts]), ids)
    of = np.concatenate([[rng.randrange(5) for _ in range(24)], [4 + classlm.tail_of(b"w9")] * 6, 4 + np.arange(classlm.TAILS + 1)])
    of[:24] %= 4
    table = classlm.pair_counts(encoded, of)

    def counted(change, w):
        """The table with the neighbours of w's occurrences where they are, w's own moved."""
        m, end = len(table), int(of[-1])
        out = np.zeros((m, m))
        for t in texts:
            c = [end, *[change if x == w else of[x] for x in (ids[v.encode()] for v in t)], 4 + classlm.tail_of(b"zz"), end]
            np.add.at(out, (c[:-1], c[1:]), 1)
        return out

    assert np.array_equal(table, counted(of[0], 0))
    got = classlm.moves(classlm.neighbours(encoded, of, len(words)), of, table, 4)
    assert np.array_equal(got[30:], of[30:])
    for w in range(30):
        tried = [classlm.likelihood(counted(k, w)) for k in range(4)]
        assert math.isclose(tried[got[w]], max(tried), rel_tol=1e-12)
    one = [classlm.JUDGED, classlm.GATHERED]
    classlm.JUDGED, classlm.GATHERED = 7, 11  # chunks change nothing
    try:
        assert np.array_equal(classlm.moves(classlm.neighbours(encoded, of, len(words)), of, table, 4), got)
    finally:
        classlm.JUDGED, classlm.GATHERED = one


def test_whole_vocabulary_is_clustered(spark):
    """20,000 words of two kinds that alternate, few of them frequent: far more than the seeds, and nearly all in classes of their kind."""
    rng = random.Random(2)
    uses = [[f"{k}{i}" for i in range(10_000) for _ in range(max(3, 5_000 // (i + 1)))] for k in "ab"]
    for kind in uses:
        rng.shuffle(kind)
    line = [w for pair in zip(*uses) for w in pair]
    texts = sequences(spark, [" ".join(line[i:i + 100]) for i in range(0, len(line), 100)])
    model = classlm.Model(classlm.word_counts(texts), texts)
    assert len(model.of) == 20_000
    kinds = Counter((c, w[:1]) for w, c in model.of.items())
    pure = sum(max(kinds[c, b"a"], kinds[c, b"b"]) for c in set(model.of.values()))
    assert pure > 0.98 * 20_000


def test_score_by_hand(docs, rows, monkeypatch):
    """The model's score against the same formulas over plain counts, with the classes it found."""
    monkeypatch.setattr(classlm, "SEEDS", 6)
    found = {}
    monkeypatch.setattr(classlm, "cluster", lambda encoded, words, real=classlm.cluster: found.setdefault("is", (words, real(encoded, words)))[1])
    got = classlm.score(docs, fold(7) != 2).collect()
    words, (of, _) = found["is"]
    learned = [words_of(t)[:-1] for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    count, end = Counter(w for t in learned for w in t), int(of[-1])
    cls = {w: int(of[i]) for i, w in enumerate(words)}
    assert set(cls) == {w for w, c in count.items() if c >= classlm.LEAST} and len(cls) > 50
    kind = lambda w: cls.get(w, end - classlm.TAILS + classlm.tail_of(w))
    pairs, size, types = Counter(), Counter(), end + 1
    for t in learned:
        c = [end, *map(kind, t), end]
        pairs.update(zip(c, c[1:]))
        size.update(c[1:])
    from_, kinds = Counter(), Counter()
    for (a, _), n in pairs.items():
        from_[a] += n
        kinds[a] += 1

    def moved(a, b):
        k = max(kinds[a], 1)
        return (pairs[a, b] + k * (size[b] + 1) / (sum(size.values()) + types)) / (from_[a] + k)

    def inside(w):
        k = kind(w)
        if w in cls:
            return count[w] / size[k]
        tail = [c for v, c in count.items() if v not in cls and kind(v) == k]
        if not tail:
            return 1.0
        once, twice = tail.count(1), tail.count(2)
        discount = once / (once + 2 * twice) if once else 0.5
        return (count[w] - discount) / sum(tail) if w in count else discount * len(tail) / sum(tail)

    expected = []
    for i, t, *_ in rows:
        text = words_of(t)[:-1]
        c = [end, *map(kind, text), end]
        expected.append((i, sum(math.log10(moved(a, b)) for a, b in zip(c, c[1:])) + sum(math.log10(inside(w)) for w in text)))
    assert np.allclose([s for _, s in sorted(expected)], [s for _, s in sorted((r.doc_id, r.score) for r in got)], rtol=1e-9)


def test_tails_agree(spark):
    words = ["a", "é", "x.", "x,", "1", "x!", "日", "z-", "9."]
    df = spark.createDataFrame([(w,) for w in words], "word string").select("word", classlm.tail_column("word").alias("t"))
    assert all(r.t == classlm.tail_of(r.word.encode()) for r in df.collect())


def test_scores_without_training(docs, empty):
    assert classlm.score(empty, F.lit(True)).count() == 0
    got = classlm.score(docs.limit(3), F.lit(False)).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 3


# ---- quality

def test_quality(spark, docs):
    rng = random.Random(9)
    good = lambda: ". ".join(" ".join(rng.choice("the of and water people house".split()) + str(rng.randrange(99)) for _ in range(9)) for _ in range(4))
    bad = lambda: " | ".join("SPAM!!" + str(rng.randrange(3)) for _ in range(30))
    rows, labels = [], []
    for i in range(400):
        y = int(rng.random() < (0.9 if i % 4 else 0.2))
        rows.append((i, good() if y else bad(), "en", "h0" if i % 4 else "h1"))
        if i % 3:
            labels.append((i, y))
    rows += [(900, None, None, None), (901, "", "en", "sparse")]
    labels += [(1, None), (None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("e", F.lit(1))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality(df, marks).collect()}
    assert len(got) == len(rows)
    truth = {i: "SPAM" not in t for i, t, *_ in rows if i < 900}
    assert all(got[i].kept == y for i, y in truth.items())
    assert got[0].host_rate < 0.4 < 0.8 < got[1].host_rate  # the sites differ
    total = np.mean(list(truth.values()))
    assert abs(got[901].path_rate - total) < 0.1  # a site of one keeps the global rate
    left = quality.drop_low_quality(df, marks)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {i for i, r in got.items() if r.kept}


def test_quality_posterior_by_hand(spark, docs, rows):
    labels = by_hand.labels_of(rows)
    table = spark.createDataFrame([(i, q, 0) for i, q in labels.items()], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id, r.posterior, r.kept) for r in quality.quality(docs, table).collect())
    expected = sorted(by_hand.posteriors(rows, labels))
    assert [x[0] for x in got] == [x[0] for x in expected]
    assert np.allclose([x[1] for x in got], [x[1] for x in expected], atol=1e-6)
    assert [x[2] for x in got] == [x[1] >= quality.KEEP for x in expected] and {x[2] for x in got} == {True, False}


def test_quality_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept for r in quality.quality(docs, none).collect())
    assert quality.quality(empty, none).count() == 0 and quality.drop_low_quality(docs, none).count() == docs.count()


def test_shrinkage_strength():
    rng = np.random.default_rng(3)
    n = rng.integers(20, 200, 500)
    for a, b in ((8, 2), (80, 20)):
        p = rng.beta(a, b, 500)
        good = rng.binomial(n, p)
        rate = good.sum() / n.sum()
        got = quality.strength(rate, n.sum(), (n * n).sum(), (n * (good / n - rate) ** 2).sum(), 499)
        assert 0.6 * (a + b) < got < 1.7 * (a + b)


# ---- nearest neighbours

def brute(vectors, ids, k=10):
    out = {}
    for i, v in zip(ids, vectors):
        if i % 100 == 0:
            d = np.sqrt(((vectors - v) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(ids[j], d[j]) for j in order]
    return out


def test_search(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(900, 8)).astype(np.float32).astype(float)
    v[300:600] = v[300]  # a third are one vector
    v[700:703] = v[10]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    more = [(1000, None), (1100, []), (1200, [0.0] * 8), (1300, [float("nan")] + [1.0] * 7), (1400, [None] + [1.0] * 7),
            (1500, [float("inf")] * 8), (None, [1.0] * 8), (1600, [1.0, 2.0])]
    df = spark.createDataFrame(rows + more, "vec_id long, embedding array<double>").withColumn("vector", F.lit(1)).withColumn("size", F.lit(2))
    got = {}
    for r in ann.search(df, df.where("vec_id % 100 = 0"), shard=128).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(v, np.arange(900))
    assert set(got) == set(want)
    for q, x in want.items():
        assert len(got[q]) == 10 and np.allclose([s for _, s in got[q]], sorted(s for _, s in got[q]))
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 10 * len(want)
    assert got[300] == want[300]  # ties go to the smaller ids


def test_search_small(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (5, [0.0, 1.0]), (5, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.search(df, df.where("vec_id % 100 = 0")).collect()]
    assert got == [(0, 1, 5, math.sqrt(2))]
    none = df.where("vec_id < 0")
    assert ann.search(none, none).count() == 0
