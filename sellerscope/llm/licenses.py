"""Licence scans: a trained paragraph classifier whose findings templates confirm.

A multinomial logistic regression on hashed word one- and two-grams tells licence families
from each other and from ordinary text. It is fitted to variants of the notices below, made by
rule, and to a bounded sample of the corpus's own paragraphs without a licence word. The
probability that a paragraph must reach is set on held-out ordinary paragraphs
(``FALSE_ALARMS``), so unlike texts stay in the unknown class. A finding is confirmed if
it holds most of the word triples of one of its family's templates.

Every line is read whole, in overlapping windows. Lines up to the next blank one, comment
marks aside, are a paragraph: windows also run across its line ends, as published notices
are wrapped, and a finding is compared with the templates across line ends too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope.llm.common import cut, ship, shipped, text_or_empty

# Public wordings of licence notices, by family.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license version 3",
             "you can redistribute it and/or modify it under the terms of the gnu affero general public license"],
    "apache": ["licensed under the apache license version 2.0",
               "you may not use this file except in compliance with the license. you may obtain a copy of the license at http://www.apache.org/licenses/license-2.0",
               "this project is released under the apache 2.0 license"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
            "licensed under the 3-clause bsd license", "use of this source code is governed by a bsd-style license"],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license",
              "licensed under cc by-sa 4.0"],
    "cc-by-nc": ["licensed under cc by-nc 4.0", "licensed under cc by-nc-sa 4.0",
                 "this work is licensed under a creative commons attribution-noncommercial 4.0 international license"],
    "cc0": ["this work is dedicated to the public domain under cc0 1.0 universal",
            "this is free and unencumbered software released into the public domain"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu gpl v2 or later",
            "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "isc": ["permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted",
            "licensed under the isc license"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1",
             "this library is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v. 2.0",
            "licensed under the mozilla public license version 2.0"],
    "proprietary": ["all rights reserved", "copyright 2020 all rights reserved", "unauthorized copying or distribution of this file is strictly prohibited proprietary and confidential"],
}
BEFORE = ["", "", "copyright 2021 the authors", "this file is", "the contents of this page are", "note:", "// ", "* "]
AFTER = ["", "", "see the license file for details", "all other material excepted", "by the contributors", "for the full text see the website"]
ORDINARY = ["the driver was asked for a license at the border", "with permission of the author we printed the picture",
            "the work was released in march under a new title", "all rights of way are shown on the general map",
            "the public library is free and open on sunday", "she reserved a table for the general and his wife",
            "version 3 of the plan was published by the office", "the company may use any copy of this report",
            "copyright law was discussed in the lecture", "the software runs on any machine for any purpose"]
CUES = "licen|copyright|rights reserved|redistribut|permission|public domain|creative commons|warrant|cc by|cc0|gnu |bsd"
# end of fixed values

FAMILIES = sorted(TEMPLATES)
BITS = 15
WINDOW, STRIDE = 16, 8
#: words on either side of a window that its templates are compared with too
AROUND = 32
#: bound of the sample of ordinary paragraphs, and the share of held-out ones that may look like a licence
SAMPLE, FALSE_ALARMS = 4_000, 0.001
VARIANTS, ROUNDS, STEP = 90, 40, 0.5
CONFIRMED = 0.6
MEMO = 300_000
#: what a comment mark is made of, and words that are one
MARKS, MARK_WORDS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", frozenset([b"dnl", b"rem"])
STRIP = b".,;:!?\"'()[]{}<>*#/|"


class Grams(dict):
    """Hash place of a word, white space and outer marks aside."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.strip(STRIP)) >> 20
        return h


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def places(words: list[bytes], memo: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every word, and of every word with the one before it (of the first: with none)."""
    h = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    pair = (np.concatenate([[7], h[:-1]]) * 1_000_003 + h * 31) >> 5
    mask = (1 << BITS) - 1
    return h & mask, (pair & mask) | (1 << BITS)


def triples(words: list[bytes]) -> set[tuple[bytes, ...]]:
    w = [x.strip(STRIP) for x in words]
    return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}


def bare(word: bytes) -> bool:
    return not word.strip(MARKS) or word in MARK_WORDS


def wrapped(lines: list[list[bytes]], begin: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words without comment marks at line ends, the line of each, and where paragraphs begin."""
    at, of, starts, n, open_ = [], [], [], 0, False
    for k, (line, a) in enumerate(zip(lines, begin)):
        i, j = 0, len(line)
        while i < j and bare(line[i]):
            i += 1
        while j > i and bare(line[j - 1]):
            j -= 1
        if i < j:
            if not open_:
                starts.append(n)
            at.append(np.arange(a + i, a + j))
            of.append(np.full(j - i, k))
            n += j - i
        open_ = i < j
    none = np.empty(0, np.int64)
    return np.concatenate([none, *at]), np.concatenate([none, *of]), np.array([*starts, n], np.int64)


class Model:
    def __init__(self, weights: np.ndarray, bias: np.ndarray, least: float):
        self.weights, self.bias, self.least = weights, bias, least

    def probabilities(self, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        z = sums / np.sqrt(2.0 * np.maximum(sizes, 1))[:, None] + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def variants(ordinary: list[str], seed: int = 5) -> list[tuple[str, int]]:
    """Notices with words left out and others around them; a third stand inside ordinary text."""
    rng = np.random.default_rng(seed)
    out = []
    for family, templates in TEMPLATES.items():
        for i in range(VARIANTS):
            words = templates[i % len(templates)].split()
            if len(words) > 6:
                words = [w for w in words if rng.random() > 0.06]
            words = [*str(rng.choice(BEFORE)).split(), *words, *str(rng.choice(AFTER)).split()] if i >= len(templates) else words
            if i % 3 == 2 and ordinary:
                around = ordinary[rng.integers(len(ordinary))].split()
                at = int(rng.integers(0, len(around) + 1))
                words = [*around[max(0, at - int(rng.integers(0, 6))):at], *words, *around[at:at + int(rng.integers(0, 6))]]
            out.append((" ".join(words), FAMILIES.index(family)))
    return out


def train(ordinary: list[str]) -> Model:
    """Fit to the variants and to three quarters of the ordinary paragraphs; the others set the bound."""
    rng, memo, unknown = np.random.default_rng(11), Grams(), len(FAMILIES)
    ordinary = sorted(ordinary)
    rows = variants([t for i, t in enumerate(ordinary) if i % 4]) + [(t, unknown) for t in ORDINARY * 6] + [(t, unknown) for i, t in enumerate(ordinary) if i % 4]
    cases = []
    for text, y in rows:
        words = words_of(text)
        at = int(rng.integers(0, max(1, len(words) - WINDOW + 1)))
        words = words[at:at + WINDOW]
        if words:
            cases.append((np.concatenate(places(words, memo)), y, len(words)))
    w, b = np.zeros((2 << BITS, unknown + 1), np.float32), np.zeros(unknown + 1)
    past = np.full_like(w, 1e-3)
    for _ in range(ROUNDS if cases else 0):
        order = rng.permutation(len(cases))
        for low in range(0, len(order), 128):
            part = [cases[i] for i in order[low:low + 128]]
            at = np.concatenate([c[0] for c in part])
            of = np.repeat(np.arange(len(part)), [len(c[0]) for c in part])
            scale = 1 / np.sqrt(np.array([2.0 * c[2] for c in part]))
            sums = np.add.reduceat(w[at], np.concatenate([[0], np.cumsum([len(c[0]) for c in part])[:-1]]))
            z = sums * scale[:, None] + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), [c[1] for c in part]] -= 1
            b -= 0.05 * p.mean(axis=0)
            g = (p * scale[:, None])[of].astype(np.float32)
            np.add.at(past, at, g * g)
            np.add.at(w, at, -STEP * g / np.sqrt(past[at]) / 4)
    model = Model(w, b, 0.5)
    held = [words_of(t)[:WINDOW] for i, t in enumerate(ordinary) if i % 4 == 0]
    held = [x for x in held if x]
    if held:
        sums = np.array([w[np.concatenate(places(x, memo))].sum(axis=0) for x in held])
        best = model.probabilities(sums, np.array([len(x) for x in held]))[:, :-1].max(axis=1)
        model.least = float(max(0.5, min(0.95, np.quantile(best, 1 - FALSE_ALARMS))))
    return model


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model for the corpus: about ``sample`` documents, drawn by a hash of doc_id, give one ordinary line each."""
    n = docs.count()
    draw = (F.xxhash64(F.lit("licence"), "doc_id").cast("double") + 2.0 ** 63) / 2.0 ** 64
    lines = F.filter(F.split(text_or_empty(), "\n"), lambda x: (F.length(x) > 0) & ~F.lower(x).rlike(CUES))
    # whole lines; one per document, by a hash too, so the sample is bounded by its number of documents
    pick = F.element_at("lines", (F.pmod(F.xxhash64("doc_id"), F.size("lines")) + 1).cast("int"))
    drawn = cut(docs.where(draw < min(1.0, sample / max(1, n))).select("doc_id", lines.alias("lines")).where(
        F.size("lines") > 0).select(pick.alias("line")), "ordinary")
    return train([r["line"] for r in drawn.toLocalIterator()])


FOUND = "paragraph int, word int, family string, probability double, similarity double, confirmed boolean"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, families, findings.

    ``findings`` lists the windows whose family reaches the calibrated probability: number of
    the line, first word, family, probability, similarity to the nearest template, confirmed.
    Windows across line ends follow those of lines, unless one of their lines has the family confirmed.
    ``families`` are the confirmed ones. Null and empty texts have none. Repeated rows are
    scanned each; an empty table gives an empty result.
    """
    shared = ship(docs.sparkSession, model)  # of fixed size
    known = {f: [triples(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}

    def find(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, memo, unknown = shipped(shared), Grams(), len(FAMILIES)

        def findings(text: str) -> list[tuple]:
            lines = [words_of(x) for x in text.split("\n")]
            words = [w for x in lines for w in x]
            if not words:
                return []
            one, two = places(words, memo)
            size = np.array([len(x) for x in lines])
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            if two.size and (begin[size > 0] > 0).any():  # a line's first word has none before it
                first = begin[(size > 0) & (begin > 0)]
                h = np.array([memo[words[i]] for i in first], np.int64)
                two[first] = (((7 * 1_000_003 + h * 31) >> 5) & ((1 << BITS) - 1)) | (1 << BITS)
            total = m.weights[one] + m.weights[two]
            starts = [(k, a + s, min(WINDOW, n - s)) for k, (a, n) in enumerate(zip(begin.tolist(), size.tolist())) if n
                      for s in range(0, max(1, n - WINDOW + STRIDE), STRIDE)]
            run = np.concatenate([np.zeros((1, total.shape[1])), np.cumsum(total, axis=0, dtype=np.float64)])
            at, n = np.array([s[1] for s in starts]), np.array([s[2] for s in starts])
            p = m.probabilities(run[at + n] - run[at], n)
            best = p[:, :unknown].argmax(axis=1)
            seq, of, bounds = wrapped(lines, begin.tolist())

            def nearest(family: str, low: int, high: int, line: int | None) -> tuple[float, bool]:
                """Similarity and confirmation of words low to high with those around them in their line and paragraph."""
                have = set()
                if line is not None:
                    first = int(begin[line])
                    have = triples(words[max(first, low - AROUND):min(first + int(size[line]), high + AROUND)])
                i, j = np.searchsorted(seq, [low, high])
                if i < j:
                    a, b = bounds[np.searchsorted(bounds, i, "right") - 1:][:2]
                    have |= triples([words[x] for x in seq[max(a, i - AROUND):min(b, j + AROUND)]])
                best = max(known[family], key=lambda t: len(t & have) / len(t))
                seen = best & have
                near = len(seen) / len(best)
                # notices of related families share wordings: the words go to the one they match better
                taken = near >= CONFIRMED and any(len(t & have) / len(t) > near and 3 * len(t & seen) >= len(seen)
                                                  for f, ts in known.items() if f != family for t in ts)
                return near, near >= CONFIRMED and not taken

            out, sure = [], set()
            for i in np.flatnonzero(p[np.arange(len(p)), best] >= m.least):
                k, a, size_ = starts[i]
                near, confirmed = nearest(FAMILIES[best[i]], a, a + size_, k)
                out.append((k, a - int(begin[k]), FAMILIES[best[i]], float(p[i, best[i]]), near, confirmed))
                if confirmed:
                    sure.add((k, FAMILIES[best[i]]))
            # windows across line ends
            across = [(a + x, min(WINDOW, b - a - x)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()) if of[a] != of[b - 1]
                      for x in range(0, max(1, b - a - WINDOW + STRIDE), STRIDE)]
            across = [(x, c) for x, c in across if of[x] != of[x + c - 1]]
            if not across:
                return out
            total = total[seq]
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            h = np.array([memo[words[i]] for i in seq[first]], np.int64)
            before = np.array([memo[words[i]] for i in seq[first - 1]], np.int64)
            before[np.isin(first, bounds)] = 7  # a paragraph's first word has none before it
            pair = (((before * 1_000_003 + h * 31) >> 5) & ((1 << BITS) - 1)) | (1 << BITS)
            total[first] = m.weights[one[seq[first]]] + m.weights[pair]
            run = np.concatenate([np.zeros((1, total.shape[1])), np.cumsum(total, axis=0, dtype=np.float64)])
            at, n = np.array(across).T
            p = m.probabilities(run[at + n] - run[at], n)
            best = p[:, :unknown].argmax(axis=1)
            for i in np.flatnonzero(p[np.arange(len(p)), best] >= m.least):
                x, last = int(at[i]), int(at[i] + n[i] - 1)
                k, family = int(of[x]), FAMILIES[best[i]]
                if any((line, family) in sure for line in range(k, int(of[last]) + 1)):
                    continue  # found in a line of its own
                near, confirmed = nearest(family, int(seq[x]), int(seq[last]) + 1, None)
                out.append((k, int(seq[x] - begin[k]), family, float(p[i, best[i]]), near, confirmed))
            return out

        for pdf in batches:
            found = [findings(t) for t in pdf["text"]]
            names = [x.strip().split(" ")[0] for x in FOUND.split(",")]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "families": [sorted({x[2] for x in f if x[5]}) for f in found],
                                "findings": [[dict(zip(names, x)) for x in f] for f in found]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(
        find, f"doc_id {kind}, families array<string>, findings array<struct<{FOUND.replace(' ', ':').replace(',:', ',')}>>")
