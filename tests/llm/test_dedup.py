import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sellerscope.llm import exact_dedup, linededup, near_dedup
from sellerscope.llm.common import connected_components

SPACE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def exact_expected(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").translate(SPACE), []).append((-len(t or ""), i))
    out = []
    for i, t, *_ in rows:
        norm = (t or "").translate(SPACE)
        keep = min(groups[norm])[1]
        out.append((i, keep, len(groups[norm]), keep == i, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"least": 3, "most": 9}, {"hashed": lambda c: F.xxhash64(c) % 5}])
def test_exact_groups(docs, rows, options):
    got = exact_dedup.exact_groups(docs, **options).collect()
    assert sorted(tuple(r) for r in got) == exact_expected(rows)


def test_exact_native(docs):
    plan = exact_dedup.exact_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_exact_drop(docs, rows, empty):
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, _, _, kept, _ in exact_expected(rows) if kept})
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_exact_copies(empty).count() == 0


def test_exact_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (4, "ab"), (None, "q")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect()}
    assert got == {(None, None, 2, True), (4, None, 2, False), (None, None, 1, True)}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_expected(rows):
    sets, parent = [(i, shingles(t)) for i, t, *_ in rows], {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


@pytest.mark.parametrize("block", [512, 4])
def test_near_groups(docs, rows, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)  # small blocks: large clusters take several rounds
    assert sorted(tuple(r) for r in near_dedup.near_groups(docs).collect()) == near_expected(rows)


def test_near_drop(docs, rows, empty):
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _, _, kept in near_expected(rows) if kept)
    assert near_dedup.near_groups(empty).count() == 0


def test_large_group_of_near_copies(spark, monkeypatch):
    """A hot group whose members mostly differ too much from one another, in chains."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(60)] = f"z{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == near_expected(rows)


def test_large_bucket_of_unlike_members(spark, monkeypatch):
    """Documents that share a band key and mostly nothing else: every pair that sizes and sketches allow must meet."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        sketch = rng.integers(0, 256, 64, dtype=np.uint8).tobytes()
        if i % 10 == 0:  # pairs of equal sketch, sizes at the bound and just beyond it
            rows.append((1000 + i, 3 * (i + 10) + (i % 20 == 0), [5, 100 + i], sketch))
            rows.append((1001 + i, 4 * (i + 10), [5, 200 + i], sketch))
        else:
            rows.append((1000 + i + 1000 * (i % 2), int(rng.integers(20, 700)), [5, 300 + i], sketch))
    sketch = np.array([np.frombuffer(r[3], np.uint8) for r in rows])
    n = np.array([r[1] for r in rows])
    expected = set()
    for i, j in np.argwhere(100 * np.minimum(n[:, None], n) >= 75 * np.maximum(n[:, None], n)):
        if i < j and np.bitwise_count(sketch[i] ^ sketch[j]).sum() <= near_dedup.MOST_BITS:
            expected.add((rows[i][0], rows[j][0]))
    assert len(expected) == 15
    ids = spark.createDataFrame(rows, "rep long, n_shingles long, bands array<long>, sketch binary")
    assert {(min(r), max(r)) for r in near_dedup.candidate_edges(ids).collect()} == expected


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for j in (0.5, 0.75, 0.95):
        n = 2000
        both = int(2 * n * j / (1 + j))
        a = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        x, y = (near_dedup.minhash(s) for s in (a[:n], a[n - both:]))
        bits = np.bitwise_count(near_dedup.odd_sketch(x) ^ near_dedup.odd_sketch(y)).sum()
        differing = np.log(1 - 2 * bits / 512) / np.log(1 - 2 / 512)
        assert abs(1 - differing / 2 / near_dedup.SAMPLES - j) < 0.15
        assert (bits <= near_dedup.MOST_BITS) or j < 0.6


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(200)] + [
        (i, i + 1) for i in range(2000, 2040)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        x, y = sorted((find(u), find(v)))
        parent[y] = x
    touched = {x for u, v in edges if u != v for x in (u, v)}
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in touched}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def changed(rng, s, most):
    s = list(s)
    for _ in range(rng.randint(0, most)):
        k, i = rng.random(), rng.randrange(len(s) + 1)
        if k < 0.33 or i == len(s):
            s.insert(i, rng.choice("abc"))
        elif k < 0.66:
            s.pop(i)
        else:
            s[i] = rng.choice("abc")
    return "".join(s)


def test_banded_distance_and_probes():
    rng = random.Random(5)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = changed(rng, a, 4)
        d = distance(a, b)
        assert linededup.within(a, b) == (d if d <= 2 else None)
        if d <= 2:
            assert (linededup.parity(a) ^ linededup.parity(b)).bit_count() <= 2 * d
            short, long = sorted((a, b), key=len)
            if len(short) >= 3:
                parts = linededup.segments(len(short))
                assert any(long[s:s + n] == short[parts[i][0]:parts[i][0] + n] for i, s, n in linededup.probes(len(long), len(short)))


def test_line_groups(spark, docs, rows):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(36, 60))).strip() + "." for _ in range(12)]
    base += ["Menu | About | Contact", "Page 14 of 90", "Home > News", "Last change: 2024-05-01 ."]
    more = [(500 + i, "\n".join([changed(rng, rng.choice(base), 2) for _ in range(4)] + ["", "short", " padded line \t"]), "en", "a")
            for i in range(30)]
    plain = {i: t for i, t, *_ in [*rows, *more]}
    df = docs.select("doc_id", "text", "lang", "source", "line", "h").dropDuplicates(["doc_id"]).unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string, source string"), allowMissingColumns=True)
    lines = [(i, k, x.strip(" \t\n\x0b\x0c\r")) for i, t in sorted(plain.items()) if t is not None for k, x in enumerate(t.split("\n"))]
    distinct = sorted({x for *_, x in lines if x})
    parent, degree = {x: x for x in distinct}, dict.fromkeys(distinct, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, x in enumerate(distinct):
        for y in distinct[:k]:
            shorter = min(len(x), len(y))
            most = 0 if shorter < 12 else 1 if shorter < 40 else 2
            if most and abs(len(x) - len(y)) <= most and distance(x, y) <= most:
                parent[find(x)] = find(y)
                degree[x] += 1
                degree[y] += 1
    assert sum(degree.values()) > 50
    first = {}
    for i, k, x in lines:
        first.setdefault(find(x) if x else None, (i, k))
    expected = {(i, k): (not x or first[find(x)] == (i, k), degree[x] if x else None) for i, k, x in lines}
    got = {(r.doc_id, r.line_no): (r.kept, r.links) for r in linededup.line_groups(df).collect()}
    assert got == expected
    texts = {r.doc_id: r.text for r in linededup.drop_repeated_lines(df).collect()}
    wanted = {}
    for i, k, x in lines:
        if expected[i, k][0]:
            wanted.setdefault(i, []).append(x)
    assert texts == {i: "\n".join(x) for i, x in wanted.items()}


def test_common_passage(spark, monkeypatch):
    """Very many lines that share a passage, and the characters of their ends, meet few others; no link is lost."""
    rng, made = random.Random(8), []
    passage = "".join(rng.choice("abcdefgh ") for _ in range(60)).strip() + "."
    lines = []
    for side in range(3):  # before, behind and around the rest
        for _ in range(120):
            rest = list("the quick brown fox jumps over")
            rng.shuffle(rest)
            rest = "".join(rest).replace(" ", "_")
            lines.append((rest + passage, passage + rest, rest[:15] + passage + rest[15:])[side])
    lines += [changed(rng, x, 2) for x in lines[::6]]
    lines += [f"{passage[:44]} of {i:03} items" for i in range(60)]
    lines = sorted(set(lines))
    near = {(linededup.line_hash(x), linededup.line_hash(y)) for k, x in enumerate(lines) for y in lines[:k]
            if abs(len(x) - len(y)) <= 2 and linededup.within(x, y) is not None}
    write = linededup.cut
    monkeypatch.setattr(linededup, "cut", lambda df, name: [made.append((name, (out := write(df, name)).count())), out][1])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = linededup.links(df).collect()
    assert {(r.a, r.b) for r in got} == {(min(x), max(x)) for x in near} and len(got) == len(near)
    assert sum(n for name, n in made if name == "pairs") < len(near) + 20 * len(lines)


def test_near_copies_of_a_line(spark, monkeypatch):
    """Lines that are one long line but for some words meet few others, however many they are; no link is lost."""
    rng, made = random.Random(9), []
    words = ["".join(rng.choice("etaoinshr") for _ in range(4)) for _ in range(70)]
    lines = []
    for _ in range(400):
        own = list(words)
        for _ in range(rng.randrange(1, 4)):
            own[rng.randrange(70)] = rng.choice(words)
        lines.append(" ".join(own))
    lines += [changed(rng, x, 2) for x in lines[::8]]
    lines = sorted(set(lines))
    near = {(linededup.line_hash(x), linededup.line_hash(y)) for k, x in enumerate(lines) for y in lines[:k]
            if abs(len(x) - len(y)) <= 2 and linededup.within(x, y) is not None}
    write = linededup.cut
    monkeypatch.setattr(linededup, "cut", lambda df, name: [made.append((name, (out := write(df, name)).count())), out][1])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = linededup.links(df).collect()
    assert {(r.a, r.b) for r in got} == {(min(x), max(x)) for x in near} and len(got) == len(near) > 50
    assert sum(n for name, n in made if name == "pairs") < len(near) + 16 * len(lines)


def test_map_of_pairs():
    rng = random.Random(10)
    for _ in range(2000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = changed(rng, a, 2)
        assert (linededup.pair_parity(a) ^ linededup.pair_parity(b)).bit_count() <= 4 * distance(a, b)


def test_no_lines(empty):
    assert linededup.line_groups(empty).count() == 0


def test_texts_of_candidates(spark):
    """Only the wanted lines leave the task that reads them, once each, whatever their hash's sign."""
    lines = [f"line number {i} of many" for i in range(300)]
    df = spark.createDataFrame([(i, "\n".join(lines[i:i + 3] + ["short"])) for i in range(298)] + [(999, None)], "doc_id long, text string")
    wanted = {linededup.line_hash(x): x for x in lines[::7]}
    assert min(wanted) < 0 < max(wanted)
    got = linededup.texts_of(df, spark.createDataFrame([(h,) for h in wanted], "id long"))
    assert {r.id: r.line for r in got.collect()} == wanted and got.count() == len(wanted)
    assert "ArrowEvalPython" not in got._jdf.queryExecution().executedPlan().toString()  # a second Python process per task
