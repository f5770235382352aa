import bisect
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sellerscope.llm import mixing, packing
from tests.llm import by_hand

PATH = public_tokenizers.path("word_bpe_49k.json")


def placed(histogram, runs, capacity=packing.CAPACITY):
    """Checks that runs place every piece once, without gaps; the number of sequences."""
    sequences, ranks = {}, {}
    for length, first, count, each, sequence, at in runs:
        ranks.setdefault(length, []).append((first, count))
        for k in range(count):
            sequences.setdefault(sequence + k // each, []).append((at + k % each * length, length))
    assert {k: sum(c for _, c in x) for k, x in ranks.items()} == dict(histogram)
    for x in ranks.values():
        at = 0
        for first, count in sorted(x):
            assert first == at
            at += count
    for x in sequences.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def best_fit_decreasing(histogram, capacity=packing.CAPACITY):
    rooms, n = [], 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                n, room = n + 1, capacity
            else:
                room = rooms.pop(i)
            bisect.insort(rooms, room - length)
    return n


@pytest.mark.parametrize("draw", [
    lambda r: min(2048, max(1, int(r.lognormvariate(6.3, 1.1)))), lambda r: r.randint(1, 2048), lambda r: r.randint(600, 1100),
    lambda r: r.choice([683, 700, 1365, 300, 1000]), lambda r: 5, lambda r: 2048])
def test_plan(draw):
    rng = random.Random(1)
    for n in (1, 40, 1500):
        histogram = {}
        for _ in range(n):
            length = draw(rng)
            histogram[length] = histogram.get(length, 0) + 1
        used = placed(histogram, packing.plan_runs(histogram))
        assert math.ceil(sum(a * b for a, b in histogram.items()) / 2048) <= used <= best_fit_decreasing(histogram)
    assert packing.plan_runs({}) == []


def test_configurations_beat_best_fit():
    rng = random.Random(1)
    histogram = {}
    for _ in range(4000):
        length = rng.randint(600, 1100)
        histogram[length] = histogram.get(length, 0) + 1
    assert placed(histogram, packing.plan_runs(histogram)) < best_fit_decreasing(histogram)


def pieces_of(rows, capacity=packing.CAPACITY):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for i, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(ids[k:k + capacity].tobytes())) for k in range(0, len(ids), capacity)]
    return sorted(out)


def check_packed(got, capacity=packing.CAPACITY):
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in sequences.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pack(docs, rows, empty, capacity):
    odd = "don't it's x<|endoftext|>y cod́e İstanbul ΣΑΣ 12ab3 a.b,c ...!! ｆｕｌｌ ﬁ éa a b c\x1cd Ÿ µ ª"
    df = docs.withColumn("text", F.when(F.col("doc_id") == 7, odd).otherwise(F.col("text")))
    rows = [(i, odd if i == 7 else t) for i, t, *_ in rows]
    got = packing.pack(df, PATH, capacity).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces_of(rows, capacity)
    check_packed(got, capacity)
    assert packing.pack(empty, PATH, capacity).count() == 0


# ---- mixing

def test_period_is_fair():
    rng = random.Random(0)
    for _ in range(100):
        shares = {i: rng.randint(1, 20) for i in range(rng.randint(1, 8))}
        total, plan, done = sum(shares.values()), mixing.period(shares), dict.fromkeys(shares, 0)
        assert [x[4] for x in plan] == list(range(total))
        for i, _, release, deadline, slot in plan:
            assert release <= slot < deadline
            done[i] += 1
            assert all(abs(done[s] - (slot + 1) * k / total) < 1 for s, k in shares.items())
        assert done == shares


def test_phases_have_no_gaps():
    rng = random.Random(1)
    for _ in range(60):
        blocks = {f"s{i}": rng.randint(1, 60) for i in range(rng.randint(1, 9))}
        shares, slots = {i: rng.randint(1, 9) for i in blocks}, {}
        for i, low, high, share, start, total, plan in mixing.phases(blocks, shares):
            for b in range(low, high):
                turn, j = divmod(b - low, share)
                release, deadline, at = plan[j]
                assert release <= at < deadline
                assert at < total
                slots[start + turn * total + at] = (i, b)
        order = [slots[x] for x in range(sum(blocks.values()))]
        assert all([b for s, b in order if s == i] == list(range(n)) for i, n in blocks.items())


def check_mixture(got, of, root_shares=None):
    """Slots without gaps, every source's blocks in turn, release and deadline kept; for given shares at the root, the
    bound until a component runs out."""
    slots, turns = {}, {}
    for r in got:
        assert r._release <= r._turn < r._deadline
        assert r._component != "root" or r._turn == r._slot
        slots.setdefault(r._slot, set()).add((of[r.doc_id], r._block, r._component))
        turns.setdefault(r._component, {}).setdefault(r._turn, set()).add((of[r.doc_id], r._block))
    assert sorted(slots) == list(range(len(slots))) and all(len(x) == 1 for x in slots.values())
    for node, x in turns.items():  # a pool's slots are its sources' alone, the root has slots for pools too
        assert (node == "root" or sorted(x) == list(range(len(x)))) and all(len(y) == 1 for y in x.values())
    order = [next(iter(slots[s])) for s in sorted(slots)]
    for source in {s for s, _, _ in order}:
        mine = [b for s, b, _ in order if s == source]
        assert mine == list(range(len(mine)))
    if root_shares:
        who = [s if c == "root" else None for s, _, c in order]
        left, done, total = {x: who.count(x) for x in set(who)}, dict.fromkeys(who, 0), sum(root_shares[x] for x in set(who))
        for at, s in enumerate(who, 1):
            done[s] += 1
            assert all(abs(done[x] - at * root_shares[x] / total) < 1 for x in done)
            if done[s] == left[s]:
                break
    return order


@pytest.mark.parametrize("ranges", [20_000, 9])
@pytest.mark.parametrize("weights", [None, {"a": 1, "b": 3}, {"a": 2, "b": 1, "absent": 5}])
def test_mix(docs, rows, empty, weights, ranges):
    mixed = mixing.mix(docs, weights, block=4, range_rows=ranges)
    got = mixed.orderBy("_slot", "_place").collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    check_mixture(got, {r[0]: r[3] for r in rows}, weights and weights | {None: 1})
    ordered = mixing.in_order(mixed, docs.columns)
    assert ordered.columns == docs.columns
    assert [r.doc_id for r in ordered.collect()] == [r.doc_id for r in got] or ordered.rdd.getNumPartitions() > 1
    assert mixing.mix(empty, weights).count() == 0


@pytest.mark.parametrize("fan, pools", [(128, 2), (6, 29)])
def test_mix_schedules_every_source(spark, monkeypatch, fan, pools):
    """300 sources: the 128 largest at the root, each of the rest in a pool's schedule, in trees of one to three levels."""
    monkeypatch.setattr(mixing, "FAN", fan)
    sizes = {f"s{i}": 1 + 600 // (i + 1) for i in range(300)}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    of = dict(rows)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), block=2, range_rows=500).collect()
    assert sorted(r.doc_id for r in got) == sorted(of)
    order = check_mixture(got, of)
    nodes = {s: c for s, _, c in order}
    assert len(nodes) == 300 and sum(c == "root" for c in nodes.values()) == 128
    assert len(set(nodes.values())) == pools + 1
    # the shares of the root: until a component runs out each is within a block of its own
    weight = {s: n ** mixing.POWER for s, n in sizes.items()}
    root = {}
    for s, c in nodes.items():
        root[s if c == "root" else None] = root.get(s if c == "root" else None, 0) + weight[s]
    total = sum(root.values())
    shares = {s: max(1, round(mixing.TOTAL * w / total)) for s, w in root.items()}
    check_mixture(got, of, shares)


def test_mix_refuses_weights(docs):
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0})


# ---- the pipeline

def test_pipeline(spark, docs, rows, tmp_path):
    """Each stage on what its predecessor kept, against brute force; labels of both classes, so that rows are rejected."""
    from tests.llm.test_dedup import exact_expected, near_expected
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = by_hand.labels_of(rows)
    spark.createDataFrame([(i, q, 0) for i, q in labels.items()], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    now, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: (r.doc_id, r.text, r.lang, r.source) for r in now.collect()}
        if name == "mixture":
            mixed = mixing.mix(now).orderBy("_slot", "_place").collect()
            check_mixture(mixed, {i: r[3] for i, r in before.items()})
            assert [r.doc_id for r in stage(spark, now, str(tmp_path)).collect()] == [r.doc_id for r in mixed]
        columns, now = now.columns, corpus_pipeline.cut(stage(spark, now, str(tmp_path)), "stage")
        if name != "packing":
            assert now.columns == columns
            left[name] = sorted(r.doc_id for r in now.collect())
    kept = {i for i, p in by_hand.posteriors(rows, labels) if p >= 0.5}
    good = [r for r in rows if r[0] in kept]
    assert left["quality"] == sorted(r[0] for r in good) and 0 < len(good) < len(rows)
    assert left["exact dedup"] == sorted({i for i, _, _, kept, _ in exact_expected(good) if kept})
    some = [r for r in rows if r[0] in set(left["exact dedup"])]
    assert left["near dedup"] == sorted({i for i, _, _, kept in near_expected(list(dict.fromkeys(some))) if kept})
    assert left["mixture"] == left["near dedup"]
    got = now.collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces_of(before.values())
    check_packed(got)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(got)


def test_pipeline_packs_in_the_order_of_the_mixture(spark, tmp_path):
    """Sequences are filled and numbered in the order of the rows, so another order gives other sequences."""
    some, got = spark.createDataFrame([(i, "and " * (300 + i % 4 * 150)) for i in range(60)], "doc_id long, text string"), {}
    for name, order in (("up", F.col("doc_id")), ("down", -F.col("doc_id"))):
        path = f"{tmp_path}/{name}"
        some.repartitionByRange(3, order).sortWithinPartitions(order).write.parquet(path)
        found = corpus_pipeline.packed(spark, spark.read.parquet(path), str(tmp_path)).collect()
        check_packed(found)
        first = {}
        for r in found:
            at = r.doc_id if name == "up" else -r.doc_id
            first[r.sequence_id] = min(at, first.get(r.sequence_id, at))
        assert sorted(first) == list(range(len(first)))
        assert [first[i] for i in sorted(first)] == sorted(first.values())
        got[name] = {(r.doc_id, r.piece): r.sequence_id for r in found}
    assert got["up"].keys() == got["down"].keys() and got["up"] != got["down"]
    assert len(set(got["up"].values())) == len(set(got["down"].values()))


def test_words_a_worker_keeps():
    """The memory of ids is bounded, below what an executor with two workers has beside its heap, and gives the tokenizer's ids."""
    from tokenizers import Tokenizer
    encode = packing.TokenIds(PATH)
    text = " ".join(f"a{i:x}b" if i % 3 else "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) + "." for i in range(130_000))
    plain = Tokenizer.from_file(PATH)
    for part in (text, text[-2_000:], text[:2_000]):
        ids = encode(part)
        assert len(encode.words) + len(encode.words.older) <= 100_000
        if len(part) < 3_000:
            assert ids == b"".join(i.to_bytes(4, "little") for i in plain.encode(part, add_special_tokens=False).ids)
