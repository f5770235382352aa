import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sellerscope.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed=2, n=160):
    rng = random.Random(seed)
    said = [f"w{i} said\tso\n much {'x ' * (i % 5)}" for i in range(6)] + ["", None]
    rows = []
    for c in rng.sample(range(n * 2), n):
        for t in range(rng.choice([0, 1, 1, 2, 3, 4, 7])):
            rows.append((c, t, rng.choice(["user", None, "assistant"]) if t % 3 else "user", said[min(rng.randrange(8), rng.randrange(8))]))
    rows += [(7, None, "user", "null turn first"), (None, 0, "user", "no id"), (41, 3, "user", "tie"), (41, 3, "user", "tie"), (41, 3, "user", "a tie")]
    rows += [(1000 + i, t, "user", "copied " * t) for i in range(40) for t in range(5)]  # copies
    rows += [(2001, t, "user", f"long {t}") for t in range(300)] + [(-3, 0, "user", "negative"), (-3, 9, None, "far")]
    return rows


def brute(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((t is not None, t or 0, tid, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        made[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        stack, leaves, saved = [p], 0, 0
        while stack:
            x = stack.pop()
            leaves += x not in children
            saved += (len(members[x]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0)
            stack += children.get(x, [])
        return leaves, saved

    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(made[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *below(p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("container", [3, 40, 100_000])
def test_prefix_trie(spark, container):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("conv", "node", "rep", "words", "head", "top", "is_head"):
        df = df.withColumn(c, F.lit(1))
    got = sorted((tuple(r) for r in trie.prefix_trie(df, container=container).collect()), key=str)
    assert got == brute(rows)


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 2)
    rows = [(c, 0, "user", "lost"), (c, 1, "user", "lost too")]  # no base, and no turn after the first two
    got = [tuple(r) for r in trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
