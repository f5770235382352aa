"""Line dedup by a segment-partition edit join.

Lines (between line feeds, white space at the ends dropped) that are equal form a class.
Two classes are linked if the edit distance of their lines is at most the threshold of the shorter
one: 1 from ``LEAST`` characters on, ``DISTANCE`` from ``WIDE`` on; shorter lines are linked with their
equals only. A line is cut into threshold + 1 segments; within that distance at least one segment stays unchanged, so it stands in the other line near
its own place. Every line is indexed under its segments (with its length and the segment's
number) and probes, for each length it could be linked with, the substrings at the places
that the lengths allow. A parity map of character counts, of which an edit changes at
most two bits, goes with every key and drops most chance meetings inside the join; what is
left is verified by a banded bit-parallel edit distance. Only hashes are shuffled; the texts
of candidate lines are fetched afterwards.

A segment that more than ``MEETING`` lines have is no key by itself. The segment that stays unchanged can be
chosen so that at most as many edits lie before it as segments do, and likewise behind it; both rests are cut again
by the edits they may hold, and the lines meet under the segment together with the pieces that stay unchanged in the
rests, and so on until few lines have a key or no rest holds more characters than edits. A parity map of the pairs of
neighbouring characters, of which an edit changes at most four bits, goes with these keys as well: lines that differ by
whole words have much the same characters, but not the same pairs.

The earliest line of each group of linked classes stays; blank lines always stay.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerscope.llm.common import WHITE, connected_components, cut

DISTANCE, LEAST, WIDE = 2, 12, 40
#: line hashes a task remembers, rows or characters of a frame that it hands on, and bits of the filter of candidate lines
MEMO, FRAME, FRAME_CHARACTERS, FILTER_BITS = 200_000, 50_000, 4_000_000, 1 << 23
#: lines up to which a segment is a key by itself, so that a probe meets no more of them
MEETING = 32


def threshold(length: int) -> int:
    """Edits within which a line of ``length`` characters is linked with one that is no shorter."""
    return 0 if length < LEAST else 1 if length < WIDE else DISTANCE


def segments(length: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(start, length) of the distance + 1 segments: the last ones are one longer."""
    k = distance + 1
    short = length // k
    longer = length - short * k
    out, at = [], 0
    for i in range(k):
        n = short + (i >= k - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, other: int, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """(segment, start, length) of the substrings of a line of ``length`` that may equal a
    segment of a line of ``other`` <= length characters, by the multi-match-aware bounds."""
    gap, out = length - other, []
    for i, (p, n) in enumerate(segments(other, distance)):
        low = max(0, p - i, p + gap - (distance - i))
        high = min(length - n, p + i, p + gap + (distance - i))
        out += [(i, start, n) for start in range(low, high + 1)]
    return out


def parity(line: str) -> int:
    """A bit per character class, set if the line has an odd number of them."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    return int(np.bitwise_xor.reduce(np.int64(1) << (codes % 61).astype(np.int64)))


def pair_parity(line: str) -> int:
    """A bit per class of pairs of neighbouring characters, set if the line has an odd number of them."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.int64)
    return int(np.bitwise_xor.reduce(np.int64(1) << ((codes[:-1] * 7919 + codes[1:]) % 61)))


def within(a: str, b: str, distance: int = DISTANCE) -> int | None:
    """The edit distance of a and b if it is at most ``distance``: bit vectors of a band of 2 * distance + 1.

    Bit k of a vector stands for diagonal k - distance; vector e holds the diagonals that some
    alignment with e errors has followed up to the current row, all cells of the band at once.
    """
    if abs(len(a) - len(b)) > distance:
        return None
    while True:  # equal ends need no rows
        n = min(len(a), len(b))
        i, step = 0, 1
        while i < n and a[i:i + step] == b[i:i + step] and step <= n:
            i, step = min(n, i + step), step * 2
        if not i:
            break
        a, b = a[i:], b[i:]
    n = min(len(a), len(b))
    i = 0
    while i < n and a[-1 - i] == b[-1 - i]:
        i += 1
    a, b = a[:len(a) - i], b[:len(b) - i]
    band = (1 << (2 * distance + 1)) - 1
    place: dict[str, int] = {}
    for j, c in enumerate(b[:distance]):
        place[c] = place.get(c, 0) | 1 << (j + distance + 1)  # bit k + 1: the band begins before b
    ahead = [0] * (distance + 1)
    for e in range(distance + 1):  # before the first row: e insertions
        for k in range(distance, min(2 * distance, distance + e, distance + len(b)) + 1):
            ahead[e] |= 1 << k
    for i, c in enumerate(a):
        # cell (i, i + k - distance) matches if b has c there; the window of b moves with the row
        match = 0
        for k in range(2 * distance + 1):
            j = i + k - distance
            if 0 <= j < len(b) and b[j] == c:
                match |= 1 << k
        inside = 0
        for k in range(2 * distance + 1):
            if 0 <= i + 1 + k - distance <= len(b):
                inside |= 1 << k
        now = []
        for e in range(distance + 1):
            x = ahead[e] & match
            if e:
                x |= ahead[e - 1] | (ahead[e - 1] >> 1) | (now[e - 1] << 1)  # substitute, delete, insert
            now.append(x & inside & band)
        ahead = now
    end = 1 << (len(b) - len(a) + distance)
    return next((e for e in range(distance + 1) if ahead[e] & end), None)


def trimmed(text: str | None) -> list[str]:
    """The lines of a text without the white space at their ends; a null text has none."""
    return [x.strip(WHITE) for x in text.split("\n")] if text is not None else []


def line_hash(line: str) -> int:
    """64-bit class of a line; n different lines share one with probability n^2 / 2^65."""
    return xxhash.xxh64_intdigest(line.encode()) - (1 << 63)


def _places(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of about FRAME lines; a document's lines stay in one."""
    for pdf in batches:
        kind = pdf["doc_id"].dtype
        size, docs, number, line, blank = array("q"), [], array("i"), array("q"), array("b")

        def out() -> pd.DataFrame:
            frame = pd.DataFrame({"doc_id": pd.Series(docs, dtype=kind).repeat(np.array(size)).reset_index(drop=True),
                                  "line_no": np.array(number, np.int32),
                                  "line_id": pd.arrays.IntegerArray(np.array(line, np.int64), np.array(blank, bool))})
            docs.clear()
            for x in (size, number, line, blank):
                del x[:]
            return frame

        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            found = trimmed(text)
            docs.append(doc_id)
            size.append(len(found))
            number.extend(range(len(found)))
            line.extend(line_hash(x) if x else 0 for x in found)
            blank.extend(not x for x in found)
            if len(number) >= FRAME:
                yield out()
        yield out()


def _distinct_lines(pdf: pd.DataFrame, seen: set[int]) -> Iterator[tuple[int, str]]:
    """Lines that can be linked, once each as far as the task's bounded memory reaches."""
    for text in pdf["text"]:
        for x in trimmed(text):
            if len(x) >= LEAST:
                h = line_hash(x)
                if h not in seen:
                    if len(seen) >= MEMO:
                        seen.clear()
                    seen.add(h)
                    yield h, x


def _plan(n: int) -> list[tuple[int, int, int, int]]:
    """(start, end, seed, bits) of the keys of a line of n characters: its segments, with the bits in which the parity map of
    a linked line may differ, and the substrings that it probes with, with -1."""
    t = threshold(n)
    own = [(s, s + m, n * 8 + i, 2 * t) for i, (s, m) in enumerate(segments(n, t))]
    others = [other for other in range(max(LEAST, n - DISTANCE), n + 1) if n - other <= threshold(other)]
    return own + [(s, s + m, other * 8 + i, -1) for other in others for i, s, m in probes(n, other, threshold(other))]


def _keys(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, id, map, bits) in frames of about FRAME rows."""
    plans: dict[int, list[tuple[int, int, int, int]]] = {}
    seen: set[int] = set()
    key, bits, ids, maps, size = array("q"), array("b"), array("q"), array("q"), array("q")

    def out() -> pd.DataFrame:
        each = np.array(size, np.int64)
        frame = pd.DataFrame({"key": np.array(key, np.int64), "id": np.repeat(np.array(ids, np.int64), each),
                              "map": np.repeat(np.array(maps, np.int64), each), "bits": np.array(bits, np.int8)})
        for x in (key, bits, ids, maps, size):
            del x[:]
        return frame

    for pdf in batches:
        for h, line in _distinct_lines(pdf, seen):
            plan = plans.get(len(line))
            if plan is None:
                if len(plans) > 4096:
                    plans.clear()
                plan = plans[len(line)] = _plan(len(line))
            for s, e, seed, _ in plan:
                key.append(xxhash.xxh64_intdigest(line[s:e], seed) - (1 << 63))
            bits.extend(b for *_, b in plan)
            ids.append(h)
            maps.append(parity(line))
            size.append(len(plan))
            if len(key) >= FRAME:
                yield out()
    yield out()


def _open(line: str, key: int, index: bool) -> Iterator[list[tuple[int, int, int, int]]]:
    """What lies beside the keys of ``line`` that are ``key``: (start, end, the index line's length there, edits it may hold)."""
    for s, e, seed, bits in _plan(len(line)):
        if (bits >= 0) == index and xxhash.xxh64_intdigest(line[s:e], seed) - (1 << 63) == key:
            other, i = divmod(seed, 8)
            at, n = segments(other, t := threshold(other))[i]
            yield [(0, s, at, i), (e, len(line), other - at - n, t - i)]


def _pieces(line: str, rest: tuple[int, int, int, int], index: bool) -> Iterator[tuple[str, list[tuple[int, int, int, int]]]]:
    """(text that stays unchanged, rests beside it to be cut) for each piece of a rest; a rest that may hold no edit is part of that text."""
    s, e, m, edits = rest
    own = segments(m, edits)
    for j, at, n in [(j, *x) for j, x in enumerate(own)] if index else probes(e - s, m, edits):
        before, behind = (s, s + at, own[j][0], j), (s + at + n, e, m - own[j][0] - n, edits - j)
        if all(x[3] or x[1] - x[0] == x[2] for x in (before, behind)):
            first, last = s if not j else s + at, e if j == edits else s + at + n
            # a rest of no more characters than edits is not cut: nearly all lines that agree beside it are linked
            yield f"{j}{line[first:last]}", [x for x in (before, behind) if 0 < x[3] < x[2]]


def _finer(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The keys below each key (of an index line where bits >= 0), with the rests that are still to be cut, and the map of pairs."""
    names = ["key", "id", "map", "bits", "rests", "pair_map"]
    for pdf in batches:
        rows = []
        for key, h, parity_map, bits, rests, line in zip(*(pdf[c] for c in (*names[:-1], "line"))):
            index, pair_map = bits >= 0, pair_parity(line)
            states = _open(line, key, index) if rests is None else [list(zip(*[iter(rests)] * 4))]
            for state in states:
                for chosen in product(*(list(_pieces(line, x, index)) for x in state)):
                    finer = xxhash.xxh64_intdigest("\n".join([str(key), *(text for text, _ in chosen)])) - (1 << 63)
                    rows.append((finer, h, parity_map, bits, [int(y) for _, left in chosen for x in left for y in x], pair_map))
                if len(rows) >= FRAME:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        yield pd.DataFrame(rows, columns=names)


def _verified(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        d = [within(a, b, threshold(min(len(a), len(b)))) for a, b in zip(pdf["line_a"], pdf["line_b"])]
        out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "distance": pd.Series(d, dtype="float64")})
        yield out[out["distance"].notna()].astype({"distance": "int64"})


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line) of the lines in ``ids``: a filter of FILTER_BITS bits, of fixed size, keeps nearly all others in the
    tasks that read them; the join after it is exact."""
    bit = F.pmod(F.col("id"), F.lit(FILTER_BITS))  # ids are hashes
    rows = ids.select(F.floor(bit / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, CAST(pmod(pmod(id, {FILTER_BITS}), 32) AS INT))").alias("m"))
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in rows.groupBy("w").agg(F.bit_or("m").alias("m")).collect():  # FILTER_BITS / 32 rows at most
        words[r["w"]] = r["m"]
    shared = docs.sparkSession.sparkContext.broadcast(words.astype("<u4").tobytes())

    def lines(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, seen = shared.value, set()
        for pdf in batches:
            rows, held = [], 0
            for row in _distinct_lines(pdf, seen):
                at = row[0] % FILTER_BITS
                if not wanted[at >> 3] >> (at & 7) & 1:
                    continue
                rows.append(row)
                held += len(row[1])
                if len(rows) >= FRAME or held >= FRAME_CHARACTERS:
                    yield pd.DataFrame(rows, columns=["id", "line"]).astype({"id": "int64"})
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["id", "line"]).astype({"id": "int64"})

    found = docs.select("text").mapInPandas(lines, "id long, line string")
    return found.join(ids.select(F.col("id").alias("i")), F.col("id") == F.col("i"), "left_semi").groupBy("id").agg(F.min("line").alias("line"))


def _crowded(keys: DataFrame) -> DataFrame:
    return keys.where("bits >= 0").groupBy(F.col("key").alias("crowd")).agg(F.count("*").alias("n")).where(F.col("n") > MEETING).select("crowd")


def _met(keys: DataFrame, crowded: DataFrame) -> DataFrame:
    """(a, b), a < b: lines that meet under a key that is not crowded."""
    index = keys.where("bits >= 0").join(crowded, F.col("key") == F.col("crowd"), "left_anti")
    probe = keys.where("bits < 0").select(*[F.col(c).alias(f"p_{c}") for c in keys.columns if c not in ("bits", "rests")])
    near = F.bit_count(F.col("map").bitwiseXOR(F.col("p_map"))) <= F.col("bits")
    if "pair_map" in keys.columns:
        near &= F.bit_count(F.col("pair_map").bitwiseXOR(F.col("p_pair_map"))) <= 2 * F.col("bits").cast("int")
    pairs = index.join(probe, (F.col("key") == F.col("p_key")) & (F.col("id") != F.col("p_id")) & near)
    return pairs.select(F.least("id", "p_id").alias("a"), F.greatest("id", "p_id").alias("b")).distinct()


def links(docs: DataFrame) -> DataFrame:
    """(a, b, distance): all linked pairs of classes, a < b."""
    keys = cut(docs.select("text").mapInPandas(_keys, "key long, id long, map long, bits tinyint"), "keys")
    crowded = cut(_crowded(keys), "crowded")
    pairs = cut(_met(keys, crowded), "pairs")
    there = F.col("key") == F.col("crowd")
    crowd = cut(keys.join(crowded, there, "left_semi").distinct().withColumn("rests", F.lit(None).cast("array<int>")), "crowd")
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).union(crowd.select("id")).distinct(), "ids")
    line = cut(texts_of(docs, ids), "candidates")
    while not crowd.isEmpty():  # every cut leaves shorter rests
        crowd = cut(crowd.join(line, "id").mapInPandas(_finer, "key long, id long, map long, bits tinyint, rests array<int>, pair_map long").distinct(), "finer")
        # lines under one key have rests of the same index lengths and edits: all of them are cut again, or none
        crowded = cut(_crowded(crowd.where("size(rests) > 0")), "crowded")
        pairs = pairs.union(cut(_met(crowd, crowded), "pairs"))
        crowd = cut(crowd.drop("pair_map").join(crowded, there, "left_semi"), "crowd")
    full = (pairs.distinct().join(line.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
            .join(line.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b"))
    return cut(full.select("a", "b", "line_a", "line_b").mapInPandas(_verified, "a long, b long, distance long"), "links")


def line_groups(docs: DataFrame) -> DataFrame:
    """One row per line: doc_id, line_no, line_id, copies, links, group, kept.

    ``copies`` counts equal lines, ``links`` other classes within the distance, ``group`` is the
    smallest line_id linked through any chain. Of a group the line with the smallest doc_id, then
    line_no, is kept; rows with null doc_id come last. Blank lines have null ids and are
    kept. Null texts give no line. Repeated rows of a doc_id are one place: their lines at one
    number are kept alike. Other columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    places = cut(docs.select("doc_id", "text").mapInPandas(_places, f"doc_id {kind}, line_no int, line_id long"), "places")
    found = links(docs)
    group = connected_components(found.select(F.col("a").alias("u"), F.col("b").alias("v")), "line_groups")
    degree = found.select(F.explode(F.array("a", "b")).alias("l")).groupBy("l").agg(F.count("*").alias("links"))
    classes = places.where("line_id is not null").groupBy(F.col("line_id").alias("c")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc"))
    of = cut(classes.join(group, F.col("c") == F.col("id"), "left").join(degree, F.col("c") == F.col("l"), "left").select(
        "c", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "c").alias("group"), "doc"), "classes")
    first = of.groupBy(F.col("group").alias("g")).agg(F.min("doc").alias("first_doc"))
    of = of.join(first, F.col("group") == F.col("g")).drop("g", "doc")
    placed = places.join(of, F.col("line_id") == F.col("c"), "left")
    # the earliest line of a group: the smallest line number among its first document's lines
    lead = placed.where(F.col("doc_id").eqNullSafe(F.col("first_doc")) & F.col("group").isNotNull()).groupBy(
        F.col("group").alias("g")).agg(F.min("line_no").alias("first_no"))
    kept = F.col("group").isNull() | (F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("line_no") == F.col("first_no")))
    return placed.join(lead, F.col("group") == F.col("g"), "left").select(
        "doc_id", "line_no", "line_id", "copies", "links", "group", kept.alias("kept"))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), line: a null text has no line."""
    white = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
    return docs.where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).select(
        "doc_id", "line_no", F.regexp_replace("line", white, "").alias("line"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text of every document that has text, without the lines that are not kept."""
    lines = lines_of(docs).withColumnRenamed("doc_id", "d").withColumnRenamed("line_no", "no")
    kept = line_groups(docs).where("kept").select("doc_id", "line_no").distinct()
    left = lines.join(kept, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("no") == F.col("line_no")))
    return left.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l")).select(
        "doc_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))
