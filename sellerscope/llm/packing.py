"""Best-fit packing of token sequences, planned on the histogram of lengths.

Texts are tokenised inside tasks and cut into pieces of at most ``CAPACITY`` tokens. The
plan needs only how many pieces have each length, at most ``CAPACITY`` numbers:

1. Linear grouping: lengths that are not small are ordered and parted into groups of equal
   cardinality; each counts as its group's largest length. The few sizes that remain give
   a cutting-stock problem, whose configurations are found by column generation.
2. Substitution: the configurations' places of a group are filled with that group's actual
   pieces, whose lengths are at most the rounded one.
3. What rounding down left over, and then the small lengths, go, longest first, to the sequences with the least room that holds them.

The plan is a table of runs: pieces of one length, by their rank, go to consecutive
sequences at a fixed offset. Tasks then look up their own pieces' runs. Ranks come from
counts per length and salt, so a length that a third of all pieces have is not one group.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.llm.common import cut, text_or_empty

CAPACITY = 2048
#: (number of groups, share of the capacity up to which lengths are small) to try; the plan with the fewest sequences is taken
#: (from a half on, every configuration holds one piece, and the rest is best fit decreasing)
TRIED = ((96, 1 / 4), (96, 0.36), (16, 1 / 2))
#: words, and parts of words, whose ids a worker keeps in each of two generations; a worker of 400,000 words held 110 MB more
MEMO, PARTS = 50_000, 200_000
#: runs that are broadcast; a longer plan is joined by shuffle
BROADCAST_RUNS = 500_000
END_ID = 0


#: a word of Latin-1 letters, and marks after it, which the tokenizer parts from them
WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!|%#&$*;:?]*)")


def _byte_characters() -> dict[int, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in own)}


class Memory(dict):
    """What ``make`` gave for each key, in two generations of at most ``most`` keys: when the younger is full
    it replaces the older, so that frequent keys are kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class TokenIds:
    """Ids of a text as little-endian 32-bit numbers, word by word (white space parts the tokenizer's words).

    A plain word's letters and marks are encoded apart by the vocabulary's merges, which is
    what the whole tokenizer does with them; every other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and workers are forks
        from tokenizers import Tokenizer
        self.tokenizer, self.characters = Tokenizer.from_file(path), _byte_characters()
        self.model = self.tokenizer.model
        self.letters, self.marks = Memory(self.merged, PARTS), Memory(self.whole, PARTS)
        self.words = Memory(self.encoded, MEMO)

    def whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, letters: str) -> bytes:
        as_bytes = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.characters)
        tokens = [t.id for t in self.model.tokenize(as_bytes)]
        return struct.pack(f"<{len(tokens)}I", *tokens)

    def encoded(self, raw: bytes) -> bytes:
        word = raw.decode()
        plain = WORD.fullmatch(word)
        if not plain:
            return self.whole(word)
        letters, marks = plain.groups()
        return self.letters[letters.lower()] + self.marks[marks] if marks else self.letters[letters.lower()]

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.encode().split()))  # at ASCII white space


def worker_encoder(path: str) -> TokenIds:
    """The worker's encoder: made once, and kept with what it remembers for the worker's next tasks."""
    kept = sys.modules.setdefault("_llm_token_ids", ModuleType("_llm_token_ids")).__dict__
    if path not in kept:
        kept[path] = TokenIds(path)
    return kept[path]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids, followed by ``END_ID``, and the document's columns ``keep``."""
    def pieces(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end, step = worker_encoder(tokenizer), np.array([END_ID], "<u4").tobytes(), 4 * capacity
        for pdf in batches:
            rows = []
            for doc_id, text, *kept in zip(pdf["doc_id"], pdf["text"], *(pdf[c] for c in keep)):
                ids = encode(text) + end
                rows += [(doc_id, i // step, i // 4, min(step, len(ids) - i) // 4, zlib.crc32(ids[i:i + step]), *kept)
                         for i in range(0, len(ids), step)]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *keep])

    kind, *kinds = (docs.schema[c].dataType.simpleString() for c in ("doc_id", *keep))
    return docs.select("doc_id", text_or_empty().alias("text"), *keep).mapInPandas(
        pieces, ", ".join([f"doc_id {kind}, piece int, start long, length long, ids_crc32 long", *map(" ".join, zip(keep, kinds))]))


# ---- the plan, on counts alone --------------------------------------------------------

def _best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack, one more piece in each round: the configuration of greatest worth."""
    best = np.zeros(capacity + 1)
    rounds = []
    for _ in range(capacity // int(sizes.min())):
        more, taken = best.copy(), np.full(capacity + 1, -1)
        for k in np.flatnonzero(worth > 1e-12):
            value = best[:capacity + 1 - sizes[k]] + worth[k]
            at = np.flatnonzero(value > more[sizes[k]:] + 1e-12)
            more[at + sizes[k]], taken[at + sizes[k]] = value[at], k
        if (taken < 0).all():
            break
        best = more
        rounds.append(taken)
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    for taken in reversed(rounds):
        if taken[room] >= 0:
            pattern[taken[room]] += 1
            room -= sizes[taken[room]]
    return best[capacity], pattern


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int, rounds: int = 300) -> list[tuple[np.ndarray, int]]:
    """(pattern, sequences) for ``need`` pieces of each size: column generation, rounded down."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))  # kept by rank-one updates; plain sums need no BLAS threads in the driver
    for _ in range(rounds):
        value, pattern = _best_pattern(sizes, np.maximum(inverse.sum(axis=0), 0.0), capacity)
        if value <= 1 + 1e-6:
            break
        x, direction = (inverse * need).sum(axis=1), (inverse * pattern).sum(axis=1)
        ratio = np.full(m, np.inf)
        ratio[direction > 1e-9] = x[direction > 1e-9] / direction[direction > 1e-9]
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / direction[out]
        inverse -= direction[:, None] * row
        inverse[out] = row
    x = (inverse * need).sum(axis=1)
    chosen, left = [], need.astype(np.int64).copy()
    for j in np.argsort(-x):
        pattern = np.rint(basis[:, j]).astype(np.int64)
        count = int(np.floor(x[j] + 1e-7))
        if count > 0 and (pattern > 0).any():
            count = min(count, int((left[pattern > 0] // pattern[pattern > 0]).min()))
            if count > 0:
                chosen.append((pattern, count))
                left -= pattern * count
    return chosen


def _grouped(lengths: np.ndarray, counts: np.ndarray, groups: int) -> np.ndarray:
    """The group of every length (ascending): about equal numbers of pieces, a length in one group."""
    middle = np.cumsum(counts) - counts / 2
    return np.unique((middle * groups / counts.sum()).astype(np.int64), return_inverse=True)[1]


class _Plan:
    """Runs (length, from_rank, count, per_sequence, sequence, offset); sequences with equal content are ranges."""

    def __init__(self, capacity: int):
        self.capacity, self.runs, self.ranges, self.used, self.next = capacity, [], {}, {}, 0

    def take(self, length: int, sequence: int, count: int, each: int, offset: int) -> None:
        at = self.used.get(length, 0)
        self.runs.append((length, at, count, each, sequence, offset))
        self.used[length] = at + count

    def put(self, room: int, first: int, count: int) -> None:
        if count > 0:
            self.ranges.setdefault(room, []).append((first, count))

    def open(self, count: int) -> int:
        self.next += count
        return self.next - count

    def best_fit(self, length: int, count: int) -> None:
        """Place pieces of one length: each in the sequence with the least room that holds it."""
        while count:
            room = min((r for r in self.ranges if r >= length), default=None)
            if room is None:
                each = self.capacity // length
                full = -(-count // each)
                self.put(self.capacity, self.open(full), full)
                room = self.capacity
            first, there = self.ranges[room].pop()
            if not self.ranges[room]:
                del self.ranges[room]
            each = room // length
            whole = min(there, count // each)
            offset = self.capacity - room
            if whole:
                self.take(length, first, whole * each, each, offset)
                self.put(room - each * length, first, whole)
                count -= whole * each
            if count and whole < there:
                self.take(length, first + whole, count, each, offset)
                self.put(room - count * length, first + whole, 1)
                count, whole = 0, whole + 1
            self.put(room, first + whole, there - whole)


def _plan(lengths: np.ndarray, counts: np.ndarray, groups: int, capacity: int, small: int) -> _Plan:
    plan = _Plan(capacity)
    large = (lengths > small) & (lengths < capacity)
    for n, c in zip(lengths[lengths == capacity], counts[lengths == capacity]):
        plan.take(int(n), plan.open(int(c)), int(c), 1, 0)
    if large.any():
        n, c = lengths[large], counts[large]
        group = _grouped(n, c, groups)
        sizes = np.array([n[group == g].max() for g in range(group.max() + 1)])
        need = np.bincount(group, weights=c).astype(np.int64)
        left = [[(int(a), int(b)) for a, b in zip(n[group == g], c[group == g])] for g in range(len(sizes))]
        for pattern, count in configurations(sizes, need, capacity):
            # equal contents stay together: a range is parted where a group's next length begins
            open_ranges = [(plan.open(count), count, 0)]
            for g in np.flatnonzero(pattern)[::-1]:
                for _ in range(pattern[g]):
                    parted = []
                    for first, there, filled in open_ranges:
                        while there and left[g]:
                            length, have = left[g].pop()
                            use = min(there, have)
                            if have > use:
                                left[g].append((length, have - use))
                            plan.take(length, first, use, 1, filled)
                            parted.append((first, use, filled + length))
                            first, there = first + use, there - use
                        if there:
                            parted.append((first, there, filled))
                    open_ranges = parted
            for first, there, filled in open_ranges:
                plan.put(capacity - filled, first, there)
        for n, c in sorted((x for of in left for x in of), reverse=True):  # what rounding down left over
            plan.best_fit(n, c)
    for n, c in sorted(zip(lengths[lengths <= small], counts[lengths <= small]), reverse=True):
        plan.best_fit(int(n), int(c))
    return plan


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY,
              tried: tuple[tuple[int, float], ...] = TRIED) -> list[tuple[int, ...]]:
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    if not len(lengths):
        return []
    return min((_plan(lengths, counts, g, capacity, int(s * capacity)) for g, s in tried), key=lambda p: p.next).runs


# ---- the pieces' places ---------------------------------------------------------------

def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, salts: int | None = None,
         order: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece holding ``END_ID`` alone. Repeated rows are packed
    each. Other columns are not read. An empty table gives an empty result.

    ``order`` names two columns of the documents, a range and a place in it, by which they are to be read: pieces of one
    length then go to sequences in that order, and sequences are numbered from 0 by the earliest document they hold.
    As many sequences are used as without it.
    """
    spark = docs.sparkSession
    salts = salts or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = tokenized_pieces(docs, tokenizer, capacity, order or ()).withColumn(
        "salt", F.col(order[0]) if order else F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    pieces = cut(pieces, "pieces")
    # ranks within a length: the salts before a piece's own, and its place in its own
    part = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    part = cut(part.select(F.col("length").alias("l"), F.col("salt").alias("s"), "n",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "salts")
    own = Window.partitionBy("length", "salt").orderBy(*(order or ())[1:], "doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("place", F.row_number().over(own) - 1)
              .join(part, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
              .withColumn("rank", F.col("base") + F.col("place")))
    # at most ``capacity`` lengths come to the driver; the runs are bounded by them too
    histogram = {r["l"]: r["n"] for r in part.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    plan = plan_runs(histogram, capacity)
    runs = spark.createDataFrame(plan, "run_length long, first long, count long, each long, sequence long, at long")
    runs = F.broadcast(runs) if len(plan) <= BROADCAST_RUNS else runs
    found = (ranked.join(runs, (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("first") + F.col("count")))
            .withColumn("step", F.col("rank") - F.col("first"))
            .select(*(order or ()), "doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.floor(F.col("step") / F.col("each"))).cast("long").alias("sequence_id"),
                    (F.col("at") + F.pmod("step", "each") * F.col("length")).cast("long").alias("offset")))
    return _numbered(cut(found, "packed"), *order) if order else found


def _numbered(packed: DataFrame, part: str, place: str) -> DataFrame:
    """``packed`` with its sequences numbered by the least (part, place) they hold: inside each part, after the parts before it."""
    least = F.min(F.struct(part, place))
    first = cut(packed.groupBy("sequence_id").agg(least.alias("f")).select(F.col("sequence_id").alias("s"), F.col(f"f.{part}").alias("p"),
                                                                           F.col(f"f.{place}").alias("at")), "sequences")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    base = first.groupBy("p").agg(F.count("*").alias("n")).select(
        F.col("p").alias("q"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("p").orderBy("at", "s")) - 1
    number = first.withColumn("i", inside).join(F.broadcast(base), F.col("p") == F.col("q")).select("s", (F.col("base") + F.col("i")).alias("number"))
    return packed.join(number, F.col("sequence_id") == F.col("s")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("number").alias("sequence_id"), "offset")
