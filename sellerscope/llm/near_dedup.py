"""Near-duplicate documents: MinHash bands, odd-sketch verification, exact confirmation.

1. Each document gets a MinHash (128 samples), its 32 band keys and an odd sketch: every
   sample flips one bit of a 512-bit parity map, so the population count of the XOR of
   two sketches tells how many samples differ. Documents with equal shingle sets are
   one class, and only one member of a class goes on.
2. In each band bucket the sketches are compared; members whose estimate is not clearly
   below the threshold hang together. That gives candidate clusters, with one edge per
   member and block. A bucket of more than a block is sliced by the number of shingles
   and each slice compared as in 3, so every pair that may be linked meets.
3. Each cluster's full shingle sets are compared exactly. A cluster of more than a block
   is first compared with one block drawn at random, which joins nearly all of it; what
   is still outside its largest part is then compared with every block. All pairs of
   different parts are covered, and no pair list of a group is ever written.

A pair at the threshold misses all bands with probability (1 - 0.75^4)^32 = 5e-6, and the
sketch with about 1e-6 (``SKETCH_CUT`` stands five standard deviations beyond).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerscope.llm.common import connected_components, cut, unused
from sellerscope.llm.shingles import WordHashes, mixed, shingle_set

SAMPLES, ROWS = 128, 4
BANDS = SAMPLES // ROWS
SKETCH_BITS = 512
#: similarity below which an estimate from the sketch is taken as clearly too low, and its XOR count
SKETCH_CUT = 0.52
MOST_BITS = int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * SAMPLES * (1 - SKETCH_CUT))))
#: members compared at once
BLOCK = 512
#: columns of the incidence matrix at once
COLUMNS = 16_384
PERCENT = 75
#: step of sizes, a little over 100 / PERCENT: rounding of the logarithm parts no pair
SIZE_STEP = 1.34

_rng = np.random.default_rng(7)
_A = _rng.integers(1, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_PLACE = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
_BAND = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))


def minhash(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        out = np.minimum(out, (x[i:i + 4096, None] * _A + _B).min(axis=0))
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of the number of samples that fall on each of the bits, packed."""
    bit = mixed(samples.astype(np.uint64) | _PLACE) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    return np.packbits(np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1)


def band_keys(samples: np.ndarray) -> np.ndarray:
    pairs = samples.view(np.uint64).reshape(BANDS, ROWS // 2)
    key = _BAND.copy()
    for i in range(ROWS // 2):
        key = mixed(key + mixed(pairs[:, i] + np.uint64(i)))
    return key.view(np.int64)


SIGNATURE = "doc_id {id}, n_shingles long, set_key binary, bands array<long>, sketch binary"


def _signatures(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = WordHashes()
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            s = shingle_set(text, memo)
            if len(s):
                m = minhash(s)
                rows.append((doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), band_keys(m), odd_sketch(m).tobytes()))
            else:
                rows.append((doc_id, 0, None, None, None))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_key", "bands", "sketch"])


def signatures(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(_signatures, SIGNATURE.format(id=kind))


def whole_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that hold whole groups of rows sorted by ``keys``, with each group's first row."""
    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        k = [pdf[c].to_numpy() for c in keys]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in k], axis=0)) + 1
        if not len(new):
            rest = pdf
            continue
        yield pdf.iloc[:new[-1]], np.concatenate([[0], new[:-1]])
        rest = pdf.iloc[new[-1]:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest, np.zeros(1, np.int64)


def labels_of(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the smallest row it hangs together with."""
    m = len(linked)
    label = np.arange(m)
    while True:
        near = np.minimum(label, np.where(linked, label, m).min(axis=1))
        near = near[near]
        if (near == label).all():
            return label
        label = near


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1)


def _candidates(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Star edges between the members of a block whose sizes and sketches allow a link."""
    for pdf, first in whole_groups(batches, ["key", "block"]):
        ids, n = pdf["rep"].to_numpy(), pdf["n_shingles"].to_numpy()
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint64).reshape(len(ids), -1)
        size = np.diff(np.append(first, len(ids)))
        left = np.repeat(first + size, size) - np.arange(len(ids))  # members from this one on
        small = np.repeat(size <= 8, size)
        u, v = [], []
        for step in range(1, min(8, size.max())):
            i = np.flatnonzero(small & (left > step))
            j = i + step
            ok = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
            i, j = i[ok], j[ok]
            ok = _differing(sketch[i], sketch[j]) <= MOST_BITS
            u.append(ids[i[ok]])
            v.append(ids[j[ok]])
        for at, m in zip(first[size > 8], size[size > 8]):
            own, s, k = ids[at:at + m], sketch[at:at + m], n[at:at + m]
            label = labels_of((_differing(s[:, None], s[None]) <= MOST_BITS)
                              & (100 * np.minimum(k[:, None], k) >= PERCENT * np.maximum(k[:, None], k)))
            u.append(own)
            v.append(own[label])
        u, v = np.concatenate([*u, ids[:0]]), np.concatenate([*v, ids[:0]])
        yield pd.DataFrame({"u": u[u != v], "v": v[u != v]})


def _compare(parts: DataFrame) -> DataFrame:
    """Edges between the rows (key, block, rep, n_shingles, sketch) of each (key, block).

    Rows hang on the one of least hash, which tends to be the same in all bands: few different edges.
    """
    kind = parts.schema["rep"].dataType.simpleString()
    return (parts.select("key", "block", "rep", "n_shingles", "sketch").repartition("key", "block")
            .sortWithinPartitions("key", "block", F.xxhash64("rep")).mapInPandas(_candidates, f"u {kind}, v {kind}"))


def _first_parts(block: str = "block", blocks: str = "blocks") -> Column:
    """Parts of a row in the first round: block 0 is a random draw, it goes with each other block."""
    return F.when(F.col(blocks) == 1, F.array(F.lit(0).cast("long"))).when(
        F.col(block) == 0, F.sequence(F.lit(1).cast("long"), F.col(blocks) - 1)).otherwise(F.array(block))


def _outsiders(large: DataFrame, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``large`` (rep, cluster, block, blocks) not in the largest joined part of their cluster, and their groups.

    Of two rows in different parts one is outside, so all pairs are covered when these meet every block.
    """
    of = large.join(joined, F.col("rep") == F.col("id"), "left").select(
        "rep", "cluster", "block", "blocks", F.coalesce("component", "rep").alias("part_of"))
    sized = of.groupBy("cluster", "part_of").agg(F.count("*").alias("size"))
    top = sized.groupBy("cluster").agg(F.max(F.struct("size", "part_of")).alias("m")).select(
        F.col("cluster").alias("c"), F.col("m.part_of").alias("largest"))
    outside = cut(of.join(top, F.col("cluster") == F.col("c")).where("part_of <> largest").select("rep", "cluster", "blocks"), "outside")
    groups = outside.groupBy(F.col("cluster").alias("c")).agg(
        F.ceil(F.count("*") / BLOCK).alias("groups"), F.first("blocks").alias("blocks"))
    return outside, groups


def candidate_edges(classes: DataFrame) -> DataFrame:
    """(u, v): edges that hold all members of a band bucket together whose sketches allow a link."""
    rows = cut(classes.select("rep", "n_shingles", F.explode("bands").alias("key")), "bands")
    sizes = cut(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
                .select(F.col("key").alias("k"), "size"), "buckets")
    facts = classes.select("rep", "n_shingles", "sketch")
    member = rows.join(sizes.where(F.col("size") <= BLOCK), F.col("key") == F.col("k")).select("key", F.col("rep").alias("r"))
    within = _compare(member.join(facts, F.col("rep") == F.col("r")).withColumn("block", F.lit(0).cast("long")))
    hot = sizes.where(F.col("size") > BLOCK)
    if hot.isEmpty():
        return within.distinct()
    # sizes that allow a link differ by one step at most: each slice of a large bucket holds two steps
    step = F.floor(F.log("n_shingles") / F.log(F.lit(SIZE_STEP)))
    slices = cut(rows.join(hot, F.col("key") == F.col("k")).select("key", "rep", F.posexplode(F.array(step, step + 1)).alias("home", "slice"))
                 .select(F.xxhash64("key", "slice").alias("cluster"), "rep", "home"), "slices")
    # members of one step meet in the slice that is home to them; a slice that is home to none adds no pair
    blocks = slices.groupBy(F.col("cluster").alias("c")).agg(F.count("*").alias("size"), F.max("home").alias("home")).where(
        "size > 1 and home = 1").select("c", F.ceil(F.col("size") / BLOCK).alias("blocks"))
    draw = (F.xxhash64("rep").cast("double") + 2.0 ** 63) / 2.0 ** 64  # block 0 has the least hashes
    placed = cut(slices.join(blocks, F.col("cluster") == F.col("c")).select(
        F.col("rep").alias("r"), "cluster", "blocks", F.least(F.floor(draw * F.col("blocks")), F.col("blocks") - 1).alias("at")), "placed")

    def compared(members: DataFrame, part: Column) -> DataFrame:
        return members.join(facts, F.col("rep") == F.col("r")).select(
            F.col("cluster").alias("key"), "rep", "n_shingles", "sketch", F.explode(part).alias("block"))

    links = within.union(_compare(compared(placed, _first_parts("at")))).distinct()
    large = placed.where("blocks > 1").select(F.col("r").alias("rep"), "cluster", F.col("at").alias("block"), "blocks")
    if large.isEmpty():
        return links
    joined = connected_components(links, "near")
    links = joined.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v"))
    outside, groups = _outsiders(large, joined)
    here = outside.select(F.col("rep").alias("r"), "cluster").join(groups, F.col("cluster") == F.col("c")).withColumn(
        "group", F.pmod(F.xxhash64("r", "cluster", F.lit(1)), "groups"))
    here = compared(here, F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.col("group") * F.col("blocks") + b))
    there = placed.drop("blocks").join(groups, F.col("cluster") == F.col("c"))
    there = compared(there, F.transform(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1), lambda g: g * F.col("blocks") + F.col("at")))
    return links.union(_compare(here.union(there))).distinct()


def _sets(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = WordHashes()
    for pdf in batches:
        sets = [shingle_set(t, memo).tobytes() for t in pdf["text"]]
        same = [xxhash.xxh3_128_digest(s) == k for s, k in zip(sets, pdf["set_key"])]
        yield pd.DataFrame({"rep": pdf["rep"], "cluster": pdf["cluster"], "block": pdf["block"], "shingles": sets})[same]


def exact_labels(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest row that each set hangs together with by links 100 * |a & b| >= 75 * |a | b|."""
    n = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([0, 0 if 100 * both >= PERCENT * (n.sum() - both) else 1])
    owner = np.repeat(np.arange(len(sets)), n)
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.append(True, value[1:] != value[:-1])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    both = np.zeros((len(sets), len(sets)), np.float64)
    total = column[-1] + 1 if len(column) else 0
    for low in range(0, total, COLUMNS):
        i, j = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, total - low)), np.float32)
        part[owner[i:j], column[i:j] - low] = 1
        both += part @ part.T
    union = n[:, None] + n - both
    return labels_of(100 * both >= PERCENT * union)


def _confirmed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf, first in whole_groups(batches, ["cluster", "part"]):
        ids, raw = pdf["rep"].to_numpy(), pdf["shingles"].tolist()
        u, v = [], []
        for i, j in zip(first, np.append(first[1:], len(ids))):
            if j - i > 1:
                label = exact_labels([np.frombuffer(s, np.uint64) for s in raw[i:j]])
                u.append(ids[i:j])
                v.append(ids[i:j][label])
        u, v = np.concatenate([*u, ids[:0]]), np.concatenate([*v, ids[:0]])
        yield pd.DataFrame({"u": u[u != v], "v": v[u != v]})


def _confirm(parts: DataFrame) -> DataFrame:
    kind = parts.schema["rep"].dataType.simpleString()
    return cut(parts.select("cluster", "part", "rep", "shingles").repartition("cluster", "part")
               .sortWithinPartitions("cluster", "part").mapInPandas(_confirmed, f"u {kind}, v {kind}"), "links")


def confirmed_edges(docs: DataFrame, classes: DataFrame, candidates: DataFrame) -> DataFrame:
    """(u, v): star edges that join exactly the classes joined by confirmed links."""
    clusters = cut(connected_components(candidates, "clusters"), "clusters")
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    members = (clusters.join(sizes, "component").join(classes.select("rep", "set_key"), F.col("id") == F.col("rep"))
               .select("rep", "set_key", F.col("component").alias("cluster"), "blocks",
                       F.pmod(F.xxhash64("rep"), "blocks").alias("block")))
    kind = members.schema["rep"].dataType.simpleString()
    sets = cut(docs.select("doc_id", "text").join(members, F.col("doc_id") == F.col("rep"))
               .select("rep", "text", "set_key", "cluster", "block")
               .mapInPandas(_sets, f"rep {kind}, cluster {kind}, block long, shingles binary"), "sets")
    counts = sets.groupBy("cluster").agg((F.max("block") + 1).alias("blocks")).withColumnRenamed("cluster", "c")
    placed = sets.join(counts, F.col("cluster") == F.col("c"))
    links = _confirm(placed.withColumn("part", F.explode(_first_parts())))
    large = cut(placed.where("blocks > 1").select("rep", "cluster", "block", "blocks"), "large")
    if large.isEmpty():
        return links
    # what is not in the largest joined part of its cluster meets every block
    outside, groups = _outsiders(large, connected_components(links, "joined"))
    outer = (outside.select(F.col("rep").alias("r"), F.col("cluster").alias("c")).join(groups, "c")
             .withColumn("group", F.pmod(F.xxhash64("r", F.lit(1)), "groups"))
             .select("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"), "blocks", "group"))
    here = sets.join(outer, F.col("rep") == F.col("r")).select(
        "rep", "cluster", "shingles", (F.col("group") * F.col("blocks") + F.col("b")).alias("part"))
    there = sets.join(groups, F.col("cluster") == F.col("c")).withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    there = there.select("rep", "cluster", "shingles", (F.col("group") * F.col("blocks") + F.col("block")).alias("part"))
    return links.union(_confirm(here.union(there)))


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, the row's own included.
    Null or wordless texts have no shingles, are linked with nothing and are kept. Rows of
    one doc_id are one node: equal ids go together even where their texts differ. Rows with
    a null doc_id hang on the others of equal set but link nothing further. Other columns
    are not read. An empty table gives an empty result.
    """
    found = cut(signatures(docs), "signatures")
    classes = cut(found.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")).where("rep is not null"), "classes")
    edges = confirmed_edges(docs, classes, cut(candidate_edges(classes), "candidates"))
    component = connected_components(edges)
    of = classes.select(F.col("set_key").alias("key"), "rep").join(component, F.col("rep") == F.col("id"), "left").select(
        "key", F.coalesce("component", "rep").alias("found"))
    return (found.select("doc_id", "n_shingles", "set_key").join(of, F.col("set_key") == F.col("key"), "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: those of each group's smallest doc_id."""
    kept_id = unused("kept_id")
    kept = cut(near_groups(docs).where("kept").select(F.col("doc_id").alias(kept_id)).distinct(), "kept")
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")
