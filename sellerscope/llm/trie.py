"""The prefix trie of conversations, built as a burst trie.

A turn is known by the SHA-256 of its role and text, a prefix by a hash chained over its turns
(128 bits; two different prefixes share one with probability n^2 / 2^129). Texts are read once
and never shuffled. Equal conversations become one suffix with a number of copies.

All suffixes start in one container under the root. A container whose suffixes still hold more than
``CONTAINER`` turns is burst: it becomes a trie head, and its suffixes go on to containers by their
next turn. Whether a container bursts depends on its own size alone, so the sizes of all prefixes give
every round of bursts at once. Containers that remain are bounded; tasks hold the shards of them, sort each
one's suffixes and sweep them into nodes. One suffix alone has no branch: its nodes are read off it, however
long it is. Heads collect what lies below them along the path of their smallest conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from sellerscope.llm.common import cut

#: turns that a container may hold
CONTAINER = 512
#: conversations FAMILY apart share heads of fewer than HEADS turns
FAMILY, HEADS = 20, 4
ROOT = hashlib.sha256(b"").digest()[:16]
EMPTY = hashlib.sha256(b"").hexdigest()

_ROW = "conv long, pos long, node binary, parent binary, words long, cum long, last boolean"
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "end_rep long, head binary")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, tid, words) of every row with a conv_id; tid is the SHA-256 of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.unhex(F.sha2(both, 256)).alias("tid"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def rebuilt(rows: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """(conv, own, turn, tid, words): shared head turns (own 0) and all own turns (own 1) of every conversation.

    The own turns that the shared head replaces are still there; ``prefixes`` passes over them.
    """
    first = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "tid"))
    top = rows.where(F.col("conv") % family == 0).withColumn("i", first).where(F.col("i") < heads).select(
        F.col("conv").alias("base"), "i", "tid", "words")
    head = F.crc32(F.col("conv").cast("string")) % heads
    convs = rows.select("conv").distinct().where(F.col("conv") % family != 0).select(
        "conv", (F.col("conv") - F.col("conv") % family).alias("of"), head.alias("h")).where("h > 0")
    shared = convs.join(top, (F.col("of") == F.col("base")) & (F.col("i") <= F.col("h"))).select(
        "conv", F.lit(0).alias("own"), F.col("i").cast("long").alias("turn"), "tid", "words")
    return shared.union(rows.select("conv", F.lit(1).alias("own"), "turn", "tid", "words"))


def prefixes(rows: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per prefix of every rebuilt conversation, the root among them, by one sorted pass.

    node and parent identify the prefix and the one before it; words are those of its last turn,
    cum those of all its turns; last marks the whole conversation.
    """
    passed = F.when(F.col("conv") % family == 0, F.lit(0)).otherwise(F.crc32(F.col("conv").cast("string")) % heads)

    def chain(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, row, skip = None, None, 0
        for pdf in batches:
            out = []
            for conv, own, skipped, tid, words in zip(pdf["conv"].tolist(), pdf["own"].tolist(), pdf["passed"].tolist(), pdf["tid"],
                                                      pdf["words"].tolist()):
                if conv != now:
                    if row:
                        out.append((*row, True))
                    now, skip, row = conv, skipped, (conv, 0, ROOT, None, 0, 0)
                if own and skip:
                    skip -= 1
                    continue
                out.append((*row, False))
                row = (conv, row[1] + 1, hashlib.sha256(row[2] + tid).digest()[:16], row[2], words, row[5] + words)
            yield pd.DataFrame(out, columns=["conv", "pos", "node", "parent", "words", "cum", "last"])
        if row:
            yield pd.DataFrame([(*row, True)], columns=["conv", "pos", "node", "parent", "words", "cum", "last"])

    ordered = rows.withColumn("passed", passed).repartition("conv").sortWithinPartitions(
        "conv", "own", F.asc_nulls_first("turn"), "tid")
    return ordered.mapInPandas(chain, _ROW)


def classes(rows: DataFrame) -> DataFrame:
    """(rep, copies, node, length, total, ends): equal conversations, by their last prefix.

    ends is the SHA-256 of the members' ids in numeric order; ids stream through it, so a class of any size
    needs no more memory than another (a hash of one list cannot be parted, so one task reads a class's ids).
    """
    def members(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, rep, copies, length, total, digest = None, 0, 0, 0, 0, None
        columns = ["rep", "copies", "node", "length", "total", "ends"]
        for pdf in batches:
            out = []
            for conv, node, pos, cum in zip(pdf["conv"].tolist(), pdf["node"], pdf["pos"].tolist(), pdf["cum"].tolist()):
                if node != now:
                    if now is not None:
                        out.append((rep, copies, now, length, total, digest.hexdigest()))
                    now, rep, copies, length, total, digest = node, conv, 1, pos, cum, hashlib.sha256(str(conv).encode())
                else:
                    copies += 1
                    digest.update(b",%d" % conv)
            yield pd.DataFrame(out, columns=columns)
        if now is not None:
            yield pd.DataFrame([(rep, copies, now, length, total, digest.hexdigest())], columns=columns)

    whole = rows.where("last").select("conv", "node", "pos", "cum").repartition("node").sortWithinPartitions("node", "conv")
    return whole.mapInPandas(members, "rep long, copies long, node binary, length long, total long, ends string")


def sweep(suffixes: list[tuple[list[bytes], list[int], int, int, int]], head: bytes) -> list[tuple]:
    """The nodes of a container. A suffix is its prefixes from the container's top on, their last turns'
    words, the depth of the first, its smallest conversation, and its copies."""
    nodes: list[list] = []  # depth, parent's place, members, smallest member, children, leaves, saved, end, words
    stack: list[int] = []
    before: list[bytes] = []

    def close(to: int) -> None:
        while len(stack) > to:
            node = nodes[stack.pop()]
            node[5] = node[5] or 1
            node[6] += (node[2] - 1) * node[8]
            if stack:
                up = nodes[stack[-1]]
                up[2] += node[2]
                up[3] = min(up[3], node[3])
                up[4] += 1
                up[5] += node[5]
                up[6] += node[6]

    for path, words, depth, rep, copies in sorted(suffixes):
        same = 0
        while same < min(len(path), len(before)) and path[same] == before[same]:
            same += 1
        close(same)
        for i in range(same, len(path)):
            nodes.append([depth + i, stack[-1] if stack else None, 0, rep, 0, 0, 0, None, words[i]])
            stack.append(len(nodes) - 1)
        end = nodes[stack[-1]]
        end[2], end[3], end[7], before = end[2] + copies, min(end[3], rep), rep, path
    close(0)
    return [(m, depth, None if up is None else nodes[up][3], n, children, leaves, saved, end, head if up is None else None)
            for depth, up, n, m, children, leaves, saved, end, _ in nodes]


def _swept(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Containers, one after the other; their rows come sorted by top, conversation and place."""
    columns = [c.split()[0] for c in _NODE.split(", ")]
    top, head, conv, suffixes = None, None, None, []
    for pdf in batches:
        out = []
        for t, p, c, pos, node, words, copies in zip(pdf["top"], pdf["head"], pdf["conv"].tolist(), pdf["pos"].tolist(), pdf["node"],
                                                     pdf["words"].tolist(), pdf["copies"].tolist()):
            if t != top:
                if top is not None:
                    out += sweep(suffixes, head)
                top, head, conv, suffixes = t, p, None, []
            if c != conv:
                conv = c
                suffixes.append(([], [], pos, c, copies))
            suffixes[-1][0].append(node)
            suffixes[-1][1].append(words)
        yield _frame(out, columns)
    if top is not None:
        yield _frame(sweep(suffixes, head), columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"parent_conv_id": "Int64", "end_rep": "Int64"})


def prefix_trie(conversations: DataFrame, container: int = CONTAINER, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every conversation c is rebuilt first: the first h turns of conversation c - c % ``family``, with
    h = crc32(c) % ``heads``, then its own turns after its first h. Turns are ordered by turn, null first; turns
    of one number by the hash of role and text; repeated rows are turns each. Null roles and texts are empty. Rows
    without conv_id take no part. Other columns are not read. An empty table has no node.
    """
    rows = cut(prefixes(rebuilt(turns(conversations), family, heads), family, heads), "prefixes")
    same = cut(classes(rows), "classes")
    kept = cut(rows.drop("last").join(same.drop("ends", "node").withColumnRenamed("rep", "conv"), "conv"), "suffixes")

    # which containers burst, and the heads that they leave; "lone" is one suffix that is too long for a container
    sizes = kept.groupBy("node").agg(
        F.count("*").alias("suffixes"), F.sum("copies").alias("n"), F.min("conv").alias("m"), F.sum(F.col("length") - F.col("pos")).alias("turns"),
        F.first("pos").alias("depth"), F.first("parent").alias("up"), F.first("words").alias("w"))
    large = cut(sizes.where((F.col("turns") > container) | (F.col("depth") == 0)).withColumn(
        "is_head", (F.col("suffixes") > 1) | (F.col("depth") == 0)), "large")
    head = large.where("is_head").select("node", "n", "m", "depth", "up", "w")
    marked = cut(kept.join(large.select("node", "is_head"), "node", "left"), "marked")

    # every suffix's container: the prefix after its last head
    outside = ~F.coalesce("is_head", F.lit(False))
    start = marked.groupBy("conv").agg(
        F.min_by(F.when(outside, F.col("node")), F.when(outside, F.col("pos"))).alias("top"),
        F.min_by(F.when(outside, F.col("is_head").isNotNull()), F.when(outside, F.col("pos"))).alias("lone"),
        F.max_by(F.when(~outside, F.col("node")), F.when(~outside, F.col("pos"))).alias("head")).where("top IS NOT NULL")
    inside = cut(marked.where(outside).drop("is_head").join(start, "conv"), "containers")
    swept = inside.where("NOT lone").select("top", "head", "conv", "pos", "node", "words", "copies").repartition(
        "top").sortWithinPartitions("top", "conv", "pos").mapInPandas(_swept, _NODE)
    is_top = F.col("node") == F.col("top")
    lone = inside.where("lone").select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), F.when(~is_top, F.col("conv")).alias("parent_conv_id"),
        F.col("copies").alias("n_convs"), (F.col("pos") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("copies") - 1) * (F.col("total") - F.col("cum") + F.col("words"))).alias("saved_tokens"),
        F.when(F.col("pos") == F.col("length"), F.col("conv")).alias("end_rep"), F.when(is_top, F.col("head")).alias("head"))
    below = cut(swept.union(lone), "nodes")

    # heads: what their own containers hold, then the sums along each head's path to the root
    own = below.where("head IS NOT NULL").groupBy(F.col("head").alias("node")).agg(
        F.count("*").alias("containers"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    child = head.where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("child_heads"))
    none = F.lit(0).cast("long")
    direct = cut(head.join(own, "node", "left").join(child, "node", "left").select(
        "node", "n", "m", "depth", "up", (F.coalesce("containers", none) + F.coalesce("child_heads", none)).alias("n_children"),
        F.when(F.coalesce("containers", "child_heads").isNull(), 1).otherwise(F.coalesce("leaves", none)).cast("long").alias("leaves"),
        (F.coalesce("saved", none) + (F.col("n") - 1) * F.col("w")).alias("saved")), "heads")
    path = marked.where(~outside).select(F.col("conv").alias("m"), F.col("pos"), F.col("node").alias("above"))
    sums = direct.select("m", "depth", "leaves", "saved").join(path, "m").where("pos <= depth").groupBy(F.col("above").alias("node")).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    first = direct.select(F.col("node").alias("head"), F.col("m").alias("head_conv"))
    heads_out = direct.drop("leaves", "saved").join(sums, "node").join(first, F.col("up") == F.col("head"), "left").join(
        same.select("node", F.col("rep").alias("end_rep")), "node", "left").select(
        F.col("m").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("head_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", "end_rep")
    rest = below.join(first, "head", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "head_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "end_rep")
    return heads_out.union(rest).join(same.select(F.col("rep").alias("end_rep"), "ends"), "end_rep", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))
