"""Mixing sources to target weights by Pfair scheduling of source blocks.

Every source's documents, in a hashed order, are parted into blocks of ``block`` documents.
Weights are integer shares; with their sum D, the j-th block of a source of share k is
released at slot floor(j D / k) and due by slot ceil((j + 1) D / k). Earliest deadline first
among released blocks then keeps each source within less than one block of its share at
every slot. The schedule repeats after D slots, so only one period is simulated, and a
task places a block by arithmetic. In the period in which a source runs out, its empty slots
are closed up; after it, the rest is scheduled anew by their shares. No document is dropped
or repeated.

The ``OWN`` largest sources are scheduled at the root. All others hang, by hash, in a tree
of pools of about ``FAN`` members each: a pool gets slots like a source, and its own
schedule, by the same rule, gives them to its members. A pool's member is within less than
one block of its share of the pool's slots; of all slots it is within less than 1 + f blocks,
f < 1 being its share of the pool (plus f f' for a pool in a pool, and so on). Every
pool is scheduled in a task of its own from one row a member.

Blocks are numbered from counts per source and hash range, so a source of any size is never
one group.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from functools import reduce
from math import ceil, gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.llm.common import cut

BLOCK = 16
#: sources of the root when no weights are given, members of a pool on average, the sum of a node's shares, the power of sizes
OWN, FAN, TOTAL, POWER = 128, 128, 4096, 0.7
#: rows of a hash range, on average
RANGE_ROWS = 20_000
ROOT = "root"
SCHEDULE = ("_node string, _child string, _low long, _high long, _share long, _start long, _total long, "
            "_slots array<struct<release: long, deadline: long, at: long>>")


def period(shares: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, j, release, deadline, slot) of the blocks of one period, earliest deadline first."""
    total = sum(shares.values())

    def block(i: str, j: int) -> tuple[int, int, str, int]:
        return j * total // shares[i], -(-(j + 1) * total // shares[i]), i, j

    coming, ready, out = [block(i, 0) for i in shares], [], []
    heapq.heapify(coming)
    for slot in range(total):
        while coming and coming[0][0] <= slot:  # a source's next block is known once the last one is released
            release, deadline, i, j = heapq.heappop(coming)
            heapq.heappush(ready, (deadline, i, j, release))
            if j + 1 < shares[i]:
                heapq.heappush(coming, block(i, j + 1))
        deadline, i, j, release = heapq.heappop(ready)
        out.append((i, j, release, deadline, slot))
    return out


def phases(blocks: dict[str, int], shares: dict[str, int]) -> list[tuple]:
    """(source, low, high, share, start, total, [(release, deadline, slot)]): the blocks that a source places in a phase,
    and the slots of those of one period of it.

    A phase is as many whole periods as every source has blocks for, or one period in which a source runs out and its
    empty slots are closed up. Either gives each source that goes on exactly its share.
    """
    done, start, out = dict.fromkeys(blocks, 0), 0, []
    while active := {i: shares[i] for i in blocks if done[i] < blocks[i]}:
        d = reduce(gcd, active.values())
        active = {i: k // d for i, k in active.items()}
        total, left = sum(active.values()), {i: blocks[i] - done[i] for i in active}
        plan = {i: [] for i in active}
        for i, _, *times in period(active):
            plan[i].append(tuple(times))
        if turns := min(left[i] // k for i, k in active.items()):
            out += [(i, done[i], done[i] + turns * k, k, start, total, plan[i]) for i, k in active.items()]
            placed, start = {i: turns * k for i, k in active.items()}, start + turns * total
        else:
            plan = {i: x[:left[i]] for i, x in plan.items()}
            kept = sorted(x[-1] for each in plan.values() for x in each)
            placed = {i: len(x) for i, x in plan.items()}
            out += [(i, done[i], done[i] + placed[i], placed[i], start, len(kept),
                     [tuple(bisect_left(kept, at) for at in times) for times in x]) for i, x in plan.items()]
            start += len(kept)
        for i, n in placed.items():
            done[i] += n
    return out


def _node_schedule(given: dict[str, int] | None):
    """A function that schedules the members of one node; ``given`` are the root's shares, where they are set."""
    def schedule(members: pd.DataFrame) -> pd.DataFrame:
        node, names = members["_node"].iloc[0], members["_child"].tolist()
        if given is not None and node == ROOT:
            shares = {i: given[i] for i in names}
        else:
            total = members["_weight"].sum()
            shares = {i: max(1, round(TOTAL * w / total)) for i, w in zip(names, members["_weight"])}
        rows = phases(dict(zip(names, members["_blocks"].tolist())), shares)
        return pd.DataFrame([(node, *r[:-1], [dict(zip(("release", "deadline", "at"), x)) for x in r[-1]]) for r in rows],
                            columns=["_node", "_child", "_low", "_high", "_share", "_start", "_total", "_slots"])
    return schedule


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def _tree(sized: DataFrame, own: list[str], pooled: int, block: int) -> tuple[DataFrame, list[int]]:
    """(_node, _child, _weight, _blocks): members of every node, and the number of pools of each level, leaves first."""
    pools = []
    while pooled and (not pools or pools[-1] > 1):
        pools.append(ceil((pools[-1] if pools else pooled) / FAN))
    leaf = F.concat(F.lit("0/"), F.pmod(F.xxhash64("_child"), F.lit(pools[0])).cast("string")) if pools else F.lit(ROOT)
    found = level = sized.select(F.when(F.col("_child").isin(own), F.lit(ROOT)).otherwise(leaf).alias("_node"), "_child",
                                 F.pow(F.col("_n"), F.lit(POWER)).alias("_weight"), F.ceil(F.col("_n") / block).alias("_blocks"))
    for _ in pools:
        level = level.where(F.col("_node") != ROOT).groupBy(F.col("_node").alias("_child")).agg(
            F.sum("_weight").alias("_weight"), F.sum("_blocks").alias("_blocks"))
        level = level.select(_parent(F.col("_child"), pools).alias("_node"), "_child", "_weight", "_blocks")
        found = found.unionByName(level)
    return found, pools


def _parent(pool: Column, pools: list[int]) -> Column:
    """The node that a pool "level/number" hangs in."""
    level, number = (F.split_part(pool, F.lit("/"), F.lit(i)).try_cast("long") for i in (1, 2))
    out = F.lit(ROOT)
    for i, n in enumerate(pools[1:]):
        out = F.when(level == i, F.concat(F.lit(f"{i + 1}/"), F.pmod(number, F.lit(n)).cast("string"))).otherwise(out)
    return out


def _place(blocks: DataFrame, schedule: DataFrame) -> DataFrame:
    """Blocks (_n, _c, _at: the block's number there) with the slot in _n as _to, and _release and _deadline in the same count."""
    rows = blocks.join(schedule, (F.col("_n") == F.col("_node")) & (F.col("_c") == F.col("_child"))
                       & (F.col("_at") >= F.col("_low")) & (F.col("_at") < F.col("_high")))
    step = F.col("_at") - F.col("_low")
    base = F.col("_start") + F.floor(step / F.col("_share")).cast("long") * F.col("_total")
    entry = F.get("_slots", F.pmod(step, F.col("_share")).cast("int"))  # may be evaluated before the join's bounds are
    return rows.select(*blocks.columns, (base + entry["at"]).alias("_to"), (base + entry["release"]).alias("_release"),
                       (base + entry["deadline"]).alias("_deadline"))


def mix(docs: DataFrame, weights: dict[str, int] | None = None, pool_share: int = 1, block: int = BLOCK,
        range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows of ``docs``, in no particular order, with _component, _block, _release, _turn, _deadline, _slot, _place.

    Ordered by (_slot, _place) they are the mixture. ``weights`` gives integer shares of at
    least 1 by source; all other sources share a pool of ``pool_share``. Without weights, a source's share is a power of its
    size, in 1/``TOTAL`` of its node's slots and at least one of them. Null sources are a source like others.
    _component is the node that schedules the row's source: "root", or a pool of it. Of that node's slots the block has
    _turn, was released at _release and was due by _deadline; _slot is its slot of all. At the root, _turn is _slot.
    Repeated rows are placed each. Column names that begin with an underscore are reserved. An empty table gives an
    empty result.
    """
    if weights is not None and (not weights or min(*weights.values(), pool_share) < 1):
        raise ValueError("weights are integers of at least 1")
    key = F.xxhash64("doc_id", "source")
    all_rows = docs.count()
    ranges = max(1, all_rows // range_rows)
    # a hash range keeps the order of the hash: blocks are numbered by ranges, then inside them
    part = F.floor((key.cast("double") + 2.0 ** 63) / 2.0 ** 64 * ranges).cast("long")
    parts = docs.select(_source_key(F.col("source")).alias("_c"), part.alias("_p")).groupBy("_c", "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_c").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.select("_c", "_p", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "ranges")

    sized = parts.groupBy(F.col("_c").alias("_child")).agg(F.sum("_n").alias("_n"))
    if weights is None:
        own = [r["_child"] for r in sized.orderBy(F.desc("_n"), "_child").limit(OWN).collect()]
    else:
        own = [f"={s}" for s in weights]
    pooled = sized.where(~F.col("_child").isin(own)).count()
    members, pools = _tree(sized, own, pooled, block)
    given = None if weights is None else {f"={s}": k for s, k in weights.items()} | {f"{len(pools) - 1}/0": pool_share}
    schedule = cut(members.groupBy("_node").applyInPandas(_node_schedule(given), SCHEDULE), "schedule")

    # every block of a range: one that two ranges share is placed in both, alike
    low, high = F.floor(F.col("_base") / block), F.floor((F.col("_base") + F.col("_n") - 1) / block)
    leaf = members.where(~F.col("_child").rlike("^[0-9]+/")).select(F.col("_child").alias("_k"), F.col("_node").alias("_n"))
    blocks = (parts.select("_c", "_p", F.explode(F.sequence(low, high)).alias("_b"))
              .join(leaf, F.col("_c") == F.col("_k")).select("_c", "_p", "_b", "_n", F.col("_b").alias("_at")))
    first = _place(blocks, schedule)
    first = first.select("_c", "_p", "_b", F.col("_n").alias("_component"), "_release", "_deadline", F.col("_to").alias("_turn"),
                         F.col("_to").alias("_slot"))
    if pools:
        first = cut(first, "blocks")  # a level's plan does not hold those below
    placed = first.where(F.col("_component") == ROOT)
    if pools:
        up = first.where(F.col("_component") != ROOT).withColumn("_pool", F.col("_component"))
        for _ in pools:
            kept = ["_c", "_p", "_b", "_component", "_release", "_deadline", "_turn"]
            step = up.select(F.struct(*kept).alias("_row"), _parent(F.col("_pool"), pools).alias("_n"), F.col("_pool").alias("_c"),
                             F.col("_slot").alias("_at"))
            up = cut(_place(step, schedule).select("_row.*", F.col("_to").alias("_slot"), F.col("_n").alias("_pool")), "blocks")
        placed = placed.unionByName(up.drop("_pool"))
    # a range's places are one row, so documents meet them where the window has put them
    entry = F.struct("_b", "_release", "_deadline", "_turn", "_slot")
    placed = placed.groupBy("_c", "_p", "_component").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    bases = parts.select(F.col("_c").alias("_c1"), F.col("_p").alias("_p1"), "_base")
    placed = placed.join(bases, (F.col("_c") == F.col("_c1")) & (F.col("_p") == F.col("_p1")))
    placed = placed.select(F.col("_c").alias("_c2"), F.col("_p").alias("_p2"), "_component", "_entries", "_base")

    rows = docs.withColumn("_source", _source_key(F.col("source"))).withColumn("_key", key).withColumn("_part", part)
    rank = F.row_number().over(Window.partitionBy("_source", "_part").orderBy("_key", "doc_id")) - 1
    ranked = rows.withColumn("_in", rank).join(placed, (F.col("_source") == F.col("_c2")) & (F.col("_part") == F.col("_p2")))
    at = F.col("_base") + F.col("_in")
    which = F.floor(at / block).cast("long")
    found = F.get("_entries", (which - F.floor(F.col("_base") / block)).cast("int"))
    return ranked.select(*docs.columns, "_component", which.alias("_block"), *[found[c].alias(c) for c in
                         ("_release", "_turn", "_deadline", "_slot")], F.pmod(at, F.lit(block)).cast("int").alias("_place"))


def in_order(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The rows in the order of the mixture: ranges of slots over the partitions, sorted inside."""
    return mixed.repartitionByRange(F.col("_slot"), F.col("_place")).sortWithinPartitions("_slot", "_place").select(*columns)

