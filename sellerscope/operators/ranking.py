"""Global ranks, cumulative counts and quantiles without a one-task window.

``Window.orderBy(x)`` with no partition moves every row into one task. The
operators here instead:

1. pre-aggregate to one row per distinct value (a hot value becomes one row);
2. split the value range into ``B`` buckets at quantile edges that are
   fetched once as literals (8 bytes per TARGET_ROWS_PER_BUCKET values, and a
   recomputed task sees the same edges, so rows never move between buckets);
3. run the ordered window inside each (partition, bucket);
4. add per-bucket offsets from a table of at most ``P x B`` rows; whether it
   is broadcast is left to the measured size (AQE).

The same table yields average ranks (pandas ``rank(pct=True)``), ROC/PR
cumulative counts and the hash-ranked stratified split. Exact interpolated
quantiles (numpy's linear method) need less: a sketch brackets the position,
and only the values inside the bracket are ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.operators.scalars import attach_scalars

# buckets grow with the data so one bucket's window stays about this size
TARGET_ROWS_PER_BUCKET = 1_000_000
DEFAULT_BUCKETS = 1
# percentile sketches are off by at most 1 / SKETCH of the rows
SKETCH = 10_000
HASH_BITS = 60
_BUCKET = "_bucket"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (the shared folder;
    set here only when the session left it unset). Cuts the lineage so a
    table read by several jobs is computed once, and a lost executor
    re-reads the checkpoint instead of recomputing the input."""
    from sellerscope.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scaled_buckets(rows: int, minimum: int = DEFAULT_BUCKETS, size: int | None = None) -> int:
    """Bucket count for ``rows`` rows: at least ``minimum``, about ``size`` rows each (``TARGET_ROWS_PER_BUCKET``)."""
    return max(minimum, math.ceil(rows / (size or TARGET_ROWS_PER_BUCKET)))


def value_edges(df: DataFrame, col: str, buckets: int = DEFAULT_BUCKETS,
                rel_err: float | None = None) -> list[float]:
    """At most ``buckets - 1`` sorted split points of ``col`` (driver
    literals; the fetch is bounded by the bucket count)."""
    if buckets <= 1:
        return []
    rel_err = rel_err if rel_err is not None else min(0.001, 0.25 / buckets)
    probs = [i / buckets for i in range(1, buckets)]
    qs = df.approxQuantile(col, probs, rel_err)
    return sorted({float(v) for v in qs if v is not None and not math.isnan(v)})


def bucket_of(value: Column, edges: list[float]) -> Column:
    """Number of edges strictly below ``value`` (monotone in value), as a
    balanced binary search of ``when`` branches: depth log2(B), so the
    generated code stays small. NULL goes to bucket 0."""
    def search(lo: int, hi: int) -> Column:
        # edges[:lo] are below value, edges[hi:] are not
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value > F.lit(edges[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))
    return search(0, len(edges))


def hash_rank_key(key: Column, seed: int) -> Column:
    """Deterministic pseudo-random 60-bit integer of (seed, key) from md5."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_bucket(h: Column, buckets: int) -> Column:
    """Bucket of a uniform 60-bit hash: integer division, no edges needed."""
    step = -(-(2 ** HASH_BITS) // buckets)
    return F.floor(h / F.lit(step)).cast("int")


def with_bucket(df: DataFrame, value_col: str, edges: list[float]) -> DataFrame:
    """Adds ``_bucket`` (monotone in the value). Up to 127 edges: a small
    codegen'd search tree; beyond: ``Bucketizer`` (a JVM binary search)."""
    if len(edges) <= 127:
        return df.withColumn(_BUCKET, bucket_of(F.col(value_col), edges))
    from pyspark.ml.feature import Bucketizer
    b = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol=value_col, outputCol=_BUCKET,
                   handleInvalid="keep")
    return b.transform(df).withColumn(_BUCKET, F.col(_BUCKET).cast("int"))


def _offsets(bucketed: DataFrame, partition_cols: list[str], sums: list[str]) -> DataFrame:
    """Per (partition, bucket): totals of earlier buckets and partition totals.

    Runs on the per-bucket totals only (at most partition keys x buckets
    rows, one per TARGET_ROWS_PER_BUCKET values), so even without partition
    keys the ordered window sees a small table."""
    totals = bucketed.groupBy(*partition_cols, _BUCKET).agg(*[F.sum(s).alias(s) for s in sums])
    before = Window.partitionBy(*partition_cols).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*partition_cols)
    cols = {}
    for s in sums:
        cols[f"{s}_offset"] = F.coalesce(F.sum(s).over(before), F.lit(0))
        cols[f"{s}_total"] = F.sum(s).over(whole)
    return totals.withColumns(cols).drop(*sums)


def prefix_sums(df: DataFrame, value_col: str, sums: dict[str, Column],
                partition_cols=(), buckets: int = DEFAULT_BUCKETS,
                edges: list[float] | None = None, descending: bool = False,
                input_materialized: bool = False) -> DataFrame:
    """One row per (partition, distinct non-null value) with, for each named
    sum: its per-value amount ``s``, the amount of all strictly earlier values
    ``s_before`` (ascending, or descending with ``descending``) and the
    partition total ``s_total``."""
    partition_cols = list(partition_cols)
    v = F.col(value_col)
    base = df.filter(v.isNotNull())
    # the double only picks the bucket; inside it the values themselves are ordered
    as_double = v.cast("double")
    agg = (base.withColumn("_ord", -as_double if descending else as_double)
           .groupBy(*partition_cols, value_col, "_ord")
           .agg(*[F.sum(c).alias(n) for n, c in sums.items()]))
    if edges is None:
        # the distinct-value table feeds two jobs (edges, then ranks): write
        # it once to the shared checkpoint folder instead of recomputing the
        # whole input lineage; it is at most as large as the input, usually
        # far smaller, and a lost executor re-reads it rather than recomputing
        if not input_materialized:
            agg = materialize(agg)
        edges = value_edges(agg, "_ord", scaled_buckets(agg.count(), buckets))
    if not edges:
        # one bucket of at most TARGET_ROWS_PER_BUCKET values: nothing comes before it
        whole = Window.partitionBy(*partition_cols)
        before = whole.orderBy(v.desc() if descending else v.asc()).rowsBetween(Window.unboundedPreceding, -1)
        out = agg.withColumns({f"{n}_before": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in sums}
                              | {f"{n}_total": F.sum(n).over(whole) for n in sums})
        return out.drop("_ord")
    bucketed = with_bucket(agg, "_ord", edges)
    w = (Window.partitionBy(*partition_cols, _BUCKET).orderBy(v.desc() if descending else v.asc())
         .rowsBetween(Window.unboundedPreceding, -1))
    within = bucketed.withColumns({f"{n}_in": F.coalesce(F.sum(n).over(w), F.lit(0)) for n in sums})
    offsets = _offsets(bucketed, partition_cols, list(sums))
    out = within.join(offsets, [*partition_cols, _BUCKET], "inner")
    out = out.withColumns({f"{n}_before": F.col(f"{n}_offset") + F.col(f"{n}_in") for n in sums})
    return out.drop(_BUCKET, "_ord", *[f"{n}_in" for n in sums], *[f"{n}_offset" for n in sums])


def average_rank_pct(df: DataFrame, value_col: str, out_col: str = "rank_pct",
                     partition_cols=(), buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """pandas ``rank(pct=True)`` (ties get their average rank / count of
    non-null values), appended to every row of ``df``; NULL stays NULL."""
    partition_cols = list(partition_cols)
    # the input feeds the distinct-value table and the join back: write it
    # once (a projected, usually filtered table) instead of recomputing it
    df = materialize(df)
    ps = prefix_sums(df, value_col, {"_n": F.lit(1).cast("long")}, partition_cols, buckets,
                     input_materialized=True)
    ranks = ps.select(*partition_cols, value_col,
                      ((F.col("_n_before") + (F.col("_n") + 1) / 2.0) / F.col("_n_total")).alias(out_col))
    return df.join(ranks, [*partition_cols, value_col], "left")


def _lerp(a: Column, b: Column, t: Column) -> Column:
    """numpy's linear interpolation (the two-sided form it uses for t >= .5)."""
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)


def _bracket(values: DataFrame, p: float, most: int) -> tuple[DataFrame, int, int]:
    """(inside, below, rows): the values between which the two positions around the p-quantile of
    ``_v`` lie, the number of rows below them, and of all. Beyond ``most`` rows a sketch gives
    the bracket; while more rows are inside, a sketch of those narrows it."""
    total = values.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    low = high = None
    inside, n, target, below = values, total, (total - 1) * p, 0
    if n > most:
        values = inside = materialize(values)  # read by every sketch and count
    while n > most:
        margin = 2 / SKETCH + 2 / n
        near = [max(0.0, target / n - margin), min(1.0, target / n + margin)]
        found = tuple(inside.agg(F.percentile_approx("_v", near, SKETCH).alias("q")).first()["q"])
        if found == (low, high):
            break  # its ends are repeated values: few distinct ones are left
        low, high = found
        inside = values.filter(F.col("_v").between(low, high))
        one = values.agg(F.count_if(F.col("_v") < low).alias("below"), F.count_if(F.col("_v").between(low, high)).alias("n")).first()
        n, below = one["n"], one["below"]
        target = (total - 1) * p - below
    return inside, below, total


def exact_quantile(df: DataFrame, value_col: str, p: float, out_col: str = "q",
                   most: int = TARGET_ROWS_PER_BUCKET) -> DataFrame:
    """One row: the exact linear-interpolation quantile (numpy default) of the
    non-null values. Up to ``most`` rows their distinct values are ranked as they are;
    beyond, a sketch brackets the two positions, exact counts say how many rows lie
    below the bracket, and only its distinct values are ranked."""
    values = df.select(F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    inside, below, total = _bracket(values, float(p), most)
    counts = inside.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    at = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(below))
    h = max(total - 1, 0) * float(p)
    lo = math.floor(h)
    hi = min(lo + 1, max(total - 1, 0))

    def value(pos: int) -> Column:
        return F.max(F.when((F.col("_before") <= pos) & (F.lit(pos) < F.col("_before") + F.col("_n")), F.col("_v")))

    one = at.agg(value(lo).alias("_lo"), value(hi).alias("_hi"))
    return one.select(_lerp(F.col("_lo"), F.col("_hi"), F.lit(h - lo)).alias(out_col))


def row_positions(df: DataFrame, order_cols: list[str], partition_cols=(),
                  bucket: Column | None = None, out_col: str = "position",
                  total_col: str = "partition_rows") -> DataFrame:
    """1-based row_number over ``order_cols`` within ``partition_cols`` plus
    the partition size, computed per bucket (``bucket`` must be monotone in
    the ordering) and offset by a small broadcast table."""
    partition_cols = list(partition_cols)
    b = df.withColumn(_BUCKET, bucket if bucket is not None else F.lit(0))
    w = Window.partitionBy(*partition_cols, _BUCKET).orderBy(*order_cols)
    within = b.withColumn("_pos_in", F.row_number().over(w)).withColumn("_one", F.lit(1).cast("long"))
    offsets = _offsets(within, partition_cols, ["_one"])
    out = within.join(offsets, [*partition_cols, _BUCKET], "inner")
    out = out.withColumns({out_col: F.col("_one_offset") + F.col("_pos_in"),
                           total_col: F.col("_one_total")})
    return out.drop(_BUCKET, "_pos_in", "_one", "_one_offset", "_one_total")


def stratified_split(df: DataFrame, label_col: str, key_col: str, test_size: float = 0.25,
                     seed: int = 42, buckets: int | None = None) -> DataFrame:
    """Adds ``is_test``: within each label the rows ranked by md5(seed:key)
    (key breaks ties), the first ceil(test_size * n_label) are test rows.
    Exact per-class fractions; membership is reproducible in SQL."""
    h = hash_rank_key(F.col(key_col), seed)
    if not buckets:
        # the row count sizes the buckets: checkpoint first so counting and
        # ranking read the same materialized rows (one lineage evaluation)
        df = materialize(df)
    df = df.withColumn("_h", h)
    b = buckets if buckets else scaled_buckets(df.count())
    pos = row_positions(df, ["_h", key_col], [label_col], hash_bucket(F.col("_h"), b), "_pos", "_n_label")
    test = F.col("_pos") <= F.ceil(F.col("_n_label") * F.lit(float(test_size)))
    return pos.withColumn("is_test", test.cast("int")).drop("_h", "_pos", "_n_label")


def stratified_folds(df: DataFrame, label_col: str, key_col: str, folds: int = 5,
                     seed: int = 42, buckets: int | None = None) -> DataFrame:
    """Adds ``fold`` in [0, folds): rows of each label dealt round-robin in
    md5(seed:key) order, so every fold gets the same class mix (+-1 row)."""
    h = hash_rank_key(F.col(key_col), seed)
    if not buckets:
        # the row count sizes the buckets: checkpoint first so counting and
        # ranking read the same materialized rows (one lineage evaluation)
        df = materialize(df)
    df = df.withColumn("_h", h)
    b = buckets if buckets else scaled_buckets(df.count())
    pos = row_positions(df, ["_h", key_col], [label_col], hash_bucket(F.col("_h"), b), "_pos", "_n_label")
    return pos.withColumn("fold", ((F.col("_pos") - 1) % folds).cast("int")).drop("_h", "_pos", "_n_label")


def histogram(df: DataFrame, value_col: str, bins: int, lo: float | None = None,
              hi: float | None = None) -> DataFrame:
    """Equal-width counts over [min, max] (or given bounds), last bin closed;
    every bin listed (zero counts included). Bounds come from a one-row
    aggregate joined by broadcast, never fetched."""
    spark = df.sparkSession
    v = F.col(value_col).cast("double")
    vals = df.select(v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if lo is None or hi is None:
        # bounds then bins: two reads of one column instead of two evaluations
        # of the input's lineage
        vals = materialize(vals)
        stats = vals.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    else:
        stats = spark.range(1).select(F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"))
    # numpy widens a zero range to [x - .5, x + .5]
    stats = stats.select(
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    norm = F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))
    idx = F.floor((F.col("_v") - F.col("_lo")) * norm).cast("int")
    idx = F.when(idx >= bins, F.lit(bins - 1)).otherwise(idx)
    in_range = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    counts = (attach_scalars(vals, stats).filter(in_range)
              .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = attach_scalars(spark.range(bins).select(F.col("id").cast("int").alias("bin")), stats)
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    out = grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * step).alias("bin_lower"),
        F.when(F.col("bin") == bins - 1, F.col("_hi")).otherwise(F.col("_lo") + (F.col("bin") + 1) * step)
        .alias("bin_upper"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    return out.orderBy("bin")


def histogram_shift(reference: DataFrame, new: DataFrame, value_col: str, bins: int = 30) -> DataFrame:
    """Score drift: both batches binned on shared equal-width edges (the
    range of the two together), with counts, shares and the share change."""
    a = reference.select(F.col(value_col).cast("double").alias("_v"), F.lit(0).alias("_side"))
    b = new.select(F.col(value_col).cast("double").alias("_v"), F.lit(1).alias("_side"))
    both = materialize(a.unionByName(b).filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    stats = both.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    stats = stats.select(
        F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    norm = F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))
    idx = F.floor((F.col("_v") - F.col("_lo")) * norm).cast("int")
    idx = F.when(idx >= bins, F.lit(bins - 1)).otherwise(idx)
    counts = (attach_scalars(both, stats).groupBy(idx.alias("bin"))
              .agg(F.sum((F.col("_side") == 0).cast("long")).alias("reference_count"),
                   F.sum((F.col("_side") == 1).cast("long")).alias("new_count")))
    totals = both.agg(F.sum((F.col("_side") == 0).cast("long")).alias("_na"),
                      F.sum((F.col("_side") == 1).cast("long")).alias("_nb"))
    grid = attach_scalars(attach_scalars(df_range(reference, bins), stats), totals)
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    out = grid.join(counts, "bin", "left").select(
        "bin", (F.col("_lo") + F.col("bin") * step).alias("bin_lower"),
        F.coalesce("reference_count", F.lit(0)).cast("long").alias("reference_count"),
        F.coalesce("new_count", F.lit(0)).cast("long").alias("new_count"),
        F.try_divide(F.coalesce("reference_count", F.lit(0)).cast("double"), F.col("_na")).alias("reference_share"),
        F.try_divide(F.coalesce("new_count", F.lit(0)).cast("double"), F.col("_nb")).alias("new_share"))
    return out.withColumn("share_change", F.col("new_share") - F.col("reference_share")).orderBy("bin")


def df_range(df: DataFrame, n: int) -> DataFrame:
    """Bin ids 0..n-1 (a bounded grid, so empty bins are listed)."""
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))


def above_quantile_flags(df: DataFrame, key_cols, specs) -> DataFrame:
    """``key_cols`` plus one 0/1 flag per (value_col, p, out_col) spec:
    value strictly above its exact p-quantile over ``df``. The projected
    input is checkpointed once and feeds every quantile and the final pass."""
    cols = list(dict.fromkeys([*key_cols, *[c for c, _, _ in specs]]))
    base = materialize(df.select(*cols))
    out = base
    for i, (col, p, name) in enumerate(specs):
        q = exact_quantile(base, col, p, f"_q{i}")
        out = attach_scalars(out, q).withColumn(name, (F.col(col) > F.col(f"_q{i}")).cast("int"))
    return out.select(*key_cols, *[name for _, _, name in specs])
