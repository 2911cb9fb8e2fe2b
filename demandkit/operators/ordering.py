"""Global ordering without a single-partition window.

``row_index`` numbers rows 0..n-1 in key order the way
``row_number() OVER (ORDER BY keys) - 1`` does, but range-partitions the
rows (composite keys split even a hot date across tasks), numbers them
inside each partition, and adds per-partition offsets from a table with one
row per partition. Contiguous folds, exact quantiles and lag/rolling series
are built on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize, written

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _as_cols(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def row_index(df: DataFrame, keys: Sequence[str | Column], idx_col: str = "row_idx",
              num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """Add ``idx_col`` = 0-based position of each row in ``keys`` order.

    The range-partitioned, position-numbered frame is checkpointed once
    (reliable checkpoint in the shared folder): the per-partition counts and
    the numbered rows must come from the same physical partitioning, and a
    recomputation after an executor loss could sample different range
    bounds. Rows tied on every key get adjacent, arbitrary positions, as
    with ``row_number``. ``total_col`` optionally carries the total row
    count on every row.
    """
    order = _as_cols(keys)
    # Without an explicit count AQE may coalesce adjacent ranges (small
    # inputs then use few tasks); positions are taken after the coalesced
    # read and checkpointed, so counts and positions always agree.
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    ranged = (ranged.sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = materialize(ranged.withColumn("_pid", F.shiftright("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    # One row per partition: bounded by n, so the offset window and the
    # broadcast below never grow with the data.
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
    )
    out = ranged.join(F.broadcast(offsets), "_pid").withColumn(
        idx_col, F.col("_off") + F.col("_pos"))
    if total_col:
        out = out.withColumn(total_col, F.col("_total"))
    return out.drop("_mid", "_pid", "_pos", "_off", "_total")


#: Rows of a range that :func:`row_numbers` aims at, sampled rows a range, and ranges at most.
RANGE_ROWS, RANGE_SAMPLE, MOST_RANGES = 2_000_000, 40, 4096


def range_bounds(df: DataFrame, keys: Sequence[str], ranges: int, seed: int = 7) -> list:
    """Up to ``ranges - 1`` ascending keys that part the rows about evenly, from a sample
    of ``RANGE_SAMPLE`` rows a range (those of the least hashes of their keys)."""
    if ranges < 2:
        return []
    sample = df.select(*keys).orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(ranges * RANGE_SAMPLE)
    rows = [tuple(r) for r in sample.sort(*keys).collect()]
    picked = [rows[len(rows) * k // ranges] for k in range(1, ranges)] if rows else []
    return [b for k, b in enumerate(picked) if b != rows[0] and b not in picked[:k]]


def _range_of(own: Column, bounds: list[Column], low: int, high: int) -> Column:
    """Number of bounds at or under ``own``, by halving."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(own >= bounds[mid], _range_of(own, bounds, mid + 1, high)).otherwise(_range_of(own, bounds, low, mid))


def row_numbers(df: DataFrame, keys: Sequence[str], idx_col: str = "row_idx", ranges: int | None = None) -> DataFrame:
    """:func:`row_index` without a copy of the rows: ranges of the composite key are
    fixed by literal bounds. One pass counts the rows of each range; a second sends each
    range to a task, which sorts and numbers it from the sum of the ranges before. Bounds
    and sums are part of the plan, so a task that is run again after a lost executor
    numbers alike. Rows equal in all keys are numbered in any order."""
    keys = list(keys)
    ranges = ranges or max(1, min(MOST_RANGES, -(-df.count() // RANGE_ROWS)))
    bounds = [F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, b)])
              for b in range_bounds(df, keys, ranges)]
    tagged = df.withColumn("_range", _range_of(F.struct(*keys), bounds, 0, len(bounds)))
    counted = {r["_range"]: r["count"] for r in tagged.groupBy("_range").count().collect()}  # a row a range
    before, total = [], 0
    for k in range(len(bounds) + 1):
        before.append(F.lit(total).cast("long"))
        total += counted.get(k, 0)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return tagged.withColumn(idx_col, F.array(*before)[F.col("_range")] + inside - 1).drop("_range")


def contiguous_folds(df: DataFrame, keys: Sequence[str], k: int = 5, fold_col: str = "fold",
                     num_partitions: int | None = None) -> DataFrame:
    """Unshuffled k-fold: k contiguous blocks in key order, the first
    ``n % k`` blocks one row longer (same blocks as ``ntile(k)``). Folds are
    numbered 1..k.

    The rows themselves are neither sorted nor copied. Counts by the leading
    key place the first row of each fold in one value of it; only rows of
    those (at most ``k - 1``) values are ordered by the whole key, and the
    ``k - 1`` keys found label every row by comparison. Rows that tie on the
    whole key share a fold."""
    lead, keys = keys[0], list(keys)
    counts = df.groupBy(lead).agg(F.count(F.lit(1)).alias("_c"))
    run = materialize(running_sum(counts, [lead], "_c", "_end", num_partitions))
    n = run.agg(F.max("_end")).first()[0] or 0
    starts, at = [], 0
    for f in range(k - 1):
        at += n // k + (f < n % k)
        if at < n:
            starts.append(at)
    if not starts:
        return df.withColumn(fold_col, F.lit(1))
    holds = [(F.col("_end") - F.col("_c") <= s) & (F.lit(s) < F.col("_end")) for s in starts]
    hit = holds[0]
    for h in holds[1:]:
        hit = hit | h
    # At most k - 1 values of the leading key, in order.
    found = run.where(hit).orderBy(lead).collect()
    edge = df.select(*keys).join(F.broadcast(run.where(hit).select(F.col(lead).alias("_lead"))),
                                 F.col(lead).eqNullSafe(F.col("_lead")), "left_semi")
    places, before = [], 0
    for row in found:
        places += [before + s - (row["_end"] - row["_c"]) for s in starts if row["_end"] - row["_c"] <= s < row["_end"]]
        before += row["_c"]
    first = row_index(edge, keys, "_ri", num_partitions=num_partitions).where(F.col("_ri").isin(places)).orderBy("_ri")
    bounds = [F.struct(*[F.lit(r[c]).cast(df.schema[c].dataType).alias(c) for c in keys]) for r in first.collect()]
    own, fold = F.struct(*keys), F.lit(1)
    for bound in bounds:
        fold = fold + (own >= bound).cast("int")
    return df.withColumn(fold_col, fold)


#: Bins of one counting pass, and rows of an interval whose values are counted one by one.
QUANTILE_BINS = 2048
QUANTILE_ROWS = 100_000


def exact_quantiles(df: DataFrame, value_col: str, qs: Sequence[float],
                    group_cols: Sequence[str] = (), bins: int = QUANTILE_BINS, rows: int = QUANTILE_ROWS) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / numpy default,
    SQL ``quantile_cont``), one column ``q_<pct>`` per quantile, per group.

    Selection by successive range counts. Every quantile lies at two positions
    of the sorted values. A pass counts the rows of the interval that holds a position in
    ``bins`` equal parts (partial counts, so a part is a row per task, however many
    rows share a value) and goes on with the part that holds it, between its own least and
    largest value. When no interval has over ``rows`` rows, or more than one value, a last
    pass counts the values in them. Nothing is sorted or kept but the intervals,
    a row per group and position. Values that aren't finite count as null does:
    they are left out."""
    g = list(group_cols)
    names = [f"q_{round(q * 100, 6):g}".replace(".", "_") for q in qs]
    value = F.col(value_col).cast("double")
    data = df.select(*g, value.alias("_v")).where(F.col("_v").isNotNull() & (F.abs("_v") < float("inf")))
    whole = data.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = []
    for i, q in enumerate(qs):
        pos = (F.col("_n") - 1) * F.lit(float(q))
        wanted += [F.struct(F.lit(2 * i).alias("_t"), F.floor(pos).alias("_at")),
                   F.struct(F.lit(2 * i + 1).alias("_t"), F.ceil(pos).alias("_at"))]
    # _at: the position within the interval; _rows: the rows in it.
    state = written(whole.select(*g, "_lo", "_hi", F.col("_n").alias("_rows"), "_n", F.inline(F.array(*wanted))), "quantiles")
    while not state.where((F.col("_lo") < F.col("_hi")) & (F.col("_rows") > rows)).isEmpty():
        state = written(_narrowed(data, state, g, bins), "quantiles")
    open_ = state.where("_lo < _hi")
    key = [*g, "_lo", "_hi"]
    counts = _inside(data, open_.select(*key).distinct(), g).groupBy(*key, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ends = counts.withColumn("_end", F.sum("_c").over(Window.partitionBy(*key).orderBy("_v")))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in key]
    hit = open_.alias("s").join(ends.alias("c"), reduce(lambda x, y: x & y, same)).where(
        "c._end - c._c <= s._at AND s._at < c._end").select(*[f"s.{c}" for c in g], "s._t", "s._n", "c._v")
    found = hit.unionByName(state.where("_lo = _hi").select(*g, "_t", "_n", F.col("_lo").alias("_v")))
    finals = []
    for i, (q, nm) in enumerate(zip(qs, names)):
        lo, hi = (F.max(F.when(F.col("_t") == 2 * i + k, F.col("_v"))) for k in (0, 1))
        pos = (F.max("_n") - 1) * F.lit(float(q))
        finals.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(nm))
    return found.groupBy(*g).agg(*finals)


def _inside(data: DataFrame, intervals: DataFrame, g: list[str]) -> DataFrame:
    """Rows of ``data`` with each interval of their group that holds them: a few rows a
    group, broadcast behind a count."""
    side = intervals.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(g)], "_lo", "_hi")
    own = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(g)], F.lit(True))
    within = own & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    return data.join(broadcast_if_small(side), within).drop(*[f"_{i}" for i in range(len(g))])


def _narrowed(data: DataFrame, state: DataFrame, g: list[str], bins: int) -> DataFrame:
    """One counting pass: every position's interval becomes the part that holds it."""
    key = [*g, "_lo", "_hi"]
    # Halves first: the width of an interval may exceed the largest double.
    share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
    part = F.least(F.floor(share * bins), F.lit(bins - 1))
    # Many positions may share an interval; a row meets each interval once.
    wide = state.where("_lo < _hi").select(*key).distinct()
    parts = _inside(data, wide, g).groupBy(*key, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
    ends = parts.withColumn("_end", F.sum("_c").over(Window.partitionBy(*key).orderBy("_part")))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in key]
    hit = state.alias("s").join(ends.alias("c"), reduce(lambda x, y: x & y, same)).where(
        "c._end - c._c <= s._at AND s._at < c._end")
    next_ = hit.select(*[f"s.{c}" for c in g], F.col("c._from").alias("_lo"), F.col("c._to").alias("_hi"), F.col("c._c").alias("_rows"),
                       "s._n", "s._t", F.expr("s._at - (c._end - c._c)").alias("_at"))
    return next_.unionByName(state.where("_lo = _hi").select(*next_.columns))


def exact_quantiles_grouped(df: DataFrame, value_col: str, qs: Sequence[float],
                            group_cols: Sequence[str]) -> DataFrame:
    """:func:`exact_quantiles` per group."""
    return exact_quantiles(df, value_col, qs, group_cols)


def running_sum(df: DataFrame, keys: Sequence[str | Column], value_col: str,
                out_col: str = "running_sum", num_partitions: int | None = None) -> DataFrame:
    """Inclusive prefix sum of ``value_col`` in ``keys`` order, computed
    like :func:`row_index`: range partitions, a per-partition running sum,
    plus the totals of all earlier partitions (one row per partition)."""
    order = _as_cols(keys)
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    ranged = materialize(ranged.sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()))
    w_in = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum(value_col).over(w_in))
    totals = ranged.groupBy("_pid").agg(F.sum(value_col).alias("_tot"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_tot").over(w), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
                 .withColumn(out_col, F.col("_off") + F.col("_local"))
                 .drop("_pid", "_local", "_off"))
