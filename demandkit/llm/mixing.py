"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source whose target is ``x`` times its size is wanted ``x``
times: ``floor(x)`` whole copies and a fraction. Pivotal rounding pairs two
fractional documents of a source and moves mass between them at random, in
proportion to their sizes so that the words taken stay the same, until one
of them is whole. Each leaf (a hash slice of a source, so that a hot source
is split) goes from its largest document to its smallest and pairs each with all the
smaller ones together, so a long document is balanced by many short ones and a leaf leaves
one fractional document of the smallest; the residuals of the leaves meet in
a reduction tree, pair by pair and level by level, until one per source is left, which is
rounded to the nearer side. All draws are functions of the seed and the doc_id:
reruns agree, whatever the partitioning.

Defined cases: null text has size 0; documents of size 0 are never taken; a
null source is a source of its own, last in order; a document without
doc_id draws by its text; repeated rows are rounded one by one; an empty table gives an
empty result; a source of total size 0 has target 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import row_index
from .common import arrow_schema, checkpointed, free_names, key_runs, map_arrow, map_passes, small, utf8

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 20_011
#: Documents of a leaf, and residuals that meet in one node of the tree.
LEAF_ROWS = 4096
TREE_FAN = 256

_LEAF = "node long, source_no long, doc_id long, doc_key long, size long, base long, fraction double"


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, doc_key of each document (words are runs of
    anything but ASCII white space)."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("doc_key"),
                       utf8().alias("text"))

    def step(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column("doc_id"), "source": b.column("source"), "doc_key": b.column("doc_key"),
                "size": [len(t.split()) for t in b.column("text").to_pylist()]}

    return map_passes(slim, "doc_id long, source string, doc_key long, size long", step)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: source, source_no, source_size, n_docs, target.

    Weights go round the sources in code-point order, null last. A target
    beyond ``most`` times its source stops there and its excess goes to the
    rest by weight, until none is above; only two totals a round come to
    the driver."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = row_index(sources, [F.col("source").isNull(), F.col("source")], "source_no")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("source_no") % len(weights) + 1).cast("int"))
    table = checkpointed(ranked.withColumn("weight", weight.cast("long"))
                         .withColumn("cap", F.col("source_size") * most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share: Column = F.lit(0.0)
    level, bounded = None, F.lit(False)
    while True:
        held, open_weight = table.agg(F.sum(F.when(bounded, F.col("cap")).otherwise(0)),
                                      F.sum(F.when(~bounded, F.col("weight")).otherwise(0))).first()
        if not open_weight:
            share = F.col("cap").cast("double")
            break
        rest = total - (held or 0)
        share = F.col("weight") * F.lit(float(rest)) / F.lit(float(open_weight))
        if (rest, open_weight) == level:
            break
        level = (rest, open_weight)
        # In whole numbers, so that a target that just meets its bound isn't above it.
        bounded = bounded | (F.col("weight").cast("decimal(38,0)") * F.lit(rest).cast("decimal(38,0)")
                             > F.col("cap").cast("decimal(38,0)") * F.lit(open_weight).cast("decimal(38,0)"))
    target = F.when(bounded, F.col("cap").cast("double")).otherwise(share)
    return table.select("source", "source_no", "source_size", "n_docs", target.alias("target"))


def _draw(keys: np.ndarray, salt: int) -> np.ndarray:
    """Uniform [0, 1) numbers from 64-bit keys (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.int64).view(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def pivot(sizes: list[int], fractions: list[float], draws: list[float]) -> tuple[list[float], int]:
    """Round fractions by pairs, keeping the sum of size x fraction: all but
    one become 0 or 1. Returns them and the position of the one left (-1:
    none)."""
    out, i = list(fractions), -1
    for j, b in enumerate(fractions):
        if not 0.0 < b < 1.0 or sizes[j] <= 0:
            continue
        if i < 0:
            i = j
            continue
        a, s, t = out[i], sizes[i], sizes[j]
        up, down = min(1.0 - a, b * t / s), min(a, (1.0 - b) * t / s)
        if draws[j] * (up + down) < down:  # a rises, b falls
            a_full = (1.0 - a) * s <= b * t
            out[i], out[j] = (1.0, b - (1.0 - a) * s / t) if a_full else (a + b * t / s, 0.0)
            i = j if a_full else i
        else:
            a_empty = a * s <= (1.0 - b) * t
            out[i], out[j] = (0.0, b + a * s / t) if a_empty else (a - (1.0 - b) * t / s, 1.0)
            i = j if a_empty else i
        if not 1e-12 < out[i] < 1.0 - 1e-12:
            out[i] = round(out[i])
            i = -1
    return out, i


def settle(sizes: list[int], fraction: float, draws: list[float]) -> list[float]:
    """Round equal fractions of a leaf whose sizes descend. Each document is paired with all
    the smaller ones as one partner: mass moves between the two at random until the
    document is whole, and what the smaller ones gain or lose they share evenly, so they keep a
    common fraction. The words taken stay the same, and what is left fractional is one document, the
    smallest as a rule. Where the smaller ones can balance only one of the outcomes, that one is taken;
    where none, they become whole and the document stays fractional."""
    used = [i for i, s in enumerate(sizes) if s > 0]
    out = [fraction] * len(sizes)
    if not 0.0 < fraction < 1.0 or len(used) < 2:
        return out
    rest = float(sum(sizes))
    words = fraction * rest
    for i in used[:-1]:
        s = sizes[i]
        rest -= s
        taken, left = 0.0 <= words - s <= rest, words <= rest
        if not taken and not left:  # neither outcome: the smaller ones become whole, this one stays
            high = draws[i] * (s + rest) < words
            out[i] = (words - rest * high) / s
            for j in used[used.index(i) + 1:]:
                out[j] = float(high)
            return out
        one = draws[i] * (s + rest) < words if taken and left else taken
        out[i] = float(one)
        words = min(max(words - s * one, 0.0), rest)
    last = words / sizes[used[-1]]
    out[used[-1]] = last if 1e-12 < last < 1.0 - 1e-12 else float(round(last))
    return out


def _round_nodes(level: int, seed: int):
    schema = arrow_schema(_LEAF)

    def run(batches):
        for run_ in key_runs(batches, "node"):
            cols = {c: run_.column(c).to_pylist() for c in run_.column_names}
            keys = [k if d is None else d for d, k in zip(cols["doc_id"], cols["doc_key"], strict=True)]
            draws = _draw(np.array(keys, np.int64), seed + level).tolist()
            if level:
                cols["fraction"], _ = pivot(cols["size"], cols["fraction"], draws)
            else:
                cols["fraction"] = settle(cols["size"], cols["fraction"][0], draws)
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in schema], schema=schema)

    return run


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED,
           leaf_rows: int = LEAF_ROWS, fan: int = TREE_FAN) -> DataFrame:
    """One row per document: doc_id, doc_key, size, source_size, target,
    copies (0 to ``most``), taken (words)."""
    sized = checkpointed(word_counts(docs))
    targets = checkpointed(source_targets(sized, weights, most)
                           .withColumn("times", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                       .otherwise(F.lit(0.0)))
                           .withColumn("leaves", F.ceil(F.col("n_docs") / leaf_rows).cast("long")))
    leaf = F.pmod(F.xxhash64(F.coalesce("doc_id", "doc_key"), F.lit(seed)), F.col("leaves"))
    rows = (sized.join(small(targets), sized["source"].eqNullSafe(targets["source"]))
            .select(leaf.alias("node"), "source_no", "doc_id", "doc_key", "size",
                    F.floor("times").cast("long").alias("base"), (F.col("times") - F.floor("times")).alias("fraction")))
    done, level = None, 0
    most_nodes = targets.agg(F.max("leaves")).first()[0] or 1
    while True:
        # A node of the tree is (source, slice): one column, as runs of equal keys are read.
        keyed = rows.withColumn("node", F.col("source_no") * F.lit(1 << 40) + F.col("node"))
        keyed = map_arrow(keyed.repartition("node").sortWithinPartitions("node", F.desc("size"), "doc_id", "doc_key"),
                          _round_nodes(level, seed), _LEAF)
        keyed = checkpointed(keyed.withColumn("node", F.col("node") % F.lit(1 << 40)))
        open_ = (F.col("fraction") > 0) & (F.col("fraction") < 1) & (F.col("size") > 0)
        if most_nodes == 1:
            left = F.when(open_, (F.col("fraction") >= 0.5).cast("double")).otherwise(F.col("fraction"))
            keyed, last = keyed.withColumn("fraction", left), True
        else:
            last = False
        whole = keyed if last else keyed.where(~open_)
        done = whole if done is None else done.unionByName(whole)
        if last:
            break
        rows = keyed.where(open_).withColumn("node", F.floor(F.col("node") / fan).cast("long"))
        most_nodes, level = -(-most_nodes // fan), level + 1
    n = F.when(F.col("size") > 0, F.col("base") + F.col("fraction").cast("long")).otherwise(F.lit(0).cast("long"))
    return (done.withColumn("copies", n).join(small(targets.select("source_no", "source_size", "target")), "source_no")
            .select("doc_id", "doc_key", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, each as many times as it is taken. Rows equal in
    doc_id and text are one document here, whose copies add up."""
    taken = (copies(docs, **options).where("copies > 0").groupBy("doc_id", "doc_key")
             .agg(F.sum("copies").cast("int").alias("_copies")))
    key, same_id, same_key, n, copy = free_names(docs, "text_key", "taken_id", "taken_key", "taken_copies", "copy_no")
    taken = taken.withColumnsRenamed({"doc_id": same_id, "doc_key": same_key, "_copies": n})
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return (keyed.dropDuplicates(["doc_id", key])
            .join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col(same_id)) & (F.col(key) == F.col(same_key)))
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
