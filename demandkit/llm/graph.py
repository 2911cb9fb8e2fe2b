"""Connected components of a graph that is a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, checkpointed, map_arrow

#: Links of a task that are contracted at once.
LOCAL_LINKS = 500_000

_EDGE = "u long, v long"


def _contract(batches):
    """Replace the links of a task by a star around the smallest vertex of each
    part that they connect; memory is bounded by ``LOCAL_LINKS``."""
    schema = arrow_schema(_EDGE)

    def stars(up: dict[int, int]):
        pairs = [(x, _root(up, x)) for x in up]
        pairs = [p for p in pairs if p[0] != p[1]]
        cols = list(zip(*pairs, strict=True)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    up: dict[int, int] = {}
    seen = 0
    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            up.setdefault(u, u)
            up.setdefault(v, v)
            a, c = _root(up, u), _root(up, v)
            up[max(a, c)] = min(a, c)
        seen += b.num_rows
        if seen > LOCAL_LINKS:
            yield stars(up)
            up, seen = {}, 0
    yield stars(up)


def _root(up: dict[int, int], x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating-star algorithm. Large: every vertex ties
    its larger neighbours to its smallest one; small: its smaller ones and
    itself. Minima are aggregated before the shuffle and cut off, so that
    a hub's edges meet its minimum in a join whose hot keys Spark can split."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where("u != v")
    least = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")))
    out = (edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
           .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Every vertex is a centre or hangs on one centre only."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest vertex that each vertex of ``edges`` (columns
    u, v of long) can reach. Vertices without a link don't occur. Each
    task contracts its own links first; then stars alternate until they are
    a forest of stars. Lineage is cut by a checkpoint each round."""
    now = checkpointed(map_arrow(edges.select("u", "v").where("u != v"), _contract, _EDGE).distinct())
    while not _is_star_forest(now):
        now = checkpointed(_star(_star(now, large=True), large=False))
    return (now.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
