"""Near-duplicate embeddings by int8 tile products with rigorous bounds.

Unit vectors are quantised to int8 with a scale of their own, and the length
of the quantisation error of each is kept. For two vectors ``x = a + e`` and
``y = b + f`` (``a``, ``b`` the quantised forms) the cosine is at most
``a.b + |a||f| + |e||b| + |e||f|``; tiles of such products decide which pairs
may reach the threshold, and only these are recomputed in double precision.
Nothing that could be a link is left out.

Equal vectors are one class first, so a vector that a third of all rows
repeat is compared once. The classes are dealt into blocks by hash, and each
pair of blocks is one group of a Spark shuffle. Its task goes through tiles
and returns link counts and the links of a spanning forest, never all pairs.
The work is quadratic, as an exact answer over arbitrary vectors needs; the
blocks grow with the table so that the rows shipped grow with its power of
1.5 (see ``block_rows``).

Defined cases: a vector that is null, empty, zero or has null or non-finite
components links with nothing and is its own component; vectors of different
lengths never link; equal vectors link with each other; a vec_id on several
rows is one vertex with a row of its own each; a null vec_id stays null and
its component is the smallest vec_id it reaches, null if there is none;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, checkpointed, key_runs, map_arrow, map_passes
from .graph import connected_components

SIMILARITY = 0.95
#: Rows and columns of a tile inside a pair of blocks.
TILE = (1024, 4096)
LEAST_BLOCK, MOST_BLOCK = 2_048, 65_536

NO_ID = 1 << 62


def block_rows(total: int) -> int:
    """Vectors of a block; a pair of the largest needs some 200 MB at 128 dimensions."""
    return min(MOST_BLOCK, max(LEAST_BLOCK, 16 * math.isqrt(total)))


def units(raw: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length at unit length, in double precision."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1)[:, None]  # no overflow or underflow of the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """int8 codes of unit vectors, their common scale, and the length of each
    one's error (rounded up)."""
    scale = float(np.abs(vectors).max()) / 127.0
    codes = np.rint(vectors / scale).astype(np.int8)
    error = np.linalg.norm(vectors - codes * scale, axis=1) * (1 + 1e-9) + 1e-12
    return codes, scale, error


def possible(a: tuple, b: tuple, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the pairs of two tiles (codes, scale, errors) whose
    cosine may reach ``least``. Products of int8 codes are sums of whole
    numbers under 2**24 (up to 1000 dimensions) that float32 holds exactly;
    longer vectors use float64. The tile's largest errors sift, each pair's
    own errors decide."""
    (ca, sa, ea), (cb, sb, eb) = a, b
    kind = np.float32 if ca.shape[1] <= 1000 else np.float64
    dots = ca.astype(kind) @ cb.astype(kind).T
    bound = lambda e, f: least - e - f - 3 * e * f - 1e-9  # noqa: E731  |a| <= 1 + |e|
    row, col = np.divmod(np.flatnonzero(dots >= kind(math.floor(bound(ea.max(), eb.max()) / (sa * sb)))), len(cb))
    sure = dots[row, col].astype(np.float64) * (sa * sb) >= bound(ea[row], eb[col])
    return row[sure], col[sure]


def linked_pairs(x: np.ndarray, y: np.ndarray, similarity: float, same: bool):
    """Rows and columns of the pairs with cosine >= ``similarity``, tile by
    tile; within one block (``same``) each pair once."""
    left = [quantise(x[i:i + TILE[0]]) for i in range(0, len(x), TILE[0])]
    right = [quantise(y[j:j + TILE[1]]) for j in range(0, len(y), TILE[1])]
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if same and (j + 1) * TILE[1] <= i * TILE[0]:
                continue
            row, col = possible(a, b, similarity)
            row, col = row + i * TILE[0], col + j * TILE[1]
            if same:
                keep = row < col
                row, col = row[keep], col[keep]
            for at in range(0, len(row), 200_000):
                r, c = row[at:at + 200_000], col[at:at + 200_000]
                exact = np.einsum("ij,ij->i", x[r], y[c]) >= similarity
                if exact.any():
                    yield r[exact], c[exact]


class Parts:
    """Connected parts of numbered members, kept as one label array."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.forest: list[tuple[int, int]] = []

    def connect(self, a: np.ndarray, b: np.ndarray) -> None:
        la, lb = self.label[a], self.label[b]
        apart = la != lb
        if not apart.any():
            return
        keys, at = np.unique(np.minimum(la, lb)[apart] * len(self.label) + np.maximum(la, lb)[apart], return_index=True)
        a, b = a[apart][at], b[apart][at]
        up: dict[int, int] = {}

        def root(i: int) -> int:
            while i in up:
                i = up[i]
            return i

        for k, i, j in zip(keys.tolist(), a.tolist(), b.tolist(), strict=True):
            p, q = root(k // len(self.label)), root(k % len(self.label))
            if p != q:
                up[max(p, q)] = min(p, q)
                self.forest.append((i, j))
        changed = np.array(list(up), np.int64)
        names = np.arange(len(self.label))
        names[changed] = [root(i) for i in changed.tolist()]
        self.label = names[self.label]


_SEEN = "vec_id long, valid boolean, d1 long, d2 long, raw binary"
_FOUND = "u long, v long, links long"


def _packed(embeddings: DataFrame, kind: str) -> DataFrame:
    """Raw components and their digest, or null for a vector that can't link."""
    def step(b: pa.RecordBatch) -> dict:
        raw = []
        for values in b.column("embedding").to_pylist():
            x = np.array(values, kind) if values and None not in values else None
            raw.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
        digests = [np.frombuffer(hashlib.blake2b(r or b"", digest_size=16).digest(), np.int64).tolist() for r in raw]
        return {"vec_id": b.column("vec_id"), "valid": [r is not None for r in raw],
                "d1": [d[0] for d in digests], "d2": [d[1] for d in digests], "raw": raw}

    return map_passes(embeddings, _SEEN, step, column="embedding")


def _compare(pairs: DataFrame, similarity: float, kind: str) -> DataFrame:
    """Link counts (u = v) and forest links of the block pairs ``pair``."""
    schema = arrow_schema(_FOUND)

    def run(batches):
        for group in key_runs(batches, "pair"):
            cols = {c: group.column(c).to_pylist() for c in ("side", "node", "copies", "raw")}
            _, i, j = group.column("pair")[0].as_py().split("/")
            yield _rows(_one_pair(cols, similarity, kind, same=i == j), schema)

    return map_arrow(pairs.repartition("pair").sortWithinPartitions("pair", "side", "node"), run, _FOUND)


def _one_pair(cols: dict[str, list], similarity: float, kind: str, same: bool) -> list[tuple]:
    """Link counts and forest links of a block with itself (``same``) or with
    another one, which may hold no vector of this length."""
    cut = sum(s == 0 for s in cols["side"])
    node, copies = np.array(cols["node"], np.int64), np.array(cols["copies"], np.int64)
    count, parts = np.zeros(len(node), np.int64), Parts(len(node))
    shift = 0 if same else cut
    if cut and shift < len(node):
        x = units(cols["raw"][:cut], kind)
        y = x if same else units(cols["raw"][cut:], kind)
        for r, c in linked_pairs(x, y, similarity, same):
            c = c + shift
            np.add.at(count, r, copies[c])
            np.add.at(count, c, copies[r])
            parts.connect(r, c)
    out = [(int(node[i]), int(node[i]), int(count[i])) for i in np.flatnonzero(count)]
    return out + [(int(node[i]), int(node[j]), 0) for i, j in parts.forest]


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def components(embeddings: DataFrame, similarity: float = SIMILARITY, rows: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. ``rows``
    overrides the size of a block."""
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    slim = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(
        "array<float>" if kind == "<f4" else "array<double>").alias("embedding"))
    nameless = F.lit(NO_ID) + F.pmod(F.xxhash64("d1", "d2"), F.lit(1 << 60))
    seen = checkpointed(_packed(slim, kind).withColumn("id", F.coalesce("vec_id", nameless)))
    classes = checkpointed(seen.where("valid").groupBy("d1", "d2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.any_value("raw").alias("raw")))
    total = classes.count()
    n = max(1, -(-total // (rows or block_rows(total))))
    # Every block meets itself and each other one: a row goes to n pairs. Vectors of another length are other pairs.
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block, size = F.pmod(F.xxhash64("d1", "d2", F.lit(4)), F.lit(n)), F.length("raw")
    pairs = (classes.select("node", "copies", "raw", block.alias("block")).withColumn("other", other)
             .select(F.concat_ws("/", size, F.least("block", "other"), F.greatest("block", "other")).alias("pair"),
                     (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "copies", "raw"))
    found = checkpointed(_compare(pairs, similarity, kind))
    counted = found.where("u = v").groupBy("u").agg(F.sum("links").alias("links"))
    label = connected_components(found.where("u != v").select("u", "v"))
    vertex = (classes.select("d1", "d2", "node", "copies").join(counted, F.col("node") == F.col("u"), "left")
              .join(label, "node", "left")
              .select("d1", "d2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("label", "node").alias("component")))
    out = seen.select("vec_id", "id", "valid", "d1", "d2").join(vertex, ["d1", "d2"], "left")
    component = F.coalesce("component", "id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.when(component < NO_ID, component).alias("component_id"),
                      (F.col("id") == component).alias("kept"))
