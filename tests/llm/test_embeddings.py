import numpy as np
import pytest
from pyspark.sql import types as T

from demandkit.llm import embeddings as E


def table(spark, rows, kind=T.FloatType()):
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind)),
        T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType())])).repartition(3)


def brute(rows, similarity=0.95, kind=np.float32):
    vectors = {}
    for i, x, *_ in rows:
        if x and None not in x:
            v = np.array(x, kind).astype(np.float64)
            if np.isfinite(v).all() and v.any():
                vectors[i] = v / np.linalg.norm(v)
    up = {i: i for i, *_ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = dict.fromkeys(up, 0)
    ids = sorted(vectors)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            if len(vectors[i]) == len(vectors[j]) and vectors[i] @ vectors[j] >= similarity:
                links[i] += 1
                links[j] += 1
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return sorted((i, links[i], root(i), root(i) == i) for i in up)


def got(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def groups(n, seed=1, dims=16, spread=0.06):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 12 + 1, dims))
    rows = []
    for i in range(n):
        x = centres[i // 12] + spread * rng.normal(size=dims) * (i % 5)
        rows.append((i, [float(v) for v in x.astype(np.float32)], 0, "n"))
    return rows


@pytest.mark.parametrize("block", [None, 37])
def test_matches_brute_force(spark, block):
    rows = groups(300)
    assert got(E.components(table(spark, rows), rows=block)) == brute(rows)


def test_double_vectors_and_hot_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 1.0, -2.0], 0, "n") for i in range(90)]
    assert got(E.components(table(spark, rows, T.DoubleType()), rows=16)) == brute(rows, kind=np.float64)


def test_vectors_that_cannot_link(spark):
    rows = [(1, None, 0, "n"), (2, [], 0, "n"), (3, [0.0, 0.0], 0, "n"), (4, [1.0, None], 0, "n"),
            (5, [float("nan"), 1.0], 0, "n"), (6, [float("inf"), 1.0], 0, "n"), (7, [1.0, 1.0], 0, "n"),
            (8, [2.0, 2.0], 0, "n"), (9, [1.0, 1.0, 0.0], 0, "n"), (10, [1e-30, 1e-30], 0, "n"), (11, [3e38, 3e38], 0, "n")]
    assert got(E.components(table(spark, rows))) == brute(rows)


def test_rare_lengths_in_many_blocks(spark):
    """Some blocks hold linked vectors of a rare length, others none."""
    rows = groups(120) + [(1000 + i, [1.0, 1.0 + i / 100, 1.0][:2 + i % 2], 0, "n") for i in range(16)]
    assert got(E.components(table(spark, rows), rows=12)) == brute(rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    out = E.components(table(spark, [(None, [1.0, 0.0], 0, "n"), (None, [1.0, 0.01], 0, "n"), (3, [0.0, 1.0], 0, "n"),
                                     (3, [0.0, 1.0], 0, "n")])).collect()
    assert len(out) == 4 and all(r.n_links == 1 for r in out)
    assert {r.component_id for r in out} == {None, 3}
    assert E.components(table(spark, [])).collect() == []


def test_bounds_never_miss():
    rng = np.random.default_rng(3)
    x = E.units([r.astype("<f4").tobytes() for r in rng.normal(size=(200, 24))], "<f4")
    y = x + rng.normal(size=x.shape) * 0.05
    y /= np.linalg.norm(y, axis=1)[:, None]
    for least in (0.5, 0.9, 0.97):
        row, col = E.possible(E.quantise(x), E.quantise(y), least)
        need = set(zip(*np.nonzero(x @ y.T >= least), strict=True))
        assert need <= set(zip(row.tolist(), col.tolist(), strict=True))
