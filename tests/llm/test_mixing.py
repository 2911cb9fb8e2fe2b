import numpy as np
import pytest

from demandkit.llm import mixing as X


def targets(sizes):
    """Targets by repeated resharing, in order of the sources (None last)."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped, out = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        out = {s: 3 * sizes[s] if s in capped else rest * weight[s] / share for s in names}
        more = {s for s in names if s not in capped and out[s] > 3 * sizes[s]}
        if not more:
            return out
        capped |= more


def check(rows, got, slack=1):
    sizes, taken, largest = {}, {}, {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    by_id = {r[0]: r for r in rows}
    for r in got:
        s = by_id[r.doc_id][2]
        assert r.size == len((by_id[r.doc_id][1] or "").encode().split())
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        largest[s] = max(largest.get(s, 0), r.size)
    want = targets(sizes)
    for r in got:
        s = by_id[r.doc_id][2]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack * largest[s]


def test_targets_are_met_and_reruns_agree(make_docs, fixture_rows):
    docs = make_docs(fixture_rows, extra=True)
    got = X.copies(docs).collect()
    assert len(got) == len(fixture_rows)
    check(fixture_rows, got)
    again = X.copies(make_docs(fixture_rows, parts=7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


@pytest.mark.parametrize("leaf_rows", [4096, 40])
def test_sources_with_long_documents_come_near_their_targets(spark, make_docs, leaf_rows):
    """A few texts of half a source's words and many short ones: every source is within 2 % of its target or
    the size of a short document."""
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(20, 60)), f"s{i % 3}") for i in range(300)] + [
        (1000 + i, "w " * int(rng.integers(1500, 2500)), f"s{i % 3}") for i in range(6)] + [(None, "n " * 30, "s1")] * 9
    taken, want, size = {}, {}, {}
    for r in X.copies(make_docs(rows), leaf_rows=leaf_rows).collect():
        s = (r.source_size, r.target)
        taken[s], want[s] = taken.get(s, 0) + r.taken, r.target
    assert len(want) == 3
    # Leaves of 40 rows hold fewer words than one long text: what is left is half of one at most.
    assert all(abs(taken[s] - want[s]) <= (max(0.02 * want[s], 60) if leaf_rows > 100 else 1250) for s in want)


def test_settling_a_leaf_keeps_words_and_expectation():
    rng = np.random.default_rng(6)
    sizes = sorted(rng.integers(1, 50, 25).tolist(), reverse=True) + [0]
    mean = np.zeros(26)
    for _ in range(3000):
        out = X.settle(sizes, 0.3, rng.random(26).tolist())
        assert sum(0 < x < 1 for x, n in zip(out, sizes, strict=True) if n) <= 1
        assert np.dot(sizes, out) == pytest.approx(0.3 * sum(sizes))
        mean += out
    assert np.abs(mean[:20] / 3000 - 0.3).max() < 0.05  # the last few must fit what is left
    for f in (0.1, 0.5, 0.9):  # a document larger than all others together
        assert np.dot([1000, 3, 2, 1], X.settle([1000, 3, 2, 1], f, [0.5] * 4)) == pytest.approx(f * 1006)


def test_reduction_tree_of_many_leaves(make_docs):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 60)), f"s{i % 4 if i % 3 else 0}") for i in range(600)]
    check(rows, X.copies(make_docs(rows), leaf_rows=16, fan=3).collect())


def test_small_sources_stop_at_three_times_their_size(make_docs):
    rows = [(i, "a b c d", "a" if i < 2 else "b") for i in range(40)] + [(100, "x y", None), (101, None, "c"), (102, "", "d")]
    got = X.copies(make_docs(rows)).collect()
    check(rows, got)
    assert {r.taken for r in got if r.doc_id < 2} == {12}
    assert [r.taken for r in got if r.doc_id > 100] == [0, 0]


def test_empty_table_null_ids_and_repeated_rows(make_docs):
    assert X.copies(make_docs([])).collect() == []
    assert X.mix(make_docs([])).collect() == []
    rows = [(None, "a b"), (None, "c d"), (1, "e f"), (1, "e f")]
    assert len(X.copies(make_docs(rows)).collect()) == 4


def test_mix_repeats_whole_rows(make_docs, fixture_rows):
    docs = make_docs(fixture_rows, extra=True)
    want = {r.doc_id: r.copies for r in X.copies(docs).collect()}
    mixed = X.mix(docs)
    assert mixed.columns == docs.columns
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_pivot_keeps_the_words_and_the_expectation():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 50, 30).tolist()
    fractions = rng.random(30).tolist()
    mean = np.zeros(30)
    for _ in range(2000):
        out, left = X.pivot(sizes, fractions, rng.random(30).tolist())
        assert sum(0 < x < 1 for x in out) <= 1
        assert np.dot(sizes, out) == pytest.approx(np.dot(sizes, fractions))
        mean += out
    assert np.abs(mean / 2000 - fractions).max() < 0.06
