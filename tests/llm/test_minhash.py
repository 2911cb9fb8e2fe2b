import collections
import re

import numpy as np
import pytest

from demandkit.llm import minhash as M


def brute(rows, width=3, percent=85):
    sets = []
    for doc_id, text, *_ in rows:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0d]+", raw)
        sets.append((doc_id, {tuple(w[k:k + width]) for k in range(len(w) - width + 1)}
                     if len(w) >= width else {tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = collections.defaultdict(list)
    for k, (_, s) in enumerate(sets):
        shared = collections.Counter(j for x in s for j in where[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = root(j), root(k)
                up[max(a, b)] = min(a, b)
        for x in s:
            where[x].append(k)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, len(s), least[root(k)], least[root(k)] == i) for k, (i, s) in enumerate(sets))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def near_copies(n, seed=3, words=120):
    """A group of copies with few changed words each, and unrelated texts."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 5000, words)]
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.integers(0, words, int(rng.integers(0, 5))):
            copy[at] = f"v{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(copy)))
    return rows + [(n + i, " ".join(f"u{x}" for x in rng.integers(0, 10**9, 50))) for i in range(20)]


def test_matches_brute_force(make_docs, fixture_rows):
    assert got(M.components(make_docs(fixture_rows), 3, 0.85)) == brute(fixture_rows)


@pytest.mark.parametrize("block", [4096, 7])
def test_one_large_group_whole_and_in_blocks(make_docs, block):
    rows = near_copies(60)
    assert got(M.components(make_docs(rows), 3, 0.85, block)) == brute(rows)


def test_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É one two"), (8, "é one two"),
            (9, "a b c " * 20_000), (10, "c a b " * 20_000), (11, "x\x1cy z w")]
    assert got(M.components(make_docs(rows, extra=True), 3, 0.85)) == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(make_docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "q r s t"), (None, "q r s t")]
    out = M.components(make_docs(rows), 3, 0.85).collect()
    assert len(out) == 5
    assert [r.component_id for r in out if r.n_shingles and r.doc_id == 1] == [1, 1]
    nameless = [(r.component_id, r.kept) for r in out if r.doc_id is None]
    assert sorted(nameless, key=str) == sorted([(1, False), (None, True), (None, True)], key=str)
    assert M.components(make_docs([]), 3, 0.85).collect() == []


def test_deduplicate_keeps_one_of_each_group(make_docs):
    rows = near_copies(30)
    docs = make_docs(rows, extra=True)
    kept = M.deduplicate(docs, width=5, similarity=0.8)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(rows, 5, 80) if r[3]]


def test_estimate_is_near_the_true_similarity():
    rng = np.random.default_rng(1)
    factors = M._multipliers(384)
    both, one, two = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    bits = [np.frombuffer(M.pack(M.minima(np.concatenate([both, x]), factors)), np.uint8) for x in (one, two)]
    assert abs(M.estimate(bits[0], bits[1][None, :], 384)[0] - 0.8) < 0.12


def test_bands_miss_few_pairs_at_the_threshold():
    for similarity in (0.8, 0.85, 0.95):
        assert (1 - similarity ** M.rows_per_band(similarity)) ** M.BANDS <= M.MISS


def tied(rows, width=3, percent=85):
    """Brute force where rows of one doc_id are one vertex."""
    out = brute([(k, t) for k, (_, t, *_) in enumerate(rows)], width, percent)
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for k, _, c, _ in out:
        for a, b in ((("row", k), ("row", c)), (("row", k), ("id", rows[k][0]))):
            up[root(a)] = root(b)
    least = {}
    for i, *_ in rows:
        least[root(("id", i))] = min(least.get(root(("id", i)), i), i)
    return sorted((rows[k][0], n, least[root(("id", rows[k][0]))], least[root(("id", rows[k][0]))] == rows[k][0]) for k, n, _, _ in out)


@pytest.mark.parametrize("block", [4096, 5])
def test_a_doc_id_on_rows_of_different_texts_ties_their_groups(make_docs, block):
    groups = [[" ".join([f"g{g}w{x}" for x in range(80)] + [f"g{g}end{k}"]) for k in range(4)] for g in range(4)]
    rows = [(5, groups[0][0]), (7, groups[0][1]), (5, groups[1][0]), (3, groups[1][1]), (7, groups[2][0]), (20, groups[2][1]),
            (20, groups[2][2]), (30, groups[3][0]), (31, groups[3][1]), (31, "apart from all others here"), (9, None), (9, "alone again naturally so")]
    assert got(M.components(make_docs(rows), 3, 0.85, block)) == tied(rows)
    assert {r[2] for r in tied(rows)} == {3, 30, 9}


def test_near_copies_without_an_id_leave_one(make_docs):
    near, other = ([" ".join([f"g{g}w{x}" for x in range(80)] + [f"g{g}end{k}"]) for k in range(3)] for g in range(2))
    rows = [(None, near[0]), (None, near[1]), (None, near[2]), (None, near[2]), (None, other[0]), (4, other[1]), (None, None), (None, "")]
    kept = M.deduplicate(make_docs(rows, extra=True), 3, 0.85).collect()
    assert len(kept) == 4 and kept[0].key == "x-key"
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [4]
    assert sum(r.text in near for r in kept) == 1 and sum(not r.text for r in kept) == 2


def test_a_block_of_near_copies_takes_little_memory():
    import tracemalloc
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 120).astype(np.uint64)
    factors = M._multipliers(M.BANDS * M.rows_per_band(0.85))
    sets = [np.unique(np.concatenate([base, rng.integers(0, 1 << 62, 4).astype(np.uint64)])) for _ in range(M.BLOCK)]
    bits = np.array([np.frombuffer(M.pack(M.minima(s, factors)), np.uint8) for s in sets])
    tracemalloc.start()
    links, _ = M.link_group(sets, bits, [-1] * len(sets), 85, len(factors))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(links) == len(sets) - 1 and peak < 100 << 20
