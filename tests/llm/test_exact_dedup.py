import hashlib

import pytest

from demandkit.llm import exact_dedup as X


def brute(rows):
    low = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
    groups = {}
    for r in rows:
        groups.setdefault(low(r[1]), []).append(r[0])
    return sorted((r[0], max(groups[low(r[1])]), len(groups[low(r[1])]), r[0] == max(groups[low(r[1])]),
                   hashlib.sha256(low(r[1])).hexdigest()) for r in rows)


def got(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_matches_brute_force(make_docs, fixture_rows):
    assert got(X.groups(make_docs(fixture_rows, parts=5))) == brute(fixture_rows)


def test_spilling_gives_the_same(make_docs, fixture_rows):
    assert got(X.groups(make_docs(fixture_rows), table_bytes=3_000)) == brute(fixture_rows)


def test_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, "Abc"), (4, "aBC"), (5, "É"), (6, "é"), (7, "x" * 300_000), (8, "X" * 300_000)]
    assert got(X.groups(make_docs(rows, extra=True))) == brute(rows)


def test_repeated_rows_and_null_ids_keep_one(make_docs):
    out = X.groups(make_docs([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")])).collect()
    assert sorted((r.text_sha256, r.kept) for r in out if r.kept).__len__() == 2
    assert {r.group_size for r in out} == {3, 2}
    assert {r.keep_id for r in out} == {1, None}


def test_empty_table(make_docs):
    assert X.groups(make_docs([])).collect() == []
    assert X.deduplicate(make_docs([])).collect() == []


def test_hot_group_over_many_tasks(make_docs):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(300)]
    assert got(X.groups(make_docs(rows, parts=12))) == brute(rows)


@pytest.mark.parametrize("table_bytes", [X.TABLE_BYTES, 2_000])
def test_deduplicate_keeps_whole_rows(make_docs, fixture_rows, table_bytes):
    docs = make_docs([*fixture_rows, (None, "only here"), (None, None)], extra=True)
    kept = X.deduplicate(docs, table_bytes)
    assert kept.schema.names == docs.schema.names
    want = {r[0] for r in brute(fixture_rows) if r[3]}
    rows = kept.collect()
    assert {r.doc_id for r in rows if r.doc_id is not None} == want
    text = {r[0]: r[1] for r in fixture_rows}
    assert all(r.text == text[r.doc_id] and r.hash == "x-hash" for r in rows if r.doc_id is not None)
    assert [r.text for r in rows if r.doc_id is None].count("only here") == 1


def test_grace_recursion_and_collisions():
    records = [(7, b"a%d" % (i % 40), (i, i)) for i in range(400)] + [(i << 40, b"b%d" % i, (i, i)) for i in range(100)]
    found = {c: sorted(v) for c, v in X.grace(iter(records), limit=500)}
    assert len(found) == 140 and found[b"a3"] == sorted((i, i) for i in range(3, 400, 40))
    best = dict(X.grace(iter(records), limit=500, largest=True))
    assert best[b"a3"] == [(363, 363)]
