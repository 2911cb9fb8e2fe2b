import hashlib

import numpy as np
import pytest

from demandkit.llm import suffix_dedup as S


def brute(rows, length=100):
    seen, out = set(), []
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(raw[s:s + length])
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def want(fixture_rows):
    return brute(fixture_rows)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 5_000}, {"hot": 2}])
def test_matches_brute_force(make_docs, fixture_rows, want, options):
    assert got(S.remove_repeats(make_docs(fixture_rows), **options)) == want


def test_edge_cases(make_docs):
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdé "), 400))
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 100), (5, "a" * 1000), (6, "ab" * 300), (7, text),
            (8, "x" + text[50:350] + "y" + text[:120]), (9, text), (10, "\n" * 250 + "\0" * 250), (11, "\0" * 120)]
    assert got(S.remove_repeats(make_docs(rows, extra=True))) == brute(rows)


def test_long_text_is_read_in_pieces(make_docs, monkeypatch):
    rng = np.random.default_rng(6)
    part = "".join(rng.choice(list("abcdefgh"), 3000))
    rows = [(1, part + "z" + part[500:2500]), (2, "q" + part)]
    monkeypatch.setattr(S, "PIECE_BYTES", 700)
    pieces = list(S._pieces(iter([_batch(rows)]), 100))
    assert len(pieces) > 5
    assert got(S.remove_repeats(make_docs(rows))) == brute(rows)


def _batch(rows):
    import pyarrow as pa
    return pa.RecordBatch.from_pydict({"doc": [r[0] for r in rows], "text": [r[1].encode() for r in rows]})


def test_repeated_and_null_ids(make_docs):
    rng = np.random.default_rng(7)
    a, b = ("".join(rng.choice(list("abcdefgh"), 300)) for _ in range(2))
    out = S.remove_repeats(make_docs([(1, a), (1, a), (1, b + a), (None, a + "x"), (2, b)])).collect()
    by = {}
    for r in out:
        by.setdefault((r.doc_id, r.n_bytes), []).append(r.n_removed)
    assert by[(1, 300)][0] == by[(1, 300)][1]  # one document with a row each
    assert by[(2, 300)] == [300] and by[(None, 301)] == [300]
    assert by[(1, 300)][0] + by[(1, 600)][0] == 300


def test_empty_table(make_docs):
    assert S.remove_repeats(make_docs([])).collect() == []


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(8)
    for text in (b"banana$", b"a" * 50, bytes(rng.integers(97, 100, 500).astype(np.uint8)), b"\0\0\0", b"ab" * 40 + b"\n"):
        buffer = np.frombuffer(text, np.uint8)
        order = S.suffix_array(buffer)
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        common = S.kasai(buffer, order, 30, chain=8).tolist()
        for k in range(1, len(want)):
            a, b = text[want[k - 1]:], text[want[k]:]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[k] == min(30, n)


def test_shards_of_other_fingerprints_are_not_compared(monkeypatch):
    """Windows of different fingerprints differ: a task of many shards takes time by its bytes, not by their square."""
    import pyarrow as pa
    rng = np.random.default_rng(9)
    parts = [rng.integers(97, 123, 300, dtype=np.uint8).tobytes() for _ in range(40)]
    rows = [(key, doc, 1000 * key, part) for key, part in enumerate(parts[:39]) for doc in (1, 2)]
    rows += [(39, doc, 39_000, parts[39][doc % 5:]) for doc in range(30)]  # one of several shards

    def run(shard_bytes):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 3 + [pa.binary()])],
                                              names=["key", "doc", "start", "text"])]
        found = [x for b in S._compare_shards(100, shard_bytes)(batches) for x in zip(*(c.to_pylist() for c in b.columns))]
        return S.stretches(*(np.array(c, np.int64) for c in zip(*found)))

    one, met, real = run(1 << 20), [], S.Shard.merge
    monkeypatch.setattr(S.Shard, "merge", lambda self, earlier: met.append(len(earlier)) or real(self, earlier))
    many = run(1_000)
    assert all(np.array_equal(a, b) for a, b in zip(one, many, strict=True)) and len(one[0]) >= 39
    assert len(met) > 20 and not any(met[:18]) and max(met[-5:]) > 1


def test_common_prefixes_end_with_the_text():
    rng = np.random.default_rng(10)
    for raw in (b"\0" * 50, b"ab" * 90 + b"\0" * 9, rng.integers(0, 3, 3000, dtype=np.uint8).tobytes(), b"x"):
        order = S.suffix_array(np.frombuffer(raw, np.uint8))
        assert list(order) == sorted(range(len(raw)), key=lambda i: raw[i:])
        want = [0]
        for i, j in zip(order, order[1:]):
            k = 0
            while k < 40 and max(i, j) + k < len(raw) and raw[i + k] == raw[j + k]:
                k += 1
            want.append(k)
        assert list(S.kasai(np.frombuffer(raw, np.uint8), order, 40)) == want
