import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from demandkit.llm import byte_bpe as B
from demandkit.llm.queries import tokenizer

PATH, PATTERN = tokenizer()
ENTRIES = B.read_ranks(PATH)
VOCABULARY = B.Vocabulary(ENTRIES, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={e: i for i, e in enumerate(ENTRIES)}, special_tokens={})


def ids(text):
    return np.frombuffer(VOCABULARY.encode(text), "<u4").tolist()


def test_round_trip_matches_the_library(make_docs, fixture_rows):
    rows = [*fixture_rows, (-1, None), (-2, ""), (-3, "<|endoftext|> it's  we'LL\n\n \t x"), (-4, "ab" * 100_000)]
    for r in B.round_trip(make_docs(rows, extra=True), PATH, PATTERN).collect():
        text = next(x[1] for x in rows if x[0] == r.doc_id) or ""
        want = LIBRARY.encode_ordinary(text)
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_then_decode(make_docs):
    rows = [(1, "Hello, wörld!"), (2, None), (2, None), (None, "x")]
    encoded = B.encode(make_docs(rows), PATH, PATTERN)
    back = sorted((bytes(r.text), r.doc_id) for r in B.decode(encoded, PATH).collect()
                  if r.text is not None)
    assert [b.decode() for b, _ in back] == ["", "", "Hello, wörld!", "x"]
    assert B.round_trip(make_docs([]), PATH, PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r'.,!stdlmvre019aAéß  \x85\x1c"),
                                  st.characters(codec="utf-8", max_codepoint=0x2FFF, categories=["L", "N", "P", "S", "Z"])), max_size=40))
def test_any_text_matches_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


def test_perfect_hash_is_minimal_and_rejects_others():
    keys = ENTRIES[:5000]
    table = B.PerfectHash(keys)
    assert sorted(table.rank) == list(range(5000))
    assert all(table.get(k) == i for i, k in enumerate(keys))
    assert all(table.get(k + b"\xff\xfe") == -1 for k in keys[:500])


def test_heap_merge_equals_the_library_piece_by_piece():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 40, 300):
        piece = "".join(rng.choice(list("aeinrst"), n))
        assert VOCABULARY.merge(piece.encode()) == LIBRARY.encode_ordinary(piece) or n < 2


def test_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(B, "CACHE_RUNS", 5)
    text = " ".join(f"word{i}" for i in range(50))
    assert ids(text) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 2000, " " * 999 + "x", "\n" * 50, "☃" * 300])
def test_long_runs(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
