import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from demandkit.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIB_A = Tokenizer.from_file(A)
LIB_A.encode_special_tokens = True
LIB_B = sentencepiece.SentencePieceProcessor(model_file=B)
TOOLS = T.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())


def library(text):
    """Ids and byte ends of both tokenizers over the whole text, by the libraries."""
    if not text:
        return None
    raw = (" " + text).encode()
    a = LIB_A.encode(" " + text, add_special_tokens=False).ids
    b = LIB_B.encode(text)
    bytes_a = [TOOLS.a_bytes[i] for i in a]
    bytes_b = [TOOLS.b_bytes[i] for i in b]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    return a, b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()


def brute(rows):
    """Every overlap, found by comparing byte ranges; groups by common ends."""
    links, groups, sizes = [], [], []
    for _, text in rows:
        found = library(text)
        links.append([])
        groups.append("")
        sizes.append((0, 0, 0))
        if not found:
            continue
        a, b, ends_a, ends_b = found
        common = sorted(set(ends_a) & set(ends_b))
        parts, low_a, low_b = [], 0, 0
        for end in common:
            x, y = ends_a.index(end, low_a) + 1, ends_b.index(end, low_b) + 1
            parts.append(",".join(map(str, a[low_a:x])) + "|" + ",".join(map(str, b[low_b:y])))
            for i in range(low_a, x):
                for j in range(low_b, y):
                    from_a, from_b = ([0] + ends_a)[i], ([0] + ends_b)[j]
                    if max(from_a, from_b) < min(ends_a[i], ends_b[j]):
                        links[-1].append((a[i], b[j]))
            low_a, low_b = x, y
        groups[-1] = hashlib.sha256(";".join(parts).encode()).hexdigest()
        sizes[-1] = (len(a), len(b), len(parts))
    count = Counter(x for d in links for x in d)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return sorted((str(doc_id), *size, len(d), sum(count[x] == top[x[1]] for x in d), sum(count[x] for x in d), g)
                  for (doc_id, _), size, d, g in zip(rows, sizes, links, groups, strict=True))


def result(df):
    assert df.columns == [x.split(" ")[0] for x in T._RESULT.split(", ")]
    return sorted((str(r.doc_id), *r[1:]) for r in df.collect())


EDGES = [None, "", " ", "  two  spaces ", "<|endoftext|> and <s> <unk>", "a▁b ▁c", "tab\tand\nline\r\n end ", "é ü ñ ñ 中文 emoji 😀",
         "nul \x00 byte", "x" * 3000, "ab " * 4000, " non breaking", "don't we'll 123 4567!", "　wide"]


def test_whole_table_against_brute_force(make_docs, fixture_rows):
    rows = [(r[0], r[1]) for r in fixture_rows] + [(10_000 + i, t) for i, t in enumerate(EDGES)]
    rows += [(7, "a repeated row"), (7, "a repeated row"), (None, "no id"), (None, None)]
    docs = make_docs(rows, extra=True)
    want = brute(rows)
    assert result(T.align(docs, A, B)) == want
    assert result(T.align(docs, A, B, links=500)) == want  # many blocks, the same result


def test_pieces_of_a_long_text_align_like_the_whole(monkeypatch, make_docs, fixture_rows):
    long = " ".join(r[1] for r in fixture_rows if r[1])[:300_000]
    monkeypatch.setattr(T, "PIECE", 5000)
    found = T.align_text(TOOLS, long)
    a, b, _, _ = library(long)
    assert (found.n_a, found.n_b) == (len(a), len(b)) and len(found.pairs) > 50
    assert brute([(1, long[:60_000])])[0][-1] == T.align_text(TOOLS, long[:60_000]).digest.hexdigest()


def test_empty_and_tokenless_tables(make_docs):
    assert T.align(make_docs([]), A, B).collect() == []
    assert result(T.align(make_docs([(1, None), (2, "")]), A, B)) == [("1", 0, 0, 0, 0, 0, 0, ""), ("2", 0, 0, 0, 0, 0, 0, "")]


TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,!stdlre019aAéß \x85\x1c▁<>|́"), st.characters(codec="utf-8")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_words_apart_are_the_library_on_the_whole(text):
    found, want = T.align_text(TOOLS, text), library(text)
    assert (found is None) == (want is None)
    if found:
        assert (found.n_a, found.n_b) == (len(want[0]), len(want[1]))
        assert found.n_links == len(set(want[2]) | set(want[3]))
        assert found.digest.hexdigest() == brute([(1, text)])[0][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=30), st.lists(st.integers(1, 60), max_size=30))
def test_runs_cover_all_common_ends(x, y):
    last = max(x + y, default=0) + 1
    a, b = sorted({*x, last}), sorted({*y, last})
    stretches, odd = T.diagonal_runs(a, b)
    starts = sorted([(i + k, j + k) for i, j, n in stretches for k in range(n)] + odd)
    ends = [*starts[1:], (len(a), len(b))]
    assert [a[i - 1] for i, _ in ends] == [b[j - 1] for _, j in ends] == sorted(set(a) & set(b))
    links = list(zip(*(x.tolist() for x in T.overlaps(a, b, *np.array(starts).T)), strict=True))
    assert sorted(links) == [(i, j) for i in range(len(a)) for j in range(len(b))
                             if max(([0] + a)[i], ([0] + b)[j]) < min(a[i], b[j])]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000])
def test_one_to_one_stretches_are_jumped(n):
    ends = list(range(1, n + 1))
    assert T.diagonal_runs(ends, ends) == ([(0, 0, n)], [])


def test_rank_tokenizer_gives_the_ids_of_the_file(spark, fixture_rows):
    """Words, entries side by side, and random letters: the ids are those of A's own library."""
    assert TOOLS.ranked and TOOLS.separable
    rng = np.random.default_rng(4)
    words = sorted({w for _, text, *_ in fixture_rows for w in (text or "").split(" ") if w})
    names = [e.decode("utf-8", "ignore") for e in TOOLS.a_bytes]
    words += [names[x] + names[y] for x, y in rng.integers(0, len(names), (40_000, 2))]
    words += ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz ABé'.,01"), int(n))) for n in rng.integers(1, 16, 20_000)]
    words = [" " + w for w in words]
    want = [x.ids for x in LIB_A.encode_batch_fast(words, add_special_tokens=False)]
    assert [TOOLS.ranked.encode_ordinary(w) for w in words] == want


def test_new_words_of_a_text_take_one_call_and_are_parted_again():
    tools = T.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())
    calls = []

    class Counted:
        def encode_ordinary(self, text, real=tools.ranked):
            calls.append(text)
            return real.encode_ordinary(text)

    tools.ranked = Counted()
    words = ["(edge", "plain", "naïve", "word's", "ﬁgures", "tab\tinside", "日本語", "x" * 300, "1234567", "plain", "last\n\n "]
    a, b, whole = tools.encode(words)
    assert len(calls) == 3  # the words between two cuts at once, the first and the last one by one
    for numbers in (words, words[::-1], ["ﬁgures", "  ", ""]):
        tools.forget()
        got = tools.encode(numbers)
        one_a = [tools.a.encode(" " + w, add_special_tokens=False).ids for w in numbers]
        one_b = [tools.b.encode(w) for w in numbers]
        assert got[0].tolist() == sum(one_a, []) and got[1].tolist() == sum(one_b, [])
        raw = (" " + " ".join(numbers)).encode()
        assert got[2] == (raw == b"".join(tools.a_bytes[i] for i in got[0]) == b"".join(tools.b_bytes[i] for i in got[1]))
        for w, x, y in zip(numbers, one_a, one_b):
            good = b"".join(tools.a_bytes[i] for i in x) == b" " + w.encode() == b"".join(tools.b_bytes[i] for i in y)
            assert tools.good[tools.memory[w]] == good


def test_new_words_of_several_texts_are_aligned_once_side_by_side(monkeypatch, fixture_rows):
    """Words that one tokenizer doesn't spell stand between the others."""
    tools = T.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())
    calls, real = [], T.diagonal_runs
    monkeypatch.setattr(T, "diagonal_runs", lambda a, b: calls.append(len(a)) or real(a, b))
    texts = [r[1] for r in fixture_rows[:40]] + ["fine words a▁b and more", None, "", "fine words", "a▁b", "(edge) naïve　"]
    for _ in range(2):  # the second time all words are known
        found = list(T.align_texts(tools, texts))
        assert len(calls) == 1
        for text, got in zip(texts, found, strict=True):
            want = brute([(1, text)])[0]
            assert (got is None) == (want[-1] == "")
            if got:
                pairs, links = got.counted()
                assert ("1", got.n_a, got.n_b, got.n_groups, got.n_links) == want[:5] and got.digest.hexdigest() == want[-1]
                assert links.sum() == got.n_links and (pairs[links == links.max()] >= 0).all()
    assert found[40] is found[44] is None and found[43]
