"""Alignment of two tokenizers over the same texts, by diagonal run skipping.

Every text is tokenised by a byte-level BPE (A) and by a piece model with byte
fallback (B). The byte offsets at which tokens end are two ascending arrays. As
long as both step through the text together, their ends agree at one shift
between the indexes: exponential probing compares blocks of 1, 2, 4, ... ends at
that shift, then halves the last block, and so jumps a stretch of one-to-one groups
at once. Where they part, the irregular group is walked token by token up to the
next common end; the shift is then what the group made of it.

Links are the pairs of an A and a B token whose bytes overlap. They are counted
by pair of ids over the whole corpus, and every document is told how many of its
links are the most frequent of their B id, and the sum of its links' counts.

Spark's part. Tasks tokenise and align their documents and gather them into blocks
of some million links with a dictionary of the id pairs that occur (one Parquet
table). The dictionaries alone are summed by pair; the highest count of each B id
is a table no longer than B's vocabulary (broadcast). Each block asks for the counts
of its dictionary by a join on the pair, in which a frequent pair has one row a
block, and meets the answers in a cogroup; no link is ever shuffled by itself.

Texts are cut at a single space between a character that is no white space and
a letter or digit: no token of A or B crosses it (checked on the files; without that
property texts stay whole), so distinct words are tokenised once per task and a very
long text is aligned piece by piece, in bounded memory. Where both tokenizers spell a word, both end
with it, and no group or link crosses it: the new words of a text are aligned side by side, and a task remembers
the groups and links of each.

Defined cases: a text that is null or empty, or whose tokens' bytes aren't those of
a space and the text, has no tokens: numbers 0 and an empty ``groups_sha256``.
Special tokens' strings are plain text. Rows equal in doc_id or text count as
often as they occur; a null doc_id stays null; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_arrow, passes, ship_code, write_table

#: A block of documents ends with the document that reaches so many links.
BLOCK_LINKS = 8_000_000
#: Characters of a text aligned at once (a piece goes on to the next cut).
PIECE = 1 << 18
#: Remembered words of a task and their ids; when full, the memory starts anew.
CACHE_WORDS, CACHE_IDS = 500_000, 20_000_000

#: The byte that B's models write for a space (fixed value).
SPACE = "▁"
CUT = re.compile(rf"(?<=[^\s{SPACE}]) (?=\w)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable
    bytes of Latin-1 stand for themselves, the others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for c, b in [*zip(plain, plain), *((256 + i, b) for i, b in enumerate(rest))]}


class Tokenizers:
    """Both tokenizers of a Python worker, the bytes of their entries, and a
    memory of words."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else
                        p.replace(SPACE, " ").encode() for p in pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in e], np.int64) for e in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = _numerals(len(entries)), _numerals(len(pieces))
        spec = json.loads(a_json)
        splits = spec.get("pre_tokenizer") or {}
        self.ranked = self._ranked(spec["model"])
        self.separable = (splits.get("type") == "ByteLevel" and splits.get("use_regex", True)
                          and not splits.get("add_prefix_space") and not spec.get("normalizer")
                          and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces))
        self.forget()

    def _ranked(self, model: dict):
        """The rank tokenizer of the same vocabulary, which is faster on words, where ids follow
        the order of the merges; None otherwise."""
        import public_tokenizers
        import tiktoken
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
        ids = [model["vocab"].get("".join(p), -1) for p in pairs]
        if not ids or ids != sorted(set(ids)) or model.get("ignore_merges"):
            return None
        entries = {self.a_bytes[i]: i for i in model["vocab"].values()}
        if len(entries) != len(model["vocab"]) or max(i for e, i in entries.items() if len(e) == 1) > min(ids):
            return None
        return tiktoken.Encoding("entries", pat_str=public_tokenizers.PATTERN, mergeable_ranks=entries, special_tokens={})

    def forget(self) -> None:
        """Empty the memory: word -> number; ids and links of all words in a row, with where each begins;
        the numbers of their groups, and these as text."""
        self.memory: dict[str, int] = {}
        self.ids = [_Row(), _Row()]
        self.links = _Row(np.int64)
        self.good, self.n_groups = np.zeros(1024, bool), np.zeros(1024, np.int64)
        self.groups: list[bytes] = []

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Runs of words that both tokenizers can take one by one."""
        if not self.separable:
            yield [text]
            return
        at = 0
        while len(text) - at > PIECE:
            m = CUT.search(text, at + PIECE)
            if not m:
                break
            yield CUT.split(text[at:m.start()])
            at = m.end()
        yield CUT.split(text[at:])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of A and B of the words, each with a space before it, and
        whether both spell the text's bytes."""
        return self.tokens(words, self.numbers(words))

    def tokens(self, words: list[str], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
        """As :meth:`encode`, of words with known numbers."""
        a, b = (row.take(numbers) for row in self.ids)
        if self.good[numbers].all():
            return a, b, True
        raw = (" " + " ".join(words)).encode()
        return a, b, (b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw
                      == b"".join(map(self.b_bytes.__getitem__, b.tolist())))

    def numbers(self, words: list[str], ends: Iterable[str] = ()) -> np.ndarray:
        """Numbers of the words in the memory; new ones are tokenised and aligned first. ``ends``: the
        first and last words of the pieces that ``words`` are from (by default they are of one piece)."""
        if len(self.memory) > CACHE_WORDS or self.ids[0].n + self.ids[1].n + self.links.n > CACHE_IDS:
            self.forget()
        known = self.memory
        numbers = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0).tolist()
        if new:
            fresh = dict.fromkeys([words[i] for i in new])
            # Only the first and the last word of a piece may begin or end in any character.
            edges = [w for w in dict.fromkeys(ends or (words[0], words[-1])) if fresh.pop(w, self) is None]
            fresh = [*fresh, *edges]
            sizes = np.fromiter(map(len, map(str.encode, fresh)), np.int64, len(fresh)) + 1
            a, n_a = self._encode_a(fresh, len(fresh) - len(edges), sizes)
            b, n_b = _flat(self.b.encode(fresh, num_threads=1))
            at = len(known)
            known.update(zip(fresh, range(at, at + len(fresh))))
            self.ids[0].extend(a, n_a)
            self.ids[1].extend(b, n_b)
            if len(known) > len(self.good):
                self.good, self.n_groups = (np.concatenate([x, np.zeros(len(known), x.dtype)]) for x in (self.good, self.n_groups))
            good = self.good[at:at + len(fresh)] = self._spelled(fresh, sizes, a, n_a, b, n_b)
            pairs, n_links, self.n_groups[at:at + len(fresh)], texts = align_words(self, good, a, n_a, b, n_b)
            self.links.extend(pairs, n_links)
            self.groups += texts
            numbers[new] = [known[words[i]] for i in new]
        return numbers

    def _encode_a(self, words: list[str], inner: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of words with a space before each, in a row, and how many each has. The
        first ``inner`` words stood between two cuts, and so do they side by side: the rank
        tokenizer takes them at once, and the ends of its tokens part them again."""
        if not self.ranked or not self.separable:
            return _flat([x.ids for x in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)])
        ids, counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if inner:
            ids = np.array(self.ranked.encode_ordinary(" " + " ".join(words[:inner])), np.int32)
            ends, wanted = np.cumsum(self.a_size[ids]), np.cumsum(sizes[:inner])
            last = np.searchsorted(ends, wanted)
            if ends[-1] != wanted[-1] or (ends[last] != wanted).any():  # a token across a cut: one by one
                ids, inner = ids[:0], 0
            else:
                counts = np.diff(last, prepend=-1)
        more, n = _flat([self.ranked.encode_ordinary(" " + w) for w in words[inner:]])
        return np.concatenate([ids, more]), np.concatenate([counts, n])

    def _spelled(self, words: list[str], sizes: np.ndarray, *tokens: np.ndarray) -> np.ndarray:
        """Whether both tokenizers spell each word with a space before it: all words of the right length at
        once, and one by one where some differ. ``tokens``: ids and numbers of ids a word, of A and of B."""
        good = np.ones(len(words), bool)
        for ids, counts, spell, size in ((*tokens[:2], self.a_bytes, self.a_size), (*tokens[2:], self.b_bytes, self.b_size)):
            last, flat = np.cumsum(counts), ids.tolist()
            fits = np.diff(np.append(0, np.cumsum(size[ids]))[last], prepend=0) == sizes
            kept, of_kept = (words, flat) if fits.all() else (compress(words, fits), ids[np.repeat(fits, counts)].tolist())
            if b"".join(map(spell.__getitem__, of_kept)) == b"".join([b" " + w.encode() for w in kept]):
                good &= fits
                continue
            good &= np.array([b"".join(map(spell.__getitem__, flat[e - n:e])) == b" " + w.encode()
                              for w, e, n in zip(words, last.tolist(), counts.tolist(), strict=True)], bool)
        return good


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids in a row, and how many each has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum())), counts


class _Row:
    """Lists of ids, one behind the other."""

    def __init__(self, kind=np.int32):
        self.values, self.start, self.n, self.lists = np.zeros(1024, kind), np.zeros(1024, np.int64), 0, 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        more, lists = len(values), len(sizes)
        if self.n + more > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(max(len(self.values), more), self.values.dtype)])
        if self.lists + lists >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros(max(len(self.start), lists + 1), np.int64)])
        self.values[self.n:self.n + more] = values
        self.start[self.lists + 1:self.lists + lists + 1] = self.n + np.cumsum(sizes)
        self.n += more
        self.lists += lists

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.start[numbers + 1] - self.start[numbers]

    def take(self, numbers: np.ndarray) -> np.ndarray:
        """The lists with these numbers, joined."""
        first, sizes = self.start[numbers], self.sizes(numbers)
        end = np.cumsum(sizes)
        return self.values[np.arange(end[-1]) + np.repeat(first - end + sizes, sizes)]


def _numerals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n - 1, each in the low bytes of a 64-bit number, and the
    position in bits of the byte after them."""
    text = b"".join(str(i).encode().ljust(8, b"\0") for i in range(n))
    return np.frombuffer(text, "<u8"), np.array([8 * len(str(i)) for i in range(n)], np.uint64)


def diagonal_runs(a: list[int], b: list[int]) -> tuple[list, list]:
    """Align two ascending arrays of ends whose last ones agree: stretches of
    one-to-one groups as (i, j, length), and where irregular groups begin, as (i, j)."""
    stretches, odd = [], []
    i = j = 0
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            start, k = i, 1
            i += 1
            j += 1
            while i < n and a[i:i + k] == b[j:j + k]:  # probe ever longer blocks at this shift
                i += k
                j += k
                k += k
            if i > n:  # the last block was cut off at the end
                j -= i - n
                i = n
            k //= 2
            while k and i < n:  # the first difference lies in the last block
                if a[i:i + k] == b[j:j + k]:
                    i += k
                    j += k
                k //= 2
            if i > n:
                j -= i - n
                i = n
            stretches.append((start, j - (i - start), i - start))
            if i == n:
                break
            x, y = a[i], b[j]
        odd.append((i, j))
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
    return stretches, odd


def overlaps(a: list[int], b: list[int], first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of A and B that overlap, group by group: where one side has a
    single token it meets all of the other side; else both are walked."""
    n_a, n_b = np.diff(first_a, append=len(a)), np.diff(first_b, append=len(b))
    plain = np.minimum(n_a, n_b) == 1
    size = np.maximum(n_a, n_b)[plain]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    of_a = np.repeat(first_a[plain], size) + inside * np.repeat(n_a[plain] > 1, size)
    of_b = np.repeat(first_b[plain], size) + inside * np.repeat(n_b[plain] > 1, size)
    more_a, more_b = [], []
    for g in np.flatnonzero(~plain).tolist():
        i, j = int(first_a[g]), int(first_b[g])
        while True:
            more_a.append(i)
            more_b.append(j)
            if a[i] < b[j]:
                i += 1
            elif b[j] < a[i]:
                j += 1
            else:
                break
    return np.append(of_a, np.array(more_a, np.int64)), np.append(of_b, np.array(more_b, np.int64))


class Aligned:
    """The aligned pieces of one text: numbers, the digest of its groups, and
    its id pairs with their number of links."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest = hashlib.sha256()
        self.pairs: list[np.ndarray] = []
        self.whole = True

    def add(self, tools: Tokenizers, a: np.ndarray, b: np.ndarray) -> None:
        """A piece by its tokens."""
        first_a, first_b, of_a, of_b = align_tokens(tools, a, b)
        self._more(len(a), len(b), len(first_a), _groups_text(tools, a, b, first_a, first_b), _pairs(tools, a[of_a], b[of_b]))

    def add_words(self, tools: Tokenizers, numbers: np.ndarray) -> None:
        """A piece by the numbers of its words, all of which both tokenizers spell."""
        self._more(*(int(row.sizes(numbers).sum()) for row in tools.ids), int(tools.n_groups[numbers].sum()),
                   b";".join(map(tools.groups.__getitem__, numbers.tolist())), tools.links.take(numbers))

    def _more(self, n_a: int, n_b: int, n_groups: int, text: bytes, pairs: np.ndarray) -> None:
        if self.n_groups:
            self.digest.update(b";")
        self.digest.update(text)
        self.pairs.append(pairs)
        self.n_a += n_a
        self.n_b += n_b
        self.n_groups += n_groups
        self.n_links += len(pairs)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs and their links."""
        if not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.unique(np.concatenate(self.pairs), return_counts=True)


def _columns(rows: list[tuple], width: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(rows), np.int64, len(rows) * width).reshape(-1, width).T


def align_tokens(tools: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where the groups of tokens with the same bytes begin in A and in B, and the indexes of the tokens that overlap."""
    ends_a, ends_b = np.cumsum(tools.a_size[a]).tolist(), np.cumsum(tools.b_size[b]).tolist()
    stretches, odd = diagonal_runs(ends_a, ends_b)
    i, j, n = _columns(stretches, 3)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    odd_a, odd_b = _columns(odd, 2)
    first_a = np.sort(np.concatenate([np.repeat(i, n) + inside, odd_a]))
    first_b = np.sort(np.concatenate([np.repeat(j, n) + inside, odd_b]))
    return first_a, first_b, *overlaps(ends_a, ends_b, first_a, first_b)


def align_words(tools: Tokenizers, good: np.ndarray, a: np.ndarray, n_a: np.ndarray, b: np.ndarray,
                n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Links of the words in a row, and of each word the number of links, the number of groups and the
    groups' text: all ``good`` words are aligned side by side, the others get none."""
    n_links, n_groups, texts = np.zeros(len(good), np.int64), np.zeros(len(good), np.int64), [b""] * len(good)
    if not good.any():
        return np.zeros(0, np.int64), n_links, n_groups, texts
    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
    last_a, last_b = np.cumsum(n_a[good]), np.cumsum(n_b[good])
    first_a, first_b, of_a, of_b = align_tokens(tools, a, b)
    order = np.argsort(of_a, kind="stable")
    n_links[good] = np.diff(np.searchsorted(of_a[order], last_a), prepend=0)
    n_groups[good] = np.diff(np.searchsorted(first_a, last_a), prepend=0)
    each = _groups_text(tools, a, b, first_a, first_b, last_b).split(b"\n")
    if good.all():
        texts = each
    else:
        for i, text in zip(np.flatnonzero(good).tolist(), each, strict=True):
            texts[i] = text
    return _pairs(tools, a[of_a[order]], b[of_b[order]]), n_links, n_groups, texts


def _pairs(tools: Tokenizers, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) * len(tools.b_bytes) + b


def _groups_text(tools: Tokenizers, a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
                 last_b: np.ndarray | None = None) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: of each group the ids of A, then of B. Behind the
    groups that end with the ``last_b`` first tokens of B a line ends."""
    out_a, out_b = np.append(first_a[1:], len(a)), np.append(first_b[1:], len(b))  # ends of the groups
    at_a = np.arange(len(a)) + np.repeat(first_b, out_a - first_a)
    at_b = np.arange(len(b)) + np.repeat(out_a, out_b - first_b)
    text = np.empty(len(a) + len(b), "<u8")
    mark = np.full(len(text), ord(","), np.uint64)
    mark[at_a[out_a - 1]], mark[at_b[out_b - 1]] = ord("|"), ord(";")
    if last_b is not None:
        mark[at_b[last_b - 1]] = ord("\n")
    for at, ids, (digits, after) in ((at_a, a, tools.a_text), (at_b, b, tools.b_text)):
        text[at] = digits[ids] | mark[at] << after[ids]
    return text.tobytes().translate(None, b"\0")[:-1]


def align_texts(tools: Tokenizers, texts: Iterable[str | None]) -> Iterator[Aligned | None]:
    """The alignment of each text; None where it has no tokens. Short texts are taken together up to
    ``PIECE`` characters or so: their new words cost less side by side."""
    held, done, size = [], [], 0
    for text in texts:
        out = Aligned()
        out.whole = bool(text)
        done.append(out)
        for words in tools.pieces(text) if text else ():
            held.append((out, words))
            size += min(len(text), PIECE)
            if size >= PIECE:
                _align_pieces(tools, held)
                held, size = [], 0
                if not out.whole:
                    break
        if not held:
            yield from (x if x.whole else None for x in done)
            done = []
    _align_pieces(tools, held)
    yield from (x if x.whole else None for x in done)


def _align_pieces(tools: Tokenizers, held: list[tuple[Aligned, list[str]]]) -> None:
    if not held:
        return
    every = tools.numbers(list(chain.from_iterable(words for _, words in held)),
                          [w for _, words in held for w in (words[0], words[-1])])
    good, at = tools.good[every], 0
    for out, words in held:
        numbers, spelled = every[at:at + len(words)], good[at:at + len(words)].all()
        at += len(words)
        if spelled and out.whole:
            out.add_words(tools, numbers)
        elif out.whole:
            a, b, out.whole = tools.tokens(words, numbers)
            if out.whole:
                out.add(tools, a, b)


def align_text(tools: Tokenizers, text: str | None) -> Aligned | None:
    """The alignment of a text; None where it has no tokens."""
    return next(align_texts(tools, [text]))


#: A block: its documents' numbers, where each one's entries end in ``entries`` (positions in
#: the block's dictionary ``pairs``, with their links), and links of each pair in the block.
_BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, ends array<long>, entries binary, times binary, pairs array<long>, links array<long>")
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class _Block:
    def __init__(self, number: int):
        self.number, self.docs, self.links = number, [], 0

    def add(self, doc_id, found: Aligned | None) -> None:
        if found is None:
            none = np.zeros(0, np.int64)
            self.docs.append((doc_id, 0, 0, 0, 0, "", none, none))
            return
        self.docs.append((doc_id, found.n_a, found.n_b, found.n_groups, found.n_links, found.digest.hexdigest(), *found.counted()))
        self.links += found.n_links

    def batch(self) -> pa.RecordBatch:
        ids, n_a, n_b, groups, links, digests, pairs, times = zip(*self.docs, strict=True)
        every, often = np.concatenate(pairs), np.concatenate(times)
        names, at = np.unique(every, return_inverse=True)
        totals = np.bincount(at, weights=often, minlength=len(names)).astype(np.int64)  # exact under 2**53
        steps = np.diff(at, prepend=0).astype(np.int32)
        pack = zstandard.ZstdCompressor(level=3).compress
        row = [self.number, ids, n_a, n_b, groups, links, digests, np.cumsum([len(p) for p in pairs]),
               pack(steps.tobytes()), pack(often.astype(np.uint32).tobytes()), names, totals]
        schema = arrow_schema(_BLOCK)
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)


_LOADED: dict[str, Tokenizers] = {}


def _loaded(files) -> Tokenizers:
    key = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(*files)
    return _LOADED[key]


def blocks(docs: DataFrame, a_path: str, b_path: str, links: int = BLOCK_LINKS) -> DataFrame:
    """Documents tokenised and aligned, in blocks; a written table."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))  # fixed files: some 2 MB

    def run(batches):
        tools = _loaded(files.value)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for part in passes(batches):
            texts = (text.as_py() for text in part.column("text"))
            for doc_id, found in zip(part.column("doc_id").to_pylist(), align_texts(tools, texts), strict=True):
                block.add(doc_id, found)
                if block.links >= links:
                    yield block.batch()
                    block = _Block(block.number + 1)
        if block.docs:
            yield block.batch()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return write_table(map_arrow(slim, run, _BLOCK), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: links of each pair of ids (A's id times the size of B's
    vocabulary, plus B's id) over all documents; a written table."""
    return write_table(aligned.select(F.inline(F.arrays_zip("pairs", "links"))).groupBy(F.col("pairs").alias("pair"))
                       .agg(F.sum("links").alias("n")), "pair-counts")


def _answer(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one block with the counts that it asked for."""
    schema = arrow_schema(_RESULT)
    order = np.argsort(right.column("pair").to_numpy())
    n, best = (right.column(c).to_numpy()[order] for c in ("n", "best"))
    row = {c: left.column(c)[0].as_py() for c in left.column_names}
    unpack = zstandard.ZstdDecompressor().decompress
    at = np.cumsum(np.frombuffer(unpack(row["entries"]), np.int32), dtype=np.int64)
    times = np.frombuffer(unpack(row["times"]), np.uint32).astype(np.int64)
    ends = np.array(row["ends"], np.int64)
    sums = []
    for values in (times * best[at] if len(at) else times, times * n[at] if len(at) else times):
        total = np.append(0, np.cumsum(values))
        sums.append(total[ends] - total[np.append(0, ends[:-1])])
    row |= {"n_best": sums[0], "count_sum": sums[1]}
    return pa.Table.from_arrays([pa.array(row[f.name], f.type) for f in schema], schema=schema)


def align(docs: DataFrame, a_path: str, b_path: str, links: int = BLOCK_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece
    vocabulary = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    ship_code(docs.sparkSession)
    aligned = blocks(docs, a_path, b_path, links)
    counts = pair_counts(aligned)
    of_b = (F.col("pair") % vocabulary).alias("b")
    top = counts.groupBy(of_b).agg(F.max("n").alias("top"))  # no more rows than B's vocabulary
    known = counts.join(F.broadcast(top), counts.pair % vocabulary == top.b).select(
        "pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    asked = aligned.select(F.col("block").alias("asker"), F.explode("pairs").alias("pair"))
    answers = asked.join(known, "pair").select("asker", "pair", "n", "best")
    return aligned.drop("pairs", "links").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_answer, _RESULT)
