"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is a vocabulary entry is resolved whole by a minimal perfect
hash; any other is merged by a heap of adjacent pairs over a doubly linked
list of its bytes, lowest rank first, leftmost of equals. The vocabulary file
is read once by the driver (its size is fixed by the tokenizer, not by the
data) and travels with the task; nothing is trained.

Text is first cut into runs of non-space characters with at most one leading
space, or runs of white space; no match of the pre-token pattern crosses
these cuts, so each run is encoded once per task and remembered.

Defined cases: null text is the empty text, which has no ids; ids of
special tokens are never produced; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_passes

#: Remembered runs of a task; when full, the memory starts anew.
CACHE_RUNS = 500_000
CACHE_CHARS = 64

#: White space of Unicode, as the pre-token pattern's ``\s`` has it (fixed values).
SPACE = (r"\t-\r\x20\x85\xa0  -     　")
#: A plain word or plain punctuation that ends where any pre-token must end; else a
#: run without white space, or of white space (the last of which stays with what follows).
RUNS = re.compile(rf" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?![^{SPACE}.,!|])| ?[.,!|]+(?![^{SPACE}A-Za-z])"
                  rf"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary by rank, from a file of base64 entries with their ranks."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    by_rank = {int(rank): base64.b64decode(entry) for entry, rank in pairs}
    return [by_rank[i] for i in range(len(by_rank))]


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys, n slots, one
    displacement per bucket; the key in the slot confirms a hit."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        n = len(keys)
        self.buckets = max(1, n // per_bucket)
        split: list[list[int]] = [[] for _ in range(self.buckets)]
        hashed = [_two(k) for k in keys]
        for i, (a, _) in enumerate(hashed):
            split[a % self.buckets].append(i)
        slots, self.displace = np.full(n, -1), [0] * self.buckets
        second = np.array([b for _, b in hashed], np.uint64)
        order = sorted(range(self.buckets), key=lambda b: -len(split[b]))
        for b in order:
            members = split[b]
            if len(members) < 2:
                break
            d = 1
            while True:  # displacements are tried a block at a time
                at = _slot(second[members][:, None], np.arange(d, d + 256, dtype=np.uint64)[None, :], n)
                fits = (slots[at] < 0).all(axis=0)
                ordered = np.sort(at, axis=0)
                fits &= (ordered[1:] != ordered[:-1]).all(axis=0)
                if fits.any():
                    found = int(np.argmax(fits))
                    break
                d += 256
            self.displace[b] = d + found
            slots[at[:, found]] = members
        free = iter(np.flatnonzero(slots < 0).tolist())
        for b in order:
            if len(split[b]) == 1:  # the slot itself, as a negative number
                x = next(free)
                self.displace[b], slots[x] = -1 - x, split[b][0]
        self.rank = slots.tolist()
        self.keys = [keys[i] for i in self.rank]

    def get(self, key: bytes) -> int:
        """The rank of ``key``, or -1."""
        a, b = _two(key)
        d = self.displace[a % self.buckets]
        x = -1 - d if d < 0 else int(_slot(b, d, len(self.keys)))
        return self.rank[x] if self.keys[x] == key else -1


_ODD, _BITS = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _slot(second, d, n: int):
    """Slot of a second hash under displacement ``d`` (numbers or arrays)."""
    if isinstance(d, int):
        h = ((second ^ (d * _ODD & _BITS)) * 0xD6E8FEB86659FD93) & _BITS
        return (h >> 32) % n
    with np.errstate(over="ignore"):
        h = (second ^ (d * np.uint64(_ODD))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _two(key: bytes) -> tuple[int, int]:
    h = int.from_bytes(hashlib.blake2b(key, digest_size=16).digest(), "little")
    return h & 0xFFFFFFFFFFFF, h >> 64


class Vocabulary:
    """Ranks of byte strings, the perfect hash over them, and the splitting
    pattern."""

    def __init__(self, entries: list[bytes], pattern: str):
        self.entries = entries
        self.pattern = regex.compile(pattern)
        self.whole = PerfectHash(entries)
        self.pairs = {e: i for i, e in enumerate(entries)}
        self.memory: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that isn't an entry itself. A node is named by
        its first byte: ``end`` links it to the next, ``start`` (by end) to
        the one before; ``best`` has the rank of the pair that begins there,
        by which outdated entries of the heap are known."""
        n, rank = len(piece), self.pairs.get
        end, start = list(range(1, n + 1)), list(range(-1, n))
        best = [rank(piece[i:i + 2], -1) for i in range(n - 1)] + [-1]
        heap = [r * n + i for i, r in enumerate(best) if r >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            if best[i] != r:
                continue
            j = end[i]
            best[j] = -1
            k = end[i] = end[j]
            start[k] = i
            if k < n:
                best[i] = r = rank(piece[i:end[k]], -1)
                if r >= 0:
                    heapq.heappush(heap, r * n + i)
            else:
                best[i] = -1
            if i:
                h = start[i]
                best[h] = r = rank(piece[h:k], -1)
                if r >= 0:
                    heapq.heappush(heap, r * n + h)
        ids, i = [], 0
        while i < n:
            ids.append(rank(piece[i:end[i]]))
            i = end[i]
        return ids

    def encode_run(self, run: str) -> bytes:
        ids: list[int] = []
        for token in self.pattern.findall(run):
            piece = token.encode()
            r = self.whole.get(piece)
            if r >= 0:
                ids.append(r)
            else:
                ids += self.merge(piece)
        out = np.array(ids, "<u4").tobytes()
        if len(run) <= CACHE_CHARS:
            if len(self.memory) >= CACHE_RUNS:
                self.memory.clear()
            self.memory[run] = out
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, fresh = self.memory.get, self.encode_run
        return b"".join([known(run) or fresh(run) for run in RUNS.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, Vocabulary] = {}


def loaded(entries: list[bytes], pattern: str) -> Vocabulary:
    """The vocabulary of this Python worker, built at its first task."""
    key = hashlib.sha256(repr((len(entries), entries[:64], entries[-64:], pattern)).encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(entries, pattern)
    return _LOADED[key]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int): the encoded documents."""
    entries = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # a fixed file: about 1 MB

    def step(b: pa.RecordBatch) -> dict:
        v = loaded(entries.value, pattern)
        return {"doc_id": b.column("doc_id"),
                "ids": [np.frombuffer(v.encode(t), "<u4").astype(np.int32) for t in b.column("text").to_pylist()]}

    return map_passes(_texts(docs), "doc_id long, ids array<int>", step)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text (UTF-8 bytes) of encoded documents; null ids give no bytes."""
    entries = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def step(b: pa.RecordBatch) -> dict:
        look = entries.value.__getitem__
        return {"doc_id": b.column("doc_id"),
                "text": [b"".join(map(look, ids or ())) for ids in b.column("ids").to_pylist()]}

    return map_passes(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>")),
                      "doc_id long, text binary", step, column="ids")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode every text, decode
    its ids again, and give the digests of both."""
    entries = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def step(b: pa.RecordBatch) -> dict:
        v = loaded(entries.value, pattern)
        ids = [v.encode(t) for t in b.column("text").to_pylist()]
        return {"doc_id": b.column("doc_id"), "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(v.decode(x)).hexdigest() for x in ids]}

    return map_passes(_texts(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", step)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
