"""Exact deduplication by Grace hashing.

Every map task first collapses the equal texts of its own input in an
open-addressing table, so a group of copies that holds a third of all rows
reaches the shuffle as one record per task. The records are dealt by the
hash of their content; each reduce task runs Grace hash deduplication:
records go to spill files by further hash bits, recursively, until the
distinct contents of a bucket fit one open-addressing table, which compares
complete contents. Equality never rests on a digest.

Texts are equal when identical after lower-casing A-Z. Defined cases: null
text is the empty text, and all empty texts are one group; of equal texts
the largest doc_id stays, a null doc_id counts as the smallest, and of rows
that tie on doc_id too exactly one stays; an empty table gives an empty
result; other columns are ignored by :func:`groups` and kept by
:func:`deduplicate`.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_arrow, utf8, write_table

#: Bytes of distinct content that one table may hold before its bucket spills.
TABLE_BYTES = 64 << 20
FANOUT_BITS = 4
HASH_BITS = 60

MEMBER = "rid long, rep long, doc_id long, text_sha256 string, hash long, n long, text binary"
CLASS = "rep long, keep_rid long, keep_id long, group_size long"


class ContentTable:
    """Open addressing with linear probing; keys are (hash, whole content)."""

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.values: list[list] = []
        self.size = 0

    def entry(self, h: int, content: bytes) -> list:
        """The value list of ``content``; empty if it is new."""
        mask = len(self.slots) - 1
        at = h & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.contents[i] == content:
                return self.values[i]
            at = (at + 1) & mask
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.values.append([])
        self.size += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return self.values[-1]

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for i, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def grace(records: Iterable[tuple[int, bytes, tuple]], limit: int = TABLE_BYTES,
          level: int = 0, largest: bool = False) -> Iterator[tuple[bytes, list]]:
    """``(content, values)`` of each distinct content of ``(hash, content,
    value)`` records. While the distinct contents exceed ``limit`` bytes the
    bucket is partitioned by the next hash bits into spill files of the task
    and each file is taken by itself; records whose hash bits are used up
    share one table. With ``largest`` a content keeps only the value that
    leads with the largest doc_id (of ties the first)."""
    table, records = ContentTable(), iter(records)
    last = (level + 1) * FANOUT_BITS > HASH_BITS
    for h, content, value in records:
        _put(table.entry(h, content), [value], largest)
        if table.size > limit and not last and len(table.contents) > 1:
            break
    else:
        yield from zip(table.contents, table.values, strict=True)
        return
    shift, fan = HASH_BITS - (level + 1) * FANOUT_BITS, 1 << FANOUT_BITS
    # Scratch of this task attempt only, like Spark's own spill: nothing else reads it.
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files = [(Path(folder) / f"{b}").open("w+b") for b in range(fan)]
        for h, content, values in zip(table.hashes, table.contents, table.values, strict=True):
            for value in values:
                pickle.dump((h, content, value), files[(h >> shift) & (fan - 1)], protocol=5)
        del table
        for record in records:
            pickle.dump(record, files[(record[0] >> shift) & (fan - 1)], protocol=5)
        for f in files:
            f.seek(0)
            yield from grace(_read(f), limit, level + 1, largest)
            f.close()


def _put(values: list, new: list, largest: bool) -> None:
    values += new
    if largest and len(values) > 1:
        values[:] = [max(values, key=lambda v: (v[0] is not None, v[0] or 0))]


def _read(f) -> Iterator[tuple[int, bytes, tuple]]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def content_hash(digest: bytes) -> int:
    """The leading bits of a SHA-256 as a non-negative long."""
    return int.from_bytes(digest[:8], "big") >> (64 - HASH_BITS)


def _older(doc_id: int | None, rid: int) -> tuple:
    """Sort key: the row that stays is the largest."""
    return (doc_id is not None, doc_id or 0, -rid)


def _collapse(limit: int, memory: int):
    schema = arrow_schema(MEMBER)

    def flush(rows):
        table = ContentTable()
        for at, (_, _, h, content) in enumerate(rows):
            table.entry(h, content).append(at)
        out = [None] * len(rows)
        for content, at in zip(table.contents, table.values, strict=True):
            best = max(at, key=lambda i: _older(rows[i][1], rows[i][0]))
            rep = rows[best][0]
            for i in at:
                rid, doc_id, h, _ = rows[i]
                out[i] = (rid, rep, doc_id, h, len(at) if i == best else 0, content if i == best else None)
        return out

    def run(batches):
        base, seen = TaskContext.get().partitionId() << 33, 0
        rows, digests, size = [], [], 0

        def batch():
            cols = list(zip(*flush(rows), strict=True))
            rid, rep, doc, h, n, text = cols
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip((rid, rep, doc, digests, h, n, text), schema, strict=True)],
                schema=schema)

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                content = (text.as_py() or b"").lower()
                digest = hashlib.sha256(content).digest()
                rows.append((base + seen, doc_id, content_hash(digest), content))
                digests.append(digest.hex())
                seen += 1
                size += len(content) + 200
                if size > memory:
                    yield batch()
                    rows, digests, size = [], [], 0
        if rows:
            yield batch()

    return run


def _classes(limit: int):
    schema = arrow_schema(CLASS)

    def records(batches):
        for b in batches:
            yield from zip(b.column("hash").to_pylist(), (x.as_py() for x in b.column("text")), zip(
                b.column("rid").to_pylist(), b.column("doc_id").to_pylist(), b.column("n").to_pylist()))

    def run(batches):
        out = []
        for _, values in grace(records(batches), limit):
            keep = max(values, key=lambda v: _older(v[1], v[0]))
            total = sum(v[2] for v in values)
            out += [(rid, keep[0], keep[1], total) for rid, _, _ in values]
            if len(out) > 20_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return run


def _batch(rows, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The collapsed rows are written once, so that a retried task cannot name
    its representatives anew; the members then find their class by the
    representative of their own task, a key without skew."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    members = write_table(map_arrow(slim, _collapse(table_bytes, table_bytes), MEMBER), "exact-members")
    heads = members.where("n > 0").select("hash", "text", "rid", "doc_id", "n")
    classes = map_arrow(heads.repartition("hash"), _classes(table_bytes), CLASS)
    return (members.select("rid", "rep", "doc_id", "text_sha256").join(classes, "rep")
            .select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    "text_sha256"))


def deduplicate(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns. Whole rows travel with
    their text: each batch drops its own copies first, the rest meets after
    one shuffle in Grace hashing, and nothing is joined back."""
    names = docs.columns
    others = [c for c in names if c != "text"]
    doc_id = F.col("doc_id").cast("long") if "doc_id" in names else F.lit(None).cast("long")
    text = F.col("text").cast("string")
    slim = docs.select(
        doc_id.alias("doc_id"), text.cast("binary").alias("text"),
        F.xxhash64(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)).alias("hash"),
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row"))

    def thin(batches):
        for b in batches:
            table = ContentTable()
            ids = b.column("doc_id").to_pylist()
            for i, (h, raw) in enumerate(zip(b.column("hash").to_pylist(), b.column("text").to_pylist(), strict=True)):
                values = table.entry(h & _MASK, (raw or b"").lower())
                values[:] = [max([*values, i], key=lambda j: (ids[j] is not None, ids[j] or 0, -j))]
            best = sorted(v[0] for v in table.values)
            yield b.take(pa.array(best, type=pa.int64()))

    def winners(batches):
        def records():
            for b in batches:
                nonlocal schema
                schema = b.schema
                for d, raw, h, row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "hash", "row")),
                                          strict=True):
                    yield h & _MASK, (raw or b"").lower(), (d, raw, h, row)

        schema, out, size = None, [], 0
        for _, values in grace(records(), table_bytes, largest=True):
            out.append(values[0])
            size += len(values[0][1] or b"")
            if size > 4 << 20 or len(out) >= 4000:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)

    kept = map_arrow(map_arrow(slim, thin, slim.schema).repartition("hash"), winners, slim.schema)
    return kept.select(*[F.col("text").cast("string").alias("text") if c == "text"
                         else F.col(f"row.c{others.index(c)}").alias(c) for c in names])


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MASK = (1 << HASH_BITS) - 1
