"""Line deduplication by a log-template tree.

Lines are parsed by a tree of fixed depth: the first level is the number of
tokens, the next ``LEADING`` levels are the leading tokens, where a token with
a digit or an at sign is a variable field from the start. A leaf holds
templates; a line joins the most similar one if at least ``SIMILARITY`` of its
tokens agree, and the positions that differ become variable fields. A
template that occurs in ``LEAST_DOCS`` documents or more is boilerplate: its
lines are dropped from every document. A document counts once for a template,
however many of its lines belong to it.

A leaf is a group of a Spark shuffle. Equal lines are collected inside each map
task first, so a line that a third of all documents repeat reaches its leaf
as one row per task. It carries the keys of at most ``LEAST_DOCS`` documents:
a line in that many decides for its template, and of one in fewer all
documents are known, so the leaf counts different documents exactly. What
comes back is the digest of each line to drop, joined to the lines of the
documents.

Templates depend on the order of lines, so a leaf takes its distinct lines
in the order of their bytes: results don't depend on the partitioning.
Defined cases: null text is empty; blank lines are never dropped and belong
to no template; rows equal in doc_id and text are one document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, checkpointed, map_arrow, map_passes, small, utf8

LEADING = 3
SIMILARITY = 0.7
LEAST_DOCS = 3
FIELD = b"<*>"

_DIGIT = bytes(1 if 48 <= b <= 57 or b == 64 else 0 for b in range(256))


def fields(line: bytes) -> list[bytes]:
    """Tokens of a line, those with a digit or an at sign as variable fields."""
    parts = line.split()
    if b"\x01" in line.translate(_DIGIT):
        parts = [FIELD if b"\x01" in p.translate(_DIGIT) else p for p in parts]
    return parts


def leaf(parts: list[bytes]) -> int:
    """The path in the tree as a 64-bit number."""
    path = b"%d " % len(parts) + b" ".join(parts[:LEADING])
    return int.from_bytes(hashlib.blake2b(path, digest_size=8).digest(), "little", signed=True)


def digest(content: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(content, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def templates(lines: list[tuple[bytes, list[int]]], similarity: float = SIMILARITY) -> list[list[int]]:
    """Lines (distinct contents with their documents, in order) of one leaf by
    template. Tokens are numbers in an array; each line is compared with all
    templates of the leaf at once."""
    if len(lines) == 1:
        return [[0]]
    names: dict[bytes, int] = {FIELD: 0}
    width = len(lines[0][0].split(b" "))
    found = np.zeros((4, width), np.int64)
    members: list[list[int]] = []
    for i, (content, _) in enumerate(lines):
        row = np.array([names.setdefault(t, len(names)) for t in content.split(b" ")])
        n = len(members)
        if n:
            equal = (found[:n] == row).sum(axis=1)
            best = int(equal.argmax())
            if equal[best] >= similarity * width:
                found[best][found[best] != row] = 0
                members[best].append(i)
                continue
        if n == len(found):
            found = np.vstack([found, np.zeros_like(found)])
        found[n] = row
        members.append([i])
    return members


_COUNTED = "leaf long, content binary, docs array<long>"
_DROPPED = "d1 long, d2 long"


def _count_pass(least_docs: int):
    def step(b: pa.RecordBatch) -> dict:
        docs: dict[bytes, list[int]] = {}
        for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
            for content in {b" ".join(p) for p in map(fields, text.split(b"\n")) if p}:
                keys = docs.setdefault(content, [])
                if len(keys) < least_docs and key not in keys:
                    keys.append(key)
        return {"leaf": [leaf(c.split(b" ")) for c in docs], "content": list(docs), "docs": list(docs.values())}

    return step


def recurs(lines: list[list[int]], least_docs: int) -> bool:
    """Whether enough different documents hold any of the lines."""
    return max(map(len, lines)) >= least_docs or len(set().union(*lines)) >= least_docs


def _leaves(least_docs: int, similarity: float):
    schema = arrow_schema(_DROPPED)

    def run(batches):
        out: list[tuple[int, int]] = []

        def close(lines):
            if sum(len(keys) for _, keys in lines) < least_docs:
                return
            for group in templates(lines, similarity):
                if recurs([lines[i][1] for i in group], least_docs):
                    out.extend(digest(lines[i][0]) for i in group)

        current, lines = None, []
        for b in batches:
            for at, content, docs in zip(*(b.column(c).to_pylist() for c in ("leaf", "content", "docs")), strict=True):
                if at != current:
                    close(lines)
                    current, lines = at, []
                    if len(out) > 50_000:
                        yield _rows(out, schema)
                        out.clear()
                if not lines or lines[-1][0] != content:
                    lines.append((content, docs))
                elif len(lines[-1][1]) < least_docs:
                    lines[-1][1].extend(d for d in docs if d not in lines[-1][1])
        close(lines)
        yield _rows(out, schema)

    return run


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def recurring_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """d1, d2: digests of the generalised lines whose template recurs in
    different documents."""
    counted = map_passes(_keyed(docs).select("key", "text"), _COUNTED, _count_pass(least_docs))
    return map_arrow(counted.repartition("leaf").sortWithinPartitions("leaf", "content"),
                     _leaves(least_docs, similarity), _DROPPED)


def _line_digests(b: pa.RecordBatch) -> dict:
    """Digests of the non-blank lines of each document, by line number."""
    cols: dict[str, list] = {k: [] for k in ("doc_id", "key", "line", "d1", "d2")}
    for doc_id, key, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text")), strict=True):
        for i, line in enumerate(text.split(b"\n")):
            parts = fields(line)
            if parts:
                d1, d2 = digest(b" ".join(parts))
                for k, x in zip(cols, (doc_id, key, i, d1, d2), strict=True):
                    cols[k].append(x)
    return cols


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).withColumn(
        "key", F.xxhash64("text", F.coalesce("doc_id", F.lit(-1))))


def dropped(docs: DataFrame, least_docs: int = LEAST_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """key, lines: the numbers of the lines to drop of each document that has any."""
    gone = small(checkpointed(recurring_lines(docs, least_docs, similarity)), most_rows=400_000)  # some 100 bytes each
    lines = map_passes(_keyed(docs), "doc_id long, key long, line int, d1 long, d2 long", _line_digests)
    return lines.join(gone, ["d1", "d2"]).groupBy("key").agg(F.collect_set("line").alias("lines"))


def clean(docs: DataFrame, least_docs: int = LEAST_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256, text
    (UTF-8 bytes of the remaining lines)."""
    def step(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_lines", "n_dropped", "kept_sha256", "text")}
        for text, gone in zip(b.column("text").to_pylist(), b.column("lines").to_pylist(), strict=True):
            lines, gone = text.split(b"\n"), set(gone or ())
            kept = b"\n".join(x for i, x in enumerate(lines) if i not in gone)
            for k, x in zip(out, (len(lines), len(gone), hashlib.sha256(kept).hexdigest(), kept), strict=True):
                out[k].append(x)
        return {"doc_id": b.column("doc_id"), **out}

    whole = _keyed(docs).join(dropped(docs, least_docs, similarity), "key", "left").select("doc_id", "text", "lines")
    return map_passes(whole, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, text binary", step)
