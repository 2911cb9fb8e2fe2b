"""Removal of repeated substrings by per-shard suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in
a smaller doc_id, or earlier in the same document) is removed. Strings are
judged on the input and never cross documents.

1. Each string (window) is assigned the smallest fingerprint of the
   ``GRAM``-byte strings in it; equal windows have equal ones, at equal places.
   A maximal run of windows with one such string is a segment. Segments, not windows, are
   dealt over the cluster, by fingerprint, as four numbers each; a map task
   first drops all but the earliest of its equal segments, so a passage that
   a third of all documents repeat arrives once per task.
2. A segment that equals an earlier one is covered as a whole. Fingerprints
   that occur in one segment only are done. Where different segments share a
   fingerprint, the earliest of each kind is contested: its text is fetched.
3. The texts of contested segments are gathered into shards by fingerprint.
   Each shard gets a suffix array by Larsson-Sadakane refinement in numpy and
   common prefixes by Kasai's method; neighbours with ``LENGTH`` bytes in
   common are one class, of which all but the earliest are covered. The
   shards of a task that hold parts of one fingerprint are merged by binary search of each class in the sorted
   suffixes of the others (windows of different fingerprints differ). A fingerprint with more than ``HOT`` contested
   segments is dealt anew by the fingerprint of its windows.

Defined cases: null text is empty; texts under ``LENGTH`` bytes keep all
bytes; a null doc_id comes after all others; rows with one doc_id and
different texts are different documents, ordered by a hash of the text; rows
equal in doc_id and text are one document with a row each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import row_index
from . import textcodes
from .common import arrow_schema, checkpointed, map_arrow, map_passes, passes, small, utf8, write_table

LENGTH = 100
GRAM = 24
#: Bytes of text in one numpy pass (whose arrays take some 120 times as much); longer
#: texts are read in pieces that overlap.
PIECE_BYTES = 1 << 20
#: Segments of a map task that are compared with each other before the shuffle.
LOCAL_SEGMENTS = 500_000
SHARD_BYTES = 1 << 20
HOT = 200_000
#: Documents whose ids may be broadcast (some 80 bytes each in a hash table).
MOST_IDS = 1_000_000

COVERED, CONTESTED, CROWDED = 1, 2, 3


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def segments(pieces: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Fingerprint, hash of the text, piece, start and number of windows of
    each segment of some pieces of text."""
    buffer, starts = textcodes.join(pieces)
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if len(buffer) <= length:
        return none
    sums = textcodes.prefix_sums(buffer)
    at = np.arange(len(buffer) - gram + 1)
    grams = textcodes.span_hash(sums, at, at + gram)
    least = _sliding_min(grams, length - gram + 1)
    sizes = np.diff(starts) - 1
    windows = np.maximum(sizes - length + 1, 0)
    piece = np.repeat(np.arange(len(pieces)), windows)
    if not len(piece):
        return none
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    key = least[starts[piece] + inside]
    # The leftmost smallest string is left behind when a window begins with it: no segment repeats a window in itself.
    passed = grams[starts[piece] + inside] == key
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1]) | passed[:-1]])
    count = np.diff(np.r_[first, len(key)])
    begin = starts[piece[first]] + inside[first]
    text = textcodes.span_hash(sums, begin, begin + count + length - 1)
    return key[first], text, piece[first], inside[first], count


def earliest(key: np.ndarray, text: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (key, text, doc, start), and whether each (key, text) is new
    there. A place that comes twice (from a repeated row) is taken once."""
    order = np.lexsort((start, doc, text, key))
    if not len(order):
        return order, np.zeros(0, bool)
    k, t, d, s = key[order], text[order], doc[order], start[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])]
    once = new | np.r_[True, (d[1:] != d[:-1]) | (s[1:] != s[:-1])]
    return order[once], new[once]


def stretches(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches that overlap or touch as one."""
    order = np.lexsort((start, doc))
    doc, start, size = doc[order], start[order], size[order]
    if not len(doc):
        return doc, start, size
    other = np.r_[True, doc[1:] != doc[:-1]]
    # Ends so far of each document: ends grow with a step that no document's bytes reach.
    shift = np.cumsum(other) << 44
    end = np.maximum.accumulate(start + size + shift)
    first = np.flatnonzero(np.r_[True, other[1:] | (start[1:] + shift[1:] > end[:-1])])
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], start[first], end[last] - shift[last] - start[first]


_SEGMENT = "key long, text long, doc long, place long"


def _segment_rows(length: int, gram: int):
    """place: start * 2**16 + windows; 0 windows mark a covered segment, whose
    key only spreads it and whose text is its size in bytes."""
    schema = arrow_schema(_SEGMENT)

    def flush(held):
        key, text, doc, start, count = (np.concatenate(x) for x in zip(*held, strict=True))
        order, new = earliest(key, text, doc, start)
        key, text, doc, start, count = (x[order] for x in (key, text, doc, start, count))
        gone = stretches(doc[~new], start[~new], count[~new] + length - 1)
        spread = textcodes.mix((gone[0] * 1_000_003 + gone[1]).astype(np.uint64))
        key, text, doc, start, count = (np.concatenate([x[new], y]) for x, y in (
            (key, spread), (text, gone[2].astype(np.uint64)), (doc, gone[0]), (start, gone[1]),
            (count, np.zeros(len(spread), np.int64))))
        for at in range(0, len(key), 50_000):
            s = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                key[s].view(np.int64), text[s].view(np.int64), doc[s], (start[s] << 16) | count[s])], schema=schema)

    def run(batches):
        held, total = [], 0
        for docs, offsets, pieces in _pieces(batches, length):
            key, text, piece, start, count = segments(pieces, length, gram)
            held.append((key, text, docs[piece], start + offsets[piece], count))
            total += len(key)
            if total > LOCAL_SEGMENTS:
                yield from flush(held)
                held, total = [], 0
        if held:
            yield from flush(held)

    return run


def _pieces(batches, length: int):
    """Documents and offsets of pieces of about ``PIECE_BYTES`` altogether;
    pieces of one text overlap by a window less one byte."""
    docs, offsets, texts, total = [], [], [], 0
    for b in passes(batches):
        for doc, text in zip(b.column("doc").to_pylist(), b.column("text").to_pylist(), strict=True):
            for at in range(0, max(len(text) - length + 1, 1), PIECE_BYTES):
                part = text[at:at + PIECE_BYTES + length - 1]
                docs.append(doc)
                offsets.append(at)
                texts.append(part)
                total += len(part)
                if total > PIECE_BYTES:
                    yield np.array(docs, np.int64), np.array(offsets, np.int64), texts
                    docs, offsets, texts, total = [], [], [], 0
    if texts:
        yield np.array(docs, np.int64), np.array(offsets, np.int64), texts


_JUDGED = "kind int, key long, doc long, start long, size long"


def _judge(length: int, hot: int):
    """Covered segments (size in bytes) and contested ones (size in windows)
    of a partition, which has all segments of its fingerprints."""
    schema = arrow_schema(_JUDGED)

    def run(batches):
        cols = [[], [], [], []]
        for b in batches:
            for c, name in zip(cols, ("key", "text", "doc", "place"), strict=True):
                c.append(b.column(name).to_numpy())
        if not cols[0]:
            return
        key, text, doc, place = (np.concatenate(c) for c in cols)
        start, count = place >> 16, place & 0xFFFF
        done = count == 0
        yield from _emit(schema, COVERED, key[done], doc[done], start[done], text[done])
        key, text, doc, start, count = (x[~done] for x in (key, text, doc, start, count))
        order, new = earliest(key, text, doc, start)
        key, doc, start, count = (x[order] for x in (key, doc, start, count))
        yield from _emit(schema, COVERED, key[~new], doc[~new], start[~new], count[~new] + length - 1)
        key, doc, start, count = (x[new] for x in (key, doc, start, count))
        if not len(key):
            return
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        kinds = np.diff(np.r_[first, len(key)])
        kinds = np.repeat(kinds, kinds)
        for kind, mask in ((CONTESTED, (kinds > 1) & (kinds <= hot)), (CROWDED, kinds > hot)):
            yield from _emit(schema, kind, key[mask], doc[mask], start[mask], count[mask])

    return run


def _emit(schema: pa.Schema, kind: int, *cols: np.ndarray):
    for at in range(0, len(cols[0]), 50_000):
        part = [pa.array(c[at:at + 50_000].astype(np.int64)) for c in cols]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part[0]), kind, np.int32)), *part], schema=schema)


def words(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number, zeros
    after the end."""
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    out = np.zeros(len(buffer), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:i + len(buffer)]
    return out


def suffix_array(buffer: np.ndarray) -> np.ndarray:
    """All suffixes in order, by Larsson-Sadakane refinement: sorted by seven
    bytes first (and how many there are, as the end comes before any byte); then only groups of equal suffixes are sorted, by the group
    of the suffix that many bytes on, which doubles the bytes each time."""
    n = len(buffer)
    first = (words(buffer) & ~np.uint64(0xFF)) | np.minimum(n - np.arange(n), 7).astype(np.uint64)
    order = np.argsort(first)
    new = np.r_[True, first[order][1:] != first[order][:-1]]
    group = np.empty(n + 1, np.int64)  # a group's number is the place of its first suffix
    group[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    group[n] = -1
    known, at = 7, np.arange(n)
    while True:
        # Places in groups of several suffixes: those of one group are next to each other.
        sizes = np.diff(np.r_[np.flatnonzero(new[at]), len(at)])
        at = at[np.repeat(sizes > 1, sizes)]
        if not len(at):
            break
        suffix = order[at]
        own, ahead = group[suffix], group[np.minimum(suffix + known, n)]
        resort = np.argsort(own * (n + 1) + ahead + 1)  # both below n: one number for the pair
        suffix, own, ahead = suffix[resort], own[resort], ahead[resort]
        order[at] = suffix
        new[at] = np.r_[True, (own[1:] != own[:-1]) | (ahead[1:] != ahead[:-1])]
        group[suffix] = np.maximum.accumulate(np.where(new[at], at, 0))
        known *= 2
    return order


#: Numbers with one more byte each.
_BYTE_STEPS = np.array([1 << 8 * k for k in range(8)], np.uint64)


def kasai(buffer: np.ndarray, order: np.ndarray, limit: int, chain: int = 64) -> np.ndarray:
    """Bytes (up to ``limit``) that each suffix has in common with the one
    before it in ``order``. Positions are taken in text order: a common prefix
    is at least the one of the position before, less one. All chains of
    ``chain`` positions advance together."""
    n = len(buffer)
    ahead = np.append(words(buffer), np.uint64(0))
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, np.int64)
    held = np.zeros(-(-n // chain), np.int64)
    for step in range(chain):
        at = np.arange(step, n, chain)
        other = before[at]
        most = np.minimum(limit, n - np.maximum(at, other))  # none has bytes beyond the end
        length = np.maximum(held[:len(at)] - 1, 0)
        length[other < 0] = 0
        live = np.flatnonzero((other >= 0) & (length < most))
        while len(live):
            differ = ahead[at[live] + length[live]] ^ ahead[other[live] + length[live]]
            same = 8 - np.searchsorted(_BYTE_STEPS, differ, side="right")  # equal bytes of the next eight
            length[live] = np.minimum(length[live] + same, most[live])
            live = live[(same == 8) & (length[live] < most[live])]
        common[at] = length
        held[:len(at)] = length
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    out = np.empty(n, np.int64)
    out[place] = common
    return out


class Shard:
    """Contested segments of a task: their distinct windows in suffix order,
    and the earliest place of each."""

    def __init__(self, doc: np.ndarray, start: np.ndarray, texts: list[bytes], length: int):
        self.buffer, begins = textcodes.join(texts)
        self.length = length
        order = suffix_array(self.buffer)
        common = kasai(self.buffer, order, length)
        windows = np.diff(begins) - length  # a line feed ends each text
        owner = np.repeat(np.arange(len(texts)), np.diff(begins))
        inside = np.arange(len(self.buffer)) - begins[owner]
        valid = inside < windows[owner]
        run = np.cumsum(common < length)[valid[order]]
        self.at = order[valid[order]]
        self.doc, self.start = doc[owner[self.at]], start[owner[self.at]] + inside[self.at]
        first = np.r_[True, run[1:] != run[:-1]] if len(run) else np.zeros(0, bool)
        self.kind = np.cumsum(first) - 1
        self.heads = self.at[first]  # one window of each class, ascending
        by = np.lexsort((self.start, self.doc, self.kind))
        edge = by[np.r_[True, self.kind[by][1:] != self.kind[by][:-1]]] if len(by) else by
        self.best_doc, self.best_start = self.doc[edge], self.start[edge]

    def find(self, buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Class of each window of another shard here, or -1: a binary search
        of all of them at once."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.heads))
        theirs, ours = words(buffer), words(self.buffer)
        while (open_ := low < high).any():
            mid = (low + high) // 2
            sign = np.zeros(len(at), np.int8)
            todo = np.flatnonzero(open_)
            for k in range(0, self.length, 8):
                k = min(k, self.length - 8)
                a, b = ours[self.heads[mid[todo]] + k], theirs[at[todo] + k]
                sign[todo] = np.where(a < b, -1, np.where(a > b, 1, 0))
                todo = todo[a == b]
                if not len(todo):
                    break
            low = np.where(open_ & (sign < 0), mid + 1, low)
            high = np.where(open_ & (sign >= 0), mid, high)
        hit = np.minimum(low, max(len(self.heads) - 1, 0))
        same = low < len(self.heads)
        for k in range(0, self.length, 8):
            k = min(k, self.length - 8)
            i = np.flatnonzero(same)
            same[i] = ours[self.heads[hit[i]] + k] == theirs[at[i] + k]
        return np.where(same, hit, -1)

    def merge(self, earlier: list[Shard]) -> None:
        """Give each class the earliest place in this and all earlier shards,
        here and there."""
        found = [s.find(self.buffer, self.heads) for s in earlier]
        for s, hit in zip(earlier, found, strict=True):
            i = np.flatnonzero(hit >= 0)
            less = (s.best_doc[hit[i]] < self.best_doc[i]) | (
                (s.best_doc[hit[i]] == self.best_doc[i]) & (s.best_start[hit[i]] < self.best_start[i]))
            i = i[less]
            self.best_doc[i], self.best_start[i] = s.best_doc[hit[i]], s.best_start[hit[i]]
        for s, hit in zip(earlier, found, strict=True):
            i = np.flatnonzero(hit >= 0)
            s.best_doc[hit[i]], s.best_start[hit[i]] = self.best_doc[i], self.best_start[i]

    def covered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents, starts and bytes of what is covered."""
        late = (self.doc != self.best_doc[self.kind]) | (self.start != self.best_start[self.kind])
        return stretches(self.doc[late], self.start[late], np.full(int(late.sum()), self.length))


_TEXT = "key long, doc long, start long, text binary"
_STRETCH = "doc long, start long, size long"


def _compare_shards(length: int, shard_bytes: int):
    schema = arrow_schema(_STRETCH)

    def emit(shard: Shard):
        found = shard.covered()
        for at in range(0, len(found[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 50_000]) for x in found], schema=schema)

    def run(batches):
        # Rows come by fingerprint, and equal windows have one: a shard is merged with those that hold part of its
        # own fingerprints, and is done when the last of them is over.
        open_: list[tuple[int, Shard]] = []
        held: list[tuple[int, int, bytes]] = []
        total = last = 0

        def close():
            doc, start, texts = zip(*held, strict=True)
            shard = Shard(np.array(doc, np.int64), np.array(start, np.int64), list(texts), length)
            shard.merge([s for _, s in open_])
            open_.append((last, shard))

        for b in batches:
            for key, *row in zip(*(b.column(c).to_pylist() for c in ("key", "doc", "start", "text")), strict=True):
                if total > shard_bytes:
                    close()
                    held, total = [], 0
                    for end, shard in open_:
                        if end != key:
                            yield from emit(shard)
                    open_ = [x for x in open_ if x[0] == key]
                held.append(row)
                total += len(row[2])
                last = key
        if held:
            close()
        for _, shard in open_:
            yield from emit(shard)

    return run


_WINDOW = "hash long, doc long, start long"


def _crowded_windows(length: int):
    def step(b: pa.RecordBatch) -> dict:
        buffer, begins = textcodes.join(b.column("text").to_pylist())
        windows = np.diff(begins) - length
        owner = np.repeat(np.arange(b.num_rows), windows)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = begins[owner] + inside
        h = textcodes.span_hash(textcodes.prefix_sums(buffer), at, at + length)
        return {"hash": h.view(np.int64), "doc": np.array(b.column("doc").to_pylist(), np.int64)[owner],
                "start": np.array(b.column("start").to_pylist(), np.int64)[owner] + inside}
    return step


def _crowded(texts: DataFrame, length: int) -> DataFrame:
    """Covered stretches of crowded fingerprints: their windows meet by their
    own fingerprint. The first place of each is an aggregate, so a window that
    all of them have is counted before the shuffle."""
    windows = write_table(map_passes(texts, _WINDOW, _crowded_windows(length)), "suffix-windows")
    first = windows.groupBy("hash").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    late = windows.join(first.where("n > 1"), "hash").where("first.doc != doc OR first.start != start")
    return late.select("doc", "start", F.lit(length).cast("long").alias("size"))


def _numbered(docs: DataFrame) -> DataFrame:
    """doc (position in the order of documents), doc_id, text. The doc_id is
    the position unless ids are null or repeated."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    unique = slim.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty()
    if unique:
        return slim.withColumn("doc", F.col("doc_id"))
    keyed = slim.withColumn("content", F.xxhash64("text"))
    order = row_index(keyed.select("doc_id", "content").distinct(),
                      [F.col("doc_id").isNull(), F.col("doc_id"), F.col("content")], "doc").withColumnsRenamed(
                          {"doc_id": "_id", "content": "_content"})
    return keyed.join(checkpointed(order), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content"))
                      ).select("doc", "doc_id", "text")


def _ids(rows: DataFrame) -> DataFrame:
    return small(checkpointed(rows.select("doc").distinct()), MOST_IDS)


def covered(numbered: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
            shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc, start, size: stretches of bytes to remove (they may overlap)."""
    rows = map_arrow(numbered.select("doc", "text"), _segment_rows(length, gram), _SEGMENT)
    judged = write_table(map_arrow(rows.repartition("key"), _judge(length, hot), _JUDGED), "suffix-judged")
    parts = judged.where(F.col("kind") == COVERED).select("doc", "start", "size")
    contested = judged.where(F.col("kind") != COVERED)
    wanted = contested.groupBy("doc").agg(F.collect_list(F.struct("kind", "key", "start", "size")).alias("wanted"))
    # Rows of one document are cut alike; their places are equal, and the first is nobody's copy.
    fetched = numbered.select("doc", "text").join(_ids(contested), "doc", "left_semi").join(wanted, "doc")
    schema = "kind int, " + _TEXT

    def cut(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("kind", "key", "doc", "start", "text")}
        for doc, text, wants in zip(b.column("doc").to_pylist(), b.column("text").to_pylist(),
                                    b.column("wanted").to_pylist(), strict=True):
            for w in wants:
                row = (w["kind"], w["key"], doc, w["start"], text[w["start"]:w["start"] + w["size"] + length - 1])
                for k, x in zip(out, row, strict=True):
                    out[k].append(x)
        return out

    texts = map_passes(fetched, schema, cut)
    crowd = not judged.where(F.col("kind") == CROWDED).isEmpty()
    if crowd:
        texts = write_table(texts, "suffix-contested")
    near = texts.where(F.col("kind") == CONTESTED).drop("kind")
    found = map_arrow(near.repartition("key").sortWithinPartitions("key", "doc", "start"),
                      _compare_shards(length, shard_bytes), _STRETCH)
    parts = parts.unionByName(found)
    if crowd:
        parts = parts.unionByName(_crowded(texts.where(F.col("kind") == CROWDED).drop("kind", "key"), length))
    return parts


def spans(start: list[int], size: list[int]) -> list[tuple[int, int]]:
    """Maximal removed runs of one document."""
    out: list[tuple[int, int]] = []
    for a, n in sorted(zip(start, size, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], a + n))
        else:
            out.append((a, a + n))
    return out


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _apply(b: pa.RecordBatch) -> dict:
    out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
    for text, gone in zip(b.column("text").to_pylist(), b.column("gone").to_pylist(), strict=True):
        cut = spans([g["start"] for g in gone], [g["size"] for g in gone])
        parts, at = [], 0
        for a, e in cut:
            parts.append(text[at:a])
            at = e
        kept = b"".join([*parts, text[at:]])
        for k, x in zip(out, (len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept), strict=True):
            out[k].append(x)
    return {"doc_id": b.column("doc_id"), **out}


def remove_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, kept (the remaining bytes)."""
    numbered = _numbered(docs)
    gone = checkpointed(covered(numbered, length, **options).groupBy("doc")
                        .agg(F.collect_list(F.struct("start", "size")).alias("gone")))
    ids = _ids(gone)
    touched = numbered.join(ids, "doc", "left_semi").join(gone, "doc").select("doc_id", "text", "gone")
    whole = numbered.join(ids, "doc", "left_anti").select(
        "doc_id", F.length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"))
    return map_passes(touched, _RESULT, _apply).unionByName(whole)
