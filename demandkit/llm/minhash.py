"""Near-duplicate documents by b-bit MinHash.

A document is the set of its word shingles. For each set the minima under many
hash functions are taken; whole minima make band keys, and of each minimum the
low bits are kept and packed into a signature. Sets that share a band key are
candidates. Inside each group of candidates the packed signatures give a
collision-corrected similarity by counting equal bits (two minima agree by
chance in one of ``2**BITS`` cases); pairs that may reach the threshold are
confirmed on their full sets, most similar first, and a pair whose documents
are connected already is left out, so no group is expanded into all pairs.

Rows with equal sets are one class from the start. Candidate groups are the
connected components of the buckets, described by one link per member. A
group larger than ``BLOCK`` is cut into blocks; blocks are connected inside,
then by their hubs, and what is still apart is compared block by block with
everything else: no candidate is dropped.

Defined cases: null, empty and word-less texts have the empty set and link
with nothing; a text of fewer words than a shingle has its whole sequence as
the one shingle; a doc_id that occurs on several rows is one vertex, linked
by any of its texts; rows without doc_id are vertices by their content, and
their component_id is null unless a doc_id is in it; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textcodes
from .common import arrow_schema, checkpointed, free_names, map_arrow, map_passes, utf8, write_table
from .graph import connected_components

BANDS = 48
MOST_ROWS = 8
#: Chance that a pair just at the threshold shares no band, at most.
MISS = 1e-6
#: Bits kept of a minimum.
BITS = 2
#: A pair is confirmed unless its estimate is this many standard errors under the threshold.
ERRORS = 5.5
#: Documents of a block (longer ones count more, see ``_weight``) and shingles that make one more.
BLOCK = 4096
SHINGLES_PER_UNIT = 2000
#: Likely pairs of a block that are held at once.
PAIRS = 200_000
#: Hubs of a block that meet those of other blocks first.
HUBS = 4

#: Bytes of text whose sets are made at once.
PASS_BYTES = 4 << 20

#: Vertices of rows without a doc_id lie above this number.
NO_ID = 1 << 62


def rows_per_band(similarity: float, bands: int = BANDS) -> int:
    """The most minima in a band that keep the chance of a miss under ``MISS``."""
    return max(r for r in range(1, MOST_ROWS + 1) if r == 1 or (1 - similarity ** r) ** bands <= MISS)


def _multipliers(n: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(29))
    return (rng.integers(0, 1 << 32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def minima(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minima of a set under each hash function, as uint32."""
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 512):
        block = low[at:at + 512, None] * factors
        block ^= high[at:at + 512, None]
        np.minimum(best, block.min(axis=0), out=best)
    return best


def band_keys(least: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key of each band's whole minima."""
    h = np.arange(1, least.shape[-1] // rows + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            h = textcodes.mix(h * np.uint64(0x9E3779B97F4A7C15) + least[..., r::rows].astype(np.uint64))
    return h


def pack(least: np.ndarray) -> bytes:
    """Low bits of all minima, one plane of bits after the other."""
    low = textcodes.mix(least.astype(np.uint64)).astype(np.uint8)
    return b"".join(np.packbits((low >> b) & 1).tobytes() for b in range(BITS))


def estimate(one: np.ndarray, others: np.ndarray, functions: int) -> np.ndarray:
    """Collision-corrected similarity of a packed signature to others (rows
    of uint8): equal minima by bit counts, less the chance agreement."""
    differ = np.zeros((len(others), others.shape[1] // BITS), np.uint8)
    width = differ.shape[1]
    for b in range(BITS):
        differ |= others[:, b * width:(b + 1) * width] ^ one[b * width:(b + 1) * width]
    equal = 1 - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) / functions
    chance = 2.0 ** -BITS
    return (equal - chance) / (1 - chance)


def lowest_estimate(similarity: float, functions: int) -> float:
    """Estimates under this are no links."""
    chance = 2.0 ** -BITS
    p = chance + (1 - chance) * similarity
    return similarity - ERRORS * np.sqrt(p * (1 - p) / functions) / (1 - chance)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text."""
    buffer, starts = textcodes.join([t.lower() for t in texts])
    begin, end, doc = textcodes.words(buffer, starts)
    if not len(begin):
        return [np.zeros(0, np.uint64)] * len(texts)
    word = textcodes.span_hash(textcodes.prefix_sums(buffer), begin, end)
    hashes, docs = textcodes.distinct(*textcodes.shingle_hash(word, doc, width))
    return np.split(hashes, np.searchsorted(docs, np.arange(1, len(texts))))


_SIGNED = "id long, n_shingles long, d1 long, d2 long, bands array<long>, bits binary"


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
    return int(d[0]), int(d[1])


def signatures(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """One row per document: vertex, size and digest of its set, band keys and
    packed low bits (both null for the empty set). Written once."""
    rows = rows_per_band(similarity)
    factors = _multipliers(BANDS * rows)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))

    def step(b: pa.RecordBatch) -> dict:
        sets = shingle_sets(b.column("text").to_pylist(), width)
        digests = [_digest(s) for s in sets]
        least = [minima(s, factors) if len(s) else None for s in sets]
        ids = [d if d is not None else NO_ID + (x[0] & (NO_ID // 2 - 1))
               for d, x in zip(b.column("doc_id").to_pylist(), digests, strict=True)]
        return {"id": ids, "n_shingles": [len(s) for s in sets],
                "d1": [x[0] for x in digests], "d2": [x[1] for x in digests],
                "bands": [None if m is None else band_keys(m, rows).view(np.int64) for m in least],
                "bits": [None if m is None else pack(m) for m in least]}

    return write_table(map_passes(slim, _SIGNED, step, size=PASS_BYTES), "minhash-signatures")


class Forest:
    """Union-find; the smallest member names its tree."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on whole sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def link_group(sets: list[np.ndarray], bits: np.ndarray, known: list[int], percent: int,
               functions: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Links that connect the true components of a group, as pairs of
    positions, and how many links each member got. Members with the same
    ``known`` number (not -1) are connected already. Pairs are tried from the likeliest
    level of estimates down to the least that can be a link; at each, those of members
    still apart are held up to ``PAIRS``, then confirmed in order and skipped once
    connected: memory grows with the members, not their pairs, and what is connected
    at a high level isn't compared at a lower one. No pair is confirmed twice."""
    n = len(sets)
    tree, degree, links = np.arange(n), [0] * n, []
    first: dict[int, int] = {}
    for i, k in enumerate(known):
        if k >= 0:
            tree[i] = first.setdefault(k, i)

    def settle(pairs) -> None:
        for i, j in pairs:
            if tree[i] != tree[j] and _linked(sets[i], sets[j], percent):
                tree[tree == max(tree[i], tree[j])] = min(tree[i], tree[j])
                links.append((i, j))
                degree[i] += 1
                degree[j] += 1

    if n == 2:
        settle([(0, 1)])
        return links, degree
    least, sizes = lowest_estimate(percent / 100, functions), np.array([len(s) for s in sets])
    above = np.inf
    for level in (percent / 100 + 0.04, percent / 100, (percent / 100 + least) / 2, least):
        held: list[tuple[np.ndarray, ...]] = []
        for i in range(n - 1):
            apart = i + 1 + np.flatnonzero((tree[i + 1:] != tree[i]) & (
                100 * np.minimum(sizes[i], sizes[i + 1:]) >= percent * np.maximum(sizes[i], sizes[i + 1:])))
            if len(apart):
                near = estimate(bits[i], bits[apart], functions)
                likely = (near >= level) & (near < above)
                held.append((near[likely], np.full(np.count_nonzero(likely), i), apart[likely]))
            if held and (i == n - 2 or sum(len(h[0]) for h in held) > PAIRS):
                near, one, other = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.argsort(-near, kind="stable")
                settle(zip(one[order].tolist(), other[order].tolist(), strict=True))
                held = []
        above = level
    return links, degree


_LINK = "u long, v long, label long, block string, degree long"


def _confirm(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) of the groups named by ``block``, and every member with
    itself (u = v), the smallest member it is connected to, and its number
    of links. Rows: block, node, known, d1,
    d2, bits, text; groups are dealt over tasks and read one after another."""
    schema = arrow_schema(_LINK)
    functions = BANDS * rows_per_band(percent / 100)

    def run(batches):
        out: list[tuple] = []
        for group in _small_runs(batches):
            texts = [t or b"" for t in group["text"]]
            sets = shingle_sets(texts, width)
            start = 0
            for n in group["sizes"]:
                # A row whose text isn't the one that was signed (its doc_id is on several rows) is another's.
                at = [i for i in range(start, start + n)
                      if _digest(sets[i]) == (group["d1"][i], group["d2"][i])]
                start += n
                at = list({(group["node"][i], group["d1"][i], group["d2"][i]): i for i in at}.values())
                bits = np.array([np.frombuffer(group["bits"][i], np.uint8) for i in at])
                links, degree = link_group([sets[i] for i in at], bits, [group["known"][i] for i in at],
                                           percent, functions) if len(at) > 1 else ([], [0] * len(at))
                block, node = group["block"][start - 1], [group["node"][i] for i in at]
                forest = Forest(len(at))  # rows are sorted: the first member of a tree is the smallest
                for i, j in links:
                    forest.join(i, j)
                out += [(node[i], node[j], 0, block, 0) for i, j in links if node[i] != node[j]]
                out += [(x, x, node[forest.root(i)], block, d) for i, (x, d) in enumerate(zip(node, degree, strict=True))]
            if len(out) > 20_000:
                yield _rows(out, schema)
                out = []
        if out:
            yield _rows(out, schema)

    return map_arrow(rows.repartition("block").sortWithinPartitions("block", "node"), run, _LINK)


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _small_runs(batches, size: int = PASS_BYTES):
    """Whole groups, several at a time while their texts are small."""
    names = ("block", "node", "known", "d1", "d2", "bits", "text")
    held: dict[str, list] = {k: [] for k in names}
    sizes: list[int] = []
    total = 0
    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in names), strict=True):
            if not held["block"] or held["block"][-1] != row[0]:
                if total > size:
                    yield held | {"sizes": sizes}
                    held, sizes, total = {k: [] for k in names}, [], 0
                sizes.append(0)
            for k, x in zip(names, row, strict=True):
                held[k].append(x)
            sizes[-1] += 1
            total += len(row[6] or b"")
    if sizes:
        yield held | {"sizes": sizes}


def _weight() -> Column:
    return 1 + F.floor(F.col("n_shingles") / SHINGLES_PER_UNIT)


def candidate_links(classes: DataFrame) -> DataFrame:
    """u, v: one link from each member of a bucket to its smallest member.
    Buckets are counted before they are read; of most, the smallest and
    largest member are all there is, and only larger ones are joined."""
    keys = classes.select("node", F.explode("bands").alias("key"))
    buckets = checkpointed(keys.groupBy("key").agg(F.min("node").alias("v"), F.max("node").alias("w"),
                                                   F.count(F.lit(1)).alias("n")).where("v != w"))
    more = buckets.where("n > 2").select("key", "v")
    return (buckets.select(F.col("w").alias("u"), "v")
            .unionByName(keys.join(more, "key").select(F.col("node").alias("u"), "v").where("u != v"))).distinct()


def components(docs: DataFrame, width: int = 5, similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    named = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return _placed(docs, width, similarity, block).select(
        named("id").alias("doc_id"), "n_shingles", named("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))


def _placed(docs: DataFrame, width: int, similarity: float, block: int) -> DataFrame:
    """id (vertex), n_shingles and component of every document."""
    percent = round(100 * similarity)
    signed = signatures(docs, width, similarity)
    key = ["n_shingles", "d1", "d2"]
    classes = checkpointed(signed.where("n_shingles > 0").groupBy(*key)
                           .agg(F.min("id").alias("node"), F.any_value("bands").alias("bands"),
                                F.any_value("bits").alias("bits")))
    groups = connected_components(candidate_links(classes))
    member = checkpointed(classes.join(groups, "node")
                          .select("node", *key, "bits", F.col("label").alias("candidate")))
    size = (member.groupBy("candidate").agg(F.sum(_weight()).alias("weight"))
            .select("candidate", F.ceil(F.col("weight") / block).cast("long").alias("blocks")))
    member = checkpointed(member.join(size, "candidate")
                          .withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))

    def confirm(rows: DataFrame) -> DataFrame:
        """Rows: block, node, known, d1, d2, bits, without their texts."""
        with_id = rows.where(F.col("node") < NO_ID).join(texts, F.col("node") == F.col("doc_id"))
        if nameless:
            by_content = signed.where(F.col("id") >= NO_ID).select("id")
            whole = map_passes(docs.where("doc_id IS NULL").select(utf8().alias("text")),
                               "id long, text binary", lambda b: _nameless(b, width))
            with_id = with_id.drop("doc_id").unionByName(
                rows.join(by_content.distinct(), F.col("node") == F.col("id"), "left_semi")
                .join(whole, F.col("node") == F.col("id")).drop("id"))
        return _confirm(with_id.select("block", "node", "known", "d1", "d2", "bits", "text"), width, percent)

    nameless = not signed.where(F.col("id") >= NO_ID).isEmpty()
    base = member.withColumn("known", F.lit(-1))
    inside = checkpointed(confirm(base.withColumn("block", F.concat_ws("/", "candidate", "part"))))
    label = inside.where("u = v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("label"))
    if not member.where("blocks > 1").isEmpty():
        large = base.where("blocks > 1")
        split = inside.join(large.select(F.col("node").alias("u")).distinct(), "u", "left_semi")
        links = split.where("u != v").select("u", "v")
        joined = connected_components(_across(large, split, links, confirm, block))
        label = label.join(joined.withColumnRenamed("label", "wide"), "node", "left").select(
            "node", F.coalesce("wide", "label").alias("label"))
    vertex = classes.select(*key, "node").join(label, "node", "left").select(
        *key, F.coalesce("label", "node").alias("component"))
    same = [signed[c] == vertex[c] for c in key]
    placed = signed.join(vertex, same, "left").select(
        "id", signed["n_shingles"], F.coalesce("component", "id").alias("component"))
    sets = F.struct(*key)
    several = signed.groupBy("id").agg(F.min(sets).alias("a"), F.max(sets).alias("b")).where("a != b")
    return placed if several.isEmpty() else _tied(write_table(placed, "minhash-placed"), inside)


def _tied(placed: DataFrame, inside: DataFrame) -> DataFrame:
    """Components that meet in a vertex of several texts become one: a vertex ties all the
    components of its rows, and those that its texts got in their groups."""
    names = placed.select("id", "component").unionByName(
        inside.where("u = v").select(F.col("u").alias("id"), F.col("label").alias("component")))
    least = names.groupBy("id").agg(F.min("component").alias("v"), F.max("component").alias("w")).where("v != w")
    ties = names.join(least, "id").select(F.col("component").alias("u"), "v").where("u != v").distinct()
    joined = connected_components(ties).withColumnRenamed("node", "component")
    return placed.join(joined, "component", "left").select(
        "id", "n_shingles", F.coalesce("label", "component").alias("component"))


def _nameless(b: pa.RecordBatch, width: int) -> dict:
    texts = b.column("text").to_pylist()
    return {"id": [NO_ID + (_digest(s)[0] & (NO_ID // 2 - 1)) for s in shingle_sets(texts, width)],
            "text": texts}


def _across(large: DataFrame, inside: DataFrame, links: DataFrame, confirm, block: int) -> DataFrame:
    """Links between the blocks of large groups. First the hubs of each block
    meet in one group per candidate group; then, with what is connected so far
    as one, all members outside the largest such part are compared with
    everything else, block by block. Members of that part are never
    compared with each other again."""
    hub = inside.where("u = v AND degree > 0").select(
        F.col("u").alias("node"), "block", "degree")
    top = hub.groupBy("block").agg(F.slice(F.sort_array(F.collect_list(F.struct("degree", "node")), False), 1, HUBS)
                                   .alias("best"))  # a block is bounded
    hubs = top.select(F.explode("best.node").alias("node"))
    met = confirm(large.join(hubs, "node", "left_semi").withColumn("block", F.col("candidate").cast("string")))
    links = checkpointed(links.unionByName(met.where("u != v").select("u", "v")))
    part = connected_components(links)
    now = checkpointed(large.join(part, "node", "left").withColumn("label", F.coalesce("label", "node")))
    main = (now.groupBy("candidate", "label").agg(F.sum(_weight()).alias("w"))
            .groupBy("candidate").agg(F.max_by("label", F.struct("w", "label")).alias("main")))
    now = checkpointed(now.join(main, "candidate").withColumn("known", F.col("label")))
    rest = now.where("label != main")
    others = (rest.groupBy("candidate").agg(F.ceil(F.sum(_weight()) / block).cast("long").alias("others")))
    rest = rest.join(others, "candidate").withColumn("own", F.pmod(F.xxhash64("node", F.lit(9)), F.col("others")))
    # Tiles (main block i, other block j) and (other block j, other block k).
    tile = lambda kind, a, b: F.concat_ws("/", "candidate", F.lit(kind), a, b)
    cross = [
        now.where("label = main").join(others, "candidate")
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
           .withColumn("block", tile("m", "part", "j")),
        rest.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("block", tile("m", "j", "own")),
        rest.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
            .withColumn("block", tile("o", F.least("own", "j"), F.greatest("own", "j"))),
    ]
    rows = None
    for x in cross:
        x = x.select("block", "node", "known", "d1", "d2", "bits")
        rows = x if rows is None else rows.unionByName(x)
    return checkpointed(links.unionByName(confirm(rows).where("u != v").select("u", "v")))


def deduplicate(docs: DataFrame, width: int = 5, similarity: float = 0.8, block: int = BLOCK) -> DataFrame:
    """The documents, all columns as they are, without those whose component
    holds a smaller doc_id. Rows that repeat a kept doc_id stay. Of rows without a
    doc_id one of each set stays, and only in components without a doc_id."""
    placed = write_table(_placed(docs, width, similarity, block), "minhash-components")
    gone = placed.where("id != component").select("id").distinct()
    name, vertex = free_names(docs, "gone_id", "vertex_id")
    gone = gone.withColumnRenamed("id", name)
    kept = docs.join(gone.where(F.col(name) < NO_ID), F.col("doc_id").cast("long") == F.col(name), "left_anti")
    if placed.where(F.col("id") >= NO_ID).isEmpty():
        return kept

    def run(batches):
        for b in batches:
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            sets = shingle_sets(texts, width) if texts else []
            ids = [NO_ID + (_digest(s)[0] & (NO_ID // 2 - 1)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.int64())], names=[*b.schema.names, vertex])

    schema = docs.select("*", F.lit(None).cast("long").alias(vertex)).schema
    nameless = map_arrow(docs.where("doc_id IS NULL"), run, schema)
    shown = (nameless.where(F.col(vertex).isNotNull()).join(gone.where(F.col(name) >= NO_ID), F.col(vertex) == F.col(name), "left_anti")
             .dropDuplicates([vertex]))
    return kept.where("doc_id IS NOT NULL").unionByName(
        shown.unionByName(nameless.where(F.col(vertex).isNull())).drop(vertex))
