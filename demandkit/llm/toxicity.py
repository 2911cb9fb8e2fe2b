"""Toxicity by maximum-scoring segments.

Tokens score by their log-odds between toxic and clean documents under an
informative Dirichlet prior, lowered by their standard error, so that a rare
token scores nothing; a token that is not in the lexicon scores by its
prefix, any other costs a little. A linear-time scan finds all maximal
scoring segments of a whole text (toxic passages). Their scores are turned
into expected numbers of chance segments of a clean text of that length
(extreme-value statistics: ``E = K n exp(-lambda S)``), and the evidence of
the significant ones, calibrated on labelled documents that the lexicon
hasn't seen, is the score.

The lexicon is fitted on at most ``FIT_ROWS`` labelled documents a class;
counting is a Spark aggregation, and a token counts as often as it occurs in
different contexts, so that copies of one document don't make evidence.
Defined cases: null, empty and token-less texts have the score of a text
without evidence; without labels of both classes every score is 0; rows
equal in text have equal scores; a null doc_id counts as the id ''.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_arrow, map_passes, utf8
from .labelled import fit_sample, remainder

#: Labelled documents of each class that the model is fitted on at most.
FIT_ROWS = 10_000
MODULUS, HELD = 3, 1
THRESHOLD = 0.7

#: Weight of the prior as a share of the fit documents, standard errors taken off, cost of a plain token.
PRIOR = 0.05
ERRORS = 2.0
COST = 0.2
PREFIX_BYTES = (6, 5, 4)
FOLDS = 3
LEAST_SCORE, MOST_SCORE = 1.2, 8.0
CACHE_TOKENS = 200_000

#: Bytes that part tokens besides white space (fixed values).
PUNCTUATION = b""".,;:!?"()[]{}<>|*#$%&/\\=+~^`@_-'"""
_SPLIT = bytes(32 if b in PUNCTUATION else b for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.lower().translate(_SPLIT).split()


def prefixes(token: bytes) -> list[bytes]:
    """Keys of a token's proper prefixes, longest first; keys of tokens never
    hold a space."""
    return [b" " + token[:n] for n in PREFIX_BYTES if len(token) > n]


def segments(hits: list[tuple[int, float]], cost: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last position) of a
    sequence whose scoring positions are ``hits`` and where each position
    between costs ``cost``; one pass over a list of candidates, each joined
    to the nearest earlier one that starts lower and ends lower. A candidate
    keeps a link to the nearest earlier one that starts lower; one that starts lowest
    of all settles those before it. So the pass takes linear time."""
    done: list[tuple[float, float, int, int, int]] = []
    open_: list[tuple[float, float, int, int, int]] = []  # total before, total after, first, last, link
    total, at = 0.0, -1
    for position, score in hits:
        if at >= 0:
            total -= cost * (position - at - 1)
        before, total, at = total, total + score, position
        first, j = position, len(open_) - 1
        while j >= 0 and open_[j][0] >= before:
            j = open_[j][4]
        while j >= 0 and open_[j][1] < total:
            before, _, first, _, link = open_[j]
            del open_[j:]
            j = link
        if j < 0:
            done += open_
            open_ = []
        open_.append((before, total, first, position, j))
    return [(b - a, f, e) for a, b, f, e, _ in done + open_]


def scoring(known: dict[bytes, float], words: list[bytes]) -> list[tuple[int, float]]:
    """All scoring positions; a token scores wherever it occurs."""
    return [(i, s) for i, s in enumerate(map(known.__getitem__, words)) if s]


@dataclass
class Model:
    """What a task needs: the lexicon (its size is bounded by the fit
    sample) and a few numbers."""

    scores: dict[bytes, float]
    decay: float  # lambda
    scale: float  # K
    weights: tuple[float, ...]  # calibration: constant, best, total
    memory: _Known | None = None  # of a task

    def evidence(self, text: bytes) -> tuple[float, float, list[tuple[float, int, int]]]:
        """Best and summed evidence (-ln E over the significant segments),
        and these segments."""
        words = tokens(text)
        if self.memory is None:
            self.memory = _Known(self.scores)
        known = self.memory
        hits = scoring(known, words)
        if not hits:
            return 0.0, 0.0, []
        size = math.log(max(len(words), 1)) + math.log(self.scale)
        strong = [(self.decay * s - size, f, e) for s, f, e in segments(hits, COST)]
        strong = [x for x in strong if x[0] > 0]
        return max((x[0] for x in strong), default=0.0), sum(x[0] for x in strong), strong

    def score(self, text: bytes) -> float:
        return self.calibrated(*self.evidence(text)[:2])

    def calibrated(self, best: float, total: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, np.dot(self.weights, _features(best, total))))))


def _features(best: float, total: float) -> tuple[float, float, float]:
    return 1.0, math.log1p(best), math.log1p(total)


class _Known(dict):
    """Scores by token, worked out at first sight; cleared when large."""

    def __init__(self, scores: dict[bytes, float]):
        super().__init__()
        self.scores = scores

    def __missing__(self, token: bytes) -> float:
        if len(self) >= CACHE_TOKENS:
            self.clear()
        keys = [token, *prefixes(token)]
        s = next((self.scores[k] for k in keys if k in self.scores), 0.0)
        if len(token) < 64:
            self[token] = s
        return s


_COUNT = "fold int, token binary, toxic long, clean long, toxic_seen long, clean_seen long"


def _count_pass(b: pa.RecordBatch) -> dict:
    """Documents and context bits of each token, by fold and class."""
    counts: dict[tuple[int, bytes], list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for text, label, fold in zip(*(b.column(c).to_pylist() for c in ("text", "label", "fold")), strict=True):
        n, seen = 1 - label, 3 - label
        words = tokens(text)
        bits: dict[bytes, int] = defaultdict(int)
        for before, token, after in zip([b"", *words], words, [*words[1:], b""], strict=False):
            bits[token] |= 1 << (zlib.crc32(before + b" " + after) & 62)
        for token in list(bits):
            for key in prefixes(token):  # as many as different tokens
                bits[key] |= 1 << (zlib.crc32(token) & 62)
        for key, bit in bits.items():
            c = counts[fold, key]
            c[n] += 1
            c[seen] |= bit
    cols = list(zip(*counts.values(), strict=True)) or [(), (), (), ()]
    return {"fold": [k[0] for k in counts], "token": [k[1] for k in counts],
            **dict(zip(("toxic", "clean", "toxic_seen", "clean_seen"), cols, strict=True))}


#: Context bits in use (every other of 63).
_SLOTS = 32


def _effective(n: str, seen: str):
    """Documents, but no more than the different contexts (linear counting)."""
    used = F.bit_count(F.col(seen)).cast("double")
    contexts = -_SLOTS * F.log(1.0 - used / _SLOTS)
    return F.when(used >= _SLOTS - 4, F.col(n).cast("double")).otherwise(F.least(F.col(n).cast("double"), contexts))


def count_tokens(sample: DataFrame) -> DataFrame:
    """One row per fold and token of the sample, for :func:`lexicon`."""
    return checkpointed(
        map_passes(sample.select("text", "label", "fold"), _COUNT, _count_pass).groupBy("fold", "token")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
             F.bit_or("toxic_seen").alias("toxic_seen"), F.bit_or("clean_seen").alias("clean_seen")))


def lexicon(counts: DataFrame, n1: int, n0: int) -> dict[bytes, float]:
    """Scores of the tokens and prefixes that are significantly toxic, and 0
    for well-known clean tokens under a toxic prefix."""
    if not n1 or not n0:
        return {}
    merged = (counts.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean")],
                                          *[F.bit_or(c).alias(c) for c in ("toxic_seen", "clean_seen")])
              .select("token", _effective("toxic", "toxic_seen").alias("y"), _effective("clean", "clean_seen").alias("c")))
    mass = PRIOR * (n1 + n0)
    prior = (F.col("y") + F.col("c")) * PRIOR + 0.05
    y, c = F.col("y") + prior, F.col("c") + prior
    odds = F.log(y / (n1 + mass - F.col("y"))) - F.log(c / (n0 + mass - F.col("c")))
    least = odds - ERRORS * F.sqrt(1 / y + 1 / c)
    scored = merged.select("token", "c", least.alias("s")).where(f"s >= {LEAST_SCORE} OR c >= 5")
    toxic = {bytes(r["token"]): min(MOST_SCORE, r["s"]) for r in scored.where(f"s >= {LEAST_SCORE}").collect()}
    heads = [k for k in toxic if k[:1] == b" "]
    if heads:
        under = [F.concat(F.lit(b" "), F.substring("token", 1, n)).isin(heads) for n in PREFIX_BYTES]
        for r in scored.where((F.col("s") < LEAST_SCORE) & (under[0] | under[1] | under[2])).select("token").collect():
            toxic[bytes(r["token"])] = 0.0
    return toxic


def extreme_values(score: float, hits: int, words: int) -> float:
    """The decay lambda of chance segments: the positive root of
    E[exp(lambda x)] = 1 over the token scores of clean text, of whose
    ``words`` tokens ``hits`` (and half a one more) score ``score`` on
    average and the others the cost."""
    x = np.array([score, -COST])
    w = np.array([hits + 0.5, max(words - hits, 1)])
    w = w / w.sum()
    low, high = 1e-3, 50.0 / max(score, 1.0)
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if float(w @ np.exp(mid * x)) < 1.0 else (low, mid)
    return low


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """The lexicon of the whole sample; its extreme-value numbers and the
    calibration come from documents scored by the lexicon of the other
    folds. None without both classes."""
    sample, counts = fit_sample(docs, labels, "toxic", MODULUS, HELD, rows)
    sizes = {(r["fold"], r["label"]): r["count"] for r in sample.groupBy("fold", "label").count().collect()}
    table = count_tokens(sample)

    def scores_without(fold: int) -> dict[bytes, float]:
        n = [sum(v for (f, y), v in sizes.items() if f != fold and y == k) for k in (1, 0)]
        return lexicon(table.where(F.col("fold") != fold), *n)

    whole, parts = scores_without(-1), [scores_without(f) for f in range(FOLDS)]
    if not whole:
        return None

    def hits(b: pa.RecordBatch) -> dict:
        known = [_Known(p) for p in parts]
        words = [tokens(t) for t in b.column("text").to_pylist()]
        found = [[s for _, s in scoring(known[f], w)]
                 for w, f in zip(words, b.column("fold").to_pylist(), strict=True)]
        return {"n": [len(w) for w in words], "total": [sum(x) for x in found], "hits": [len(x) for x in found]}

    clean = map_passes(sample.where("label = 0").select("text", "fold"), "n long, total double, hits long", hits)
    n, total, seen = clean.agg(F.sum("n"), F.sum("total"), F.sum("hits")).first()
    decay = extreme_values(float(total or 0) / seen if seen else 3.0, seen or 0, n or 1)
    models = [Model(p, decay, COST, (0.0, 0.0, 0.0)) for p in parts]

    def evidence(b: pa.RecordBatch) -> dict:
        found = [models[f].evidence(t)
                 for t, f in zip(b.column("text").to_pylist(), b.column("fold").to_pylist(), strict=True)]
        return {"label": b.column("label"), "best": [x[0] for x in found], "total": [x[1] for x in found]}

    got = map_passes(sample.select("text", "label", "fold"), "label int, best double, total double", evidence).collect()
    x = np.array([_features(r["best"], r["total"]) for r in got])
    y = np.array([r["label"] for r in got], float)
    # Each class weighs as much as it has fit labels, whatever the sample took of it.
    weight = np.where(y == 1, counts.get(1, 0) / max(1.0, y.sum()), counts.get(0, 0) / max(1.0, (1 - y).sum()))
    return Model(whole, decay, COST, tuple(logistic(x, y, weight / weight.mean())))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weighted logistic regression by Newton's method; the constant isn't penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1)) * len(y)
    penalty /= max(len(y), 1) / 10
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty,
                               x.T @ (weight * (y - p)) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted and the passages (token positions
    ``first-last``) of every document."""
    spans = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))

    def step(b: pa.RecordBatch) -> dict:
        texts = b.column("text").to_pylist()
        if model is None:
            return {"doc_id": b.column("doc_id"), "score": [0.0] * len(texts), "passages": [""] * len(texts)}
        found = [model.evidence(t) for t in texts]
        return {"doc_id": b.column("doc_id"), "score": [model.calibrated(*x[:2]) for x in found],
                "passages": [",".join(f"{f}-{e}" for _, f, e in x[2]) for x in found]}

    return (map_passes(spans, "doc_id long, score double, passages string", step)
            .select("doc_id", (remainder(MODULUS) == HELD).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages"))


def drop_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, all columns as they are; the text
    is scored in the batch that carries the row, nothing is joined."""
    if model is None:
        return docs

    def run(batches):
        for b in batches:
            keep = [model.score((t or "").encode()) < threshold for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(keep, type=pa.bool_()))

    return map_arrow(docs, run, docs.schema)
