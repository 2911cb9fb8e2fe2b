"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of about 512 bytes. Every passage is encoded
(byte classes, word lengths, repetition) and embedded by a hidden layer; gated
attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``, weighs the passages,
and a logistic layer scores the weighted representation. Only document
labels are used; which passages matter is learned.

The model is fitted in numpy on at most ``FIT_ROWS`` labelled documents a
class, of at most ``FIT_BYTES`` each (passage vectors of that sample alone come to the driver), and applied
to whole texts in one pass without a shuffle. Defined cases: null and empty
texts are one empty passage; a shorter text is one passage; without labels
of both classes every score is the share of label 1 (1.0 without labels);
equal texts have equal scores; a null doc_id counts as the id ''.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcodes
from .common import map_passes, utf8
from .labelled import fit_sample, label_table, remainder

#: Labelled documents of each class that the model is fitted on at most.
FIT_ROWS = 3_000
#: Longest text of the sample, so that the passages that come to the driver have a bound too: at
#: most 2 * FIT_ROWS * FIT_BYTES / PASSAGE_BYTES vectors. Longer texts are scored like all others.
FIT_BYTES = 256 << 10
MODULUS, HELD = 5, 0
THRESHOLD = 0.3

PASSAGE_BYTES = 512
#: Bytes of text encoded at once; the arrays take some 100 times as much.
ENCODE_BYTES = 2 << 20
HIDDEN, GATES = 24, 12
STEPS, RATE, DECAY = 250, 0.02, 1e-3
SEED = 11

#: Classes of bytes; a byte in none of them is in the class before the last (fixed values).
_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\x0b\x0c", b"\t",
            b".", b",", b"!", b"?", b"*", b"#", b"$", b"%", b"&", b"|", b"<>", b"/\\", b":", b";", b"=", b"-", b"_",
            b"\"", b"'`", b"()", b"[]{}", b"@", b"+^~")
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS[np.frombuffer(_c, np.uint8)] = _i
_CLASS[128:] = len(_CLASSES) + 1
_N_CLASSES = len(_CLASSES) + 2
FEATURES = _N_CLASSES + 6


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and the passages of each text."""
    buffer, starts = textcodes.join(texts)
    sizes = np.diff(starts) - 1
    per_doc = np.maximum(1, np.round(sizes / PASSAGE_BYTES)).astype(np.int64)
    first = np.r_[0, np.cumsum(per_doc)]
    total = int(first[-1])
    doc = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.minimum((np.arange(len(buffer)) - starts[doc]) // PASSAGE_BYTES, per_doc[doc] - 1)
    passage = first[doc] + place
    real = np.ones(len(buffer), bool)
    real[starts[1:] - 1] = False  # the line feeds that join the texts
    out = np.zeros((total, FEATURES))
    counts = np.bincount(passage[real] * _N_CLASSES + _CLASS[buffer[real]], minlength=total * _N_CLASSES)
    counts = counts.reshape(total, _N_CLASSES).astype(float)
    length = counts.sum(axis=1)
    out[:, :_N_CLASSES] = np.sqrt(counts / np.maximum(length, 1)[:, None])
    begin, end, _ = textcodes.words(buffer, starts)
    if len(begin):
        at = passage[begin]
        n = np.bincount(at, minlength=total).astype(float)
        size = (end - begin).astype(float)
        mean = np.bincount(at, size, total) / np.maximum(n, 1)
        spread = np.bincount(at, size * size, total) / np.maximum(n, 1) - mean ** 2
        word = textcodes.span_hash(textcodes.prefix_sums(textcodes.lower_ascii(buffer)), begin, end)
        _, owner = textcodes.distinct(word, at)
        repeat = np.r_[False, (word[1:] == word[:-1]) & (at[1:] == at[:-1])]
        out[:, _N_CLASSES] = np.log1p(n)
        out[:, _N_CLASSES + 1] = mean / 10
        out[:, _N_CLASSES + 2] = np.sqrt(np.maximum(spread, 0)) / 10
        out[:, _N_CLASSES + 3] = np.bincount(owner, minlength=total) / np.maximum(n, 1)
        out[:, _N_CLASSES + 4] = np.bincount(at, repeat, total) / np.maximum(n, 1)
    out[:, _N_CLASSES + 5] = np.log1p(length) / 6
    return out.astype(np.float32), per_doc


@dataclass
class Model:
    centre: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    shift: float  # from the balanced sample to the label shares

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x, per_doc = encode(texts)
        logit, _ = forward((x - self.centre) / self.spread, per_doc, self.weights)
        return 1 / (1 + np.exp(-np.clip(logit + self.shift, -60, 60)))


def _sum_by_doc(values: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.r_[0, np.cumsum(per_doc)[:-1]], axis=0)


def forward(x: np.ndarray, per_doc: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, dict]:
    """Logit of each document, and what the gradient needs."""
    h = np.tanh(x @ w["encode"] + w["encode0"])
    t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
    e = (t * g) @ w["a"]
    top = np.maximum.reduceat(e, np.r_[0, np.cumsum(per_doc)[:-1]])
    p = np.exp(e - np.repeat(top, per_doc))
    p /= np.repeat(_sum_by_doc(p, per_doc), per_doc)
    z = _sum_by_doc(h * p[:, None], per_doc)
    return z @ w["out"] + w["out0"], {"h": h, "t": t, "g": g, "p": p, "z": z}


def gradient(x, per_doc, w, keep, slope) -> dict[str, np.ndarray]:
    """Gradient of a loss whose derivative by the logits is ``slope``."""
    h, t, g, p, z = (keep[k] for k in "htgpz")
    out = {"out": z.T @ slope, "out0": slope.sum(keepdims=True)}
    dz = np.repeat(slope[:, None] * w["out"][None, :], per_doc, axis=0)
    dp = (h * dz).sum(axis=1)
    de = p * (dp - np.repeat(_sum_by_doc(p * dp, per_doc), per_doc))
    out["a"] = (t * g).T @ de
    dt, dg = de[:, None] * g * w["a"] * (1 - t * t), de[:, None] * t * w["a"] * g * (1 - g)
    out["v"], out["u"] = h.T @ dt, h.T @ dg
    dh = (p[:, None] * dz + dt @ w["v"].T + dg @ w["u"].T) * (1 - h * h)
    out["encode"], out["encode0"] = x.T @ dh, dh.sum(axis=0)
    return out


def train(x: np.ndarray, per_doc: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Adam on the class-balanced log loss; all of the sample at each step."""
    centre, spread = x.mean(axis=0), x.std(axis=0) + 0.05
    x = (x - centre) / spread
    rng = np.random.Generator(np.random.PCG64(SEED))
    shape = {"encode": (x.shape[1], HIDDEN), "encode0": (HIDDEN,), "v": (HIDDEN, GATES), "u": (HIDDEN, GATES),
             "a": (GATES,), "out": (HIDDEN,), "out0": (1,)}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "a out" else np.zeros(s) for k, s in shape.items()}
    first, second = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, STEPS + 1):
        logit, keep = forward(x, per_doc, w)
        slope = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * share
        for k, d in gradient(x, per_doc, w, keep, slope).items():
            d = d + DECAY * w[k]
            first[k] += 0.1 * (d - first[k])
            second[k] += 0.001 * (d * d - second[k])
            w[k] = w[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return centre, spread, w


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """The model, or None without labels of both classes."""
    sample, counts = fit_sample(docs, labels, "quality", MODULUS, HELD, rows)
    if not counts.get(0) or not counts.get(1):
        return None

    def step(b: pa.RecordBatch) -> dict:
        x, per_doc = encode(b.column("text").to_pylist())
        at = np.r_[0, np.cumsum(per_doc)]
        return {"doc_id": b.column("doc_id"), "label": b.column("label"),
                "x": [x[i:j].ravel() for i, j in zip(at[:-1], at[1:], strict=True)]}

    got = map_passes(sample.where(F.octet_length("text") <= FIT_BYTES).select("doc_id", "label", "text"), "doc_id long, label int, x array<float>", step,
                     size=ENCODE_BYTES).toArrow()
    got = got.sort_by([("doc_id", "ascending")])
    y = np.array(got.column("label").to_pylist(), float)
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES).astype(float)
    per_doc = np.array(got.column("x").combine_chunks().value_lengths().to_pylist()) // FEATURES
    if len(set(y)) < 2:
        return None
    centre, spread, w = train(x, per_doc, y)
    return Model(centre.astype(np.float32), spread.astype(np.float32),
                 {k: v.astype(np.float32) for k, v in w.items()}, float(np.log(counts[1] / counts[0])))


def score(docs: DataFrame, model: Model | None, otherwise: float = 1.0) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))

    def step(b: pa.RecordBatch) -> dict:
        texts = b.column("text").to_pylist()
        values = [otherwise] * len(texts) if model is None else model.scores(texts).astype(float)
        return {"doc_id": b.column("doc_id"), "score": values}

    return (map_passes(slim, "doc_id long, score double", step, size=ENCODE_BYTES)
            .select("doc_id", (remainder(MODULUS) == HELD).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def prevalence(labels: DataFrame) -> float:
    """Share of label 1 among the labels that may be learned from."""
    p = label_table(labels, "quality").where(remainder(MODULUS) != HELD).agg(F.avg("label")).first()[0]
    return 1.0 if p is None else float(p)
