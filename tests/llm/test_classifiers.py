"""Quality and toxicity: held-out accuracy, edge cases and their parts."""
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.llm import quality as Q
from demandkit.llm import toxicity as T

WORDS = [a + b for a in ("ta", "re", "mi", "so", "lu", "ka", "ne", "vo") for b in ("n", "r", "st", "ble", "ing", "or")]
BAD = ("grumwit", "snorfle", "blattpate")


def corpus(n=500, seed=3):
    """Clean prose, prose with planted bad words, and junk."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(WORDS, int(rng.integers(20, 200))))
        toxic, good = i % 5 == 0, i % 7 != 0
        if toxic:
            for at in rng.integers(0, len(words), 4):
                words[at] = str(rng.choice(BAD))
        if not good:
            words = [w + "$$$" if k % 2 else "##" + w for k, w in enumerate(words)]
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def known():
    return corpus()


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scored, labels, column):
    want = {r[0]: r[column] for r in labels}
    held = [r for r in scored if r.held_out]
    assert len(held) > 50
    return sum(r.predicted == want[r.doc_id] for r in held) / len(held)


def test_toxicity_held_out_accuracy_and_passages(spark, make_docs, known):
    rows, labels = known
    docs = make_docs(rows, extra=True)
    model = T.fit(docs, label_frame(spark, labels))
    scored = T.score(docs, model).collect()
    assert len(scored) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored)
    assert accuracy(scored, labels, 2) > 0.97
    assert all(bool(r.passages) == bool(labels[r.doc_id][2]) for r in scored if r.score > 0.7)
    kept = T.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored if r.score < T.THRESHOLD}


def test_quality_held_out_accuracy(spark, make_docs, known):
    rows, labels = known
    docs = make_docs(rows, extra=True)
    model = Q.fit(docs, label_frame(spark, labels))
    scored = Q.score(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    assert accuracy(scored, labels, 1) > 0.97


def test_held_out_labels_change_nothing(spark, make_docs, known):
    rows, labels = known
    docs = make_docs(rows)
    flipped = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 and zlib.crc32(str(i).encode()) % 5 == 0
               else (i, q, t) for i, q, t in labels]
    for part in (T, Q):
        a, b = (sorted(map(tuple, part.score(docs, part.fit(docs, label_frame(spark, x))).select("doc_id", "score").collect()))
                for x in (labels, flipped))
        assert a == b


def test_edge_cases(spark, make_docs, known):
    rows, labels = known
    frame = label_frame(spark, labels).unionByName(
        spark.createDataFrame([(None, 1, 1), (3, None, None), (0, 1, 1)], "doc_id long, quality int, toxic int"))
    odd = make_docs([(1000, None), (1001, ""), (1002, ""), (None, "x"), (1003, "ta " * 200_000), (1003, "ta " * 200_000),
                     (1004, "\n\t "), (1005, "grumwit")], extra=True)
    docs = make_docs(rows)
    for part in (T, Q):
        model = part.fit(docs, frame)
        out = part.score(odd, model).collect()
        assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
        by = {}
        for r in out:
            by.setdefault(r.doc_id, set()).add(r.score)
        assert by[1000] == by[1001] == by[1002] and len(by[1003]) == 1
        assert part.score(make_docs([]), model).collect() == []


def test_without_labels(spark, make_docs):
    docs, none = make_docs([(1, "a b"), (2, None)]), label_frame(spark, [])
    assert T.fit(docs, none) is None and Q.fit(docs, none) is None
    assert [r.score for r in T.score(docs, None).collect()] == [0.0, 0.0]
    assert [r.score for r in Q.score(docs, None, Q.prevalence(none)).collect()] == [1.0, 1.0]
    assert T.drop_toxic(docs, None).count() == 2
    one = label_frame(spark, [(i, 1, 0) for i in range(20)])
    assert T.fit(make_docs([(i, "a b c") for i in range(20)]), one) is None


def test_segments_are_the_maximal_ones():
    def brute(scores):
        """Maximal segments by definition: recursively the best one, then both sides."""
        if not scores or max(scores) <= 0:
            return []
        total = list(itertools.accumulate(scores, initial=0))
        best = max(((total[j] - total[i], i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
        i, j = best[3], best[4]
        return brute(scores[:i]) + [best[0]] + brute(scores[j:])

    rng = np.random.default_rng(9)
    for _ in range(200):
        n = int(rng.integers(1, 25))
        hits = sorted(rng.choice(n, int(rng.integers(1, n + 1)), replace=False).tolist())
        value = {i: float(rng.integers(1, 9)) for i in hits}
        got = [s for s, _, _ in T.segments([(i, value[i]) for i in hits], 1.5)]
        want = brute([value.get(i, -1.5) for i in range(n)])
        assert np.allclose(sorted(got), sorted(want))


def test_passages_that_repeat_earlier_words():
    model = T.Model({b.encode(): 3.0 for b in BAD}, 1.0, 0.01, (0.0, 1.0, 1.0))
    plain, dense = ["ta"] * 60, list(BAD)
    passages = lambda words: [(f, e) for _, f, e in model.evidence(" ".join(words).encode())[2]]
    assert passages(plain + dense + plain + dense + plain) == [(60, 62), (123, 125)]
    scattered = [w for b in BAD for w in [*plain, b]]
    alone, later = (model.evidence(" ".join(w).encode()) for w in (scattered, scattered + plain + dense))
    at = len(scattered) + 60
    assert (at, at + 2) in [(f, e) for _, f, e in later[2]] and later[0] > alone[0]
    assert passages(plain + ["grumwit"] * 3 + plain) == [(60, 62)]


def test_attention_gradient():
    rng = np.random.default_rng(2)
    x, per_doc, y = rng.normal(size=(9, 4)), np.array([2, 3, 1, 3]), np.array([0.0, 1, 1, 0])
    w = {"encode": rng.normal(size=(4, 5)), "encode0": rng.normal(size=5), "v": rng.normal(size=(5, 3)),
         "u": rng.normal(size=(5, 3)), "a": rng.normal(size=3), "out": rng.normal(size=5), "out0": np.zeros(1)}

    def loss():
        z, _ = Q.forward(x, per_doc, w)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    logit, keep = Q.forward(x, per_doc, w)
    grad = Q.gradient(x, per_doc, w, keep, 1 / (1 + np.exp(-logit)) - y)
    for k, g in grad.items():
        for at in list(np.ndindex(g.shape))[:6]:
            before = w[k][at]
            w[k][at] = before + 1e-6
            up = loss()
            w[k][at] = before - 1e-6
            assert abs((up - loss()) / 2e-6 - g[at]) < 1e-4
            w[k][at] = before


def test_small_documents_table(spark, small_dir):
    docs, labels = (spark.read.parquet(f"{small_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = Q.score(docs, Q.fit(docs, labels)).join(labels, "doc_id")
    right = scored.where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.85


def test_segment_scan_takes_linear_time():
    """Isolated hits, and hits whose candidates pile up in rising and falling order."""
    import time
    n = 100_000
    for hits in ([(50 * i, 2.0) for i in range(n)], [(i * (2 + i % 3), 1.0) for i in range(n)], [(9 * i, 1.0 + (i % 40)) for i in range(n)],
                 [(i + 100 * (i // 7), 1.2) for i in range(n)], [(2 * i, 0.3) for i in range(n)]):
        start = time.perf_counter()
        found = T.segments(hits, 0.2)
        assert time.perf_counter() - start < 2 and found
    text = b" ".join([b"plain"] * 60 + [b"grumwit"]) + b" "
    model = T.Model({b"grumwit": 3.0}, 0.5, T.COST, (0.0, 1.0, 0.0))
    start = time.perf_counter()
    model.evidence(text * 4000)
    assert time.perf_counter() - start < 4
