"""Bounded, deterministic samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8, write_table


def remainder(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo ``modulus`` (a null id counts as
    the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def label_table(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label: rows without either are left out, of several labels of
    one document the largest counts."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int,
               rows: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts of at most ``rows`` labelled documents of each class (those of
    the smallest hash of their id) that aren't held out: doc_id, label, fold
    (0-2, for cross-fitting), text. Also the number of fit labels by class. The ids
    are bounded by ``rows``, so they are broadcast and no text is shuffled."""
    known = label_table(labels, label).where(remainder(modulus) != held)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id", F.lit(5))
    picked = [known.where(F.col("label") == c).orderBy(order, "doc_id").limit(rows) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1]).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(3)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return write_table(texts.join(F.broadcast(ids), "doc_id"), "fit-sample"), counts


def probability(score, low: float = 0.0, high: float = 1.0):
    """Clip to the range of a probability."""
    return max(low, min(high, float(score)))
