import hashlib

import numpy as np
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline as P
from demandkit.llm import byte_bpe
from demandkit.llm.queries import QUERIES, tokenizer

from .test_exact_dedup import brute as exact
from .test_minhash import brute as near


def test_every_operator_has_its_query():
    names = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert names == set(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages_in_turn_match_brute_force(spark, make_docs, small_dir, tmp_path):
    """Each stage on all that the one before kept, against a plain version."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        out = stage(spark, docs, small_dir)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            assert after.columns == docs.columns
        ids = sorted(r.doc_id for r in after.collect())
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
            clean = [i for i, y in labels.items() if not y]
            assert len(set(ids) & set(clean)) >= 0.95 * len(clean)
        elif name == "exact_dedup":
            assert ids == [r[0] for r in exact(before) if r[3]]
        elif name == "minhash":
            assert ids == [r[0] for r in near(before, 5, 80) if r[3]]
        elif name == "source_mix":
            words = {r[0]: len((r[1] or "").split()) for r in before}
            assert set(ids) <= set(words) and max(ids.count(i) for i in set(ids)) <= 3
            assert abs(sum(words[i] for i in ids) - sum(words.values())) <= 20 * max(words.values())
        else:
            path, pattern = tokenizer()
            ranks = {e: i for i, e in enumerate(byte_bpe.read_ranks(path))}
            library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            want = sorted((i, hashlib.sha256(np.array(library.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest())
                          for i, t, _ in before)
            assert sorted((r.doc_id, r.ids_sha256) for r in after.collect()) == want
        kept[name] = ids
        docs = after
    assert sorted(r.doc_id for r in P.run(spark, small_dir).collect()) == kept["byte_bpe"]


def test_odd_tables_pass_through_every_stage(spark, make_docs, small_dir, tmp_path):
    rows = [(1, None, None), (1, None, None), (2, "", "a"), (None, "words of a text without id", "b"), (4, "x" * 100_000, "a"),
            (5, "same text here", "a"), (5, "same text here", "a"), (6, "Same text here", None)]
    for k, docs in enumerate((make_docs(rows, extra=True), make_docs([], extra=True))):
        for name, stage in P.STAGES:
            out = stage(spark, docs, small_dir)
            assert name == "byte_bpe" or out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{k}-{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{k}-{name}"))
        assert docs.count() <= 3 * len(rows) and (k == 0) == (docs.count() > 0)
