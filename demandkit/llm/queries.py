"""One registered query per operator, with production parameters over whole
tables, and the DuckDB form of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, conversations, embeddings, exact_dedup, line_templates, minhash, mixing, quality, secrets, sql, suffix_dedup, token_alignment, toxicity, url_filter
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path and pre-token pattern of the installed public vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(documents(spark, sf_dir))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(documents(spark, sf_dir), width=3, similarity=0.85)


def op3_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.score(docs, model, 0.0 if model else quality.prevalence(labels))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.clean(documents(spark, sf_dir)).drop("text")


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir), *tokenizer())


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


#: The policy of the query (fixed values).
URL_RULES = (url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json")[0], tokenizer("piece_bpe_32k.model")[0])


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_summary(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_exact_dedup, op2_minhash, op3_quality_mil, op4_suffix_dedup, op5_line_templates, op6_toxic_segments, op7_source_mix, op8_embedding_tiles,
    op9_byte_bpe, op10_secret_scan, op11_url_filter, op12_token_alignment, op13_conversation_repair)}

# A-Z alone go to lower case, as in the operator.
_NORM = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

ORACLES: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t""",
    "op8_embedding_tiles": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id
                  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
        reach(n, r) AS (SELECT vec_id, vec_id FROM embeddings
                        UNION SELECT reach.n, links.v FROM reach JOIN links ON reach.r = links.u)
        SELECT e.vec_id, coalesce(l.n, 0) AS n_links, c.r AS component_id, e.vec_id = c.r AS kept
        FROM embeddings e
        LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) l ON e.vec_id = l.u
        JOIN (SELECT n, min(r) AS r FROM reach GROUP BY n) c ON e.vec_id = c.n""",
    "op11_url_filter": sql.url_filter(URL_RULES, url_filter.DAMPING, url_filter.STEPS, url_filter.BLOCK_SHARE),
    "op13_conversation_repair": sql.conversation_repair(),
}
