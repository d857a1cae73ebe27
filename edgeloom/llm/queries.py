"""The queries of the operators, each over its whole table, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm import jaccard, lines, lm, mixing, packing, phrases, qda, ranked, rules, suffix, tokens, topk, warc
from edgeloom.plans import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BUCKET = "crc32(CAST(CAST(doc_id AS string) AS binary)) % {n}"


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SHA-1 in base 32 is 32 letters, five bits each, out of 40 hexadecimal digits.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS digest FROM p),
ranked AS (SELECT *, max(page_id) OVER (PARTITION BY digest, payload_bytes) AS kept FROM hashed)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         ((CAST('0x' || substr(digest, CAST(i * 5 // 4 + 1 AS BIGINT), 2) AS BIGINT) >> CAST(3 - i * 5 % 4 AS BIGINT)) & 31) + 1
         AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       IF(page_id = kept, 'response', 'revisit') AS record_type, IF(page_id = kept, NULL, kept) AS refers_to
FROM ranked"""


@query("op1_warc_bundles", WARC_SQL)
def op1_warc_bundles(spark, d):
    folder = scratch_path(spark, "warc")
    index = warc.write_bundles(table(spark, d, "pages"), folder)
    return warc.read_bundles(index, folder).drop("html")


@query("op2_quality_rules")
def op2_quality_rules(spark, d):
    docs = table(spark, d, "documents")
    judged = rules.apply_rules(docs, rules.fit_rules(docs, table(spark, d, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op3_top_k_search", TOP_SQL)
def op3_top_k_search(spark, d):
    return topk.top_k(table(spark, d, "embeddings"), "vec_id % 50 = 0", k=5)


@query("op4_mix_sources", mixing.MIX_SQL)
def op4_mix_sources(spark, d):
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_similar_documents")
def op6_similar_documents(spark, d):
    return jaccard.similar_documents(table(spark, d, "documents"), words=4, percent=85)


@query("op7_quality_classifier")
def op7_quality_classifier(spark, d):
    held_out = f"coalesce({BUCKET.format(n=4)} = 2, false)"
    scored = qda.quality_scores(table(spark, d, "documents"), table(spark, d, "labels"), f"NOT {held_out}")
    return scored.select("doc_id", F.expr(held_out).alias("held_out"), "score",
                         F.expr("IF(score >= 0.7D, 1, 0)").alias("predicted"))


@query("op5_token_counts")
def op5_token_counts(spark, d):
    # an earlier run has counted a tenth of the documents, so that this one has hits and misses
    docs, cache = table(spark, d, "documents"), scratch_path(spark, "token-cache")
    tokens.token_counts(docs.where("pmod(xxhash64(doc_id), 10) = 0"), tokenizer_path(), cache)
    counted = tokens.token_counts(docs, tokenizer_path(), cache)
    return counted.withColumn("over_limit", F.expr("n_tokens > 1024"))


@query("op8_pack_sequences")
def op8_pack_sequences(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer_path())


@query("op9_remove_repeats")
def op9_remove_repeats(spark, d):
    return suffix.remove_repeats(table(spark, d, "documents"))


@query("op10_suffix_tree_scores")
def op10_suffix_tree_scores(spark, d):
    held_out = f"coalesce({BUCKET.format(n=10)} = 0, false)"
    scored = lm.score_texts(table(spark, d, "documents"), f"NOT {held_out}")
    return scored.select("doc_id", F.expr(held_out).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                         "score")


@query("op11_phrase_collocations", phrases.PHRASES_SQL)
def op11_phrase_collocations(spark, d):
    found = phrases.collocations(table(spark, d, "documents"))
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query("op12_ranked_search", ranked.SEARCH_SQL)
def op12_ranked_search(spark, d):
    return ranked.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op13_common_lines", lines.LINES_SQL)
def op13_common_lines(spark, d):
    dropped = lines.drop_common_lines(table(spark, d, "documents"))
    return dropped.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(CAST(text AS binary), 256) AS kept_sha256")
