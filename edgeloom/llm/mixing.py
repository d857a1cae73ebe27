"""Mixing sources to target weights: Efraimidis-Spirakis sampling with prefix sums to a word budget.

A document gets the key ``-ln(u) / weight`` with ``u`` drawn from a hash of its id, so that reruns agree.
A source's target is spent on complete epochs first; the rest goes to documents in the order of
their keys, as far as it reaches. Prefix sums are made in buckets of keys, of which there are as
many as the table asks for, so that no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.plans import stage

BUCKET_ROWS = 2_000
MAX_REPEATS = 3

WORD_COUNT = "CAST(regexp_count(coalesce(text, ''), '[^\\\\x20\\\\x09-\\\\x0D]+') AS bigint)"
# Share of characters that are no decoration: junk is drawn later.
QUALITY_WEIGHT = ("0.05D + 0.95D * coalesce(CAST(length(translate(text, '#*$%&|<>!', '')) AS double)"
                  " / greatest(length(text), 1), 1.0D)")


def source_targets(sources: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources(source, source_size)`` with ``weight``, ``target``: shares of all sizes by weight.

    Sources weigh 1, 2, 3, 1, ... by code point, null last. A target stops at ``max_repeats`` times the
    size of its source; what is left over goes to the others by weight. Filling up in the order of
    cap / weight settles this in one pass.
    """
    return sources.sparkSession.sql(f"""
        WITH weighed AS (
          SELECT source, source_size, {max_repeats} * source_size AS cap,
                 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight
          FROM {{sources}}),
        filled AS (
          SELECT *, sum(source_size) OVER () AS total,
                 sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, weight, source
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
                 sum(weight) OVER (ORDER BY cap / weight DESC, weight DESC, source DESC) AS open_weight
          FROM weighed),
        full AS (SELECT *, cap <= weight * (left_over / open_weight) AS capped FROM filled)
        SELECT source, source_size, weight,
               CASE WHEN capped THEN CAST(cap AS double)
                    ELSE weight * ((total - sum(IF(capped, cap, 0)) OVER ())
                                   / sum(IF(capped, 0, weight)) OVER ()) END AS target
        FROM full""", sources=sources)


def mix(docs: DataFrame, size: str = WORD_COUNT, weight: str = QUALITY_WEIGHT, seed: int = 0,
        bucket_rows: int = BUCKET_ROWS, with_row: bool = False) -> DataFrame:
    """``(doc_id, source, size, source_size, target, key, times, taken)`` for ``docs(doc_id, text, source)``.

    ``size`` and ``weight`` are SQL expressions over the columns of ``docs``. ``times`` is how often
    the mix has the document, ``taken`` that many times ``size``. The document on which a budget ends is taken if that
    comes nearer to it. Documents of size 0 take nothing and are in complete epochs only; rows repeated in full get the same key and
    follow one another; a null source is a source of its own. ``with_row`` adds all columns of ``docs`` as ``row``.
    """
    spark = docs.sparkSession
    # rows without an id draw by their text, lest a third of a table has one key
    own = "coalesce(CAST(doc_id AS string), concat('null', md5(coalesce(text, ''))))"
    u = (f"(CAST(conv(substr(md5(concat({own}, ':{seed}')), 1, 13), 16, 10)"
         " AS double) + 0.5D) / 4503599627370496D")
    keyed = stage(docs.selectExpr("doc_id", "source", f"{size} AS size", f"-ln({u}) / ({weight}) AS key", *["struct(*) AS row"] * with_row), "mix")
    buckets = max(1, -(-keyed.count() // bucket_rows))
    # 1 - exp(-key) rises with the key and is spread evenly enough between 0 and 1
    keyed = keyed.withColumn("bucket", F.expr(f"CAST(least({buckets - 1}, floor({buckets} * (1 - exp(-key)))) AS bigint)"))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    columns = "row," if with_row else ""
    return spark.sql("""
        WITH placed AS (
          SELECT s.source, bucket, source_size, target,
                 sum(bucket_size) OVER (PARTITION BY s.source ORDER BY bucket) - bucket_size AS before_bucket,
                 IF(source_size = 0, 0L, CAST(floor(target / source_size) AS bigint)) AS epochs
          FROM {sums} s JOIN {targets} t ON s.source <=> t.source),
        ordered AS (
          SELECT *, sum(size) OVER (PARTITION BY source, bucket ORDER BY key, doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before_doc
          FROM {keyed})
        SELECT *, size * times AS taken FROM (
          SELECT doc_id, o.source, size, source_size, target, key, """ + columns + """
                 epochs + IF(size > 0 AND before_bucket + before_doc + size / 2 <= target - epochs * source_size, 1L, 0L) AS times
          FROM ordered o JOIN placed p ON o.source <=> p.source AND o.bucket = p.bucket)""",
        sums=sums, targets=targets, keyed=keyed)


# The same mix for DuckDB: without buckets, a window per source.
MIX_SQL = r"""
WITH keyed AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null' || md5(coalesce(text, ''))) || ':0'), 1, 13) AS BIGINT) + 0.5)
             / 4503599627370496.0)
         / (0.05 + 0.95 * coalesce(CAST(length(translate(text, '#*$%&|<>!', '')) AS DOUBLE) / greatest(length(text), 1), 1)) AS key
  FROM documents),
weighed AS (
  SELECT source, source_size, 3 * source_size AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source)),
filled AS (
  SELECT *, sum(source_size) OVER () AS total,
         sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, weight, source
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER (ORDER BY cap / weight DESC, weight DESC, source DESC) AS open_weight
  FROM weighed),
capped AS (SELECT *, cap <= weight * (left_over / open_weight) AS capped FROM filled),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE)
         ELSE weight * ((total - sum(IF(capped, cap, 0)) OVER ()) / sum(IF(capped, 0, weight)) OVER ()) END AS target
  FROM capped),
ordered AS (
  SELECT doc_id, k.source, size, source_size, target,
         IF(source_size = 0, 0, CAST(floor(target / source_size) AS BIGINT)) AS epochs,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (epochs + IF(before + size / 2 <= target - epochs * source_size, 1, 0)) AS BIGINT) AS taken
FROM ordered"""
