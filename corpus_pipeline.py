"""From documents to packed training sequences: filter, deduplicate, mix, pack.

Each stage takes the documents that the one before has written and calls one operator on all of
them. Stages but the last give documents, with their columns and in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm import jaccard, mixing, packing, rules, suffix
from edgeloom.llm.queries import table, tokenizer_path
from edgeloom.llm.tables import written
from edgeloom.llm.textstats import SHARES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that repeat themselves or that a learned rule rejects.

    The fixed minimum of words is left out here: a short text is no bad one. The learned rules judge texts of any
    length, and the learner sees the number of words, so that it can spare clean short ones.
    """
    learned = rules.fit_rules(docs, table(spark, sf_dir, "labels"), names=[*SHARES, "n_words"])
    return rules.apply_rules(docs.select(*COLUMNS), learned, with_row=True).where(
        f"rule IS NULL AND NOT ({rules.REPETITIVE})").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id. Rows with a null id stay,
    repeated rows stay once."""
    groups = jaccard.similar_documents(docs, words=5, percent=80)
    others = groups.where("doc_id IS NOT NULL AND doc_id != component_id").select("doc_id").distinct()
    left = docs.select(*COLUMNS).join(others.hint("merge"), "doc_id", "left_anti")
    return left.withColumn("digest", F.xxhash64("text", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
                           ).dropDuplicates(["doc_id", "digest"]).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 50 bytes or more that a document with a smaller id has; characters that are cut
    go as a whole. A document that loses all of its text stays with an empty one."""
    cut = suffix.remove_repeats(docs.select(*COLUMNS), with_row=True, whole_chars=True)
    return cut.withColumn("text", F.expr("CAST(kept AS string)")).selectExpr(
        "row.doc_id AS doc_id", "text", "row.lang AS lang", "row.source AS source",
        "CAST(length(text) AS bigint) AS n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix has it, up to three times, or not at all."""
    mixed = mixing.mix(docs.select(*COLUMNS), with_row=True).where("times > 0")
    return mixed.selectExpr("row", "explode(sequence(1L, times)) AS copy").select("row.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``packing.pack`` of all copies."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]

# No stage but the mix can be said in SQL; the tests hold rules, near duplicates, passages and the mix against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
