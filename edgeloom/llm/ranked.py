"""Ranked lexical search with the roles reversed: the items' terms are the index, documents stream through it.

An inverted index from terms to the items that hold them goes to every task. Each document is reduced to its counts of
those terms once; the second pass streams the counts through the index and keeps a bounded heap of
best documents for each item. Heaps are merged in two steps. Items come in blocks whose index has a
bounded number of postings.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import written

BEST = 10
POSTINGS = 1_000_000  # of one block of items: about 30 MB in a task
CELLS = 1 << 20  # scores that are summed at once: documents times items
MERGE_TASKS = 64  # tasks whose heaps are merged in the first step

# With bytes: no character of a longer UTF-8 sequence has a byte below 0x80.
_TERMS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: bytes | None) -> list[bytes]:
    return _TERMS.findall((text or b"").lower())


class ItemIndex:
    """Postings of one block of items: by term, the items that hold it and how often."""

    def __init__(self, texts: list[list[bytes]]):
        """``texts`` holds the texts of each item."""
        held = [Counter(t for text in item for t in terms_of(text)) for item in texts]
        self.items = len(held)
        self.numbers = {t: i for i, t in enumerate(sorted(set().union(*held)))}
        lists: list[list[tuple[int, int]]] = [[] for _ in self.numbers]
        for item, counts in enumerate(held):
            for term, times in counts.items():
                lists[self.numbers[term]].append((item, times))
        self.postings = [np.array(x, np.int64).T for x in lists]

    def counts(self, text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        """The number of terms of a text, and which terms of the index it has how often."""
        terms = terms_of(text)
        own = [(self.numbers[t], n) for t, n in Counter(terms).items() if t in self.numbers]
        both = np.array(own, np.int32).reshape(-1, 2)
        return len(terms), both[:, 0], both[:, 1]


def term_counts(docs: DataFrame, index) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of the documents that have any term; ``index`` is a broadcast ``ItemIndex``."""
    def count(batches):
        held = index.value
        for batch in batches:
            rows = [held.counts(t.as_py()) for t in batch.column(1)]
            some = [r[0] > 0 for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1].astype("<i4").tobytes() for r in rows], pa.binary()),
                 pa.array([r[2].astype("<i4").tobytes() for r in rows], pa.binary())],
                ["doc_id", "n", "terms", "tfs"]).filter(pa.array(some))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        count, f"doc_id {kind}, n bigint, terms binary, tfs binary")


def _flat(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and how many each row has."""
    lists = [np.frombuffer(x.as_py(), "<i4") for x in batch.column(column)]
    return np.concatenate(lists).astype(np.int64), np.array([len(x) for x in lists])


def document_counts(counted: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each of ``terms`` terms is."""
    def count(batches):
        total = np.zeros(terms, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_flat(batch, 0)[0], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    found = np.zeros(terms, np.int64)
    for r in counted.select("terms").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df")).collect():
        found[r[0]] = r[1]  # a row for each term of the block
    return found


class Heaps:
    """The best documents of each item so far: highest score first, smallest id among equals, null ids last."""

    def __init__(self, items: int, best: int):
        self.best, self.heaps = best, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # the score that a document needs

    def add(self, ids: list, scores: np.ndarray) -> None:
        """``scores`` has a row for each of ``ids`` and a column for each item."""
        for item in np.flatnonzero((scores >= self.least).any(axis=0)):
            heap, column = self.heaps[item], scores[:, item]
            rows = np.flatnonzero(column >= self.least[item])
            if len(rows) > self.best:
                rows = rows[column[rows] >= np.partition(column[rows], -self.best)[-self.best]]
            for row in rows:
                entry = (int(column[row]), ids[row] is not None, -(ids[row] or 0), ids[row])
                if len(heap) < self.best:
                    heapq.heappush(heap, entry)
                elif entry[:3] > heap[0][:3]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.best:
                self.least[item] = heap[0][0]

    def rows(self) -> list[tuple]:
        return [(item, entry[3], entry[0]) for item, heap in enumerate(self.heaps) for entry in heap]


def block_scores(postings, items: int, weights: np.ndarray, rows: np.ndarray, terms: np.ndarray, gains: np.ndarray,
                 documents: int) -> np.ndarray:
    """Scores of ``documents`` by ``items``: the gain of each (row, term) goes to the items of that term."""
    scores = np.zeros((documents, items), np.int64)
    order = np.argsort(terms, kind="stable")
    numbers, starts = np.unique(terms[order], return_index=True)
    for term, own in zip(numbers, np.split(order, starts[1:])):
        held, times = postings[term]
        scores[rows[own][:, None], held] += (weights[term] * gains[own])[:, None] * times
    return scores


def _best_of_tasks(counted: DataFrame, index, weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """``(item, doc_id, score)``: the heaps of each task."""
    def search(batches):
        held = index.value
        heaps = Heaps(held.items, best)
        step = max(1, CELLS // held.items)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                terms, lengths = _flat(batch, 2)
                tf = _flat(batch, 3)[0]
                # Python's numbers: the product may pass 64 bits
                m = np.array([25 + 75 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], np.int64)
                rows = np.repeat(np.arange(batch.num_rows), lengths)
                gains = 1_000_000_000 * tf // (1000 * tf + 8 * m[rows])
                heaps.add(batch.column(0).to_pylist(),
                          block_scores(held.postings, held.items, weights, rows, terms, gains, batch.num_rows))
        found = heaps.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in found], pa.int32()), pa.array([r[1] for r in found], kind),
             pa.array([r[2] for r in found], pa.int64())], ["item", "doc_id", "score"])

    kind = pa.int32() if counted.schema["doc_id"].dataType.simpleString() == "int" else pa.int64()
    return counted.mapInArrow(search, f"item int, doc_id {counted.schema['doc_id'].dataType.simpleString()}, score bigint")


def merged(heaps: DataFrame, best: int) -> DataFrame:
    """``(item, rank, doc_id, score)``: heaps of neighbouring tasks are merged first, then those."""
    rank = "row_number() OVER (PARTITION BY {} ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank"
    some = heaps.withColumn("tasks", F.expr(f"spark_partition_id() div {MERGE_TASKS}"))
    some = some.selectExpr("*", rank.format("item, tasks")).where(f"rank <= {best}").drop("rank", "tasks")
    return some.selectExpr("*", rank.format("item")).where(f"rank <= {best}").select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, postings: int = POSTINGS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``best`` documents of ``docs(doc_id, text)`` for each of ``items(item_id, text)``.

    Terms are runs of digits, letters A-Z in any case and characters beyond ASCII. Each row of ``docs`` is a document, also
    where ids, which are whole numbers, are null or repeated. Rows of ``items`` with one id are one item with the
    terms of all of its different texts; a null id is an item as well. Null and empty texts have no terms; a document or
    item without terms is in no result. Equal scores go by id, a null id last. ``postings`` bounds the index of one
    block of items, each of which reads the documents; it changes no result.
    """
    each = written(items.selectExpr("item_id", "coalesce(text, '') AS text").distinct()
                   .groupBy("item_id").agg(F.sort_array(F.collect_list("text")).alias("texts")), "items")
    # a term has a character and another one before the next
    size = each.selectExpr("aggregate(texts, 0L, (n, t) -> n + octet_length(t) div 2 + 1) AS n").agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-size // postings))
    block_of = f"CAST(pmod(xxhash64(item_id, 'block'), {blocks}) AS int)"
    found = [_search_block(docs, each.where(f"{block_of} = {b}"), best) for b in range(blocks)]
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result


def _search_block(docs: DataFrame, items: DataFrame, best: int) -> DataFrame:
    spark = docs.sparkSession
    rows = items.orderBy(F.xxhash64("item_id")).collect()  # bounded by the number of postings
    held = ItemIndex([[t.encode() for t in r.texts] for r in rows])
    index = spark.sparkContext.broadcast(held)
    counted = written(term_counts(docs, index), "term-counts")
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    at = document_counts(counted, len(held.numbers))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in at.tolist()], np.int64)
    heaps = _best_of_tasks(counted, index, weights, n_docs, n_terms, best)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)],
                                  f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return merged(heaps, best).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


_RUNS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS t FROM documents),
s AS (SELECT r, doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM s),
c AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM s) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM c, g GROUP BY term),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_RUNS}) AS term FROM benchmark) GROUP BY item_id, term),
x AS (SELECT item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN c USING (term) JOIN s USING (r), g GROUP BY item_id, r),
y AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM x JOIN s USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM y WHERE rank <= 10"""
