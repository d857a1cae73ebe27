"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are dealt into shards. In a shard, each dimension has its postings in the order of their
value, cut into segments of equal quantised impact. A query goes through the segments of all
dimensions from large to small contributions, level by level. After a level, what a vector has gained
and what it can still gain bound its score; once few vectors are left whose bound reaches the query's
k-th best, or all segments are through, those are scored exactly. Everything else is out by proof.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import written

SHARD_ROWS = 4096
BLOCK_ROWS = 256  # queries that go through a shard together
BLOCKS_PER_TASK = 64  # before a shard is given to another task as well
IMPACT_STEP = 8  # values of one segment
# Contributions down to which segments are read, level by level, in units of their root mean square.
LEVELS = (0.0, -0.25, -0.5, -1.0)
FEW = 0.25  # share of a shard that is scored exactly rather than bounded by another level
LARGEST = 2**62  # of the sum of squares of a vector

SCALE = 256


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: float = SCALE) -> DataFrame:
    """``(vec_id, v)`` with ``v = floor(scale * x)``; vectors null or holding null or non-finite values are left out.

    A vector whose squares add up to ``LARGEST`` or more is an error that names it: below that no score, nor any sum on
    the way to it, leaves 64 bits.
    """
    return vectors.selectExpr(f"`{id_column}` AS vec_id", f"CAST(`{vector_column}` AS array<double>) AS v").where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    ).selectExpr("vec_id", f"transform(v, x -> floor({scale}D * x)) AS v",
                 f"aggregate(v, 0D, (s, x) -> s + pow(CAST(floor({scale}D * x) AS double), 2)) AS squares").selectExpr(
        "vec_id", f"""transform(IF(squares < {LARGEST}D, v, raise_error(concat(
            'scores of vector ', vec_id, ' are beyond 64 bits'))), x -> CAST(x AS int)) AS v""")


def _matrix(rows: list[list[int]], width: int) -> np.ndarray:
    """Rows as a matrix; shorter vectors end in zeros."""
    out = np.zeros((len(rows), width), np.int32)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _packed(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """``(key, ids, matrix)``: the rows of a group in one, as bytes. Groups are bounded by their number."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        matrix = _matrix(table.column("v").to_pylist(), dims)
        return pa.table({key: table.column(key)[:1], "ids": pa.array([ids.tobytes()]), "matrix": pa.array([matrix.tobytes()])})

    return rows.groupBy(key).applyInArrow(pack, f"{key} bigint, ids binary, matrix binary")


class Shard:
    """The impact-ordered index of some vectors."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix.astype(np.int64)
        by_dim = self.matrix.T
        self.order = np.argsort(by_dim, axis=1, kind="stable")
        self.values = np.take_along_axis(by_dim, self.order, 1)
        impacts = self.values // IMPACT_STEP
        self.values = self.values.astype(float)
        # where each segment starts, and its smallest and largest value
        self.starts = [np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) for row in impacts]
        self.ends = [np.concatenate([s[1:], [len(ids)]]) for s in self.starts]
        self.low = [v[s] for v, s in zip(self.values, self.starts)]
        self.high = [v[e - 1] for v, e in zip(self.values, self.ends)]

    def _reach(self, dim: int, weight: int, level: float) -> int:
        """How many postings of a dimension are in segments that may contribute ``level`` or more."""
        if weight > 0:  # from the large end
            k = int(np.searchsorted(weight * self.high[dim], level, side="left"))
            return len(self.ids) - int(self.starts[dim][k]) if k < len(self.starts[dim]) else 0
        # contributions fall from the small end
        k = int(np.searchsorted(-weight * self.low[dim], -level, side="right"))
        return int(self.ends[dim][k - 1]) if k else 0

    def top(self, query: np.ndarray, own_id: int, k: int, floor: float) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, vec_id)`` besides ``own_id``, as far as they may reach ``floor``."""
        query = query.astype(np.int64)
        weights = [(d, int(w)) for d, w in enumerate(query) if w]
        n = len(self.ids)
        bound, before, read = np.zeros(n), None, np.empty(0, np.int64)
        done = dict.fromkeys(range(len(query)), 0)
        unit = float(np.sqrt((query**2).mean() * (self.matrix.astype(float)**2).mean())) or 1.0
        others = np.flatnonzero(self.ids != own_id)
        possible = others
        for at in LEVELS:
            if len(possible) <= max(FEW * n, k):
                break
            level = at * unit
            slices, parts = [], []
            for d, w in weights:
                reach = self._reach(d, w, level)
                if reach > done[d]:
                    cut = slice(n - reach, n - done[d]) if w > 0 else slice(done[d], reach)
                    slices.append(self.order[d, cut])
                    parts.append(w * self.values[d, cut])
                    done[d] = reach
            # the bound takes the level for each posting that was not read, which contributes less
            if before is None:
                bound += len(weights) * level
            else:  # lower the level for what is still not read
                bound += (len(weights) - np.bincount(read, minlength=n)) * (level - before)
            if slices:
                each = np.concatenate(slices)
                bound += np.bincount(each, np.concatenate(parts) - level, n)
                read = np.concatenate([read, each])
            before = level
            # a k-th best among the most promising is a floor for all
            best = others[np.argpartition(-bound[others], min(4 * k, len(others) - 1))[:4 * k]]
            scores = self.matrix[best] @ query
            if len(scores) >= k:
                floor = max(floor, float(np.partition(scores, len(scores) - k)[len(scores) - k]))
            slack = 1 + 1e-9 * abs(floor)  # of sums in floating point
            possible = others[bound[others] >= floor - slack]
        scores = self.matrix[possible] @ query
        kept = np.lexsort((self.ids[possible], -scores))[:k]
        return [(int(scores[i]), int(self.ids[possible[i]])) for i in kept]


def top_k(vectors: DataFrame, queries: str, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
          scale: float = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each query, ties to the smaller id.

    ``queries`` is a condition on ``vec_id``. A query does not meet its own id; with fewer other vectors it
    has fewer rows. Repeated rows count once; vectors of unlike length are compared over the shorter one.
    Vectors that are null or hold a null or non-finite value take no part; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    whole = written(quantised(vectors, id_column, vector_column, scale).distinct(), "vectors")
    counts = whole.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if(F.expr(queries))).first()
    rows, dims, asked = int(counts[0]), int(counts[1]), int(counts[2])
    shards, blocks = max(1, -(-rows // shard_rows)), max(1, -(-asked // block_rows))
    groups = -(-blocks // BLOCKS_PER_TASK)
    index = written(_packed(whole.withColumn("shard", F.expr(f"pmod(xxhash64(vec_id, v), {shards})")), "shard", dims), "shards")
    asked_blocks = _packed(whole.where(queries).withColumn(
        "block", F.expr(f"pmod(xxhash64(v, vec_id), {blocks})")), "block", dims)
    # every block meets every shard; a shard is repeated for each group of blocks
    left = index.selectExpr("shard", "ids", "matrix", f"explode(sequence(0L, {groups - 1}L)) AS part")
    right = asked_blocks.selectExpr("block", "ids AS query_ids", "matrix AS query_matrix",
                                    f"block % {groups} AS part", f"explode(sequence(0L, {shards - 1}L)) AS shard")
    pairs = left.join(right.hint("merge"), ["shard", "part"])

    def search(batches):
        last, shard = None, None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["shard"] != last:
                    ids = np.frombuffer(row["ids"], np.int64)
                    last, shard = row["shard"], Shard(ids, np.frombuffer(row["matrix"], np.int32).reshape(len(ids), dims))
                asked = np.frombuffer(row["query_ids"], np.int64)
                for own_id, query in zip(asked, np.frombuffer(row["query_matrix"], np.int32).reshape(len(asked), dims)):
                    found += [(int(own_id), vec_id, score) for score, vec_id in shard.top(query, int(own_id), k, -np.inf)]
            table = np.array(found, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint").distinct()
    return found.selectExpr(
        "query_id", "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS int) AS rank", "vec_id", "score",
    ).where(F.col("rank") <= k)
