"""Removing lines that many documents have, by a sharded minimal perfect hash over digests of lines.

Digests of the distinct lines of each document are counted; those of enough documents are indexed. A shard of
the index is a minimal perfect hash in levels of bits, an array of fingerprints, by which lines that are not in it are
told apart, and an array of counts. Every task holds the shards of the most frequent lines, of which there are
a bounded number, and looks its documents' lines up there. Where more lines are common than that, digests of the lines not found are sent
to the shards of the others, and what they hit is sent back to the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.jaccard import mix64
from edgeloom.llm.tables import written

AT_LEAST = 10
SHARD_KEYS = 1 << 16
NEAR_KEYS = 1 << 21  # lines that every task holds: some 13 bytes each, 27 MB

_BLANKS = b" \t\n\x0b\x0c\r"
_LEVEL = 0x9E3779B97F4A7C15
_INDEX = "shard int, sizes binary, bits binary, prints binary, counts binary"


def keys_of(text: bytes, min_chars: int) -> list[bytes]:
    """The keys of the lines of a text: stripped, A-Z in lower case; empty for lines of fewer than ``min_chars`` characters."""
    keys = [line.strip(_BLANKS) for line in text.lower().split(b"\n")]
    if min_chars <= 1:
        return keys
    return [k if len(k) >= 4 * min_chars or len(k.decode(errors="replace")) >= min_chars else b"" for k in keys]


def digests(keys) -> np.ndarray:
    """Two 64-bit numbers for each key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)


def line_counts(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """``(a, b, n)``: digests of keys of lines, and in how many rows of ``docs(text)`` each occurs."""
    def count(batches):
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in batch.column(0):
                for key in set(keys_of(text.as_py() or b"", min_chars)):
                    seen[key] = seen.get(key, 0) + 1
            seen.pop(b"", None)
            pairs = digests(seen).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(list(seen.values()), pa.int64())], ["a", "b", "n"])

    found = docs.select(F.col("text").cast("binary")).mapInArrow(count, "a bigint, b bigint, n bigint")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix64(a ^ mix64(b + np.uint64((level + 1) * _LEVEL % (1 << 64)))) % np.uint64(size)


def build_shard(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """``(sizes, bits, prints, counts)`` of distinct pairs: in each level, the keys that are alone in their place stay,
    the others go to the next. A key's number is that of the bits set before its own."""
    sizes, bits, order = [], [], []
    left = np.arange(len(a))
    while len(left):
        size = max(64, -(-2 * len(left) // 64) * 64)
        place = _places(a[left], b[left], len(sizes), size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        stays = alone[place]
        order.append(left[stays][np.argsort(place[stays])])
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little").tobytes())
        left = left[~stays]
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    counts = np.minimum(n[order], np.iinfo(np.uint32).max).astype("<u4")
    return np.array(sizes, "<u4").tobytes(), b"".join(bits), b[order].astype("<u8").tobytes(), counts.tobytes()


class Shard:
    """One shard of the index, ready to be probed."""

    def __init__(self, sizes: bytes, bits: bytes, prints: bytes, counts: bytes):
        self.sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        self.words = np.frombuffer(bits, "<u8")
        ones = np.bitwise_count(self.words).astype(np.uint32)
        self.before = np.cumsum(ones, dtype=np.uint32) - ones
        self.prints, self.counts = np.frombuffer(prints, "<u8"), np.frombuffer(counts, "<u4")

    def documents(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many documents each key is; 0 for keys that are not in the shard."""
        found = np.zeros(len(a), np.uint32)
        left, start = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            place = _places(a[left], b[left], level, size) + np.uint64(start)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            here = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            number = self.before[word[here]] + np.bitwise_count(below)
            member = self.prints[number] == b[left[here]]
            found[left[here]] = np.where(member, self.counts[number], 0)
            left, start = left[~here], start + size
            if not len(left):
                break
        return found


def shard_of(a, shards: int):
    return (a >> np.uint64(20)) % np.uint64(shards)


def probe(index: dict[int, Shard], shards: int, pairs: np.ndarray) -> np.ndarray:
    """In how many documents each of ``pairs`` is, as far as ``index`` has it."""
    found = np.zeros(len(pairs), np.uint32)
    if not index:
        return found
    shard = shard_of(pairs[:, 0], shards).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    for number, rows in zip(numbers, np.split(order, starts[1:])):
        if number in index:
            found[rows] = index[number].documents(pairs[rows, 0], pairs[rows, 1])
    return found


def line_index(keys: DataFrame, shards: int) -> DataFrame:
    """``(shard, sizes, bits, prints, counts)`` of ``keys(a, b, n)``."""
    def build(table: pa.Table) -> pa.Table:
        a, b = (table.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
        parts = build_shard(a, b, table.column("n").to_numpy())
        return pa.table([table.column("shard").slice(0, 1), *(pa.array([p], pa.binary()) for p in parts)],
                        ["shard", "sizes", "bits", "prints", "counts"])

    shard = F.expr(f"CAST(shiftrightunsigned(a, 20) % {shards} AS int) AS shard")
    return keys.select(shard, "a", "b", "n").groupBy("shard").applyInArrow(build, _INDEX)


def loaded(rows) -> dict[int, Shard]:
    return {r[0]: Shard(*map(bytes, r[1:])) for r in rows}


def _near_count(keys: DataFrame, near_keys: int) -> int:
    """The power of two such that at most ``near_keys`` of ``keys`` have at least so many documents."""
    classes = dict(keys.groupBy(F.expr("CAST(floor(log2(n)) AS int)")).count().collect())  # 63 rows at most
    total, least = 0, 64
    for c in range(63, -1, -1):
        total += classes.get(c, 0)
        if total > near_keys:
            break
        least = c
    return 1 << least if least < 63 else (1 << 63) - 1


def _shards(keys: DataFrame, shard_keys: int) -> int:
    return max(1, -(-keys.count() // shard_keys))


def drop_common_lines(docs: DataFrame, at_least: int = AT_LEAST, min_chars: int = 1, near_keys: int = NEAR_KEYS,
                      shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``(doc_id, text, n_lines, n_dropped)`` for ``docs(doc_id, text)``: texts without their common lines.

    A line is common if its key, the line without blanks at both ends and with A-Z in lower case, has at least ``min_chars``
    characters and occurs in at least ``at_least`` documents. Each row is a document, also where ids are null or repeated; how often
    a document has a line does not matter. A null or empty text is one empty line. ``near_keys`` and ``shard_keys`` lay out the work
    and change no result.
    """
    keys = written(line_counts(docs, min_chars).where(F.col("n") >= at_least), "line-keys")
    least = _near_count(keys, near_keys)
    near, far = keys.where(F.col("n") >= least), keys.where(F.col("n") < least)
    near_shards, far_shards = _shards(near, shard_keys), _shards(far, shard_keys)
    held = docs.sparkSession.sparkContext.broadcast(
        [tuple(r) for r in line_index(near, near_shards).collect()])  # near_keys lines at most

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    if far.isEmpty():
        dropped = _drop(texts, held, near_shards, at_least, min_chars)
    else:
        texts = written(texts.withColumn("place", F.monotonically_increasing_id()), "line-texts")
        hits = _far_hits(_misses(texts, held, near_shards, min_chars), line_index(far, far_shards), far_shards, at_least)
        lists = hits.groupBy("place").agg(F.collect_list(F.struct("a", "b")).alias("hits"))
        dropped = _drop(texts.join(lists, "place", "left").select("doc_id", "text", "hits"),
                        held, near_shards, at_least, min_chars)
    return dropped.selectExpr("doc_id", "CAST(kept AS string) AS text", "n_lines", "n_dropped")


def _drop(texts: DataFrame, held, shards: int, at_least: int, min_chars: int) -> DataFrame:
    """``texts(doc_id, text)`` without lines that the held shards or their own ``hits``, if they have any, call common."""
    def drop(batches):
        index = loaded(held.value)
        for batch in batches:
            own = batch.column(2) if batch.num_columns > 2 else None
            kept, n_lines, n_dropped = [], [], []
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or b""
                keys = keys_of(text, min_chars)
                pairs = digests(keys)
                common = probe(index, shards, pairs) >= at_least
                if own is not None and own[i].is_valid:
                    far = {(h["a"], h["b"]) for h in own[i].as_py()}
                    common |= np.array([p in far for p in map(tuple, pairs.view(np.int64).tolist())])
                common &= np.array([bool(k) for k in keys])
                n_lines.append(len(keys))
                n_dropped.append(int(common.sum()))
                kept.append(b"\n".join(x for x, c in zip(text.split(b"\n"), common) if not c) if n_dropped[-1] else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                ["doc_id", "kept", "n_lines", "n_dropped"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(drop, f"doc_id {kind}, kept binary, n_lines bigint, n_dropped bigint")


def _misses(texts: DataFrame, held, shards: int, min_chars: int) -> DataFrame:
    """``(a, b, place)``: the distinct keys of each text that the held shards do not have."""
    def emit(batches):
        index = loaded(held.value)
        for batch in batches:
            for text, place in zip(batch.column(0), batch.column(1)):
                pairs = digests({k for k in keys_of(text.as_py() or b"", min_chars) if k})
                pairs = pairs[probe(index, shards, pairs) == 0].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.full(len(pairs), place.as_py(), np.int64))],
                    ["a", "b", "place"])

    return texts.select("text", "place").mapInArrow(emit, "a bigint, b bigint, place bigint")


def _far_hits(misses: DataFrame, index: DataFrame, shards: int, at_least: int) -> DataFrame:
    """``(a, b, place)`` of the misses that are in ``index``: each shard comes before the lines that are looked up in it."""
    def look_up(batches):
        current, number = None, None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            bounds = np.flatnonzero(np.diff(shard)) + 1
            for start, end in zip([0, *bounds], [*bounds, len(shard)]):
                rows = batch.slice(start, end - start)
                if shard[start] != number:
                    current, number = None, shard[start]
                if rows.column(5)[0].is_valid:
                    current = Shard(*(rows.column(c)[0].as_py() for c in range(4, 8)))
                    rows = rows.slice(1)
                if current is not None and rows.num_rows:
                    a, b = (rows.column(c).to_numpy().view(np.uint64) for c in (1, 2))
                    yield rows.filter(pa.array(current.documents(a, b) >= at_least)).select([1, 2, 3])

    asked = misses.selectExpr(f"CAST(shiftrightunsigned(a, 20) % {shards} AS int) AS shard", "a", "b", "place",
                              *(f"CAST(NULL AS binary) AS {c}" for c in ("sizes", "bits", "prints", "counts")))
    held = index.selectExpr("shard", "0L AS a", "0L AS b", "-1L AS place", "sizes", "bits", "prints", "counts")
    rows = held.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "place")
    return rows.mapInArrow(look_up, "a bigint, b bigint, place bigint")


LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common c ON k.key = c.key GROUP BY r"""
