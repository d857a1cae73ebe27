"""Best-fit packing of token sequences by a configuration linear program.

Documents are encoded once and cut into pieces; what the packing needs of them is a histogram over
at most ``capacity`` lengths. On it the driver solves the linear program over configurations
(multisets of lengths that fit into one sequence) by multiplicative weights, each column priced by
a knapsack. Whole parts of the solution are taken, the rest is filled largest length first. The result is a list
of slots per length, whose size follows from the capacity and not from the data. Pieces are
numbered within their length and find their slot by that number.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tokens import encoder, text_of
from edgeloom.plans import stage

CAPACITY = 2048
ROUNDS = 60  # of multiplicative weights
STEP = 0.15  # share of a length that one configuration may cover in a round
BUCKET_ROWS = 20_000


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the first takes what does not fill a sequence."""
    if total <= capacity:
        return [total]
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = 0,
              with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` for ``docs(doc_id, text)``.

    A document's ids are those of its text and then ``end``; so a null or empty text is one piece of length 1.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches):
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            at, rows, pieces = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(text_of(text)), end], "<u4")
                start = 0
                for k, length in enumerate(cut_lengths(len(ids), capacity)):
                    piece = ids[start:start + length]
                    at.append(i)
                    rows.append((k, start, length, zlib.crc32(piece.tobytes())))
                    if with_ids:
                        pieces.append(piece.astype(np.int64))
                    start += length
            k, start, length, crc = np.array(rows, np.int64).reshape(-1, 4).T
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(k.astype(np.int32)),
                      pa.array(start), pa.array(length), pa.array(crc)]
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(pieces, pa.list_(pa.int64()))] * with_ids, names)

    chosen = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    id_type = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(cut, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
                             + ", ids array<bigint>" * with_ids)


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for each capacity, and the index of a length in it (-1: none)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(lengths[0]), capacity + 1):
        fit = bisect_right(lengths, c)
        values = best[c - lengths[:fit]] + prices[:fit]
        k = int(values.argmax())
        if values[k] > best[c - 1]:
            best[c], choice[c] = values[k], k
        else:
            best[c], choice[c] = best[c - 1], -1
    return best, choice


def _configuration(choice: np.ndarray, lengths: np.ndarray, room: int) -> Counter:
    """Indices of the lengths that the knapsack puts into ``room``."""
    found: Counter = Counter()
    while room > 0:
        k = choice[room]
        if k < 0:
            room -= 1
        else:
            found[int(k)] += 1
            room -= int(lengths[k])
    return found


def solve_configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS,
                         step: float = STEP) -> list[tuple[tuple[tuple[int, int], ...], float]]:
    """A fractional cover: ``(configuration, how often)`` with configurations as ``(index, times)`` pairs.

    The weight of a length falls as it is covered. A round prices the best configuration
    around every length that is still open, and takes those near the best of all.
    """
    cover, uses = np.zeros(len(lengths)), Counter()
    for _ in range(rounds):
        if (cover >= 1).all():
            break
        prices = np.exp(-4 * cover) * lengths / capacity * (cover < 1)
        best, choice = _knapsack(lengths, prices, capacity)
        value = prices + best[capacity - lengths]
        for k in np.flatnonzero((cover < 1) & (value >= 0.8 * value.max())):
            if cover[k] >= 1:
                continue
            config = _configuration(choice, lengths, capacity - int(lengths[k]))
            config[int(k)] += 1
            amount = step * min(counts[j] / n for j, n in config.items())
            uses[tuple(sorted(config.items()))] += amount
            for j, n in config.items():
                cover[j] += amount * n / counts[j]
    return list(uses.items())


def _fill(lengths: list[int], left: list[int], room: int, below: int) -> Counter:
    """Indices up to ``below`` that fill ``room`` as far as it can be, larger lengths first."""
    items: list[tuple[int, int]] = []  # (index, copies as one item)
    reach, mask = 1, (1 << (room + 1)) - 1
    reached = [reach]
    for k in range(below, -1, -1):
        copies, size = min(left[k], room // lengths[k]), 1
        while copies > 0 and not reach >> room & 1:
            take = min(size, copies)
            items.append((k, take))
            reach |= reach << take * lengths[k] & mask
            reached.append(reach)
            copies, size = copies - take, size * 2
    found: Counter = Counter()
    at = reach.bit_length() - 1
    for i in range(len(items) - 1, -1, -1):
        if not reached[i] >> at & 1:
            k, take = items[i]
            found[k] += take
            at -= take * lengths[k]
    return found


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS):
    """``[({length: times}, repeats)]`` that use every piece of ``histogram`` exactly once."""
    found = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    lengths = np.array(sorted(k for k, n in histogram.items() if n and k < capacity), np.int64)
    if not len(lengths):
        return found
    left = [histogram[int(k)] for k in lengths]
    names = [int(k) for k in lengths]
    solution = solve_configurations(lengths, np.array(left, float), capacity, rounds)
    # fuller configurations first, so that over-covered lengths go to them
    solution.sort(key=lambda x: -sum(names[k] * n for k, n in x[0]))
    for config, amount in solution:
        repeats = min([int(amount + 1e-9), *(left[k] // n for k, n in config)])
        if repeats:
            found.append(({names[k]: n for k, n in config}, repeats))
            for k, n in config:
                left[k] -= n * repeats
    for k in range(len(names) - 1, -1, -1):
        while left[k]:
            left[k] -= 1
            config = _fill(names, left, capacity - names[k], k)
            left[k] += 1
            config[k] += 1
            repeats = min(left[j] // n for j, n in config.items())
            found.append(({names[j]: n for j, n in config.items()}, repeats))
            for j, n in config.items():
                left[j] -= n * repeats
    return found


def slot_table(plan) -> dict[int, np.ndarray]:
    """For each length: rows ``(first number, first sequence, times per sequence, offset)``, by first number."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for config, repeats in plan:
        offset = 0
        for length in sorted(config, reverse=True):
            times = config[length]
            slots.setdefault(length, []).append((used[length], sequence, times, offset))
            used[length] += times * repeats
            offset += times * length
        sequence += repeats
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False,
         bucket_rows: int = BUCKET_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """``pieces_of(docs)`` with ``sequence_id`` and ``offset``: where each piece lies.

    Repeated rows are packed each; an empty table needs no sequence. Pieces of one length are numbered in
    buckets, so that no task holds a length of which there is any number.
    """
    pieces = stage(pieces_of(docs, tokenizer_path, capacity, end, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    slots = slot_table(plan_sequences(histogram, capacity, rounds))

    buckets = max(1, -(-sum(histogram.values()) // bucket_rows))
    pieces = pieces.withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id, piece), {buckets})"))
    before = pieces.groupBy("length", "bucket").count().selectExpr(
        "length", "bucket", "sum(count) OVER (PARTITION BY length ORDER BY bucket) - count AS before")
    numbered = pieces.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, bucket ORDER BY doc_id, piece) - 1 AS number").join(
        before, ["length", "bucket"]).selectExpr(*pieces.drop("bucket").columns, "number + before AS number")
    names = [*pieces.drop("bucket").columns, "sequence_id", "offset"]
    at, at_length = len(names) - 2, names.index("length")

    def place(batches):
        for batch in batches:
            length = batch.column(at_length).to_numpy()
            number = batch.column(at).to_numpy()
            sequence, offset = np.empty_like(number), np.empty_like(number)
            for own in np.unique(length):
                rows, mine = slots[int(own)], length == own
                slot = rows[np.searchsorted(rows[:, 0], number[mine], side="right") - 1]
                within = number[mine] - slot[:, 0]
                sequence[mine] = slot[:, 1] + within // slot[:, 2]
                offset[mine] = slot[:, 3] + within % slot[:, 2] * own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(sequence), pa.array(offset)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.drop("bucket").schema)
    return numbered.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")
