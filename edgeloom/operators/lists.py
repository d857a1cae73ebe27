"""Closed two-paths by probing neighbour lists: no row is made for a path.

Every vertex v has the list of its neighbours of higher rank. A cycle is found at its lowest vertex: v, a middle w and an end u, both
in the list of v, such that u is in the list of w as well. Vertices have one of k colours, by a hash. The cell of two colours holds the
entries (w, u) of these colours in packed arrays; the vertices v pass it with their entries of these colours only. So each entry is held in
one cell and passes at most 2 * k of them, where a cell holds about a k * k-th of all entries: E ** 1.5 / sqrt(block) entries travel, not E * E / block.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.plans import shuffle_partitions

BLOCK_ENTRIES = 2_000_000  # entries that a cell holds, about
PATHS_AT_ONCE = 300_000  # entries that are looked up in one go
CHUNK = 200_000  # entries of whole lists that are dealt in one go
PASSING = 16_000_000  # entries that pass a cell in one task
LEAST_TASK = 10_000  # entries below which a task is not worth its start
SLOTS = 1 << 22  # of the table that tells which ends a vertex may have

WHOLE = ("tinyint", "smallint", "int", "bigint")

_WIDTHS = (np.uint8, np.uint16, np.uint32, np.uint64)
_HEAD = struct.Struct("<Bqq")


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as their range needs."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a, np.int64)
        low = a.min(initial=np.iinfo(np.int64).max) if len(a) else np.int64(0)
        above = a.view(np.uint64) - np.array([low]).view(np.uint64)
        width = (max(1, (int(above.max(initial=0)).bit_length() + 7) // 8) - 1).bit_length()
        parts += [_HEAD.pack(width, int(low), len(a)), above.astype(_WIDTHS[width]).tobytes()]
    return b"".join(parts)


def unpack(body: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(body):
        width, low, n = _HEAD.unpack_from(body, at)
        at += _HEAD.size
        above = np.frombuffer(body, _WIDTHS[width], n, at).astype(np.uint64)
        arrays.append((above + np.array([low], np.int64).view(np.uint64)).view(np.int64))
        at += n * np.dtype(_WIDTHS[width]).itemsize
    return arrays


def _dealt_by(ids: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A number below ``n`` for each id, by a hash."""
    h = (ids.view(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def _starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[:len(values)])


def _lengths(values: np.ndarray) -> np.ndarray:
    return np.diff(np.append(_starts(values), len(values)))


def deal(entries: np.ndarray, colours: int, shares: int) -> Iterator[tuple[int, int, bytes]]:
    """``(cell, kind, body)`` for whole lists ``entries`` (rows: vertex, neighbour, copies of the edge to it and from it), by vertex.

    Kind 0 is held by the cell, kind 1 passes it. A cell has ``shares`` tasks, which all hold its entries; a vertex passes one.
    """
    v, high = entries[0], entries[1]
    of_v, of_high = _dealt_by(v, colours, 1), _dealt_by(high, colours, 1)
    cell = of_v * colours + of_high
    order = np.argsort(cell, kind="stable")
    bounds = np.append(_starts(cell[order]), len(order))
    for first, last in zip(bounds[:-1], bounds[1:]):
        some = order[first:last]
        body = pack(*entries[:, some])
        for share in range(shares):
            yield int(cell[some[0]]) * shares + share, 0, body
    share_of_v = _dealt_by(v, shares, 2)
    for share in range(shares):
        at = np.flatnonzero(share_of_v == share)
        row = np.cumsum(np.concatenate([[True], v[at][1:] != v[at][:-1]])[:len(at)]) - 1
        at = at[np.bincount(row)[row] > 1] if len(at) else at  # one neighbour closes nothing
        if len(at):
            yield from _passing(entries[:, at], of_high[at], colours, shares, share)


def _passing(entries: np.ndarray, colour: np.ndarray, colours: int, shares: int, share: int) -> Iterator[tuple[int, int, bytes]]:
    new = np.concatenate([[True], entries[0, 1:] != entries[0, :-1]])
    row = np.cumsum(new) - 1
    there = np.zeros((colours, int(row[-1]) + 1), np.int32)
    np.add.at(there, (colour, row), 1)
    order = np.argsort(colour, kind="stable")
    bounds = np.searchsorted(colour[order], np.arange(colours + 1))
    pieces = [order[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    rows = [row[p] for p in pieces]
    for middle in range(colours):
        if not len(pieces[middle]):
            continue
        for end in range(colours):
            # only vertices with a neighbour of either colour
            chosen = pieces[middle][there[end][rows[middle]] > (middle == end)]
            if not len(chosen):
                continue
            own = entries[0, chosen]
            arrays = [own[_starts(own)], _lengths(own), *entries[1:, chosen]]
            if middle != end:
                others = pieces[end][there[middle][rows[end]] > 0]
                arrays += [_lengths(entries[0, others]), *entries[1:, others]]
            yield (middle * colours + end) * shares + share, 1, pack(*arrays)


class Block:
    """The entries that a cell holds, by their vertex."""

    def __init__(self, held: list[list[np.ndarray]]):
        owner, high, up, down = (np.concatenate(c) for c in zip(*held)) if held else np.zeros((4, 0), np.int64)
        order = np.argsort(owner, kind="stable")
        owner = owner[order]
        self.starts = _starts(owner)
        self.owners, self.lengths = owner[self.starts], _lengths(owner)
        # ids numbered within the block, so that an end is looked up by place
        self.ids, numbers = np.unique(high[order], return_inverse=True)
        self.numbers = numbers.astype(np.int32)
        self.up, self.down = up[order], down[order]

    def matches(self, body: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """Vertices of a passing ``body`` with a middle and an end: ``(v, w, u)``, then copies of v->w, w->v, w->u, u->w, v->u and u->v."""
        vertices, n_middle, *rest = unpack(body)
        middle = rest[:3]
        n_end, *end = rest[3:] if len(rest) > 3 else (n_middle, *middle)
        if not len(self.owners):
            return
        m_row = np.repeat(np.arange(len(vertices)), n_middle)
        e_row = np.repeat(np.arange(len(vertices)), n_end)
        at = np.minimum(np.searchsorted(self.owners, middle[0]), len(self.owners) - 1)
        here = np.flatnonzero(self.owners[at] == middle[0])
        number = np.minimum(np.searchsorted(self.ids, end[0]), len(self.ids) - 1)
        known = np.flatnonzero(self.ids[number] == end[0])
        if not len(here) or not len(known):
            return
        m_row, at, middle = m_row[here], at[here], [a[here] for a in middle]
        key = e_row[known] * len(self.ids) + number[known]
        order = np.argsort(key, kind="stable")
        key, known = key[order], known[order]
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        first = 0
        while first < len(at):  # lists together, up to a bounded number of entries, but one list at least
            limit = (ends[first - 1] if first else 0) + PATHS_AT_ONCE
            last = max(first + 1, int(np.searchsorted(ends, limit, "right")))
            yield from self._matches(vertices, m_row[first:last], at[first:last], [a[first:last] for a in middle], key, known, end)
            first = last

    def _matches(self, vertices, m_row, at, middle, key, known, end):
        lengths = self.lengths[at]
        before = np.cumsum(lengths) - lengths
        rows = np.arange(int(lengths.sum())) + np.repeat(self.starts[at] - before, lengths)
        # a key is a vertex and an end; a table of bytes tells nearly all that are no entry of the vertex
        base = int(m_row[0]) * len(self.ids)
        low, high = np.searchsorted(key, (base, (int(m_row[-1]) + 1) * len(self.ids)))
        key, known = key[low:high] - base, known[low:high]
        if not len(key):
            return
        wanted = np.repeat(m_row * len(self.ids) - base, lengths)
        wanted += self.numbers[rows]
        span = (int(m_row[-1] - m_row[0]) + 1) * len(self.ids)
        slot, wanted_slot = (key, wanted) if span <= SLOTS else (_dealt_by(key, SLOTS, 3), _dealt_by(wanted, SLOTS, 3))
        table = np.zeros(min(span, SLOTS), bool)
        table[slot] = True
        some = np.flatnonzero(table[wanted_slot])
        place = np.minimum(np.searchsorted(key, wanted[some]), len(key) - 1)
        found = key[place] == wanted[some]
        some, place = some[found], known[place[found]]
        if not len(some):
            return
        which = np.searchsorted(before + lengths, some, "right")
        rows = rows[some]
        yield (vertices[m_row[which]], middle[0][which], end[0][place], middle[1][which], middle[2][which],
               self.up[rows], self.down[rows], end[1][place], end[2][place])


def count_closed(p: np.ndarray, q: np.ndarray, r: np.ndarray, multiplicity: str) -> int:
    """The sum over cycles with ``p``, ``q`` and ``r`` copies of their edges; exact at any size."""
    some = (p > 0) & (q > 0) & (r > 0)
    if multiplicity == "distinct":
        return 3 * int(np.count_nonzero(some))
    p, q, r = p[some], q[some], r[some]
    if not len(p):
        return 0
    # floats are near enough to tell whether 64 bits hold the sum
    if float(p.max()) * float(q.max()) * float(r.max()) * len(p) > 2.0 ** 61:
        p, q, r = (x.astype(object) for x in (p, q, r))
    if multiplicity == "all":
        return 3 * int((p * q * r).sum())
    return int((p * q + q * r + r * p).sum())


def layout(entries: int, block_entries: int, tasks: int) -> tuple[int, int]:
    """Colours, and tasks per cell, for lists of ``entries`` in all.

    Entries travel ``2 * colours + shares`` times. More colours than blocks need, and shares, are only for ``tasks`` tasks to have work.
    """
    tasks = min(tasks, -(-entries // LEAST_TASK))
    colours = max(1, math.ceil(math.sqrt(entries / block_entries)), round(tasks ** (1 / 3)))
    return colours, max(1, -(-tasks // colours ** 2), -(-2 * entries // (colours * PASSING)))


def dealt_lists(ranked: DataFrame, entries: int, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``(cell, kind, body)`` for pairs ``ranked(a, b, m_ab, m_ba, d_a, d_b)``, of which there are ``entries``; rows of a cell are together."""
    if ranked.schema["a"].dataType.simpleString() not in WHOLE:
        raise ValueError("neighbour lists need ids that are whole numbers")
    spark = ranked.sparkSession
    partitions, cores = shuffle_partitions(spark), spark.sparkContext.defaultParallelism
    colours, shares = layout(entries, block_entries, min(partitions, 4 * cores))
    # Ties go by id: a < b. A list has at most sqrt(2 * pairs) entries.
    lists = ranked.withColumn("a_low", F.expr("d_a <= d_b")).selectExpr(
        "CAST(IF(a_low, a, b) AS bigint) AS v", "CAST(IF(a_low, b, a) AS bigint) AS high",
        "CAST(IF(a_low, m_ab, m_ba) AS bigint) AS m_up", "CAST(IF(a_low, m_ba, m_ab) AS bigint) AS m_down",
    ).repartition(partitions, "v").sortWithinPartitions("v")

    def send(batches):
        for chunk in _whole_lists(batches):
            cell, kind, body = zip(*deal(chunk, colours, shares))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())], ["cell", "kind", "body"])

    tasks = min(colours * colours * shares, max(partitions, 4 * cores))
    return lists.mapInArrow(send, "cell bigint, kind int, body binary").repartitionById(
        tasks, F.expr(f"CAST(cell % {tasks} AS int)")).sortWithinPartitions("cell", "kind")


def _whole_lists(batches) -> Iterator[np.ndarray]:
    """The entries of batches in chunks, as rows of an array; a list is never cut."""
    parts, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        parts.append(np.stack([c.to_numpy() for c in batch.columns]))
        n += batch.num_rows
        if n >= CHUNK:
            chunk = np.concatenate(parts, axis=1)
            cut = int(np.searchsorted(chunk[0], chunk[0, -1]))
            parts, n = [chunk[:, cut:]], chunk.shape[1] - cut
            if cut:
                yield chunk[:, :cut]
    if parts:
        yield np.concatenate(parts, axis=1)


def _found(batches) -> Iterator[tuple[np.ndarray, ...]]:
    """``Block.matches`` of all cells in ``batches(cell, kind, body)``."""
    cell, block, held = None, None, []
    for batch in batches:
        for at, kind, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if at != cell:
                cell, block, held = at, None, []
            if kind == 0:
                held.append(unpack(body.as_py()))
            else:
                if block is None:
                    block, held = Block(held), []
                yield from block.matches(body.as_py())


def closed_by_lists(dealt: DataFrame, multiplicity: str, count_type: str) -> DataFrame:
    """``(closed)`` in partial sums, null where one is beyond ``count_type``, for the cells of ``dealt_lists``."""
    def probe(batches):
        total = 0
        for _, _, _, v_w, w_v, w_u, u_w, v_u, u_v in _found(batches):
            total += count_closed(v_w, w_u, u_v, multiplicity) + count_closed(v_u, u_w, w_v, multiplicity)
        yield pa.RecordBatch.from_arrays([pa.array([str(total)])], ["closed"])

    return dealt.mapInArrow(probe, "closed string").selectExpr(f"try_cast(closed AS {count_type}) AS closed")


def cycles_by_lists(dealt: DataFrame) -> DataFrame:
    """``(x, y, z)``: each cycle once, beginning anywhere, for the cells of ``dealt_lists``."""
    def probe(batches):
        for v, w, u, v_w, w_v, w_u, u_w, v_u, u_v in _found(batches):
            there, back = (v_w > 0) & (w_u > 0) & (u_v > 0), (v_u > 0) & (u_w > 0) & (w_v > 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a[there], b[back]])) for a, b in ((v, v), (w, u), (u, w))],
                                             ["x", "y", "z"])

    return dealt.mapInArrow(probe, "x bigint, y bigint, z bigint")
