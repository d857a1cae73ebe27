"""Removing repeated passages with a logarithmic family of sparse suffix arrays.

A string of ``length`` bytes is found by its anchor: the k-mer in it with the smallest hash. Equal strings
have equal anchors at equal places, so it is enough to sort the suffixes at anchors, about one in
sixteen. Consecutive strings with one anchor are a run. Documents come in batches by
rising id. A batch's suffixes are sorted together with those of the levels so far and scanned once:
anchors that more than one document has are matches. A run that an earlier document has as a whole is
repeated; runs that share their anchor only are compared string by string. Then the batch becomes a
level, and levels of equal size merge, so that a suffix is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.jaccard import mix64
from edgeloom.llm.tables import by_key, frequent_values, joined, written
from edgeloom.plans import discard

LENGTH = 50
KMER = 20
BATCHES = 2
BLOCK = 1 << 22  # bytes of a text that are hashed at once
GROUP_BYTES = 1 << 16  # of shorter texts that are hashed at once, one after the other
HOT_SAMPLE = 2_000  # documents looked at for keys that very many have
HOT_AT = 20
FEW_RUNS = 10_000
ALL = -1  # mask of a run that is repeated as a whole

_POSITION_BITS = np.uint64(24)
_BASE = 0x9E3779B97F4A7C15
# 256 random numbers, one for each byte
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def window_hashes(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all strings of each of ``lengths`` bytes, put together from lengths that are powers of two and not yet mixed."""
    powers = {1: _BYTES[data]}
    n = 1
    while 2 * n <= max(lengths):
        h = powers[n]
        powers[2 * n] = h[:-n] * _power(n) + h[n:]
        n *= 2
    found = []
    for length in lengths:
        total, done = None, 0
        for n in sorted(powers, reverse=True):
            if length & n:
                part = powers[n][done:len(data) - length + done + 1]
                total = part if total is None else total * _power(n) + part
                done += n
        found.append(total)
    return found


class Runs:
    """The runs of one block of text, or of several texts that stop at ``ends``: strings ``first..last`` (starts) share the
    anchor ``anchor``. ``text`` numbers the text of each run."""

    def __init__(self, data: np.ndarray, length: int, kmer: int, ends: np.ndarray | None = None):
        kmers, self._strings = window_hashes(data, (kmer, length))
        kmers = mix64(kmers)
        width = length - kmer + 1
        at = np.arange(len(kmers), dtype=np.uint64)
        # the smallest hash of a window, and of equal ones the first
        packed = (kmers >> _POSITION_BITS << _POSITION_BITS) | at
        n = 1
        while 2 * n <= width:
            packed = np.minimum(packed[:-n], packed[n:])
            n *= 2
        if n < width:
            packed = np.minimum(packed[:n - width], packed[width - n:])
        anchors = (packed & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
        last = np.append(first[1:] - 1, len(anchors) - 1)
        self.text = np.zeros(len(first), np.int64)
        if ends is not None:
            # strings over the end of a text are none: runs stop before them and begin after them
            inner = ends[:-1]
            begins = np.concatenate([[0], inner])
            first = np.union1d(first, begins[begins < len(anchors)])
            last = np.append(first[1:] - 1, len(anchors) - 1)
            self.text = np.searchsorted(ends, first, "right")
            last = np.minimum(last, ends[self.text] - length)
            some = first <= last
            first, last, self.text = first[some], last[some], self.text[some]
        self.first, self.last = first, last
        self.anchor = anchors[self.first]
        self.key = kmers[self.anchor]
        place = (self.anchor - self.first).astype(np.uint64) << np.uint64(8) | (self.last - self.first).astype(np.uint64)
        self.run = mix64(mix64(self._strings[self.first]) * np.uint64(3) + mix64(mix64(self._strings[self.last]) + place))

    @property
    def strings(self) -> np.ndarray:
        """The hash of each string; only few of them are needed where runs are made."""
        return mix64(self._strings)


def blocks(text: bytes, length: int, kmer: int):
    """``(start, Runs)`` of a text, in blocks that overlap so that each string is in exactly one."""
    for start in range(0, max(0, len(text) - length + 1), BLOCK):
        yield start, Runs(np.frombuffer(text, np.uint8)[start:start + BLOCK + length - 1], length, kmer)


def groups(texts: list[bytes | None], length: int, kmer: int):
    """``(first, ends, start, Runs)`` of all ``texts``: consecutive short ones together, of which the first has the number ``first`` and
    which end at ``ends``; a long one in its ``blocks``, with the place of the block in ``start``."""
    sizes = np.array([len(t or b"") for t in texts], np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + GROUP_BYTES, "right")) - 1)
        if last == first + 1:
            for start, found in blocks(texts[first] or b"", length, kmer):
                yield first, sizes[first:last], start, found
        elif upto[last] - upto[first] >= length:
            data = np.frombuffer(b"".join(t or b"" for t in texts[first:last]), np.uint8)
            ends = upto[first + 1:last + 1] - upto[first]
            yield first, ends, 0, Runs(data, length, kmer, ends)
        first = last


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _once(found: Runs) -> np.ndarray:
    """The first of equal runs of each text, by text and run."""
    order = np.lexsort((found.run, found.text))
    run, text = found.run[order], found.text[order]
    return order[np.concatenate([[True], (run[1:] != run[:-1]) | (text[1:] != text[:-1])])[:len(order)]]


def _of_text(runs: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A name for each run of each text."""
    return mix64(runs.view(np.uint64) + text.astype(np.uint64) * np.uint64(_BASE))


def _suffixes(docs: DataFrame, length: int, kmer: int, hot: list[int]) -> DataFrame:
    """``(key, run, doc_id, packed)``: a suffix per run, once for each document and content.

    Suffixes of ``hot`` keys are kept together: one row for a block of a document, under the smallest hot key and with run 0,
    has them in ``packed`` as key, run, key, run and so on, eight bytes each. It is null in all other rows. Bytes, since
    Spark hands even a null array to Python at many times the cost of a number.
    """
    often = np.array(sorted(hot), np.int64)

    def suffixes(batches):
        for batch in batches:
            keys, runs, at, packed = [], [], [], []
            for i, _, _, found in groups(batch.column(1).to_pylist(), length, kmer):
                once = _once(found)
                key, run, text = _signed(found.key[once]), _signed(found.run[once]), found.text[once] + i
                together = np.flatnonzero(np.isin(key, often))
                if len(together):
                    begins = np.flatnonzero(np.diff(text[together], prepend=-1))
                    for part in np.split(together, begins[1:]):
                        packed.append(np.stack([key[part], run[part]], 1).astype(">i8").tobytes())
                    keys.append(np.full(len(begins), often[0]))
                    runs.append(np.zeros(len(begins), np.int64))
                    at.append(text[together[begins]])
                    key, run, text = (np.delete(x, together) for x in (key, run, text))
                packed += [None] * len(key)
                keys.append(key)
                runs.append(run)
                at.append(text)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(runs)),
                     batch.column(0).take(pa.array(np.concatenate(at))), pa.array(packed, pa.binary())],
                    ["key", "run", "doc_id", "packed"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(suffixes, f"key bigint, run bigint, doc_id {id_type}, packed binary")


def _run_strings(docs: DataFrame, wanted: DataFrame, length: int, kmer: int) -> DataFrame:
    """``(key, doc_id, run, place, strings)``: the strings of the runs of ``wanted(doc_id, run)``, in order.

    ``place`` is how far before the anchor the first string starts.
    """
    def strings(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(5)]
            texts, wanted = batch.column(1).to_pylist(), batch.column(2)
            ends = wanted.offsets.to_numpy()
            names = wanted.values.to_numpy()
            for i, sizes, _, found in groups(texts, length, kmer):
                own = ends[i:i + len(sizes) + 1]
                known = np.sort(_of_text(names[own[0]:own[-1]], np.repeat(np.arange(len(sizes)), np.diff(own))))
                once = _once(found)
                name = _of_text(_signed(found.run[once]), found.text[once])
                some = once[known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name]
                hashes = _signed(found.strings)
                for column, values in zip(columns, (
                        _signed(found.key[some]), found.text[some] + i, _signed(found.run[some]), found.anchor[some] - found.first[some],
                        [hashes[a:b + 1].tobytes() for a, b in zip(found.first[some], found.last[some])])):
                    column.append(values)
            if columns[0]:
                key, at, run, place = (np.concatenate(c) for c in columns[:4])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(pa.array(at)), pa.array(run), pa.array(place.astype(np.int32)),
                     pa.array([x for part in columns[4] for x in part], pa.binary())],
                    ["key", "doc_id", "run", "place", "strings"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    per_doc = wanted.groupBy("doc_id").agg(F.collect_list("run").alias("runs"))
    return docs.join(per_doc.hint("merge"), "doc_id").select("doc_id", "text", "runs").mapInArrow(
        strings, f"key bigint, doc_id {id_type}, run bigint, place int, strings binary")


def _masks(batch: pa.RecordBatch) -> np.ndarray:
    """For each run, the places of its strings that a smaller id of the same key has as well."""
    lists = batch.column(4).to_pylist()
    sizes = np.array([len(x) // 8 for x in lists])
    row = np.repeat(np.arange(batch.num_rows), sizes)
    string = np.frombuffer(b"".join(lists), np.int64)
    key = batch.column(0).to_numpy()[row]
    doc = np.unique(batch.column(1).to_numpy(zero_copy_only=False), return_inverse=True)[1][row]
    order = np.lexsort((doc, string, key))
    new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (string[order][1:] != string[order][:-1])])
    first = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    hit = order[doc[order] > first]
    place = np.repeat(batch.column(3).to_numpy(), sizes) - (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    masks = np.zeros(batch.num_rows, np.int64)
    np.bitwise_or.at(masks, row[hit], np.int64(1) << place[hit].astype(np.int64))
    return masks


def _by_whole_keys(batches, hot: np.ndarray, settle):
    """``settle(batch)`` for batches that hold all rows of their keys, and ``None`` beside rows of hot keys."""
    held = None
    for batch in batches:
        if held is not None:
            batch = joined(held, batch)
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        often = np.isin(key, hot)
        yield batch.filter(pa.array(often)), None
        last = int(np.searchsorted(key, key[-1]))
        inner = batch.slice(0, last).filter(pa.array(~often[:last]))
        if inner.num_rows:
            yield inner, settle(inner)
        # a hot key goes on without being held
        held = None if often[-1] else batch.slice(last)
    if held is not None and held.num_rows:
        yield held, settle(held)


REPEATED, WANTED, OPEN = 0, 1, 2


def _kinds(batch: pa.RecordBatch) -> np.ndarray:
    """What each suffix of whole keys is: repeated as a run; the first of a run whose key has other runs; or neither (-1)."""
    key, run = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    doc = batch.column(2).to_numpy(zero_copy_only=False)
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_run = new_key | np.concatenate([[True], run[1:] != run[:-1]])
    firsts = np.flatnonzero(new_run)
    first = doc[firsts[np.cumsum(new_run) - 1]]
    kinds = np.where(doc > first, REPEATED, -1).astype(np.int32)
    key_starts = np.searchsorted(firsts, np.flatnonzero(new_key))
    low, high = np.minimum.reduceat(doc[firsts], key_starts), np.maximum.reduceat(doc[firsts], key_starts)
    several = np.repeat(low < high, np.diff(np.concatenate([key_starts, [len(firsts)]])))
    kinds[firsts[several.astype(bool)]] = WANTED
    return kinds


def _scan(suffixes: DataFrame, hot: list[int]) -> DataFrame:
    """``(key, run, doc_id, packed, kind)`` of the suffixes that match others, and of all packed ones (``OPEN``)."""
    def scan(batches):
        for rows, kinds in _by_whole_keys(batches, np.array(sorted(hot), np.int64), _kinds):
            kinds = np.full(rows.num_rows, OPEN, np.int32) if kinds is None else kinds
            marked = pa.RecordBatch.from_arrays([*rows.columns, pa.array(kinds)], [*rows.schema.names, "kind"])
            yield marked.filter(pa.array(kinds >= 0))

    id_type = suffixes.schema["doc_id"].dataType.simpleString()
    return by_key(suffixes, hot).mapInArrow(
        scan, f"key bigint, run bigint, doc_id {id_type}, packed binary, kind int")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, run and row of the suffixes in ``batch(doc_id, packed)``."""
    lists = batch.column(1).to_pylist()
    pairs = np.frombuffer(b"".join(lists), ">i8").astype(np.int64).reshape(-1, 2)
    sizes = np.array([len(x) // 16 for x in lists], np.int64)
    return pairs[:, 0], pairs[:, 1], np.repeat(np.arange(batch.num_rows), sizes)


def _firsts(packed: DataFrame) -> DataFrame:
    """``(key, run, first_id, n)`` of the suffixes in ``packed(doc_id, packed)``, folded in each batch before the shuffle."""
    def fold(batches):
        for batch in batches:
            key, run, row = _unpacked(batch)
            doc = batch.column(0).to_numpy(zero_copy_only=False)[row]
            order = np.lexsort((doc, run, key))
            key, run, doc = key[order], run[order], doc[order]
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (run[1:] != run[:-1])])[:len(key)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[new]), pa.array(run[new]), pa.array(doc[new], batch.schema.field(0).type),
                 pa.array(np.diff(np.append(new, len(key))), pa.int64())], ["key", "run", "doc_id", "n"])

    id_type = packed.schema["doc_id"].dataType.simpleString()
    return packed.select("doc_id", "packed").mapInArrow(fold, f"key bigint, run bigint, doc_id {id_type}, n bigint").groupBy(
        "key", "run").agg(F.min("doc_id").alias("first_id"), F.sum("n").alias("n"))


def _open_repeats(packed: DataFrame, firsts: DataFrame) -> DataFrame:
    """``(doc_id, runs)`` of the suffixes of hot keys whose run has a smaller id.

    Runs that make up at least ``1 / FEW_RUNS`` of these suffixes, of which there are no more than ``FEW_RUNS``, are told to the
    tasks, so that their rows stay where they are. The others meet their smallest id in a join.
    """
    total = int(firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    common = firsts.where(f"n > 1 AND n >= {total / FEW_RUNS!r}D").select("key", "run", "first_id").collect()
    smallest = {(r.key, r.run): r.first_id for r in common}
    known = np.array(sorted({run for _, run in smallest}), np.int64)

    def split(batches):
        for batch in batches:
            repeated, keys, runs = ([[] for _ in range(batch.num_rows)] for _ in range(3))
            ids = batch.column(0).to_pylist()
            key, run, row = _unpacked(batch)
            for k, r, i, told in zip(key.tolist(), run.tolist(), row.tolist(), np.isin(run, known).tolist()):
                first = smallest.get((k, r)) if told else None
                if first is None:
                    keys[i].append(k)
                    runs[i].append(r)
                elif ids[i] > first:
                    repeated[i].append(r)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (repeated, keys, runs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["doc_id", "repeated", "keys", "runs"])

    id_type = packed.schema["doc_id"].dataType.simpleString()
    marked = written(packed.select("doc_id", "packed").mapInArrow(
        split, f"doc_id {id_type}, repeated array<bigint>, keys array<bigint>, runs array<bigint>"), "marked")
    rest = marked.selectExpr("doc_id", "inline(arrays_zip(keys, runs))").toDF("doc_id", "key", "run").join(
        firsts.where("n > 1").hint("merge"), ["key", "run"]).where("doc_id > first_id")
    return marked.where("size(repeated) > 0").selectExpr("doc_id", "repeated AS runs").unionByName(
        rest.selectExpr("doc_id", "array(run) AS runs"))


def _partly_repeated(runs: DataFrame, hot: list[int]) -> DataFrame:
    """``(doc_id, run, mask)`` for ``runs`` of ``_run_strings``, of which a key has several.

    Keys are settled in the task that holds them; hot ones string by string.
    """
    def settle(batches):
        for rows, masks in _by_whole_keys(batches, np.array(sorted(hot), np.int64), _masks):
            strings = rows.column(4)
            if masks is not None:  # the strings are done with
                strings = pa.array([b""] * rows.num_rows, pa.binary())
            masks = pa.array([None] * rows.num_rows if masks is None else masks, pa.int64())
            yield pa.RecordBatch.from_arrays([*rows.columns[:4], strings, masks], [*rows.schema.names, "mask"])

    id_type = runs.schema["doc_id"].dataType.simpleString()
    settled = written(by_key(runs, hot).mapInArrow(
        settle, f"key bigint, doc_id {id_type}, run bigint, place int, strings binary, mask bigint").where(
        "mask IS NULL OR mask != 0"), "settled")
    strings = settled.where("mask IS NULL").drop("mask").mapInArrow(
        _each_string, f"key bigint, doc_id {id_type}, run bigint, place int, at int, string bigint")
    known = strings.groupBy("key", "string").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    parts = strings.join(known.hint("merge"), ["key", "string"]).where("doc_id > low").groupBy("doc_id", "run").agg(
        F.expr("bit_or(shiftleft(1L, place - at)) AS mask"))
    return settled.where("mask IS NOT NULL").select("doc_id", "run", "mask").unionByName(parts)


def _each_string(batches):
    """A row for each of the strings in batches of ``(key, doc_id, run, place, strings)``."""
    for batch in batches:
        lists = batch.column(4).to_pylist()
        sizes = np.array([len(x) // 8 for x in lists], np.int64)
        row = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield pa.RecordBatch.from_arrays(
            [*(c.take(row) for c in batch.columns[:4]), pa.array(at.astype(np.int32)), pa.array(np.frombuffer(b"".join(lists), np.int64))],
            ["key", "doc_id", "run", "place", "at", "string"])


class SuffixIndex:
    """The levels so far, as ``(size in batches, suffixes(key, run, doc_id))`` from large to small.

    ``hot`` are keys that very many documents have; which ones are listed lays out tasks and changes no result.
    """

    def __init__(self, length: int = LENGTH, kmer: int = KMER, hot: list[int] | None = None):
        if not 0 < kmer <= length:
            raise ValueError("kmer must be positive and at most length")
        if length - kmer > 62:
            raise ValueError("a run has more than 63 strings; take a longer kmer")
        self.length, self.kmer, self.hot = length, kmer, hot or []
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, docs: DataFrame, all_docs: DataFrame | None = None, keep: bool = True) -> DataFrame:
        """``(doc_id, runs, mask)``: runs of ``docs(doc_id, text)`` with strings that a smaller id has.

        Bit ``i`` of ``mask`` is the string that starts ``i`` before the anchor. Ids of ``docs`` are larger than
        those of the levels, whose texts are found in ``all_docs``. With ``keep``, ``docs`` become the newest level, and
        levels merge as long as the last two are of one size; a merged level holds each run once, with its smallest id.
        Without it, the index is at its end and the levels are deleted.
        """
        suffixes = _suffixes(docs, self.length, self.kmer, self.hot)
        if keep:
            suffixes = written(suffixes, "level")
        rows = suffixes
        for _, level in self.levels:
            rows = rows.unionByName(level)
        found = written(_scan(rows, self.hot), "matches")
        if keep:
            self._merge(suffixes)
        else:
            for _, level in self.levels:
                discard(level)
            self.levels = []

        known, packed = found.where(f"kind != {OPEN}").drop("key", "packed"), found.where(f"kind = {OPEN}")
        firsts = written(_firsts(packed), "firsts")
        several = firsts.groupBy("key").agg(F.min("first_id").alias("low"), F.max("first_id").alias("high")).where(
            "low < high").select("key")
        whole = written(known.where(f"kind = {REPEATED}").selectExpr("doc_id", "array(run) AS runs").unionByName(
            _open_repeats(packed, firsts)).withColumn("mask", F.lit(ALL).cast("bigint")), "masks")
        wanted = known.where(f"kind = {WANTED}").select("doc_id", "run").unionByName(
            firsts.join(several.hint("merge"), "key").selectExpr("first_id AS doc_id", "run"))
        strings = written(_run_strings(docs if all_docs is None else all_docs, wanted, self.length, self.kmer), "strings")
        discard(found)
        discard(firsts)
        parts = written(_partly_repeated(strings, self.hot), "masks")
        discard(strings)
        return whole.unionByName(parts.selectExpr("doc_id", "array(run) AS runs", "mask"))

    def _merge(self, level: DataFrame) -> None:
        size = 1
        while self.levels and self.levels[-1][0] == size:
            older = self.levels.pop()[1]
            both = level.unionByName(older)
            single = both.where("packed IS NULL").groupBy("key", "run").agg(F.min("doc_id").alias("doc_id")).selectExpr(
                "key", "run", "doc_id", "CAST(NULL AS binary) AS packed")
            hot = _firsts(both.where("packed IS NOT NULL")).selectExpr(
                f"{min(self.hot, default=0)}L AS key", "0L AS run", "first_id AS doc_id",
                "unhex(concat(lpad(hex(key), 16, '0'), lpad(hex(run), 16, '0'))) AS packed")
            merged = written(single.unionByName(hot), "level")
            discard(level)
            discard(older)
            level, size = merged, 2 * size
        self.levels.append((size, level))


def _marks(found: Runs, size: int, names: np.ndarray, joint: np.ndarray, length: int, kmer: int) -> np.ndarray:
    """How many more repeated strings cover a byte than the byte before, for ``joint`` masks of the sorted ``names`` of runs."""
    marks = np.zeros(size + 1, np.int32)
    own = _of_text(_signed(found.run), found.text)
    hit = np.minimum(np.searchsorted(names, own), len(names) - 1)
    found_masks = np.where(names[hit] == own, joint[hit], 0)
    some = np.flatnonzero(found_masks)
    first, last, mask = found.first[some], found.last[some], found_masks[some]
    whole = mask == ALL
    np.add.at(marks, first[whole], 1)
    np.add.at(marks, last[whole] + length, -1)
    if not whole.all():
        back = np.arange(length - kmer + 1)
        starts = found.anchor[some][~whole, None] - back
        repeated = (mask[~whole, None] >> back) & 1 == 1
        starts = starts[repeated & (starts >= first[~whole, None]) & (starts <= last[~whole, None])]
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + length, -1)
    return marks


def covered(texts: list[bytes], runs: np.ndarray, masks: np.ndarray, of: np.ndarray, length: int, kmer: int) -> list[np.ndarray | None]:
    """Which bytes of each of ``texts`` lie in a repeated string, or None without any; ``masks`` go with ``runs``, of which one may be
    there more than once, and ``of`` numbers their texts, in rising order."""
    gone: list[np.ndarray | None] = [None] * len(texts)
    marks: dict[int, np.ndarray] = {}
    for i, ends, start, found in groups(texts, length, kmer):
        low, high = np.searchsorted(of, (i, i + len(ends)))
        if low == high or not len(found.first):
            continue
        names, place = np.unique(_of_text(runs[low:high], of[low:high] - i), return_inverse=True)
        joint = np.zeros(len(names), np.int64)
        np.bitwise_or.at(joint, place, masks[low:high])
        if len(ends) == 1:  # blocks of one text
            whole = marks.setdefault(i, np.zeros(len(texts[i]) + 1, np.int32))
            some = _marks(found, int(found.last[-1]) + length, names, joint, length, kmer)
            whole[start:start + len(some)] += some
            continue
        cover = np.cumsum(_marks(found, int(ends[-1]), names, joint, length, kmer)[:-1]) > 0
        for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if cover[a:b].any():
                gone[i + k] = cover[a:b]
    for i, whole in marks.items():
        cover = np.cumsum(whole[:-1]) > 0
        gone[i] = cover if cover.any() else None
    return gone


def remove_repeats(docs: DataFrame, length: int = LENGTH, kmer: int = KMER, batches: int = BATCHES,
                   with_row: bool = False, whole_chars: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept, row])``, a row for each row of ``docs(doc_id, text)``.

    Bytes are removed that a string of ``length`` bytes covers which also starts in a document with a smaller id,
    judged on the texts as they came. Rows with one id do not make each other shorter. A null text is
    empty; texts below ``length`` lose nothing, nor do rows with a null id, which no other row loses to either.
    ``kept`` is what is left, in bytes, and ``row`` holds all columns of ``docs`` but the text. With ``whole_chars`` a character of which
    any byte is removed goes as a whole, so that a text in UTF-8 stays one.
    """
    extra = ["row"] * with_row
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *(
        F.struct(*(c for c in docs.columns if c != "text")).alias(c) for c in extra))
    known = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    cuts = known.agg(F.expr("percentile_approx(doc_id, array(" + ", ".join(
        f"{i / batches}D" for i in range(1, batches)) + "))")).first()[0] if batches > 1 else []
    edges = [None, *sorted(set(cuts or [])), None]
    every = max(1, known.count() // HOT_SAMPLE)
    sample = _suffixes(known.where(f"pmod(xxhash64(doc_id), {every}) = 0"), length, kmer, []).select("key")
    index = SuffixIndex(length, kmer, frequent_values(sample, HOT_AT))
    masks = None
    for low, high in zip(edges[:-1], edges[1:]):
        batch = known
        if low is not None:
            batch = batch.where(F.col("doc_id") > F.lit(low))
        if high is not None:
            batch = batch.where(F.col("doc_id") <= F.lit(high))
        found = index.add(batch, known, keep=high is not None)  # nothing comes after the last batch
        masks = found if masks is None else masks.unionByName(found)

    def cut(batches):
        for batch in batches:
            rows, kept = [], []
            # a row has a list of (runs, mask); all runs of the batch, with the mask of each, and where those of a row end
            lists = batch.column(2)
            entries = lists.flatten()
            runs = entries.field("runs")
            sizes = runs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            masks = np.repeat(entries.field("mask").to_numpy(zero_copy_only=False).astype(np.int64), sizes)
            runs = runs.flatten().to_numpy()
            per_row = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(per_row)])]
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            of = np.repeat(np.arange(len(texts)), np.diff(ends))
            for text, gone in zip(texts, covered(texts, runs, masks, of, length, kmer)):
                left, spans = text, 0
                if gone is not None:
                    # a run may be repeated as a whole and in part
                    if whole_chars:
                        # each byte belongs to the last one before it that begins a character
                        begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
                        number = np.cumsum(begins)
                        gone = (np.bincount(number, gone) > 0)[number]
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest()))
                kept.append(left)
            n, removed, spans, digest = zip(*rows) if rows else [[]] * 4
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                      pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(kept, pa.binary()), *batch.columns[3:]] * with_row, names + ["kept", "row"] * with_row)

    per_doc = masks.groupBy("doc_id").agg(F.collect_list(F.struct("runs", "mask")).alias("runs"))
    return docs.join(per_doc.hint("merge"), "doc_id", "left").select("doc_id", "text", "runs", *extra).mapInArrow(
        cut, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        + "".join(f", kept binary, row {docs.schema[c].dataType.simpleString()}" for c in extra))
