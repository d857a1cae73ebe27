"""Language-model scores from a probabilistic suffix tree over words.

Symbols are lower-cased words and an end. Contexts of one to ``depth`` words are states of the tree if they occur
often enough and their next-symbol distribution diverges from that of the context without its first
word. A state gives part of its probability to the symbols it has seen, and the rest to its suffix, down to
the root, which knows every word. A symbol is scored from the longest state that ends before it.

An n-gram counts if it occurs ``LEAST`` times, whatever the size of the corpus. N-grams, states and their values
are Spark tables; the most frequent ones are also sent to the tasks, which saves lookups and changes no
result. Bit filters do the same: what they let through in error is dropped by its count, or finds no value.

Keys of n-grams travel in packs: a task folds those of many texts and has one row for each of ``PARTS`` ranges of
their hash, so that shuffles move few and long rows.

A text's score is a sum over its n-grams. To the root's part for each word, a state adds what it leaves to its suffix for
each of its occurrences, and an n-gram after a state adds the probability it has there over the one it
would have had.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import small_batches, written
from edgeloom.llm.words import text_hashes, word_groups
from edgeloom.plans import discard

DEPTH = 4
SHARE = 2e-6  # at most 1 / SHARE words, and as many n-grams, are sent to the tasks
LEAST = 5  # occurrences of an n-gram in the tree at least
DISCOUNT = 0.5
ADD = 0.1
PENALTY = 0.5
FLUSH = 1_000_000  # n-grams that a task folds at once; some 80 bytes each
HELD = 1 << 18  # values that a task packs at once; nothing is folded there
ASK = 1 << 18  # keys that a task looks up at once; sorting them takes some 100 bytes a key
PARTS = 256  # ranges of hashed keys, a pack for each
MAX_BITS = 1 << 29  # of a filter; a larger tree lets more through

END = xxhash.xxh3_64_intdigest(b" ") - (1 << 63)  # no word is blank


def word_hashes(text: bytes | None) -> np.ndarray:
    """A 64-bit hash for each word, and the end."""
    return np.append(text_hashes(text).view(np.int64), END)


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each of ``keys`` is in ``sorted_keys``, -1 if it is not."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Slots:
    """Finds hashed keys by their leading bits, at a place of their own in a table of twice as many or the next free one.
    Binary search in this many keys takes some five times as long."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, (2 * len(keys) + 1).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._places(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], at[lost] + 1 & len(self.slots) - 1

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each of ``keys`` is among those of the table, -1 if it is not."""
        at = self._places(keys)
        found = self.slots[at].astype(np.int64)
        if not len(self.keys):
            return found
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(wrong):
            at[wrong] = at[wrong] + 1 & len(self.slots) - 1
            found[wrong] = held = self.slots[at[wrong]]
            wrong = wrong[(held >= 0) & (self.keys[held] != keys[wrong])]
        return found


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of their first words and of their last words."""
    z = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64)
    z = (z ^ z >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (z ^ z >> np.uint64(29)).view(np.int64)


def all_keys(hashes: np.ndarray, depth: int) -> list[np.ndarray]:
    """The keys of the n-grams of 1 to ``depth + 1`` words, in the order of the text."""
    keys = [hashes]
    for _ in range(depth):
        keys.append(mixed(keys[-1][:-1], keys[-1][1:]))
    return keys


def token_groups(batches) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """``(batch, first, hashes, text)`` for groups of consecutive texts, the last column of ``batches``: the number of the
    first one in its batch, the hashes of their tokens, ends included, and the number of each token's text in the group."""
    for batch in batches:
        for first, hashes, sizes in word_groups(batch.column(batch.num_columns - 1)):
            yield (batch, first, np.insert(hashes.view(np.int64), np.cumsum(sizes), END),
                   np.repeat(np.arange(len(sizes)), sizes + 1))


def _ranges(part: np.ndarray) -> list[slice]:
    """The slices of each of the ``PARTS`` in the sorted ``part``."""
    ends = np.searchsorted(part, np.arange(PARTS + 1))
    return [slice(a, b) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _packs(part: np.ndarray, names: str, *columns: np.ndarray) -> pa.RecordBatch:
    """A row for each part that has any: its number and the bytes of its slice of each column."""
    own = [(k, s) for k, s in enumerate(_ranges(part)) if s.stop > s.start]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in own], pa.int32())] + [pa.array([c[s].tobytes() for _, s in own], pa.binary()) for c in columns],
        ["part", *names.split()])


def _by_part(packs, kinds: list[type]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns of each part, whose packs come one after the other."""
    held, number = [], None
    for batch in packs:
        for part, *columns in zip(*(c.to_pylist() for c in batch.columns)):
            if part != number and held:
                yield number, [np.concatenate(c) for c in zip(*held)]
                held = []
            number = part
            held.append([np.frombuffer(c, kind) for c, kind in zip(columns, kinds)])
    if held:
        yield number, [np.concatenate(c) for c in zip(*held)]


def _short(keys: np.ndarray) -> np.ndarray:
    """40 bits of each key: its part, then 32 more."""
    return (keys & PARTS - 1) << 32 | keys >> 8 & 0xFFFFFFFF


@dataclass
class Filter:
    """Two bits for each key that was put in, in a segment of ``size`` bits for each part."""

    size: int
    words: np.ndarray

    @staticmethod
    def places(short: np.ndarray, size: int) -> list[np.ndarray]:
        return [short >> shift & size - 1 for shift in (0, 11)]

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        found = np.arange(len(keys))
        for shift in (0, 11):
            at = (keys[found] & PARTS - 1) * self.size + (keys[found] >> 8 + shift & (1 << 32 - shift) - 1 & self.size - 1)
            found = found[(self.words[at >> 6] >> (at & 63) & 1).astype(bool)]
        mask = np.zeros(len(keys), bool)
        mask[found] = True
        return mask


def _filter(packs: DataFrame, keys: int, least: int) -> Filter:
    """A filter of what occurs ``least`` times in ``packs(part, short, n)``, made for about ``keys``; the driver gets its
    bits alone."""
    size = min(MAX_BITS, 1 << max(14, int(16 * keys).bit_length())) // PARTS

    def segments(batches):
        for part, (short, n) in _by_part(batches, [np.uint32, np.uint8]):
            order = np.argsort(short)
            short, n = short[order], n[order]
            first = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
            often = short[first[np.add.reduceat(n, first, dtype=np.int64) >= least]].astype(np.int64)
            bits = np.zeros(size, bool)
            for at in Filter.places(often, size):
                bits[at] = True
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()])],
                                             ["part", "bits"])

    rows = packs.repartition("part").sortWithinPartitions("part").mapInArrow(segments, "part int, bits binary").toArrow()
    words = np.zeros((PARTS, size >> 6), np.int64)
    for part, bits in zip(rows["part"].to_pylist(), rows["bits"].to_pylist()):
        words[part] = np.frombuffer(bits, np.int64)
    return Filter(size, words.ravel())


def _short_packs(keys: np.ndarray) -> pa.RecordBatch:
    short, n = np.unique(_short(keys), return_counts=True)
    return _packs(short >> 32, "short n", short.astype(np.uint32), np.minimum(n, 255).astype(np.uint8))


def filter_of(keys: DataFrame) -> Filter:
    """A filter of the one column of ``keys``."""
    def pack(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            rows += batch.num_rows
            if rows >= FLUSH:
                yield _short_packs(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield _short_packs(np.concatenate(held))

    return _filter(keys.mapInArrow(pack, "part int, short binary, n binary"), keys.count(), 1)


@dataclass
class Tree:
    """The frequent part of the tree: sorted keys of words with ``log_root``, and of n-grams with what they add
    (``gain``) and what they add where a word follows (``rest``). ``all_grams`` has those that are not frequent too."""

    total: int = 0
    distinct: int = 0
    depth: int = DEPTH
    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    log_root: np.ndarray = field(default_factory=lambda: np.empty(0))
    grams: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    gain: np.ndarray = field(default_factory=lambda: np.empty(0))
    rest: np.ndarray = field(default_factory=lambda: np.empty(0))
    all_grams: Filter = field(default_factory=lambda: Filter(64, np.zeros(PARTS, np.int64)))

    @cached_property
    def word_slots(self) -> Slots:
        return Slots(self.words)

    @cached_property
    def gram_slots(self) -> Slots:
        return Slots(self.grams)

    @property
    def log_scale(self) -> float:
        return float(np.log10(self.total + ADD * (self.distinct + 1)))

    def parts(self, hashes: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(frequent words, base, score)`` of each of some texts, and ``(keys, their texts)`` that the tables may add to.

        ``text`` numbers the text of each token. Words that are not frequent are scored as if they were new, and are
        among the keys.
        """
        word = self.word_slots.find(hashes)
        known = word >= 0
        values = np.full(len(hashes), np.log10(ADD) - self.log_scale)
        values[known] = self.log_root[word[known]]
        base = np.bincount(text, values, texts)
        total, keys_left, texts_left = base.copy(), [hashes[~known]], [text[~known]]
        for k, keys in enumerate(all_keys(hashes, self.depth)):
            own = text[:len(keys)]
            some = np.flatnonzero((own == text[k:]) & self.all_grams.may_have(keys))
            at = self.gram_slots.find(keys[some])
            held, at = some[at >= 0], at[at >= 0]
            follows = np.append(text, -1)[held + k + 1] == own[held]
            total += np.bincount(own[held], self.gain[at] + np.where(follows, self.rest[at], 0), texts)
            if k:
                left = np.setdiff1d(some, held, assume_unique=True)
                keys_left.append(keys[left])
                texts_left.append(own[left])
        return np.bincount(text[known], minlength=texts), base, total, np.concatenate(keys_left), np.concatenate(texts_left)

    def score(self, hashes: np.ndarray) -> float:
        """The score of one text as far as the frequent part knows it."""
        return float(self.parts(hashes, np.zeros(len(hashes), np.int64), 1)[2][0])


def _word_counts(texts: DataFrame) -> DataFrame:
    """``(gram, c)``, summed within tasks before the shuffle."""
    def folded(held):
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["gram", "n"])

    def count(batches):
        held, rows = [], 0
        for _, _, hashes, _ in token_groups(batches):
            held.append(hashes)
            rows += len(hashes)
            if rows >= FLUSH:
                yield folded(held)
                held, rows = [], 0
        if held:
            yield folded(held)

    return texts.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("c"))


def _often(texts: DataFrame, k: int, parts: Filter, tokens: int) -> Filter:
    """A filter of the n-grams of ``k + 1`` words that occur ``LEAST`` times. Their first and their last ``k`` words
    do as well, and are in ``parts``."""
    shared = texts.sparkSession.sparkContext.broadcast(parts)

    def pack(batches):
        held, rows = [], 0
        for _, _, hashes, text in token_groups(batches):
            context, suffix = _candidates(hashes, text, k, shared.value)
            held.append(mixed(context, suffix))
            rows += len(context)
            if rows >= FLUSH:
                yield _short_packs(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield _short_packs(np.concatenate(held))

    return _filter(texts.mapInArrow(pack, "part int, short binary, n binary"), tokens // (4 * LEAST), LEAST)


def _candidates(hashes: np.ndarray, text: np.ndarray, k: int, parts: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the first and of the last ``k`` words of all ``k + 1`` words of a text where both may be in ``parts``."""
    if len(hashes) <= k:
        return hashes[:0], hashes[:0]
    keys = all_keys(hashes, k - 1)[-1]
    own = parts.may_have(keys)
    some = np.flatnonzero(own[1:] & own[:-1] & (text[k:] == text[:-k]))
    return keys[some], keys[some + 1]


def _gram_counts(texts: DataFrame, k: int, parts: Filter, often: Filter) -> DataFrame:
    """``(gram, context, suffix, c)`` for the n-grams of ``k + 1`` words that occur ``LEAST`` times: the keys of an
    n-gram, of all its words but the last, and of all but the first. N-grams that are not in ``often`` stay in their task."""
    shared = texts.sparkSession.sparkContext.broadcast((parts, often))

    def folded(held):
        context, suffix = map(np.concatenate, zip(*held))
        gram = mixed(context, suffix)
        _, first, n = np.unique(gram, return_index=True, return_counts=True)
        order = np.argsort(gram[first] & PARTS - 1, kind="stable")
        first = first[order]
        return _packs(gram[first] & PARTS - 1, "context suffix n", context[first], suffix[first], n[order].astype(np.uint32))

    def count(batches):
        held, rows = [], 0
        for _, _, hashes, text in token_groups(batches):
            context, suffix = _candidates(hashes, text, k, shared.value[0])
            some = shared.value[1].may_have(mixed(context, suffix))
            held.append((context[some], suffix[some]))
            rows += int(some.sum())
            if rows >= FLUSH:
                yield folded(held)
                held, rows = [], 0
        if rows:
            yield folded(held)

    def summed(batches):
        for _, (context, suffix, n) in _by_part(batches, [np.int64, np.int64, np.uint32]):
            gram = mixed(context, suffix)
            order = np.argsort(gram)
            gram, n = gram[order], n[order]
            first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
            c = np.add.reduceat(n, first, dtype=np.int64)
            first, c = first[c >= LEAST], c[c >= LEAST]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram[first], context[order[first]], suffix[order[first]], c)],
                                             ["gram", "context", "suffix", "c"])

    return (texts.mapInArrow(count, "part int, context binary, suffix binary, n binary").repartition("part").sortWithinPartitions("part")
            .mapInArrow(summed, "gram bigint, context bigint, suffix bigint, c bigint"))


def _states(grams: DataFrame, lower: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """``(gram, c, given, gain)`` of ``grams`` and ``(gram, c, rest)`` of the contexts that are states, from
    ``lower(gram, c, given)``, the n-grams that are one word shorter.

    A context of count ``c`` stays if ``c`` times the divergence of its distribution from its suffix's exceeds
    ``PENALTY * ln(total)`` for each symbol it lists. Tables are written before sums by context, so that a join on a
    common one can be split, and deleted once read, as is ``grams``.
    """
    context = lower.selectExpr("gram AS context", "c AS n")
    suffix = lower.selectExpr("gram AS suffix", "given AS below")
    listed = written(grams.join(context, "context").join(suffix, "suffix").selectExpr(
        "gram", "context", "c", "n", "below", f"(c - {DISCOUNT}D) / n AS seen"), "listed")
    discard(grams)
    left = written(listed.groupBy("context").agg(F.expr("greatest(1 - sum(seen), 1e-12D) AS rest")), "left")
    given = written(listed.join(left, "context").withColumn("given", F.expr("seen + rest * below")), "given")
    discard(listed)
    discard(left)
    # symbols that are not listed keep their proportions, so they diverge as one
    states = written(given.groupBy("context").agg(
        F.max("n").alias("n"), F.max("rest").alias("rest"), F.count("*").alias("symbols"),
        F.expr("sum(given * ln(given / below)) AS gain"), F.expr("greatest(1 - sum(given), 1e-12D) AS other"),
        F.expr("greatest(1 - sum(below), 1e-12D) AS other_below")).where(
        f"n * (gain + other * ln(other / other_below)) > {PENALTY * float(np.log(max(total, 2)))!r}D * symbols"
    ).selectExpr("context", "n", "log10(rest) AS log_rest"), "states")
    tested = given.join(states.select("context", "log_rest"), "context", "left").selectExpr(
        "gram", "c", "IF(log_rest IS NULL, below, given) AS given",
        "IF(log_rest IS NULL, 0D, log10(given / below) - log_rest) AS gain")
    level = written(tested, "level")
    discard(given)
    return level, states.selectExpr("context AS gram", "n AS c", "log_rest AS rest")


def fit_tables(train: DataFrame, depth: int = DEPTH) -> tuple[int, int, DataFrame, DataFrame]:
    """``(tokens, distinct words, words, model)`` of ``train(text)``: ``(gram, c)`` for every word, and
    ``(gram, c, gain, rest)`` for each n-gram that adds anything to a score."""
    texts = train.select(F.col("text").cast("binary").alias("text"))
    words = written(_word_counts(texts), "words")
    total, distinct = map(int, words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first())
    scale = total + ADD * (distinct + 1)
    level = words.where(f"c >= {LEAST}").selectExpr("gram", "c", f"(c + {ADD}D) / {scale!r}D AS given")
    parts = train.sparkSession.createDataFrame([], "gram bigint, c bigint, gain double, rest double")
    often = filter_of(level.select("gram"))
    for k in range(1, depth + 1):
        shorter, often = often, _often(texts, k, often, total)
        grams = written(_gram_counts(texts, k, shorter, often), "grams")
        level, states = _states(grams, level, total)
        parts = parts.union(level.where("gain != 0").selectExpr("gram", "c", "gain", "0D AS rest")).union(
            states.selectExpr("gram", "c", "0D AS gain", "rest"))
    model = parts.groupBy("gram").agg(F.max("c").alias("c"), F.sum("gain").alias("gain"), F.sum("rest").alias("rest"))
    return total, distinct, words, written(model, "model")


def _least_sent(counts: DataFrame, limit: float) -> int:
    """A count that at most ``limit`` rows of ``counts(c)`` reach, to an eighth of a power of two."""
    steps = counts.groupBy(F.expr("CAST(8 * log2(c) AS int) AS step")).agg(
        F.count("*").alias("rows"), F.min("c").alias("least"), F.max("c").alias("most")).collect()
    steps.sort(key=lambda s: -s.step)
    least, held = steps[0].most + 1 if steps else 1, 0
    for step in steps:
        held += step.rows
        if held > limit:
            break
        least = step.least
    return least


def frequent_part(total: int, distinct: int, words: DataFrame, model: DataFrame, depth: int, share: float) -> Tree:
    """What is sent to the tasks: the most frequent words and n-grams, at most ``1 / share`` of each, and a filter of all.
    Both are cut at one count, so that a word and its state are sent together."""
    tree = Tree(total, distinct, depth)
    often = f"c >= {max(_least_sent(words, 1 / share), _least_sent(model, 1 / share))}"
    rows = words.where(often).orderBy("gram").toArrow()
    tree.words = rows["gram"].to_numpy().copy()
    tree.log_root = np.log10(rows["c"].to_numpy() + ADD) - tree.log_scale
    rows = model.where(often).orderBy("gram").toArrow()
    tree.grams, tree.gain, tree.rest = (rows[c].to_numpy().copy() for c in ("gram", "gain", "rest"))
    tree.all_grams = filter_of(model.select("gram"))
    return tree


def fit(train: DataFrame, depth: int = DEPTH, share: float = SHARE) -> tuple[Tree, DataFrame]:
    """The frequent part of the tree, and ``(gram, c)`` for every word of ``train(text)``.

    An empty table gives a tree without words.
    """
    total, distinct, words, model = fit_tables(train, depth)
    return frequent_part(total, distinct, words, model, depth, share), words


def _turned(keys: np.ndarray) -> np.ndarray:
    """Keys with their part as the highest bits."""
    keys = keys.view(np.uint64)
    return keys << np.uint64(56) | keys >> np.uint64(8)


def _asked(keys: list[np.ndarray], rows: list[np.ndarray]) -> tuple[pa.RecordBatch, int]:
    """Packs of the keys that some rows ask for: each key once with the number of its rows, then these rows, counted from
    the first, and how often each has the key. And the first row."""
    key, row = _turned(np.concatenate(keys)), np.concatenate(rows)
    first_row = int(row.min())
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])))
    times = np.diff(np.append(first, len(key)))
    key, row = key[first], row[first]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts, part = np.diff(np.append(first, len(key))), (key >> np.uint64(56)).astype(np.int64)
    once = _packs(part[first], "a b", key[first], counts.astype(np.uint32))
    every = _packs(part, "c d", (row - first_row).astype(np.uint32), times.astype(np.uint32))
    return pa.RecordBatch.from_arrays([*once.columns, *every.columns[1:]], ["part", "a", "b", "c", "d"]), first_row


def _answers(asked: DataFrame, values: DataFrame) -> DataFrame:
    """``(row, root, more, known)``: sums of ``values(gram, root, more, known)`` over what each row asks for; several
    rows for one number. Tasks hold the values of their parts, and packs of one task at a time."""
    def pack(batches):
        def packed(held):
            gram, *columns = (np.concatenate(c) for c in zip(*held))
            key = _turned(gram)
            order = np.argsort(key)
            key = key[order]
            return _packs((key >> np.uint64(56)).astype(np.int64), "a b c d", key, *(c[order] for c in columns))

        held, rows = [], 0
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            rows += batch.num_rows
            if rows >= HELD:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    def summed(held, first):
        rows, *sums = (np.concatenate(c) for c in zip(*held))
        rows, at = np.unique(rows, return_inverse=True)
        root, more, known = (np.bincount(at, x) for x in sums)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int64) + first), pa.array(root), pa.array(more), pa.array(known.astype(np.int64))],
            ["row", "root", "more", "known"])

    def answer(batches):
        table, held, number = [], [], None
        for batch in batches:
            for kind, first, a, b, c, d in zip(*(x.to_pylist() for x in batch.columns[1:])):
                if kind == 0:
                    table.append((np.frombuffer(a, np.uint64), *(np.frombuffer(x, float) for x in (b, c, d))))
                    continue
                if isinstance(table, list):
                    table = _sums_by_key(table)
                if first != number and held:
                    yield summed(held, number)
                    held = []
                number = first
                at = find(table[0], np.frombuffer(a, np.uint64))
                at = np.repeat(at, np.frombuffer(b, np.uint32))
                some = at >= 0
                at, times = at[some], np.frombuffer(d, np.uint32)[some]
                held.append((np.frombuffer(c, np.uint32)[some], *(x[at] * times for x in table[1:])))
        if held:
            yield summed(held, number)

    packs = values.mapInArrow(pack, "part int, a binary, b binary, c binary, d binary").selectExpr(
        "part", "0 AS kind", "0L AS first", "a", "b", "c", "d")
    return packs.union(asked.selectExpr("part", "1 AS kind", "row AS first", "a", "b", "c", "d")).repartition(
        "part").sortWithinPartitions("kind", "first").mapInArrow(answer, "row bigint, root double, more double, known bigint")


def _sums_by_key(table: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sorted keys, and the sums of the other columns for each of them."""
    if not table:
        return np.empty(0, np.uint64), *[np.empty(0)] * 3
    key, *columns = (np.concatenate(c) for c in zip(*table))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], *(np.add.reduceat(c[order], first) for c in columns)


def score_texts(docs: DataFrame, train: str = "true", depth: int = DEPTH, share: float = SHARE) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``, a row for each row of ``docs(doc_id, text)``.

    ``train`` is a condition on ``doc_id``: the rows to learn from, all texts of them. Null and empty texts are
    an end alone. Repeated rows are learnt and scored each. Scores are log10 probabilities; without
    training rows every token has probability 1.
    """
    with small_batches(docs.sparkSession):
        return _score_texts(docs, train, depth, share)


def _score_texts(docs: DataFrame, train: str, depth: int, share: float) -> DataFrame:
    total, distinct, words, model = fit_tables(docs.where(train), depth)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_part(total, distinct, words, model, depth, share))
    schema = (f"row bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, n_known bigint, base double, "
              "score double, part int, a binary, b binary, c binary, d binary")

    def score(batches):
        keys, rows, held = [], [], 0

        def packs():
            asked, first = _asked(keys, rows)
            none = [pa.nulls(asked.num_rows, t) for t in (id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([first] * asked.num_rows, pa.int64()), *none, *asked.columns], names)

        names = ["row", "doc_id", "n_tokens", "n_known", "base", "score", "part", *"abcd"]
        for batch, first, hashes, text in token_groups(batches):
            texts = int(text[-1]) + 1
            known, base, scores, asked, of = shared.value.parts(hashes, text, texts)
            own, id_type = batch.slice(first, texts), batch.column(1).type
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.array(np.bincount(text, minlength=texts)), pa.array(known), pa.array(base),
                 pa.array(scores), pa.nulls(texts, pa.int32()), *[pa.nulls(texts, pa.binary())] * 4], names)
            keys.append(asked)
            rows.append(own.column(0).to_numpy()[of])
            held += len(asked)
            if held >= ASK:
                yield packs()
                keys, rows, held = [], [], 0
        if held:
            yield packs()

    # once written, the row numbers do not change
    scored = written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text"))
                     .mapInArrow(score, schema), "scored")
    values = words.selectExpr("gram", f"log10(c + {ADD}D) - log10({ADD}D) AS root", "0D AS more", "1D AS known").union(
        model.selectExpr("gram", "0D", "gain + rest", "0D"))
    rest = written(_answers(scored.where("part IS NOT NULL"), values).groupBy("row").agg(
        *(F.sum(x).alias(f"rest_{x}") for x in ("root", "more", "known"))), "rest")
    return scored.where("part IS NULL").join(rest.hint("merge"), "row", "left").selectExpr(
        "doc_id", "n_tokens", "n_known + coalesce(rest_known, 0L) AS n_known", f"{total}L AS train_tokens",
        "base + coalesce(rest_root, 0D) AS base_score", "score + coalesce(rest_root + rest_more, 0D) AS score")
