"""Phrases that stand out, by sorting suffixes of words to a fixed depth.

Every word begins a suffix of up to ``LONGEST`` words of its piece. Suffixes are routed by their leading words, so that all that
begin with one phrase meet in one task, and sorted there by multikey three-way quicksort: the size of an equal
partition is the count of a phrase, and a partition that is too small is given up with all that it holds.

Two passes before make sketches, counters of hashed word sequences that never fall short of the true count. A suffix is
cut where the sketch shows that no frequent phrase goes on, before it is sent. Leading words that very many suffixes share are told by the
sketch too: these suffixes are routed by one more word, and what the tasks count for the shorter phrase is added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.jaccard import mix64
from edgeloom.llm.tables import written
from edgeloom.plans import discard, shuffle_partitions

LEAST = 100
LONGEST = 5
BEST = 2000
SLICE = 1 << 22  # bytes of text that are taken apart at once
BUCKET_BYTES = 1 << 24  # bytes of text whose suffixes meet in one bucket
MOST_COUNTERS = 1 << 24  # of a sketch: a byte each where it is sent to tasks
HOT_ROWS = 1 << 14  # suffixes with the same leading words, from which these are routed by one word more
RANK_PARTS = 64

_BLOCK = 1 << 16  # counters in a row
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: blank, 2: end of a piece
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_FREQUENT, _HOT = 1, 2


def word_stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(codes, pieces, words)``: for each word of the texts its place in ``words`` and the number of its piece."""
    data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    kind = _KIND[data]
    inside = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    pieces = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(data[kind == 0])]).dictionary_encode()
    return found.indices.to_numpy(), pieces, found.dictionary


def slices(batches):
    """``(lang, texts)`` of up to about ``SLICE`` bytes for batches of ``(lang, text)``."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if text.is_valid:
                held.setdefault(lang, []).append(text.as_py())
                sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1]) + 1
                if sizes[lang] >= SLICE:
                    yield lang, held.pop(lang)
                    del sizes[lang]
    yield from held.items()


def hashes_of(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w.as_py()) for w in words], np.uint64)


def sequence_hashes(lang: str, codes: np.ndarray, words: pa.Array) -> list[np.ndarray]:
    """By length less one: the hash of the words that begin at each place, without regard to pieces."""
    hashes = hashes_of(words)[codes]
    found = [mix64(hashes ^ np.uint64(xxhash.xxh3_64_intdigest(lang)))]
    for k in range(1, LONGEST):
        found.append(mix64(found[-1][:-1] + hashes[k:]) if len(hashes) > k else np.zeros(0, np.uint64))
    return found


class Classes:
    """Of each counter of the sketches so far, whether it is frequent or hot."""

    def __init__(self):
        self.by_length: dict[int, np.ndarray] = {}

    def of(self, length: int, hashes: np.ndarray) -> np.ndarray:
        classes = self.by_length[length]
        return classes[(hashes & np.uint64(len(classes) - 1)).astype(np.int64)]

    def open_places(self, hashes: list[np.ndarray], pieces: np.ndarray, longest: int) -> list[np.ndarray]:
        """For each length up to ``longest`` the places at which a sequence of so many words lies in one piece, all shorter
        ones in it being frequent, and itself too if a sketch has its length."""
        masks = []
        for length in range(1, longest + 1):
            if length == 1:
                here = np.ones(len(pieces), bool)
            else:
                here = masks[-1][:-1] & masks[-1][1:]
                if length == 2:
                    here &= pieces[1:] == pieces[:-1]
            if length in self.by_length:
                here[here] = self.of(length, hashes[length - 1][here]) >= _FREQUENT
            masks.append(here)
        return masks


def sketch(docs: DataFrame, lengths: tuple[int, ...], counters: int, classes: Classes) -> DataFrame:
    """``(block, lang, n, counts)`` per task: blocks of counters of the sequences of ``lengths`` words that ``classes``
    leave open, and, with block -1, the words of each lang."""
    def count(batches):
        known = held.value
        total = np.zeros(counters, np.uint32)
        words: dict[str, int] = {}
        for lang, texts in slices(batches):
            codes, pieces, dictionary = word_stream(texts)
            words[lang] = words.get(lang, 0) + len(codes)
            hashes = sequence_hashes(lang, codes, dictionary)
            masks = known.open_places(hashes, pieces, max(lengths))
            for length in lengths:
                here = masks[length - 1]
                np.add.at(total, (hashes[length - 1][here] & np.uint64(counters - 1)).astype(np.int64), np.uint32(1))
        pack = zstandard.ZstdCompressor(level=1)
        blocks = [(-1, lang, n, None) for lang, n in words.items()]
        for start in range(0, counters, _BLOCK):
            block = total[start:start + _BLOCK]
            if block.any():
                blocks.append((start // _BLOCK, None, 0, pack.compress(block.astype("<u4").tobytes())))
        for row in blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.binary()))],
                ["block", "lang", "n", "counts"])

    held = docs.sparkSession.sparkContext.broadcast(classes)
    return docs.mapInArrow(count, "block int, lang string, n bigint, counts binary")


def summed(blocks: DataFrame) -> DataFrame:
    """``(block, counts)``: one row for each block, the sum of those of all tasks."""
    def add(batches):
        number, total = None, None
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zstandard.decompress(counts.as_py()), "<u4").astype(np.int64)
                if block != number:
                    if number is not None:
                        yield _packed(number, total)
                    number, total = block, np.zeros(len(part), np.int64)
                total += part
        if number is not None:
            yield _packed(number, total)

    rows = blocks.where("block >= 0").select("block", "counts").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(add, "block int, counts binary")


def _packed(number: int, total: np.ndarray) -> pa.RecordBatch:
    data = zstandard.compress(np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data], pa.binary())], ["block", "counts"])


def _classified(totals: DataFrame, counters: int, least: int, hot_rows: int) -> np.ndarray:
    """A class for each counter; ``counters`` is bounded by ``MOST_COUNTERS``."""
    counts = np.zeros(counters, np.uint32)
    for block, data in totals.toLocalIterator():
        part = np.frombuffer(zstandard.decompress(bytes(data)), "<u4")
        counts[block * _BLOCK:block * _BLOCK + len(part)] = part
    # counts of a full sketch are mostly noise, which must not make every sequence a hot one
    hot = max(hot_rows, least, 8 * int(counts.mean()))
    return (counts >= least).astype(np.uint8) * _FREQUENT + (counts >= hot).astype(np.uint8) * (_HOT - _FREQUENT)


def routed(docs: DataFrame, classes: Classes, buckets: int, word_buckets: int) -> DataFrame:
    """``(bucket, lang, words, codes, weights, hot)``: suffixes of a slice that go to one bucket, each different one once.

    ``codes`` has ``LONGEST`` numbers for each suffix, its words' places in ``words`` and then -1. ``hot`` says how many
    leading words are so frequent that their suffixes are spread over buckets. Frequent single words come
    with ``weights`` alone, in buckets of their own below 0.
    """
    def route(batches):
        known = held.value
        for lang, texts in slices(batches):
            codes, pieces, words = word_stream(texts)
            hashes = sequence_hashes(lang, codes, words)
            masks = known.open_places(hashes, pieces, LONGEST)
            often = np.bincount(codes[masks[0]], minlength=len(words))
            some = np.flatnonzero(often)
            own_bucket = (hashes_of(words.take(pa.array(some))) % np.uint64(word_buckets)).astype(np.int64)
            for number in np.unique(own_bucket):
                own = some[own_bucket == number]
                yield _row(-1 - number, lang, words.take(pa.array(own)), None, often[own], None)
            starts = np.flatnonzero(masks[1])
            if not len(starts):
                continue
            depth = np.zeros(len(codes), np.int8)
            for length in range(2, LONGEST + 1):
                depth[:len(masks[length - 1])][masks[length - 1]] = length
            depth = depth[starts]
            hot = np.ones(len(starts), np.int8)
            route = hashes[1][starts]
            for length in range(2, LONGEST):
                more = np.flatnonzero((hot == length - 1) & (depth >= length))
                more = more[known.of(length, hashes[length - 1][starts[more]]) == _HOT]
                hot[more] = length
                more = more[depth[more] > length]
                route[more] = hashes[length][starts[more]]
            matrix = np.full((len(starts), LONGEST), -1, np.int32)
            whole = np.zeros(len(starts), np.uint64)
            for i in range(LONGEST):
                has = np.flatnonzero(depth > i)
                matrix[has, i] = codes[starts[has] + i]
                whole[has] = hashes[i][starts[has]]
            # equal hashes are equal suffixes but for a chance that is looked at
            _, first, inverse, weights = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
            if (matrix != matrix[first][inverse]).any():
                first, weights = np.arange(len(starts)), np.ones(len(starts), np.int64)
            bucket = (mix64(route[first]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            numbers, at = np.unique(bucket[order], return_index=True)
            for number, own in zip(numbers, np.split(order, at[1:])):
                part = matrix[first[own]]
                used, renamed = np.unique(part, return_inverse=True)
                if used[0] == -1:
                    used, renamed = used[1:], renamed - 1
                yield _row(number, lang, words.take(pa.array(used)), renamed.astype("<i4"), weights[own], hot[first[own]])

    held = docs.sparkSession.sparkContext.broadcast(classes)
    return docs.mapInArrow(route, "bucket int, lang string, words binary, codes binary, weights binary, hot binary")


def _row(bucket, lang, words: pa.Array, codes, weights, hot) -> pa.RecordBatch:
    # no word has a line break in it
    values = [bucket, lang, b"\n".join(words.to_pylist()), None if codes is None else codes.tobytes(),
              weights.astype("<i8").tobytes(), None if hot is None else hot.tobytes()]
    kinds = [pa.int32(), pa.string()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)],
                                      ["bucket", "lang", "words", "codes", "weights", "hot"])


def frequent_prefixes(codes: np.ndarray, weights: np.ndarray, hot: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """``(row, length, count)`` of the prefixes of two and more words with ``least`` suffixes, and of all that are ``hot``.

    Multikey three-way quicksort of pointers: a partition is split at the word of its middle row at one depth; what is
    equal goes on at the next depth. Partitions that cannot hold a frequent prefix are given up.
    """
    found = []
    parts = [(np.arange(len(weights)), 0)]
    while parts:
        rows, depth = parts.pop()
        if not len(rows):
            continue
        column = codes[rows, depth]
        pivot = column[len(rows) // 2]
        for side in (rows[column < pivot], rows[column > pivot]):
            if len(side) and (weights[side].sum() >= least or hot[side].max() > depth):
                parts.append((side, depth))
        if pivot < 0:
            continue  # suffixes that end here
        equal = rows[column == pivot]
        total = int(weights[equal].sum())
        if total >= least or hot[equal].max() > depth:
            if depth:
                found.append((int(equal[0]), depth + 1, total))
            if depth + 1 < codes.shape[1]:
                parts.append((equal, depth + 1))
    return found


def counted(rows: DataFrame, least: int) -> DataFrame:
    """``(lang, phrase, words, f)`` for ``routed`` rows: counts of phrases, in parts where leading words are hot."""
    def sort(batches):
        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["bucket"], row["lang"]) != key:
                    if held:
                        yield _prefixes(held, least) if key[0] >= 0 else _words(held, least)
                    key, held = (row["bucket"], row["lang"]), []
                held.append(row)
        if held:
            yield _prefixes(held, least) if key[0] >= 0 else _words(held, least)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "lang")
    return dealt.mapInArrow(sort, "lang string, phrase binary, words int, f bigint")


def _words(rows: list[dict], least: int) -> pa.RecordBatch:
    total: dict[bytes, int] = {}
    for row in rows:
        for word, n in zip(row["words"].split(b"\n"), np.frombuffer(row["weights"], "<i8").tolist()):
            total[word] = total.get(word, 0) + n
    total = {w: n for w, n in total.items() if n >= least}
    return _counts(rows[0]["lang"], list(total), [1] * len(total), list(total.values()))


def _prefixes(rows: list[dict], least: int) -> pa.RecordBatch:
    numbers: dict[bytes, int] = {}
    codes = []
    for row in rows:
        own = [numbers.setdefault(w, len(numbers)) for w in row.pop("words").split(b"\n")]
        codes.append(np.array([*own, -1], np.int32)[np.frombuffer(row.pop("codes"), "<i4")])
    codes = np.concatenate(codes).reshape(-1, LONGEST)
    weights = np.concatenate([np.frombuffer(r["weights"], "<i8") for r in rows])
    hot = np.concatenate([np.frombuffer(r["hot"], np.int8) for r in rows])
    found = frequent_prefixes(codes, weights, hot, least)
    words = list(numbers)
    return _counts(rows[0]["lang"], [b" ".join(words[c] for c in codes[row, :length]) for row, length, _ in found],
                   [f[1] for f in found], [f[2] for f in found])


def _counts(lang, phrases, words, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary()), pa.array(words, pa.int32()),
         pa.array(counts, pa.int64())], ["lang", "phrase", "words", "f"])


def phrase_counts(docs: DataFrame, least: int = LEAST, hot_rows: int = HOT_ROWS, bucket_bytes: int = BUCKET_BYTES,
                  most_counters: int = MOST_COUNTERS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, f)`` of phrases of one to ``LONGEST`` words that occur ``least`` times, and ``(lang, n)``.

    The last three parameters lay out the work and change no result.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    counters = 1 << min(max(16, (size // 16).bit_length()), most_counters.bit_length() - 1)
    classes, totals = Classes(), None
    for lengths in ((1, 2), (3, 4)):
        blocks = written(sketch(texts, lengths, counters, classes), "phrase-sketch")
        if totals is None:
            totals = written(blocks.where("block < 0").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-words")
        found = _classified(written(summed(blocks), "phrase-classes"), counters, least, hot_rows)
        classes.by_length |= dict.fromkeys(lengths, found)
        discard(blocks)
    tasks = shuffle_partitions(docs.sparkSession)
    parts = counted(routed(texts, classes, max(4 * tasks, size // bucket_bytes), tasks), least)
    counts = parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(f"f >= {least}")
    return written(counts.withColumn("phrase", F.expr("CAST(phrase AS string)")), "phrases"), totals


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, percent: int = 100, **layout) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each lang's ``best`` phrases of ``docs(lang, text)``.

    Texts, A-Z in lower case, fall into pieces at ``.,;:!?`` and line ends and those into words at blanks and tabs. ``n`` is the number of
    words of a lang, ``a`` how often a phrase of two words or more occurs in pieces, ``least`` at least. Cut after some of its words, into parts that occur
    ``l`` and ``r`` times, it has the score ``1000 * a * n div (l * r)``; the cut with the lowest one counts, the first of equals. A phrase
    inside a longer one that occurs ``percent`` of a hundred as often is dropped. Equal scores go by ``a``, then by phrase. Each row is a document, also
    a repeated one; a null lang is ``und``; null and empty texts have no words.
    """
    counts, totals = phrase_counts(docs, least, **layout)
    return ranked(docs.sparkSession.sql("""
        WITH cuts AS (
          SELECT lang, phrase, f AS a, k, substring_index(phrase, ' ', k) AS first
          FROM {counts} LATERAL VIEW explode(sequence(1, words - 1)) AS k WHERE words > 1),
        parted AS (
          SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r
          FROM cuts c JOIN {counts} x ON x.lang = c.lang AND x.phrase = c.first
          JOIN {counts} y ON y.lang = c.lang AND y.phrase = substr(c.phrase, length(c.first) + 2)),
        scored AS (
          SELECT p.lang, phrase, a, min(struct(
            (CAST(a AS decimal(20, 0)) * n * 1000) div (CAST(l AS decimal(20, 0)) * r) AS score, k, l, r)) AS cut, n
          FROM parted p JOIN {totals} t ON p.lang = t.lang GROUP BY p.lang, phrase, a, n),
        inner_phrases AS (
          SELECT lang, phrase, max(f) AS most FROM (
            SELECT lang, f, inline(array(struct(substring_index(phrase, ' ', words - 1) AS phrase),
                                         struct(substr(phrase, length(substring_index(phrase, ' ', 1)) + 2) AS phrase)))
            FROM {counts} WHERE words > 2)
          GROUP BY lang, phrase)
        SELECT s.lang, s.phrase, a, cut.l, cut.r, n, cut.score
        FROM scored s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.phrase = s.phrase
        WHERE 100 * coalesce(most, 0) < """ + str(percent) + " * a", counts=counts, totals=totals), best)


def ranked(scored: DataFrame, best: int) -> DataFrame:
    """The first ``best`` rows of each lang; those of parts of it first."""
    rank = "CAST(row_number() OVER (PARTITION BY {} ORDER BY score DESC, a DESC, phrase) AS int) AS rank"
    some = scored.selectExpr("*", f"pmod(hash(phrase), {RANK_PARTS}) AS part")
    some = some.selectExpr("*", rank.format("lang, part")).where(f"rank <= {best}").drop("rank", "part")
    return some.selectExpr("lang", rank.format("lang"), "phrase", "a", "l", "r", "n", "score").where(f"rank <= {best}")


PHRASES_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, k, w[i:i + k - 1] AS p FROM o, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, p, count(*) AS f FROM g GROUP BY lang, k, p HAVING count(*) >= 100),
cuts AS (SELECT c.lang, c.p, c.f AS a, j, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
         FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1) c JOIN f l ON l.lang = c.lang AND l.p = c.p[1:j]
         JOIN f r ON r.lang = c.lang AND r.p = c.p[j + 1:] JOIN t ON t.lang = c.lang),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS x FROM cuts) WHERE x = 1),
parts AS (SELECT lang, f, p[i:j] AS p FROM (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM (
            SELECT *, unnest(range(1, k)) AS i FROM f WHERE k > 2)) WHERE j - i + 1 < k),
longer AS (SELECT lang, p, max(f) AS most FROM parts GROUP BY lang, p),
ranked AS (SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, n, score,
             row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(s.p, ' ')) AS rank
           FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.p = s.p WHERE 100 * coalesce(most, 0) < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""
