"""Similar documents by a parity-sketch join on word shingles.

Shingles toggle bits of a sketch, so bits in which two sketches differ come from shingles that only
one document has: their number never exceeds the symmetric difference. Documents of
similar size with a Jaccard similarity of ``threshold`` or more differ in at most ``D`` shingles, hence
of ``D + 1 + e`` chunks of their sketches at least ``e + 1`` are equal. Chunks are joined by
their content; candidates pass a Hamming test on a folded sketch and then an exact comparison.

Chunks that hold next to nothing, or only shingles that very many documents have, are equal by chance. They are
keyed in pairs, of which ``e`` spare chunks guarantee one. In a group of equal keys each member first meets
the one that shares most keys; what that links is one component, and only members of different
components of a group are compared further, by their sketches and in blocks. So thousands of near copies
cost one comparison each, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.components import components
from edgeloom.llm.tables import frequent_values, repeated_keys, slices, written
from edgeloom.llm.words import mix64, text_hashes, word_groups
from edgeloom.plans import discard

BAND_RATIO = 0.7  # smallest over largest size of a band
FREQUENT_SAMPLE = 5_000  # documents looked at for very frequent shingles; steers chunk keys, not results
FREQUENT_AT = 10
HOT_AT = 50  # of the sample's documents: keys whose rows are spread over tasks
GROUP_BLOCK = 256  # members of a group whose sketches are compared in one row
PAIRS_AT_ONCE = 1 << 14  # whose sketches are compared in one go
FOLD_BYTES = 128  # of a sketch that go along with the members of a small group; of longer ones half goes,
LONGEST_FOLD = 1024  # up to this: a fold with fewer bits than half of the shingles is full and rules nothing out
VERIFIED = 500  # partners that follow one copy of a text to its comparison, about
SLICE = 64  # rows of a batch that are unpacked at once
TEXT_DIGEST = "xxhash64(text)"
SKETCH_BITS = 1  # per shingle, in the folded sketch; sets with half of their shingles in common still differ in enough bits


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """A hash for each shingle of the words of one text, or of several, whose ends the caller leaves out."""
    total = np.full(len(hashes) - words + 1, words, np.uint64)
    for i in range(words):
        total = mix64(total + hashes[i:len(hashes) - words + 1 + i])
    return total


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text with fewer words has one of all its words."""
    found = text_hashes(text)
    return np.unique(_shingles(found, min(words, len(found)))) if len(found) else found


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """``shingle_hashes`` of each row of a binary column, in order."""
    for _, hashes, counts in word_groups(column):
        whole = _shingles(hashes, words) if len(hashes) >= words else hashes[:0]
        start = 0
        for n in counts.tolist():
            if n >= words:
                own = np.sort(whole[start:start + n - words + 1])
                distinct = np.empty(len(own), bool)
                distinct[0] = True
                np.not_equal(own[1:], own[:-1], out=distinct[1:])
                yield own[distinct]
            else:
                yield _shingles(hashes[start:start + n], n) if n else hashes[:0]
            start += n


def jaccard_links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether ``100 * intersection >= percent * union`` for sorted distinct hashes, neither empty."""
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(a, b)
    shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def most_apart(a: int, b: int, percent: int) -> int:
    """The largest symmetric difference of sets of sizes ``a`` and ``b`` that still link."""
    return (100 - percent) * (a + b) // (100 + percent)


class Bands:
    """How sets are banded by size and their sketches cut into chunks, for one threshold.

    ``starts`` are the first sizes of the bands; sizes that link lie in one band or in neighbours.
    """

    def __init__(self, percent: int):
        self.percent = percent
        ratio = min(BAND_RATIO, percent / 100)
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, int(np.ceil(self.starts[-1] / ratio))))
        # with w weak chunks and e spare ones there are about e + 2 w^2 / e keys besides the needed ones: e = sqrt(2) w is best
        mean = (1 + ratio) / 2 * (100 + percent) / (2 * max(1, 100 - percent))
        self.spare_share = 2**0.5 * np.exp(-mean) * (1 + mean)
        self._chunks: dict[int, tuple[int, int, np.ndarray]] = {}

    def chunks(self, band: int) -> tuple[int, int, np.ndarray]:
        """``(chunks, spare, edges)`` of a band; a shingle is in the chunk between whose edges its hash lies."""
        if band not in self._chunks:
            last = self.starts[band + 1] - 1
            apart = most_apart(last, last, self.percent)
            spare = 2 + int(self.spare_share * apart)
            count = apart + 1 + spare
            edges = (np.arange(count, dtype=np.float64) / count * 2.0**63).astype(np.uint64) << np.uint64(1)
            self._chunks[band] = count, spare, edges
        return self._chunks[band]


def chunk_keys(hashes: np.ndarray, scheme: Bands, frequent: np.ndarray) -> np.ndarray:
    """Join keys of one document, given its sorted hashes and the sorted very frequent ones."""
    n, starts, percent = len(hashes), scheme.starts, scheme.percent
    band = int(np.searchsorted(starts, n, side="right")) - 1
    rare = np.ones(n, bool)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rare = frequent[at] != hashes
    rare_before = np.concatenate([[0], np.cumsum(rare)])
    bits = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix64((hashes & np.uint64(0xFFFF)) + np.uint64(1)))])
    found = []
    for b in (band, band + 1):  # as the larger of a pair, or as the smaller beside a neighbouring band
        largest = min(starts[b + 1] - 1, 100 * n // percent)
        apart = most_apart(n, largest, percent)
        if largest < max(n, starts[b]) or apart < 1:
            continue  # no partner there, or none but equal sets
        chunks, spare, edges = scheme.chunks(b)
        own = min(chunks, apart + 1 + spare)
        ends = np.concatenate([np.searchsorted(hashes, edges), [n]])[:own + 1]
        content = bits[ends[1:]] ^ bits[ends[:-1]]
        content = mix64(content ^ mix64(np.arange(own, dtype=np.uint64) + np.uint64((b + 1) << 40)))
        strong = (np.diff(rare_before[ends]) >= 2) | (np.diff(ends) >= 4)
        found.append(content[strong])
        weak = content[~strong]
        for gap in range(1, min(len(weak) - 1, 2 * len(weak) // spare + 1) + 1):
            found.append(mix64(weak[:-gap] * np.uint64(3) + weak[gap:]))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def folded_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity bits at the low bits of the hashes, packed; the size is a power of two that grows with the set."""
    size = max(64, 1 << int(SKETCH_BITS * len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8))


def folded_to(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch of at most ``size`` bytes, with no more bits that differ."""
    while len(sketch) > size:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def fold_of(sketch: np.ndarray) -> np.ndarray:
    """What goes along with a member of a small group."""
    return folded_to(sketch, min(LONGEST_FOLD, max(FOLD_BYTES, len(sketch) // 2)))


def alike(sketches: list[np.ndarray]) -> np.ndarray:
    """The sketches at the size of the smallest, a row of 64-bit numbers each."""
    size = min(map(len, sketches))
    return np.array([folded_to(sketch, size) for sketch in sketches]).view(np.uint64)


def sketch_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Differing bits of two folded sketches; the larger is folded to the size of the smaller."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded_to(a, size) ^ folded_to(b, size)).sum())


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _set_digest(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _document_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, digest, n_shingles, node, sketch, fold)``; ``node`` stands for the set, and is null for an empty one.
    ``fold`` is ``fold_of`` the sketch."""
    def digest(batches):
        for batch in batches:
            sizes, nodes, sketches, folds = [], [], [], []
            for hashes in shingle_sets(batch.column(2), words):
                sizes.append(len(hashes))
                nodes.append(_set_digest(hashes) if len(hashes) else None)
                sketch = folded_sketch(hashes) if len(hashes) else None
                sketches.append(None if sketch is None else sketch.tobytes())
                folds.append(None if sketch is None else fold_of(sketch).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(folds, pa.binary())],
                ["doc_id", "digest", "n_shingles", "node", "sketch", "fold"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.selectExpr("doc_id", f"{TEXT_DIGEST} AS digest", "text").mapInArrow(
        digest, f"doc_id {id_type}, digest bigint, n_shingles bigint, node bigint, sketch binary, fold binary")


def _frequent(docs: DataFrame, rows: int, words: int) -> np.ndarray:
    """Sorted hashes of shingles that many documents of a bounded sample have.

    At most the sample's shingles over ``FREQUENT_AT`` are found, so the list is bounded as well.
    """
    def explode(batches):
        for batch in batches:
            found = list(shingle_sets(batch.column(0), words))
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(found or [np.empty(0, np.uint64)]))], ["h"])

    every = max(1, rows // FREQUENT_SAMPLE)
    sample = docs.where(f"pmod(xxhash64(doc_id), {every}) = 0").select("text")
    found = frequent_values(sample.mapInArrow(explode, "h bigint"), FREQUENT_AT)
    return np.sort(np.array(found, np.int64).view(np.uint64))


def _members(docs: DataFrame, rows_of_docs: int, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``(key, node)`` for every key that more than one set may have.

    A set that two tasks have may leave its keys with that one node.
    """
    scheme = Bands(percent)

    def keys(batches):
        seen: set[int] = set()
        for batch in batches:
            found, nodes = [], []
            for hashes in shingle_sets(batch.column(0), words):
                node = _set_digest(hashes) if len(hashes) else None
                if node is None or node in seen:
                    continue  # a copy in this task
                seen.add(node)
                own = chunk_keys(hashes, scheme, frequent)
                found.append(own)
                nodes.append(np.full(len(own), node, np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(found)), pa.array(np.concatenate(nodes))], ["key", "node"])

    rows = docs.select("text").mapInArrow(keys, "key bigint, node bigint")
    every = max(1, rows_of_docs // FREQUENT_SAMPLE)
    sample = docs.where(f"pmod(xxhash64(doc_id), {every}) = 0").select("text").mapInArrow(keys, "key bigint, node bigint")
    return written(repeated_keys(rows, frequent_values(sample.select("key"), HOT_AT)), "members")


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(x, y)`` whose sizes and sketches do not rule out a link."""
    def test(batches):
        for batch in batches:
            keep = []
            for part in slices(batch, SLICE):
                for a, b, n, m in zip(*(part.column(c).to_pylist() for c in ("sketch_x", "sketch_y", "n_x", "n_y"))):
                    keep.append(percent * max(n, m) <= 100 * min(n, m) and sketch_distance(
                        np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)) <= most_apart(n, m, percent))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    for end in ("x", "y"):
        side = nodes.selectExpr(f"node AS {end}", f"n_shingles AS n_{end}", f"sketch AS sketch_{end}")
        pairs = pairs.join(side.hint("merge"), end)
    return pairs.mapInArrow(test, "x bigint, y bigint")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, text)`` for each of ``nodes(node, digest)``: one text that has the set, whatever its id."""
    found = docs.selectExpr(f"{TEXT_DIGEST} AS digest", "text").join(nodes.hint("merge"), "digest")
    return found.dropDuplicates(["node"]).select("node", "text")


def _verified(close: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of ``close(x, y)`` that link, by an exact comparison of the sets of both texts.

    The text of ``y`` travels once for up to about ``VERIFIED`` of its partners, whose texts follow it in one stream.
    """
    def compare(batches):
        of, ours = None, None
        for batch in batches:
            for part in slices(batch, SLICE):
                keep, shard, x = [], part.column("part").to_pylist(), part.column("x").to_pylist()
                for i, (y, hashes) in enumerate(zip(part.column("y").to_pylist(), shingle_sets(part.column("text"), words))):
                    if x[i] is None:
                        of, ours = (y, shard[i]), hashes
                    keep.append(x[i] is not None and of == (y, shard[i]) and jaccard_links(hashes, ours, percent))
                yield part.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    partners = close.groupBy("y").agg(F.expr(f"ceil(count(*) / {VERIFIED})").alias("parts"))
    pairs = close.join(partners.hint("merge"), "y").selectExpr("y", "x", "pmod(xxhash64(x), parts) AS part")
    heads = pairs.select("y", "part").distinct().join(texts.withColumnRenamed("node", "y").hint("merge"), "y").selectExpr(
        "y", "part", "CAST(NULL AS bigint) AS x", "text")
    others = pairs.join(texts.withColumnRenamed("node", "x").hint("merge"), "x").select("y", "part", "x", "text")
    return heads.unionByName(others).repartition("y", "part").sortWithinPartitions("y", "part", "x").mapInArrow(
        compare, "x bigint, y bigint")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``(x, y)`` whose ends are in different components."""
    for end in ("x", "y"):
        pairs = pairs.join(labels.selectExpr(f"node AS {end}", f"component AS of_{end}").hint("merge"), end, "left")
    return pairs.where("coalesce(of_x, x) != coalesce(of_y, y)").select("x", "y")


def _pairs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of each two members of one group, of which each begins at one of ``starts`` and ends before the next."""
    first = np.arange(starts[0], starts[-1])
    partners = np.repeat(starts[1:], np.diff(starts)) - 1 - first
    i = np.repeat(first, partners)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(partners) - partners, partners)


def _folds_apart(folds: pa.Array, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing bits of the sketches at ``i`` and ``j``, each pair at the size of the smaller."""
    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    found = [np.frombuffer(f, np.uint8) for f in folds.take(pa.array(used)).to_pylist()]
    sizes = np.array([len(f) for f in found], np.int64)
    a, b = place[:len(i)], place[len(i):]
    least = np.minimum(sizes[a], sizes[b])
    apart = np.zeros(len(i), np.int64)
    for size in np.unique(least).tolist():
        some = np.flatnonzero(least == size)
        members, at = np.unique(np.concatenate([a[some], b[some]]), return_inverse=True)
        bits = np.array([folded_to(found[m], size) for m in members.tolist()]).view(np.uint64)
        for first in range(0, len(some), PAIRS_AT_ONCE):
            last = min(first + PAIRS_AT_ONCE, len(some))
            apart[some[first:last]] = np.bitwise_count(
                bits[at[first:last]] ^ bits[at[len(some) + first:len(some) + last]]).sum(1, dtype=np.int64)
    return apart


def _within(groups: DataFrame, percent: int) -> DataFrame:
    """``(x, y)``, each once: members of one of ``groups(members)``, of at most ``GROUP_BLOCK`` members, that are in
    different components and that neither sizes nor folds rule out."""
    def pairs(batches):
        for batch in batches:
            for part in slices(batch, SLICE):
                lists = part.column(0)
                starts = lists.offsets.to_numpy().astype(np.int64)
                node, label, size = (lists.values.field(c).to_numpy() for c in ("node", "label", "n_shingles"))
                i, j = _pairs_of(starts)
                i, j = (x[label[i] != label[j]] for x in (i, j))
                smaller, larger = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                i, j = (x[percent * larger <= 100 * smaller] for x in (i, j))
                # sets that meet in many groups are compared once
                x, y = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                order = np.lexsort((y, x))
                once = order[np.concatenate([[True], (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)])[:len(order)]]
                i, j, x, y = (a[once] for a in (i, j, x, y))
                near = _folds_apart(lists.values.field("fold"), i, j) <= (100 - percent) * (size[i] + size[j]) // (100 + percent)
                x, y = x[near], y[near]
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

    return groups.select("members").mapInArrow(pairs, "x bigint, y bigint").distinct()


def _between(blocks: DataFrame, percent: int) -> DataFrame:
    """``(x, y)``, each once: members of larger groups, laid out in ``blocks(key, blocks, block, members)``, that are in
    different components and whose sketches do not rule out a link. Each two blocks of a group meet in one row."""
    def columns(block: dict) -> tuple[np.ndarray, ...]:
        members = block["members"]
        return (*(np.array([m[c] for m in members], np.int64) for c in ("node", "label", "n_shingles")),
                [np.frombuffer(m["sketch"], np.uint8) for m in members])

    def compare(batches):
        for batch in batches:
            for part in slices(batch, 1):
                found = set()
                row = part.to_pylist()[0]
                a, b = columns(row["left"]), columns(row["right"])
                both = alike(a[3] + b[3])
                ours, theirs = both[:len(a[3])], both[len(a[3]):]
                for i in range(len(ours)):
                    apart = np.bitwise_count(theirs ^ ours[i]).sum(1, dtype=np.int64)
                    smaller, larger = np.minimum(b[2], a[2][i]), np.maximum(b[2], a[2][i])
                    close = ((b[1] != a[1][i]) & (percent * larger <= 100 * smaller)
                             & (apart <= (100 - percent) * (smaller + larger) // (100 + percent)))
                    x = int(a[0][i])
                    found.update((min(x, y), max(x, y)) for y in b[0][close].tolist())
                x, y = zip(*found) if found else [[]] * 2
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    left = blocks.selectExpr("key", "blocks", "struct(members) AS left", "block AS low",
                             "explode(sequence(block, blocks - 1)) AS high")
    right = blocks.selectExpr("key", "blocks", "struct(members) AS right", "block AS high", "explode(sequence(0, block)) AS low")
    return left.join(right.hint("merge"), ["key", "blocks", "low", "high"]).select("left", "right").mapInArrow(
        compare, "x bigint, y bigint").distinct()


def _across(open_groups: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The written pairs ``(x, y)`` of different components in a group that their sketches do not rule out.

    ``open_groups(key, node, n)`` has ``n`` members to a key. Groups of up to ``GROUP_BLOCK`` members compare their
    folds, and a pair that these leave meets its sketches once, in however many groups it is. Larger groups are laid
    out in blocks with sketches, and only pairs that pass leave the task. Keys with the same few members are one group
    before the folds join them.
    """
    sized = nodes.join(labels.hint("merge"), "node", "left").selectExpr(
        "node", "coalesce(component, node) AS label", "n_shingles", "fold")
    member = F.struct("node", "label", "n_shingles", "fold")
    groups = written(open_groups.where(f"n <= {GROUP_BLOCK}").groupBy("key").agg(
        F.sort_array(F.collect_set("node")).alias("nodes")).select(
        F.xxhash64("nodes").alias("group"), "nodes").dropDuplicates(["group"]).select(
        "group", F.explode("nodes").alias("node")), "groups")
    small = groups.join(sized.hint("merge"), "node").groupBy("group").agg(F.collect_list(member).alias("members"))
    narrow = written(_within(small, percent), "pairs")
    discard(groups)
    close = written(_close(narrow, nodes, percent), "close")
    discard(narrow)
    large = open_groups.where(f"n > {GROUP_BLOCK}").withColumn(
        "blocks", F.expr(f"CAST(ceil(n / {GROUP_BLOCK}) AS int)")).withColumn(
        "block", F.expr("CAST(pmod(xxhash64(node), blocks) AS int)"))
    blocks = written(large.join(sized.drop("fold").hint("merge"), "node").join(
        nodes.select("node", "sketch").hint("merge"), "node").groupBy("key", "blocks", "block").agg(
        F.collect_list(F.struct("node", "label", "n_shingles", "sketch")).alias("members")), "blocks")
    both = written(close.union(_between(blocks, percent)).distinct(), "close")
    discard(blocks)
    discard(close)
    return both


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``docs(doc_id, text)``.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of word shingles;
    ``component_id`` is the smallest id that can be reached. Null, empty and blank texts have an empty set and
    link with nothing. Equal sets are one node from the start, so copies and repeated rows cost nothing
    further. A null id links like any other, is never the smallest, and is in the component of its text; an id
    with several texts links by each of them, in a row each.
    """
    docs = docs.selectExpr("doc_id", "CAST(text AS binary) AS text")
    sets = written(_document_sets(docs, words), "sets")
    nodes = written(sets.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("digest").alias("digest"), F.max("n_shingles").alias("n_shingles"),
        F.max("sketch").alias("sketch"), F.max("fold").alias("fold")), "nodes")
    rows = sets.count()
    members = _members(docs, rows, words, percent, _frequent(docs, rows, words))

    groups = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    weighed = written(members.join(groups.hint("merge"), "key").groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    ranked = members.join(weighed.hint("merge"), "node")
    # the member that shares most with others: the text that near copies were made from, or the least changed
    centers = written(ranked.groupBy("key").agg(F.expr("max(struct(weight, node))").alias("best")).selectExpr(
        "key", "best.node AS y", "best.weight AS weight"), "centers")
    first = written(members.withColumnRenamed("node", "x").join(centers.hint("merge"), "key").where(
        "x != y").groupBy("x", "y").agg(F.max("weight").alias("weight")), "first")
    discard(centers)
    texts = written(_texts(docs, nodes.select("node", "digest").join(weighed.select("node").hint("merge"), "node")), "texts")
    discard(weighed)

    def linked(pairs: DataFrame) -> DataFrame:
        close = written(_close(pairs, nodes, percent), "close")
        out = written(_verified(close, texts, words, percent), "links")
        discard(close)
        return out

    # texts travel for one center of each member at first, then for pairs that are still apart
    links = linked(first.groupBy("x").agg(F.expr("max(struct(weight, y)).y").alias("y")))
    labels = written(components(links.toDF("a", "b")), "labels")
    links = links.unionByName(linked(_apart(first, labels)))
    discard(first)
    discard(labels)
    labels = written(components(links.toDF("a", "b")), "labels")

    labelled = members.join(labels.hint("merge"), "node", "left").selectExpr(
        "key", "node", "coalesce(component, node) AS label")
    mixed = labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where(
        "low < high").select("key", "n")
    open_groups = written(labelled.select("key", "node").join(mixed.hint("merge"), "key"), "open")
    discard(members)
    across = _across(open_groups, nodes, labels, percent)
    discard(open_groups)
    more = written(_verified(across, texts, words, percent), "links")
    discard(across)
    discard(texts)

    found = components(links.unionByName(more).toDF("a", "b")).join(nodes.select("node", "doc_id"), "node")
    smallest = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = found.join(smallest.hint("merge"), "component").select("node", "component_id")
    own = nodes.selectExpr("node", "doc_id AS own_id").join(of_node.hint("merge"), "node", "left").selectExpr(
        "node", "coalesce(component_id, own_id) AS component_id")
    return sets.join(own.hint("merge"), "node", "left").selectExpr(
        "doc_id", "n_shingles", "IF(node IS NULL, doc_id, component_id) AS component_id")
