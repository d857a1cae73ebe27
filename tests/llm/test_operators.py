"""Each operator against a slow and obvious version, on rows with nulls, empty and long texts, copies and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from edgeloom.llm import jaccard, lm, mixing, packing, qda, rules, suffix, textstats, tokens, topk, warc, words
from edgeloom.llm.components import components
from edgeloom.llm.queries import tokenizer_path
from edgeloom.plans import scratch_path

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, size STRING, `key` INT, n_words DOUBLE, row INT"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgäß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def texts():
    rng = random.Random(4)
    base, passage = sentence(rng, 120), sentence(rng, 30)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (6, "x " * 3000), (7, sentence(rng, 5000))]
    rows += [(10 + i, base) for i in range(3)] + [(10, base)]  # copies, and a row twice
    for i in range(12):
        words = base.split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = "new"
        rows.append((20 + i, " ".join(words)))
    rows += [(40 + i, f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}") for i in range(8)]
    rows += [(60 + i, "\n".join([sentence(rng, 8)] * 3 + ["*** $$$ ###"] * (i % 5))) for i in range(10)]
    rows += [(80, "a b c <|endoftext|> d  e\n\n f\r\n"), (81, "日本語 テキスト 😀" * 5), (None, base), (None, None)]
    return rows


ROWS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    sources = ["b", None, "a", "Z", "b", "b"]
    data = [(i, t, "en", sources[k % 6], None, "?", k, 0.5, k) for k, (i, t) in enumerate(ROWS)]
    found = spark.createDataFrame(data, SCHEMA).repartition(3).cache()
    yield found
    found.unpersist()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def collected(df):
    return Counter(map(tuple, df.collect()))


def stats(text):
    data = (text or "").encode()
    words, lines = WORD.findall(data), [x for x in data.split(b"\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_text_counts(docs, nothing):
    got = textstats.text_counts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collected(got) == Counter((i, *stats(t)) for i, t in ROWS)
    assert textstats.text_counts(nothing).count() == 0
    kept = textstats.with_shares(textstats.text_counts(docs, with_row=True)).select("row.*")
    assert collected(kept) == collected(docs)


def test_repeated_words_of_many_different_words():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 40, 500)
    want = textstats.repeated_words(ids)
    assert 0 < want and textstats.repeated_words(ids * 3_000_000) == want


def test_rules(spark, docs, nothing):
    rng = np.random.default_rng(1)
    columns = {"symbol_share": rng.random(2000), "mean_word": rng.random(2000)}
    quality = 1 - ((columns["symbol_share"] > 0.8) | ((columns["mean_word"] < 0.1) & (columns["symbol_share"] < 0.5))).astype(int)
    found = rules.learn_rules(columns, quality)
    frame = spark.createDataFrame(list(zip(*(v.tolist() for v in columns.values()), quality.tolist())), "symbol_share DOUBLE, mean_word DOUBLE, quality INT")
    judged = frame.withColumn("rule", rules.rule_number(found)).toPandas()
    assert ((judged["rule"].isna()).astype(int) == judged["quality"]).mean() > 0.99
    assert rules.learn_rules(columns, np.ones(2000)) == [] and rules.learn_rules({"a": np.zeros(0)}, np.zeros(0)) == []
    labels = spark.createDataFrame([(60 + i, i % 2, 0, "x") for i in range(10)] + [(None, 0, 0, "x"), (1, None, 0, "x")],
                                   "doc_id BIGINT, quality INT, toxic INT, text STRING")
    judged = rules.apply_rules(docs, rules.fit_rules(docs, labels))
    base = {(i, t): stats(t)[0] < 50 or 2 * stats(t)[4] > stats(t)[0] for i, t in ROWS}
    assert collected(judged.select("doc_id", "base_failed")) == Counter((i, base[i, t]) for i, t in ROWS)
    assert judged.where("kept AND base_failed").count() == 0
    assert rules.apply_rules(nothing, rules.fit_rules(nothing, labels)).count() == 0


def test_classifier(spark, docs, nothing):
    rng = np.random.default_rng(2)
    x = [rng.normal(size=(400, 3)), rng.normal(size=(300, 3)) * [1, 2, 3] + [2, 0, 0]]
    n = np.array([400.0, 300.0])
    model = qda.fit_moments(n, np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), shrink=0.0, ridge=0.0)
    for k in (0, 1):  # with hardly any shrinkage the log density of a Gaussian
        assert model.means[k] == pytest.approx(x[k].mean(0))
    assert (model.score(x[1]) > 0.5).mean() > 0.8 > 0.3 > (model.score(x[0]) > 0.5).mean()
    labels = spark.createDataFrame([(60 + i, i % 2) for i in range(10)] + [(40, 1), (41, 0), (None, 1)], "doc_id BIGINT, quality INT")
    scored = qda.quality_scores(docs, labels, "doc_id != 41").collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in qda.quality_scores(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in qda.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert qda.quality_scores(nothing, labels).count() == 0


def test_mixing(spark, docs, nothing):
    rows = mixing.mix(docs, bucket_rows=5).collect()
    sizes = Counter((i, len(WORD.findall((t or "").encode()))) for i, t in ROWS)
    assert Counter((r.doc_id, r.size) for r in rows) == sizes
    total = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in rows:
        assert r.taken == r.size * r.times and r.times <= 3
        own = total[r.source]
        own[0], own[1], own[2], own[3] = own[0] + r.size, own[1] + r.taken, r.target, max(own[3], r.size)
    assert sum(t for _, _, t, _ in total.values()) == pytest.approx(sum(s for s, *_ in total.values()))
    for size, taken, target, largest in total.values():
        assert target <= 3 * size + 1e-6 and abs(taken - target) <= largest
    assert collected(mixing.mix(docs.repartition(5), bucket_rows=1_000_000)) == Counter(map(tuple, rows))
    assert mixing.mix(nothing).count() == 0
    flat = spark.createDataFrame([("a", 10), ("b", 1000), (None, 0)], "source STRING, source_size BIGINT")
    assert {r.source: r.target for r in mixing.source_targets(flat).collect()} == {"a": 30.0, "b": 980.0, None: 0.0}


def test_encoder_gives_the_ids_of_the_library():
    library, own = Tokenizer.from_file(tokenizer_path()), tokens.Encoder(tokenizer_path())
    rng = random.Random(9)
    cases = [t or "" for _, t in ROWS] + ["<|endoftext|><|endoftext|> x", "  ", "\t\n a  b\x1c \x1c"]
    cases += ["".join(rng.choice("ab 1\n\t'sé漢😀. <|>") for _ in range(40)) for _ in range(300)]
    for text in cases:
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_counts_and_their_cache(spark, docs, nothing):
    library, cache = Tokenizer.from_file(tokenizer_path()), scratch_path(spark, "cache")
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    assert collected(tokens.token_counts(docs.where("doc_id < 40"), tokenizer_path(), cache)) == Counter(
        {k: n for k, n in want.items() if k[0] is not None and k[0] < 40})
    assert collected(tokens.token_counts(docs, tokenizer_path(), cache)) == want
    stored = spark.read.parquet(f"{cache}/tokenizer={tokens.tokenizer_digest(tokenizer_path())}")
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for _, t in ROWS})
    assert tokens.token_counts(nothing, tokenizer_path(), cache).count() == 0


def test_sequence_plan():
    rng = random.Random(3)
    for n in (0, 1, 50, 3000):
        histogram = Counter(min(64, max(1, int(rng.expovariate(1 / 20)))) for _ in range(n))
        plan, used = packing.plan_sequences(histogram, 64), Counter()
        for config, repeats in plan:
            assert sum(k * times for k, times in config.items()) <= 64
            for k, times in config.items():
                used[k] += times * repeats
        assert used == histogram
        if n:
            assert sum(r for _, r in plan) <= 1.02 * -(-sum(k * v for k, v in histogram.items()) // 64) + 1


def test_packing(docs, nothing):
    library = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack(docs, tokenizer_path(), capacity=128, with_ids=True, bucket_rows=4).toPandas()
    got = defaultdict(list)
    for (doc, _), piece in rows.groupby([rows.doc_id.fillna(-1), "piece"]):
        assert (piece.length == [len(x) for x in piece.ids]).all() and (piece.length <= 128).all()
        assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(piece.ids, piece.ids_crc32))
        got[int(doc)].append(sorted(map(tuple, piece.ids)))
    want = defaultdict(list)
    for i, t in ROWS:
        want[-1 if i is None else i].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    for doc, lists in want.items():
        assert sorted(x for part in got[doc] for ids in part for x in ids) == sorted(x for ids in lists for x in ids)
        if len(lists) == 1:
            assert [x for part in got[doc] for x in part[0]] == lists[0]
            assert all(len(part[0]) == 128 for part in got[doc][1:])
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert list(own.offset) == list(np.cumsum([0, *own.length])[:-1]) and own.length.sum() <= 128
    assert packing.pack(nothing, tokenizer_path()).count() == 0


def linked(rows, words, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group}
    return Counter((i, len(s), least[g]) for (i, _), s, g in zip(rows, sets, group))


@pytest.mark.parametrize("words, percent, block", [(4, 85, 256), (5, 80, 2)])
def test_similar_documents(docs, nothing, monkeypatch, words, percent, block):
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", block)
    assert collected(jaccard.similar_documents(docs, words, percent)) == linked(ROWS, words, percent)
    assert jaccard.similar_documents(nothing).count() == 0


def test_rows_without_id_and_ids_of_several_texts_link(spark):
    words = sentence(random.Random(8), 200).split()
    near = [" ".join(["new"] * k + words[k:]) for k in (0, 12, 24)]
    other = sentence(random.Random(9), 150)
    rows = [(4, near[0]), (None, near[1]), (7, near[2]), (9, other), (9, f"{other} more"), (8, other.replace(" ", "  ")),
            (None, "alone and without an id"), (3, "short"), (5, "Short")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(2)
    got = collected(jaccard.similar_documents(docs).select("doc_id", "component_id"))
    assert got == Counter([(4, 4), (None, 4), (7, 4), (9, 8), (9, 8), (8, 8), (None, None), (3, 3), (5, 3)])


def test_hashes_of_words():
    rng = random.Random(3)
    found = [" A\tb\x0bcc\x00 \u3000é ".encode(), None, b"", b"B a", b"x" * 70_000 + b" a", sentence(rng, 300).encode(), b" \n"]
    split = [(t or b"").lower().split() for t in found]
    assert [len(words.text_hashes(t)) for t in found] == list(map(len, split))
    number = {}
    for t, own in zip(found, split):
        for w, h in zip(own, words.text_hashes(t).tolist()):
            assert number.setdefault(w, h) == h
    assert len(set(number.values())) == len(number)
    for size in (1, 50, 1 << 20):
        words.GROUP_BYTES, before = size, words.GROUP_BYTES
        try:
            column = pa.array([b"cut", *found], pa.binary()).slice(1)
            flat = [h for _, hashes, _ in words.word_groups(column) for h in hashes.tolist()]
            counts = [n for _, _, own in words.word_groups(column) for n in own.tolist()]
        finally:
            words.GROUP_BYTES = before
        assert counts == list(map(len, split)) and flat == [number[w] for own in split for w in own]


def test_chunks_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    for percent in (80, 85, 95):
        scheme = jaccard.Bands(percent)
        for size in (6, 7, 20, 90, 400, 3000):
            for _ in range(15):
                a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) << np.uint64(1))
                apart = jaccard.most_apart(len(a), len(a), percent) // 2
                b = np.unique(np.concatenate([a[apart:] if rng.random() < 0.5 else a, rng.integers(0, 2**63, rng.integers(0, apart + 1)).astype(np.uint64)]))
                if not jaccard.jaccard_links(a, b, percent) or np.array_equal(a, b):
                    continue
                frequent = np.sort(rng.choice(a, len(a) // 2, replace=False))
                for often in (np.empty(0, np.uint64), frequent):
                    assert len(np.intersect1d(jaccard.chunk_keys(a, scheme, often), jaccard.chunk_keys(b, scheme, often)))
                assert jaccard.sketch_distance(jaccard.folded_sketch(a), jaccard.folded_sketch(b)) <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100, v) for v in range(101, 140)] + [(5, 5), (None, 3)]
    group = {v: v for a, b in links if a is not None for v in (a, b)}
    for _ in group:
        for a, b in links:
            if a is not None:
                group[a] = group[b] = min(group[a], group[b])
    got = components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()
    assert {r.node: r.component for r in got} == group and len(got) == len(group)


@pytest.mark.parametrize("length, kmer, batches, sample", [(50, 20, 1, 2000), (50, 20, 4, 5), (8, 3, 2, 2000)])
def test_remove_repeats(docs, nothing, monkeypatch, length, kmer, batches, sample):
    monkeypatch.setattr(suffix, "HOT_AT", 3)  # so that some keys are settled string by string
    monkeypatch.setattr(suffix, "HOT_SAMPLE", sample)
    monkeypatch.setattr(suffix, "BLOCK", 700)
    rows = [(i, (t or "").encode()) for i, t in ROWS]
    first = {}
    for i, data in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k in range(len(data) - length + 1):
            first.setdefault(data[k:k + length], i)
    want = Counter()
    for i, data in rows:
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1 if i is not None else 0):
            if first[data[k:k + length]] < i:
                gone[k:k + length] = True
        left = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        want[i, len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest()] += 1
    assert collected(suffix.remove_repeats(docs, length, kmer, batches)) == want
    assert suffix.remove_repeats(nothing, length, kmer, batches).count() == 0


def test_levels_merge_geometrically(docs):
    index = suffix.SuffixIndex()
    own = docs.selectExpr("doc_id", "CAST(text AS binary) AS text").where("doc_id IS NOT NULL")
    sizes = []
    for k in range(5):
        index.add(own.where(f"doc_id % 5 = {k}").withColumn("doc_id", own.doc_id + 1000 * k), own)
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_language_model(docs, nothing):
    train, held = "coalesce(doc_id % 3 != 0, true)", lambda i: i is not None and i % 3 == 0
    words = [[*WORD.findall((t or "").encode().lower()), None] for _, t in ROWS]
    counts = Counter(w for (i, _), own in zip(ROWS, words) if not held(i) for w in own)
    n, v = sum(counts.values()), len(counts)
    want = sorted((i is None, i or 0, len(own), sum(counts[w] > 0 for w in own), n,
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)) for (i, _), own in zip(ROWS, words))
    got = lm.score_texts(docs, train).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert lm.score_texts(nothing, train).count() == 0
    assert {r.score for r in lm.score_texts(docs, "false").collect()} == {0.0}


def test_states_give_probabilities(docs):
    tree, words = lm.fit(docs)
    assert (tree.rest < 0).any()
    rows = words.collect()
    context = lm.word_hashes(b" ".join(ROWS[7][1].encode().split()[:9]))[:-1]
    held, before = set(tree.words.tolist()), tree.score(context)
    new = math.log10(lm.ADD) - tree.log_scale
    total = 10 ** (tree.score(np.array([*context, 12345])) - before)
    for row in rows:
        score = tree.score(np.array([*context, row.gram]))
        rare = 0 if row.gram in held else math.log10(row.c + lm.ADD) - tree.log_scale - new
        total += 10 ** (score - before + rare)
    assert total == pytest.approx(1.0, abs=1e-6)


def suffix_tree_scores(train, texts):
    """Scores of lists of words, with every n-gram of the tree in a dictionary."""
    counts = Counter(tuple(own[i:i + k]) for own in train for k in range(1, lm.DEPTH + 2) for i in range(len(own) - k + 1))
    total, vocabulary = sum(map(len, train)), {g for g in counts if len(g) == 1}
    given = {g: (counts[g] + lm.ADD) / (total + lm.ADD * (len(vocabulary) + 1)) for g in vocabulary}
    new, rest = lm.ADD / (total + lm.ADD * (len(vocabulary) + 1)), {}
    for k in range(2, lm.DEPTH + 2):
        symbols = defaultdict(list)
        for g, c in counts.items():
            if len(g) == k and c >= lm.LEAST:
                symbols[g[:-1]].append(g)
        for context, grams in symbols.items():
            seen = {g: (counts[g] - lm.DISCOUNT) / counts[context] for g in grams}
            left = max(1 - sum(seen.values()), 1e-12)
            own = {g: seen[g] + left * given[g[1:]] for g in grams}
            gain = sum(p * math.log(p / given[g[1:]]) for g, p in own.items())
            other, below = (max(1 - sum(x), 1e-12) for x in (own.values(), [given[g[1:]] for g in grams]))
            state = counts[context] * (gain + other * math.log(other / below)) > 0.5 * math.log(max(total, 2)) * len(grams)
            rest[context] = left if state else 1
            given |= own if state else {g: given[g[1:]] for g in grams}

    def probability(context, word):
        gram = (*context, word)
        if gram in given:
            return given[gram]
        return rest.get(context, 1) * probability(context[1:], word) if context else new

    return [sum(math.log10(probability(tuple(own[max(0, i - lm.DEPTH):i]), w)) for i, w in enumerate(own)) for own in texts]


@pytest.mark.parametrize("share", [1e-6, 2e-3, 2.0])
def test_tree_does_not_depend_on_what_is_sent_to_tasks(docs, share):
    words = [[*WORD.findall((t or "").encode().lower()), None] for _, t in ROWS]
    train = [own for (i, _), own in zip(ROWS, words) if not (i is not None and i % 3 == 0)]
    want = sorted((i is None, i or 0, round(s, 6)) for (i, _), s in zip(ROWS, suffix_tree_scores(train, words)))
    got = sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 6)) for r in lm.score_texts(docs, "coalesce(doc_id % 3 != 0, true)", share=share).collect())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], abs=1e-5)


def test_larger_corpus_keeps_states(spark):
    def states(more):
        rows = [("often then",)] * 8 + [(" ".join(f"w{i}" for i in range(more)),)]
        model = lm.fit_tables(spark.createDataFrame(rows, "text string"))[3]
        return {r.gram for r in model.where("rest < 0").collect()}, lm.score_texts(
            spark.createDataFrame([(i, t) for i, (t,) in enumerate(rows)], "doc_id bigint, text string"), share=1e-2).where("doc_id = 0").first()

    key = int(lm.word_hashes(b"often")[0])
    for more in (10, 5000):
        found, row = states(more)
        assert key in found and row.score > row.base_score + 1


def test_top_k(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(size=12) / 3]) for i in range(300)]
    vectors += [(300 + i, vectors[5][1]) for i in range(8)] + [(5, vectors[5][1])]  # ties, and a row twice
    vectors += [(400, None), (410, [1.0, None]), (420, [float("nan")] * 12), (430, [float("inf")] * 12), (440, []), (450, [0.0] * 12), (460, [3e6, -1.0]), (470, [2e6] * 12)]
    frame = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors
             if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = Counter()
    for q in (i for i in whole if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want.update((q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1))
    got = topk.top_k(frame, "vec_id % 10 = 0", shard_rows=64, block_rows=7)
    assert collected(got) == want
    assert topk.top_k(frame.limit(0), "true").count() == 0
    assert collected(topk.top_k(frame.where("vec_id = 0"), "true")) == Counter()
    for large in ([1e30, 1.0], [1e7, 1e7, 2e7]):
        with pytest.raises(Exception, match="scores of vector 9 are beyond 64 bits"):
            topk.quantised(spark.createDataFrame([(1, [1.0]), (9, large)], "vec_id BIGINT, embedding ARRAY<DOUBLE>"), "vec_id", "embedding").collect()


def test_runs_at_once_count_a_text_once(spark, docs):
    cache = scratch_path(spark, "tokens")
    want = collected(tokens.token_counts(docs, tokenizer_path(), cache))
    folder = f"{cache}/tokenizer={tokens.tokenizer_digest(tokenizer_path())}"
    spark.read.parquet(folder).write.mode("append").parquet(folder + "-other")
    spark.read.parquet(folder + "-other").write.mode("append").parquet(folder)  # as another first run leaves it
    assert collected(tokens.token_counts(docs, tokenizer_path(), cache)) == want and want.total() == len(ROWS)


def test_one_id_with_very_many_rows_is_one_of_the_sample(spark):
    docs = spark.range(500).selectExpr("1L AS doc_id", "concat('text ', id) AS text").union(spark.sql("SELECT 2L, 'other'"))
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id BIGINT, quality INT")
    assert rules.labelled_sample(docs, labels).count() == 2


def test_rows_without_an_id_draw_by_their_text(spark):
    docs = spark.range(2000).selectExpr("CAST(NULL AS bigint) AS doc_id", "concat('word ', id) AS text", "'s' AS source")
    assert mixing.mix(docs).select("key").distinct().count() == 2000


def test_warc(spark):
    pages = [(i, f"http://h/{i} é\r\n", f"<p>{i % 4}</p>" * 50) for i in range(40)]
    pages += [(50, None, None), (51, "u", ""), (52, "u", "\r\n\r\nWARC/1.1"), (None, "u", "<p>1</p>" * 50), (None, None, "alone"), (7, pages[7][1], pages[7][2])]
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id BIGINT, url STRING, html STRING, digest STRING, size STRING")
    folder = scratch_path(spark, "warc")
    index = warc.write_bundles(frame, folder, frame_bytes=2000, bundle_bytes=4000)
    kept = defaultdict(lambda: -1)
    for i, _, html in pages:
        kept[html or ""] = max(kept[html or ""], -1 if i is None else i)
    want = Counter()
    for i, _, html in pages:
        data, best = (html or "").encode(), kept[html or ""]
        own = best == -1 or i == best
        want[i, len(data), warc.payload_digest(data), "response" if own else "revisit", None if own else best, data if own else None] += 1
    assert collected(warc.read_bundles(index, folder)) == want
    wanted = spark.createDataFrame([(7,), (39,), (50,), (999,)], "page_id BIGINT")
    assert collected(warc.lookup(index, folder, wanted)) == Counter({k: n for k, n in want.items() if k[0] in (7, 39, 50)})
    assert index.select("bundle").distinct().count() > 1
    none = scratch_path(spark, "warc")
    assert warc.read_bundles(warc.write_bundles(frame.limit(0), none), none).count() == 0


def test_seek_table_is_a_skippable_frame():
    import zstandard

    frames = [zstandard.ZstdCompressor().compress(b"a" * n) for n in (10, 2000)]
    data = b"".join(frames) + warc.seek_table([(len(f), n) for f, n in zip(frames, (10, 2000))])
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"a" * 2010


def test_texts_are_hashed_together_as_alone(spark):
    rng = np.random.default_rng(5)
    line = rng.integers(97, 101, 400, np.uint8).tobytes()
    texts = [line[rng.integers(0, 200):][:int(rng.integers(0, 300))] for _ in range(60)] + [None, b"", line[:49], line[:50]]
    alone = [[(int(k), int(r), int(b - a)) for _, f in suffix.blocks(t or b"", 50, 20) for k, r, a, b in zip(f.key, f.run, f.first, f.last)]
             for t in texts]
    together = [[] for _ in texts]
    calls = 0
    for i, _, _, found in suffix.groups(texts, 50, 20):
        calls += 1
        for k, r, a, b, of in zip(found.key, found.run, found.first, found.last, found.text):
            together[i + of].append((int(k), int(r), int(b - a)))
    assert together == alone and calls == 1  # was one for each text


def test_members_of_many_groups_are_compared_at_once():
    starts = np.array([2, 5, 5, 6, 8])
    i, j = jaccard._pairs_of(starts)
    assert list(zip(i.tolist(), j.tolist())) == [(2, 3), (2, 4), (3, 4), (6, 7)]
    rng = np.random.default_rng(1)
    found = [rng.integers(0, 256, size, np.uint8) for size in (16, 32, 32, 64)]
    i, j = np.triu_indices(4, 1)
    apart = jaccard._folds_apart(pa.array([f.tobytes() for f in found], pa.binary()), i, j)
    assert apart.tolist() == [jaccard.sketch_distance(found[a], found[b]) for a, b in zip(i, j)]


def test_large_sets_in_one_group_are_told_apart_by_their_folds(spark):
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.integers(0, 1 << 63, n, np.int64).astype(np.uint64)) for n in (3000, 3100, 4096, 4100, 7000, 7500)]
    sets.append(sets[-1][100:])
    folds = [jaccard.fold_of(jaccard.folded_sketch(s)).tobytes() for s in sets]
    rows = [(0, [(i, i, len(s), f) for i, (s, f) in enumerate(zip(sets, folds))])]
    groups = spark.createDataFrame(rows, "key INT, members ARRAY<STRUCT<node: BIGINT, label: BIGINT, n_shingles: BIGINT, fold: BINARY>>")
    assert [tuple(r) for r in jaccard._within(groups, 80).collect()] == [(5, 6)]


def test_slots_find_what_binary_search_finds():
    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate([rng.integers(-2**63, 2**63 - 1, 5000), np.arange(300), -np.arange(300)]))  # and many with equal leading bits
    asked = np.concatenate([keys, keys + 7, rng.integers(-2**63, 2**63 - 1, 5000)])
    for some in (keys, keys[:1], keys[:0]):
        assert (lm.Slots(some).find(asked) == lm.find(some, asked)).all()


def test_language_model_sends_small_batches(spark, docs, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, written, seen, largest = spark.conf.get(name), lm.written, set(), []

    def noting(df, table):
        if not largest:
            rows = spark.range(0, 400, 1, 1).selectExpr("CAST(repeat('x', 100000) AS binary) AS b").mapInArrow(sizes, "n bigint")
            largest.append(max(r.n for r in rows.collect()))
        seen.add(spark.conf.get(name))
        return written(df, table)

    monkeypatch.setattr(lm, "written", noting)
    lm.score_texts(docs)
    assert seen == {"4m"} and largest[0] < 8_000_000 and spark.conf.get(name) == before
