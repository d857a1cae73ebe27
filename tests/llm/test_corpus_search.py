"""Common lines, ranked search and phrases against slow and obvious versions, on odd rows as well."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from edgeloom.llm import lines, phrases, ranked

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, n_lines INT, rank DOUBLE, score STRING, n INT, phrase INT, kept INT, place INT"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = ["the", "of", "sea", "Sea", "ÄPFEL", "äpfel", "日本", "a1", "x", "long" * 30, "no break", "de", "la"]


def texts():
    rng = random.Random(11)
    common = ["  Menu | Home\t", "MENU | HOME", "", "   ", "© 2020 all rights", "ß　"]
    rows = [(1, None, "en"), (2, "", None), (3, " \n\t \n\r\n", "en"), (4, "one\n\n", "und")]
    for i in range(120):
        body = []
        for _ in range(rng.randint(0, 5)):
            words = [rng.choice(VOCABULARY) for _ in range(rng.randint(1, 9))]
            body.append(rng.choice([" ", "  ", "\t", ", "]).join(words) + rng.choice([".", "", "!?", " ;", "\r"]))
            if rng.random() < 0.5:
                body.append(rng.choice(common))
        rows.append((10 + i, "\n".join(body), rng.choice(["en", "en", "fr", None])))
    rows += [(500, "the sea of x " * 4000, "en"), (None, "the sea\nMenu | Home", "fr"), (None, "the sea\nMenu | Home", "fr")]
    return rows + rows[20:23] + [(10, "another text\nmenu | home", "en")]  # rows twice, an id twice


ROWS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    found = spark.createDataFrame([(i, t, g, 1, 0.5, "?", 2, 3, 4, 5) for i, t, g in ROWS], SCHEMA).repartition(3).cache()
    yield found
    found.unpersist()


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def without_common_lines(rows, at_least, min_chars):
    seen = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= max(1, min_chars))
    for doc_id, text, _ in rows:
        split = (text or "").split("\n")
        kept = [x for x in split if len(key(x)) < max(1, min_chars) or seen[key(x)] < at_least]
        yield doc_id, "\n".join(kept), len(split), len(split) - len(kept)


@pytest.mark.parametrize("at_least, min_chars, near_keys, shard_keys", [
    (10, 1, 1 << 20, 1 << 16), (2, 1, 3, 4), (3, 2, 0, 1), (10, 6, 1, 1), (1, 1, 4, 7), (1000, 1, 4, 7)])
def test_common_lines(docs, at_least, min_chars, near_keys, shard_keys):
    found = lines.drop_common_lines(docs, at_least, min_chars, near_keys, shard_keys)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert Counter(map(tuple, found.collect())) == Counter(without_common_lines(ROWS, at_least, min_chars))


def test_common_lines_of_nothing(docs):
    assert lines.drop_common_lines(docs.limit(0)).collect() == []


def test_perfect_hash_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 1 << 63, 5000).astype(np.uint64), rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    a[:20], b[20:40] = a[0], b[20]  # one half alone does not tell keys apart
    parts = lines.build_shard(a, b, np.arange(1, 5001))
    assert len(parts[2]) == 8 * 5000 and len(parts[3]) == 4 * 5000
    shard = lines.Shard(*parts)
    assert (shard.documents(a, b) == np.arange(1, 5001)).all()
    assert not shard.documents(a, b + np.uint64(1)).any()
    assert not lines.Shard(*lines.build_shard(a[:0], b[:0], a[:0])).documents(a, b).any()


def terms(text):
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def best_documents(rows, items, best):
    held = [(i, Counter(terms(t))) for i, t, _ in rows if terms(t)]
    count, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(Counter)
    for item, text in dict.fromkeys((i, t or "") for i, t in items):
        wanted[item].update(terms(text))
    for item, own in wanted.items():
        scores = []
        for doc_id, c in held:
            m = 25 + 75 * sum(c.values()) * count // total
            score = sum(n * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, n in own.items() if c[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:best], 1):
            yield item, rank, doc_id, -score


ITEMS = [(1, "The SEA of äpfel"), (2, None), (3, ""), (4, "the the the x"), (4, "the the the x"), (5, "unknown words"),
         (None, "日本 a1"), (7, "sea"), (7, "x long")] + [(20 + i, " ".join(VOCABULARY[i % 5:i % 5 + 4])) for i in range(20)]


@pytest.mark.parametrize("best, postings", [(10, 1_000_000), (3, 40), (500, 1_000_000)])
def test_ranked_search(spark, docs, best, postings):
    items = spark.createDataFrame([(i, t, 0, "clash") for i, t in ITEMS], "item_id BIGINT, text STRING, item INT, doc_id STRING")
    found = ranked.search(docs, items, best, postings)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == Counter(best_documents(ROWS, ITEMS, best))


def test_ranked_search_of_nothing(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    assert ranked.search(docs.limit(0), items).collect() == []
    assert ranked.search(docs, items.limit(0)).collect() == []


def best_phrases(rows, least, best, percent):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * inside[p] < percent * a:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:best], 1):
            yield lang, rank, p.decode(), -a, left, right, totals[lang], -score


@pytest.mark.parametrize("least, best, percent, layout", [
    (20, 2000, 100, {}), (2, 7, 100, {"most_counters": 1 << 16}), (2, 2000, 60, {"hot_rows": 3, "bucket_bytes": 1000}),
    (5, 2000, 100, {"hot_rows": 40, "bucket_bytes": 5000}), (1, 50, 100, {"hot_rows": 1, "most_counters": 4})])
def test_collocations(docs, least, best, percent, layout):
    found = phrases.collocations(docs, least, best, percent, **layout)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, found.collect())) == Counter(best_phrases(ROWS, least, best, percent))


def test_small_slices_change_nothing(docs, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 200)
    found = phrases.collocations(docs, 5, hot_rows=20)
    assert Counter(map(tuple, found.collect())) == Counter(best_phrases(ROWS, 5, 2000, 100))


def test_collocations_of_nothing(docs):
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    row = spark.sql("SELECT (CAST(a AS decimal(20, 0)) * n * 1000) div (CAST(l AS decimal(20, 0)) * r) AS score FROM VALUES "
                    "(40000000000001L, 9000000000000007L, 70000000000003L, 80000000000009L) AS t(a, n, l, r)").first()
    assert row.score == 1000 * 40000000000001 * 9000000000000007 // (70000000000003 * 80000000000009)


def test_sorted_prefixes_are_those_that_were_counted():
    rng = np.random.default_rng(3)
    depth = rng.integers(2, 6, 400)
    codes = rng.integers(0, 4, (400, 5)).astype(np.int32)
    codes[np.arange(5) >= depth[:, None]] = -1
    weights = rng.integers(1, 5, 400)
    want = Counter()
    for row, d, w in zip(codes.tolist(), depth, weights):
        for k in range(2, d + 1):
            want[tuple(row[:k])] += int(w)
    found = phrases.frequent_prefixes(codes, weights, np.ones(400, np.int8), 30)
    assert {tuple(codes[r, :k].tolist()): n for r, k, n in found} == {p: n for p, n in want.items() if n >= 30}
