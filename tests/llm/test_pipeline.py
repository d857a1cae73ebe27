from collections import Counter

import corpus_pipeline as pipeline
from edgeloom.llm.queries import table
from edgeloom.plans import stage

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    results = {}
    for name, run in pipeline.STAGES:
        docs = stage(run(spark, docs, SF_DIR), "stage")
        results[name] = docs.collect()
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
    ids = {name: {r.doc_id for r in rows} for name, rows in results.items()}
    kept = ids["quality rules"]
    assert all(i in kept for i, q in labels.items() if q == 1)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 2
    from test_operators import linked

    groups = linked([(r.doc_id, r.text) for r in results["quality rules"]], 5, 80)
    assert ids["near duplicates"] == {group for _, _, group in groups}
    before = {r.doc_id: r.text for r in results["near duplicates"]}
    assert all(len(r.text) <= len(before[r.doc_id]) and r.n_chars == len(r.text) for r in results["repeated passages"])
    times = Counter(r.doc_id for r in results["source mix"])
    assert max(times.values()) <= 3 and set(times) <= ids["repeated passages"]
    assert Counter(r.doc_id for r in results["packing"] if r.piece == 0) == times


def test_short_and_repetitive_junk_goes(spark, monkeypatch):
    clean = ["word" + "abcdefghij"[i % 10] + " and some other plain text with number " + "klmnopqrst"[i // 10 % 10] for i in range(60)]
    rows = list(enumerate(clean)) + [(100 + i, "## $$ ** ||" + " &&" * (i % 3)) for i in range(30)]
    rows += [(200, "same " * 10), (201, "one two three four " * 40), (202, "short and clean")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows[:80]], "doc_id bigint, quality int")
    ids = lambda known: {r.doc_id for r in (monkeypatch.setattr(pipeline, "table", lambda *_: known), pipeline.quality_rules(spark, docs, ""))[1].collect()}
    good = {i for i, _ in rows if i < 100} | {202}
    assert ids(labels) == good
    assert ids(labels.limit(0)) == good | {100 + i for i in range(30)}


def test_rows_with_nulls_and_empty_tables(spark):
    docs = table(spark, SF_DIR, "documents").limit(3)
    odd = docs.selectExpr("doc_id", "CAST(NULL AS string) AS text", "CAST(NULL AS string) AS lang", "CAST(NULL AS string) AS source",
                          "CAST(NULL AS bigint) AS n_chars", "1 AS size", "2 AS row").union(
        docs.selectExpr("CAST(NULL AS bigint)", "''", "'en'", "'s'", "0L", "1", "2"))
    for start in (odd, odd.limit(0)):
        rows = start
        for name, run in pipeline.STAGES:
            rows = stage(run(spark, rows, SF_DIR), "stage")
        assert rows.columns[0] == "doc_id"


def test_mix_gives_each_row_its_own_times(spark):
    words = lambda n, i: " ".join(f"w{i}" for _ in range(n))
    rows = [(i, words(60, i), "en", "s0", 1) for i in range(60)] + [(i, words(20, i), "en", "s1", 1) for i in range(60)]
    rows += [(None, words(7, i), None, "s2", 1) for i in range(50)] + [(None, words(7, 1), None, "s2", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = Counter()
    for r in pipeline.mixing.mix(docs, with_row=True).collect():
        want[tuple(r.row)] += r.times
    got = Counter(map(tuple, pipeline.source_mix(spark, docs, "").collect()))
    assert got == +want
    targets = {r.source: r.target for r in pipeline.mixing.mix(docs).collect()}
    for source, target in targets.items():
        taken = sum(n * len(row[1].split()) for row, n in got.items() if row[3] == source)
        assert abs(taken - target) <= 60


def test_passages_go_in_whole_characters(spark):
    passage = "é日😀" * 20
    texts = {1: f"keep \ufffd this {passage} end", 2: f"\ufffd other {passage}\ufffd", 3: "keep \ufffd this", 4: f"{passage[1:]} tail ü"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = {}
    for i, text in texts.items():
        data = text.encode()
        earlier = {t.encode()[k:k + 50] for j, t in texts.items() if j < i for k in range(len(t.encode()) - 49)}
        gone = {b for k in range(len(data) - 49) if data[k:k + 50] in earlier for b in range(k, k + 50)}
        kept, at = "", 0
        for c in text:
            size = len(c.encode())
            kept += "" if gone & set(range(at, at + size)) else c
            at += size
        want[i] = kept
    got = pipeline.repeated_passages(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in got} == want and want[2] != texts[2] and want[3] == texts[3]
    assert all(r.n_chars == len(r.text) for r in got)
