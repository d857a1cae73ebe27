"""Counts over whole texts, one row per document, and the shares derived from them.

Words are runs of bytes other than space and 0x09-0x0D, which is what ``bytes.split()``
separates. A null text counts as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import slices

COUNTS = (
    "n_bytes", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_top_word", "n_upper", "n_lower", "n_digits", "n_marks", "n_wide",
)

# Derived from the counts; every value is finite, also for an empty text.
SHARES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(n_upper + n_lower, 1)",
    "wide_share": "n_wide / greatest(word_chars, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "top_word_share": "n_top_word / greatest(n_words, 1)",
}

SLICE = 500  # rows that are counted at once

_SYMBOLS = list(b"#*$%&|<>")
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a three-word window found at least twice."""
    if len(ids) < 4:
        return 0
    base = int(ids.max()) + 1
    pairs = ids[:-1] * base + ids[1:]
    if base < 2_000_000:
        windows = pairs[:-1] * base + ids[2:]
    else:  # number the pairs, so that the product stays within 64 bits
        windows = np.unique(pairs[:-1], return_inverse=True)[1] * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:shift + len(windows)] |= twice
    return int(covered.sum())


def count_text(text: bytes) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    if not text:
        return (0,) * len(COUNTS)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    lines = [line for line in text.split(b"\n") if line.strip()]
    blank = int(histogram[32] + histogram[9:14].sum())
    return (
        len(text), len(words), len(text) - blank - int(histogram[128:192].sum()),
        int(histogram[_SYMBOLS].sum()), len(lines), len(lines) - len(set(lines)), repeated_words(ids),
        len(numbers), int(np.bincount(ids).max()) if words else 0,
        int(histogram[65:91].sum()), int(histogram[97:123].sum()), int(histogram[48:58].sum()),
        int(histogram[_MARKS].sum()), int(histogram[192:].sum()),
    )


def text_counts(docs: DataFrame, with_row: bool = False) -> DataFrame:
    """``(doc_id, *COUNTS)`` for ``docs(doc_id, text)``, a row for each row; with all columns of it as ``row`` if asked."""
    extra = ["row"] * with_row

    def count(batches):
        for whole in batches:
            for batch in slices(whole, SLICE):  # few rows at once, and each text but once, so that a task stays small
                texts = (batch.column(1).field("text") if with_row else batch.column(1)).cast(pa.binary())
                rows = [count_text(t.as_py() or b"") for t in texts]
                table = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(table[:, i]) for i in range(len(COUNTS))), *batch.columns[1:] * with_row],
                    ["doc_id", *COUNTS, *extra])

    chosen = docs.select("doc_id", *(F.struct("*").alias(c) for c in extra)) if with_row else docs.select(
        "doc_id", F.col("text").cast("binary").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}
    return chosen.mapInArrow(count, ", ".join(
        [f"doc_id {kinds['doc_id']}", *(f"{c} bigint" for c in COUNTS), *(f"row {kinds[c]}" for c in extra)]))


def with_shares(counts: DataFrame) -> DataFrame:
    return counts.withColumns({name: F.expr(f"CAST({sql} AS double)") for name, sql in SHARES.items()})
