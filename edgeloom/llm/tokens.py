"""Token counts behind a digest cache, and the encoder that fills it.

A text is known by the SHA-256 of its UTF-8 bytes and a tokenizer by that of its file, the only
normalisation that cannot change a count being a null text's: it is empty. Counts that the cache has
are joined; the others are encoded once per distinct text and appended, so that the next run finds
them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# How GPT-2 style tokenizers split a text, and the same where no white space follows on another:
# without its lookahead, the pattern runs in linear time. Fixed values.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES_OF_SINGLE_SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"


def worker_cache() -> types.SimpleNamespace:
    """Objects that a Python worker keeps from task to task."""
    return sys.modules.setdefault("edgeloom_worker_cache", types.SimpleNamespace())  # type: ignore[arg-type]


class Encoder:
    """Token ids of whole texts as the library of a tokenizer file gives them.

    ``.json`` is for tokenizers and ``.model`` for sentencepiece. A byte-level file beside which its
    ranks lie in ``.tiktoken`` is run by tiktoken, several times as fast for the same ids: texts are cut at the special
    tokens first, as tokenizers does.
    """

    def __init__(self, path: str):
        file = Path(path)
        ranks = file.with_suffix(".tiktoken")
        if file.suffix == ".model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda text: model.encode(text, num_threads=1)
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        if ranks.exists():
            self._fast(tokenizer, ranks)

    def _fast(self, tokenizer, ranks: Path) -> None:
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.open("rb"))}
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        general, single = (tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
                           for name, pattern in (("general", PIECES), ("single", PIECES_OF_SINGLE_SPACED)))
        spaces = re.compile(r"\s\s")
        cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

        def plain(text: str) -> list[int]:
            return general(text) if spaces.search(text) else single(text)

        def encode(text: str) -> list[int]:
            if cut is None or not cut.search(text):
                return plain(text)
            ids: list[int] = []
            for part in cut.split(text):
                ids += [special[part]] if part in special else plain(part)
            return ids

        self.encode = encode


def encoder(path: str) -> Encoder:
    """The encoder of a file, made once per worker."""
    kept = worker_cache().__dict__.setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def text_of(value: bytes | None) -> str:
    return (value or b"").decode("utf-8", "replace")


def tokenizer_digest(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def _count_misses(texts: DataFrame, path: str) -> DataFrame:
    """``(digest, n_tokens)`` for ``texts(digest, text)``."""
    def count(batches):
        encode = encoder(path).encode
        for batch in batches:
            counts = [len(encode(text_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(count, "digest binary, n_tokens bigint")


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)``, a row for each row of ``docs(doc_id, text)``.

    ``cache`` is the folder of the counts, by tokenizer; it may be missing at first. Null and empty
    texts have no tokens, repeated texts are encoded once, an empty table adds nothing. Copies are
    dropped on both sides of the shuffle, so a text that a third of all rows share costs a row per task.
    """
    spark = docs.sparkSession
    folder = f"{cache}/tokenizer={tokenizer_digest(tokenizer_path)}"
    content = docs.selectExpr("doc_id", "coalesce(CAST(text AS binary), X'') AS text").withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    texts = content.select("digest", "text").dropDuplicates(["digest"])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    known = None
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        known = spark.read.schema("digest binary, n_tokens bigint").parquet(folder)
        texts = texts.join(known, "digest", "left_anti")
    _count_misses(texts, tokenizer_path).write.mode("append").parquet(folder)
    counts = spark.read.schema("digest binary, n_tokens bigint").parquet(folder)
    counts = counts.dropDuplicates(["digest"])  # runs at once may have added the same text
    return content.selectExpr("doc_id", "CAST(length(text) AS bigint) AS n_bytes", "digest").join(
        counts.hint("merge"), "digest").select("doc_id", "n_bytes", "n_tokens")
