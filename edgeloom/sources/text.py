"""Reading edge, rank and vertex files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions import ID_TYPES, all_ids, id_from, ids_of, is_id, is_one_pair


def _words(lines: DataFrame, column: str, mode: str, id_type: str, what: str) -> tuple[DataFrame, str]:
    """``(word, tokens)`` of a column of text lines, and what becomes of a malformed word."""
    if mode not in ("fail", "drop"):
        raise ValueError(f"mode must be 'fail' or 'drop', not {mode!r}")
    if id_type not in ID_TYPES:
        raise ValueError(f"id_type must be one of {ID_TYPES}, not {id_type!r}")
    words = (
        lines.select(F.col(column).alias("line"))
        .selectExpr("explode(CASE WHEN contains(line, ' ') THEN split(line, ' ') ELSE array(line) END) AS word")
        .where("word != ''")
        .selectExpr("word", "split(word, ',') AS tokens")
    )
    return words, "array()" if mode == "drop" else f"raise_error(concat('malformed {what}: ', word))"


def _checked_words(words: DataFrame, condition: str, malformed: str) -> DataFrame:
    """``(tokens)`` of the words that meet ``condition``; the check stays whichever columns are used later."""
    return words.selectExpr("tokens", f"explode(CASE WHEN {condition} THEN array(0) ELSE {malformed} END) AS place")


def parse_edges(lines: DataFrame, column: str = "value", mode: str = "fail", id_type: str = "bigint") -> DataFrame:
    """``edges(src, dst)`` out of a column of text lines.

    A line holds words separated by blanks, a word holds one edge ``follower,user``
    or several as ``a,b,c,d``. Empty lines and words are skipped. Any other word that
    is not made of pairs of ids stops the query in ``mode="fail"`` and is skipped as a
    whole in ``mode="drop"``.
    """
    words, malformed = _words(lines, column, mode, id_type, "edge")
    words = words.selectExpr("word", f"{ids_of('tokens', id_type)} AS ids")
    # One row for each pair, by the place of its first id.
    places = f"""
        CASE WHEN {is_one_pair('ids', id_type)} THEN array(0)
             WHEN size(ids) > 2 AND size(ids) % 2 = 0 AND {all_ids('word', 'ids', id_type)}
             THEN sequence(0, size(ids) - 2, 2)
             ELSE {malformed} END"""
    pairs = words.selectExpr("ids", f"explode({places}) AS place")
    tidy = "trim({})" if id_type == "string" else "{}"
    return pairs.selectExpr(
        tidy.format("ids[place]") + " AS src", tidy.format("ids[place + 1]") + " AS dst")


SCANS = ("lines", "blanks")


def _read(spark: SparkSession, path: str | list[str], scan: str) -> DataFrame:
    """``(value)``: the text of files in records that end at line ends, or at blanks and then at line ends.

    Either way the records hold the same words. A record is read by one task, so a file of few, very long
    lines should be scanned by blanks, and a file without blanks by lines.
    """
    if scan not in SCANS:
        raise ValueError(f"scan must be one of {SCANS}, not {scan!r}")
    if scan == "lines":
        return spark.read.text(path)
    records = spark.read.text(path, lineSep=" ")
    return records.selectExpr("explode(CASE WHEN value RLIKE '[\\r\\n]' THEN split(value, '[\\r\\n]+') ELSE array(value) END) AS value")


def read_edges(spark: SparkSession, path: str | list[str], mode: str = "fail", id_type: str = "bigint",
               scan: str = "lines") -> DataFrame:
    """Edges of text files, see ``parse_edges``. With ``scan="blanks"`` lines may be of any length, and one line is read by many tasks."""
    return parse_edges(_read(spark, path, scan), mode=mode, id_type=id_type)


def parse_ranks(lines: DataFrame, column: str = "value", mode: str = "fail", id_type: str = "bigint") -> DataFrame:
    """``ranks(v, rank)`` out of words ``vertex,rank``, one or several to a line.

    A word without an id or without a number stops the query or is skipped, as for ``parse_edges``.
    """
    words, malformed = _words(lines, column, mode, id_type, "rank")
    good = f"size(tokens) = 2 AND {is_id('tokens[0]', id_type)} AND try_cast(tokens[1] AS double) IS NOT NULL"
    return _checked_words(words, good, malformed).selectExpr(
        f"{id_from('tokens[0]', id_type)} AS v", "CAST(tokens[1] AS double) AS rank")


def parse_vertices(lines: DataFrame, column: str = "value", mode: str = "fail", id_type: str = "bigint") -> DataFrame:
    """``vertices(v)`` out of words ``vertex,0``, one or several to a line; the second field means nothing."""
    words, malformed = _words(lines, column, mode, id_type, "vertex")
    good = f"size(tokens) <= 2 AND {is_id('tokens[0]', id_type)}"
    return _checked_words(words, good, malformed).selectExpr(f"{id_from('tokens[0]', id_type)} AS v")


def read_ranks(spark: SparkSession, path: str | list[str], mode: str = "fail", id_type: str = "bigint",
               scan: str = "lines") -> DataFrame:
    """Ranks of text files, see ``parse_ranks``."""
    return parse_ranks(_read(spark, path, scan), mode=mode, id_type=id_type)


def read_vertices(spark: SparkSession, path: str | list[str], mode: str = "fail", id_type: str = "bigint",
               scan: str = "lines") -> DataFrame:
    """Vertices of text files, see ``parse_vertices``."""
    return parse_vertices(_read(spark, path, scan), mode=mode, id_type=id_type)
