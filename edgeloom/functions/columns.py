"""SQL expressions shared by the readers and operators.

The helpers return SQL text, which costs the driver one call however long the
expression is. All of it stays inside the JVM and inside generated code: no lambda
functions, which Spark would interpret row by row.
"""

from __future__ import annotations

ID_TYPES = ("bigint", "string")


def ids_of(tokens: str, id_type: str) -> str:
    """The ids in an array of text tokens, null for a token that is no integer."""
    return f"try_cast({tokens} AS array<bigint>)" if id_type == "bigint" else tokens


def all_ids(word: str, ids: str, id_type: str) -> str:
    """Whether each comma-separated token of ``word`` is an id.

    With ``bigint`` that is a 64-bit integer. With ``string`` it is any text that is
    not blank, so that ``01`` and ``1`` stay two users.
    """
    if id_type == "bigint":
        # array_join leaves nulls out, so a bad token shows in the number of pieces
        return f"size(split(array_join({ids}, ','), ',')) = size({ids})"
    return f"NOT {word} RLIKE '(^|,)\\\\s*(,|$)'"


def is_one_pair(ids: str, id_type: str) -> str:
    """Cheap test for what nearly every word is: two ids."""
    good = "{0}[{1}] IS NOT NULL" if id_type == "bigint" else "trim({0}[{1}]) != ''"
    return f"size({ids}) = 2 AND {good.format(ids, 0)} AND {good.format(ids, 1)}"


# Generator with both ends of an edge: columns ``v``, ``n_out``, ``n_in``.
ENDPOINTS = "inline(array(struct(src AS v, 1L AS n_out, 0L AS n_in), struct(dst AS v, 0L AS n_out, 1L AS n_in)))"


def part_of(other_end: str, parts: str) -> str:
    """Which of ``parts`` pieces of a hub a row belongs to, chosen by its other end."""
    return f"CASE WHEN {parts} > 1 THEN pmod(xxhash64({other_end}), {parts}) ELSE 0L END"


def safe_sum(expression: str) -> str:
    """A sum that is null where it, or any of its terms, leaves its type, whatever the session's settings."""
    return f"IF(count({expression}) = count(*), try_sum({expression}), NULL)"


def total_or_error(column: str, count_type: str) -> str:
    """The sum of ``column``, 0 without rows, and an error where it is beyond ``count_type``."""
    total = f"try_cast({safe_sum(column)} AS {count_type})"
    return (f"CASE WHEN count(*) = 0 THEN CAST(0 AS {count_type}) WHEN {total} IS NOT NULL THEN {total} "
            f"ELSE CAST(raise_error('ARITHMETIC_OVERFLOW: the count is beyond {count_type}') AS {count_type}) END")


def is_id(token: str, id_type: str) -> str:
    return f"try_cast({token} AS bigint) IS NOT NULL" if id_type == "bigint" else f"trim({token}) != ''"


def id_from(token: str, id_type: str) -> str:
    return f"CAST({token} AS bigint)" if id_type == "bigint" else f"trim({token})"


def closed_paths(multiplicity: str, products: str, sums: str, closing: str) -> str:
    """Closed two-paths that one cycle of three different vertices stands for.

    For two edges with multiplicities ``p``, ``q`` and a closing edge with ``r``
    there are three starting points, hence

    * ``all``: every copy of every edge counts, ``3*p*q*r``;
    * ``closing_exists``: the closing edge only has to exist,
      ``p*q + q*r + r*p``;
    * ``distinct``: the three starting points themselves.

    All of them are linear in ``p*q`` and ``p+q``, so both may be summed over many
    middle vertices (``products``, ``sums``) before the closing edge is known. Beyond
    the range of their type they are null.
    """
    if multiplicity == "all":
        return f"try_multiply(try_multiply({products}, {closing}), 3)"
    if multiplicity == "closing_exists":
        return f"try_add({products}, try_multiply({closing}, {sums}))"
    return f"try_multiply({products}, 3)"
