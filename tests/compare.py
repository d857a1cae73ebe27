"""Compare a Spark result with DuckDB over the same tables, as multisets of rows."""

from collections import Counter
from pathlib import Path

import duckdb

SPARK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}


def connect(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def mismatch(df, con, sql):
    """Empty if rows, column names and types agree; otherwise a short reason."""
    relation = con.sql(sql)
    names = sorted(relation.columns)
    if sorted(df.columns) != names:
        return f"columns {df.columns} against {relation.columns}"
    want_types = {c: SPARK_TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    if dict(df.dtypes) != want_types:
        return f"types {df.dtypes} against {want_types}"
    want = Counter(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
    got = Counter(tuple(row) for row in df.select(*names).collect())
    if got != want:
        return f"{sum(got.values())} rows against {sum(want.values())}, e.g. {list((got - want).items())[:2]} against {list((want - got).items())[:2]}"
    return ""
