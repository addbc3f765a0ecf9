"""Shared output convention of registered queries and their SQL oracles:
doubles rounded to 6 decimal places on both sides."""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6
_DESCRIBE_DIR = os.environ.get("DUOSCOPE_ORACLE_DIR", "/root/testdata/sf0.001")
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def round_result(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = [F.round(F.col(f"`{n}`"), digits).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
            for n, t in df.dtypes]
    return df.select(*cols)


def wrap_oracles(sqls: dict[str, str], digits: int = DIGITS) -> dict[str, str]:
    """Wrap each SQL so its DOUBLE columns are rounded like ``round_result``.

    Column types are read with DuckDB ``DESCRIBE`` on the small tables of
    ``DUOSCOPE_ORACLE_DIR``; without DuckDB or those tables a warning says so and the SQL is
    returned unwrapped. SQL that does not bind is an error.
    """
    try:
        import duckdb
    except ModuleNotFoundError:
        warnings.warn("no DuckDB: oracle SQL is not rounded")
        return dict(sqls)
    paths = {t: f"{_DESCRIBE_DIR}/{t}.parquet" for t in _TABLES}
    lacking = [t for t, p in paths.items() if not os.path.exists(p)]
    if lacking:
        warnings.warn(f"oracle SQL is not rounded: no {', '.join(lacking)} in {_DESCRIBE_DIR}")
        return dict(sqls)
    con = duckdb.connect()
    for t, path in paths.items():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    out = {}
    for name, sql in sqls.items():
        desc = con.execute(f"DESCRIBE {sql}").fetchall()
        doubles = [row[0] for row in desc if row[1] in ("DOUBLE", "FLOAT")]
        if doubles:
            repl = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in doubles)
            out[name] = f"SELECT * REPLACE ({repl}) FROM ({sql}) q"
        else:
            out[name] = sql
    con.close()
    return out
