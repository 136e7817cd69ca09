"""Run a registered query and its oracle SQL side by side and compare the results."""

from __future__ import annotations

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and v != v:
        return None
    if isinstance(v, bool):
        return int(v)
    return str(v)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t))
    return cols, out


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = query(spark, sf_dir)
    s_cols, s_rows = canonical(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_cols, d_rows = canonical(d_cols, res.fetchall())
    if s_cols != d_cols:
        return False, f"{name}: columns {s_cols} != {d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows {len(s_rows)} != {len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"{name}: first diff\n spark={a}\n duck ={b}"
    return True, f"{name}: ok ({len(s_rows)} rows)"
