"""Compare a Spark result with its SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _columns(con, relation: str) -> dict[str, str]:
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {relation}").fetchall()}


def _read(columns: dict[str, str]) -> str:
    """Select list: columns by name, doubles to six decimals, times without zone."""
    items = []
    for name, kind in sorted(columns.items()):
        quoted = f'"{name}"'
        if kind == "DOUBLE":
            quoted = f"round({quoted}, 6) + 0.0"
        elif kind.startswith("TIMESTAMP"):
            quoted = f"CAST({quoted} AS TIMESTAMP)"
        items.append(f'{quoted} AS "{name}"')
    return ", ".join(items)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    con.register("arrow_rows", df.toArrow())
    con.execute("CREATE OR REPLACE TEMP TABLE ours AS SELECT * FROM arrow_rows")
    con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}")
    ours, theirs = _columns(con, "ours"), _columns(con, "theirs")
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} / {sorted(theirs)}"
    kinds = {n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]}
    kinds = {n: k for n, k in kinds.items() if not all(t.startswith("TIMESTAMP") for t in k)}
    if kinds:
        return f"types {kinds}"
    sizes = [con.execute(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in ("ours", "theirs")]
    if sizes[0] != sizes[1]:
        return f"rows {sizes}"
    read = _read(ours)
    for a, b in (("ours", "theirs"), ("theirs", "ours")):
        extra = f"SELECT {read} FROM {a} EXCEPT ALL SELECT {read} FROM {b}"
        found = con.execute(f"SELECT * FROM ({extra}) LIMIT 3").fetchall()
        if found:
            return f"only in {a}: {found}"
    return None
