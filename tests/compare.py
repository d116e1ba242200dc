"""Compare a Spark result with a SQL result of a second engine, row order aside."""

from __future__ import annotations

import datetime
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


KINDS = {"tinyint": "int", "integer": "int", "int": "int", "bigint": "bigint", "varchar": "string", "boolean": "boolean",
         "double": "double", "date": "date", "string": "string"}


def differences(df, con, sql: str) -> list[str]:
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    other = result.fetchall()
    if sorted(names) != columns:
        return [f"columns {columns} != {sorted(names)}"]
    found = []
    for c in columns:
        a, b = df.schema[c].dataType.simpleString(), KINDS.get(kinds[c], kinds[c])
        if a != b:
            found.append(f"type of {c}: {a} != {b}")
    order = [names.index(c) for c in columns]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    left = sorted((tuple(cell(x) for x in r) for r in rows), key=key)
    right = sorted((tuple(cell(r[i]) for i in order) for r in other), key=key)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}")
    return found
