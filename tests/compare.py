"""Run a registered query and its oracle on the same folder and compare every value."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~null"
    if isinstance(v, bool):
        return str(v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> tuple[list[str], dict]:
    started = time.time()
    spark_rows = [tuple(row) for row in df.collect()]
    middle = time.time()
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    sql_rows = found.fetchall()
    times = {"spark": middle - started, "sql": time.time() - middle, "rows": len(spark_rows)}
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
        return problems, times
    if len(spark_rows) != len(sql_rows):
        problems.append(f"rows {len(spark_rows)} != {len(sql_rows)}")
    types = dict(zip(names, [str(d[1]) for d in found.description]))
    for f in df.schema.fields:
        ours = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN"}.get(f.dataType.simpleString(), f.dataType.simpleString())
        if types[f.name] != ours:
            problems.append(f"type of {f.name}: {ours} != {types[f.name]}")
    a, b = rows_of(df.columns, spark_rows), rows_of(names, sql_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, e.g. {bad[0]} on {sorted(names)}")
    return problems, times
