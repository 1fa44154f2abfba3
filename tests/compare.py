"""Run named queries next to their SQL twins and compare names, types and values."""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
    "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]", "array<int>": "INTEGER[]",
    "array<bigint>": "BIGINT[]",
}


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def compare(spark, con, folder: str, name: str, queries, oracles) -> tuple[bool, str]:
    started = time.time()
    df = queries[name](spark, folder)
    rows = df.collect()
    spark_sec = time.time() - started
    if name not in oracles:
        return True, f"{spark_sec:6.2f}s rows={len(rows)} (no twin)"
    started = time.time()
    rel = con.sql(oracles[name])
    got = con.sql(oracles[name]).fetchall()
    duck_sec = time.time() - started
    note = f"{spark_sec:6.2f}s / {duck_sec:5.2f}s rows={len(rows)}"
    if sorted(df.columns) != sorted(rel.columns):
        return False, f"{note} columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = dict(df.dtypes)
    odd = [
        f"{c}:{types[c]}!={t}" for c, t in zip(rel.columns, map(str, rel.types))
        if TYPES.get(types[c], types[c]) != t
    ]
    names = sorted(df.columns)
    mine = sorted(tuple(plain(r[c]) for c in names) for r in rows)
    where = {c: i for i, c in enumerate(rel.columns)}
    theirs = sorted(tuple(plain(r[where[c]]) for c in names) for r in got)
    if mine != theirs:
        extra = [m for m in mine if m not in set(theirs)][:3]
        lack = [t for t in theirs if t not in set(mine)][:3]
        return False, f"{note} vs {len(theirs)} VALUES {names}\n   spark {str(extra)[:700]}\n   sql   {str(lack)[:700]}"
    return not odd, f"{note}{' TYPES ' + ' '.join(odd) if odd else ''}"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = oracle_connection(folder)
    bad = 0
    for name in QUERIES:
        if names and name not in names and not any(n.endswith("*") and name.startswith(n[:-1]) for n in names):
            continue
        try:
            ok, note = compare(spark, con, folder, name, QUERIES, ORACLES)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
