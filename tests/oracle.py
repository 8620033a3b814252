"""Compare a registered query with its SQL twin; ``python tests/oracle.py [names…]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT",
}


def compare(spark, fn, sql, sf_dir, con):
    """None when rows, names and types agree, else a short text."""
    df = fn(spark, sf_dir)
    mine_names = df.columns
    mine = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    other_names = [c[0] for c in res.description]
    other = res.fetchall()
    if sorted(mine_names) != sorted(other_names):
        return f"columns {sorted(mine_names)} vs {sorted(other_names)}"
    kinds = {c[0]: c[1] for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        if kind in KINDS and KINDS[kind] != kinds[name]:
            return f"type of {name}: {kind} vs {kinds[name]}"
    a, b = rows_sorted(mine_names, mine), rows_sorted(other_names, other)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}: {a[:2]} {b[:2]}"
    for left, right in zip(a, b):
        if left != right:
            return f"{sorted(mine_names)}\n   {left}\n   {right}"
    return None


def main(names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = contract.queries(), contract.oracle_sql()
    con = connect(sf_dir)
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, queries[name], oracles[name], sf_dir, con)
            else:
                problem = None if queries[name](spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        tag = "ok  " if problem is None else "FAIL"
        kind = "" if name in oracles else " (rows only)"
        print(f"{tag} {name}{kind} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
