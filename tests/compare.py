"""Run registered queries and their SQL side by side: ``python tests/compare.py [sf] [names...]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    return names, kinds, result.fetchall()


def text_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("" if r[i] is None else repr(r[i]) for i in order) for r in rows)


def check(spark, sf_dir, run, sql):
    """None if equal, else what differs."""
    df = run(spark, sf_dir)
    found = [tuple(r) for r in df.collect()]
    names, kinds, wanted = oracle_rows(sf_dir, sql)
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} != {names}"
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    left, right = text_rows(df.columns, found), text_rows(names, wanted)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    same = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}
    spark_kinds = dict(df.dtypes)
    odd = [(n, spark_kinds[n], k) for n, k in zip(names, kinds) if same.get(k, k) != spark_kinds[n]]
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = check(session, sf_dir, run, oracles[name])
            else:
                problem = f"(no SQL) {run(session, sf_dir).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:22} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("problems:", bad)
