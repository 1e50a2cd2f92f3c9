"""Compare every registered query with its SQL twin: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double",
}


def canonical(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, db, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    ours = canonical(df.columns, df.collect())
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = canonical(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    sql_types = {r[0]: SPARK_TYPES.get(r[1], r[1]) for r in db.execute(f"DESCRIBE {sql}").fetchall()}
    if dict(df.dtypes) != sql_types:
        return f"types differ: {sorted(set(dict(df.dtypes).items()) ^ set(sql_types.items()))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    db, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.perf_counter()
        try:
            if name in sqls:
                verdict = compare(spark, db, name, query, sqls[name], sf_dir)
            else:
                verdict = None if query(spark, sf_dir).count() else "no rows"
        except Exception as err:
            verdict = f"{type(err).__name__}: {str(err)[:600]}"
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.perf_counter() - start:.1f}s {verdict or ''}", flush=True)
    print(f"{bad} failed")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
