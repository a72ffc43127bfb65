"""Compare registered queries with their oracle SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duckdb_result(con, sql: str):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            columns, rows = spark_result(build(spark, sf_dir))
        except Exception as error:  # noqa: BLE001
            print(f"{name:26s} SPARK ERROR {str(error)[:600]}", flush=True)
            continue
        seconds = time.time() - started
        if name not in oracles:
            print(f"{name:26s} {seconds:6.2f}s rows={len(rows)} (no oracle) {columns} {str(rows[:1])[:150]}", flush=True)
            continue
        try:
            expected_columns, expected = duckdb_result(con, oracles[name])
        except Exception as error:  # noqa: BLE001
            print(f"{name:26s} DUCKDB ERROR {str(error)[:600]}", flush=True)
            continue
        ok = columns == expected_columns and rows == expected
        print(f"{name:26s} {seconds:6.2f}s rows={len(rows)} {'ok' if ok else 'MISMATCH'}", flush=True)
        if not ok:
            different = [(a, b) for a, b in zip(rows, expected) if a != b][:3]
            print("   ", columns, expected_columns, len(rows), len(expected), str(different)[:900], flush=True)


if __name__ == "__main__":
    main()
