"""Run registered queries beside their SQL: `python tests/check_oracle.py [sf] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(con, df, sql: str) -> str | None:
    """None if equal as multisets of rows, else what differs."""
    relation = con.sql(sql)
    got, want = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as registered

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = registered.oracle_sql(), 0
    for name, query in registered.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            problem = compare(con, df, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28} {time.perf_counter() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
