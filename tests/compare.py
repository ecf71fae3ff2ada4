"""Compare registered queries with their SQL in DuckDB, value by value.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.compute as pc

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events
    documents embeddings pages benchmark labels conversations""".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(column: pa.ChunkedArray) -> list:
    if pa.types.is_timestamp(column.type):
        column = pc.cast(column, pa.int64() if column.type.unit == "us" else pa.timestamp("us"), safe=False)
        if pa.types.is_timestamp(column.type):
            column = column.cast(pa.int64())
    if pa.types.is_decimal(column.type):
        column = column.cast(pa.float64())
    return column.to_pylist()


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(zip(*[plain(table[name]) for name in names]), key=repr)


def differences(ours: pa.Table, theirs: pa.Table) -> str | None:
    """The first thing that differs, or None."""
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(set(ours.column_names) ^ set(theirs.column_names))}"
    left, right = rows(ours), rows(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            names = sorted(ours.column_names)
            off = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return f"values {off[:4]} in {a[:6]}"
    kinds = [
        f"{n}: {ours.schema.field(n).type} vs {theirs.schema.field(n).type}"
        for n in sorted(ours.column_names)
        if str(ours.schema.field(n).type).removesuffix(", tz=UTC]").removesuffix("]")
        != str(theirs.schema.field(n).type).removesuffix("]")
    ]
    return f"types {kinds}" if kinds else None


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    theirs = con.sql(oracle_sql()[name]).to_arrow_table()
    return differences(queries()[name](spark, sf_dir).toArrow(), theirs)


if __name__ == "__main__":
    from fareline.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    for name in sys.argv[2:] or queries():
        started = time.time()
        try:
            if name in oracle_sql():
                verdict = compare(spark, con, sf_dir, name) or "equal"
            else:
                verdict = f"no SQL, {queries()[name](spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error).splitlines()[0][:500]}"
        print(f"{name:32} {time.time() - started:6.1f}s  {verdict}", flush=True)
