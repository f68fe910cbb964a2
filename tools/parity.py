"""Run registered queries against their SQL in DuckDB: ``python tools/parity.py <folder> [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fairreach import catalog  # noqa: E402


def normal(value):
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(normal(r[i]) for i in order) for r in rows)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def compare(spark: SparkSession, con, folder: str, name: str) -> tuple[bool, str]:
    df = catalog.queries()[name](spark, folder)
    started = time.time()
    columns, rows = table(df.columns, df.collect())
    took = time.time() - started
    total = sum(rows.values())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return total > 0, f"{total} rows, no SQL, {took:.1f}s"
    result = con.execute(sql)
    want_columns, want = table([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return False, f"columns {columns} != {want_columns}"
    if rows != want:
        extra, missing = rows - want, want - rows
        return False, f"{total} vs {sum(want.values())}; extra {list(extra.items())[:2]} missing {list(missing.items())[:2]}"
    return total > 0, f"{total} rows, {took:.1f}s"


def main() -> None:
    folder, names = sys.argv[1], sys.argv[2:] or list(catalog.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = []
    for name in names:
        started = time.time()
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:300]}"
        if not ok:
            failed.append(name)
        print("ok  " if ok else "FAIL", name, note, f"[{time.time() - started:.1f}s]", flush=True)
    print(len(names) - len(failed), "of", len(names), "agree; failed:", failed)


if __name__ == "__main__":
    main()
