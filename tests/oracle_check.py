"""Run queries and their SQL side by side: python -m tests.oracle_check SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb

import __spark_entry__ as contract
from siltstone.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return value
    return f"{float(value):.9g}" if isinstance(value, int) else str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, db, sf_dir: str, name: str) -> tuple[bool, str]:
    frame = contract.queries()[name](spark, sf_dir)
    ours = rows_of(frame.columns, frame.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(ours[1])} rows, no SQL"
    found = db.execute(sql)
    theirs = rows_of([c[0] for c in found.description], found.fetchall())
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        extra = [r for r in ours[1] if r not in set(theirs[1])][:3]
        lacking = [r for r in theirs[1] if r not in set(ours[1])][:3]
        return False, f"{len(ours[1])} / {len(theirs[1])} rows\n  ours   {extra}\n  theirs {lacking}"
    return True, f"{len(ours[1])} rows"


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failures = 0
    for name in names or contract.queries():
        start = time.time()
        try:
            good, note = compare(spark, db, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            good, note = False, str(error)[:1200]
        failures += not good
        print("PASS" if good else "FAIL", name, f"{time.time() - start:.1f}s", note, flush=True)
    print("failures:", failures)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
