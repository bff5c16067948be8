"""Run registered queries beside their SQL in DuckDB and compare all rows.

python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks import registry
from danji.session import local_session


def duckdb_tables(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    return x


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str):
    """(message, Spark seconds): the message is empty when everything agrees."""
    start = time.time()
    df = registry.QUERIES[name](spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    if name not in registry.ORACLE:
        return ("" if got else "no rows"), seconds, len(got)
    result = con.execute(registry.ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(columns)}", seconds, len(got)
    mine, theirs = rows_of(df.columns, got), rows_of(columns, result.fetchall())
    if mine != theirs:
        only_mine, only_theirs = mine - theirs, theirs - mine
        return (
            f"{sum(mine.values())} rows <> {sum(theirs.values())}; order {sorted(columns)}; "
            f"only Spark ({sum(only_mine.values())}): {list(only_mine)[:3]}; "
            f"only SQL ({sum(only_theirs.values())}): {list(only_theirs)[:3]}"
        ), seconds, len(got)
    return ("" if got else "no rows on either side"), seconds, len(got)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    registry.load()
    names = sys.argv[2:] or list(registry.QUERIES)
    spark, con, bad = local_session("compare"), duckdb_tables(sf_dir), 0
    for name in names:
        try:
            message, seconds, n = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            message, seconds, n = f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0
        bad += bool(message)
        print(f"{'FAIL' if message else 'ok  '} {name} {seconds:.2f}s rows={n} {message}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
