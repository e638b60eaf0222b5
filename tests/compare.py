"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the folder's tables as views."""
    con = duckdb.connect()
    for t in TABLES:
        if Path(folder, f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    """A value in one comparable form."""
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, int):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if not hasattr(v, "hour") else v.isoformat()
    return str(v) if type(v).__name__ != "Decimal" else float(v)


def rows_of(columns, rows) -> Counter:
    """Multiset of rows with columns ordered by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, folder: str) -> tuple[bool, str]:
    """Same column names and the same multiset of rows?"""
    df = query(spark, folder)
    mine_columns = df.columns
    mine = rows_of(mine_columns, df.collect())
    cursor = con.execute(query.sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = rows_of(theirs_columns, cursor.fetchall())
    if sorted(mine_columns) != sorted(theirs_columns):
        return False, f"columns {sorted(mine_columns)} != {sorted(theirs_columns)}"
    if mine != theirs:
        a, b = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
        return False, f"rows {sum(mine.values())} vs {sum(theirs.values())}; only spark {a}; only sql {b}; {sorted(mine_columns)}"
    return True, f"{sum(mine.values())} rows"


def main() -> None:
    """Command line."""
    from quartermill.catalog import load
    from quartermill.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, q in load().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, q, folder)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {time.time() - start:5.1f}s {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
