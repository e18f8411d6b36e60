"""Compare queries with their SQL: ``python tests/check_oracles.py [folder] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    """A value in a form that both engines share."""
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, list):
        return [plain(x) for x in value]
    return value


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


# Names of the same type in both engines.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_gaps(df, description) -> list[str]:
    """Columns whose types differ between a DataFrame and a SQL result."""
    theirs = {d[0]: str(d[1]) for d in description}
    return [f"{n}: {t} vs {theirs[n]}" for n, t in df.dtypes if n in theirs and SAME_TYPE.get(t, t) != theirs[n]]


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


def compare(spark, con, run, sql: str | None, folder: str) -> tuple[bool, str]:
    """Whether a query gives the rows of its SQL, and what to say about it."""
    df = run(spark, folder)
    mine = rows_of(df.columns, df.collect())
    if sql is None:
        return True, f"{len(mine)} rows, no SQL"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    gaps = type_gaps(df, result.description)
    if gaps:
        return False, f"types {gaps}"
    if mine == theirs:
        return True, f"{len(mine)} rows"
    a, b = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
    return False, f"{len(mine)} vs {len(theirs)} rows; only mine {a[:2]}; only SQL {b[:2]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tallymint.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(folder), oracle_sql(), 0
    for name, run in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, run, oracles.get(name), folder)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
