"""Runs queries and their SQL on the given tables and compares them: check_sql.py [sf or folder] [name ...]"""

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry_points  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_rows(name: str, sf_dir: str):
    with duckdb.connect() as db, tempfile.TemporaryDirectory(prefix="run-") as spill:
        db.execute(f"SET temp_directory = '{spill}'")
        for table in TABLES:
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        result = db.execute(entry_points.oracle_sql()[name])
        names = [column[0] for column in result.description]
        types = [str(column[1]) for column in result.description]
        return names, types, result.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def value(v):
        return round(v, 9) if isinstance(v, float) and math.isfinite(v) else v
    key = lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row]
    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=key)


def compare(spark, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, None if nothing does."""
    df = entry_points.queries()[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    names, types, want = sql_rows(name, sf_dir)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}
    have = {c: kinds.get(t, t) for c, t in df.dtypes}
    if have != (declared := dict(zip(names, types))):
        return f"types {set(have.items()) ^ set(declared.items())}"
    got, want = normal(df.columns, got), normal(names, want)
    if not want:
        return "no rows"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows != {len(want)}; extra {list(a)[:2]}; missing {list(b)[:2]}"
    return None


if __name__ == "__main__":
    from conftest import make_session

    spark = make_session()
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    for name in sys.argv[2:] or entry_points.queries():
        start = time.time()
        try:
            problem = compare(spark, name, sf if sf[0] == "/" else f"/root/testdata/sf{sf}")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {'ok' if problem is None else problem}  {time.time() - start:.1f}s", flush=True)
