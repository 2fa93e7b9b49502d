"""Every query against its SQL on the smallest tables."""

import datetime as dt
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_points
from check_sql import compare, normal
from headway import queries as registered
from headway.queries import lake


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(registered.SQL)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, name, "/root/testdata/sf0.001") is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["stream_quality", "backfill_status"])
def test_polls_are_in_the_lake_by_portions_of_days(spark, tmp_path, monkeypatch, name):
    start = dt.datetime(2024, 1, 2)
    # 12 polls on each of six days, one of which has none.
    at = [start + dt.timedelta(days=day, hours=2 * n) for day in (0, 1, 2, 4, 5) for n in range(12)]
    rows = [(i, when, i, "view", 1.0, f'{{"k": {i % 10}}}') for i, when in enumerate(at)]
    # A poll that is gone counts as often as its row comes.
    rows += [row for row in rows if row[5] == '{"k": 2}']
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    table = pa.Table.from_pylist([dict(zip(names, row)) for row in rows])
    pq.write_table(table, tmp_path / "events.parquet")
    monkeypatch.setattr(lake, "POLLS", 30)
    whole, held, lakes = lake.making.put_objects, [], []

    def put(polls, to):
        lakes.append(Path(to))
        n = whole(polls, to)
        held.append(sum(len(list((place / "raw").rglob("*.pb"))) for place in set(lakes)))
        return n

    monkeypatch.setattr(lake.making, "put_objects", put)
    got = entry_points.queries()[name](spark, str(tmp_path))
    got_rows = normal(got.columns, [tuple(row) for row in got.collect()])
    assert 0 < max(held) <= 30
    assert not any((place / "raw").exists() for place in lakes)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
        result = db.execute(entry_points.oracle_sql()[name])
        columns = [column[0] for column in result.description]
        assert got_rows == normal(columns, result.fetchall())
