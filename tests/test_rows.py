"""Row operators, accounting, change-only capture and keys."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from headway.feeds import CAPTURED_FEEDS, LONG, STRING, FeedSpec, registry, struct, uncurated
from headway.functions import keys
from headway.operators import capture, quality, rows
from headway.operators.capture import drop_unchanged
from headway.streaming import capture as streaming_capture
from headway.streaming.capture import changed_only


def test_feeds_and_specs_line_up():
    assert set(registry()) == set(CAPTURED_FEEDS)
    assert uncurated() == []
    assert uncurated([*CAPTURED_FEEDS, "new_feed"]) == ["new_feed"]
    assert {n: len(s.schema) for n, s in registry().items()} == {
        "vehicle_positions": 24,
        "trip_updates": 20,
        "service_alerts": 15,
    }


def test_unknown_sort_key_is_refused():
    schema = struct(a=STRING)
    with pytest.raises(ValueError, match="not_a_column"):
        FeedSpec("x", schema, ("a", "not_a_column"), schema, lambda df: df)


def test_conform_casts_orders_and_refuses_drift(spark):
    schema = struct(b=STRING, a=LONG)
    df = spark.createDataFrame([(1, 2, "d")], "a int, b int, date string")
    out = rows.conform(df, schema, ("date",))
    assert out.dtypes == [("date", "string"), ("b", "string"), ("a", "bigint")]
    assert out.first() == ("d", "2", 1)
    with pytest.raises(ValueError, match=r"missing \['a'\]"):
        rows.conform(df.drop("a"), schema, ("date",))
    with pytest.raises(ValueError, match=r"extra \['date'\]"):
        rows.conform(df, schema)


def test_leaf_outer_copies_only_what_it_keeps(spark):
    df = spark.sql(
        "select * from values (1, array(named_struct('x', 1, 'y', named_struct('z', 'p')),"
        " named_struct('x', cast(null as int), 'y', null))), (2, array()), (3, null) as t(id, items)"
    )
    out = rows.leaf_outer(df, [F.col("id")], F.col("items"), {"x": "x", "z": "y.z"})
    assert sorted(out.collect(), key=str) == [
        (1, 1, "p"),
        (1, None, None),
        (2, None, None),
        (3, None, None),
    ]


def test_distinct_takes_null_as_equal_and_looks_into_lists(spark):
    schema = "a string, n array<struct<x:int>>"
    data = [(None, [(1,)]), (None, [(1,)]), (None, [(None,)]), (None, [(None,)]), (None, None), (None, [])]
    assert rows.distinct_rows(spark.createDataFrame(data * 3, schema)).count() == 4


def test_union_keeps_copies(spark):
    part = spark.createDataFrame([(1, "a")], "n int, s string")
    assert rows.union_parts([part, part.select("s", "n")], struct(s=STRING, n=LONG)).count() == 2


def test_day_sort_puts_nulls_last(spark):
    df = spark.createDataFrame(
        [("d2", "a", 1), ("d1", None, 1), ("d1", "b", None), ("d1", "b", 0), ("d1", "a", 9)],
        "date string, k string, n int",
    )
    assert [tuple(r) for r in rows.day_sort(df, ["k", "n"]).collect()] == [
        ("d1", "a", 9),
        ("d1", "b", 0),
        ("d1", "b", None),
        ("d1", None, 1),
        ("d2", "a", 1),
    ]


def test_distinct_sorted_is_one_shuffle(spark, capsys):
    df = spark.range(30000).selectExpr("concat('d', id % 3) AS date", "id % 700 AS k", "id % 2 AS n")
    out = rows.distinct_sorted(df, ["k"], 4)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) == 2100
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)
    assert out.rdd.getNumPartitions() == 4
    capsys.readouterr()
    rows.distinct_sorted(df, ["k"], 4).explain()
    assert capsys.readouterr().out.count("Exchange ") == 1


def test_distinct_sorted_takes_all_there_is(spark):
    data = [("d", None, [(1,)], 0.0), ("d", None, [(1,)], -0.0), ("d", "a", None, None), ("d", "a", None, None)]
    df = spark.createDataFrame(data, "date string, k string, items array<struct<n:int>>, x double")
    assert len(rows.distinct_sorted(df, ["k"], 3).collect()) == 2
    # A literal or a floating-point number as a key.
    other = spark.range(3000).selectExpr("'d' AS date", "-(id % 700) / 7.0D AS k", "id % 2 AS n")
    got = [tuple(r) for r in rows.distinct_sorted(other, ["k"], 4).collect()]
    assert len(got) == 700 and [g[1] for g in got] == sorted(g[1] for g in got)
    keys_only = spark.createDataFrame([("d", 1), ("d", 1), ("c", 2)], "date string, k int")
    got = [tuple(r) for r in rows.distinct_sorted(keys_only, ["k"], 2).collect()]
    assert got == [("c", 2), ("d", 1)]


def test_one_sort_key_spreads_over_partitions(spark):
    df = spark.range(20000).select(F.lit("d").alias("date"), F.lit("hot").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sizes = [
            r["count"]
            for r in rows.day_sort(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 6
    assert max(sizes) < 8000


def _counts(spark, *values):
    names = "discovered long, succeeded long, download_failed long, parse_failed long"
    return spark.createDataFrame([values], names)


def test_rates(spark):
    row = quality.completeness(_counts(spark, 1500, 1350, 30, 120), 2000).first()
    assert (row.failed, row.coverage, row.failure_rate) == (150, 0.75, 0.1)


def test_rates_of_nothing_are_zero(spark):
    row = quality.completeness(_counts(spark, 0, 0, 0, 0), 96).first()
    assert (row.coverage, row.failure_rate) == (0.0, 0.0)


def test_coverage_is_not_clamped(spark):
    assert quality.completeness(_counts(spark, 240, 240, 0, 0), 96).first().coverage == 2.5


def test_accounting_adds_up(spark):
    status = [quality.OK] * 3 + [quality.PARSE_FAILED] * 2 + [quality.DOWNLOAD_FAILED]
    df = spark.createDataFrame([("d", s) for s in status], "date string, status string")
    row = quality.snapshot_accounting(df, ["date"]).first()
    assert tuple(row) == ("d", 6, 3, 1, 2)


def _kept(spark, polls, seconds=10):
    df = spark.createDataFrame(polls, "feed string, t long, n long, identity string")
    out = drop_unchanged(df, ["feed"], ["t", "n"], "identity", seconds)
    assert out.columns == df.columns
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_only_neighbours_are_compared(spark):
    polls = [("f", t, 0, i) for t, i in enumerate(["A", "A", "B", "A", "A"])]
    assert [(p[1], p[3]) for p in _kept(spark, polls)] == [(0, "A"), (2, "B"), (3, "A")]


def test_first_poll_stays_even_without_identity(spark):
    polls = [("f", 0, 0, None), ("f", 1, 0, None), ("f", 2, 0, "A"), ("g", 5, 0, "A")]
    assert [(p[0], p[1]) for p in _kept(spark, polls)] == [("f", 0), ("f", 2), ("g", 5)]


@pytest.mark.parametrize("seconds", [1, 7, 1000])
def test_slices_do_not_change_the_result(spark, seconds):
    rng = random.Random(seconds)
    polls = [
        (rng.choice(["hot", "hot", "hot", "cold"]), rng.randrange(200), n, rng.choice(["A", "B", None]))
        for n in range(600)
    ]
    want, last = [], {}
    for poll in sorted(polls, key=lambda p: (p[1], p[2])):
        if poll[0] not in last or last[poll[0]] != poll[3]:
            want.append(poll)
        last[poll[0]] = poll[3]
    assert _kept(spark, polls, seconds) == sorted(want, key=str)


def test_slices_are_carried_over_gaps_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(capture, "GROUP_BITS", 2)
    times = [0, 1, 5, 6, 40, 41, 300, 5_000, 5_001, 90_000, -7, -3000]
    polls = [("f", t, 0, "B" if t in (6, 5_000) else "A") for t in times]
    want, last = [], None
    for poll in sorted(polls, key=lambda p: p[1]):
        if poll[3] != last:
            want.append(poll)
        last = poll[3]
    assert _kept(spark, polls, 1) == sorted(want, key=str)


def test_no_window_has_all_slices_of_a_key_and_one_scan_is_enough(spark, capsys, tmp_path):
    df = spark.createDataFrame([("f", 1, 0, "A")], "feed string, t long, n long, identity string")
    df.write.parquet(f"{tmp_path}/polls")
    polls = spark.read.parquet(f"{tmp_path}/polls")
    drop_unchanged(polls, ["feed"], ["t", "n"], "identity", 10).explain()
    plan = capsys.readouterr().out
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows
    assert all("windowspecdefinition(feed#" in w and ("_at#" in w or "_slice#" in w) for w in windows)
    assert plan.count("FileScan") == 1


def test_names_of_columns_do_not_matter(spark):
    df = spark.createDataFrame(
        [("f", 0, "A", 1), ("f", 1, "A", 2), ("f", 70, "B", 3)], "_slice string, _at long, _kept string, _First int"
    )
    kept = drop_unchanged(df, ["_slice"], ["_at"], "_kept", 10)
    assert kept.columns == df.columns
    assert sorted(r._First for r in kept.collect()) == [1, 3]


def test_stream_keeps_what_the_batch_keeps(spark, tmp_path):
    rng = random.Random(3)
    polls = sorted(
        (rng.randrange(400), n, rng.choice(["hot", "hot", "cold", None]), rng.choice(["A", "B", None]))
        for n in range(500)
    )
    df = spark.createDataFrame(polls, "t long, n long, feed string, identity string")
    want = drop_unchanged(df, ["feed"], ["t", "n"], "identity", 50)
    for first, last in ((0, 120), (120, 121), (121, 300), (300, 500)):
        # Each time a new query that knows of the ones before only by the checkpoint.
        spark.createDataFrame(polls[first:last], df.schema).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        kept = changed_only(source, ["feed"], ["t", "n"], "identity")
        sink = kept.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        sink.option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_keys_of_a_stream_share_calls_and_keep_nulls(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streaming_capture, "BUCKETS", 2)
    big = (1 << 53) + 1
    polls = [
        (big + t, None if k == 3 else k, f"z{k}", None if (t + k) % 4 == 0 else t // 3) for t in range(30) for k in range(6)
    ]
    df = spark.createDataFrame([*polls, (None, 1, "z1", 5), (None, None, "z9", None)], "t long, k long, z string, identity long")
    want = drop_unchanged(df, ["k", "z"], ["t"], "identity", 50)
    for parity in (0, 1):
        df.where((F.coalesce("t", F.lit(0)) > big + 14) == bool(parity)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        kept = changed_only(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["k", "z"], ["t"], "identity")
        assert "bucket" in kept._jdf.queryExecution().analyzed().toString()
        sink = kept.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        sink.option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_identity_stays_if_the_payload_was_not_stored(spark, tmp_path):
    schema = "t long, feed string, identity string"

    def run(store):
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        changed_only(source, ["feed"], ["t"], "identity").writeStream.foreachBatch(store).option(
            "checkpointLocation", f"{tmp_path}/progress"
        ).trigger(availableNow=True).start().awaitTermination()

    def stored(batch, _):
        batch.write.mode("append").parquet(f"{tmp_path}/out")

    def refused(batch, _):
        raise OSError("access denied")

    spark.createDataFrame([(1, "f", "A")], schema).write.parquet(f"{tmp_path}/in")
    run(stored)
    spark.createDataFrame([(2, "f", "B")], schema).write.mode("append").parquet(f"{tmp_path}/in")
    with pytest.raises(StreamingQueryException):
        run(refused)
    run(stored)
    spark.createDataFrame([(3, "f", "B"), (4, "f", "A")], schema).write.mode("append").parquet(f"{tmp_path}/in")
    run(stored)
    assert sorted(r.t for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 4]


def test_stream_names_what_it_misses(spark):
    with pytest.raises(ValueError, match="no column etag"):
        changed_only(spark.createDataFrame([(1, "f")], "t long, feed string"), ["feed"], ["t"], "etag")


def test_time_slices(spark):
    df = spark.sql(
        "select * from values ('f', timestamp'2025-12-04 00:00:01', 'A'), ('f', timestamp'2025-12-04 09:00:00', 'A'),"
        " ('f', timestamp'2025-12-05 00:00:00', 'B'), ('f', null, 'B') as t(feed, t, identity)"
    )
    kept = drop_unchanged(df, ["feed"], ["t"], "identity", 3600)
    assert sorted(str(r.t) for r in kept.collect()) == ["2025-12-04 00:00:01", "2025-12-05 00:00:00", "None"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kathmandu"])
def test_key_of_a_capture_time(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.timestamp_micros(F.lit(1_764_849_659_999_999))
        key = keys.raw_key(F.lit("ferries"), at, "bin")
        parts = spark.range(1).select(
            key.alias("key"), keys.date_of(key), keys.hour_of(key), keys.captured_epoch(key)
        )
        assert parts.first() == (
            "raw/ferries/2025/12/04/12/ferries_1764849659.bin",
            "2025-12-04",
            "12",
            1764849659,
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_prefixes():
    day = dt.date(2025, 11, 2)
    assert keys.raw_prefix("vehicle_positions", day) == "raw/vehicle_positions/2025/11/02/"
    assert keys.curated_path("vehicle_positions", day) == "curated/vehicle_positions/date=2025-11-02"


def test_hour_prefix(spark):
    df = spark.createDataFrame([("raw/f/2025/11/02/10/a.pb",), ("raw/f/2025/11/02/11/b.pb",)], "key string")
    got = [r[0] for r in df.select(keys.hour_prefix(F.col("key"))).collect()]
    assert got == ["raw/f/2025/11/02/10", "raw/f/2025/11/02/11"]


def test_capture_time_of_odd_keys(spark):
    names = ["a_17.pb", "a.pb", "a_99999999999999999999.pb", "b_1_2.tar.pb", "b_1_2.pb"]
    df = spark.createDataFrame([(f"raw/f/2025/11/02/10/{n}",) for n in names], "key string")
    got = [r[0] for r in df.select(keys.captured_epoch(F.col("key"))).collect()]
    assert got == [17, None, None, None, 2]
