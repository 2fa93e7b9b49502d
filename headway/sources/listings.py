"""Listings that remember: what the folders of days long past hold, kept in the lake.

Raw objects are stored under the hour in which they were captured and never change, so the folders
of a day get no more objects once it is over, and need to be listed only once. A day's listing is kept
as a table of its own with a small object that holds its count; without it, or if the table has
another count, the day is listed again. An object that was put into such a day by hand is not seen
until :func:`forget` is called.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.objects import appearing_whole, list_objects, open_store, qualified

# A day is over when this much of the next has passed: uploads may come late.
GRACE = dt.timedelta(hours=6)
AT_ONCE = 16
_SCHEMA = "hour string, key string, length long, date string"


def is_over(day: dt.date, now: dt.datetime | None = None) -> bool:
    end = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), dt.UTC)
    return (now or dt.datetime.now(dt.UTC)) >= end + GRACE


def _table(root: str, feed: str) -> str:
    return f"{root}/listings/{feed}"


def _count_path(base: str, feed: str, day: str) -> str:
    return f"{base}/listings/_counts/{feed}/{day}.json"


def _kept(spark: SparkSession, lake: str, feed: str, days: Sequence[str]) -> dict[str, int]:
    """Counts of the days that have been listed before."""
    store, base = open_store(qualified(spark, lake))
    where = pafs.FileSelector(f"{base}/listings/_counts/{feed}", allow_not_found=True)
    there = {found.base_name for found in store.get_file_info(where)}

    def get(day: str) -> tuple[str, int]:
        with store.open_input_stream(_count_path(base, feed, day)) as source:
            return day, json.loads(source.read())["n"]

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(pool.map(get, [day for day in days if f"{day}.json" in there]))


def list_remembered(spark: SparkSession, lake: str, feed: str, days: Sequence[dt.date]) -> DataFrame:
    """As :func:`headway.sources.objects.list_objects`, but lists only folders of days that are not
    over or have not been listed before, and keeps the listing of those that are over."""
    by_name = {f"{day:%Y-%m-%d}": day for day in days}
    kept = _kept(spark, lake, feed, list(by_name))
    table = spark.read.schema(_SCHEMA)
    # Days without objects have no folder.
    held = [day for day, n in kept.items() if n]
    columns = ["date", "hour", "key", "length"]
    remembered = None
    if held:
        folders = [f"{_table(lake, feed)}/date={day}" for day in held]
        try:
            remembered = table.option("basePath", _table(lake, feed)).parquet(*folders).select(*columns)
            counts = {r.date: r["count"] for r in remembered.groupBy("date").count().collect()}
        except (PySparkException, Py4JJavaError):  # A folder that is gone, or an unreadable file.
            counts = {}
        broken = [day for day in held if counts.get(day) != kept[day]]
        kept = {day: n for day, n in kept.items() if day not in broken}
        remembered = remembered.where(~F.col("date").isin(broken)) if counts else None
    todo = [day for name, day in by_name.items() if name not in kept]
    if not todo:
        return remembered if remembered is not None else spark.createDataFrame([], _SCHEMA).select(*columns)
    listed = list_objects(spark, lake, feed, todo)
    over = [day for day in todo if is_over(day)]
    if over:
        _keep(spark, lake, feed, listed, over)
        # Read again, so that folders are listed once.
        fresh = _read_new(spark, lake, feed, over).select(*columns)
        still = [day for day in todo if day not in over]
        listed = fresh.unionByName(list_objects(spark, lake, feed, still)) if still else fresh
    return listed if remembered is None else remembered.unionByName(listed)


def _keep(spark: SparkSession, lake: str, feed: str, listed: DataFrame, days: Sequence[dt.date]) -> None:
    names = [f"{day:%Y-%m-%d}" for day in days]
    (
        listed.where(F.col("date").isin(names)).write.mode("overwrite").partitionBy("date")
        .option("partitionOverwriteMode", "dynamic").parquet(_table(lake, feed))
    )
    counts = {r.date: r["count"] for r in _read_new(spark, lake, feed, days).groupBy("date").count().collect()}
    store, base = open_store(qualified(spark, lake))

    def put(day: str) -> None:
        with appearing_whole(store, base, _count_path(base, feed, day)) as sink:
            sink.write(json.dumps({"n": counts.get(day, 0)}).encode())

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(put, names))


def _read_new(spark: SparkSession, lake: str, feed: str, days: Sequence[dt.date]) -> DataFrame:
    names = [f"{day:%Y-%m-%d}" for day in days]
    return spark.read.schema(_SCHEMA).parquet(_table(lake, feed)).where(F.col("date").isin(names))


def forget(spark: SparkSession, lake: str, feed: str, days: Sequence[dt.date]) -> None:
    """Lets the next listing of these days look into their folders again."""
    store, base = open_store(qualified(spark, lake))
    for day in days:
        path = _count_path(base, feed, f"{day:%Y-%m-%d}")
        if store.get_file_info(path).is_file:
            store.delete_file(path)
