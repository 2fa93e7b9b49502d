"""What a named backfill has done: a small object for each feed and day, put when the day is done."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from headway.sources.objects import appearing_whole, open_store, qualified

# Objects read or put at a time.
AT_ONCE = 16


def _folder(base: str, name: str, feed: str) -> str:
    if not name or "/" in name or name.startswith("."):
        raise ValueError(f"{name!r} cannot name a backfill")
    return f"{base}/backfills/{name}/{feed}"


def add(
    spark: SparkSession, lake: str, name: str, feed: str,
    outcomes: Mapping[dt.date, tuple[str, Mapping | None]],
) -> None:
    """Keeps the status and quality of days; a day's earlier entry is replaced."""
    store, base = open_store(qualified(spark, lake))
    folder = _folder(base, name, feed)

    def put(item: tuple) -> None:
        day, (status, quality) = item
        with appearing_whole(store, base, f"{folder}/{day:%Y-%m-%d}.json") as sink:
            sink.write(json.dumps({"status": status, "quality": quality}).encode())

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(put, outcomes.items()))


def read(
    spark: SparkSession, lake: str, name: str, feed: str, days: Iterable[dt.date]
) -> dict[dt.date, dict]:
    """Status and quality of those of the days that are done."""
    store, base = open_store(qualified(spark, lake))
    where = pafs.FileSelector(_folder(base, name, feed), allow_not_found=True)
    there = {found.base_name: found.path for found in store.get_file_info(where)}
    wanted = {day: there[f"{day:%Y-%m-%d}.json"] for day in days if f"{day:%Y-%m-%d}.json" in there}

    def get(item: tuple) -> tuple[dt.date, dict]:
        day, path = item
        with store.open_input_stream(path) as source:
            return day, json.loads(source.read())

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(pool.map(get, wanted.items()))
