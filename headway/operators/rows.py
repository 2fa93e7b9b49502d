"""Row operators: flattening, typing, distinct and order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_outer(
    df: DataFrame, parents: Sequence[Column], items: Column, leaves: Mapping[str, str]
) -> DataFrame:
    """One row per list element, the parent columns repeated on each.

    ``leaves`` maps output names to field paths in the element. A parent whose list is
    empty or NULL keeps one row with all leaf columns NULL.
    """
    parts = df.select(*parents, items.alias("_items"))
    kept = [F.col(f"`{name}`") for name in parts.columns[:-1]]
    # Two steps, so that the generator copies the parent columns and not what they come from.
    exploded = parts.select(*kept, F.explode_outer("_items").alias("_leaf"))
    return exploded.select(
        *kept, *[F.col(f"_leaf.{path}").alias(name) for name, path in leaves.items()]
    )


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns of ``schema``, in order and cast, after the ``keep`` columns.

    Names must agree: a missing or an extra column is an error, not a NULL or a drop.
    """
    want, have = set(schema.names) | set(keep), set(df.columns)
    twice = {name for name in have if df.columns.count(name) > 1}
    if want != have or twice:
        raise ValueError(
            f"columns do not match the schema: missing {sorted(want - have)}, "
            f"extra {sorted(have - want)}, duplicated {sorted(twice)}"
        )
    return df.select(
        *keep, *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
    )


def union_parts(parts: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """All parts as one table of one schema; duplicates stay."""
    typed = [conform(part, schema) for part in parts]
    union = typed[0]
    for part in typed[1:]:
        union = union.unionByName(part)
    return union


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact full-row distinct, NULL equal to NULL, nested columns included.

    Each task drops its own copies before the shuffle, so a row copied without bound
    reaches the reducer at most once per task.
    """
    return df.distinct()


def _sort_order(df: DataFrame, keys: Sequence[str], lead: Sequence[str]) -> list[Column]:
    """The lead columns and the keys, NULLs last, then a hash of the rest: it breaks ties, so that
    range partitioning can split a key that holds many rows."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (*lead, *keys)]
    ties = [F.xxhash64(*rest)] if rest else []
    return [*[F.col(c).asc_nulls_last() for c in (*lead, *keys)], *ties]


def day_sort(df: DataFrame, keys: Sequence[str], lead: Sequence[str] = ("date",)) -> DataFrame:
    """Global sort on the lead columns and the keys, ascending with NULLs last.

    Rows equal on all keys have no promised order among them.
    """
    return df.orderBy(*_sort_order(df, keys, lead))


def distinct_sorted(
    df: DataFrame, keys: Sequence[str], partitions: int, lead: Sequence[str] = ("date",)
) -> DataFrame:
    """Full-row distinct in the order of :func:`day_sort`, over so many partitions, in one shuffle.

    Ranges are cut by the lead columns, the keys and a hash of the rest, so each holds all copies of
    its rows: the distinct and the sort need no exchange of their own, and a key that holds many rows
    is split. (If a key is a floating-point number, which Spark normalises before it compares, or a
    literal, Spark adds the exchanges that it then needs; the result is the same.)
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (*lead, *keys)]
    hashed = df.withColumn("_rest", F.xxhash64(*rest) if rest else F.lit(0).cast("long"))
    order = [*[F.col(c).asc_nulls_last() for c in (*lead, *keys)], F.col("_rest")]
    ranges = hashed.repartitionByRange(partitions, *order)
    return ranges.distinct().orderBy(*order).drop("_rest")
