"""Change-only capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Slices that are looked at together at each level, and levels: the last looks at two rows for
# each 2**24 slices of a key.
GROUP_BITS = 12
LEVELS = 3
# Number of the slice of rows without a time or number; others lie above it.
FIRST_SLICE = -(1 << 62)


def drop_unchanged(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], identity: str, width: float
) -> DataFrame:
    """Keeps a row only if its identity differs from that of the row before it.

    Per ``keys``, in ``order``; the first row always stays. Only neighbours are compared:
    A, B, A keeps all three. Failed stores must be filtered out before, as an identity
    moves only when its payload was stored.

    The first column of ``order``, a number or a time, is cut into slices of ``width`` (seconds
    for a time) that tasks work on alone, so a key with a third of all rows is spread over many
    tasks. Rows in which it is NULL come first, as one slice.

    The input is read and sorted once. What goes on from there are the rows found to have changed and
    each slice's first and last: at each level a first row is set against the last one of the slice
    before, among neighbouring slices, then groups of slices, and so on, so no task has all
    slices of a key. Changed rows wait beside them, spread by their slice.
    """
    names = {part: _free(df, part) for part in ("slice", "at", "first", "last", "kept", "before", "after", "apart")}
    n = names.__getitem__
    own = F.struct(F.col(identity).alias("identity"))
    changed = ~F.col(identity).eqNullSafe(F.col(n("before"))["identity"])

    def neighbours(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn(n("before"), F.lag(own).over(window)).withColumn(
            n("after"), F.lead(F.lit(1)).over(window)
        )

    sliced = df.withColumn(n("slice"), _slice(df, order[0], width))
    seen = neighbours(sliced, Window.partitionBy(*keys, n("slice")).orderBy(*order))
    is_first, is_last = F.col(n("before")).isNull(), F.col(n("after")).isNull()
    # NULL for a row whose predecessor lies in another slice.
    kept = F.when(~is_first, changed)
    rows = seen.select(
        *df.columns, n("slice"), (F.col(n("slice")) - FIRST_SLICE).alias(n("at")),
        is_first.alias(n("first")), is_last.alias(n("last")), kept.alias(n("kept")),
    )
    for level in range(1, LEVELS + 1):
        linked = F.col(n("first")) | F.col(n("last"))
        rows = rows.where(linked | F.col(n("kept")))
        # From zero up, so that the highest bits are the same for all. The last level takes what is
        # left, two rows for each group of the level before.
        shift = GROUP_BITS if level < LEVELS else 63
        rows = rows.withColumn(n("at"), F.shiftright(n("at"), shift))
        rows = rows.withColumn(n("apart"), F.when(~linked, F.col(n("slice"))))
        # A slice's first row comes before its last; they may be one.
        window = Window.partitionBy(*keys, n("at"), n("apart")).orderBy(n("slice"), n("last"))
        seen = neighbours(rows, window)
        settled = F.col(n("first")) & ~is_first
        rows = seen.select(
            *df.columns, n("slice"), n("at"),
            (linked & is_first).alias(n("first")), (linked & is_last).alias(n("last")),
            F.when(settled, changed).otherwise(F.col(n("kept"))).alias(n("kept")),
        )
    # What is still open is the first row of its key.
    return rows.where(F.coalesce(F.col(n("kept")), F.lit(True))).select(*df.columns)


def _free(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    name = f"_{name}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def _slice(df: DataFrame, first: str, width: float) -> Column:
    at = F.col(first)
    if df.schema[first].dataType.typeName().startswith("timestamp"):
        at = F.unix_micros(at.cast("timestamp")) / 1_000_000
    return F.coalesce(F.floor(at / width).cast("long"), F.lit(FIRST_SLICE))
