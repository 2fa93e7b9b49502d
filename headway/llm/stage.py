"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.shared import shared_folder

# Text handled at a time within a task, in bytes; a single longer text is handled alone.
SLICE_BYTES = 4 << 20
# Rows go to Python in batches of so many bytes, by Spark's own setting: each batch is held at once by
# the JVM and by the worker, for every task of an executor.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARKS_BATCH_BYTES = "67108864b"

# Stands for a null document id in joins.
NO_ID = -(1 << 63)


def id_key(doc_id: str | Column = "doc_id") -> Column:
    """A document id as a long that joins, also where it is null."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def as_id(key: str | Column) -> Column:
    """The document id of a key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.nullif(column, F.lit(NO_ID))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like those wanted that the table does not have."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, jobs hand rows to Python in batches of BATCH_BYTES, unless the session sets a size
    of its own; afterwards the session is as it was."""
    ours = spark.conf.get(_BATCH_SETTING, _SPARKS_BATCH_BYTES) == _SPARKS_BATCH_BYTES
    if ours:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(_BATCH_SETTING)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table as Parquet and reads it again: lineage ends there, and it is computed once."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with small_batches(spark):
        df.write.parquet(path)
    # Spark removes the shuffle files of a finished job when the driver collects its garbage, which
    # it may not do for half an hour; a job of many stages would hold all of them until then.
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of staged tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(path, True)


def most_frequent(counts: DataFrame, by: list[str], size: int) -> DataFrame:
    """The ``size`` rows of highest ``n``, ties in order of ``by``.

    Every task of a sort with a limit sends that many rows to the driver. So rows that cannot be
    among them go first, by a histogram of 16 steps to the power of two.
    """
    counts = staged(counts, "counts")
    step = F.floor(F.log2("n") * 16)
    seen, least = 0, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        seen, least = seen + row["count"], row["step"]
        if seen >= size:
            break
    return counts.where(step >= least).orderBy(F.desc("n"), *by).limit(size)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows, so that one slice holds about ``SLICE_BYTES`` of the column."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(lengths, dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop
