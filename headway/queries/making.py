"""Helpers that make raw objects for the queries, and show the order of written files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from headway.feeds import LONG, STRING
from headway.sources import wire
from headway.sources.objects import appearing_whole, open_store, qualified, writing_folder


def pack(
    entities: DataFrame,
    keep: Sequence[str] = ("date", "hour"),
    max_entities: int = 1000,
    messages: wire.Messages | None = None,
) -> DataFrame:
    """Packs entity rows to payloads, the inverse of decoding.

    Takes the ``keep`` columns, ``header_timestamp`` and ``entity``; gives ``keep``,
    ``header_timestamp`` and ``content``. A NULL entity adds nothing, so alone it is a header-only
    payload. Rows of one batch with equal ``keep`` and header time share payloads of at most
    ``max_entities``; nothing is shuffled or gathered, so one poll may be several payloads.
    """
    keep = list(keep)
    schema = T.StructType([T.StructField(name, STRING) for name in keep])
    schema = schema.add("header_timestamp", LONG).add("content", T.BinaryType())
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        message, known = wire.feed_message(messages), wire.messages(messages)
        for batch in batches:
            entity = batch.column("entity")
            there = _valid(entity)
            heads = [batch.column(name) for name in (*keep, "header_timestamp")]
            order, starts = _grouped(heads, there, max_entities)
            if not len(starts):
                continue
            heads = [values.take(pa.array(order[starts])).cast(f.type) for values, f in zip(heads, arrow)]
            headers = [
                message(header={"gtfs_realtime_version": "2.0", "timestamp": time}).SerializeToString()
                for time in heads[-1].to_pylist()
            ]
            entity = entity.filter(pa.array(there))
            # Text that is not UTF-8 is refused here, as nothing reads it one by one.
            entity.validate(full=True)
            filled = there[order]
            places = (np.cumsum(there) - 1)[order[filled]]
            items = encoded(entity, "FeedEntity", known).take(pa.array(places))
            sizes = np.add.reduceat(filled.astype(np.int64), starts)
            bodies = _repeated(items, sizes, known["FeedMessage"]["entity"][1])
            contents = pc.binary_join_element_wise(pa.array(headers, pa.binary()), bodies, b"")
            yield pa.RecordBatch.from_arrays([*heads, contents], schema=arrow)

    return entities.select(*keep, "header_timestamp", "entity").mapInArrow(run, schema)


def _grouped(heads: list[pa.Array], there: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in an order that has equal heads together, and where in it each payload starts: at a new
    head, and at a row that finds so many entities in its payload."""
    code = np.zeros(len(there), np.int64)
    for values in heads:
        own = values.dictionary_encode(null_encoding="encode")
        both = code * (len(own.dictionary) + 1) + np.asarray(own.indices)
        code = np.unique(both, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    code, filled = code[order], there[order]
    before = np.cumsum(filled) - filled
    first = np.searchsorted(code, code)
    full = (before - before[first]) // most
    new = np.ones(len(order), np.bool_)
    new[1:] = (code[1:] != code[:-1]) | (full[1:] != full[:-1])
    return order, np.flatnonzero(new)


# Numbers that a field holds; an enum holds its codes.
_RANGES = {
    "int32": (-(2**31), 2**31 - 1),
    "sint32": (-(2**31), 2**31 - 1),
    "uint32": (0, 2**32 - 1),
    "uint64": (0, 2**63 - 1),
}
_FIXED = {"float": (5, "<f4"), "double": (1, "<f8")}
_LENGTH_GIVEN = 2


def encoded(
    column: pa.StructArray,
    message: str,
    known: Mapping[str, Mapping[str, tuple[str, int]]],
    there: np.ndarray | None = None,
) -> pa.BinaryArray:
    """Rows of a struct column as messages on the wire, column by column; NULL leaves a field unset.

    The bytes are those of the protobuf package, and what it refuses fails: a required field unset, a
    number beyond its type, a code outside its enum. Rows not ``there`` have no message; they give
    no bytes.
    """
    there = np.ones(len(column), np.bool_) if there is None else there
    fields = dict(zip((field.name for field in column.type), column.flatten()))
    for name, (kind, _) in known[message].items():
        if kind.endswith("!") and there.any():
            given = _valid(fields[name]) if name in fields else np.zeros(len(there), np.bool_)
            if (there & ~given).any():
                from google.protobuf.message import EncodeError

                raise EncodeError(f"{message} is missing required fields: {name}")
    parts: list[pa.Array] = []
    filled = [name for name, values in fields.items() if values.null_count < len(values)]
    for name in sorted(filled, key=lambda name: known[message][name][1]):
        values, (kind, number) = fields[name], known[message][name]
        base, valid = kind.rstrip("!*"), _valid(values)
        if kind.endswith("*"):
            sizes = np.asarray(pc.fill_null(values.value_lengths(), 0), dtype=np.int64)
            parts.append(_repeated(encoded(values.flatten(), base, known), sizes, number))
        elif base in known or base == "string":
            body = encoded(values, base, known, valid) if base in known else values.cast(pa.binary())
            body = pc.fill_null(body, b"")
            parts += [_varints(_lengths(body), _tag(number, _LENGTH_GIVEN), valid), body]
        elif base in _FIXED:
            code, kept = _FIXED[base]
            numbers = np.asarray(pc.fill_null(values.cast(pa.float64()), 0.0))
            with np.errstate(over="ignore"):
                numbers = np.ascontiguousarray(numbers.astype(kept))
            parts.append(_cut(_tag(number, code), numbers.view(np.uint8).reshape(len(numbers), -1), valid))
        else:
            numbers = np.asarray(pc.fill_null(values.cast(pa.int64()), 0), dtype=np.int64)
            _check(numbers[valid], base, f"{message}.{name}")
            if base.startswith("sint"):
                numbers = (numbers << 1) ^ (numbers >> 63)
            parts.append(_varints(numbers, _tag(number, 0), valid))
    if not parts:
        return pa.array([b""] * len(column), pa.binary())
    return pc.binary_join_element_wise(*parts, b"")


def _valid(values: pa.Array) -> np.ndarray:
    return values.is_valid().to_numpy(zero_copy_only=False)


def _lengths(values: pa.BinaryArray) -> np.ndarray:
    return np.asarray(pc.binary_length(values), dtype=np.int64)


def _check(numbers: np.ndarray, kind: str, where: str) -> None:
    if kind in wire.ENUMS:
        fits = np.isin(numbers, wire.ENUMS[kind])
    else:
        low, high = _RANGES.get(kind, (-(2**63), 2**63 - 1))
        fits = (numbers >= low) & (numbers <= high)
    if not fits.all():
        raise ValueError(f"{where}: {numbers[~fits][0]} is no {kind}")


def _tag(number: int, code: int) -> np.ndarray:
    value = number << 3 | code
    groups = [value >> 7 * n & 0x7F for n in range((value.bit_length() + 6) // 7)]
    return np.array([*[group | 0x80 for group in groups[:-1]], groups[-1]], np.uint8)


def _varints(numbers: np.ndarray, tag: np.ndarray, valid: np.ndarray) -> pa.BinaryArray:
    """The tag and the number of each valid row, seven bits to a byte, low ones first."""
    rest = numbers.view(np.uint64)
    widest = max(1, (int(rest.max(initial=0)).bit_length() + 6) // 7)
    groups = rest[:, None] >> (7 * np.arange(widest, dtype=np.uint64))
    more = np.zeros(groups.shape, np.bool_)
    more[:, :-1] = groups[:, 1:] > 0
    return _cut(tag, (groups & 0x7F | more * np.uint64(0x80)).astype(np.uint8), valid, 1 + more.sum(axis=1))


def _cut(tag: np.ndarray, rows: np.ndarray, valid: np.ndarray, sizes: np.ndarray | None = None) -> pa.BinaryArray:
    """The tag and the first ``sizes`` bytes of each valid row, all bytes by default."""
    whole = np.concatenate([np.broadcast_to(tag, (len(rows), len(tag))), rows], axis=1)
    ends = np.where(valid, len(tag) + (rows.shape[1] if sizes is None else sizes), 0)
    kept = whole[np.arange(whole.shape[1]) < ends[:, None]]
    offsets = np.concatenate([[0], np.cumsum(ends)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])


def _repeated(items: pa.BinaryArray, sizes: np.ndarray, number: int) -> pa.BinaryArray:
    """Encoded messages of a repeated field, so many of them to a row."""
    every = np.ones(len(items), np.bool_)
    tagged = pc.binary_join_element_wise(_varints(_lengths(items), _tag(number, _LENGTH_GIVEN), every), items, b"")
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(offsets, tagged), b"")


def put_objects(objects: DataFrame, lake: str) -> int:
    """Stores ``content`` under ``key`` for every row and returns how many there were.

    A repeated attempt rewrites the same bytes under the same key. Files appear whole.
    """
    lake = qualified(objects.sparkSession, lake)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(lake)
        with writing_folder(store, base) as beside:
            for batch in batches:
                for key, content in zip(*[c.to_pylist() for c in batch.columns]):
                    with appearing_whole(store, base, f"{base}/{key}", beside) as sink:
                        sink.write(content)
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    written = objects.select("key", "content").mapInArrow(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_days(sorted_rows: DataFrame, path: str) -> None:
    """Writes rows already sorted by ``date`` first, a folder a day."""
    sorted_rows.write.partitionBy("date").option("compression", "zstd").parquet(path)


def with_positions(table: DataFrame) -> DataFrame:
    """Adds ``position``: the place of each row within its day, in file order, from 1.

    For a table read from what ``write_days`` wrote. Only one row per file is gathered to
    learn how many rows the files before it hold.
    """
    placed = table.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # Names number their files, and as text part-100000 comes before part-99999.
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    files = placed.groupBy("date", "_file").agg((F.max("_row") + 1).alias("_size"))
    order = Window.partitionBy("date").orderBy(number, "_file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        "date", "_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return placed.join(starts, ["date", "_file"]).select(
        *table.columns, (F.col("_start") + F.col("_row") + 1).alias("position")
    )
