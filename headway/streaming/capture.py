"""Change-only capture while polling: a stream that knows the last stored identity of each key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Groups of keys, by a hash, that are called and kept together.
BUCKETS = 1 << 12


def changed_only(
    polls: DataFrame, keys: Sequence[str], order: Sequence[str], identity: str
) -> DataFrame:
    """The polls of a stream whose identity differs from that of the poll before, per ``keys``.

    The batch counterpart is :func:`headway.operators.capture.drop_unchanged`, and rows are the same if
    polls arrive in order: those of one trigger are put in ``order`` first (NULL first), and each
    trigger's come after the last one's. A poll that comes late is compared with what is stored by
    then, as a capture that is under way does.

    What is kept of a key is the identity last stored, one value. It is committed with the batch that
    stores the payload: if that fails, the batch is done again from the state before, so an identity
    never moves without its payload. Polls that are known to have failed are filtered out before.

    Keys share the state, and the call, of one of ``BUCKETS``, so that a trigger costs no more calls
    than that however many keys it has. A trigger's polls of one bucket are compared in one task, which
    holds them; the source's limits (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bound them.
    """
    for column in (*keys, *order, identity):
        if column not in polls.columns:
            raise ValueError(f"the stream has no column {column}")
    # NULLs of numbers go beside them, as pandas has none.
    numbers = {
        c for c, f in zip(polls.columns, polls.schema)
        if isinstance(f.dataType, T.NumericType) and not isinstance(f.dataType, T.DecimalType)
    }
    place = {c: n for n, c in enumerate(polls.columns)}
    values = [
        (F.coalesce(polls[c], F.lit(0).cast(polls.schema[c].dataType)) if c in numbers else polls[c]).alias(f"c{n}")
        for c, n in place.items()
    ]
    unset = [polls[c].isNull().alias(f"n{place[c]}") for c in place if c in numbers]
    key = F.to_json(F.struct(*[_text(polls, c).alias(f"k{n}") for n, c in enumerate(keys)]))
    marked = polls.select(
        *values, *unset, key.alias("key"), _text(polls, identity).alias("identity"),
        F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket"),
    )
    out = marked.drop("key", "identity", "bucket").schema
    sent = out.names
    ordered = [(f"c{place[c]}", f"n{place[c]}" if c in numbers else None) for c in order]
    state_schema = T.StructType([
        T.StructField(name, T.ArrayType(T.StringType())) for name in ("keys", "identities")
    ])

    def compare(
        _: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts), ignore_index=True)
        # NULL first; a sort of the frame takes longer than all else for a few rows.
        parts_of = []
        for value, flag in ordered:
            there = (rows[value].notna() & ~rows[flag].astype(bool) if flag else rows[value].notna()).tolist()
            parts_of += [there, [v if ok else None for v, ok in zip(rows[value].tolist(), there, strict=True)]]
        at = sorted(range(len(rows)), key=list(zip(*parts_of, strict=True)).__getitem__)
        owners, known = rows["key"].tolist(), rows["identity"].where(rows["identity"].notna(), None).tolist()
        last = dict(zip(*state.get, strict=True)) if state.exists else {}
        kept = []
        for n in at:
            own, now = owners[n], known[n]
            if own not in last or last[own] != now:
                kept.append(n)
            last[own] = now
        state.update((list(last), list(last.values())))
        yield rows.iloc[kept, : len(sent)]

    changed = marked.groupBy("bucket").applyInPandasWithState(
        compare, out, state_schema, "append", GroupStateTimeout.NoTimeout
    )
    return changed.select(*[
        (F.when(~F.col(f"n{n}"), F.col(f"c{n}")) if c in numbers else F.col(f"c{n}")).alias(c)
        for c, n in place.items()
    ])


def _text(df: DataFrame, name: str) -> Column:
    """A value as text, different values differently; NULL stays."""
    binary = isinstance(df.schema[name].dataType, T.BinaryType)
    return F.base64(df[name]) if binary else df[name].cast("string")
