"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node. The vectors go through every shuffle as they are, floats as floats and
anything else as doubles, and distances are doubles, so that neither the range of the table nor
near copies blur their order.

The graph starts with neighbours in several orders of the nodes, by signs of random projections,
each cut into short stretches. In each round the vectors of a node's neighbours, in either
direction, meet at that node: they are neighbours of neighbours, each other's likely neighbours. A
pair is looked at if one of the two links is new, and given on if it is nearer than a neighbour that
one of the pair has. Rounds end when few links change.

A query is a node. Its search keeps the nearest nodes found and opens those that are not open yet,
all at once, until the nearest ones are all open.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from headway.llm.stage import discard, staged

# Links kept for each node, and links to it that are looked at in a round (the nearest ones).
DEGREE = 20
BACK = 20
# Nodes of a stretch that are compared in the first graph, and the orders that are cut.
STRETCH = 256
ORDERS = 24
# Rounds end when less than this share of the links is new.
SETTLED = 0.01
# Nodes that a search keeps.
BEAM = 256


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """id and vector (doubles) of rows with neither null, a zero vector, nor a component that is
    null or not finite. Vectors of another length than most are left out too."""
    v = F.col("vector")
    rows = vectors.select(
        F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(
        v.isNotNull() & F.col("id").isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (most["n"] if most else 0))


def _nearest(rows: DataFrame, of: str, by: list, n: int) -> DataFrame:
    """The first ``n`` rows of each ``of``; Spark limits each group before it shuffles."""
    order = F.row_number().over(W.partitionBy(of).orderBy(*by))
    return rows.withColumn("place", order).where(F.col("place") <= n).drop("place")


def _matrix(codes: pa.Array) -> np.ndarray:
    """Vectors as rows of doubles. The last byte of a code is its type."""
    if not len(codes):
        return np.zeros((0, 0))
    flat = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), -1)
    kind = f"<{chr(flat[0, -1])}"
    return np.ascontiguousarray(flat[:, :-1]).view(kind).astype(np.float64)


def _coded(nodes: DataFrame, floats: bool) -> DataFrame:
    """Nodes with their vectors as bytes, without loss where all are ``floats``."""
    kind = "f" if floats else "d"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(len(vectors), -1).astype(f"<{kind}") if len(vectors) else []
            codes = pa.array([row.tobytes() + kind.encode() for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), codes], ["node", "code"])

    return staged(nodes.mapInArrow(run, "node long, code binary"), "codes")


LINKS = "u long, v long, d double"


def _orders(orders: int, bits: int, seed: int):
    """Each node once for each order, with its place there: the signs of random projections, then
    one more projection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, planes = np.random.default_rng(seed), None
        for batch in batches:
            x = _matrix(batch.column("code"))
            if planes is None:
                planes = random.standard_normal((orders, x.shape[1], bits + 1))
            for order in range(orders):
                along = x @ planes[order]
                cell = (along[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_pydict(
                    {
                        "order": np.full(len(x), order, dtype=np.int32), "cell": cell,
                        "along": along[:, bits], "node": batch.column("node"),
                        "code": batch.column("code"),
                    }
                )

    return run


def _stretches(degree: int, stretch: int):
    """Nearest nodes within stretches of successive rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            vectors = _matrix(batch.column("code"))
            order = batch.column("order").to_numpy()
            ends = np.flatnonzero(np.r_[order[1:] != order[:-1], True]) + 1
            # An order's last stretch reaches back, so that none is short unless all are.
            cuts = [
                max(first, min(at, end - stretch))
                for first, end in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)
                for at in range(first, end, stretch)
            ]
            for start in cuts:
                end = int(ends[np.searchsorted(ends, start, side="right")])
                stop = min(start + stretch, end)
                node, x = nodes[start:stop], vectors[start:stop]
                d = _distances(x[None])[0]
                np.fill_diagonal(d, np.inf)
                n = min(degree, len(node) - 1)
                if n < 1:
                    continue
                best = np.argpartition(d, n - 1, axis=1)[:, :n]
                yield pa.RecordBatch.from_pydict(
                    {
                        "u": np.repeat(node, n), "v": node[best.ravel()],
                        "d": np.take_along_axis(d, best, axis=1).ravel(),
                    }
                )

    return run


def _distances(x: np.ndarray) -> np.ndarray:
    """Distances of the rows of each matrix, from the row of median length as the origin: among near
    copies that is one of them, so that their distances do not cancel out."""
    squares = np.einsum("ijk,ijk->ij", x, x)
    middle = np.argpartition(squares, squares.shape[1] // 2, axis=1)[:, squares.shape[1] // 2]
    x = x - x[np.arange(len(x)), middle][:, None]
    squares = np.einsum("ijk,ijk->ij", x, x)
    d = squares[:, :, None] + squares[:, None, :] - 2 * x @ x.transpose(0, 2, 1)
    return np.sqrt(np.maximum(d, 0))


def _local_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the nodes that meet at a node, where one of the two links is new and the pair is
    nearer than the farthest neighbour of one of its nodes."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            met = whole.slice(at, 256).column("met")
            sizes = met.value_lengths().to_numpy()
            flat = met.flatten()
            width = int(sizes.max())
            row = np.repeat(np.arange(len(sizes)), sizes)
            column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)

            def padded(values, fill, shape=()):
                out = np.full((len(sizes), width, *shape), fill, dtype=values.dtype)
                out[row, column] = values
                return out

            node = padded(flat.field("node").to_numpy(), -1)
            fresh = padded(flat.field("fresh").to_numpy(zero_copy_only=False), False)
            far = padded(flat.field("far").to_numpy(), -1.0)
            vectors = _matrix(flat.field("code"))
            x = padded(vectors, 0.0, vectors.shape[1:])
            # Places that nothing fills repeat the first vector, so that it may well be the origin.
            d = _distances(np.where((node >= 0)[:, :, None], x, x[:, :1]))
            ok = (node[:, :, None] != node[:, None, :]) & (node[:, :, None] >= 0)
            ok &= (node[:, None, :] >= 0) & (fresh[:, :, None] | fresh[:, None, :])
            # Each order of a pair is one row, for the node whose neighbours it may change.
            ok &= d < far[:, :, None]
            i, a, b = np.nonzero(ok)
            yield pa.RecordBatch.from_pydict({"u": node[i, a], "v": node[i, b], "d": d[i, a, b]})


def build_graph(nodes: DataFrame, degree: int = DEGREE, seed: int = 1) -> DataFrame:
    """The neighbour graph of ``nodes`` (node, code), u, v, d: the nearest nodes found for each. No
    nodes, or one, have no links."""
    n = nodes.count()
    # Cells of the signs hold half a stretch or so. A task gets a few stretches at least, so that no
    # node is alone in one.
    bits = max(1, min(40, int(np.log2(max(2, 2 * n / STRETCH)))))
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    tasks = max(1, min(tasks, n * ORDERS // (4 * STRETCH)))
    place = ["order", "cell", "along", "node"]
    dealt = nodes.mapInArrow(
        _orders(ORDERS, bits, seed), "order int, cell long, along double, node long, code binary"
    ).repartitionByRange(tasks, *place).sortWithinPartitions(*place)
    start = dealt.mapInArrow(_stretches(degree, STRETCH), LINKS)
    graph = _merged(start.withColumn("fresh", F.lit(True)), degree, "graph0")
    total = max(1, graph.count())
    # Links only become shorter, so rounds come to an end.
    for number in count(1):
        far = graph.groupBy("u").agg(
            F.when(F.count("*") >= degree, F.max("d")).otherwise(float("inf")).alias("far")
        )
        held = nodes.join(far, nodes["node"] == far["u"], "left").select(
            "node", "code", F.coalesce("far", F.lit(float("inf"))).alias("far")
        )
        back = _nearest(
            graph.select(F.col("v").alias("at"), F.col("u").alias("node"), "d", "fresh"),
            "at", ["d", "node"], BACK,
        )
        meet = (
            graph.select(F.col("u").alias("at"), F.col("v").alias("node"), "d", "fresh")
            .unionAll(back).groupBy("at", "node").agg(F.max("fresh").alias("fresh"))
        )
        met = meet.join(held, "node").groupBy("at").agg(
            F.collect_list(F.struct("node", "fresh", "far", "code")).alias("met"),
            F.max("fresh").alias("fresh"),
        ).where("fresh").select("met")
        found = met.mapInArrow(_local_joins, LINKS).withColumn("fresh", F.lit(True))
        old, before = graph.withColumn("fresh", F.lit(False)), graph
        graph = _merged(old.unionAll(found), degree, f"graph{number}")
        discard(before)
        if graph.where("fresh").count() < SETTLED * total:
            return graph.drop("fresh")


def _merged(links: DataFrame, degree: int, name: str) -> DataFrame:
    """The nearest links of each node; a link found again is not new."""
    once = links.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    return staged(_nearest(once, "u", ["d", "v"], degree), name)


def _between(a: str, b: str):
    return F.sqrt(F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    ))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = _matrix(batch.column("code")) - _matrix(batch.column("goal"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("query"), batch.column("node"), pa.array(np.sqrt((d * d).sum(axis=1)))],
            ["query", "node", "d"],
        )


def search_graph(graph: DataFrame, nodes: DataFrame, asked: DataFrame, beam: int = BEAM):
    """The nearest nodes found for each of ``asked`` (a column node): query, node; the query itself
    is one of them. ``nodes`` have node and code."""
    ways = graph.select(F.col("u").alias("node"), F.col("v").alias("next")).unionAll(
        _nearest(graph, "v", ["d", "u"], BACK).select(F.col("v").alias("node"), F.col("u").alias("next"))
    ).distinct()
    ways = staged(ways, "ways")
    asked = staged(asked.select("node").distinct().join(nodes, "node"), "asked")
    of = asked.select(F.col("node").alias("query"), F.col("code").alias("goal"))
    found = asked.select(
        F.col("node").alias("query"), "node", F.lit(0.0).alias("d"),
        F.lit(False).alias("open"),
    )
    last = None
    # A search keeps its nearest nodes, which only become nearer, so it comes to an end.
    for number in count():
        # An open node has given its ways; one met again keeps that mark.
        new = (
            found.where("NOT open").join(ways, "node").select("query", F.col("next").alias("node"))
            .distinct().join(found, ["query", "node"], "left_anti")
            .join(nodes, "node").join(of, "query").select("query", "node", "code", "goal")
            .mapInArrow(_measured, "query long, node long, d double")
            .withColumn("open", F.lit(False))
        )
        met = found.withColumn("open", F.lit(True)).unionAll(new)
        found = staged(_nearest(met, "query", ["d", "node"], beam), f"beam{number}")
        if last is not None:
            discard(last)
        last = found
        if found.where("NOT open").isEmpty():
            discard(ways, asked)
            return found.select("query", "node")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each row of ``queries`` (rows of ``vectors``), the ``k`` nearest other rows of
    ``vectors`` found: query_id, rank (from 1), vec_id and score, the Euclidean distance in double
    precision; ties to the smaller id. Rows that ``usable`` leaves out take no part. A row that is
    there twice under one id is one row."""
    rows = usable(vectors, id_, vector).distinct()
    # Numbered when written, so that a task run again finds the same numbers.
    nodes = staged(
        rows.groupBy("vector").agg(F.min("id").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    members = staged(
        rows.join(nodes.select("vector", "node"), "vector").select("node", "id"), "members"
    )
    asked = members.join(queries.select(F.col(id_).cast("long").alias("id")).distinct(), "id")
    nodes = nodes.select("node", "vector")
    codes = _coded(nodes, isinstance(vectors.schema[vector].dataType.elementType, FloatType))
    met = search_graph(build_graph(codes), codes, asked)
    goal = nodes.select(F.col("node").alias("query"), F.col("vector").alias("goal"))
    found = met.join(nodes, "node").join(goal, "query").select(
        "query", "node", _between("vector", "goal").alias("d")
    )
    # Of equal vectors only the smallest k + 1 ids can be among the k nearest.
    few = _nearest(members, "node", ["id"], k + 1)
    listed = _nearest(
        found.join(few, "node").select("query", "id", "d"), "query", ["d", "id"], k + 1
    )
    lists = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("list"))
    out = asked.withColumnRenamed("id", "query_id").join(lists, F.col("node") == F.col("query"))
    own = F.filter("list", lambda x: x["id"] != F.col("query_id"))
    return out.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "one")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.id").alias("vec_id"),
        F.col("one.d").alias("score"),
    )
