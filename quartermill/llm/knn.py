"""Exact top-k search by inner product as a Voronoi join.

Vectors get one more component, so that the largest inner product becomes the least
distance: data vectors are lifted to the same norm, queries get a zero. A bounded
sample of the data serves as pivots; data and queries fall into the cell of their
nearest pivot. Small summaries of the cells (distances of the nearest members to the
pivot, ranges of the queries' distances to all pivots) bound how far the k-th
neighbour of any query of a cell can be, and from which ring of which data cell it
can come. Data go only to the query groups whose rings they are in; large cells of
queries are split, and so are the data of a group, and each unit solves its block with
a matrix product. The best of all units are merged per query.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermill.llm.common import cut, grouped, text_buffer

#: Size of the sample of pivots; all summaries are bounded by its square.
PIVOTS = 48
#: Queries that data are sent out for at once, and data that they meet in one task.
GROUP = 16384
CHUNK = 16384
#: Queries whose products with a chunk are held at once.
QUERIES = 512
EXACT = 1 << 53
LOW, HIGH = -(1 << 63), (1 << 63) - 1


class Space(NamedTuple):
    """Pivots (lifted), the norm all data have when lifted, and the number of components."""

    pivots: np.ndarray
    norm: float
    width: int


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles, filled up with zeros."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy()[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    out = np.zeros((len(column), width))
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(offsets[:-1], sizes)] = flat
    return out


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Data vectors with the component that brings them to the norm."""
    rest = np.maximum(norm**2 - (vectors**2).sum(axis=1), 0.0)
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)


def gaps(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors to pivots."""
    square = (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def find_space(data: DataFrame, pivots: int) -> Space | None:
    """A bounded sample in order of hash, and the largest norm; nothing for no data."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most = data.agg(F.max(square).alias("norm"), F.max(F.size("v")).alias("width")).first()
    if most.width is None:
        return None
    norm, width = float(np.sqrt(most.norm)), most.width
    rows = data.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").collect()
    sample = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        sample[k, : len(r.v)] = r.v
    return Space(np.unique(lifted(sample, norm), axis=0), norm, width)


def packed(column: pa.Array) -> pa.Array:
    """Lists of longs as bytes."""
    flat = column.flatten().to_numpy()
    offsets = column.offsets.to_numpy().astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer((offsets - offsets[0]) * np.int32(8)), pa.py_buffer(np.ascontiguousarray(flat))])


def assign_data(data: DataFrame, space: Space) -> DataFrame:
    """``id``, ``cell``, distance to its pivot, and the vector as bytes."""

    def run(batches):
        for batch in batches:
            far = gaps(lifted(matrix(batch.column(1), space.width), space.norm), space.pivots)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell), pa.array(far[np.arange(len(cell)), cell]), packed(batch.column(1))], names=["id", "cell", "dist", "v"])

    return data.select("id", "v").mapInArrow(run, "id long, cell long, dist double, v binary")


def query_gaps(column: pa.Array, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """Distances of queries to all pivots, and their cells."""
    vectors = matrix(column, max(space.width, int(pa.compute.max(pa.compute.list_value_length(column)).as_py() or 0)))[:, : space.width]
    far = gaps(np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1), space.pivots)
    return far, far.argmin(axis=1)


def assign_queries(queries: DataFrame, space: Space) -> DataFrame:
    """``id``, ``cell`` and the vector as bytes."""

    def run(batches):
        for batch in batches:
            _, cell = query_gaps(batch.column(1), space)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell), packed(batch.column(1))], names=["id", "cell", "v"])

    return queries.select("id", "v").mapInArrow(run, "id long, cell long, v binary")


def summarise_queries(queries: DataFrame, space: Space) -> DataFrame:
    """Per query cell and pivot: least and largest distance, and the least difference of squares to the own pivot's."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            far, cell = query_gaps(batch.column(1), space)
            square = far**2 - (far[np.arange(len(cell)), cell] ** 2)[:, None]
            order = np.argsort(cell, kind="stable")
            found, starts = np.unique(cell[order], return_index=True)
            cut_ = lambda f, x: f.reduceat(x[order], starts, axis=0).ravel()
            n = len(space.pivots)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                np.repeat(found, n), np.tile(np.arange(n), len(found)), cut_(np.minimum, far), cut_(np.maximum, far), cut_(np.minimum, square),
            )], names=["q", "cell", "low", "high", "edge"])

    rows = queries.select("id", "v").mapInArrow(run, "q long, cell long, low double, high double, edge double")
    return rows.groupBy("q", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("edge").alias("edge"))


def rings(space: Space, near: list, ranges: list, k: int) -> np.ndarray:
    """``[query cell, data cell]``: least and largest distance to the pivot at which data may matter."""
    n = len(space.pivots)
    between = gaps(space.pivots, space.pivots)
    slack = 1e-5 * (space.norm + 1)
    out = np.full((n, n, 2), np.nan)
    by_cell: dict[int, list] = {}
    for r in ranges:
        by_cell.setdefault(r.q, []).append(r)
    for q, rows in by_cell.items():
        high = {r.cell: r.high for r in rows}
        reach = sorted(high[cell] + dist for cell, dist in near)
        # One more than k: the query's own row may be among them.
        bound = reach[k] + slack if len(reach) > k else np.inf
        for r in rows:
            if q != r.cell and bound < np.inf and r.edge > 2 * between[q, r.cell] * (bound + slack):
                continue  # the whole cell lies behind the plane between the two pivots
            out[q, r.cell] = r.low - bound - slack, r.high + bound + slack
    return out


def products(queries: list[np.ndarray], data: list[np.ndarray]) -> np.ndarray:
    """Exact inner products; what a long can't hold becomes its nearest end."""
    width = max(map(len, [*queries, *data]), default=0)

    def fill(rows):
        if all(len(r) == width for r in rows):
            return np.stack(rows) if rows else np.zeros((0, width), np.int64)
        out = np.zeros((len(rows), width), np.int64)
        for k, r in enumerate(rows):
            out[k, : len(r)] = r
        return out

    a, b = fill(queries), fill(data)
    top = max(width, 1) * max((abs(int(x)) for m in (a,) if m.size for x in (m.min(), m.max())), default=0)
    top *= max((abs(int(x)) for m in (b,) if m.size for x in (m.min(), m.max())), default=0)
    if top < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < HIGH:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.array([[min(max(x, LOW), HIGH) for x in row] for row in exact], np.int64).reshape(exact.shape)


def best_of(group: np.ndarray, near: np.ndarray, ids: np.ndarray, own: list, theirs: list, k: int) -> tuple[np.ndarray, ...]:
    """The best ``k`` of some data rows for each of some queries: query, row and score."""
    score = products(own, theirs)
    other = ids[group][:, None] != ids[near]
    # Those at least as good as the k-th best other row; ties are settled by id.
    masked = np.where(other, score, LOW)
    least = np.partition(masked, len(near) - k, axis=1)[:, len(near) - k] if len(near) > k else np.full(len(group), LOW)
    a, b = np.nonzero(other & (masked >= least[:, None]))
    order = np.lexsort((ids[near][b], -score[a, b].astype(np.float64), a)) if abs(score).max() < EXACT else np.array(
        sorted(range(len(a)), key=lambda i: (a[i], -int(score[a[i], b[i]]), ids[near[b[i]]])), np.int64)
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    a, b = a[place < k], b[place < k]
    return ids[group[a]], ids[near[b]], score[a, b]


def solve(table: pa.Table, rings_: np.ndarray, k: int) -> list[np.ndarray]:
    """The best ``k`` of a unit's data for each of its queries."""
    side, ids, cell, dist = (table.column(c).to_numpy() for c in ("side", "id", "cell", "dist"))
    raw, offsets, _ = text_buffer(table.column("v").combine_chunks())
    raw, at = raw.tobytes(), offsets.tolist()
    row = lambda i: np.frombuffer(raw[at[i] : at[i + 1]], np.int64)
    found: list[list] = [[], [], []]
    mine = np.flatnonzero(side == 1)
    mine = mine[np.argsort(ids[mine], kind="stable")]
    if (ids[mine][1:] == ids[mine][:-1]).any():  # repeated rows count once
        mine = np.array(list({(ids[i], raw[at[i] : at[i + 1]]): i for i in mine}.values()))
    asked = np.flatnonzero(side == 0)
    for q in np.unique(cell[asked]):
        low, high = rings_[q][cell[mine]].T
        near = mine[(dist[mine] >= low) & (dist[mine] <= high)]
        group = asked[cell[asked] == q]
        if not len(near):
            continue
        theirs = [row(i) for i in near]
        for at_once in np.array_split(group, -(-len(group) // QUERIES)):
            for out, x in zip(found, best_of(at_once, near, ids, [row(i) for i in at_once], theirs, k)):
                out.append(x)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """The ``k`` rows of ``data`` with the largest inner product for each row of ``queries``, but its own.

    Both have ``id`` (long) and ``v`` (array of longs). Returns ``query_id``, ``rank``
    (from 1), ``vec_id`` and ``score``; ties go to the smaller id, and a query gets all
    others if there are fewer than ``k``. Own is what has the same id. Rows with a null
    id, a null vector or a null component take no part. Of vectors of unequal length
    the shorter ends in zeros. Repeated rows count once; of queries that repeat an id the
    least vector asks. Scores beyond a long become its nearest end. Without data or
    queries there are no rows. Other columns play no part.
    """
    valid = lambda df: df.select(F.col("id").cast("long").alias("id"), "v").filter(
        "id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    data = valid(data)
    queries = valid(queries).groupBy("id").agg(F.min("v").alias("v"))
    spark = data.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    space = find_space(data, pivots)
    if space is None:
        return empty
    held = cut(assign_data(data, space))
    asked = cut(assign_queries(queries, space))
    ids = held.groupBy("id").agg(F.min(F.struct("dist", "cell")).alias("near"))
    nearest = Window.partitionBy("cell").orderBy("dist")
    near = ids.select("near.cell", "near.dist").withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k + 1)
    near = [(r.cell, r.dist) for r in near.select("cell", "dist").collect()]
    rings_ = rings(space, near, summarise_queries(queries, space).collect(), k)

    # Query cells into groups: small ones together, a large one split.
    sizes = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    bases, base, room = {}, -1, 0
    for cell in sorted(sizes):
        if room < sizes[cell]:
            base, room = base + 1, group
        bases[cell], room = base, room - sizes[cell]
    if not bases:
        return empty
    members: dict[int, list] = {}
    for cell, b in bases.items():
        members.setdefault(b, []).append(cell)
    splits = {b: -(-sum(sizes[c] for c in cells) // group) for b, cells in members.items()}
    routes = []
    for b, cells in members.items():
        own = rings_[cells]
        for c in np.flatnonzero(~np.isnan(own[:, :, 0]).all(axis=0)):
            routes.append((int(c), b, float(np.nanmin(own[:, c, 0])), float(np.nanmax(own[:, c, 1])), splits[b]))
    chunks = -(-held.count() // chunk) or 1
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    table = spark.createDataFrame(routes, "cell long, base long, low double, high double, splits long")
    sent = held.join(table, "cell").filter("dist BETWEEN low AND high").select(
        "base", upto(F.col("splits")).alias("split"), F.pmod(F.xxhash64("id"), F.lit(chunks)).alias("chunk"), F.lit(1).alias("side"), "id", "cell", "dist", "v")
    homes = spark.createDataFrame([(c, b, splits[b]) for c, b in bases.items()], "cell long, base long, splits long")
    asking = asked.join(homes, "cell").select(
        "base", F.pmod(F.xxhash64("id"), F.col("splits")).alias("split"), upto(F.lit(chunks).cast("long")).alias("chunk"), F.lit(0).alias("side"), "id", "cell", F.lit(0.0).alias("dist"), "v")
    best = grouped(sent.union(asking), ["base", "split", "chunk"], lambda t: solve(t, rings_, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
