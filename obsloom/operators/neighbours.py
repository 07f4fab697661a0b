"""Nearest neighbours within a group, exact, without comparing all pairs.

The points of each group are cut into cells by repeated medians, each along the dimension in which the points of the
cut spread most; the cuts come from a sample of bounded size. Each point finds its k best in its own cell, which gives
its reach. Of the other cells of its group a point looks into those whose box its reach touches: first into the
nearest few, which shortens the reach, then into what is left. Copies of a point are carried once with their number,
and cells that many points look into are served by several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from obsloom.operators.ranges import HASHES
from obsloom.operators.sizes import measured

#: Points that a cell aims at, and points that one task serves of a cell.
CELL_ROWS, QUERY_ROWS = 2000, 4000
#: Cells of all groups together, at most, sampled points for each, and cells that a point looks into next.
CELLS, SAMPLE, NEXT = 1 << 14, 16, 6
#: Candidates beyond k that are measured exactly, and queries that are measured at once.
SPARE, CHUNK = 8, 512


def as_vector(features: Sequence[str]) -> Column:
    """The features as one array. Wide frames are planned much faster when they travel as one column."""
    return F.array(*[F.col(c).cast("double") for c in features])


@dataclass
class Cuts:
    """A perfect binary tree of cuts: node i goes on in 2i + 1 below its cut and in 2i + 2 above."""

    dims: np.ndarray
    values: np.ndarray

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(int(len(self.dims) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.dims[node]] > self.values[node])
        return node - len(self.dims)


def median_cuts(points: np.ndarray, levels: int) -> Cuts:
    """Cuts at the median of the widest dimension, ``levels`` times."""
    dims, values = np.zeros(2**levels - 1, dtype=np.int64), np.zeros(2**levels - 1)
    parts = {0: points}
    for node in range(2**levels - 1):
        here = parts.pop(node)
        if len(here):
            dims[node] = int((here.max(axis=0) - here.min(axis=0)).argmax())
            values[node] = np.median(here[:, dims[node]])
        above = here[:, dims[node]] > values[node]
        parts[2 * node + 1], parts[2 * node + 2] = here[~above], here[above]
    return Cuts(dims, values)


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _by_group(groups: list[str]) -> Iterator[tuple[str, np.ndarray]]:
    names, place = np.unique(np.array(groups, dtype=object).astype(str), return_inverse=True)
    for i, name in enumerate(names):
        yield str(name), np.flatnonzero(place == i)


def group_cuts(points: DataFrame, cell_rows: int) -> dict[str, Cuts]:
    """Cuts of the groups with more than ``cell_rows`` points, from a sample by hash of bounded size."""
    sizes = points.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
    large = {r["g"]: r["n"] for r in sizes.orderBy(F.desc("n"), "g").limit(CELLS).collect()}
    if not large:
        return {}
    whole = sum(large.values())
    # so many levels that cells have about cell_rows points, or as many as the group's share of all cells allows
    levels = {g: max(1, min(-(-n // cell_rows) - 1, max(1, CELLS * n // whole - 1)).bit_length()) for g, n in large.items()}
    shares = {g: min(HASHES, (2 ** levels[g]) * SAMPLE * HASHES // n) for g, n in large.items()}
    shared = points.sparkSession.sparkContext.broadcast(shares)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = np.array([shared.value.get(g, 0) for g in batch.column("g").to_pylist()])
            kept = batch.filter(pa.array(batch.column("at").to_numpy() < bounds))
            yield pa.RecordBatch.from_arrays([kept.column("g"), kept.column("x")], names=["g", "x"])

    hashed = points.select("g", "x", F.xxhash64("x").bitwiseAND(F.lit(HASHES - 1)).alias("at"))
    sample = hashed.mapInArrow(chosen, "g string, x array<double>").toArrow()
    vectors = _vectors(sample.column("x")) if sample.num_rows else np.zeros((0, 0))
    return {g: median_cuts(vectors[at], levels[g]) for g, at in _by_group(sample.column("g").to_pylist())}


def in_cells(points: DataFrame, cuts: dict[str, Cuts]) -> DataFrame:
    """``points`` with their ``cell`` in the group."""
    if not cuts:
        return points.withColumn("cell", F.lit(0).cast("long"))
    shared = points.sparkSession.sparkContext.broadcast(cuts)
    shape = points.withColumn("cell", F.lit(0).cast("long")).schema

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, dtype=np.int64)
            vectors = _vectors(batch.column("x")) if batch.num_rows else None
            for group, at in _by_group(batch.column("g").to_pylist()):
                if group in shared.value:
                    cell[at] = shared.value[group].cell(vectors[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return points.mapInArrow(placed, shape)


def boxes_of(placed: DataFrame, cuts: dict[str, Cuts], width: int) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each group that is cut: cell numbers, and the lowest and highest values of their points."""
    cut = placed.where(F.col("g").isin(list(cuts))) if len(cuts) <= 100 else placed.where(F.col("cell") >= 0)
    ends = [f(F.col("x")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(width)]
    table = cut.groupBy("g", "cell").agg(*ends).toArrow()
    cells = table.column("cell").to_numpy()
    low, high = (np.column_stack([table.column(f"{name}{i}").to_numpy() for i in range(width)]) for name in ("low", "high"))
    return {g: (cells[at], low[at], high[at]) for g, at in _by_group(table.column("g").to_pylist()) if g in cuts}


FOUND = "point long, reach double, found array<struct<d: double, x: array<double>, copies: long>>"


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def nearest(queries: pa.Table, block: pa.Table, k: int) -> Iterator[pa.Table]:
    """For each query point its k nearest points of the block, nearest first, ties by their values, and its reach: the
    distance within which there are k rows, copies counted."""
    points = _vectors(block.column("x"))
    order = np.lexsort(points.T[::-1])
    points, names, copies = points[order], block.column("point").to_numpy()[order], block.column("copies").to_numpy()[order]
    wanted, asked_names = _vectors(queries.column("x")), queries.column("point").to_numpy()
    centre = points.mean(axis=0)
    moved = points - centre
    norms = (moved**2).sum(axis=1)
    take = min(len(points), k + 1 + SPARE)
    for start in range(0, len(wanted), CHUNK):
        asked, own = wanted[start : start + CHUNK], asked_names[start : start + CHUNK]
        lengths = ((asked - centre) ** 2).sum(axis=1)
        # squared distances by products, good to within ``error``; the nearest are measured again
        rough = lengths[:, None] + norms[None, :] - 2 * (asked - centre) @ moved.T
        error = 1e-12 * (lengths + norms.max() + 1e-300)
        near = np.sort(np.argpartition(rough, take - 1, axis=1)[:, :take], axis=1)
        beyond = np.sqrt(np.maximum(np.partition(rough, take - 1, axis=1)[:, take - 1] - 2 * error, 0.0))
        apart = np.sqrt(((points[near] - asked[:, None, :]) ** 2).sum(axis=2))
        apart[names[near] == own[:, None]] = np.inf
        best = np.argsort(apart, axis=1, kind="stable")[:, :k]
        at, distance = np.take_along_axis(near, best, axis=1), np.take_along_axis(apart, best, axis=1)
        if take < len(points):
            for i in np.flatnonzero(~(distance[:, -1] < beyond)):  # so many ties that others may come first
                every = np.sqrt(((points - asked[i]) ** 2).sum(axis=1))
                every[names == own[i]] = np.inf
                at[i] = np.argsort(every, kind="stable")[: at.shape[1]]
                distance[i] = every[at[i]]
        real = np.isfinite(distance)
        held = np.cumsum(np.where(real, copies[at], 0), axis=1)
        enough = (held >= k) & real
        reach = np.where(enough.any(axis=1), distance[np.arange(len(at)), enough.argmax(axis=1)], np.inf)
        vectors = _lists(pa.array(points[at[real]].ravel()), np.full(int(real.sum()), points.shape[1]))
        entries = pa.StructArray.from_arrays([pa.array(distance[real]), vectors, pa.array(copies[at[real]])], names=["d", "x", "copies"])
        yield pa.table({"point": own, "reach": reach, "found": _lists(entries, real.sum(axis=1))})


def search(queries: DataFrame, known: DataFrame, k: int, query_rows: int) -> DataFrame:
    """The best of each query (g, cell, point, x) in its cell of ``known``; a cell's queries go to as many tasks as they need."""
    parts = measured(queries.groupBy("g", "cell").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("parts")))
    asked = queries.join(parts, ["g", "cell"]).withColumn("part", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int"))
    served = known.join(parts, ["g", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # fresh names on both sides: each is made from the same points
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in ("g", "cell", "part", "point", "x")])
    served = served.select(*[F.col(c).alias(f"b_{c}") for c in ("g", "cell", "part", "point", "copies", "x")])

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = (t.rename_columns([c[2:] for c in t.column_names]) for t in (left, right))
        pieces = list(nearest(left, right, k)) if left.num_rows and right.num_rows else []
        kind = pa.schema([("point", pa.int64()), ("reach", pa.float64()), ("found", pa.list_(ENTRY))])
        return pa.concat_tables(pieces).cast(kind) if pieces else kind.empty_table()

    left = asked.groupBy("q_g", "q_cell", "q_part")
    return left.cogroup(served.groupBy("b_g", "b_cell", "b_part")).applyInArrow(task, FOUND)


ENTRY = pa.struct([("d", pa.float64()), ("x", pa.list_(pa.float64())), ("copies", pa.int64())])


def touched(found: DataFrame, boxes: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]], first: int, last: int | None) -> DataFrame:
    """For each point (g, cell, point, x, reach) the cells of its group other than its own that its reach touches.

    Of the cells in order of distance those from ``first`` to before ``last``; ``cell`` is then the other cell.
    """
    shared = found.sparkSession.sparkContext.broadcast(boxes)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, own, reach = _vectors(batch.column("x")), batch.column("cell").to_numpy(), batch.column("reach").to_numpy()
            rows, others = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for group, at in _by_group(batch.column("g").to_pylist()):
                if group not in shared.value:
                    continue
                number, low, high = shared.value[group]
                step = max(1, (1 << 21) // (len(number) * vectors.shape[1]))
                for start in range(0, len(at), step):
                    part = at[start : start + step]
                    x = vectors[part][:, None, :]
                    gap = np.sqrt((np.maximum(np.maximum(low[None] - x, x - high[None]), 0.0) ** 2).sum(axis=2))
                    gap[number[None, :] == own[part][:, None]] = np.inf
                    order = np.argsort(gap, axis=1, kind="stable")[:, first:last]
                    # a hair more than the reach, for the rounding of distances
                    bound = reach[part] * (1 + 1e-9) + 1e-12
                    inside = np.take_along_axis(gap, order, axis=1) <= bound[:, None]
                    inside &= np.isfinite(np.take_along_axis(gap, order, axis=1))
                    row, place = np.nonzero(inside)
                    rows.append(part[row])
                    others.append(number[order[row, place]])
            row, other = pa.array(np.concatenate(rows)), pa.array(np.concatenate(others))
            yield pa.RecordBatch.from_arrays(
                [batch.column("g").take(row), other, batch.column("point").take(row), batch.column("x").take(row)],
                names=["g", "cell", "point", "x"],
            )

    return found.select("g", "cell", "point", "x", "reach").mapInArrow(cells, "g string, cell long, point long, x array<double>")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """(point, reach, found) with the best of all lists of each point."""
    merged = found.groupBy("point").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit(float("inf")).alias("reach"))

    def further(state: Column, entry: Column) -> Column:
        held = state["held"] + entry["copies"]
        return F.struct(held.alias("held"), F.when((state["held"] < k) & (held >= k), entry["d"]).otherwise(state["reach"]).alias("reach"))

    return merged.select("point", F.aggregate("found", start, further)["reach"].alias("reach"), "found")


def nearest_neighbours(
    df: DataFrame,
    group: str,
    features: Sequence[str] | str,
    k: int = 3,
    cell_rows: int = CELL_ROWS,
    query_rows: int = QUERY_ROWS,
    following: int = NEXT,
) -> DataFrame:
    """``group, x, copies, neighbours`` for each distinct point ``x``.

    ``features`` are the columns that make the array ``x``, or the name of an array column. Points with
    a NULL are left out. ``neighbours`` lists the points of the k nearest other rows of the group, nearest
    first; further copies of the point itself come first, at distance 0. Ties go by the values of the point.
    """
    vector = F.col(features) if isinstance(features, str) else as_vector(features)
    rows = df.select(F.col(group).cast("string").alias("g"), vector.alias("x"))
    rows = rows.where(F.col("g").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    points = rows.groupBy("g", "x").agg(F.count("*").alias("copies"))
    points = measured(points.withColumn("point", F.monotonically_increasing_id()))
    first = points.select(F.size("x").alias("width")).first()
    cuts = group_cuts(points, cell_rows)
    placed = measured(in_cells(points, cuts)) if cuts else in_cells(points, cuts)
    found = measured(search(placed, placed, k, query_rows))
    if cuts:
        boxes = boxes_of(placed, cuts, first["width"])
        where = placed.select("g", "cell", "point", "x")
        for start, stop in ((0, following), (following, None)):
            asked = measured(touched(where.join(found.select("point", "reach"), "point"), boxes, start, stop))
            if asked.isEmpty():
                continue
            more = search(asked, placed, k, query_rows)
            found = measured(best_of(found.unionByName(more), k))
    own = points.join(found.select("point", "found"), "point", "left")
    twins = F.array_repeat("x", F.least(F.col("copies") - 1, F.lit(k).cast("bigint")).cast("int"))
    none = F.array().cast("array<struct<d:double,x:array<double>,copies:bigint>>")
    others = F.flatten(
        F.transform(F.coalesce("found", none), lambda n: F.array_repeat(n["x"], F.least(n["copies"], F.lit(k).cast("bigint")).cast("int")))
    )
    return own.select(F.col("g").alias(group), "x", "copies", F.slice(F.concat(twins, others), 1, k).alias("neighbours"))
