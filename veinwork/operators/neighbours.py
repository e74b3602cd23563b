"""Exact nearest neighbours of every row.

Equal points are merged first: a point needs only its k+1 smallest ids, since no row can have
more neighbours there, so a vector shared by a large part of the table costs one point.

Two levels of cuts then put points that are near each other into one block of bounded size: the
first level makes the square root of the number of leaves, and each of its cells is cut again. Cuts
lie at medians of drawn points, across the dimension that varies most. A block is compared with
itself, which bounds how far the neighbours of its points can be, and by the triangle inequality
which other blocks it has to meet (the idea of the pivot-based kNN join of Lu, Shen, Chen and Ooi,
VLDB 2012).

A task then owns a group of blocks of one cell and meets the blocks that come to it, the nearest
first, while the k+1 best of each point are kept and tighten its bound. A block travels once to a
group, however many blocks of the group it has to meet. What leaves the task is one list
of k+1 for each point, however many blocks it has met. Blocks travel as packs of points of about a
kilobyte, of which the first alone has the block's center, so that a batch of rows is small whatever the
session's batch size. A task holds points in single precision where nothing is lost.

Balls of thousands of points rule out little in many dimensions, so the points of a block are cut further
into short runs, and boxes around these tell which runs a point has to be compared with.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from veinwork.operators.shape import col
from veinwork.session import discard, durable

LEAF_ROWS = 8192
# Points of the blocks that a task owns together, at most, unless one block has more.
GROUP_ROWS = 32_768
# Points that are assigned to the leaves of a cell together.
ASSIGN_ROWS = 16_384
PACK_BYTES = 1024
# Tasks that the groups are dealt to, at most.
TASKS = 20_000
_PIECE_CELLS = 1_000_000
_RUN = 64  # points of a run whose minimum bounds the least squares
_BOX_ROWS = 128  # points of a run whose box is compared with others, at most
_AT_ONCE = 16_384  # pairs that are held before they are merged
# Drawn points for each leaf, from which the cuts are learned.
DRAWN = 32
_COMPACT = 64  # blocks met between two clearings of the ids that are kept


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def rough_squares(q: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and a bound on their error per query row."""
    middle = r.mean(axis=0)
    q, r = q - middle, r - middle
    qq, rr = (q * q).sum(axis=1), (r * r).sum(axis=1)
    squares = np.maximum(qq[:, None] + rr[None, :] - 2.0 * (q @ r.T), 0.0)
    slack = 16.0 * np.finfo(float).eps * (q.shape[1] + 4) * (qq + rr.max())
    return squares, slack


def _points(column: pa.ListArray) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The points in single precision where nothing is lost."""
    with np.errstate(over="ignore", invalid="ignore"):
        single = x.astype(np.float32)
    return single if (single == x).all() else x


def _gaps(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Distances of points from one in double precision."""
    step = x - center
    step *= step
    return np.sqrt(step.sum(axis=1))


def _sortable(values: pa.Array) -> np.ndarray:
    """Ids as an array that sorts: numbers, or texts of fixed width."""
    return values.to_numpy() if pa.types.is_integer(values.type) else np.array(values.to_pylist())


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    step = max(1, _PIECE_CELLS // max(pivots.shape))
    parts = [rough_squares(x[i:i + step], pivots)[0].argmin(axis=1) for i in range(0, len(x), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class Cuts:
    """A tree of cuts learned from drawn points; each leaf has `size` of them at most, unless they are equal."""

    def __init__(self, drawn: np.ndarray, size: int):
        self.across, self.value, self.below = [], [], []  # `below` has the two nodes under a node, or its leaf
        self.leaves = 0
        waiting = [(self._node(), np.arange(len(drawn)))]
        while waiting:
            node, at = waiting.pop()
            points = drawn[at]
            with np.errstate(over="ignore", invalid="ignore"):
                across = int(np.argmax(np.nan_to_num(points.var(axis=0), nan=np.inf))) if len(at) > size else 0
            values = points[:, across]
            least, greatest = values.min(initial=np.inf), values.max(initial=-np.inf)
            if len(at) <= size or least == greatest:
                self.below[node] = (self.leaves, -1)
                self.leaves += 1
                continue
            # A value that many points share is not cut.
            middle = np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2]
            if middle == greatest:
                middle = values[values < greatest].max()
            left = values <= middle
            self.across[node], self.value[node] = across, middle
            self.below[node] = (self._node(), self._node())
            waiting += [(self.below[node][1], at[~left]), (self.below[node][0], at[left])]

    def _node(self) -> int:
        self.across.append(-1)
        self.value.append(0.0)
        self.below.append((-1, -1))
        return len(self.across) - 1

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each point; near leaves have near numbers."""
        found = np.zeros(len(x), np.int64)
        waiting = [(0, np.arange(len(x)))]
        while waiting:
            node, at = waiting.pop()
            if self.across[node] < 0:
                found[at] = self.below[node][0]
                continue
            left = x[at, self.across[node]] <= self.value[node]
            waiting += [(below, some) for below, some in zip(self.below[node], (at[left], at[~left]), strict=True) if len(some)]
        return found


def _run_starts(run: np.ndarray | None, rows: int) -> np.ndarray:
    """Where runs start, from the number of the run of each point; long ones are cut."""
    if run is None:
        return np.arange(0, rows, _BOX_ROWS)
    starts = np.r_[0, np.flatnonzero(np.diff(run)) + 1]
    length = np.diff(np.r_[starts, len(run)])
    if length.max() <= _BOX_ROWS:
        return starts
    return np.concatenate([np.arange(start, start + n, _BOX_ROWS) for start, n in zip(starts, length, strict=True)])


def _boxes(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest of each dimension in runs of points."""
    return np.minimum.reduceat(x, starts, axis=0), np.maximum.reduceat(x, starts, axis=0)


def _box_squares(low: np.ndarray, high: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """Squared distances of boxes from boxes; a point is a box."""
    total = np.zeros((len(low), len(least)))
    for j in range(low.shape[1]):
        step = np.maximum(least[:, j] - high[:, j, None], low[:, j, None] - greatest[:, j])
        np.maximum(step, 0.0, out=step)
        step *= step
        total += step
    return total


def _bordered(x: np.ndarray, first: np.ndarray, second: np.ndarray, kind: type) -> np.ndarray:
    """The points with two more columns, in the wanted precision."""
    out = np.empty((len(x), x.shape[1] + 2), kind)
    out[:, :-2], out[:, -2], out[:, -1] = x, first, second
    return out


class Search:
    """The nearest points of a set of query points, among all points that it has met."""

    def __init__(self, x: np.ndarray, width: int, run: np.ndarray | None = None):
        self.x, self.width = _narrow(x), width
        self.run = np.zeros(len(x), np.int64) if run is None else run
        self.middle = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        near = x - self.middle
        self.squares = (near * near).sum(axis=1)
        with np.errstate(over="ignore"):
            self.left = _bordered(near, self.squares, np.ones(len(x)), np.float32)
        self.distance = np.full((len(x), width), np.inf)
        self.key = np.zeros((len(x), width), np.int64)
        self.place = np.full((len(x), width), -1, np.int64)  # in `kept`
        self.kept: list[pa.Array] = []
        self.size = 0

    @property
    def bound(self) -> np.ndarray:
        """How far the last wanted neighbour of each query point can be."""
        return self.distance[:, -1]

    def visit(self, part: tuple) -> None:
        """Meet packs of another block, if its ball is within the bounds of this one."""
        gap = np.sqrt(((part[3] - self.center) ** 2).sum()) - part[4] - self.radius
        if len(self.x) and gap <= self.bound.max():
            self.meet(*part[:6])

    def meet(
        self, x: np.ndarray, ids: pa.ListArray, keys: np.ndarray, center: np.ndarray, radius: float, run: np.ndarray | None = None,
    ) -> None:
        """Compare with the points `x` of a ball, which stand for the rows `ids`; `keys` break ties, and
        points of the same `run` lie together."""
        if not len(self.x) or not len(x):
            return
        gap = _gaps(self.x, center) - radius
        alive = np.flatnonzero(gap <= self.bound)
        known = np.isfinite(self.bound[alive])
        if not known.all():
            self._compare([(alive[~known], 0, len(x))], x, ids, keys)
        if known.any():
            self._compare(self._near_runs(alive[known], x, _run_starts(run, len(x))), x, ids, keys)
        if len(self.kept) > _COMPACT:
            self._compact()

    def _near_runs(self, alive: np.ndarray, x: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
        """(queries, start, end) of the runs whose boxes the bounds of some queries reach, the nearest runs
        first. Bounds may get tighter in between."""
        own = _run_starts(self.run[alive], len(alive))
        ends, length = np.r_[starts[1:], len(x)], np.diff(np.r_[own, len(alive)])
        least, greatest = _boxes(x, starts)
        # Points as they are held in single precision, and boxes a little wider than the rounding.
        held = self.left[alive, :-2]
        least, greatest = least - self.middle, greatest - self.middle
        wide = 4.0 * np.finfo(np.float32).eps * max(np.abs(held).max(), np.abs(least).max(), np.abs(greatest).max())
        with np.errstate(over="ignore"):
            least, greatest = (least - wide).astype(np.float32), (greatest + wide).astype(np.float32)
            between = _box_squares(*_boxes(held, own), least, greatest)
            reach = lambda bound: (bound * (1.0 + 1e-5)) ** 2
            near = between <= reach(np.maximum.reduceat(self.bound[alive], own))[:, None]
        if not np.isfinite(between).all() or length @ near @ (ends - starts) > 0.5 * len(alive) * len(x):
            yield alive, 0, len(x)  # boxes that rule out little cost more than they save
            return
        order = np.argsort(between.min(axis=0), kind="stable")
        for i in order[near.any(axis=0)[order]]:
            at = np.flatnonzero(np.repeat(near[:, i], length))
            points = held[at]
            gap = np.maximum(least[i] - points, points - greatest[i])
            np.maximum(gap, 0.0, out=gap)
            yield alive[at[np.einsum("ij,ij->i", gap, gap) <= reach(self.bound[alive[at]])]], starts[i], ends[i]

    def _compare(self, runs: Iterable[tuple[np.ndarray, int, int]], x: np.ndarray, ids: pa.ListArray, keys: np.ndarray) -> None:
        """Compare the queries of each run with its points."""
        held, pairs = 0, []
        for alive, first, end in runs:
            if not len(alive):
                continue
            r = x[first:end] - self.middle
            rr = (r * r).sum(axis=1)
            most = rr.max()
            kind = np.float32 if self.squares.max() + most < 1e30 else np.float64
            r *= -2.0
            right = _bordered(r, np.ones(len(r)), rr, kind).T
            del r
            step = max(1, _PIECE_CELLS // (end - first))
            for start in range(0, len(alive), step):
                at = alive[start:start + step]
                rows, cols = self._shortlist(at, right, most, kind)
                found = self._measured(at, rows, cols + first, x)
                pairs.append(found)
                held += len(found[0])
                if held > _AT_ONCE:
                    self._merge(*map(np.concatenate, zip(*pairs, strict=True)), ids, keys)
                    held, pairs = 0, []
        if held:
            self._merge(*map(np.concatenate, zip(*pairs, strict=True)), ids, keys)

    def _measured(self, at: np.ndarray, rows: np.ndarray, cols: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, distance) of the pairs within the bounds. What the matrix product cannot tell
        apart is measured directly, dimension by dimension."""
        squares = self.x[at[rows]] - x[cols]
        squares *= squares
        total = np.zeros(len(rows))
        for j in range(x.shape[1]):
            total += squares[:, j]
        distance = np.sqrt(total)
        good = distance <= self.bound[at[rows]]
        return at[rows[good]], cols[good], distance[good]

    def _shortlist(self, at: np.ndarray, right: np.ndarray, most: float, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query of `at`, point) that can be within the bounds, by a single-precision product."""
        left = self.left[at] if kind is np.float32 else np.column_stack([self.x[at] - self.middle, self.squares[at], np.ones(len(at))])
        squares = left @ right
        slack = 32.0 * np.finfo(kind).eps * (right.shape[0] + 2) * (self.squares[at] + most)
        limit = self.bound[at] ** 2
        if not np.isfinite(limit).all():
            last = min(self.width, right.shape[1]) - 1
            # The minima of runs of points bound the wanted value from above, and are few.
            runs = squares.shape[1] // _RUN
            few = squares if runs <= 2 * self.width else squares[:, :runs * _RUN].reshape(len(at), _RUN, runs).min(axis=1)
            own = np.partition(few, last, axis=1)[:, last].astype(np.float64) + slack
            limit = np.minimum(limit, own if last + 1 == self.width else np.inf)
        found = np.flatnonzero(squares <= np.nextafter((limit + slack).astype(kind), kind(np.inf))[:, None])
        return np.divmod(found, right.shape[1])

    def _merge(self, at: np.ndarray, cols: np.ndarray, distance: np.ndarray, ids: pa.ListArray, keys: np.ndarray) -> None:
        used, place = np.unique(cols, return_inverse=True)
        hit = np.unique(at)
        rows = np.concatenate([np.repeat(hit, self.width), at])
        distance = np.concatenate([self.distance[hit].ravel(), distance])
        key = np.concatenate([self.key[hit].astype(keys.dtype if self.size == 0 else self.key.dtype).ravel(), keys[cols]])
        place = np.concatenate([self.place[hit].ravel(), place + self.size])
        order = np.lexsort((key, distance, rows))
        rows = rows[order]
        order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < self.width]
        if self.key.dtype != key.dtype:  # texts may be wider than before
            self.key = self.key.astype(key.dtype)
        self.distance[hit] = distance[order].reshape(len(hit), self.width)
        self.key[hit] = key[order].reshape(len(hit), self.width)
        self.place[hit] = place[order].reshape(len(hit), self.width)
        self.kept.append(ids.take(pa.array(used)))
        self.size += len(used)

    def _compact(self) -> None:
        known = self.place >= 0
        live, place = np.unique(self.place[known], return_inverse=True)
        self.kept = [pa.concat_arrays(self.kept).take(pa.array(live))]
        self.place[known] = place
        self.size = len(live)

    def result(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(query, distance, id) of the `width` nearest rows of each query point, in that order."""
        rows, columns = np.nonzero(self.place >= 0)
        lists = pa.concat_arrays(self.kept).take(pa.array(self.place[rows, columns])) if len(rows) else None
        if lists is None:
            return np.zeros(0, np.int64), np.zeros(0), pa.array([])
        length = lists.value_lengths().to_numpy()
        ids = lists.flatten()
        distance = np.repeat(self.distance[rows, columns], length)
        rows = np.repeat(rows, length)
        order = np.lexsort((_sortable(ids), distance, rows))
        rows = rows[order]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < self.width
        return rows[keep], distance[order][keep], ids.take(pa.array(order[keep]))


def _tree(points: DataFrame, total: int, leaf_rows: int) -> DataFrame:
    """The points with the `block` they belong to and its `cell`; a stored table."""
    leaves = ceil(total / leaf_rows)
    if leaves == 1:
        return points.withColumns({"cell": F.lit(0), "block": F.lit(0).cast("long")})
    # For as many cells as the square root of the leaves.
    chosen = points.orderBy(F.md5(F.col("p").cast("string")), "p").limit(DRAWN * (isqrt(leaves - 1) + 1)).select("x").collect()
    cuts = Cuts(np.array([r["x"] for r in chosen]), DRAWN)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cuts.leaf(_points(batch.column("x")))
            yield batch.append_column("cell", pa.array(cell, pa.int32()))

    placed = durable(points.mapInArrow(assign, f"{kinds}, cell int"))
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"))
    wanted = durable(cells.select("cell", F.ceil(F.col("n") / leaf_rows).alias("leaves"), "n",
                                  F.ceil(F.col("n") / ASSIGN_ROWS).cast("int").alias("parts")))
    # Drawn by the hash of the point.
    draw = F.pmod(F.xxhash64(F.lit("drawn"), "p"), F.lit(1 << 30)) * F.col("n") < F.col("leaves") * (DRAWN << 30)
    drawn = placed.join(wanted, "cell").filter(draw & (F.col("leaves") > 1)).select(
        F.col("cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("x").alias("drawn"))
    dealt = placed.join(wanted, "cell").select(*placed.columns, _spread("part", "p", F.col("parts")).alias("part"))

    def cut(points: pa.Table, drawn: pa.Table) -> pa.Table:
        x, leaf = _points(points["x"].combine_chunks()), np.zeros(points.num_rows, np.int64)
        if drawn.num_rows and points.num_rows:
            # The same in every part; leaves somewhat too small, so that few are dealt out in parts.
            leaf = Cuts(_points(drawn["drawn"].combine_chunks()), 3 * DRAWN // 4).leaf(x)
        return points.drop_columns(["part"]).append_column("leaf", pa.array(leaf, pa.int64()))

    pairs = dealt.groupBy("cell", "part").cogroup(drawn.groupBy("cell", "part"))
    leafed = durable(pairs.applyInArrow(cut, f"{kinds}, cell int, leaf long"))
    sizes = durable(leafed.groupBy("cell", "leaf").agg(F.ceil(F.count("*") / leaf_rows).cast("int").alias("parts")))
    block = F.col("cell").cast("long") * (1 << 42) + F.col("leaf") * (1 << 21) + _spread("block", "p", F.col("parts"))
    found = durable(leafed.join(sizes, ["cell", "leaf"]).select(*points.columns, "cell", block.alias("block")))
    discard(placed, wanted, leafed, sizes)
    return found


def _spread(name: str, key: str, parts: Column) -> Column:
    """Deal rows to `parts` groups by a hash of their key."""
    return F.pmod(F.xxhash64(F.lit(name), F.col(key)), parts).cast("int")


def _packer(width: int, id_type: pa.DataType):
    """One block: its packs of points, and with each of them the block's ball and bound."""
    lists = pa.list_(pa.list_(id_type))

    def pack(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        x = _points(block["x"].chunk(0))
        run = Cuts(x, _BOX_ROWS).leaf(x)
        order = np.argsort(run, kind="stable")
        block, run = block.take(pa.array(order)).combine_chunks(), run[order]
        x, ids = _points(block["x"].chunk(0)), block["ids"].chunk(0)
        full = block["full"].to_numpy()
        center = x.mean(axis=0)
        radius = float(np.sqrt(((x - center) ** 2).sum(axis=1)).max())
        radius += 1e-12 * x.shape[1] * (1.0 + float(np.abs(x).max()))  # what rounding may amount to
        own = Search(x[~full], width)
        own.meet(x, ids, _sortable(block["p"].chunk(0)), center, radius)
        step = max(1, PACK_BYTES // (8 * x.shape[1]))
        first = np.r_[0, np.flatnonzero(np.diff(run)) + 1, len(x)].tolist()
        starts = [i for a, b in zip(first, first[1:]) for i in range(a, b, step)]  # a pack is of one run
        ends = [*starts[1:], len(x)]
        n = len(starts)
        sent = _narrow(x)
        return pa.table({
            "block": pa.array([block["block"][0].as_py()] * n, pa.int64()), "cell": pa.array([block["cell"][0].as_py()] * n, pa.int32()),
            "seekers": pa.array([int((~full).sum())] * n, pa.int64()), "center": pa.array([center, *[None] * (n - 1)], pa.list_(pa.float64())),
            "radius": pa.array([radius] * n), "bound": pa.array([float(own.bound.max(initial=0.0))] * n),
            "x": pa.array([sent[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            "full": pa.array([full[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            "ids": pa.array([ids[a:b].to_pylist() for a, b in zip(starts, ends)], lists), "first": pa.array([i == 0 for i in starts]), "pack": pa.array(range(n), pa.int32()), "run": pa.array(run[starts], pa.int32()),
        })

    return pack


def _reachable(cells: np.ndarray, centers: np.ndarray, reach: np.ndarray):
    """For each block the cells whose balls its bound cannot rule out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _points(batch.column("center"))
            radius, bound = batch.column("radius").to_numpy(), batch.column("bound").to_numpy()
            gap = np.stack([np.sqrt(((x - c) ** 2).sum(axis=1)) for c in centers], axis=1) - reach
            rows, found = np.nonzero(gap - radius[:, None] <= bound[:, None])
            out = batch.select(["a", "block", "center", "radius", "bound"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(cells[found], pa.int32())], names=["a", "own", "ca", "ra", "bound", "cell"])

    return run


def _visits(packs: DataFrame, group_rows: int) -> DataFrame:
    """(a, block, gap): the blocks that group `a` has to meet, and how far they are from the nearest of
    its own, which have no gap but minus infinity; a stored table."""
    before = F.sum("seekers").over(W.partitionBy("cell").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    group = F.col("cell").cast("long") * (1 << 32) + F.floor(F.coalesce(before, F.lit(0)) / group_rows)
    blocks = durable(packs.filter("first").select(
        "block", "cell", "seekers", "center", "radius", "bound", group.alias("a")))

    def ball(cell: pa.Table) -> pa.Table:
        x = _points(cell["center"].combine_chunks())
        middle = x.mean(axis=0)
        reach = np.sqrt(((x - middle) ** 2).sum(axis=1)) + cell["radius"].to_numpy()
        return pa.table({"cell": cell["cell"][:1], "middle": pa.array([middle], pa.list_(pa.float64())), "reach": [float(reach.max())]})

    # As many rows as first-level pivots.
    balls = blocks.groupBy("cell").applyInArrow(ball, "cell int, middle array<double>, reach double").collect()
    reachable = _reachable(np.array([r["cell"] for r in balls]), np.array([r["middle"] for r in balls]), np.array([r["reach"] for r in balls]))
    opened = blocks.filter("seekers > 0").mapInArrow(
        reachable, "a long, own long, ca array<double>, ra double, bound double, cell int")
    squares = F.aggregate(F.zip_with("ca", "center", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    gap = F.when(F.col("own") == F.col("block"), F.lit(float("-inf"))).otherwise(F.sqrt(squares) - F.col("ra") - F.col("radius"))
    other = blocks.select("block", "cell", "center", "radius")
    found = durable(opened.join(other, "cell").withColumn("gap", gap).filter("gap <= bound").groupBy("a", "block").agg(
        F.min("gap").alias("gap")))
    discard(blocks)
    return found


def _searcher(width: int, id_type: pa.DataType):
    """Rows of packs, sorted by the group `a` that meets them and then by distance, its own first, and
    within a block the pack that has the center, which comes first."""
    near = pa.list_(pa.struct([("d", pa.float64()), ("neighbor", id_type)]))

    def finish(own: dict[int, list], searches: list[Search]) -> Iterator[pa.RecordBatch]:
        for search in searches or _begin(own, width):
            if not len(search.x):
                continue
            rows, distance, ids = search.result()
            ends = np.searchsorted(rows, np.arange(len(search.x) + 1)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(distance), ids], fields=list(near.value_type))
            lists = pa.ListArray.from_arrays(pa.array(ends), pairs)
            yield pa.RecordBatch.from_arrays([pa.array(search.names, id_type), lists.cast(near)], names=["p", "near"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own, searches, center = None, {}, [], None
        for batch in batches:
            names, blocks = batch.column("a").to_numpy(), batch.column("block").to_numpy()
            mine = batch.column("gap").to_numpy() == -np.inf
            cuts = np.flatnonzero((np.diff(names) != 0) | (np.diff(blocks) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)], strict=True):
                if start == end:
                    continue
                if names[start] != current:
                    yield from finish(own, searches)
                    current, own, searches = names[start], {}, []
                packs = batch.slice(start, end - start)
                if packs.column("center")[0].is_valid:  # else the block began in the batch before
                    center = np.array(packs.column("center")[0].as_py())
                if mine[start]:
                    own.setdefault(blocks[start], []).append((packs, center))
                    continue
                if not searches:
                    searches, own = _begin(own, width), {}
                part = _unpack(packs, center)
                for search in searches:
                    search.visit(part)
        yield from finish(own, searches)

    return run


def _unpack(rows: pa.RecordBatch, center: np.ndarray | None = None) -> tuple:
    """(points, ids, keys, center, radius, runs, which points are crowded, smallest ids) of packs of one block, whose center
    the first of them has unless it is given."""
    if center is None:
        center = np.array(rows.column("center")[0].as_py())
    ids = rows.column("ids").flatten()
    sent = b"".join(rows.column("x").to_pylist())
    kind = np.float32 if len(sent) == 4 * len(center) * len(ids) else np.float64
    x = np.frombuffer(sent, kind).reshape(-1, len(center)).astype(np.float64)
    firsts = ids.flatten().take(pa.array(ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()))
    full = np.frombuffer(b"".join(rows.column("full").to_pylist()), dtype=bool)
    run = np.repeat(rows.column("run").to_numpy(), rows.column("ids").value_lengths().to_numpy())
    return x, ids, _sortable(firsts), center, rows.column("radius")[0].as_py(), run, full, firsts


def _begin(own: dict[int, list], width: int) -> list[Search]:
    """For each block of a group, as packs and their center, a search for its points that are not crowded,
    which has met the block itself, and then the others of the group. One block at a time is unpacked."""
    searches = []
    for packs in own.values():
        parts = [_unpack(*some) for some in packs]
        seek = ~np.concatenate([part[6] for part in parts])
        search = Search(np.concatenate([part[0] for part in parts])[seek], width, np.concatenate([part[5] for part in parts])[seek])
        search.names = pa.concat_arrays([part[7] for part in parts]).filter(pa.array(seek)).to_pylist()
        search.center, search.radius = parts[0][3:5]
        for part in parts:
            search.meet(*part[:6])
        searches.append(search)
    for search, block in zip(searches, own, strict=True):
        others = [(((packs[0][1] - search.center) ** 2).sum(), name) for name, packs in own.items() if name != block]
        for _, name in sorted(others):
            for some in own[name]:
                search.visit(_unpack(*some))
    return searches


def merged_points(df: DataFrame, id: str, features: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows as (id, x), and the distinct points (p, x, ids, full) as a stored table: `p` is the
    smallest of the k+1 `ids` that are kept, `full` tells that a point has more rows than k+1."""
    rows = df.select(
        col(id).alias("id"),
        F.transform(col(features), lambda v: v.cast("double") + F.lit(0.0)).alias("x"),
    )
    copies = W.partitionBy("x").orderBy("id")
    points = durable(
        rows.withColumn("_r", F.row_number().over(copies)).filter(F.col("_r") <= k + 2)
        .groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(
            F.col("ids")[0].alias("p"), "x", F.slice("ids", 1, k + 1).alias("ids"),
            (F.size("ids") > k + 1).alias("full"),
        )
    )
    return rows, points


def edges_of(rows: DataFrame, points: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """`(id, neighbor, rank, distance)` of all rows from the lists (p, near) of the points that
    are not full; a stored table."""
    members = points.filter("not full").select("p", F.explode("ids").alias("id"))
    found = members.join(lists, "p").select("id", "near")
    # Rows of a crowded point have k copies of it at distance 0.
    zero = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("d"), i.alias("neighbor")))
    crowded = points.filter("full").select("x", zero.alias("near"))
    if not crowded.isEmpty():
        found = found.unionByName(rows.join(crowded, "x").select("id", "near"))
    others = F.slice(F.filter("near", lambda e: e["neighbor"] != F.col("id")), 1, k)
    return durable(found.select("id", F.posexplode(others).alias("_pos", "_e")).select(
        "id", F.col("_e.neighbor").alias("neighbor"),
        (F.col("_pos") + 1).alias("rank"), F.col("_e.d").alias("distance"),
    ))


def id_types(df: DataFrame, id: str) -> tuple[str, pa.DataType]:
    kind = df.schema[id].dataType
    return kind.simpleString(), to_arrow_type(kind)


def no_edges(df: DataFrame, id_type: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], f"id {id_type}, neighbor {id_type}, rank int, distance double")


def nearest_neighbours(df: DataFrame, id: str, features: str, k: int = 20, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """`(id, neighbor, rank, distance)`: the k nearest other rows by Euclidean distance, ties
    to the smaller id. `features` is an array of numbers without nulls; ids are unique.

    The result is written to the shared folder, as scores read it several times.
    """
    id_type, arrow_id = id_types(df, id)
    rows, points = merged_points(df, id, features, k)
    total = points.count()
    if not total:
        return no_edges(df, id_type)
    placed = _tree(points, total, leaf_rows)
    packs = durable(placed.groupBy("block").applyInArrow(
        _packer(k + 1, arrow_id),
        "block long, cell int, seekers long, center array<double>, radius double, bound double, x binary, full binary, "
        f"ids array<array<{id_type}>>, first boolean, pack int, run int",
    ))
    parallel = df.sparkSession.sparkContext.defaultParallelism
    visits = _visits(packs, max(leaf_rows, min(GROUP_ROWS, total // (4 * parallel))))
    met = visits.join(packs.select("block", "center", "radius", "x", "full", "ids", "pack", "run"), "block").select(
        "a", "block", "gap", "center", "radius", "x", "full", "ids", "pack", "run")
    tasks = min(TASKS, max(parallel, visits.select("a").distinct().count()))
    lists = durable(met.repartition(tasks, "a").sortWithinPartitions("a", "gap", "block", "pack").mapInArrow(
        _searcher(k + 1, arrow_id), f"p {id_type}, near array<struct<d:double,neighbor:{id_type}>>"))
    discard(packs, visits)
    edges = edges_of(rows, points, lists, k)
    discard(points, lists)
    return edges
