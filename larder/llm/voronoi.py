"""Exact top-k search by inner product: a Voronoi kNN join.

Of candidates x and a query q, those of greatest q.x are those nearest to q
once every candidate has one more component, sqrt(M^2 - |x|^2) with M the
greatest length of a candidate, and every query has zero there:
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x. So the search is a nearest-neighbour join.

Pivots are drawn from a bounded sample; queries and candidates go to the cell of
their nearest pivot. Summaries of the cells (how many, how far from the pivot,
the least distances of candidates) bound the distance within which each cell's
queries have their k neighbours; a candidate can be one only if its distance to
its own pivot is at least the distance of the two pivots less that bound and the
radius of the query cell. Cells of queries are put together to groups of bounded
size, and a group gets only the candidates that one of its cells may need,
spread over slices. A task holds a group's queries and streams a slice past
them, with the same test under the bounds found so far. The answers of slices
are ranked by Spark.

All scores are whole numbers and exact: products run in float32 where no sum
can exceed 2^24, in float64 up to 2^53, in Python integers beyond. The pivots
decide only how much work is saved: where nothing can be ruled out, each query
meets each candidate, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larder.llm.common import dropped, stored
from larder.llm.vectors import whole_vectors

TOP = 20
# rows that pivots are drawn from, and the most pivots
SAMPLE, PIVOTS = 4096, 256
# candidates a cell is meant to have
CELL_ROWS = 256
# bytes of a group's queries as 64-bit numbers
GROUP_BYTES = 16 << 20
# slices of n candidates: the square root of n / SLICE_UNIT
SLICE_UNIT = 1024
# products held at once
_BLOCK = 1 << 22
_LONG = 1 << 63


@dataclass(frozen=True)
class Space:
    """What every task knows: the width of vectors, the greatest squared length of candidates, and the pivots."""

    width: int
    most: int
    pivots: np.ndarray

    @property
    def kind(self):
        """The number type in which inner products are exact."""
        return np.float32 if self.most < 1 << 24 else np.float64 if self.most < 1 << 53 else object

    @property
    def slack(self) -> float:
        """More than the rounding errors of a distance."""
        return 1e-6 * (1 + float(self.most) ** 0.5)

    def matrix(self, vectors) -> np.ndarray:
        """Equal widths, missing components zero; exact."""
        kind = np.int64 if self.kind is object else np.float64
        out = np.zeros((len(vectors), self.width), kind)
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
        if len(values) == out.size:
            return values.reshape(out.shape).astype(kind)
        for row, (start, end) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
            out[row, : end - start] = values[start:end]
        return out

    def lengths(self, x: np.ndarray) -> np.ndarray:
        """Squared lengths, as float64."""
        x = x.astype(np.float64)
        return np.einsum("ij,ij->i", x, x)

    def distances(self, x: np.ndarray, candidates: bool) -> np.ndarray:
        """Of every row to every pivot, in the space with one more component."""
        squared = self.lengths(x)
        last = np.sqrt(np.maximum(float(self.most) - squared, 0)) if candidates else np.zeros(len(x))
        whole = np.column_stack([x.astype(np.float64), last])
        own = squared + last * last
        p = self.pivots
        return np.sqrt(np.maximum(own[:, None] + (p * p).sum(axis=1)[None, :] - 2 * whole @ p.T, 0))


def _stats(rows: DataFrame) -> tuple[int, int, int]:
    """Rows, width and greatest squared length, the last rounded up to what surely holds."""
    squared = F.expr("aggregate(x, 0D, (a, c) -> a + double(c) * double(c))")
    found = rows.agg(F.count("*"), F.max(F.size("x")), F.max(squared)).first()
    return found[0], found[1] or 0, int((found[2] or 0.0) * (1 + 1e-9)) + 1


def _pivots(rows: DataFrame, n: int, width: int, most: int) -> np.ndarray:
    """Pivots among a sample of about ``SAMPLE`` rows, far from each other."""
    share = min(SAMPLE / n, 1.0)
    drawn = rows.where(F.pmod(F.xxhash64("row", "x"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = drawn.orderBy("row").select("x").toArrow()["x"].combine_chunks()
    if not len(sample):
        sample = rows.select("x").limit(1).toArrow()["x"].combine_chunks()
    plain = Space(width, most, np.zeros((1, width + 1)))
    x = plain.matrix(sample).astype(np.float64)
    x = np.unique(np.column_stack([x, np.sqrt(np.maximum(float(most) - plain.lengths(x), 0))]), axis=0)
    wanted = min(max(-(-n // CELL_ROWS), 1), PIVOTS, len(x))
    chance = np.random.default_rng(42)
    chosen = [int(chance.integers(len(x)))]
    apart = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < wanted and apart.any():
        chosen.append(int(chance.choice(len(x), p=apart / apart.sum())))
        apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _in_cells(space: Space, candidates: bool):
    """Rows with the cell they lie in and how far from its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = space.distances(space.matrix(batch["x"]), candidates)
            cell = apart.argmin(axis=1) if len(batch) else np.zeros(0, int)
            columns = {name: batch[name] for name in ("row", "vec_id", "x")}
            columns["cell"] = pa.array(cell, pa.int32())
            columns["far"] = pa.array(apart[np.arange(len(batch)), cell], pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


_CELL_SCHEMA = "row bigint, vec_id bigint, x array<bigint>, cell int, far double"


@dataclass(frozen=True)
class Bounds:
    """Per cell of queries: its group's number, how many parts the group is cut into, and what candidates it may need."""

    group: np.ndarray
    parts: dict[int, int]
    slices: dict[int, int]
    # [query cell, candidate cell]: the least distance of a candidate from its pivot that may matter
    least: np.ndarray
    # [query cell, candidate cell]: distances between pivots
    between: np.ndarray
    radius: np.ndarray


def _bounds(space: Space, queries: DataFrame, cells: DataFrame, top: int) -> Bounds:
    """From summaries of the cells, a bounded number of rows."""
    n = len(space.pivots)
    of_queries = queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).toPandas()
    asked, radius = np.zeros(n, np.int64), np.zeros(n)
    asked[of_queries["cell"]], radius[of_queries["cell"]] = of_queries["n"], of_queries["far"]
    of_cells = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).toPandas()
    held, reach = np.zeros(n, np.int64), np.full(n, -1.0)
    held[of_cells["cell"]], reach[of_cells["cell"]] = of_cells["n"], of_cells["far"]
    # the least distances in each cell; one more than the answers, as one may be the query itself
    order = F.row_number().over(Window.partitionBy("cell").orderBy("far"))
    near = cells.select("cell", "far").withColumn("k", order).where(F.col("k") <= top + 1).toPandas()
    p = space.pivots
    # a query lies in the space's floor, a pivot may not; distances go through the pivots' own places
    between = np.sqrt(np.maximum(((p[:, None, :] - p[None, :, :]) ** 2).sum(axis=2), 0))
    least = np.full((n, n), np.inf)
    for i in np.flatnonzero(asked):
        upper = np.sort(radius[i] + between[i, near["cell"]] + near["far"].to_numpy())
        theta = upper[top] if len(upper) > top else np.inf
        least[i] = between[i] - radius[i] - theta - space.slack
        least[i, reach < least[i]] = np.inf
    # groups: neighbouring cells together, up to the size bound
    size = max(GROUP_BYTES // (8 * max(space.width, 1)), 1)
    todo, group, parts, needs = set(np.flatnonzero(asked).tolist()), np.full(n, -1), {}, {}
    while todo:
        number, first = len(parts), min(todo)
        members, total = [], 0
        for i in np.argsort(between[first], kind="stable").tolist():
            if i in todo and (not members or total + asked[i] <= size):
                members.append(i)
                total += int(asked[i])
        todo -= set(members)
        group[members] = number
        parts[number] = -(-total // size)
        needs[number] = int(held[np.isfinite(least[members].min(axis=0))].sum())
    slices = {g: max(int(np.ceil((rows / SLICE_UNIT) ** 0.5)), 1) for g, rows in needs.items()}
    return Bounds(group, parts, slices, least, between, radius)


def _dealt(queries: DataFrame, cells: DataFrame, bounds: Bounds) -> DataFrame:
    """Queries and candidates with the (group, part, slice) that needs them; queries copied to each slice."""
    spark = queries.sparkSession
    cell_rows = [
        (int(i), int(g), bounds.parts[int(g)], bounds.slices[int(g)]) for i, g in enumerate(bounds.group) if g >= 0
    ]
    of_cell = F.broadcast(spark.createDataFrame(cell_rows, "cell int, grp int, parts int, slices int"))
    asked = queries.join(of_cell, "cell").select(
        "grp", F.expr("int(pmod(xxhash64(row), parts))").alias("part"),
        F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"),
        F.lit(0).alias("kind"), "row", "vec_id", "x", "cell", "far",
    )
    need_rows = []
    for g in sorted(bounds.parts):
        least = bounds.least[bounds.group == g].min(axis=0)
        need_rows += [(int(j), g, bounds.parts[g], bounds.slices[g], float(least[j])) for j in np.flatnonzero(np.isfinite(least))]
        need_rows += [(int(j), g, bounds.parts[g], bounds.slices[g], -1.0) for j in np.flatnonzero(np.isneginf(least))]
    # at most PIVOTS rows a group of queries
    needs = spark.createDataFrame(need_rows, "cell int, grp int, parts int, slices int, least double")
    offered = (
        cells.join(needs, "cell")
        .where("far >= least")
        .select(
            "grp", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
            F.expr("int(pmod(xxhash64(row, 7), slices))").alias("slice"),
            F.lit(1).alias("kind"), "row", "vec_id", "x", "cell", "far",
        )
    )
    return asked.unionByName(offered)


class _Group:
    """The queries of one (group, part) in one slice, and the best candidates so far."""

    def __init__(self, space: Space, bounds: Bounds, top: int):
        self.space, self.bounds, self.top, self.tables = space, bounds, top, []

    def add(self, table: pa.Table) -> None:
        self.tables.append(table)

    def ready(self) -> None:
        table = pa.concat_tables(self.tables).combine_chunks().sort_by("cell")
        self.tables = []
        self.row = table["row"].to_numpy()
        self.vec_id = table["vec_id"].to_numpy(zero_copy_only=False)
        cell = table["cell"].to_numpy()
        x = self.space.matrix(table["x"].combine_chunks())
        self.squared = self.space.lengths(x)
        self.x = x.astype(self.space.kind)
        self.cells, first = np.unique(cell, return_index=True)
        self.spans = list(zip(first, [*first[1:], len(cell)]))
        self.best = [None] * len(cell)
        # the score a candidate must reach
        self.floor = np.full(len(cell), -np.inf)

    def offer(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        if self.tables:
            self.ready()
        cell, far = table["cell"].to_numpy(), table["far"].to_numpy()
        data = self.space.matrix(table["x"].combine_chunks()).astype(self.space.kind)
        row, vec_id = table["row"].to_numpy(), table["vec_id"].to_pylist()
        everything, some = [], []
        for number, (i, (start, end)) in enumerate(zip(self.cells, self.spans)):
            least = self.bounds.least[i]
            weakest = self.floor[start:end]
            if np.isfinite(weakest).all():
                theta = np.sqrt(np.maximum(self.squared[start:end] + self.space.most - 2 * weakest, 0)).max()
                least = np.maximum(least, self.bounds.between[i] - self.bounds.radius[i] - theta - self.space.slack)
            needed = far >= least[cell]
            if needed.all():
                everything += range(start, end)
            elif needed.any():
                some.append((np.arange(start, end), np.flatnonzero(needed)))
        for asked, offered in [(np.array(everything, int), None), *some]:
            part = data if offered is None else data[offered]
            step = max(_BLOCK // len(part), 1)
            for at in range(0, len(asked), step):
                block = asked[at : at + step]
                self.keep(block, self.x[block] @ part.T, offered, row, vec_id)

    def keep(self, asked, scores, offered, row, vec_id) -> None:
        n = scores.shape[1]
        if self.space.kind is object or n <= self.top + 1:
            floors = [None] * len(asked)
        else:
            floors = np.partition(scores, n - self.top - 1, axis=1)[:, n - self.top - 1].tolist()
        for q, line, floor in zip(asked.tolist(), scores, floors):
            if floor is None:
                places = range(n)
            else:
                floor = max(floor, self.floor[q])
                places = np.flatnonzero(line >= floor).tolist()
            found = self.best[q] or []
            for k in places:
                at = k if offered is None else int(offered[k])
                if row[at] != self.row[q]:
                    name = vec_id[at]
                    found.append((-int(line[k]), name is None, name or 0, int(row[at])))
            found.sort()
            self.best[q] = found[: self.top]
            if len(found) >= self.top:
                # a float no greater than the whole number
                self.floor[q] = np.nextafter(float(-self.best[q][-1][0]), -np.inf)

    def answers(self) -> pa.RecordBatch:
        if self.tables:
            self.ready()
        out = [
            (int(self.row[q]), int(self.vec_id[q]), None if none else name, row, max(min(-minus, _LONG - 1), -_LONG))
            for q, best in enumerate(self.best)
            for minus, none, name, row in best or []
        ]
        columns = list(zip(*out)) if out else [[]] * 5
        names = ("query_row", "query_id", "vec_id", "row", "score")
        return pa.RecordBatch.from_pydict({k: pa.array(c, pa.int64()) for k, c in zip(names, columns)})


def _solved(space: Space, bounds: Bounds, top: int):
    """The best candidates of each query, of rows sorted by task key, queries first."""
    key = ["grp", "part", "slice"]
    step = max(GROUP_BYTES // (8 * max(space.width, 1)), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            names = list(zip(*(table[c].to_numpy() for c in key), table["kind"].to_numpy()))
            cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if names[start][:3] != now:
                    if group:
                        yield group.answers()
                    now, group = names[start][:3], _Group(space, bounds, top)
                for at in range(start, end, step):
                    part = table.slice(at, min(step, end - at))
                    if names[start][3] == 0:
                        group.add(part)
                    else:
                        group.offer(part)
        if group:
            yield group.answers()

    return run


def top_k(candidates: DataFrame, queries, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` candidates of greatest inner product for every query.

    ``candidates`` are (vec_id, x array<bigint>); the rows for which the column
    expression ``queries`` holds are the queries. Every row but the query's own is
    a candidate, copies of it included. Ties go to the smaller vec_id, null last;
    repeated rows each ask and each are found. A shorter vector counts as if
    zeros followed; a score beyond a bigint is returned as the nearest bigint.
    Without rows, or without queries, there are no answers.
    """
    spark = candidates.sparkSession
    rows = stored(candidates.select(F.monotonically_increasing_id().alias("row"), "vec_id", "x"), "vectors")
    n, width, most = _stats(rows)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    asking = rows.where(queries)
    if not n or asking.isEmpty():
        return spark.createDataFrame([], schema)
    space = Space(width, most, _pivots(rows, n, width, most))
    cells = stored(rows.mapInArrow(_in_cells(space, True), _CELL_SCHEMA), "candidate-cells")
    asked = stored(asking.mapInArrow(_in_cells(space, False), _CELL_SCHEMA), "query-cells")
    dropped(rows)
    bounds = _bounds(space, asked, cells, top)
    task = ["grp", "part", "slice"]
    dealt = _dealt(asked, cells, bounds)
    tasks = sum(bounds.parts[g] * bounds.slices[g] for g in bounds.parts)
    # twice as many partitions as tasks, so that few of them share one
    sorted_ = dealt.repartition(2 * tasks, *task).sortWithinPartitions(*task, "kind", "cell")
    found = sorted_.mapInArrow(_solved(space, bounds, top), "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def embedding_neighbours(embeddings: DataFrame, queries="vec_id % 20 = 0", top: int = TOP) -> DataFrame:
    """``top_k`` over whole-number vectors of ``embeddings`` (``vec_id``, ``embedding``); vectors not usable take no part."""
    return top_k(whole_vectors(embeddings.select("vec_id", "embedding")), F.expr(queries), top)
