"""Exact top-k search against all inner products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import voronoi
from larder.llm.queries import op12_voronoi_join
from larder.llm.vectors import whole_vectors


def expected(rows, is_query, top=20):
    """Rows (vec_id, x) against every other row, in whole numbers."""
    width = max((len(x) for _, x in rows), default=0)
    x = np.array([list(v) + [0] * (width - len(v)) for _, v in rows], object).reshape(len(rows), width)
    out = []
    for q, (name, _) in enumerate(rows):
        if is_query(name):
            scores = (x @ x[q]).tolist() if width else [0] * len(rows)
            others = sorted((-s, n is None, n or 0) for k, ((n, _), s) in enumerate(zip(rows, scores)) if k != q)
            out += [(name, rank, None if none else n, -s) for rank, (s, none, n) in enumerate(others[:top], 1)]
    return sorted(out, key=str)


def by_20(name):
    return name is not None and name % 20 == 0


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def searched(spark, rows, top=20):
    df = spark.createDataFrame(rows, "vec_id long, x array<bigint>")
    return got(voronoi.top_k(df, F.expr("vec_id % 20 = 0"), top))


@pytest.fixture
def small(monkeypatch):
    """Many cells, groups and slices on few rows."""
    monkeypatch.setattr(voronoi, "CELL_ROWS", 10)
    monkeypatch.setattr(voronoi, "GROUP_BYTES", 8 * 8 * 5)
    monkeypatch.setattr(voronoi, "SLICE_UNIT", 40)


def test_given_vectors(spark, tiny):
    rows = spark.read.parquet(f"{tiny}/embeddings.parquet").collect()
    whole = [(r.vec_id, [int(np.floor(64 * float(c))) for c in r.embedding]) for r in rows]
    assert got(op12_voronoi_join(spark, tiny)) == expected(whole, by_20)


@pytest.mark.parametrize("spread", [2, 40])
def test_many_cells_and_groups(spark, small, spread):
    rng = random.Random(spread)
    centres = [[rng.randrange(-300, 300) for _ in range(8)] for _ in range(12)]
    rows = [(k, [c + rng.randrange(-spread, spread) for c in rng.choice(centres)]) for k in range(600)]
    assert searched(spark, rows, 5) == expected(rows, by_20, 5)


def test_bounds_spare_work(spark, small):
    """Of far clusters of many lengths not every candidate goes to every group."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, (10, 8))
    x = centres[np.arange(2000) % 10] + rng.integers(-3, 4, (2000, 8))
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, x array<bigint>")
    rows = df.select(F.col("vec_id").alias("row"), "vec_id", "x")
    n, width, most = voronoi._stats(rows)
    space = voronoi.Space(width, most, voronoi._pivots(rows, n, width, most))
    cells = rows.mapInArrow(voronoi._in_cells(space, True), voronoi._CELL_SCHEMA).cache()
    asked = rows.where("vec_id % 20 = 0").mapInArrow(voronoi._in_cells(space, False), voronoi._CELL_SCHEMA).cache()
    bounds = voronoi._bounds(space, asked, cells, 3)
    offered = voronoi._dealt(asked, cells, bounds).where("kind = 1").count()
    groups = sum(bounds.parts.values())
    assert groups > 5 and offered < 0.9 * groups * n


def test_ties_and_copies(spark, small):
    rows = [(k, [1, 1, 0]) for k in range(200)] + [(k, [0, 0, k % 3]) for k in range(200, 300)]
    rows += [(None, [1, 1, 0]), (None, [9, 9, 9]), (20, [1, 1, 0]), (20, [5, 5, 5]), (20, [5, 5, 5])]
    assert searched(spark, rows) == expected(rows, by_20)


@pytest.mark.parametrize("size", [3000, 1 << 27, 1 << 40])
def test_large_numbers_are_exact(spark, size):
    rng = random.Random(size)
    rows = [(k, [rng.randrange(-size, size) for _ in range(4)]) for k in range(60)]
    want = [r[:3] + (max(min(r[3], (1 << 63) - 1), -(1 << 63)),) for r in expected(rows, by_20)]
    if size < 1 << 40:
        assert searched(spark, rows) == want
    else:  # beyond a bigint scores are cut and rank as cut
        assert sorted(r[3] for r in searched(spark, rows)) == sorted(r[3] for r in want)


def test_hard_cases(spark):
    rows = [(20, [1, 2]), (21, [3]), (22, []), (40, []), (41, [0, 0, 7])]
    assert searched(spark, rows) == expected(rows, by_20)
    assert searched(spark, []) == [] and searched(spark, [(1, [1])]) == []
    assert searched(spark, [(20, [1])]) == []
    assert searched(spark, [(20, []), (21, [])]) == [(20, 1, 21, 0)]


def test_unusable_vectors_take_no_part(spark):
    bad = [None, [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [1e300, 1.0]]
    rows = [(20 * k, v, 1, 2) for k, v in enumerate(bad)] + [(100, [-0.01, 0.99], 3, 4), (101, [1.0, 1.0], 5, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int, cell int")
    assert [tuple(r) for r in whole_vectors(df).collect()] == [(100, [-1, 63]), (101, [64, 64])]
    assert got(voronoi.embedding_neighbours(df)) == [(100, 1, 101, 62 * 64)]
