"""Whitening against NumPy."""

import numpy as np
import pytest

from larder.llm import whitening
from larder.llm.queries import op13_whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def checked(df, rows, components=16):
    """``rows`` are (vec_id, x) of equal width; signs are taken from the result."""
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert df.columns == COLUMNS
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    x = np.array([v for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, width, wide = len(fit), x.shape[1], min(components, x.shape[1])
    assert len(got) == len(rows) * wide
    sums = [int(s) for s in fit.astype(object).sum(axis=0)]
    centred = np.array([[(n * int(c) - s) / n for c, s in zip(v, sums)] for v in x])
    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(v, sums)) for v in x]
    of_fit = np.array([[(n * int(c) - s) / n for c, s in zip(v, sums)] for v in fit])
    e, axes = np.linalg.eigh(of_fit.T @ of_fit / n)
    e, axes = e[::-1], axes[:, ::-1]
    for c in range(wide):
        mine = [r for r in got if r[1] == c + 1]
        assert {r[2] for r in mine} == {n} and [r[3] for r in mine] == deviation
        assert np.allclose([r[5] for r in mine], e[c] / e.sum(), rtol=1e-9, atol=1e-12)
        if e[c] > 1e-9 * e[0]:
            want = centred @ axes[:, c] / e[c] ** 0.5
            found = np.array([r[4] for r in mine])
            assert np.allclose(found * np.sign((want * found).sum()), want, rtol=1e-6, atol=1e-7)
    assert {r[6] is not None and r[6] < 1e-9 for r in got} == {True}


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1.0, 2) for k, v in rows], "vec_id long, x array<bigint>, n double, block int")


def test_given_vectors(spark, tiny):
    rows = spark.read.parquet(f"{tiny}/embeddings.parquet").collect()
    whole = [(r.vec_id, [int(np.floor(64 * float(c))) + 1_000_000 for c in r.embedding]) for r in rows]
    checked(op13_whitening(spark, tiny), whole)


@pytest.mark.parametrize("block_columns", [3, 256])
def test_copies_many_blocks_and_columns(spark, monkeypatch, block_columns):
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", block_columns)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(3)
    x = (rng.normal(0, 50, (120, 7)) @ rng.normal(0, 1, (7, 7)) + 1e6).astype(np.int64).tolist()
    rows = list(enumerate(x)) + [(500 + k, x[5]) for k in range(60)] + [(None, x[6]), (3, x[3])]
    checked(whitening.whitened(frame(spark, rows).repartition(5)), rows)


def test_rerun_gives_the_same_values(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(rng.integers(0, 99, (50, 5)).tolist()))
    one, two = (sorted(map(tuple, whitening.whitened(frame(spark, rows)).collect())) for _ in range(2))
    assert one == two


def test_components_without_variance(spark):
    rows = [(k, [k, 2 * k, 7]) for k in range(20)]
    got = sorted(map(tuple, whitening.whitened(frame(spark, rows)).collect()), key=lambda r: (r[0], r[1]))
    assert [r[4] is None for r in got[:3]] == [False, True, True]
    assert got[0][5] == pytest.approx(1) and got[0][6] < 1e-9
    same = whitening.whitened(frame(spark, [(1, [4, 5]), (2, [4, 5])])).collect()
    assert [tuple(r)[2:] for r in same] == [(1, 0, None, None, None)] * 4


def test_large_numbers(spark):
    rows = [(k, [k**2 * (1 << 50), -k * (1 << 55), k % 3]) for k in range(12)]
    got = [tuple(r) for r in whitening.whitened(frame(spark, rows)).collect()]
    assert len(got) == 36 and {r[3] for r in got} == {None} and {r[2] for r in got} == {12}


def test_hard_cases(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [])])).collect() == []
    ragged = [(1, [5, 1_000_000]), (2, [7, 3]), (3, [8, 8])]
    checked(whitening.whitened(frame(spark, [(1, [5]), *ragged[1:]])), ragged)
    bad = [(1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [0.5, 1.0]), (5, [0.5, -1.0])]
    df = spark.createDataFrame(bad, "vec_id long, embedding array<double>")
    got = whitening.embedding_whitening(df).collect()
    assert {r.vec_id for r in got} == {4, 5} and len(got) == 4 and {r.n for r in got} == {2}
