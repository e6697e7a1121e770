"""Embedding whitening with distributed block matrices.

Rows of whole-number vectors are packed into blocks of ``BLOCK_ROWS`` rows and
numbered; a block holds centred rows of one range of columns, and zeros where
the last rows of a task do not fill it. The fit list (each distinct vector once)
as a BlockMatrix A gives the scatter matrix A^T A; its eigenvectors, found on
the driver as it is only as wide as a vector, over the roots of their eigenvalues
make the whitening matrix. A second BlockMatrix of all rows times that matrix
projects them.

Sums are whole numbers, so the centre of a row, (n x - S) / n, is rounded once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from larder.llm.common import stored
from larder.llm.vectors import whole_vectors

COMPONENTS = 16
# added to every whole number
ADDED = 1_000_000
BLOCK_ROWS, BLOCK_COLUMNS = 512, 256
# blocks of a partition when blocks are multiplied
_TOGETHER = 128
_LONG = 1 << 63

_PACKED = "part bigint, number bigint, held int, vec_id array<bigint>, x array<bigint>"


def _packed(width: int):
    """Rows put together to blocks, in the order in which a task meets them; short vectors filled up with ``ADDED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, names, rows = TaskContext.get().partitionId(), 0, [], []

        def block(k):
            columns = {
                "part": pa.array([part], pa.int64()),
                "number": pa.array([number], pa.int64()),
                "held": pa.array([k], pa.int32()),
                "vec_id": pa.array([names[:k]], pa.list_(pa.int64())),
                "x": pa.array([np.concatenate(rows[:k])], pa.list_(pa.int64())),
            }
            del names[:k], rows[:k]
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            names += batch["vec_id"].to_pylist()
            for x in batch["x"]:
                x = x.values.to_numpy()
                rows.append(x if len(x) == width else np.concatenate([x, np.full(width - len(x), ADDED, np.int64)]))
                if len(rows) == BLOCK_ROWS:
                    yield block(BLOCK_ROWS)
                    number += 1
        if rows:
            yield block(len(rows))

    return run


def _blocks(rows: DataFrame, width: int, purpose: str) -> tuple[DataFrame, int]:
    """Stored blocks of ``rows`` (vec_id, x) with numbers from 0 on, and how many there are.

    Numbers come from the counts of blocks by task, one row each.
    """
    packed = stored(rows.mapInArrow(_packed(width), _PACKED), purpose)
    counts = packed.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    numbered = packed.join(offsets, "part").withColumn("block", (F.col("offset") + F.col("number")).cast("int"))
    return numbered.drop("part", "number", "offset"), packed.count()


def _scaled_centre(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as bigints where they suffice, else as Python integers."""
    most = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    kind = np.int64 if n * most + max(map(abs, sums), default=0) < _LONG else object
    return x.astype(kind) * n - np.array(sums, kind)


def _centred(n: int, sums: list[int]):
    """The sub-matrices of a block: ((row, column), matrix)."""
    width = len(sums)

    def run(row):
        x = np.array(row.x, np.int64).reshape(row.held, width)
        centred = np.zeros((BLOCK_ROWS, width))
        centred[: row.held] = _scaled_centre(x, n, sums) / n
        for j, start in enumerate(range(0, width, BLOCK_COLUMNS)):
            part = centred[:, start : start + BLOCK_COLUMNS]
            yield (row.block, j), DenseMatrix(BLOCK_ROWS, part.shape[1], part.ravel(order="F"))

    return run


def _matrix(blocks: DataFrame, count: int, n: int, sums: list[int]) -> BlockMatrix:
    parts = blocks.select("block", "held", "x").rdd.flatMap(_centred(n, sums))
    return BlockMatrix(parts, BLOCK_ROWS, min(BLOCK_COLUMNS, len(sums)), count * BLOCK_ROWS, len(sums))


def _product(a: BlockMatrix, b: BlockMatrix, middle: int) -> BlockMatrix:
    """a b, with the blocks along the dimension that they share dealt over ``middle`` times as many tasks."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, middle)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _scatter(a: BlockMatrix, count: int) -> np.ndarray:
    """a^T a, of which the driver keeps one number for each pair of columns."""
    middle = max(ceil(count**0.5), ceil(count / _TOGETHER))
    found = _product(a.transpose(), a, middle).toLocalMatrix().toArray()
    return (found + found.T) / 2


def _projected(a: BlockMatrix, matrix: np.ndarray, count: int) -> BlockMatrix:
    """a times a local matrix, which goes to every task; it is as long as a vector and ``COMPONENTS`` wide."""
    spark_context = SparkSession.active().sparkContext
    width, wide = matrix.shape
    parts = [
        ((j, 0), DenseMatrix(len(matrix[s : s + BLOCK_COLUMNS]), wide, matrix[s : s + BLOCK_COLUMNS].ravel(order="F")))
        for j, s in enumerate(range(0, width, BLOCK_COLUMNS))
    ]
    # a product has as many partitions as the factor with more of them
    spread = spark_context.parallelize(parts, max(ceil(count / _TOGETHER), 1))
    return a.multiply(BlockMatrix(spread, min(BLOCK_COLUMNS, width), wide, width, wide))


def _rows_out(n: int, sums: list[int], wide: int):
    """Rows of blocks whose projected values came back: vec_id, deviation and one value for each component."""
    width = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                x = batch["x"][k].values.to_numpy().reshape(-1, width)
                scaled = _scaled_centre(x, n, sums)
                reach = int(abs(scaled).max(initial=0))
                if reach * reach * width >= _LONG:
                    scaled = scaled.astype(object)
                far = (scaled * scaled).sum(axis=1).tolist()
                values = np.frombuffer(batch["projected"][k].as_py(), "<f8").reshape(wide, -1)[:, : len(x)].T
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": pa.array(batch["vec_id"][k].as_py(), pa.int64()),
                        "deviation": pa.array([v if v < _LONG else None for v in far], pa.int64()),
                        "values": pa.array(list(np.ascontiguousarray(values)), pa.list_(pa.float64())),
                    }
                )

    return run


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """How many vectors the blocks of ``fit`` hold and their sums by dimension, exactly."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            for block in batch["x"]:
                x = block.values.to_numpy().reshape(-1, width)
                n += len(x)
                total += (x if abs(x).max(initial=0) < 1 << 50 else x.astype(object)).sum(axis=0)
        if n:
            columns = {"at": pa.array(range(-1, width), pa.int32()), "s": pa.array([str(int(v)) for v in (n, *total)])}
            yield pa.RecordBatch.from_pydict(columns)

    by_place = fit.select("x").mapInArrow(partial, "at int, s string").groupBy("at")
    rows = by_place.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    return int(rows[0].s), [int(r.s) for r in rows[1:]]


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of ``rows`` (vec_id, x array<bigint>).

    One row for every row and component up to ``components`` or the vectors'
    width. The fit list holds each distinct vector once: n of them. deviation is
    the sum over dimensions of (n x - S)^2, null beyond a bigint; whitened the
    centred row on the component over the root of the component's variance e;
    explained e over the whole variance; identity_error the greatest absolute
    entry of the covariance of the whitened fit list less the identity.

    A component without variance has a null whitened value and does not count in
    identity_error, which is null if there is none; without any variance
    explained is null. Shorter vectors are filled up with ``ADDED``. Repeated
    rows are all returned. No rows, or only empty vectors, give no rows.
    """
    spark = rows.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], schema)
    filled = F.expr(f"concat(x, array_repeat({ADDED}L, {width} - size(x)))")
    distinct = rows.select(filled.alias("x")).distinct().select(F.lit(None).cast("bigint").alias("vec_id"), "x")
    fit, fit_count = _blocks(distinct, width, "fit-blocks")
    n, sums = _sums(fit, width)

    a = _matrix(fit, fit_count, n, sums)
    variance, axes = np.linalg.eigh(_scatter(a, fit_count) / n)
    wide = min(components, width)
    variance, axes = variance[::-1], axes[:, ::-1]
    total = float(variance.sum())
    alive = variance[:wide] > max(variance[0], 0) * width * 1e-15
    over = np.where(alive, variance[:wide], np.inf) ** -0.5
    matrix = axes[:, :wide] * over
    error = None
    if alive.any():
        of_fit = _scatter(_projected(a, matrix, fit_count), fit_count)[: wide, : wide] / n
        error = float(abs(of_fit - np.eye(wide))[np.ix_(alive, alive)].max())

    every, count = _blocks(rows.select("vec_id", "x"), width, "row-blocks")
    product = _projected(_matrix(every, count, n, sums), matrix, count)
    parts = product.blocks.map(lambda b: (b[0][0], bytearray(b[1].toArray().ravel(order="F").astype("<f8").tobytes())))
    projected = spark.createDataFrame(parts, "block int, projected binary")
    out = every.join(projected, "block").select("vec_id", "x", "projected")
    values = out.mapInArrow(_rows_out(n, sums, wide), "vec_id bigint, deviation bigint, values array<double>")

    def known(numbers: list) -> Column:
        return F.array(*[F.lit(v).cast("double") for v in numbers])

    explained = [float(v) / total if total > 0 else None for v in variance[:wide]]
    at = F.col("at") + 1
    return values.select("vec_id", "deviation", F.posexplode("values").alias("at", "value")).select(
        "vec_id",
        at.cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.when(F.get(F.array(*[F.lit(bool(v)) for v in alive]), F.col("at")), F.col("value")).alias("whitened"),
        F.get(known(explained), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def embedding_whitening(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``whitened`` over whole-number vectors of ``embeddings`` (``vec_id``, ``embedding``); vectors not usable are left out."""
    return whitened(whole_vectors(embeddings.select("vec_id", "embedding"), add=ADDED), components)
