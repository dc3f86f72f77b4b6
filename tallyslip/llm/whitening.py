"""Whitening of embeddings by principal components, solved in mixed precision.

Entries become integers, and every distinct vector counts once in the fit. Its covariance is summed on executors from blocks of centred
rows; only d x d sums and d-vectors reach the driver. There the eigenvectors come from a float32 solver and are corrected by the
Ogita-Aishima iteration, a few matrix products each, in extended precision (`numpy.longdouble`). Directions whose eigenvalues the
iteration can't tell apart form a cluster: a small sub-problem is solved on their span and turns them, after which the iteration goes on.

Defined results: null vectors, and vectors with null or non-finite entries, are dropped; so are empty vectors, and those whose length
isn't the most frequent one (of equally frequent ones the longest). Integers beyond 2^62 are held there. Fewer than 16 dimensions give
fewer components. A direction without variance (at rounding level) has `whitened` 0 and doesn't count in `identity_error`; a table of
equal vectors has no other. A deviation beyond a long is null. Null or repeated ids and repeated rows: a result per row. Ties of
eigenvalues: any orthonormal base of their space. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.common import discard, materialize

#: Entries are scaled by this, floored and moved by OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows that are in memory as doubles at once, and groups in which partial sums of tasks meet.
BLOCK_ROWS, MERGE_GROUPS = 4096, 64
#: Most corrections by the iteration.
STEPS = 12
LIMIT = 2**62


def grid(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) as int64; OFFSET is left to the sums, as it is the same everywhere."""
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -LIMIT, LIMIT).astype(np.int64)


def pack(row: np.ndarray) -> bytes:
    """The integers of a vector in the fewest bytes that hold all of them: equal vectors have equal bytes."""
    for kind in (np.int8, np.int16, np.int32):
        limits = np.iinfo(kind)
        if row.min() >= limits.min and row.max() <= limits.max:
            return row.astype(kind).tobytes()
    return row.tobytes()


def unpack(codes: list[bytes], d: int) -> np.ndarray:
    """Rows of int64 from packed vectors of d entries."""
    out = np.empty((len(codes), d), dtype=np.int64)
    for i, code in enumerate(codes):
        out[i] = np.frombuffer(code, dtype=f"i{len(code) // d}")
    return out


def encode(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, code) of the usable rows, and the number of dimensions."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = df.select(F.col(id_col).alias("id"), vec.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(finite)
    top = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = top["d"] if top else 1
    id_type = rows.schema["id"].dataType

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(stream):
            x = grid(pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).reshape(-1, d))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(r) for r in x], pa.binary())], ["id", "code"])

    return rows.filter(F.size("v") == d).mapInArrow(run, f"id {id_type.simpleString()}, code binary"), d


def blocks(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(first, BLOCK_ROWS)


def count_and_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sums of its dimensions, OFFSET included."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in blocks(stream):
            x = unpack(batch.column(0).to_pylist(), d)
            wide = x if np.abs(x).max(initial=0) < 2**40 else x.astype(object)
            n, total = n + len(x), [a + int(b) for a, b in zip(total, wide.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "n", "s"],
            )

    rows = fit.select("code").mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    n, sums = 0, [0] * d
    for r in rows:
        n, sums[r["i"]] = r["n"], int(r["s"])
    return n, [s + n * OFFSET for s in sums]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S, exact: int64, or Python integers where these don't hold it."""
    moved = [s - n * OFFSET for s in sums]
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, moved))
    if most < LIMIT:
        return n * x - np.array(moved, dtype=np.int64)
    return n * x.astype(object) - np.array(moved, dtype=object)


def gram(fit: DataFrame, d: int, k: int, make: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of y and of y y' over the fit list, y = make(x) of k entries. Tasks add up their blocks, groups of tasks their sums;
    MERGE_GROUPS results reach the driver, each k x (k + 1) doubles."""

    def add(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in blocks(stream):
            y = make(unpack(batch.column(0).to_pylist(), d))
            total[0] += y.sum(axis=0)
            total[1:] += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def merge(parts: pa.Table) -> pa.Table:
        return pa.table({"part": pa.array([sum(np.frombuffer(p) for p in parts.column("part").to_pylist()).tobytes()], pa.binary())})

    parts = fit.select("code").mapInArrow(add, "part binary").withColumn("g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    merged = parts.groupBy("g").applyInArrow(lambda t: merge(t), "part binary").collect()
    total = sum((np.frombuffer(r["part"]) for r in merged), np.zeros(k * (k + 1))).reshape(k + 1, k)
    return total[0], total[1:]


def _clusters(values: np.ndarray, gap: float) -> list[slice]:
    """Ranges of neighbours in ascending values that are no more than `gap` apart."""
    cuts = [0, *[i for i in range(1, len(values)) if values[i] - values[i - 1] > gap], len(values)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and unit eigenvectors of the symmetric `a`, from approximate ones `x`, in extended precision.

    A step takes r = I - x'x and s = x'ax. Eigenvalue i is s_ii / (1 - r_ii); a pair further apart than the present error is corrected
    by (s_ij + l_j r_ij) / (l_j - l_i), a nearer one only made orthogonal. Pairs in a cluster are told apart by a double-precision
    sub-problem on its span, with the cluster's middle taken off so that its small differences keep their digits."""
    wide = np.longdouble
    a, x = a.astype(wide), x.astype(wide)
    d, eps = len(a), float(np.finfo(wide).eps)
    eye, norm = np.eye(d, dtype=wide), float(np.abs(a).sum(axis=1).max())
    before = np.inf
    for _ in range(STEPS):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = 2 * float(np.linalg.norm(off.astype(np.float64)) + norm * np.linalg.norm(r.astype(np.float64)))
        order = np.argsort(values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        for part in _clusters(values.astype(np.float64), error):
            if part.stop - part.start > 1:  # turn the cluster's vectors by the eigenvectors of what `a` is on their span
                span = x[:, part] @ (np.eye(part.stop - part.start, dtype=wide) + r[part, part] / 2)
                middle = values[part].mean()
                inner = span.T @ (a @ span - middle * span)
                _, turn = np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))
                x[:, part] = span @ turn.astype(wide)
        r, s = eye - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        gaps = values[None, :] - values[:, None]
        error = 2 * float(np.linalg.norm((s - np.diag(values)).astype(np.float64)) + norm * np.linalg.norm(r.astype(np.float64)))
        apart = np.abs(gaps) > max(error, 4 * d * eps * norm)
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ step
        size = float(np.abs(step).max())
        if size < 8 * d * eps or (size >= before and size < 1e-12):
            break
        before = size
    r = eye - x.T @ x
    x = x + x @ (r / 2)
    values = np.diag(x.T @ (a @ x))
    order = np.argsort(values, kind="stable")
    return values[order], x[:, order]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors (columns) of a covariance, in double precision."""
    top = np.abs(v).max(initial=0)
    if not top > 0:
        return np.zeros(len(v)), np.eye(len(v))
    _, start = np.linalg.eigh((v / top).astype(np.float32))
    values, vectors = refine(v / top, start)
    return (values[::-1] * top).astype(np.float64), vectors[:, ::-1].astype(np.float64)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per usable row and component."""
    coded, d = encode(df, id_col, vec_col)
    coded = materialize(coded)
    fit = materialize(coded.select("code").distinct())
    n, sums = count_and_sums(fit, d)
    k = min(components, d)
    values, vectors, explained, error = np.zeros(d), np.eye(d), [0.0] * k, 0.0

    def centred(x: np.ndarray) -> np.ndarray:
        return (deviations(x, n, sums) / n).astype(np.float64)

    if n:
        _, total = gram(fit, d, d, centred)
        values, vectors = eigen(total / n)
    trace = float(values.sum())
    real = [i for i in range(k) if values[i] > 4 * d * np.finfo(float).eps * values[0]]
    to_white = np.zeros((d, k))
    for i in real:
        to_white[:, i] = vectors[:, i] / np.sqrt(values[i])
    if real:
        explained = [float(v) / trace for v in values[:k]]
        mean, total = gram(fit, d, k, lambda x: centred(x) @ to_white)
        cov = total / n - np.outer(mean / n, mean / n)
        error = float(np.abs(cov[np.ix_(real, real)] - np.eye(len(real))).max())
    discard(fit)

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(stream):
            x = unpack(batch.column(1).to_pylist(), d)
            wide = deviations(x, n, sums)
            white = (wide / n).astype(np.float64) @ to_white
            if wide.dtype != object and float(np.abs(wide).max(initial=0)) ** 2 * d >= 2**62:
                wide = wide.astype(object)
            squares = [int(s) if s < 2**63 else None for s in (wide * wide).sum(axis=1)]
            row = pa.array(np.repeat(np.arange(len(x)), k))
            number = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)))
            cols = [batch.column(0).take(row), number, pa.array(np.full(len(x) * k, n)), pa.array(squares, pa.int64()).take(row)]
            cols += [pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = coded.schema["id"].dataType.simpleString()
    return coded.mapInArrow(run, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
