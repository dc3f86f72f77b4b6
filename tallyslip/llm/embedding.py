"""Embedding near-dedup: cross-polytope buckets, int8 tile products with error bounds, full precision where they leave doubt.

Equal vectors are one row with a weight. Vectors are scaled to unit length and rounded to int8 with one scale per vector. Every
vector has one bucket per table: it is turned by random integer matrices, and the largest coordinate with its sign names
the bucket. The number of buckets grows with the number of vectors so that they keep their size, and the number of
tables follows from the wanted recall: a pair at the threshold is missed by all tables with probability at most about `miss`.
A bucket's rows meet in one sorted run with their int8 codes and error bounds only; products of these tiles are exact
integers. With rounding errors e_x, e_y (their norms are known exactly up to float rounding),
|x.y - x'.y'| <= |x'||e_y| + |y'||e_x| + |e_x||e_y|: pairs whose lower bound reaches the threshold are links, pairs whose upper
bound doesn't are none. Rows of pairs in between meet once more with their vectors, and only those pairs are recomputed in
double precision. A pair that meets in several tables counts in the first.
Runs give link counts per vector and a bounded fan-out tree of links, never pairs; buckets of more than `block_rows` vectors are
dealt in blocks and every pair of blocks meets in a run of its own, as every link has to be counted.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors
of different lengths don't link. Repeated rows (same id) are vectors like others. A null id is no smallest one of its component unless
all are null. Extra columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.common import components, discard, materialize
from tallyslip.llm.tiles import thinned, tree, whole_runs

THRESHOLD = 0.9
#: Wanted chance that a pair at the threshold meets in no table.
MISS = 1e-4
#: Vectors per bucket that the number of buckets aims at.
BUCKET_ROWS = 64
#: Vectors of a bucket that meet in one run; rows of a tile whose products are in memory at once; pairs recomputed at once.
BLOCK_ROWS, TILE_ROWS, PAIRS = 2048, 256, 10_000
SEED = 42
#: Slack of double rounding in bounds and of float32 inputs.
SLACK = 1e-9
#: Random pairs on which the chance of a common bucket is measured, and entries' scale of the integer matrices.
TRIALS, SCALE = 20_000, 64


class Tables:
    """Bucket codes of int8 vectors of one length. Matrices and codes are integers, so their products are exact in doubles and every
    task gives a vector the same bucket."""

    def __init__(self, dim: int, n: int, threshold: float = THRESHOLD, miss: float = MISS):
        bits = max(1, math.ceil(math.log2(max(n, 2) / BUCKET_ROWS)))
        widest = max(1, dim.bit_length() - 1)  # a full turn has 2 * 2 ** widest buckets
        self.turns = [widest] * (bits // (widest + 1)) + ([bits % (widest + 1) - 1] if bits % (widest + 1) else [])
        self.bits = sum(w + 1 for w in self.turns)
        rng = np.random.default_rng(SEED + dim)
        x, z = rng.standard_normal((2, TRIALS, dim))
        unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
        x = unit(x)
        z = unit(z - (z * x).sum(axis=1, keepdims=True) * x) if dim > 1 else x
        pair = [quantise(v)[0] for v in (x, threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * z)]
        chance = 1.0
        for width in self.turns:
            matrix = self._matrix(rng, dim, width)
            a, b = (self._largest(v.astype(np.float64) @ matrix) for v in pair)
            chance *= float((a == b).mean())
        chance = min(max(chance * 0.98, 1e-6), 1 - 1e-9)  # less the error of the trials
        self.count = max(1, math.ceil(math.log(miss) / math.log1p(-chance)))
        self.matrices = [[self._matrix(rng, dim, w) for w in self.turns] for _ in range(self.count)]

    @staticmethod
    def _matrix(rng: np.random.Generator, dim: int, width: int) -> np.ndarray:
        return np.rint(rng.standard_normal((dim, 1 << width)) * SCALE)

    @staticmethod
    def _largest(turned: np.ndarray) -> np.ndarray:
        at = np.abs(turned).argmax(axis=1)
        return 2 * at + (turned[np.arange(len(turned)), at] > 0)

    def codes(self, quantised: np.ndarray, tables: int | None = None) -> np.ndarray:
        """(vectors, tables) bucket codes below 2 ** bits, of all or the first tables."""
        x = quantised.astype(np.float64)
        used = self.matrices[:tables]
        out = np.zeros((len(x), len(used)), dtype=np.int64)
        for t, turns in enumerate(used):
            for matrix in turns:
                out[:, t] = out[:, t] * 2 * matrix.shape[1] + self._largest(x @ matrix)
        return out


def _unit(packed: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), dtype="<f8").reshape(len(packed), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the rounded vectors, norms of the rounding errors (each rounded up)."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rounded = codes * scale[:, None]
    up = 1 + 1e-12
    return codes, scale, np.linalg.norm(rounded, axis=1) * up, np.linalg.norm(unit - rounded, axis=1) * up


class Short:
    """int8 codes with scales and bounds, as they lie in rows: three doubles, then the codes."""

    def __init__(self, codes: np.ndarray, scale: np.ndarray, size: np.ndarray, error: np.ndarray):
        self.codes, self.scale, self.size, self.error = codes, scale, size, error

    def packed(self) -> list[bytes]:
        numbers = np.stack((self.scale, self.size, self.error), axis=1)
        return [n.tobytes() + c.tobytes() for n, c in zip(numbers, self.codes)]

    @staticmethod
    def unpacked(rows: list[bytes]) -> Short:
        flat = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), -1)
        numbers = np.ascontiguousarray(flat[:, :24]).view("<f8")
        return Short(np.ascontiguousarray(flat[:, 24:]).view(np.int8), *numbers.T)

    def __getitem__(self, at) -> Short:
        return Short(self.codes[at], self.scale[at], self.size[at], self.error[at])


def tile_bounds(a: Short, b: Short, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are links for sure, and which may be. Integer products are exact in float32 below 2**24 and in float64
    beyond, so BLAS may do them."""
    exact = np.float32 if a.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    near = (a.codes.astype(exact) @ b.codes.astype(exact).T) * a.scale[:, None] * b.scale[None, :]
    bound = a.size[:, None] * b.error[None, :] + a.error[:, None] * (b.size + b.error)[None, :] + SLACK
    sure = near - bound >= threshold
    return sure, (near + bound >= threshold) & ~sure


def exact_pairs(unit: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold in double precision, some pairs at a time."""
    good = [np.einsum("ij,ij->i", unit[i[p : p + PAIRS]], unit[j[p : p + PAIRS]]) >= threshold for p in range(0, len(i), PAIRS)]
    return np.concatenate(good) if good else np.zeros(0, dtype=bool)


def _run_links(tables: Tables, threshold: float, table: int, side: np.ndarray, rep: np.ndarray, weight: np.ndarray, short: Short, unit: np.ndarray | None) -> Iterator[tuple[int, int | None, int, int]]:
    """(a, b, n, kind) of one run. Without vectors: links that are sure, and the rows of doubtful ones; with `unit`: those links."""
    left, right = (np.flatnonzero(side == 1), np.flatnonzero(side == 2)) if side.any() else (np.arange(len(rep)), np.arange(len(rep)))
    if not len(left) or not len(right):
        return
    before = None
    total = np.zeros(len(rep), dtype=np.int64)
    doubtful = np.zeros(len(rep), dtype=bool)
    ones, others = [], []
    for p in range(0, len(left), TILE_ROWS):
        part = left[p : p + TILE_ROWS]
        sure, maybe = tile_bounds(short[part], short[right], threshold)
        mask = sure if unit is None else maybe
        fresh = part[:, None] < right[None, :] if not side.any() else np.ones(mask.shape, dtype=bool)
        if table and (sure | maybe).any():  # a pair counts in the first table where it meets
            before = tables.codes(short.codes, table) if before is None else before
            for t in range(table):
                fresh &= before[part, t][:, None] != before[right, t][None, :]
        mask &= fresh
        i, j = np.nonzero(mask)
        i, j = part[i], right[j]
        if unit is not None:
            good = exact_pairs(unit, i, j, threshold)
            i, j = i[good], j[good]
        else:
            x, y = np.nonzero(maybe & fresh)
            doubtful[part[x]] = doubtful[right[y]] = True
        np.add.at(total, i, weight[j])
        np.add.at(total, j, weight[i])
        i, j = thinned(len(rep), i, j)
        ones.append(i)
        others.append(j)
    yield from ((int(rep[k]), None, int(total[k]), 0) for k in np.flatnonzero(total))
    yield from ((int(rep[p]), int(rep[q]), 0, 1) for p, q in tree(len(rep), np.concatenate(ones), np.concatenate(others)))
    yield from ((int(rep[k]), None, 0, 2) for k in np.flatnonzero(doubtful))


def _links(runs: DataFrame, tables, threshold: float, with_vectors: bool) -> DataFrame:
    """`runs`: run, side, table, rep, weight, short and perhaps packed. Rows (run, side, a, b, n, kind): kind 0 the weight n of
    what links to a, 1 a link that joins a and b, 2 a row with doubtful pairs (with its run and side)."""
    schema = pa.schema([("run", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("kind", pa.int32())])

    def link(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_runs(stream):
            run = batch.column(0).to_numpy()
            side, table, rep, weight = (batch.column(k).to_numpy() for k in (1, 2, 3, 4))
            edge = np.flatnonzero(run[1:] != run[:-1]) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(run)]):
                if b - a > 1:
                    short = Short.unpacked(batch.column(5).slice(a, b - a).to_pylist())
                    unit = _unit(batch.column(6).slice(a, b - a).to_pylist()) if with_vectors else None
                    out = list(_run_links(tables.value, threshold, int(table[a]), side[a:b], rep[a:b], weight[a:b], short, unit))
                    if out:
                        x, y, n, kind = zip(*out)
                        yield pa.RecordBatch.from_arrays([pa.array([run[a]] * len(x)), pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(n, pa.int64()), pa.array(kind, pa.int32())], schema=schema)

    columns = ["run", "side", "table", "rep", "weight", "short"] + ["packed"] * with_vectors
    dealt = runs.select(*columns).repartition("run").sortWithinPartitions("run", "side", "rep")
    return materialize(dealt.mapInArrow(link, "run long, a long, b long, n long, kind int"))


def _pack_valid(batches_in: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null where a vector links with nothing."""
    for batch in batches_in:
        vectors = batch.column(1)
        flat = pc.fill_null(vectors.flatten(), np.nan).to_numpy(zero_copy_only=False).astype("<f8") + 0.0
        sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        stops = np.cumsum(sizes)
        rows = [flat[a:b] for a, b in zip((stops - sizes).tolist(), stops.tolist())]
        packed = [x.tobytes() if np.isfinite(x).all() and x.any() else None for x in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["vec_id", "packed"])


def _bucket_rows(reps: DataFrame, tables, block_rows: int) -> DataFrame:
    """(run, side, table, rep) of every row of `reps` (rep, packed) in every table; large buckets as pairs of blocks."""

    def bucket(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                short = Short.unpacked(part.column(1).to_pylist())
                keys = tables.value.codes(short.codes) + (np.arange(tables.value.count, dtype=np.int64) << tables.value.bits)
                yield pa.RecordBatch.from_pydict({"rep": np.repeat(part.column(0).to_numpy(), tables.value.count), "key": keys.ravel()})

    bits = tables.value.bits
    member = reps.select("rep", "short").mapInArrow(bucket, "rep long, key long")
    hot = materialize(member.groupBy("key").count().filter(F.col("count") > block_rows).select("key", F.ceil(F.col("count") / (block_rows // 2)).cast("int").alias("blocks")))
    member = member.join(hot, "key", "left") if hot.limit(1).count() else member.withColumn("blocks", F.lit(None).cast("int"))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    side = lambda i: F.when(i == block, 0).when(i > block, 1).otherwise(2)
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, block).alias("x"), F.greatest(i, block).alias("y"), side(i).alias("side")))
    alone = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("side")))
    rows = member.select("key", "rep", F.explode(F.when(F.col("blocks") > 1, pairs).otherwise(alone)).alias("pair"))
    return rows.select(F.xxhash64("key", "pair.x", "pair.y").alias("run"), "pair.side", F.shiftright("key", bits).cast("int").alias("table"), "rep")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) per row; `id` is a long."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    packed = materialize(rows.mapInArrow(_pack_valid, "vec_id long, packed binary"))
    good = packed.filter("packed is not null")
    reps = materialize(good.groupBy("packed").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight")).withColumn("rep", F.xxhash64("packed", "least")))

    def shorten(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                short = Short(*quantise(_unit(part.column(2).to_pylist()))).packed()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(short, pa.binary())], names=["rep", "weight", "short"])

    found = []
    for (size,) in reps.select(F.length("packed")).distinct().collect():  # a few vector lengths
        same = reps.filter(F.length("packed") == size)
        tables = spark.sparkContext.broadcast(Tables(size // 8, same.count(), threshold, miss))
        short = materialize(same.select("rep", "weight", "packed").mapInArrow(shorten, "rep long, weight long, short binary"))
        member = _bucket_rows(short, tables, block_rows)
        links = _links(member.join(short, "rep"), tables, threshold, False)
        found.append(links)
        doubtful = links.filter("kind = 2").select("run", F.col("a").alias("rep")).distinct()
        if doubtful.limit(1).count():
            doubtful = materialize(member.join(doubtful, ["run", "rep"]))
            found.append(_links(doubtful.join(short, "rep").join(same.select("rep", "packed"), "rep"), tables, threshold, True))
    if not found:
        return packed.select(F.col("vec_id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    counts = links.filter("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    classes = components(links.filter("kind = 1"))
    members = reps.select("rep", "least", "weight", "packed").join(classes.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    members = materialize(members.join(counts, "rep", "left"))
    least = materialize(members.groupBy("component").agg(F.min("least").alias("component_id")))
    of_rep = materialize(members.join(least, "component").select("packed", "component_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    discard(*found, members, least)
    out = packed.join(of_rep, "packed", "left")
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    )
