"""What several operators share: written intermediate tables, components of a link table, word caches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Entries that a Python worker keeps in one cache before it starts it anew.
CACHE_ENTRIES = 500_000
#: Words of a WordTable: new ones come with every document, the frequent ones are soon learnt again.
TABLE_WORDS = 100_000
#: Documents, and bytes of their texts, whose words are in memory at once (a longer text is a block by itself).
BLOCK_DOCS, BLOCK_BYTES = 1000, 8 << 20
#: Longer words aren't kept in a cache.
CACHE_WORD_CHARS = 64

_own_dir: dict[str, str] = {}
#: Written tables that may be deleted, by identity.
_written: dict[int, tuple[DataFrame, str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a temporary one in local mode (tests), else an error: the
    executors of a cluster can't read each other's local folders."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own_dir[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost executors, and
    gives the optimizer the real size."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[id(out)] = (out, path)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for frame in frames:
        _, path = _written.pop(id(frame), (None, None))
        if path:
            jvm, conf = frame.sparkSession.sparkContext._jvm, frame.sparkSession.sparkContext._jsc.hadoopConfiguration()
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_mod(id_col: str, modulus: int):
    """crc32 of the id written as text, modulo `modulus` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def sample_by_hash(df: DataFrame, cols: list[str], rows: int, total: int) -> DataFrame:
    """A repeatable sample of at most `rows` of about `total` rows: those with the smallest hashes of `cols`, rows equal in
    all of these once. A threshold on the hash leaves few more than that before they are ordered."""
    share = min(1.0, 1.3 * (rows + 50) / max(1, total))
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(7), *cols))
    few = hashed.filter(F.col("_hash") / F.lit(2.0**64) + 0.5 < share).dropDuplicates(["_hash"])
    return few.orderBy("_hash").limit(rows).drop("_hash")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the links (a, b), both long: one row (id, component) per linked id, component
    the smallest id reachable.

    Minimum labels flow along the links and every label then jumps to the label of its label, so chains
    shorten by a power each round. Joins are by id (links of one id are split by AQE where they are many),
    aggregates are minima with map-side partial results. Nulls and self links are left out."""
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a != b")
    # both directions of a link in one pass: what makes the links runs once
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(links.select(F.explode(ways).alias("way")).select("way.a", "way.b").distinct())
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("m"))
        moved = materialize(labels.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.col("component").alias("before"), F.least("component", "m").alias("component")
        ))
        jump = moved.filter("component < id").select(F.col("id").alias("component"), F.col("component").alias("target"))
        after = materialize(moved.join(jump, "component", "left").select("id", F.coalesce("target", "component").alias("component"), "before"))
        changed = after.filter("component != before").limit(1).count()
        discard(labels, moved)
        if not changed:
            discard(both)
            return after.select("id", "component")
        labels = after


class WordTable:
    """One row of numbers per distinct white-space word, made in batches and kept in the Python worker; starts
    anew when full, so its memory is bounded by one Arrow batch and `entries` rows."""

    def __init__(self, make: Callable[[list[str]], np.ndarray], entries: int = TABLE_WORDS):
        self.make, self.entries = make, entries
        self.index: dict[str, int] = {}
        self.rows: np.ndarray | None = None

    def learn(self, texts: Iterable[str | None]) -> None:
        """Make the rows of all words of these texts."""
        if len(self.index) > self.entries:
            self.index, self.rows = {}, None
        missing: set[str] = set()
        for text in texts:
            if text:
                missing |= set(text.split()).difference(self.index)
        if missing:
            words = sorted(missing)
            new = self.make(words)
            self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
            self.rows = new if self.rows is None else np.concatenate((self.rows, new))

    def at(self, text: str) -> np.ndarray:
        """Row numbers of the words of a learnt text, in order; equal words have equal numbers."""
        words = text.split()
        return np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))

    def of(self, text: str) -> np.ndarray:
        """Rows of the words of a learnt text, in order."""
        return self.rows[self.at(text)]


#: What a Python worker keeps between tasks: one entry, by operator and parameters.
_worker: dict = {}


def worker_state(key, make: Callable):
    """A per-worker singleton. Only the latest is kept, so a long-lived worker doesn't gather caches of several operators."""
    if key not in _worker:
        _worker.clear()
        _worker[key] = make()
    return _worker[key]


def forget() -> None:
    """Drop what an earlier operator left in this worker; for operators that keep nothing there."""
    _worker.clear()


@contextmanager
def without_gc() -> Iterator[None]:
    """No garbage collection while a block is worked on: no cycles arise there, and scans of large caches take longer than the work."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return to the system what is free in this worker: its allocators hold it otherwise, beside the executor's heap and through all stages."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def text_blocks(stream: Iterable[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most BLOCK_DOCS rows and BLOCK_BYTES bytes of the texts (or elements of the arrays) in
    column `at`, a row at least."""
    for batch in stream:
        size = pc.list_value_length if pa.types.is_list(batch.schema.types[at]) else pc.binary_length
        total = np.cumsum(pc.fill_null(size(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = total[first - 1] if first else 0
            fits = int(np.searchsorted(total, before + BLOCK_BYTES, side="right"))
            last = max(first + 1, min(fits, first + BLOCK_DOCS))
            yield batch.slice(first, last - first)
            give_back()
            first = last


def batches(make_rows: Callable[[pa.RecordBatch], dict], schema: pa.Schema, text_at: int = 1) -> Callable:
    """A mapInArrow function from one that turns a block into columns; `text_at` is the column of the texts."""

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(stream, text_at):
            with without_gc():
                cols = make_rows(batch)
                out = pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in schema], schema=schema)
            yield out

    return run


#: Types of added columns: DDL name -> Arrow type.
ADDED = {"double": pa.float64(), "long": pa.int64(), "string": pa.string()}


def add_from_text(df: DataFrame, text_col: str, make: Callable[[list[str | None]], dict], added: dict[str, str]) -> DataFrame:
    """`df` with columns that `make` gives for a batch of texts; columns of the same names are replaced. Rows stay where
    they are, so a decision on the new columns needs no join."""
    df = df.drop(*added)
    at = df.columns.index(text_col)

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(stream, at):
            with without_gc():
                new = make(batch.column(at).to_pylist())
                out = pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(new[c], type=ADDED[t]) for c, t in added.items()]], names=[*batch.schema.names, *added])
            yield out

    schema = T.StructType([*df.schema.fields])
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return df.mapInArrow(run, schema)
