"""SimHash near-dedup with pigeonring filtering.

The 64 bits lie in a ring of `SEGMENTS` segments. If two fingerprints differ in at most `max_bits` bits, some
segment starts a chain around the ring in which the first l segments differ in at most
l * max_bits / SEGMENTS bits together, for every l. With 5 segments and 4 bits: the first segment is equal,
the first two differ in at most one bit, and so on. The first two conditions are the join key: the segment
itself and the next one with one bit left out (one key per bit left out). Rows of a key meet in one sorted run; there the longer
chains and then the full Hamming distance are checked. Equal fingerprints are one row from the start.

A run gives a spanning tree of its linked fingerprints with a bounded fan-out, never all pairs. Keys with
more than `block_rows` fingerprints are dealt in blocks, and every pair of blocks meets in a run of its own; where that
were more copies than the 78 keys of the chain's third segment (two bits left out), those part the key first.

Defined results: null text is an empty document; no words: fingerprint zero, which links like any other.
Very long texts are hashed whole, in slices. Repeated rows give repeated results with one component; null ids have
fingerprints and a component (the smallest id that isn't null, else null). Extra columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyslip.llm.common import batches, components, discard, forget, materialize, text_blocks
from tallyslip.llm.tiles import thinned, tree, whole_runs

SEGMENTS, MAX_BITS = 5, 4
#: (lowest bit, width) of each segment.
LAYOUT = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
BLOCK_ROWS = 4096
FAN_OUT = 32
SEED = 42
#: Shingles whose bits are in memory at once.
SLICE = 8192


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The XXH64 of every shingle in order, repeats included; fewer words than a shingle are one."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z and only ASCII white space
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    stops = list(itertools.accumulate(len(w) + 1 for w in words))
    k, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip([0, *stops], stops[k - 1 :])], dtype="<u8")


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How often each bit is 1, over rows of 64-bit words."""
    total = np.zeros(64 * hashes.shape[1], dtype=np.int64)
    for at in range(0, len(hashes), SLICE):
        part = np.ascontiguousarray(hashes[at : at + SLICE])
        total += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return total


def simhash(text: str | None, shingle: int) -> np.ndarray:
    """The fingerprint, one 64-bit word: bit b is 1 if it is 1 in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, shingle)
    return np.packbits(_ones(hashes[:, None]) * 2 > len(hashes), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) per row."""
    id_type = docs.schema[id_col].dataType

    def make(batch: pa.RecordBatch) -> dict:
        prints = np.concatenate([simhash(t, shingle) for t in batch.column(1).to_pylist()])
        return {"id": batch.column(0), "fp": prints.view(np.int64)}

    schema = pa.schema([("id", to_arrow_type(id_type)), ("fp", pa.int64())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches(make, schema), f"id {id_type.simpleString()}, fp long").withColumnRenamed("id", id_col)


def _bits(fp, low: int, width: int):
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: str):
    """Chain keys of a fingerprint: start, bit left out, the first segment and the rest of the next one."""
    out = []
    for start in range(SEGMENTS):
        first, (low, width) = _bits(F.col(fp), *LAYOUT[start]), LAYOUT[(start + 1) % SEGMENTS]
        second = _bits(F.col(fp), low, width)
        for bit in range(width):
            kept = second.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            out.append(F.lit((start * 16 + bit) << 26).bitwiseOR(F.shiftleft(first, 13)).bitwiseOR(kept))
    return F.array(*out)


_BIT_COUNT = np.bitwise_count
_MASKS = [np.uint64(((1 << w) - 1) << low) for low, w in LAYOUT]


def linked(one: np.ndarray, other: np.ndarray, start: int) -> np.ndarray:
    """Whether fingerprints link, by chains from `start` and the full distance at last."""
    apart = one ^ other
    total = np.zeros(apart.shape, dtype=np.int64)
    good = np.ones(apart.shape, dtype=bool)
    for length in range(1, SEGMENTS + 1):
        total += _BIT_COUNT(apart & _MASKS[(start + length - 1) % SEGMENTS])
        good &= total * SEGMENTS <= length * MAX_BITS
        if not good.any():
            break
    return good


def tree_links(prints: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that join what is linked within a run, each member to its parent in a tree of fan-out FAN_OUT."""
    links, left = [], prints
    while len(left) > 1:
        group, left = [left[:1]], left[1:]
        front = 0
        found = list(group[0])
        while front < len(found) and len(left):
            near = linked(left, found[front], start)
            if near.any():
                found.extend(left[near])
                left = left[~near]
            front += 1
        links.extend((int(np.int64(found[(i - 1) // FAN_OUT])), int(np.int64(found[i]))) for i in range(1, len(found)))
    return links


def _runs(stream: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole runs of equal (key, pair): arrays of keys and fingerprints, a run never split between two yields."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in stream:
        new = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(new[0]):
            continue
        held.append(new)
        if held[0][0][0] == new[0][-1] and held[0][1][0] == new[1][-1]:
            continue  # still the same run
        key, pair, fp = (np.concatenate(x) for x in zip(*held))
        last = np.flatnonzero((key != key[-1]) | (pair != pair[-1]))[-1] + 1
        yield key[:last], pair[:last], fp[:last]
        held = [(key[last:], pair[last:], fp[last:])]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _link_runs(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, pair, fp in _runs(stream):
        prints = fp.view(np.uint64)
        edge = np.flatnonzero((key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
        starts, stops = np.concatenate(([0], edge)), np.concatenate((edge, [len(key)]))
        sizes = stops - starts
        a, b = [], []
        two = starts[sizes == 2]
        for start in range(SEGMENTS):
            at = two[(key[two] >> 30) == start]
            good = at[linked(prints[at], prints[at + 1], start)]
            a.append(fp[good])
            b.append(fp[good + 1])
        for i in np.flatnonzero(sizes > 2):
            if links := tree_links(prints[starts[i] : stops[i]], int(key[starts[i]] >> 30)):
                x, y = np.array(links, dtype=np.int64).T
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})


#: Bits of a third segment that its key leaves out: the first three segments differ in at most two bits together.
DEEPER = [((1 << 13) - 1) & ~(1 << i) & ~(1 << j) for i, j in itertools.combinations(range(13), 2)]


def _deeper(fp: str, key: str):
    """The third segment of a chain, numbered by the two bits that are left out."""
    start, values = F.shiftrightunsigned(key, 30), [_bits(F.col(fp), *LAYOUT[(s + 2) % SEGMENTS]) for s in range(SEGMENTS)]
    third = reduce(lambda out, s: F.when(start == s, values[s]).otherwise(out), range(1, SEGMENTS), values[0])
    return F.transform(F.lit(DEEPER), lambda mask, i: F.shiftleft(i.cast("long") + 1, 13).bitwiseOR(third.bitwiseAND(mask)))


def _block_pairs(blocks, fp: str):
    """The runs of a fingerprint whose key is dealt in `blocks`: block x meets block y in the run x * blocks + y, x <= y."""
    own = F.pmod(F.xxhash64(fp), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.least(i, own).cast("long") * blocks + F.greatest(i, own))
    return F.when(blocks > 1, meets).otherwise(F.array(F.lit(0).cast("long")))


def near_links(prints: DataFrame, block_rows: int = BLOCK_ROWS, most_blocks: int = len(DEEPER)) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`: what they connect is what all pairs within
    MAX_BITS bits connect. A key of more than `most_blocks` blocks is cut by the chain's third segment first."""
    keys = prints.select("fp", F.explode(_keys("fp")).alias("key"))
    # a key's rows are those of two values of (segment, next segment); the counts of these few cells tell
    # which keys are large, without counting every key
    cells = [
        F.lit(s << 26).bitwiseOR(F.shiftleft(_bits(F.col("fp"), *LAYOUT[s]), 13)).bitwiseOR(_bits(F.col("fp"), *LAYOUT[(s + 1) % SEGMENTS]))
        for s in range(SEGMENTS)
    ]
    large = prints.select(F.explode(F.array(*cells)).alias("cell")).groupBy("cell").count().filter(F.col("count") > block_rows // 2)
    masks = [(bit, ((1 << 26) - 1) & ~(1 << bit)) for bit in range(13)]
    start = F.shiftrightunsigned("cell", 26)
    of_cell = F.array(*[F.shiftleft(start * 16 + bit, 26).bitwiseOR(F.col("cell").bitwiseAND(F.lit(mask))) for bit, mask in masks])
    hot = large.select(F.explode(of_cell).alias("key"), "count").groupBy("key").agg(F.sum("count").alias("n"))
    hot = materialize(hot.select("key", F.ceil(F.col("n") / (block_rows // 2)).cast("int").alias("blocks")))
    keys = keys.join(hot, "key", "left") if hot.limit(1).count() else keys.withColumn("blocks", F.lit(None).cast("int"))
    usual = F.coalesce(F.col("blocks") <= most_blocks, F.lit(True))
    rows = keys.filter(usual).select("key", F.explode(_block_pairs(F.col("blocks"), "fp")).alias("pair"), "fp")
    if hot.filter(F.col("blocks") > most_blocks).limit(1).count():
        deep = materialize(keys.filter(~usual).select("key", F.explode(_deeper("fp", "key")).alias("sub"), "fp"))
        sizes = deep.groupBy("key", "sub").agg(F.ceil(F.count(F.lit(1)) / (block_rows // 2)).cast("int").alias("blocks"))
        deep = deep.join(sizes.filter("blocks > 1"), ["key", "sub"], "left")
        deep = deep.select("key", "sub", F.explode(_block_pairs(F.col("blocks"), "fp")).alias("pair"), "fp")
        rows = rows.unionByName(deep.select("key", F.shiftleft("sub", 40).bitwiseOR(F.col("pair")).alias("pair"), "fp"))
    runs = rows.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return runs.mapInArrow(_link_runs, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, fingerprint, component_id) per row."""
    of_docs = materialize(fingerprints(docs, shingle, id_col, text_col))
    distinct = materialize(of_docs.groupBy("fp").agg(F.min(id_col).alias("least")))
    classes = components(near_links(distinct.select("fp"), block_rows))
    # the least id of a class: by its fingerprints' least ids
    members = distinct.join(classes.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = materialize(members.select("fp", "component").join(least, "component").select("fp", "component_id"))
    return of_docs.join(of_print, "fp", "left").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Similar documents: 64-bit lanes of the wide fingerprint; each lane also gives a min-wise value of the shingles.
LANES = 16
#: Shingles of similar documents.
SIMILAR_SHINGLE = 5
#: Fingerprints compared in one run; length of chains at which larger buckets are cut in blocks; expected pivots of those.
RUN_ROWS, CHAIN, PIVOTS = 1024, 3, 32
#: Chains: offsets of their lanes in the ring of lanes, and the step between the lanes where they start; 16 and 8 chains. Two of them share few
#: lanes, so that they miss a pair more independently than neighbours do. A pair whose shared lanes all lie in large buckets has to share a whole
#: chain: at a Jaccard similarity of 0.68 it misses all of two lanes with probability 0.001, all of three with 0.009.
CHAINS = (((0, 2, 6), 1), ((0, 7, 15), 2))


def sketch(hashes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Of a set of hashes the wide SimHash, each shingle voting once, and the smallest value in each lane (a multiply-xorshift
    finisher of the hashes, another constant per lane)."""
    ones, least = np.zeros(64 * LANES, dtype=np.int64), np.full(LANES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), SLICE):
        with np.errstate(over="ignore"):
            h = hashes[at : at + SLICE, None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(1, LANES + 1, dtype=np.uint64)
            h ^= h >> np.uint64(30)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(27)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
        ones += _ones(h)
        least = np.minimum(least, h.min(axis=0))
    return np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), least


def similar_pairs(one: np.ndarray, other: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of wide fingerprints (rows of LANES words) that differ in at most `most` bits."""
    if len(one) * len(other) <= 4096:
        apart = np.bitwise_count(one[:, None, :] ^ other[None, :, :]).sum(axis=2, dtype=np.int32)
    else:
        a, b = (np.unpackbits(x.view(np.uint8), axis=1).astype(np.float32) * 2 - 1 for x in (one, other))
        apart = (a.shape[1] - a @ b.T) / 2  # sums of +-1 are exact
    return np.nonzero(apart <= most)


def _similar_runs(runs: DataFrame, most: int) -> DataFrame:
    """Links (a, b) over what is similar within each run of equal `run`; rows (run, side, rep, print) come sorted by run. Rows of
    side 0 are compared with each other, rows of side 1 with those of side 2."""

    def linked_run(side: np.ndarray, rep: np.ndarray, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        if side.any():
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
            i, j = similar_pairs(prints[left], prints[right], most)
            i, j = left[i], right[j]
        else:
            i, j = similar_pairs(prints, prints, most)
        apart = rep[i] != rep[j]
        for p, q in tree(len(rep), *thinned(len(rep), i[apart], j[apart])):
            yield int(rep[p]), int(rep[q])

    def link(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_runs(stream):
            run = batch.column(0).to_numpy()
            side, rep = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            prints = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="<u8").reshape(-1, LANES)
            edge = np.flatnonzero(run[1:] != run[:-1]) + 1
            first, stop = np.append(0, edge), np.append(edge, len(run))
            two = first[(stop - first == 2) & (side[first] == 0)]
            near = two[np.bitwise_count(prints[two] ^ prints[two + 1]).sum(axis=1, dtype=np.int32) <= most]
            pairs = list(zip(rep[near].tolist(), rep[near + 1].tolist()))
            for a, b in zip(first.tolist(), stop.tolist()):
                if b - a > 2 or b - a == 2 and side[a]:
                    pairs.extend(linked_run(side[a:b], rep[a:b], prints[a:b]))
            yield pa.RecordBatch.from_pydict({"a": pa.array([p for p, _ in pairs], pa.int64()), "b": pa.array([q for _, q in pairs], pa.int64())})

    dealt = runs.select("run", "side", "rep", "print").repartition("run").sortWithinPartitions("run", "side", "rep")
    return dealt.mapInArrow(link, "a long, b long")


def _buckets(sketches: DataFrame, run_rows: int, chain: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(run, rep) of buckets of 2 to `run_rows` rows, (run, rep, n) of larger ones, and the tables that these read: rows meet that share a lane's smallest value; a
    larger bucket is parted by a further lane, in CHAINS of at most `chain` lanes (three)."""
    small, large, written = [], None, []
    for length in range(1, min(chain, len(CHAINS[0][0])) + 1):
        if length == 1:
            member = sketches.select("rep", F.posexplode("least").alias("start", "run"))
            member = member.select("rep", "start", F.xxhash64("start", "run").alias("run"))
        else:
            if length == 2:
                begun = F.array(*[F.when(F.col("start") % step == 0, F.lit(k)) for k, (_, step) in enumerate(CHAINS)])
                large = large.withColumn("kind", F.explode(F.array_compact(begun)))
            offset = F.element_at(F.array(*[F.lit(lanes[length - 1]) for lanes, _ in CHAINS]), F.col("kind") + 1)
            lane = F.col("least")[(F.col("start") + offset) % LANES]
            member = large.join(sketches.select("rep", "least"), "rep").select("rep", "start", "kind", F.xxhash64("run", "kind", lane).alias("run"))
        counts = materialize(member.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        shared = materialize(member.join(counts, "run"))
        discard(counts)
        written.append(shared)
        small.append(shared.filter(F.col("n") <= run_rows).select("run", "rep"))
        large = shared.filter(F.col("n") > run_rows)
        if not large.limit(1).count():
            break
    return reduce(DataFrame.unionByName, small), large, written


#: Least number of blocks in which links are thinned, and links of a block.
LINK_BLOCKS, BLOCK_LINKS = 8, 500_000


def _forests(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b), of every BLOCK_LINKS read only a forest that joins the same."""

    def forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = np.concatenate([batch.column(c).to_numpy() for c in (0, 1) for batch in held])
        ids, at = np.unique(ends, return_inverse=True)
        links = np.array(list(tree(len(ids), *thinned(len(ids), *np.split(at, 2)))), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_pydict({"a": ids[links[:, 0]], "b": ids[links[:, 1]]})

    held: list[pa.RecordBatch] = []
    for batch in stream:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK_LINKS:
            yield forest(held)
            held = []
    if held:
        yield forest(held)


def ring_groups(sketches: DataFrame) -> DataFrame:
    """(run, rep, n) of the groups of two and more rows that pigeonring chains over `fp` (near_links) connect: whatever differs in at most
    MAX_BITS bits of it is in one group."""
    links = materialize(near_links(materialize(sketches.select("fp").distinct())))
    # a group of many prints comes with a tree from each of its keys; a tree per block of links joins the same
    blocks = max(LINK_BLOCKS, math.ceil(links.count() / BLOCK_LINKS))
    of_print = components(links.coalesce(blocks).mapInArrow(_forests, "a long, b long")).withColumnRenamed("id", "fp")
    discard(links)
    group = F.xxhash64(F.lit(7), F.coalesce("component", "fp")).alias("run")
    member = materialize(sketches.select("rep", "fp").join(of_print, "fp", "left").select("rep", group))
    return member.join(member.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "run").select("run", "rep", "n")


def similar_links(sketches: DataFrame, most: int, run_rows: int = RUN_ROWS, chain: int = CHAIN) -> DataFrame:
    """`sketches`: rep long, print binary, fp long (the first 64 bits of print), least array of LANES longs. (id, component) of all reps
    that some pair of fingerprints with at most `most` different bits connects, of those pairs that meet in a bucket.

    Buckets are first the groups of the pigeonring join, in which all pairs within MAX_BITS of 64 bits meet, then those of the lanes, which
    reach the pairs from there to the bar.
    Buckets that stay large hold texts that agree in whole chains of lanes, so mostly one group. They are cut in blocks;
    every block also gets the bucket's few pivots, which join what is one group over all blocks at a cost that grows with the bucket.
    Then what isn't in the bucket's main group meets all blocks, so no pair of the bucket goes unseen."""
    prints = sketches.select("rep", "print")
    small, large, written = _buckets(sketches, run_rows, chain)
    ring = materialize(ring_groups(sketches))
    written.append(ring)
    small = small.unionByName(ring.filter(F.col("n") <= run_rows).select("run", "rep"))
    large = large.select("run", "rep", "n").unionByName(ring.filter(F.col("n") > run_rows))
    links = materialize(_similar_runs(small.join(prints, "rep").withColumn("side", F.lit(0)), most))
    if not large.limit(1).count():
        discard(*written)
        return components(links)
    blocks = F.ceil(F.col("n") / run_rows).cast("int")
    large = materialize(large.select("run", "rep", blocks.alias("blocks"), (F.pmod(F.xxhash64(F.lit(3), "rep"), F.ceil(F.col("n") / PIVOTS)) == 0).alias("pivot")))
    discard(*written)
    large = large.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = large.select("run", "rep", F.explode(F.when(F.col("pivot"), every).otherwise(F.array("block"))).alias("block"))
    dealt = dealt.select(F.xxhash64("run", "block").alias("run"), "rep", F.lit(0).alias("side"))
    links = materialize(links.unionByName(_similar_runs(dealt.join(prints, "rep"), most)))
    found = components(links)
    labelled = large.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = materialize(labelled)
    of_run = materialize(labelled.groupBy("run", "component").count())
    main = of_run.groupBy("run").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.sum("count").alias("n"), F.max("count").alias("most"))
    main = materialize(main.filter("most < n").select("run", "main", F.ceil((F.col("n") - F.col("most")) / (run_rows / 2)).cast("int").alias("parts")))
    if not main.limit(1).count():
        return found
    rest = materialize(labelled.join(main, "run"))
    parts = F.sequence(F.lit(0), F.col("parts") - 1)
    part = F.pmod(F.xxhash64(F.lit(5), "rep"), F.col("parts")).cast("int")
    residents = rest.select("run", "block", F.explode(parts).alias("part"), "rep", F.lit(2).alias("side"))
    guests = rest.filter("component != main").select("run", F.explode(every).alias("block"), part.alias("part"), "rep", F.lit(1).alias("side"))
    meet = residents.unionByName(guests).select(F.xxhash64("run", "block", "part").alias("run"), "rep", "side")
    more = _similar_runs(meet.join(prints, "rep"), most)
    return components(materialize(links.unionByName(more)))


def similar_rows(docs: DataFrame, similarity: float = 0.8, shingle: int = SIMILAR_SHINGLE, text_col: str = "text", run_rows: int = RUN_ROWS, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """`docs` with a number `_row` for each row, written once, and (_row, _group): what pairs of similar texts connect.

    Texts are similar if their SimHash fingerprints, of LANES * 64 bits over the distinct shingles, agree in at least `similarity` of the
    bits; at 0.8 that is a cosine of 0.81 between the shingle sets. Equal sets are one from the start. Candidates are what pigeonring
    chains over the first 64 bits connect (all pairs within MAX_BITS of them), and what shares the smallest value of a lane, or keys of
    chains of lanes where buckets are large; each candidate is decided by its full distance."""
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    at = numbered.columns.index(text_col)

    def make(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in text_blocks(stream, at):
            reps, prints, first, least = [], [], [], []
            for text in batch.column(at).to_pylist():
                hashes = np.unique(shingle_hashes(text, shingle))
                reps.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                wide, low = sketch(hashes) if len(hashes) else (None, None)
                prints.append(wide)
                first.append(None if wide is None else int.from_bytes(wide[:8], "little", signed=True))
                least.append(None if low is None else low.view(np.int64))
            new = [pa.array(np.array(reps, dtype=np.uint64).view(np.int64)), pa.array(prints, pa.binary()), pa.array(first, pa.int64()), pa.array(least, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "_rep", "_print", "_fp", "_least"])

    schema = T.StructType([*numbered.schema.fields, T.StructField("_rep", T.LongType()), T.StructField("_print", T.BinaryType()), T.StructField("_fp", T.LongType()), T.StructField("_least", T.ArrayType(T.LongType()))])
    rows = materialize(numbered.mapInArrow(make, schema))
    sketches = rows.filter("_print is not null").select(F.col("_rep").alias("rep"), F.col("_print").alias("print"), F.col("_fp").alias("fp"), F.col("_least").alias("least"))
    sketches = materialize(sketches.dropDuplicates(["rep"]))
    most = math.floor(64 * LANES * (1 - Fraction(str(similarity))))
    classes = similar_links(sketches, most, run_rows, chain)
    of_rows = rows.select("_row", F.col("_rep").alias("id")).join(classes, "id", "left")
    groups = materialize(of_rows.select("_row", F.coalesce("component", "id").alias("_group")))
    discard(sketches)
    return rows.drop("_rep", "_print", "_fp", "_least"), groups


def similar_documents(docs: DataFrame, similarity: float = 0.8, shingle: int = SIMILAR_SHINGLE, id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN_ROWS, chain: int = CHAIN) -> DataFrame:
    """(id, component_id) per row: groups of documents whose shingle sets are similar, by their smallest id."""
    rows, groups = similar_rows(docs.select(id_col, text_col), similarity, shingle, text_col, run_rows, chain)
    of_rows = materialize(rows.select("_row", id_col).join(groups, "_row"))
    least = materialize(of_rows.groupBy("_group").agg(F.min(id_col).alias("component_id")))
    return of_rows.join(least, "_group").select(id_col, "component_id")
