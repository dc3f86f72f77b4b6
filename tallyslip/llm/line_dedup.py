"""Line dedup over levelled sorted runs of line hashes.

Only DataFrame functions. Documents come in batches by falling id. A batch counts, per line key, in how many documents it is and in
which largest one, anti-joins the runs that are there (merge joins) to leave out what they have settled, and adds the rest as a run of its
own, sorted by the hash. Two runs of a level are compacted into one of the next, by a merge join. As ids fall, a key that a run holds in
`least_docs` documents is settled: its last holder is known, and later batches neither count nor store it, however often it comes. What is
left of the runs is merged once, and lines of settled keys go, but for the largest document holding them.

A key is a line without white space at its ends, A-Z lower-cased; it counts if it has `least_chars` code points. Two 64-bit hashes stand
for it. Defined results: null text: one empty line. Rows with equal ids are one document in counts, all rows with a null id too, below
every other id; each row keeps its own result, so rows of the largest id all keep their lines. Lines repeated in a document stay or go
together. Ties can't arise. A text whose lines all go becomes empty. Very long texts: their lines are rows. Empty table: empty result.
Extra columns pass through; `n_lines` and `n_dropped` of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.common import discard, materialize

LEAST_CHARS, LEAST_DOCS = 20, 3
#: Batches by falling id.
BATCHES = 4
#: What is stripped, and the letters that are lower-cased.
SPACES, UPPER, LOWER = " \t\n\x0b\x0c\r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["_h1", "_h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line stripped and A-Z lower-cased; `lower` is the faster way for pure ASCII."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class Runs:
    """Levelled runs of (hash, documents holding it, largest of them), each a written table sorted by the hash within its parts."""

    def __init__(self, least_docs: int):
        self.least_docs, self.levels = least_docs, []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Anti-join the settled keys of every run, add what is left, compact full levels."""
        for run in self.all():
            batch = batch.join(run.filter(F.col("_n") >= self.least_docs).select(*HASH).hint("merge"), HASH, "left_anti")
        new, level = materialize(batch.sortWithinPartitions(*HASH)), 0
        while level < len(self.levels) and self.levels[level]:
            new = self.compact(self.levels[level].pop(), new)
            level += 1
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(new)

    def compact(self, one: DataFrame, two: DataFrame) -> DataFrame:
        """One run of two, by a merge join."""
        other = two.withColumnsRenamed({"_n": "_n2", "_top": "_top2"})
        n = F.coalesce("_n", F.lit(0)) + F.coalesce("_n2", F.lit(0))
        both = one.join(other.hint("merge"), HASH, "full_outer").select(*HASH, n.cast("long").alias("_n"), F.greatest("_top", "_top2").alias("_top"))
        out = materialize(both.sortWithinPartitions(*HASH))
        discard(one, two)
        return out

    def compact_all(self) -> DataFrame:
        """The one run that is left of all."""
        runs = self.all()
        while len(runs) > 1:
            runs = [*runs[2:], self.compact(runs[0], runs[1])]
        self.levels = [runs]
        return runs[0]


def _batches(ids: DataFrame, n: int) -> list[Column]:
    """Conditions on `_id` for n ranges of it, largest first; null ids are in the last one."""
    edges = ids.agg(F.percentile_approx("_id", [1 - i / n for i in range(1, n)], 10_000)).first()[0] or []
    edges = sorted(set(edges), reverse=True)
    if not edges:
        return [F.lit(True)]
    out = [F.col("_id") > edges[0]]
    out += [(F.col("_id") <= a) & (F.col("_id") > b) for a, b in zip(edges, edges[1:])]
    return [*out, F.col("_id").isNull() | (F.col("_id") <= edges[-1])]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """`docs` with their kept lines as text, and `n_lines`, `n_dropped`."""
    docs = docs.drop("n_lines", "n_dropped")
    own = docs.columns
    keyed = docs.withColumns({"_id": F.col(id_col), "_of": F.xxhash64(text_col)})
    exploded = keyed.select("_id", "_of", F.posexplode(lines_of(F.col(text_col))).alias("_pos", "_line")).withColumn("_key", line_key(F.col("_line")))
    long = exploded.filter(F.length("_key") >= least_chars)
    lines = materialize(long.select("_id", "_of", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")))

    runs = Runs(least_docs)
    for part in _batches(lines.select("_id"), batches):
        held = lines.filter(part).groupBy("_id", *HASH).agg(F.lit(1).alias("_one"))  # documents of a hot line are counted in many tasks first
        runs.add(held.groupBy(*HASH).agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_top")))
    last = runs.compact_all()
    settled = materialize(last.filter(F.col("_n") >= least_docs).select(*HASH, "_top"))
    discard(last)

    gone = lines.join(settled, HASH).filter(~F.col("_id").eqNullSafe(F.col("_top")))
    gone = materialize(gone.groupBy(F.col("_id").alias("_gone_id"), F.col("_of").alias("_gone_of")).agg(F.collect_set("_pos").alias("_gone")))
    discard(lines, settled)
    rows = keyed.join(gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_of") == F.col("_gone_of")), "left")
    all_lines = lines_of(F.col(text_col))
    stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    counts = {"n_lines": F.size("_lines").cast("long"), "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long")}
    rows = rows.withColumn("_lines", all_lines).withColumns({**counts, "_kept": kept})
    return rows.select(*[F.col("_kept").alias(c) if c == text_col else F.col(c) for c in own], "n_lines", "n_dropped")
