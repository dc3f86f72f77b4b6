"""Crop cohorts and human review labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Labels a reviewer may give.
REVIEW_LABELS = ["check_offset", "check_aligned", "check_absent", "unclear"]
# Keys of a label line.
NAMES = ["crop", "source", "result_json", "group_id", "label"]
#: Rows that a stretch of a cohort's order should hold, in which windows work, and the fewest and most stretches.
RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 1 << 20, 8, 10_000


def read_label_manifest(lines: DataFrame) -> DataFrame:
    """(line_no, line) JSON lines as columns with `violations`; values are strings, the label may be null."""
    kind = lambda c: F.schema_of_variant(F.try_variant_get(F.try_parse_json("line"), f"$.{c}", "variant"))
    row = F.from_json("line", "crop string, source string, result_json string, group_id string, label string")
    keys = F.json_object_keys("line")
    other = reduce(Column.__or__, [~F.coalesce(kind(c), F.lit("VOID")).isin("STRING", "VOID") for c in NAMES])
    out = lines.withColumns({"_k": keys, "_r": row, "_other": other}).select("line_no", "_k", "_other", "_r.*")
    blank = lambda c: F.array_contains("_k", c) & (F.coalesce(F.trim(c), F.lit("")) == "")
    checks = [
        (F.col("_k").isNull(), "not an object"),
        (F.col("_k").isNotNull() & (F.size(F.array_intersect("_k", F.array(*map(F.lit, NAMES)))) < 5), "missing key"),
        (F.col("_other"), "not a string"),
        (F.col("label").isNotNull() & ~F.col("label").isin(REVIEW_LABELS), "label"),
        (blank("crop") | blank("source") | blank("result_json") | blank("group_id"), "blank"),
        ((F.row_number().over(Window.partitionBy(F.lower("result_json")).orderBy("line_no")) > 1) & F.col("result_json").isNotNull(), "repeated"),
    ]
    return out.withColumn("violations", F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in checks])), ",")).drop("_k", "_other")


def merge_review_labels(manifest: DataFrame, reviewed: DataFrame) -> DataFrame:
    """A reviewed row replaces the label, even by null; keys match regardless of case."""
    r = reviewed.select(F.lower("result_json").alias("_key"), F.col("label").alias("_label"), F.lit(True).alias("_hit"))
    out = manifest.join(r, F.lower("result_json") == F.col("_key"), "left")
    return out.withColumn("label", F.when(F.col("_hit"), F.col("_label")).otherwise(F.col("label"))).drop("_key", "_label", "_hit")


def orphan_labels(reviewed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Reviewed keys that the manifest lacks."""
    keys = manifest.select(F.lower("result_json").alias("_key"))
    return reviewed.select(F.lower("result_json").alias("result_json")).join(keys, F.col("result_json") == F.col("_key"), "left_anti")


def require_no_orphans(reviewed: DataFrame, manifest: DataFrame) -> DataFrame:
    """`reviewed`, unless it has keys that the manifest lacks: then the job ends and names the smallest."""
    lost = orphan_labels(reviewed, manifest).agg(F.min("result_json").alias("_lost"))
    rows = reviewed.crossJoin(F.broadcast(lost))  # one row
    good = F.when(F.col("_lost").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("label of an unknown result: "), "_lost")).cast("boolean"))
    return rows.filter(good).drop("_lost")


def extend_cohort(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The frozen cohort, labels nulled, then results it lacks; is_new and key order them."""
    have = existing.select(F.lower("result_json").alias("_key"))
    fresh = new.join(have, F.lower("result_json") == F.col("_key"), "left_anti").select("result_json", F.lit(True).alias("is_new"))
    out = existing.select("result_json", F.lit(False).alias("is_new")).unionByName(fresh)
    return out.withColumns({"key": F.sha2("result_json", 256), "label": F.lit(None).cast("string")})


def review_progress(df: DataFrame) -> DataFrame:
    """Counts of the four labels, zeros shown, and of what remains."""
    names = df.sparkSession.createDataFrame([(n,) for n in [*REVIEW_LABELS, "remaining"]], "label string")
    counts = df.groupBy(F.coalesce("label", F.lit("remaining")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Keys that repeat regardless of case, with the position of the first repeat."""
    rank = F.row_number().over(Window.partitionBy(F.lower("result_json")).orderBy("ord"))
    again = df.withColumn("_n", rank).filter("_n > 1")
    return again.groupBy(F.lower("result_json").alias("result_json")).agg(F.min("ord").alias("first_repeat"), (F.count(F.lit(1)) + 1).alias("n"))


def _in_ranges(df: DataFrame) -> DataFrame:
    """`df` with `_range`: in which of some stretches of `ord`, of about RANGE_ROWS rows each, a row lies. Windows within (cohort,
    _range) never see a whole cohort; what lies between ranges is carried over by their few totals."""
    ranges = min(MOST_RANGES, max(LEAST_RANGES, df.count() // RANGE_ROWS))
    bounds = df.agg(F.percentile_approx("ord", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    edges = F.from_json(F.lit(str(sorted(set(bounds or [])))), "array<bigint>")
    return df.withColumn("_range", F.size(F.filter(edges, lambda b: b < F.col("ord"))))


def _with_totals(df: DataFrame, totals: DataFrame, *values: str) -> DataFrame:
    """`df` with the values of its cohort and range; cohorts may be null."""
    own = totals.select(F.col("cohort").alias("_c"), F.col("_range").alias("_r"), *values)
    return df.join(own, F.col("cohort").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r"))).drop("_c", "_r")


def next_unlabelled(df: DataFrame) -> DataFrame:
    """Per row of a cohort the next row without a label, from the start again after the end; null if all have one."""
    rows = _in_ranges(df).withColumn("_open", F.when(F.col("label").isNull(), F.col("ord")))
    by_range = Window.partitionBy("cohort").orderBy("_range")
    totals = rows.groupBy("cohort", "_range").agg(F.min("_open").alias("_least"))
    totals = totals.withColumns({
        "_later": F.min("_least").over(by_range.rowsBetween(1, Window.unboundedFollowing)), "_first": F.min("_least").over(Window.partitionBy("cohort")),
    })
    back = Window.partitionBy("cohort", "_range").orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    rows = _with_totals(rows.withColumn("_near", F.last("_open", ignorenulls=True).over(back)), totals, "_later", "_first")
    return rows.withColumn("next_ord", F.coalesce("_near", "_later", "_first")).drop("_range", "_open", "_near", "_later", "_first")


def review_position(df: DataFrame) -> DataFrame:
    """`position`: a row's number in its cohort by `ord`, and the cohort's size."""
    rows = _in_ranges(df)
    before = Window.partitionBy("cohort").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("cohort", "_range").agg(F.count(F.lit(1)).alias("_n"))
    totals = totals.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_all": F.sum("_n").over(Window.partitionBy("cohort"))})
    index = F.row_number().over(Window.partitionBy("cohort", "_range").orderBy("ord"))
    rows = _with_totals(rows.withColumn("_index", index), totals, "_before", "_all")
    position = F.concat_ws("/", (F.col("_index") + F.col("_before")).cast("string"), F.col("_all").cast("string"))
    return rows.withColumn("position", position).drop("_range", "_index", "_before", "_all")


def limit_valid(df: DataFrame, n: int, frozen: int = 0) -> DataFrame:
    """The first n rows that have a label, by key: unlike a cohort's limit it counts valid rows. `frozen`: rows that the cohort has
    already, which the limit must hold."""
    if n < 1:
        raise ValueError("the limit must be positive")
    if n < frozen:
        raise ValueError(f"the limit is below the {frozen} rows of the cohort")
    return df.filter(F.col("label").isNotNull()).withColumn("key", F.sha2("result_json", 256)).orderBy("key", "result_json").limit(n)
