"""Error severities and the crop-export job."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyslip.operators import crops, detections, errors
from tallyslip.plans import queries

SF = "/root/testdata/sf0.001"


def test_the_same_first_error_whatever_the_partitions(spark):
    rows = [(i, p, ["score"] if i == 17 and p == 2 else ["width"] if i > 17 else []) for i in range(40) for p in range(4)]
    df = spark.createDataFrame(rows, "image_id int, pos int, violations array<string>")
    for n in (1, 3, 16):
        good, bad = detections.route_errors(df.repartition(n).orderBy(F.rand(n)), fail_fast=True)
        assert bad.count() == 1 + 22 * 4
        with pytest.raises(PySparkException, match="ValueError: score"):
            good.collect()
    good, _ = detections.route_errors(df.filter("image_id < 17"), fail_fast=True)
    assert good.count() == 17 * 4


def test_safety_errors_end_the_job_in_any_case(spark):
    rows = spark.createDataFrame([(0, None, None), (1, "ValueError", "bad row"), (2, None, None)], "pos int, error_type string, message string")
    unsafe = spark.createDataFrame([(5, "UnsafeOutput", "second"), (2, "UnsafeOutput", "overlaps a source")], "pos int, error_type string, message string")
    good, bad = errors.split_batch(rows, ["pos"])
    assert good.count() == 2 and bad.count() == 1
    for frame in errors.split_batch(rows, ["pos"], unsafe):
        with pytest.raises(PySparkException, match="UnsafeOutput: overlaps a source"):
            frame.collect()
    with pytest.raises(PySparkException, match="ValueError: bad row"):  # it comes before the safety error
        errors.split_batch(rows, ["pos"], unsafe, continue_on_error=False)[0].collect()
    assert errors.split_batch(rows, ["pos"], unsafe.limit(0))[0].count() == 2
    assert errors.first_error(unsafe.limit(0), "pos").first()["message"] is None


def test_overlapping_outputs_and_other_configs_end_the_job(spark):
    from tallyslip.operators import batch

    rows = spark.createDataFrame([(0, None, None)], "pos int, error_type string, message string")
    outputs, sources = spark.createDataFrame([("in/a",)], "image_id string"), spark.createDataFrame([("in/a/b.png",)], "image_id string")
    over = batch.overlapping_paths(outputs, sources).select(F.lit(0).alias("pos"), F.lit("UnsafeOutput").alias("error_type"), F.col("path").alias("message"))
    with pytest.raises(PySparkException, match="UnsafeOutput: in/a"):
        errors.split_batch(rows, ["pos"], over)[0].collect()
    other = batch.config_mismatches(spark.createDataFrame([("m", 0.2)], "model string, margin double"), {"model": "m", "margin": 0.3}).filter("NOT same")
    other = other.select(F.lit(0).alias("pos"), F.lit("ConfigurationError").alias("error_type"), F.lit("made under another config").alias("message"))
    with pytest.raises(PySparkException, match="ConfigurationError"):
        errors.split_batch(rows, ["pos"], other)[0].collect()


@pytest.fixture(scope="module")
def export(spark):
    from tallyslip.plans.fixtures import fixture

    photos = fixture(spark, SF, "fx_photos").join(fixture(spark, SF, "fx_paths").select("page_id", "mtime"), "page_id")
    sources = photos.select(F.concat(F.lit("/photos/"), "image_id").alias("source"), F.col("w").alias("width"), F.col("h").alias("height"), "mtime").cache()
    results = fixture(spark, SF, "fx_results").select("result_json", "value", "mtime").cache()
    cohort, inventory = fixture(spark, SF, "fx_cohort").cache(), fixture(spark, SF, "fx_crops").cache()
    return lambda last=cohort, **o: crops.export_crops(results, sources, last, inventory, **o), cohort


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_a_second_run_changes_nothing(export):
    run, cohort = export
    first, _, bad = run()
    again, _, still_bad = run(first.drop("label"))
    assert as_set(first) == as_set(again)
    old = {r["result_json"] for r in cohort.collect()}
    assert old <= {r["result_json"] for r in first.collect()} and {r["result_json"] for r in bad.collect()} & old
    before, after = as_set(bad.drop("generation", "place")), as_set(still_bad.drop("generation", "place"))
    members = {r["result_json"].lower() for r in first.collect()}
    assert after <= before and {path.lower() for path, _, _ in before - after} <= members  # a member in other case stands for them now
    kept = {r["result_json"]: r["crop"] for r in first.collect()}
    failed = {r["result_json"] for r in bad.collect()} & old
    assert all(kept[r["result_json"]] == r["crop"] for r in cohort.collect() if r["result_json"] in failed)  # their former record


def test_limits_count_records_in_order(export):
    run, cohort = export
    frozen = cohort.count()
    everything = [tuple(r) for r in run()[0].orderBy(*crops.ORDER).collect()]
    assert len(everything) > frozen + 3
    for limit in (frozen, frozen + 3, len(everything), len(everything) + 5):
        records, plan, bad = run(limit=limit)
        assert [tuple(r) for r in records.orderBy(*crops.ORDER).collect()] == everything[:limit]
        last = everything[:limit][-1][:2]
        assert all(limit >= len(everything) or (r["generation"], r["place"]) <= last for r in bad.collect())
    for wrong in (0, frozen - 1):
        with pytest.raises(ValueError):
            run(limit=wrong)


def test_without_continuing_the_first_error_ends_it(spark, export):
    run, _ = export
    first = queries.QUERIES["first_error"](spark, SF).first()
    records, _, _ = run(continue_on_error=False)
    with pytest.raises(PySparkException) as e:
        records.collect()
    assert f"{first['error_type']}: {first['message']}" in str(e.value)
    empty = run(spark.createDataFrame([], "generation long, place string, crop string, source string, result_json string, group_id string"))[0]
    assert {r["generation"] for r in empty.collect()} == {0}
