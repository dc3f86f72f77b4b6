import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyslip.plans.oracles import ORACLES
from tallyslip.plans.queries import QUERIES

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        path = f"{SF}/{f}" + ("/*.parquet" if os.path.isdir(f"{SF}/{f}") else "")
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or isinstance(v, (str, bool)):
        return v
    return None if math.isnan(v) else round(float(v), 6)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in cols) for r in df.collect()], key=str)
    cursor = duck.execute(ORACLES[name])
    at = [d[0] for d in cursor.description]
    assert sorted(at) == cols
    want = sorted([tuple(plain(r[at.index(c)]) for c in cols) for r in cursor.fetchall()], key=str)
    assert got == want


def test_style_of_repeated_paths(spark, tmp_path):
    """Pages may share a url, so that an image has several bundles: each counts with its own outputs and its own style."""
    shared, own = [6, 18, 42], [30, 66, 102, 90]  # 6, 66 and 102 stand; 18 has no boxes, 42 another source and config
    pages = spark.createDataFrame([(i, f"https://a.example/{0 if i in shared else i}") for i in shared + own], "page_id long, url string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in QUERIES["is_bundle_committed_style"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.execute(ORACLES["is_bundle_committed_style"]).fetchall())
    assert len(got) == 9 + 4 and sum(c for _, c in got) == 3


def test_shards_partition_the_input(spark):
    from tallyslip.operators.batch import select_shard
    from tallyslip.plans.fixtures import fixture

    paths = fixture(spark, SF, "fx_paths")
    assert sum(select_shard(paths, i, 5).count() for i in range(5)) == paths.count()


def test_label_lines(spark):
    rows = {r["line_no"]: r["violations"] for r in QUERIES["read_label_manifest"](spark, SF).collect()}
    assert rows[0] == "not an object" and rows[1] == "missing key" and rows[2] == "label" and rows[3] == "blank"
    assert rows[4] == "" and rows[5] == "repeated" and rows[6] == ""


def test_bad_values_are_reported(spark):
    from pyspark.errors import PySparkException

    from tallyslip.operators import batch, detections, review
    from tallyslip.sources import files

    turned = spark.createDataFrame([("a", 0, 0.5, 1, 10, 20, 45)], "image_id string, degrees int, confidence double, n_lines int, w int, h int, explicit_degrees int")
    with pytest.raises(PySparkException):
        batch.choose_orientation(turned).collect()
    rows = spark.createDataFrame([("m", 0.2), ("m", None)], "model string, margin double")
    with pytest.raises(PySparkException):
        batch.require_same_config(rows, {"model": "m", "margin": 0.2}).collect()
    assert {tuple(r) for r in batch.require_same_config(rows, {"model": "n", "margin": 0.3}, overwrite=True).collect()} == {("n", 0.3)}
    carried = spark.createDataFrame([("s", None, "b", "c", "skipped_existing")], "source string, result string, annotated_rectified string, annotated_original string, status string")
    with pytest.raises(PySparkException):
        batch.union_manifests(carried)[1].collect()
    assert batch.shard_suffix(3, 8) == ".shard-003-of-008" and batch.shard_suffix(0, 1) == ""
    boxes = spark.createDataFrame([(1, 1.0, 1.0, 5.0, 5.0), (2, 5.0, 1.0, 5.0, 5.0), (3, float("nan"), 1.0, 5.0, 5.0), (4, 900.0, 900.0, 950.0, 950.0)], "pos int, x1 double, y1 double, x2 double, y2 double")
    got = {r["pos"]: (r["crop_error"], r["left"]) for r in detections.status_crop_box(boxes, 100, 100).collect()}
    assert got == {1: (None, 0), 2: ("empty box", None), 3: ("box not finite", None), 4: ("box outside the image", None)}
    lines = spark.createDataFrame([(0, '{"crop": null, "source": "s", "result_json": "r", "group_id": "g", "label": null}')], "line_no long, line string")
    assert review.read_label_manifest(lines).first()["violations"] == "blank"
    lines = spark.createDataFrame([(0, '{"crop": 5, "source": "s", "result_json": "r", "group_id": "g", "label": null}')], "line_no long, line string")
    assert review.read_label_manifest(lines).first()["violations"] == "not a string"
    known, labels = spark.createDataFrame([("A",)], "result_json string"), spark.createDataFrame([("a",)], "result_json string")
    assert review.require_no_orphans(labels, known).count() == 1
    with pytest.raises(PySparkException, match="unknown result: b"):
        review.require_no_orphans(labels.union(spark.createDataFrame([("c",), ("b",)], "result_json string")), known).collect()
    with pytest.raises(ValueError):
        review.limit_valid(known, 2, frozen=3)
    read = spark.createDataFrame([(1, 0, " a  b ", 0.5), (1, 1, " ", 0.1)], "image_id int, line_no int, text string, score double")
    got = detections.aggregate_ocr_lines(read, "image_id", images=spark.createDataFrame([(1,), (2,)], "image_id int")).orderBy("image_id").collect()
    assert [tuple(r) for r in got] == [(1, "a b", 0.3, 2), (2, "", None, 0)]
    docs = spark.createDataFrame([('{"a": {"skip": "true"}, "b": {"skip": true}}',)], "value string")
    assert {r["key"]: r["skip"] for r in files.load_corrections(docs).collect()} == {"a": False, "b": True}


def test_bundle_documents(spark):
    """Keys follow the state of a field; images without boxes have a document too; optional keys are left out."""
    import json

    from tallyslip.operators.bundles import write_bundles

    images = spark.createDataFrame([(1, 'a "b".png'), (2, None)], "image_id int, source string").selectExpr("*", "struct(10 AS width) AS geometry", "array(1D, 0D, 0D, 0D, 1D, 0D, 0D, 0D, 1D) AS to_original")
    rows = [(1, 0, "amount", 0.5, None, None), (1, 1, "amount", 0.25, " \u00a5 1,000.5 ", 0.75), (1, 2, "time", 0.5, "", 0.5), (1, 3, "payment_method_field", 1.0, None, None)]
    boxes = spark.createDataFrame(rows, "image_id int, pos int, label string, score double, text string, confidence double")
    boxes = boxes.selectExpr("*", "1.0D AS x1", "2.0D AS y1", "3.00049D AS x2", "4.0D AS y2")
    got = {r["image_id"]: json.loads(r["document"]) for r in write_bundles(images, boxes).collect()}
    one = got[1]
    assert list(one) == ["source", "geometry", "fields", "detections"] and one["source"] == 'a "b".png' and one["geometry"] == {"width": 10}
    assert one["fields"]["amount"] == {
        "state": "read", "raw": "\u00a5 1,000.5", "ocr_confidence": 0.75, "detector_score": 0.25, "normalized": "\u00a51000.50", "amount_fen": 100050, "currency": "CNY",
    }
    assert one["fields"]["time"] == {"state": "unreadable", "raw": None, "score": 0.5} and one["fields"]["recipient"] == {"state": "absent", "raw": None}
    assert [d["score"] for d in one["detections"]] == [0.5, 0.25, 0.5, 1.0] and one["detections"][2]["ocr"] == {"text": "", "confidence": 0.5}
    assert "ocr" not in one["detections"][0] and one["detections"][0]["bbox_rectified"] == [1.0, 2.0, 3.0, 4.0]
    assert got[2]["source"] is None and got[2]["detections"] == [] and {f["state"] for f in got[2]["fields"].values()} == {"absent"}


def test_bundles_match_texts_once(spark):
    """An amount is searched for in one column, which the parts of the document then read, not in each of them."""
    from tallyslip.operators.bundles import write_bundles

    images = spark.createDataFrame([(1, "a")], "image_id int, source string").selectExpr("*", "struct(10 AS width) AS geometry", "array(1D, 0D, 0D, 0D, 1D, 0D, 0D, 0D, 1D) AS to_original")
    boxes = spark.range(1).selectExpr("1 AS image_id", "0 AS pos", "'amount' AS label", "0.5D AS score", "'x' AS text", "0.5D AS confidence", "1D AS x1", "2D AS y1", "3D AS x2", "4D AS y2")
    plan = write_bundles(images, boxes)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "[0-9OoIl]{1,3}(?:" in line]
    assert len(lines) == 1 and "ocr_confidence" not in lines[0]


def test_review_order_in_any_number_of_ranges(spark, monkeypatch):
    import random

    from tallyslip.operators import review

    rng = random.Random(3)
    rows = [(i, rng.choice(["x", "y", None]), rng.choice([None, "unclear"])) for i in rng.sample(range(10_000), 300)]
    df = spark.createDataFrame(rows, "ord long, cohort string, label string")
    want, place = {}, {}
    for c in ("x", "y", None):
        own = sorted(r for r in rows if r[1] == c)
        open_ = [o for o, _, label in own if label is None]
        for k, (o, _, _) in enumerate(own):
            want[o] = next((x for x in open_ if x > o), open_[0] if open_ else None)
            place[o] = f"{k + 1}/{len(own)}"
    for rows_each, least in ((150, 2), (1 << 20, 8), (5, 2)):
        monkeypatch.setattr(review, "RANGE_ROWS", rows_each)
        monkeypatch.setattr(review, "LEAST_RANGES", least)
        assert {r["ord"]: r["next_ord"] for r in review.next_unlabelled(df).collect()} == want
        assert {r["ord"]: r["position"] for r in review.review_position(df).collect()} == place
    assert review.next_unlabelled(df.limit(0)).count() == review.review_position(df.limit(0)).count() == 0
