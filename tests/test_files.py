import hashlib
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tallyslip.sources import files
from tallyslip.streaming.ingest import incremental_ingest


def png(path, w=6, h=4):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raw = b"".join(b"\0" + b"\xff\x00\x00" * w for _ in range(h))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images(spark, tmp_path):
    png(tmp_path / "a.png")
    png(tmp_path / "b.PNG")
    (tmp_path / "c.jpg").write_bytes(b"no image")
    (tmp_path / "d.txt").write_text("x")
    assert files.scan_images(spark, str(tmp_path)).count() == 3
    rows = {r["image_id"][-5:]: r for r in files.scan_pixels(spark, str(tmp_path)).collect()}
    assert rows["a.png"]["width"] == 6 and rows["a.png"]["error"] is None and rows["c.jpg"]["error"]


def test_ingest_sees_files_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    png(tmp_path / "in/a.png")
    seen = []
    for name in ("b.png", "c.png"):
        incremental_ingest(spark, str(tmp_path / "in"), str(tmp_path / "cp"), lambda df, _: seen.extend(r["path"][-5:] for r in df.select("path").collect()))
        png(tmp_path / "in" / name)
    assert seen == ["a.png", "b.png"]


def test_corrections_tell_null_from_absent(spark):
    df = spark.createDataFrame([('{"a.png": {"skip": true, "orientation_degrees": null}, "b.png": {"max_side": 0}}',)], "value string")
    rows = {r["key"]: r for r in files.load_corrections(df).collect()}
    assert rows["a.png"]["skip"] and rows["a.png"]["orientation_set"] and not rows["a.png"]["max_side_set"]
    assert not rows["b.png"]["skip"] and rows["b.png"]["max_side_set"] and not rows["b.png"]["orientation_set"]


def test_switches_of_corrections(spark):
    """Every value but null, false, 0 and empty ones switches on; an absent key isn't set."""
    values = {"t": "true", "f": "false", "n": "null", "z": "0", "zz": "0.0", "one": "2", "e": '""', "s": '"false"', "l": "[]", "ll": "[0]", "o": "{}", "oo": '{"a": 1}'}
    text = ", ".join(f'"{k}": {{"prefer_portrait": {v}}}' for k, v in values.items())
    df = spark.createDataFrame([(f'{{{text}, "absent": {{"screen_quad": [[1, 2], [3, 4.5], [5, 6], [7, 8]]}}}}',)], "value string")
    rows = {r["key"]: r for r in files.load_corrections(df).collect()}
    assert {k for k in values if rows[k]["prefer_portrait"]} == {"t", "one", "s", "ll", "oo"} and all(rows[k]["prefer_portrait_set"] for k in values)
    assert rows["absent"]["prefer_portrait"] is None and not rows["absent"]["prefer_portrait_set"] and rows["absent"]["screen_quad"][1] == [3.0, 4.5]


def test_payloads(spark):
    texts = ['{"rec_texts": ["a", "b", "c"], "rec_scores": [0.5, 0.25]}', '{"texts": ["x"]}', '[[[0,1], ["t", "0.75"]], [[1,1], ["u", "bad"]]]']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
    got = [(r["id"], r["text"], r["score"]) for r in files.flatten_ocr_payload(df).orderBy("id", "line_no").collect()]
    assert got == [(0, "a", 0.5), (0, "b", 0.25), (1, "x", 0.0), (2, "t", 0.75), (2, "u", 0.0)]


def test_stage_and_bundles(spark, tmp_path):
    files.write_stage(spark.createDataFrame([(1, 0.1 + 0.2)], "id int, x double"), str(tmp_path / "stage"))
    assert files.read_stage(spark, str(tmp_path / "stage")).first()["x"] == 0.1 + 0.2
    spark.sql("SELECT 2 AS id, 0.5D AS x, 99 AS schema_version").write.mode("append").parquet(str(tmp_path / "stage"))
    staged = {r["id"]: r["error"] for r in files.read_stage(spark, str(tmp_path / "stage")).collect()}
    assert staged == {1: None, 2: "unknown stage version"}
    (tmp_path / "b").mkdir()
    (tmp_path / "b/one.json").write_text('﻿{"source": "s", "geometry": {}, "detections": []}')
    (tmp_path / "b/two.json").write_text('{"source": "s"}')
    (tmp_path / "b/three.json").write_text("{")
    (tmp_path / "b/four.json").write_text('{"source": " ", "geometry": {}, "detections": []}')
    (tmp_path / "b/five.json").write_text('{"source": "/in/x.png", "geometry": {}, "detections": []}')
    rows = {r["path"].rsplit("/", 1)[1]: r for r in files.scan_result_bundles(spark, str(tmp_path / "b"), "source string").collect()}
    assert set(rows) == {"one.json", "three.json", "four.json", "five.json"} and rows["one.json"]["result"]["source"] == "s"
    assert rows["one.json"]["source"] == rows["one.json"]["path"].replace("one.json", "s") and rows["five.json"]["source"] == "/in/x.png"
    assert rows["three.json"]["error"] == "no JSON object" and rows["four.json"]["error"] == "blank source" and rows["one.json"]["error"] is None


def test_fingerprints_and_listings(spark, tmp_path):
    png(tmp_path / "b.png")
    png(tmp_path / "a.png")
    rows = files.fingerprints(spark, str(tmp_path)).collect()
    content = (tmp_path / "a.png").read_bytes()
    assert {(r["sha256"], r["size"]) for r in rows} == {(hashlib.sha256(content).hexdigest(), len(content))} and all(r["mtime"] for r in rows)
    listed = files.require_images(files.scan_images(spark, str(tmp_path)), str(tmp_path)).collect()
    assert [r["image_id"][-5:] for r in listed] == ["a.png", "b.png"]
    with pytest.raises(ValueError):
        files.require_images(files.scan_images(spark, str(tmp_path)).limit(0), str(tmp_path))
