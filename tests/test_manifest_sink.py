"""The manifest sink: names, formats, empty shards, failing and repeated tasks."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyslip.operators.batch import assign_shard
from tallyslip.sources import manifest_sink

ROWS = [(f"img{i:03d}.png", f"out/img{i:03d}.json", "written" if i % 2 else "skipped_existing") for i in range(60)]


def manifest(spark):
    df = spark.createDataFrame([(s, s, r, t) for s, r, t in ROWS], "image_id string, source string, result string, status string")
    return df


def test_files_of_shards(spark, tmp_path):
    df = assign_shard(manifest(spark), 8).drop("image_id").repartition(5)
    where = {r["source"]: r["shard"] for r in df.collect()}
    manifest_sink.write_manifest(df.filter("shard != 5"), f"file://{tmp_path}/m", "inference_manifest", 8, ["source"])
    assert sorted(os.listdir(tmp_path / "m")) == sorted(f"inference_manifest.shard-{i:03d}-of-008.{k}" for i in range(8) for k in ("json", "jsonl"))
    for i in range(8):
        want = [{"source": s, "result": r, "status": t} for s, r, t in ROWS if where[s] == i and i != 5]
        text = (tmp_path / f"m/inference_manifest.shard-{i:03d}-of-008.json").read_text()
        assert text == json.dumps(want, ensure_ascii=False, indent=2) + "\n"
        lines = (tmp_path / f"m/inference_manifest.shard-{i:03d}-of-008.jsonl").read_text()
        assert lines == "".join(json.dumps(x, ensure_ascii=False) + "\n" for x in want)


def test_one_shard_and_errors(spark, tmp_path):
    df = manifest(spark).drop("image_id").withColumn("shard", F.lit(0))
    manifest_sink.write_manifest(df, f"file://{tmp_path}/m", "inference_manifest", 1, ["source"])
    assert sorted(os.listdir(tmp_path / "m")) == ["inference_manifest.json", "inference_manifest.jsonl"]
    bad = spark.createDataFrame([(0, "a\nb.png", "ValueError", "bad ¥ \"q\""), (0, None, "OSError", "x")], "shard int, source string, error_type string, message string")
    manifest_sink.write_errors(bad, f"file://{tmp_path}/e", 1, ["source"])
    assert os.listdir(tmp_path / "e") == ["inference_errors.jsonl"]
    got = [json.loads(x) for x in (tmp_path / "e/inference_errors.jsonl").read_text().splitlines()]
    assert got == [{"source": None, "error_type": "OSError", "message": "x"}, {"source": "a\nb.png", "error_type": "ValueError", "message": "bad ¥ \"q\""}]
    manifest_sink.write_errors(bad.limit(0), f"file://{tmp_path}/n", 1, ["source"])
    assert (tmp_path / "n/inference_errors.jsonl").read_text() == ""


def test_attempts_that_fail_leave_nothing(tmp_path):
    writer = manifest_sink.ManifestWriter({"path": f"file://{tmp_path}", "name": "m", "shards": "2"})

    def rows(fail):
        yield Row(shard=0, source="a")
        yield Row(shard=1, source="b")
        if fail:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(rows(True))
    assert os.listdir(tmp_path) == []
    lost, done = writer.write(rows(False)), writer.write(rows(False))
    assert all(n.endswith(".tmp") for n in os.listdir(tmp_path))
    writer.abort([lost, None])
    writer.commit([done, None])
    assert sorted(os.listdir(tmp_path)) == [f"m.shard-{i:03d}-of-002.{k}" for i in range(2) for k in ("json", "jsonl")]
    with pytest.raises(ValueError, match="two tasks"):
        writer.commit([writer.write(rows(False)), writer.write(rows(False))])
    assert not [n for n in os.listdir(tmp_path) if n.endswith(".tmp")]


AGAIN = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from tallyslip.sources.manifest_sink import write_manifest
flag = {flag!r}
@F.udf("string")
def once(x):
    if x == "img7" and not os.path.exists(flag):
        open(flag, "w").close()
        raise RuntimeError("the first attempt fails")
    return x
rows = spark.range(20).select(F.concat(F.lit("img"), "id").alias("source"), (F.col("id") % 2).cast("int").alias("shard"))
write_manifest(rows.repartition("shard").withColumn("source", once("source")), {path!r}, "m", 2, ["source"])
"""


def test_a_task_that_fails_is_run_again(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = AGAIN.format(repo=repo, flag=str(tmp_path / "flag"), path=f"file://{tmp_path}/m")
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, cwd=tmp_path, env={**os.environ, "PYTHONPATH": repo})
    assert run.returncode == 0, run.stderr[-2000:]
    assert (tmp_path / "flag").exists() and len(os.listdir(tmp_path / "m")) == 4
    assert sorted(x["source"] for i in range(2) for x in json.loads((tmp_path / f"m/m.shard-{i:03d}-of-002.json").read_text())) == sorted(f"img{i}" for i in range(20))
