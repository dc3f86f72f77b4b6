"""The crop-export job: from result documents and the last run's cohort to the new cohort, the crops to cut, and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyslip.functions import geometry as geo
from tallyslip.operators.batch import group_id, selection_key, stem_of
from tallyslip.operators.errors import chain, split_batch

DOCUMENT = """source string, geometry struct<rectified_size: struct<width: int, height: int>, source_size: struct<width: int, height: int>,
  H_original_to_rectified: array<array<double>>>, detections array<struct<label: string, bbox_rectified: array<double>>>"""
RECORD = ["crop", "source", "result_json", "group_id"]
ORDER = ["generation", "place"]


def work_items(results: DataFrame, cohort: DataFrame) -> DataFrame:
    """The last cohort (RECORD, and `generation`, `place`, which order it) in its own order, then the results it lacks regardless of case,
    by the SHA-256 of their path, as the next generation. `was` is the record of the last run, null for new results."""
    last = cohort.select(*ORDER, F.struct(*RECORD).alias("was"), F.col("result_json").alias("_path"))
    kept = last.join(results, F.col("_path") == F.col("result_json"), "left").drop("result_json").withColumnRenamed("_path", "result_json")
    newest = cohort.agg(F.max("generation")).first()[0]
    known = cohort.select(F.lower("result_json").alias("_key"))
    new = results.join(known, F.lower("result_json") == F.col("_key"), "left_anti")
    new = new.withColumns({"generation": F.lit(0 if newest is None else newest + 1), "place": F.concat_ws(" ", selection_key(F.col("result_json")), "result_json")})
    return kept.unionByName(new, allowMissingColumns=True)


def checked(items: DataFrame, sources: DataFrame, crops: DataFrame | None, margin: float) -> DataFrame:
    """Items with error_type, message, `ignored` (new documents that are no results), and the crop's corners. Documents whose crop is there,
    not empty and not older than document and source need no more than their source."""
    rows = items.withColumns({"_d": F.from_json("value", DOCUMENT), "_keys": F.json_object_keys("value"), "_json": F.try_parse_json("value").isNotNull()})
    whole = F.coalesce(F.size(F.array_intersect("_keys", F.array(*map(F.lit, ("source", "geometry", "detections"))))) == 3, F.lit(False))
    folder = F.regexp_extract("result_json", "^(.*/)", 1)
    path = F.when(F.trim("_d.source") != "", F.when(F.col("_d.source").startswith("/"), F.col("_d.source")).otherwise(F.concat(folder, "_d.source")))
    rows = rows.withColumns({"_whole": whole, "source": path, "crop": F.concat(stem_of(F.col("result_json")), F.lit(".jpg"))})
    live = sources.select(F.col("source").alias("_live"), F.col("width").alias("_w"), F.col("height").alias("_h"), F.col("mtime").alias("_source_mtime"))
    rows = rows.join(live, F.col("source") == F.col("_live"), "left")
    if crops is not None:
        there = crops.select(F.col("crop").alias("_crop"), F.col("length").alias("_length"), F.col("mtime").alias("_crop_mtime"))
        rows = rows.join(there, F.col("crop") == F.col("_crop"), "left")
        fresh = F.coalesce((F.col("_length") > 0) & (F.col("_crop_mtime") >= F.greatest("mtime", "_source_mtime")), F.lit(False))
    else:
        fresh = F.lit(False)
    status = F.filter("_d.detections", lambda x: x["label"] == "transfer_status")
    g = "_d.geometry"
    rows = rows.withColumns({"_fresh": fresh, "_n": F.coalesce(F.size(status), F.lit(0)), "_m": F.flatten(f"{g}.H_original_to_rectified"), "_b": F.get(status, 0)["bbox_rectified"]})
    box = [F.get("_b", F.lit(i)) for i in range(4)]
    finite = lambda a: F.forall(a, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    mx, my = (box[2] - box[0]) * margin, (box[3] - box[1]) * margin
    edges = {
        "left": F.greatest(F.lit(0), F.floor(box[0] - mx)), "top": F.greatest(F.lit(0), F.floor(box[1] - my)),
        "right": F.least(F.col(f"{g}.rectified_size.width"), F.ceil(box[2] + mx)), "bottom": F.least(F.col(f"{g}.rectified_size.height"), F.ceil(box[3] + my)),
    }
    rows = rows.withColumns({c: e.cast("long") for c, e in edges.items()})
    shape = (F.size(f"{g}.H_original_to_rectified") == 3) & F.forall(f"{g}.H_original_to_rectified", lambda r: F.size(r) == 3)
    good_box = (F.size("_b") == 4) & finite(F.col("_b")) & (box[2] > box[0]) & (box[3] > box[1])
    wide, high = F.col(f"{g}.rectified_size.width"), F.col(f"{g}.rectified_size.height")
    same_size = (F.col(f"{g}.source_size.width") == F.col("_w")) & (F.col(f"{g}.source_size.height") == F.col("_h"))
    todo, value = ~F.col("_fresh"), "ValueError"
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return rows.withColumns({
        "ignored": F.col("_json") & ~F.col("_whole") & F.col("was").isNull(),
        **chain(
            (F.col("value").isNull(), "FileNotFoundError", F.col("result_json")),
            (~F.col("_json"), value, "invalid JSON"),
            (~F.col("_whole"), value, "no longer a result document"),
            (F.col("source").isNull(), value, "result has no source path"),
            (F.col("_live").isNull(), "FileNotFoundError", F.col("source")),
            (todo & (wide.isNull() | high.isNull()), value, "geometry has no rectified size"),
            (todo & ((wide < 2) | (high < 2)), value, "rectified size must be at least 2"),
            (todo & F.col(f"{g}.source_size").isNotNull() & no(same_size), value, "source size changed"),
            (todo & (no(shape) | no(finite(F.col("_m")))), value, "matrix must be finite and 3 x 3"),
            (todo & (F.abs(geo.determinant(F.col("_m"))) < 1e-12), value, "matrix is singular"),
            (todo & (F.col("_n") != 1), value, F.concat(F.lit("expected one transfer_status, found "), F.col("_n").cast("string"))),
            (todo & no(good_box), value, "box must be finite and not empty"),
            (todo & ((F.col("right") <= F.col("left")) | (F.col("bottom") <= F.col("top"))), value, "box outside the image"),
        ),
    })


def export_crops(
    results: DataFrame, sources: DataFrame, cohort: DataFrame, crops: DataFrame | None = None, unsafe: DataFrame | None = None,
    margin: float = 0.3, limit: int | None = None, continue_on_error: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cohort, plan, errors) of a run over `results` (result_json, value, mtime), `sources` (source, width, height, mtime), the last
    `cohort`, and the inventory of `crops` (crop, length, mtime).

    The new cohort keeps the old one's rows and order: a member that fails now keeps its former record, so labels given to it find
    their row; new results that fail have none. `limit` counts records, former ones too, and nothing behind the last of them is looked
    at; it must hold the old cohort. The plan lists what is to be cut and where; rows whose crop is up to date aren't in it. `unsafe`
    (generation, place, error_type, message) ends the job whatever happens. A run over its own cohort changes nothing."""
    if margin < 0:
        raise ValueError("the margin must not be negative")
    if limit is not None and limit < 1:
        raise ValueError("the limit must be positive")
    if limit is not None and limit < (frozen := cohort.count()):
        raise ValueError(f"the limit is below the {frozen} rows of the cohort")
    rows = checked(work_items(results, cohort), sources, crops, margin).filter(~F.coalesce("ignored", F.lit(False)))
    has_record = F.col("error_type").isNull() | F.col("was").isNotNull()
    if limit is not None:
        last = rows.filter(has_record).select(F.struct(*ORDER).alias("o")).orderBy("o").limit(limit).agg(F.max("o").alias("_last"), F.count("o").alias("_records"))
        rows = rows.crossJoin(F.broadcast(last)).filter((F.col("_records") < limit) | (F.struct(*ORDER) <= F.col("_last"))).drop("_last", "_records")  # one row
    good, bad = split_batch(rows, ORDER, unsafe, continue_on_error)
    named = good.withColumn("group_id", group_id(F.col("source"), F.col("result_json")))
    kept = bad.filter(F.col("was").isNotNull()).select(*ORDER, *[F.col(f"was.{c}").alias(c) for c in RECORD])
    new_cohort = named.select(*ORDER, *RECORD).unionByName(kept).withColumn("label", F.lit(None).cast("string"))
    plan = named.filter("NOT _fresh").select("result_json", "source", "crop", F.col("_m").alias("to_rectified"), "left", "top", "right", "bottom")
    return new_cohort, plan, bad.select(*ORDER, "result_json", "error_type", "message")
