"""Inventory and batch operators: stable selection, corrections, resuming, error and manifest tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyslip.functions.style import business_tag

# Suffixes of images.
IMAGE_SUFFIXES = ["jpg", "jpeg", "png", "webp", "bmp", "tif", "tiff"]


def selection_key(image_id: Column) -> Column:
    """A stable pseudo-random order: the SHA-256 of the relative path."""
    return F.sha2(image_id, 256)


def assign_shard(df: DataFrame, n: int) -> DataFrame:
    """`shard`: the first 8 bytes of the key as an unsigned number, modulo n."""
    if n < 1:
        raise ValueError("there must be at least one shard")
    head = F.conv(F.substring(selection_key(F.col("image_id")), 1, 16), 16, 10).cast("decimal(20,0)")
    return df.withColumn("shard", (head % n).cast("int"))


def select_shard(df: DataFrame, i: int, n: int) -> DataFrame:
    if not 0 <= i < n:
        raise ValueError("the shard must be in [0, n)")
    return assign_shard(df, n).filter(F.col("shard") == i)


def sample_cohort(df: DataFrame, limit: int) -> DataFrame:
    """The first rows by (key, path). The limit counts candidates, before skipping."""
    if limit < 1:
        raise ValueError("the limit must be positive")
    return df.withColumn("key", selection_key(F.col("image_id"))).orderBy("key", "image_id").limit(limit)


def base_name(path: Column) -> Column:
    return F.regexp_replace(path, "^.*/", "")


def stem_of(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]+$", "")


def images_only(df: DataFrame) -> DataFrame:
    return df.filter(F.lower(F.regexp_extract("image_id", r"\.([^./]+)$", 1)).isin(IMAGE_SUFFIXES))


def join_corrections(images: DataFrame, corrections: DataFrame) -> DataFrame:
    """`correction`: the whole override found by relative path, else by base name. Spark broadcasts corrections where they are small."""
    entry = F.struct(*[c for c in corrections.columns if c != "key"])
    by = corrections.select(F.col("key").alias("_key"), entry.alias("_entry"))
    own = images.join(by.withColumnRenamed("_entry", "_path"), F.col("image_id") == F.col("_key"), "left").drop("_key")
    own = own.join(by.withColumnRenamed("_entry", "_name"), base_name(F.col("image_id")) == F.col("_key"), "left").drop("_key")
    return own.withColumn("correction", F.coalesce("_path", "_name")).drop("_path", "_name")


def drop_skipped(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce("correction.skip", F.lit(False)))


def apply_defaults(df: DataFrame, max_side: int = 1600, orientation: int | None = None, prefer_portrait: bool = True, auto_screen: bool = True) -> DataFrame:
    """The five options of a row: an override counts where its key is present, even with null (orientation: found automatically; a
    screen quad: none; the switches: off); else the run's default."""
    own = lambda key, value, default: F.when(F.col(f"correction.{key}_set"), F.col(f"correction.{value}")).otherwise(default)
    return df.withColumns({
        "orientation_degrees": own("orientation", "orientation", F.lit(orientation).cast("int")),
        "prefer_portrait": F.coalesce(own("prefer_portrait", "prefer_portrait", F.lit(prefer_portrait)), F.lit(False)),
        "auto_screen": F.coalesce(own("auto_screen", "auto_screen", F.lit(auto_screen)), F.lit(False)),
        "screen_quad": F.col("correction.screen_quad"),
        "max_side": own("max_side", "max_side", F.lit(max_side)),
    })


def output_name_collisions(df: DataFrame) -> DataFrame:
    """Stems that repeat regardless of case, over all shards."""
    return df.groupBy(F.lower(stem_of(F.col("image_id"))).alias("stem")).agg(F.count(F.lit(1)).alias("n"), F.min("image_id").alias("first")).filter("n > 1")


def is_committed(ocr_mode: bool = True, style: dict | None = None) -> Column:
    """Whether a bundle still stands for its image: all outputs there, not older, an object of fields, the same source,
    in OCR mode boxes that all have a result, and in style mode (`style`: schema_version, model, config) a style record made
    under the same version, model and config whose tags are those of its label by the present rules."""
    out = F.col("all_outputs") & (F.col("result_mtime") >= F.col("mtime")) & F.col("fields_object") & (F.col("recorded_source") == F.col("image_id"))
    if ocr_mode:
        out = out & (F.col("n_detections") > 0) & (F.col("n_detections") == F.col("n_with_ocr"))
    if style:
        same = [F.col("style_schema") == style["schema_version"], F.col("style_model") == style["model"], F.col("style_config") == style["config"]]
        out = reduce(Column.__and__, same, out) & F.col("style_tag").eqNullSafe(business_tag(F.col("style_label")))
    return F.coalesce(out, F.lit(False))


def split_committed(images: DataFrame, bundles: DataFrame, ocr_mode: bool = True, style: dict | None = None) -> DataFrame:
    """`committed` per image: those become skipped_existing, the others are the work list."""
    return images.join(bundles, F.col("image_id") == F.col("source"), "left").withColumn("committed", is_committed(ocr_mode, style))


def rehydrate(stage: DataFrame, images: DataFrame) -> DataFrame:
    """Staged rows with `error`: null if the live source is there and unchanged."""
    live = images.select(F.col("image_id").alias("source"), F.col("length").alias("_length"), F.col("mtime").alias("_mtime"))
    error = F.when(F.col("_length").isNull(), "missing source").when((F.col("length") != F.col("_length")) | (F.col("mtime") != F.col("_mtime")), "changed source")
    return stage.join(live, "source", "left").withColumn("error", error).drop("_length", "_mtime")


def overlapping_paths(outputs: DataFrame, sources: DataFrame) -> DataFrame:
    """Outputs that equal, contain or lie in a source. A prefix of a path at a slash is one of its ancestors, so both
    directions are equi-joins on ancestors instead of a nested loop."""
    def above(df: DataFrame, name: str) -> DataFrame:
        part = F.split(name, "/")
        ends = F.transform(F.sequence(F.lit(1), F.size(part)), lambda i: F.array_join(F.slice(part, 1, i), "/"))
        return df.select(F.col(name).alias("path"), F.explode(ends).alias("up"))

    out, src = outputs.select(F.col("image_id").alias("o")).distinct(), sources.select(F.col("image_id").alias("s")).distinct()
    inside = above(out, "o").join(src, F.col("up") == F.col("s"), "left_semi").select("path")
    around = out.join(above(src, "s"), F.col("o") == F.col("up"), "left_semi").select(F.col("o").alias("path"))
    return inside.union(around).distinct()


def unmatched_names(df: DataFrame, root: str) -> DataFrame:
    """Members outside the root."""
    return df.filter(~F.col("image_id").startswith(root.rstrip("/") + "/"))


def stale_crops(images: DataFrame, bundles: DataFrame) -> DataFrame:
    """`stale`: the bundle or crop is missing, or the crop is empty or older than its bundle or source."""
    joined = images.join(bundles, F.col("image_id") == F.col("source"), "left")
    fresh = (F.col("crop_size") > 0) & (F.col("crop_mtime") >= F.greatest("result_mtime", "mtime"))
    return joined.select("image_id", (~F.coalesce(fresh, F.lit(False))).alias("stale"))


def group_id(source: Column, result: Column) -> Column:
    """Capture group: the source's stem without its timestamp, else the result's stem, in the result's folder."""
    stem = stem_of(base_name(source))
    cut = F.regexp_extract(stem, r"^(.*)[_-](?:19|20)\d{12}$", 1)
    folder = F.nullif(F.regexp_extract(result, "^(.*)/", 1), F.lit(""))
    return F.concat_ws("/", folder, F.coalesce(F.nullif(cut, F.lit("")), stem_of(base_name(result))))


# What is put behind the stem of an image's outputs and of its stage files.
OUTPUT_SUFFIXES = {"result": ".json", "annotated_rectified": "_rectified_annotated.jpg", "annotated_original": "_original_annotated.jpg"}


def result_paths(path: Column) -> list[Column]:
    """The output paths of an image."""
    return [F.concat(stem_of(path), F.lit(suffix)).alias(name) for name, suffix in OUTPUT_SUFFIXES.items()]


def shard_suffix(index: int, count: int) -> str:
    """What names a shard's manifest: empty for a single one, else its number among all."""
    if not 0 <= index < count:
        raise ValueError("the shard must be in [0, count)")
    return "" if count == 1 else f".shard-{index:03d}-of-{count:03d}"


def manifest_rows(df: DataFrame) -> DataFrame:
    """Output paths and status per image."""
    status = F.when(F.col("committed"), "skipped_existing").otherwise("written").alias("status")
    return df.select(F.col("image_id").alias("source"), *result_paths(F.col("image_id")), status)


def union_manifests(*shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to read text for, rows carried over) of the shards' manifests: what was skipped as existing is carried without a reading. A
    carried row whose five values aren't all there ends the job."""
    rows = reduce(DataFrame.unionByName, shards)
    names = ["source", *OUTPUT_SUFFIXES, "status"]
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in names])
    skipped = rows.filter(F.col("status") == "skipped_existing").select(*names)
    skipped = skipped.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit("invalid skipped row in a manifest")).cast("boolean")))
    return rows.filter(~F.coalesce(F.col("status") == "skipped_existing", F.lit(False))), skipped


def rectification_manifest(df: DataFrame, root: str, geometry: Column) -> DataFrame:
    """One row per prepared image: where it came from, where its rectified image lies, and the entries of its geometry (a struct)."""
    source = F.concat(F.lit(root.rstrip("/") + "/"), F.col("image_id"))
    rectified = F.concat(F.lit("images/"), stem_of(F.col("image_id")), F.lit(".jpg"))
    return df.select(source.alias("source"), F.col("image_id").alias("source_relative"), rectified.alias("rectified_image"), geometry.alias("_g")).select("source", "source_relative", "rectified_image", "_g.*")


def config_mismatches(rows: DataFrame, config: dict) -> DataFrame:
    """Rows per config found (columns as in `config`), with `same`: whether it is the wanted one."""
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(v)) for k, v in config.items()])
    return rows.groupBy(*config).agg(F.count(F.lit(1)).alias("n")).withColumn("same", same)


def require_same_config(rows: DataFrame, config: dict, overwrite: bool = False) -> DataFrame:
    """`rows`, which must have been made under `config`; a row under another one ends the job. With `overwrite` they are all to be made
    anew and get the config."""
    if overwrite:
        return rows.withColumns({k: F.lit(v) for k, v in config.items()})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(v)) for k, v in config.items()])
    return rows.filter(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("rows were made under another config; overwrite them")).cast("boolean")))


def batch_summary(manifest: DataFrame, errors: DataFrame) -> DataFrame:
    return manifest.select("status").unionByName(errors.select(F.lit("failed").alias("status"))).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def union_in_stages(*frames: DataFrame) -> DataFrame:
    """Rows of several stages with stage_no, which orders them."""
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn("stage_no", F.lit(i))
        out = df if out is None else out.unionByName(df)
    return out


def choose_orientation(df: DataFrame, prefer_portrait: bool | Column = True) -> DataFrame:
    """Degrees per image: the explicit value modulo 360 (no multiple of 90 ends the job), else the best text score (a bonus of 0.02 if the turned image stands
    upright), the smallest on ties; without any score, or with an infinite best one, 90 for wide images, else 0."""
    wide = F.col("w") > F.col("h")
    upright = F.when(F.col("degrees") % 180 == 0, F.col("h") >= F.col("w")).otherwise(F.col("w") >= F.col("h"))
    score = F.col("confidence") + F.least(F.col("n_lines"), F.lit(10)) * 0.01 + F.when(upright & F.lit(prefer_portrait), 0.02).otherwise(0.0)
    best = F.row_number().over(Window.partitionBy("image_id").orderBy(F.coalesce(score, F.lit(float("-inf"))).desc(), "degrees"))
    top = df.withColumn("_s", score).withColumn("_n", best).filter("_n = 1")
    turn = F.pmod("explicit_degrees", F.lit(360))
    turn = F.when(turn % 90 == 0, turn).otherwise(F.raise_error(F.concat(F.lit("orientation must be a multiple of 90: "), F.col("explicit_degrees"))).cast("int"))
    chosen = F.when(F.col("explicit_degrees").isNotNull(), turn).when(F.col("_s") < float("inf"), F.col("degrees")).when(wide & F.lit(prefer_portrait), 90).otherwise(0)
    return top.select("image_id", chosen.cast("int").alias("orientation"))
