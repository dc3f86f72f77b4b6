"""Files in and out: image listings, result documents, stage tables, manifests, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyslip.operators.batch import IMAGE_SUFFIXES

SCHEMA_VERSION = 1


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, length, modificationTime) of the images under a path; contents aren't read. `require_images` and an order by path are
    up to the reader, as both need the whole listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(IMAGE_SUFFIXES)).select(F.col("path").alias("image_id"), "length", "modificationTime")


def require_images(images: DataFrame, path: str) -> DataFrame:
    """`images`, by path; none at all (an empty folder, or a single file of another kind) is an error."""
    if images.isEmpty():
        raise ValueError(f"no images under {path}")
    return images.orderBy("image_id")


def scan_pixels(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, width, height, n_channels, pixels, error): files that can't be decoded have an error."""
    image = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "false").load(path)
    bad = F.col("image.height") < 0
    return image.select(F.col("image.origin").alias("image_id"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("pixels"), F.when(bad, "undecodable image").alias("error"))


#: Keys of a correction that are switches.
SWITCHES = ["prefer_portrait", "auto_screen"]


def _truth(key: str) -> Column:
    """Whether a JSON value counts as on: null, false, 0, and empty texts, lists and objects are off."""
    value = F.try_variant_get(F.try_parse_json("raw"), f"$.{key}", "variant")
    kind, text = F.schema_of_variant(value), F.get_json_object("raw", f"$.{key}")
    off = (kind == "VOID") | ((kind == "BOOLEAN") & (text == "false")) | ((kind == "STRING") & (text == ""))
    off = off | (kind.startswith("ARRAY") & (text == "[]")) | (kind.startswith("OBJECT") & (text == "{}"))
    number = (kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")) & (text.try_cast("double") == 0)
    return ~F.coalesce(off | number, F.lit(False))


def load_corrections(documents: DataFrame, value: str = "value") -> DataFrame:
    """JSON objects keyed by path as rows (key, skip, orientation, prefer_portrait, auto_screen, screen_quad, max_side, each but skip with
    *_set telling a null from an absent key). `skip` is on only if it is true itself; the other switches are on for every value but null,
    false, 0 and empty ones. A root or value that is no object ends the job."""
    entry = F.from_json(value, "map<string,string>", {"mode": "FAILFAST"})
    rows = documents.select(F.explode(entry).alias("key", "raw"))
    keys = F.json_object_keys("raw")
    rows = rows.withColumn("raw", F.when(keys.isNull(), F.raise_error(F.concat(F.lit("correction is no object: "), "key"))).otherwise(F.col("raw")))
    one = F.from_json("raw", "skip boolean, orientation_degrees int, screen_quad array<array<double>>, max_side int")
    out = rows.select("key", "raw", one.alias("c"), F.json_object_keys("raw").alias("_keys"))
    has = lambda k: F.array_contains("_keys", k)
    out = out.select(
        "key", F.coalesce("c.skip", F.lit(False)).alias("skip"), has("orientation_degrees").alias("orientation_set"), F.col("c.orientation_degrees").alias("orientation"),
        *[x for k in SWITCHES for x in (has(k).alias(f"{k}_set"), F.when(has(k), _truth(k)).alias(k))],
        has("screen_quad").alias("screen_quad_set"), "c.screen_quad", has("max_side").alias("max_side_set"), "c.max_side",
    )
    return out


def scan_result_bundles(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, source, result, error): JSON documents with source, geometry and detections; objects without these are left out. A source
    that isn't absolute lies beside its document. What is no JSON object, or has a blank source, has an error."""
    text = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    text = text.select(F.input_file_name().alias("path"), F.regexp_replace("value", "^\ufeff", "").alias("value"))
    keys = F.json_object_keys("value")
    whole = F.size(F.array_intersect(keys, F.array(*map(F.lit, ["source", "geometry", "detections"])))) == 3
    source = F.get_json_object("value", "$.source")
    folder = F.regexp_replace("path", "/[^/]*$", "/")
    error = F.when(keys.isNull(), "no JSON object").when(F.coalesce(F.trim(source), F.lit("")) == "", "blank source")
    full = F.when(source.rlike("^(/|[A-Za-z][A-Za-z0-9+.-]*:/)"), source).otherwise(F.concat(folder, source))
    rows = text.filter(keys.isNull() | whole)
    return rows.select("path", F.when(error.isNull(), full).alias("source"), F.when(keys.isNotNull(), F.from_json("value", schema)).alias("result"), error.alias("error"))


def flatten_ocr_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Raw OCR JSON as (line_no, text, score) rows: parallel lists of texts and scores, cut to the shorter, missing scores
    0; or a list of [box, [text, score]]."""
    lists = F.from_json(payload, "rec_texts array<string>, texts array<string>, rec_scores array<double>, scores array<double>")
    df = df.withColumn("_l", lists)
    texts, scores = F.coalesce("_l.rec_texts", "_l.texts"), F.coalesce("_l.rec_scores", "_l.scores")
    zipped = F.transform(texts, lambda t, i: F.struct(t.alias("text"), F.when(scores.isNull(), 0.0).otherwise(F.get(scores, i)).alias("score")))
    zipped = F.when(scores.isNull(), zipped).otherwise(F.slice(zipped, F.lit(1), F.least(F.size(texts), F.size(scores))))
    nested = F.transform(F.from_json(payload, "array<array<string>>"), lambda x: F.struct(F.get_json_object(F.get(x, 1), "$[0]").alias("text"), F.coalesce(F.get_json_object(F.get(x, 1), "$[1]").try_cast("double"), F.lit(0.0)).alias("score")))
    both = F.when(F.trim(payload).startswith("["), nested).otherwise(zipped)
    return df.select("*", F.posexplode(both).alias("line_no", "_x")).select(*[c for c in df.columns if c not in ("_l", payload)], "line_no", "_x.text", "_x.score")


def fingerprint(content: Column) -> Column:
    return F.sha2(content, 256)


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size, mtime) of the files under a path: where something came from, and whether it has changed."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return read.select("path", fingerprint(F.col("content")).alias("sha256"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def write_stage(df: DataFrame, path: str) -> None:
    """The full-precision hand-off between detector and OCR."""
    df.withColumn("schema_version", F.lit(SCHEMA_VERSION)).write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Staged rows with `error` where the version is another."""
    df = spark.read.parquet(path)
    return df.withColumn("error", F.when(F.col("schema_version") != SCHEMA_VERSION, "unknown stage version"))
