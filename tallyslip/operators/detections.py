"""Operators on detector boxes: filters, the best box per label, completeness, crops, captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyslip.functions.geometry import transform_points
from tallyslip.functions.text import LABELS, extract_field_value, normalize_amount, normalize_time
from tallyslip.operators.errors import require_none

# Names shown for labels, in display order.
DISPLAY_NAMES = {"time": "时间", "amount": "金额", "transfer_status": "转账状态", "recipient_field": "收款方", "payment_method_field": "付款方式"}
# The name and the values shown for status styles.
STYLE_DISPLAY_NAME = "设备/风险标签"
STYLE_DISPLAY_VALUES = {"check_offset": "Android", "check_aligned": "iOS", "check_absent": "疑似假图", "unknown": "待复核"}


def labels_dim(spark: SparkSession) -> DataFrame:
    """The five classes, ids from 1; a fixed size, so always broadcast."""
    return spark.createDataFrame(list(enumerate(LABELS, 1)), "class_id int, label string")


def threshold_detections(df: DataFrame, t: float) -> DataFrame:
    if not 0 <= t <= 1:
        raise ValueError("the threshold must be in [0, 1]")
    return df.filter((F.col("score") >= t) & ~F.isnan("score"))


def map_labels(df: DataFrame) -> DataFrame:
    """class_id becomes label; unknown ids and the background go."""
    return df.join(F.broadcast(labels_dim(df.sparkSession)), "class_id")


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))


def validate_detections(df: DataFrame, polygon: str | None = None) -> DataFrame:
    """`violations`: what is wrong with each box, and with its corners in the photo (column `polygon`: four points) if there are any to
    check; empty if nothing is."""
    repeated = F.count(F.lit(1)).over(Window.partitionBy("image_id", "class_id")) > 1
    box = _finite("x1") & _finite("y1") & _finite("x2") & _finite("y2")
    checks = [
        (~F.col("class_id").between(1, len(LABELS)), "unknown label"),
        (repeated, "repeated label"),
        (~(_finite("score") & F.col("score").between(0, 1)), "score"),
        (~box, "box not finite"),
        (F.col("x2") <= F.col("x1"), "width"),
        (F.col("y2") <= F.col("y1"), "height"),
    ]
    if polygon:
        good = F.expr(f"size({polygon}) = 4 AND forall({polygon}, p -> size(p) = 2 AND forall(p, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf')))")
        checks.append((~F.coalesce(good, F.lit(False)), "polygon"))
    return df.withColumn("violations", F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in checks])))


def validate_images(df: DataFrame) -> DataFrame:
    """Per image all violations of its boxes, as one bad box fails the image; empty if there are none."""
    found = F.array_sort(F.array_distinct(F.flatten(F.collect_list("violations"))))
    return validate_detections(df).groupBy("image_id").agg(found.alias("violations"))


def best_per_label(df: DataFrame) -> DataFrame:
    """The strongest box of every image and label; the first one on ties."""
    first = Window.partitionBy("image_id", "label").orderBy(F.desc("score"), "pos")
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def completeness(images: DataFrame, best: DataFrame) -> DataFrame:
    """Per image: missing labels in class order, rows, complete. Images without boxes miss all."""
    found = best.groupBy("image_id").agg(F.collect_set("label").alias("found"), F.count(F.lit(1)).alias("n"))
    out = images.select("image_id").distinct().join(found, "image_id", "left")
    missing = F.array_except(F.array(*map(F.lit, LABELS)), F.coalesce("found", F.array().cast("array<string>")))
    n = F.coalesce("n", F.lit(0))
    return out.select("image_id", F.array_join(missing, ",").alias("missing"), n.alias("n"), ((F.size(missing) == 0) & (n == len(LABELS))).alias("complete"))


def pivot_fields(df: DataFrame, value: Column) -> DataFrame:
    """One column per label with its value; of repeated labels the last position wins. One shuffle on the image."""
    return df.groupBy("image_id").agg(*[F.max_by(value, F.when(F.col("label") == name, F.col("pos"))).alias(name) for name in LABELS])


def status_box(df: DataFrame) -> DataFrame:
    """Per image the strongest transfer_status box, their number, and whether it is the only one."""
    boxes = df.filter(F.col("label") == "transfer_status")
    return boxes.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("pos", F.struct("score", -F.col("pos"))).alias("pos"), F.max("score").alias("score")
    ).withColumn("strict_ok", F.col("n") == 1)


def ocr_crop_box(df: DataFrame, width: int, height: int) -> DataFrame:
    """left, top, right, bottom: the box with a margin of 8 % per axis, at least 2 px, clipped; null if empty."""
    mx, my = F.greatest(F.lit(2.0), (F.col("x2") - F.col("x1")) * 0.08), F.greatest(F.lit(2.0), (F.col("y2") - F.col("y1")) * 0.08)
    return _crop(df, mx, my, width, height)


def status_crop_box(df: DataFrame, width: int, height: int, margin: float = 0.3) -> DataFrame:
    """As ocr_crop_box with a relative margin and no least one; boxes that aren't finite or are empty keep their row, with no crop
    and the reason in `crop_error`, as do those outside the image."""
    if margin < 0:
        raise ValueError("the margin must not be negative")
    finite = _finite("x1") & _finite("y1") & _finite("x2") & _finite("y2")
    some = finite & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    held = df.withColumns({f"_{c}": F.col(c) for c in ("x1", "y1", "x2", "y2")}).withColumns({c: F.when(some, F.col(c)) for c in ("x1", "y1", "x2", "y2")})
    out = _crop(held, (F.col("x2") - F.col("x1")) * margin, (F.col("y2") - F.col("y1")) * margin, width, height)
    out = out.withColumns({c: F.when(F.col("x1").isNotNull(), F.col(c)) for c in ("left", "top", "right", "bottom")})
    out = out.withColumns({c: F.col(f"_{c}") for c in ("x1", "y1", "x2", "y2")}).drop("_x1", "_y1", "_x2", "_y2")
    error = F.when(~finite, "box not finite").when(~some, "empty box").when(F.col("left").isNull(), "box outside the image")
    return out.withColumn("crop_error", error)


def _crop(df: DataFrame, mx: Column, my: Column, width: int, height: int) -> DataFrame:
    df = df.withColumns({
        "left": F.greatest(F.lit(0), F.floor(F.col("x1") - mx)).cast("long"), "top": F.greatest(F.lit(0), F.floor(F.col("y1") - my)).cast("long"),
        "right": F.least(F.lit(width), F.ceil(F.col("x2") + mx)).cast("long"), "bottom": F.least(F.lit(height), F.ceil(F.col("y2") + my)).cast("long"),
    })
    some = (F.col("right") > F.col("left")) & (F.col("bottom") > F.col("top"))
    return df.withColumns({c: F.when(some, F.col(c)) for c in ("left", "top", "right", "bottom")})


def percent(score: Column) -> Column:
    """Whole percent, half to even on the binary value."""
    return F.concat(F.bround(score * 100, 0).cast("long").cast("string"), F.lit("%"))


def caption(label: Column, text: Column, score: Column) -> Column:
    """Display name, text if there is any, and the score in percent in brackets."""
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in DISPLAY_NAMES.items() for x in kv])[label], label)
    return F.concat_ws(" ", name, F.nullif(F.trim(text), F.lit("")), F.concat(F.lit("("), percent(score), F.lit(")")))


def style_caption(label: Column, confidence: Column) -> Column:
    """The same of a status style; unknown labels read as waiting for review."""
    shown = F.create_map(*[F.lit(x) for kv in STYLE_DISPLAY_VALUES.items() for x in kv])
    value = F.coalesce(shown[label], F.lit(STYLE_DISPLAY_VALUES["unknown"]))
    return F.concat(F.lit(STYLE_DISPLAY_NAME + " "), value, F.lit(" ("), percent(confidence), F.lit(")"))


def structured_caption_text(label: Column, text: Column) -> Column:
    """The text that a caption shows: the normalised value of time, amount, recipient and payment where there is one, else the text."""
    value = (
        F.when(label == "time", normalize_time(text))
        .when(label == "amount", normalize_amount(text)["normalized"])
        .when(label == "recipient_field", extract_field_value(text, "recipient"))
        .when(label == "payment_method_field", extract_field_value(text, "payment_method"))
    )
    return F.coalesce(F.nullif(value, F.lit("")), text)


def caption_rows(df: DataFrame, styles: DataFrame | None = None) -> DataFrame:
    """Captions numbered per image in display order; unknown labels last, then the image's row of `styles` (image_id), if it has one."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, DISPLAY_NAMES)), F.col("label")), F.lit(0))
    rows = df.withColumn("_rank", F.when(rank == 0, 99).otherwise(rank))
    if styles is not None:
        style_rows = styles.select("image_id").withColumns({"label": F.lit("status_style"), "_rank": F.lit(100)})
        rows = rows.unionByName(style_rows, allowMissingColumns=True)
    return rows.withColumn("number", F.row_number().over(Window.partitionBy("image_id").orderBy("_rank", "pos"))).drop("_rank")


def ellipse_points(df: DataFrame, n: int = 40, to_photo: str | None = None) -> DataFrame:
    """One row per point of the ellipse around a box, its radii 3 px larger than half its sides and at least 2; the last point is the
    first one again. With `to_photo`, the column with the matrix of the row's image, photo_x and photo_y are the point in the photo."""
    rx, ry = (F.greatest(F.lit(2.0), (F.col(f"{a}2") - F.col(f"{a}1")) / 2 + 3) for a in "xy")
    cx, cy = ((F.col(f"{a}1") + F.col(f"{a}2")) / 2 for a in "xy")
    out = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"))
    angle = F.col("k") * (2 * 3.141592653589793 / (n - 1))
    out = out.withColumns({"px": cx + rx * F.cos(angle), "py": cy + ry * F.sin(angle)})
    if to_photo is None:
        return out
    out = out.withColumn("_photo", F.expr(transform_points("array(array(px, py))", to_photo)))
    return out.withColumns({"photo_x": F.expr("_photo[0][0]"), "photo_y": F.expr("_photo[0][1]")}).drop("_photo")


def route_errors(df: DataFrame, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows) by `violations`; with fail_fast the first bad row by image and position ends the job, the same one however
    the rows are dealt."""
    bad = F.size("violations") > 0
    good = df.filter(~bad).drop("violations")
    errors = df.filter(bad).select("image_id", "pos", F.lit("ValueError").alias("error_type"), F.array_join("violations", ",").alias("message"))
    return (require_none(good, errors, "image_id", "pos") if fail_fast else good), errors


def attach_ocr(df: DataFrame, ocr: DataFrame) -> DataFrame:
    """At most one OCR result per box; boxes without keep nulls."""
    return df.join(ocr, ["image_id", "label"], "left")


def aggregate_ocr_lines(lines: DataFrame, *keys: str, images: DataFrame | None = None) -> DataFrame:
    """Text of the cleaned non-empty lines in order, and the mean score over all lines. Rows of `images` (the keys) without any line have
    an empty text and no score."""
    from tallyslip.functions.text import clean_text

    own = lines.withColumn("_t", clean_text(F.col("text")))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "_t")))
    texts = F.filter(F.transform(ordered, lambda x: x["_t"]), lambda t: t != "")
    out = own.groupBy(*keys).agg(F.array_join(texts, " ").alias("text"), F.avg("score").alias("confidence"), F.count(F.lit(1)).alias("n_lines"))
    return out if images is None else images.select(*keys).join(out, list(keys), "left").fillna({"text": "", "n_lines": 0})


def field_state(score: Column, text: Column) -> Column:
    """absent without a box, unreadable without text, else read."""
    return F.when(score.isNull(), "absent").when(F.coalesce(text, F.lit("")) == "", "unreadable").otherwise("read")
