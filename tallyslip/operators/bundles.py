"""Result bundles: one JSON document per image, with its geometry, fields and boxes.

Documents are strings made of `to_json` parts, since which keys a part has depends on its state. Figures are rounded as their exact
binary values demand, points in the photo as arrays are (functions/numbers.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyslip.functions.geometry import transform_points
from tallyslip.functions.numbers import round_exact, round_scaled
from tallyslip.functions.text import extract_field_value, normalize_amount, normalize_payment_method, normalize_status, normalize_time
from tallyslip.operators.detections import field_state

# Keys of the fields in a bundle and the labels that they show.
FIELDS = {"time": "time", "amount": "amount", "transfer_status": "transfer_status", "recipient": "recipient_field", "payment_method": "payment_method_field"}


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _object(**parts: Column) -> Column:
    """A JSON object of JSON texts; keys whose text is null are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in parts.items()]), F.lit("}"))


def field_value(field: str, of: str) -> Column:
    """What a field's text (in the struct column `of`) comes to: amounts a struct, the others a string."""
    text = F.col(f"{of}.text")
    if field in ("recipient", "payment_method"):
        return extract_field_value(text, field)
    return {"time": normalize_time, "amount": normalize_amount, "transfer_status": normalize_status}[field](text)


def field_document(field: str, of: str, value: Column) -> Column:
    """A field (the struct column `of` with score, text and confidence) as JSON: absent, unreadable (with the box's score) or read (text, both scores, and the normalised values its kind
    has). An amount with a figure shows the cleaned text. `value` is the column with its field_value: texts are matched once, not in every part that shows them."""
    score, text = F.col(f"{of}.score"), F.col(f"{of}.text")
    state, box = field_state(score, text).alias("state"), F.expr(round_exact(f"{of}.score", 6))
    nothing = F.lit(None).cast("string").alias("raw")
    scores = [F.expr(round_exact(f"{of}.confidence", 6)).alias("ocr_confidence"), box.alias("detector_score")]
    plain = [state, text.alias("raw"), *scores]
    read = _json(*plain)
    if field in ("time", "recipient"):
        read = _json(*plain, value.alias("value"))
    elif field == "amount":
        figures = [value["normalized"].alias("normalized"), value["amount_fen"].alias("amount_fen"), value["currency"].alias("currency")]
        read = F.when(value.isNotNull(), _json(state, value["raw"].alias("raw"), *scores, *figures)).otherwise(read)
    elif field == "transfer_status":
        read = _json(*plain, value.alias("normalized"))
    elif field == "payment_method":
        read = _json(*plain, value.alias("value"), normalize_payment_method(value).alias("normalized"))
    return F.when(state == "absent", _json(state, nothing)).when(state == "unreadable", _json(state, nothing, box.alias("score"))).otherwise(read)


def detection_document(x: str, to_original: str) -> str:
    """SQL text: a box (struct of label, score, x1..y2, text, confidence) as JSON, with its corners in the photo under the matrix of its
    image; `ocr` only where there is a text."""
    polygon = transform_points(f"array(array({x}.x1, {x}.y1), array({x}.x2, {x}.y1), array({x}.x2, {x}.y2), array({x}.x1, {x}.y2))", to_original)
    flat = (
        f"{x}.label AS label, {round_exact(f'{x}.score', 6)} AS score, array({', '.join(round_exact(f'{x}.{c}', 3) for c in ('x1', 'y1', 'x2', 'y2'))}) AS bbox_rectified, "
        f"transform({polygon}, p -> transform(p, v -> {round_scaled('v', 3)})) AS quad_original"
    )
    keep = "map('ignoreNullFields', 'false')"
    ocr = f"struct({x}.text AS text, {round_exact(f'{x}.confidence', 6)} AS confidence) AS ocr"
    return f"CASE WHEN {x}.text IS NOT NULL THEN to_json(struct({flat}, {ocr}), {keep}) ELSE to_json(struct({flat}), {keep}) END"


def write_bundles(images: DataFrame, boxes: DataFrame, styles: DataFrame | None = None) -> DataFrame:
    """(image_id, document) per row of `images` (image_id, source, geometry struct, to_original: nine numbers by rows); `boxes`
    (image_id, pos, label, score, x1..y2, text, confidence) are in order of pos, and of repeated labels the last gives the field.
    `styles` (image_id, status_style and tags as JSON) add their keys where an image has them. Boxes meet the matrix of their image
    once, as a list: one shuffle on the image."""
    picked = {f: F.max_by(F.struct("score", "text", "confidence"), F.when(F.col("label") == label, F.col("pos"))).alias(f"_{f}") for f, label in FIELDS.items()}
    in_order = F.array_sort(F.collect_list(F.struct("pos", F.struct("label", "score", "x1", "y1", "x2", "y2", "text", "confidence").alias("box"))))
    rows = images.join(boxes.groupBy("image_id").agg(in_order.alias("_list"), *picked.values()), "image_id", "left")
    rows = rows.withColumn("_boxes", F.expr(f"array_join(transform(_list, x -> {detection_document('x.box', 'to_original')}), ',')"))
    if styles is not None:
        rows = rows.join(styles.select("image_id", "status_style", "tags"), "image_id", "left")
    optional = {c: F.col(c) for c in ("status_style", "tags")} if styles is not None else {}
    rows = rows.withColumns({f"_{f}_value": field_value(f, f"_{f}") for f in FIELDS})
    fields = _object(**{f: field_document(f, f"_{f}", F.col(f"_{f}_value")) for f in FIELDS})
    source = F.substring(_json(F.col("source").alias("s")), 6, 1 << 30)
    document = _object(
        source=F.expr("left(_source, length(_source) - 1)"), geometry=F.to_json("geometry", {"ignoreNullFields": "false"}), fields=fields,
        detections=F.concat(F.lit("["), F.coalesce("_boxes", F.lit("")), F.lit("]")), **optional,
    )
    return rows.withColumn("_source", source).select("image_id", document.alias("document"))
