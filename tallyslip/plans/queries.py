"""Registered queries of the receipt operators over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyslip.functions import geometry as geo
from tallyslip.functions import style, text
from tallyslip.operators import batch, bundles, crops, detections, errors, rectify, review
from tallyslip.plans.fixtures import fixture
from tallyslip.sources import files

QUERIES = {}
THRESHOLD, WIDTH, HEIGHT, SHARDS = 0.5, 720, 1280, 8
STYLE = {"schema_version": 2, "model": "style-1", "config": 0.3}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _best(spark: SparkSession, d: str) -> DataFrame:
    boxes = detections.threshold_detections(fixture(spark, d, "fx_detections"), THRESHOLD)
    return detections.best_per_label(detections.map_labels(boxes))


def _receipt_ocr(spark: SparkSession, d: str) -> DataFrame:
    """One OCR text per image and label from time, amount and field rows, keyed as detections are."""
    amounts = fixture(spark, d, "fx_amount_text").groupBy("image_id").agg(F.min_by("text", "row_id").alias("text")).withColumn("label", F.lit("amount"))
    fields = {"recipient": "recipient_field", "status": "transfer_status", "payment": "payment_method_field"}
    each = F.explode(F.array(*[F.struct(F.col(c).alias("text"), F.lit(label).alias("label")) for c, label in fields.items()])).alias("f")
    rows = fixture(spark, d, "fx_field_rows").select(F.col("row_id").alias("image_id"), each).select("image_id", "f.*")
    times = fixture(spark, d, "fx_time_text").select(F.col("row_id").alias("image_id"), "text", F.lit("time").alias("label"))
    return amounts.select("image_id", "text", "label").unionByName(rows).unionByName(times)


# --- selection and batches


@query
def selection_key(spark, d):
    return fixture(spark, d, "fx_paths").select("image_id", batch.selection_key(F.col("image_id")).alias("key"))


@query
def assign_shard(spark, d):
    return batch.assign_shard(fixture(spark, d, "fx_paths"), SHARDS).select("image_id", "shard")


@query
def select_shard(spark, d):
    return batch.select_shard(fixture(spark, d, "fx_paths"), 3, SHARDS).select("image_id", "shard")


@query
def sample_cohort(spark, d):
    return batch.sample_cohort(fixture(spark, d, "fx_paths"), 100).select("image_id", "key")


@query
def scan_images(spark, d):
    return batch.images_only(fixture(spark, d, "fx_paths")).select("image_id", "length")


def _corrections(spark, d):
    """The view's flat corners as a list of points, null where a correction has none."""
    quad = F.array(*[F.array(f"q{c}x", f"q{c}y") for c in geo.CORNERS])
    rows = fixture(spark, d, "fx_corrections").withColumn("screen_quad", F.when(F.col("qax").isNotNull(), quad))
    return rows.drop(*[f"q{c}{k}" for c in geo.CORNERS for k in "xy"])


def _corrected(spark, d):
    return batch.join_corrections(fixture(spark, d, "fx_paths"), _corrections(spark, d))


@query
def join_corrections(spark, d):
    return _corrected(spark, d).select("image_id", F.col("correction.c_id").alias("c_id"))


@query
def drop_skipped(spark, d):
    return batch.drop_skipped(_corrected(spark, d)).select("image_id")


@query
def apply_defaults(spark, d):
    rows = batch.apply_defaults(_corrected(spark, d))
    corners = [v.alias(f"q_{k}") for k, v in geo.corners("screen_quad").items()]
    return rows.select("image_id", "orientation_degrees", "prefer_portrait", "auto_screen", "max_side", *corners)


@query
def output_name_collisions(spark, d):
    return batch.output_name_collisions(fixture(spark, d, "fx_paths"))


@query
def is_bundle_committed(spark, d):
    return batch.split_committed(fixture(spark, d, "fx_paths"), fixture(spark, d, "fx_bundles")).select("image_id", "committed")


@query
def split_committed(spark, d):
    rows = batch.split_committed(fixture(spark, d, "fx_paths"), fixture(spark, d, "fx_bundles"))
    return rows.groupBy("committed").agg(F.count(F.lit(1)).alias("n"))


@query
def write_manifest(spark, d):
    return batch.manifest_rows(batch.split_committed(fixture(spark, d, "fx_paths"), fixture(spark, d, "fx_bundles")))


@query
def rehydrate(spark, d):
    return batch.rehydrate(fixture(spark, d, "fx_stage"), fixture(spark, d, "fx_paths")).select("source", "error")


@query
def overlapping_paths(spark, d):
    paths = fixture(spark, d, "fx_paths")
    folder = F.regexp_replace("image_id", "/[^/]*$", "")
    outputs = paths.select(F.when(F.col("page_id") % 17 == 0, folder).when(F.col("page_id") % 13 == 0, F.col("image_id")).otherwise(F.concat(F.lit("out/"), "image_id")).alias("image_id"))
    return batch.overlapping_paths(outputs, paths)


@query
def unmatched_names(spark, d):
    return batch.unmatched_names(fixture(spark, d, "fx_paths"), "m.example.com").select("image_id")


@query
def stale_crops(spark, d):
    return batch.stale_crops(fixture(spark, d, "fx_paths"), fixture(spark, d, "fx_bundles"))


@query
def group_id(spark, d):
    result = F.concat(batch.stem_of(F.col("image_id")), F.lit(".json"))
    return fixture(spark, d, "fx_paths").select("image_id", batch.group_id(F.col("image_id"), result).alias("group_id"))


@query
def capture_groups(spark, d):
    return group_id(spark, d).groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))


@query
def choose_orientation(spark, d):
    return batch.choose_orientation(fixture(spark, d, "fx_orient"))


# --- detections


@query
def threshold_detections(spark, d):
    return detections.threshold_detections(fixture(spark, d, "fx_detections"), THRESHOLD).select("image_id", "pos", "score")


@query
def map_labels(spark, d):
    return detections.map_labels(fixture(spark, d, "fx_detections")).select("image_id", "pos", "label")


@query
def validate_detections(spark, d):
    return detections.validate_detections(fixture(spark, d, "fx_detections")).select("image_id", "pos", F.array_join("violations", ",").alias("violations"))


@query
def best_per_label(spark, d):
    return _best(spark, d).select("image_id", "label", "pos", "score")


@query
def completeness(spark, d):
    return detections.completeness(fixture(spark, d, "fx_detections"), _best(spark, d))


@query
def pivot_fields(spark, d):
    boxes = detections.map_labels(fixture(spark, d, "fx_detections"))
    return detections.pivot_fields(boxes, F.col("pos"))


@query
def status_box(spark, d):
    return detections.status_box(detections.map_labels(fixture(spark, d, "fx_detections")))


@query
def ocr_crop_box(spark, d):
    return detections.ocr_crop_box(fixture(spark, d, "fx_detections"), WIDTH, HEIGHT).select("pos", "left", "top", "right", "bottom")


@query
def status_crop_box(spark, d):
    return detections.status_crop_box(fixture(spark, d, "fx_detections"), WIDTH, HEIGHT).select("pos", "left", "top", "right", "bottom", "crop_error")


@query
def caption(spark, d):
    rows = detections.attach_ocr(_best(spark, d), _receipt_ocr(spark, d))
    return rows.select("image_id", "label", detections.caption(F.col("label"), F.col("text"), F.col("score")).alias("caption"))


@query
def caption_rows(spark, d):
    return detections.caption_rows(_best(spark, d)).select("image_id", "label", "number")


def _photos_of_boxes(spark, d):
    """Photos of the images that have boxes, with options by arithmetic on their number, and their plans."""
    ids, n = fixture(spark, d, "fx_detections").select("image_id").distinct(), F.col("image_id")
    photos = ids.select(
        "image_id", F.when(n % 3 == 0, 1400).otherwise(800).alias("w"), F.when(n % 3 == 0, 800).otherwise(1400).alias("h"),
        F.when(n % 5 == 0, (n % 4 * 90).cast("int")).alias("orientation_degrees"), (n % 7 != 0).alias("prefer_portrait"), (n % 6 != 0).alias("auto_screen"),
        F.lit(None).cast("array<array<double>>").alias("screen_quad"), F.when(n % 4 == 0, 0).otherwise(1280).alias("max_side"),
    )
    return rectify.plan_rectification(photos, fixture(spark, d, "fx_quads").withColumnRenamed("by_", "by"))


@query
def ellipse_points(spark, d):
    """Points of the closed ellipses round the best boxes, in the rectified image and in the photo."""
    matrices = _photos_of_boxes(spark, d).select("image_id", "to_original")
    out = detections.ellipse_points(_best(spark, d).join(matrices, "image_id", "left"), to_photo="to_original")
    return out.select("pos", "k", *[F.round(c, 6).alias(c) for c in ("px", "py", "photo_x", "photo_y")])


@query
def route_errors(spark, d):
    good, errors = detections.route_errors(detections.validate_detections(fixture(spark, d, "fx_detections")))
    return good.select("pos", F.lit(None).cast("string").alias("message")).unionByName(errors.select("pos", "message"))


@query
def batch_summary(spark, d):
    manifest = write_manifest(spark, d)
    _, errors = detections.route_errors(detections.validate_detections(fixture(spark, d, "fx_detections")))
    return batch.batch_summary(manifest, errors)


@query
def union_errors(spark, d):
    _, first = detections.route_errors(detections.validate_detections(fixture(spark, d, "fx_detections")))
    second = batch.rehydrate(fixture(spark, d, "fx_stage"), fixture(spark, d, "fx_paths")).filter("error is not null")
    return batch.union_in_stages(first.select(F.col("image_id").cast("string").alias("source"), "message"), second.select("source", F.col("error").alias("message")))


@query
def attach_ocr(spark, d):
    out = detections.attach_ocr(_best(spark, d), _receipt_ocr(spark, d))
    return out.select("image_id", "label", "text")


@query
def aggregate_ocr_lines(spark, d):
    out = detections.aggregate_ocr_lines(fixture(spark, d, "fx_ocr_lines"), "image_id", "class_id")
    return out.select("image_id", "class_id", "text", F.round("confidence", 9).alias("confidence"), "n_lines")


@query
def build_fields(spark, d):
    """One row per image with the states and normalised values of its five fields."""
    rows = detections.attach_ocr(_best(spark, d), _receipt_ocr(spark, d))
    rows = rows.withColumns({"state": detections.field_state(F.col("score"), F.col("text")), "text": F.nullif("text", F.lit(""))})
    fields = detections.pivot_fields(rows, F.struct("state", "text"))
    state = {c: F.coalesce(F.col(f"{c}.state"), F.lit("absent")).alias(f"{c}_state") for c in text.LABELS}
    return fields.select(
        "image_id", *state.values(),
        text.normalize_time(F.col("time.text")).alias("time_value"),
        text.normalize_amount(F.col("amount.text"))["amount_fen"].cast("long").alias("amount_fen"),
        F.when(F.col("transfer_status.text").isNotNull(), text.normalize_status(F.col("transfer_status.text"))).alias("status"),
        text.extract_field_value(F.col("recipient_field.text"), "recipient").alias("recipient"),
        F.when(F.col("payment_method_field.text").isNotNull(), text.normalize_payment_method(F.col("payment_method_field.text"))).alias("payment"),
    )


@query
def field_state(spark, d):
    rows = detections.attach_ocr(_best(spark, d), _receipt_ocr(spark, d))
    return rows.select("image_id", "label", detections.field_state(F.col("score"), F.col("text")).alias("state"))


@query
def write_bundles(spark, d):
    """One JSON document per image that has boxes, with its geometry, the boxes in the photo, and the style of its status box where it
    has class probabilities."""
    best = _best(spark, d)
    spoken = F.when(F.col("text").isNotNull() & (F.col("image_id") % 9 != 0), (F.col("image_id") * 7 % 100).cast("double") / 100)
    boxes = detections.attach_ocr(best, _receipt_ocr(spark, d)).withColumn("confidence", spoken)
    images = _photos_of_boxes(spark, d).select(
        "image_id", F.concat(F.lit("in/"), F.col("image_id").cast("string"), F.lit(".png")).alias("source"), rectify.geometry_record().alias("geometry"), "to_original",
    ).join(best.select("image_id").distinct(), "image_id", "left_semi")
    named = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    tags = ("platform", "authenticity", "review_tag", "requires_manual_review", "reason", "rule_version")
    styles = style.style_tags(style_record(spark, d).filter("state != 'unavailable'"))
    styles = styles.select("image_id", named("schema_version", "state", "label", F.round("confidence", 6).alias("confidence"), "business_tag", "model").alias("status_style"), named(*tags).alias("tags"))
    return bundles.write_bundles(images, boxes, styles)


# --- text


@query
def clean_text(spark, d):
    return fixture(spark, d, "fx_ocr_lines").select("image_id", "line_no", text.clean_text(F.col("text")).alias("text"))


@query
def extract_field_value(spark, d):
    return fixture(spark, d, "fx_field_rows").select("row_id", text.extract_field_value(F.col("recipient"), "recipient").alias("value"))


@query
def normalize_time(spark, d):
    return fixture(spark, d, "fx_time_text").select("row_id", text.normalize_time(F.col("text")).alias("time"))


@query
def normalize_amount(spark, d):
    amount = text.normalize_amount(F.col("text"))
    return fixture(spark, d, "fx_amount_text").select("row_id", amount["normalized"].alias("normalized"), amount["amount_fen"].cast("long").alias("amount_fen"))


@query
def normalize_status(spark, d):
    return fixture(spark, d, "fx_field_rows").select("row_id", text.normalize_status(F.col("status")).alias("status"))


@query
def normalize_payment_method(spark, d):
    return fixture(spark, d, "fx_field_rows").select("row_id", text.normalize_payment_method(F.col("payment")).alias("payment"))


# --- geometry


def _quads(spark, d):
    return geo.order_quad(fixture(spark, d, "fx_quads").withColumnRenamed("by_", "by"))


@query
def order_quad(spark, d):
    q = _quads(spark, d)
    return q.select("pos", "ax", "ay", "bx", F.col("by").alias("by_"), "cx", "cy", "dx", "dy")


@query
def quad_score(spark, d):
    return _quads(spark, d).select("pos", F.round(geo.quad_score(), 6).alias("score"))


@query
def best_quad(spark, d):
    """The chosen screen of every image, the full image where no candidate is one."""
    q = geo.best_quad(_quads(spark, d))
    return q.select("image_id", "pos", "screen_detected", *[F.col(f"{c}{k}").alias(f"q_{c}{k}") for c in geo.CORNERS for k in "xy"])


@query
def output_size(spark, d):
    return geo.output_size(_quads(spark, d), 1000).select("pos", "out_w", "out_h")


@query
def rotation_homography(spark, d):
    h = geo.rotation_homography((F.col("pos") % 4 * 90).cast("int"), F.col("w"), F.col("h"))
    return fixture(spark, d, "fx_quads").select("pos", *[h[i].alias(f"h{i}") for i in range(9)])


@query
def homography(spark, d):
    """h: unit square to quad; m: quad to rectangle; n: its inverse; and whether their product is the identity."""
    q = geo.output_size(geo.square_to_quad(_quads(spark, d)), 1000)
    q = geo.quad_to_rectangle(q.withColumns({f"_h{i}": F.col(f"h{i}") for i in range(9)})).withColumn("back", F.expr(geo.inverse("to_rectangle")))
    q = q.withColumn("product", F.expr(geo.multiply("to_rectangle", "back")))
    same = F.expr("forall(transform(product, (v, i) -> abs(v - CASE WHEN i % 4 = 0 THEN 1 ELSE 0 END)), e -> e < 1e-6)")
    at = lambda m, n: [F.expr(f"round({m}[{i}], 6)").alias(f"{n}{i}") for i in range(9)]
    return q.select("pos", *[F.round(f"_h{i}", 6).alias(f"h{i}") for i in range(9)], *at("to_rectangle", "m"), *at("back", "n"), same.alias("is_inverse"))


@query
def project_points(spark, d):
    q = geo.square_to_quad(_quads(spark, d))
    x, y = geo.project(F.lit(0.25), F.lit(0.75))
    return q.select("pos", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


# --- style


def _probs(spark, d):
    return fixture(spark, d, "fx_probs").withColumn("probs", style.softmax(F.array("l0", "l1", "l2")))


@query
def softmax(spark, d):
    return _probs(spark, d).select("image_id", *[F.round(F.col("probs")[i], 9).alias(f"p{i}") for i in range(3)])


def _gated(spark, d):
    return _probs(spark, d).withColumn("g", style.gate_style(F.col("probs"), 0.80, 0.95)).select("image_id", "g.*")


@query
def gate_style(spark, d):
    return _gated(spark, d).select("image_id", "label", "candidate", F.round("confidence", 9).alias("confidence"))


@query
def style_tags(spark, d):
    return style.style_tags(_gated(spark, d)).select("image_id", "platform", "review_tag", "requires_manual_review", "reason", style.business_tag(F.col("label")).alias("business_tag"))


@query
def style_record(spark, d):
    boxes = detections.map_labels(fixture(spark, d, "fx_detections"))
    best = detections.status_box(boxes).select("image_id", "pos").join(boxes.select("pos", "x1", "y1", "x2", "y2"), "pos")
    return style.style_record(best, _gated(spark, d), STYLE["model"], STYLE["config"]).drop("pos")


# --- review


@query
def read_label_manifest(spark, d):
    return review.read_label_manifest(fixture(spark, d, "fx_label_lines")).select("line_no", "violations")


def _merged(spark, d):
    return review.merge_review_labels(fixture(spark, d, "fx_manifest"), fixture(spark, d, "fx_reviewed"))


@query
def merge_review_labels(spark, d):
    return _merged(spark, d).select("ord", "label")


@query
def orphan_labels(spark, d):
    return review.orphan_labels(fixture(spark, d, "fx_reviewed"), fixture(spark, d, "fx_manifest"))


@query
def extend_cohort(spark, d):
    manifest = fixture(spark, d, "fx_manifest")
    renamed = F.when(F.col("ord") % 3 == 0, F.col("result_json")).otherwise(F.concat(F.lit("old/"), "result_json"))
    return review.extend_cohort(manifest.withColumn("result_json", renamed), manifest).select("result_json", "is_new", "key", "label")


@query
def review_progress(spark, d):
    return review.review_progress(_merged(spark, d))


@query
def duplicate_keys(spark, d):
    rows = fixture(spark, d, "fx_manifest")
    twice = rows.select("ord", "result_json").unionByName(rows.select((F.col("ord") + 10_000_000).alias("ord"), F.when(F.col("ord") % 6 == 0, F.lower("result_json")).otherwise(F.concat("result_json", F.lit(".copy"))).alias("result_json")))
    return review.duplicate_keys(twice)


@query
def next_unlabelled(spark, d):
    return review.next_unlabelled(_merged(spark, d)).select("ord", "next_ord")


@query
def review_position(spark, d):
    return review.review_position(fixture(spark, d, "fx_manifest")).select("ord", "position")


@query
def limit_valid(spark, d):
    return review.limit_valid(_merged(spark, d), 50).select("result_json", "label")


def _export(spark, d, limit=None):
    photos = fixture(spark, d, "fx_photos").join(fixture(spark, d, "fx_paths").select("page_id", "mtime"), "page_id")
    sources = photos.select(F.concat(F.lit("/photos/"), "image_id").alias("source"), F.col("w").alias("width"), F.col("h").alias("height"), "mtime")
    results = fixture(spark, d, "fx_results").select("result_json", "value", "mtime")
    return crops.export_crops(results, sources, fixture(spark, d, "fx_cohort"), fixture(spark, d, "fx_crops"), limit=limit)


@query
def export_cohort(spark, d):
    """The new cohort of a crop export: former members in their order, those that fail with their former record, then new ones."""
    return _export(spark, d)[0]


@query
def export_crop_plan(spark, d):
    """What is to be cut, and where."""
    return _export(spark, d)[1].select("result_json", "source", "crop", "left", "top", "right", "bottom")


@query
def export_errors(spark, d):
    return _export(spark, d)[2]


@query
def first_error(spark, d):
    """The one error that would end the export if it didn't continue."""
    return errors.first_error(_export(spark, d)[2], *crops.ORDER)


# --- resume, manifests, captions and geometry records


@query
def is_bundle_committed_style(spark, d):
    rows = batch.split_committed(fixture(spark, d, "fx_paths"), fixture(spark, d, "fx_bundles"), style=STYLE)
    return rows.select("image_id", "committed")


@query
def result_paths(spark, d):
    return fixture(spark, d, "fx_paths").select("image_id", *batch.result_paths(F.col("image_id")))


@query
def union_manifests(spark, d):
    """Manifests of all shards as one; skipped rows are carried past the text reading."""
    rows = batch.assign_shard(batch.split_committed(fixture(spark, d, "fx_paths"), fixture(spark, d, "fx_bundles")), 2)
    work, carried = batch.union_manifests(*[batch.manifest_rows(rows.filter(F.col("shard") == i)) for i in range(2)])
    return work.withColumn("carried", F.lit(False)).unionByName(carried.withColumn("carried", F.lit(True)))


@query
def require_same_config(spark, d):
    """Configs under which crops were made, and whether they are the wanted one."""
    return batch.config_mismatches(fixture(spark, d, "fx_bundles"), {"style_config": 0.3, "style_model": "style-1"})


def _planned(spark, d):
    """Plans of all photos under their corrections, run defaults and orientation scores. Paths may repeat, so photos are keyed by number."""
    photos = batch.join_corrections(fixture(spark, d, "fx_photos"), _corrections(spark, d))
    photos = batch.drop_skipped(photos)
    photos = batch.apply_defaults(photos).select(F.col("image_id").alias("path"), F.col("page_id").alias("image_id"), "w", "h", "orientation_degrees", "prefer_portrait", "auto_screen", "screen_quad", "max_side")
    turns = fixture(spark, d, "fx_turns").drop("image_id").withColumnRenamed("page_id", "image_id")
    return rectify.plan_rectification(photos, fixture(spark, d, "fx_quads").withColumnRenamed("by_", "by"), turns)


@query
def rectification_manifest(spark, d):
    """The geometry of every prepared photo, nested values as JSON."""
    rows = _planned(spark, d).filter("error is null").select(F.col("path").alias("image_id"), rectify.geometry_record().alias("g"))
    rows = batch.rectification_manifest(rows, "/photos", F.col("g"))
    return rows.select(*[F.to_json(c).alias(c) if "array" in t or "struct" in t else F.col(c) for c, t in rows.dtypes])


@query
def plan_rectification(spark, d):
    """What each photo's plan comes to, and the option that can't be followed."""
    return _planned(spark, d).select("image_id", "rotation_degrees", "screen_detected", "rectified_w", "rectified_h", "error")


@query
def validate_geometry(spark, d):
    z, one = F.lit(0.0), F.lit(1.0)
    m = lambda *names: F.array(*[F.col(n).cast("double") if isinstance(n, str) else n for n in names])
    rows = fixture(spark, d, "fx_geometry").withColumns({
        "to_rectified": m("a", z, "tx", z, "b", "ty", z, z, one), "to_original": m("ia", z, "itx", z, "ib", "ity", z, z, one),
        "screen_quad": F.array(m("qx", z), m(one, z), m(one, one), m(z, one)), "source_w": F.col("w"), "source_h": F.col("h"), "now_source_w": F.col("now_w"),
        "now_source_h": F.col("h"), "rectified_w": F.col("w"), "rectified_h": F.col("h"), "now_rectified_w": F.col("w"), "now_rectified_h": F.col("now_h"),
    })
    return geo.validate_geometry(rows).select("pos", F.array_join("violations", ",").alias("violations"))


@query
def bbox_to_polygon(spark, d):
    """Boxes as quads, and the quad of the whole image behind them."""
    rows = fixture(spark, d, "fx_detections")
    p, f = geo.bbox_to_polygon(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]), geo.full_image_quad(F.lit(WIDTH), F.lit(HEIGHT))
    at = lambda a, n: [F.get(F.get(a, F.lit(i)), F.lit(k)).alias(f"{n}{i}{'xy'[k]}") for i in range(4) for k in range(2)]
    return rows.select("pos", *at(p, "p"), *at(f, "f"))


@query
def validate_images(spark, d):
    return detections.validate_images(fixture(spark, d, "fx_detections")).select("image_id", F.array_join("violations", ",").alias("violations"))


@query
def structured_caption_text(spark, d):
    rows = detections.attach_ocr(_best(spark, d), _receipt_ocr(spark, d))
    return rows.select("image_id", "label", detections.structured_caption_text(F.col("label"), F.col("text")).alias("text"))


@query
def style_caption(spark, d):
    """Captions of status styles, and their number behind those of the image's boxes."""
    styles = _gated(spark, d)
    rows = detections.caption_rows(_best(spark, d), styles).filter("label = 'status_style'").select("image_id", "number")
    return rows.join(styles, "image_id").select("image_id", "number", detections.style_caption(F.col("label"), F.col("confidence")).alias("caption"))


@query
def load_corrections(spark, d):
    rows = files.load_corrections(fixture(spark, d, "fx_correction_docs"))
    quad = F.to_json("screen_quad").alias("screen_quad")
    return rows.select(*[quad if c == "screen_quad" else F.col(c) for c in rows.columns])


@query
def flatten_ocr_payload(spark, d):
    return files.flatten_ocr_payload(fixture(spark, d, "fx_payloads")).select("doc_id", "line_no", "text", "score")
