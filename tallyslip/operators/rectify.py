"""Plans of rectification: turn, screen quad, size and both matrices of every photo in one pass, without touching pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyslip.functions import geometry as geo
from tallyslip.functions.numbers import round_scaled
from tallyslip.operators.batch import choose_orientation

BAD_TURN, BAD_SIDE = "orientation must be a multiple of 90", "max_side must be 0 or at least 2"


def plan_rectification(photos: DataFrame, candidates: DataFrame | None = None, turns: DataFrame | None = None) -> DataFrame:
    """`photos` (image_id unique, w, h, and the options orientation_degrees, prefer_portrait, auto_screen, screen_quad, max_side) with
    source_w, source_h, rectified_w, rectified_h, rotation_degrees, screen_detected, screen_quad_original, to_rectified, to_original
    and `error`, the first option that can't be followed (then there is no plan).

    Turn: the given one modulo 360, else the best of `turns` (image_id, degrees, confidence, n_lines), else upright for wide photos
    that should be portraits. Quad: the given one, else with auto_screen the best of `candidates` (image_id, pos, ax..dy, in the
    turned photo), else the whole image. Candidates and turns meet photos in one join each, only where they can count."""
    turn = F.pmod("orientation_degrees", F.lit(360))
    rows = photos
    if turns is not None:
        open_ = photos.filter("orientation_degrees is null").select("image_id", "w", "h", "prefer_portrait", F.lit(None).cast("int").alias("explicit_degrees"))
        best = choose_orientation(turns.select("image_id", "degrees", "confidence", "n_lines").join(open_, "image_id"), F.col("prefer_portrait"))
        rows = rows.join(best.withColumnRenamed("orientation", "_scored"), "image_id", "left")
    else:
        rows = rows.withColumn("_scored", F.lit(None).cast("int"))
    wide = F.when(F.col("prefer_portrait") & (F.col("w") > F.col("h")), 90).otherwise(0)
    rows = rows.withColumn("rotation_degrees", F.coalesce(turn, "_scored", wide).cast("int"))
    rows = rows.withColumn("_own", F.expr(geo.order_points("screen_quad")))
    error = (
        F.when(F.col("rotation_degrees") % 90 != 0, BAD_TURN).when(F.col("screen_quad").isNotNull() & F.col("_own").isNull(), geo.REPEATED_CORNERS)
        .when((F.col("max_side") < 0) | (F.col("max_side") == 1), BAD_SIDE)
    )
    flat = F.col("rotation_degrees") % 180 == 0
    rows = rows.withColumns({
        "error": error, "_turn": geo.rotation_homography(F.col("rotation_degrees"), F.col("w"), F.col("h")),
        "_w": F.when(flat, F.col("w")).otherwise(F.col("h")), "_h": F.when(flat, F.col("h")).otherwise(F.col("w")),
    }).withColumn("_back", F.expr(geo.inverse("_turn")))

    full = geo.full_image_quad(F.col("_w"), F.col("_h")).cast("array<array<double>>")
    found = F.lit(None).cast("array<array<double>>")
    if candidates is not None:
        where = rows.filter("auto_screen AND screen_quad is null AND error is null").select("image_id", F.col("_w").alias("w"), F.col("_h").alias("h"), "prefer_portrait")
        ordered = geo.order_quad(candidates.select("image_id", "pos", *[f"{c}{k}" for c in geo.CORNERS for k in "xy"]).join(where, "image_id"))
        best = geo.best_quad(ordered, F.col("prefer_portrait")).filter("screen_detected").select("image_id", F.col("quad").alias("_found"))
        rows, found = rows.join(best, "image_id", "left"), F.col("_found")
    else:
        rows = rows.withColumn("_found", found)
    turned = F.expr(geo.order_points(geo.transform_points("_own", "_turn")))
    quad = F.coalesce(F.when(F.col("_own").isNotNull(), turned), "_found", full)
    rows = rows.withColumns({"screen_detected": F.col("_own").isNotNull() | F.col("_found").isNotNull(), "_quad": F.when(F.col("error").isNull(), quad)})
    rows = rows.withColumn("_quad", F.expr(geo.order_points("_quad")))
    rows = rows.withColumn("screen_quad_original", F.expr(geo.order_points(f"coalesce(_own, {geo.transform_points('_quad', '_back')})")))
    sized = geo.output_size(rows.withColumns(geo.corners("_quad")), F.col("max_side"))
    mapped = geo.quad_to_rectangle(sized).withColumn("to_rectified", F.expr(geo.multiply("to_rectangle", "_turn")))
    mapped = mapped.withColumns({"to_original": F.expr(geo.inverse("to_rectified")), "rectified_w": F.col("out_w"), "rectified_h": F.col("out_h")})
    results = ["rotation_degrees", "screen_detected", "screen_quad_original", "to_rectified", "to_original", "rectified_w", "rectified_h"]
    kept = [c for c in photos.columns if c not in results]
    good = F.col("error").isNull()
    return mapped.select(*kept, F.col("w").alias("source_w"), F.col("h").alias("source_h"), *[F.when(good, F.col(c)).alias(c) for c in results], "error")


def geometry_record() -> Column:
    """The geometry of a planned row as it is written: sizes, turn, quad (3 decimals) and both matrices by rows (8 decimals)."""
    size = lambda k: F.struct(F.col(f"{k}_w").alias("width"), F.col(f"{k}_h").alias("height")).alias(f"{k}_size")
    points = F.expr(f"transform(screen_quad_original, p -> transform(p, v -> {round_scaled('v', 3)}))").alias("screen_quad_original")
    by_rows = lambda m: f"transform(array(0, 3, 6), r -> transform(slice({m}, r + 1, 3), v -> {round_scaled('v', 8)}))"
    rows = lambda m, name: F.expr(by_rows(m)).alias(name)
    return F.struct(
        size("source"), size("rectified"), "rotation_degrees", "screen_detected", points,
        rows("to_rectified", "H_original_to_rectified"), rows("to_original", "H_rectified_to_original"),
    )
