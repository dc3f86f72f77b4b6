"""Geometry on corners and matrices, as column arithmetic. Quads are columns ax..dy, four corners in order, or arrays of four points;
matrices are arrays of nine numbers by rows. Functions on these arrays take and give SQL text (see numbers.py)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyslip.functions.numbers import let

CORNERS = ["a", "b", "c", "d"]
#: Candidates below this score aren't a screen.
LEAST_SCREEN_SCORE = 0.10
REPEATED_CORNERS = "screen_quad must have four distinct corners"


def order_points(points: str) -> str:
    """Four points by angle about their centroid, from the one with the smallest x + y; null unless they are four different points."""
    centre = f"array({', '.join('(' + ' + '.join(f'p[{i}][{k}]' for i in range(4)) + ') / 4' for k in range(2))})"
    around = f"sort_array(array({', '.join(f'struct(atan2(p[{i}][1] - c[1], p[{i}][0] - c[0]) AS a, {i} AS i, p[{i}] AS q)' for i in range(4))})).q"
    sums = f"array({', '.join(f's[{i}][0] + s[{i}][1]' for i in range(4))})"
    start = "CAST(array_position(t, array_min(t)) AS INT)"
    cycle = let(centre, "c", let(around, "s", let(sums, "t", let(start, "n", "concat(slice(s, n, 4), slice(s, 1, n - 1))"))))
    return let(points, "p", f"CASE WHEN size(p) = 4 AND size(array_distinct(p)) = 4 THEN {cycle} END")


def corners(points: str) -> dict[str, Column]:
    """ax..dy of four points."""
    return {f"{c}{k}": F.expr(f"{points}[{i}][{j}]") for i, c in enumerate(CORNERS) for j, k in enumerate("xy")}


def quad_points() -> str:
    """The columns ax..dy as four points."""
    return f"array({', '.join(f'array({c}x, {c}y)' for c in CORNERS)})"


def order_quad(df: DataFrame, strict: bool = False) -> DataFrame:
    """ax..dy sorted by angle about the centroid, starting at the corner with the smallest x + y; null where corners repeat, or with
    `strict` the end of the job."""
    df = df.withColumnsRenamed({f"{c}{k}": f"{c}{k}_" for c in CORNERS for k in "xy"})
    cx, cy = ((F.col(f"a{k}_") + F.col(f"b{k}_") + F.col(f"c{k}_") + F.col(f"d{k}_")) / 4 for k in "xy")
    corner = [F.struct(F.atan2(F.col(f"{c}y_") - cy, F.col(f"{c}x_") - cx).alias("angle"), F.lit(i).alias("pos"), F.col(f"{c}x_").alias("x"), F.col(f"{c}y_").alias("y")) for i, c in enumerate(CORNERS)]
    df = df.withColumn("_q", F.array_sort(F.array(*corner)))
    sums = F.transform("_q", lambda p: p["x"] + p["y"])
    start = F.array_position(sums, F.array_min(sums)).cast("int")
    df = df.withColumn("_q", F.concat(F.slice("_q", start, F.lit(4)), F.slice("_q", F.lit(1), start - 1)))
    whole = F.size(F.array_distinct(F.transform("_q", lambda p: F.struct(p["x"], p["y"])))) == 4
    if strict:
        df = df.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit(REPEATED_CORNERS)).cast("boolean")))
    df = df.withColumns({f"{c}{k}": F.when(whole, F.col("_q")[i][k]) for i, c in enumerate(CORNERS) for k in "xy"})
    return df.drop("_q", *[f"{c}{k}_" for c in CORNERS for k in "xy"])


def _side(p: str, q: str) -> Column:
    return F.sqrt((F.col(f"{p}x") - F.col(f"{q}x")) * (F.col(f"{p}x") - F.col(f"{q}x")) + (F.col(f"{p}y") - F.col(f"{q}y")) * (F.col(f"{p}y") - F.col(f"{q}y")))


def quad_score(prefer_portrait: bool | Column = True) -> Column:
    """The score of an ordered quad as a screen, -1 where it can't be one. The limits below are fixed values that decide results."""
    area = F.abs(sum((F.col(f"{p}x") * F.col(f"{q}y") - F.col(f"{q}x") * F.col(f"{p}y") for p, q in zip(CORNERS, "bcda")), F.lit(0.0))) / 2
    image = (F.col("w") * F.col("h")).cast("double")
    whole = {k: [F.col(f"{c}{k}").cast("int") for c in CORNERS] for k in "xy"}
    x, y = F.least(*whole["x"]), F.least(*whole["y"])
    width, height = F.greatest(*whole["x"]) - x + 1, F.greatest(*whole["y"]) - y + 1
    across, down = (_side("a", "b") + _side("d", "c")) / 2, (_side("a", "d") + _side("b", "c")) / 2
    left, top, right, bottom = x <= 2, y <= 2, x + width >= F.col("w") - 2, y + height >= F.col("h") - 2
    rect = area / F.greatest((width * height).cast("double"), F.lit(1.0))
    cover = area / image
    touches = sum((t.cast("int") for t in (left, top, right, bottom)), F.lit(0))
    adjacent = (left & top) | (top & right) | (right & bottom) | (bottom & left)
    bad = (cover < 0.15) | (cover > 0.995) | (width < 40) | (height < 40) | (F.lit(prefer_portrait) & (across >= down))
    bad = bad | (F.least(across, down) / F.greatest(across, down) < 0.35) | (left & top & right & bottom) | (rect < 0.48)
    bad = bad | F.when(adjacent, cover < 0.18).otherwise((cover < 0.30) | (width / F.col("w") < 0.45) | (height / F.col("h") < 0.45))
    return F.when(bad, -1.0).otherwise(cover * (0.7 + 0.3 * rect) - 0.025 * touches)


def best_quad(df: DataFrame, prefer_portrait: bool | Column = True) -> DataFrame:
    """Per image the candidate (ordered quad, pos, w and h of its image) with the highest score, the first on ties, if it reaches
    LEAST_SCREEN_SCORE; else pos null and the quad of the full image. One aggregation, no sort."""
    scored = df.withColumn("_score", F.coalesce(quad_score(prefer_portrait), F.lit(-1.0)))
    quad = F.struct("pos", F.expr(quad_points()).alias("quad"))
    top = scored.groupBy("image_id").agg(
        F.max_by(quad, F.struct("_score", -F.col("pos"))).alias("_top"), F.max("_score").alias("score"), F.first("w").alias("w"), F.first("h").alias("h")
    )
    good = F.col("score") >= LEAST_SCREEN_SCORE
    full = full_image_quad(F.col("w"), F.col("h")).cast("array<array<double>>")
    out = top.select("image_id", F.when(good, F.col("_top.pos")).alias("pos"), good.alias("screen_detected"), F.when(good, F.col("_top.quad")).otherwise(full).alias("quad"))
    return out.select("*", *[v.alias(k) for k, v in corners("quad").items()])


def output_size(df: DataFrame, max_side: int | Column = 1600) -> DataFrame:
    """out_w, out_h of an ordered quad: the longer of opposite sides and 1 px, at least 2, scaled to max_side (0: kept)."""
    if isinstance(max_side, int) and max_side != 0 and max_side < 2:
        raise ValueError("max_side must be 0 or at least 2")
    limit = F.lit(max_side)
    w = F.greatest(F.lit(2.0), F.bround(F.greatest(_side("a", "b"), _side("d", "c")), 0) + 1)
    h = F.greatest(F.lit(2.0), F.bround(F.greatest(_side("a", "d"), _side("b", "c")), 0) + 1)
    scale = F.when((limit > 0) & (F.greatest(w, h) > limit), limit.cast("double") / F.greatest(w, h)).otherwise(1.0)
    return df.withColumns({"out_w": F.greatest(F.lit(2), F.bround(w * scale, 0).cast("int")), "out_h": F.greatest(F.lit(2), F.bround(h * scale, 0).cast("int"))})


def rotation_homography(degrees: Column, w: Column, h: Column) -> Column:
    """Nine numbers, by rows, that turn a w x h image by a multiple of 90 degrees."""
    z, one = F.lit(0.0), F.lit(1.0)
    w1, h1 = (w - 1).cast("double"), (h - 1).cast("double")
    d = F.pmod(degrees, F.lit(360))
    return (
        F.when(d == 0, F.array(one, z, z, z, one, z, z, z, one)).when(d == 90, F.array(z, -one, h1, one, z, z, z, z, one))
        .when(d == 180, F.array(-one, z, w1, z, -one, h1, z, z, one)).when(d == 270, F.array(z, one, z, -one, z, w1, z, z, one))
    )


def square_to_quad(df: DataFrame) -> DataFrame:
    """h0..h8: the projective map from the unit square to the ordered quad, in closed form (Heckbert, 1989)."""
    sx = F.col("ax") - F.col("bx") + F.col("cx") - F.col("dx")
    by = F.col("by")
    sy = F.col("ay") - by + F.col("cy") - F.col("dy")
    dx1, dy1, dx2, dy2 = F.col("bx") - F.col("cx"), by - F.col("cy"), F.col("dx") - F.col("cx"), F.col("dy") - F.col("cy")
    det = dx1 * dy2 - dx2 * dy1
    g, h = (sx * dy2 - dx2 * sy) / det, (dx1 * sy - sx * dy1) / det
    df = df.withColumns({"h6": g, "h7": h, "h8": F.lit(1.0)})
    return df.withColumns({
        "h0": F.col("bx") - F.col("ax") + F.col("h6") * F.col("bx"), "h1": F.col("dx") - F.col("ax") + F.col("h7") * F.col("dx"), "h2": F.col("ax"),
        "h3": by - F.col("ay") + F.col("h6") * by, "h4": F.col("dy") - F.col("ay") + F.col("h7") * F.col("dy"), "h5": F.col("ay"),
    })


def multiply(a: str, b: str) -> str:
    """The matrix product: first `b`, then `a`."""
    return f"array({', '.join(' + '.join(f'{a}[{3 * r + k}] * {b}[{3 * k + c}]' for k in range(3)) for r in range(3) for c in range(3))})"


def adjugate(m: str) -> str:
    """The transposed cofactors: the inverse but for the determinant, which a projective map doesn't need."""
    a, b, c, d, e, f, g, h, i = (f"{m}[{k}]" for k in range(9))
    pairs = [(e, i, f, h), (c, h, b, i), (b, f, c, e), (f, g, d, i), (a, i, c, g), (c, d, a, f), (d, h, e, g), (b, g, a, h), (a, e, b, d)]
    return f"array({', '.join(f'{p} * {q} - {r} * {s}' for p, q, r, s in pairs)})"


def inverse(m: str) -> str:
    """The inverse matrix; null if the determinant is 0."""
    a, b, c, d, e, f, g, h, i = (f"x[{k}]" for k in range(9))
    det = f"{a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g})"
    return let(m, "x", let(det, "d", f"CASE WHEN d <> 0 THEN transform({adjugate('x')}, v -> v / d) END"))


def transform_points(points: str, m: str) -> str:
    """Points ([x, y] each) under a projective map; null where they go to infinity."""
    row = lambda r: f"({m}[{r}] * p[0] + {m}[{r + 1}] * p[1] + {m}[{r + 2}])"
    return f"transform({points}, p -> {let(f'nullif({row(6)}, 0D)', 'n', f'array({row(0)} / n, {row(3)} / n)')})"


def quad_to_rectangle(df: DataFrame) -> DataFrame:
    """`to_rectangle`: the projective map of an ordered quad to the corners of an out_w x out_h image, its last entry 1: the map of the
    unit square to the quad backwards, then both axes stretched."""
    df = square_to_quad(df).withColumn("_h", F.expr(f"array({', '.join(f'h{i}' for i in range(9))})")).withColumn("_back", F.expr(adjugate("_h")))
    stretch = "CASE WHEN i < 3 THEN out_w - 1 WHEN i < 6 THEN out_h - 1 ELSE 1 END"
    df = df.withColumn("to_rectangle", F.expr(f"CASE WHEN _back[8] <> 0 THEN transform(_back, (v, i) -> v * ({stretch}) / _back[8]) END"))
    return df.drop("_h", "_back", *[f"h{i}" for i in range(9)])


def project(u: Column, v: Column) -> tuple[Column, Column]:
    """(x, y) of a point under h0..h8."""
    n = F.col("h6") * u + F.col("h7") * v + F.col("h8")
    return (F.col("h0") * u + F.col("h1") * v + F.col("h2")) / n, (F.col("h3") * u + F.col("h4") * v + F.col("h5")) / n


def bbox_to_polygon(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The four corners of a box, clockwise from the top left one."""
    return F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))


def full_image_quad(w: Column, h: Column) -> Column:
    """The quad of a whole image, by the centres of its corner pixels."""
    return bbox_to_polygon(F.lit(0), F.lit(0), w - 1, h - 1)


def determinant(m: Column) -> Column:
    """Of nine numbers by rows."""
    a, b, c, d, e, f, g, h, i = (F.get(m, F.lit(k)) for k in range(9))
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def validate_geometry(df: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """`violations` of staged geometry: `to_rectified` and `to_original` (nine numbers by rows), `rotation_degrees`, `screen_quad` (four
    points), and recorded sizes against the present ones (source_w, source_h, rectified_w, rectified_h and the same with now_)."""
    finite = lambda a: F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    invertible = lambda m: F.coalesce((F.size(m) == 9) & finite(m) & (F.abs(determinant(m)) >= 1e-12), F.lit(False))
    one, other = F.col("to_rectified"), F.col("to_original")
    cell = lambda m, r, c: F.get(m, F.lit(3 * r + c))
    product = {(r, c): sum((cell(one, r, k) * cell(other, k, c) for k in range(3)), F.lit(0.0)) for r in range(3) for c in range(3)}
    near = [F.abs(x - float(r == c)) <= tolerance + tolerance * float(r == c) for (r, c), x in product.items()]
    inverse = near[0]
    for n in near[1:]:
        inverse = inverse & n
    quad = F.coalesce((F.size("screen_quad") == 4) & F.forall("screen_quad", lambda p: (F.size(p) == 2) & finite(p)), F.lit(False))
    same = lambda k: F.coalesce((F.col(f"{k}_w") == F.col(f"now_{k}_w")) & (F.col(f"{k}_h") == F.col(f"now_{k}_h")), F.lit(False))
    checks = [
        (~same("source"), "source size"), (~same("rectified"), "rectified size"), (~quad, "screen quad"),
        (~invertible(one), "to_rectified"), (~invertible(other), "to_original"),
        (invertible(one) & invertible(other) & ~F.coalesce(inverse, F.lit(False)), "not inverse"),
        (~F.coalesce(F.col("rotation_degrees").isin(0, 90, 180, 270), F.lit(False)), "rotation"),
    ]
    return df.withColumn("violations", F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in checks])))
