"""Rounding, matrices and rectification plans against Python's rounding and a numpy version with an 8 x 8 solve."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyslip.functions import geometry as geo
from tallyslip.functions.numbers import round_exact, round_scaled
from tallyslip.operators import rectify
from tallyslip.operators.bundles import write_bundles
from tallyslip.operators.detections import ellipse_points


def test_rounding_equals_the_exact_one(spark):
    """100,000 values: random ones, exact ties, decimal near-ties, large and small ones, NaN and infinities."""
    rng = random.Random(1)
    values = [rng.random() * 10 ** rng.randrange(-7, 9) * rng.choice([1, -1]) for _ in range(60_000)]
    values += [(2 * k + 1) / 2**j for k in range(250) for j in range(1, 30)] + [x / 1000 + 0.0005 for x in range(10_000)]
    values += [round(rng.random(), 6) + 0.5e-6 for _ in range(23_000)] + [1.0005, 2.675, 123.4565, -0.0, 5e-7, 1.5e-6, 2.5e-6, math.inf, -math.inf, math.nan, 1e300, 2.0**52 + 0.5]
    assert len(values) > 100_000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    digits = (3, 6, 8)
    for r in df.select("v", *[F.expr(round_exact("v", d)).alias(f"r{d}") for d in digits], F.expr(round_scaled("v", 3)).alias("s")).collect():
        v = r["v"]
        for d in digits:
            assert repr(round(v, d) if math.isfinite(v) else v) == repr(r[f"r{d}"]), (v, d)
        if math.isfinite(v) and abs(v) < 1e300:
            assert r["s"] == np.round(v, 3)
    assert spark.sql(f"SELECT {round_exact('CAST(NULL AS DOUBLE)', 6)} AS v").first()["v"] is None


def solved(quad, w, h):
    """The map of four corners to those of a w x h image, as the solution of eight equations."""
    a, b = [], []
    for (x, y), (u, v) in zip(quad, [(0, 0), (w - 1, 0), (w - 1, h - 1), (0, h - 1)]):
        a += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        b += [u, v]
    return np.append(np.linalg.solve(np.array(a, float), np.array(b, float)), 1.0).reshape(3, 3)


def in_order(points):
    p = np.array(points, float)
    c = p[np.argsort(np.arctan2(*(p - p.mean(axis=0)).T[::-1]), kind="stable")]
    return np.roll(c, -int(np.argmin(c.sum(axis=1))), axis=0)


def moved(points, m):
    q = np.c_[np.array(points, float), np.ones(len(points))] @ m.T
    return q[:, :2] / q[:, 2:]


TURNS = {0: lambda w, h: np.eye(3), 90: lambda w, h: np.array([[0, -1, h - 1], [1, 0, 0], [0, 0, 1.0]]), 180: lambda w, h: np.array([[-1, 0, w - 1], [0, -1, h - 1], [0, 0, 1.0]]), 270: lambda w, h: np.array([[0, 1, 0], [-1, 0, w - 1], [0, 0, 1.0]])}


def test_plans_against_numpy(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        w, h = rng.choice([(800, 1400), (1400, 800), (600, 600)])
        quad = None if i % 3 == 0 else [[rng.uniform(0, w / 3), rng.uniform(0, h / 3)], [rng.uniform(2 * w / 3, w), rng.uniform(0, h / 3)], [rng.uniform(2 * w / 3, w), rng.uniform(2 * h / 3, h)], [rng.uniform(0, w / 3), rng.uniform(2 * h / 3, h)]]
        if quad:
            rng.shuffle(quad)
        rows.append((i, w, h, rng.choice([None, 0, 90, -90, 180, 450]), rng.random() < 0.7, False, quad, rng.choice([0, 2, 640, 1600])))
    photos = spark.createDataFrame(rows, "image_id long, w int, h int, orientation_degrees int, prefer_portrait boolean, auto_screen boolean, screen_quad array<array<double>>, max_side int")
    got = {r["image_id"]: r for r in rectify.plan_rectification(photos).collect()}
    for i, w, h, degrees, portrait, _, quad, side in rows:
        r = got[i]
        degrees = degrees % 360 if degrees is not None else 90 if portrait and w > h else 0
        turn = TURNS[degrees](w, h)
        rw, rh = (w, h) if degrees % 180 == 0 else (h, w)
        turned = in_order(moved(in_order(quad), turn)) if quad else np.array([[0, 0], [rw - 1, 0], [rw - 1, rh - 1], [0, rh - 1]], float)
        a, b, c, d = turned
        size = [max(2, round(max(np.linalg.norm(b - a), np.linalg.norm(c - d))) + 1), max(2, round(max(np.linalg.norm(d - a), np.linalg.norm(c - b))) + 1)]
        if side and max(size) > side:
            size = [max(2, round(s * (side / max(size)))) for s in size]
        assert (r["rotation_degrees"], r["screen_detected"], r["rectified_w"], r["rectified_h"], r["error"]) == (degrees, bool(quad), *size, None)
        want = solved(turned, *size) @ turn
        there, back = np.array(r["to_rectified"]).reshape(3, 3), np.array(r["to_original"]).reshape(3, 3)
        assert np.allclose(there, want, rtol=1e-7, atol=1e-7) and np.allclose(there @ back, np.eye(3), atol=1e-6)
        origin = in_order(quad) if quad else in_order(moved(turned, np.linalg.inv(turn)))
        assert np.allclose(r["screen_quad_original"], origin, atol=1e-6)


def test_options_that_cannot_be_followed(spark):
    same = [[1.0, 1.0], [1.0, 1.0], [5.0, 5.0], [1.0, 5.0]]
    rows = [(1, 45, None, 0), (2, 45, same, 1), (3, None, same, 1), (4, None, None, 1), (5, None, None, -3), (6, None, [[1.0, 2.0]], 0), (7, -90, None, 0)]
    photos = spark.createDataFrame(rows, "image_id int, orientation_degrees int, screen_quad array<array<double>>, max_side int")
    photos = photos.selectExpr("*", "10 AS w", "20 AS h", "true AS prefer_portrait", "true AS auto_screen")
    got = {r["image_id"]: r for r in rectify.plan_rectification(photos).collect()}
    assert [got[i]["error"] for i in range(1, 8)] == [rectify.BAD_TURN, rectify.BAD_TURN, geo.REPEATED_CORNERS, rectify.BAD_SIDE, rectify.BAD_SIDE, geo.REPEATED_CORNERS, None]
    assert all(got[i]["to_rectified"] is None and got[i]["rectified_w"] is None for i in range(1, 7)) and got[7]["rotation_degrees"] == 270
    quad = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 5.0, 5.0, 1.0, 5.0)], "ax double, ay double, bx double, by double, cx double, cy double, dx double, dy double")
    assert geo.order_quad(quad).first()["ax"] is None
    with pytest.raises(PySparkException, match="four distinct corners"):
        geo.order_quad(quad, strict=True).collect()


def test_screens_and_turns_are_chosen(spark):
    """The first of the best candidates, unless automatic search is off; scores of turns with the bonus for upright ones."""
    photos = spark.createDataFrame([(1, True, 0), (2, False, 0), (3, True, None), (4, True, None)], "image_id int, auto_screen boolean, orientation_degrees int")
    photos = photos.selectExpr("*", "1000 AS w", "2000 AS h", "true AS prefer_portrait", "CAST(NULL AS ARRAY<ARRAY<DOUBLE>>) AS screen_quad", "0 AS max_side")
    screen = (100.0, 100.0, 900.0, 100.0, 900.0, 1900.0, 100.0, 1900.0)
    candidates = [(i, pos, *screen) for i in (1, 2, 3) for pos in (7, 5)] + [(4, 1, 0.0, 0.0, 50.0, 0.0, 50.0, 50.0, 0.0, 50.0)]
    candidates = spark.createDataFrame(candidates, "image_id int, pos int, ax double, ay double, bx double, by double, cx double, cy double, dx double, dy double")
    turns = spark.createDataFrame([(3, d, None if d == 90 else 0.5 + (d == 180) * 0.1, 0) for d in (0, 90, 180, 270)], "image_id int, degrees int, confidence double, n_lines int")
    got = {r["image_id"]: r for r in rectify.plan_rectification(photos, candidates, turns).collect()}
    assert [(got[i]["screen_detected"], got[i]["rotation_degrees"]) for i in (1, 2, 3, 4)] == [(True, 0), (False, 0), (True, 180), (False, 0)]
    best = geo.best_quad(geo.order_quad(candidates.selectExpr("*", "1000 AS w", "2000 AS h"))).collect()
    assert {r["image_id"]: (r["pos"], r["cx"]) for r in best} == {1: (5, 900.0), 2: (5, 900.0), 3: (5, 900.0), 4: (None, 999.0)}


def test_boxes_and_ellipses_in_the_photo(spark):
    """A turned photo without perspective: boxes turn with it, and the last point of an ellipse is the first."""
    photos = spark.sql("SELECT 1 AS image_id, 1400 AS w, 800 AS h, 90 AS orientation_degrees, true AS prefer_portrait, false AS auto_screen, CAST(NULL AS ARRAY<ARRAY<DOUBLE>>) AS screen_quad, 0 AS max_side")
    plan = rectify.plan_rectification(photos)
    boxes = spark.sql("SELECT 1 AS image_id, 0 AS pos, 'amount' AS label, 0.9D AS score, 5.25D AS x1, 5.25D AS y1, 35.75D AS x2, 18.75D AS y2, '¥12.30' AS text, 0.99D AS confidence")
    images = plan.select("image_id", F.lit("a.png").alias("source"), rectify.geometry_record().alias("geometry"), "to_original")
    doc = json.loads(write_bundles(images, boxes).first()["document"])
    assert doc["detections"][0]["quad_original"] == [[5.25, 794 - 0.25], [5.25, 799 - 35.75], [18.75, 799 - 35.75], [18.75, 799 - 5.25]]
    assert doc["geometry"]["rotation_degrees"] == 90 and doc["geometry"]["rectified_size"] == {"width": 800, "height": 1400} and doc["geometry"]["screen_detected"] is False
    assert doc["geometry"]["H_original_to_rectified"] == [[0.0, -1.0, 799.0], [1.0, 0.0, 0.0], [0.0, 0.0, 1.0]]
    assert list(doc["geometry"]) == ["source_size", "rectified_size", "rotation_degrees", "screen_detected", "screen_quad_original", "H_original_to_rectified", "H_rectified_to_original"]
    points = ellipse_points(boxes.join(plan.select("image_id", "to_original"), "image_id"), to_photo="to_original").orderBy("k").collect()
    angles = np.linspace(0, 2 * np.pi, 40)
    want = np.c_[20.5 + 18.25 * np.cos(angles), 12.0 + 9.75 * np.sin(angles)]
    assert np.allclose([(p["px"], p["py"]) for p in points], want) and np.allclose([(p["photo_x"], p["photo_y"]) for p in points], np.c_[want[:, 1], 799 - want[:, 0]], atol=1e-3)
