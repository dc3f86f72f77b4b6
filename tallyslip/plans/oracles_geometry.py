"""DuckDB SQL of rectification plans: ordered quads by window functions, turns by cases instead of matrices, rounding in integers."""

from __future__ import annotations

CORNERS = ["ax", "ay", "bx", "by_", "cx", "cy", "dx", "dy"]
_SIDE = "sqrt(({0}x-{1}x)*({0}x-{1}x)+({2}-{3})*({2}-{3}))"
_Y = {"a": "ay", "b": "by_", "c": "cy", "d": "dy"}


def ordered(src: str, out: str) -> str:
    """CTEs that end in `out`: the quads of `src` (key, ax..dy) in order."""
    picks = ", ".join(f"max(CASE WHEN k = {i} THEN {k} END) AS {c}" for (i, k), c in zip([(i, k) for i in range(4) for k in "xy"], CORNERS))
    return f"""{out}_c AS (SELECT key, unnest([0, 1, 2, 3]) AS i, unnest([ax, bx, cx, dx]) AS x, unnest([ay, by_, cy, dy]) AS y FROM {src}),
{out}_m AS (SELECT *, sum(x) OVER (PARTITION BY key) / 4 AS mx, sum(y) OVER (PARTITION BY key) / 4 AS my FROM {out}_c),
{out}_r AS (SELECT key, x, y, row_number() OVER (PARTITION BY key ORDER BY atan2(y - my, x - mx), i) - 1 AS r FROM {out}_m),
{out}_s AS (SELECT key, r AS s FROM (SELECT key, r, row_number() OVER (PARTITION BY key ORDER BY x + y, r) AS n FROM {out}_r) WHERE n = 1),
{out} AS (SELECT key, {picks} FROM (SELECT a.key, x, y, (r - s + 4) % 4 AS k FROM {out}_r a JOIN {out}_s b ON b.key = a.key) GROUP BY key)"""


def _turned(x: str, y: str, back: bool) -> tuple[str, str]:
    """A point after the photo's turn, or before it."""
    to = {90: (f"h - 1 - {y}", x), 180: (f"w - 1 - {x}", f"h - 1 - {y}"), 270: (y, f"w - 1 - {x}")}
    fro = {90: (y, f"h - 1 - {x}"), 180: (f"w - 1 - {x}", f"h - 1 - {y}"), 270: (f"w - 1 - {y}", x)}
    cases = fro if back else to
    return tuple(f"CASE deg {' '.join(f'WHEN {d} THEN {p[k]}' for d, p in cases.items())} ELSE {(x, y)[k]} END" for k in range(2))


def _turn_all(back: bool) -> str:
    points = [_turned(f"{c}x", _Y[c], back) for c in "abcd"]
    return ", ".join(f"CAST({e} AS DOUBLE) AS {name}" for e, name in zip([e for p in points for e in p], CORNERS))


def _product(left: list[str], right: list[str]) -> list[str]:
    return [" + ".join(f"{left[3 * r + k]} * {right[3 * k + c]}" for k in range(3)) for r in range(3) for c in range(3)]


def _cofactors(m: list[str]) -> list[str]:
    a, b, c, d, e, f, g, h, i = m
    pairs = [(e, i, f, h), (c, h, b, i), (b, f, c, e), (f, g, d, i), (a, i, c, g), (c, d, a, f), (d, h, e, g), (b, g, a, h), (a, e, b, d)]
    return [f"({p} * {q} - {r} * {s})" for p, q, r, s in pairs]


def names(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(9)]


def _columns(values: list[str], prefix: str) -> str:
    return ", ".join(f"{v} AS {n}" for v, n in zip(values, names(prefix)))


#: The turn as a matrix, by degrees.
_TURN = [
    f"CAST(CASE deg WHEN 90 THEN {q} WHEN 180 THEN {u} WHEN 270 THEN {v} ELSE {p} END AS DOUBLE)" for p, q, u, v in zip(
        ("1", "0", "0", "0", "1", "0", "0", "0", "1"), ("0", "-1", "h - 1", "1", "0", "0", "0", "0", "1"),
        ("-1", "0", "w - 1", "0", "-1", "h - 1", "0", "0", "1"), ("0", "1", "0", "-1", "0", "w - 1", "0", "0", "1"),
    )
]


def map_to_rectangle(src: str, rest: str) -> str:
    """CTEs back, rect: m0..m8, the map of ordered quads (ax..dy, ow, oh) to their rectangles, with the columns `rest`."""
    stretch = ["(ow - 1)"] * 3 + ["(oh - 1)"] * 3 + ["1"]* 3
    return f"""u0 AS (SELECT *, (bx-cx)*(dy-cy) - (dx-cx)*(by_-cy) AS det, ax-bx+cx-dx AS sx, ay-by_+cy-dy AS sy FROM {src}),
u1 AS (SELECT *, (sx*(dy-cy) - (dx-cx)*sy) / det AS h6, ((bx-cx)*sy - sx*(by_-cy)) / det AS h7, CAST(1 AS DOUBLE) AS h8 FROM u0),
u2 AS (SELECT *, bx-ax+h6*bx AS h0, dx-ax+h7*dx AS h1, ax AS h2, by_-ay+h6*by_ AS h3, dy-ay+h7*dy AS h4, ay AS h5 FROM u1),
back AS (SELECT {rest}, {', '.join(names('h'))}, {_columns(_cofactors(names('h')), 'b')} FROM u2),
rect AS (SELECT {rest}, {', '.join(names('h'))}, {_columns([f'b{i} * {stretch[i]} / b8' for i in range(9)], 'm')} FROM back)"""


def sized(src: str, out: str, max_side: str) -> str:
    sides = [_SIDE.format(p, q, _Y[p], _Y[q]) for p, q in ("ab", "dc", "ad", "bc")]
    return f"""{out}_l AS (SELECT *, greatest(2.0::DOUBLE, round_even(greatest({sides[0]}, {sides[1]}), 0) + 1) AS lw, greatest(2.0::DOUBLE, round_even(greatest({sides[2]}, {sides[3]}), 0) + 1) AS lh FROM {src}),
{out}_k AS (SELECT *, CASE WHEN {max_side} > 0 AND greatest(lw, lh) > {max_side} THEN CAST({max_side} AS DOUBLE) / greatest(lw, lh) ELSE 1.0::DOUBLE END AS sc FROM {out}_l),
{out} AS (SELECT *, CAST(greatest(2, round_even(lw * sc, 0)) AS INT) AS ow, CAST(greatest(2, round_even(lh * sc, 0)) AS INT) AS oh FROM {out}_k)"""


def inverse_of(prefix: str, src: str, out: str, rest: str, to: str) -> str:
    m = names(prefix)
    det = f"{m[0]} * ({m[4]} * {m[8]} - {m[5]} * {m[7]}) - {m[1]} * ({m[3]} * {m[8]} - {m[5]} * {m[6]}) + {m[2]} * ({m[3]} * {m[7]} - {m[4]} * {m[6]})"
    return f"{out}_d AS (SELECT *, {det} AS dt FROM {src}), {out} AS (SELECT {rest}, {_columns([f'{c} / dt' for c in _cofactors(m)], to)} FROM {out}_d)"


def plan(sides_and_scores: str) -> str:
    """CTEs from ph (key, w, h, od, pp, ac, ms, scored, has, qax..qdy) to plan (key, deg, detected, error, w, h, ow, oh, ax..dy of the quad
    in the photo, t0..t8 to the rectified image, o0..o8 back)."""
    q = [f"q{c}" for c in CORNERS]
    pick = ", ".join(f"coalesce(o.{c}, s.{c}, CAST({full} AS DOUBLE)) AS {c}" for c, full in zip(CORNERS, ("0", "0", "rw - 1", "0", "rw - 1", "rh - 1", "0", "rh - 1")))
    corners, plain = ", ".join(CORNERS), "key, w, h, deg, detected, error"
    origin = ", ".join(f"coalesce(o.{c}, b.{c}) AS {c}" for c in CORNERS)
    return f"""p1 AS (SELECT *, CAST(coalesce((od % 360 + 360) % 360, scored, CASE WHEN pp AND w > h THEN 90 ELSE 0 END) AS INT) AS deg FROM ph),
p2 AS (SELECT *, CASE WHEN deg % 180 = 0 THEN w ELSE h END AS rw, CASE WHEN deg % 180 = 0 THEN h ELSE w END AS rh, CASE WHEN deg % 90 <> 0 THEN 'orientation must be a multiple of 90'
  WHEN has AND len(list_distinct([{', '.join(f'[{q[2 * i]}, {q[2 * i + 1]}]' for i in range(4))}])) < 4 THEN 'screen_quad must have four distinct corners' WHEN ms < 0 OR ms = 1 THEN 'max_side must be 0 or at least 2' END AS error FROM p1),
own0 AS (SELECT key, {', '.join(f'{a} AS {b}' for a, b in zip(q, CORNERS))} FROM p2 WHERE has AND error IS NULL),
{ordered('own0', 'own')},
ownt0 AS (SELECT o.key, {_turn_all(False)} FROM own o JOIN p2 p ON p.key = o.key),
{ordered('ownt0', 'ownt')},
cq0 AS (SELECT pos AS key, {corners} FROM fx_quads),
{ordered('cq0', 'cq')},
oq AS (SELECT c.*, f.pos, p.key AS image_id, p.rw AS w, p.rh AS h, p.pp FROM cq c JOIN fx_quads f ON f.pos = c.key JOIN p2 p ON p.key = f.image_id WHERE p.ac AND NOT p.has AND p.error IS NULL),
{sides_and_scores.replace('OR across >= down', 'OR (pp AND across >= down)')},
screen AS (SELECT image_id AS key, {corners} FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pos) AS n FROM sc) WHERE n = 1 AND score >= 0.10),
qr0 AS (SELECT p.key, {pick} FROM p2 p LEFT JOIN ownt o ON o.key = p.key LEFT JOIN screen s ON s.key = p.key WHERE p.error IS NULL),
{ordered('qr0', 'qr')},
qb0 AS (SELECT o.key, {_turn_all(True)} FROM qr o JOIN p2 p ON p.key = o.key),
qo0 AS (SELECT b.key, {origin} FROM qb0 b LEFT JOIN own o ON o.key = b.key),
{ordered('qo0', 'qo')},
z0 AS (SELECT r.*, p.w, p.h, p.deg, p.ms, p.error, p.has OR s.key IS NOT NULL AS detected FROM qr r JOIN p2 p ON p.key = r.key LEFT JOIN screen s ON s.key = r.key),
{sized('z0', 'z', 'ms')},
{map_to_rectangle('z', f'{plain}, ow, oh')},
t AS (SELECT {plain}, ow, oh, {_columns(_product(names('m'), [f'({x})' for x in _TURN]), 't')} FROM rect),
{inverse_of('t', 't', 'io', f"{plain}, ow, oh, {', '.join(names('t'))}", 'o')},
plan AS (SELECT io.*, {', '.join(f'qo.{c}' for c in CORNERS)} FROM io JOIN qo ON qo.key = io.key)"""


def json_number(v: str) -> str:
    """A rounded double below 10^7 with up to 8 decimals as JSON writers of the JVM print it: small ones by a power of ten."""
    d = f"CAST(CAST(round(abs({v}) * 100000000) AS BIGINT) AS VARCHAR)"
    small = f"CASE WHEN {v} < 0 THEN '-' ELSE '' END || left({d}, 1) || '.' || CASE WHEN length(rtrim({d}, '0')) > 1 THEN substring(rtrim({d}, '0'), 2) ELSE '0' END || 'E' || CAST(length({d}) - 9 AS VARCHAR)"
    return f"CASE WHEN {v} = 0 THEN '0.0' WHEN abs({v}) >= 0.001 THEN CAST({v} AS VARCHAR) ELSE {small} END"


def json_list(values: list[str], digits: int) -> str:
    power = f"{10**digits}.0::DOUBLE"
    return f"'[' || array_to_string(list_transform(list_transform([{', '.join(values)}], lambda v: round_even(v * {power}, 0) / {power} + 0.0), lambda v: {json_number('v')}), ',') || ']'"


def json_rows(values: list[str], width: int, digits: int) -> str:
    rows = [json_list(values[i : i + width], digits) for i in range(0, len(values), width)]
    return "'[' || " + " || ',' || ".join(rows) + " || ']'"


def size_json(w: str, h: str) -> str:
    return f"""'{{"width":' || CAST({w} AS VARCHAR) || ',"height":' || CAST({h} AS VARCHAR) || '}}'"""


#: The entries of a plan's geometry as JSON texts.
QUAD, TO_RECTIFIED, TO_ORIGINAL = json_rows(CORNERS, 2, 3), json_rows(names("t"), 3, 8), json_rows(names("o"), 3, 8)
GEOMETRY = (
    f"""'{{"source_size":' || {size_json('w', 'h')} || ',"rectified_size":' || {size_json('ow', 'oh')} || ',"rotation_degrees":' || CAST(deg AS VARCHAR) || ',"screen_detected":' || CAST(detected AS VARCHAR) """
    f"""|| ',"screen_quad_original":' || {QUAD} || ',"H_original_to_rectified":' || {TO_RECTIFIED} || ',"H_rectified_to_original":' || {TO_ORIGINAL} || '}}'"""
)


def exact(x: str, digits: int) -> str:
    """A double of at least 2^-8 rounded to `digits` decimals by integers: it is a multiple of 2^-60, so nothing is lost before the tie rule."""
    n = f"(CAST({x} * 1152921504606846976.0::DOUBLE AS HUGEINT) * {10**digits})"
    one = "1152921504606846976::HUGEINT"
    q, rest = f"({n} // {one})", f"({n} % {one})"
    up = f"CASE WHEN {rest} * 2 > {one} OR ({rest} * 2 = {one} AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CAST({q} + {up} AS DOUBLE) / {10**digits}.0::DOUBLE)"


def projected(x: str, y: str, prefix: str = "o") -> tuple[str, str]:
    o = names(prefix)
    below = f"({o[6]} * {x} + {o[7]} * {y} + {o[8]})"
    return f"(({o[0]} * {x} + {o[1]} * {y} + {o[2]}) / {below})", f"(({o[3]} * {x} + {o[4]} * {y} + {o[5]}) / {below})"


#: Photos of the images that have boxes.
PHOTOS_OF_BOXES = f"""ph AS (SELECT DISTINCT image_id AS key, CASE WHEN image_id % 3 = 0 THEN 1400 ELSE 800 END AS w, CASE WHEN image_id % 3 = 0 THEN 800 ELSE 1400 END AS h,
  CASE WHEN image_id % 5 = 0 THEN image_id % 4 * 90 END AS od, image_id % 7 <> 0 AS pp, image_id % 6 <> 0 AS ac, CASE WHEN image_id % 4 = 0 THEN 0 ELSE 1280 END AS ms, CAST(NULL AS INT) AS scored, false AS has,
  {', '.join(f'CAST(NULL AS DOUBLE) AS q{c}' for c in CORNERS)} FROM fx_detections)"""

_OWN = ["c_id", "skip", "orientation_set", "orientation", "max_side_set", "max_side", "prefer_portrait_set", "prefer_portrait", "auto_screen_set", "auto_screen", "qax", "qay", "qbx", "qby", "qcx", "qcy", "qdx", "qdy"]
#: Photos with the options of their corrections, by path or else by base name.
CORRECTED_PHOTOS = f"""fj AS (SELECT p.page_id, p.image_id, p.w, p.h, {', '.join(f'CASE WHEN a.c_id IS NOT NULL THEN a.{c} ELSE b.{c} END AS {c}' for c in _OWN)}
  FROM fx_photos p LEFT JOIN fx_corrections a ON a.key = p.image_id LEFT JOIN fx_corrections b ON b.key = regexp_replace(p.image_id, '^.*/', '')),
fo AS (SELECT page_id AS key, image_id AS path, w, h, CASE WHEN orientation_set THEN orientation END AS od, coalesce(CASE WHEN prefer_portrait_set THEN prefer_portrait ELSE true END, false) AS pp,
  coalesce(CASE WHEN auto_screen_set THEN auto_screen ELSE true END, false) AS ac, CASE WHEN max_side_set THEN max_side ELSE 1600 END AS ms, qax IS NOT NULL AS has, qax, qay, qbx, qby AS qby_, qcx, qcy, qdx, qdy FROM fj WHERE NOT coalesce(skip, false)),
ts AS (SELECT f.key, f.w, f.h, f.pp, degrees, confidence + least(n_lines, 10) * 0.01::DOUBLE + CASE WHEN pp AND ((degrees % 180 = 0 AND h >= w) OR (degrees % 180 = 90 AND w >= h)) THEN 0.02::DOUBLE ELSE 0.0::DOUBLE END AS score
  FROM fx_turns t JOIN fo f ON f.key = t.page_id WHERE f.od IS NULL),
tb AS (SELECT key, CASE WHEN score IS NOT NULL THEN degrees WHEN w > h AND pp THEN 90 ELSE 0 END AS scored FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY coalesce(score, -1) DESC, degrees) AS n FROM ts) WHERE n = 1),
ph AS (SELECT fo.*, tb.scored FROM fo LEFT JOIN tb ON tb.key = fo.key)"""
