"""DuckDB SQL of the receipt queries: written on its own, over the same views."""

from tallyslip.plans import oracles_geometry as og
from tallyslip.plans.fixtures import with_fixtures as fx

_LABEL = "CASE class_id WHEN 1 THEN 'time' WHEN 2 THEN 'amount' WHEN 3 THEN 'transfer_status' WHEN 4 THEN 'recipient_field' WHEN 5 THEN 'payment_method_field' END"
_MAPPED = f"m AS (SELECT *, {_LABEL} AS label FROM fx_detections WHERE class_id BETWEEN 1 AND 5)"
_BEST = f"{_MAPPED}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, label ORDER BY score DESC, pos) AS rn FROM m WHERE score >= 0.5) t WHERE rn = 1)"
_OCR = """ocr AS (SELECT image_id, min_by(text, row_id) AS text, 'amount' AS label FROM fx_amount_text GROUP BY image_id
  UNION ALL SELECT row_id, recipient, 'recipient_field' FROM fx_field_rows UNION ALL SELECT row_id, status, 'transfer_status' FROM fx_field_rows
  UNION ALL SELECT row_id, payment, 'payment_method_field' FROM fx_field_rows UNION ALL SELECT row_id, text, 'time' FROM fx_time_text)"""
_OCR_FX = ("fx_detections", "fx_amount_text", "fx_field_rows", "fx_time_text")
_STANDS = "b.all_outputs AND b.result_mtime >= p.mtime AND b.fields_object AND b.recorded_source = p.image_id AND b.n_detections > 0 AND b.n_detections = b.n_with_ocr"
_COMMITTED = f"c AS (SELECT p.*, coalesce({_STANDS}, false) AS committed FROM fx_paths p LEFT JOIN fx_bundles b ON b.source = p.image_id)"
_CORRECTED = """j AS (SELECT p.image_id, CASE WHEN a.c_id IS NOT NULL THEN a.c_id ELSE b.c_id END AS c_id, CASE WHEN a.c_id IS NOT NULL THEN a.skip ELSE b.skip END AS skip,
  CASE WHEN a.c_id IS NOT NULL THEN a.orientation_set ELSE b.orientation_set END AS os, CASE WHEN a.c_id IS NOT NULL THEN a.orientation ELSE b.orientation END AS o,
  CASE WHEN a.c_id IS NOT NULL THEN a.max_side_set ELSE b.max_side_set END AS ms, CASE WHEN a.c_id IS NOT NULL THEN a.max_side ELSE b.max_side END AS m
  FROM fx_paths p LEFT JOIN fx_corrections a ON a.key = p.image_id LEFT JOIN fx_corrections b ON b.key = regexp_replace(p.image_id, '^.*/', ''))"""
_VIOLATIONS = """v AS (SELECT image_id, pos, concat_ws(',', CASE WHEN class_id NOT BETWEEN 1 AND 5 THEN 'unknown label' END, CASE WHEN count(*) OVER (PARTITION BY image_id, class_id) > 1 THEN 'repeated label' END,
  CASE WHEN score < 0 OR score > 1 THEN 'score' END, CASE WHEN x2 <= x1 THEN 'width' END, CASE WHEN y2 <= y1 THEN 'height' END) AS violations FROM fx_detections)"""
_STATUS = """CASE WHEN s LIKE '%失败%' OR s LIKE '%未成功%' OR s LIKE '%已撤销%' THEN 'failed' WHEN s LIKE '%处理中%' OR s LIKE '%待处理%' OR s LIKE '%进行中%' THEN 'pending'
  WHEN s LIKE '%转账成功%' OR s LIKE '%交易成功%' OR s LIKE '%付款成功%' OR s LIKE '%支付成功%' OR s LIKE '%转帐成功%' THEN 'success' ELSE 'unknown' END"""
_PAYMENT = "CASE WHEN s LIKE '%余额宝%' THEN 'yuebao' WHEN s LIKE '%余额%' THEN 'balance' WHEN s LIKE '%花呗%' THEN 'huabei' WHEN s LIKE '%银行卡%' OR s LIKE '%储蓄卡%' OR s LIKE '%信用卡%' THEN 'bank_card' ELSE 'other' END"
_STEM = "regexp_replace(image_id, '[.][^./]+$', '')"
_ORDERED = """corners AS (SELECT pos, w, h, image_id, 0 AS i, ax AS x, ay AS y FROM fx_quads UNION ALL SELECT pos, w, h, image_id, 1, bx, by_ FROM fx_quads UNION ALL SELECT pos, w, h, image_id, 2, cx, cy FROM fx_quads UNION ALL SELECT pos, w, h, image_id, 3, dx, dy FROM fx_quads),
angled AS (SELECT c.*, atan2(c.y - (q.ay + q.by_ + q.cy + q.dy) / 4, c.x - (q.ax + q.bx + q.cx + q.dx) / 4) AS angle FROM corners c JOIN fx_quads q ON q.pos = c.pos),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY angle, i) - 1 AS r FROM angled),
started AS (SELECT pos AS spos, min_by(r, (x + y) * 100 + r) AS s FROM ranked GROUP BY pos),
turned AS (SELECT a.*, (a.r - s.s + 4) % 4 AS k FROM ranked a JOIN started s ON s.spos = a.pos),
oq AS (SELECT pos, max(image_id) AS image_id, max(w) AS w, max(h) AS h, max(CASE WHEN k = 0 THEN x END) AS ax, max(CASE WHEN k = 0 THEN y END) AS ay, max(CASE WHEN k = 1 THEN x END) AS bx, max(CASE WHEN k = 1 THEN y END) AS by_,
  max(CASE WHEN k = 2 THEN x END) AS cx, max(CASE WHEN k = 2 THEN y END) AS cy, max(CASE WHEN k = 3 THEN x END) AS dx, max(CASE WHEN k = 3 THEN y END) AS dy FROM turned GROUP BY pos)"""
_SIDES = """sides AS (SELECT *, sqrt((ax-bx)*(ax-bx)+(ay-by_)*(ay-by_)) AS ab, sqrt((dx-cx)*(dx-cx)+(dy-cy)*(dy-cy)) AS dc, sqrt((ax-dx)*(ax-dx)+(ay-dy)*(ay-dy)) AS ad, sqrt((bx-cx)*(bx-cx)+(by_-cy)*(by_-cy)) AS bc FROM oq)"""
_SCORED = """f AS (SELECT *, abs(ax*by_-bx*ay + bx*cy-cx*by_ + cx*dy-dx*cy + dx*ay-ax*dy) / 2 AS area, (ab + dc) / 2 AS across, (ad + bc) / 2 AS down,
  least(trunc(ax), trunc(bx), trunc(cx), trunc(dx)) AS x, least(trunc(ay), trunc(by_), trunc(cy), trunc(dy)) AS y,
  greatest(trunc(ax), trunc(bx), trunc(cx), trunc(dx)) - least(trunc(ax), trunc(bx), trunc(cx), trunc(dx)) + 1 AS bw, greatest(trunc(ay), trunc(by_), trunc(cy), trunc(dy)) - least(trunc(ay), trunc(by_), trunc(cy), trunc(dy)) + 1 AS bh FROM sides),
g AS (SELECT *, x <= 2 AS l, y <= 2 AS t, x + bw >= w - 2 AS r, y + bh >= h - 2 AS b, area / (w * h) AS cover, area / greatest(bw * bh, 1.0) AS rect FROM f),
sc AS (SELECT *, CASE WHEN cover < 0.15 OR cover > 0.995 OR bw < 40 OR bh < 40 OR across >= down OR least(across, down) / greatest(across, down) < 0.35 OR (l AND t AND r AND b) OR rect < 0.48 THEN -1.0
  WHEN (l AND t) OR (t AND r) OR (r AND b) OR (b AND l) THEN CASE WHEN cover < 0.18 THEN -1.0 ELSE cover * (0.7 + 0.3 * rect) - 0.025 * (l::INT + t::INT + r::INT + b::INT) END
  WHEN cover < 0.30 OR bw / w < 0.45 OR bh / h < 0.45 THEN -1.0 ELSE cover * (0.7 + 0.3 * rect) - 0.025 * (l::INT + t::INT + r::INT + b::INT) END AS score FROM g)"""
_HOMOGRAPHY = """d0 AS (SELECT *, (bx-cx)*(dy-cy) - (dx-cx)*(by_-cy) AS det, ax-bx+cx-dx AS sx, ay-by_+cy-dy AS sy FROM oq),
gh AS (SELECT *, (sx*(dy-cy) - (dx-cx)*sy) / det AS g, ((bx-cx)*sy - sx*(by_-cy)) / det AS hh FROM d0),
hm AS (SELECT pos, bx-ax+g*bx AS h0, dx-ax+hh*dx AS h1, ax AS h2, by_-ay+g*by_ AS h3, dy-ay+hh*dy AS h4, ay AS h5, g AS h6, hh AS h7, 1.0 AS h8 FROM gh)"""
_PROBS = """e AS (SELECT image_id, exp(l0 - greatest(l0, l1, l2)) AS e0, exp(l1 - greatest(l0, l1, l2)) AS e1, exp(l2 - greatest(l0, l1, l2)) AS e2 FROM fx_probs),
p AS (SELECT image_id, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM e),
cand AS (SELECT *, greatest(p0, p1, p2) AS confidence, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'check_offset' WHEN p1 >= p2 THEN 'check_aligned' ELSE 'check_absent' END AS candidate FROM p),
gated AS (SELECT *, CASE WHEN confidence >= CASE WHEN candidate = 'check_absent' THEN 0.95 ELSE 0.80 END THEN candidate ELSE 'unknown' END AS label FROM cand)"""
_MERGED = "mg AS (SELECT m.ord, m.cohort, m.result_json, CASE WHEN r.result_json IS NOT NULL THEN r.label ELSE m.label END AS label FROM fx_manifest m LEFT JOIN fx_reviewed r ON lower(r.result_json) = lower(m.result_json))"
_CROP = "CAST(greatest(0, floor(x1 - {mx})) AS BIGINT) AS l, CAST(greatest(0, floor(y1 - {my})) AS BIGINT) AS t, CAST(least(720, ceil(x2 + {mx})) AS BIGINT) AS r, CAST(least(1280, ceil(y2 + {my})) AS BIGINT) AS b"
_CROP_OUT = 'CASE WHEN r > l AND b > t THEN l END AS "left", CASE WHEN r > l AND b > t THEN t END AS top, CASE WHEN r > l AND b > t THEN r END AS "right", CASE WHEN r > l AND b > t THEN b END AS bottom'
_WHITE = r"[\s　]+"


def _cleaned(t: str) -> str:
    return f"trim(regexp_replace({t}, '{_WHITE}', ' ', 'g'))"


def _amount_of(t: str) -> str:
    """Fen of the best of all matches: with a currency sign, with a point, the longest, the first."""
    pattern = r"(?:[¥￥]\s*)?([0-9OoIl]{1,3}(?:,[0-9OoIl]{3})*(?:\.[0-9]{1,2})?)"
    found = [f"regexp_extract_all({_cleaned(t)}, '{pattern}', {g})" for g in range(2)]
    ranked = f"list_transform(list_zip({found[0]}, {found[1]}, range(len({found[0]}))), lambda x: {{s: left(x[1], 1) IN ('¥', '￥'), p: contains(x[2], '.'), l: length(x[2]), i: -x[3], n: x[2]}})"
    return f"CAST(CAST(replace(translate(list_sort({ranked}, 'DESC')[1].n, 'OoIl', '0011'), ',', '') AS DECIMAL(28, 2)) * 100 AS BIGINT)"


def _time_of(t: str) -> str:
    """The first candidate that is a clock time, else the first that is one reversed. Without look-behind: characters that aren't part of
    a time are doubled, so that neighbours don't share the one between them."""
    apart = rf"regexp_replace(replace({t}, '：', ':'), '([^0-9:])', '\1\1', 'g')"
    found = f"regexp_extract_all({apart}, '(?:^|[^0-9])([0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?)(?:[^0-9]|$)', 1)"
    valid = "lambda x: CAST(split_part(x, ':', 1) AS INT) < 24 AND CAST(split_part(x, ':', 2) AS INT) < 60 AND coalesce(TRY_CAST(split_part(x, ':', 3) AS INT), 0) < 60"
    return f"coalesce(list_filter({found}, {valid})[1], list_filter(list_transform({found}, lambda x: reverse(x)), {valid})[1])"


def _value_of(t: str, words: tuple[str, ...]) -> str:
    """What stands behind the first word that leaves something, else before it; without a word all of it."""
    c, edges = _cleaned(t), " :：-—"
    sides = [f"CASE WHEN strpos({c}, '{w}') > 0 THEN coalesce(nullif(ltrim(substring({c}, strpos({c}, '{w}') + {len(w)}), '{edges}'), ''), nullif(rtrim(left({c}, strpos({c}, '{w}') - 1), '{edges}'), '')) END" for w in words]
    return f"coalesce({', '.join(sides)}, {c})"


def _recipient_of(t: str) -> str:
    return _value_of(t, ("收款方", "收款人", "收款账户", "收款账号"))


def _payment_of(t: str) -> str:
    return _value_of(t, ("付款方式", "交易方式", "付款渠道", "支付方式"))


def _committed(select: str) -> str:
    return fx(f"WITH {_COMMITTED} {select}", "fx_paths", "fx_bundles")


ORACLES = {
    "selection_key": fx("SELECT image_id, sha256(image_id) AS key FROM fx_paths", "fx_paths"),
    "assign_shard": fx("SELECT image_id, CAST(('0x' || substring(sha256(image_id), 1, 16))::UBIGINT % 8 AS INT) AS shard FROM fx_paths", "fx_paths"),
    "select_shard": fx("SELECT image_id, 3 AS shard FROM fx_paths WHERE ('0x' || substring(sha256(image_id), 1, 16))::UBIGINT % 8 = 3", "fx_paths"),
    "sample_cohort": fx("SELECT image_id, sha256(image_id) AS key FROM fx_paths ORDER BY key, image_id LIMIT 100", "fx_paths"),
    "scan_images": fx("SELECT image_id, length FROM fx_paths WHERE lower(regexp_extract(image_id, '[.]([^./]+)$', 1)) IN ('jpg','jpeg','png','webp','bmp','tif','tiff')", "fx_paths"),
    "join_corrections": fx(f"WITH {_CORRECTED} SELECT image_id, c_id FROM j", "fx_corrections"),
    "drop_skipped": fx(f"WITH {_CORRECTED} SELECT image_id FROM j WHERE NOT coalesce(skip, false)", "fx_corrections"),
    "apply_defaults": fx(
        f"WITH {og.CORRECTED_PHOTOS}, o AS (SELECT image_id, CASE WHEN orientation_set THEN orientation END AS orientation_degrees, coalesce(CASE WHEN prefer_portrait_set THEN prefer_portrait ELSE true END, false) AS prefer_portrait, "
        "coalesce(CASE WHEN auto_screen_set THEN auto_screen ELSE true END, false) AS auto_screen, CASE WHEN max_side_set THEN max_side ELSE 1600 END AS max_side, "
        "qax AS q_ax, qay AS q_ay, qbx AS q_bx, qby AS q_by, qcx AS q_cx, qcy AS q_cy, qdx AS q_dx, qdy AS q_dy FROM fj) SELECT * FROM o", "fx_photos", "fx_corrections", "fx_turns",
    ),
    "output_name_collisions": fx(f"SELECT lower({_STEM}) AS stem, count(*) AS n, min(image_id) AS first FROM fx_paths GROUP BY 1 HAVING count(*) > 1", "fx_paths"),
    "is_bundle_committed": _committed("SELECT image_id, committed FROM c"),
    "split_committed": _committed("SELECT committed, count(*) AS n FROM c GROUP BY 1"),
    "write_manifest": _committed(f"SELECT image_id AS source, {_STEM} || '.json' AS result, {_STEM} || '_rectified_annotated.jpg' AS annotated_rectified, {_STEM} || '_original_annotated.jpg' AS annotated_original, CASE WHEN committed THEN 'skipped_existing' ELSE 'written' END AS status FROM c"),
    "rehydrate": fx("SELECT s.source, CASE WHEN p.image_id IS NULL THEN 'missing source' WHEN s.length <> p.length OR s.mtime <> p.mtime THEN 'changed source' END AS error FROM fx_stage s LEFT JOIN fx_paths p ON p.image_id = s.source", "fx_stage"),
    "overlapping_paths": fx("WITH o AS (SELECT DISTINCT CASE WHEN page_id % 17 = 0 THEN regexp_replace(image_id, '/[^/]*$', '') WHEN page_id % 13 = 0 THEN image_id ELSE 'out/' || image_id END AS path FROM fx_paths) SELECT DISTINCT path FROM o WHERE EXISTS (SELECT 1 FROM fx_paths p WHERE o.path = p.image_id OR starts_with(o.path, p.image_id || '/') OR starts_with(p.image_id, o.path || '/'))", "fx_paths"),
    "unmatched_names": fx("SELECT image_id FROM fx_paths WHERE NOT starts_with(image_id, 'm.example.com/')", "fx_paths"),
    "stale_crops": fx("SELECT p.image_id, NOT coalesce(b.crop_size > 0 AND b.crop_mtime >= greatest(b.result_mtime, p.mtime), false) AS stale FROM fx_paths p LEFT JOIN fx_bundles b ON b.source = p.image_id", "fx_bundles"),
    "group_id": fx(f"SELECT image_id, regexp_replace({_STEM}, '([^/])[_-](19|20)[0-9]{{12}}$', '\\1') AS group_id FROM fx_paths".replace("{{12}}", "{12}"), "fx_paths"),
    "capture_groups": fx(f"SELECT regexp_replace({_STEM}, '([^/])[_-](19|20)[0-9]{{12}}$', '\\1') AS group_id, count(*) AS n FROM fx_paths GROUP BY 1".replace("{{12}}", "{12}"), "fx_paths"),
    "choose_orientation": fx("""WITH s AS (SELECT *, confidence + least(n_lines, 10) * 0.01 + CASE WHEN (degrees % 180 = 0 AND h >= w) OR (degrees % 180 = 90 AND w >= h) THEN 0.02 ELSE 0.0 END AS score FROM fx_orient),
  t AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY coalesce(score, -1) DESC, degrees) AS n FROM s)
SELECT image_id, CAST(CASE WHEN explicit_degrees IS NOT NULL THEN (explicit_degrees + 360) % 360 WHEN score IS NOT NULL THEN degrees WHEN w > h THEN 90 ELSE 0 END AS INT) AS orientation FROM t WHERE n = 1""", "fx_orient"),
    "threshold_detections": fx("SELECT image_id, pos, score FROM fx_detections WHERE score >= 0.5", "fx_detections"),
    "map_labels": fx(f"WITH {_MAPPED} SELECT image_id, pos, label FROM m", "fx_detections"),
    "validate_detections": fx(f"WITH {_VIOLATIONS} SELECT image_id, pos, violations FROM v", "fx_detections"),
    "best_per_label": fx(f"WITH {_BEST} SELECT image_id, label, pos, score FROM best", "fx_detections"),
    "completeness": fx(f"""WITH {_BEST}, i AS (SELECT DISTINCT image_id FROM fx_detections), c AS (SELECT i.image_id, count(b.label) AS n, max(b.label = 'time') AS a1, max(b.label = 'amount') AS a2, max(b.label = 'transfer_status') AS a3, max(b.label = 'recipient_field') AS a4, max(b.label = 'payment_method_field') AS a5 FROM i LEFT JOIN best b ON b.image_id = i.image_id GROUP BY 1)
SELECT image_id, concat_ws(',', CASE WHEN NOT coalesce(a1, false) THEN 'time' END, CASE WHEN NOT coalesce(a2, false) THEN 'amount' END, CASE WHEN NOT coalesce(a3, false) THEN 'transfer_status' END, CASE WHEN NOT coalesce(a4, false) THEN 'recipient_field' END, CASE WHEN NOT coalesce(a5, false) THEN 'payment_method_field' END) AS missing, n, n = 5 AS complete FROM c""", "fx_detections"),
    "pivot_fields": fx(f"WITH {_MAPPED} SELECT image_id, max(CASE WHEN class_id = 1 THEN pos END) AS time, max(CASE WHEN class_id = 2 THEN pos END) AS amount, max(CASE WHEN class_id = 3 THEN pos END) AS transfer_status, max(CASE WHEN class_id = 4 THEN pos END) AS recipient_field, max(CASE WHEN class_id = 5 THEN pos END) AS payment_method_field FROM m GROUP BY 1", "fx_detections"),
    "status_box": fx(f"WITH {_MAPPED}, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pos) AS rn, count(*) OVER (PARTITION BY image_id) AS n FROM m WHERE class_id = 3) SELECT image_id, n, pos, score, n = 1 AS strict_ok FROM r WHERE rn = 1", "fx_detections"),
    "ocr_crop_box": fx("WITH c AS (SELECT pos, " + _CROP.format(mx="greatest(2.0, (x2 - x1) * 0.08::DOUBLE)", my="greatest(2.0, (y2 - y1) * 0.08::DOUBLE)") + f" FROM fx_detections) SELECT pos, {_CROP_OUT} FROM c", "fx_detections"),
    "status_crop_box": fx("WITH c AS (SELECT pos, " + _CROP.format(mx="(x2 - x1) * 0.3::DOUBLE", my="(y2 - y1) * 0.3::DOUBLE") + f", x2 > x1 AND y2 > y1 AS box FROM fx_detections), e AS (SELECT pos, box, CASE WHEN box THEN l END AS l, CASE WHEN box THEN t END AS t, CASE WHEN box THEN r END AS r, CASE WHEN box THEN b END AS b FROM c) SELECT pos, {_CROP_OUT}, CASE WHEN NOT box THEN 'empty box' WHEN NOT (r > l AND b > t) THEN 'box outside the image' END AS crop_error FROM e", "fx_detections"),
    "caption": fx(
        f"WITH {_BEST}, {_OCR} SELECT b.image_id, b.label, CASE b.label WHEN 'time' THEN '时间' WHEN 'amount' THEN '金额' WHEN 'transfer_status' THEN '转账状态' WHEN 'recipient_field' THEN '收款方' ELSE '付款方式' END "
        "|| coalesce(' ' || nullif(trim(o.text), ''), '') || ' (' || CAST(CAST(round_even(b.score * 100, 0) AS BIGINT) AS VARCHAR) || '%)' AS caption FROM best b LEFT JOIN ocr o ON o.image_id = b.image_id AND o.label = b.label", *_OCR_FX,
    ),
    "caption_rows": fx(f"WITH {_BEST} SELECT image_id, label, CAST(row_number() OVER (PARTITION BY image_id ORDER BY class_id, pos) AS INT) AS number FROM best", "fx_detections"),
    "ellipse_points": fx(
        f"WITH {_BEST}, {og.PHOTOS_OF_BOXES}, {og.plan(_SIDES + ', ' + _SCORED)}, e AS (SELECT b.image_id, b.pos, k, (x1 + x2) / 2 + greatest(2.0, (x2 - x1) / 2 + 3) * cos(k * (2 * 3.141592653589793::DOUBLE / 39)) AS px, "
        "(y1 + y2) / 2 + greatest(2.0, (y2 - y1) / 2 + 3) * sin(k * (2 * 3.141592653589793::DOUBLE / 39)) AS py FROM best b CROSS JOIN (SELECT unnest(range(0, 40)) AS k) ks) "
        f"SELECT pos, CAST(k AS INT) AS k, round(px, 6) AS px, round(py, 6) AS py, round({og.projected('px', 'py')[0]}, 6) AS photo_x, round({og.projected('px', 'py')[1]}, 6) AS photo_y FROM e JOIN plan ON plan.key = e.image_id", "fx_detections", "fx_quads",
    ),
    "route_errors": fx(f"WITH {_VIOLATIONS} SELECT pos, CASE WHEN violations <> '' THEN violations END AS message FROM v", "fx_detections"),
    "batch_summary": fx(f"WITH {_VIOLATIONS}, {_COMMITTED}, s AS (SELECT CASE WHEN committed THEN 'skipped_existing' ELSE 'written' END AS status FROM c UNION ALL SELECT 'failed' FROM v WHERE violations <> '') SELECT status, count(*) AS n FROM s GROUP BY 1", "fx_detections", "fx_bundles"),
    "union_errors": fx(f"WITH {_VIOLATIONS} SELECT CAST(image_id AS VARCHAR) AS source, violations AS message, 0 AS stage_no FROM v WHERE violations <> '' UNION ALL SELECT s.source, CASE WHEN p.image_id IS NULL THEN 'missing source' ELSE 'changed source' END, 1 FROM fx_stage s LEFT JOIN fx_paths p ON p.image_id = s.source WHERE p.image_id IS NULL OR s.length <> p.length OR s.mtime <> p.mtime", "fx_detections", "fx_stage"),
    "attach_ocr": fx(f"WITH {_BEST}, {_OCR} SELECT b.image_id, b.label, o.text FROM best b LEFT JOIN ocr o ON o.image_id = b.image_id AND o.label = b.label", *_OCR_FX),
    "field_state": fx(f"WITH {_BEST}, {_OCR} SELECT b.image_id, b.label, CASE WHEN coalesce(o.text, '') = '' THEN 'unreadable' ELSE 'read' END AS state FROM best b LEFT JOIN ocr o ON o.image_id = b.image_id AND o.label = b.label", *_OCR_FX),
    "aggregate_ocr_lines": fx("WITH c AS (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM fx_ocr_lines) SELECT image_id, CAST(class_id AS BIGINT) AS class_id, coalesce(string_agg(CASE WHEN t <> '' THEN t END, ' ' ORDER BY line_no), '') AS text, round(avg(score), 9) AS confidence, count(*) AS n_lines FROM c GROUP BY image_id, class_id", "fx_ocr_lines"),
    "build_fields": fx(f"""WITH {_BEST}, j AS (SELECT b.image_id, b.label, a.row_id AS arow, t.row_id AS trow, t.text AS ttext, f.row_id AS frow, f.status, f.payment, f.recipient AS rtext, a.text AS atext
    FROM best b LEFT JOIN (SELECT image_id, min(row_id) AS row_id, min_by(text, row_id) AS text FROM fx_amount_text GROUP BY image_id) a ON a.image_id = b.image_id AND b.label = 'amount' LEFT JOIN fx_time_text t ON t.row_id = b.image_id AND b.label = 'time' LEFT JOIN fx_field_rows f ON f.row_id = b.image_id AND b.label NOT IN ('amount', 'time')),
  v AS (SELECT image_id, label, CASE WHEN coalesce(arow, trow, frow) IS NULL THEN 'unreadable' ELSE 'read' END AS state, CASE WHEN label = 'time' THEN {_time_of('ttext')} END AS time_value, CASE WHEN label = 'amount' THEN {_amount_of('atext')} END AS amount_fen,
    CASE WHEN label = 'transfer_status' AND frow IS NOT NULL THEN {_STATUS.replace('s LIKE', "replace(status, ' ', '') LIKE")} END AS status, CASE WHEN label = 'recipient_field' AND frow IS NOT NULL THEN {_recipient_of('rtext')} END AS recipient, CASE WHEN label = 'payment_method_field' AND frow IS NOT NULL THEN {_PAYMENT.replace('s LIKE', 'payment LIKE')} END AS payment FROM j)
SELECT image_id, {', '.join(f"coalesce(max(CASE WHEN label = '{c}' THEN state END), 'absent') AS {c}_state" for c in ('time', 'amount', 'transfer_status', 'recipient_field', 'payment_method_field'))}, max(time_value) AS time_value, max(amount_fen) AS amount_fen, max(status) AS status, max(recipient) AS recipient, max(payment) AS payment FROM v GROUP BY image_id""", *_OCR_FX),
    "clean_text": fx("SELECT image_id, line_no, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM fx_ocr_lines", "fx_ocr_lines"),
    "extract_field_value": fx(f"SELECT row_id, {_recipient_of('recipient')} AS value FROM fx_field_rows", "fx_field_rows"),
    "normalize_time": fx(f"SELECT row_id, {_time_of('text')} AS time FROM fx_time_text", "fx_time_text"),
    "normalize_amount": fx(f"WITH a AS (SELECT row_id, {_amount_of('text')} AS f FROM fx_amount_text) SELECT row_id, '¥' || CAST(f // 100 AS VARCHAR) || '.' || lpad(CAST(f % 100 AS VARCHAR), 2, '0') AS normalized, f AS amount_fen FROM a", "fx_amount_text"),
    "normalize_status": fx(f"WITH a AS (SELECT row_id, replace(status, ' ', '') AS s FROM fx_field_rows) SELECT row_id, {_STATUS} AS status FROM a", "fx_field_rows"),
    "normalize_payment_method": fx(f"WITH a AS (SELECT row_id, replace(payment, ' ', '') AS s FROM fx_field_rows) SELECT row_id, {_PAYMENT} AS payment FROM a", "fx_field_rows"),
    "order_quad": fx(f"WITH {_ORDERED} SELECT pos, ax, ay, bx, by_, cx, cy, dx, dy FROM oq", "fx_quads"),
    "quad_score": fx(f"WITH {_ORDERED}, {_SIDES}, {_SCORED} SELECT pos, round(score, 6) AS score FROM sc", "fx_quads"),
    "best_quad": fx(f"WITH {_ORDERED}, {_SIDES}, {_SCORED}, t AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pos) AS n FROM sc) SELECT image_id, CASE WHEN score >= 0.10 THEN pos END AS pos, score >= 0.10 AS screen_detected, "
        + ", ".join(f"CASE WHEN score >= 0.10 THEN {c} ELSE {full} END AS q_{c.strip('_')}" for c, full in zip(og.CORNERS, (0, 0, "w - 1", 0, "w - 1", "h - 1", 0, "h - 1"))) + " FROM t WHERE n = 1", "fx_quads"),
    "output_size": fx(f"WITH {_ORDERED}, {_SIDES}, s AS (SELECT pos, greatest(2.0, round_even(greatest(ab, dc), 0) + 1) AS ow, greatest(2.0, round_even(greatest(ad, bc), 0) + 1) AS oh FROM sides), z AS (SELECT *, CASE WHEN greatest(ow, oh) > 1000 THEN 1000.0::DOUBLE / greatest(ow, oh) ELSE 1.0 END AS k FROM s) SELECT pos, CAST(greatest(2, round_even(ow * k, 0)) AS INT) AS out_w, CAST(greatest(2, round_even(oh * k, 0)) AS INT) AS out_h FROM z", "fx_quads"),
    "rotation_homography": fx("SELECT pos, " + ", ".join(f"CASE pos % 4 WHEN 0 THEN {a} WHEN 1 THEN {b} WHEN 2 THEN {c} ELSE {d} END::DOUBLE AS h{i}" for i, (a, b, c, d) in enumerate(zip(
        ("1", "0", "0", "0", "1", "0", "0", "0", "1"), ("0", "-1", "h - 1", "1", "0", "0", "0", "0", "1"), ("-1", "0", "w - 1", "0", "-1", "h - 1", "0", "0", "1"), ("0", "1", "0", "-1", "0", "w - 1", "0", "0", "1")))) + " FROM fx_quads", "fx_quads"),
    "homography": fx(
        f"WITH {_ORDERED}, {og.sized('oq', 'z', '1000')}, {og.map_to_rectangle('z', 'pos, ow, oh')}, {og.inverse_of('m', 'rect', 'io', 'pos, ' + ', '.join(og.names('h') + og.names('m')), 'n')} SELECT pos, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in og.names("h") + og.names("m") + og.names("n")) + ", true AS is_inverse FROM io", "fx_quads",
    ),
    "project_points": fx(f"WITH {_ORDERED}, {_HOMOGRAPHY} SELECT pos, round((h0 * 0.25 + h1 * 0.75 + h2) / (h6 * 0.25 + h7 * 0.75 + h8), 6) AS x, round((h3 * 0.25 + h4 * 0.75 + h5) / (h6 * 0.25 + h7 * 0.75 + h8), 6) AS y FROM hm", "fx_quads"),
    "softmax": fx(f"WITH {_PROBS} SELECT image_id, round(p0, 9) AS p0, round(p1, 9) AS p1, round(p2, 9) AS p2 FROM p", "fx_probs"),
    "gate_style": fx(f"WITH {_PROBS} SELECT image_id, label, candidate, round(confidence, 9) AS confidence FROM gated", "fx_probs"),
    "style_tags": fx(f"WITH {_PROBS} SELECT image_id, CASE label WHEN 'check_offset' THEN 'android' WHEN 'check_aligned' THEN 'ios' END AS platform, CASE label WHEN 'check_absent' THEN 'suspected_fake' WHEN 'unknown' THEN 'review' END AS review_tag, label IN ('check_absent', 'unknown') AS requires_manual_review, CASE label WHEN 'check_offset' THEN 'status_check_offset' WHEN 'check_aligned' THEN 'status_check_aligned' WHEN 'check_absent' THEN 'status_check_absent' ELSE 'status_style_low_confidence' END AS reason, CASE label WHEN 'check_offset' THEN 'android' WHEN 'check_aligned' THEN 'ios' WHEN 'check_absent' THEN 'suspected_fake' ELSE 'review' END AS business_tag FROM gated", "fx_probs"),
    "style_record": fx(
        f"WITH {_PROBS}, {_MAPPED}, s AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, pos) AS rn FROM m WHERE class_id = 3) "
        "SELECT s.image_id, x1, y1, x2, y2, coalesce(g.label, 'unknown') AS label, 2 AS schema_version, "
        "CASE WHEN g.label IS NULL THEN 'unavailable' WHEN g.label = 'unknown' THEN 'review' ELSE 'classified' END AS state, "
        "CASE g.label WHEN 'check_offset' THEN 'android' WHEN 'check_aligned' THEN 'ios' WHEN 'check_absent' THEN 'suspected_fake' ELSE 'review' END AS business_tag, "
        "coalesce(g.candidate, 'unknown') AS candidate_label, round(coalesce(g.confidence, 0), 9) AS confidence, 'style-1' AS model, 0.3::DOUBLE AS config "
        "FROM s LEFT JOIN gated g ON g.image_id = s.image_id WHERE rn = 1",
        "fx_probs", "fx_detections",
    ),
    "merge_review_labels": fx(f"WITH {_MERGED} SELECT ord, label FROM mg", "fx_manifest", "fx_reviewed"),
    "orphan_labels": fx("SELECT r.result_json FROM fx_reviewed r WHERE NOT EXISTS (SELECT 1 FROM fx_manifest m WHERE lower(m.result_json) = r.result_json)", "fx_manifest", "fx_reviewed"),
    "extend_cohort": fx("SELECT CASE WHEN ord % 3 = 0 THEN result_json ELSE 'old/' || result_json END AS result_json, false AS is_new, sha256(CASE WHEN ord % 3 = 0 THEN result_json ELSE 'old/' || result_json END) AS key, CAST(NULL AS VARCHAR) AS label FROM fx_manifest UNION ALL SELECT result_json, true, sha256(result_json), CAST(NULL AS VARCHAR) FROM fx_manifest WHERE ord % 3 <> 0", "fx_manifest"),
    "review_progress": fx(f"WITH {_MERGED}, n AS (SELECT unnest(['check_offset', 'check_aligned', 'check_absent', 'unclear', 'remaining']) AS label) SELECT n.label, count(m.ord) AS n FROM n LEFT JOIN mg m ON coalesce(m.label, 'remaining') = n.label GROUP BY n.label", "fx_manifest", "fx_reviewed"),
    "duplicate_keys": fx("SELECT lower(result_json) AS result_json, ord + 10000000 AS first_repeat, CAST(2 AS BIGINT) AS n FROM fx_manifest WHERE ord % 6 = 0", "fx_manifest"),
    "next_unlabelled": fx(f"WITH {_MERGED}, u AS (SELECT cohort, ord FROM mg WHERE label IS NULL), a AS (SELECT m.ord, min(CASE WHEN u.ord > m.ord THEN u.ord END) AS later, min(u.ord) AS lowest FROM mg m LEFT JOIN u ON u.cohort = m.cohort GROUP BY m.ord) SELECT ord, coalesce(later, lowest) AS next_ord FROM a", "fx_manifest", "fx_reviewed"),
    "review_position": fx("SELECT ord, CAST(row_number() OVER (PARTITION BY cohort ORDER BY ord) AS VARCHAR) || '/' || CAST(count(*) OVER (PARTITION BY cohort) AS VARCHAR) AS position FROM fx_manifest", "fx_manifest"),
    "limit_valid": fx(f"WITH {_MERGED} SELECT result_json, label FROM mg WHERE label IS NOT NULL ORDER BY sha256(result_json), result_json LIMIT 50", "fx_manifest", "fx_reviewed"),
}

_TAG = "CASE b.style_label WHEN 'check_offset' THEN 'android' WHEN 'check_aligned' THEN 'ios' WHEN 'check_absent' THEN 'suspected_fake' ELSE 'review' END"
_MANIFEST = (
    f"SELECT image_id AS source, {_STEM} || '.json' AS result, {_STEM} || '_rectified_annotated.jpg' AS annotated_rectified, "
    f"{_STEM} || '_original_annotated.jpg' AS annotated_original"
)

ORACLES |= {
    # a path may repeat: outputs and style are those of one and the same bundle
    "is_bundle_committed_style": fx(
        f"SELECT p.image_id, coalesce({_STANDS} AND b.style_schema = 2 AND b.style_model = 'style-1' AND b.style_config = 0.3 "
        f"AND b.style_tag = {_TAG}, false) AS committed FROM fx_paths p LEFT JOIN fx_bundles b ON b.source = p.image_id", "fx_paths", "fx_bundles",
    ),
    "result_paths": fx(_MANIFEST.replace("AS source", "AS image_id") + " FROM fx_paths", "fx_paths"),
    "union_manifests": _committed(f"{_MANIFEST}, CASE WHEN committed THEN 'skipped_existing' ELSE 'written' END AS status, committed AS carried FROM c"),
    "require_same_config": fx(
        "SELECT style_config, style_model, count(*) AS n, style_config = 0.3 AND style_model = 'style-1' AS same FROM fx_bundles GROUP BY 1, 2", "fx_bundles"
    ),
    "rectification_manifest": fx(
        f"WITH {og.CORRECTED_PHOTOS}, {og.plan(_SIDES + ', ' + _SCORED)} SELECT '/photos/' || path AS source, path AS source_relative, 'images/' || regexp_replace(path, '[.][^./]+$', '') || '.jpg' AS rectified_image, "
        f"{og.size_json('plan.w', 'plan.h')} AS source_size, {og.size_json('ow', 'oh')} AS rectified_size, deg AS rotation_degrees, detected AS screen_detected, {og.QUAD} AS screen_quad_original, "
        f'{og.TO_RECTIFIED} AS "H_original_to_rectified", {og.TO_ORIGINAL} AS "H_rectified_to_original" FROM plan JOIN fo ON fo.key = plan.key', "fx_photos", "fx_corrections", "fx_turns", "fx_quads",
    ),
    "plan_rectification": fx(
        f"WITH {og.CORRECTED_PHOTOS}, {og.plan(_SIDES + ', ' + _SCORED)} SELECT p2.key AS image_id, plan.deg AS rotation_degrees, plan.detected AS screen_detected, ow AS rectified_w, oh AS rectified_h, p2.error FROM p2 LEFT JOIN plan ON plan.key = p2.key",
        "fx_photos", "fx_corrections", "fx_turns", "fx_quads",
    ),
    "validate_geometry": fx(
        """SELECT pos, concat_ws(',', CASE WHEN now_w <> w THEN 'source size' END, CASE WHEN now_h <> h THEN 'rectified size' END, CASE WHEN qx IS NULL THEN 'screen quad' END,
  CASE WHEN a = 0 THEN 'to_rectified' END, CASE WHEN a <> 0 AND (abs(a * itx + tx) > 1e-5 OR abs(b * ity + ty) > 1e-5 OR abs(a * ia - 1) > 2e-5 OR abs(b * ib - 1) > 2e-5) THEN 'not inverse' END,
  CASE WHEN rotation_degrees NOT IN (0, 90, 180, 270) THEN 'rotation' END) AS violations FROM fx_geometry""",
        "fx_geometry",
    ),
    "bbox_to_polygon": fx(
        "SELECT pos, x1 AS p0x, y1 AS p0y, x2 AS p1x, y1 AS p1y, x2 AS p2x, y2 AS p2y, x1 AS p3x, y2 AS p3y, "
        "0 AS f0x, 0 AS f0y, 719 AS f1x, 0 AS f1y, 719 AS f2x, 1279 AS f2y, 0 AS f3x, 1279 AS f3y FROM fx_detections",
        "fx_detections",
    ),
    "validate_images": fx(
        f"WITH {_VIOLATIONS}, u AS (SELECT image_id, unnest(string_split(violations, ',')) AS x FROM v) "
        "SELECT image_id, coalesce(string_agg(DISTINCT nullif(x, ''), ',' ORDER BY nullif(x, '')), '') AS violations FROM u GROUP BY 1",
        "fx_detections",
    ),
    "structured_caption_text": fx(
        f"""WITH {_BEST}, t AS (SELECT image_id, 'amount' AS label, min_by(text, row_id) AS text, min(row_id) AS row_id FROM fx_amount_text GROUP BY image_id),
  o AS (SELECT image_id, label, text, (SELECT '¥' || CAST(f // 100 AS VARCHAR) || '.' || lpad(CAST(f % 100 AS VARCHAR), 2, '0') FROM (SELECT {_amount_of('text')} AS f)) AS value FROM t
    UNION ALL SELECT row_id, 'recipient_field', recipient, {_recipient_of('recipient')} FROM fx_field_rows UNION ALL SELECT row_id, 'transfer_status', status, NULL FROM fx_field_rows
    UNION ALL SELECT row_id, 'payment_method_field', payment, {_payment_of('payment')} FROM fx_field_rows UNION ALL SELECT row_id, 'time', text, {_time_of('text')} FROM fx_time_text)
SELECT b.image_id, b.label, coalesce(o.value, o.text) AS text FROM best b LEFT JOIN o ON o.image_id = b.image_id AND o.label = b.label""",
        *_OCR_FX,
    ),
    "style_caption": fx(
        f"""WITH {_PROBS}, {_BEST}, k AS (SELECT image_id, count(*) AS n FROM best GROUP BY 1)
SELECT g.image_id, CAST(coalesce(k.n, 0) + 1 AS INT) AS number, '设备/风险标签 ' || CASE g.label WHEN 'check_offset' THEN 'Android' WHEN 'check_aligned' THEN 'iOS' WHEN 'check_absent' THEN '疑似假图' ELSE '待复核' END
  || ' (' || CAST(CAST(round_even(confidence * 100, 0) AS BIGINT) AS VARCHAR) || '%)' AS caption FROM gated g LEFT JOIN k ON k.image_id = g.image_id""",
        "fx_probs", "fx_detections",
    ),
    "load_corrections": fx(
        "SELECT image_id AS key, page_id % 3 = 0 AS skip, page_id % 2 = 0 OR page_id % 5 = 1 AS orientation_set, CASE WHEN page_id % 2 = 1 AND page_id % 5 = 1 THEN -90 END AS orientation, "
        "page_id % 8 <> 0 AS prefer_portrait_set, CASE WHEN page_id % 8 <> 0 THEN page_id % 8 IN (3, 6, 7) END AS prefer_portrait, page_id % 7 < 3 AS auto_screen_set, CASE WHEN page_id % 7 < 3 THEN page_id % 7 = 2 END AS auto_screen, "
        "page_id % 4 IN (1, 2) AS screen_quad_set, CASE WHEN page_id % 4 = 1 THEN '[[0.0,' || CAST(CAST(page_id % 50 AS DOUBLE) AS VARCHAR) || '],[9.5,0.0],[9.0,9.0],[1.0,8.0]]' END AS screen_quad, "
        "true AS max_side_set, CAST(page_id % 4 * 100 AS INT) AS max_side FROM fx_paths",
        "fx_paths",
    ),
    "flatten_ocr_payload": fx(
        """SELECT doc_id, 0 AS line_no, 'a' || CAST(doc_id AS VARCHAR) AS text, 0.5::DOUBLE AS score FROM documents WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id, 1, 'b', 0.25 FROM documents WHERE doc_id % 5 = 0
UNION ALL SELECT doc_id, 0, 't' || CAST(doc_id AS VARCHAR), 0 FROM documents WHERE doc_id % 5 = 1
UNION ALL SELECT doc_id, 0, 'x' || CAST(doc_id AS VARCHAR), 0.75 FROM documents WHERE doc_id % 5 = 2 UNION ALL SELECT doc_id, 1, 'y', 0 FROM documents WHERE doc_id % 5 = 2""",
        "fx_payloads",
    ),
}

_SCORES = "'ocr_confidence', confidence, 'detector_score', round(score, 6)"
_FEN = _amount_of("text")
_YUAN = "(SELECT '¥' || CAST(f // 100 AS VARCHAR) || '.' || lpad(CAST(f % 100 AS VARCHAR), 2, '0') FROM (SELECT fen AS f))"
_R = {c: og.exact(c, 3) for c in ("x1", "y1", "x2", "y2")}
_PHOTO = [f"[round_even({x} * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE + 0.0, round_even({y} * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE + 0.0]" for x, y in (og.projected(a, b) for a, b in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2")))]
_QUAD = f"[{', '.join(_PHOTO)}]"
_BOX = f"'label', label, 'score', round(score, 6), 'bbox_rectified', [{_R['x1']}, {_R['y1']}, {_R['x2']}, {_R['y2']}], 'quad_original', {_QUAD}"
_READ = f"""CASE WHEN text IS NULL OR text = '' THEN json_object('state', 'unreadable', 'raw', NULL, 'score', round(score, 6))
    WHEN label = 'time' THEN json_object('state', 'read', 'raw', text, {_SCORES}, 'value', {_time_of('text')})
    WHEN label = 'amount' AND fen IS NOT NULL THEN json_object('state', 'read', 'raw', {_cleaned('text')}, {_SCORES}, 'normalized', {_YUAN}, 'amount_fen', fen, 'currency', 'CNY')
    WHEN label = 'amount' THEN json_object('state', 'read', 'raw', text, {_SCORES})
    WHEN label = 'transfer_status' THEN json_object('state', 'read', 'raw', text, {_SCORES}, 'normalized', {_STATUS.replace('s LIKE', "replace(text, ' ', '') LIKE")})
    WHEN label = 'recipient_field' THEN json_object('state', 'read', 'raw', text, {_SCORES}, 'value', {_recipient_of('text')})
    ELSE json_object('state', 'read', 'raw', text, {_SCORES}, 'value', {_payment_of('text')}, 'normalized', {_PAYMENT.replace('s LIKE', f"({_payment_of('text')}) LIKE")}) END"""
_STYLE_OBJECT = """json_object('schema_version', 2, 'state', CASE WHEN g.label = 'unknown' THEN 'review' ELSE 'classified' END, 'label', g.label, 'confidence', round(round(g.confidence, 9), 6),
    'business_tag', CASE g.label WHEN 'check_offset' THEN 'android' WHEN 'check_aligned' THEN 'ios' WHEN 'check_absent' THEN 'suspected_fake' ELSE 'review' END, 'model', 'style-1')"""
_TAGS_OBJECT = """json_object('platform', CASE g.label WHEN 'check_offset' THEN 'android' WHEN 'check_aligned' THEN 'ios' END, 'authenticity', 'not_assessed',
    'review_tag', CASE g.label WHEN 'check_absent' THEN 'suspected_fake' WHEN 'unknown' THEN 'review' END, 'requires_manual_review', g.label IN ('check_absent', 'unknown'),
    'reason', CASE g.label WHEN 'check_offset' THEN 'status_check_offset' WHEN 'check_aligned' THEN 'status_check_aligned' WHEN 'check_absent' THEN 'status_check_absent' ELSE 'status_style_low_confidence' END,
    'rule_version', 'status-style-v2')"""
_FIELD_OF = {"time": "time", "amount": "amount", "transfer_status": "transfer_status", "recipient": "recipient_field", "payment_method": "payment_method_field"}
_FIELD_LIST = ", ".join(
    f"'{k}', coalesce(max(CASE WHEN label = '{label}' THEN field END)::JSON, json_object('state', 'absent', 'raw', NULL))" for k, label in _FIELD_OF.items()
)

_GEOMETRY = og.GEOMETRY

ORACLES["write_bundles"] = fx(
    f"""WITH {_PROBS.replace("p AS (", "pr AS (").replace("FROM p)", "FROM pr)")}, {_BEST}, {og.PHOTOS_OF_BOXES}, {og.plan(_SIDES + ", " + _SCORED).replace("f AS (SELECT", "ff AS (SELECT").replace("FROM f)", "FROM ff)")}, ocr AS (SELECT image_id AS oid, 'amount' AS olabel, min_by(text, row_id) AS text, min(row_id) AS row_id FROM fx_amount_text GROUP BY image_id
    UNION ALL SELECT row_id, 'recipient_field', recipient, row_id FROM fx_field_rows UNION ALL SELECT row_id, 'transfer_status', status, row_id FROM fx_field_rows
    UNION ALL SELECT row_id, 'payment_method_field', payment, row_id FROM fx_field_rows UNION ALL SELECT row_id, 'time', text, row_id FROM fx_time_text),
  j AS (SELECT b.*, o.text, o.row_id, CASE WHEN o.text IS NOT NULL AND image_id % 9 <> 0 THEN CAST(image_id * 7 % 100 AS DOUBLE) / 100 END AS confidence FROM best b LEFT JOIN ocr o ON o.oid = b.image_id AND o.olabel = b.label),
  k AS (SELECT j.*, plan.* EXCLUDE (error, w, h), CASE WHEN label = 'amount' THEN {_FEN} END AS fen FROM j JOIN plan ON plan.key = j.image_id),
  f AS (SELECT *, CAST({_READ} AS VARCHAR) AS field,
    CASE WHEN text IS NOT NULL THEN json_object({_BOX}, 'ocr', json_object('text', text, 'confidence', confidence)) ELSE json_object({_BOX}) END AS box FROM k),
  i AS (SELECT image_id, json_object({_FIELD_LIST}) AS fields, string_agg(CAST(box AS VARCHAR), ',' ORDER BY pos) AS boxes FROM f GROUP BY image_id),
  st AS (SELECT DISTINCT image_id FROM m WHERE class_id = 3)
SELECT i.image_id, '{{"source":"in/' || CAST(i.image_id AS VARCHAR) || '.png","geometry":' || {_GEOMETRY} || ',"fields":' || CAST(fields AS VARCHAR)
  || ',"detections":[' || boxes || ']' || CASE WHEN g.label IS NOT NULL AND st.image_id IS NOT NULL THEN ',"status_style":' || CAST({_STYLE_OBJECT} AS VARCHAR) || ',"tags":' || CAST({_TAGS_OBJECT} AS VARCHAR) ELSE '' END || '}}' AS document
FROM i LEFT JOIN st ON st.image_id = i.image_id LEFT JOIN gated g ON g.image_id = i.image_id JOIN plan ON plan.key = i.image_id""",
    "fx_probs", "fx_quads", *_OCR_FX,
)

_LINE = "CASE WHEN json_valid(line) THEN json_extract_string(line, '$.{0}') END AS {0}"
ORACLES["read_label_manifest"] = fx(
    f"""WITH p AS (SELECT line_no, json_valid(line) AS good, CASE WHEN json_valid(line) THEN len(json_keys(line)) END AS n, {", ".join(_LINE.format(c) for c in ("crop", "source", "result_json", "group_id", "label"))} FROM fx_label_lines),
  q AS (SELECT *, row_number() OVER (PARTITION BY lower(result_json) ORDER BY line_no) AS k FROM p)
SELECT line_no, concat_ws(',', CASE WHEN NOT good THEN 'not an object' END, CASE WHEN n < 5 THEN 'missing key' END,
  CASE WHEN label NOT IN ('check_offset', 'check_aligned', 'check_absent', 'unclear') THEN 'label' END,
  CASE WHEN trim(crop) = '' OR trim(source) = '' OR trim(result_json) = '' OR trim(group_id) = '' THEN 'blank' END,
  CASE WHEN result_json IS NOT NULL AND k > 1 THEN 'repeated' END) AS violations FROM q""",
    "fx_label_lines",
)

_ITEMS = """mg0 AS (SELECT max(generation) + 1 AS g FROM fx_cohort),
it AS (SELECT c.generation, c.place, c.result_json, r.value, r.mtime, true AS old, c.crop AS wcrop, c.source AS wsource, c.group_id AS wgroup FROM fx_cohort c LEFT JOIN fx_results r ON r.result_json = c.result_json
  UNION ALL SELECT (SELECT g FROM mg0), sha256(result_json) || ' ' || result_json, result_json, value, mtime, false, NULL, NULL, NULL FROM fx_results r WHERE NOT EXISTS (SELECT 1 FROM fx_cohort c WHERE lower(c.result_json) = lower(r.result_json))),
js AS (SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS j, regexp_replace(result_json, '[.][^./]+$', '') AS stem FROM it),
dt AS (SELECT *, coalesce(json_type(j) = 'OBJECT' AND json_exists(j, '$.source') AND json_exists(j, '$.geometry') AND json_exists(j, '$.detections'), false) AS whole, nullif(trim(json_extract_string(j, '$.source')), '') AS src,
  CAST(json_extract(j, '$.geometry.rectified_size.width') AS INT) AS rw, CAST(json_extract(j, '$.geometry.rectified_size.height') AS INT) AS rh, CAST(json_extract(j, '$.geometry.source_size.width') AS INT) AS sw,
  json_array_length(j, '$.geometry.H_original_to_rectified') AS nrows, CAST(json_extract(j, '$.geometry.H_original_to_rectified[0][0]') AS DOUBLE) AS m0,
  list_filter(CAST(json_extract(j, '$.detections[*]') AS JSON[]), lambda x: json_extract_string(x, '$.label') = 'transfer_status') AS st FROM js),
bx AS (SELECT dt.*, ph.w, ph.image_id AS live, len(st) AS n, c.length > 0 AND c.mtime >= greatest(dt.mtime, p.mtime) AS fresh, stem || '.jpg' AS crop, CAST(json_extract(st[1], '$.bbox_rectified') AS DOUBLE[]) AS b
  FROM dt LEFT JOIN fx_photos ph ON '/photos/' || ph.image_id = src LEFT JOIN fx_paths p ON p.page_id = ph.page_id LEFT JOIN fx_crops c ON c.crop = stem || '.jpg'),
ed AS (SELECT *, CAST(greatest(0, floor(b[1] - (b[3] - b[1]) * 0.3::DOUBLE)) AS BIGINT) AS l, CAST(greatest(0, floor(b[2] - (b[4] - b[2]) * 0.3::DOUBLE)) AS BIGINT) AS t,
  CAST(least(rw, ceil(b[3] + (b[3] - b[1]) * 0.3::DOUBLE)) AS BIGINT) AS r, CAST(least(rh, ceil(b[4] + (b[4] - b[2]) * 0.3::DOUBLE)) AS BIGINT) AS bo FROM bx WHERE NOT (j IS NOT NULL AND NOT whole AND NOT old)),
er AS (SELECT *, CASE WHEN value IS NULL THEN result_json WHEN j IS NULL THEN 'invalid JSON' WHEN NOT whole THEN 'no longer a result document' WHEN src IS NULL THEN 'result has no source path' WHEN live IS NULL THEN src
  WHEN coalesce(fresh, false) THEN NULL WHEN rw < 2 THEN 'rectified size must be at least 2' WHEN sw <> w THEN 'source size changed' WHEN nrows <> 3 THEN 'matrix must be finite and 3 x 3' WHEN m0 = 0 THEN 'matrix is singular'
  WHEN n <> 1 THEN 'expected one transfer_status, found ' || CAST(n AS VARCHAR) WHEN b[3] <= b[1] THEN 'box must be finite and not empty' WHEN r <= l OR bo <= t THEN 'box outside the image' END AS message,
  CASE WHEN value IS NULL OR (whole AND src IS NOT NULL AND live IS NULL) THEN 'FileNotFoundError' ELSE 'ValueError' END AS kind FROM ed)"""
_EXPORT = ("fx_results", "fx_cohort", "fx_crops", "fx_photos")
_GROUP = "regexp_extract(result_json, '^(.*/)', 1) || coalesce(nullif(regexp_extract(regexp_replace(regexp_replace(src, '^.*/', ''), '[.][^./]+$', ''), '^(.*)[_-](19|20)[0-9]{12}$', 1), ''), regexp_replace(stem, '^.*/', ''))"
ORACLES |= {
    "export_cohort": fx(
        f"WITH {_ITEMS} SELECT generation, place, CASE WHEN message IS NULL THEN crop ELSE wcrop END AS crop, CASE WHEN message IS NULL THEN src ELSE wsource END AS source, result_json, "
        f"CASE WHEN message IS NULL THEN {_GROUP} ELSE wgroup END AS group_id, NULL AS label FROM er WHERE message IS NULL OR old", *_EXPORT,
    ),
    "export_crop_plan": fx(f'WITH {_ITEMS} SELECT result_json, src AS source, crop, l AS "left", t AS top, r AS "right", bo AS bottom FROM er WHERE message IS NULL AND NOT coalesce(fresh, false)', *_EXPORT),
    "export_errors": fx(f"WITH {_ITEMS} SELECT generation, place, result_json, kind AS error_type, message FROM er WHERE message IS NOT NULL", *_EXPORT),
    "first_error": fx(f"WITH {_ITEMS} SELECT kind AS error_type, message FROM er WHERE message IS NOT NULL ORDER BY generation, place LIMIT 1", *_EXPORT),
}
