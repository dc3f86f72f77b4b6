"""Views that stand in for detector, OCR, review and inventory tables, derived by arithmetic from the given tables.

Each is one SQL text that Spark and DuckDB both read, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIXTURES = {
    "fx_detections": """
SELECT user_id * 10 + event_id % 10 AS image_id, event_id AS pos,
  CASE WHEN event_id % 41 = 0 THEN 9 WHEN event_id % 43 = 0 THEN 0 WHEN event_type = 'click' THEN 1 WHEN event_type = 'view' THEN 2
       WHEN event_type = 'purchase' THEN 3 WHEN event_type = 'signup' THEN 4 ELSE 5 END AS class_id,
  CAST(event_id * 37 % 21 AS DOUBLE) / 20 AS score,
  CAST(event_id * 13 % 600 AS DOUBLE) AS x1, CAST(event_id * 29 % 1200 AS DOUBLE) AS y1,
  CASE WHEN event_id % 97 = 0 THEN CAST(event_id * 13 % 600 AS DOUBLE) ELSE CAST(event_id * 13 % 600 AS DOUBLE) + 20 + value END AS x2,
  CAST(event_id * 29 % 1200 AS DOUBLE) + 10 + value / 4 AS y2
FROM events""",
    "fx_ocr_lines": """
SELECT conv_id AS image_id, 1 + turn % 5 AS class_id, turn AS line_no, CASE WHEN turn = 6 THEN '   ' ELSE text END AS text,
  CAST((conv_id * 7 + turn * 11) % 100 AS DOUBLE) / 100 AS score
FROM conversations""",
    "fx_amount_text": """
SELECT o_orderkey AS row_id, o_custkey AS image_id, CASE o_orderkey % 11
  WHEN 0 THEN concat('¥', CAST(o_orderkey % 900 + 1 AS VARCHAR(20)), ',', CAST(100 + o_orderkey % 899 AS VARCHAR(20)), '.', CAST(10 + o_orderkey % 89 AS VARCHAR(20)))
  WHEN 1 THEN concat('￥　', CAST(o_orderkey % 90 + 1 AS VARCHAR(20)), ',', CAST(100 + o_orderkey % 899 AS VARCHAR(20)), '.5')
  WHEN 2 THEN concat('¥', CAST(1000 + o_orderkey % 8999 AS VARCHAR(20)), '.', CAST(10 + o_orderkey % 89 AS VARCHAR(20)))
  WHEN 3 THEN concat('12:30 ', CAST(o_orderkey % 90 + 1 AS VARCHAR(20)), ',', CAST(100 + o_orderkey % 899 AS VARCHAR(20)), '.25')
  WHEN 4 THEN concat('¥1O', CAST(o_orderkey % 9 AS VARCHAR(20)), '.l0')
  WHEN 6 THEN concat('共', CAST(o_custkey % 7 AS VARCHAR(20)), '笔 ', CAST(o_orderkey % 997 AS VARCHAR(20)), '.5', CAST(o_custkey % 10 AS VARCHAR(20)), ' 元')
  WHEN 7 THEN concat(CAST(o_custkey % 900 AS VARCHAR(20)), '.25 ￥', CAST(o_orderkey % 800 AS VARCHAR(20)), ' ￥ ', CAST(o_orderkey % 90 AS VARCHAR(20)), '.7')
  WHEN 8 THEN concat('-', CAST(o_orderkey AS VARCHAR(20)), ',', CAST(o_custkey AS VARCHAR(20)), '.', CAST(o_custkey % 1000 AS VARCHAR(20)))
  WHEN 9 THEN concat('  ¥ ', CAST(o_orderkey % 9 + 1 AS VARCHAR(20)), ',', CAST(o_custkey % 900 + 100 AS VARCHAR(20)), ',O', CAST(o_orderkey % 90 + 10 AS VARCHAR(20)), ' 转 ', CAST(o_orderkey AS VARCHAR(20)), '.00')
  WHEN 10 THEN concat(CAST(o_orderkey % 24 AS VARCHAR(20)), ':', CAST(o_custkey % 60 AS VARCHAR(20)), ' l', CAST(o_custkey % 10 AS VARCHAR(20)), ' Il,OOo.5 ')
  ELSE 'n/a' END AS text
FROM orders""",
    "fx_time_text": """
SELECT event_id AS row_id, CASE event_id % 11
  WHEN 0 THEN concat('at ', lpad(CAST(event_id % 24 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(event_id % 60 AS VARCHAR(20)), 2, '0'))
  WHEN 1 THEN concat(CAST(event_id % 24 AS VARCHAR(20)), ':', lpad(CAST(event_id % 60 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(event_id * 7 % 60 AS VARCHAR(20)), 2, '0'), ' ok')
  WHEN 2 THEN concat(lpad(CAST(event_id % 24 AS VARCHAR(20)), 2, '0'), '：', lpad(CAST(event_id % 60 AS VARCHAR(20)), 2, '0'))
  WHEN 3 THEN reverse(concat(lpad(CAST(event_id % 24 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(event_id % 60 AS VARCHAR(20)), 2, '0')))
  WHEN 4 THEN concat('25:61 ', lpad(CAST(event_id % 24 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(event_id % 60 AS VARCHAR(20)), 2, '0'))
  WHEN 6 THEN concat(CAST(user_id % 40 AS VARCHAR(20)), ':', lpad(CAST(event_id % 99 AS VARCHAR(20)), 2, '0'), '时', CAST(event_id % 30 AS VARCHAR(20)), ':', lpad(CAST(user_id % 70 AS VARCHAR(20)), 2, '0'))
  WHEN 7 THEN concat('7', CAST(event_id % 9 AS VARCHAR(20)), ':', lpad(CAST(user_id % 60 AS VARCHAR(20)), 2, '0'), ':', CAST(event_id AS VARCHAR(20)))
  WHEN 8 THEN concat(lpad(CAST(event_id % 99 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(user_id % 99 AS VARCHAR(20)), 2, '0'), ':', lpad(CAST(event_id % 77 AS VARCHAR(20)), 2, '0'), ' / ', lpad(CAST(user_id % 99 AS VARCHAR(20)), 2, '0'), '：', lpad(CAST(event_id % 99 AS VARCHAR(20)), 2, '0'))
  WHEN 9 THEN concat(CAST(event_id AS VARCHAR(20)), ':', CAST(user_id AS VARCHAR(20)), ' ', CAST(event_id % 10 AS VARCHAR(20)), ':', CAST(user_id % 10 AS VARCHAR(20)), '0x')
  ELSE concat('112:34', CAST(event_id % 10 AS VARCHAR(20))) END AS text
FROM events""",
    "fx_field_rows": """
SELECT c_custkey AS row_id, 4 AS class_id, CASE c_custkey % 11
  WHEN 0 THEN concat('收款方 ', c_name) WHEN 1 THEN concat(c_name, ' 收款方') WHEN 2 THEN '收款方'
  WHEN 3 THEN concat('收款方：', c_name) WHEN 4 THEN concat('收款人— ', c_name) WHEN 5 THEN concat('-- 收款账户 收款方: ', c_name, ' ') WHEN 6 THEN concat(c_name, '  —收款人：') WHEN 7 THEN concat('收款账号-', c_name, ' 收款人 x') WHEN 8 THEN '：收款方 —' ELSE c_name END AS recipient,
  CASE c_custkey % 7 WHEN 0 THEN '转账成功' WHEN 1 THEN '处 理 中' WHEN 2 THEN '未成功' WHEN 3 THEN '支付成功 已撤销' WHEN 4 THEN '待 处理' WHEN 5 THEN '交易 成功' ELSE 'x' END AS status,
  CASE c_mktsegment WHEN 'BUILDING' THEN '付款方式 余额宝' WHEN 'AUTOMOBILE' THEN '余额' WHEN 'MACHINERY' THEN '花呗' WHEN 'HOUSEHOLD' THEN '工商银行储蓄卡(1234)' ELSE 'cash' END AS payment
FROM customer""",
    "fx_paths": """
SELECT page_id, concat(stem, suffix) AS image_id, page_id * 7 % 1000 + 1 AS length, 1700000000000 + page_id * 1000 AS mtime FROM (
  SELECT page_id, concat(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), CASE WHEN page_id % 10 = 0 THEN '_20260701001815' ELSE '' END) AS stem,
    CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '.webp' ELSE '.txt' END AS suffix FROM pages
  UNION ALL
  SELECT page_id + 1000000000, upper(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')) AS stem, '.png' FROM pages WHERE page_id % 25 = 3
) AS p""",
    "fx_corrections": """
SELECT CASE WHEN page_id % 7 = 0 THEN image_id WHEN page_id % 11 = 0 THEN regexp_replace(image_id, '^.*/', '') ELSE concat(image_id, '.moved') END AS key, min(page_id) AS c_id, max(page_id % 3 = 0) AS skip,
  max(page_id % 2 = 0) AS orientation_set, max(CASE WHEN page_id % 4 = 0 THEN NULL WHEN page_id % 26 = 14 THEN 45 ELSE 90 * (page_id % 5 - 1) END) AS orientation, max(page_id % 5 = 0) AS max_side_set, max(CASE WHEN page_id % 3 = 0 THEN 0 WHEN page_id % 25 = 10 THEN 1 ELSE 640 END) AS max_side,
  max(page_id % 3 = 1) AS prefer_portrait_set, max(page_id % 2 = 1) AS prefer_portrait, max(page_id % 4 = 2) AS auto_screen_set, max(page_id % 8 = 2) AS auto_screen, max(page_id % 3 = 2) AS screen_quad_set,
  max(CASE WHEN page_id % 3 = 2 THEN CAST(70 + page_id % 83 AS DOUBLE) END) AS qax, max(CASE WHEN page_id % 3 = 2 THEN CAST(95 + page_id % 61 AS DOUBLE) END) AS qay,
  max(CASE WHEN page_id % 3 = 2 THEN CAST(700 - page_id % 47 AS DOUBLE) END) AS qbx, max(CASE WHEN page_id % 3 = 2 THEN CAST(80 + page_id % 53 AS DOUBLE) END) AS qby,
  max(CASE WHEN page_id % 3 = 2 THEN CAST(CASE WHEN page_id % 23 = 0 THEN 700 - page_id % 47 ELSE 660 + page_id % 37 END AS DOUBLE) END) AS qcx,
  max(CASE WHEN page_id % 3 = 2 THEN CAST(CASE WHEN page_id % 23 = 0 THEN 80 + page_id % 53 ELSE 710 + page_id % 29 END AS DOUBLE) END) AS qcy,
  max(CASE WHEN page_id % 3 = 2 THEN CAST(60 + page_id % 71 AS DOUBLE) END) AS qdx, max(CASE WHEN page_id % 3 = 2 THEN CAST(690 + page_id % 43 AS DOUBLE) END) AS qdy
FROM fx_paths GROUP BY 1""",
    "fx_bundles": """
SELECT CASE WHEN page_id % 3 = 0 THEN image_id ELSE concat(image_id, '.moved') END AS source, page_id % 8 <> 0 AS all_outputs, CASE WHEN page_id % 5 = 0 THEN mtime - 1000 ELSE mtime END AS result_mtime,
  CASE WHEN page_id % 14 = 0 THEN concat(image_id, '.old') ELSE image_id END AS recorded_source, page_id % 16 <> 1 AS fields_object,
  CASE WHEN page_id % 9 = 0 THEN 0 ELSE 5 END AS n_detections, CASE WHEN page_id % 9 = 0 THEN 0 WHEN page_id % 10 = 0 THEN 4 ELSE 5 END AS n_with_ocr,
  page_id % 3 + 1 AS crop_size, mtime + (page_id % 4) * 500 - 700 AS crop_mtime,
  CASE WHEN page_id % 12 = 0 THEN 1 ELSE 2 END AS style_schema, CASE WHEN page_id % 15 = 0 THEN 'style-0' ELSE 'style-1' END AS style_model,
  CASE WHEN page_id % 21 = 0 THEN 0.2 ELSE 0.3 END AS style_config, CASE page_id % 4 WHEN 1 THEN 'check_offset' WHEN 2 THEN 'check_aligned' WHEN 3 THEN 'check_absent' ELSE 'unknown' END AS style_label,
  CASE WHEN page_id % 6 = 3 THEN 'review' WHEN page_id % 4 = 1 THEN 'android' WHEN page_id % 4 = 2 THEN 'ios' WHEN page_id % 4 = 3 THEN 'suspected_fake' ELSE 'review' END AS style_tag
FROM fx_paths""",
    "fx_stage": """
SELECT CASE WHEN page_id % 22 = 0 OR page_id % 2 = 1 THEN concat(image_id, '.gone') ELSE image_id END AS source, CASE WHEN page_id % 6 = 0 THEN length + 1 ELSE length END AS length, mtime
FROM fx_paths""",
    "fx_orient": """
SELECT conv_id AS image_id, degrees, CASE WHEN conv_id % 6 = 0 THEN NULL ELSE CAST((conv_id * 3 + degrees) % 10 AS DOUBLE) / 10 END AS confidence,
  (conv_id + CAST(degrees / 90 AS BIGINT)) % 13 AS n_lines, CASE WHEN conv_id % 2 = 0 THEN 1200 ELSE 800 END AS w, CASE WHEN conv_id % 2 = 0 THEN 800 ELSE 1200 END AS h,
  CASE WHEN conv_id % 10 = 0 THEN -90 ELSE NULL END AS explicit_degrees
FROM (SELECT DISTINCT conv_id FROM conversations) AS c CROSS JOIN (SELECT 0 AS degrees UNION ALL SELECT 90 UNION ALL SELECT 180 UNION ALL SELECT 270) AS d""",
    "fx_photos": """
SELECT image_id, page_id, CASE WHEN page_id % 3 = 0 THEN 1400 ELSE 800 END AS w, CASE WHEN page_id % 3 = 0 THEN 800 ELSE 1400 END AS h FROM fx_paths""",
    "fx_turns": """
SELECT image_id, page_id, degrees, CASE WHEN page_id % 6 < 3 THEN NULL ELSE CAST((page_id * 3 + degrees) % 10 AS DOUBLE) / 10 END AS confidence, (page_id + CAST(degrees / 90 AS BIGINT)) % 13 AS n_lines
FROM fx_paths CROSS JOIN (SELECT 0 AS degrees UNION ALL SELECT 90 UNION ALL SELECT 180 UNION ALL SELECT 270) AS d""",
    "fx_results": """
SELECT page_id, concat(regexp_replace(image_id, '[.][^./]+$', ''), '.json') AS result_json, mtime AS mtime, CASE WHEN page_id % 13 = 3 THEN '{{"source": ' WHEN page_id % 13 = 5 THEN '{{"model": "m"}}' WHEN page_id % 13 = 6 THEN '[1, 2]' ELSE concat(
  '{{"source": "', CASE WHEN page_id % 17 = 4 THEN ' ' WHEN page_id % 19 = 7 THEN '/photos/gone.png' ELSE concat('/photos/', image_id) END,
  '", "geometry": {{"rectified_size": {{"width": ', CAST(CASE WHEN page_id % 37 = 2 THEN 1 ELSE 600 + page_id % 100 END AS VARCHAR(20)), ', "height": ', CAST(1000 + page_id % 77 AS VARCHAR(20)), '}}, "source_size": {{"width": ',
  CAST(CASE WHEN page_id % 31 = 11 THEN 801 WHEN page_id % 3 = 0 THEN 1400 ELSE 800 END AS VARCHAR(20)), ', "height": ', CAST(CASE WHEN page_id % 3 = 0 THEN 800 ELSE 1400 END AS VARCHAR(20)),
  '}}, "H_original_to_rectified": [[', CASE WHEN page_id % 23 = 9 THEN '0' ELSE '1.5' END, ', 0, 2], [0, 1, 1]', CASE WHEN page_id % 41 = 12 THEN '' ELSE ', [0, 0, 1]' END, ']}}, "detections": [{{"label": "amount", "bbox_rectified": [1, 2, 3, 4]}}',
  CASE WHEN page_id % 7 = 0 THEN '' ELSE concat(', {{"label": "transfer_status", "bbox_rectified": [', CAST(CASE WHEN page_id % 29 = 8 THEN 5000 ELSE page_id % 400 END AS VARCHAR(20)), '.25, ', CAST(page_id % 300 AS VARCHAR(20)), ', ',
    CAST(CASE WHEN page_id % 29 = 8 THEN 5100 WHEN page_id % 11 = 6 THEN page_id % 400 ELSE page_id % 400 + 90 END AS VARCHAR(20)), '.25, ', CAST(page_id % 300 + 40 AS VARCHAR(20)), ']}}') END,
  CASE WHEN page_id % 7 = 1 THEN ', {{"label": "transfer_status", "bbox_rectified": [1, 1, 9, 9]}}' ELSE '' END, ']}}') END AS value
FROM (SELECT min(page_id) AS page_id, min_by(image_id, page_id) AS image_id, min_by(mtime, page_id) AS mtime FROM fx_paths GROUP BY regexp_replace(image_id, '[.][^./]+$', '')) AS p""",
    "fx_cohort": """
SELECT page_id % 2 AS generation, lpad(CAST(page_id AS VARCHAR(20)), 12, '0') AS place, concat('old/', CAST(page_id AS VARCHAR(20)), '.jpg') AS crop, concat('/photos/', image_id) AS source,
  CASE WHEN page_id % 9 = 2 THEN concat('old/', CAST(page_id AS VARCHAR(20)), '.json') WHEN page_id % 10 = 3 THEN upper(concat(regexp_replace(image_id, '[.][^./]+$', ''), '.json')) ELSE concat(regexp_replace(image_id, '[.][^./]+$', ''), '.json') END AS result_json,
  'g' AS group_id
FROM (SELECT min(page_id) AS page_id, min_by(image_id, page_id) AS image_id, min_by(mtime, page_id) AS mtime FROM fx_paths GROUP BY regexp_replace(image_id, '[.][^./]+$', '')) AS p WHERE page_id % 3 = 1 AND page_id < 1000000000""",
    "fx_crops": """
SELECT concat(regexp_replace(image_id, '[.][^./]+$', ''), '.jpg') AS crop, page_id % 6 AS length, mtime + page_id % 5 - 2 AS mtime FROM (SELECT min(page_id) AS page_id, min_by(image_id, page_id) AS image_id, min_by(mtime, page_id) AS mtime FROM fx_paths GROUP BY regexp_replace(image_id, '[.][^./]+$', '')) AS p WHERE page_id % 4 < 3""",
    "fx_quads": """
SELECT CAST(floor(p_partkey / 4) AS BIGINT) AS image_id, p_partkey AS pos, 800 AS w, 1400 AS h,
  CAST(CASE WHEN p_partkey % 11 = 0 THEN 1.0 WHEN p_partkey % 9 = 0 THEN 50.0 ELSE 60.0 + p_partkey % 120 END AS DOUBLE) AS ax, CAST(CASE WHEN p_partkey % 11 = 0 THEN 2.0 WHEN p_partkey % 9 = 0 THEN 400.0 ELSE 90.0 + p_partkey * 3 % 120 END AS DOUBLE) AS ay,
  CAST(CASE WHEN p_partkey % 11 = 0 THEN 798.0 ELSE 740.0 - p_partkey * 7 % 120 END AS DOUBLE) AS bx, CAST(CASE WHEN p_partkey % 11 = 0 THEN 3.0 WHEN p_partkey % 9 = 0 THEN 410.0 ELSE 80.0 + p_partkey * 5 % 120 END AS DOUBLE) AS by_,
  CAST(CASE WHEN p_partkey % 11 = 0 THEN 797.0 ELSE 750.0 - p_partkey * 11 % 120 END AS DOUBLE) AS cx, CAST(CASE WHEN p_partkey % 11 = 0 THEN 1396.0 WHEN p_partkey % 9 = 0 THEN 800.0 ELSE 1310.0 - p_partkey * 2 % 120 END AS DOUBLE) AS cy,
  CAST(CASE WHEN p_partkey % 11 = 0 THEN 2.0 ELSE 55.0 + p_partkey * 13 % 120 END AS DOUBLE) AS dx, CAST(CASE WHEN p_partkey % 11 = 0 THEN 1397.0 WHEN p_partkey % 9 = 0 THEN 790.0 ELSE 1300.0 - p_partkey * 17 % 120 END AS DOUBLE) AS dy
FROM part""",
    "fx_probs": """
SELECT vec_id AS image_id, 20 * CAST(embedding[{first}] AS DOUBLE) AS l0, CASE WHEN vec_id % 50 = 0 THEN 20 * CAST(embedding[{first}] AS DOUBLE) ELSE 20 * CAST(embedding[{second}] AS DOUBLE) END AS l1, 20 * CAST(embedding[{third}] AS DOUBLE) AS l2
FROM embeddings""",
    "fx_geometry": """
SELECT p_partkey AS pos, CASE WHEN p_partkey % 13 = 0 THEN 0.0 ELSE 1.0 + p_partkey % 7 END AS a, 2.0 + p_partkey % 3 AS b, 1.0 * (p_partkey % 50) AS tx, 1.0 * (p_partkey % 40) AS ty,
  1.0 / (1.0 + p_partkey % 7) AS ia, 1.0 / (2.0 + p_partkey % 3) AS ib, -1.0 * (p_partkey % 50) / (1.0 + p_partkey % 7) + CASE WHEN p_partkey % 17 = 0 THEN 0.5 ELSE 0.0 END AS itx,
  -1.0 * (p_partkey % 40) / (2.0 + p_partkey % 3) AS ity, CASE WHEN p_partkey % 5 = 0 THEN 45 ELSE p_partkey % 4 * 90 END AS rotation_degrees,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE 1.0 * p_size END AS qx, 800 AS w, 1400 AS h, CASE WHEN p_partkey % 23 = 0 THEN 801 ELSE 800 END AS now_w, CASE WHEN p_partkey % 29 = 0 THEN 1399 ELSE 1400 END AS now_h
FROM part""",
    "fx_correction_docs": """
SELECT page_id, concat('{{"', image_id, '": {{"skip": ', CASE page_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN '"true"' ELSE 'false' END,
  CASE WHEN page_id % 2 = 0 THEN ', "orientation_degrees": null' WHEN page_id % 5 = 1 THEN ', "orientation_degrees": -90' ELSE '' END,
  CASE page_id % 8 WHEN 0 THEN '' WHEN 1 THEN ', "prefer_portrait": null' WHEN 2 THEN ', "prefer_portrait": 0' WHEN 3 THEN ', "prefer_portrait": "false"' WHEN 4 THEN ', "prefer_portrait": []' WHEN 5 THEN ', "prefer_portrait": ""' WHEN 6 THEN ', "prefer_portrait": true' ELSE ', "prefer_portrait": 0.5' END,
  CASE page_id % 7 WHEN 0 THEN ', "auto_screen": false' WHEN 1 THEN ', "auto_screen": {{}}' WHEN 2 THEN ', "auto_screen": [0]' ELSE '' END,
  CASE page_id % 4 WHEN 1 THEN concat(', "screen_quad": [[0, ', CAST(page_id % 50 AS VARCHAR(20)), '], [9.5, 0], [9, 9], [1, 8]]') WHEN 2 THEN ', "screen_quad": null' ELSE '' END,
  ', "max_side": ', CAST(page_id % 4 * 100 AS VARCHAR(20)), '}}}}') AS value
FROM fx_paths""",
    "fx_payloads": """
SELECT doc_id, CASE doc_id % 5
  WHEN 0 THEN concat('{{"rec_texts": ["a', CAST(doc_id AS VARCHAR(20)), '", "b", "c"], "rec_scores": [0.5, 0.25]}}')
  WHEN 1 THEN concat('{{"texts": ["t', CAST(doc_id AS VARCHAR(20)), '"]}}')
  WHEN 2 THEN concat('[[[[0, 0], [1, 1]], ["x', CAST(doc_id AS VARCHAR(20)), '", 0.75]], [[[2, 2]], ["y", "bad"]]]')
  WHEN 3 THEN '{{"other": 1}}' ELSE '[]' END AS payload
FROM documents""",
    "fx_manifest": """
SELECT doc_id AS ord, concat('out/', source, '/', CAST(doc_id AS VARCHAR(20)), '.JSON') AS result_json, source AS cohort, CASE WHEN doc_id % 5 = 0 THEN 'unclear' ELSE NULL END AS label FROM documents""",
    "fx_reviewed": """
SELECT lower(concat('out/', d.source, '/', CAST(d.doc_id AS VARCHAR(20)), '.JSON')) AS result_json,
  CASE WHEN d.doc_id % 17 = 0 THEN NULL WHEN l.quality = 1 AND l.toxic = 0 THEN 'check_offset' WHEN l.quality = 1 THEN 'check_aligned' WHEN l.toxic = 0 THEN 'check_absent' ELSE 'unclear' END AS label
FROM labels AS l JOIN documents AS d ON d.doc_id = l.doc_id
UNION ALL SELECT 'out/none/-1.json', 'unclear' UNION ALL SELECT 'out/none/-2.json', NULL""",
    "fx_label_lines": """
SELECT doc_id AS line_no, CASE doc_id % 9
  WHEN 0 THEN '{{"crop": '
  WHEN 1 THEN concat('{{"crop":"c', CAST(doc_id AS VARCHAR(20)), '.png","source":"s.jpg","result_json":"R', CAST(doc_id AS VARCHAR(20)), '.json","label":null}}')
  WHEN 2 THEN concat('{{"crop":"c', CAST(doc_id AS VARCHAR(20)), '.png","source":"s.jpg","result_json":"r', CAST(doc_id AS VARCHAR(20)), '.json","group_id":"g","label":"maybe"}}')
  WHEN 3 THEN concat('{{"crop":"c', CAST(doc_id AS VARCHAR(20)), '.png","source":"s.jpg","result_json":"r', CAST(doc_id AS VARCHAR(20)), '.json","group_id":" ","label":"unclear"}}')
  WHEN 4 THEN concat('{{"crop":"c', CAST(doc_id AS VARCHAR(20)), '.png","source":"s.jpg","result_json":"R', CAST(doc_id - 4 + 9 AS VARCHAR(20)), '.json","group_id":"g","label":"unclear"}}')
  WHEN 5 THEN concat('{{"crop":"c', CAST(doc_id AS VARCHAR(20)), '.png","source":"s.jpg","result_json":"r', CAST(doc_id - 5 + 9 AS VARCHAR(20)), '.json","group_id":"g","label":null}}')
  ELSE concat('{{"crop":"c', CAST(doc_id AS VARCHAR(20)), '.png","source":"s.jpg","result_json":"r', CAST(doc_id AS VARCHAR(20)), '.json","group_id":"g","label":"check_absent"}}') END AS line
FROM documents""",
}

#: Views that others read, before them.
NEEDS = {"fx_results": ["fx_paths"], "fx_cohort": ["fx_paths"], "fx_crops": ["fx_paths"], "fx_photos": ["fx_paths"], "fx_turns": ["fx_paths"], "fx_corrections": ["fx_paths"], "fx_bundles": ["fx_paths"], "fx_stage": ["fx_paths"], "fx_correction_docs": ["fx_paths"]}
TABLES = ("events", "conversations", "orders", "customer", "pages", "part", "embeddings", "documents", "labels")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame over the tables in sf_dir."""
    text = FIXTURES[name].format(first=0, second=1, third=2)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"FROM {t}" in text or f"JOIN {t} " in text}
    frames |= {n: fixture(spark, sf_dir, n) for n in NEEDS.get(name, [])}
    text = text.replace("{", "{{").replace("}", "}}")  # braces of JSON texts stay as they are
    for n in frames:
        text = text.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return spark.sql(text, **frames)


def with_fixtures(query: str, *names: str) -> str:
    """A DuckDB query with these views before it."""
    wanted: list[str] = []
    for name in names:
        wanted += [n for n in [*NEEDS.get(name, []), name] if n not in wanted]
    views = ", ".join(f"{n} AS ({FIXTURES[n].format(first=1, second=2, third=3)})" for n in wanted)
    body = query.strip()
    return f"WITH {views}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {views} {body}"
