"""Bounding-box queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import boxes as bx
from millrace.operators import detection as det
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.session import new_path
from millrace.sources import writers
from millrace.tables import BOXES_SQL, boxes, table

# Overlap of two SQL box expressions with fields x1, y1, x2, y2.


def _iou(a, b):
    w = f"(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    h = f"(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = "(({0}.x2 - {0}.x1) * ({0}.y2 - {0}.y1))"
    union = f"({area.format(a)} + {area.format(b)} - {w} * {h})"
    return f"(CASE WHEN {w} > 0 AND {h} > 0 THEN {w} * {h} / {union} ELSE 0.0 END)"


@query("iou_join", "JN-06 BOX-01", f"""WITH {BOXES_SQL}
SELECT a.image_id, a.box_id AS l_box_id, b.box_id AS r_box_id, round({_iou('a', 'b')}, 6) AS iou
FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND NOT a.is_target AND b.is_target
WHERE {_iou('a', 'b')} >= 0.2""")
def iou_join(spark, sf_dir):
    rows = boxes(spark, sf_dir)
    pairs = det.iou_join(rows.filter("NOT is_target"), rows.filter("is_target"), ["image_id"], 0.2)
    return _round(pairs.select("image_id", "l_box_id", "r_box_id", "iou"), 6)


@query("box_convert", "BOX-02 BOX-05 BOX-06", f"""WITH {BOXES_SQL}
SELECT box_id, x2 - x1 AS w, y2 - y1 AS h, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy,
  (x2 - x1) * (y2 - y1) AS area, round((x2 - x1) / (y2 - y1 + 1e-6), 6) AS aspect,
  round((x1 + x2) / 2 / 800, 6) AS ncx, round((y1 + y2) / 2 / 600, 6) AS ncy,
  round((x2 - x1) / 800, 6) AS nw, round((y2 - y1) / 600, 6) AS nh, true AS round_trip FROM boxes""")
def box_convert(spark, sf_dir):
    b = bx.corners()
    xywh, center = bx.convert(b, "xyxy", "xywh"), bx.convert(b, "xyxy", "cxcywh")
    wide, high = F.lit(800.0), F.lit(600.0)
    norm = bx.normalise(center, wide, high)
    back = bx.convert(bx.denormalise(norm, wide, high), "cxcywh", "xyxy")
    same = F.abs(back[0] - b[0]) + F.abs(back[1] - b[1]) + F.abs(back[2] - b[2]) + F.abs(back[3] - b[3]) < 1e-6
    return _round(boxes(spark, sf_dir).select(
        "box_id", xywh[2].alias("w"), xywh[3].alias("h"), center[0].alias("cx"), center[1].alias("cy"),
        bx.area(b).alias("area"), bx.aspect_ratio(b).alias("aspect"),
        *[c.alias(n) for c, n in zip(norm, ("ncx", "ncy", "nw", "nh"))], same.alias("round_trip"),
    ), 6)


@query("box_resize_clip", "BOX-03 BOX-04", f"""WITH {BOXES_SQL}
SELECT box_id, x1 * 2 AS rx1, y2 * 0.5 AS ry2, greatest(0.0, least(x2, 400.0)) AS clip_x2, greatest(0.0, least(y1, 300.0)) AS clip_y1,
  round(x1 * 0.8, 6) AS letter_x1, round(y1 * 0.8 + 80, 6) AS letter_y1,
  round(x2 * ((CASE WHEN class_id % 4 IN (1, 3) THEN 240 ELSE 400 END) / 800) + CASE WHEN class_id % 4 IN (1, 3) THEN 400 ELSE 0 END, 6) AS mosaic_x2
FROM boxes""")
def box_resize_clip(spark, sf_dir):
    b = bx.corners()
    w, h = F.lit(800), F.lit(600)
    resized = bx.resize(b, w, h, F.lit(1600), F.lit(300))
    clipped = bx.clip(b, F.lit(400), F.lit(300))
    letter = bx.letterbox(b, w, h, 640)
    mosaic = bx.mosaic(b, F.col("class_id") % 4, w, h, 400, 300, 640)
    return _round(boxes(spark, sf_dir).select(
        "box_id", resized[0].alias("rx1"), resized[3].alias("ry2"), clipped[2].alias("clip_x2"),
        clipped[1].alias("clip_y1"), letter[0].alias("letter_x1"), letter[1].alias("letter_y1"),
        mosaic[2].alias("mosaic_x2"),
    ), 6)


@query("confidence_filter", "PRJ-19 DET-07", f"""WITH {BOXES_SQL}
SELECT image_id, class_id AS category_id, x1, y1, x2 - x1 AS w, y2 - y1 AS h, score FROM boxes WHERE score > 0.5""")
def confidence_filter(spark, sf_dir):
    out = det.results_table(boxes(spark, sf_dir).filter("score > 0.5"))
    parts = [F.col("bbox")[i].alias(n) for i, n in enumerate(("x1", "y1", "w", "h"))]
    return out.select("image_id", "category_id", *parts, "score")


@query("class_stats", "AGG-17 AGG-20", f"""WITH {BOXES_SQL}
SELECT class_id, count(*) AS n, round(avg(score), 6) AS avg_score, round(stddev_pop(score), 6) AS std_score,
  min(score) AS min_score, max(score) AS max_score, round(avg((x2 - x1) * (y2 - y1)), 4) AS mean_area,
  round(stddev_pop((x2 - x1) * (y2 - y1)), 4) AS std_area, min((x2 - x1) * (y2 - y1)) AS min_area,
  max((x2 - x1) * (y2 - y1)) AS max_area, round(avg(x2 - x1), 6) AS mean_width, round(avg(y2 - y1), 6) AS mean_height,
  round(avg((x2 - x1) / (y2 - y1 + 1e-6)), 6) AS mean_aspect, median(score) AS median_score
FROM boxes GROUP BY 1""")
def class_stats(spark, sf_dir):
    from millrace.operators.quantiles import exact_quantiles

    rows = boxes(spark, sf_dir)
    stats = det.box_statistics(rows)
    median = exact_quantiles(rows, ["score"], [0.5], ["class_id"]).select("class_id", F.col("q0").alias("median_score"))
    out = stats.join(median, "class_id", "left")
    areas = {c: F.round(c, 4) for c in ("mean_area", "std_area")}
    return _round(out.withColumns(areas), 6)


@query("resolution_counts", "AGG-21", f"""WITH {BOXES_SQL}
SELECT (x2 - x1)::BIGINT AS width, (y2 - y1)::BIGINT AS height, count(*) AS n FROM boxes GROUP BY 1, 2""")
def resolution_counts(spark, sf_dir):
    size = [(F.col("x2") - F.col("x1")).cast("long").alias("width"), (F.col("y2") - F.col("y1")).cast("long").alias("height")]
    return boxes(spark, sf_dir).groupBy(*size).agg(F.count("*").alias("n"))


# Some images lose their boxes, so that images without any are there.
_BOXLESS = "image_id % 10 > 0"


@query("images_with_boxes", "JN-04", f"""WITH {BOXES_SQL}
SELECT o_orderkey AS image_id, box_id, class_id, score FROM orders LEFT JOIN boxes ON o_orderkey = image_id AND {_BOXLESS}""")
def images_with_boxes(spark, sf_dir):
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    found = boxes(spark, sf_dir).filter(_BOXLESS).select("image_id", "box_id", "class_id", "score")
    return det.images_with_boxes(images, found)


@query("image_box_json", "JN-04 SNK-17", f"""WITH {BOXES_SQL},
n AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY box_id) - 1 AS rn FROM boxes WHERE {_BOXLESS}),
p AS (SELECT image_id, rn // 5 AS part, count(*) AS n_boxes, string_agg(box_id, ',' ORDER BY box_id) AS ids FROM n GROUP BY 1, 2)
SELECT o_orderkey AS image_id, coalesce(part, 0) AS part, coalesce(n_boxes, 0) AS n_boxes, ids,
  coalesce(max(part) OVER (PARTITION BY o_orderkey), 0) + 1 AS parts FROM orders LEFT JOIN p ON o_orderkey = image_id""")
def image_box_json(spark, sf_dir):
    """Nested records per image, written as JSON and read again."""
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    found = boxes(spark, sf_dir).filter(_BOXLESS).select("image_id", "box_id", "class_id", "score")
    path = new_path(spark, "images")
    nested = det.image_box_lists(images, found, part_size=5)
    writers.write_json(nested, path)
    out = spark.read.schema(nested.schema).json(path)
    ids = F.array_join(F.transform("boxes", lambda b: b["box_id"]), ",")
    return out.select("image_id", "part", F.size("boxes").cast("long").alias("n_boxes"), F.nullif(ids, F.lit("")).alias("ids"), "parts")


# Greedy choices in SQL: one recursion step per box of an image, in order.
_BOX = "{{'id': {0}.box_id, 'x1': {0}.x1, 'y1': {0}.y1, 'x2': {0}.x2, 'y2': {0}.y2}}"


def _greedy_sql(source, order, op, threshold):
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY {order}) AS rn FROM {source}),
walk AS (
  SELECT n.image_id, 1::BIGINT AS rn, n.box_id, n.box_id AS leader_id, [{_BOX.format('n')}] AS leaders
  FROM numbered n WHERE rn = 1
  UNION ALL
  SELECT s.image_id, s.rn, s.box_id, coalesce(s.hit.id, s.box_id),
    CASE WHEN s.hit IS NULL THEN list_append(s.leaders, s.b) ELSE s.leaders END
  FROM (SELECT w.leaders, n.image_id, n.rn, n.box_id, {_BOX.format('n')} AS b,
          list_filter(w.leaders, lambda k: {_iou('k', 'n')} {op} {threshold})[1] AS hit
        FROM walk w JOIN numbered n ON n.image_id = w.image_id AND n.rn = w.rn + 1) s)"""


@query("nms", "DET-01", f"""WITH RECURSIVE {BOXES_SQL}, {_greedy_sql('boxes', 'score DESC, box_id', '>=', 0.3)}
SELECT image_id, box_id FROM walk WHERE box_id = leader_id""")
def nms(spark, sf_dir):
    kept = det.non_max_suppression(boxes(spark, sf_dir), ["image_id"], iou_threshold=0.3)
    return kept.select("image_id", "box_id")


_MODELS_SQL = "models AS (SELECT *, l.class_id % 3 AS model_id FROM boxes l)"


def _models(spark, sf_dir):
    return boxes(spark, sf_dir).withColumn("model_id", F.col("class_id") % 3)


@query("box_fusion", "DET-05", f"""WITH RECURSIVE {BOXES_SQL}, {_MODELS_SQL},
{_greedy_sql('models', 'model_id, box_id', '>', 0.2)},
g AS (SELECT m.*, w.leader_id FROM numbered m JOIN walk w USING (image_id, rn)),
v AS (SELECT image_id, leader_id, class_id, sum(score) AS votes, min(rn) AS first FROM g GROUP BY ALL),
best AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY image_id, leader_id ORDER BY round(votes, 9) DESC, first) = 1),
f AS (SELECT image_id, leader_id AS box_id, count(*) AS members, sum(score) / count(*) AS score,
  CASE WHEN count(*) = 1 THEN max(x1) ELSE sum(x1 * score) / nullif(sum(score), 0) END AS x1,
  CASE WHEN count(*) = 1 THEN max(y1) ELSE sum(y1 * score) / nullif(sum(score), 0) END AS y1,
  CASE WHEN count(*) = 1 THEN max(x2) ELSE sum(x2 * score) / nullif(sum(score), 0) END AS x2,
  CASE WHEN count(*) = 1 THEN max(y2) ELSE sum(y2 * score) / nullif(sum(score), 0) END AS y2
  FROM g GROUP BY 1, 2)
SELECT f.image_id, f.box_id, best.class_id, round(f.score, 6) AS score, members, round(x1, 6) AS x1, round(y1, 6) AS y1,
  round(x2, 6) AS x2, round(y2, 6) AS y2
FROM f JOIN best ON f.image_id = best.image_id AND f.box_id = best.leader_id WHERE f.score >= 0.25""")
def box_fusion(spark, sf_dir):
    return _round(det.weighted_fusion(_models(spark, sf_dir), iou_threshold=0.2), 6)


@query("max_confidence_fusion", "DET-06", f"""WITH RECURSIVE {BOXES_SQL}, {_MODELS_SQL},
{_greedy_sql('models', 'model_id, box_id', '>', 0.2)},
g AS (SELECT m.*, w.leader_id FROM numbered m JOIN walk w USING (image_id, rn))
SELECT image_id, box_id, class_id, score FROM g
QUALIFY row_number() OVER (PARTITION BY image_id, leader_id ORDER BY score DESC, model_id, box_id) = 1 AND score >= 0.25""")
def max_confidence_fusion(spark, sf_dir):
    out = det.max_confidence_fusion(_models(spark, sf_dir), iou_threshold=0.2)
    return out.select("image_id", "box_id", "class_id", "score")


# Coarser classes, so that predictions and targets of one class do meet.
_COARSE_SQL = """
coarse AS (SELECT * REPLACE (class_id % 2 AS class_id) FROM boxes),
preds AS (SELECT * FROM coarse WHERE NOT is_target), tgts AS (SELECT * FROM coarse WHERE is_target)"""


def _coarse(spark, sf_dir):
    rows = boxes(spark, sf_dir).withColumn("class_id", F.col("class_id") % 2)
    return rows.filter("NOT is_target"), rows.filter("is_target")


_MATCH_SQL = f"""
p AS (SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY score DESC, box_id) AS rn FROM preds),
t AS (SELECT image_id, class_id, list({{'id': box_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY x1, y1, x2, y2, box_id) AS ts
      FROM tgts GROUP BY 1, 2),
steps AS (
  SELECT p.image_id, p.class_id, 0::BIGINT AS rn, NULL::VARCHAR AS box_id, NULL::VARCHAR AS hit, []::VARCHAR[] AS used
  FROM p WHERE rn = 1
  UNION ALL
  SELECT q.image_id, q.class_id, q.rn, q.box_id, q.hit.id, CASE WHEN q.hit IS NULL THEN q.used ELSE list_append(q.used, q.hit.id) END
  FROM (SELECT s.used, n.image_id, n.class_id, n.rn, n.box_id,
          list_reduce(list_prepend(NULL, list_filter(t.ts, lambda k: NOT list_contains(s.used, k.id) AND {_iou('k', 'n')} >= 0.2)),
            lambda a, b: CASE WHEN a IS NULL OR {_iou('b', 'n')} > {_iou('a', 'n')} THEN b ELSE a END) AS hit
        FROM steps s JOIN p n ON n.image_id = s.image_id AND n.class_id = s.class_id AND n.rn = s.rn + 1
        LEFT JOIN t ON t.image_id = n.image_id AND t.class_id = n.class_id) q),
matched AS (SELECT p.*, s.hit IS NOT NULL AS is_tp FROM p JOIN steps s USING (image_id, class_id, rn))"""
def _matched(spark, sf_dir):
    preds, targets = _coarse(spark, sf_dir)
    return det.match_boxes(preds, targets, order_by=[-F.col("score")], iou_threshold=0.2), targets


_RATES = """round(tp / (tp + fp + 1e-10), 6) AS precision, round(tp / (tp + fn + 1e-10), 6) AS recall,
  round(2 * (tp / (tp + fp + 1e-10)) * (tp / (tp + fn + 1e-10)) / (tp / (tp + fp + 1e-10) + tp / (tp + fn + 1e-10) + 1e-10), 6) AS f1"""


@query("match_counts", "DET-02", f"""WITH RECURSIVE {BOXES_SQL}, {_COARSE_SQL}, {_MATCH_SQL},
c AS (SELECT class_id, CAST(sum(is_tp::INT) AS BIGINT) AS tp, count(*) - CAST(sum(is_tp::INT) AS BIGINT) AS fp,
  (SELECT count(*) FROM tgts WHERE tgts.class_id = matched.class_id) - CAST(sum(is_tp::INT) AS BIGINT) AS fn
  FROM matched GROUP BY 1)
SELECT *, {_RATES} FROM c""")
def match_counts(spark, sf_dir):
    matched, targets = _matched(spark, sf_dir)
    return _round(det.match_counts(matched, targets), 6)


@query("average_precision", "DET-03 WIN-07 WIN-08", f"""WITH RECURSIVE {BOXES_SQL}, {_COARSE_SQL}, {_MATCH_SQL},
c AS (SELECT class_id, score, box_id, is_tp::INT AS tp,
  sum(is_tp::INT) OVER w AS hits, count(*) OVER w AS seen FROM matched
  WINDOW w AS (PARTITION BY class_id ORDER BY score DESC, box_id ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, max(hits / (seen + 1e-10)) OVER (PARTITION BY class_id ORDER BY score DESC, box_id
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS best FROM c),
n AS (SELECT class_id, count(*) AS n_targets FROM tgts GROUP BY 1)
SELECT class_id, n_targets, round(sum(best) FILTER (WHERE tp = 1) / n_targets, 6) AS ap FROM e JOIN n USING (class_id) GROUP BY 1, 2""")
def average_precision(spark, sf_dir):
    matched, targets = _matched(spark, sf_dir)
    return _round(det.average_precision(matched, targets), 6)


@query("detection_confusion", "DET-04", f"""WITH {BOXES_SQL}, {_COARSE_SQL},
b AS (SELECT p.box_id, p.class_id AS predicted_class, t.class_id AS target_class FROM preds p JOIN tgts t USING (image_id)
  WHERE {_iou('p', 't')} >= 0.2
  QUALIFY row_number() OVER (PARTITION BY p.box_id ORDER BY {_iou('p', 't')} DESC, t.box_id) = 1)
SELECT target_class, predicted_class, count(*) AS n FROM b GROUP BY 1, 2""")
def detection_confusion(spark, sf_dir):
    preds, targets = _coarse(spark, sf_dir)
    return det.detection_confusion(preds, targets, iou_threshold=0.2)


@query("prior_decode", "BOX-07 BOX-08", """
WITH d AS (SELECT vec_id, embedding AS e, (vec_id % 16) // 4 AS r, vec_id % 4 AS c, (vec_id // 16) % 4 AS shape FROM embeddings),
p AS (SELECT *, (c + 0.5) / 4 AS cx, (r + 0.5) / 4 AS cy,
  CASE shape WHEN 0 THEN 0.2 WHEN 1 THEN sqrt(0.2 * 0.9) WHEN 2 THEN 0.2 * sqrt(2) ELSE 0.2 / sqrt(2) END AS pw,
  CASE shape WHEN 0 THEN 0.2 WHEN 1 THEN sqrt(0.2 * 0.9) WHEN 2 THEN 0.2 / sqrt(2) ELSE 0.2 * sqrt(2) END AS ph FROM d),
x AS (SELECT vec_id, cx + e[1]::DOUBLE * 0.1 * pw AS mx, cy + e[2]::DOUBLE * 0.1 * ph AS my, pw * exp(e[3]::DOUBLE * 0.2) AS bw,
  ph * exp(e[4]::DOUBLE * 0.2) AS bh FROM p)
SELECT vec_id, round(greatest(0, least(1, mx - bw / 2)), 6) AS x1, round(greatest(0, least(1, my - bh / 2)), 6) AS y1,
  round(greatest(0, least(1, mx + bw / 2)), 6) AS x2, round(greatest(0, least(1, my + bh / 2)), 6) AS y2 FROM x""")
def prior_decode(spark, sf_dir):
    return _round(_decoded(spark, sf_dir).select("vec_id", "x1", "y1", "x2", "y2"), 6)


def _decoded(spark, sf_dir):
    priors = det.prior_grid(spark, [4, 1], [[2], [2]]).filter("map = 0")
    k = F.col("vec_id")
    rows = table(spark, sf_dir, "embeddings").withColumns(
        {"row": F.floor(k % 16 / 4).cast("int"), "col": (k % 4).cast("int"), "shape": (F.floor(k / 16) % 4).cast("int")}
    )
    joined = rows.join(priors, ["row", "col", "shape"])
    loc = tuple(F.col("embedding")[i].cast("double") for i in range(4))
    prior = tuple(F.col(c) for c in ("cx", "cy", "pw", "ph"))
    decoded = bx.decode_offsets(loc, prior)
    return joined.select("vec_id", "embedding", *[c.alias(n) for c, n in zip(decoded, ("x1", "y1", "x2", "y2"))])


_SCORED_SQL = """
s AS (SELECT vec_id, list_transform(embedding, lambda v: exp((v - list_max(embedding))::DOUBLE)) AS e FROM embeddings),
c AS (SELECT vec_id, unnest(range(len(e))) AS class_id, unnest(e) / list_sum(e) AS score FROM s)"""


@query("score_postprocess", "DET-08", f"""WITH {_SCORED_SQL}
SELECT vec_id, class_id::INT AS class_id, round(score, 6) AS score FROM c WHERE class_id > 0 AND score > 0.02""")
def score_postprocess(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return _round(det.class_scores(rows, "embedding", 0.02).select("vec_id", "class_id", "score"), 6)


@query("score_sigmoid_nms", "DET-08")
def score_sigmoid_nms(spark, sf_dir):
    rows = _decoded(spark, sf_dir).withColumn("image_id", F.col("vec_id") % 50)
    images = rows.select("image_id").distinct()
    out = det.postprocess(rows, images, "embedding", 0.55, "sigmoid", by_class=False, box_id="vec_id")
    return _round(out.select("image_id", "vec_id", "class_id", "score", "x1", "y1", "x2", "y2"), 6)
