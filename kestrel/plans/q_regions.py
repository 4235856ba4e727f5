"""Queries for regions, hierarchies and samplers that go round."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import regions as R
from kestrel.operators import resampling as S
from kestrel.plans.catalog import register
from kestrel.plans.oracle import with_views
from kestrel.sources import tables as T

_BOXES = """,
b AS (SELECT s_suppkey AS cloud_id, k AS box_id, 10.0::DOUBLE + 12 * k + s_suppkey % 5 AS cx, 5.0::DOUBLE AS cy, 1.0::DOUBLE + s_suppkey % 3 AS cz,
  14.0::DOUBLE AS xs, 6.0::DOUBLE AS ys, 4.0::DOUBLE AS zs, 0.3::DOUBLE * k + 0.1::DOUBLE * (s_suppkey % 4) AS rz
  FROM supplier, (SELECT unnest([0, 1, 2]) AS k)),
hit AS (SELECT p.cloud_id, pt_id, box_id FROM points p JOIN b ON b.cloud_id = p.cloud_id
  AND abs(z - (cz + zs / 2)) <= zs / 2 AND abs((x - cx) * cos(rz) + (y - cy) * sin(rz)) < xs / 2 AND abs((y - cy) * cos(rz) - (x - cx) * sin(rz)) < ys / 2)
"""


def _clouds(spark, sf_dir):
    """Three numbered regions for each supplier's cloud."""
    s = T.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cloud_id"))
    return s.withColumn("box_id", F.explode(F.array(*[F.lit(k) for k in range(3)])))


def _boxes(spark, sf_dir):
    s, k = F.col("cloud_id"), F.col("box_id")
    return _clouds(spark, sf_dir).withColumns({
        "cx": F.lit(10.0) + k * 12 + s % 5, "cy": F.lit(5.0), "cz": F.lit(1.0) + s % 3, "x_size": F.lit(14.0), "y_size": F.lit(6.0), "z_size": F.lit(4.0),
        "rz": F.lit(0.3) * k + F.lit(0.1) * (s % 4)})


@register("points_in_boxes", with_views("points") + _BOXES + """
SELECT p.cloud_id, p.pt_id, coalesce(min(box_id), -1) AS box_id FROM points p LEFT JOIN hit h ON h.cloud_id = p.cloud_id AND h.pt_id = p.pt_id
GROUP BY p.cloud_id, p.pt_id""")
def points_in_boxes(spark, sf_dir):
    """Every point with its first rotated box."""
    return R.first_box(T.points(spark, sf_dir), _boxes(spark, sf_dir), "cloud_id", "pt_id", "box_id")


@register("points_pooled_by_box", with_views("points") + _BOXES + """,
r AS (SELECT *, row_number() OVER (PARTITION BY cloud_id, box_id ORDER BY pt_id) AS rank FROM hit)
SELECT b.cloud_id, b.box_id, r.pt_id, r.rank, r.pt_id IS NULL AS empty FROM b LEFT JOIN r ON r.cloud_id = b.cloud_id AND r.box_id = b.box_id AND rank <= 5""")
def points_pooled_by_box(spark, sf_dir):
    """The first five points of every box, empty boxes too."""
    return R.pool_by_box(T.points(spark, sf_dir), _boxes(spark, sf_dir), "cloud_id", "pt_id", "box_id", 5)


@register("points_in_polygons", with_views("points") + """,
q AS (SELECT s_suppkey AS cloud_id, k AS box_id, unnest([0, 1, 2, 3]) AS side, [5 + 12.5::DOUBLE * k, 17 + 12.5::DOUBLE * k + s_suppkey % 3,
  15 + 12.5::DOUBLE * k, 6 + 12.5::DOUBLE * k] AS xs, [1.25::DOUBLE, 2.25, 9.25, 8.25] AS ys FROM supplier, (SELECT unnest([0, 1, 2]) AS k)),
e AS (SELECT cloud_id, box_id, xs[side+1] AS ax, ys[side+1] AS ay, xs[(side+1)%4+1] AS fx, ys[(side+1)%4+1] AS fy FROM q)
SELECT p.cloud_id, p.pt_id, e.box_id FROM points p JOIN e ON e.cloud_id = p.cloud_id AND (ay > y) <> (fy > y) AND x < (fx - ax) * (y - ay) / (fy - ay) + ax
GROUP BY p.cloud_id, p.pt_id, e.box_id HAVING count(*) % 2 = 1""")
def points_in_polygons(spark, sf_dir):
    """Points inside quadrilaterals."""
    at = F.col("box_id") * F.lit(12.5)
    quads = _clouds(spark, sf_dir).withColumns({
        "x1": at + 5, "x2": at + 17 + F.col("cloud_id") % 3, "x3": at + 15, "x4": at + 6,
        "y1": F.lit(1.25), "y2": F.lit(2.25), "y3": F.lit(9.25), "y4": F.lit(8.25)})
    return R.points_in_polygons(T.points(spark, sf_dir), quads, "cloud_id", "pt_id", "box_id")


@register("class_hierarchy", """WITH up AS (
  SELECT s_suppkey, 'N' || s_nationkey AS a, 'R' || n_regionkey AS b FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT s_suppkey, unnest([a, b, 'all']) AS class FROM up WHERE b <> 'R1' UNION ALL SELECT s_suppkey, unnest([a, 'all']) FROM up WHERE b = 'R1'""")
def class_hierarchy(spark, sf_dir):
    """Suppliers under their nation, its region and the root, without one disallowed region."""
    nation, region = F.concat(F.lit("N"), F.col("n_nationkey")), F.concat(F.lit("R"), F.col("n_regionkey"))
    n = T.table(spark, sf_dir, "nation")
    edges = n.select(nation.alias("child"), region.alias("parent")).union(n.select(region, F.lit("all"))).distinct()
    allowed = edges.select(F.col("child").alias("class")).union(edges.select("parent")).where("class <> 'R1'")
    rows = T.table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("N"), F.col("s_nationkey")).alias("class"))
    return R.expand_classes(rows, edges, "class", allowed).select("s_suppkey", "class")


@register("class_aware_draws", """WITH c AS (SELECT label, count(*) AS size FROM embeddings GROUP BY label),
k AS (SELECT *, row_number() OVER (ORDER BY md5('42-' || label), label) - 1 AS c, 2 * count(*) OVER () AS lap, sum(size) OVER () AS n FROM c),
w AS (SELECT *, (n // lap) * 2 + least(greatest(n % lap - 2 * c, 0), 2) AS take FROM k),
r AS (SELECT w.*, vec_id, cycle, cycle * size + row_number() OVER (PARTITION BY w.label, cycle ORDER BY md5('42-' || cycle || '-' || vec_id), vec_id) - 1 AS draw
  FROM (SELECT *, unnest(range(0, CAST(ceil(take / size) AS BIGINT))) AS cycle FROM w WHERE take > 0) w JOIN embeddings e ON e.label = w.label)
SELECT CAST((draw // 2) * lap + 2 * c + draw % 2 AS BIGINT) AS position, label, vec_id FROM r WHERE draw < take""")
def class_aware_draws(spark, sf_dir):
    """K3: as many draws as samples, two of a class at a time."""
    return S.class_aware(T.table(spark, sf_dir, "embeddings"), "label", "vec_id", 2)


@register("ratio_batches", """WITH s(event_type, share, start) AS (VALUES ('click', 9, 0), ('view', 5, 9), ('purchase', 2, 14)),
z AS (SELECT event_type, any_value(share) AS share, any_value(start) AS start, count(*) AS size FROM events JOIN s USING (event_type) GROUP BY event_type),
w AS (SELECT *, CAST(max(ceil(size / share)) OVER () AS BIGINT) AS batches FROM z),
r AS (SELECT w.*, event_id, cycle * size + row_number() OVER (PARTITION BY w.event_type, cycle ORDER BY md5('42-' || cycle || '-' || event_id), event_id) - 1 AS draw
  FROM (SELECT *, unnest(range(0, CAST(ceil(share * batches / size) AS BIGINT))) AS cycle FROM w) w JOIN events e ON e.event_type = w.event_type)
SELECT CAST(draw // share AS BIGINT) AS batch, CAST(start + draw % share AS BIGINT) AS slot, event_type, event_id FROM r WHERE draw < share * batches""")
def ratio_batches(spark, sf_dir):
    """K4: batches of 16 events, three kinds in the ratio 3 : 2 : 1, until every event is drawn."""
    return S.ratio_batches(T.table(spark, sf_dir, "events"), "event_type", "event_id", {"click": 3, "view": 2, "purchase": 1}, 16)


@register("resampled_concat", """WITH s(event_type, factor) AS (VALUES ('click', 0.5::DOUBLE), ('view', 1.7::DOUBLE)),
r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS r FROM events),
z AS (SELECT event_type, count(*) AS size, CAST(round_even(count(*) * any_value(factor), 0) AS BIGINT) AS m FROM events JOIN s USING (event_type) GROUP BY event_type),
d AS (SELECT event_type, size, m, unnest(range(0, m)) AS draw FROM z),
p AS (SELECT event_type, draw, CAST(round_even((size - 1e-4) / m * draw
  + CAST('0x' || substr(md5('42-' || event_type || '-' || draw), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE * ((size - 1e-4) / m) - 0.5, 0) AS BIGINT) AS r FROM d)
SELECT event_type, draw, event_id FROM p JOIN r USING (event_type, r)""")
def resampled_concat(spark, sf_dir):
    """K6: half of one source and 1.7 times another, in jittered strides."""
    rows = T.table(spark, sf_dir, "events").select("event_type", "event_id")
    return S.resampled_concat(rows, "event_type", ["event_id"], {"click": 0.5, "view": 1.7}).select("event_type", "draw", "event_id")
