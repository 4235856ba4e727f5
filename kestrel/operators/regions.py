"""Points inside rotated 3-D boxes and polygons, pooling by box, class hierarchies.

Points and regions of one cloud meet by equi-join on the grid cells that a
region's bounding rectangle covers; a point is in one cell, so no pair comes
twice and a crowded cloud is split over its cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.selection import top_n_per_group
from kestrel.session import cut_lineage

BOX3D = ("cx", "cy", "cz", "x_size", "y_size", "z_size", "rz")


def _by_cell(points: DataFrame, regions: DataFrame, key: str, lo_x, hi_x, lo_y, hi_y, cell: float) -> DataFrame:
    def at(v: Column) -> Column:
        return F.floor(v / cell)

    spread = (regions.withColumn("_gx", F.explode(F.sequence(at(lo_x), at(hi_x)))).withColumn("_gy", F.explode(F.sequence(at(lo_y), at(hi_y)))))
    return points.withColumns({"_gx": at(F.col("x")), "_gy": at(F.col("y"))}).join(spread, [key, "_gx", "_gy"]).drop("_gx", "_gy")


def in_box3d() -> Column:
    """Whether (x, y, z) lies in a box turned by rz whose cz is its bottom; sides are open, top and bottom closed."""
    dx, dy, c, s = F.col("x") - F.col("cx"), F.col("y") - F.col("cy"), F.cos("rz"), F.sin("rz")
    along, across = dx * c + dy * s, dy * c - dx * s
    return ((F.abs(F.col("z") - (F.col("cz") + F.col("z_size") / 2)) <= F.col("z_size") / 2)
            & (F.abs(along) < F.col("x_size") / 2) & (F.abs(across) < F.col("y_size") / 2))


def points_in_boxes(points: DataFrame, boxes: DataFrame, key: str, point_id: str, box_id: str, cell: float = 16.0) -> DataFrame:
    """J14, all boxes: (key, point, box) for every point inside a box."""
    reach = F.sqrt(F.col("x_size") * F.col("x_size") + F.col("y_size") * F.col("y_size")) / 2
    met = _by_cell(points.select(key, point_id, "x", "y", "z"), boxes.select(key, box_id, *BOX3D), key,
                   F.col("cx") - reach, F.col("cx") + reach, F.col("cy") - reach, F.col("cy") + reach, cell)
    return met.where(in_box3d()).select(key, point_id, box_id)


def first_box(points: DataFrame, boxes: DataFrame, key: str, point_id: str, box_id: str, cell: float = 16.0) -> DataFrame:
    """J14, one box: every point with the smallest box that holds it, -1 if none."""
    found = points_in_boxes(points, boxes, key, point_id, box_id, cell).groupBy(key, point_id).agg(F.min(box_id).alias(box_id))
    return points.select(key, point_id).join(found, [key, point_id], "left").withColumn(box_id, F.coalesce(F.col(box_id), F.lit(-1)))


def pool_by_box(points: DataFrame, boxes: DataFrame, key: str, point_id: str, box_id: str, n: int = 512, cell: float = 16.0) -> DataFrame:
    """The first ``n`` points (by id) inside each box with their ``rank``; an empty box gives one row with ``empty`` and null point."""
    held = top_n_per_group(points_in_boxes(points, boxes, key, point_id, box_id, cell), [key, box_id], [F.col(point_id)], n)
    return boxes.select(key, box_id).join(held, [key, box_id], "left").withColumn("empty", F.col(point_id).isNull())


def in_polygon(xs: list[Column], ys: list[Column]) -> Column:
    """Even-odd rule: a ray to the right of (x, y) crosses an odd number of sides."""
    x, y, odd = F.col("x"), F.col("y"), F.lit(False)
    for i in range(len(xs)):
        (ax, ay), (bx, by) = (xs[i - 1], ys[i - 1]), (xs[i], ys[i])
        crosses = ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / F.nullif(by - ay, F.lit(0.0)) + ax)
        odd = odd != F.coalesce(crosses, F.lit(False))
    return odd


def points_in_polygons(points: DataFrame, polygons: DataFrame, key: str, point_id: str, polygon_id: str, cell: float = 16.0) -> DataFrame:
    """(key, point, polygon) for every point inside a quadrilateral ``x1, y1 .. x4, y4``; which side a boundary point falls is open."""
    xs, ys = [[F.col(f"{a}{i}") for i in range(1, 5)] for a in "xy"]
    met = _by_cell(points.select(key, point_id, "x", "y"), polygons, key, F.least(*xs), F.greatest(*xs), F.least(*ys), F.greatest(*ys), cell)
    return met.where(in_polygon(xs, ys)).select(key, point_id, polygon_id)


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, ancestor) of a class hierarchy, the class itself included; path doubling, so few rounds, and loops end."""
    up = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).where("child IS NOT NULL AND ancestor IS NOT NULL")
    both = up.select("child").union(up.select("ancestor")).distinct().select("child", F.col("child").alias("ancestor"))
    known = cut_lineage(both.union(up).distinct())
    size = known.count()
    while True:
        on = known.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("_far"))
        known = cut_lineage(known.join(on, "ancestor").select("child", F.col("_far").alias("ancestor")).distinct())
        if (now := known.count()) == size:
            return known
        size = now


def expand_classes(rows: DataFrame, edges: DataFrame, label: str, allowed: DataFrame | None = None) -> DataFrame:
    """A copy of every row for its class and each ancestor; with ``allowed`` (a table of that column) only copies of those classes stay."""
    up = closure(edges).select(F.col("child").alias(label), F.col("ancestor").alias("_up"))
    out = rows.join(up, label, "left").withColumn(label, F.coalesce("_up", label)).drop("_up")
    return out if allowed is None else out.join(allowed.select(label).distinct(), label, "left_semi")
