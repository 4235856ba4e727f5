"""Row-local pose operators.

A pose is one row with equally long arrays (``xs``, ``ys`` and visibilities or
scores, in joint order), so none of these adds a shuffle.  Joint maps are plain
Python lists: they are part of a layout's definition and become literals of the
plan.  A null array gives null, a joint beyond the array a null joint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Body, face and hand ranges of the 133-joint layout with a neck at 17 (start, end).
WHOLEBODY_PARTS = {"body": (0, 18), "face": (24, 92), "left_hand": (92, 113), "right_hand": (113, 134)}
#: For each of the 18 joints of the target layout its joint in the 17-joint layout; None is the neck.
NECK_LAYOUT = [0, None, 6, 8, 10, 5, 7, 9, 12, 14, 16, 11, 13, 15, 2, 1, 4, 3]
_SHOULDERS = (5, 6)


def joint(values, i: int) -> Column:
    return F.get(values, F.lit(i))


def take(values, index) -> Column:
    """The joints ``index`` of an array, in that order."""
    return F.array(*[joint(values, i) for i in index])


def flip(xs, ys, visible, mirror: list[int], width: float, height: float, direction: str = "horizontal") -> tuple[Column, Column, Column]:
    """P10: mirrored (xs, ys, visible).  A diagonal flip turns both axes and leaves sides as they are."""
    if direction not in ("horizontal", "vertical", "diagonal"):
        raise ValueError(f"no flip {direction!r}")
    if direction != "diagonal":
        xs, ys, visible = (take(v, mirror) for v in (xs, ys, visible))
    turn = {"x": direction != "vertical", "y": direction != "horizontal"}
    x = F.transform(xs, lambda v: F.lit(width) - v - 1) if turn["x"] else xs
    y = F.transform(ys, lambda v: F.lit(height) - v - 1) if turn["y"] else ys
    return x, y, visible


def flip_about(xs, ys, visible, mirror: list[int], center_x: float | None = 0.5, root: list[int] | None = None) -> tuple[Column, Column, Column]:
    """P10 around a fixed x, or around the mean x of the ``root`` joints where they are given."""
    c = F.lit(center_x) if root is None else sum((joint(xs, i) for i in root), F.lit(0.0)) / len(root)
    return F.transform(take(xs, mirror), lambda v: c * 2 - v), take(ys, mirror), take(visible, mirror)


def convert_layout(xs, ys, visible, size: int, mapping: list[tuple]) -> tuple[Column, Column, Column, Column]:
    """(xs, ys, visible, weight) of a layout of ``size`` joints.

    ``mapping`` holds (source, target); a source that is a pair of joints gives
    their mean position and the product of their visibilities.  A target that
    nothing maps to is 0 with weight 0.
    """
    to = {target: source if isinstance(source, tuple) else (source, source) for source, target in mapping}
    paired = any(isinstance(source, tuple) for source, _ in mapping)  # then a single source counts as a pair with itself
    zero = F.lit(0.0)

    def mean(v):
        return F.array(*[(joint(v, to[t][0]) + joint(v, to[t][1])) * 0.5 if t in to else zero for t in range(size)])

    seen = F.array(*[zero if t not in to else joint(visible, to[t][0]) * (joint(visible, to[t][1]) if paired else F.lit(1.0))
                     for t in range(size)])
    return mean(xs), mean(ys), seen, F.array(*[F.lit(float(t in to)) for t in range(size)])


def with_neck(xs, ys, scores) -> tuple[Column, Column, Column]:
    """The 18-joint layout with a neck between the shoulders, scored as the weaker of them."""
    a, b = _SHOULDERS

    def lay(values, neck):
        return F.array(*[neck if i is None else joint(values, i) for i in NECK_LAYOUT])

    def middle(v):
        return (joint(v, a) + joint(v, b)) / 2

    return lay(xs, middle(xs)), lay(ys, middle(ys)), lay(scores, F.least(joint(scores, a), joint(scores, b)))


def parts(xs, ys, scores, ranges: dict[str, tuple[int, int]] | None = None, min_score: float = 0.3) -> dict[str, Column]:
    """For each part an array of (x, y, score), null where a joint scores below ``min_score``; a part without any joint is null."""
    out = {}
    for name, (start, end) in (ranges or WHOLEBODY_PARTS).items():
        kept = F.array(*[F.when(joint(scores, i) >= min_score, F.struct(joint(xs, i).alias("x"), joint(ys, i).alias("y"), joint(scores, i).alias("score")))
                         for i in range(start, end)])
        out[name] = F.when(F.exists(kept, lambda j: j.isNotNull()), kept)
    return out


def part_score(part) -> Column:
    """Sum of the scores of a part's joints (a null part: 0)."""
    return F.coalesce(F.aggregate(part, F.lit(0.0), lambda a, j: a + F.coalesce(j["score"], F.lit(0.0))), F.lit(0.0))


def _times(point, matrix) -> list[Column]:
    """A row vector times a 3 x n matrix."""
    return [point[0] * matrix[0][j] + point[1] * matrix[1][j] + point[2] * matrix[2][j] for j in range(len(matrix[0]))]


def world_to_camera(point, rotation, shift) -> list[Column]:
    """Coordinates before a camera of 3 x 3 ``rotation`` (applied from the right) and ``shift``; entries may be columns."""
    return [v + t for v, t in zip(_times(point, rotation), shift, strict=True)]


def camera_to_world(point, rotation, shift) -> list[Column]:
    """The inverse of ``world_to_camera`` for an orthonormal rotation."""
    moved = [v - t for v, t in zip(point, shift, strict=True)]
    return _times(moved, [[rotation[j][i] for j in range(3)] for i in range(3)])


def camera_to_pixel(point, focal, center, radial=(), tangential=()) -> list[Column]:
    """Pixel of a point before the camera; three radial terms, or six where the last three divide, and two tangential ones."""
    u, v = point[0] / point[2], point[1] / point[2]
    if radial:
        r2 = u * u + v * v

        def series(terms):
            return sum((F.pow(r2, F.lit(i)) * t for i, t in enumerate(terms, 1)), F.lit(1.0))

        grow = series(radial[:3]) / (series(radial[3:]) if len(radial) == 6 else F.lit(1.0))
        p0, p1 = tangential
        grow = grow + (u * p1 + v * p0) * 2
        u, v = u * grow + r2 * p1, v * grow + r2 * p0
    return [u * focal[0] + center[0], v * focal[1] + center[1]]


def pixel_to_camera(pixel, depth, focal, center) -> list[Column]:
    """The point of a pixel at a known depth, without distortion."""
    return [(pixel[i] - center[i]) / focal[i] * depth for i in range(2)] + [depth]


def softmax(scores) -> Column:
    e = F.transform(scores, lambda v: F.exp(v - F.array_max(scores)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, w: a + w))


def decode_axes(x_scores, y_scores, split: float = 1.0, combine: str = "min", normalise: bool = False) -> tuple[Column, Column, Column]:
    """(x, y, score) of a joint from its score arrays along the two axes.

    The first largest bin wins; the score is the smaller (``min``) or the mean of
    the two maxima, and a score of 0 or less puts the joint at -1 before the
    division by ``split`` bins a pixel.
    """
    if combine not in ("min", "mean"):
        raise ValueError(f"no way {combine!r} to combine scores")
    if normalise:
        x_scores, y_scores = softmax(x_scores), softmax(y_scores)
    tops = F.array_max(x_scores), F.array_max(y_scores)
    score = F.when(tops[0].isNotNull(), F.least(*tops)) if combine == "min" else (tops[0] + tops[1]) / 2
    score = F.when(tops[1].isNotNull(), score)
    at = [F.when(score > 0, (F.array_position(s, m) - 1).cast("double")).when(score <= 0, F.lit(-1.0)) / split for s, m in zip((x_scores, y_scores), tops, strict=True)]
    return at[0], at[1], score


def capture_key(path) -> tuple[Column, Column, Column]:
    """(subject, action, camera) of ``<dir>/<subject>_<action>.<camera>_<frame>``; empty where a name has another form."""
    form = r"^(?:.*/)?([^/_]*)_([^/.]*)\.([^/_]*)_[^/]*$"
    return tuple(F.regexp_extract(path, form, i) for i in (1, 2, 3))
