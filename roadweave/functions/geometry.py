"""Plane geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def angle(dx: Column, dy: Column) -> Column:
    return F.atan2(dy, dx)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))


def unit(dx: Column, dy: Column) -> tuple[Column, Column]:
    """The direction of a vector; null for a vector of no length."""
    n = F.nullif(F.sqrt(dx * dx + dy * dy), F.lit(0.0))
    return dx / n, dy / n


def angle_between(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Radians between two vectors, the cosine clipped to [-1, 1]."""
    (ux, uy), (vx, vy) = unit(ax, ay), unit(bx, by)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ux * vx + uy * vy)))


def is_sharp(ax: Column, ay: Column, bx: Column, by: Column, max_degrees: float) -> Column:
    return angle_between(ax, ay, bx, by) > F.radians(F.lit(max_degrees))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment, which may be a point."""
    dx, dy = bx - ax, by - ay
    t = F.coalesce(((px - ax) * dx + (py - ay) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return distance(px, py, ax + t * dx, ay + t * dy)


def scan_segment(x: Column, y: Column, dx: Column, dy: Column, reach: float) -> tuple[Column, Column, Column, Column]:
    """The segment across a direction at a point, ``reach`` to either side."""
    ux, uy = unit(dx, dy)
    return x - uy * reach, y + ux * reach, x + uy * reach, y - ux * reach


def circle_through(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    """Centre and radius of the circle through three points; null on a line."""
    d = F.nullif(2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by)), F.lit(0.0))
    a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
    x = (a2 * (by - cy) + b2 * (cy - ay) + c2 * (ay - by)) / d
    y = (a2 * (cx - bx) + b2 * (ax - cx) + c2 * (bx - ax)) / d
    return x, y, distance(x, y, ax, ay)


def rotate(x: Column, y: Column, radians: Column) -> tuple[Column, Column]:
    return x * F.cos(radians) - y * F.sin(radians), x * F.sin(radians) + y * F.cos(radians)


def rotation_matrix(yaw: Column, pitch: Column, roll: Column) -> Column:
    """Rows of Rz(yaw) Ry(pitch) Rx(roll) as an array of arrays."""
    cy, sy, cp, sp, cr, sr = F.cos(yaw), F.sin(yaw), F.cos(pitch), F.sin(pitch), F.cos(roll), F.sin(roll)
    return F.array(
        F.array(cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr),
        F.array(sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr),
        F.array(-sp, cp * sr, cp * cr),
    )


def lerp(x: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Linear between two points; the first where they share x."""
    return y0 + (y1 - y0) * F.coalesce((x - x0) / F.nullif(x1 - x0, F.lit(0)), F.lit(0.0))


def in_extents(x: Column, y: Column, min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Inside or on an axis-aligned box."""
    return x.between(min_x, max_x) & y.between(min_y, max_y)


def in_polygon(x: Column, y: Column, corners: list[tuple[Column, Column]]) -> Column:
    """Strictly inside a convex polygon, whichever way it is wound."""
    sides = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1], strict=True)]
    left = right = F.lit(True)
    for s in sides:
        left, right = left & (s > 0), right & (s < 0)
    return left | right


def boxes_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Partial overlap of (min_x, min_y, max_x, max_y) boxes: containment and equality are none."""
    meet = (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])
    inside = lambda p, q: (p[0] >= q[0]) & (p[1] >= q[1]) & (p[2] <= q[2]) & (p[3] <= q[3])
    return meet & ~inside(a, b) & ~inside(b, a)


def overlap_area(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    return side(0, 2) * side(1, 3)


def natural_key(name: Column) -> Column:
    """A text that sorts names with their digit runs as numbers: each run padded to 20 digits."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 20, "0")).otherwise(p)), "")


def image_sequence(path: Column, name_regex: str | None = None) -> Column:
    """The number in an image's name: its stem, or group 1 of a pattern; null where there is none."""
    stem = F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
    found = F.regexp_extract(stem, name_regex, 1) if name_regex else stem
    return F.when(found != "", found).try_cast("long")


def has_extension(path: Column, extension: str) -> Column:
    return F.endswith(F.lower(path), F.lit("." + extension.lower().lstrip(".")))
