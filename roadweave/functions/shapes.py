"""Numerical kernels on small point sets: hulls, rectangles, circles, smoothing, cycles."""

from __future__ import annotations

from collections import deque

import numpy as np


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Hull corners, counter-clockwise; fewer than three distinct points come back as they are."""
    pts = np.unique(np.asarray(points, float), axis=0)
    if len(pts) < 3:
        return pts

    def half(seq) -> list:
        out: list = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def min_area_rectangle(points: np.ndarray) -> np.ndarray:
    """Four corners of the smallest rectangle that holds the points; one of its sides lies on the hull."""
    hull = convex_hull(points)
    if len(hull) == 1:
        return np.repeat(hull, 4, axis=0)
    best = None
    for a, b in zip(hull, np.roll(hull, -1, axis=0), strict=True):
        n = np.hypot(*(b - a))
        if n == 0:
            continue
        u = (b - a) / n
        axes = np.array([u, [-u[1], u[0]]])
        local = hull @ axes.T
        lo, hi = local.min(0), local.max(0)
        area = np.prod(hi - lo)
        if best is None or area < best[0] - 1e-12:
            best = (area, np.array([lo, [hi[0], lo[1]], hi, [lo[0], hi[1]]]) @ axes)
    return best[1]


def polygon_area(corners: np.ndarray) -> float:
    x, y = np.asarray(corners, float).T
    return float(abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)


def clip_convex(subject: np.ndarray, clip: np.ndarray) -> np.ndarray:
    """The common part of two convex polygons."""
    (ax, ay), (bx, by), (cx, cy) = clip[:3]
    if (bx - ax) * (cy - by) - (by - ay) * (cx - bx) < 0:
        clip = clip[::-1]
    out = list(map(tuple, subject))
    for a, b in zip(clip, np.roll(clip, -1, axis=0), strict=True):
        inside = lambda p, a=a, b=b: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) >= 0
        prev, out = out, []
        for p, q in zip(prev, prev[1:] + prev[:1], strict=True):
            if inside(p):
                out.append(p)
            if inside(p) != inside(q):
                d = np.subtract(q, p)
                n = (b[0] - a[0]) * d[1] - (b[1] - a[1]) * d[0]
                t = ((b[1] - a[1]) * (p[0] - a[0]) - (b[0] - a[0]) * (p[1] - a[1])) / n
                out.append(tuple(np.add(p, t * d)))
        if not out:
            return np.zeros((0, 2))
    return np.array(out)


def _crossings(a: np.ndarray, b: np.ndarray) -> list[tuple[float, float, int, int]]:
    """(x, y, i, j) where side i of one ring crosses side j of another inside both."""
    out = []
    p, r = a, np.roll(a, -1, axis=0) - a
    q, s = b, np.roll(b, -1, axis=0) - b
    for i in range(len(a)):
        n = r[i, 0] * s[:, 1] - r[i, 1] * s[:, 0]
        d = q - p[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (d[:, 0] * s[:, 1] - d[:, 1] * s[:, 0]) / n
            u = (d[:, 0] * r[i, 1] - d[:, 1] * r[i, 0]) / n
        for j in np.flatnonzero((n != 0) & (t > 1e-12) & (t < 1 - 1e-12) & (u > 1e-12) & (u < 1 - 1e-12)):
            out.append((*(p[i] + t[j] * r[i]), i, int(j)))
    return out


def is_simple(ring: np.ndarray) -> bool:
    """Whether a ring of three points or more has an area and no sides that cross."""
    return len(ring) >= 3 and polygon_area(ring) > 1e-12 and not _crossings(ring, ring)


def cross_themselves(rings: np.ndarray) -> np.ndarray:
    """Of rings of one size (n, corners, 2), whether any two sides cross, as ``is_simple`` has it, all rings at once."""
    p, r = rings, np.roll(rings, -1, axis=1) - rings
    n = r[:, :, None, 0] * r[:, None, :, 1] - r[:, :, None, 1] * r[:, None, :, 0]
    d = p[:, None] - p[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (d[..., 0] * r[:, None, :, 1] - d[..., 1] * r[:, None, :, 0]) / n
        u = (d[..., 0] * r[:, :, None, 1] - d[..., 1] * r[:, :, None, 0]) / n
    return ((n != 0) & (t > 1e-12) & (t < 1 - 1e-12) & (u > 1e-12) & (u < 1 - 1e-12)).any((1, 2))


def common_area(a: np.ndarray, b: np.ndarray) -> float:
    """The area that two simple rings have in common, by slabs between the heights of corners and crossings."""
    if (a.max(0) <= b.min(0)).any() or (b.max(0) <= a.min(0)).any():
        return 0.0
    ys = np.unique(np.r_[a[:, 1], b[:, 1], [y for _, y, _, _ in _crossings(a, b)]])

    def spans(ring: np.ndarray, y: float) -> np.ndarray:
        nxt = np.roll(ring, -1, axis=0)
        over = (ring[:, 1] > y) != (nxt[:, 1] > y)
        p, q = ring[over], nxt[over]
        return np.sort(p[:, 0] + (y - p[:, 1]) / (q[:, 1] - p[:, 1]) * (q[:, 0] - p[:, 0])).reshape(-1, 2)

    total = 0.0
    for lo, hi in zip(ys[:-1], ys[1:], strict=True):
        y = (lo + hi) / 2
        total += (hi - lo) * sum(max(0.0, min(q[1], p[1]) - max(q[0], p[0])) for p in spans(a, y) for q in spans(b, y))
    return total


def is_convex(ring: np.ndarray) -> bool:
    """Whether a simple ring turns one way only."""
    d = np.roll(ring, -1, axis=0) - ring
    n = np.roll(d, -1, axis=0)
    turn = d[:, 0] * n[:, 1] - d[:, 1] * n[:, 0]
    return bool((turn >= -1e-12).all() or (turn <= 1e-12).all())


def common_areas(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The areas that pairs of convex rings (n, corners, 2) have in common, all pairs at once.

    The common part's corners are corners of one ring inside the other and
    crossings of sides; in order round their middle they give the area.
    """
    a, b = (np.where((_signed(x) < 0)[:, None, None], x[:, ::-1], x) for x in (a, b))
    p, r, q, s = a, np.roll(a, -1, axis=1) - a, b, np.roll(b, -1, axis=1) - b
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]

    def within(points: np.ndarray, at: np.ndarray, side: np.ndarray) -> np.ndarray:
        return (cross(side[:, None], points[:, :, None] - at[:, None]) >= -1e-12).all(2)

    d = q[:, None] - p[:, :, None]
    n = cross(r[:, :, None], s[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(d, s[:, None]) / n, cross(d, r[:, :, None]) / n
    crosses = (np.abs(n) > 1e-15) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    meet = p[:, :, None] + np.where(crosses, t, 0.0)[..., None] * r[:, :, None]
    points = np.concatenate([p, q, meet.reshape(len(a), -1, 2)], axis=1)
    valid = np.concatenate([within(p, q, s), within(q, p, r), crosses.reshape(len(a), -1)], axis=1)
    count = valid.sum(1)
    middle = np.where(valid[..., None], points, 0.0).sum(1) / np.maximum(count, 1)[:, None]
    local = points - middle[:, None]
    angle = np.where(valid, np.arctan2(local[..., 1], local[..., 0]), np.inf)
    order = np.argsort(angle, axis=1)
    local = np.take_along_axis(np.where(valid[..., None], local, 0.0), order[..., None], axis=1)
    # points left out repeat the first one, so that they enclose nothing
    local = np.where((np.arange(local.shape[1]) < count[:, None])[..., None], local, local[:, :1])
    return np.where(count > 2, np.abs(_signed(local)), 0.0)


def _signed(rings: np.ndarray) -> np.ndarray:
    nxt = np.roll(rings, -1, axis=1)
    return (rings[..., 0] * nxt[..., 1] - rings[..., 1] * nxt[..., 0]).sum(1) / 2


def overlap_share(box: np.ndarray, other: np.ndarray) -> float:
    """The share of a box that another covers."""
    common = clip_convex(box, other)
    own = polygon_area(box)
    return polygon_area(common) / own if len(common) > 2 and own else 0.0


def convex_overlap(box: np.ndarray, other: np.ndarray) -> bool:
    """Partial overlap: one box inside the other, or equal to it, does not count."""
    common = clip_convex(box, other)
    if len(common) < 3 or (a := polygon_area(common)) <= 1e-12:
        return False
    return a < polygon_area(box) - 1e-9 and a < polygon_area(other) - 1e-9


def in_convex(point: np.ndarray, corners: np.ndarray) -> bool:
    """Strictly inside."""
    d = np.roll(corners, -1, axis=0) - corners
    s = d[:, 0] * (point[1] - corners[:, 1]) - d[:, 1] * (point[0] - corners[:, 0])
    return bool((s > 0).all() or (s < 0).all())


def circle_of(a, b, c) -> tuple[float, float, float] | None:
    """Centre and radius through three points; None on a line."""
    d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
    if abs(d) < 1e-12:
        return None
    sq = [p[0] ** 2 + p[1] ** 2 for p in (a, b, c)]
    x = (sq[0] * (b[1] - c[1]) + sq[1] * (c[1] - a[1]) + sq[2] * (a[1] - b[1])) / d
    y = (sq[0] * (c[0] - b[0]) + sq[1] * (a[0] - c[0]) + sq[2] * (b[0] - a[0])) / d
    return x, y, float(np.hypot(a[0] - x, a[1] - y))


def sector(points: np.ndarray, centre) -> float:
    """Degrees of the least sector that holds the points."""
    a = np.sort(np.degrees(np.arctan2(points[:, 1] - centre[1], points[:, 0] - centre[0])))
    return float(360 - np.diff(np.r_[a, a[0] + 360]).max()) if len(a) else 0.0


def smooth(values: np.ndarray, strength: float) -> np.ndarray:
    """A penalised spline through equally spaced values: least squares plus ``strength`` times squared second differences.

    The matrix has five diagonals; it is factored and solved along them, in time and memory linear in the values.
    """
    n = len(values)
    y = np.asarray(values, float)
    if n < 3 or strength <= 0:
        return y
    # diagonals of I + strength * D'D, D the second differences
    inner = np.arange(n)
    main = 1 + strength * (1.0 * (inner >= 2) + 4.0 * ((inner >= 1) & (inner <= n - 2)) + 1.0 * (inner <= n - 3))
    one = -2.0 * strength * ((inner[:-1] <= n - 3) * 1.0 + (inner[:-1] >= 1) * 1.0)
    two = np.full(n - 2, strength)
    d, l1, l2, z = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n):
        b = two[i - 2] if i >= 2 else 0.0
        a = (one[i - 1] if i >= 1 else 0.0) - (b * l1[i - 1] if i >= 2 else 0.0)
        l2[i] = b / d[i - 2] if i >= 2 else 0.0
        l1[i] = a / d[i - 1] if i >= 1 else 0.0
        d[i] = main[i] - l1[i] * a - l2[i] * b
        z[i] = y[i] - (l1[i] * z[i - 1] if i >= 1 else 0.0) - (l2[i] * z[i - 2] if i >= 2 else 0.0)
    x = [0.0] * n
    for i in range(n - 1, -1, -1):
        x[i] = z[i] / d[i] - (l1[i + 1] * x[i + 1] if i + 1 < n else 0.0) - (l2[i + 2] * x[i + 2] if i + 2 < n else 0.0)
    return np.array(x)


def _basis(at: np.ndarray, knots: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): the degree + 1 B-splines that are not zero at each point."""
    k = np.clip(np.searchsorted(knots, at, side="right") - 1, degree, len(knots) - degree - 2)
    out = np.zeros((len(at), degree + 1))
    out[:, 0] = 1.0
    for j in range(1, degree + 1):
        saved = np.zeros(len(at))
        for r in range(j):
            right, left = knots[k + r + 1] - at, at - knots[k + 1 - j + r]
            part = out[:, r] / (right + left)
            out[:, r] = saved + right * part
            saved = left * part
        out[:, j] = saved
    return k - degree, out


def smoothing_spline(at: np.ndarray, values: np.ndarray, residual: float) -> tuple[np.ndarray, np.ndarray]:
    """(fitted, slope) of a cubic B-spline through (n, d) values at increasing places, squared deviations at most ``residual`` in all.

    Least squares over few knots; spans that deviate more than their share get a
    knot at their middle point, until the bound is met. Fewer than four points
    are kept as they are.
    """
    at, values = np.asarray(at, float), np.asarray(values, float)
    if (np.diff(at) <= 0).any():
        raise ValueError("places must increase")
    n = len(at)
    if n < 4:
        return values.copy(), np.gradient(values, at, axis=0) if n > 1 else np.zeros_like(values)
    inner = np.zeros(0)
    while True:
        knots = np.r_[[at[0]] * 4, inner, [at[-1]] * 4]
        first, weights = _basis(at, knots, 3)
        m = len(knots) - 4
        rows, cols = np.repeat(np.arange(n), 4), (first[:, None] + np.arange(4)).ravel()
        # the normal matrix has seven diagonals; both sides are summed from four terms a point
        normal, right = np.zeros((m, m)), np.zeros((m, values.shape[1]))
        for a in range(4):
            np.add.at(right, first + a, weights[:, [a]] * values)
            for b in range(4):
                np.add.at(normal, (first + a, first + b), weights[:, a] * weights[:, b])
        c = np.linalg.solve(normal + np.eye(m) * 1e-13 * np.trace(normal), right)
        fitted = np.zeros_like(values)
        np.add.at(fitted, rows, weights.ravel()[:, None] * c[cols])
        off = ((values - fitted) ** 2).sum(1)
        if off.sum() <= residual:
            break
        ends = np.r_[0, np.searchsorted(at, inner), n - 1]
        shares = np.array([off[a : b + 1].sum() for a, b in zip(ends[:-1], ends[1:], strict=True)])
        wide = np.diff(ends) >= 4
        if not wide.any():
            # no span can be parted and still hold points enough: the values themselves
            return values.copy(), np.gradient(values, at, axis=0)
        split = wide & (shares >= min(off.sum() / len(shares), shares[wide].max()))
        middle = (ends[:-1] + ends[1:]) // 2
        inner = np.unique(np.r_[inner, at[middle[split]]])
    steps = 3 * np.diff(c, axis=0) / (knots[4 : m + 3] - knots[1:m])[:, None]
    first, weights = _basis(at, knots[1:-1], 2)
    slope = np.zeros_like(values)
    np.add.at(slope, np.repeat(np.arange(n), 3), weights.ravel()[:, None] * steps[(first[:, None] + np.arange(3)).ravel()])
    return fitted, slope


def contour_area(mask: np.ndarray) -> float:
    """The area inside the outer contour of a blob, which runs through pixel centres; holes belong to it.

    Four filled pixels in a square enclose one unit, three of them half a unit.
    """
    r, c = np.nonzero(mask)
    if not len(r):
        return 0.0
    blob = np.pad(mask[r.min() : r.max() + 1, c.min() : c.max() + 1].astype(bool), 1)
    outside = np.zeros_like(blob)
    outside[[0, -1]] = outside[:, [0, -1]] = True
    while True:
        grown = outside.copy()
        grown[1:] |= outside[:-1]
        grown[:-1] |= outside[1:]
        grown[:, 1:] |= outside[:, :-1]
        grown[:, :-1] |= outside[:, 1:]
        grown &= ~blob
        if (grown == outside).all():
            break
        outside = grown
    full = (~outside).astype(int)
    four = full[1:, 1:] + full[1:, :-1] + full[:-1, 1:] + full[:-1, :-1]
    return float((four == 4).sum() + (four == 3).sum() / 2)


def label_blobs(mask: np.ndarray, corners: bool = True) -> np.ndarray:
    """Blobs of a dense mask, numbered from 1 in reading order; 0 elsewhere. With ``corners`` diagonal neighbours touch.

    Runs of a row are joined to the runs above that they touch (union-find), so
    work goes with the runs, not the pixels.
    """
    mask = np.asarray(mask, bool)
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    parent = list(range(len(row)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    reach = 1 if corners else 0
    first = np.searchsorted(row, np.arange(mask.shape[0] + 1))
    for r in range(1, mask.shape[0]):
        i, j = first[r - 1], first[r]
        while i < first[r] and j < first[r + 1]:
            if start[i] < end[j] + reach and start[j] < end[i] + reach:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if end[i] < end[j]:
                i += 1
            else:
                j += 1
    roots = np.fromiter((find(k) for k in range(len(row))), np.int64, len(row))
    number = np.unique(roots, return_inverse=True)[1] + 1 if len(row) else roots
    out = np.zeros(mask.shape, int)
    for r, a, b, k in zip(row, start, end, number, strict=True):
        out[r, a:b] = k
    return out


#: Neighbours clockwise from the left, as the row axis points down.
_AROUND = [(0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1)]


def outer_border(blobs: np.ndarray, k: int) -> np.ndarray:
    """(x, y) of the border pixels of blob ``k``, followed clockwise from its first pixel in reading order.

    The walk ends when it leaves the first pixel by the way it left it first; a
    pixel that the border passes twice is there twice.
    """
    first = np.flatnonzero(blobs.ravel() == k)
    if not len(first):
        return np.zeros((0, 2))
    whole = np.pad(blobs == k, 1)
    at = begin = (int(first[0]) // blobs.shape[1] + 1, int(first[0]) % blobs.shape[1] + 1)
    came, first_way, out = 0, None, []
    while True:
        for turn in range(8):
            way = (came + turn) % 8
            to = at[0] + _AROUND[way][0], at[1] + _AROUND[way][1]
            if whole[to]:
                break
        else:
            return np.array([[at[1] - 1, at[0] - 1]], float)
        if at == begin and way == first_way:
            return np.array(out, float)
        if first_way is None:
            first_way = way
        out.append((at[1] - 1, at[0] - 1))
        # look on from the last empty neighbour seen
        at, came = to, (way + 6) % 8 if way % 2 == 0 else (way + 5) % 8


def outer_contours(mask: np.ndarray) -> list[np.ndarray]:
    """Borders of the blobs that lie in no hole of another, in reading order of their first pixels."""
    blobs = label_blobs(mask)
    around = label_blobs(~np.pad(np.asarray(mask, bool), 1), corners=False)
    out = []
    for k in range(1, blobs.max(initial=0) + 1):
        at = int(np.flatnonzero(blobs.ravel() == k)[0])
        # left of a blob's first pixel is what surrounds it
        if around[at // blobs.shape[1] + 1, at % blobs.shape[1]] == around[0, 0]:
            out.append(outer_border(blobs, k))
    return out


def rectangle(points: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """(centre, width, height, angle) of the smallest rectangle round the points.

    The width runs at ``angle``, in (0, 90] degrees from x towards y, and the
    height across it: of an upright rectangle the height is its extent in x.
    """
    corners = min_area_rectangle(points)
    u, v = corners[1] - corners[0], corners[2] - corners[1]
    centre = corners.mean(0)
    along = u if np.hypot(*u) > 0 else np.array([-v[1], v[0]])
    angle = np.degrees(np.arctan2(along[1], along[0])) % 180
    width, height = float(np.hypot(*u)), float(np.hypot(*v))
    if not 1e-9 < angle <= 90 + 1e-9:
        angle, width, height = (angle + 90) % 180, height, width
    return centre, width, height, float(min(angle, 90.0)) if np.hypot(*u) + np.hypot(*v) > 0 else 90.0


def corners_of(centre: np.ndarray, width: float, height: float, angle: float) -> np.ndarray:
    """Corners of a rectangle in a fixed order, so that two boxes can be averaged corner by corner."""
    e = np.array([np.cos(np.radians(angle)), np.sin(np.radians(angle))]) * width / 2
    f = np.array([-np.sin(np.radians(angle)), np.cos(np.radians(angle))]) * height / 2
    return centre + np.array([f - e, -e - f, e - f, e + f])


def under_rectangle(shape: tuple[int, int], centre: np.ndarray, width: float, height: float, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the pixels whose centres lie in a rectangle, its sides too; row by row between its sides."""
    c, s = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    half_y = (abs(s) * width + abs(c) * height) / 2
    rows = np.arange(max(0, int(np.ceil(centre[1] - half_y - 1e-6))), min(shape[0] - 1, int(np.floor(centre[1] + half_y + 1e-6))) + 1)
    dy = rows - centre[1]
    lo, hi = np.full(len(rows), -np.inf), np.full(len(rows), np.inf)
    # |dx c + dy s| <= width / 2 and |dy c - dx s| <= height / 2
    for a, b, half in ((c, dy * s, width / 2 + 1e-6), (-s, dy * c, height / 2 + 1e-6)):
        if abs(a) < 1e-9:
            lo[np.abs(b) > half] = np.inf
        else:
            x1, x2 = (-half - b) / a, (half - b) / a
            lo, hi = np.maximum(lo, np.minimum(x1, x2)), np.minimum(hi, np.maximum(x1, x2))
    first = np.clip(np.ceil(lo + centre[0]), 0, shape[1]).astype(int)
    last = np.clip(np.floor(hi + centre[0]), -1, shape[1] - 1).astype(int)
    n = np.maximum(0, last - first + 1)
    return np.repeat(rows, n), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def turned_raster(image: np.ndarray, turn: float, centre: tuple[float, float]) -> np.ndarray:
    """An image of the same size turned by ``turn`` radians, counter-clockwise as seen, about ``centre`` (x, y); nearest pixel, 0 beyond."""
    r, c = np.indices(image.shape)
    dx, dy = c - centre[0], r - centre[1]
    x = np.floor(centre[0] + np.cos(turn) * dx - np.sin(turn) * dy + 0.5 + 1e-9).astype(int)
    y = np.floor(centre[1] + np.sin(turn) * dx + np.cos(turn) * dy + 0.5 + 1e-9).astype(int)
    ok = (x >= 0) & (x < image.shape[1]) & (y >= 0) & (y < image.shape[0])
    out = np.zeros_like(image)
    out[ok] = image[y[ok], x[ok]]
    return out


def cycle_basis(neighbours: dict[int, list[int]]) -> list[list[int]]:
    """Fundamental cycles of breadth-first trees from the least ids: one for each edge off the trees."""
    seen: dict[int, int | None] = {}
    depth: dict[int, int] = {}
    cycles = []
    for root in sorted(neighbours):
        if root in seen:
            continue
        seen[root], depth[root] = None, 0
        todo, members = deque([root]), [root]
        while todo:
            u = todo.popleft()
            for v in sorted(neighbours[u]):
                if v not in seen:
                    seen[v], depth[v] = u, depth[u] + 1
                    todo.append(v)
                    members.append(v)
        for u in sorted(members):
            for v in sorted(neighbours[u]):
                if u < v and seen[u] != v and seen[v] != u:
                    a, b = [u], [v]
                    while a[-1] != b[-1]:
                        side = a if depth[a[-1]] >= depth[b[-1]] else b
                        side.append(seen[side[-1]])
                    cycles.append(a + b[-2::-1])
    return cycles
