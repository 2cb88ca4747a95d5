"""Contours, rectangles and the parser's rules; lines in order; blobs over tiles; joins of rotated boxes."""

import math
import random
from collections import Counter, deque

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadweave.functions import geo, shapes
from roadweave.operators import blend, boxparser, graphs, grid, linegraph, lineorder, placement
from roadweave.operators.boxparser import DriveState, ParserOptions


def flood(mask, corners=True):
    out, k = np.zeros(mask.shape, int), 0
    for r, c in zip(*np.nonzero(mask), strict=True):
        if out[r, c]:
            continue
        k += 1
        out[r, c], todo = k, deque([(r, c)])
        while todo:
            y, x = todo.popleft()
            for i, j in ((y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if corners or not (a and b)):
                if 0 <= i < mask.shape[0] and 0 <= j < mask.shape[1] and mask[i, j] and not out[i, j]:
                    out[i, j] = k
                    todo.append((i, j))
    return out


def test_labels_and_borders_equal_flooding():
    rng = np.random.default_rng(0)
    for _ in range(150):
        mask = rng.random((rng.integers(1, 14), rng.integers(1, 14))) < rng.random()
        blobs = shapes.label_blobs(mask)
        assert (blobs == flood(mask)).all() and (shapes.label_blobs(mask, False) == flood(mask, False)).all()
        for k in range(1, blobs.max() + 1):
            border = shapes.outer_border(blobs, k)
            whole = np.pad(blobs == k, 1)
            outside = flood(~whole, False) == 1
            rim = {(c - 1, r - 1) for r, c in zip(*np.nonzero(whole), strict=True) if outside[r - 1, c] or outside[r + 1, c] or outside[r, c - 1] or outside[r, c + 1]}
            assert set(map(tuple, border.astype(int))) == rim
            assert shapes.polygon_area(border) == pytest.approx(shapes.contour_area(blobs == k))


def test_contours_in_holes_are_left_out():
    ring = np.ones((9, 9), bool)
    ring[1:8, 1:8] = False
    ring[4, 4] = True
    assert len(shapes.outer_contours(ring)) == 1 and len(shapes.outer_contours(~ring)) == 1
    ring[0, 4] = False  # a gap lets the outside in
    assert len(shapes.outer_contours(ring)) == 2


def test_rectangles_have_a_fixed_orientation():
    assert shapes.rectangle(np.array([[0, 0], [100, 0], [100, 10], [0, 10]]))[1:] == (10, 100, 90)
    assert shapes.rectangle(np.array([[0, 0], [10, 0], [10, 100], [0, 100]]))[1:] == (100, 10, 90)
    rng = np.random.default_rng(1)
    for _ in range(100):
        centre, (w, h), a = rng.uniform(5, 25, 2), rng.uniform(1, 20, 2), rng.uniform(1, 89)
        c, width, height, angle = shapes.rectangle(shapes.corners_of(centre, w, h, a))
        assert np.allclose(c, centre) and (width, height, angle) == pytest.approx((w, h, a))
        rows, cols = shapes.under_rectangle((30, 30), centre, w, h, a)
        y, x = np.indices((30, 30))
        t, dx, dy = math.radians(a), x - centre[0], y - centre[1]
        want = (np.abs(dx * math.cos(t) + dy * math.sin(t)) <= w / 2 + 1e-6) & (np.abs(dy * math.cos(t) - dx * math.sin(t)) <= h / 2 + 1e-6)
        assert set(zip(rows.tolist(), cols.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(want)), strict=True))


def test_windows_are_whole_steps_and_the_last_goes_to_the_end(spark):
    assert blend.slices(400, 32, 16)[-2:] == [(368, 400), (384, 400)] and len(blend.slices(400, 32, 16)) == 25
    assert blend.slices(47, 16, 6) == [(0, 16), (10, 26), (20, 36), (30, 47)] and blend.slices(9, 16, 6) == []
    rows = spark.range(50).select(F.col("id").cast("int").alias("row"), F.lit(0).alias("col"))
    for h, w, o in ((47, 16, 6), (50, 20, 6), (9, 16, 6), (33, 16, 15)):
        got = {(r["slice"], r["row"]) for r in blend.in_slices(rows, h, w, o).collect()}
        assert got == {(k, r) for k, (a, b) in enumerate(blend.slices(h, w, o)) for r in range(a, b)}


def test_touching_classes_are_one_contour_of_the_most_frequent_class():
    best, second = np.zeros((16, 12), int), np.zeros((16, 12), int)
    best[:, 2:6], best[:, 6:8] = 1, 2
    second[:, 2:8] = 3
    [(s, k, b, cls, fallback, corners)] = boxparser.boxes_of(best, second, ParserOptions(window=16, overlap=1, min_box_area=1))
    assert (s, k, b, cls, fallback) == (0, 0, 0, 1, 3)
    assert np.allclose(corners.min(0), [2, 0]) and np.allclose(corners.max(0), [7, 15])
    best[:, 3:8] = 2
    assert boxparser.boxes_of(best, second, ParserOptions(window=16, overlap=1))[0][3] == 2


def test_wide_boxes_are_cut_into_whole_steps():
    pieces = boxparser.split_wide((np.array([200.0, 4.0]), 8.0, 400.0, 90.0), 16, 16)
    assert len(pieces) == 25 and {p[2] for p in pieces} == {32.0}
    assert np.allclose([p[0] for p in pieces], [(392.0 - 16 * k if pieces[0][0][0] > 200 else 8.0 + 16 * k, 4.0) for k in range(25)])
    best = np.zeros((8, 130), int)
    best[2:6] = 1
    o = ParserOptions(window=8, overlap=1, max_box_pixels=64)
    assert len(boxparser.boxes_of(best, best, o)) == 18
    # across is as long, but it is not the height of the rectangle
    assert len(boxparser.boxes_of(np.pad(best[2:6].T[:70], 4), np.zeros((78, 12), int), ParserOptions(window=78, overlap=1, max_box_pixels=64))) == 1


def box(cx, cy, half=1.0, cls=1, slice_=0, contour=0, k=0, at=(0.0, 0.0), reach=50.0):
    corners = shapes.corners_of(np.array([cx, cy]), 2 * half, 2 * half, 90.0)
    return {"slice": slice_, "contour": contour, "box": k, "cls": cls, "fallback": 0, "cx": cx, "cy": cy, "corners": corners.ravel(), "x": at[0], "y": at[1], "reach": reach}


def fold(*frames, **options):
    state = DriveState()
    for f in frames:
        state.frame(pd.DataFrame(f), ParserOptions(**{"old_distance": 5.0, **options}))
    return state


def test_a_box_merges_with_an_earlier_one_of_any_class():
    s = fold([box(0, 0, cls=1)], [box(0.5, 0, cls=2)])
    assert list(s.nodes) == [0] and s.nodes[0]["centre"].tolist() == [0.25, 0] and s.nodes[0]["cls"] == 1
    assert s.nodes[0]["corners"].mean(0).tolist() == [0.25, 0] and not s.edges
    # boxes of one frame do not merge, and one beyond the distance asks nobody
    assert len(fold([box(0, 0), box(0.5, 0, k=1)]).nodes) == 2
    assert len(fold([box(0, 0)], [box(0.5, 0)], old_distance=0.5).nodes) == 2


def test_a_box_joins_the_three_nearest_its_contour_and_the_last_window():
    far = [box(x, 0, slice_=k, contour=k) for k, x in enumerate((-1.9, -1.5, 1.5, 1.6, 1.9))]
    s = fold(far, [box(0, 1.5)])
    assert {e for e in s.edges if 5 in e} == {(1, 5), (2, 5), (3, 5), (4, 5)}  # three nearest, and 4 of the last window
    assert len(s.edges - {(1, 5), (2, 5), (3, 5), (4, 5)}) == 3  # windows in a row: 0-1, 2-3, 3-4
    assert fold(far, [box(0, 1.5)], single=True).edges >= {(1, 5)} and len([e for e in fold(far, [box(0, 1.5)], single=True).edges if 5 in e]) == 1
    one = fold([box(0, 0), box(1.5, 0, k=1), box(1.5, 0.5, contour=1), box(0, 1.6, slice_=2)])
    assert one.edges == {(0, 1), (0, 3), (1, 3), (2, 3)}  # other contours of one window do not meet
    # one inside the other is no overlap
    assert not fold([box(0, 0, 2.0), box(0.2, 0, 0.5, k=1)]).edges


def test_boxes_beyond_the_raster_from_the_vehicle_are_forgotten():
    s = fold([box(0, 0, at=(0, 0), reach=10)], [box(30, 0, at=(30, 0), reach=10)], [box(40, 0, at=(40, 0), reach=10)])
    assert s.near == [1, 2]
    s.forget()
    assert sorted(s.nodes) == [1, 2]
    # the last window of a frame is looked at by the next one's first
    assert fold([box(0, 0)], [box(1.5, 0)], old_distance=0.1).edges == {(0, 1)}


def test_a_turned_region_gives_the_boxes_where_they_are(spark):
    rows = [(0, f, r, c, v, 0, 5.0, 7.0, 20.0, 20.0, turn) for f, turn in ((0, 0.0), (1, math.pi / 2)) for r in range(41) for c in range(41) for v in [int(18 <= (c if f == 0 else r) < 23)]]
    regions = spark.createDataFrame(rows, "drive long, frame long, row int, col int, best int, second int, x double, y double, centre_row double, centre_col double, turn double")
    got = boxparser.find_boxes(regions, ParserOptions(window=16, overlap=8, resolution=0.1)).toPandas()
    up, across = (got[got["frame"] == f].sort_values("slice") for f in (0, 1))
    assert len(up) == len(across) == 5 and np.allclose(up["cx"], 5.0) and np.allclose(across["cy"], 7.0)
    assert np.allclose(np.sort(up["cy"] - 7.0), np.sort(across["cx"] - 5.0), atol=0.11)
    assert np.allclose(got["reach"], 4.1)


def test_lines_in_order_equal_walks(spark):
    rng = random.Random(5)
    nodes, edges, want, with_class = [], [], set(), set()
    for k in range(12):
        n = rng.randint(2, 40)
        made = {tuple(sorted((i, i + 1))) for i in range(n - 1)} | {tuple(sorted(rng.sample(range(n), 2))) for _ in range(rng.randint(0, 4))}
        if k % 3 == 0:  # a ring apart from all
            made |= {(100, 101), (101, 102), (102, 103), (100, 103)}
        graph = linegraph.Graph()
        for i in sorted({i for e in made for i in e}):
            graph.add(i, float(i), 0.0, rng.randint(0, 1) if rng.random() < 0.3 else 0)
        for a, b in sorted(made):
            graph.connect(a, b)
        cuts = {c for c in rng.sample(sorted(graph.nodes), min(2, len(graph.nodes))) if k % 2}
        nodes += [(k, i, x, y, c) for i, (x, y, c, _) in graph.nodes.items()]
        edges += [(k, a, b) if rng.random() < 0.5 else (k, b, a) for a, b in made]
        for rule, out in ((False, want), (True, with_class)):
            for line in linegraph.lines_of(graph, cuts=cuts, by_class=rule):
                out.add((k, tuple(line)))
        edges += [(k, c, None) for c in cuts]  # carries the cuts along
    cut = spark.createDataFrame([(k, a) for k, a, b in edges if b is None] or [(0, -1)], "graph long, node long")
    n = spark.createDataFrame(nodes, "graph long, node long, x double, y double, cls int")
    e = spark.createDataFrame([x for x in edges if x[2] is not None] * 2, "graph long, src long, dst long")
    got = lineorder.line_order(e, cut).groupBy("graph", "first", "second").agg(F.sort_array(F.collect_list(F.struct("k", "node"))).alias("p")).collect()
    assert all([x["k"] for x in r["p"]] == list(range(len(r["p"]))) for r in got)
    assert {(r["graph"], tuple(x["node"] for x in r["p"])) for r in got} == want and len(got) == len(want)
    strings = lineorder.linestrings(n, e, cut).collect()
    assert {(r["graph"], tuple(r["nodes"])) for r in strings} == with_class and len(strings) == len(with_class)


def test_line_order_takes_odd_rows(spark):
    e = spark.createDataFrame([(0, 1, 1), (None, 1, 2), (0, None, 2), (0, 3, None)], "graph long, src long, dst long")
    assert lineorder.line_order(e).count() == 0 and lineorder.line_order(e.where("false")).count() == 0
    assert lineorder.fork_cuts(e).count() == 0


def test_robust_directions_are_means_of_the_last_steps(spark):
    xy = [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.0, 1.0), (4.0, 2.0), (5.0, 3.0)]
    nodes = spark.createDataFrame([(0, i, x, y) for i, (x, y) in enumerate(xy)] + [(0, 6, 4.0, 3.0), (0, 7, 5.0, 2.0), (0, 9, 9.0, 9.0), (1, 0, 0.0, 0.0)] + [(1, k + 2, math.cos(k * 0.21), math.sin(k * 0.21)) for k in (-1, 0, 1)], "graph long, node long, x double, y double")
    edges = spark.createDataFrame([(0, i, i + 1) for i in range(5)] + [(0, 4, 6), (0, 4, 7), (1, 0, 1), (1, 2, 0), (1, 0, 3)], "graph long, src long, dst long")
    found = lineorder.robust_directions(nodes, edges).collect()
    got = {r["node"]: (r["dx"], r["dy"]) for r in found if r["graph"] == 0}
    unit = lambda v: v / np.hypot(*v)
    steps = [unit(np.subtract(b, a)) for a, b in zip(xy, xy[1:], strict=False)]
    assert got[0] == pytest.approx((1, 0)) and got[1] == pytest.approx((1, 0))
    assert got[3] == pytest.approx(tuple(unit(sum(steps[:3]))))
    # two edges of the fork have as many votes, so the line to it counts; at the other fork the middle edge wins
    assert got[4] == pytest.approx(tuple(unit(sum(steps[1:4]))))
    assert {r["node"]: (r["dx"], r["dy"]) for r in found if r["graph"] == 1}[0] == pytest.approx((1, 0))
    assert got[9] == (None, None)


def test_fork_cuts_equal_fork_removal(spark):
    rng = random.Random(2)
    for most in (None, 3):
        edges, want = [], set()
        for k in range(8):
            graph = linegraph.Graph()
            n = 30
            for i in range(n):
                graph.add(i, float(i), 0.0, 0)
            for i in range(1, n):
                graph.connect(i, rng.randint(max(0, i - 6), i - 1))
            edges += [(k, a, b) for a in graph.adj for b in graph.adj[a] if a < b]
            left = {(k, a, b) for g in linegraph.fork_remove(most)(graph) for a in g.adj for b in g.adj[a] if a < b}
            want |= {e for e in edges if e[0] == k} - left
        got = {tuple(r) for r in lineorder.fork_cuts(spark.createDataFrame(edges, "graph long, src long, dst long"), most).collect()}
        # fork removal also leaves out edges of parts of one node, which have none
        assert got == want


def test_blobs_over_tiles_equal_flooding(spark):
    rng = np.random.default_rng(3)
    mask = rng.random((23, 31)) < 0.45
    labels = flood(mask)
    df = spark.createDataFrame([(f, int(r), int(c)) for f in (0, 1) for r, c in zip(*np.nonzero(mask), strict=True)], "frame long, row int, col int")
    for tile in (4, 7, 512):
        got = graphs.foreground_blobs(df, ["frame"], tile).collect()
        for f in (0, 1):
            of = {}
            for r in (x for x in got if x["frame"] == f):
                of.setdefault(labels[r["row"], r["col"]], set()).add((r["blob"]["row"], r["blob"]["col"], r["area"]))
            assert len(of) == labels.max()
            for k, names in of.items():
                rows, cols = np.nonzero(labels == k)
                first = min(zip(rows, cols, strict=True))
                assert names == {(*map(int, first), len(rows))}
    assert graphs.foreground_blobs(df.where("false"), ["frame"]).count() == 0


def test_pair_hops_equal_breadth_first(spark):
    rng = random.Random(4)
    edges = {(i, rng.randint(max(0, i - 4), i - 1)) for i in range(1, 80)}
    near = {i: set() for i in range(80)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)

    def steps(a, b):
        seen, todo = {a: 0}, deque([a])
        while todo:
            u = todo.popleft()
            for v in near[u] - seen.keys():
                seen[v] = seen[u] + 1
                todo.append(v)
        return seen[b]

    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(5, 5), (5, 5), (None, 3), (1, 999)]
    e, p = spark.createDataFrame(list(edges), "src long, dst long"), spark.createDataFrame(pairs, "a long, b long")
    for most in (0, 1, 4, 7):
        got = {(r["a"], r["b"]): r["hop"] for r in graphs.pair_hops(e, p, most).collect()}
        assert got == {(a, b): steps(a, b) for a, b in pairs if a is not None and b < 80 and steps(a, b) <= most}


def test_rotated_boxes_equal_clipped_polygons(spark):
    rng = np.random.default_rng(6)
    boxes = [(k, *map(float, rng.uniform(0, 30, 2)), *map(float, rng.uniform(1, 8, 2)), float(rng.uniform(0, 7))) for k in range(60)] + [(60, 5.0, 5.0, 4.0, 2.0, 0.3), (61, 5.0, 5.0, 4.0, 2.0, 0.3), (62, 5.0, 5.0, 1.0, 1.0, 1.0)]
    corners = {b[0]: shapes.corners_of(np.array(b[1:3]), b[3], b[4], math.degrees(b[5])) for b in boxes}
    df = spark.createDataFrame(boxes, "id long, cx double, cy double, width double, height double, angle double")
    got = {(r["l"]["id"], r["r"]["id"]) for r in grid.rotated_pairs(df, df, 6.0).collect()}
    assert got == {(a, b) for a in corners for b in corners if shapes.convex_overlap(corners[a], corners[b])}
    inside = {(r["p"]["id"], r["b"]["id"]) for r in grid.points_in_rotated(df.select("id", F.col("cx").alias("x"), F.col("cy").alias("y")), df, 6.0).collect()}
    assert inside == {(a[0], b) for a in boxes for b in corners if shapes.in_convex(np.array(a[1:3]), corners[b])}


def test_common_areas_of_many_pairs_equal_those_of_each():
    rng = np.random.default_rng(7)
    rings = [shapes.convex_hull(rng.uniform(0, 10, (9, 2))) for _ in range(60)]
    rings += [np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float), np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float)[::-1], np.array([[1, 1], [2, 1], [2, 2], [1, 2]], float), np.array([[4, 0], [8, 0], [8, 4], [4, 4]], float)]
    for a in rings:
        for b in rings:
            assert shapes.common_areas(a[None], b[None])[0] == pytest.approx(shapes.common_area(a, b), abs=1e-9)
    star = np.array([[0, 0], [2, 1], [4, 0], [3, 2], [4, 4], [2, 3], [0, 4], [1, 2]], float)
    assert not shapes.is_convex(star) and shapes.is_convex(rings[0])


def test_second_class_of_a_region(spark):
    rows = [(0, 0, 0, 1, 5.0), (0, 0, 0, 2, 3.0), (0, 0, 1, 2, 0.05), (0, 0, 2, 0, 9.0), (0, 0, 3, 4, 2.0), (0, 0, 3, 1, 1.0), (0, 0, 4, 7, 2.0), (0, 0, 4, 1, 0.3)]
    w = spark.createDataFrame(rows, "frame long, row int, col int, cls int, weight double")
    got = {r["col"]: (r["cls"], r["second"]) for r in placement.region_labels(w, [4], drivable=7, second=True).collect()}
    assert got == {0: (1, 2), 1: (0, 2), 2: (0, 0), 3: (0, 0), 4: (7, 1)}
    assert {r["col"]: r["cls"] for r in placement.region_labels(w, [4], drivable=7).collect()} == {k: v[0] for k, v in got.items()}


def test_warps_of_each_frame_equal_bilinear_sums(spark):
    rng = np.random.default_rng(9)
    shape = (7, 9)
    pixels = {(f, r, c): tuple(map(float, rng.integers(0, 255, 3))) for f in (0, 1, 2) for r in range(6) for c in range(8) if rng.random() < 0.9}
    h = {0: [1, 0, 0, 0, 1, 0, 0, 0, 1], 1: [0.8, 0.1, 0.7, -0.1, 0.9, 1.3, 0.01, 0.02, 1.0], 2: [1, 0, 0, 0, 1, 0, -0.25, 0, 1.0]}
    df = spark.createDataFrame([(*k, *v) for k, v in pixels.items()], "frame long, row int, col int, r double, g double, b double")
    frames = spark.createDataFrame([(f, list(map(float, m))) for f, m in h.items()], "frame long, h array<double>")
    want = {}
    for f, m in h.items():
        m = np.reshape(m, (3, 3))
        for r in range(shape[0]):
            for c in range(shape[1]):
                u, v, w = m @ (c, r, 1)
                if w == 0:
                    continue
                u, v = u / w, v / w
                parts = [((1 - abs(v - y)) * (1 - abs(u - x)), (f, y, x)) for y in (math.floor(v), math.floor(v) + 1) for x in (math.floor(u), math.floor(u) + 1)]
                hit = [(a, pixels[k]) for a, k in parts if a > 0 and k in pixels]
                if hit:
                    want[(f, r, c)] = tuple(sum(a * p[k] for a, p in hit) for k in range(3))
    got = {(x["frame"], x["row"], x["col"]): (x["r"], x["g"], x["b"]) for x in blend.warp(df, frames, shape).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert {k: v for k, v in got.items() if k[0] == 0} == {k: pytest.approx(v) for k, v in pixels.items() if k[0] == 0}


def test_warps_look_only_round_the_pixels_that_exist(spark):
    px = spark.createDataFrame([(0, 150_000, 70_000, 2.0)], "frame long, row int, col int, weight double")
    frames = spark.createDataFrame([(0, [1.0, 0.0, 0.5, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])], "frame long, h array<double>")
    got = blend.warp(px, frames, (200_000, 200_000)).collect()
    assert sorted((r["row"], r["col"], r["weight"]) for r in got) == [(150_000, 69_999, 1.0), (150_000, 70_000, 1.0)]


def test_places_without_a_number_have_no_nearest(spark):
    rows = [(0, 1, 0.0, 0.0), (0, 2, 1.0, 0.0), (0, 3, float("nan"), 0.0), (0, 4, None, 1.0), (0, 5, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "g long, id long, x double, y double")
    got = {r["id"]: r["nearest"] for r in grid.nearest_in_group(df, df, ["g"], "id", "id").collect()}
    assert got == {1: 2, 2: 1, 5: 2}


def test_metres_go_back_to_degrees_within_a_millimetre(spark):
    rng = random.Random(1)
    rows = [(rng.uniform(-79, 83), rng.uniform(-180, 179.99)) for _ in range(400)] + [(0.0, 9.0), (45.0, 6.0), (-0.0001, 11.99)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    zone = geo.utm_zone(F.col("lon"))
    east, north = geo.latlon_to_utm(F.col("lat"), F.col("lon"))
    made = df.select("*", zone.alias("zone"), east.alias("x"), north.alias("y"))
    lat, lon = geo.utm_to_latlon(F.col("x"), F.col("y"), F.col("zone"), F.col("lat") >= 0)
    for r in made.select("lat", "lon", lat.alias("a"), lon.alias("b")).collect():
        assert abs(r["lat"] - r["a"]) * 111_000 < 1e-3 and abs(r["lon"] - r["b"]) * 111_000 * math.cos(math.radians(r["lat"])) < 1e-3


def test_lines_within_blocks_need_few_rounds(spark, monkeypatch):
    edges = spark.createDataFrame([(0, k, k + 1) for k in range(1000)], "graph long, src long, dst long")
    written, write = [], lineorder.materialize
    monkeypatch.setattr(lineorder, "materialize", lambda df, name: (written.append(name), write(df, name))[1])
    assert lineorder.line_order(edges).count() == 1001
    # rounds are for the session's few partitions, not for 1,000 arcs
    assert written.count("arcs") <= 7


@pytest.mark.parametrize("block", [8])
def test_lines_across_blocks_equal_those_of_one_block(spark, monkeypatch, block):
    rng = np.random.default_rng(block)
    ring = lambda g, nodes: [(g, int(a), int(b)) for a, b in zip(nodes, np.roll(nodes, 1), strict=True)]
    path = lambda g, nodes: ring(g, nodes)[1:]
    edges = path(0, rng.permutation(40)) + ring(0, 100 + rng.permutation(9)) + ring(0, 200 + rng.permutation(30)) + path(1, np.arange(25)) + path(1, [7, 90, 91]) + path(1, [7, 80])
    frame = spark.createDataFrame(edges + edges[:5] + [(1, 3, 3)], "graph long, src long, dst long")
    got = lambda: {tuple(r) for r in lineorder.line_order(frame).collect()}
    whole = got()
    monkeypatch.setattr(lineorder, "BLOCK", block)
    assert got() == whole
    # lines of 40, 8, 18, 3 and 2 nodes, rings of 9 and 30 whose first node comes twice
    assert sorted(Counter((g, a, b) for g, a, b, _, _ in whole).values()) == [2, 3, 8, 10, 18, 31, 40]
