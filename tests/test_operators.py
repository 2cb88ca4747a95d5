"""Hand-built fixtures and properties."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadweave.functions import camera, geo, shapes
from roadweave.functions import geometry as g
from roadweave.operators import blend, graphs, grid, lanes, linegraph, lineorder, placement, poses
from roadweave.operators.components import connected_components

LOG = "sequence long, x double, heading double"


def test_poses_gap_clamp_and_duplicates(spark):
    log = spark.createDataFrame([(10, 1.0, 3.0), (20, 3.0, -3.0), (20, 5.0, -3.0), (40, 9.0, 0.0)], LOG)
    frames = spark.createDataFrame([(5,), (10,), (15,), (20,), (30,), (50,)], "sequence long")
    # two rows of one sequence keep their order in the log
    log = log.withColumn("n", F.monotonically_increasing_id())
    got = {r["sequence"]: r for r in poses.align(frames.withColumn("n", F.lit(0).cast("long")), log, ["x", "heading"], order="n").collect()}
    assert [got[k]["x"] for k in (5, 10, 15, 20, 30, 50)] == [1.0, 1.0, 2.0, 5.0, 7.0, 9.0]
    assert got[15]["heading"] == pytest.approx(0.0)
    turned = {r["sequence"]: r["heading"] for r in poses.align(frames.withColumn("n", F.lit(0).cast("long")), log, ["heading"], order="n", wrap=("heading",)).collect()}
    assert abs(turned[15]) == pytest.approx(math.pi, abs=1e-6)


def test_alignment_by_ranges_equals_that_by_one_group(spark):
    rng = random.Random(6)
    log = spark.createDataFrame([(rng.randint(0, 4000), rng.random(), k) for k in range(300)], "sequence long, x double, n long")
    frames = spark.createDataFrame([(rng.randint(-50, 4050), k) for k in range(500)], "sequence long, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = poses.align(frames, log, ["x"], order="n")
        assert sorted(map(tuple, ranged.collect())) == sorted(tuple(r)[:3] for r in poses.align(frames.withColumn("d", F.lit(1)), log.withColumn("d", F.lit(1)), ["x"], by=["d"], order="n").select("sequence", "n", "x").collect())
        numbered = poses.frame_numbers(frames, ["sequence", "n"])
        assert [r["frame"] for r in numbered.orderBy("sequence", "n").collect()] == list(range(500))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_poses_without_log_are_null(spark):
    frames = spark.createDataFrame([(1,)], "sequence long")
    assert poses.align(frames, spark.createDataFrame([], "sequence long, x double"), ["x"]).first()["x"] is None


def fold(frames, mode):
    """The sequential definition of the blends."""
    acc = defaultdict(float)
    touched = set()
    for f in sorted(frames):
        covered = {p for p, w in frames[f].items() if sum(w.values()) != 0}
        for p in covered:
            for c in {*frames[f][p], *(k[1] for k in acc if k[0] == p)}:
                w = frames[f][p].get(c, 0.0)
                if mode == "sum":
                    acc[p, c] += w
                elif mode == "enhance":
                    acc[p, c] += w * (2 if p in touched else 1)
                else:
                    acc[p, c] = (acc[p, c] + w) / 2 if p in touched else w
        touched |= covered
    return {k: v for k, v in acc.items() if v}


@pytest.mark.parametrize("mode", ["sum", "enhance", "average"])
def test_blends_equal_the_sequential_fold(spark, mode):
    rng = random.Random(4)
    frames = {f: {(r, c): {rng.randint(0, 3): 1.0} for r in range(4) for c in range(4) if rng.random() < 0.7} for f in range(5)}
    obs = spark.createDataFrame([(f, r, c, k, w) for f, px in frames.items() for (r, c), ws in px.items() for k, w in ws.items()], "frame int, row int, col int, cls int, weight double")
    got = {((r["row"], r["col"]), r["cls"]): r["weight"] for r in blend.blend(obs, mode).collect() if r["weight"]}
    assert got == pytest.approx(fold(frames, mode))


def test_unknown_blend_is_an_error(spark):
    with pytest.raises(ValueError):
        blend.blend(spark.createDataFrame([], "frame int, row int, col int, cls int, weight double"), "other")


def test_window_fits_or_fails(spark):
    assert [r[0] for r in spark.range(-3, 12, 5).select(blend.fit_window(F.col("id").cast("int"), 4, 10)).collect()] == [0, 2, 6]
    with pytest.raises(ValueError):
        blend.fit_window(F.lit(0), 11, 10)


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000))
def test_grid_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pts = [(i, rng.uniform(-2, 2), rng.uniform(-2, 2)) for i in range(60)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    r = rng.choice([0.1, 0.5, 1.3])
    got = {(x["a"], x["b"]) for x in grid.pairs_within(df, df, r).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).collect()}
    assert got == {(a[0], b[0]) for a in pts for b in pts if math.hypot(a[1] - b[1], a[2] - b[2]) <= r}


def test_components_equal_union_find(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(200 + k, 201 + k) for k in range(60)] + [(5, 5), (1, None), (300, 301), (300, 301)]
    parent = {n: n for e in edges for n in e if n is not None}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(find(n) == c for n, c in got.items())
    assert {n for n in parent if sum(find(m) == find(n) for m in parent) > 1} == set(got)
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_dead_ends_leave_no_leaf_beside_a_fork(spark):
    edges = [(0, 1, 2), (0, 2, 3), (0, 3, 4), (0, 2, 5), (0, 3, 6), (0, 3, 7), (1, 1, 2), (2, 1, 9), (2, 2, 9), (2, 3, 9)]
    got = sorted(map(tuple, graphs.remove_dead_ends(spark.createDataFrame(edges, "graph long, src long, dst long")).collect()))
    assert (1, 1, 2) in got and got.count((2, 1, 9)) == 0 and (2, 2, 9) in got
    degree = defaultdict(int)
    for gr, a, b in got:
        degree[gr, a] += 1
        degree[gr, b] += 1
    for gr, a, b in got:
        for fork, leaf in ((a, b), (b, a)):
            assert not (degree[gr, fork] > 2 and degree[gr, leaf] == 1)


def test_blobs_and_junk(spark):
    px = [(0, 0), (1, 1), (2, 0), (5, 5), (5, 6), (9, 9)]
    labels = spark.createDataFrame([(r, c, 3) for r, c in px] + [(7, 7, 0)], "row int, col int, cls int")
    mask = np.zeros((10, 10), bool)
    for p in px:
        mask[p] = True
    want = shapes.label_blobs(mask)
    got = graphs.foreground_blobs(labels.where("cls <> 0")).collect()
    assert {(r["row"], r["col"]): r["area"] for r in got} == {p: int((want == want[p]).sum()) for p in px}
    clean = {(r["row"], r["col"]): r["cls"] for r in graphs.clean_junk(labels, 2).collect()}
    assert clean[(0, 0)] == 3 and clean[(5, 5)] == 0 and clean[(9, 9)] == 0


def test_geodetic_round_trip_and_known_utm(spark):
    rows = [(45.4642, 9.19, 120.0), (-33.86, 151.2, 10.0), (0.1, -179.9, 0.0), (71.0, 25.8, 300.0)]
    df = spark.createDataFrame(rows, "lat double, lon double, h double")
    e, n, u = geo.latlon_to_enu(F.col("lat"), F.col("lon"), F.col("h"), 45.0, 9.0, 50.0)
    lat, lon, h = geo.enu_to_latlon(F.col("e"), F.col("n"), F.col("u"), 45.0, 9.0, 50.0)
    for r in df.withColumns({"e": e, "n": n, "u": u}).withColumns({"a": lat, "b": lon, "c": h}).collect():
        assert (r["a"], r["b"], r["c"]) == (pytest.approx(r["lat"], abs=1e-6), pytest.approx(r["lon"], abs=1e-6), 0.0)
    east, north = geo.latlon_to_utm(F.col("lat"), F.col("lon"))
    got = spark.createDataFrame([(0.0, 3.0), (43.642566, -79.387139)], "lat double, lon double").select(east, north, geo.utm_zone(F.col("lon"))).collect()
    assert tuple(got[0])[:2] == (pytest.approx(500_000), pytest.approx(0, abs=1e-6))
    assert tuple(got[1]) == (pytest.approx(630084, abs=1), pytest.approx(4833438, abs=1), 17)


def test_rectangles_overlap_and_circles():
    sq = np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float)
    assert not shapes.convex_overlap(sq, sq) and not shapes.convex_overlap(sq, sq * 0.25 + 0.5)
    assert shapes.convex_overlap(sq, sq + 1) and not shapes.convex_overlap(sq, sq + 2)
    assert shapes.overlap_share(sq, sq + 1) == pytest.approx(0.25)
    a = np.deg2rad(30)
    turn = np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
    pts = np.array([[x, y] for x in np.linspace(0, 5, 9) for y in np.linspace(0, 1, 4)]) @ turn.T
    assert shapes.polygon_area(shapes.min_area_rectangle(pts)) == pytest.approx(5.0)
    assert shapes.circle_of((1, 0), (0, 1), (-1, 0)) == pytest.approx((0, 0, 1)) and shapes.circle_of((0, 0), (1, 1), (2, 2)) is None
    assert shapes.sector(np.array([[1, 0], [0, 1], [-1, 0]]), (0, 0)) == pytest.approx(180)
    noisy = np.arange(20) + np.random.default_rng(0).normal(0, 0.3, 20)
    assert np.abs(np.diff(shapes.smooth(noisy, 50), 2)).max() < np.abs(np.diff(noisy, 2)).max()


def grid_graph(k=4, cls=3):
    gr = linegraph.Graph()
    for i in range(k):
        for j in range(k):
            gr.add(i * k + j, float(i), float(j), cls)
    for i in range(k):
        for j in range(k):
            if i + 1 < k:
                gr.connect(i * k + j, (i + 1) * k + j)
            if j + 1 < k:
                gr.connect(i * k + j, i * k + j + 1)
    return gr


def line(n, start=0, cls=1, y=0.0):
    gr = linegraph.Graph()
    for k in range(n):
        gr.add(start + k, float(k), y, cls)
        if k:
            gr.connect(start + k - 1, start + k)
    return gr


def test_cycle_basis_has_one_cycle_for_each_extra_edge():
    gr = grid_graph(4)
    basis = shapes.cycle_basis(gr.adj)
    assert len(basis) == sum(map(len, gr.adj.values())) // 2 - len(gr.nodes) + 1
    for c in basis:
        assert all(b in gr.adj[a] for a, b in zip(c, c[1:] + c[:1], strict=True))


def test_cluster_becomes_a_box():
    gr = grid_graph(6)
    out = linegraph.box_replace(min_cluster_size=4)(gr)
    box = out[-1]
    assert box.type == "box" and len(box.nodes) == 4 and box.nodes[0][2] == 3
    assert linegraph.box_replace(min_cluster_size=4, replace_only=[9])(gr) == [gr]
    assert linegraph.box_replace()(box) == [box]


def test_small_cycles_flatten_and_forks_go():
    gr = line(6)
    gr.add(10, 2.5, 0.5, 1)
    gr.connect(10, 2)
    gr.connect(10, 3)
    flat = linegraph.cycle_flatten()(gr)[0]
    assert not shapes.cycle_basis(flat.adj) and 10 in flat.nodes
    y = line(9)
    y.add(20, 4.0, 1.0, 1)
    y.connect(20, 4)
    parts = linegraph.fork_remove()(y)
    assert [len(p.nodes) for p in parts] == [9]
    assert len(linegraph.fork_remove(max_len=0)(y)[0].nodes) == 10
    assert sorted(linegraph.dead_end_remove()(y)[0].nodes) == list(range(9))


def test_circle_is_closed_and_noise_left_alone():
    rng = np.random.default_rng(1)
    ring = linegraph.Graph()
    for k in range(30):
        a = 2 * np.pi * k / 36
        ring.add(k, 5 * np.cos(a) + rng.normal(0, 0.02), 5 * np.sin(a) + rng.normal(0, 0.02), 2)
        if k:
            ring.connect(k - 1, k)
    [out] = linegraph.auto_circle()(ring)
    assert out.type == "circle" and all(len(v) == 2 for v in out.adj.values())
    r = np.hypot(*out.xy(out.nodes).T)
    assert np.abs(r - 5).max() < 0.1
    straight = line(30)
    assert linegraph.auto_circle()(straight) == [straight]


def test_fit_replaces_a_cluster_and_keeps_its_neighbours():
    gr = grid_graph(5)
    gr.add(100, 10.0, 2.0, 3)
    gr.connect(100, 22)
    [out] = linegraph.fit_replace(min_nodes=5, sample_dist=0.5)(gr)
    assert 100 in out.nodes and len(out.adj[100]) == 1 and len(out.components()) == 1


def test_smoothing_moves_inner_nodes_only():
    gr = line(12)
    gr.nodes[5] = (5.0, 2.0, 1, None)
    [out] = linegraph.line_smooth(5.0, max_angle_delta_deg=179)(gr)
    assert out.nodes[0] == gr.nodes[0] and out.nodes[11] == gr.nodes[11] and 0 < out.nodes[5][1] < 2
    assert linegraph.line_smooth(5.0)(line(4))[0].nodes == line(4).nodes
    with pytest.raises(ValueError):
        linegraph.line_smooth(0)


def test_lines_cover_every_edge_once():
    for gr in (grid_graph(3), line(5)):
        lines = linegraph.lines_of(gr)
        used = [tuple(sorted(e)) for path in lines for e in zip(path, path[1:], strict=False)]
        assert len(used) == len(set(used)) == sum(map(len, gr.adj.values())) // 2
    ring = line(6)
    ring.connect(5, 0)
    [path] = linegraph.lines_of(ring)
    assert path[0] == path[-1] == 0 and len(path) == 7


def tables(spark, graph_list):
    n = [(k, i, x, y, c, f, gr.type) for k, gr in enumerate(graph_list) for i, (x, y, c, f) in gr.nodes.items()]
    e = [(k, a, b) for k, gr in enumerate(graph_list) for a in gr.adj for b in gr.adj[a] if a < b]
    return spark.createDataFrame(n, "graph long, node long, x double, y double, cls int, fallback int, type string"), spark.createDataFrame(e, "graph long, src long, dst long")


def test_stack_over_tables(spark):
    nodes, edges = tables(spark, [grid_graph(6), line(8), line(2)])
    rows = linegraph.process(linegraph.to_rows(nodes, edges), linegraph.box_replace(min_cluster_size=4), linegraph.drop_short(4))
    got = linegraph.nodes_of(rows).groupBy("graph", "part", "type").count().collect()
    assert {(r["graph"], r["type"], r["count"]) for r in got} >= {(0, "box", 4), (1, None, 8)}
    assert not [r for r in got if r["graph"] == 2]


def test_large_graphs_are_clustered_by_tables_as_in_one_pass(spark, monkeypatch):
    rng = random.Random(4)
    made = []
    for size, reach in ((90, 0.13), (60, 0.02), (70, 0.2)):
        gr = linegraph.Graph()
        for n in rng.sample(range(1000), size):
            gr.add(n, rng.random(), rng.random(), rng.randrange(3))
        for a in gr.nodes:
            for b in gr.nodes:
                if a < b and np.hypot(*np.diff(gr.xy([a, b]), axis=0)[0]) <= reach:
                    gr.connect(a, b)
        made.append(gr)
    nodes, edges = tables(spark, [*made, linegraph.box_replace(min_cluster_size=4)(grid_graph(6))[-1]])
    rows = linegraph.to_rows(nodes, edges)
    for stack in ([linegraph.box_replace(), linegraph.cycle_flatten(), linegraph.fork_remove(), linegraph.drop_short(2)], [linegraph.box_replace(replace_only=[1])]):
        got = lambda: sorted(map(tuple, linegraph.process(rows, *stack).collect()), key=str)  # noqa: B023, E731
        monkeypatch.setattr(linegraph, "WHOLE_ROWS", 200_000)
        want = got()
        monkeypatch.setattr(linegraph, "WHOLE_ROWS", 0)
        assert got() == want and len({r[:2] for r in want}) >= 4 and {r[9] for r in want} == {None, "box"}


def test_linestrings_cut_at_class_forks_and_splits(spark):
    a = line(6)
    for k in (3, 4, 5):
        a.nodes[k] = (*a.nodes[k][:2], 4, None)
    nodes, edges = tables(spark, [a, line(5)])
    got = defaultdict(list)
    for r in lineorder.linestrings(nodes, edges, spark.createDataFrame([(1, 2)], "graph long, node long")).collect():
        got[r["graph"]].append((list(r["nodes"]), r["cls"]))
    assert sorted(got[1]) == [([0, 1, 2], 1), ([2, 3, 4], 1)]
    assert len(got[0]) == 2


def test_points_of_interest(spark):
    a = line(5)
    a.nodes[3] = (3.0, 0.0, 2, None)
    a.add(9, 1.0, 1.0, 1)
    a.connect(9, 1)
    nodes, edges = tables(spark, [a])
    got = {(r["node"], r["reason"]) for r in linegraph.points_of_interest(nodes, edges, 30.0).collect()}
    assert {(0, "end"), (4, "end"), (9, "end"), (1, "fork"), (2, "class"), (3, "class"), (4, "class")} <= got


def test_heads_connect_until_none_is_left(spark):
    shifted = lambda dx: [(i, x + dx, y, c) for i, (x, y, c, _) in line(3).nodes.items()]
    n = [(k, i, x, y, c) for k, dx in ((0, 0.0), (1, 2.4), (2, 4.8), (3, 50.0)) for i, x, y, c in shifted(dx)]
    e = [(k, i, i + 1) for k in range(4) for i in range(2)]
    nodes, edges = linegraph.connect_heads(spark.createDataFrame(n, "graph long, node long, x double, y double, cls int"), spark.createDataFrame(e, "graph long, src long, dst long"), 0.5)
    assert {(r["old_graph"], r["graph"]) for r in nodes.collect()} == {(0, 0), (1, 0), (2, 0), (3, 3)}
    assert edges.count() == 10


def test_splits_propagate_between_parallel_lines(spark):
    rows = [(k, i, float(i), 3.5 * k, 1.0, 0.0) for k in range(3) for i in range(10)]
    nodes = spark.createDataFrame(rows, "graph long, node long, x double, y double, dx double, dy double")
    seen, rel = lanes.propagate_splits(nodes, spark.createDataFrame([(0, 4)], "graph long, node long"), 1.5, 6.0, 0.3)
    assert {(r["graph"], r["node"]) for r in seen.collect()} == {(0, 4), (1, 4), (2, 4)}
    pairs = {tuple(r) for r in rel.collect()}
    assert (0, 4, 1, 4) in pairs and (1, 4, 0, 4) in pairs


def test_lanes_pair_orient_and_repair(spark):
    lines = spark.createDataFrame([(1, 10, 20, 0.0, 0.0, 10.0, 0.0, 5.0, 0.0), (2, 20, 10, 0.0, 3.5, 10.0, 3.5, 5.0, 3.5), (3, 10, 20, 0.0, 0.5, 10.0, 0.5, 5.0, 0.5)], "ls long, start_graph long, end_graph long, sx double, sy double, ex double, ey double, cx double, cy double")
    pairs = lanes.pair(lines, 2.0)
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (2, 3)]
    assert (3, 2) in {tuple(r) for r in lanes.orient(pairs, lines).collect()}
    assert lanes.distinct_lanes(spark.createDataFrame([(1, 2), (2, 1)], "right_ls long, left_ls long")).count() == 1


def test_holes_are_merged_head_to_tail_only(spark):
    line = lambda ls, nodes, y=0.0, graph=0, cls=1, turn=1: (ls, graph, cls, nodes, [(float(n), y) for n in nodes][::turn])
    rows = [
        line(1, list(range(10, 30))), line(2, [29, 30, 31]), line(3, [31, 32]), line(4, [8, 9, 10]),  # after, after that, and before
        line(5, [40, 29]), line(6, [29, 41], cls=2), line(7, [29, 42], graph=1), line(8, list(range(29, 39))),  # the other way, class, graph, too long
    ]
    df = spark.createDataFrame(rows, "ls long, graph long, cls int, nodes array<long>, xy array<struct<x:double,y:double>>")
    got = {r["ls"]: r["nodes"] for r in lanes.repair_holes(df, spark.createDataFrame([(1, 1)], "right_ls long, left_ls long")).collect()}
    assert got[1] == list(range(8, 33)) and set(got) == {1, 5, 6, 7, 8}
    bent = [line(1, [0, 1, 2]), (2, 0, 1, [2, 3], [(2.0, 0.0), (3.0, 0.2)])]
    df = spark.createDataFrame(bent, df.schema)
    assert lanes.repair_holes(df, spark.createDataFrame([(1, 1)], "right_ls long, left_ls long")).count() == 2


def test_common_area_of_any_rings():
    rng = np.random.default_rng(2)
    for _ in range(30):
        a, b = (np.column_stack([np.cos(t), np.sin(t)]) * rng.uniform(0.3, 2, (9, 1)) + rng.normal(0, 0.4, 2) for t in [np.linspace(0, 2 * np.pi, 9, endpoint=False)] * 2)
        assert shapes.is_simple(a) and shapes.common_area(a, a) == pytest.approx(shapes.polygon_area(a))
        x, y = rng.uniform(-3, 3, (2, 40_000))
        inside = lambda r: sum(((p[1] > y) != (q[1] > y)) & (x < p[0] + (y - p[1]) / (q[1] - p[1] + 1e-300) * (q[0] - p[0])) for p, q in zip(r, np.roll(r, -1, axis=0), strict=True)) % 2 == 1
        assert shapes.common_area(a, b) == pytest.approx(36 * (inside(a) & inside(b)).mean(), abs=0.15)
    assert not shapes.is_simple(np.array([[0, 0], [2, 2], [2, 0], [0, 2]], float))


def test_contours_enclose_holes_and_cut_corners():
    square = np.ones((4, 4), bool)
    ring = square.copy()
    ring[1:3, 1:3] = False
    assert shapes.contour_area(square) == shapes.contour_area(ring) == 9.0
    assert shapes.contour_area(np.eye(5, dtype=bool)) == shapes.contour_area(np.ones((1, 7), bool)) == 0.0
    diamond = np.array([[0, 1, 0], [1, 1, 1], [0, 1, 0]], bool)
    assert shapes.contour_area(diamond) == 2.0 and shapes.contour_area(np.zeros((2, 2), bool)) == 0.0


def test_smoothing_along_diagonals_equals_the_dense_solution():
    for n in (3, 4, 5, 30):
        y, d = np.random.default_rng(n).normal(size=n), np.diff(np.eye(n), 2, axis=0)
        assert shapes.smooth(y, 7.0) == pytest.approx(np.linalg.solve(np.eye(n) + 7.0 * d.T @ d, y))
    assert np.abs(shapes.smooth(np.tile([0.0, 1.0], 50_000), 50.0) - 0.5)[100:-100].max() < 0.01


def road(spark, graphs_=4, n=14, gap=3.5, cls=1):
    nodes = [(k, i, 2.0 * i, gap * k, cls) for k in range(graphs_) for i in range(n)]
    edges = [(k, i, i + 1) for k in range(graphs_) for i in range(n - 1)]
    return spark.createDataFrame(nodes, "graph long, node long, x double, y double, cls int"), spark.createDataFrame(edges, "graph long, src long, dst long")


def test_lane_search_finds_the_lanes_of_a_road(spark):
    nodes, edges = road(spark)
    # the second line changes its class half-way, which cuts all lines there
    nodes = nodes.withColumn("cls", F.when((F.col("graph") == 1) & (F.col("node") >= 7), 2).otherwise(F.col("cls")))
    found = lanes.find_lanes(nodes, edges, 1.5, 5.0, 0.5)
    assert found.splits.where("round > 0").count() > 0
    at = {r["ls"]: (r["graph"], r["nodes"][0], r["nodes"][-1]) for r in found.lines.collect()}
    pairs = {frozenset(at[x][0] for x in (r["right_ls"], r["left_ls"])) for r in found.lanes.collect()}
    assert pairs == {frozenset({0, 1}), frozenset({1, 2}), frozenset({2, 3})}
    for r in found.lanes.collect():
        (_, a, b), (_, c, d) = at[r["right_ls"]], at[r["left_ls"]]
        # at the change of class either of its two nodes is the cut
        assert all(abs(p - q) <= 1 for p, q in zip(sorted((a, b)), sorted((c, d)), strict=True))
    points, ways, lanelets = lanes.map_elements(found, nodes.withColumn("ele", F.lit(None).cast("double")), (100.0, 50.0, 7.0))
    assert points.count() == 56 and points.agg(F.min("x"), F.max("ele")).first() == (-100.0, 0.0)
    ids = {r["id"] for r in points.collect()}
    assert all(set(r["nodes"]) <= ids for r in ways.collect()) and lanelets.count() == found.lanes.count() > 3
    none = lanes.find_lanes(nodes, edges, 1.5, 5.0, 0.5, [1, 2])
    assert none.lanes.count() == 0


def test_the_direction_travels_with_the_split(spark):
    # the middle line's own nodes have odd directions of their own, as on a noisy line
    nodes, edges = road(spark, 3)
    aimed = nodes.drop("cls").withColumns({"dx": F.when(F.col("graph") == 1, 0.0).otherwise(1.0), "dy": F.when(F.col("graph") == 1, 1.0).otherwise(0.0)})
    seen, _ = lanes.propagate_splits(aimed, spark.createDataFrame([(0, 4, 1.0, 0.0)], "graph long, node long, dx double, dy double"), 1.5, 5.0, 0.5, edges=edges)
    assert {(r["graph"], r["node"]) for r in seen.collect()} == {(0, 4), (1, 4), (2, 4)}


def splits_by_hand(nodes, edges, sources, least, most, tolerance, max_degrees, path_len):
    """The rules of the propagation, node by node, round by round."""
    adj = defaultdict(set)
    for gr, a, b in edges:
        adj[gr, a].add(b)
        adj[gr, b].add(a)

    def close(gr, n):
        seen, level = {n}, {n}
        for _ in range(path_len - 1):
            level = {m for k in level for m in adj[gr, k]} - seen
            seen |= level
        return seen

    seen, relations = {}, set()
    frontier = {k: nodes[k][2:] for k in sources}
    for r in range(1000):
        seen |= {k: r for k in frontier}
        reached = {}
        for (gr, n), (dx, dy) in sorted(frontier.items()):
            x, y = nodes[gr, n][:2]
            size = math.hypot(dx, dy)
            ux, uy = dx / size, dy / size
            found = defaultdict(list)
            for (g2, m), (px, py, *_) in nodes.items():
                d = math.hypot(px - x, py - y)
                if (g2, m) == (gr, n) or not least <= d <= most:
                    continue
                along, across = (px - x) * ux + (py - y) * uy, (py - y) * ux - (px - x) * uy
                off = math.hypot(along, max(0.0, abs(across) - most))
                arms = [(nodes[g2, k][0] - px, nodes[g2, k][1] - py) for k in adj[g2, m]]
                if off > tolerance or not any(abs(a * ux + b * uy) / math.hypot(a, b) >= math.cos(math.radians(max_degrees)) for a, b in arms):
                    continue
                beside = [k for k in adj[g2, m] if (g2, k) in seen]
                to = min(beside) if beside else m
                if (g2, to) != (gr, n):
                    found[g2].append((off * d, to))
            for g2, candidates in found.items():
                taken = []
                for _, m in sorted(candidates):
                    if not close(g2, m) & set(taken):
                        taken.append(m)
                for m in taken:
                    relations |= {(gr, n, g2, m), (g2, m, gr, n)}
                    reached[g2, m] = min(reached.get((g2, m), ((gr, n), (dx, dy))), ((gr, n), (dx, dy)))
        frontier = {k: v for k, (_, v) in reached.items() if k not in seen}
        if not frontier:
            return seen, relations


@pytest.mark.parametrize("seed", [1, 2])
def test_splits_equal_those_by_hand(spark, seed):
    rng = random.Random(seed)
    nodes = {(k, 20 * k + i): (1.5 * i + rng.uniform(-0.3, 0.3), 2.6 * k + rng.uniform(-0.4, 0.4), 1.0, rng.uniform(-0.2, 0.2)) for k in range(5) for i in range(12)}
    edges = [(k, 20 * k + i, 20 * k + i + 1) for k in range(5) for i in range(11)]
    sources = [(0, 3), (2, 48), (4, 91)]
    want = splits_by_hand(nodes, edges, sources, 1.2, 4.5, 0.5, 70.0, 5)
    df = spark.createDataFrame([(*k, *v) for k, v in nodes.items()], "graph long, node long, x double, y double, dx double, dy double")
    seen, relations = lanes.propagate_splits(df, spark.createDataFrame(sources, "graph long, node long"), 1.2, 4.5, 0.5, edges=spark.createDataFrame(edges, "graph long, src long, dst long"))
    assert {(r["graph"], r["node"]): r["round"] for r in seen.collect()} == want[0]
    assert {tuple(r) for r in relations.collect()} == want[1] and len(want[0]) > 5


def test_splits_without_relations_are_found_by_least_sources(spark, monkeypatch):
    # points all over a field, so that lines come near each other and themselves
    rng = random.Random(1)
    nodes = {(k, 40 * k + i): (rng.uniform(0, 5), rng.uniform(0, 5), rng.uniform(-1, 1), rng.uniform(-1, 1)) for k in range(2) for i in range(30)}
    edges = [(k, 40 * k + i, 40 * k + i + 1) for k in range(2) for i in range(29)]
    sources = [(k, 40 * k + i) for k in range(2) for i in (3, 9, 15)]
    want = splits_by_hand(nodes, edges, sources, 0.6, 3.0, 0.6, 70.0, 5)[0]
    monkeypatch.setattr(lanes, "LEAST_FIRST", 0)
    monkeypatch.setattr(lanes, "FIRST_SOURCES", 2)
    df = spark.createDataFrame([(*k, *v) for k, v in nodes.items()], "graph long, node long, x double, y double, dx double, dy double")
    seen, relations = lanes.propagate_splits(df, spark.createDataFrame(sources, "graph long, node long"), 0.6, 3.0, 0.6, edges=spark.createDataFrame(edges, "graph long, src long, dst long"), with_relations=False)
    assert {(r["graph"], r["node"]): r["round"] for r in seen.collect()} == want
    assert relations is None and len(want) > len(sources)


def test_late_rounds_of_splits_look_only_about_their_sources(spark, monkeypatch):
    nodes = {(k, 20 * k + i): (1.5 * i, 2.6 * k, 1.0, 0.0) for k in range(9) for i in range(12) if i < 9 or k < 3}
    edges = [(k, 20 * k + i, 20 * k + i + 1) for k in range(9) for i in range(11) if i < 8 or k < 3]
    want = splits_by_hand(nodes, edges, [(0, 4)], 1.2, 4.5, 0.5, 70.0, 5)
    df = spark.createDataFrame([(*k, *v) for k, v in nodes.items()], "graph long, node long, x double, y double, dx double, dy double")
    scan, met = grid.scan_line, []
    monkeypatch.setattr(grid, "scan_line", lambda left, right, *a: (met.append(right.count()), scan(left, right, *a))[1])
    monkeypatch.setattr(lanes, "MANY_NODES", 0)
    monkeypatch.setattr(lanes, "HORIZON", 1)
    seen, relations = lanes.propagate_splits(df, spark.createDataFrame([(0, 4)], "graph long, node long"), 1.2, 4.5, 0.5, edges=spark.createDataFrame(edges, "graph long, src long, dst long"))
    assert {(r["graph"], r["node"]): r["round"] for r in seen.collect()} == want[0]
    assert {tuple(r) for r in relations.collect()} == want[1] and max(want[0].values()) > 3
    assert met[0] < len(nodes) / 2


def test_rings_cross_themselves_as_one_by_one():
    rings = np.random.default_rng(3).uniform(0, 1, (300, 6, 2))
    crossed = shapes.cross_themselves(rings)
    assert 0 < crossed.sum() < 300 and [not x for x in crossed] == [shapes.is_simple(r) for r in rings]


def test_lane_sides_follow_annotations(spark):
    lines = spark.createDataFrame([(1, 0, 0, 9, 0.0, 0.0), (2, 1, 5, 6, 0.0, 3.0)], "ls long, graph long, first long, last long, cx double, cy double")
    rel = lanes.symmetric(spark.createDataFrame([(0, 0, 1, 5), (0, 9, 1, 6)], "graph long, node long, other_graph long, other_node long"))
    sides = lambda s: spark.createDataFrame([(1, 5, s)], "graph long, node long, side string")
    got = lambda *a: [tuple(r) for r in lanes.pair_by_relations(lines, rel, 2.0, *a).collect()]
    assert got() == got(sides("left")) == [(1, 2)] and got(sides("right")) == [(2, 1)]


def test_elevation_fills_to_a_fixed_point(spark):
    n = spark.createDataFrame([(0, 0.0, 0.0, 5.0), (1, 1.0, 0.0, None), (2, 2.0, 0.0, None), (3, 50.0, 0.0, None)], "node long, x double, y double, ele double")
    assert {r["node"]: r["ele"] for r in lanes.fill_elevation(n, 1.0).collect()} == {0: 5.0, 1: 5.0, 2: 5.0, 3: None}


def test_elevation_fills_a_chain_of_more_than_100_nodes(spark):
    n = spark.createDataFrame([(k, float(k), 0.0, None if k else 5.0) for k in range(103)], "node long, x double, y double, ele double")
    assert lanes.fill_elevation(n, 1.0).where("ele = 5").count() == 103


def test_splits_propagate_over_more_than_50_lines(spark):
    nodes = spark.createDataFrame([(k, 0, 0.0, 3.5 * k, 1.0, 0.0) for k in range(53)], "graph long, node long, x double, y double, dx double, dy double")
    seen, _ = lanes.propagate_splits(nodes, spark.createDataFrame([(0, 0)], "graph long, node long"), 1.5, 6.0, 0.3)
    assert {(r["graph"], r["round"]) for r in seen.collect()} == {(k, k) for k in range(53)}


def test_splits_reach_parallel_lines_of_one_graph(spark):
    at = lambda graph, first, y: [(graph, first + i, float(i), y, 1.0, 0.0) for i in range(10)]
    nodes = spark.createDataFrame(at(0, 0, 3.5) + at(0, 10, 0.0) + at(1, 0, 1.75), "graph long, node long, x double, y double, dx double, dy double")
    edges = spark.createDataFrame([(k, a + i, a + i + 1) for k, a in ((0, 0), (0, 10), (1, 0)) for i in range(9)] + [(0, 0, 10)], "graph long, src long, dst long")
    start = lambda graph, node: spark.createDataFrame([(graph, node)], "graph long, node long")
    found = lambda out: {tuple(r) for r in out[1].collect()}
    assert found(lanes.propagate_splits(nodes.where("graph = 0"), start(0, 8), 1.5, 4.0, 0.3)) == {(0, 8, 0, 18), (0, 18, 0, 8)}
    # a line between the arms of the fork cuts both, but only one where they are fewer than five steps apart
    assert {(1, 8, 0, 8), (1, 8, 0, 18)} <= found(lanes.propagate_splits(nodes, start(1, 8), 1.5, 2.0, 0.3, edges=edges))
    assert found(lanes.propagate_splits(nodes, start(1, 1), 1.5, 2.0, 0.3, edges=edges)) == {(1, 1, 0, 1), (0, 1, 1, 1)}


def test_hops_reach_all_nodes_or_as_many_steps_as_asked(spark):
    edges, start = spark.createDataFrame([(k, k + 1) for k in range(54)], "src long, dst long"), spark.createDataFrame([(0,)], "node long")
    assert {(r["node"], r["hop"]) for r in graphs.hops(edges, start).collect()} == {(k, k) for k in range(55)}
    assert graphs.hops(edges, start, 3).count() == 4


def test_rectangle_lines_and_annotations(spark):
    shape = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (0.0, 1.0)])], "graph long, corners array<struct<x:double,y:double>>")
    r = lanes.rectangle_lines(shape).first()
    assert sorted((p["x"], p["y"]) for p in r["middle"]) == [(0.0, 0.5), (4.0, 0.5)]
    nodes = spark.createDataFrame([(0, 1), (0, 2)], "graph long, node long")
    out = lanes.annotate(nodes, spark.createDataFrame([(5, 0, [1, 2])], "ls long, graph long, nodes array<long>"), spark.createDataFrame([(9, 5, 6)], "lane long, right_ls long, left_ls long")).first()
    assert (out["linestrings"], out["lanelets"]) == ([5], [9])


def test_bird_view_agrees_with_projection(spark):
    cam = camera.Pinhole(500, 500, 320, 240, (0.5, 0.1, 1.6), 0.02, 0.05, 0.01)
    bird = camera.BirdView(cam, (4.0, 24.0, -5.0, 5.0), 0.05)
    assert bird.size == (400, 200)
    px = np.array([[10.0, 20.0], [150.0, 399.0]])
    ground = np.column_stack([px, np.ones(2)]) @ bird.pixel_to_world.T
    img = cam.project(np.column_stack([ground[:, :2], np.zeros(2)]))
    assert bird.bird_to_image(px) == pytest.approx(img) and bird.image_to_bird(img) == pytest.approx(px)
    ray = cam.direction(img)[0]
    assert np.cross(ray, [ground[0, 0] - 0.5, ground[0, 1] - 0.1, -1.6]) == pytest.approx([0, 0, 0], abs=1e-9)
    assert np.isnan(cam.project(np.array([[-5.0, 0, 0]]))).all() and 0 < bird.coverage(640, 480).mean() <= 1
    u, v = camera.project_columns(cam, F.lit(float(ground[0, 0])), F.lit(float(ground[0, 1])), F.lit(0.0))
    assert tuple(spark.range(1).select(u, v).first()) == pytest.approx(tuple(img[0]))
    # the window's furthest left corner is pixel 1, its nearest right one the last and one more
    corner = lambda x, y: (bird.world_to_pixel @ [x, y, 1])[:2]
    assert corner(24.0, 5.0) == pytest.approx([1, 1]) and corner(4.0, -5.0) == pytest.approx([200, 400])
    sheared = camera.BirdView(cam, bird.view, 0.05, (0.1, 0.0))
    assert (sheared.world_to_pixel @ [24.0, 5.0, 1])[:2] == pytest.approx([1 + 0.1 - 0.1 * 200 / 2, 1])


def test_panoramic_head(spark):
    head = camera.head_of(500, 500, 320, 240, [0, 0, 2.0], [0.1, 0, 0], [0.0, 0.0, 0.0])
    # level: ahead of the vehicle is the depth axis of the image, left of it is left, up is up
    ahead, left, up = (head.extrinsics[:, :3] @ v for v in np.eye(3))
    assert ahead == pytest.approx([1, 0, 0]) or ahead == pytest.approx([0, 0, 1]) or ahead == pytest.approx([-1, 0, 0])
    assert head.extrinsics[:, :3] @ head.extrinsics[:, :3].T == pytest.approx(np.eye(3))
    turned = head.turned((0.0, 0.0, np.pi / 2))
    assert turned.extrinsics[:, :3] != pytest.approx(head.extrinsics[:, :3])
    # the camera's place on the head keeps the built-in rotation, the head's place on the vehicle turns with the view
    shift = turned.extrinsics[:, 3] - camera.HEAD_TO_CAMERA @ (np.linalg.inv(camera.HEAD_TO_CAMERA) @ turned.extrinsics[:, :3] @ [0, 0, -2.0])
    assert shift == pytest.approx(head.extrinsics[:, 3] - head.extrinsics[:, :3] @ [0, 0, -2.0])


def warped(frame, angle, centre, at, shape):
    """An inverse warp of a dense frame, pixel by pixel."""
    out = {}
    c, s = math.cos(angle), math.sin(angle)
    for j in range(shape[0]):
        for i in range(shape[1]):
            u, v = i - at[0], j - at[1]
            col, row = math.floor(c * u - s * v + centre[0] + 0.5), math.floor(s * u + c * v + centre[1] + 0.5)
            if (row, col) in frame:
                out[j, i] = frame[row, col]
    return out


@pytest.mark.parametrize("degrees", [0.0, 33.0, 90.0, 181.5])
def test_frames_are_placed_as_an_inverse_warp_places_them(spark, degrees):
    rng = random.Random(int(degrees))
    frame = {(r, c): rng.randint(1, 4) for r in range(9) for c in range(14)}
    obs = spark.createDataFrame([(3, r, c, k, 1.0) for (r, c), k in frame.items()], "frame int, row int, col int, cls int, weight double")
    at = spark.createDataFrame([(3, 10.37, -4.11, math.radians(degrees), 8.0, 0.5, 60, 70)], "frame int, x double, y double, angle double, tl_x double, tl_y double, h_px int, w_px int")
    got = {(r["row"], r["col"]): r["cls"] for r in placement.on_map(obs, at, 0.1, (7.2, 4.3)).collect()}
    assert got == warped(frame, math.radians(degrees), (7.2, 4.3), ((10.37 - 8.0) / 0.1, (0.5 + 4.11) / 0.1), (60, 70))


def test_angles_anchors_and_map_chunks(spark):
    frames = spark.createDataFrame([(0, 0.0, 0.0, 0.5), (1, 1.0, 1.0, 0.6), (2, 1.0, 1.0, 0.7), (3, 0.0, 1.0, 0.8)], "frame int, x double, y double, heading double")
    angle = lambda mode: [round(r["angle"], 6) for r in placement.frame_angles(frames, mode, -90.0).orderBy("frame").collect()]
    q = math.pi / 2
    assert angle("estimated") == [round(a - q, 6) for a in (0, math.pi / 4, 0, math.pi)]
    assert angle("gps") == [round(a - q, 6) for a in (0.5, 0.6, 0.7, 0.8)] and set(angle("only_offset")) == {round(-q, 6)}
    e = placement.anchors(frames.withColumn("chunk", F.lit(0)), ["chunk"], 50, 70, 0.1, 0.2).first()
    assert (e["tl_x"], e["tl_y"], e["br_x"], e["br_y"], e["h_px"], e["w_px"]) == (-3.0, 3.0, 4.0, -2.0, 50, 70)
    obs = spark.createDataFrame([(f, 25, 35, 1, 1.0) for f in range(4)], "frame int, row int, col int, cls int, weight double")
    px, chunks = placement.build_map(obs, frames, (50, 70), 0.1, (35, 25), "only_offset", 0.0, 0.0, 2)
    assert chunks.count() == 2 and px.agg(F.sum("weight")).first()[0] == 4.0
    assert placement.build_map(obs, frames, (50, 70), 0.1, (35, 25), "only_offset", 0.0, 0.0, 2, 1)[0].select("chunk").distinct().count() == 1


def test_regions_are_moved_into_the_map_or_fail(spark):
    px = spark.createDataFrame([(0, r, c, 1, 1.0) for r in range(40) for c in range(60)], "chunk int, row int, col int, cls int, weight double")
    chunks = spark.createDataFrame([(0, 0.0, 4.0, 6.0, 0.0, 40, 60)], "chunk int, tl_x double, tl_y double, br_x double, br_y double, h_px int, w_px int")
    at = spark.createDataFrame([(1, 3.0, 2.0, 0.0), (2, 5.9, 3.9, 0.0), (3, 9.0, 2.0, 0.0)], "frame int, x double, y double, angle double")
    got = placement.regions(px, chunks, at, (2.0, 1.0), 0.1)
    assert {r["frame"]: (r["count"], round(r["x"], 6), round(r["y"], 6)) for r in got.groupBy("frame").agg(F.count("*").alias("count"), F.min("tl_x").alias("x"), F.min("tl_y").alias("y")).collect()} == {1: (200, 2.0, 2.5), 2: (200, 4.0, 4.0)}
    assert got.agg(F.min("row"), F.max("row"), F.max("col")).first() == (0, 9, 19)
    with pytest.raises(Exception, match="larger than the map"):
        placement.regions(px, chunks, at, (2.0, 5.0), 0.1).collect()
    mixed = spark.createDataFrame([(1, 0, 0, 0, 5.0), (1, 0, 0, 2, 0.2), (1, 0, 1, 7, 0.4), (1, 0, 2, 3, 0.05)], "frame int, row int, col int, cls int, weight double")
    assert {r["col"]: r["cls"] for r in placement.region_labels(mixed, [], drivable=7).collect()} == {0: 2, 1: 0, 2: 0}


def test_frames_are_cleaned_masked_and_turned(spark):
    px = [(1, r, c, 1) for r in range(4) for c in range(4)] + [(1, 8, 8, 2), (1, 8, 9, 11), (2, 0, 0, 1)]
    df = spark.createDataFrame(px, "frame int, row int, col int, cls int")
    kept = placement.clean_frames(df, 10, 11)
    assert kept.where("cls = 1").count() == 16 and kept.where("cls = 11").count() == 1 and kept.count() == 17
    assert placement.clean_frames(df, 10, 11, (20, 20)).where("cls = 1").count() == 9
    assert placement.clean_frames(df, None).count() == 19
    w = df.withColumn("weight", F.lit(1.0))
    back = placement.turned(placement.turned(w, (10, 10), 90.0), (10, 10), -90.0)
    assert {tuple(r) for r in back.select("frame", "row", "col", "cls").collect()} <= {tuple(r) for r in df.collect()}
    assert placement.cropped(w, 8, 10, 8, 10).select("row", "col").orderBy("col").collect()[1] == (0, 1)
    frames = spark.createDataFrame([(1, math.pi / 2), (2, 0.0)], "frame int, angle double")
    assert placement.mask_vehicle(df, frames, (10, 10), [(0, 4, 0, 4)]).where("frame = 1 and cls = 1").count() == 12
    assert placement.mask_vehicle(df, frames, (10, 10), [(0, 4, 0, 4)]).where("frame = 2").count() == 0


def test_natural_order(spark):
    names = ["img10.png", "img2.png", "IMG1.png", "a", "img02b.png"]
    got = [r["n"] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(g.natural_key(F.col("n")), "n").collect()]
    assert got == ["a", "IMG1.png", "img2.png", "img02b.png", "img10.png"]


def test_elevation_of_dense_nodes_looks_at_few(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, float(x), float(y), float(i) if i % 2 else None) for i, (x, y) in enumerate(rng.random((600, 2)) * 3)] + [(7, 0.5, 0.5, 70.0), (1000, 9.0, 9.0, None), (1001, None, 1.0, None), (1002, float("nan"), 1.0, 3.0)]
    n = spark.createDataFrame(rows, "node long, x double, y double, ele double")
    asked, within = [], lanes.grid.pairs_within
    monkeypatch.setattr(lanes.grid, "pairs_within", lambda left, right, *a: (asked.append(left.crossJoin(right).count()), within(left, right, *a))[1])
    got = {(r["node"], r["ele"]) for r in lanes.fill_elevation(n, 1.0).collect()}
    full = [r for r in rows if r[3] is not None]

    def least(x, y):
        return min(((i, math.hypot(x - u, y - v), e) for i, u, v, e in full if math.hypot(x - u, y - v) <= 1.0), default=(0, 0, None))[2]

    assert got == {(i, e if e is not None or x is None else least(x, y)) for i, x, y, e in rows}
    assert sum(asked) < 10 * len(rows)
