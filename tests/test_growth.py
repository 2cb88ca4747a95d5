"""Work and memory that grow with the rows, not with how many meet in one place."""

import numpy as np
from pyspark.sql import functions as F

from roadweave import queries as q
from roadweave.operators import graphs, grid, lanes, linegraph
from roadweave.operators.components import near_components


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_rectangles_are_never_broadcast(spark, sf):
    assert "BroadcastHashJoin" not in plan(q.queries()["rectangle_classes"](spark, sf))


def nested(spark, n):
    """Boxes in one cell, each in all later ones, the smallest of id 0."""
    k = F.col("id")
    return spark.range(n).select(k.alias("id"), *[(20 - (1 + k) / n).alias(c) for c in ("min_x", "min_y")], *[(20 + (1 + k) / n).alias(c) for c in ("max_x", "max_y")])


def test_a_box_is_dropped_by_the_first_smaller_one_found(spark):
    assert [r["id"] for r in grid.prune_overlaps(nested(spark, 60_000), 40.0).select("id").collect()] == [0]


def test_a_point_stops_at_the_first_box_that_holds_it(spark):
    boxes = nested(spark, 60_000)
    points = boxes.select("id", F.lit(20.0).alias("x"), F.lit(20.0).alias("y"))
    got = grid.first_box(points, boxes, 40.0).groupBy("box").count().collect()
    assert {r["box"]: r["count"] for r in got} == {0: 59_999, 1: 1}
    edge = spark.createDataFrame([(9, 0.0, 1.0), (8, 0.5, 0.5)], "id long, x double, y double")
    one = spark.createDataFrame([(8, 0.0, 0.0, 2.0, 2.0), (9, 0.0, 0.0, 3.0, 3.0)], "id long, min_x double, min_y double, max_x double, max_y double")
    assert {r["id"]: r["box"] for r in grid.first_box(edge, one, 40.0).collect()} == {8: 9}


def test_points_of_one_place_do_not_all_meet(spark):
    p = spark.range(20_000).select("id", F.lit(0.5).alias("x"), F.when(F.col("id") == 19_999, 0.53).otherwise(0.5).alias("y"))
    got = grid.nearest_k(p, p, 0.05, 3, "id", "id")
    rows = {(r["a"], r["rank"]): r["b"] for r in got.select(F.col("l.id").alias("a"), "rank", F.col("r.id").alias("b")).collect()}
    assert len(rows) == 60_000
    assert [rows[a, k] for a in (0, 2, 7, 19_999) for k in (1, 2, 3)] == [1, 2, 3, 0, 1, 3, 0, 1, 2, 0, 1, 2]


def test_sides_are_added_up_without_sorting_pairs(spark):
    nodes = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, -1.0), (3, 0.0, 0.0)], "node long, x double, y double")
    cars = spark.createDataFrame([(5, 0.0, 0.0, 0.0), (6, 0.0, 0.5, 0.0), (7, 0.0, 0.0, None)], "frame long, x double, y double, heading double")
    out = lanes.annotate_side(nodes, cars)
    assert "SortAggregate" not in plan(out)
    assert {tuple(r) for r in out.collect()} == {(1, 6, "left"), (2, 6, "right"), (3, 6, "right")}


def test_angles_are_taken_once_a_box_not_once_a_pair(spark, sf):
    joins = [x for x in plan(q.queries()["rotated_overlaps"](spark, sf)).splitlines() if "Join" in x]
    assert joins and not any("COS(" in x for x in joins)


def test_tables_of_arcs_are_not_broadcast(spark, sf):
    assert "BroadcastHashJoin" not in plan(q.queries()["linestring_cuts"](spark, sf))


def test_shuffles_are_dealt_by_the_number_of_rows(spark):
    edges = spark.createDataFrame([(0, 1, 2), (0, 2, 3)], "graph int, src int, dst int")
    assert ", 77)" in plan(graphs.degrees(edges, 77))
    nodes = spark.createDataFrame([(0, k, 0.0, 0.0, 1) for k in (1, 2, 3)], "graph int, node int, x double, y double, cls int")
    assert ", 77)" in plan(linegraph.points_of_interest(nodes, edges, parts=77))


def parallel_lines(spark, lines, nodes):
    p = spark.range(lines * nodes).select(F.floor(F.col("id") / nodes).alias("graph"), (F.col("id") % nodes).alias("node"))
    p = p.select("graph", "node", F.col("node").cast("double").alias("x"), (F.col("graph") * 2.0).alias("y"), F.lit(1.0).alias("dx"), F.lit(0.0).alias("dy"))
    return p, p.where(F.col("node") < nodes - 1).select("graph", F.col("node").alias("src"), (F.col("node") + 1).alias("dst"))


def test_a_lone_candidate_is_not_asked_for_its_neighbours(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("nothing to choose")

    monkeypatch.setattr(lanes, "_close_nodes", refuse)
    p, e = parallel_lines(spark, 4, 6)
    seen, rel = lanes.propagate_splits(p, p.where("graph = 0 and node = 3").select("graph", "node"), 1.5, 2.5, 0.2, edges=e)
    assert {tuple(r) for r in seen.select("graph", "node", "round").collect()} == {(k, 3, k) for k in range(4)}
    assert rel.count() == 6


def test_candidates_meet_their_neighbours_half_way(spark):
    _, e = parallel_lines(spark, 1, 40)
    both = graphs.undirected(e)
    asked = spark.range(40).select(F.lit(0).cast("long").alias("other_graph"), F.col("id").alias("other_node")).where("other_node <> 7")
    for steps in (0, 1, 3, 4):
        got = {r["other_node"]: set(r["close"]) for r in lanes._close_nodes(asked, both, steps).collect()}
        assert got == {a: {b for b in range(40) if b != 7 and abs(a - b) <= steps} for a in range(40) if a != 7}


def test_polygons_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(lanes, "RING_ROWS", 2)
    at = lambda y: F.array(*[F.struct(F.lit(float(x)).alias("x"), (F.col("id") * 3.0 + y).alias("y")) for x in (0, 5)])
    lines = spark.range(40).select((F.col("id") * 2).alias("ls"), at(0).alias("xy")).unionByName(spark.range(40).select((F.col("id") * 2 + 1).alias("ls"), at(2).alias("xy")))
    rings = lanes.lane_rings(spark.range(40).select((F.col("id") * 2).alias("right_ls"), (F.col("id") * 2 + 1).alias("left_ls")), lines)
    assert "RoundRobinPartitioning(20)" in plan(rings)
    assert rings.count() == 40 and rings.where("area = 10").count() == 40


def test_degrees_are_added_up_without_sorting_a_forks_edges(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("both directions of every edge")

    monkeypatch.setattr(graphs, "undirected", refuse)
    e = spark.createDataFrame([(0, k, 9) for k in range(5)] + [(0, 9, 20), (0, 20, 9), (0, 20, 21), (0, 7, 7), (0, None, 9)], "graph long, src long, dst long")
    got = {tuple(r) for r in graphs.remove_dead_ends(e).select("src", "dst").collect()}
    assert got == {(4, 9), (9, 20), (20, 21)}


def test_points_in_range_are_linked_by_cells(spark):
    k = F.col("id")
    dense = spark.range(60_000).select((k + 10).alias("node"), (F.lit(0.5) + k * 1e-9).alias("x"), F.lit(0.5).alias("y"))
    # in range only of the dense points' edge, by one point that is not outermost; then a gap; a node of two places
    odd = spark.createDataFrame([(1, 3.0, 3.0), (2, 3.09, 3.0), (3, 3.19001, 3.0), (4, 0.5, 0.6), (5, 0.5, 0.70001), (6, None, 1.0), (7, 3.19, 3.2), (7, 9.0, 9.0), (8, 9.0, 9.05)], "node long, x double, y double")
    got = {(r["node"], r["component"]) for r in near_components(dense.unionByName(odd), 0.1).collect()}
    assert {c for n, c in got if n >= 10} == {4}
    assert {x for x in got if x[0] < 10} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (7, 7), (8, 7)}


def test_cells_are_linked_like_pairs(spark):
    rng = np.random.default_rng(5)
    xy = rng.random((600, 2))
    p = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(xy)], "node long, x double, y double")
    got = dict(map(tuple, near_components(p, 0.04).collect()))
    root = np.arange(600)
    close = np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1)) <= 0.04
    while (new := np.where(close, root[None], 600).min(1)).tolist() != root.tolist():
        root = new
    assert got == dict(enumerate(root.tolist()))


def test_pairs_of_boxes_are_dealt_by_cells(spark, sf):
    text = plan(q.queries()["box_overlaps"](spark, sf))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "REPARTITION_BY_NUM" in text


def test_an_end_named_on_both_sides_is_searched_once(spark, monkeypatch):
    rows = []
    kept = graphs.materialize

    def count(df, name):
        out = kept(df, name)
        if name == "ball":
            rows.append(out.count())
        return out

    monkeypatch.setattr(graphs, "materialize", count)
    e = spark.range(9).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    pairs = spark.range(9).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionAll(spark.createDataFrame([(9, 6), (9, 5)], "a long, b long"))
    got = {tuple(r) for r in graphs.pair_hops(e, pairs, 3).collect()}
    assert got == {(k, k + 1, 1) for k in range(9)} | {(9, 6, 3)}
    assert rows == [10, 18, 16]
