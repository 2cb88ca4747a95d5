"""Line graphs as tables: nodes(graph, node, x, y, cls, ...), edges(graph, src, dst)."""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import geo, shapes
from roadweave.functions import geometry as g
from roadweave.operators.components import connected_components
from roadweave.storage import COMPACT_ROUNDS, materialize


def undirected(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """Both directions of each edge, once; loops go. ``parts`` is the number of partitions that they are dealt to."""
    one = edges.select("graph", "src", "dst")
    both = one.unionByName(one.select("graph", F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst")
    return (both if parts is None else both.repartition(parts, "graph", "src", "dst")).distinct()


def degrees(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """(graph, node, degree): distinct neighbours."""
    return undirected(edges, parts).groupBy("graph", F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def drop_small_graphs(nodes: DataFrame, min_nodes: int = 2) -> DataFrame:
    """Nodes of graphs with at least ``min_nodes``."""
    large = nodes.groupBy("graph").agg(F.count("*").alias("n")).where(F.col("n") >= min_nodes).select("graph")
    return nodes.join(large, "graph", "left_semi")


def remove_dead_ends(edges: DataFrame) -> DataFrame:
    """Edges once leaves beside forks are cut until the fork has degree 2.

    A leaf has one neighbour, so forks do not affect each other: a fork of
    degree D loses its min(leaves, D - 2) leaves of least id. Graphs of two
    nodes or fewer have no fork and are kept.
    """
    one = edges.select("graph", F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).where(edges["src"] != edges["dst"]).distinct()
    one = materialize(one, "spur-edges")
    # degrees are added up before they are dealt, so that a large fork is not sorted in one task
    degree = one.select("graph", F.explode(F.array("src", "dst")).alias("node")).groupBy("graph", "node").agg(F.count("*").alias("degree"))
    degree = materialize(degree, "spur-degrees")
    leaves = degree.where("degree = 1").select("graph", F.col("node").alias("leaf"))
    side = lambda leaf, fork: one.select("graph", F.col(leaf).alias("leaf"), F.col(fork).alias("src")).join(leaves, ["graph", "leaf"], "left_semi")
    spurs = side("src", "dst").unionByName(side("dst", "src")).join(degree.where("degree > 2").select("graph", F.col("node").alias("src"), "degree"), ["graph", "src"])
    rank = F.row_number().over(Window.partitionBy("graph", "src").orderBy("leaf"))
    cut = materialize(spurs.withColumn("k", rank).where("k <= degree - 2").select("graph", "leaf"), "spurs")
    # a leaf that is cut has one edge, from it to its fork
    gone = cut.select("graph", F.col("leaf").alias("src"))
    return one.join(gone, ["graph", "src"], "left_anti").join(gone.withColumnRenamed("src", "dst"), ["graph", "dst"], "left_anti").select("graph", "src", "dst")


def split_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes whose ``graph`` is their component, ids of the form (graph, least node)."""
    of = connected_components(edges.select(F.struct("graph", F.col("src").alias("node")).alias("src"), F.struct("graph", F.col("dst").alias("node")).alias("dst")))
    named = of.select(F.col("node.graph").alias("graph"), F.col("node.node").alias("node"), F.col("component.node").alias("part"))
    return nodes.join(named, ["graph", "node"], "left").withColumn("part", F.coalesce("part", "node"))


def pair_hops(edges: DataFrame, pairs: DataFrame, most: int) -> DataFrame:
    """(a, b, hop): fewest steps between the two nodes of each pair, of the pairs at most ``most`` steps apart.

    The search goes from both ends, half the way from each, so it looks at the
    nodes within half of ``most`` of an end and never at a whole graph. Ends
    that many pairs name, on either side, are searched once. ``edges`` is (src, dst), either way;
    repeated pairs come once, a node is no step from itself, null ends give no
    row.
    """
    both = edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()
    both = materialize(both, "hop-edges")
    asked = materialize(pairs.select("a", "b").where("a is not null and b is not null").distinct(), "hop-pairs")

    ends = asked.select(F.col("a").alias("end")).unionAll(asked.select(F.col("b").alias("end"))).distinct()
    frontier = materialize(ends.select("end", F.col("end").alias("node"), F.lit(0).alias("d")), "ball")
    seen, before = frontier, None
    for k in range(1, (most + 1) // 2 + 1):
        reached = frontier.join(both, F.col("node") == F.col("src")).select("end", F.col("dst").alias("node")).distinct()
        known = frontier.select("end", "node") if before is None else frontier.select("end", "node").unionAll(before.select("end", "node"))
        before, frontier = frontier, materialize(reached.join(known, ["end", "node"], "left_anti").withColumn("d", F.lit(k)), "ball")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    left = seen.withColumnsRenamed({"end": "a", "d": "da"})
    right = seen.where(F.col("d") <= most // 2).withColumnsRenamed({"end": "b", "d": "db"})
    met = asked.join(left, "a").join(right, ["b", "node"])
    return met.groupBy("a", "b").agg(F.min(F.col("da") + F.col("db")).alias("hop"))


def hops(edges: DataFrame, sources: DataFrame, most: int | None = None) -> DataFrame:
    """(node, hop): fewest steps from any source (src, dst edges; node sources).

    All nodes that can be reached, or those at most ``most`` steps away.
    One join of the frontier a step. Neighbours of a frontier are in it, in the
    one before or in the next, so only these two are compared with what is
    reached, not all nodes seen; each frontier is written to the shared folder
    so that lineage stays short.
    """
    both = edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()
    both = materialize(both, "hop-edges")
    seen = frontier = materialize(sources.select("node").distinct().withColumn("hop", F.lit(0)), "hops")
    before = None
    for k in count(1) if most is None else range(1, most + 1):
        reached = frontier.join(both, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        known = frontier.select("node") if before is None else frontier.select("node").unionAll(before.select("node"))
        before, frontier = frontier, materialize(reached.join(known, "node", "left_anti").withColumn("hop", F.lit(k)), "hops")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        if k % COMPACT_ROUNDS == 0:
            seen = materialize(seen, "hops")
    return seen


def keep_longest(rows: DataFrame, by: list[str], length: Column, tie: list[str], keep: int = 2) -> DataFrame:
    """The ``keep`` longest of each group."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(length.desc(), *tie))
    return rows.withColumn("rank", rank).where(F.col("rank") <= keep)


def segments(rows: DataFrame, by: list[str], order: list[str], cls: str, cuts: Column | None = None) -> DataFrame:
    """Adds ``segment``: a number that grows where the class changes or a cut is marked."""
    w = Window.partitionBy(*by).orderBy(*order)
    change = ~F.col(cls).eqNullSafe(F.lag(cls).over(w)) & (F.row_number().over(w) > 1)
    if cuts is not None:
        change = change | F.coalesce(cuts, F.lit(False))
    return rows.withColumn("__cut", change.cast("int")).withColumn("segment", F.sum("__cut").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__cut")


def consensus(directions: DataFrame, by: list[str], member: str, least: float = 0.95) -> DataFrame:
    """The member of each group whose direction most others share within |dot| > ``least``; null unless one is ahead.

    Directions are unit vectors, either way alike: they are angles modulo half a
    turn, and those near a member are a range of angles, counted by a window
    instead of by pairs. A null direction is near none.
    """
    reach = math.acos(least) - 1e-12
    theta = F.pmod(g.angle(F.col("dx"), F.col("dy")), F.lit(math.pi))
    turns = F.explode(F.array(*[F.lit(k * math.pi) for k in (-1, 0, 1)])).alias("__turn")
    spread = directions.where("dx is not null and dy is not null").select(*by, member, theta.alias("__t"), turns).withColumn("__t", F.col("__t") + F.col("__turn"))
    keys = ", ".join(f"`{c}`" for c in by)
    near = F.expr(f"count(*) over (partition by {keys} order by __t range between {reach!r}D preceding and {reach!r}D following)") - 1
    counted = spread.withColumn("n", near).where("__turn = 0").select(*by, member, "n")
    rest = directions.where("dx is null or dy is null").select(*by, member, F.lit(0).cast("long").alias("n"))
    counts = counted.unionByName(rest)
    top = F.max("n").over(Window.partitionBy(*by))
    return counts.withColumn("votes", top).where("n = votes").groupBy(*by).agg(F.max("votes").alias("votes"), F.when(F.count("*") == 1, F.min(member)).alias("winner"))


def sector_degrees(points: DataFrame, by: list[str]) -> DataFrame:
    """Degrees of the least sector round (cx, cy) that holds a group's points: 360 less the widest gap."""
    turn = F.degrees(g.angle(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")))
    w = Window.partitionBy(*by).orderBy("__a")
    whole = Window.partitionBy(*by)
    x = points.withColumn("__a", turn)
    gap = F.coalesce(F.lead("__a").over(w) - F.col("__a"), F.min("__a").over(whole) + 360 - F.col("__a"))
    return x.withColumn("__gap", gap).groupBy(*by).agg((360 - F.max("__gap")).alias("sector"))


def shift_ids(first: DataFrame, second: DataFrame, offset: Column | int) -> DataFrame:
    """Disjoint union: the second's node ids moved past the first's."""
    return first.unionByName(second.withColumn("node", F.col("node") + offset))


def concat_lists(a: Column, b: Column) -> Column:
    """Lists joined, null as empty."""
    return F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array()))


def to_utm(nodes: DataFrame, ref_lat: float, ref_lon: float, ref_h: float = 0.0, zone: int | None = None) -> DataFrame:
    """Nodes in local metres as UTM metres."""
    lat, lon, _ = geo.enu_to_latlon(F.col("x"), F.col("y"), F.lit(0.0), ref_lat, ref_lon, ref_h)
    moved = nodes.withColumns({"__lat": lat, "__lon": lon})
    east, north = geo.latlon_to_utm(F.col("__lat"), F.col("__lon"), zone)
    return moved.withColumns({"x": east, "y": north}).drop("__lat", "__lon")


def foreground_blobs(pixels: DataFrame, by: list[str] | None = None, tile: int = 512) -> DataFrame:
    """(by, row, col, blob, area): 8-connected blobs of distinct pixels, in each group.

    Labelled in two levels: each tile by itself, in one task of bounded size;
    then only labels that touch across a tile's border are components of each
    other. A blob is named by its least pixel.
    """
    by = by or []
    keys = [*by, "row", "col"]
    number = lambda c: F.floor(F.col(c) / tile).cast("int")
    p = pixels.select(*keys).distinct().withColumns({"__i": number("row"), "__j": number("col")})
    kept = {c: pixels.schema[c].dataType for c in keys}
    schema = ", ".join([*[f"`{c}` {kept[c].simpleString()}" for c in keys], f"r0 {kept['row'].simpleString()}", f"c0 {kept['col'].simpleString()}"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        dense = np.zeros((int(r.max() - r.min()) + 1, int(c.max() - c.min()) + 1), bool)
        dense[r - r.min(), c - c.min()] = True
        labels = shapes.label_blobs(dense)
        first = np.unique(labels.ravel(), return_index=True)[1][-labels.max() :]
        mine = first[labels[r - r.min(), c - c.min()] - 1]
        return pdf[keys].assign(r0=mine // dense.shape[1] + r.min(), c0=mine % dense.shape[1] + c.min())

    local = materialize(p.groupBy(*by, "__i", "__j").applyInPandas(run, schema), "tile-blobs")
    least = F.struct(*by, F.col("r0").alias("row"), F.col("c0").alias("col"))
    edge = lambda c, k: F.pmod(F.col(c), F.lit(tile)) == k
    steps = F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a, b in ((0, 1), (1, -1), (1, 0), (1, 1))])
    rim = local.where(edge("row", tile - 1) | edge("col", tile - 1) | edge("col", 0)).select(*keys, least.alias("src"), F.explode(steps).alias("s"))
    asked = rim.select(*by, "src", "row", "col", (F.col("row") + F.col("s.r")).alias("to_row"), (F.col("col") + F.col("s.c")).alias("to_col"))
    crosses = (F.floor(F.col("row") / tile) != F.floor(F.col("to_row") / tile)) | (F.floor(F.col("col") / tile) != F.floor(F.col("to_col") / tile))
    asked = asked.where(crosses).select(*by, "src", F.col("to_row").cast(kept["row"]).alias("row"), F.col("to_col").cast(kept["col"]).alias("col"))
    met = local.where(edge("row", 0) | edge("col", 0) | edge("col", tile - 1)).select(*keys, least.alias("dst"))
    touching = materialize(asked.join(met, keys).select("src", "dst").distinct(), "tile-edges")
    blobs = local.select(*keys, least.alias("blob"))
    if not touching.isEmpty():
        of = connected_components(touching).select(F.col("node").alias("blob"), "component")
        blobs = blobs.join(of, "blob", "left").select(*keys, F.coalesce("component", "blob").alias("blob"))
    area = blobs.groupBy("blob").agg(F.count("*").alias("area"))
    return blobs.join(area, "blob").select(*keys, "blob", "area")


def clean_junk(labels: DataFrame, min_area: int) -> DataFrame:
    """Labels with foreground blobs of area at most ``min_area`` made background."""
    small = foreground_blobs(labels.where("cls <> 0")).where(F.col("area") <= min_area).select("row", "col", F.lit(True).alias("__small"))
    return labels.join(small, ["row", "col"], "left").withColumn("cls", F.when(F.col("__small"), 0).otherwise(F.col("cls"))).drop("__small")


def erode(labels: DataFrame, by: list[str] | None = None, shape: tuple[int, int] | None = None) -> DataFrame:
    """Foreground pixels all of whose eight neighbours are foreground (R15); with ``shape``, only neighbours inside it count."""
    keys = [*(by or []), "row", "col"]
    p = labels.where("cls <> 0")
    side = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    asked = p.select(*keys, "cls").withColumn("__r", F.explode(side)).withColumn("__c", F.explode(side))
    asked = asked.select(*(by or []), F.col("row").alias("r0"), F.col("col").alias("c0"), "cls", (F.col("row") + F.col("__r")).alias("row"), (F.col("col") + F.col("__c")).alias("col"))
    wanted = F.lit(9)
    if shape is not None:
        inside = lambda c, n: F.lit(3) - (F.col(c) == 0).cast("int") - (F.col(c) == n - 1).cast("int")
        wanted = inside("r0", shape[0]) * inside("c0", shape[1])
    full = asked.join(p.select(*keys), keys).groupBy(*(by or []), "r0", "c0", "cls").agg(F.count("*").alias("n")).where(F.col("n") == wanted)
    return full.select(*(by or []), F.col("r0").alias("row"), F.col("c0").alias("col"), "cls")
