"""Connected components of an edge table (CC).

Alternating large-star and small-star rounds: every round is two
aggregate-and-join passes over the edges, so no neighbourhood is ever gathered
into one row, and a path of n nodes needs O(log n) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions import geometry as g
from roadweave.storage import materialize, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that has an edge to another node.

    ``component`` is the least node reachable. Null ends and self-loops are
    ignored; repeated edges count once; an empty table gives an empty result.
    """
    current = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    current = materialize(current, "edges")
    mark = None
    for _ in range(max_rounds):
        before, current = current, materialize(_small_star(_large_star(current)), "star")
        release(before)
        row = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (now := tuple(row)) == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"no fixed point in {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


#: Sides of cells as a share of the radius: points of one cell are all in range.
CELL_SHARE = 0.7
#: Directions in which a cell's outermost points are tried first.
DIRECTIONS = [(1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.0, -1.0), (1.0, 1.0), (1.0, -1.0), (-1.0, 1.0), (-1.0, -1.0)]


def near_components(points: DataFrame, radius: float) -> DataFrame:
    """(node, component) of points (node, x, y) linked when at most ``radius`` apart, of all points that have a place.

    Points of one small cell are one component, so links are sought between
    cells only: first among their outermost points; of cells that these do not
    link, among the points that are in range of the other's extent. So the rows
    grow with the points, except where many points of two cells lie just out of
    range of each other: these are compared pair by pair.
    """
    side = radius * CELL_SHARE
    cell = lambda c: F.floor(F.col(c) / F.lit(side)).cast("long")
    at = points.select("node", "x", "y").where("node is not null and x is not null and y is not null and not isnan(x) and not isnan(y)")
    at = materialize(at.withColumns({"i": cell("x"), "j": cell("y")}), "near-points")
    ends = F.array(*[F.max_by(F.struct("x", "y"), F.col("x") * u + F.col("y") * v) for u, v in DIRECTIONS])
    extent = [f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))]
    cells = materialize(at.groupBy("i", "j").agg(F.min("node").alias("name"), F.array_distinct(ends).alias("ends"), *extent), "near-cells")
    # two cells apart may still be in range, three may not; each pair is asked from one side
    steps = F.array(*[F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a in (0, 1, 2) for b in (-2, -1, 0, 1, 2) if (a, b) > (0, 0)])
    asked = cells.withColumn("s", F.explode(steps)).withColumns({"oi": F.col("i") + F.col("s.i"), "oj": F.col("j") + F.col("s.j")}).drop("s")
    other = cells.select(F.col("i").alias("oi"), F.col("j").alias("oj"), *[F.col(c).alias(f"o_{c}") for c in cells.columns if c not in "ij"])
    near = lambda a, b: g.distance(a["x"], a["y"], b["x"], b["y"]) <= radius
    clear = F.exists("ends", lambda a: F.exists("o_ends", lambda b: near(a, b)))
    pairs = materialize(asked.join(other, ["oi", "oj"]).withColumn("linked", clear).drop("ends", "o_ends"), "near-pairs")
    gap = lambda c, lo, hi: F.greatest(F.lit(0.0), F.col(lo) - F.col(c), F.col(c) - F.col(hi))
    reach = lambda o: F.sqrt(F.pow(gap("x", f"{o}min_x", f"{o}max_x"), F.lit(2)) + F.pow(gap("y", f"{o}min_y", f"{o}max_y"), F.lit(2))) <= radius * (1 + 1e-9)
    open_ = pairs.where("not linked")
    mine = open_.join(at, ["i", "j"]).where(reach("o_")).select("name", "o_name", "i", "j", "oi", "oj", "x", "y")
    others = open_.join(at.select(F.col("i").alias("oi"), F.col("j").alias("oj"), "x", "y"), ["oi", "oj"]).where(reach("")).select("i", "j", "oi", "oj", F.col("x").alias("ox"), F.col("y").alias("oy"))
    met = mine.join(others, ["i", "j", "oi", "oj"]).where(g.distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy")) <= radius)
    named = materialize(at.select("node", "i", "j").join(cells.select("i", "j", "name"), ["i", "j"]).select("node", "name").distinct(), "near-names")
    # a node that is in several places joins them
    first = named.groupBy("node").agg(F.min("name").alias("u"), F.max("name").alias("v")).where("u <> v").select("node", "u").join(named, "node").select("u", F.col("name").alias("v"))
    links = pairs.where("linked").select(F.col("name").alias("u"), F.col("o_name").alias("v")).unionByName(met.select(F.col("name").alias("u"), F.col("o_name").alias("v"))).unionByName(first)
    of = connected_components(links, "u", "v").select(F.col("node").alias("name"), "component")
    return named.join(of, "name", "left").select("node", F.coalesce("component", "name").alias("component")).distinct()
