"""Spatial joins by bucketed equi-joins (GRID).

Points are put in square cells; one side is copied to its neighbours' cells, so
that an equi-join on the cell finds all pairs in range and the exact predicate
does the rest. No pair is found twice, none is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import geometry as g
from roadweave.storage import materialize, release


def _cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(float(size))).cast("long")


def pairs_within(left: DataFrame, right: DataFrame, radius: float, lx: str = "x", ly: str = "y", rx: str = "x", ry: str = "y", inclusive: bool = True) -> DataFrame:
    """(l struct, r struct, d): all pairs at most ``radius`` apart."""
    near = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    a = left.select(F.struct("*").alias("l"), F.col(lx).alias("__lx"), F.col(ly).alias("__ly"))
    a = a.withColumn("__i", F.explode(F.transform(near, lambda k: _cell(F.col("__lx"), radius) + k))).withColumn("__j", F.explode(F.transform(near, lambda k: _cell(F.col("__ly"), radius) + k)))
    b = right.select(F.struct("*").alias("r"), F.col(rx).alias("__rx"), F.col(ry).alias("__ry"))
    b = b.withColumns({"__i": _cell(F.col("__rx"), radius), "__j": _cell(F.col("__ry"), radius)})
    d = g.distance(F.col("__lx"), F.col("__ly"), F.col("__rx"), F.col("__ry"))
    hit = a.join(b, ["__i", "__j"]).select("l", "r", d.alias("d"))
    return hit.where(F.col("d") <= radius) if inclusive else hit.where(F.col("d") < radius)


def compared(left: DataFrame, right: DataFrame, radius: float) -> int:
    """How many pairs ``pairs_within`` compares."""
    count = lambda df: df.groupBy(_cell(F.col("x"), radius).alias("i"), _cell(F.col("y"), radius).alias("j")).agg(F.count("*").alias("n"))
    steps = F.array(*[F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    around = count(left).withColumn("s", F.explode(steps)).select((F.col("i") + F.col("s.i")).alias("i"), (F.col("j") + F.col("s.j")).alias("j"), F.col("n").alias("m"))
    return around.join(count(right), ["i", "j"]).agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0


def annulus(left: DataFrame, right: DataFrame, least: float, most: float, **columns: str) -> DataFrame:
    """Pairs between two distances."""
    return pairs_within(left, right, most, **columns).where(F.col("d") >= least)


def nearest_k(left: DataFrame, right: DataFrame, radius: float, k: int, left_id: str, right_id: str, distinct: bool = True, **columns: str) -> DataFrame:
    """Up to ``k`` nearest within ``radius``, the lowest id on ties (J6); ``distinct`` leaves out equal ids.

    Rows look round themselves in a range that doubles for those that have not
    found ``k``, beginning where a cell holds few, so what is compared grows with
    the rows and ``k``, not with the density.
    """
    rx, ry = columns.get("rx", "x"), columns.get("ry", "y")
    # rows of one place are equally far from any other: only the least ids of them can be among the nearest
    place = Window.partitionBy(rx, ry).orderBy(right_id)
    named = right.where(F.col(right_id).isNotNull()) if distinct else right
    held = materialize(named.where(F.col(rx).isNotNull() & F.col(ry).isNotNull()).withColumn("__place", F.dense_rank().over(place)).where(F.col("__place") <= k + 1).drop("__place"), "nearest-held")
    todo = materialize(left, "nearest-asked")
    reach = radius
    while reach > radius / 4096:
        cells = held.groupBy(_cell(F.col(rx), reach).alias("i"), _cell(F.col(ry), reach).alias("j")).agg(F.count("*").alias("n"))
        rows, mates = cells.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
        if not rows or mates <= 4 * (k + 1) * rows:
            break
        reach /= 2
    out = None
    while True:
        hit = pairs_within(todo, held, reach, **columns)
        if distinct:
            hit = hit.where(F.col("l")[left_id] != F.col("r")[right_id])
        order = Window.partitionBy(F.col("l")[left_id]).orderBy("d", F.col("r")[right_id])
        hit = hit.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if reach >= radius:
            return hit if out is None else out.unionByName(hit)
        # k within a reach are the nearest; rows with fewer look farther
        hit = materialize(hit, "nearest-found")
        done = hit.where(F.col("rank") == k).select(F.col("l")[left_id].alias(left_id)).distinct()
        full = hit.join(done.withColumnRenamed(left_id, "__done"), F.col("l")[left_id] == F.col("__done"), "left_semi")
        out = full if out is None else out.unionByName(full)
        todo, reach = materialize(todo.join(done, left_id, "left_anti"), "nearest-asked"), min(2 * reach, radius)


def least_in_range(left: DataFrame, right: DataFrame, radius: float, row_id: str, value: str) -> DataFrame:
    """(row_id, value): of the right rows at most ``radius`` from a left row, the value of the one of least ``row_id``, the nearer on ties.

    Cells are small, so that many are in range as a whole. A left row looks at
    the least id of each cell in reach, and at more of a cell, round by round,
    only where its next id is not above the least that the row has found; so what
    is compared grows with the rows, not with the density. A null id is the least.
    """
    side = radius * 0.501
    place = lambda df: df.where("not isnan(cast(x as double)) and not isnan(cast(y as double))")
    at = place(right).select(F.col(row_id).alias("o_id"), F.col(value).alias("v"), F.col("x").alias("ox"), F.col("y").alias("oy"), _cell(F.col("x"), side).alias("i"), _cell(F.col("y"), side).alias("j"))
    held = materialize(at.withColumn("k", F.dense_rank().over(Window.partitionBy("i", "j").orderBy("o_id")) - 1), "range-held")
    cells = held.groupBy("i", "j").agg(*[f(c).alias(f"{n}_{c}") for c in ("ox", "oy") for n, f in (("min", F.min), ("max", F.max))])
    steps = F.array(*[F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a in range(-2, 3) for b in range(-2, 3)])
    asked = place(left).select(F.col(row_id).alias("id"), "x", "y", F.explode(steps).alias("s"))
    asked = asked.select("id", "x", "y", (_cell(F.col("x"), side) + F.col("s.i")).alias("i"), (_cell(F.col("y"), side) + F.col("s.j")).alias("j")).join(cells, ["i", "j"])
    gap = lambda c: F.greatest(F.lit(0.0), F.col(f"min_o{c}") - F.col(c), F.col(c) - F.col(f"max_o{c}"))
    asked = asked.where(F.sqrt(gap("x") * gap("x") + gap("y") * gap("y")) <= radius * (1 + 1e-9))
    asked = materialize(asked.select("id", "x", "y", "i", "j"), "range-asked")
    low, high, out = 0, 1, None
    while True:
        d = g.distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))
        hit = asked.join(held.where(F.col("k").between(low, high - 1)).hint("merge"), ["i", "j"]).withColumn("d", d).where(F.col("d") <= radius)
        found = hit.groupBy("id").agg(F.min_by(F.struct("o_id", "d", "v"), F.struct("o_id", "d")).alias("m"))
        both = found if out is None else found.unionByName(out).groupBy("id").agg(F.min_by("m", F.struct("m.o_id", "m.d")).alias("m"))
        out = materialize(both, "range-found")
        after = held.where(F.col("k") == high).select("i", "j", F.col("o_id").alias("after")).distinct()
        rest = asked.join(after, ["i", "j"]).join(out.hint("merge"), "id", "left").where("m is null or after <= m.o_id").select(*asked.columns)
        asked = materialize(rest, "range-asked")
        if asked.isEmpty():
            return out.select(F.col("id").alias(row_id), F.col("m.v").alias(value))
        low, high = high, high * LOOK_GROWTH


def nearest_in_group(left: DataFrame, right: DataFrame, group: list[str], left_id: str, right_id: str) -> DataFrame:
    """Each left row's nearest right row of its group, the least id on ties (J12): (left_id, nearest, d).

    Rows look round themselves, in a range that doubles each round for those
    that have not found one, beginning near the mean distance between points; so
    a group is never paired as a whole. Rows with no other of their group have
    no row, nor have rows without a number for a place.
    """
    a = materialize(left.select(*group, F.col(left_id).alias("__id"), "x", "y").where("x is not null and y is not null and not isnan(x) and not isnan(y)"), "nearest-left")
    b = materialize(right.select(*group, F.col(right_id).alias("__other"), F.col("x").alias("ox"), F.col("y").alias("oy")).where("ox is not null and oy is not null and not isnan(ox) and not isnan(oy)"), "nearest-right")
    box = b.agg(*[f(c) for c in ("ox", "oy") for f in (F.min, F.max)], F.count("*")).first()
    own = a.agg(*[f(c) for c in ("x", "y") for f in (F.min, F.max)]).first()
    kind = f"`{left_id}` {left.schema[left_id].dataType.simpleString()}, nearest {right.schema[right_id].dataType.simpleString()}, d double"
    if not box[4] or own[0] is None:
        return left.sparkSession.createDataFrame([], kind)
    span = max(max(box[1], own[1]) - min(box[0], own[0]), max(box[3], own[3]) - min(box[2], own[2]), 1e-9)
    radius = span / max(1.0, box[4] ** 0.5)
    # a row without another of its group would never be done
    others = b.groupBy(*group).agg(F.count_distinct("__other").alias("__n"), F.min("__other").alias("__one"))
    todo = materialize(a.join(others, group).where((F.col("__n") > 1) | (F.col("__one") != F.col("__id"))).select(*group, "__id", "x", "y"), "nearest-todo")
    out = None
    near = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    while True:
        asked = todo.withColumn("__i", F.explode(F.transform(near, lambda k: _cell(F.col("x"), radius) + k))).withColumn("__j", F.explode(F.transform(near, lambda k: _cell(F.col("y"), radius) + k)))
        held = b.withColumns({"__i": _cell(F.col("ox"), radius), "__j": _cell(F.col("oy"), radius)})
        d = g.distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))
        hit = asked.join(held, [*group, "__i", "__j"]).where("__id <> __other").withColumn("d", d).where(F.col("d") <= radius)
        found = materialize(hit.groupBy("__id").agg(F.min(F.struct("d", "__other")).alias("m")).select(F.col("__id").alias(left_id), F.col("m.__other").alias("nearest"), F.col("m.d").alias("d")), "nearest")
        out = found if out is None else out.unionByName(found)
        rest = materialize(todo.join(found.select(F.col(left_id).alias("__id")), "__id", "left_anti"), "nearest-todo")
        release(todo)
        todo, radius = rest, 2 * radius
        if todo.isEmpty():
            return out


def scan_line(left: DataFrame, right: DataFrame, least: float, most: float, tolerance: float, dx: str = "dx", dy: str = "dy") -> DataFrame:
    """Pairs in the annulus whose right point is by the segment across the left point's direction."""
    hit = annulus(left, right, least, most)
    # in the direction's own frame the segment is an axis from -most to most
    ux, uy = g.unit(F.col("l")[dx], F.col("l")[dy])
    x, y = F.col("r.x") - F.col("l.x"), F.col("r.y") - F.col("l.y")
    hit = hit.withColumns({"__along": x * ux + y * uy, "__across": y * ux - x * uy})
    past = F.greatest(F.lit(0.0), F.abs("__across") - most)
    off = F.sqrt(F.col("__along") * F.col("__along") + past * past)
    return hit.withColumn("off", off).drop("__along", "__across").where(F.col("off") <= tolerance)


def in_oriented_box(nodes: DataFrame, cars: DataFrame, half_length: float, half_width: float, heading: str = "heading") -> DataFrame:
    """(l node, r car, along, across): nodes strictly inside a box that turns with the car.

    ``across`` is positive to the left of the car.
    """
    reach = (half_length**2 + half_width**2) ** 0.5
    hit = pairs_within(nodes, cars, reach)
    x, y = g.rotate(F.col("l.x") - F.col("r.x"), F.col("l.y") - F.col("r.y"), -F.col("r")[heading])
    return hit.withColumns({"along": x, "across": y}).where((F.abs("along") < half_length) & (F.abs("across") < half_width))


def points_in_boxes(points: DataFrame, boxes: DataFrame, cell: float, by: list[str] | None = None) -> DataFrame:
    """(p struct, b struct): points in or on axis-aligned boxes (min_x .. max_y)."""
    by = by or []
    a = points.select(*by, F.struct("*").alias("p"), _cell(F.col("x"), cell).alias("__i"), _cell(F.col("y"), cell).alias("__j"))
    b = boxes.select(*by, F.struct("*").alias("b"), F.explode(F.sequence(_cell(F.col("min_x"), cell), _cell(F.col("max_x"), cell))).alias("__i"), _cell(F.col("min_y"), cell).alias("__lo"), _cell(F.col("max_y"), cell).alias("__hi"))
    b = b.withColumn("__j", F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")
    hit = a.join(b, [*by, "__i", "__j"])
    return hit.where(g.in_extents(F.col("p.x"), F.col("p.y"), *[F.col("b")[k] for k in ("min_x", "min_y", "max_x", "max_y")])).select("p", "b")


def box_pairs(left: DataFrame, right: DataFrame, cell: float, dealt: int | None = None) -> DataFrame:
    """(l struct, r struct): axis-aligned boxes that meet in more than an edge.

    A pair is kept in the one cell that holds the lower corner of its overlap.
    ``dealt`` is the number of partitions that cells are dealt to: a small file
    of boxes may have far more pairs than the one task that reads it can make.
    """

    def spread(df: DataFrame, name: str) -> DataFrame:
        x = df.select(F.struct("*").alias(name), F.explode(F.sequence(_cell(F.col("min_x"), cell), _cell(F.col("max_x"), cell))).alias("__i"), _cell(F.col("min_y"), cell).alias("__lo"), _cell(F.col("max_y"), cell).alias("__hi"))
        x = x.withColumn("__j", F.explode(F.sequence("__lo", "__hi"))).drop("__lo", "__hi")
        return x if dealt is None else x.repartition(dealt, "__i", "__j").hint("merge")

    hit = spread(left, "l").join(spread(right, "r"), ["__i", "__j"])
    meet = (F.col("l.min_x") < F.col("r.max_x")) & (F.col("r.min_x") < F.col("l.max_x")) & (F.col("l.min_y") < F.col("r.max_y")) & (F.col("r.min_y") < F.col("l.max_y"))
    corner = (_cell(F.greatest("l.min_x", "r.min_x"), cell) == F.col("__i")) & (_cell(F.greatest("l.min_y", "r.min_y"), cell) == F.col("__j"))
    return hit.where(meet & corner).select("l", "r")


BOX = ["min_x", "min_y", "max_x", "max_y"]
#: Boxes of a cell that are looked at first, and how many times as many a later round.
FIRST_LOOK, LOOK_GROWTH = 8, 8


def _ranked_cells(boxes: DataFrame, cell: float, order: list[str]) -> DataFrame:
    """Boxes once a cell that they touch, with ``__k``, their place in it by ``order``."""
    x = boxes.withColumn("__i", F.explode(F.sequence(_cell(F.col("min_x"), cell), _cell(F.col("max_x"), cell))))
    x = x.withColumn("__j", F.explode(F.sequence(_cell(F.col("min_y"), cell), _cell(F.col("max_y"), cell))))
    return x.withColumn("__k", F.row_number().over(Window.partitionBy("__i", "__j").orderBy(*order)) - 1)


def over_smaller(boxes: DataFrame, cell: float, share: float) -> DataFrame:
    """(id): boxes (id, area, min_x .. max_y) that overlap a smaller one by more than ``share`` of it.

    One smaller box is enough, so a box looks at the smallest of its cells
    first, and at more of them, round by round, only until one is found or none
    is smaller.
    """
    ranked = materialize(_ranked_cells(boxes.select("id", "area", *BOX), cell, ["area", "id"]), "cell-ranks")
    other = ranked.select("__i", "__j", F.col("__k").alias("__o"), F.col("area").alias("o_area"), *[F.col(c).alias(f"o_{c}") for c in BOX])
    asked, low, high, out = ranked.where("__k > 0"), 0, FIRST_LOOK, None
    while True:
        hit = asked.join(other.where(F.col("__o").between(low, high - 1)).hint("merge"), ["__i", "__j"]).where("__o < __k and area > o_area")
        common = g.overlap_area(tuple(F.col(c) for c in BOX), tuple(F.col(f"o_{c}") for c in BOX))
        found = materialize(hit.where(common > share * F.col("o_area")).select("id").distinct(), "cell-found")
        out = found if out is None else out.unionByName(found)
        asked = materialize(asked.where(F.col("__k") > high).join(found.hint("merge"), "id", "left_anti"), "cell-asked")
        if asked.isEmpty():
            return out
        low, high = high, high * LOOK_GROWTH


def prune_overlaps(boxes: DataFrame, cell: float, share: float = 0.3, box_id: str = "id") -> DataFrame:
    """Boxes without those that overlap a smaller one by more than ``share`` of it; of equal ones both stay."""
    area = (F.col("max_x") - F.col("min_x")) * (F.col("max_y") - F.col("min_y"))
    out = over_smaller(boxes.select(F.col(box_id).alias("id"), area.alias("area"), *BOX), cell, share)
    return boxes.join(out.distinct().withColumnRenamed("id", box_id).hint("merge"), box_id, "left_anti")


def first_box(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """(id, box): the box of least id, not the point's own, that holds each point (id, x, y), its edge not counted.

    A point looks at the least ids of its cell first, and at more of them only
    until a box holds it.
    """
    ranked = materialize(_ranked_cells(boxes.select("id", *BOX), cell, ["id"]), "cell-ranks").withColumnRenamed("id", "box")
    asked = materialize(points.select("id", "x", "y", _cell(F.col("x"), cell).alias("__i"), _cell(F.col("y"), cell).alias("__j")), "cell-asked")
    sizes = materialize(ranked.groupBy("__i", "__j").agg(F.count("*").alias("__n")), "cell-sizes")
    asked = asked.join(sizes, ["__i", "__j"])
    low, high, out = 0, FIRST_LOOK, None
    while True:
        hit = asked.join(ranked.where(F.col("__k").between(low, high - 1)).hint("merge"), ["__i", "__j"])
        hit = hit.where("id <> box and x > min_x and x < max_x and y > min_y and y < max_y")
        found = materialize(hit.groupBy("id").agg(F.min("box").alias("box")), "cell-found")
        out = found if out is None else out.unionByName(found)
        asked = materialize(asked.where(F.col("__n") > high).join(found.hint("merge"), "id", "left_anti"), "cell-asked")
        if asked.isEmpty():
            return out
        low, high = high, high * LOOK_GROWTH


def rotated(boxes: DataFrame) -> DataFrame:
    """Boxes (cx, cy, width, height, angle in radians, the width's) with the axis-aligned extents that hold them, and ux, uy, the width's direction."""
    boxes = boxes.withColumns({"ux": F.cos("angle"), "uy": F.sin("angle")})
    c, s = F.abs("ux"), F.abs("uy")
    hx, hy = (c * F.col("width") + s * F.col("height")) / 2, (s * F.col("width") + c * F.col("height")) / 2
    return boxes.withColumns({"min_x": F.col("cx") - hx, "max_x": F.col("cx") + hx, "min_y": F.col("cy") - hy, "max_y": F.col("cy") + hy})


def _axes(s: str) -> list[tuple[Column, Column, Column]]:
    """The box's two directions, each with half its extent there."""
    x, y = F.col(f"{s}.ux"), F.col(f"{s}.uy")
    return [(x, y, F.col(f"{s}.width") / 2), (-y, x, F.col(f"{s}.height") / 2)]


def _reach(s: str, ux: Column, uy: Column) -> Column:
    """Half of what a box covers along a direction."""
    (ax, ay, aw), (bx, by, bw) = _axes(s)
    return aw * F.abs(ax * ux + ay * uy) + bw * F.abs(bx * ux + by * uy)


def rotated_pairs(left: DataFrame, right: DataFrame, cell: float, tiny: float = 1e-9) -> DataFrame:
    """(l, r): rotated boxes that overlap in part (J8, P13); one inside the other, or equal to it, does not count, nor does touching.

    Boxes as ``rotated`` takes them. Extents meet in cells; two boxes overlap if
    no direction of theirs separates them, and one holds the other if it reaches
    farther along both of its own.
    """
    hit = box_pairs(rotated(left), rotated(right), cell)
    dx, dy = F.col("r.cx") - F.col("l.cx"), F.col("r.cy") - F.col("l.cy")
    apart, held = F.lit(False), []
    for s, o in (("l", "r"), ("r", "l")):
        holds = F.lit(True)
        for ux, uy, half in _axes(s):
            gap, other = F.abs(dx * ux + dy * uy), _reach(o, ux, uy)
            apart = apart | (gap >= half + other - tiny)
            holds = holds & (gap + other <= half + tiny)
        held.append(holds)
    return hit.where(~apart & ~held[0] & ~held[1])


def points_in_rotated(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """(p, b): points strictly inside rotated boxes (J9, P12); points have x, y, boxes as ``rotated`` takes them."""
    hit = points_in_boxes(points, rotated(boxes), cell)
    dx, dy = F.col("p.x") - F.col("b.cx"), F.col("p.y") - F.col("b.cy")
    inside = F.lit(True)
    for ux, uy, half in _axes("b"):
        inside = inside & (F.abs(dx * ux + dy * uy) < half - 1e-9)
    return hit.where(inside)


def inverse_distance_mean(pairs: DataFrame, by: Column, value: Column, gamma: float = 1.0) -> DataFrame:
    """(node, value): mean of neighbours weighted by 1/d**gamma (A10); pairs at no distance have no weight."""
    w = 1 / F.pow(F.nullif(F.col("d"), F.lit(0.0)), F.lit(gamma))
    return pairs.groupBy(by.alias("node")).agg((F.sum(value * w) / F.nullif(F.sum(F.when(value.isNotNull(), w)), F.lit(0.0))).alias("value"))
