"""Trajectories: pose alignment, headings, slices, chunks and extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import geometry as g
from roadweave.storage import materialize


def align(frames: DataFrame, log: DataFrame, values: list[str], on: str = "sequence", by: list[str] | None = None, order: str | None = None, wrap: tuple[str, ...] = ()) -> DataFrame:
    """``frames`` with the log's ``values`` at each frame's ``on``.

    An exact match takes the last log row of that ``on``; otherwise values are
    linear between the neighbours and clamped at the ends. Values named in
    ``wrap`` are angles in radians that turn the short way. Frames without any
    log row of their ``by`` group get nulls. One sort of the union by group;
    no join. Without ``by``, ranges of ``on`` take the place of groups, and the
    last log row before a range and the first after it are carried over.
    """
    order = order or on
    keep = [c for c in frames.columns if c not in values]
    point = F.struct(on, *values)
    group = by or []
    a = log.select(*group, F.col(on).alias("__t"), F.lit(0).alias("__k"), F.col(order).alias("__o"), point.alias("__p"), F.lit(None).cast(frames.select(F.struct(*keep)).schema[0].dataType).alias("__f"))
    b = frames.select(*group, F.col(on).alias("__t"), F.lit(1).alias("__k"), F.col(order).alias("__o"), F.lit(None).cast(log.select(point).schema[0].dataType).alias("__p"), F.struct(*keep).alias("__f"))
    both = a.unionByName(b)
    if by:
        carried = both.withColumns({"__last": F.lit(None).cast(a.schema["__p"].dataType), "__next": F.lit(None).cast(a.schema["__p"].dataType)})
    else:
        group = ["__range"]
        both = materialize(both.repartitionByRange("__t", "__k", "__o").withColumn("__range", F.spark_partition_id()), "align")
        rank = F.struct("__t", "__k", "__o")
        ends = both.groupBy("__range").agg(*[f(F.when(F.col("__p").isNotNull(), F.struct(rank, "__p")))["__p"].alias(n) for f, n in ((F.max, "__l"), (F.min, "__n"))])
        w = Window.orderBy("__range")
        ends = ends.select("__range", F.last("__l", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("__last"), F.first("__n", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("__next"))
        # one row a range, as many as there are partitions
        carried = both.join(F.broadcast(ends), "__range")
    w = Window.partitionBy(*group).orderBy("__t", "__k", "__o")
    before = F.coalesce(F.last("__p", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("__last"))
    after = F.coalesce(F.first("__p", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)), F.col("__next"))
    x = carried.withColumns({"__b": before, "__a": after}).where("__k = 1")
    out = []
    for v in values:
        p, q = F.col("__b")[v], F.col("__a")[v]
        if v in wrap:
            q = p + F.atan2(F.sin(q - p), F.cos(q - p))
        between = g.lerp(F.col("__t"), F.col("__b")[on], F.col("__a")[on], p, q)
        out.append(F.when(F.col("__b").isNull(), q).when(F.col("__a").isNull() | (F.col("__b")[on] == F.col("__t")), p).otherwise(between).alias(v))
    return x.select(*[F.col("__f")[c].alias(c) for c in keep], *out)


def motion_heading(poses: DataFrame, order: list[str], by: list[str] | None = None, x: str = "x", y: str = "y") -> DataFrame:
    """Adds ``heading``: the angle from the previous pose; null at the first."""
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    return poses.withColumn("heading", g.angle(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)))


def robust_direction(poses: DataFrame, order: list[str], by: list[str] | None = None, x: str = "x", y: str = "y", k: int = 3) -> DataFrame:
    """Adds ``dir_x`` and ``dir_y``: the normalised sum of the last ``k`` step directions."""
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    ux, uy = g.unit(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w))
    last = w.rowsBetween(1 - k, 0)
    steps = poses.withColumns({"__ux": ux, "__uy": uy}).withColumns({"__sx": F.sum("__ux").over(last), "__sy": F.sum("__uy").over(last)})
    dx, dy = g.unit(F.col("__sx"), F.col("__sy"))
    return steps.withColumns({"dir_x": dx, "dir_y": dy}).drop("__ux", "__uy", "__sx", "__sy")


def frame_numbers(rows: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Adds ``frame``, counted from 0 in order; without ``by``, ranges are counted and numbered each by itself."""
    if by:
        return rows.withColumn("frame", (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("int"))
    parts = materialize(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "frames")
    counts = parts.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    at = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    # one row a range, as many as there are partitions
    return parts.join(F.broadcast(starts), "__range").withColumn("frame", (F.col("__start") + at).cast("int")).select(*rows.columns, "frame")


def frame_slice(frames: DataFrame, start: int = 0, end: int = -1) -> DataFrame:
    """Frames start to end-1, numbered anew; a negative end is all."""
    kept = frames.where(F.col("frame") >= start)
    return (kept if end < 0 else kept.where(F.col("frame") < end)).withColumn("frame", F.col("frame") - start)


def every(frames: DataFrame, start: int, end: int, step: int) -> DataFrame:
    """Frames start, start+step, ... below end."""
    if start < 0 or step < 1 or end < start:
        raise ValueError("bounds of the iteration do not fit")
    return frames.where(F.col("frame").between(start, end - 1) & ((F.col("frame") - start) % step == 0))


def chunk_of(frame: Column, frames_per_chunk: int) -> Column:
    """The chunk of a frame (J3); chunks are as many as the frames need, none empty (Q7)."""
    return F.floor(frame / frames_per_chunk).cast("int")


def extents(points: DataFrame, by: list[str], x: str = "x", y: str = "y", margin: float = 0.0) -> DataFrame:
    """Bounding extents of each group (A1), widened by a margin."""
    return points.groupBy(*by).agg((F.min(x) - margin).alias("min_x"), (F.min(y) - margin).alias("min_y"), (F.max(x) + margin).alias("max_x"), (F.max(y) + margin).alias("max_y"), F.count("*").alias("n"))


def merge_extents(parts: DataFrame, by: list[str]) -> DataFrame:
    """Extents of sets of extents (A2)."""
    return parts.groupBy(*by).agg(F.min("min_x").alias("min_x"), F.min("min_y").alias("min_y"), F.max("max_x").alias("max_x"), F.max("max_y").alias("max_y"), F.sum("n").alias("n"))


def anchored(resolution: float, min_x: Column, min_y: Column, max_x: Column, max_y: Column, offset_px: int = 0) -> Column:
    """Extents as a struct in metres and pixels (F15, R8): the pixel offset counts in whole metres."""
    off = float(int(offset_px * resolution))
    left, bottom, right, top = min_x - off, min_y - off, max_x + off, max_y + off
    return F.struct(
        F.lit(resolution).alias("resolution"), left.alias("tl_x"), top.alias("tl_y"), right.alias("br_x"), bottom.alias("br_y"),
        F.ceil((top - bottom) / resolution).cast("int").alias("h_px"), F.ceil((right - left) / resolution).cast("int").alias("w_px"),
    )


def extents_json(resolution: float, left: Column, top: Column, right: Column, bottom: Column, offset_x: float = 0.0, offset_y: float = 0.0) -> Column:
    """Extents as a JSON document (F16): anchors without their offsets, the offsets, and the size with them, (height, width)."""
    height, width = top - bottom + 2 * offset_y, right - left + 2 * offset_x
    corner = lambda x, y, dx, dy: F.struct(F.array(x, y).alias("point"), F.array(F.lit(dx), F.lit(dy)).alias("offset"))
    pair = F.struct(corner(left, top, -offset_x, offset_y).alias("top_left"), corner(right, bottom, offset_x, -offset_y).alias("bottom_right"))
    size = F.struct(F.array(height, width).alias("meter"), F.array((height / resolution).cast("int"), (width / resolution).cast("int")).alias("pixel"))
    return F.to_json(F.struct(F.lit(resolution).alias("resolution"), pair.alias("anchors"), size.alias("extents")))


EXTENTS_JSON = "resolution double, anchors struct<top_left:struct<point:array<double>,offset:array<double>>,bottom_right:struct<point:array<double>,offset:array<double>>>, extents struct<meter:array<double>,pixel:array<int>>"


def extents_from_json(document: Column) -> Column:
    """The struct that ``anchored`` gives, from such a document; null for another text."""
    d = F.from_json(document, EXTENTS_JSON)
    at = lambda corner, k: d["anchors"][corner]["point"][k] + d["anchors"][corner]["offset"][k]
    return F.struct(d["resolution"].alias("resolution"), at("top_left", 0).alias("tl_x"), at("top_left", 1).alias("tl_y"), at("bottom_right", 0).alias("br_x"), at("bottom_right", 1).alias("br_y"), d["extents"]["pixel"][0].alias("h_px"), d["extents"]["pixel"][1].alias("w_px"))


def multi_camera(frames: DataFrame, camera: str = "camera") -> DataFrame:
    """One row a frame: mean position over cameras and their images and headings in order."""
    part = F.struct(camera, "path", "heading")
    return frames.groupBy("frame").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg("z").alias("z"), F.sort_array(F.collect_list(part)).alias("cameras"))


def paired(main: DataFrame, other: DataFrame) -> DataFrame:
    """Frames that both sources have, each side a struct."""
    pack = lambda df, name: df.select("frame", F.struct(*[c for c in df.columns if c != "frame"]).alias(name))
    return pack(main, "main").join(pack(other, "other"), "frame")


def epoch_seconds(text: Column, pattern: str = "yyyyMMddHHmmss", millis: Column | None = None) -> Column:
    """A survey clock reading as epoch seconds."""
    t = F.unix_micros(F.to_timestamp(text, pattern)) / F.lit(1_000_000.0)
    return t if millis is None else t + millis / F.lit(1000.0)
