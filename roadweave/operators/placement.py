"""Frames put on the map by their poses, and the passes over a frame's labels before that.

A frame is turned about the vehicle by its heading and an offset, and moved to
its position on the chunk's raster. Each observed pixel names the map pixels
that read it, at most four of which come into question, so a frame is placed
without a join on pixels and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import geometry as g
from roadweave.operators import blend, graphs, poses
from roadweave.storage import materialize

#: Half the diagonal of a pixel, and a little more.
HALF_DIAGONAL = 0.7072


def frame_angles(frames: DataFrame, mode: str = "estimated", offset_degrees: float = 0.0, by: list[str] | None = None) -> DataFrame:
    """``frames`` with ``angle``: radians by which a frame is turned counter-clockwise.

    ``gps`` takes the pose's heading, ``estimated`` the direction from the frame
    before (0 where there is none or it is at the same place), ``only_offset``
    neither; the offset is added to each.
    """
    offset = F.radians(F.lit(float(offset_degrees)))
    if mode == "only_offset":
        return frames.withColumn("angle", offset)
    if mode == "gps":
        return frames.withColumn("angle", F.col("heading") + offset)
    if mode != "estimated":
        raise ValueError(f"no angle mode {mode}")
    w = Window.partitionBy(*(by or [])).orderBy("frame")
    turn = g.angle(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w))
    return frames.withColumn("angle", F.coalesce(turn, F.lit(0.0)) + offset)


def anchors(frames: DataFrame, by: list[str], rows: int, cols: int, resolution: float, symmetric_offset: float = 0.0) -> DataFrame:
    """(by, tl_x, tl_y, br_x, br_y, h_px, w_px): rasters that hold all frames of a group.

    Half a frame and ``symmetric_offset`` metres are added on each side, cut to
    whole metres; sizes in pixels are cut too.
    """
    off_x, off_y = (float(int((n / 2 + symmetric_offset / resolution) * resolution)) for n in (cols, rows))
    e = poses.extents(frames, by)
    left, right, top, bottom = F.col("min_x") - off_x, F.col("max_x") + off_x, F.col("max_y") + off_y, F.col("min_y") - off_y
    px = lambda a, b: ((a - b) / resolution).cast("int")
    return e.select(*by, left.alias("tl_x"), top.alias("tl_y"), right.alias("br_x"), bottom.alias("br_y"), px(top, bottom).alias("h_px"), px(right, left).alias("w_px"))


def on_map(observations: DataFrame, frames: DataFrame, resolution: float, centre: tuple[float, float]) -> DataFrame:
    """Observations (frame, row, col, cls, weight) at their map pixels.

    ``frames`` is (frame, x, y, angle, tl_x, tl_y, h_px, w_px and what else is
    to be kept); ``centre`` is the vehicle's (col, row) in a frame. A map pixel
    reads the nearest pixel of the frame, half up, as an inverse warp does;
    what falls outside the raster goes.
    """
    kept = [c for c in frames.columns if c not in ("frame", "x", "y", "angle", "tl_x", "tl_y", "h_px", "w_px")]
    cx, cy = map(float, centre)
    at = frames.select("frame", *kept, F.cos("angle").alias("__c"), F.sin("angle").alias("__s"), ((F.col("x") - F.col("tl_x")) / resolution).alias("__x"), ((F.col("tl_y") - F.col("y")) / resolution).alias("__y"), "h_px", "w_px")
    x = observations.join(at, "frame")
    u, v, c, s = F.col("col") - cx, F.col("row") - cy, F.col("__c"), F.col("__s")
    x = x.withColumn("__i", F.ceil(c * u + s * v + F.col("__x") - HALF_DIAGONAL)).withColumn("__j", F.ceil(c * v - s * u + F.col("__y") - HALF_DIAGONAL))
    x = x.withColumn("__d", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])))
    x = x.withColumns({"__i": F.col("__i") + F.col("__d.i"), "__j": F.col("__j") + F.col("__d.j")})
    a, b = F.col("__i") - F.col("__x"), F.col("__j") - F.col("__y")
    reads = (F.floor(c * a - s * b + cx + 0.5) == F.col("col")) & (F.floor(s * a + c * b + cy + 0.5) == F.col("row"))
    inside = (F.col("__i") >= 0) & (F.col("__i") < F.col("w_px")) & (F.col("__j") >= 0) & (F.col("__j") < F.col("h_px"))
    return x.where(reads & inside).select("frame", *kept, F.col("__j").cast("int").alias("row"), F.col("__i").cast("int").alias("col"), "cls", "weight")


def build_map(observations: DataFrame, frames: DataFrame, shape: tuple[int, int], resolution: float, centre: tuple[float, float], mode: str = "estimated", offset_degrees: float = 0.0, symmetric_offset: float = 0.0, split_after_frames: int = 100, limit_chunks: int | None = None, blend_mode: str = "sum") -> tuple[DataFrame, DataFrame]:
    """Pixels (chunk, row, col, cls, weight) of a drive's frames, and the chunks' anchors."""
    placed = frame_angles(frames, mode, offset_degrees).withColumn("chunk", poses.chunk_of(F.col("frame"), split_after_frames))
    if limit_chunks:
        placed = placed.where(F.col("chunk") < limit_chunks)
    chunks = anchors(placed, ["chunk"], *shape, resolution, symmetric_offset)
    seen = on_map(observations, placed.select("frame", "chunk", "x", "y", "angle").join(chunks.drop("br_x", "br_y"), "chunk"), resolution, centre)
    return blend.nonzero(blend.blend(seen, blend_mode, ["chunk"])), chunks


def combine_cameras(observations: DataFrame) -> DataFrame:
    """What several cameras of a frame see: a class counts at a pixel once, however many see it."""
    return observations.groupBy("frame", "row", "col", "cls").agg(F.max("weight").alias("weight"))


def mask_vehicle(pixels: DataFrame, frames: DataFrame, shape: tuple[int, int], holes: Sequence[tuple[int, int, int, int]]) -> DataFrame:
    """Pixels that the vehicle does not cover.

    ``holes`` (first row, last row + 1, first column, last column + 1) is the
    vehicle in a frame of ``shape`` that looks ahead; the mask turns about the
    frame's centre by the ``angle`` of ``frames``, and nothing is seen outside it.
    """
    rows, cols = shape
    x = pixels.join(frames.select("frame", F.cos("angle").alias("__c"), F.sin("angle").alias("__s")), "frame")
    u, v = F.col("col") - cols / 2, F.col("row") - rows / 2
    at_col, at_row = F.floor(F.col("__c") * u - F.col("__s") * v + cols / 2 + 0.5), F.floor(F.col("__s") * u + F.col("__c") * v + rows / 2 + 0.5)
    seen = at_row.between(0, rows - 1) & at_col.between(0, cols - 1)
    for r0, r1, c0, c1 in holes:
        seen = seen & ~(at_row.between(r0, r1 - 1) & at_col.between(c0, c1 - 1))
    return x.where(seen).select(*pixels.columns)


def clean_frames(pixels: DataFrame, min_block_area: int | None = 20, drivable: int | None = None, eroded_in: tuple[int, int] | None = None) -> DataFrame:
    """Labels of frames without small blobs.

    ``pixels`` (frame, row, col, cls, ...) may hold a pixel once a class. Pixels
    of any class but background and ``drivable`` make 8-connected blobs within
    their frame; those under ``min_block_area`` go, and with ``eroded_in``, the
    frames' (rows, cols), pixels beside background too. Background and drivable
    are kept as they are.
    """
    if min_block_area is None:
        return pixels
    plain = (F.col("cls") == 0) if drivable is None else F.col("cls").isin(0, drivable)
    kept = graphs.foreground_blobs(pixels.where(~plain), ["frame"]).where(F.col("area") >= min_block_area).select("frame", "row", "col")
    if eroded_in is not None:
        kept = graphs.erode(kept.withColumn("cls", F.lit(1)), ["frame"], eroded_in).select("frame", "row", "col")
    return pixels.where(plain).unionByName(pixels.where(~plain).join(kept, ["frame", "row", "col"], "left_semi"))


def _windows(pixels: DataFrame, chunks: DataFrame, places: DataFrame, size: tuple[float, float], resolution: float, cell: float) -> tuple[DataFrame, DataFrame]:
    """(place, row, col, cls, weight) of the windows round ``places`` (place, x, y), and (place, tl_x, tl_y, at_row, at_col)."""
    from roadweave.operators import grid

    boxes = chunks.select("chunk", "tl_x", "tl_y", F.col("tl_x").alias("min_x"), F.col("br_y").alias("min_y"), F.col("br_x").alias("max_x"), F.col("tl_y").alias("max_y"))
    hit = grid.points_in_boxes(places, boxes, cell).select("p.*", "b.*")
    whole = Window.partitionBy("place")
    hit = hit.withColumns({"left": F.min("min_x").over(whole), "right": F.max("max_x").over(whole), "low": F.min("min_y").over(whole), "high": F.max("max_y").over(whole)})
    w, h = map(float, size)
    fits = (F.col("right") - F.col("left") >= w - 1e-9) & (F.col("high") - F.col("low") >= h - 1e-9)
    hit = hit.withColumn("win_x", F.when(fits, F.greatest("left", F.least(F.col("x") - w / 2, F.col("right") - w))).otherwise(F.raise_error(F.lit("the region is larger than the map")).cast("double")))
    hit = hit.withColumn("win_y", F.least("high", F.greatest(F.col("y") + h / 2, F.col("low") + h)))
    # the window's first pixel, and the chunk's, on the raster of all chunks that hold the position
    cut = lambda c: (c / resolution + 1e-9).cast("int")
    n_rows, n_cols = int(h / resolution + 1e-9), int(w / resolution + 1e-9)
    hit = hit.withColumns({"row0": cut(F.col("high") - F.col("win_y")) - cut(F.col("high") - F.col("tl_y")), "col0": cut(F.col("win_x") - F.col("left")) - cut(F.col("tl_x") - F.col("left"))})
    hit = materialize(hit.select("place", "chunk", "row0", "col0", F.col("win_x").alias("tl_x"), F.col("win_y").alias("tl_y"), cut(F.col("win_y") - F.col("y")).alias("at_row"), cut(F.col("x") - F.col("win_x")).alias("at_col")), "windows")
    tile = lambda c, n: F.floor(c / n).cast("int")
    asked = hit.select("place", "chunk", "row0", "col0", F.explode(F.sequence(tile(F.col("row0"), n_rows), tile(F.col("row0") + n_rows - 1, n_rows))).alias("__i")).withColumn("__j", F.explode(F.sequence(tile(F.col("col0"), n_cols), tile(F.col("col0") + n_cols - 1, n_cols))))
    held = pixels.withColumns({"__i": tile(F.col("row"), n_rows), "__j": tile(F.col("col"), n_cols)})
    x = asked.join(held, ["chunk", "__i", "__j"]).select("place", (F.col("row") - F.col("row0")).alias("row"), (F.col("col") - F.col("col0")).alias("col"), "cls", "weight")
    x = x.where(F.col("row").between(0, n_rows - 1) & F.col("col").between(0, n_cols - 1))
    # one exchange by place serves the sums here and what is made of each pixel's classes after them
    sums = x.repartition("place").groupBy("place", "row", "col", "cls").agg(F.sum("weight").alias("weight"))
    return sums, hit.groupBy("place").agg(*[F.first(c).alias(c) for c in ("tl_x", "tl_y", "at_row", "at_col")])


def _placed(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(place, x, y), each position once, and the frames with their place."""
    place = F.xxhash64("x", "y").alias("place")
    named = frames.select("frame", "x", "y", "angle", place)
    return named.groupBy("place").agg(F.first("x").alias("x"), F.first("y").alias("y")), named


def _with_frames(rows: DataFrame, at: DataFrame, frames: DataFrame, rotation_offset: float) -> DataFrame:
    upright = (-F.col("angle") - F.radians(F.lit(rotation_offset))).alias("to_vertical")
    named = frames.select("frame", "place", "x", "y", upright).join(at, "place")
    return rows.join(named, "place").drop("place")


def regions(pixels: DataFrame, chunks: DataFrame, frames: DataFrame, size: tuple[float, float], resolution: float, rotation_offset: float = -90.0, cell: float = 100.0) -> DataFrame:
    """Windows of the map round positions, moved to lie inside it.

    ``pixels`` (chunk, row, col, cls, weight), ``chunks`` as ``anchors`` gives
    them, ``frames`` (frame, x, y, angle). A position looks at all chunks that
    hold it, their weights added; one that no chunk holds has no row (Q10); a
    window that does not fit is an error. Result: (frame, row, col, cls, weight)
    in the window, the position ``x``, ``y``, the window's ``tl_x``, ``tl_y``,
    the vehicle's pixel ``at_row``, ``at_col``, and ``to_vertical``, the radians
    that turn it upright. Windows meet pixels in an equi-join on tiles as large
    as a window; frames at one position share its window.
    """
    places, named = _placed(frames)
    sums, at = _windows(pixels, chunks, places, size, resolution, cell)
    return _with_frames(sums, at, named, rotation_offset)


def labelled_regions(pixels: DataFrame, chunks: DataFrame, frames: DataFrame, size: tuple[float, float], resolution: float, ignore_classes: list[int] | None = None, drivable: int | None = None, second: bool = False, rotation_offset: float = -90.0, cell: float = 100.0) -> DataFrame:
    """``regions`` as labels, cls and, with ``second``, the class that comes next (A6): each window is labelled once, for all its frames."""
    places, named = _placed(frames)
    sums, at = _windows(pixels, chunks, places, size, resolution, cell)
    return _with_frames(region_labels(sums, ignore_classes, drivable=drivable, second=second), at, named, rotation_offset)


def region_labels(windows: DataFrame, ignore_classes: list[int] | None = None, background: float = 0.1, drivable: int | None = None, drivable_factor: float = 0.2, second: bool = False) -> DataFrame:
    """The best class of each pixel of ``regions``; background weighs as much everywhere, ignored classes become it.

    With ``second`` also the class that is best once that one weighs nothing:
    background where no other outweighs it.
    """
    keys = [c for c in windows.columns if c not in ("cls", "weight")]
    weight: Column = F.col("weight")
    if drivable is not None:
        weight = F.when(F.col("cls") == drivable, weight * drivable_factor).otherwise(weight)
    ranked = F.when(F.col("cls") != 0, F.struct(weight.alias("w"), (-F.col("cls")).alias("c")))
    ignored = F.col("cls").isin(list(ignore_classes or []))
    if not second:
        picked = windows.groupBy(*keys).agg(F.max(ranked).alias("b"))
        label = F.when(F.col("b.w") > background, -F.col("b.c")).otherwise(0)
        return blend.ignore_classes(picked.select(*keys, label.alias("cls")), ignore_classes or [])
    picked = windows.groupBy(*keys).agg(F.reverse(F.array_sort(F.collect_list(ranked))).alias("a"))
    first, after = F.get("a", F.lit(0)), F.get("a", F.lit(1))
    label = F.when(first["w"] > background, -first["c"]).otherwise(0)
    # once the best class weighs nothing: background, unless another weighs more, or was background the best
    after = F.when(first["w"] > background, F.when(after["w"] > background, -after["c"])).when(first["w"] > 0, -first["c"])
    labels = picked.select(*keys, label.alias("cls"), F.coalesce(after, F.lit(0)).alias("second"))
    return labels.withColumns({"cls": F.when(ignored, 0).otherwise(F.col("cls")), "second": F.when(ignored, 0).otherwise(F.col("second"))})


def turned(pixels: DataFrame, shape: tuple[int, int], degrees: float) -> DataFrame:
    """Pixels of a frame turned counter-clockwise about its centre, nearest pixel; what leaves the frame goes.

    Before and after a predictor that wants upright images: turn the input by
    ``degrees``, predict, turn the result by ``-degrees``.
    """
    rows, cols = shape
    here = pixels.select("frame").distinct().select("frame", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.radians(F.lit(float(degrees))).alias("angle"), F.lit(-(cols / 2)).alias("tl_x"), F.lit(rows / 2).alias("tl_y"), F.lit(rows).alias("h_px"), F.lit(cols).alias("w_px"))
    return on_map(pixels, here, 1.0, (cols / 2, rows / 2))


def cropped(pixels: DataFrame, top: int, bottom: int, left: int, right: int) -> DataFrame:
    """Pixels of rows top to bottom - 1 and columns left to right - 1, numbered anew."""
    inside = F.col("row").between(top, bottom - 1) & F.col("col").between(left, right - 1)
    return pixels.where(inside).withColumns({"row": F.col("row") - top, "col": F.col("col") - left})
