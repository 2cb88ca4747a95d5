"""Pixel rasters as rows: blends, class picks, masks, stitching.

A pixel is (row, col), an observation (frame, row, col, cls, weight).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIXEL = ["row", "col"]

# Colours of class ids 0 to 18 as red, green, blue.
PALETTE = [
    (0, 0, 0),
    (255, 153, 51),
    (255, 51, 255),
    (0, 255, 0),
    (255, 0, 0),
    (190, 189, 127),
    (116, 18, 29),
    (149, 95, 32),
    (184, 183, 153),
    (0, 0, 255),
    (68, 17, 81),
    (255, 255, 255),
    (61, 82, 213),
    (0, 79, 45),
    (181, 141, 182),
    (108, 70, 117),
    (190, 189, 127),
    (255, 164, 32),
    (49, 127, 67),
]


def nonzero(pixels: DataFrame) -> DataFrame:
    """The sparse form: rows whose weight is not 0 (P5)."""
    return pixels.where("weight <> 0")


def one_hot(labels: DataFrame) -> DataFrame:
    """Labels as observations of weight 1."""
    return labels.withColumn("weight", F.lit(1.0))


def mask(pixels: DataFrame, alpha: DataFrame) -> DataFrame:
    """Weights times a mask's alpha; what the mask lacks or zeroes goes."""
    return nonzero(pixels.join(alpha, PIXEL).withColumn("weight", F.col("weight") * F.col("alpha")).drop("alpha"))


def ignore_classes(pixels: DataFrame, classes: list[int], cls: str = "cls") -> DataFrame:
    """Ignored classes become background."""
    return pixels.withColumn(cls, F.when(F.col(cls).isin(classes), 0).otherwise(F.col(cls)))


def blend(observations: DataFrame, mode: str = "sum", by: list[str] | None = None) -> DataFrame:
    """(row, col, cls, weight) of a stack of frames.

    ``sum`` adds. ``enhance`` counts a pixel's first covering frame once and
    later ones twice. ``average`` takes half of what was there and half of each
    new frame, so that of n covering frames the first has 0.5**(n-1) and the
    k-th 0.5**(n-k+1). A frame covers a pixel where its weights there do not
    sum to 0. Sums need one partial aggregation; the ordered modes rank frames
    of a pixel first, in one shuffle that the final sum reuses.
    """
    keys = [*(by or []), *PIXEL]
    if mode == "sum":
        return observations.groupBy(*keys, "cls").agg(F.sum("weight").alias("weight"))
    pixel = Window.partitionBy(*keys)
    covers = F.sum("weight").over(Window.partitionBy(*keys, "frame"))
    seen = observations.withColumn("__covers", covers).where("__covers <> 0")
    seen = seen.withColumn("__k", F.dense_rank().over(pixel.orderBy("frame")))
    if mode == "enhance":
        share = F.when(F.col("__k") == 1, 1.0).otherwise(2.0)
    elif mode == "average":
        seen = seen.withColumn("__n", F.max("__k").over(pixel))
        share = F.pow(F.lit(0.5), F.when(F.col("__k") == 1, F.col("__n") - 1).otherwise(F.col("__n") - F.col("__k") + 1))
    else:
        raise ValueError(f"no blend mode {mode}")
    return seen.groupBy(*keys, "cls").agg(F.sum(F.col("weight") * share).alias("weight"))


def best_class(pixels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The class of the greatest weight at each pixel, the lowest id on ties (A5)."""
    return pixels.groupBy(*(by or []), *PIXEL).agg(F.max_by("cls", F.struct("weight", -F.col("cls"))).alias("cls"))


def second_best_class(pixels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The best class once the winner's weight is 0: background where nothing else is positive."""
    keys = [*(by or []), *PIXEL]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("weight"), "cls"))
    second = F.max(F.when((F.col("__r") == 2) & (F.col("weight") > 0), F.col("cls")))
    return pixels.withColumn("__r", rank).groupBy(*keys).agg(F.coalesce(second, F.lit(0)).alias("cls"))


def majority(rows: DataFrame, by: list[str], cls: str = "cls", without_background: bool = False, total: str | None = None) -> DataFrame:
    """The most frequent class of each group, the lowest id on ties (A7, A8); ``total`` names a column for the rows counted."""
    counted = (rows.where(F.col(cls) != 0) if without_background else rows).groupBy(*by, cls).agg(F.count("*").alias("n"))
    totals = [] if total is None else [F.sum("n").alias(total)]
    return counted.groupBy(*by).agg(F.max_by(cls, F.struct("n", -F.col(cls))).alias("cls"), *totals)


def under_rectangles(boxes: DataFrame) -> DataFrame:
    """(box, row, col): the pixels whose centres lie in each rotated rectangle, its sides too.

    ``boxes`` is (box, cx, cy, width, height, angle): the width runs at
    ``angle`` degrees from x towards y, in pixels. A rectangle becomes a row a
    scan line, and a scan line its pixels between the sides.
    """
    tiny = 1e-6
    c, s = F.cos(F.radians("angle")), F.sin(F.radians("angle"))
    half_y = (F.abs(s) * F.col("width") + F.abs(c) * F.col("height")) / 2 + tiny
    lines = boxes.withColumn("row", F.explode(F.when(F.floor(F.col("cy") + half_y) >= F.ceil(F.col("cy") - half_y), F.sequence(F.ceil(F.col("cy") - half_y), F.floor(F.col("cy") + half_y)))))
    dy = F.col("row") - F.col("cy")

    def span(a: Column, b: Column, half: Column) -> tuple[Column, Column]:
        wide = F.when(F.abs(b) > half, F.lit(float("inf")))
        x1, x2 = F.try_divide(-half - b, a), F.try_divide(half - b, a)
        flat = F.abs(a) < 1e-9
        return F.when(flat, F.coalesce(wide, F.lit(float("-inf")))).otherwise(F.least(x1, x2)), F.when(flat, F.lit(float("inf"))).otherwise(F.greatest(x1, x2))

    (lo1, hi1), (lo2, hi2) = span(c, dy * s, F.col("width") / 2 + tiny), span(-s, dy * c, F.col("height") / 2 + tiny)
    spans = lines.withColumns({"__lo": F.greatest(lo1, lo2) + F.col("cx"), "__hi": F.least(hi1, hi2) + F.col("cx")}).where("__lo <= __hi and ceil(__lo) <= floor(__hi)")
    return spans.select("box", F.col("row").cast("int").alias("row"), F.explode(F.sequence(F.ceil("__lo").cast("int"), F.floor("__hi").cast("int"))).alias("col"))


def stitch(chunks: DataFrame, anchors: DataFrame, mode: str = "sum") -> DataFrame:
    """Chunks (chunk, row, col, cls, weight) moved to a common anchor and blended in chunk order.

    ``anchors`` (chunk, d_row, d_col) is a small dimension table.
    """
    moved = chunks.join(anchors, "chunk").select(F.col("chunk").alias("frame"), (F.col("row") + F.col("d_row")).alias("row"), (F.col("col") + F.col("d_col")).alias("col"), "cls", "weight")
    return blend(moved, mode)


def fill_empty(main: DataFrame, other: DataFrame) -> DataFrame:
    """Where ``main`` has nothing at a (pixel, class), ``other`` counts (U4)."""
    m, o = main.withColumnRenamed("weight", "__m"), other.withColumnRenamed("weight", "__o")
    return m.join(o, [*PIXEL, "cls"], "full").select(*PIXEL, "cls", F.coalesce(F.nullif("__m", F.lit(0.0)), "__o", F.lit(0.0)).alias("weight"))


def stack_halves(upper: DataFrame, lower: DataFrame, height: int, width: int) -> DataFrame:
    """``upper`` above ``lower`` turned by half a turn."""
    turned = lower.withColumns({"row": F.lit(2 * height - 1) - F.col("row"), "col": F.lit(width - 1) - F.col("col")})
    return upper.unionByName(turned)


def merge_heads(line: Column, area: Column, drivable: int) -> Column:
    """An area's label where the line head saw nothing."""
    return F.when(line == 0, F.when(area != 0, F.lit(drivable)).otherwise(F.lit(0))).otherwise(line)


def remap_fallback(nodes: DataFrame, target: int, valid: list[int] | None = None, set_class: int | None = None, cls: str = "cls", fallback: str = "fallback") -> DataFrame:
    """Nodes of class ``target`` take their fallback if it is listed, else ``set_class`` if given."""
    if valid is None and set_class is None:
        raise ValueError("neither a fallback nor a class to set")
    other = F.lit(set_class) if set_class is not None else F.col(cls)
    return nodes.withColumn(cls, F.when(F.col(cls) == target, F.when(F.col(fallback).isin(valid or []), F.col(fallback)).otherwise(other)).otherwise(F.col(cls)))


def coarsen(pixels: DataFrame, scale: float) -> DataFrame:
    """A smaller raster: weights of the pixels that fall together are summed."""
    return pixels.withColumns({"row": F.floor(F.col("row") * scale).cast("int"), "col": F.floor(F.col("col") * scale).cast("int")}).groupBy(*PIXEL, "cls").agg(F.sum("weight").alias("weight"))


def colours(labels: DataFrame) -> DataFrame:
    """Labels with r, g, b of the palette; other classes are black."""
    table = F.lit([c for rgb in PALETTE for c in rgb])
    at = lambda k: F.coalesce(F.get(table, F.when(F.col("cls") >= 0, F.col("cls") * 3 + k).otherwise(F.lit(-1))), F.lit(0))
    return labels.withColumns({"r": at(0), "g": at(1), "b": at(2)})


def weigh_background(pixels: DataFrame, background: float | None = 0.1, drivable_class: int | None = None, drivable_factor: float = 0.2) -> DataFrame:
    """Background set to a small weight and the drivable area scaled down, before classes are picked."""
    w = F.col("weight")
    if background is not None:
        w = F.when(F.col("cls") == 0, F.lit(background)).otherwise(w)
    if drivable_class is not None:
        w = F.when(F.col("cls") == drivable_class, F.col("weight") * drivable_factor).otherwise(w)
    return pixels.withColumn("weight", w)


def affine(pixels: DataFrame, rows: int, cols: int, m: tuple[float, float, float, float, float, float], by: list[str] | None = None) -> DataFrame:
    """Nearest-neighbour warp into a raster of rows x cols.

    ``m`` takes a target (row, col) to a source: row' = m0*row + m1*col + m2,
    col' = m3*row + m4*col + m5, rounded half up. The target grid is made by
    the engine and joined to the source on the rounded pixel.
    """
    spark = pixels.sparkSession
    grid = spark.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    near = lambda a, b, c: F.floor(F.col("row") * a + F.col("col") * b + (c + 0.5)).cast("int")
    grid = grid.select("row", "col", near(*m[:3]).alias("__r"), near(*m[3:]).alias("__c"))
    source = pixels.withColumnsRenamed({"row": "__r", "col": "__c"})
    return grid.join(source, ["__r", "__c"]).drop("__r", "__c")


def target_boxes(r: np.ndarray, c: np.ndarray, h: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """(first row, last row, first col, last col): all targets that homographies ``h`` (n, 9) take to less than a pixel from each source (r, c).

    The box round the places that the square round a source comes from; all
    targets where the line at infinity crosses the square, or a matrix has no
    inverse.
    """
    m = h.reshape(-1, 3, 3)
    back = np.stack([np.cross(m[:, :, 1], m[:, :, 2]), np.cross(m[:, :, 2], m[:, :, 0]), np.cross(m[:, :, 0], m[:, :, 1])], 1)
    det = np.abs((back[:, 0] * m[:, :, 0]).sum(1))
    corners = np.stack([np.stack([c + i, r + j, np.ones(len(r))], 1) for i in (-1, 1) for j in (-1, 1)], 2)
    x, y, z = (back @ corners).transpose(1, 0, 2)
    far = 1e-6 * np.abs(z).max(1)
    fits = (det > 1e-9 * np.abs(m).max(2).prod(1)) & ((z.min(1) > far) | (z.max(1) < -far))
    z = np.where(fits[:, None], z, 1.0)
    out = np.empty((len(r), 4), np.int32)
    for k, (v, n) in enumerate(((y / z, shape[0]), (x / z, shape[1]))):
        out[:, 2 * k] = np.where(fits, np.clip(np.ceil(np.nan_to_num(v.min(1)) - 1e-3), 0, n), 0)
        out[:, 2 * k + 1] = np.where(fits, np.clip(np.floor(np.nan_to_num(v.max(1)) + 1e-3), -1, n - 1), n - 1)
    return out


def seen_targets(r: np.ndarray, c: np.ndarray, h: np.ndarray, shape: tuple[int, int], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(place in r, target row, target col, share) of every target that a source takes part in, about ``most`` candidates at a time."""
    row0, row1, col0, col1 = target_boxes(r, c, h, shape).astype(np.int64).T
    wide = np.maximum(col1 - col0 + 1, 0)
    sizes = np.maximum(row1 - row0 + 1, 0) * wide
    ends = sizes.cumsum()
    begin = 0
    while begin < len(r):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - sizes[begin] + most, side="right")))
        n = sizes[begin:end]
        k = np.repeat(np.arange(begin, end), n)
        at = np.arange(len(k)) - np.repeat(n.cumsum() - n, n)
        row, col = row0[k] + at // wide[k], col0[k] + at % wide[k]
        m = h[k].T
        with np.errstate(all="ignore"):
            depth = m[6] * col + m[7] * row + m[8]
            u, v = (m[0] * col + m[1] * row + m[2]) / depth, (m[3] * col + m[4] * row + m[5]) / depth
            share = np.ones(len(k))
            for x, here in ((v, r[k]), (u, c[k])):
                low = np.floor(x)
                share *= np.where(low == here, 1 - x + low, np.where(low + 1 == here, x - low, 0.0))
            ok = (depth != 0) & (np.abs(u) < 1e6) & (np.abs(v) < 1e6) & (share > 0)
        yield k[ok], row[ok], col[ok], share[ok]
        begin = end


def warp(pixels: DataFrame, frames: DataFrame, shape: tuple[int, int], by: str = "frame", parts: int | None = None) -> DataFrame:
    """Each frame's image seen through its own homography, interpolated between four pixels.

    ``frames`` is (by, h), h the nine numbers, row by row, that take a target
    (col, row, 1) to the source; ``pixels`` (by, row, col, values and classes).
    A target pixel is the weighted sum of the sources round it, ``weight`` for
    each class, or r, g and b; sources that are missing count nothing. A source
    looks for its targets in the box round its four corners' places in the
    target, so rows are made for pixels that exist, not for whole images; where
    the line at infinity crosses its square, or the matrix has no inverse, it
    looks at all targets. ``parts`` is the number of partitions that what is
    seen is dealt to, by frame.
    """
    values = [c for c in pixels.columns if c in ("weight", "r", "g", "b")]
    kept = [c for c in pixels.columns if c not in (by, "row", "col", *values)]
    nine = [f"__h{k}" for k in range(9)]
    source = pixels.join(frames.select(by, *[F.col("h")[k].alias(n) for k, n in enumerate(nine)]).hint("merge"), by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, row, col, share in seen_targets(batch["row"].to_numpy(float), batch["col"].to_numpy(float), batch[nine].to_numpy(float), shape):
                out = batch[[by, *kept]].iloc[k].assign(row=row, col=col)
                for v in values:
                    out[v] = batch[v].to_numpy(float)[k] * share
                yield out

    kinds = [(c, pixels.schema[c].dataType.simpleString()) for c in (by, *kept)] + [(c, "int") for c in PIXEL] + [(c, "double") for c in values]
    seen = source.select(by, *PIXEL, *kept, *values, *nine).mapInPandas(run, ", ".join(f"`{c}` {kind}" for c, kind in kinds))
    seen = seen.repartition(*([] if parts is None else [parts]), by)
    return seen.groupBy(by, *PIXEL, *kept).agg(*[F.sum(c).alias(c) for c in values])


def homography(pixels: DataFrame, rows: int, cols: int, h: list[list[float]]) -> DataFrame:
    """The same warp by a perspective map of target (x=col, y=row) to source."""
    spark = pixels.sparkSession
    grid = spark.range(rows * cols).select(F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    dot = lambda k: F.col("col") * h[k][0] + F.col("row") * h[k][1] + F.lit(float(h[k][2]))
    d = F.nullif(dot(2), F.lit(0.0))
    grid = grid.select("row", "col", F.floor(dot(1) / d + 0.5).cast("int").alias("__r"), F.floor(dot(0) / d + 0.5).cast("int").alias("__c"))
    return grid.join(pixels.withColumnsRenamed({"row": "__r", "col": "__c"}), ["__r", "__c"]).drop("__r", "__c")


def window_around(positions: DataFrame, pixels: DataFrame, half: int, by: list[str] | None = None) -> DataFrame:
    """The pixels within ``half`` of each position's (row, col), with their place in the window.

    A window names the tiles, as large as itself, that it touches, four at most,
    and meets the raster in an equi-join on them. Positions outside the raster
    have no row (Q10).
    """
    size = 2 * half + 1
    tile = lambda c: F.floor(c / size).cast("int")
    at = positions.withColumnsRenamed({"row": "at_row", "col": "at_col"})
    for k in ("row", "col"):
        at = at.withColumn(f"__{k}", F.explode(F.sequence(tile(F.col(f"at_{k}") - half), tile(F.col(f"at_{k}") + half))))
    held = pixels.withColumns({"__row": tile(F.col("row")), "__col": tile(F.col("col"))})
    x = at.join(held, ["__row", "__col", *(by or [])]).drop("__row", "__col")
    x = x.withColumns({"win_row": F.col("row") - F.col("at_row") + half, "win_col": F.col("col") - F.col("at_col") + half})
    return x.where(F.col("win_row").between(0, 2 * half) & F.col("win_col").between(0, 2 * half))


def fit_window(low: Column, size: int, total: int) -> Column:
    """The start of a window moved to lie inside 0..total; an error if it cannot."""
    if size > total:
        raise ValueError("the region is larger than the map")
    return F.greatest(F.lit(0), F.least(low, F.lit(total - size)))


def slices(height: int, window: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of the horizontal windows of a raster.

    As many windows as the height holds whole steps; the last one goes to the
    end, so it may be shorter or longer than the others. A raster lower than one
    step has none.
    """
    if not 0 <= overlap < window:
        raise ValueError("the overlap must be smaller than the window")
    step = window - overlap
    n = int(height / step)
    return [(k * step, height if k == n - 1 else min(k * step + window, height)) for k in range(n)]


def in_slices(pixels: DataFrame, height: int, window: int, overlap: int) -> DataFrame:
    """Pixels of the first ``height`` rows with ``slice``, once for each window that holds them."""
    step = window - overlap
    last = len(slices(height, window, overlap)) - 1
    if last < 0:
        return pixels.where("false").withColumn("slice", F.lit(0))
    pixels = pixels.where(F.col("row").between(0, height - 1))
    first = F.greatest(F.lit(0), F.ceil((F.col("row") - window + 1) / F.lit(step))).cast("int")
    return pixels.withColumn("slice", F.explode(F.sequence(F.least(first, F.lit(last)), F.least(F.floor(F.col("row") / step).cast("int"), F.lit(last)))))


def to_world(row: Column, col: Column, tl_x: Column, tl_y: Column, resolution: float) -> tuple[Column, Column]:
    """Raster to metres: the row axis points down."""
    return tl_x + col * resolution, tl_y - row * resolution


def to_pixel(x: Column, y: Column, tl_x: Column, tl_y: Column, resolution: float) -> tuple[Column, Column]:
    return F.floor((tl_y - y) / resolution).cast("int"), F.floor((x - tl_x) / resolution).cast("int")
