"""Regions to line graphs: windows, contours, rectangles, and an ordered fold over frames.

Finding boxes is parallel over frames; connecting them depends on the order of
frames, so a drive is one fold, and drives are parallel.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions import shapes
from roadweave.operators.blend import slices
from roadweave.operators.linegraph import Graph

BOXES = "drive long, frame long, slice int, contour int, box int, cls long, fallback long, cx double, cy double, corners array<double>, x double, y double, reach double"


@dataclass(frozen=True)
class ParserOptions:
    """``None`` follows from the window, as documented beside each."""

    window: int = 32
    overlap: int = 16
    resolution: float = 0.05
    max_box_pixels: float | None = None  # twice the window
    old_distance: float | None = None  # the window in metres
    min_box_area: float = 1.0
    single: bool = False  # connect to the first overlapping candidate only
    nearest: int = 3


def split_wide(rect: tuple, step: float, overlap: float) -> list[tuple]:
    """A rectangle (centre, width, height, angle) cut along its height into as many pieces as it holds whole steps.

    A piece is one part of the height and ``overlap`` more; pieces go against
    the height's direction.
    """
    centre, width, height, angle = rect
    n = int(height / step)
    part = height / n
    along = np.array([-np.sin(np.radians(angle)), np.cos(np.radians(angle))])
    return [(centre + along * (height / 2 - part * (k + 0.5)), width, part + overlap, angle) for k in range(n)]


def class_under(labels: np.ndarray, rect: tuple) -> int:
    """The most frequent class other than background under a rectangle, the lowest on ties, 0 if there is none."""
    values, counts = np.unique(labels[shapes.under_rectangle(labels.shape, *rect)], return_counts=True)
    values, counts = values[values != 0], counts[values != 0]
    return int(values[counts.argmax()]) if len(values) else 0


def boxes_of(best: np.ndarray, second: np.ndarray, o: ParserOptions) -> list[tuple[int, int, int, int, int, np.ndarray]]:
    """(slice, contour, box, cls, fallback, corners in pixels) of a region's two label images.

    A contour goes round all foreground that hangs together, whatever its
    classes; each piece of it takes the class that most of its pixels have.
    """
    out = []
    most = o.max_box_pixels or 2 * o.window
    for s, (lo, hi) in enumerate(slices(best.shape[0], o.window, o.overlap)):
        part, other = best[lo:hi], second[lo:hi]
        for k, border in enumerate(shapes.outer_contours(part != 0)):
            if shapes.polygon_area(border) < o.min_box_area:
                continue
            rect = shapes.rectangle(border)
            pieces = split_wide(rect, o.window - o.overlap, o.overlap) if rect[2] >= most else [rect]
            for b, piece in enumerate(pieces):
                # between two arms of a contour a piece can hold no pixel of it
                if cls := class_under(part, piece):
                    out.append((s, k, b, cls, class_under(other, piece), shapes.corners_of(*piece) + (0, lo)))
    return out


def find_boxes(regions: DataFrame, options: ParserOptions = ParserOptions()) -> DataFrame:
    """Boxes of every region, in world metres.

    ``regions`` has a row a pixel: drive, frame, row, col, best, second, and
    where it lies: x, y (metres) of the pixel centre_row, centre_col, the
    vehicle's own. With ``turn`` the raster is turned by so many radians about
    that pixel before it is parsed, so that lines run upwards, and its boxes are
    turned back. tl_x, tl_y instead are the metres of the first pixel. A region
    is bounded by its window; frames are independent.
    """
    o = options
    zero = F.lit(0.0)
    if "x" not in regions.columns:
        regions = regions.withColumns({"x": F.col("tl_x"), "y": F.col("tl_y"), "centre_row": zero, "centre_col": zero})
    if "turn" not in regions.columns:
        regions = regions.withColumn("turn", zero)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shape = int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1
        best, second = np.zeros(shape, int), np.zeros(shape, int)
        best[pdf["row"], pdf["col"]] = pdf["best"]
        second[pdf["row"], pdf["col"]] = pdf["second"]
        at = pdf.iloc[0]
        centre, turn = np.array([float(at["centre_col"]), float(at["centre_row"])]), float(at["turn"] or 0.0)
        if turn:
            best, second = (shapes.turned_raster(v, turn, centre) for v in (best, second))
        back = np.array([[np.cos(turn), -np.sin(turn)], [np.sin(turn), np.cos(turn)]])
        here, reach = (float(at["x"]), float(at["y"])), max(shape) * o.resolution
        rows = []
        for s, k, b, cls, fallback, corners in boxes_of(best, second, o):
            world = here + (corners - centre) @ back.T * (o.resolution, -o.resolution)
            rows.append((int(at["drive"]), int(at["frame"]), s, k, b, cls, fallback, *world.mean(0).tolist(), world.ravel().tolist(), *here, reach))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in BOXES.split(", ")])

    return regions.groupBy("drive", "frame").applyInPandas(run, BOXES)


@dataclass
class DriveState:
    """What a drive's fold carries: a node a box, edges, the boxes near the vehicle, those of the last window, and what has changed."""

    nodes: dict[int, dict] = field(default_factory=dict)
    edges: set[tuple[int, int]] = field(default_factory=set)
    near: list[int] = field(default_factory=list)
    previous: list[int] = field(default_factory=list)
    count: int = 0
    changed: set[int] = field(default_factory=set)
    new_edges: list[tuple[int, int]] = field(default_factory=list)

    def join(self, a: int, b: int) -> None:
        edge = (min(a, b), max(a, b))
        if a != b and edge not in self.edges:
            self.edges.add(edge)
            self.new_edges.append(edge)

    def drain(self) -> tuple[list[int], list[tuple[int, int]]]:
        """Nodes that are new or moved and edges that are new since the last call."""
        out = sorted(self.changed), self.new_edges
        self.changed, self.new_edges = set(), []
        return out

    def drain_rows(self) -> tuple[list[tuple], list[tuple[int, int]]]:
        """The same with the nodes' values: (id, None, x, y, cls, fallback)."""
        nodes, edges = self.drain()
        return [(k, None, *map(float, self.nodes[k]["centre"]), int(self.nodes[k]["cls"]), int(self.nodes[k]["fallback"])) for k in nodes], edges

    def forget(self) -> None:
        """Keep only what the next frames can still meet."""
        kept = {*self.near, *self.previous}
        self.nodes = {k: self.nodes[k] for k in sorted(kept)}
        self.edges = {e for e in self.edges if kept.issuperset(e)}

    def add(self, box: dict, o: ParserOptions, earlier: list[int], contour: list[int]) -> tuple[int, bool]:
        """(node, whether it is new).

        A box whose centre lies in one of the ``earlier`` nodes' boxes, the
        nearest first, is merged with it, whatever their classes: both are
        averaged. Else it is a node, connected to every box that it overlaps of
        the earlier ones, its contour's and the last window's, in this order.
        """
        centre, corners = np.array([box["cx"], box["cy"]]), box["corners"]
        for n in earlier:
            node = self.nodes[n]
            if shapes.in_convex(centre, node["corners"]):
                node["centre"], node["corners"] = (node["centre"] + centre) / 2, (node["corners"] + corners) / 2
                self.changed.add(n)
                return n, False
        k = self.count
        self.count += 1
        self.nodes[k] = {"centre": centre, "corners": corners, "cls": box["cls"], "fallback": box["fallback"]}
        self.changed.add(k)
        for n in dict.fromkeys([*earlier, *contour, *self.previous]):
            if shapes.convex_overlap(corners, self.nodes[n]["corners"]):
                self.join(k, n)
                if o.single:
                    break
        return k, True

    def frame(self, boxes: pd.DataFrame, o: ParserOptions) -> None:
        """Fold one frame in; then earlier boxes beyond the raster's longer side from the vehicle are no longer looked at.

        Nearest boxes are those of earlier frames, by where they were when the
        frame began, within ``old_distance``. A frame without boxes changes
        nothing.
        """
        held = list(self.near)
        at = np.array([self.nodes[n]["centre"] for n in held]).reshape(-1, 2)
        most = o.old_distance or o.window * o.resolution
        new: list[int] = []
        for _, part in boxes.sort_values(["slice", "contour", "box"]).groupby("slice"):
            current: list[int] = []
            for _, contour in part.groupby("contour"):
                inside: list[int] = []
                for r in contour.to_dict("records"):
                    r["corners"] = np.array(r["corners"]).reshape(-1, 2)
                    d = np.hypot(*(at - (r["cx"], r["cy"])).T)
                    earlier = [held[j] for j in np.argsort(d, kind="stable")[: o.nearest] if d[j] < most]
                    k, is_new = self.add(r, o, earlier, inside)
                    inside.append(k)
                    new += [k] if is_new else []
                current += inside
            self.previous = current
        here = boxes[["x", "y"]].iloc[0].to_numpy(float)
        reach = float(boxes["reach"].iloc[0])
        self.near = [n for n, d in zip(held, np.hypot(*(at - here).T), strict=True) if d <= reach] + new

    def graphs(self) -> dict[int, Graph]:
        """Connected parts by their least node."""
        whole = Graph()
        for k, n in sorted(self.nodes.items()):
            whole.add(k, *map(float, n["centre"]), int(n["cls"]), int(n["fallback"]))
        for a, b in sorted(self.edges):
            whole.connect(a, b)
        return {part[0]: whole.induced(part) for part in whole.components()}


GRAPH_ROWS = "drive long, graph long, kind string, a long, b long, x double, y double, cls long, fallback long"


def fold_drives(boxes: DataFrame, options: ParserOptions = ParserOptions()) -> DataFrame:
    """Line graphs of every drive, boxes folded in the order of frames; graphs of one node go."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        state = DriveState()
        for _, part in pdf.sort_values("frame").groupby("frame"):
            state.frame(part, options)
        rows, drive = [], int(pdf["drive"].iloc[0])
        for k, g in state.graphs().items():
            if len(g.nodes) < 2:
                continue
            rows += [(drive, k, "node", n, None, x, y, c, f) for n, (x, y, c, f) in sorted(g.nodes.items())]
            rows += [(drive, k, "edge", a, b, None, None, None, None) for a in sorted(g.adj) for b in g.adj[a] if a < b]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in GRAPH_ROWS.split(", ")]).astype({c: "Int64" for c in ("drive", "graph", "a", "b", "cls", "fallback")} | {"x": "float64", "y": "float64"})

    return boxes.groupBy("drive").applyInPandas(run, GRAPH_ROWS)
