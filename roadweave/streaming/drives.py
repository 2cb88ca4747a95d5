"""Surveys as streams: boxes folded while a drive goes on, extents by event time.

State is kept by drive and node: the boxes near the vehicle, so it does not grow
with the drive, and a batch writes only the nodes that it adds, moves or leaves
behind. What a frame adds is emitted as it is folded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadweave.operators.boxparser import BOXES, DriveState, ParserOptions
from roadweave.operators.components import connected_components
from roadweave.storage import materialize

UPDATES = "drive long, frame long, kind string, a long, b long, x double, y double, cls long, fallback long"
COLUMNS = [c.split()[0] for c in UPDATES.split(", ")]
BOX_COLUMNS = [c.split()[0] for c in BOXES.split(", ")]
#: State needs a store that holds maps by key.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DriveFold(StatefulProcessor):
    """The fold of one drive: a value for where it is, a map of the nodes it can still meet, a map of frames that wait."""

    def __init__(self, options: ParserOptions, hold: int):
        self.options, self.hold = options, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.about = handle.getValueState("about", "last long, count long")
        self.nodes = handle.getMapState("nodes", "node long", "cx double, cy double, corners array<double>, label long, fallback long, near boolean, place long")
        self.waiting = handle.getMapState("waiting", "frame long, box long", BOXES.replace("cls ", "label "))

    def close(self) -> None:
        """Nothing is held outside the state."""

    def _begun(self) -> tuple[int, DriveState, dict[int, tuple]]:
        """The last frame folded, the fold as it stood then, and its nodes as they are stored."""
        last, fold = -1, DriveState()
        if self.about.exists():
            last, fold.count = self.about.get()
        stored = {k[0]: tuple(v) for k, v in self.nodes.iterator()}
        for k, (x, y, corners, cls, fallback, _, _) in sorted(stored.items()):
            fold.nodes[k] = {"centre": np.array([x, y]), "corners": np.reshape(corners, (-1, 2)), "cls": cls, "fallback": fallback}
        fold.near = [k for k in sorted(stored) if stored[k][5]]
        fold.previous = sorted((k for k in stored if stored[k][6] >= 0), key=lambda k: stored[k][6])
        return last, fold, stored

    def _keep(self, last: int, fold: DriveState, stored: dict[int, tuple]) -> None:
        self.about.update((last, fold.count))
        near, place = set(fold.near), {n: k for k, n in enumerate(fold.previous)}
        for k in stored.keys() - near - place.keys():
            self.nodes.removeKey((k,))
        for k in sorted(near | place.keys()):
            n = fold.nodes[k]
            row = (*map(float, n["centre"]), [float(v) for v in np.ravel(n["corners"])], int(n["cls"]), int(n["fallback"]), k in near, place.get(k, -1))
            if stored.get(k) is None or (*stored[k][:2], list(stored[k][2]), *stored[k][3:]) != row:
                self.nodes.updateValue((k,), row)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, fold, stored = self._begun()
        held = [tuple(v) for _, v in self.waiting.iterator()]
        parts = [p[BOX_COLUMNS] for p in rows]
        pdf = pd.concat([pd.DataFrame(held, columns=BOX_COLUMNS), *parts] if held else parts, ignore_index=True)
        out = [(key[0], int(f), "late", None, None, None, None, None, None) for f in sorted(pdf.loc[pdf["frame"] <= last, "frame"].unique())]
        pdf = pdf[pdf["frame"] > last]
        until = pdf["frame"].max() - self.hold
        for frame, part in pdf[pdf["frame"] <= until].sort_values("frame").groupby("frame"):
            fold.frame(part, self.options)
            nodes, edges = fold.drain_rows()
            out += [(key[0], int(frame), "node", *n) for n in nodes] + [(key[0], int(frame), "edge", a, b, None, None, None, None) for a, b in edges]
            fold.forget()
            last = int(frame)
        self._keep(last, fold, stored)
        self.waiting.clear()
        for k, r in enumerate(pdf[pdf["frame"] > until].itertuples(index=False)):
            self.waiting.updateValue((int(r.frame), k), tuple(v.tolist() if isinstance(v, (np.ndarray, np.generic)) else v for v in r))
        yield pd.DataFrame(out, columns=COLUMNS).astype({c: "Int64" for c in ("drive", "frame", "a", "b", "cls", "fallback")} | {"x": "float64", "y": "float64"})


def fold_stream(boxes: DataFrame, options: ParserOptions = ParserOptions(), hold: int = 0) -> DataFrame:
    """Nodes and edges of each drive's graphs as frames of boxes arrive.

    A node row is new, or moves the node of that id; edges come once. Frames are
    folded in order: the last ``hold`` ones wait for stragglers, and a frame
    that arrives after a later one was folded is a row of kind ``late`` and is
    not folded. ``graphs_of`` makes graphs of the rows. The session's state
    store becomes one that holds maps by key.
    """
    boxes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return boxes.groupBy("drive").transformWithStateInPandas(DriveFold(options, hold), UPDATES, "append", "None")


def graphs_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (drive, graph, node, x, y, cls, fallback) and edges (drive, graph, src, dst) of what ``fold_stream`` has emitted; a graph is named by its least node, and graphs of one node go."""
    rows = materialize(rows, "folded")
    last = Window.partitionBy("drive", "a").orderBy(F.desc("frame"))
    nodes = rows.where("kind = 'node'").withColumn("__k", F.row_number().over(last)).where("__k = 1").select("drive", F.col("a").alias("node"), "x", "y", "cls", "fallback")
    edges = rows.where("kind = 'edge'").select("drive", F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    of = connected_components(edges.select(F.struct("drive", F.col("src").alias("node")).alias("src"), F.struct("drive", F.col("dst").alias("node")).alias("dst")))
    of = of.select(F.col("node.drive").alias("drive"), F.col("node.node").alias("node"), F.col("component.node").alias("graph"))
    named = nodes.join(of, ["drive", "node"])
    return named.select("drive", "graph", "node", "x", "y", "cls", "fallback"), edges.join(named.select("drive", "graph", F.col("node").alias("src")), ["drive", "src"]).select("drive", "graph", "src", "dst")


def stream_extents(positions: DataFrame, delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Extents of each drive by window of event time; late positions count within ``delay``."""
    return positions.withWatermark("ts", delay).groupBy(F.window("ts", window), "drive").agg(F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y"), F.count("*").alias("n"))
