"""Names that a preset can use, and the extension points behind them."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions import camera
from roadweave.operators import blend, boxparser, graphs, linegraph
from roadweave.sources import images, survey

KINDS = ("source", "camera", "predictor", "model", "parser", "processor", "merge")
_NAMES: dict[str, dict[str, Any]] = {k: {} for k in KINDS}


def register(kind: str, name: str, item: Any) -> Any:
    if kind not in _NAMES:
        raise ValueError(f"no kind {kind}")
    _NAMES[kind][name] = item
    return item


def lookup(kind: str, name: str) -> Any:
    try:
        return _NAMES[kind][name]
    except KeyError:
        raise ValueError(f"no {kind} named {name}; there are {sorted(_NAMES[kind])}") from None


def load_folder(path: str, kind: str = "model") -> list[str]:
    """Register what every module of a folder lists in ``EXPORTS``."""
    found = []
    for file in sorted(Path(path).glob("*.py")):
        spec = importlib.util.spec_from_file_location(f"roadweave_custom_{file.stem}", file)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        for name, item in getattr(module, "EXPORTS", {}).items():
            register(kind, name, item)
            found.append(name)
    return found


class Predictor(Protocol):
    """Images to labelled pixels (E2): a batch with frame and data to rows frame, row, col, cls, weight."""

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame: ...


OBSERVATIONS = "frame long, row int, col int, cls int, weight double"


def observe(images: DataFrame, make: Callable[[], Predictor]) -> DataFrame:
    """A predictor over all images; it is made once a task and given batches (E2-E6, N1-N11 behind it)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = make()
        for batch in batches:
            yield predictor.predict(batch)

    return images.mapInPandas(run, OBSERVATIONS)


class ModelPredictor:
    """A model that gives a label image (E3), or class scores (E4, ``soft``), for each image array."""

    def __init__(self, model: Callable[[pd.Series], Any], soft: bool = False):
        self.model, self.soft = model, soft

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        rows = []
        for r in batch.to_dict("records"):
            out = np.asarray(self.model(r))
            if self.soft:
                row, col, cls = np.nonzero(out)
                weight = out[row, col, cls].astype(float)
            else:
                row, col = np.nonzero(out)
                cls, weight = out[row, col], np.ones(len(row))
            rows.append(pd.DataFrame({"frame": r["frame"], "row": row, "col": col, "cls": cls, "weight": weight}))
        return pd.concat(rows) if rows else pd.DataFrame(columns=["frame", "row", "col", "cls", "weight"])


class TwoHeadPredictor:
    """A model with a line head and a drivable head, class scores (classes, rows, cols) of each, as one label image.

    The drivable class comes after the line classes and counts only where the
    line head sees background; a model may have no second head. Labels are
    brought back from the model's size to the image's by the nearest pixel.
    """

    def __init__(self, model: Callable[[pd.Series], tuple[Any, Any]], size: tuple[int, int] | None = None):
        self.model, self.size = model, size

    def labels(self, image: dict) -> Any:
        import numpy as np

        line, area = self.model(image)
        drivable = np.shape(line)[0]
        out = np.argmax(line, axis=0)
        if area is not None:
            out = np.where(out == 0, np.argmax(area, axis=0) * drivable, out)
        if self.size is None:
            return out
        r, c = (np.minimum(np.arange(n) * m // n, m - 1) for n, m in zip(self.size, out.shape, strict=True))
        return out[np.ix_(r, c)]

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        return ModelPredictor(self.labels).predict(batch)


class ColourPredictor:
    """Pixels themselves, channels as classes 0 to 2 (E5)."""

    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        return ModelPredictor(lambda r: np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["channels"]), soft=True).predict(batch)


def single_class(observations: DataFrame, cls: int) -> DataFrame:
    """All foreground as one class."""
    return observations.withColumn("cls", F.when(F.col("cls") != 0, cls).otherwise(0))


def composed(main: DataFrame, other: DataFrame, merge: str = "fill") -> DataFrame:
    """Two predictors' observations merged frame by frame."""
    return lookup("merge", merge)(main, other)


def _fill(main: DataFrame, other: DataFrame) -> DataFrame:
    o = other.join(main.select("frame", "row", "col").distinct(), ["frame", "row", "col"], "left_anti")
    return main.unionByName(o)


@dataclass(frozen=True)
class TableProcessor:
    """A processor that sees all graphs at once: tables of nodes and edges to such tables."""

    run: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def head_connect(max_dist: float, ignore_shapes: bool = True, ignore_classes: list[int] | None = None, tails_only: bool = False) -> TableProcessor:
    """Ends of lines joined to other graphs in range (G8); ids are unique in the merged graphs."""

    def run(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        moved, links = linegraph.connect_heads(nodes, edges, max_dist, ignore_classes, tails_only, ignore_shapes)
        key = lambda g, n: F.xxhash64(g, n)
        rest = nodes.drop("x", "y", "cls", "type").withColumnRenamed("graph", "old_graph")
        out = moved.join(rest, ["old_graph", "node"]).withColumn("node", key("old_graph", "node"))
        ends = links.select(key("src_graph", "src").alias("src"), key("dst_graph", "dst").alias("dst"))
        made = ends.join(out.select("graph", F.col("node").alias("src")), "src").select("graph", "src", "dst")
        return out.drop("old_graph"), made

    return TableProcessor(run)


def to_utm(ref_lat: float, ref_lon: float, ref_h: float = 0.0) -> TableProcessor:
    """Nodes in local metres as UTM metres."""
    return TableProcessor(lambda nodes, edges: (graphs.to_utm(nodes, ref_lat, ref_lon, ref_h), edges))


def auto_circle(treshold: float | None = None, **parameters: Any) -> linegraph.Processor:
    """Rings of circles (G5); presets spell the limit ``treshold``."""
    return linegraph.auto_circle(**parameters, **({} if treshold is None else {"threshold": treshold}))


def box_parser(window_height: int, overlap_pixels: int, resolution: float, max_horizontal_box_size: int | None = None, old_candidate_distance: float | None = None, min_box_area: int = 1, node_conn_mode: str = "multiple", debug: bool = False) -> boxparser.ParserOptions:
    """The parser's options as presets name them; the first overlapping candidate only, or all of them (Q1)."""
    if str(node_conn_mode).lower() not in ("single", "multiple"):
        raise ValueError(f"no connection mode {node_conn_mode}")
    return boxparser.ParserOptions(window_height, overlap_pixels, resolution, max_horizontal_box_size, old_candidate_distance, min_box_area, str(node_conn_mode).lower() == "single")


# Names that presets use.
_PRESET_NAMES = {
    "processor": {
        "AutoCircleProcessor": auto_circle,
        "BiforcationRemoverProcessor": linegraph.fork_remove,
        "BoxReplaceProcessor": linegraph.box_replace,
        "CycleFlattenProcessor": linegraph.cycle_flatten,
        "DeadEndRemoverProcessor": linegraph.dead_end_remove,
        "DropTooShortProcessor": linegraph.drop_short,
        "EnuToUtmProcessor": to_utm,
        "FallbackClassProcessor": linegraph.fallback_class,
        "FitReplaceProcessor": linegraph.fit_replace,
        "HeadConnectorProcessor": head_connect,
        "LineSmoothProcessor": linegraph.line_smooth,
    },
    "camera": {"Camera": camera.pinhole_of, "LadybugCamera": camera.head_of},
    "parser": {"BoxImageParser": box_parser},
    "predictor": {"RGBPredictor": ColourPredictor, "ModelPredictor": ModelPredictor, "SDFPredictor": TwoHeadPredictor},
}
for _kind, _items in _PRESET_NAMES.items():
    for _name, _item in _items.items():
        register(_kind, _name, _item)
for _name in ("box_replace", "fit_replace", "cycle_flatten", "auto_circle", "line_smooth", "fork_remove", "dead_end_remove", "drop_short", "fallback_class"):
    register("processor", _name, getattr(linegraph, _name))
register("processor", "head_connect", head_connect)
register("processor", "to_utm", to_utm)
register("camera", "pinhole", camera.Pinhole)
register("camera", "panoramic_head", camera.PanoramicHead)
register("parser", "boxes", boxparser.ParserOptions)
register("predictor", "model", ModelPredictor)
register("predictor", "colour", ColourPredictor)
register("predictor", "two_heads", TwoHeadPredictor)
register("merge", "fill", _fill)
register("merge", "stack", blend.stack_halves)
register("source", "data_set", survey.data_set)
register("source", "survey_set", survey.survey_set)
register("source", "survey_images", images.SurveyImages)
register("source", "multi_camera", survey.multi_camera)
