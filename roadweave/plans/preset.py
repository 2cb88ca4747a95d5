"""Presets: one JSON document that says what all stages do (the configuration surface)."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from enum import Enum
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions import geo
from roadweave.functions.camera import BirdView, Pinhole
from roadweave.operators import blend, boxparser, graphs, lanes, linegraph, placement
from roadweave.plans.registry import TableProcessor, lookup
from roadweave.sources import store
from roadweave.storage import materialize


# Members of the options and how presets spell them.
class AngleMode(Enum):
    GPS = "gps"
    ESTIMATED = "estimated"
    ONLY_OFFSET = "only_offset"


class SmoothMode(Enum):
    NONE = "none"
    ANGLE = "angle"
    POSITION = "position"
    ALL = "all"


class BlendMode(Enum):
    SUM = "sum"
    AVERAGE = "avg"
    ENHANCE_OVERLAP = "overlap"


#: Blends by their option.
BLENDS = {BlendMode.SUM: "sum", BlendMode.AVERAGE: "average", BlendMode.ENHANCE_OVERLAP: "enhance"}


def member(kind: type[Enum], text: Any) -> Enum:
    """An option by its value or name, in any case (Q1); others are an error."""
    found = [m for m in kind if str(text).lower() in (m.value, m.name.lower())]
    if not found:
        raise ValueError(f"no {kind.__name__} {text}; there are {[m.value for m in kind]}")
    return found[0]


@dataclass
class DatasetOptions:
    images: str = ""
    car_gps: str = ""
    img_format: str = "png"
    name_regex: str | None = None
    start: int = 0
    end: int = -1


@dataclass
class CameraOptions:
    name: str = "Camera"
    parameters: dict[str, Any] = field(default_factory=dict)


@dataclass
class BevOptions:
    view_size: tuple[float, float, float, float] = (0.0, 10.0, -10.0, 10.0)
    resolution: float = 0.05
    offset_angle: float = 0.0
    center_of_rotation: tuple[int, int] | None = None
    mask_bev: bool = False
    camera: CameraOptions = field(default_factory=CameraOptions)


@dataclass
class ModelOptions:
    name: str | None = None
    path: str = ""
    num_classes: int | None = None
    parameters: dict[str, Any] = field(default_factory=dict)
    predict_size: tuple[int, int] = (384, 640)
    checkpoint: str | None = None


@dataclass
class MappingOptions:
    symmetric_offset: float = 0
    split_after_frames: int = 100
    limit_chunks: int | None = None
    angle_mode: AngleMode = AngleMode.ESTIMATED
    smooth_mode: SmoothMode = SmoothMode.NONE
    blend_mode: BlendMode | None = None  # by the preset's mode
    saveimages: bool = False
    folder: str = "Images"


@dataclass
class ParserChoice:
    name: str = "BoxImageParser"
    parameters: dict[str, Any] = field(default_factory=dict)


@dataclass
class GraphOptions:
    start: int = 0
    end: int = -1
    step: int = 1
    area_size: tuple[float, float] = (20.0, 20.0)
    min_area_size: int | None = None
    ignore_classes: list[int] = field(default_factory=list)
    parser: ParserChoice = field(default_factory=ParserChoice)


@dataclass
class StackItem:
    processor: str
    parameters: dict[str, Any] = field(default_factory=dict)
    enabled: bool = True


@dataclass
class LaneOptions:
    input_path: str = ""
    output_file: str = ""
    annotated_map_path: str | None = None
    zone_number: int = 33
    zone_letter: str = "N"
    car_height: float = 0.0
    min_lane_size: float = 1.5
    max_lane_size: float = 6.0
    search_tolerance: float = 0.5
    ignore_classes: list[int] = field(default_factory=lambda: [9, 10, 13, 14])
    max_corner_angle: float = 60.0
    sharp_angle_generate_splits: bool = False
    min_node_path_len: int = 10


@dataclass
class Preset:
    mode: str = "class"
    output_root: str = "/app/output"
    dataset: DatasetOptions = field(default_factory=DatasetOptions)
    bev: BevOptions = field(default_factory=BevOptions)
    model: ModelOptions = field(default_factory=ModelOptions)
    mapping: MappingOptions = field(default_factory=MappingOptions)
    graph: GraphOptions = field(default_factory=GraphOptions)
    stack: list[StackItem] = field(default_factory=list)
    min_nodes: int = 2
    lanes: LaneOptions = field(default_factory=LaneOptions)

    @property
    def blend(self) -> str:
        """Classes are enhanced where frames overlap, colours averaged, unless the preset says otherwise."""
        return BLENDS[self.mapping.blend_mode or (BlendMode.ENHANCE_OVERLAP if self.mode == "class" else BlendMode.AVERAGE)]


def _fields(kind: type, values: dict | None) -> dict:
    return {k: tuple(v) if isinstance(v, list) and k in ("view_size", "center_of_rotation", "area_size", "predict_size") else v for k, v in (values or {}).items() if k in kind.__dataclass_fields__ and v is not None}


def parse(document: str | dict) -> Preset:
    """A preset from JSON; unknown modes, options, cameras, parsers and processors are errors, unknown keys are left out."""
    d = json.loads(document) if isinstance(document, str) else document
    mode = d.get("mode", "class")
    if mode not in ("class", "RGB"):
        raise ValueError(f"no mode {mode}")
    mapping = d.get("pixel-mapping", {})
    m = _fields(MappingOptions, mapping.get("parameters")) | _fields(MappingOptions, mapping.get("visualization"))
    for key, kind in (("angle_mode", AngleMode), ("smooth_mode", SmoothMode), ("blend_mode", BlendMode)):
        if key in m:
            m[key] = member(kind, m[key])
    bev = _fields(BevOptions, d.get("bev"))
    if "camera" in bev:
        bev["camera"] = CameraOptions(**_fields(CameraOptions, bev["camera"]))
        lookup("camera", bev["camera"].name)
    g = _fields(GraphOptions, d.get("graph-mapping"))
    if "parser" in g:
        g["parser"] = ParserChoice(**_fields(ParserChoice, g["parser"]))
        lookup("parser", g["parser"].name)
    post = d.get("postprocessing", {})
    stack = [StackItem(x["processor"], x.get("parameters", {}), x.get("enabled", True)) for x in post.get("stack", [])]
    for item in stack:
        lookup("processor", item.processor)
    return Preset(
        mode, d.get("output_root", "/app/output"), DatasetOptions(**_fields(DatasetOptions, d.get("dataset"))), BevOptions(**bev), ModelOptions(**_fields(ModelOptions, d.get("model"))),
        MappingOptions(**m), GraphOptions(**g), stack, max(2, post.get("min_nodes", 2)), LaneOptions(**_fields(LaneOptions, d.get("lanelet2"))),
    )


def to_json(p: Preset) -> str:
    return json.dumps(asdict(p), default=lambda x: x.value)


def camera_of(p: Preset) -> Pinhole:
    """The preset's camera."""
    return lookup("camera", p.bev.camera.name)(**p.bev.camera.parameters)


def bird_view(p: Preset) -> BirdView:
    """The preset's view of the ground."""
    return BirdView(camera_of(p), p.bev.view_size, p.bev.resolution)


def parser_options(p: Preset) -> boxparser.ParserOptions:
    """The preset's parser."""
    return lookup("parser", p.graph.parser.name)(**p.graph.parser.parameters)


def build_raster(observations: DataFrame, frames: DataFrame, p: Preset, smooth: bool = False) -> tuple[DataFrame, DataFrame]:
    """Stage 2's map and its chunks: observations (frame, row, col, cls, weight) of bird's-eye views, placed by the poses ``frames``.

    With a smooth mode, ``frames`` also has smooth_x, smooth_y and
    smooth_heading. With ``mask_bev`` only what the camera's image shows counts
    (P7).
    """
    if p.bev.mask_bev:
        seen = bird_view(p).coverage(*reversed(p.model.predict_size))
        rows_, cols_ = (x.tolist() for x in seen.nonzero())
        shown = observations.sparkSession.createDataFrame(list(zip(rows_, cols_, strict=True)), "row int, col int")
        observations = observations.join(F.broadcast(shown), ["row", "col"], "left_semi")
    rows, cols = bird_view(p).size if p.bev.camera.parameters else (int(round(a / p.bev.resolution)) for a in (p.bev.view_size[1] - p.bev.view_size[0], p.bev.view_size[3] - p.bev.view_size[2]))
    m = p.mapping
    if m.smooth_mode in (SmoothMode.POSITION, SmoothMode.ALL):
        frames = frames.drop("x", "y").withColumnsRenamed({"smooth_x": "x", "smooth_y": "y"})
    mode = m.angle_mode.value
    if m.smooth_mode in (SmoothMode.ANGLE, SmoothMode.ALL) and m.angle_mode is not AngleMode.ONLY_OFFSET:
        frames, mode = frames.drop("heading").withColumnRenamed("smooth_heading", "heading"), AngleMode.GPS.value
    return placement.build_map(observations, frames, (rows, cols), p.bev.resolution, p.bev.center_of_rotation or (cols // 2, rows // 2), mode, p.bev.offset_angle, m.symmetric_offset, m.split_after_frames, m.limit_chunks, p.blend)


def drivable_class(p: Preset) -> int | None:
    """The last of the model's classes."""
    return p.model.num_classes - 1 if p.model.num_classes else None


def regions(pixels: DataFrame, chunks: DataFrame, frames: DataFrame, p: Preset) -> DataFrame:
    """Stage 3's labelled windows round every position, cleaned of small blobs chunk by chunk.

    Blobs are of all classes but background and the drivable one, which weighs a
    tenth there. Windows have the best class ``cls`` and the one after it,
    ``second``; they are turned by the way from the position before.
    """
    drivable = drivable_class(p)
    if p.graph.min_area_size is not None:
        best = placement.region_labels(pixels.select("chunk", "row", "col", "cls", "weight"), drivable=drivable, drivable_factor=0.1)
        best = best.where("cls <> 0" if drivable is None else f"cls not in (0, {drivable})")
        small = graphs.foreground_blobs(best, ["chunk"]).where(F.col("area") <= p.graph.min_area_size)
        pixels = pixels.join(small.select("chunk", "row", "col"), ["chunk", "row", "col"], "left_anti")
    at = placement.frame_angles(frames, AngleMode.ESTIMATED.value, 0.0)
    return placement.labelled_regions(pixels, chunks, at, p.graph.area_size, p.bev.resolution, p.graph.ignore_classes, drivable, second=True)


def line_graphs(pixels: DataFrame, chunks: DataFrame, frames: DataFrame, p: Preset) -> tuple[DataFrame, DataFrame]:
    """Stage 3 whole: nodes and edges of cleaned graphs, from the map and the poses (frame, x, y and, with several, drive).

    Frames from ``start`` up to ``end`` (-1: all), every ``step``-th, are parsed;
    each looks at the map turned so that it runs upwards.
    """
    g = p.graph
    drive = F.col("drive") if "drive" in frames.columns else F.lit(0)
    windows = regions(pixels, chunks, frames, p).join(frames.select("frame", drive.cast("long").alias("drive")), "frame")
    taken = (F.col("frame") >= g.start) & ((F.col("frame") - g.start) % g.step == 0)
    windows = windows.where(taken if g.end == -1 else taken & (F.col("frame") < g.end))
    windows = windows.select("drive", F.col("frame").cast("long").alias("frame"), "row", "col", F.col("cls").alias("best"), "second", "x", "y", F.col("at_row").cast("double").alias("centre_row"), F.col("at_col").cast("double").alias("centre_col"), F.col("to_vertical").alias("turn"))
    o = parser_options(p)
    rows = materialize(boxparser.fold_drives(boxparser.find_boxes(windows, o), o), "drive-graphs")
    name = F.xxhash64("drive", "graph").alias("graph")
    nodes = rows.where("kind = 'node'").select(name, F.col("a").alias("node"), "x", "y", "cls", "fallback")
    edges = rows.where("kind = 'edge'").select(name, F.col("a").alias("src"), F.col("b").alias("dst"))
    return clean_graphs(nodes, edges, p)


def clean_graphs(nodes: DataFrame, edges: DataFrame, p: Preset) -> tuple[DataFrame, DataFrame]:
    """Stage 3's stack in order, then the final filter.

    Processors of single graphs that follow each other are one pass; those that
    see all graphs work on tables between them.
    """
    stack = [lookup("processor", x.processor)(**x.parameters) for x in p.stack if x.enabled]
    held: list = []

    def flush(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = linegraph.renumber(linegraph.process(linegraph.to_rows(nodes, edges), *held))
        held.clear()
        return linegraph.nodes_of(rows).drop("part"), linegraph.edges_of(rows).drop("part")

    for item in stack:
        if isinstance(item, TableProcessor):
            nodes, edges = item.run(*(flush(nodes, edges) if held else (nodes, edges)))
        else:
            held.append(item)
    if held or not stack:
        nodes, edges = flush(nodes, edges)
    kept = graphs.drop_small_graphs(nodes, p.min_nodes)
    return kept, edges.join(kept.select("graph").distinct(), "graph", "left_semi")


def find_lanes(nodes: DataFrame, edges: DataFrame, p: Preset) -> lanes.Lanes:
    """Stage 4's lanes of cleaned graphs by the preset's options."""
    o = p.lanes
    return lanes.find_lanes(nodes, edges, o.min_lane_size, o.max_lane_size, o.search_tolerance, list(o.ignore_classes), o.max_corner_angle if o.sharp_angle_generate_splits else None, min_node_path_len=o.min_node_path_len)


def map_file(nodes: DataFrame, edges: DataFrame, p: Preset, path: str | None = None) -> lanes.Lanes | None:
    """Stage 4 whole: lanes of cleaned graphs as one OSM file, nodes being UTM metres of the preset's zone; the lanes found.

    The map's origin is the first node of the first graph. With an annotated
    path the graphs are written there with their lines and lanes. Graphs without
    a node write nothing.
    """
    nodes, edges = materialize(nodes, "map-nodes"), materialize(edges, "map-edges")
    first = nodes.orderBy("graph", "node").select("x", "y").first()
    if first is None:
        return None
    o, path = p.lanes, path or p.lanes.output_file
    origin, northern = (first["x"], first["y"], 0.0), o.zone_letter.upper() >= "N"
    found = find_lanes(nodes, edges, p)
    points, ways, lanelets = lanes.map_elements(found, nodes, origin, list(o.ignore_classes), o.car_height)
    if "type" in nodes.columns:
        at = nodes.where("type in ('box', 'shape')").groupBy("graph").agg(F.min_by("cls", "node").alias("cls"), F.sort_array(F.collect_list(F.struct("node", "x", "y"))).alias("c")).where(F.size("c") == 4)
        corners = at.select("graph", "cls", F.transform("c", lambda n: F.struct(n["x"].alias("x"), n["y"].alias("y"))).alias("corners"))
        more = lanes.shape_elements(corners, origin)
        points, ways, lanelets = points.unionByName(more[0]), ways.unionByName(more[1]), lanelets.unionByName(more[2])
    there = nodes.sparkSession.range(1).select(*[c.alias(k) for c, k in zip(geo.utm_to_latlon(F.lit(origin[0]), F.lit(origin[1]), o.zone_number, northern), ("lat", "lon"), strict=True)]).first()
    elements = store.osm_elements(lanes.on_globe(points, origin, o.zone_number, northern), ways, lanelets)
    store.write_osm(elements, path, (there["lat"], there["lon"]), f"UTM {o.zone_number}{o.zone_letter}", "lat lon")
    if o.annotated_map_path:
        store.export_graphs(annotated(nodes, found), edges, o.annotated_map_path)
    return found


def annotated(nodes: DataFrame, found: lanes.Lanes) -> DataFrame:
    """``nodes`` with the ids of their linestrings and lanelets."""
    at = found.lines.select("ls", "graph", F.explode("nodes").alias("node"))
    sides = found.lanes.select(F.xxhash64("right_ls", "left_ls").alias("lane"), F.explode(F.array("right_ls", "left_ls")).alias("ls"))
    by = at.join(sides, "ls", "left").groupBy("graph", "node").agg(F.sort_array(F.collect_set("ls")).alias("linestrings"), F.sort_array(F.collect_set("lane")).alias("lanelets"))
    return nodes.join(by, ["graph", "node"], "left")


def run(observations: DataFrame, frames: DataFrame, p: Preset, path: str | None = None) -> lanes.Lanes | None:
    """Stages 2 to 4 in a row, from observations and poses to the OSM file; each stage's tables are written."""
    pixels, chunks = build_raster(observations, frames, p)
    pixels, chunks = materialize(pixels, "map-pixels"), materialize(chunks, "map-chunks")
    return map_file(*line_graphs(pixels, chunks, frames, p), p, path)
