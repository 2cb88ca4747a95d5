"""Sources, stores, presets, the box parser and streams."""

import json
import struct
import xml.etree.ElementTree as et
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadweave.operators import boxparser, linegraph, poses
from roadweave.plans import preset, registry
from roadweave.sources import images, store, survey
from roadweave.streaming import drives


@pytest.fixture
def drive(tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    for k in (1, 2, 4, 10):
        (images / f"cam_{k}.png").write_bytes(store.png(np.full((2, 3, 3), k, np.uint8)))
    (images / "notes.txt").write_text("x")
    rows = [{"sequence": s, "x": float(s), "y": 0.0, "z": 1.0, "heading": 0.0, "roll": 0.0, "pitch": 0.0} for s in (1, 3, 5)]
    (tmp_path / "log.json").write_text(json.dumps(rows))
    (tmp_path / "log.csv").write_text("y,sequence,x,z,heading,roll,pitch\n" + "".join(f"0.0,{r['sequence']},{r['x']},1.0,0,0,0\n" for r in rows))
    return tmp_path


def test_alignment_from_files(spark, drive):
    names = survey.image_names(spark, str(drive / "images"), "PNG", r"cam_(\d+)")
    assert sorted(r["sequence"] for r in names.collect()) == [1, 2, 4, 10]
    out = survey.aligned(survey.gps_log(spark, str(drive / "log.json")), names)
    assert {r["sequence"]: r["x"] for r in out.collect()} == {1: 1.0, 2: 2.0, 4: 4.0, 10: 5.0}
    assert survey.gps_log(spark, str(drive / "log.csv")).count() == 3
    survey.write_poses(out, str(drive / "aligned"))
    frames = survey.data_set(spark, str(drive / "images"), str(drive / "aligned"), start=1, end=3, name_regex=r"cam_(\d+)")
    assert [(r["frame"], r["sequence"]) for r in frames.orderBy("frame").collect()] == [(0, 2), (1, 4)]
    assert frames.where(F.col("path").endswith("cam_2.png")).count() == 1


def test_images_decode_and_become_pixels(spark, drive):
    px = store.image_pixels(survey.decoded(spark, str(drive / "images")))
    assert px.count() == 4 * 6 and px.where(F.col("path").endswith("cam_4.png")).agg(F.max("r")).first()[0] == 4


def test_images_are_resized(spark, drive):
    out = survey.decoded(spark, str(drive / "images"), (4, 6)).collect()
    assert {(r["height"], r["width"], len(r["data"])) for r in out} == {(4, 6, 72)} and {x for r in out for x in r["data"]} == {1, 2, 4, 10}
    ramp = np.arange(4, dtype=np.uint8).reshape(1, 4, 1) * 10
    assert survey.resized(ramp, (1, 2)).ravel().tolist() == [5, 25] and survey.resized(ramp, (1, 8)).ravel().tolist() == [0, 3, 8, 13, 18, 23, 28, 30]


def test_survey_set_counts_must_match(spark, drive):
    log = drive / "survey.tsv"
    log.write_text("id\tx\ty\tz\tyaw\troll\tpitch\tclock\n" + "".join(f"{k}\t{k}.0\t0\t0\t90\t0\t0\t20240101000000{k:03d}\n" for k in range(4)))
    out = survey.survey_set(spark, str(drive / "images"), str(log), "png").orderBy("frame").collect()
    assert [r["path"].rsplit("_", 1)[1] for r in out] == ["1.png", "2.png", "4.png", "10.png"]
    assert out[1]["heading"] == pytest.approx(np.pi / 2) and out[1]["seconds"] == pytest.approx(1704067200.001)
    log.write_text(log.read_text() + "9\t0\t0\t0\t0\t0\t0\t20240101000000000\n")
    with pytest.raises(ValueError):
        survey.survey_set(spark, str(drive / "images"), str(log), "png")


def test_survey_images_as_a_source(spark, tmp_path):
    folder = tmp_path / "images"
    folder.mkdir()
    for k in range(20):
        (folder / f"cam_{k:04d}.PNG").write_bytes(bytes([k]))
    (folder / "other.txt").write_text("x")
    images.register(spark)
    df = spark.read.format("survey_images").option("path", str(folder)).option("files", 4).load()
    assert [(r["frame"], r["sequence"], bytes(r["data"])) for r in df.orderBy("frame").collect()] == [(k, k, bytes([k])) for k in range(20)] and df.rdd.getNumPartitions() == 5
    some = df.where("frame >= 6 and frame < 11 and sequence <> 8")
    assert sorted(r["frame"] for r in some.select("frame").collect()) == [6, 7, 9, 10] and some.rdd.getNumPartitions() == 2
    assert "BatchScan survey_images" in some._jdf.queryExecution().executedPlan().toString()
    assert df.where("frame = 3").count() == 1 and df.where("frame > 18").count() == 1 and df.where("frame <= 1").count() == 2
    reader = images.FramesReader({"path": str(folder), "name_regex": "cam_000"})
    assert [p.names[0] for p in reader.partitions()] == ["cam_0000.PNG"] and len(reader.partitions()[0].names) == 10
    q = None
    for part in range(2):
        if part:
            (folder / "cam_0020.png").write_bytes(b"z")
            q.processAllAvailable()
        else:
            q = spark.readStream.format("survey_images").option("path", str(folder)).load().select("frame", "path").writeStream.format("memory").queryName("seen_frames").option("checkpointLocation", str(tmp_path / "c")).start()
            q.processAllAvailable()
    q.stop()
    assert sorted(r["frame"] for r in spark.table("seen_frames").collect()) == list(range(21))
    with pytest.raises(Exception, match="path"):
        spark.read.format("survey_images").load().count()


def test_smoothed_track(spark):
    rng = np.random.default_rng(2)
    t = np.cumsum(rng.uniform(0.1, 3.0, 200))  # uneven times
    xy = np.column_stack([np.sin(t / 30) * 40, np.cos(t / 30) * 40])
    noisy = xy + rng.normal(0, 0.1, xy.shape)
    rows = [("a", k, float(t[k]), float(x), float(y)) for k, (x, y) in enumerate(noisy)] + [("b", 0, 0.0, 1.0, 2.0), ("b", 1, 1.0, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "track string, frame int, at double, x double, y double")
    out = survey.smoothed(df, 0.03, time="at").toPandas().sort_values(["track", "frame"])
    a, b = out[out["track"] == "a"], out[out["track"] == "b"]
    moved = a[["smooth_x", "smooth_y"]].to_numpy()
    assert ((moved - noisy) ** 2).sum() <= 0.03 * 200 and np.abs(moved - xy).max() < 0.35
    turn = np.angle(np.exp(1j * (a["smooth_heading"].to_numpy() - np.arctan2(-np.sin(t / 30), np.cos(t / 30)))))
    assert np.abs(turn).max() < 0.35
    assert b[["smooth_x", "smooth_y", "smooth_heading"]].to_numpy().tolist() == [[1.0, 2.0, 0.0], [2.0, 2.0, 0.0]]
    exact = survey.smoothed(df, 0.0, time="at").where("track = 'a'").toPandas().sort_values("frame")
    assert np.allclose(exact[["smooth_x", "smooth_y"]], noisy)


def test_chunks_are_pruned(spark, tmp_path):
    px = spark.createDataFrame([(k, 0, 0, 1, 1.0) for k in range(4)], "chunk int, row int, col int, cls int, weight double")
    store.write_chunks(px, spark.createDataFrame([(k, 0.05) for k in range(4)], "chunk int, resolution double"), str(tmp_path / "map"))
    part = store.read_chunks(spark, str(tmp_path / "map"), [2])
    assert part.count() == 1 and store.read_chunk_info(spark, str(tmp_path / "map")).count() == 4
    assert "PartitionFilters: [isnotnull(chunk" in part._jdf.queryExecution().executedPlan().toString()


def test_graph_files_round_trip(spark, tmp_path):
    nodes = spark.createDataFrame([(0, k, float(k), 0.0, 1, 2, None) for k in range(4)] + [(1, 0, 0.0, 0.0, 1, None, "box")], "graph long, node long, x double, y double, cls int, fallback int, type string")
    edges = spark.createDataFrame([(0, 0, 1), (0, 2, 3)], "graph long, src long, dst long")
    store.export_graphs(nodes, edges, str(tmp_path / "g"))
    n, e = store.load_graphs(spark, str(tmp_path / "g"))
    assert n.count() == 4 and n.select("graph").distinct().count() == 2 and e.count() == 2


def test_osm_file(spark, tmp_path):
    points = spark.createDataFrame([(1, 45.0, 9.0, 1.5), (2, 45.1, 9.1, 1.5)], "id long, lat double, lon double, ele double")
    ways = spark.createDataFrame([(10, [1, 2], "line_thin", 'so"lid'), (11, [2, 1], "line_thin", "dashed")], "id long, nodes array<long>, type string, subtype string")
    lets = spark.createDataFrame([(20, 10, 11, "road")], "id long, left_way long, right_way long, subtype string")
    store.write_osm(store.osm_elements(points, ways, lets), str(tmp_path / "m.osm"), (1.0, 2.0), "33N")
    import xml.etree.ElementTree as et

    root = et.parse(tmp_path / "m.osm").getroot()
    assert [len(root.findall(k)) for k in ("node", "way", "relation")] == [2, 2, 1]
    assert json.loads((tmp_path / "m.osm.info.json").read_text())["zone"] == "33N"


def test_png_is_valid(spark):
    raw = store.png(np.zeros((2, 2, 3), np.uint8))
    assert raw[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", raw[16:24]) == (2, 2)
    assert struct.unpack(">I", raw[29:33])[0] == zlib.crc32(raw[12:29])
    df = spark.createDataFrame([(1, 0, 0, 9, 8, 7)], "chunk long, row int, col int, r int, g int, b int")
    assert bytes(store.chunk_images(df).first()["image"])[:4] == b"\x89PNG"


def regions(spark, frames=4):
    """A straight line of class 1 that the vehicle follows upwards."""
    rows = []
    for f in range(frames):
        rows += [(0, f, r, c, int(8 <= c < 12), 2 * int(8 <= c < 12), 0.0, f * 1.0) for r in range(40) for c in range(20)]
    return spark.createDataFrame(rows, "drive long, frame long, row int, col int, best int, second int, tl_x double, tl_y double")


def test_parser_links_one_line(spark):
    o = boxparser.ParserOptions(window=16, overlap=8)
    boxes = boxparser.find_boxes(regions(spark), o)
    assert boxes.where("cls = 1 and fallback = 2").count() == boxes.count() > 10
    out = boxparser.fold_drives(boxes, o)
    assert out.where("kind = 'node'").select("graph").distinct().count() == 1
    n, e = (out.where(f"kind = '{k}'").count() for k in ("node", "edge"))
    assert e >= n - 1 > 2


def test_fold_as_a_stream(spark, tmp_path):
    o = boxparser.ParserOptions(window=16, overlap=8)
    boxes = boxparser.find_boxes(regions(spark, 8), o)
    q = None
    for k, frames in enumerate(("frame in (0, 1, 2)", "frame in (3, 5)", "frame in (4, 6)", "frame in (1, 7)")):
        boxes.where(frames).write.parquet(str(tmp_path / f"in/{k}"))
        if q is None:
            stream = spark.readStream.schema(boxes.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
            q = drives.fold_stream(stream, o, hold=1).writeStream.outputMode("append").format("memory").queryName("folded").option("checkpointLocation", str(tmp_path / "c")).start()
        q.processAllAvailable()
    q.stop()
    rows = spark.table("folded")
    # frame 4 came while 5 was waiting; frame 1 came too late; 7 still waits
    assert [r["frame"] for r in rows.where("kind = 'late'").collect()] == [1]
    assert {r["frame"] for r in rows.where("kind = 'node'").collect()} <= set(range(7))
    n, e = drives.graphs_of(rows)
    whole = boxparser.fold_drives(boxes.where("frame < 7"), o)
    at = lambda df, *c: sorted(tuple(round(x, 6) for x in r) for r in df.select(*c).collect())
    assert at(n, "node", "x", "y") == at(whole.where("kind = 'node'"), "a", "x", "y") and n.select("graph").distinct().count() == 1
    assert at(e, "src", "dst") == at(whole.where("kind = 'edge'"), "a", "b")


def test_stream_extents(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:01", 1.0, 2.0), (1, "2024-01-01 00:01:00", 3.0, 0.0)], "drive long, ts string, x double, y double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "p"))
    q = drives.stream_extents(spark.readStream.schema(df.schema).parquet(str(tmp_path / "p"))).writeStream.outputMode("update").format("memory").queryName("ext").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert tuple(spark.table("ext").select("min_x", "max_x", "n").first()) == (1.0, 3.0, 2)


PRESET = {
    "mode": "class", "dataset": {"start": 2, "name_regex": "a"}, "bev": {"view_size": [0, 2, -1, 1], "resolution": 1.0}, "pixel-mapping": {"parameters": {"blend_mode": "AVERAGE", "split_after_frames": 2, "angle_mode": "only_offset"}},
    "postprocessing": {"stack": [{"processor": "dead_end_remove"}, {"processor": "line_smooth", "parameters": {"smooth_coeff": 1.0}, "enabled": False}], "min_nodes": 1}, "lanelet2": {"max_corner_angle": 45},
}


def test_presets(spark):
    p = preset.parse(json.dumps(PRESET))
    assert (p.mapping.blend_mode, p.min_nodes, p.lanes.max_corner_angle, p.dataset.start, p.graph.step) == (preset.BlendMode.AVERAGE, 2, 45, 2, 1)
    assert json.loads(preset.to_json(p))["mapping"]["blend_mode"] == "avg"
    for bad in ({"mode": "other"}, {"postprocessing": {"stack": [{"processor": "none"}]}}, {"pixel-mapping": {"parameters": {"angle_mode": "sideways"}}}, {"bev": {"camera": {"name": "none"}}}, {"graph-mapping": {"parser": {"name": "none"}}}):
        with pytest.raises(ValueError):
            preset.parse(bad)
    obs = spark.createDataFrame([(f, 1, 1, 1, 1.0) for f in range(4)], "frame int, row int, col int, cls int, weight double")
    frames = spark.range(4).select(F.col("id").cast("int").alias("frame"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("heading"))
    px, chunks = preset.build_raster(obs, frames, p)
    assert chunks.count() == 2 and sorted((r["chunk"], r["weight"]) for r in px.collect()) == [(0, 1.0), (1, 1.0)]
    nodes = spark.createDataFrame([(0, k, float(k), 0.0, 1) for k in range(5)] + [(0, 9, 2.0, 1.0, 1)], "graph long, node long, x double, y double, cls int")
    edges = spark.createDataFrame([(0, k, k + 1) for k in range(4)] + [(0, 2, 9)], "graph long, src long, dst long")
    n, e = preset.clean_graphs(nodes, edges, p)
    assert sorted(r["node"] for r in n.collect()) == [0, 1, 2, 3, 4] and e.count() == 4


#: A survey's whole preset, section by section as users write them, with values of our own.
WHOLE = {
    "mode": "class", "output_root": "/out", "dataset": {"images": "/in/front", "img_format": "jpg", "car_gps": "/in/poses.csv", "start": 40, "end": 95},
    "bev": {"camera": {"name": "Camera", "parameters": {"cameraData": {"intrinsic": {"fx": 410.0, "fy": 405.0, "cx": 320.0, "cy": 180.0}, "extrinsic": {"x": 0.2, "y": 0, "z": 1.8, "yaw": 0, "pitch": 0.2, "roll": 0}}}}, "view_size": [1, 9, -8, 8], "offset_angle": -90, "resolution": 0.1, "center_of_rotation": [80, 80]},
    "model": {"path": "", "name": "any", "num_classes": 8, "parameters": {"line_classes": 7}, "predict_size": [360, 640], "checkpoint": "/in/y.pth"},
    "pixel-mapping": {"parameters": {"symmetric_offset": 3, "angle_mode": "gps", "split_after_frames": 500}, "visualization": {"saveimages": True, "folder": "Pictures"}},
    "graph-mapping": {"start": 0, "end": -1, "step": 1, "area_size": [12, 12], "ignore_classes": [7], "min_area_size": 6, "parser": {"name": "BoxImageParser", "parameters": {"window_height": 12, "overlap_pixels": 6, "max_horizontal_box_size": 60, "min_box_area": 2, "resolution": 0.1}}},
    "postprocessing": {"min_nodes": 4, "stack": [{"processor": "BoxReplaceProcessor", "parameters": {"min_cluster_size": 7, "replace_only": [5]}}]},
    "lanelet2": {"input_path": "/in/graphs", "output_file": "/out/roads.osm", "annotated_map_path": "/out", "zone_number": 32, "zone_letter": "N", "car_height": 0.0, "min_lane_size": 1.5, "max_lane_size": 5.0, "search_tolerance": 0.6, "ignore_classes": [6]},
}


def test_a_whole_preset_reaches_every_stage(spark):
    p = preset.parse(WHOLE)
    bird = preset.bird_view(p)
    assert bird.size == (80, 160) and (p.blend, p.mapping.angle_mode, p.mapping.folder, p.model.num_classes) == ("enhance", preset.AngleMode.GPS, "Pictures", 8)
    o = preset.parser_options(p)
    assert (o.window, o.overlap, o.max_box_pixels, o.min_box_area, o.single) == (12, 6, 60, 2, False)
    obs = spark.createDataFrame([(f, 40, 80, 1, 1.0) for f in range(3)], "frame int, row int, col int, cls int, weight double")
    frames = spark.createDataFrame([(f, 10.0 + f, 20.0, 0.0) for f in range(3)], "frame int, x double, y double, heading double")
    px, chunks = preset.build_raster(obs, frames, p)
    e = chunks.first()
    # turned by a quarter, the vehicle's own pixel (80, 80) is at its position, and row 40 is 40 pixels ahead of it
    assert sorted((r["row"], r["col"]) for r in px.collect()) == [(round((e["tl_y"] - 20.0) / 0.1), round((10.0 + f - e["tl_x"]) / 0.1) + 40) for f in range(3)]


def small_map(spark, cells):
    """A chunk of 20 by 20 metres at 0.1, with weights (row, col, cls, weight)."""
    chunks = spark.createDataFrame([(0, 0.0, 20.0, 20.0, 0.0, 200, 200)], "chunk long, tl_x double, tl_y double, br_x double, br_y double, h_px int, w_px int")
    return spark.createDataFrame([(0, *c) for c in cells], "chunk long, row int, col int, cls int, weight double"), chunks


def test_preset_regions_drop_junk_that_lies_on_drivable_ground(spark):
    line = [(r, 100, 2, 5.0) for r in range(60, 140)]
    junk = [(70, 80, 3, 9.0), (70, 81, 3, 9.0)]
    ground = [(r, c, 7, 4.0) for r in range(60, 140) for c in range(60, 140)]
    px, chunks = small_map(spark, line + junk + ground)
    frames = spark.createDataFrame([(0, 10.0, 9.0), (1, 10.0, 10.0)], "frame int, x double, y double")
    got = preset.regions(px, chunks, frames, preset.parse(WHOLE | {"graph-mapping": WHOLE["graph-mapping"] | {"area_size": [6, 6]}})).where("frame = 1").collect()
    at = {(r["row"], r["col"]): (r["cls"], r["second"]) for r in got}
    # the window begins at row and column 70 of the map; drivable ground is ignored, junk is gone
    assert {k for k, v in at.items() if v[0]} == {(r, 30) for r in range(60)} and {at[k] for k in at if at[k][0]} == {(2, 7)}
    assert {(r["at_row"], r["at_col"]) for r in got} == {(30, 30)} and {round(r["to_vertical"], 9) for r in got} == {0.0}
    kept = preset.regions(px, chunks, frames, preset.parse(WHOLE | {"graph-mapping": WHOLE["graph-mapping"] | {"area_size": [6, 6], "min_area_size": 1}})).where("frame = 1 and cls = 3")
    assert kept.count() == 2


def test_from_observations_to_the_map_file(spark, tmp_path):
    """Two solid lines 3.5 m apart that a vehicle follows eastwards become one lane of the file."""
    p = preset.parse(WHOLE | {"lanelet2": WHOLE["lanelet2"] | {"annotated_map_path": str(tmp_path / "graphs")}, "postprocessing": {"min_nodes": 4}})
    x0, y0 = 500_000.0, 5_000_000.0
    # ahead of the vehicle: rows run towards it, columns to the right; its own pixel is (80, 80)
    obs = [(f, r, c + k, 3, 1.0) for f in range(12) for r in range(10, 70) for c in (62, 97) for k in range(2)]
    obs += [(f, r, c, 7, 1.0) for f in range(12) for r in range(10, 70, 7) for c in range(64, 97, 9)] + [(f, 5, 5, 2, 1.0) for f in (3, 4)]
    observations = spark.createDataFrame(obs, "frame int, row int, col int, cls int, weight double")
    frames = spark.createDataFrame([(f, x0 + 2.0 * f, y0, 0.0) for f in range(12)], "frame int, x double, y double, heading double")
    found = preset.run(observations, frames, p, str(tmp_path / "roads.osm"))
    lines = [r for r in found.lines.collect() if len(r["nodes"]) > 2]
    assert found.lanes.count() == 1 and {r["cls"] for r in lines} == {3}
    for r in lines:
        y = [q["y"] - y0 for q in r["xy"]]
        assert max(y) - min(y) < 0.3 and min(abs(np.mean(y) - 1.75), abs(np.mean(y) + 1.75)) < 0.2
    root = et.parse(tmp_path / "roads.osm").getroot()
    assert len(root.findall("relation")) == 1
    refs = {n.get("id"): (float(n.get("lat")), float(n.get("lon"))) for n in root.findall("node")}
    way = {w.get("id"): [refs[n.get("ref")] for n in w.findall("nd")] for w in root.findall("way")}
    left, right = (way[next(m.get("ref") for m in root.find("relation").findall("member") if m.get("role") == role)] for role in ("left", "right"))
    assert abs(abs(np.mean([a for a, _ in left]) - np.mean([a for a, _ in right])) * 111_130 - 3.5) < 0.1
    assert all(45.1 < a < 45.2 and 8.99 < b < 9.01 for a, b in refs.values())
    info = json.loads((tmp_path / "roads.osm.info.json").read_text())
    assert info["zone"] == "UTM 32N" and 45.1 < info["origin"][0] < 45.2
    held = spark.read.text(str(tmp_path / "graphs")).collect()
    assert any('"linestrings":[' in r[0] and '"lanelets":[' in r[0] for r in held)
    few = preset.parse(WHOLE | {"graph-mapping": WHOLE["graph-mapping"] | {"start": 2, "end": 7, "step": 2}})
    px, chunks = preset.build_raster(observations, frames, few)
    n, _ = preset.line_graphs(px, chunks, frames, few)
    assert n.agg(F.max("x")).first()[0] < x0 + 12 + 6.1


def test_only_what_the_camera_shows_counts(spark):
    p = preset.parse(WHOLE | {"bev": WHOLE["bev"] | {"mask_bev": True}})
    seen = preset.bird_view(p).coverage(640, 360)
    assert 0 < seen.sum() < seen.size
    obs = spark.createDataFrame([(0, r, c, 1, 1.0) for r in range(0, 80, 5) for c in range(0, 160, 5)], "frame int, row int, col int, cls int, weight double")
    frames = spark.createDataFrame([(0, 0.0, 0.0, np.pi / 2)], "frame int, x double, y double, heading double")
    assert preset.build_raster(obs, frames, p)[0].count() == seen[::5, ::5].sum()


def test_stacks_mix_graph_and_table_processors(spark):
    stack = [{"processor": "DropTooShortProcessor", "parameters": {"min_nodes": 2}}, {"processor": "HeadConnectorProcessor", "parameters": {"max_dist": 1.5}}, {"processor": "AutoCircleProcessor", "parameters": {"treshold": 0.5}}, {"processor": "EnuToUtmProcessor", "parameters": {"ref_lat": 45.5, "ref_lon": 9.2}}]
    p = preset.parse({"postprocessing": {"stack": stack}})
    nodes = spark.createDataFrame([(k, i, 4.0 * k + i, 0.0, 1) for k in range(2) for i in range(4)], "graph long, node long, x double, y double, cls int")
    edges = spark.createDataFrame([(k, i, i + 1) for k in range(2) for i in range(3)], "graph long, src long, dst long")
    n, e = preset.clean_graphs(nodes, edges, p)
    assert n.select("graph").distinct().count() == 1 and n.count() == 8 and e.count() == 7
    assert 4e5 < n.agg(F.min("x")).first()[0] < 6e5


def test_predictors_and_folder(spark, tmp_path):
    (tmp_path / "mine.py").write_text("EXPORTS = {'threshold': lambda r: [[0, 3], [3, 0]]}\n")
    assert registry.load_folder(str(tmp_path)) == ["threshold"]
    images = spark.createDataFrame([(1,), (2,)], "frame long")
    out = registry.observe(images, lambda: registry.ModelPredictor(lambda r: [[0, 3], [3, 0]]))
    assert out.count() == 4 and out.where("cls = 3 and weight = 1").count() == 4
    soft = registry.ModelPredictor(lambda r: np.ones((1, 1, 2)) * 0.5, soft=True).predict(pd.DataFrame({"frame": [1]}))
    assert list(soft["weight"]) == [0.5, 0.5]
    line = np.zeros((3, 2, 2))
    line[0] = 0.5
    line[1, 0, 0] = line[2, 0, 1] = 1.0
    area = np.stack([np.full((2, 2), 0.4), np.array([[1.0, 1.0], [1.0, 0.0]])])
    heads = registry.lookup("predictor", "SDFPredictor")
    assert heads(lambda r: (line, area)).labels({}).tolist() == [[1, 2], [3, 0]] and heads(lambda r: (line, None)).labels({}).tolist() == [[1, 2], [0, 0]]
    assert heads(lambda r: (line, area), (4, 6)).labels({})[::2, ::3].tolist() == [[1, 2], [3, 0]] and len(heads(lambda r: (line, area)).predict(pd.DataFrame({"frame": [1, 2]}))) == 6
    other = registry.composed(out.where("row = 0"), out.withColumn("cls", F.lit(5)))
    assert other.where("cls = 5").count() == 2 and registry.single_class(out, 1).where("cls = 1").count() == 4
    with pytest.raises(ValueError):
        registry.lookup("parser", "none")
    assert all(registry.lookup(kind, name) for kind, name in (("source", "data_set"), ("parser", "BoxImageParser"), ("camera", "LadybugCamera")))


def test_cameras_of_a_frame(spark):
    a = spark.createDataFrame([(0, 0.0, 0.0, 0.0, "l", 0.0)], "frame int, x double, y double, z double, path string, heading double")
    out = survey.multi_camera({"left": a, "right": a.withColumn("x", F.lit(2.0))}).first()
    assert out["x"] == 1.0 and [c["camera"] for c in out["cameras"]] == ["left", "right"]
    assert poses.paired(a.drop("path"), a.drop("path")).count() == 1
    assert linegraph.COLUMNS[0] == "graph"
