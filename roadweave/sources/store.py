"""Stored maps: chunk tables, graph files, images and the output map."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.operators.components import connected_components
from roadweave.operators.graphs import drop_small_graphs


def write_chunks(pixels: DataFrame, chunks: DataFrame, path: str) -> None:
    """Pixels by chunk, and the small table that describes the chunks."""
    pixels.repartition("chunk").write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/pixels")
    chunks.coalesce(1).write.mode("overwrite").parquet(f"{path}/chunks")


def read_chunk_info(spark: SparkSession, path: str) -> DataFrame:
    """Descriptions only; no pixel is read."""
    return spark.read.parquet(f"{path}/chunks")


def read_chunks(spark: SparkSession, path: str, chunks: list[int] | None = None) -> DataFrame:
    """Pixels of all chunks or of those named; others' folders are not opened."""
    df = spark.read.parquet(f"{path}/pixels")
    return df if chunks is None else df.where(F.col("chunk").isin(chunks))


def export_graphs(nodes: DataFrame, edges: DataFrame, path: str, min_nodes: int = 2) -> None:
    """One JSON document a graph, in node-link form (S14, S16, Q38: only ``path`` is replaced)."""
    keep = drop_small_graphs(nodes, min_nodes)
    attributes = [c for c in nodes.columns if c not in ("graph", "node", "x", "y", "type")]
    n = keep.groupBy("graph").agg(F.sort_array(F.collect_list(F.struct(F.col("node").alias("id"), F.array("x", "y").alias("position"), F.struct(*attributes).alias("attributes")))).alias("nodes"), *([F.first("type", True).alias("type")] if "type" in nodes.columns else []))
    e = edges.groupBy("graph").agg(F.sort_array(F.collect_list(F.struct(F.col("src").alias("source"), F.col("dst").alias("target")))).alias("links"))
    about = F.struct(F.col("graph").alias("id"), *(["type"] if "type" in nodes.columns else []))
    body = n.join(e, "graph", "left").select(F.to_json(F.struct(F.lit(False).alias("directed"), F.lit(False).alias("multigraph"), about.alias("graph"), "nodes", F.coalesce("links", F.expr("array()")).alias("links"))).alias("value"))
    body.write.mode("overwrite").text(path)


GRAPH_JSON = "graph struct<id:long,type:string>, nodes array<struct<id:long,position:array<double>,attributes:struct<cls:long,fallback:long>>>, links array<struct<source:long,target:long>>"


def load_graphs(spark: SparkSession, path: str, min_nodes: int = 2) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of stored graphs; small ones go, parts that do not hang together are graphs of their own."""
    raw = spark.read.schema(GRAPH_JSON).json(path)
    n = raw.select(F.col("graph.id").alias("g"), F.col("graph.type").alias("type"), F.explode("nodes").alias("n")).select("g", F.col("n.id").alias("node"), F.col("n.position")[0].alias("x"), F.col("n.position")[1].alias("y"), F.col("n.attributes.cls").alias("cls"), F.col("n.attributes.fallback").alias("fallback"), "type")
    e = raw.select(F.col("graph.id").alias("g"), F.explode("links").alias("l")).select("g", F.col("l.source").alias("src"), F.col("l.target").alias("dst"))
    of = connected_components(e.select(F.struct("g", F.col("src").alias("node")).alias("src"), F.struct("g", F.col("dst").alias("node")).alias("dst")))
    of = of.select(F.col("node.g").alias("g"), F.col("node.node").alias("node"), F.xxhash64("component").alias("graph"))
    nodes = drop_small_graphs(n.join(of, ["g", "node"]).drop("g"), min_nodes)
    edges = e.join(of.withColumnRenamed("node", "src"), ["g", "src"]).select("graph", "src", "dst").join(nodes.select("graph").distinct(), "graph", "left_semi")
    return nodes, edges


def png(rgb: np.ndarray) -> bytes:
    """An image (rows, cols, 3) of bytes as a PNG file."""
    rows, cols, _ = rgb.shape
    raw = b"".join(b"\0" + rgb[r].astype(np.uint8).tobytes() for r in range(rows))
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", cols, rows, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def chunk_images(coloured: DataFrame, by: str = "chunk") -> DataFrame:
    """(chunk, image binary): one PNG for each chunk of coloured pixels (S17); a chunk is bounded by its frames."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1, 3), np.uint8)
        out[pdf["row"], pdf["col"]] = pdf[["r", "g", "b"]].to_numpy()
        return pd.DataFrame({by: [pdf[by].iloc[0]], "image": [png(out)]})

    return coloured.groupBy(by).applyInPandas(run, f"{by} long, image binary")


def osm_elements(points: DataFrame, ways: DataFrame, lanelets: DataFrame) -> DataFrame:
    """(part, id, value): the elements of an OSM file, one row each.

    points (id, lat, lon, ele), ways (id, nodes array<long>, type, subtype),
    lanelets (id, left_way, right_way, subtype).
    """
    text = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(F.regexp_replace(c.cast("string"), "&", "&amp;"), "<", "&lt;"), '"', "&quot;"), F.lit('"'))
    tag = lambda k, c: F.coalesce(F.concat(F.lit(f'<tag k="{k}" v='), text(c), F.lit("/>")), F.lit(""))  # noqa: E731 (a null has no tag)
    node = F.concat(F.lit("<node id="), text(F.col("id")), F.lit(' visible="true" version="1" lat='), text(F.col("lat")), F.lit(" lon="), text(F.col("lon")), F.lit(">"), tag("ele", F.col("ele")), F.lit("</node>"))
    refs = F.array_join(F.transform("nodes", lambda n: F.concat(F.lit('<nd ref="'), n.cast("string"), F.lit('"/>'))), "")
    way = F.concat(F.lit("<way id="), text(F.col("id")), F.lit(' visible="true" version="1">'), refs, tag("type", F.col("type")), tag("subtype", F.col("subtype")), F.lit("</way>"))
    member = lambda c, role: F.concat(F.lit('<member type="way" ref='), text(c), F.lit(f' role="{role}"/>'))
    relation = F.concat(F.lit("<relation id="), text(F.col("id")), F.lit(' visible="true" version="1">'), member(F.col("left_way"), "left"), member(F.col("right_way"), "right"), F.lit('<tag k="type" v="lanelet"/>'), tag("subtype", F.col("subtype")), F.lit("</relation>"))
    return points.select(F.lit(1).alias("part"), "id", node.alias("value")).unionByName(ways.select(F.lit(2).alias("part"), "id", way.alias("value"))).unionByName(lanelets.select(F.lit(3).alias("part"), "id", relation.alias("value")))


def write_osm(elements: DataFrame, path: str, origin: tuple[float, float], zone: str, origin_format: str = "map metres") -> None:
    """The map as one OSM file and its description.

    Executors write the elements in order, as parts of ``path``.parts; the
    driver only joins these files in the store that holds them.
    """
    spark = elements.sparkSession
    ends = spark.createDataFrame([(0, 0, '<?xml version="1.0" encoding="UTF-8"?>\n<osm version="0.6" generator=' + quoteattr("roadweave") + ">"), (9, 0, "</osm>")], "part int, id long, value string")
    elements.unionByName(ends).orderBy("part", "id").select("value").write.mode("overwrite").text(f"{path}.parts")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    at = hadoop.fs.Path(f"{path}.parts")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hadoop.fs.Path(path), True)
    for name in sorted(f.getPath().getName() for f in fs.listStatus(at)):
        if name.startswith("part-"):
            part = fs.open(hadoop.fs.Path(at, name))
            hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            part.close()
    out.close()
    fs.delete(at, True)
    info = fs.create(hadoop.fs.Path(f"{path}.info.json"), True)
    info.write(bytearray(json.dumps({"origin": list(origin), "origin_format": origin_format, "zone": zone}).encode()))
    info.close()


def map_image(coloured: DataFrame) -> DataFrame:
    """(map, image binary): all pixels of a stitched and coloured map as one PNG (S17), for a map that fits one task: coarsen it first."""
    return chunk_images(coloured.withColumn("map", F.lit(0).cast("long")), "map")


def image_pixels(images: DataFrame) -> DataFrame:
    """(path, row, col, b, g, r) of decoded images, as rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                a = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels)
                y, x = np.mgrid[: r.height, : r.width]
                yield pd.DataFrame({"path": r.path, "row": y.ravel(), "col": x.ravel(), **{c: a[..., min(k, r.channels - 1)].ravel() for k, c in enumerate("bgr")}})

    return images.mapInPandas(run, "path string, row int, col int, b int, g int, r int")
