"""Survey inputs: logs, image folders and data sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.functions import geometry as g
from roadweave.functions.shapes import smoothing_spline
from roadweave.operators import poses

LOG = "sequence long, x double, y double, z double, heading double, roll double, pitch double"
TSV = "id string, x double, y double, z double, yaw double, roll double, pitch double, clock string"
VALUES = ["x", "y", "z", "heading", "roll", "pitch"]


def gps_csv(spark: SparkSession, path: str) -> DataFrame:
    """A log with a header; columns are found by name."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in LOG.split(", ")])


def gps_json(spark: SparkSession, path: str) -> DataFrame:
    """A log that is a JSON list of objects."""
    return spark.read.schema(LOG).option("multiLine", True).json(path)


def gps_log(spark: SparkSession, path: str) -> DataFrame:
    return gps_json(spark, path) if path.lower().endswith(".json") else gps_csv(spark, path)


def image_names(spark: SparkSession, folder: str, extension: str = "png", name_regex: str | None = None) -> DataFrame:
    """(path, sequence) of a folder's images, no content read; names without a number are left out."""
    files = spark.read.format("binaryFile").load(folder).select("path")
    named = files.where(g.has_extension(F.col("path"), extension)).withColumn("sequence", g.image_sequence(F.col("path"), name_regex))
    return named.where("sequence is not null")


def aligned(log: DataFrame, images: DataFrame, wrap_heading: bool = False) -> DataFrame:
    """A pose for every image (S4's table, J1)."""
    return poses.align(images, log, VALUES, on="sequence", wrap=("heading",) if wrap_heading else ())


def write_poses(df: DataFrame, path: str) -> None:
    """The aligned log as CSV with a header."""
    df.select("sequence", *VALUES).sortWithinPartitions("sequence").write.mode("overwrite").option("header", True).csv(path)


def data_set(spark: SparkSession, images: str, log: str, extension: str = "png", start: int = 0, end: int = -1, name_regex: str | None = None) -> DataFrame:
    """Frames with their image path and pose (S5, J2, Q2, Q3): frame, sequence, path, x .. pitch."""
    joined = image_names(spark, images, extension, name_regex).join(gps_log(spark, log), "sequence")
    return poses.frame_slice(poses.frame_numbers(joined, ["sequence"]), start, end).select("frame", "sequence", "path", *VALUES)


def survey_set(spark: SparkSession, images: str, log: str, extension: str = "jpg", start: int = 0, size: int = -1, name_regex: str | None = None) -> DataFrame:
    """Frames of a tab-separated log whose rows and images pair by position (S6); an error if their numbers differ.

    Images whose name has no match of ``name_regex`` are left out. Rows are in
    the order of the file, images in that of their names, digits as numbers.
    """
    raw = spark.read.schema(TSV).option("sep", "\t").option("header", True).csv(log).withColumn("__at", F.monotonically_increasing_id())
    rows = poses.frame_numbers(raw, ["__at"])
    files = spark.read.format("binaryFile").load(images).select("path").where(g.has_extension(F.col("path"), extension))
    if name_regex is not None:
        files = files.where(F.regexp_extract("path", r"([^/]*)$", 1).rlike(name_regex))
    files = poses.frame_numbers(files.withColumn("__key", g.natural_key(F.col("path"))), ["__key"]).drop("__key")
    if (n := rows.count()) != (m := files.count()):
        raise ValueError(f"{n} log rows for {m} images")
    clock = poses.epoch_seconds(F.substring("clock", 1, 14), millis=F.expr("try_cast(substring(clock, 15) as double)"))
    x = rows.join(files, "frame").select("frame", "path", "x", "y", "z", F.radians("yaw").alias("heading"), F.radians("roll").alias("roll"), F.radians("pitch").alias("pitch"), clock.alias("seconds"))
    return poses.frame_slice(x, start, -1 if size < 0 else start + size)


def multi_camera(sets: dict[str, DataFrame]) -> DataFrame:
    """Data sets of several cameras as one: mean pose and all images."""
    rows = None
    for name, df in sets.items():
        part = df.select("frame", F.lit(name).alias("camera"), "x", "y", "z", "path", "heading")
        rows = part if rows is None else rows.unionByName(part)
    return poses.multi_camera(rows)


def decoded(spark: SparkSession, folder: str, size: tuple[int, int] | None = None) -> DataFrame:
    """(path, height, width, channels, data) of images, decoded by the JVM's reader (S9); with ``size`` (height, width), resized to it, bilinear between pixel centres."""
    raw = spark.read.format("image").option("dropInvalid", True).load(folder).select(F.col("image.origin").alias("path"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")
    if size is None:
        return raw

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [resized(np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.channels), size).tobytes() for r in batch.itertuples()]
            yield batch.assign(height=size[0], width=size[1], data=made)

    return raw.mapInPandas(run, "path string, height int, width int, channels int, data binary")


def resized(image: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """An image (height, width, channels) of bytes at another size, bilinear between pixel centres."""
    out = image.astype(np.float64)
    for axis, n in enumerate(size):
        m = out.shape[axis]
        at = np.clip((np.arange(n) + 0.5) * m / n - 0.5, 0, m - 1)
        low = np.floor(at).astype(int)
        part = (at - low).reshape([-1 if k == axis else 1 for k in range(3)])
        out = np.take(out, low, axis) * (1 - part) + np.take(out, np.minimum(low + 1, m - 1), axis) * part
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def smoothed(frames: DataFrame, residual: float = 0.03, by: str = "track", time: str = "frame") -> DataFrame:
    """Adds smooth_x, smooth_y and smooth_heading of each track.

    A cubic spline over ``time``, which may be uneven, whose squared deviations
    are ``residual`` a pose at most in the mean; the heading is its direction.
    Two poses at one time are an error. A track is one task.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time)
        at = pdf[time].to_numpy(float)
        xy, slope = smoothing_spline(at - at[0], pdf[["x", "y"]].to_numpy(float), residual * len(pdf))
        return pdf.assign(smooth_x=xy[:, 0], smooth_y=xy[:, 1], smooth_heading=np.arctan2(slope[:, 1], slope[:, 0]))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema) + ", smooth_x double, smooth_y double, smooth_heading double"
    return frames.groupBy(by).applyInPandas(run, schema)
