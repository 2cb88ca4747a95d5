"""Frames as a data source of their own: ``spark.read.format("survey_images")``, in batches or as a stream.

For folders that driver and executors see as files; images in other stores come
by Spark's own readers (``survey.image_names``). Frames are numbered in the
order of names. Ranges of frames are partitions, and a filter on ``frame``
decides which of them are read at all.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "frame long, sequence long, path string, data binary"
#: Images that a partition holds unless the option ``files`` says otherwise.
FILES = 64


class Frames(InputPartition):
    """Frames ``first`` up to ``first + len(names)``."""

    def __init__(self, first: int, names: list[str]):
        super().__init__((first, len(names)))
        self.first, self.names = first, names


class _Folder:
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("survey_images needs a path")
        self.path = options["path"].removeprefix("file://")
        self.ending = "." + options.get("img_format", "png").lower().lstrip(".")
        self.pattern = options.get("name_regex")
        self.files = int(options.get("files", FILES))

    def names(self) -> list[str]:
        found = [n for n in os.listdir(self.path) if n.lower().endswith(self.ending)]
        return sorted(n for n in found if self.pattern is None or re.match(self.pattern, n))

    def ranges(self, names: list[str], low: int, high: int) -> list[Frames]:
        high = min(high, len(names))
        return [Frames(k, names[k : min(k + self.files, high)]) for k in range(max(0, low), high, self.files)]

    def rows(self, part: Frames) -> Iterator[tuple]:
        for k, name in enumerate(part.names):
            digits = re.findall(r"\d+", os.path.splitext(name)[0])
            with open(os.path.join(self.path, name), "rb") as f:
                yield part.first + k, int(digits[-1]) if digits else None, name, f.read()


class FramesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = _Folder(options)
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Bounds of ``frame`` are taken; other filters stay with Spark."""
        for f in filters:
            if getattr(f, "attribute", None) != ("frame",) or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                self.high = min(self.high, f.value + (not isinstance(f, LessThan)))

    def partitions(self) -> list[Frames]:
        return self.folder.ranges(self.folder.names(), self.low, self.high)

    def read(self, partition: Frames) -> Iterator[tuple]:
        return self.folder.rows(partition)


class FramesStream(DataSourceStreamReader):
    """Frames as they are added; names must come in order, as cameras number them."""

    def __init__(self, options: dict[str, str]):
        self.folder = _Folder(options)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"frame": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"frame": len(self.folder.names())}

    def partitions(self, start: dict, end: dict) -> list[Frames]:
        return self.folder.ranges(self.folder.names(), start["frame"], end["frame"])

    def read(self, partition: Frames) -> Iterator[tuple]:
        return self.folder.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept."""


class SurveyImages(DataSource):
    """Options: path, img_format (png), name_regex (matched at the beginning), files (images a partition)."""

    @classmethod
    def name(cls) -> str:
        return "survey_images"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FramesReader:
        return FramesReader(dict(self.options))

    def streamReader(self, schema) -> FramesStream:  # noqa: N802
        return FramesStream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, filters on frames included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SurveyImages)
