"""Tables in the folder that the whole cluster shares.

Lineage is cut by writing a Parquet table there: columnar, compressed, and
readable after any executor is lost.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rounds after which an iteration writes what it has gathered as one table, so that plans stay short.
COMPACT_ROUNDS = 20

_WRITTEN: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one on a single machine, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("executors need a shared folder: set spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roadweave-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/roadweave/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def parts(df: DataFrame, rows: int = 500_000) -> int:
    """Partitions of about ``rows`` rows for a shuffle of ``df``, at least as many as the session's; a task's memory then stays the same however large the table."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def release(df: DataFrame) -> None:
    """Delete a table of ``materialize`` that no later plan reads."""
    discard(df.sparkSession, df.written_at)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one table that ``new_path`` named."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in (written := _WRITTEN.get(spark.sparkContext.applicationId, [])):
        written.remove(path)


def sweep(spark: SparkSession) -> int:
    """Delete every table this application has materialized; returns how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        discard(spark, path)
    return len(paths)
