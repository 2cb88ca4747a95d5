"""A training-data pipeline: each stage keeps or changes the documents of the one before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm import decontam, langid, mixing, sharding, simhash
from roadweave.storage import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 24
#: Single words, none counted over four times, leave near copies fewest bits apart.
NEAR = {"radius": 6, "shingle": 1, "most": 4, "check_shingle": 5, "check_radius": 28, "least": 0.8}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or with a narrow margin go.

    Null, empty and letterless texts go. Repeated rows are judged alike. An
    empty table, or one without a labelled text, gives an empty result. Other
    columns are left out, in this and all stages but the last.
    """
    model = langid.fit(docs, F.lit(True))
    return langid.identify(docs, model).where("accepted").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one row: that of the least doc_id.

    SimHash finds candidates; two texts are linked if at least 0.8 of their
    five-word shingles are common. Repeated rows become one. Texts without
    words, null ones too, are one class. Of a doc_id with several texts each
    text is judged by itself; a null doc_id comes after all others. An empty
    table gives an empty result.
    """
    return simhash.keep_one(docs.select(*COLUMNS), **NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows of a doc_id are judged together: all go if one holds an item. Null and
    empty texts hold nothing and stay; an empty table or benchmark drops nothing.
    """
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Texts without words have size 0 and ride with their source's certain
    copies; a null source is one of its own; rows of one doc_id and one text
    are taken alike. An empty table gives an empty result.
    """
    return mixing.repeat(mixing.mix(docs.select(*COLUMNS))).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot.

    Null texts and ids are sharded like any other; rows of one doc_id share a
    shard, repeated rows have slots of their own. An empty table gives an empty
    result.
    """
    return sharding.shard(docs.select(*COLUMNS), SHARDS, F.coalesce(F.octet_length("text"), F.lit(0)) + 8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Compression sizes, XXH64 and the BM25 index are not SQL; tests/llm/ holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
