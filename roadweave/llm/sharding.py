"""Sharding by a two-pass external shuffle.

Pass one scatters rows into shards and, inside each shard, into buckets small
enough for memory, both by seeded hashes. Pass two orders each bucket by a
Fisher-Yates permutation whose draws are seeded hashes too, so that a lost
executor's work comes out the same when it is done again. The bucket follows
from a row's place in the input, so copies of a row are scattered like others.

Law ``key``: the shard is the one whose hash with ``doc_id`` is greatest
(rendezvous hashing), so doc_id and the shard count alone decide it, and one
more shard takes rows only into itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 20240611


def _weights(key: Column, shards: range, seed: int) -> Column:
    return F.array(*[F.xxhash64(key, F.lit(seed), F.lit(i)) for i in shards])


def shard_of(key: Column, n_shards: int, seed: int = SEED) -> Column:
    """Shard 0 to n_shards-1 of a key; a null key has a shard like any other."""
    w = _weights(key, range(n_shards), seed)
    return (F.array_position(w, F.array_max(w)) - 1).cast("int")


def permutation(n: Column, *salt: Column) -> Column:
    """Fisher-Yates, inside out: a permutation of 0..n-1 drawn from hashes of ``salt``."""

    def step(a: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(*salt, i), i + 1).cast("int")
        swapped = F.concat(F.slice(a, F.lit(1), j), F.array(i), F.slice(a, j + 2, i - j - 1), F.array(F.element_at(a, j + 1)))
        return F.when(j == i, F.concat(a, F.array(i))).otherwise(swapped)

    rest = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(rest, F.array(F.lit(0)), step)


def shard(
    docs: DataFrame,
    n_shards: int,
    size: Column,
    id_col: str = "doc_id",
    seed: int = SEED,
    bucket_bytes: int = 64 << 20,
    bucket_rows: int = 1024,
) -> DataFrame:
    """``docs`` with ``shard`` (int) and ``slot`` (long, gapless from 0 within the shard).

    ``size`` is the bytes of a row; buckets hold about ``bucket_bytes`` or
    ``bucket_rows``, whichever is less. Columns named shard or slot are replaced.
    Repeated rows and repeated ids share a shard, are spread over its buckets
    and have slots of their own; null ids and texts are sharded like others; an
    empty table gives an empty result. ``docs`` must come in the same order when
    it is read again, as files and materialized tables do; the shard follows
    from the id alone, the slot from the order too.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    n, total = docs.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    subs = max(1, math.ceil(total / n_shards / bucket_bytes), math.ceil(n / n_shards / bucket_rows))
    drawn = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    placed = docs.select(*kept, shard_of(F.col(id_col), n_shards, seed).alias("__shard"), drawn.alias("__order")).withColumn("__sub", F.pmod(F.xxhash64(F.lit(seed + 1), "__order"), F.lit(subs)).cast("int"))

    counts = placed.groupBy("__shard", "__sub").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__shard").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    # each bucket's permutation is made where its rows are, by the task that orders them
    buckets = counts.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).repartition("__shard", "__sub")
    buckets = buckets.select("__shard", "__sub", "__base", permutation(F.col("__n").cast("int"), F.lit(seed), F.col("__shard"), F.col("__sub")).alias("__order_of"))

    inside = Window.partitionBy("__shard", "__sub").orderBy("__order")
    rows = placed.withColumn("__row", F.row_number().over(inside))
    slot = F.col("__base") + F.element_at("__order_of", F.col("__row"))
    return rows.join(buckets.hint("merge"), ["__shard", "__sub"]).select(*kept, F.col("__shard").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str, files: int) -> None:
    """One folder a shard, rows in slot order, in about ``files`` files; an empty table writes none."""
    sharded.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
