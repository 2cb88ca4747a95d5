"""Mixing sources to target weights by Pareto order sampling.

A document of a source whose target is r times its size is copied floor(r)
times for certain; the rest of the target is a sample of fixed size. Documents
are ranked by u/(1-u) divided by p/(1-p), p being the inclusion probability of
a further copy, and taken in that order until the source's words come nearest
to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.words import unit, word_count
from roadweave.storage import materialize

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SEED = 7
#: Documents of a source that are ranked together, about.
RANK_ROWS = 50_000
#: Sources whose plan is broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, rows) with ``target``, by water filling.

    Sources in code-point order, null last, take the weights in turn. All words
    are shared by weight; a target stops at ``cap`` times the source's size and
    the excess goes to the others by weight: target = min(cap * size, level * weight).
    One row a source.
    """
    alone = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(alone) - 1) % len(weights) + 1).cast("int"))
    x = sizes.withColumn("w", weight).withColumn("full", (F.col("source_size") * cap).cast("double")).withColumn("turn", F.col("full") / F.col("w"))
    order = Window.orderBy("turn", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, total_w = F.sum("source_size").over(everything), F.sum("w").over(everything)
    level = (total - F.coalesce(F.sum("full").over(upto), F.lit(0.0))) / (total_w - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    # stopping a source raises the level until one is not stopped, then lowers it: the greatest holds
    x = x.withColumn("held", F.max(level).over(everything))
    return x.select("source", "source_size", "rows", F.least("full", F.col("held") * F.col("w")).alias("target"))


def pareto_key(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where p is 0 or 1."""
    return F.when((p > 0) & (p < 1), (u / (1 - u)) / (p / (1 - p)))


def plan_mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row a source: ``target``, certain copies ``whole``, and the last (key, id) of the sample.

    ``rows`` has source, size, u and tie. No source is gathered: sums by bucket of
    the key find the one bucket in which the target is reached, and only its rows
    are put in order.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goals = source_targets(sums, weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = goals.withColumn("whole", F.floor(ratio)).withColumn("p", ratio - F.col("whole")).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = materialize(goals, "mix-goals")
    small = goals.count() <= BROADCAST_SOURCES

    keyed = _with_goals(rows, goals, small).withColumn("key", pareto_key(F.col("u"), F.col("p"))).where("key is not null")
    part = F.floor(F.col("key") / (1 + F.col("key")) * F.ceil(F.col("rows") / RANK_ROWS)).cast("long")
    keyed = keyed.select("source", "size", "key", "tie", "need", part.alias("part"))
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("part_size"), F.first("need").alias("need"))
    upto = Window.partitionBy("source").orderBy("part")
    reached = sums.withColumn("end", F.sum("part_size").over(upto)).withColumn("start", F.col("end") - F.col("part_size"))
    #: the last bucket that begins within the need holds the end of the sample
    edge = reached.where("start <= need").groupBy("source").agg(F.max("part").alias("part"), F.max_by("start", "part").alias("start"))
    edge = edge.select(F.col("source").alias("s"), F.col("part").alias("q"), "start")
    inside = keyed.join(F.broadcast(edge) if small else edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("q")))
    order = Window.partitionBy("source").orderBy("key", "tie")
    nearest = inside.withColumn("reach", F.col("start") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2).where("reach <= need")
    last = nearest.groupBy("source").agg(F.max(F.struct("key", "tie")).alias("last"))
    # where the first row of the edge bucket is already too much, all earlier buckets are taken
    edges = edge.join(last, F.col("s").eqNullSafe(F.col("source")), "left").select("s", "q", "last")
    return goals.join(edges, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _with_goals(rows: DataFrame, goals: DataFrame, small: bool) -> DataFrame:
    g = goals.select(*[F.col(c).alias("__source" if c == "source" else c) for c in goals.columns])
    return rows.join(F.broadcast(g) if small else g, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def copies(plan_columns: bool = True) -> Column:
    """Copies of a row once ``plan_mix`` is joined to it."""
    key = pareto_key(F.col("u"), F.col("p"))
    part = F.floor(key / (1 + key) * F.ceil(F.col("rows") / RANK_ROWS)).cast("long")
    one = (part < F.col("q")) | ((part == F.col("q")) & F.col("last").isNotNull() & (F.struct(key.alias("key"), F.col("tie")) <= F.col("last")))
    return (F.coalesce(F.col("whole"), F.lit(0)) + F.coalesce(one, F.lit(False)).cast("long")).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, digest: bool = False) -> DataFrame:
    """``docs`` with size, source_size, target and copies (columns so named are replaced).

    Size is the words of ``text``: null or blank is 0. A null source is a source
    of its own. Rows of the same doc_id and the same text are taken alike. An
    empty table gives an empty result. With ``digest`` only doc_id, source and
    size are carried. The same rows give the same copies in any order or layout.
    """
    tie = F.concat_ws(":", F.lpad(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), 20, "0"), F.lpad(F.crc32(F.coalesce("text", F.lit(""))).cast("string"), 10, "0"))
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), unit(seed, F.col("doc_id")).alias("u"), tie.alias("tie"))
    rows = materialize(narrow, "mix-rows")
    plan = materialize(plan_mix(rows.select("source", "size", "u", "tie"), weights, cap), "mix-plan")
    small = plan.count() <= BROADCAST_SOURCES
    if digest:
        joined = _with_goals(rows, plan, small)
        return joined.select("doc_id", "source", "size", "source_size", "target", copies().alias("copies"))
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    full = docs.select(F.struct(*kept).alias("doc"), F.col("source"), word_count(F.col("text")).alias("size"), unit(seed, F.col("doc_id")).alias("u"), tie.alias("tie"))
    return _with_goals(full, plan, small).select("doc.*", "size", "source_size", "target", copies().alias("copies"))


def repeat(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says; rows with none or a null go; an empty table gives an empty result."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("__copy", "copies", "size", "source_size", "target")
