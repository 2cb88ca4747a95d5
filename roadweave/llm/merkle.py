"""Merkle manifest of a table: leaves by group, trees of a fixed fanout, and a proof for every row.

Levels are DataFrames. Rows are numbered once; a parent's number is its
children's divided by the fanout, so a level is one grouping by small runs.
Proofs go down again: a node's path is its siblings and its parent's path, so
the joins of all levels together touch each row about one and a half times.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.storage import materialize

FANOUT = 3
#: Levels joined in one plan on the way down.
CUT = 6
SIDES = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the bytes' count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def numbered(nodes: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``nodes`` with ``idx`` (from 0 in each group, in ``order``), ``size`` (rows of the group) and ``gid`` (the group's number, null first, by bytes).

    Rows are sorted by ranges of group and order, so a group of any size is
    spread; only one row for each range and group meets others of its group.
    """
    spark = nodes.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = F.asc_nulls_first(group)
    placed = nodes.repartitionByRange(ranges, first, *order).sortWithinPartitions(first, *order)
    placed = materialize(placed.withColumns({"__at": F.monotonically_increasing_id(), "__range": F.spark_partition_id()}), "merkle-order")
    parts = placed.groupBy("__range", group).agg(F.min("__at").alias("__from"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(group).orderBy("__range")
    parts = parts.withColumns({"__before": F.sum("__n").over(earlier) - F.col("__n"), "size": F.sum("__n").over(Window.partitionBy(group))})
    parts = parts.join(_group_numbers(parts.select(group).distinct(), group).withColumnRenamed(group, "__group"), F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
    parts = materialize(parts.withColumnRenamed(group, "__group").withColumnRenamed("__range", "__part"), "merkle-parts")
    joined = placed.join(parts.hint("merge"), (F.col("__range") == F.col("__part")) & F.col(group).eqNullSafe(F.col("__group")))
    return joined.select(*nodes.columns, "gid", (F.col("__at") - F.col("__from") + F.col("__before")).alias("idx"), "size")


def _group_numbers(groups: DataFrame, group: str) -> DataFrame:
    """``groups`` with ``gid``, their place in order: counts by range, then places inside a range."""
    ranges = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = groups.repartitionByRange(ranges, F.asc_nulls_first(group)).sortWithinPartitions(F.asc_nulls_first(group))
    placed = materialize(placed.withColumns({"__at": F.monotonically_increasing_id(), "__of": F.spark_partition_id()}), "merkle-groups")
    # one row a range
    sizes = placed.groupBy("__of").agg(F.min("__at").alias("__from"), F.count("*").alias("__n"))
    sizes = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__of")) - F.col("__n")).drop("__n")
    return placed.join(sizes, "__of").select(group, (F.col("__at") - F.col("__from") + F.col("__before")).alias("gid"))


def _runs(level: DataFrame, fanout: int) -> DataFrame:
    """(gid, up, upper, kids, hash): runs of ``fanout`` nodes and their parent."""
    runs = level.groupBy("gid", F.floor(F.col("idx") / fanout).cast("long").alias("up")).agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("kids"), F.first("size").alias("size"))
    joined = F.array_join(F.transform("kids", lambda k: k["hash"]), "")
    return runs.select("gid", "up", F.ceil(F.col("size") / fanout).cast("long").alias("upper"), "kids", F.sha2(joined, 256).alias("hash"))


def _sides(kids: Column, place: Column) -> Column:
    """What stands left and right of the child at ``place`` (from 0) of a run."""
    text = lambda part: F.array_join(F.transform(part, lambda k: k["hash"]), "")
    return F.struct(text(F.slice(kids, F.lit(1), place)).alias("left"), text(F.slice(kids, place + 2, F.size(kids) - place)).alias("right"))


class Forest:
    """Trees over numbered nodes (gid, idx, size, hash), one a group, and the path of each node to its top."""

    def __init__(self, nodes: DataFrame, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[DataFrame] = []
        most = nodes.agg(F.max("size")).first()[0] or 0
        level, tops = nodes.select("gid", "idx", "size", "hash"), []
        while True:
            tops.append(level.where("size = 1").select("gid", "idx", "hash"))
            if most <= 1:
                break
            runs = materialize(_runs(level.where("size > 1"), fanout), "merkle-level")
            self.levels.append(runs)
            level = runs.select("gid", F.col("up").alias("idx"), F.col("upper").alias("size"), "hash")
            most = -(-most // fanout)
        self.tops = tops

    def roots(self) -> DataFrame:
        """(gid, root) of every group."""
        return reduce(DataFrame.unionAll, self.tops).select("gid", F.col("hash").alias("root"))

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """(gid, idx, root, path): for each node its siblings, level by level from itself up; ``above`` (gid, path) goes on from a group's root."""
        none = F.expr(f"cast(array() as {SIDES})")

        def begun(top: DataFrame) -> DataFrame:
            if above is None:
                return top.select("gid", "idx", F.col("hash").alias("root"), none.alias("path"))
            return top.join(above, "gid").select("gid", "idx", F.col("hash").alias("root"), "path")

        at = begun(self.tops[-1])
        for k in range(len(self.levels) - 1, -1, -1):
            runs = self.levels[k].select("gid", "up", "kids")
            held = runs.join(at.withColumnRenamed("idx", "up"), ["gid", "up"])
            kids = held.select("gid", "root", "path", "kids", F.posexplode("kids").alias("place", "kid"))
            at = kids.select("gid", F.col("kid.idx").alias("idx"), "root", F.concat(F.array(_sides(F.col("kids"), F.col("place"))), "path").alias("path"))
            at = at.unionAll(begun(self.tops[k]))
            if k and k % CUT == 0:
                at = materialize(at, "merkle-paths")
        return at


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_hash(path: Column) -> Column:
    """H of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["left"], s["right"]))), ""), 256)


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf", fanout: int = FANOUT) -> tuple[DataFrame, str | None]:
    """``rows`` with ``subroot`` and ``path`` (from the leaf to the root), and the root.

    In each group leaves ascend by ``order`` (null first), equal ones by their
    hash; groups ascend by name, null first. Repeated rows are leaves of their
    own. An empty table gives an empty result and no root. Columns of ``rows``
    must not be named gid, idx, size, subroot or path.
    """
    names = rows.columns
    # leaves are hashed once, before a range sort looks at its rows twice
    rows = materialize(rows, "merkle-rows")
    placed = materialize(numbered(rows, group, [F.asc_nulls_first(order), F.asc(leaf)]), "merkle-leaves")
    trees = Forest(placed.select("gid", "idx", "size", F.col(leaf).alias("hash")), fanout)
    subroots = materialize(trees.roots(), "merkle-subroots")
    top = Forest(subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("idx"), F.lit(subroots.count()).alias("size"), F.col("root").alias("hash")), fanout)
    found = top.roots().first()
    above = materialize(top.paths().select(F.col("idx").alias("gid"), "path"), "merkle-above")
    paths = trees.paths(above).select("gid", "idx", F.col("root").alias("subroot"), "path")
    return placed.join(paths, ["gid", "idx"]).select(*names, "subroot", "path"), found["root"] if found else None


def verify(found: DataFrame, root: str | None, leaf: Column) -> DataFrame:
    """``found`` of ``manifest`` with folded_root, from ``leaf`` and the path, and verified, whether it is the root."""
    whole = found.withColumn("folded_root", folded(leaf, F.col("path")))
    return whole.withColumn("verified", F.col("folded_root") == F.lit(root))

