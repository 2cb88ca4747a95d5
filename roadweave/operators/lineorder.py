"""Lines of a graph put in order by pointer doubling.

Each edge is two arcs. An arc points to the one that goes on from its end,
unless a line stops there. Tasks take blocks of arcs of near node ids and follow
pointers within them; then only arcs at which another block points are left to
rounds, in which an arc takes over its pointer's pointer, so that those of a line
know its last arc, and how far it is, after log2 of their number rounds of one
equi-join. No line or graph is gathered in one task: a block is bounded.
Cut lines are joined by sorting: their tables are far larger in memory than the
compressed files whose size would have them broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import geometry as g
from roadweave.operators.graphs import consensus, degrees, undirected
from roadweave.storage import materialize, parts, release

ARC = ["graph", "src", "dst"]
#: Arcs that a task follows at a time.
BLOCK = 500_000


def _stops(arcs: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """(graph, node): ends, forks and cut nodes."""
    out = arcs.groupBy("graph", F.col("src").alias("node")).agg(F.count("*").alias("degree")).where("degree <> 2").select("graph", "node")
    return out if cuts is None else out.unionByName(cuts.select("graph", "node")).distinct()


def _pointers(arcs: DataFrame, stops: DataFrame) -> DataFrame:
    """(graph, src, dst, to_src, to_dst, far, least, last): each arc and the next one of its line, or itself where the line stops."""
    on = arcs.select("graph", F.col("src").alias("dst"), F.col("dst").alias("to_dst")).join(stops.select("graph", F.col("node").alias("dst")), ["graph", "dst"], "left_anti")
    x = arcs.join(on.where("dst <> to_dst"), ["graph", "dst"], "left").where("to_dst is null or to_dst <> src")
    last = F.col("to_dst").isNull()
    return x.select(*ARC, F.when(last, F.col("src")).otherwise(F.col("dst")).alias("to_src"), F.coalesce("to_dst", "dst").alias("to_dst"), F.when(last, 0).otherwise(1).cast("long").alias("far"), F.col("src").alias("least"), last.alias("last"))


def followed(arcs: pd.DataFrame) -> pd.DataFrame:
    """``arcs`` as ``_pointers`` makes them with pointers followed as far as the table goes.

    Each arc points at its line's last arc, or else at the first one on its way
    that the table lacks. Arcs of a ring that is whole in the table point as before.
    """
    n = len(arcs)
    graph, nodes = pd.factorize(arcs["graph"])[0], pd.factorize(arcs[["src", "dst", "to_src", "to_dst"]].to_numpy().T.ravel())[0].reshape(4, n)
    # at most BLOCK graphs and 4 * BLOCK nodes have numbers here, so that three of these fit a long
    key = lambda a, b: (graph * 4 * n + nodes[a]) * 4 * n + nodes[b]
    at = pd.Index(key(0, 1)).get_indexer(key(2, 3))
    stays = arcs["last"].to_numpy() | (at < 0)
    to, far, least = np.where(stays, np.arange(n), at), np.where(stays, 0, arcs["far"].to_numpy()), arcs["least"].to_numpy().copy()
    for _ in range(n.bit_length()):
        if stays[to].all():
            break
        far, least, to = far + far[to], np.minimum(least, least[to]), to[to]
    # the arc at which a way ends is the line's last one, or points out of the table
    ends = stays[to]
    out = arcs.copy()
    for c in ("to_src", "to_dst", "last"):
        out[c] = np.where(ends, arcs[c].to_numpy()[to], arcs[c].to_numpy())
    out["far"] = np.where(ends, far + np.where(stays, arcs["far"].to_numpy(), 0)[to], arcs["far"].to_numpy())
    out["least"] = np.where(ends, np.minimum(least, arcs["least"].to_numpy()[to]), arcs["least"].to_numpy())
    return out


def _followed(pointers: DataFrame) -> DataFrame:
    """``pointers`` followed within blocks of arcs of near ids, each of ``BLOCK`` arcs at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if held and sum(map(len, held)) + len(batch) > BLOCK:
                yield followed(pd.concat(held, ignore_index=True))
                held = []
            held.append(batch)
        if held:
            yield followed(pd.concat(held, ignore_index=True))

    return pointers.repartitionByRange(parts(pointers, BLOCK), *ARC).mapInPandas(run, pointers.schema)


def _onward(arcs: DataFrame, ahead: DataFrame) -> DataFrame:
    """``arcs`` that point at one of ``ahead`` take over its pointer."""
    ahead = ahead.select("graph", F.col("src").alias("to_src"), F.col("dst").alias("to_dst"), F.col("to_src").alias("n_src"), F.col("to_dst").alias("n_dst"), F.col("far").alias("n_far"), F.col("least").alias("n_least"), F.col("last").alias("n_last"))
    return arcs.join(ahead, ["graph", "to_src", "to_dst"]).select(*ARC, F.col("n_src").alias("to_src"), F.col("n_dst").alias("to_dst"), (F.col("far") + F.col("n_far")).alias("far"), F.least("least", "n_least").alias("least"), F.col("n_last").alias("last"))


def _doubled(pointers: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(arcs that know their line's last arc, arcs of rings with the ring's least node or None)."""
    pointers = materialize(pointers, "arcs")
    state = materialize(_followed(pointers), "arcs")
    release(pointers)
    done, open_ = state.where("last"), state.where("not last")
    if open_.isEmpty():
        return state, None
    # only arcs at which others still point are doubled
    met = open_.select("graph", F.col("to_src").alias("src"), F.col("to_dst").alias("dst")).distinct()
    ends, rings = _rounds(materialize(state.join(met, ARC).select(*state.columns), "arcs"))
    done = done.unionByName(_onward(open_, ends))
    return done, None if rings is None else _onward(open_, rings)


def _rounds(state: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``_doubled`` of the table ``state`` of arcs that point at each other only."""
    open_before = seen_least = None
    while True:
        counts = state.where("not last").agg(F.count("*"), F.sum(F.col("least").cast("decimal(38,0)"))).first()
        if not counts[0]:
            return state, None
        # a round finishes arcs of every line that has an end, so what no round finishes is rings
        if (counts[0], counts[1]) == (open_before, seen_least):
            return state.where("last"), state.where("not last")
        open_before, seen_least = counts
        before, state = state, materialize(state.where("last").unionByName(_onward(state.where("not last"), state)), "arcs")
        release(before)


def _ranked(arcs: DataFrame, stops: DataFrame) -> DataFrame:
    """(graph, src, dst, first_src, first_dst, last_src, last_dst, rank, steps): each arc's place in the line that holds it, each line both ways.

    A ring is a line from its least node back to it.
    """
    done, rings = _doubled(_pointers(arcs, stops))
    if rings is not None:
        begun = rings.select("graph", F.col("least").alias("node")).distinct()
        done = done.unionByName(_doubled(_pointers(rings.select(*ARC), begun))[0])
    done = done.select(*ARC, F.col("to_src").alias("last_src"), F.col("to_dst").alias("last_dst"), "far")
    # the way back from an arc tells where its line began
    back = done.select("graph", F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("last_dst").alias("first_src"), F.col("last_src").alias("first_dst"), F.col("far").alias("rank"))
    return done.join(back, ARC).select(*ARC, "first_src", "first_dst", "last_src", "last_dst", "rank", (F.col("rank") + F.col("far") + 1).alias("steps"))


def line_order(edges: DataFrame, cuts: DataFrame | None = None, classes: DataFrame | None = None) -> DataFrame:
    """(graph, first, second, k, node): the nodes of every line in order; first and second are a line's first nodes and name it.

    Lines end at ends, forks and ``cuts`` (graph, node); with ``classes``
    (graph, node, cls) also at the last node of a class. Each line comes once,
    from its lesser end, a loop by its lesser neighbour; a ring without such a
    node begins at its least node and comes back to it. Null ends and loops of
    one node are left out, repeated edges count once; nodes without an edge are
    on no line. An empty table gives an empty result.
    """
    arcs = materialize(undirected(edges).where("graph is not null and src is not null and dst is not null"), "line-arcs")
    stops = materialize(_stops(arcs, cuts), "line-stops")
    ranked = _ranked(arcs, stops)
    end, other = F.struct("first_src", "first_dst"), F.struct(F.col("last_dst").alias("first_src"), F.col("last_src").alias("first_dst"))
    kept = materialize(ranked.where(end < other), "line-ranks")
    if classes is not None:
        kept = _cut_by_class(kept, classes)
    steps = kept.select("graph", F.col("first_src").alias("first"), F.col("first_dst").alias("second"), (F.col("rank") + 1).alias("k"), F.col("dst").alias("node"))
    return steps.unionByName(kept.where("rank = 0").select("graph", F.col("first_src").alias("first"), F.col("first_dst").alias("second"), F.lit(0).cast("long").alias("k"), F.col("src").alias("node")))


def _cut_by_class(ranked: DataFrame, classes: DataFrame) -> DataFrame:
    """Arcs of lines in one direction, cut where the class changes along it, at the last node of the old class; ranks begin again."""
    of = lambda side: classes.select("graph", F.col("node").alias(side), F.col("cls").alias(f"{side}_cls"))
    changed = ranked.join(of("src").hint("merge"), ["graph", "src"]).join(of("dst").hint("merge"), ["graph", "dst"]).where("src_cls <> dst_cls and rank > 0")
    begins = changed.select("graph", "first_src", "first_dst", F.col("rank").alias("from"))
    if begins.isEmpty():
        return ranked
    # the greatest cut at or before an arc: cuts are spread over the blocks of ranks up to the next one
    following = Window.partitionBy("graph", "first_src", "first_dst").orderBy("from")
    zero = ranked.where("rank = 0").select("graph", "first_src", "first_dst", F.lit(0).cast("long").alias("from"), "steps")
    parts = begins.withColumn("steps", F.lit(None).cast("long")).unionByName(zero)
    parts = parts.select("graph", "first_src", "first_dst", "from", F.coalesce(F.lead("from").over(following), F.max("steps").over(following.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("until"))
    block = lambda c: F.floor(c / 256)
    spread = parts.withColumn("block", F.explode(F.sequence(block(F.col("from")), block(F.col("until") - 1))))
    line = ["graph", "first_src", "first_dst"]
    hit = ranked.drop("steps").withColumn("block", block(F.col("rank"))).join(spread.hint("merge"), [*line, "block"]).where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("until")))
    heads = ranked.select(*line, F.col("rank").alias("from"), F.col("src").alias("h_src"), F.col("dst").alias("h_dst"))
    named = hit.join(heads.hint("merge"), [*line, "from"])
    return named.select(*ARC, F.col("h_src").alias("first_src"), F.col("h_dst").alias("first_dst"), (F.col("rank") - F.col("from")).alias("rank"), (F.col("until") - F.col("from")).alias("steps"))


def linestrings(nodes: DataFrame, edges: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """(graph, line, nodes, cls): graphs cut at class changes, forks, ends and generated splits.

    ``splits`` is (graph, node). A line is one row; its class is that of its
    second node, or of its last one if it has two.
    """
    order = line_order(edges, splits, nodes.select("graph", "node", "cls")).join(nodes.select("graph", "node", "cls").hint("merge"), ["graph", "node"])
    rows = order.groupBy("graph", "first", "second").agg(F.sort_array(F.collect_list(F.struct("k", "node", "cls"))).alias("p"))
    return rows.select("graph", F.xxhash64("first", "second").alias("line"), F.transform("p", lambda n: n["node"]).alias("nodes"), F.element_at("p", 2)["cls"].alias("cls"))


def robust_directions(nodes: DataFrame, edges: DataFrame, steps: int = 3) -> DataFrame:
    """``nodes`` with dx, dy, a unit vector: the mean of the last ``steps`` steps of the line to the node (W4); null without an edge.

    A line's first node has the direction of its first step. At a fork the
    direction that most of its edges share counts, if there is one (A13); else,
    as at a node of several lines, that of the line of least name that ends
    there, or else begins there.
    """
    at = nodes.select("graph", "node", "x", "y")
    order = materialize(line_order(edges), "line-order")
    line = ["graph", "first", "second"]
    placed = order.join(at, ["graph", "node"])
    ahead = placed.select(*line, (F.col("k") + 1).alias("k"), F.col("x").alias("px"), F.col("y").alias("py"))
    ux, uy = g.unit(F.col("x") - F.col("px"), F.col("y") - F.col("py"))
    each = materialize(placed.join(ahead, [*line, "k"]).select(*line, "k", ux.alias("ux"), uy.alias("uy")), "line-steps")
    # a step counts for the node at its end and for the next ones
    spread = each.select(*line, F.explode(F.sequence(F.col("k"), F.col("k") + steps - 1)).alias("k"), "ux", "uy")
    spread = spread.unionByName(each.where("k = 1").select(*line, F.lit(0).cast("long").alias("k"), "ux", "uy"))
    mean = spread.groupBy(*line, "k").agg(F.sum("ux").alias("sx"), F.sum("uy").alias("sy")).join(order, [*line, "k"])
    dx, dy = g.unit(F.col("sx"), F.col("sy"))
    along = mean.groupBy("graph", "node").agg(F.min_by(F.struct(dx.alias("dx"), dy.alias("dy")), F.struct((F.col("k") == 0).alias("begins"), "first", "second")).alias("d"))
    # only forks are asked for their neighbours
    forks = materialize(degrees(edges).where("degree > 2").select("graph", F.col("node").alias("src")), "forks")
    arms = undirected(edges).join(forks, ["graph", "src"], "left_semi")
    arms = arms.join(at.withColumnRenamed("node", "src"), ["graph", "src"]).join(at.select("graph", F.col("node").alias("dst"), F.col("x").alias("ox"), F.col("y").alias("oy")), ["graph", "dst"])
    vx, vy = g.unit(F.col("ox") - F.col("x"), F.col("oy") - F.col("y"))
    arms = materialize(arms.select("graph", F.col("src").alias("node"), "dst", vx.alias("dx"), vy.alias("dy")), "fork-arms")
    won = consensus(arms, ["graph", "node"], "dst").where("winner is not null").select("graph", "node", F.col("winner").alias("dst"))
    shared = arms.join(won, ["graph", "node", "dst"]).select("graph", "node", F.struct("dx", "dy").alias("s"))
    kept = [c for c in nodes.columns if c not in ("dx", "dy")]
    out = nodes.select(*kept).join(along, ["graph", "node"], "left").join(shared, ["graph", "node"], "left")
    return out.select(*kept, F.coalesce("s", "d")["dx"].alias("dx"), F.coalesce("s", "d")["dy"].alias("dy"))


def branch_lengths(edges: DataFrame) -> DataFrame:
    """(graph, fork, to, nodes, last): the nodes of each branch of a fork until the next fork or the end.

    ``to`` is the branch's first node, ``last`` where it stops, that node not
    counted if it is a fork, but at least one node counts.
    """
    arcs = materialize(undirected(edges).where("graph is not null and src is not null and dst is not null"), "line-arcs")
    deg = materialize(arcs.groupBy("graph", F.col("src").alias("node")).agg(F.count("*").alias("degree")), "degrees")
    ranked = _ranked(arcs, deg.where("degree <> 2").select("graph", "node"))
    heads = ranked.where("rank = 0").join(deg.where("degree > 2").select("graph", F.col("node").alias("src")), ["graph", "src"], "left_semi")
    ends = heads.join(deg.select("graph", F.col("node").alias("last_dst"), "degree"), ["graph", "last_dst"])
    return ends.select("graph", F.col("src").alias("fork"), F.col("dst").alias("to"), F.greatest(F.col("steps") - F.when(F.col("degree") > 2, 1).otherwise(0), F.lit(1)).alias("nodes"), F.col("last_dst").alias("last"))


def fork_cuts(edges: DataFrame, max_len: int | None = None) -> DataFrame:
    """(graph, src, dst): the first edge of every branch of a fork beyond its two longest, of those of at most ``max_len`` nodes."""
    rank = F.row_number().over(Window.partitionBy("graph", "fork").orderBy(F.desc("nodes"), "to"))
    cut = branch_lengths(edges).withColumn("k", rank).where("k > 2")
    if max_len is not None:
        cut = cut.where(F.col("nodes") <= max_len)
    return cut.select("graph", F.least("fork", "to").alias("src"), F.greatest("fork", "to").alias("dst")).distinct()
