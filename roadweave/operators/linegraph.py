"""Work that is sequential inside one graph: walks, clean-up, linestrings.

Graphs of a table are spread over the cluster, one group each; inside, a small
adjacency structure is worked on in Python. Large graphs whose clusters become
boxes first are clustered by tables, so that only what is left of them meets in
tasks, a connected part each. Rows in and out are
(graph, part, kind, a, b, x, y, cls, fallback, type): a node row has its id in
``a``; an edge row its ends in ``a`` and ``b``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import shapes
from roadweave.storage import materialize

ROWS = "graph long, part long, kind string, a long, b long, x double, y double, cls long, fallback long, type string"
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]


@dataclass
class Graph:
    """Nodes (x, y, cls, fallback) by id, and neighbours in the order of their edges."""

    nodes: dict[int, tuple[float, float, int, int | None]] = field(default_factory=dict)
    adj: dict[int, list[int]] = field(default_factory=dict)
    type: str | None = None

    def add(self, node: int, x: float, y: float, cls: int = 0, fallback: int | None = None) -> None:
        self.nodes[node] = (x, y, cls, fallback)
        self.adj.setdefault(node, [])

    def connect(self, a: int, b: int) -> None:
        if a != b and b not in self.adj[a]:
            self.adj[a].append(b)
            self.adj[b].append(a)

    def remove(self, nodes: Iterable[int]) -> None:
        for n in set(nodes):
            for m in self.adj.pop(n):
                self.adj[m].remove(n)
            del self.nodes[n]

    def cut(self, a: int, b: int) -> None:
        self.adj[a].remove(b)
        self.adj[b].remove(a)

    def xy(self, nodes: Iterable[int]) -> np.ndarray:
        return np.array([self.nodes[n][:2] for n in nodes], float).reshape(-1, 2)

    def induced(self, keep: Iterable[int]) -> Graph:
        keep = set(keep)
        return Graph({n: self.nodes[n] for n in self.nodes if n in keep}, {n: [m for m in self.adj[n] if m in keep] for n in self.nodes if n in keep}, self.type)

    def components(self) -> list[list[int]]:
        seen: set[int] = set()
        out = []
        for n in sorted(self.nodes):
            if n in seen:
                continue
            todo, part = [n], []
            seen.add(n)
            while todo:
                u = todo.pop()
                part.append(u)
                for v in self.adj[u]:
                    if v not in seen:
                        seen.add(v)
                        todo.append(v)
            out.append(sorted(part))
        return out

    def split(self, least: int = 2) -> list[Graph]:
        return [self.induced(c) for c in self.components() if len(c) >= least]

    def majority(self, nodes: Iterable[int]) -> int:
        n = Counter(self.nodes[k][2] for k in nodes)
        return min(n, key=lambda c: (-n[c], c))


Processor = Callable[[Graph], list[Graph]]


def candidate_groups(g: Graph, min_degree: int | None = 3, max_cycle_len: int | None = None) -> list[list[int]]:
    """Components of what basis cycles cover once nodes of degree ``min_degree`` or less are left out (G1)."""
    ring = {n for c in shapes.cycle_basis(g.adj) if len(c) >= 2 and (max_cycle_len is None or len(c) <= max_cycle_len) for n in c}
    sub = g.induced(ring)
    if min_degree is not None:
        sub = sub.induced([n for n in sub.nodes if len(sub.adj[n]) > min_degree])
    return sub.components()


def box_replace(min_cluster_size: int = 5, replace_only: list[int] | None = None, min_degree: int | None = 3, max_cycle_len: int | None = None) -> Processor:
    """Dense clusters become rectangles of type box, after what is left of the graph."""

    def run(g: Graph) -> list[Graph]:
        if g.type is not None:
            return [g]
        boxes = []
        rest = g.induced(g.nodes)
        for group in candidate_groups(g, min_degree, max_cycle_len):
            cls = g.majority(group)
            if len(group) < min_cluster_size or replace_only is not None and cls not in replace_only:
                continue
            box = Graph(type="box")
            for k, (x, y) in enumerate(shapes.min_area_rectangle(g.xy(group))):
                box.add(k, float(x), float(y), cls)
            for k in range(4):
                box.connect(k, (k + 1) % 4)
            boxes.append(box)
            rest.remove(group)
        return (rest.split() if boxes else [g]) + boxes

    if max_cycle_len is None:
        # all cycles together cover the nodes of edges that are no bridges, which tables can tell
        run.over_tables = {"min_cluster_size": min_cluster_size, "replace_only": replace_only, "min_degree": min_degree}
    return run


def fit_replace(min_nodes: int = 10, curve_deg: int = 3, sample_dist: float = 0.2, max_fit_items: int | None = None, replace_only: list[int] | None = None, min_degree: int | None = None, max_cycle_len: int | None = 4) -> Processor:
    """Clusters become a polynomial of their longer axis, their outer neighbours tied to its nearest node."""

    def run(g: Graph) -> list[Graph]:
        if g.type is not None:
            return [g]
        out = g.induced(g.nodes)
        for group in candidate_groups(g, min_degree, max_cycle_len):
            if len(group) < min_nodes or max_fit_items is not None and len(group) > max_fit_items:
                continue
            cls = g.majority(group)
            if replace_only is not None and cls not in replace_only:
                continue
            pts = g.xy(group)
            main = int(np.ptp(pts[:, 1]) > np.ptp(pts[:, 0]))
            order = np.argsort(pts[:, main], kind="stable")
            u, v = pts[order, main], pts[order, 1 - main]
            lo, hi = u[1], u[-2]
            if hi <= lo:
                continue
            fit = np.polynomial.Polynomial.fit(u, v, min(curve_deg, len(np.unique(u)) - 1))
            at = np.linspace(lo, hi, int((hi - lo) / sample_dist) + 1)
            made = np.column_stack([at, fit(at)] if main == 0 else [fit(at), at])
            members = set(group)
            outer = sorted({m for n in group for m in out.adj[n] if m not in members})
            base = max(out.nodes) + 1
            out.remove(group)
            for k, (x, y) in enumerate(made):
                out.add(base + k, float(x), float(y), cls)
                if k:
                    out.connect(base + k - 1, base + k)
            for m in outer:
                out.connect(m, base + int(np.hypot(*(made - out.xy([m])).T).argmin()))
        return [out]

    return run


def cycle_flatten(max_cycle_nodes: int = 6) -> Processor:
    """Small cycles become their centroids, one at a time, ids the greatest of the cycle."""

    def run(g: Graph) -> list[Graph]:
        if g.type is not None:
            return [g]
        out = g.induced(g.nodes)
        while True:
            small = [c for c in shapes.cycle_basis(out.adj) if len(c) <= max_cycle_nodes]
            if not small:
                return [out]
            ring = small[0]
            members, keep = set(ring), max(ring)
            x, y = out.xy(ring).mean(0)
            cls, fallback = out.majority(ring), out.nodes[keep][3]
            outer = [m for n in ring for m in out.adj[n] if m not in members]
            out.remove(ring)
            out.add(keep, float(x), float(y), cls, fallback)
            for m in outer:
                out.connect(keep, m)

    return run


def auto_circle(min_sector_angle_deg: float = 180, min_nodes: int = 20, max_nodes: int = 100, max_outliers: int = 5, threshold: float = 0.5, max_iters: int = 50, resample_distance: float = 0.25, max_fit_radius: float = 100, seed: int = 1234) -> Processor:
    """Graphs that lie on a circle become a full ring of type circle (G5); draws are seeded by graph."""

    def run(g: Graph) -> list[Graph]:
        ids = sorted(g.nodes)
        if g.type is not None or not min_nodes <= len(ids) <= max_nodes:
            return [g]
        pts = g.xy(ids)
        rng = np.random.default_rng(seed)
        best = None
        for _ in range(max_iters):
            c = shapes.circle_of(*pts[rng.choice(len(pts), 3, replace=False)])
            if c is None or c[2] > max_fit_radius:
                continue
            off = np.abs(np.hypot(*(pts - c[:2]).T) - c[2])
            if (off > threshold).sum() <= max_outliers and (best is None or off.mean() < best[0]):
                best = (off.mean(), c)
        if best is None or shapes.sector(pts, best[1]) <= min_sector_angle_deg:
            return [g]
        x, y, r = best[1]
        n = max(3, int(2 * np.pi / np.arcsin(min(1.0, resample_distance / r))))
        ring = Graph(type="circle")
        for k in range(n):
            p = np.array([x + r * np.cos(2 * np.pi * k / n), y + r * np.sin(2 * np.pi * k / n)])
            near = g.nodes[ids[int(np.hypot(*(pts - p).T).argmin())]]
            ring.add(k, float(p[0]), float(p[1]), near[2], near[3])
        for k in range(n):
            ring.connect(k, (k + 1) % n)
        return [ring]

    return run


def lines_of(g: Graph, max_angle_deg: float | None = None, cuts: set[int] | None = None, by_class: bool = False) -> list[list[int]]:
    """Node paths between ends, forks, cut nodes, sharp corners and, ``by_class``, class changes.

    Every edge is on one path. A ring without such a node begins at its least
    id and comes back to it. Walks begin at the least ids.
    """
    cuts = cuts or set()
    done: set[tuple[int, int]] = set()

    def stops(n: int) -> bool:
        return len(g.adj[n]) != 2 or n in cuts

    def turns(a: int, b: int, c: int) -> bool:
        if by_class and g.nodes[b][2] != g.nodes[c][2]:
            return True
        if max_angle_deg is None:
            return False
        p, q, r = g.xy([a, b, c])
        u, v = q - p, r - q
        n = np.hypot(*u) * np.hypot(*v)
        return bool(n and np.degrees(np.arccos(np.clip(u @ v / n, -1, 1))) >= max_angle_deg)

    def walk(a: int, b: int) -> list[list[int]]:
        out, path = [], [a, b]
        done.update({(a, b), (b, a)})
        while not stops(path[-1]):
            here, before = path[-1], path[-2]
            ahead = [m for m in g.adj[here] if m != before]
            if not ahead or (here, ahead[0]) in done:
                break
            if turns(before, here, ahead[0]):
                out.append(path)
                path = [here]
            path.append(ahead[0])
            done.update({(here, ahead[0]), (ahead[0], here)})
        return [*out, path]

    lines = []
    for n in sorted(g.nodes, key=lambda n: (not stops(n), n)):
        for m in g.adj[n]:
            if (n, m) not in done:
                lines += walk(n, m)
    return lines


def line_smooth(smooth_coeff: float, smooth_shapes: bool = True, min_line_nodes: int = 4, max_angle_delta_deg: float = 60) -> Processor:
    """Inner nodes of lines move to a smoothing spline; lines of ``min_line_nodes`` or fewer stay, boxes and circles too.

    The coefficient bounds a line's squared deviations in all; places are by the
    length of its chords.
    """
    if smooth_coeff <= 0:
        raise ValueError("the coefficient must be positive")

    def run(g: Graph) -> list[Graph]:
        if g.type is not None and (not smooth_shapes or g.type in ("box", "circle")):
            return [g]
        out = g.induced(g.nodes)
        for line in lines_of(g, max_angle_delta_deg):
            if len(line) <= min_line_nodes:
                continue
            xy = g.xy(line)
            chords = np.hypot(*np.diff(xy, axis=0).T)
            if not chords.all():
                continue
            moved, _ = shapes.smoothing_spline(np.r_[0.0, chords.cumsum()] / chords.sum(), xy, smooth_coeff)
            for n, (x, y) in list(zip(line, moved, strict=True))[1:-1]:
                out.nodes[n] = (float(x), float(y), *g.nodes[n][2:])
        return [out]

    return run


def fork_remove(max_len: int | None = None) -> Processor:
    """At forks all but the two longest branches are cut, if no longer than ``max_len``; typed graphs pass."""

    def run(g: Graph) -> list[Graph]:
        if g.type is not None:
            return [g]
        out = g.induced(g.nodes)
        for n in sorted(g.nodes):
            if len(g.adj[n]) <= 2:
                continue
            sizes = []
            for first in g.adj[n]:
                before, here, size, seen = n, first, 1, {n, first}
                while len(g.adj[here]) == 2:
                    ahead = [m for m in g.adj[here] if m != before]
                    if not ahead or ahead[0] in seen or len(g.adj[ahead[0]]) > 2:
                        break
                    before, here = here, ahead[0]
                    seen.add(here)
                    size += 1
                sizes.append((-size, first))
            for size, first in sorted(sizes)[2:]:
                if (max_len is None or -size <= max_len) and first in out.adj[n]:
                    out.cut(n, first)
        return out.split()

    return run


def dead_end_remove() -> Processor:
    """Leaves beside forks go until the fork has degree 2 (G7), for use in a stack."""

    def run(g: Graph) -> list[Graph]:
        if g.type is not None or len(g.nodes) <= 2:
            return [g]
        out = g.induced(g.nodes)
        for n in sorted(g.nodes):
            leaves = sorted(m for m in g.adj[n] if len(g.adj[m]) == 1)
            if len(g.adj[n]) > 2:
                out.remove(leaves[: len(g.adj[n]) - 2])
        return [out]

    return run


def drop_short(min_nodes: int) -> Processor:
    return lambda g: [g] if len(g.nodes) >= min_nodes else []


def fallback_class(target_class: int, valid_fallback: list[int] | None = None, set_class: int | None = None, consider_boxes: bool = False) -> Processor:
    """Nodes of a class take their fallback if it is listed, else ``set_class``."""
    if valid_fallback is None and set_class is None:
        raise ValueError("neither a fallback nor a class to set")

    def run(g: Graph) -> list[Graph]:
        if g.type == "box" and not consider_boxes:
            return [g]
        out = g.induced(g.nodes)
        for n, (x, y, cls, fallback) in g.nodes.items():
            if cls == target_class:
                new = fallback if fallback in (valid_fallback or []) else set_class if set_class is not None else cls
                out.nodes[n] = (x, y, new, fallback)
        return [out]

    return run


def to_rows(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Tables nodes(graph, node, x, y, cls[, fallback, type]) and edges(graph, src, dst) as rows."""
    opt = lambda c, kind: (F.col(c) if c in nodes.columns else F.lit(None)).cast(kind).alias(c)
    n = nodes.select(F.col("graph").cast("long"), F.lit(0).cast("long").alias("part"), F.lit("node").alias("kind"), F.col("node").cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.col("x").cast("double"), F.col("y").cast("double"), opt("cls", "long"), opt("fallback", "long"), opt("type", "string"))
    e = edges.select(F.col("graph").cast("long"), F.lit(0).cast("long").alias("part"), F.lit("edge").alias("kind"), F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b"), *[F.lit(None).cast("double").alias(c) for c in "xy"], *[F.lit(None).cast("long").alias(c) for c in ("cls", "fallback")], F.lit(None).cast("string").alias("type"))
    return n.unionByName(e)


def nodes_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'node'").select("graph", "part", F.col("a").alias("node"), "x", "y", "cls", "fallback", "type")


def edges_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'edge'").select("graph", "part", F.col("a").alias("src"), F.col("b").alias("dst"))


def from_rows(rows: list[dict]) -> Graph:
    """One graph of a group's rows; edges to missing nodes and loops are left out, null classes are 0."""
    g = Graph()
    for r in sorted((r for r in rows if r["kind"] == "node"), key=lambda r: r["a"]):
        g.add(r["a"], r["x"], r["y"], r["cls"] or 0, r["fallback"])
        g.type = g.type or r["type"]
    for r in sorted((r for r in rows if r["kind"] == "edge"), key=lambda r: (r["a"], r["b"])):
        if r["a"] in g.nodes and r["b"] in g.nodes:
            g.connect(r["a"], r["b"])
    return g


SCHEMA = pa.schema([(c.split()[0], {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}[c.split()[1]]) for c in ROWS.split(", ")])


def to_table(graph: int | None, graphs: list[Graph]) -> pa.Table:
    rows: list[tuple] = []
    for part, g in enumerate(graphs):
        rows += [(graph, part, "node", int(n), None, float(x), float(y), int(cls), None if fallback is None else int(fallback), g.type) for n, (x, y, cls, fallback) in sorted(g.nodes.items())]
        rows += [(graph, part, "edge", int(a), int(b), None, None, None, None, g.type) for a in sorted(g.adj) for b in g.adj[a] if a < b]
    columns = zip(*rows, strict=True) if rows else [[] for _ in COLUMNS]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


#: Rows of a graph up to which it is worked on whole in one task, whatever the stack.
WHOLE_ROWS = 200_000
#: Nodes up to which a table of them is sent to the edges.
SENT_NODES = 200_000


def process(rows: DataFrame, *stack: Processor) -> DataFrame:
    """A stack of processors over every graph, in one pass; graphs of the result have parts.

    Where the stack begins with ``box_replace``, graphs of more than
    ``WHOLE_ROWS`` rows are clustered by tables, and the rest of the stack works
    on what is left, part by part; parts are numbered as in one pass.
    """
    rows = materialize(rows, "graph-rows")
    if not stack or not hasattr(stack[0], "over_tables"):
        return _processed(rows, stack)
    large = materialize(rows.groupBy("graph").agg(F.count("*").alias("n")).where((F.col("n") > WHOLE_ROWS) & F.col("graph").isNotNull()).select("graph"), "large-graphs")
    if large.isEmpty():
        return _processed(rows, stack)
    small = rows.join(F.broadcast(large), "graph", "left_anti").select(*COLUMNS)
    split = _clustered(rows.join(F.broadcast(large), "graph", "left_semi").select(*COLUMNS), **stack[0].over_tables)
    made = materialize(_processed(split, stack[1:], ["first", "least"]), "graph-parts")
    number = F.row_number().over(Window.partitionBy("graph").orderBy("first", "least", "part")).cast("long") - 1
    parts = made.select("graph", "first", "least", "part").distinct().withColumn("number", number)
    numbered = made.join(parts, ["graph", "first", "least", "part"]).withColumn("part", F.col("number")).select(*COLUMNS)
    return _processed(small, stack).unionByName(numbered)


def _processed(rows: DataFrame, stack: tuple[Processor, ...], by: list[str] | None = None) -> DataFrame:
    """The stack over the graphs of the table, or over the pieces of them that ``by``, long columns that stay, tells apart."""
    by = by or []

    def run(group: pa.Table) -> pa.Table:
        keys = {c: group.column(c)[0].as_py() for c in by}
        group = group.to_pylist()
        work = [from_rows(group)]
        for p in stack:
            work = [made for g in work for made in p(g)]
        out = to_table(group[0]["graph"], work)
        for c, v in keys.items():
            out = out.append_column(c, pa.array([v] * len(out), pa.int64()))
        return out

    return rows.groupBy("graph", *by).applyInArrow(run, ", ".join([ROWS, *[f"{c} long" for c in by]]))


class Forests:
    """The edges of a graph, one at a time, that are in one of ``k`` forests: the first that they do not close a cycle in.

    Of any cut these keep ``k`` edges, or all if there are fewer; so two forests
    have the bridges of the whole graph, and forests of parts of a graph can be
    put together. Memory grows with the nodes, not with the edges.
    """

    def __init__(self, k: int) -> None:
        self.parents: list[dict[int, int]] = [{} for _ in range(k)]

    def root(self, node: int, k: int = 0) -> int:
        p = self.parents[k]
        up = p.setdefault(node, node)
        while up != node:
            p[node] = p[up]
            node = p[node]
            up = p[node]
        return node

    def add(self, a: int, b: int) -> bool:
        for k, p in enumerate(self.parents):
            u, v = self.root(a, k), self.root(b, k)
            if u != v:
                p[max(u, v)] = min(u, v)
                return True
        return False


EDGE = "graph long, src long, dst long"


def _forest_edges(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    held: dict[int, Forests] = {}
    for batch in batches:
        rows = zip(batch["graph"].tolist(), batch["src"].tolist(), batch["dst"].tolist(), strict=True)
        kept = []
        for g, a, b in rows:
            if g not in held:
                held[g] = Forests(k)
            kept.append(held[g].add(a, b))
        yield batch[kept]


def _by_graph(edges: DataFrame, k: int) -> DataFrame:
    """Edges (graph, src, dst) of ``k`` forests of what each task holds, then dealt by graph."""
    return edges.select("graph", "src", "dst").mapInPandas(lambda batches: _forest_edges(batches, k), EDGE).repartition("graph")


def _connected(edges: DataFrame) -> DataFrame:
    """(graph, node, least): the least node connected to each node of an edge, inside its graph.

    Edges stay where they are but for forests of them, so a task holds nodes of
    a graph, not its edges.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, Forests] = {}
        for batch in batches:
            for g, a, b in zip(batch["graph"].tolist(), batch["src"].tolist(), batch["dst"].tolist(), strict=True):
                held.setdefault(g, Forests(1)).add(a, b)
        for g, forest in held.items():
            yield pd.DataFrame({"graph": g, "node": list(forest.parents[0]), "least": [forest.root(n) for n in list(forest.parents[0])]})

    return _by_graph(edges, 1).mapInPandas(run, "graph long, node long, least long")


def bridges(adj: dict[int, list[int]]) -> set[tuple[int, int]]:
    """Edges, lesser node first, that no cycle goes through."""
    low: dict[int, int] = {}
    at: dict[int, int] = {}
    out = set()
    for top in adj:
        if top in at:
            continue
        at[top] = low[top] = len(at)
        todo = [(top, None, iter(adj[top]))]
        while todo:
            node, before, ahead = todo[-1]
            for m in ahead:
                if m == before:
                    continue
                if m in at:
                    low[node] = min(low[node], at[m])
                else:
                    at[m] = low[m] = len(at)
                    todo.append((m, node, iter(adj[m])))
                    break
            else:
                todo.pop()
                if before is not None:
                    low[before] = min(low[before], low[node])
                    if low[node] > at[before]:
                        out.add((min(node, before), max(node, before)))
    return out


def _on_cycles(edges: DataFrame) -> DataFrame:
    """(graph, node, lost): nodes on a cycle, and how many of their neighbours are on none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[Forests, dict[int, list[int]]]] = {}
        for batch in batches:
            for g, a, b in zip(batch["graph"].tolist(), batch["src"].tolist(), batch["dst"].tolist(), strict=True):
                forests, adj = held.setdefault(g, (Forests(2), {}))
                if forests.add(a, b):
                    adj.setdefault(a, []).append(b)
                    adj.setdefault(b, []).append(a)
        for g, (_, adj) in held.items():
            off = bridges(adj)
            # all edges of a node that is on no cycle are bridges, and these are in the forests
            ring = {n for n, ms in adj.items() if any((min(n, m), max(n, m)) not in off for m in ms)}
            yield pd.DataFrame([(g, n, sum(m not in ring for m in adj[n])) for n in ring], columns=["graph", "node", "lost"])

    return _by_graph(edges, 2).mapInPandas(run, "graph long, node long, lost long")


def _box_rows(group: pd.DataFrame) -> pd.DataFrame:
    corners = shapes.min_area_rectangle(group[["x", "y"]].to_numpy())
    at = {"graph": group["graph"].iat[0], "part": 0, "first": 1, "least": group["least"].iat[0], "fallback": None, "type": "box"}
    cls = int(group["cls"].iat[0])
    rows = [at | {"kind": "node", "a": k, "b": None, "x": float(x), "y": float(y), "cls": cls} for k, (x, y) in enumerate(corners)]
    rows += [at | {"kind": "edge", "a": k, "b": (k + 1) % 4, "x": None, "y": None, "cls": None} for k in range(4)]
    return pd.DataFrame(rows)[[*COLUMNS, "first", "least"]].astype({c: "Int64" for c in ("b", "cls", "fallback")})


def _clustered(rows: DataFrame, min_cluster_size: int, replace_only: list[int] | None, min_degree: int | None) -> DataFrame:
    """``box_replace`` by tables: rows with ``first`` and ``least``, which tell the graphs that it makes apart and are in their order.

    Edges are counted and thinned to forests where they are; a task holds nodes
    of one graph and at most two forests of it, and the points of one cluster.
    """
    held = lambda names: F.broadcast(names) if names.count() <= SENT_NODES else names.hint("merge")
    on = lambda side: lambda names: names.select("graph", F.col("node").alias(side))
    both_in = lambda edges, names, a="src", b="dst": edges.join(held(on(a)(names)), ["graph", a], "left_semi").join(held(on(b)(names)), ["graph", b], "left_semi")

    nodes = rows.where("kind = 'node'")
    open_ = nodes.join(nodes.where("type is not null").select("graph").distinct(), "graph", "left_anti")
    places = materialize(open_.select("graph", F.col("a").alias("node"), "x", "y", F.coalesce("cls", F.lit(0)).alias("cls")), "cluster-nodes")
    edges = rows.where("kind = 'edge' and a <> b").select("graph", F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()
    edges = materialize(both_in(edges, places.select("graph", "node").distinct()), "cluster-edges")
    degree = edges.select("graph", F.explode(F.array("src", "dst")).alias("node")).groupBy("graph", "node").agg(F.count("*").alias("degree"))
    core = _on_cycles(edges)
    if min_degree is not None:
        core = core.join(degree, ["graph", "node"]).where(F.col("degree") - F.col("lost") > min_degree)
    core = materialize(core.select("graph", "node"), "cluster-core")
    of = materialize(_connected(both_in(edges, core)), "cluster-parts")
    of = core.join(of, ["graph", "node"], "left").withColumn("least", F.coalesce("least", "node")).join(places, ["graph", "node"])
    votes = of.groupBy("graph", "least", "cls").agg(F.count("*").alias("n"))
    kept = votes.groupBy("graph", "least").agg(F.sum("n").alias("size"), F.min_by("cls", F.struct(-F.col("n"), "cls")).alias("cls")).where(F.col("size") >= min_cluster_size)
    if replace_only is not None:
        kept = kept.where(F.col("cls").isin(replace_only))
    members = materialize(of.drop("cls").join(kept.drop("size"), ["graph", "least"]).select("graph", "least", "node", "x", "y", "cls"), "cluster-members")
    boxes = members.groupBy("graph", "least").applyInPandas(_box_rows, ", ".join([ROWS, "first long", "least long"]))
    boxed = members.select("graph").distinct()
    gone = members.select("graph", F.col("node"))
    # what is left falls into its connected parts; single nodes go
    left = materialize(places.join(boxed, "graph", "left_semi").select("graph", "node").join(gone, ["graph", "node"], "left_anti"), "cluster-rest")
    links = materialize(both_in(rows.where("kind = 'edge' and a <> b"), left, "a", "b").select(*COLUMNS), "cluster-links")
    part = materialize(_connected(links.select("graph", F.col("a").alias("src"), F.col("b").alias("dst"))), "cluster-rest-parts")
    part = part.select("graph", F.col("node").alias("a"), "least")
    first = lambda df, k, least: df.select(*COLUMNS, F.lit(k).cast("long").alias("first"), least.cast("long").alias("least"))
    rest = first(nodes.join(part, ["graph", "a"]), 0, F.col("least")).unionByName(first(links.join(part, ["graph", "a"]), 0, F.col("least")))
    whole = first(rows.join(boxed, "graph", "left_anti"), 0, F.lit(0))
    return rest.unionByName(boxes).unionByName(whole)


def renumber(rows: DataFrame) -> DataFrame:
    """Every (graph, part) a graph of its own."""
    return rows.withColumn("graph", F.xxhash64("graph", "part")).withColumn("part", F.lit(0).cast("long"))


def points_of_interest(nodes: DataFrame, edges: DataFrame, max_corner_deg: float | None = None, parts: int | None = None) -> DataFrame:
    """(graph, node, reason): ends, forks, class changes and, with a limit, corners; boxes have none (L2). ``parts`` is the number of partitions that graphs are dealt to."""
    from roadweave.functions import geometry as geo
    from roadweave.operators.graphs import degrees, undirected

    open_ = nodes.where("type is null or type <> 'box'") if "type" in nodes.columns else nodes
    if parts is not None:
        # a graph's rows lie together through all that follows
        open_, edges = open_.repartition(parts, "graph"), edges.repartition(parts, "graph")
    deg = degrees(edges, parts).join(open_.select("graph", "node"), ["graph", "node"], "left_semi")
    ends = deg.where("degree <> 2").select("graph", "node", F.when(F.col("degree") == 1, "end").otherwise("fork").alias("reason"))
    both = undirected(edges, parts)
    at = lambda side: open_.select("graph", F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("x", "y", "cls")])
    pair = both.join(at("src"), ["graph", "src"]).join(at("dst"), ["graph", "dst"])
    change = pair.where("src_cls <> dst_cls").select("graph", F.col("src").alias("node"), F.lit("class").alias("reason"))
    out = ends.unionByName(change)
    if max_corner_deg is not None:
        two = deg.where("degree = 2").select("graph", F.col("node").alias("src"))
        arms = pair.join(two, ["graph", "src"]).groupBy("graph", "src", "src_x", "src_y").agg(F.min(F.struct("dst", "dst_x", "dst_y")).alias("p"), F.max(F.struct("dst", "dst_x", "dst_y")).alias("q"))
        sharp = geo.is_sharp(F.col("src_x") - F.col("p.dst_x"), F.col("src_y") - F.col("p.dst_y"), F.col("q.dst_x") - F.col("src_x"), F.col("q.dst_y") - F.col("src_y"), max_corner_deg)
        out = out.unionByName(arms.where(sharp).select("graph", F.col("src").alias("node"), F.lit("corner").alias("reason")))
    return (out if parts is None else out.repartition(parts, "graph", "node")).distinct()


def connect_heads(nodes: DataFrame, edges: DataFrame, max_dist: float, ignore_classes: list[int] | None = None, tails_only: bool = False, ignore_shapes: bool = True) -> tuple[DataFrame, DataFrame]:
    """Ends of lines are joined to another graph in range until none is left.

    Each degree-1 node takes the graph of least id with an allowed node in
    range, and its least node (Q18). All ends act at once, round by round;
    graphs that meet take the least id. Returns nodes with ``graph`` and their
    ``old_graph``, and edges between (old_graph, node) pairs.
    """
    from roadweave.operators import grid
    from roadweave.operators.components import connected_components

    cols = ["old_graph", "node", "graph", "x", "y", "cls"] + (["type"] if "type" in nodes.columns else [])
    now = materialize(nodes.withColumn("old_graph", F.col("graph")).select(*cols), "heads")
    link = materialize(edges.select(F.col("graph").alias("src_graph"), "src", F.col("graph").alias("dst_graph"), "dst"), "head-edges")
    # ends and allowed nodes only get fewer, so rounds end by themselves
    while True:
        ends = link.select(F.col("src_graph").alias("old_graph"), F.col("src").alias("node")).unionAll(link.select("dst_graph", "dst"))
        heads = now.join(ends.groupBy("old_graph", "node").agg(F.count("*").alias("n")).where("n = 1").drop("n"), ["old_graph", "node"], "left_semi")
        if ignore_shapes and "type" in nodes.columns:
            heads = heads.where("type is null")
        allowed = heads if tails_only else now
        if ignore_shapes and "type" in nodes.columns:
            allowed = allowed.where("type is null")
        if ignore_classes:
            allowed = allowed.where(~F.col("cls").isin(ignore_classes))
        hit = grid.pairs_within(heads, allowed, max_dist).where("l.graph <> r.graph")
        pick = hit.groupBy(F.col("l.old_graph").alias("src_graph"), F.col("l.node").alias("src"), F.col("l.graph").alias("g")).agg(F.min(F.struct(F.col("r.graph").alias("graph"), F.col("r.old_graph").alias("dst_graph"), F.col("r.node").alias("dst"))).alias("m"))
        pick = materialize(pick.select("src_graph", "src", "m.dst_graph", "m.dst", "g", F.col("m.graph").alias("h")), "head-picks")
        if pick.isEmpty():
            break
        # two ends that pick each other make one edge
        one = pick.select("src_graph", "src", "dst_graph", "dst").where(F.struct("src_graph", "src") < F.struct("dst_graph", "dst")).unionAll(pick.where(F.struct("src_graph", "src") > F.struct("dst_graph", "dst")).select(F.col("dst_graph").alias("src_graph"), F.col("dst").alias("src"), F.col("src_graph").alias("dst_graph"), F.col("src").alias("dst"))).distinct()
        link = materialize(link.unionByName(one), "head-edges")
        to = connected_components(pick.select(F.col("g").alias("src"), F.col("h").alias("dst"))).select(F.col("node").alias("graph"), "component")
        now = materialize(now.join(to, "graph", "left").withColumn("graph", F.coalesce("component", "graph")).select(*cols), "heads")
    return now, link
