"""SimHash near-duplicates by covering locality-sensitive hashing.

Bits 0..63 are given vectors of r+1 bits. For every non-zero vector v there is
a mask of the bits whose vector is orthogonal to v (modulo 2), and a table
keyed by the fingerprint's other bits cleared. Any r differing bits leave some
v orthogonal to all their vectors, so a pair within radius r meets in a table
for certain.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.operators.components import connected_components
from roadweave.storage import materialize, release

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Partners that a node names in a table at first.
FIRST_RANKS = 2
#: Tables that are searched first, so that large classes are known in the others.
FIRST_TABLES = 8
#: Places to which a sketch deals a text's shingles.
SKETCH_BITS = 512


@lru_cache
def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The kept bits of each table: 2**(radius+1) - 1 masks that cover the radius.

    A bit is kept where its vector's product with the table's is odd. Vectors
    are dealt by the stride that leaves the poorest table the most bits.
    """
    n = 2 ** (radius + 1) - 1

    def by_stride(stride: int) -> list[int]:
        vectors = [i * stride % n + 1 for i in range(bits)]
        return [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2) for v in range(1, n + 1)]

    return max((by_stride(s) for s in range(1, n + 1)), key=lambda m: min(x.bit_count() for x in m))


def shingles(text: bytes | None, size: int) -> list[bytes]:
    """All runs of ``size`` words, A-Z lower-cased, repeats too; fewer words are one run, none are none."""
    words = (text or b"").lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False)))


def _majority(digests: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Bytes whose bits are set in over half of the digests' (n, bytes) weight."""
    ones = np.zeros(8 * digests.shape[1], np.int64)
    for at in range(0, len(digests), 4096):
        bits = np.unpackbits(digests[at : at + 4096], axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64) if weights is None else weights[at : at + 4096] @ bits
    return np.packbits(2 * ones > (len(digests) if weights is None else weights.sum()), bitorder="little")


def fingerprint(text: bytes | None, shingle: int = SHINGLE, most: int | None = None) -> int:
    """The unsigned 64-bit SimHash of a text; 0 without words.

    With ``most``, a shingle that is repeated counts so many times at most, so
    that no word speaks for the whole text.
    """
    import xxhash

    parts, weights = shingles(text, shingle), None
    if not parts:
        return 0
    if most is not None:
        counts = Counter(parts)
        parts, weights = list(counts), np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), most)
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), np.uint64, len(parts))
    return int(_majority(h.astype("<u8").view(np.uint8).reshape(-1, 8), weights).view("<u8")[0])


def wide_fingerprint(text: bytes | None, shingle: int) -> tuple[int, int]:
    """Two unsigned halves of a 128-bit SimHash; 0 without words."""
    import xxhash

    parts = shingles(text, shingle)
    if not parts:
        return 0, 0
    h = np.frombuffer(b"".join(map(partial(xxhash.xxh128_digest, seed=SEED), parts)), np.uint8).reshape(-1, 16)
    low, high = _majority(h).view("<u8")
    return int(low), int(high)


def parity_sketch(text: bytes | None, shingle: int) -> bytes:
    """The number of distinct shingles, a long, and a bit for each of ``SKETCH_BITS`` places: whether an odd number of them falls there.

    Shingles that two texts share fall out of the bits by which their sketches
    differ, so these are at most as many as the shingles that only one has.
    """
    import xxhash

    parts = set(shingles(text, shingle))
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), np.uint64, len(parts))
    odd = np.bincount((h % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) % 2
    return np.array([len(parts)], np.int64).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def surely_apart(known: dict[int, bytes], a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rids cannot have ``least`` of their shingles in common, by the sketches ``known``; of a pair without both, none.

    Of n shingles of two texts together, both counted, (1 - least) / (1 + least) at
    most are of one text only if they have ``least`` in common.
    """
    out = np.zeros(len(a), bool)
    if not known:
        return out
    none = np.full(1 + SKETCH_BITS // 64, -1, np.int64).tobytes()
    for at in range(0, len(a), 65536):
        ids, place = np.unique(np.concatenate([a[at : at + 65536], b[at : at + 65536]]), return_inverse=True)
        sketches = np.frombuffer(b"".join(known.get(i, none) for i in ids.tolist()), np.int64).reshape(len(ids), -1)
        x, y = np.split(sketches[place], 2)
        differ = np.bitwise_count((x[:, 1:] ^ y[:, 1:]).view(np.uint64)).sum(1, dtype=np.int64)
        far = differ > (x[:, 0] + y[:, 0]) * (1 - least) / (1 + least) + 1e-6
        out[at : at + 65536] = far & (x[:, 0] >= 0) & (y[:, 0] >= 0)
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, most: int | None = None, check_shingle: int | None = None) -> DataFrame:
    """``docs`` with ``__fp``, the fingerprint as a signed long, and ``__check`` and ``__check2``, those of other shingles or 0; whole texts, null as empty."""

    @F.pandas_udf("fp long, check long, check2 long")
    def run(texts: pd.Series) -> pd.DataFrame:
        n = len(texts)
        fps = np.fromiter((fingerprint(t, shingle, most) for t in texts), np.uint64, n)
        wide = np.array([wide_fingerprint(t, check_shingle) if check_shingle else (0, 0) for t in texts], np.uint64).reshape(n, 2)
        return pd.DataFrame({"fp": fps.view(np.int64), "check": wide[:, 0].view(np.int64), "check2": np.ascontiguousarray(wide[:, 1]).view(np.int64)})

    made = docs.withColumn("__made", run(F.col(text).cast("binary")))
    return made.withColumns({"__fp": F.col("__made.fp"), "__check": F.col("__made.check"), "__check2": F.col("__made.check2")}).drop("__made")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def bucket_links(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Tree edges (parent, child), as places in ``fps``, of the classes that links of at most ``radius`` bits make.

    A search that takes every fingerprint out of the rest once it is reached:
    linear edges, all links counted, none listed pair by pair. Each edge is a
    link itself.
    """
    fps = fps.astype(np.int64).view(np.uint64)
    rest = np.arange(len(fps))
    edges = []
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            k = todo.pop()
            near = np.bitwise_count(fps[rest] ^ fps[k]) <= radius
            if near.any():
                found = rest[near]
                todo += found.tolist()
                edges.append(np.column_stack([np.full(len(found), k), found]))
                rest = rest[~near]
    return np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)


def first_met(differ: np.ndarray, kept: np.ndarray, t: int) -> np.ndarray:
    """Which pairs, by the bits in which they differ, meet in table ``t`` and in no earlier one."""
    alive = np.arange(len(differ))
    for mask in kept[:t]:
        if not len(alive):
            break
        alive = alive[(differ[alive] & mask) != 0]
    out = np.zeros(len(differ), bool)
    out[alive] = True
    return out


def ranked_links(x: np.ndarray, component: np.ndarray, asking: np.ndarray, kept: np.ndarray, t: int, radius: int, check_radius: int, low: int, high: int, refused: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of places in ``x``, places that have more) of a bucket of (fingerprint, check, check) rows.

    A row's partners are those within both radii that it meets in no earlier
    table, by bits of check. Each place in ``asking`` names the ones from rank
    ``low`` up to ``high`` that are of another component, without pairs of places
    that are ``refused``. Ranks are the same in every round.
    """
    fps, checks = x[:, 0].astype(np.int64).view(np.uint64), np.ascontiguousarray(x[:, 1:], np.int64).view(np.uint64)
    found, more = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
    if (component == component[0]).all():
        return found[0], more[0]
    for block in range(0, len(asking), 256):
        here = asking[block : block + 256]
        differ = fps[here, None] ^ fps[None]
        i, j = np.nonzero(np.bitwise_count(differ) <= radius)
        keep = here[i] != j
        i, j = i[keep], j[keep]
        d = np.bitwise_count(checks[here[i]] ^ checks[j]).sum(1, dtype=np.uint16)
        near = np.flatnonzero(d <= check_radius)
        near = near[first_met(differ[i[near], j[near]], kept, t)]
        i, j, d = i[near], j[near], d[near]
        order = np.lexsort((j, d, i))
        i, j = i[order], j[order]
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, np.int64)
        rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)]))
        apart = component[here[i]] != component[j]
        if refused is not None:
            asked = np.flatnonzero(apart)
            apart[asked] = ~refused(here[i[asked]], j[asked])
        more.append(here[np.unique(i[apart & (rank >= high)])])
        named = apart & (rank >= low) & (rank < high)
        a, b = here[i[named]], j[named]
        found.append(np.column_stack([np.minimum(a, b), np.maximum(a, b)]))
    return np.unique(np.concatenate(found), axis=0), np.concatenate(more)


def _tables(rows: DataFrame, radius: int, *others: str) -> DataFrame:
    """(t, key, fp, check, check2, others): each row once a table."""
    tables = F.array(*[F.struct(F.lit(t).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(m if m < 2**63 else m - 2**64)).alias("key")) for t, m in enumerate(masks(radius))])
    return rows.select("fp", "check", "check2", *others, F.explode(tables).alias("x")).select("x.t", "x.key", "fp", "check", "check2", *others)


def _buckets(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[list[tuple[int, int, np.ndarray]], pd.DataFrame]]:
    """Whole buckets of batches sorted by (t, key): those of two rows as one table, larger ones (t, key, rows) by themselves."""
    held: list[np.ndarray] = []
    held_key = None
    for batch in batches:
        if not len(batch):
            continue
        t, key, x = batch["t"].to_numpy(), batch["key"].to_numpy(), batch[columns].to_numpy()
        starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (key[1:] != key[:-1])])
        ends = np.r_[starts[1:], len(t)]
        large = []
        if held_key == (t[0], key[0]):
            held.append(x[: ends[0]])
            starts, ends = starts[1:], ends[1:]
        two = pd.DataFrame(columns=["t", "i", "j"])
        if len(starts):
            if sum(map(len, held)) > 1:
                large.append((*held_key, np.concatenate(held)))
            held, held_key = [x[starts[-1] :]], (t[-1], key[-1])
            sizes = ends[:-1] - starts[:-1]
            pair = starts[np.flatnonzero(sizes == 2)]
            two = t[pair], x[pair], x[pair + 1]
            large += [(t[starts[i]], key[starts[i]], x[starts[i] : ends[i]]) for i in np.flatnonzero(sizes > 2)]
            yield large, two
    if sum(map(len, held)) > 1:
        yield [(*held_key, np.concatenate(held))], None


PAIR = ["a", "a_check", "a_check2", "b", "b_check", "b_check2"]


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, a_check, a_check2, b, b_check, b_check2): links between distinct (fp, check, check2) rows that hold all their classes together.

    A bucket gives the edges of a tree, and of those only the pairs that meet in
    no earlier table. A pair left out is connected by the tree of its first
    table, whose own left-out edges are by still earlier ones; so nothing is
    lost, and a class costs about its size, not its size times the tables.
    """
    kept = np.array(masks(radius), np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for large, two in _buckets(batches, ["fp", "check", "check2"]):
            edges = []
            if two is not None:
                t, a, b = two
                near = np.bitwise_count((a[:, 0] ^ b[:, 0]).view(np.uint64)) <= radius
                e = np.column_stack([a[near], b[near]])
                differ = (e[:, 0] ^ e[:, 3]).view(np.uint64)
                edges.append(e[((differ[:, None] & kept) == 0).argmax(1) == t[near]] if len(e) else e)
            for t, _, x in large:
                e = bucket_links(x[:, 0], radius)
                e = np.column_stack([x[e[:, 0]], x[e[:, 1]]])
                edges.append(e[first_met((e[:, 0] ^ e[:, 3]).view(np.uint64), kept, t)])
            if sum(map(len, edges)):
                yield pd.DataFrame(np.concatenate(edges), columns=PAIR)

    rows = _tables(distinct, radius)
    return rows.repartition("t", "key").sortWithinPartitions("t", "key").mapInPandas(run, ", ".join(f"{n} long" for n in PAIR))


def _met(rows: DataFrame, radius: int, first: int, last: int) -> DataFrame:
    """(t, key, fp, check, check2, rid, component, sketch, asks): each row once a table from ``first`` up to ``last``, by whole buckets; all ask.

    Keys are made of the fingerprints again where the rows arrive, not carried.
    """
    kept = F.array(*[F.lit(m if m < 2**63 else m - 2**64).cast("long") for m in masks(radius)])
    key = F.col("fp").bitwiseAND(kept[F.col("t")])
    dealt = rows.select(F.explode(F.sequence(F.lit(first), F.lit(last - 1))).alias("t"), *NODE, "rid", "component", "sketch").repartition("t", key)
    return dealt.select("t", key.alias("key"), *NODE, "rid", "component", "sketch", F.lit(1).cast("long").alias("asks")).sortWithinPartitions("t", "key")


def candidates(rows: DataFrame, radius: int, check_radius: int, low: int, high: int, least: float = 0.0) -> DataFrame:
    """(t, key, a, b, bits): of each bucket the links (rids, bits of check) of rank ``low`` to ``high`` between components; rows with a null b are buckets of which a node has more.

    ``rows`` is (t, key, fp, check, check2, rid, component, sketch, asks), the whole
    of each bucket in a row; only rows that ask look for partners. Pairs whose
    sketches, where both have one, tell that they have less than ``least`` in common
    are no links. Of an open bucket all rows come back, with bits 1 for those that
    have more.
    """
    kept = np.array(masks(radius), np.uint64)
    columns = ["fp", "check", "check2", "rid", "component", "asks"]
    ints = {"t": "int32", "key": "int64", "a": "int64", "b": "Int64", "bits": "int64"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, bytes] = {}

        def noted() -> Iterator[pd.DataFrame]:
            for batch in batches:
                has = batch["sketch"].notna()
                known.update(zip(batch.loc[has, "rid"].tolist(), batch.loc[has, "sketch"], strict=True))
                yield batch

        for large, two in _buckets(noted(), columns):
            edges, left = [], []
            if two is not None and low == 0:
                t, a, b = two
                near = (np.bitwise_count((a[:, 0] ^ b[:, 0]).view(np.uint64)) <= radius) & (a[:, 4] != b[:, 4])
                t, a, b = t[near], a[near], b[near]
                near = np.bitwise_count((a[:, 1:3] ^ b[:, 1:3]).view(np.uint64)).sum(1) <= check_radius
                t, a, b = t[near], a[near], b[near]
                ok = (((a[:, 0] ^ b[:, 0]).view(np.uint64)[:, None] & kept) == 0).argmax(1) == t if len(a) else np.zeros(0, bool)
                a, b = a[ok], b[ok]
                near = ~surely_apart(known, a[:, 3], b[:, 3], least)
                edges.append((a[near], b[near]))
            for t, key, x in large:
                e, more = ranked_links(x[:, :3], x[:, 4], np.flatnonzero(x[:, 5]), kept, int(t), radius, check_radius, low, high, lambda i, j, x=x: surely_apart(known, x[i, 3], x[j, 3], least))
                edges.append((x[e[:, 0]], x[e[:, 1]]))
                if len(more):
                    asks = np.zeros(len(x), np.int64)
                    asks[more] = 1
                    left.append(pd.DataFrame({"t": t, "key": key, "a": x[:, 3], "b": pd.NA, "bits": asks}))
            if any(len(a) for a, _ in edges):
                a, b = (np.concatenate(side) for side in zip(*edges, strict=True))
                bits = np.bitwise_count((a[:, 1:3] ^ b[:, 1:3]).view(np.uint64)).sum(1, dtype=np.int64)
                yield pd.DataFrame({"t": 0, "key": 0, "a": np.minimum(a[:, 3], b[:, 3]), "b": np.maximum(a[:, 3], b[:, 3]), "bits": bits}).astype(ints)
            if left:
                yield pd.concat(left).astype(ints)

    return rows.mapInPandas(run, "t int, key long, a long, b long, bits long")


NODE = ("fp", "check", "check2")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, most: int | None = None, check_shingle: int | None = None, check_radius: int | None = None) -> DataFrame:
    """(doc_id, __fp, component_id) for every row of ``docs``.

    component_id is the least doc_id that links of at most ``radius`` differing
    bits reach; with ``check_shingle`` a link also needs 128-bit fingerprints of
    those shingles within ``check_radius``, so that a wide radius brings no
    strangers. Equal texts share a fingerprint, so copies are one node; texts
    without words have fingerprint 0 and are linked like any other. A null
    doc_id is never a component_id unless a class has no other. An empty table
    gives an empty result.
    """
    made = fingerprints(docs.select("doc_id", "text"), shingle=shingle, most=most, check_shingle=check_shingle)
    rows = materialize(made.select("doc_id", "__fp", "__check", "__check2"), "simhash")
    nodes = rows.groupBy(F.col("__fp").alias("fp"), F.col("__check").alias("check"), F.col("__check2").alias("check2")).agg(F.min("doc_id").alias("least"))
    nodes = materialize(nodes.withColumn("rid", F.monotonically_increasing_id()), "simhash-nodes")
    if check_shingle:
        of = linked(nodes.select(*NODE, "rid"), radius, check_radius)
    else:
        edges = materialize(link_fingerprints(nodes.select(*NODE), radius).select("a", "b").distinct(), "simhash-edges")
        of = connected_components(edges, "a", "b").join(nodes.select(F.col("fp").alias("node"), "rid"), "node").select("rid", "component")
    least = of.join(nodes, "rid").groupBy("component").agg(F.min("least").alias("component_id"))
    classes = nodes.join(of.join(least, "component").select("rid", "component_id"), "rid", "left")
    classes = classes.select(F.col("fp").alias("__fp"), F.col("check").alias("__check"), F.col("check2").alias("__check2"), F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(classes, ["__fp", "__check", "__check2"]).drop("__check", "__check2")


def overlap(a: bytes | None, b: bytes | None, shingle: int) -> float:
    """Common shingles of two texts as a share of all; texts without words are alike."""
    x, y = set(shingles(a, shingle)), set(shingles(b, shingle))
    return len(x & y) / len(x | y) if x or y else 1.0


def only(rows: DataFrame, rid: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose ``rid`` is one of ``wanted`` (rid).

    Ids meet the rows as words of 64 bits, which are few enough to be sent to
    them; so the rows, whole texts, are not shuffled.
    """
    at = lambda c: F.expr(f"cast(`{c}` & 63 as int)")
    word = lambda c: F.shiftright(c, 6).alias("__word")
    words = wanted.select("rid", word("rid"), F.call_function("shiftleft", F.lit(1).cast("long"), at("rid")).alias("bit"))
    words = materialize(words.groupBy("__word").agg(F.bit_or("bit").alias("__bits")), "simhash-words")
    found = rows.select("*", word(rid)).join(words, "__word")
    return found.where(F.call_function("shiftright", F.col("__bits"), at(rid)).bitwiseAND(F.lit(1).cast("long")) == 1).select(*rows.columns)


def verified(edges: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """Edges (a, b) between rows whose texts have at least ``least`` of their shingles in common.

    ``texts`` is (rid, text). Only texts that an edge names are carried to it;
    their joins sort, as texts are far larger in memory than the files by whose
    size they would be broadcast.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [overlap(x, y, shingle) >= least for x, y in zip(batch["a_text"], batch["b_text"], strict=True)]
            yield batch.loc[ok, ["a", "b"]]

    named = edges.select(F.col("a").alias("rid")).unionAll(edges.select(F.col("b").alias("rid")))
    held = materialize(only(texts, "rid", named).select("rid", F.col("text").cast("binary").alias("text")), "simhash-texts")
    side = lambda k: held.select(F.col("rid").alias(k), F.col("text").alias(f"{k}_text")).hint("merge")
    pairs = edges.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "a_text", "b", "b_text")
    links = materialize(pairs.mapInPandas(run, "a long, b long"), "simhash-links")
    release(held)
    return links


def _merged(named: DataFrame, links: DataFrame) -> DataFrame:
    """``named`` with the components that ``links`` (a, b), a table, join as one."""
    if links.isEmpty():
        return named
    of = lambda k: named.select(F.col("rid").alias(k), F.col("component").alias(f"{k}_c"))
    between = links.join(of("a"), "a").join(of("b"), "b").select("a_c", "b_c").distinct()
    merged = connected_components(between, "a_c", "b_c").select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return materialize(named.join(merged, "component", "left").select(*NODE, "rid", F.coalesce("merged", "component").alias("component")), "simhash-classes")


def settled(named: DataFrame, pairs: DataFrame, verify: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """``named`` (fp, check, check2, rid, component) with components joined by those of ``pairs`` (a, b, bits) that ``verify`` keeps.

    Each node's nearest candidate is compared first, and of the others only
    those that are still of two components; so a large class compares about
    its size, and every pair is compared or within a class in the end.
    """
    if verify is None:
        return _merged(named, pairs)
    few = named.count() // 4
    for all_left in (False, True):
        of = lambda k, named=named: named.select(F.col("rid").alias(k), F.col("component").alias(f"{k}_c"))
        apart = materialize(pairs.join(of("a"), "a").join(of("b"), "b").where("a_c <> b_c").select("a", "b", "bits"), "simhash-pairs")
        if not (n := apart.count()):
            return named
        if n <= few or all_left:
            return _merged(named, verify(apart))
        nearest = lambda k, o, apart=apart: apart.groupBy(k).agg(F.min(F.struct("bits", o)).alias("m")).select(k, F.col(f"m.{o}").alias(o))
        picked = materialize(nearest("a", "b").unionByName(nearest("b", "a")).distinct(), "simhash-picked")
        named = _merged(named, verify(picked))
        pairs = apart.join(picked, ["a", "b"], "left_anti")


def sketched(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rid, sketch) of the ``texts`` (rid, text) that ``wanted`` (rid) names."""

    @F.pandas_udf("binary")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([parity_sketch(t, shingle) for t in column], dtype=object)

    return materialize(only(texts, "rid", wanted).select("rid", run(F.col("text").cast("binary")).alias("sketch")), "simhash-sketches")


def linked(nodes: DataFrame, radius: int, check_radius: int, verify: Callable[[DataFrame], DataFrame] | None = None, sketch: Callable[[DataFrame], DataFrame] | None = None, least: float = 0.0) -> DataFrame:
    """(rid, component): the classes that links make; ``verify`` keeps of candidate pairs (a, b) those that are links.

    ``nodes`` is (fp, check, check2, rid). The nearest partners of each node in
    a few tables are compared first; what they join is one component, and only
    pairs of different components are compared after that, in the other tables,
    then rank by rank, until no candidate is left. Nodes that have more partners
    than they name take a ``sketch`` (rid, sketch), by which their buckets refuse
    pairs far below ``least`` without naming them. So a class costs about its size,
    and so do near copies that are just too different to be of it; none is parted
    by a candidate that is refused.
    """
    named, tables = nodes.select(*NODE, "rid", F.col("rid").alias("component")), len(masks(radius))
    open_, sketches = None, nodes.select("rid", F.lit(None).cast("binary").alias("sketch")).where("false")
    for first, last in ((0, min(FIRST_TABLES, tables)), (FIRST_TABLES, tables)):
        if first < last:
            found = materialize(candidates(_met(named.join(sketches, "rid", "left"), radius, first, last), radius, check_radius, 0, FIRST_RANKS, least), "simhash-candidates")
            named = settled(named, found.where("b is not null").select("a", "b", "bits"), verify)
            left = found.where("b is null")
            open_ = left if open_ is None else open_.unionAll(left)
            if sketch is not None and not left.isEmpty():
                sketches = sketches.unionAll(sketch(left.select(F.col("a").alias("rid")).join(sketches, "rid", "left_anti")))
    low, high = FIRST_RANKS, FIRST_RANKS * 8
    # few large buckets are dealt to as many tasks as there are, not joined by their bytes
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while not open_.isEmpty():
        rows = open_.select("t", "key", F.col("a").alias("rid"), F.col("bits").alias("asks")).join(named, "rid").join(sketches, "rid", "left")
        rows = rows.select("t", "key", *NODE, "rid", "component", "sketch", "asks").repartition(parts, "t", "key").sortWithinPartitions("t", "key")
        found = materialize(candidates(rows, radius, check_radius, low, high, least), "simhash-candidates")
        named = settled(named, found.where("b is not null").select("a", "b", "bits"), verify)
        open_ = found.where("b is null")
        low, high = high, high * 8
    return named.select("rid", "component")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, most: int | None = None, check_shingle: int = 5, check_radius: int = 26, least: float = 0.8) -> DataFrame:
    """One row of each class of near-duplicates, all columns kept: that of the least doc_id.

    Rows are candidates within ``radius`` bits and ``check_radius`` of 128 bits
    of a fingerprint of ``check_shingle`` words; of those the ones stay linked
    whose texts have at least ``least`` of these shingles in common, compared
    exactly; no link is lost for one that is refused. Equal texts are one class, whatever their number; texts without
    words are one class. Of rows with one doc_id that with the least hash of its
    text stands first, of repeated rows any one; a null doc_id comes last. An
    empty table gives an empty result.
    """
    made = fingerprints(docs.withColumn("__rid", F.monotonically_increasing_id()), shingle=shingle, most=most, check_shingle=check_shingle)
    rows = materialize(made, "simhash-rows")
    rank = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.xxhash64("text").alias("tie"), F.col("__rid").alias("rid"))
    nodes = rows.groupBy(F.col("__fp").alias("fp"), F.col("__check").alias("check"), F.col("__check2").alias("check2")).agg(F.min(rank).alias("first"))
    nodes = materialize(nodes, "simhash-nodes")
    texts = rows.select(F.col("__rid").alias("rid"), "text")
    of = linked(nodes.select(*NODE, F.col("first.rid").alias("rid")), radius, check_radius, lambda pairs: verified(pairs, texts, check_shingle, least), lambda wanted: sketched(texts, wanted, check_shingle), least)
    firsts = nodes.select("first").join(of, F.col("first.rid") == F.col("rid"), "left").select("first", F.coalesce("component", "first.rid").alias("component"))
    kept = firsts.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    return only(rows, "__rid", kept).select(*docs.columns)
