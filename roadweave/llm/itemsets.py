"""Closed frequent itemsets of baskets and their rules.

Items ascend by support. An itemset's class holds the baskets that have it, with
those of their items that come later; classes are rows of DataFrames, spread
over the cluster. A class of bounded weight is searched where it is: a tree of
itemsets with their tidsets, diffsets below the first level, equal and contained
tidsets merged. A heavier class becomes the classes of its members by one more
round of counts, so a tidset of any size stays spread. A set that another class
shows not to be closed has the same tidset, so the same hash: of those with one
hash the longest stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.storage import materialize

#: Entries (basket, member) of a class that one task may search.
CLASS_WEIGHT = 1 << 18
#: Parts that rows of one key are dealt to before they meet a small table.
SALTS = 32
#: Baskets of more items are long ones, unless those are too many to stay apart.
LONG = 64

SETS = "items array<long>, counts array<long>, support long, x1 long, x2 long"


@dataclass
class Itemsets:
    """``sets``: items array<struct<n,item>> ascending by item, support; ``baskets``: how many there are."""

    sets: DataFrame
    baskets: int


def _hashes() -> list[Column]:
    """Two hashes of a basket; those of a tidset are their sums without carry."""
    return [F.xxhash64(F.lit(k), "t") for k in (1, 2)]


def _xors() -> list[Column]:
    return [F.bit_xor(h).alias(f"x{k}") for k, h in enumerate(_hashes(), 1)]


def _meet(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows joined to a table of one row a key, a frequent key's rows in several parts."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("t"), F.lit(SALTS)))
    held = table.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(held.hint("merge"), [*keys, "__salt"]).drop("__salt")


def _tails(rows: DataFrame) -> DataFrame:
    """(path, t, tail): each basket of a class dealt to its members' classes, with the members after each."""
    at = F.explode(F.sequence(F.lit(1), F.size("tail") - 1))
    dealt = rows.where(F.size("tail") > 1).withColumn("__at", at)
    return dealt.select(F.concat("path", F.array(F.element_at("tail", F.col("__at"))["item"])).alias("path"), "t", F.slice("tail", F.col("__at") + 1, F.size("tail")).alias("tail"))


def _counts(rows: DataFrame) -> DataFrame:
    """(path, m, n2, x1, x2): how many baskets of a class hold each member, and their hash."""
    return rows.select("path", "t", F.explode("tail").alias("m")).groupBy("path", "m").agg(F.count("*").alias("n2"), *_xors())


def _long_limit(baskets: DataFrame, need: int) -> int:
    """The least power of two, from LONG, that less than half of ``need`` baskets exceed."""
    above = {r["k"]: r["n"] for r in baskets.where(F.size("items") > LONG).groupBy(F.ceil(F.log2(F.size("items"))).alias("k")).agg(F.count("*").alias("n")).collect()}
    k = LONG.bit_length() - 1
    while 2 * sum(n for at, n in above.items() if at > k) >= need:
        k += 1
    return 1 << k


def _search(need: int):
    """A class's closed sets among its own members; cogroups its baskets with its description."""

    def closed(m: int, nodes: list[list], rows: np.ndarray, starts: np.ndarray, h: np.ndarray) -> Iterator[tuple[list[int], int, np.ndarray]]:
        buffer = np.zeros(m, bool)
        by_row = np.argsort(rows, kind="stable")
        ends = np.searchsorted(rows[by_row], np.arange(m + 1))
        member_of = np.repeat(np.arange(len(nodes)), np.diff(starts))[by_row]
        gone = np.zeros(len(nodes), bool)
        tids = [rows[starts[j] : starts[j + 1]] for j in range(len(nodes))]
        sizes = np.array([len(t) for t in tids])
        order = np.lexsort((np.arange(len(nodes)), sizes))
        place = np.empty(len(nodes), int)
        place[order] = np.arange(len(nodes))
        for j in order:
            if gone[j]:
                continue
            mine = tids[j]
            spans = ends[mine + 1] - ends[mine]
            flat = np.repeat(ends[mine] - np.r_[0, spans.cumsum()[:-1]], spans) + np.arange(spans.sum())
            shared = np.bincount(member_of[flat], minlength=len(nodes))
            items, children = list(nodes[j]), []
            for k in sorted(np.flatnonzero((shared >= need) & (place > place[j]) & ~gone).tolist(), key=lambda k: place[k]):
                if shared[k] == len(mine):
                    items += nodes[k]
                    gone[k] |= sizes[k] == len(mine)
                    continue
                gone[k] |= shared[k] == sizes[k]
                buffer[tids[k]] = True
                children.append((list(nodes[k]), mine[~buffer[mine]]))
                buffer[tids[k]] = False
            x = np.bitwise_xor.reduce(h[mine], axis=0)
            yield items, len(mine), x
            yield from below(items, len(mine), x, children, h, buffer)

    def below(prefix: list[int], support: int, x: np.ndarray, children: list, h: np.ndarray, buffer: np.ndarray) -> Iterator[tuple[list[int], int, np.ndarray]]:
        """Sets under a prefix whose children have diffsets; a stack, as chains may be long."""
        todo = [(prefix, support, x, children)]
        while todo:
            prefix, support, x, nodes = todo.pop()
            nodes = sorted(nodes, key=lambda c: -len(c[1]))
            live = [True] * len(nodes)
            for j, (own, gap) in enumerate(nodes):
                if not live[j]:
                    continue
                n = support - len(gap)
                items, kids = list(own), []
                buffer[gap] = True
                for k in range(j + 1, len(nodes)):
                    if not live[k]:
                        continue
                    more = nodes[k][1][~buffer[nodes[k][1]]]
                    both = n - len(more)
                    if both == n:
                        items += nodes[k][0]
                        live[k] = both < support - len(nodes[k][1])
                        continue
                    if both == support - len(nodes[k][1]):
                        live[k] = False
                    if both >= need:
                        kids.append((nodes[k][0], more))
                buffer[gap] = False
                whole = prefix + items
                xs = x ^ np.bitwise_xor.reduce(h[gap], axis=0) if len(gap) else x
                yield whole, n, xs
                if kids:
                    todo.append((whole, n, xs, kids))

    def run(baskets: pd.DataFrame, described: pd.DataFrame) -> pd.DataFrame:
        if not len(described) or not len(baskets):
            return pd.DataFrame(columns=["items", "counts", "support", "x1", "x2"])
        d = described.iloc[0]
        members = np.asarray(d["members"], np.int64)
        count_of = dict(zip(d["members"], d["member_counts"], strict=True)) | dict(zip(d["prefix"], d["prefix_counts"], strict=True))
        tails = baskets["tail"].to_list()
        lengths = np.fromiter(map(len, tails), np.int64, len(tails))
        flat = np.concatenate([np.asarray(t, np.int64) for t in tails])
        sorted_members = np.argsort(members, kind="stable")
        which = sorted_members[np.searchsorted(members, flat, sorter=sorted_members)]
        row = np.repeat(np.arange(len(tails)), lengths)
        by_member = np.lexsort((row, which))
        starts = np.searchsorted(which[by_member], np.arange(len(members) + 1))
        h = baskets[["h1", "h2"]].to_numpy(np.int64)
        prefix = list(d["prefix"])
        found = [(prefix + items, n, int(x[0]), int(x[1])) for items, n, x in closed(len(tails), [[int(v)] for v in members], row[by_member], starts, h)]
        return pd.DataFrame([(items, [count_of[i] for i in items], n, x1, x2) for items, n, x1, x2 in found], columns=["items", "counts", "support", "x1", "x2"])

    return run


def closed_itemsets(rows: DataFrame, basket: str, item: str, least: int = 5, share: int = 20_000, class_weight: int = CLASS_WEIGHT) -> Itemsets:
    """All closed itemsets whose support is at least ``least`` and 1/``share`` of the baskets.

    A basket is the distinct items of its rows; rows with a null basket or item
    are left out and make no basket, repeated rows count once. Items are whole
    numbers. An empty table gives an empty result. Frequent items are at most
    ``share`` times the mean basket, which bounds a basket's frequent items.
    """
    named = rows.select(F.col(basket).alias("t"), F.col(item).cast("long").alias("item")).where("t is not null and item is not null").distinct()
    pairs = materialize(named, "itemset-pairs")
    n_baskets = pairs.select("t").distinct().count()
    need = max(least, -(-n_baskets // share))
    frequent = materialize(pairs.groupBy("item").agg(F.count("*").alias("n"), *_xors()).where(F.col("n") >= need), "itemset-items")
    kept = _meet(pairs, frequent.select("item", "n"), ["item"])
    baskets = kept.groupBy("t").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("items"))
    baskets = materialize(baskets.where(F.size("items") > 1), "itemset-baskets")

    limit = _long_limit(baskets, need)
    none = F.expr("cast(array() as array<long>)")
    tails = _tails(baskets.where(F.size("items") <= limit).select(none.alias("path"), "t", F.col("items").alias("tail")))
    counts = _counts(tails)
    long_ones = baskets.where(F.size("items") > limit)
    if n_long := long_ones.count():
        more, counts = _long_baskets(long_ones, counts, need - n_long)
        tails = tails.unionByName(more)
    classes = frequent.select(F.array("item").alias("path"), F.array(F.struct("n", "item")).alias("prefix"), F.col("n").alias("support"), "x1", "x2")
    found = []
    while True:
        here, more = _level(classes, tails, counts, need, class_weight)
        found += here
        if more is None:
            break
        classes, tails = more
        counts = _counts(tails)
    sets = reduce(DataFrame.unionByName, found)
    # the subsumption index: one tidset, one closed set
    longest = sets.groupBy("support", "x1", "x2").agg(F.max_by("items", F.size("items")).alias("items"))
    closed = longest.select(F.array_sort(F.transform("items", lambda s: F.struct(s["item"].alias("item"), s["n"].alias("n")))).alias("items"), "support")
    return Itemsets(materialize(closed, "itemsets"), n_baskets)


def _long_baskets(long_ones: DataFrame, counts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(tails, counts) with the few long baskets: only pairs that can be frequent without them are looked up in them."""
    short = materialize(counts.where(F.col("n2") >= least), "itemset-pairs-short")
    cells = long_ones.select("t", F.explode("items").alias("m"))
    left = cells.select(F.array(F.col("m.item")).alias("path"), "t")
    both = short.select("path", "m").join(left, "path").join(cells, ["t", "m"]).select("path", "t", "m")
    both = materialize(both, "itemset-long")
    whole = short.unionByName(both.groupBy("path", "m").agg(F.count("*").alias("n2"), *_xors()))
    whole = whole.groupBy("path", "m").agg(F.sum("n2").alias("n2"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    return both.groupBy("path", "t").agg(F.sort_array(F.collect_list("m")).alias("tail")), whole


def _level(classes: DataFrame, tails: DataFrame, counts: DataFrame, need: int, class_weight: int) -> tuple[list[DataFrame], tuple[DataFrame, DataFrame] | None]:
    """(sets found, (classes, tails) of the members of too heavy classes or None)."""
    members = counts.where(F.col("n2") >= need).groupBy("path").agg(F.collect_list(F.struct("m", "n2", "x1", "x2")).alias("all"))
    held = classes.join(members.hint("merge"), "path", "left")
    whole = F.coalesce("all", F.expr("cast(array() as array<struct<m:struct<n:long,item:long>,n2:long,x1:long,x2:long>>)"))
    in_all = F.transform(F.filter(whole, lambda c: c["n2"] == F.col("support")), lambda c: c["m"])
    held = held.select("path", "support", "x1", "x2", F.concat("prefix", in_all).alias("prefix"), F.filter(whole, lambda c: c["n2"] < F.col("support")).alias("members"))
    weight = F.aggregate("members", F.lit(0).cast("long"), lambda n, c: n + c["n2"])
    kind = F.when(F.size("members") < 2, "leaf").when(weight <= class_weight, "search").otherwise("deal")
    held = materialize(held.withColumn("kind", kind), "itemset-classes")

    children = held.withColumn("c", F.explode("members")).select(
        "kind", F.concat("path", F.array("c.m.item")).alias("path"), F.concat("prefix", F.array("c.m")).alias("prefix"), F.col("c.n2").alias("support"), F.col("c.x1").alias("x1"), F.col("c.x2").alias("x2"))
    as_set = lambda df: df.select(F.col("prefix").alias("items"), "support", "x1", "x2")
    found = [as_set(held), as_set(children.where("kind = 'leaf'"))]

    known = F.transform("members", lambda c: c["m"])
    rows = _meet(tails, held.where("kind <> 'leaf'").select("path", "kind", known.alias("known")), ["path"])
    rows = rows.select("kind", "path", "t", F.array_intersect("tail", "known").alias("tail")).where(F.size("tail") > 0)
    rows = materialize(rows, "itemset-rows")
    described = held.where("kind = 'search'").select(
        "path", F.transform(known, lambda m: m["item"]).alias("members"), F.transform(known, lambda m: m["n"]).alias("member_counts"), F.transform("prefix", lambda m: m["item"]).alias("prefix"), F.transform("prefix", lambda m: m["n"]).alias("prefix_counts"))
    h1, h2 = _hashes()
    searched = rows.where("kind = 'search'").select("path", h1.alias("h1"), h2.alias("h2"), F.transform("tail", lambda m: m["item"]).alias("tail"))
    sets = searched.groupBy("path").cogroup(described.groupBy("path")).applyInPandas(_search(need), SETS)
    zipped = F.transform(F.arrays_zip("counts", "items"), lambda z: F.struct(z["counts"].alias("n"), z["items"].alias("item")))
    found.append(sets.select(zipped.alias("items"), "support", "x1", "x2"))
    if held.where("kind = 'deal'").isEmpty():
        return found, None
    dealt = materialize(_tails(rows.where("kind = 'deal'").drop("kind")), "itemset-tails")
    return found, (materialize(children.where("kind = 'deal'").drop("kind"), "itemset-children"), dealt)


def rules(found: Itemsets, confidence: int = 60) -> DataFrame:
    """(items, n_items, support, n_rules, best_item, rules_sha256) of every closed itemset.

    A rule takes one item c of the set; a is the support of the rest. The rest
    is closed itself, or its closure is the whole set and a the set's own
    support, so one join on the rest finds a.
    """
    b = F.lit(found.baskets).cast("long")
    name = F.array_join(F.transform("items", lambda m: m["item"].cast("string")), ",")
    sets = materialize(found.sets.select("items", name.alias("name"), "support"), "itemset-names")
    each = sets.where(F.size("items") > 1).select("name", "support", F.explode("items").alias("taken"), "items")
    rest = F.filter("items", lambda m: m["item"] != F.col("taken.item"))
    each = each.select("name", "support", F.col("taken.item").alias("c"), F.col("taken.n").alias("s"), rest.alias("rest"))
    one = each.where(F.size("rest") == 1).withColumn("a", F.element_at("rest", 1)["n"])
    more = each.where(F.size("rest") > 1).withColumn("rest_name", F.array_join(F.transform("rest", lambda m: m["item"].cast("string")), ","))
    more = more.join(sets.select(F.col("name").alias("rest_name"), F.col("support").alias("__a")).hint("merge"), "rest_name", "left").withColumn("a", F.coalesce("__a", "support"))
    cols = ["name", "support", "c", "a", "s"]
    held = one.select(*cols).unionByName(more.select(*cols)).where((100 * F.col("support") >= confidence * F.col("a")) & (F.col("support") * b > F.col("a") * F.col("s")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c", "a", "s"))), lambda r: F.concat_ws(":", r["c"], r["a"], r["s"])), ";")
    by_set = held.groupBy("name").agg(F.count("*").alias("n_rules"), F.min(F.struct("a", "c"))["c"].alias("best_item"), text.alias("text"))
    out = sets.join(by_set.hint("merge"), "name", "left")
    return out.select(F.col("name").alias("items"), F.size("items").cast("long").alias("n_items"), "support", F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"), "best_item", F.sha2(F.coalesce("text", F.lit("")), 256).alias("rules_sha256"))
