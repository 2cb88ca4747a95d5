"""Closed itemsets, Merkle manifests and line dedup against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from roadweave.llm import itemsets, linededup, merkle, queries
from tests_support import DOCS, ODD, clash


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


# Closed itemsets


def all_closed(baskets, need):
    """Every closed itemset by counting all sets of the baskets' frequent items."""
    count = defaultdict(int)
    single = defaultdict(int)
    for b in baskets:
        for i in b:
            single[i] += 1
    for b in baskets:
        kept = sorted(i for i in b if single[i] >= need)
        for n in range(1, len(kept) + 1):
            for s in combinations(kept, n):
                count[s] += 1
    often = {frozenset(s): n for s, n in count.items() if n >= need}
    return {s: n for s, n in often.items() if not any(s < t and m == n for t, m in often.items())}, often, single


def rules_by_hand(closed, often, single, b):
    out = {}
    for s, n in closed.items():
        rules = []
        for c in sorted(s) if len(s) > 1 else ():
            a = often[s - {c}]
            if 100 * n >= 60 * a and n * b > a * single[c]:
                rules.append((c, a, single[c]))
        best = min(((a, c) for c, a, _ in rules), default=(None, None))[1]
        out[",".join(map(str, sorted(s)))] = (len(s), n, len(rules), best, hashlib.sha256(";".join(f"{c}:{a}:{t}" for c, a, t in rules).encode()).hexdigest())
    return out


def shops(seed):
    """Baskets with items that are equal, contained or frequent, and two long baskets."""
    rng = random.Random(seed)
    out = []
    for _ in range(160):
        b = {rng.randrange(12) for _ in range(rng.randrange(1, 5))} | ({50} if rng.random() < 0.6 else set())
        if 3 in b:
            b |= {30, 31}  # equal to 3 in all baskets
        if 4 in b:
            b |= {40}  # 40 holds 4
        out.append(b | ({40} if rng.random() < 0.1 else set()))
    return [*out, set(range(12)) | {30, 31, 40}, set(range(0, 12, 2)) | {40, 50}]


@pytest.mark.parametrize(("seed", "weight", "long"), [(1, 1 << 18, 64), (2, 0, 64), (3, 25, 64), (4, 1 << 18, 4), (5, 40, 4), (6, 0, 4)])
def test_closed_itemsets_equal_brute_force(spark, monkeypatch, seed, weight, long):
    """In tasks, dealt out level by level (a class of any weight), or both; with long baskets apart or not."""
    monkeypatch.setattr(itemsets, "LONG", long)
    baskets = shops(seed)
    rows = [(k, i) for k, b in enumerate(baskets) for i in b] * 2 + [(None, 1), (3, None), (9999, None)]
    found = itemsets.closed_itemsets(spark.createDataFrame(rows, "sale_id long, item_id long").withColumn("t", F.lit("x")).withColumn("h1", F.lit(0)), "sale_id", "item_id", least=4, share=20_000, class_weight=weight)
    closed, often, single = all_closed(baskets, 4)
    assert found.baskets == len(baskets)
    assert {frozenset(m["item"] for m in r["items"]): r["support"] for r in found.sets.collect()} == closed and len(closed) > 60
    got = {r["items"]: (r["n_items"], r["support"], r["n_rules"], r["best_item"], r["rules_sha256"]) for r in itemsets.rules(found).collect()}
    assert got == rules_by_hand(closed, often, single, len(baskets)) and any(v[2] > 1 for v in got.values())


def test_share_of_baskets_and_empty_tables(spark):
    rows = [(k, i) for k in range(40) for i in (1, 2 + k % 2, 100 + k)] + [(41, -5), (42, -5)]
    df = spark.createDataFrame(rows, "sale_id long, item_id long")
    got = {r["items"]: r["support"] for r in itemsets.rules(itemsets.closed_itemsets(df, "sale_id", "item_id", least=2, share=3)).collect()}
    assert got == {"1": 40, "1,2": 20, "1,3": 20}  # a third of 42 baskets
    got = {r["items"]: r["support"] for r in itemsets.rules(itemsets.closed_itemsets(df, "sale_id", "item_id", least=2)).collect()}
    assert got == {"1": 40, "1,2": 20, "1,3": 20, "-5": 2}
    for empty in (df.where("false"), df.where("sale_id is null")):
        assert itemsets.rules(itemsets.closed_itemsets(empty, "sale_id", "item_id")).count() == 0


# Merkle manifests


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def proof(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i // 3 * 3 : i // 3 * 3 + 3]
        out.append((run[: i % 3], run[i % 3 + 1 :]))
        i //= 3
    return out


def manifest_by_hand(docs):
    """(doc_id, leaf) -> what is returned for it, from trees built in memory."""
    by = defaultdict(list)
    for d in docs:
        head = "".join(enc(d[c]) for c in ("doc_id", "source", "lang", "n_chars"))
        cut = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0
        seen = d["text"].replace("\n", "") if cut and d["text"] is not None else d["text"]
        by[d["source"]].append((d["doc_id"] is not None, d["doc_id"], h(head, enc(d["text"])), h(head, enc(seen))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, d, leaf, seen) in enumerate(sorted(by[s])):
            way = proof(trees[s], i) + proof(top, k)
            fold = seen
            for left, right in way:
                fold = h(*left, fold, *right)
            out.append((d, leaf, trees[s][-1][0], top[-1][0], h(*[x for left, right in way for x in left + right]), fold, fold == top[-1][0]))
    return out


@pytest.mark.parametrize("partitions", ["8", "3"])
def test_manifest_equals_trees_in_memory(spark, sf, tmp_path, partitions):
    rng = random.Random(5)
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    docs += [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in ODD]
    docs += [{"doc_id": 1000 + k, "text": f"a\nb{k}", "lang": None, "source": rng.choice(["é", "z", "Z", "hot", "hot", "hot", ""]), "n_chars": k} for k in range(200)]
    rng.shuffle(docs)
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in docs]
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = [tuple(r) for r in queries.op12_merkle(spark, str(tmp_path)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda r: (r[0] is not None, r[0], *map(str, r[1:]))
    assert sorted(got, key=key) == sorted(manifest_by_hand(docs), key=key)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 27, 28])
def test_trees_of_few_leaves(spark, n):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"), F.lit(1).alias("window"), F.lit(2).alias("key"))
    found, root = merkle.manifest(rows)
    whole = levels([h(str(i)) for i in range(n)])[-1] if n else []
    assert root == (whole[0] if n else None) and found.count() == n
    assert merkle.verify(found, root, F.col("leaf")).where("verified").count() == n
    assert {len(r["path"]) for r in found.collect()} <= {len(levels(list(range(0))) if not n else levels([h(str(i)) for i in range(n)])) - 1}
    assert merkle.verify(found, root, F.lit("0")).where("verified").count() == 0


# Line dedup


def dedup_by_hand(docs):
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(lower)
    last = float("inf")
    owner = {}
    for d, text in docs:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, last), last if d is None else d)
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == (last if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_docs(seed):
    rng = random.Random(seed)
    pool = [f"  Line NUMBER {k} {'é' * (k % 3)}" for k in range(40)] + ["short", "", "ten chars!", "nine char", "\tÀ line of its own\r"]
    docs = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 9)))) for k in range(60)]
    docs += [(3, "Line number 3 "), (3, "Line number 3 "), (5, "another text\nline number 7"), (None, "LINE NUMBER 9\nonly where no id is"), (None, "only where no id is"), (None, None), (99, None), (98, "")]
    docs += [(200 + k, "the most frequent line of all\n" + "x" * k) for k in range(300)]
    return [*docs, (700, "\n".join(f"repeated line {k % 500}" for k in range(2000))), (699, "\n".join(f"REPEATED line {k}" for k in range(400)))]


@pytest.mark.parametrize(("seed", "ranges"), [(1, 1), (2, 4), (3, 40)])
def test_line_dedup_equals_brute_force(spark, seed, ranges):
    docs = line_docs(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n_lines", "kept", "drops", "pos", "first", "h1")}).repartition(6)
    found = linededup.dedup_lines(df, ranges=ranges)
    out = linededup.with_kept(df, found)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in out.collect()), key=str)
    assert got == dedup_by_hand(docs)
    bitmap = found.where("doc.id = 700").first()
    # 400 of 500 lines are in 699 already, each four times here
    assert bitmap["n_dropped"] == 1600 and len(bitmap["drops"]) <= 32 and found.where("doc.id = 0").count() == 0


def test_line_dedup_odd_and_empty_tables(spark, odd, none):
    out = linededup.with_kept(clash(odd), linededup.dedup_lines(clash(odd)))
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in out.collect()), key=str) == dedup_by_hand([(r[0], r[1]) for r in ODD])
    assert linededup.with_kept(none, linededup.dedup_lines(none)).count() == 0


def test_lines_are_sorted_once_within_their_ranges(spark, odd):
    """First occurrences are streamed from the range sort itself: no exchange comes between them."""
    rows = linededup.keyed_lines(odd, "doc_id", "text", 10)
    plan = linededup.repeats(rows, 4)._jdf.queryExecution().executedPlan().toString()
    ranged = plan[plan.index("Window") :]
    assert ranged.index("rangepartitioning") < ranged.index("hashpartitioning") if "hashpartitioning" in ranged else "rangepartitioning" in ranged
