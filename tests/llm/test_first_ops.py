"""Sharding, language ID, chat formatting, mixing and SimHash against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadweave.llm import chat, langid, mixing, queries, sharding, simhash
from tests_support import DOCS, ODD, clash

DOC_LANG = "doc_id long, text string, lang string"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


def test_permutation_is_one(spark):
    rows = spark.range(1, 200).select(F.col("id").cast("int").alias("n"), sharding.permutation(F.col("id").cast("int"), F.lit(3)).alias("p")).collect()
    assert all(sorted(r["p"]) == list(range(r["n"])) for r in rows)
    assert rows[150]["p"] != sorted(rows[150]["p"])


def test_sharding_law_and_slots(spark, sf):
    out = queries.op1_sharding(spark, sf).collect()
    docs = {d["doc_id"]: d for d in docs_of(spark, sf)}
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    slots = defaultdict(list)
    for r in out:
        raw = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {tuple(r) for r in out} == {tuple(r) for r in queries.op1_sharding(spark, sf).collect()}


def test_sharding_small_buckets_and_odd_rows(spark, odd, none):
    many = spark.range(5000).select(F.col("id").alias("doc_id"))
    out = sharding.shard(many, 3, F.lit(10), bucket_rows=100).collect()
    for s in range(3):
        got = sorted((r["slot"], r["doc_id"]) for r in out if r["shard"] == s)
        assert [x for x, _ in got] == list(range(len(got)))
        assert [d for _, d in got] != sorted(d for _, d in got)
    same = sharding.shard(many.select(F.lit(1).alias("doc_id")), 3, F.lit(10)).collect()
    assert len({r["shard"] for r in same}) == 1 and sorted(r["slot"] for r in same) == list(range(5000))
    assert sharding.shard(clash(odd), 4, F.coalesce(F.octet_length("text"), F.lit(0))).count() == len(ODD)
    assert sharding.shard(none, 4, F.lit(1)).count() == 0


def test_written_shards_hold_the_rows_in_order(spark, odd, tmp_path):
    out = sharding.shard(odd, 2, F.lit(1))
    sharding.write_shards(out, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select(*out.columns).collect())) == sorted(map(str, out.collect()))


def test_language_id_held_out_accuracy(spark, odd, none):
    out = queries.op2_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    right = out.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.avg(F.when(F.col("n") > 100, (F.col("lang") == F.col("lang_pred")).cast("double"))), F.avg(F.col("accepted").cast("double"))).first()
    assert right[0] > 0.96 and right[1] > 0.98 and right[2] > 0.99
    model = langid.fit(docs.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet"), F.lit(True))
    got = {r["doc_id"]: r for r in langid.identify(clash(odd), model).collect()}
    assert [got[k]["lang_pred"] for k in (2, 3, 4, 6)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit(none, F.lit(True))).collect()} == {"und"}


def test_a_language_of_long_texts_only_beside_one_of_short_texts_is_learnt(spark):
    english, german = "the road turns left behind the old bridge and then ", "hinter der alten Brücke biegt die Straße nach links ab und dann "
    rows = [(k, english * 3, "en") for k in range(6)] + [(10 + k, german * 400, "de") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, F.col("doc_id") != 12)
    assert set(model) == {"en", "de"} and len(model["de"]) > langid.SAMPLE_CHARS
    assert {(r["lang"], r["lang_pred"]) for r in langid.identify(docs, model).collect()} == {("en", "en"), ("de", "de")}


def test_language_sample_of_null_and_repeated_keys(spark):
    english, german = "the road turns left behind the old bridge and then ", "hinter der alten Brücke biegt die Straße nach links ab und dann "
    rows = [(None, f"{english * 3} {k}", "en") for k in range(2000)] + [(None, f"{german * 3} {k}", "de") for k in range(2000)]
    model = langid.fit(spark.createDataFrame(rows, DOC_LANG), F.lit(True))
    assert set(model) == {"en", "de"} and all(len(v) >= langid.DICT_BYTES for v in model.values())
    # one key for all rows of a language, one text in most rows of another
    rows = [(7, f"{german * 3} {k}", "de") for k in range(300)] + [(k, english * 3, "en") for k in range(3000)] + [(9, f"{english} number {k}", "en") for k in range(50)]
    docs = spark.createDataFrame(rows, DOC_LANG)
    model = langid.fit(docs, F.lit(True))
    assert set(model) == {"en", "de"} and b"number" in langid.plain(model["en"].decode()) and langid.fit(docs.repartition(7), F.lit(True)) == model


def test_ties_and_narrow_margins_are_rejected(spark):
    model = langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), F.lit(True))
    classifier = langid.Classifier(model)
    for text in ("hi", "xyz xyz xyz", "q"):
        sizes = np.sort(classifier.sizes(langid.plain(text)))
        assert classifier.classify(text)[3] == (sizes[1] > sizes[0] and sizes[1] - sizes[0] >= langid.REJECT_MARGIN * sizes[0])
    same = langid.Classifier({"aa": b"one two three four " * 50, "bb": b"one two three four " * 50})
    assert [same.classify(t)[3] for t in ("one two", "one two three four " * 40, "another text")] == [False] * 3


def by_hand(turns):
    convs = defaultdict(list)
    for r in turns:
        convs[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    out = {}
    for k, v in convs.items():
        v.sort(key=lambda x: (x[0] is not None, x[0], x[1], x[2]))
        loss = "".join(t for _, r, t in v if r == "assistant")
        out[k] = (len(v), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in v).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    text = "</s>[INST] ok [/INST]"
    want = by_hand([r.asDict() for r in turns] + [{"conv_id": -1, "turn": 0, "role": "user", "text": text}, {"conv_id": -1, "turn": 1, "role": "assistant", "text": text}])
    out = queries.op4_chat_format(spark, sf).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out} == want


def test_chat_odd_turns_budget_and_repeats(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "a\\b <|end|>\n<|turn|>x"), (1, 2, "assistant", "\\<|\\|<\\|end|>"),
        (1, 2, "assistant", "same turn"), (1, 3, None, None), (1, None, "user", "no turn"),
        (2, 0, "system", "alone"), (None, 0, "user", "no id"), (None, 1, "assistant", "none"),
        *[(3, i, "system" if i == 0 else ("assistant" if i % 2 == 0 else "user"), f"turn {i} " + "w " * (i % 40)) for i in range(700)],
        (4, 0, "user", "long " * 5000), (4, 1, "assistant", "<s>" * 3000), (5, 0, "ro\nle", "\n"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1)).withColumn("start", F.lit(1))
    made = chat.windows(turns, budget=256, history_tokens=64)
    out = chat.read_back(made).collect()
    want = by_hand([dict(zip(("conv_id", "turn", "role", "text"), r, strict=True)) for r in rows])
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out} == want
    three = [r for r in made.collect() if r["conv_id"] == 3]
    assert len(three) > 50 and all(r["text"].startswith("<|turn|>system\nturn 0 ") for r in three)
    tokens = made.where("conv_id = 3").select(F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+"))).collect()
    assert max(t[0] for t in tokens) <= 256
    assert sum(x["repeated"] for r in three for x in r["turns"]) > 50
    assert chat.read_back(chat.windows(turns.limit(0))).count() == 0


def test_a_long_system_turn_is_in_every_window(spark):
    rows = [(1, 0, "system", "rule " * 900), *[(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "w " * 30) for k in range(1, 9)]]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(made) == 8 and all(r["text"].startswith("<|turn|>system\nrule rule ") for r in made)
    assert sum(not t["repeated"] for r in made for t in r["turns"]) == 9


def test_mix_near_targets(spark, sf, odd, none):
    out = queries.op8_mixing(spark, sf).collect()
    of = defaultdict(list)
    for r in out:
        of[round(r["target"], 3), r["source_size"]].append(r)
        assert r["taken"] <= 3 * r["size"]
    docs = {d["doc_id"]: d for d in docs_of(spark, sf)}
    sizes = defaultdict(int)
    for r in out:
        sizes[docs[r["doc_id"]]["source"]] += r["size"]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    free, left, targets = set(sizes), sum(sizes.values()), {}
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            targets |= share
            break
        for s in over:
            targets[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        free -= over
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        s = docs[r["doc_id"]]["source"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
        assert r["target"] == pytest.approx(targets[s])
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in targets)
    assert sum(r["copies"] for r in mixing.mix(clash(odd)).collect()) > 0
    assert mixing.mix(none).count() == 0


def test_mix_ranks_in_many_buckets(spark, monkeypatch):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("source"), F.repeat(F.lit("w "), (F.col("id") % 17).cast("int")).alias("text"))
    whole = {r["doc_id"]: r["copies"] for r in mixing.mix(rows).collect()}
    monkeypatch.setattr(mixing, "RANK_ROWS", 50)
    assert whole == {r["doc_id"]: r["copies"] for r in mixing.mix(rows.repartition(7)).collect()}
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert whole == {r["doc_id"]: r["copies"] for r in mixing.mix(rows, digest=True).collect()}


def slow_simhash(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), seed=42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps):
    ids, parent = list(fps), {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_simhash_against_all_pairs(spark, sf, odd, none):
    docs = docs_of(spark, sf)
    fps = {d["doc_id"]: slow_simhash(d["text"]) for d in docs}
    want = classes(fps)
    out = queries.op10_simhash(spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(clash(odd)).collect()}
    assert got[7] == 1 and got[2] == got[3] == got[4] == 2
    assert simhash.near_duplicates(odd).count() == len(ODD)
    kept = simhash.keep_one(clash(odd))
    assert kept.columns == clash(odd).columns
    # 7 has the words of 1, two of them in capitals; repeated rows and texts without words are one class each
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "6", "None"]
    assert simhash.keep_one(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_covering_links_dense_group(spark):
    import random

    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {i: base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for i in range(400)} | {i: rng.getrandbits(64) for i in range(400, 600)}
    want = classes(fps)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    df = spark.createDataFrame([(signed(f), 0, 0) for f in set(fps.values())], "fp long, check long, check2 long").repartition(5)
    from roadweave.operators.components import connected_components

    edges = simhash.link_fingerprints(df).select("a", "b")
    assert edges.count() <= 15 * len(fps)
    of = {r["node"]: r["component"] for r in connected_components(edges, "a", "b").collect()}
    groups = lambda m: {frozenset(v) for v in m if len(v) > 1}
    ours, theirs = defaultdict(set), defaultdict(set)
    for f in set(fps.values()):
        ours[of.get(signed(f), signed(f))].add(f)
    for i, f in fps.items():
        theirs[want[i]].add(f)
    assert groups(ours.values()) == groups(theirs.values())


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_masks_cover_the_radius(radius):
    import random

    rng = random.Random(radius)
    kept = simhash.masks(radius)
    assert len(kept) == 2 ** (radius + 1) - 1 and min(m.bit_count() for m in kept) >= 20
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & differ for m in kept)


def test_wide_radius_needs_the_check(spark):
    words = [f"w{k}" for k in range(150)]
    base, far = " ".join(words), " ".join(reversed(words))
    near, loose = " ".join(words[:40] + ["changed"] + words[41:]), " ".join(w if k % 12 else "changed" for k, w in enumerate(words))
    docs = spark.createDataFrame([(5, base), (3, near), (8, far), (9, base), (5, "another text of the same id"), (7, loose)], "doc_id long, text string")
    options = {"radius": 6, "shingle": 1, "most": 4, "check_shingle": 5, "check_radius": 26}
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs.where("text not like 'another%'"), **options).collect()}
    assert (got[5], got[3], got[9], got[8]) == (3, 3, 3, 8)
    # a document of which 8 in 10 shingles are not common stays, and so does another text of a doc_id that goes
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs, **options).collect()) == [3, 5, 7, 8]


def test_ranked_links_in_rounds_equal_all_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, (6, 3))
    blur = lambda: rng.integers(0, 2**63, (60, 3)) & rng.integers(0, 2**63, (60, 3)) & rng.integers(0, 2**63, (60, 3)) & rng.integers(0, 2**63, (60, 3)) & rng.integers(0, 2**63, (60, 3))
    x = np.concatenate([b ^ blur() for b in base])
    bits = lambda a, b: sum(int(p ^ q).bit_count() for p, q in zip(a, b, strict=True))
    kept = np.array(simhash.masks(4), np.uint64)
    want = {(j, i) for i in range(len(x)) for j in range(i) if bits(x[i, :1], x[j, :1]) <= 4 and bits(x[i, 1:], x[j, 1:]) <= 8}
    apart = np.arange(len(x))
    for first in (1, 4, 500):
        got, low, high, more = set(), 0, first, apart
        while len(more):
            pairs, more = simhash.ranked_links(x, apart, more, kept, 0, 4, 8, low, high)
            got |= set(map(tuple, pairs.tolist()))
            low, high = high, high * 8
        assert got == want and len(want) > 100
    pairs, more = simhash.ranked_links(x, np.zeros(len(x)), apart, kept, 0, 4, 8, 0, 8)
    assert not len(pairs) and not len(more)
    # in a later table only pairs count that no earlier one has
    later, _ = simhash.ranked_links(x, apart, apart, kept, 3, 4, 8, 0, 500)
    assert all(all(int(x[i, 0] ^ x[j, 0]) & int(m) for m in kept[:3]) for i, j in later.tolist())


def near_copies(rng, groups, size, words=160, change=0.035):
    """Groups of texts each of which changes some words of one text; many pairs are near 0.8, on either side."""
    out = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(words)]
        out += [" ".join(w if rng.random() > change * rng.random() else f"x{rng.randrange(9999)}" for w in base) for _ in range(rng.randrange(2, size))]
    return out


@pytest.mark.parametrize("first", [1, 2])
def test_no_link_is_lost_for_one_that_is_refused(spark, monkeypatch, first):
    import random

    monkeypatch.setattr(simhash, "FIRST_RANKS", first)
    texts = near_copies(random.Random(8), 25, 14)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = [(simhash.fingerprint(t.encode(), 1, 4), simhash.wide_fingerprint(t.encode(), 5), set(simhash.shingles(t.encode(), 5))) for t in texts]
    linked, refused = defaultdict(set), 0
    for i, (f, w, s) in enumerate(made):
        for j in range(i):
            g, v, r = made[j]
            if (f ^ g).bit_count() <= 6 and sum((p ^ q).bit_count() for p, q in zip(w, v, strict=True)) <= 28:
                if len(s & r) >= 0.8 * len(s | r):
                    linked[i].add(j)
                    linked[j].add(i)
                else:
                    refused += 1
    assert refused > 50

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        return min(seen)

    kept = simhash.keep_one(docs, radius=6, shingle=1, most=4, check_shingle=5, check_radius=28, least=0.8)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(len(texts)) if least(i) == i}


def test_a_large_class_compares_about_its_size(spark):
    rng = np.random.default_rng(6)
    n = 200
    fps = rng.integers(0, 2**62) ^ np.array([sum(1 << int(b) for b in rng.choice(62, 3, replace=False)) for _ in range(n)], np.int64)
    checks = rng.integers(0, 2**62) ^ np.array([1 << int(b) for b in rng.integers(0, 62, n)], np.int64)
    nodes = spark.createDataFrame([(int(f), int(c), 0, i) for i, (f, c) in enumerate(zip(fps, checks, strict=True))], "fp long, check long, check2 long, rid long")
    asked = []
    of = simhash.linked(nodes, 6, 28, lambda pairs: (asked.append(pairs.count()), pairs)[1])
    assert {r["component"] for r in of.collect()} == {0}
    assert sum(asked) <= 2 * n


def test_asked_rows_are_found_by_words(spark):
    ids = [0, 5, 63, 64, 8589934592, 8589934655, 17179869185]
    rows = spark.createDataFrame([(i, f"t{i}") for i in ids], "rid long, text string")
    found = simhash.only(rows, "rid", spark.createDataFrame([(63,), (63,), (64,), (8589934655,), (1,)], "rid long"))
    assert {tuple(r) for r in found.collect()} == {(63, "t63"), (64, "t64"), (8589934655, "t8589934655")}


def test_near_copies_too_different_are_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{rng.randrange(400)}" for _ in range(150)]
    texts = []
    for _ in range(300):
        text = list(words)
        for k in rng.sample(range(150), 4):
            text[k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(text))
    asked, verified = [], simhash.verified
    monkeypatch.setattr(simhash, "verified", lambda edges, *others: (asked.append(edges.count()), verified(edges, *others))[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = simhash.keep_one(docs, radius=6, shingle=1, most=4, check_shingle=5, check_radius=28, least=0.8)
    sets = [set(simhash.shingles(t.encode(), 5)) for t in texts]
    alone = {i for i, s in enumerate(sets) if all(len(s & r) < 0.8 * len(s | r) for j, r in enumerate(sets) if j != i)}
    assert len(alone) > 200 and alone <= {r["doc_id"] for r in kept.collect()}
    assert 0 < sum(asked) < 15 * len(texts)


@pytest.mark.parametrize("n", [0, 3, 40, 3000])
def test_sketches_refuse_no_link(n):
    rng = random.Random(n)
    words = [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    for share in np.linspace(0, 0.2, 30):
        text = list(words)
        for k in rng.sample(range(n), int(share * n)):
            text[k] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(text).encode())
    known = {i: simhash.parity_sketch(t, 5) for i, t in enumerate(texts)}
    a, b = np.nonzero(~np.eye(len(texts), dtype=bool))
    apart = simhash.surely_apart(known, a, b, 0.8)
    close = np.array([simhash.overlap(texts[i], texts[j], 5) >= 0.8 for i, j in zip(a, b, strict=True)])
    assert not (apart & close).any() and (n != 40 or (apart & ~close).any())
    assert not simhash.surely_apart({0: known[0]}, a, b, 0.8).any()
