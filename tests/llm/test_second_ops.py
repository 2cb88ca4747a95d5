"""Decontamination, LM scoring, WARC, fingerprints, token counts and the pipeline against brute force."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadweave.llm import decontam, langid, lm, minhash, queries, simhash, tokencounts, warc
from tests_support import DOCS, ODD, clash


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


def load(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet").collect()


# Decontamination


def held_items(docs, items):
    """(doc, item) pairs by the shingles of whole documents."""
    want = set()
    for i, t in items:
        w = decontam.terms(t)
        s = [b" ".join(w[k : k + 5]) for k in range(len(w) - 4)]
        for d, text in docs:
            v = decontam.terms(text)
            have = {b" ".join(v[k : k + 5]) for k in range(len(v) - 4)}
            if s and sum(x in have for x in s) / len(s) >= 0.8:
                want.add((d, i))
    return want


def test_contaminated_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = load(spark, sf, "documents"), load(spark, sf, "benchmark")
    out = queries.op3_decontamination(spark, sf).collect()
    want = held_items([(d["doc_id"], d["text"]) for d in docs], [(r["item_id"], r["text"]) for r in items])
    assert {(r["doc_id"], r["item_id"]) for r in out} == want and want


def test_planted_items_at_any_place_and_slices(spark, odd, none, monkeypatch):
    items = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(12 + k))) for k in range(40)] + [(98, None), (99, ""), (100, "three words only")], "item_id long, text string")
    texts = {r["item_id"]: r["text"] for r in items.collect()}
    rows = [(k, "fill " * (37 * k) + texts[k] + " more fill" * 5) for k in range(40)]
    cut = texts[30].split()
    rows += [(200, " ".join(cut[: len(cut) // 2])), (201, " ".join(cut[:20] + ["other"] + cut[21:])), (202, "say three words only now"), (203, "# " + " ### ".join(texts[7].upper().split()))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(k, k) for k in range(40)} | {(201, 30), (202, 100), (203, 7)}
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()} == want
    whole = sorted(map(str, decontam.contaminated(docs, items).select("doc_id", "item_id", F.round("bm25", 9)).collect()))
    monkeypatch.setattr(decontam, "INDEX_BYTES", 120 * decontam.WORD_BYTES)
    assert sorted(map(str, decontam.contaminated(docs, items).select("doc_id", "item_id", F.round("bm25", 9)).collect())) == whole
    assert decontam.contaminated(clash(odd), items).count() == 0
    assert decontam.contaminated(none, items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert sorted(r["doc_id"] for r in decontam.drop_contaminated(docs, items).select("doc_id").collect()) == [200]
    assert decontam.drop_contaminated(odd, items).count() == len(ODD)


def test_an_index_is_within_its_bytes_and_slices_are_cut_by_them(spark, monkeypatch):
    import gc
    import pickle
    import random
    import tracemalloc

    rng = random.Random(3)
    for vocabulary in (10**7, 500):
        items = [(k, " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(100))) for k in range(300)]
        gc.collect()
        tracemalloc.start()
        index = decontam.build(items)
        gc.collect()
        assert tracemalloc.get_traced_memory()[0] <= 30_000 * decontam.WORD_BYTES and len(pickle.dumps(index)) <= 30_000 * decontam.WORD_BYTES
        tracemalloc.stop()
    monkeypatch.setattr(decontam, "INDEX_BYTES", 10_000 * decontam.WORD_BYTES)
    slices = list(decontam._slices(spark.createDataFrame(items, "item_id long, text string")))
    assert [len(s) for s in slices] == [100, 100, 100]
    words = [" a-b c  d_É x1 ", None, "", "über 3,5"]
    df = spark.createDataFrame([(w,) for w in words], "text string")
    assert [r[0] or 0 for r in df.select(F.regexp_count("text", F.lit(decontam.TERM))).collect()] == [len(decontam.terms(w)) for w in words]


def test_retrieval_equals_exhaustive_bm25():
    rng = np.random.default_rng(2)
    vocab = [f"v{k}" for k in range(300)]
    items = [(k, " ".join(rng.choice(vocab, 20, p=np.arange(300, 0, -1) / 45150))) for k in range(120)]
    index = decontam.build(items)
    passages = [rng.choice(vocab, 60).tolist() + items[k][1].split() for k in range(0, 120, 5)]
    got, want = set(), set()
    pairs = sorted({(p, index.term[w.encode()]) for p, ws in enumerate(passages) for w in ws if w.encode() in index.term})
    for p, i, s in zip(*index.retrieve(np.array([x[0] for x in pairs]), np.array([x[1] for x in pairs])), strict=True):
        got.add((int(p), int(i), round(float(s), 9)))
    dense = np.zeros((len(index.term), 120))
    dense[index.post_term, index.post_item] = index.post_weight
    for p in range(len(passages)):
        score = dense[[t for q, t in pairs if q == p]].sum(0)
        want |= {(p, int(i), round(float(score[i]), 9)) for i in np.flatnonzero(score >= decontam.THRESHOLD)}
    assert got == want and len(want) >= len(passages)


# LM scoring


def test_lm_base_scores_and_learning(spark):
    sf = "/root/testdata/sf0.01"
    docs = {d["doc_id"]: lm.tokens((d["text"] or "").encode()) for d in load(spark, sf, "documents")}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    c = Counter(w for i, ws in docs.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    out = queries.op5_lm_scoring(spark, sf).collect()
    assert {r["doc_id"] for r in out} == set(docs)
    for r in out:
        ws = docs[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(w in c for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
    per = lambda k: sum(r[k] for r in out if r["held_out"]) / sum(r["n_tokens"] for r in out if r["held_out"])
    assert per("score") > per("base_score")


def small_vocabulary():
    words = [b"a", b"b", lm.END, *[f"h{k}".encode() for k in range(40)]]
    return lm.Vocabulary({w: k for k, w in enumerate(words)}, np.arange(len(words), 0, -1.0), np.linspace(1, 9, lm.TAIL_CLASSES), 1000, 400)


def test_lm_probabilities_add_up_to_one():
    v = small_vocabulary()
    p = lm.initial(v)
    h = np.random.default_rng(0).normal(0, 0.5, (1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(v.symbols - 1)
    lp, _ = lm.output(p, v, np.repeat(h, len(every), 0), every)
    assert np.exp(lp).sum() == pytest.approx(1.0, abs=1e-4)


def test_lm_scores_do_not_depend_on_company(monkeypatch):
    v = small_vocabulary()
    p = lm.initial(v)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, v.symbols - 1, n) for n in (1, 5, 33, 64, 200, 7)]
    together = lm.score_symbols(p, v, docs)
    assert together == pytest.approx([lm.score_symbols(p, v, [d])[0] for d in docs], rel=1e-4)
    monkeypatch.setattr(lm, "SCORED", 2)
    assert together == pytest.approx(lm.score_symbols(p, v, docs), rel=1e-4)
    h, last, by_hand = np.zeros((1, lm.HIDDEN), np.float32), np.array([v.symbols - 1]), 0.0
    for s in docs[4]:
        h = lm.step(p, last, h)
        by_hand += lm.output(p, v, h, np.array([s]))[0][0]
        last = np.array([s])
    assert together[4] == pytest.approx(by_hand, rel=1e-4)


def test_lm_gradients_are_those_of_the_loss():
    """Of the output, and through time of the recurrence, by finite differences in double precision."""
    v = small_vocabulary()
    p = {k: x.astype(np.float64) for k, x in lm.initial(v).items()}
    rng = np.random.default_rng(3)
    s = rng.integers(0, v.symbols - 1, (7, 4))
    s[0, 0] = s[3, 1] = v.symbols - 1
    y = rng.integers(0, v.symbols - 1, (7, 4))
    live = np.ones((7, 4), bool)
    live[5:, 2] = False
    begin = rng.normal(0, 0.5, (4, lm.HIDDEN))

    def loss():
        h, total = begin, 0.0
        for t in range(7):
            h = lm.step(p, s[t], np.where((s[t] == v.symbols - 1)[:, None], 0.0, h))
            total -= (lm.output(p, v, h, y[t])[0] * live[t]).sum()
        return total / live.sum()

    grads, after = lm.backward(p, v, s, y, live, begin)
    h = begin
    for t in range(7):
        h = lm.step(p, s[t], np.where((s[t] == v.symbols - 1)[:, None], 0.0, h))
    assert after == pytest.approx(h, rel=1e-9)
    for name, g in grads.items():
        for at in rng.choice(np.flatnonzero(g), min(25, np.count_nonzero(g)), replace=False):
            at = np.unravel_index(at, g.shape)
            old = p[name][at]
            p[name][at] = old + 1e-5
            up = loss()
            p[name][at] = old - 1e-5
            down = loss()
            p[name][at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-8), name


def test_lm_documents_are_whole_in_their_lanes():
    rng = np.random.default_rng(1)
    docs = [np.arange(n, dtype=np.int32) + 10 * k for k, n in enumerate(rng.integers(1, 4000, 700))] + [np.arange(lm.LANE_TOKENS + 5, dtype=np.int32)]
    inputs, target, sizes = lm.lanes_of(docs, 9_999_999)
    begins = [(lane, t) for lane in range(lm.STREAMS) for t in range(sizes[lane]) if inputs[t, lane] == 9_999_999]
    assert len(begins) == len(docs) + 1
    seen = []
    for (lane, t), (after, end) in zip(begins, [*begins[1:], (None, None)], strict=True):
        stop = end if after == lane else sizes[lane]
        assert (inputs[t + 1 : stop, lane] == target[t : stop - 1, lane]).all()
        seen.append(tuple(target[t:stop, lane].tolist()))
    assert sorted(seen) == sorted([*map(tuple, (d.tolist() for d in docs[:-1])), tuple(range(lm.LANE_TOKENS)), tuple(range(lm.LANE_TOKENS, lm.LANE_TOKENS + 5))])
    assert np.sort(sizes)[-2] * lm.STREAMS < 1.1 * sizes.sum()


def test_lm_training_learns_order():
    v = small_vocabulary()
    docs = [np.array([0, 1] * 60 + [2]) for _ in range(40)]
    before = lm.initial(v)
    after = before
    for _ in range(3):
        after = lm.train(after, v, docs)
    assert lm.score_symbols(after, v, docs[:1])[0] > lm.score_symbols(before, v, docs[:1])[0] + 50


def test_lm_odd_tables(spark, odd, none):
    out, _ = lm.train_and_score(clash(odd), F.lit(True))
    rows = out.collect()
    assert len(rows) == len(ODD) and all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert lm.train_and_score(none, F.lit(True))[0].count() == 0
    untaught, v = lm.train_and_score(odd, F.lit(False))
    assert v.total == 0 and untaught.agg(F.max("n_known")).first()[0] == 0


def test_every_training_document_teaches_the_network(spark):
    docs = spark.createDataFrame([(k, f"word{k} " * 5) for k in range(24)], "doc_id long, text string")
    train = F.col("doc_id") != 7
    v = lm.learn_vocabulary(lm.count_words(docs, train))
    coded = lm.encode(docs, train, v)
    before, after = lm.initial(v)["x"], lm.fit(coded, v)["x"]
    assert len(v.head) == 24
    assert all((before[:, s] != after[:, s]).any() for w, s in v.head.items() if w != lm.END)


def test_lm_chunks_and_words_do_not_change_the_counts(spark, monkeypatch):
    words = [f"w{k}" for k in range(900)]
    docs = spark.createDataFrame([(k, " ".join(words[k : k + 300])) for k in range(0, 600, 7)] + [(1, "new A a"), (1, "new A a"), (None, "w1")], "doc_id long, text string")
    train = F.col("doc_id") % 3 != 1
    whole = {r["doc_id"]: tuple(r) for r in lm.train_and_score(docs, train)[0].collect()}
    monkeypatch.setattr(lm, "CHUNK_BYTES", 3000)
    for r in lm.train_and_score(docs.repartition(3), train)[0].collect():
        assert tuple(r)[:3] == whole[r["doc_id"]][:3] and r["base_score"] == pytest.approx(whole[r["doc_id"]][3])
    assert whole[1] == (1, 4, 1, pytest.approx(whole[1][3]), pytest.approx(whole[1][4]))


# WARC


def test_warc_links_headers_and_digests(spark, sf):
    pages = {p["page_id"]: p for p in load(spark, sf, "pages")}
    out = queries.op6_warc(spark, sf).collect()
    responses = {r["page_id"]: r for r in warc.responses(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    assert len(out) == 2 * len(pages) and len({r["record_id"] for r in out}) == len(out)
    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    for r in out:
        source = responses[r["page_id"]]
        assert r["refers_to"] == source["record_id"] and r["target_uri"] == pages[r["page_id"]]["url"] and r["source_headers"].startswith("HTTP/1.1 200")
        assert r["block_digest"] == sha(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        if r["record_type"] == "conversion":
            assert r["payload_digest"] == sha(pages[r["page_id"]]["html"].encode()) and "<p>" not in r["block"] and "track(" not in r["block"]
        else:
            assert f"source-payload-digest: {sha(pages[r['page_id']]['html'].encode())}" in r["block"]


def test_warc_text_links_and_files(spark, tmp_path):
    page = "<html><head><title>T &amp; t</title><style>x{}</style></head><body><!-- <a href='no'> --><p>one<br>two&nbsp;&eacute;<b>3</b></p><script>var a='</p>'</script><a href=\"u?a=1&amp;b=2\">l</a><img src=i.png>"
    assert warc.plain_text(page) == "T & t\none\ntwo é3\nl"
    assert warc.outlinks(page) == [("u?a=1&b=2", "a/@href"), ("i.png", "img/@src")]
    unclosed = "<a href=x " * 200_000
    assert len(warc.outlinks(unclosed)) == 200_000 and warc.plain_text(unclosed + "end").endswith("end")
    pages = spark.createDataFrame([(1, "http://a", page), (1, "http://a", page), (None, None, None), (3, "http://b", ""), (4, "http://c", "no tags \r\n\r\n WARC/1.1\r\n" + "y" * 100_000)], "page_id long, url string, html string").withColumn("block", F.lit(1))
    made = warc.responses(pages)
    both = made.unionByName(warc.derive(made))
    assert both.count() == 15 and warc.derive(warc.derive(made)).count() == 0
    warc.write_warc(both.coalesce(2), str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    cols = ["record_id", "record_type", "refers_to", "block_digest", "block"]
    assert sorted(map(str, back.select(*cols).collect())) == sorted(map(str, both.select(*cols).collect()))
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


# Fingerprints


def shingle_set(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_outlinks_of_unclosed_comments_take_linear_time():
    import time

    page = "<!-- <a href='x'>" * 60_000
    began = time.perf_counter()
    assert len(warc.outlinks(page)) == 60_000 and time.perf_counter() - began < 5
    assert warc.outlinks("<a href=a><!-- <a href=b> --><a href=c><!--<a href=d>") == [("a", "a/@href"), ("c", "a/@href"), ("d", "a/@href")]
    assert warc.without_comments("a<!-->b-->c<!---->d<!--") == "acd<!--"


def test_minhash_edited_texts_and_likeness(spark, sf):
    docs = sorted(load(spark, sf, "documents"), key=lambda d: -d["doc_id"])
    out = {r["doc_id"]: r for r in queries.op7_minhash(spark, sf).collect()}
    assert len(out) == len(docs)
    errors, by_text = [], defaultdict(set)
    for d, after in zip(docs, docs[1:] + docs[:1], strict=True):
        n = len(d["text"])
        edited = d["text"][: n - n // 2] + after["text"][: n // 2]
        r = out[d["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r["near_edited"], edited), (r["near_next"], after["text"])):
            a, b = shingle_set(d["text"]), shingle_set(other)
            errors.append(near - len(a & b) / max(1, len(a | b)))
        by_text[d["text"]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and len({v for s in by_text.values() for v in s}) == len(by_text)
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.05


def test_minhash_densified_likeness_is_unbiased(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(300):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 40)]
        rows.append((k, " ".join(words), " ".join(words[:20] + [f"z{x}" for x in rng.integers(0, 10**6, 20)])))
    got = spark.createDataFrame(rows, "k long, a string, b string").select("a", "b", minhash.likeness(minhash.packed(F.col("a")), minhash.packed(F.col("b"))).alias("near")).collect()
    errors = [r["near"] - len(shingle_set(r["a"]) & shingle_set(r["b"])) / len(shingle_set(r["a"]) | shingle_set(r["b"])) for r in got]
    assert abs(np.mean(errors)) < 0.02


def test_minhash_odd_rows(spark, odd, none):
    out = minhash.compare_with_next(clash(odd)).collect()
    assert len(out) == len(ODD)
    got = {r["doc_id"]: r for r in out}
    assert got[2]["fingerprint"] == got[3]["fingerprint"] == got[4]["fingerprint"] == "0" * 256
    # 7 > 6 > 5 > 4 > 3 > 2 > 1 > null > 7
    assert got[3]["near_next"] == 1.0 and got[5]["near_next"] == 0.0
    assert got[None]["edited_sha256"] == hashlib.sha256(b"no idONE t").hexdigest()
    assert minhash.compare_with_next(none).count() == 0
    one = minhash.compare_with_next(odd.where("doc_id = 7")).first()
    assert one["near_next"] == 1.0


def test_next_ids_over_many_ranges(spark):
    for ids in ([3, 9, 10, 11, 400, 401, 7_000_000_000, -5, None], [4], list(range(0, 3000, 7))):
        got = {r["doc_id"]: r["next_id"] for r in minhash.next_ids(spark.createDataFrame([(i,) for i in ids], "doc_id long").repartition(4)).collect()}
        order = sorted((i for i in ids if i is not None), reverse=True) + [None] * (None in ids)
        assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def fingerprint_by_hand(text):
    """The fingerprint from its definition: bins, optimal densification, low bits; XXH64 of Spark's longs and strings."""
    import struct

    signed = lambda x: x - 2**64 if x >= 2**63 else x
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not w:
        return "0" * 256
    each = [xxhash.xxh64_intdigest(x, seed=42) for x in w]

    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(struct.pack("<q", signed(v)), seed=h)
        return h

    runs = [chain(each[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else None
    if runs is None:
        return None  # of fewer words the array is hashed as one; left to the other tests
    bins = {}
    for h in map(signed, runs):
        b = (h >> 57) + 64
        bins[b] = min(bins.get(b, h), h)
    low = []
    for b in range(128):
        asked = [b, *[(b * (minhash._mix(2 * t + 11) % 128 | 1) + minhash._mix(2 * t + 1 + 11) % 128) % 128 for t in range(48)]]
        hit = next((x for x in asked if x in bins), None)
        if hit is None:
            return None
        low.append(bins[hit] & 255)
    return "".join(f"{v:02x}" for v in low)


def test_minhash_fingerprints_by_hand(spark, sf):
    texts = {d["doc_id"]: d["text"] for d in load(spark, sf, "documents")}
    seen = 0
    for r in queries.op7_minhash(spark, sf).collect():
        want = fingerprint_by_hand(texts[r["doc_id"]])
        seen += want is not None
        assert want is None or r["fingerprint"] == want
    assert seen > 150


# Token counts


def test_token_totals_are_direct_counts(spark, sf):
    import public_tokenizers as P

    encoder = tokencounts._encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    want = defaultdict(lambda: [0, 0])
    for d in load(spark, sf, "documents"):
        g = want[d["source"], d["lang"], "byte_bpe_50k"]
        g[0] += 1
        g[1] += len(encoder.encode_ordinary(d["text"]))
    out = queries.op9_token_counts(spark, sf).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["docs"], r["tokens"]] for r in out} == dict(want)


def test_rollup_batches_commit_once(spark, tmp_path, odd):
    r = tokencounts.Rollup(spark, str(tmp_path / "rollup"))
    assert r.totals().count() == 0
    row = lambda op, s, n, os=None, on=None: (op, s, "en", "t1", n, os, "en" if os else None, "t1" if os else None, on)
    df = lambda *rows: spark.createDataFrame(rows, tokencounts.CHANGES).withColumn("docs", F.lit("x"))
    assert r.commit("b/1", df(row("insert", "a", 10), row("insert", "a", 5), row("insert", None, None), row("insert", "z", 3)))
    assert not r.commit("b/1", df(row("insert", "a", 999)))
    assert r.commit("b/2", df(row("revise", "b", 7, "a", 10), row("delete", "z", 3)))
    assert {(x["source"], x["docs"], x["tokens"]) for x in r.totals().collect()} == {("a", 1, 5), ("b", 1, 7), (None, 1, 0)}
    assert r.commit("empty", spark.createDataFrame([], tokencounts.CHANGES))
    # another driver that saw the batch uncommitted loses the race, and its deltas count nowhere
    rival = tokencounts.Rollup(spark, str(tmp_path / "rollup"))
    rival.committed = lambda batch: False
    assert not rival.commit("b/2", df(row("insert", "z", 50)))
    assert r.compact() and r.commit("b/3", df(row("insert", "a", 1), row("delete", "a", 1))) and r.compact()
    assert not r.commit("b/1", df(row("insert", "a", 999))) and r.vacuum() >= 3
    with pytest.raises(Exception, match="unknown op"):
        r.commit("bad", df(row("other", "a", 1)))
    assert {(x["source"], x["docs"], x["tokens"]) for x in r.totals().collect()} == {("a", 1, 5), ("b", 1, 7), (None, 1, 0)}
    counted = {x["doc_id"]: x["n_tokens"] for x in tokencounts.count_tokens(clash(odd)).collect()}
    assert counted[2] == counted[3] == 0 and counted[5] > 20_000


# The pipeline


def test_pipeline_stages_against_brute_force(spark, sf):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {d["doc_id"]: d for d in docs.collect()}
    sizes = compressed_sizes(rows, langid.fit(docs, F.lit(True)))
    spoken = {i for i, s in sizes.items() if s and sorted(s)[1] > min(s) and sorted(s)[1] - min(s) >= 0.004 * min(s)}
    assert {r[0] for r in c.language(spark, docs, sf).select("doc_id").collect()} == spoken and len(spoken) >= 0.99 * len(rows)
    linked = defaultdict(set)
    sets = {i: set(simhash.shingles((d["text"] or "").encode(), 5)) for i, d in rows.items()}
    fps = {i: (simhash.fingerprint((d["text"] or "").encode(), 1, 4), simhash.wide_fingerprint((d["text"] or "").encode(), 5)) for i, d in rows.items()}
    for i in rows:
        for j in rows:
            bits = sum((p ^ q).bit_count() for p, q in zip(fps[i][1], fps[j][1], strict=True))
            if i < j and (fps[i][0] ^ fps[j][0]).bit_count() <= 6 and bits <= 28 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                linked[i].add(j)
                linked[j].add(i)
    kept = {i for i in rows if not any(j < i for j in reached(linked, i))}
    assert {r[0] for r in c.near_duplicates(spark, docs, sf).select("doc_id").collect()} == kept
    items = load(spark, sf, "benchmark")
    bad = {d for d, _ in held_items([(i, d["text"]) for i, d in rows.items()], [(r["item_id"], r["text"]) for r in items])}
    assert {r[0] for r in c.decontaminate(spark, docs, sf).select("doc_id").collect()} == set(rows) - bad
    taken = {r["doc_id"]: r["taken"] // max(1, r["size"]) for r in queries.op8_mixing(spark, sf).collect()}
    assert Counter(r[0] for r in c.mix(spark, docs, sf).select("doc_id").collect()) == Counter({i: n for i, n in taken.items() if n})


def compressed_sizes(rows, model):
    """Sizes of each text with each dictionary by the library alone, a new compressor for each block; of small ones also with samples before them."""
    import zstandard

    params = zstandard.ZstdCompressionParameters(window_log=17, hash_log=15, chain_log=15, search_log=3, min_match=4, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0)
    alone = lambda b: len(zstandard.ZstdCompressor(compression_params=params).compress(b))
    out = {}
    for i, d in rows.items():
        raw = langid.plain(d["text"] or "")
        out[i] = []
        for k in sorted(model) if any(ch.isalpha() for ch in d["text"] or "") else ():
            held = zstandard.ZstdCompressionDict(model[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            out[i].append(sum(len(zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress(raw[at : at + 4096])) for at in range(0, len(raw), 4096)))
        if out[i] and min(out[i]) * 0.004 < 1:
            for n, k in enumerate(sorted(model)):
                step = max(1, len(model[k]) // 16)
                before = [model[k][at * step :][:1024] for at in range(16)]
                out[i][n] = (out[i][n] + sum(alone(c + raw) - alone(c) for c in before)) / 17
    return out


def test_language_id_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 5 = 0")
    rows = {d["doc_id"]: d for d in docs.collect()}
    model = langid.fit(docs, F.lit(True))
    sizes = compressed_sizes(rows, model)
    for r in langid.identify(docs, model).collect():
        s = sizes[r["doc_id"]]
        want = sorted(model)[int(np.argmin(s))] if s else "und"
        assert r["lang_pred"] == want and r["score"] == pytest.approx(1 / sum(np.exp(-0.5 * (x - min(s))) for x in s) if s else 0.0)


def reached(linked, i):
    seen, todo = {i}, [i]
    while todo:
        new = linked[todo.pop()] - seen
        seen |= new
        todo += new
    return seen


def test_pipeline_runs_on_whole_tables(spark, sf):
    import corpus_pipeline as c

    out = c.run(spark, sf)
    assert out.columns == [*c.COLUMNS, "shard", "slot"] and out.count() > 100
    by = defaultdict(list)
    for r in out.collect():
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert xxhash.xxh64_intdigest(b"", seed=42) == spark.range(1).select(F.xxhash64(F.lit("")).alias("h")).first()[0] % 2**64


def test_pipeline_stages_take_odd_and_empty_tables(spark, sf, odd, none):
    import corpus_pipeline as c

    ids = lambda df: Counter(r["doc_id"] for r in df.collect())
    every = Counter({1: 2, 2: 1, 3: 1, 4: 1, None: 1, 5: 1, 6: 1, 7: 1})
    spoken = ids(c.language(spark, clash(odd), sf))
    assert not {2, 3, 4, 6} & set(spoken) and spoken[1] == 2
    assert ids(c.near_duplicates(spark, clash(odd), sf)) == Counter([1, 2, 5, 6, None])
    assert ids(c.decontaminate(spark, clash(odd), sf)) == every
    mixed = ids(c.mix(spark, clash(odd), sf))
    assert mixed[1] % 2 == 0 and max(mixed.values()) <= 6
    sharded = c.shard(spark, clash(odd), sf)
    assert ids(sharded) == every and len({r["shard"] for r in sharded.where("doc_id = 1").collect()}) == 1
    for name, stage in c.STAGES:
        made = stage(spark, none, sf)
        assert made.columns[:5] == c.COLUMNS and made.count() == 0, name
