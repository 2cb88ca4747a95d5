"""Benchmark decontamination: a BM25 index of test items, asked by every passage.

The index holds test items, weights divided by an item's score with itself, so
one threshold suits all lengths. Items are numbered in blocks, each term keeps
its greatest weight in each block, and a passage looks only into blocks whose
bounds reach the threshold (block-max WAND, all above threshold instead of the
best k). Terms too common to lift a block alone are bounded together, as WAND
does before its pivot. What is retrieved is verified by overlap of question
and answer.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.storage import materialize

SHINGLE = 5
#: Share of an item's five-word shingles that a passage must have.
OVERLAP = 0.8
#: Share of those that begin in the question, and in the answer.
PART_OVERLAP = 0.5
#: Share of an item's BM25 score with itself at which it is retrieved.
THRESHOLD = 0.5
K1, B = 1.2, 0.75
BLOCK = 16
#: The share of items from which on a term is bounded only in sum.
COMMON = 0.1
#: Bytes of one index, in the driver and in each Python worker; a larger benchmark is asked slice by slice, one pass over the documents for each.
INDEX_BYTES = 128 << 20
#: What a word takes in the index at most, all its arrays and its term counted.
WORD_BYTES = 256
#: Words whose passages are looked up together.
BATCH_WORDS = 60_000

FOUND = "doc_id long, item_id long, bm25 double, overlap double, question_overlap double, answer_overlap double"

#: What ``terms`` takes for a word.
TERM = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Lower-case words, ASCII marks left out."""
    return (text or "").lower().encode().translate(_WORDS).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words, in order."""
    import xxhash

    runs = zip(*[words[i:] for i in range(size)], strict=False)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, map(b" ".join, runs)), np.uint64)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges: starts[i] .. starts[i] + counts[i]."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


class Index:
    """Items of one slice. ``df`` and ``n`` are over all items."""

    def __init__(self, items: list[tuple[int, list[bytes]]], df: dict[bytes, int], n: int, average: float):
        self.ids = [i for i, _ in items]
        self.lengths = [len(w) for _, w in items]
        self.longest = max([SHINGLE, *self.lengths])
        self.term: dict[bytes, int] = {}
        terms_, places, weights = array("q"), array("q"), array("d")
        for k, (_, w) in enumerate(items):
            weight = {t: log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / average)) for t, c in Counter(w).items()}
            own = sum(weight.values())
            for t, x in weight.items():
                terms_.append(self.term.setdefault(t, len(self.term)))
                places.append(k)
                weights.append(x / own)
        terms_, places, weights = (np.array(x) for x in (terms_, places, weights))
        order = np.lexsort((places, terms_))
        self.post_term, self.post_item, self.post_weight = terms_[order], places[order], weights[order]
        self.n_blocks = len(items) // BLOCK + 1
        v = len(self.term)
        # blocks of a term, each with its postings' range and greatest weight
        key = self.post_term * self.n_blocks + self.post_item // BLOCK
        self.block_key, self.block_start = np.unique(key, return_index=True)
        self.block_count = np.diff(np.r_[self.block_start, len(key)])
        self.block_max = np.maximum.reduceat(self.post_weight, self.block_start) if len(key) else np.zeros(0)
        self.term_start = np.searchsorted(self.block_key, np.arange(v) * self.n_blocks)
        self.term_blocks = np.diff(np.r_[self.term_start, len(self.block_key)])
        self.term_max = np.zeros(v)
        np.maximum.at(self.term_max, self.block_key // self.n_blocks, self.block_max)
        self.common = np.array([df[t] > max(1, COMMON * n) for t in self.term], bool)
        self.shingles = [shingle_hashes(w, min(SHINGLE, len(w))) for _, w in items]

    def retrieve(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all scores at the threshold, from distinct (passage, term) pairs sorted by passage."""
        empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not len(passage):
            return empty
        size = int(passage[-1]) + 1
        bound = np.bincount(passage, self.term_max[term], size)
        shared = np.bincount(passage, self.term_max[term] * self.common[term], size)
        go = (bound >= THRESHOLD - 1e-9)[passage]
        passage, term = passage[go], term[go]
        rare = ~self.common[term]
        p, t = passage[rare], term[rare]
        at = _spread(self.term_start[t], self.term_blocks[t])
        pair = np.repeat(p, self.term_blocks[t]) * self.n_blocks + self.block_key[at] % self.n_blocks
        live, where = np.unique(pair, return_inverse=True)
        reach = np.bincount(where, self.block_max[at], len(live)) + shared[live // self.n_blocks]
        live = live[reach >= THRESHOLD - 1e-9]
        # items all of whose terms are common live in blocks that no rare term opens
        lone = np.flatnonzero(shared >= THRESHOLD - 1e-9)
        if len(lone):
            live = np.union1d(live, (lone[:, None] * self.n_blocks + np.arange(self.n_blocks)).ravel())
        if not len(live):
            return empty
        # exact scores in the blocks that are left
        keep = np.isin(passage, live // self.n_blocks)
        p, t = passage[keep], term[keep]
        at = _spread(self.term_start[t], self.term_blocks[t])
        owner = np.repeat(p, self.term_blocks[t])
        inside = np.isin(owner * self.n_blocks + self.block_key[at] % self.n_blocks, live)
        at, owner = at[inside], owner[inside]
        post = _spread(self.block_start[at], self.block_count[at])
        pair, where = np.unique(np.repeat(owner, self.block_count[at]) * len(self.ids) + self.post_item[post], return_inverse=True)
        score = np.bincount(where, self.post_weight[post], len(pair))
        good = score >= THRESHOLD - 1e-9
        return pair[good] // len(self.ids), pair[good] % len(self.ids), score[good]

    def verify(self, item: int, have: np.ndarray) -> tuple[float, float, float]:
        """Overlap of the item, of its question and of its answer, its last third of shingles, with a passage's shingles."""
        hit = np.isin(self.shingles[item], have)
        cut = max(1, (2 * len(hit) + 2) // 3)
        part = lambda x: float(x.mean()) if len(x) else 1.0
        return part(hit), part(hit[:cut]), part(hit[cut:])

    def search(self, docs: list[list[bytes]]) -> list[tuple[int, int, float, float, float, float]]:
        """(document, item, score, overlaps) of verified items, the best passage of each document."""
        step = self.longest
        lookup = self.term.get
        owners, lows, pairs = [], [], []
        for d, words in enumerate(docs):
            known = np.fromiter((lookup(w, -1) for w in words), np.int64, len(words))
            first = len(owners)
            n = max(1, -(-len(words) // step) - 1)
            at = np.flatnonzero(known >= 0)
            k = at // step
            # a word is in the passage that begins in its step and in the one before
            both = np.r_[k, k - 1]
            t = np.r_[known[at], known[at]]
            ok = (both >= 0) & (both < n)
            pairs.append((both[ok] + first) * len(self.term) + t[ok])
            owners += [d] * n
            lows += [i * step for i in range(n)]
        if not owners or not self.term:
            return []
        distinct = np.unique(np.concatenate(pairs))
        passage, item, score = self.retrieve(distinct // len(self.term), distinct % len(self.term))
        best: dict[tuple[int, int], tuple] = {}
        at, held = None, {}
        for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist(), strict=True):
            if p != at:
                at, held = p, {}
            size = min(SHINGLE, self.lengths[i])
            if size not in held:
                held[size] = shingle_hashes(docs[owners[p]][lows[p] : lows[p] + 2 * step], size)
            whole, question, answer = self.verify(i, held[size])
            if whole >= OVERLAP and min(question, answer) >= PART_OVERLAP:
                key = (owners[p], i)
                best[key] = max(best.get(key, (0,)), (s, whole, question, answer))
        return [(*k, *v) for k, v in sorted(best.items())]


def build(items: list[tuple[int, str | None]], df: dict[bytes, int] | None = None, n: int | None = None, average: float | None = None) -> Index | None:
    """An index of test items; those without words are never found. Statistics are the items' own unless given."""
    split = [(i, w) for i, t in sorted(items, key=lambda x: (x[0] is None, x[0], x[1] or "")) if (w := terms(t))]
    if not split:
        return None
    df = df or Counter(t for _, w in split for t in set(w))
    return Index(split, df, n or len(split), average or sum(len(w) for _, w in split) / len(split))


def _item_terms(benchmark: DataFrame) -> DataFrame:
    """(term binary, df, words): each distinct term of an item, and the item's length with its first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(t, 1, len(w) if k == 0 else 0) for w in map(terms, batch["text"]) for k, t in enumerate(set(w))]
            yield pd.DataFrame(rows, columns=["term", "df", "words"])

    parts = benchmark.select("text").mapInPandas(run, "term binary, df long, words long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))


def _slices(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Items for one index after another; the driver holds one index's items and one partition that it reads."""
    held, words = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        n = len(terms(r["text"]))
        if held and (words + n) * WORD_BYTES > INDEX_BYTES:
            yield held
            held, words = [], 0
        held.append((r["item_id"], r["text"]))
        words += n
    if held:
        yield held


def _search(docs: DataFrame, text: str, shared) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value

        def found(ids: list, texts: list) -> pd.DataFrame:
            rows = [(ids[d], index.ids[i], *rest) for d, i, *rest in index.search(texts)]
            return pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND.split(", ")]).astype({"doc_id": "Int64", "item_id": "Int64"})

        for batch in batches:
            ids, texts, n = [], [], 0
            for d, t in zip(batch["doc_id"].astype(object), batch["text"], strict=True):
                ids.append(None if pd.isna(d) else int(d))
                texts.append(terms(t))
                n += len(texts[-1])
                if n >= BATCH_WORDS:
                    yield found(ids, texts)
                    ids, texts, n = [], [], 0
            if ids:
                yield found(ids, texts)

    return docs.select("doc_id", F.col(text).alias("text")).mapInPandas(run, FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, item_id, bm25, overlap, question_overlap, answer_overlap): each document with each test item it holds.

    bm25 is a share of the item's score with itself. Passages are windows twice
    as long as the longest item, at every item's length, so that no item is
    cut. Null and empty texts hold nothing; repeated documents have rows each,
    equal items too; an empty benchmark or table gives an empty result.

    A benchmark whose index is up to ``INDEX_BYTES`` is one index on every
    executor. A larger one is asked a slice at a time: its term counts are made
    by the cluster, the driver holds one slice and its counts, each slice's
    result is written before the next is read, and each is one pass over the
    documents. An item that is larger by itself is a slice of its own.
    """
    spark = docs.sparkSession
    words = benchmark.agg(F.sum(F.regexp_count("text", F.lit(TERM)))).first()[0] or 0
    if words * WORD_BYTES <= INDEX_BYTES:
        index = build([(r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").collect()])
        return _search(docs, text, spark.sparkContext.broadcast(index)) if index else spark.createDataFrame([], FOUND)
    counts = materialize(_item_terms(benchmark), "item-terms")
    words = counts.agg(F.sum("words")).first()[0]
    n = benchmark.select("text").mapInPandas(lambda batches: (pd.DataFrame({"n": [sum(1 for t in b["text"] if terms(t))]}) for b in batches), "n long").agg(F.sum("n")).first()[0]
    out = None
    for items in _slices(benchmark):
        mine = spark.createDataFrame([(t,) for t in {t for _, text_ in items for t in terms(text_)}], "term binary")
        index = build(items, {bytes(r["term"]): r["df"] for r in counts.join(mine, "term", "left_semi").collect()}, n, words / max(1, n))
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(index)
        part = materialize(_search(docs, text, shared), "contaminated")
        shared.destroy()
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no test item, all columns kept.

    Rows of one doc_id are judged together: all go if one of them holds an
    item; rows without an id are one such group. Null and empty texts hold
    nothing. An empty table gives an empty result, an empty benchmark all rows.
    """
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__bad")), "left_anti")
