"""LM scoring: a gated recurrent network with a class-factored output.

A token's probability is that of its class, given the state, times its share
of the class. The most frequent words are in classes of their own kind, where
the share depends on the state too; all other words are in classes by their
last bytes, where it follows their counts, and each such class has room for
unseen words. So probabilities over all tokens add up to one.

Training is truncated backpropagation through time in numpy: gradients stop at
windows, the state goes on to the end of the document. Workers train on parts of all training documents
and their weights are averaged. Scoring carries the state from
window to window over a whole document.

Texts are read twice: once to count words, once to become symbols. From then
on only symbols travel, in chunks cut by bytes in the order of the scan, so
that repeated documents never gather in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapreplace
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from roadweave.storage import materialize

#: The token that ends a text; no word holds a line break.
END = b"\n"
HEAD = 512
HEAD_CLASS = 32
TAIL_CLASSES = 64
HIDDEN = 16
WINDOW = 32
#: Documents side by side in one step of training, and of scoring.
STREAMS = 128
SCORED = 512
#: Tokens, with those that fill up shorter documents, that are scored together.
SCORED_CELLS = 16 << 20
RATE = 0.02
#: Training passes over the documents once; each round takes its share and begins with the weights of the one before.
ROUNDS = 2
#: Tokens of a document that are trained on in one go, with one state; a longer one goes on in another lane, from the start.
LANE_TOKENS = 16_384
#: Documents of more tokens are dealt to lanes before all others, the longest first, so that lanes are of like length.
LONG_TOKENS = 1536
#: Tokens that one worker trains on in a round, about.
WORKER_TOKENS = 2_000_000
#: UTF-8 bytes of the texts of a chunk, about; the last text is never cut.
CHUNK_BYTES = 32 << 20
#: Output weights stay within this, so that no exponent leaves the range of a float.
MOST_WEIGHT = 3.0
#: Distinct words that a counting task holds.
HELD_WORDS = 400_000


def tokens(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    out = (text or b"").lower().split()
    out.append(END)
    return out


@dataclass
class Vocabulary:
    """Head words, classes and the masses of tail classes; bounded, whatever the corpus."""

    head: dict[bytes, int]
    head_counts: np.ndarray
    tail_mass: np.ndarray
    total: int
    distinct: int
    n_head_classes: int = field(init=False)

    def __post_init__(self):
        self.n_head_classes = -(-len(self.head) // HEAD_CLASS) if self.head else 0

    @property
    def symbols(self) -> int:
        """Head words, tail classes, and the start."""
        return len(self.head) + TAIL_CLASSES + 1

    @property
    def classes(self) -> int:
        return self.n_head_classes + TAIL_CLASSES

    def symbol(self, word: bytes) -> int:
        s = self.head.get(word)
        return len(self.head) + tail_class(word) if s is None else s

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        k = len(self.head)
        return np.where(symbols < k, symbols // HEAD_CLASS, self.n_head_classes + symbols - k)


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAIL_CLASSES


def count_words(docs: DataFrame, train: Column) -> DataFrame:
    """(word binary, c): counts of all tokens of the rows where ``train`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "c"])
        for batch in batches:
            for t in batch.column("text").to_pylist():
                held.update(tokens(t))
                if len(held) > HELD_WORDS:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    parts = docs.where(train).select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """The most frequent words and the sums of all others, from all counts."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()
    head = {bytes(r["word"]): i for i, r in enumerate(top)}
    tail = F.expr(f"crc32(right_bytes) % {TAIL_CLASSES}")
    last = F.expr("substring(word, greatest(1, length(word) - 2), 3)")
    sums = counts.withColumn("right_bytes", last).groupBy(tail.alias("k")).agg(F.sum(F.col("c") + 0.5).alias("m")).collect()
    mass = np.full(TAIL_CLASSES, 0.5)
    for r in sums:
        mass[r["k"]] += r["m"]
    for r in top:
        mass[tail_class(bytes(r["word"]))] -= r["c"] + 0.5
    return Vocabulary(head, np.array([r["c"] for r in top], np.float64), np.maximum(mass, 0.5), total, distinct)


def initial(v: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights that give every token its share of the counts, and small random ones."""
    rng = np.random.default_rng(seed)
    h = HIDDEN
    head = np.zeros(v.n_head_classes * HEAD_CLASS)
    head[: len(v.head_counts)] = v.head_counts + 0.5
    head = head.reshape(v.n_head_classes, HEAD_CLASS)
    mass = np.r_[head.sum(1), v.tail_mass]
    word_bias = np.where(head > 0, np.log(np.maximum(head, 1e-9)), -1e9)
    return {
        # of update gate, reset gate and candidate
        "x": rng.normal(0, 0.3, (3, v.symbols, h)).astype(np.float32),
        "u": (rng.normal(0, 1, (3, h, h)) / np.sqrt(h)).astype(np.float32),
        "c": rng.normal(0, 0.05, (h, v.classes)).astype(np.float32),
        "cb": np.log(mass / mass.sum()).astype(np.float32),
        "w": rng.normal(0, 0.05, (v.n_head_classes, h, HEAD_CLASS)).astype(np.float32),
        "wb": np.maximum(word_bias, -1e9).astype(np.float32),
    }


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflat(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = np.asarray(vector[at : at + n], np.float32).reshape(like[k].shape)
        at += n
    return out


def keep_freed_memory() -> None:
    """Have the allocator keep what large arrays free, as fresh pages cost more than what is done with them."""
    np.empty(30 << 20, np.uint8)


def step(p: dict[str, np.ndarray], s: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The state after one step of the gated unit: the definition that ``forward`` computes faster."""
    x, a = p["x"][:, s], h @ p["u"]
    z, r = 1 / (1 + np.exp(-(x + a)[:2]))
    c = np.tanh(x[2] + r * a[2])
    return c + z * (h - c)


def forward(p: dict[str, np.ndarray], s: np.ndarray, h: np.ndarray, keep: list[np.ndarray | None]):
    """States before and after each step (steps + 1, rows, n), gates, candidates and the states' products.

    ``s`` is (steps, rows); ``keep`` tells of each step which rows carry their
    state, None for all. Gates are tanh of half their input. The three parts of
    the unit are in arrays of their own, so that every operation runs on
    contiguous memory.
    """
    (steps, rows), n, kind = s.shape, h.shape[1], p["u"].dtype
    half = np.array([0.5, 0.5, 1.0], kind)[:, None, None]
    x, u = (p["x"] * half)[:, s], p["u"] * half
    states = np.empty((steps + 1, rows, n), kind)
    states[0] = h
    gates, cands, prods = np.empty((2, steps, rows, n), kind), np.empty((steps, rows, n), kind), np.empty((3, steps, rows, n), kind)
    for t in range(steps):
        before = states[t] if keep[t] is None else states[t] * keep[t]
        a, g, c, after = prods[:, t], gates[:, t], cands[t], states[t + 1]
        np.matmul(before, u, out=a)
        np.add(x[:2, t], a[:2], out=g)
        np.tanh(g, out=g)
        g *= 0.5
        g += 0.5
        np.multiply(g[1], a[2], out=c)
        c += x[2, t]
        np.tanh(c, out=c)
        np.subtract(before, c, out=after)
        after *= g[0]
        after += c
    return states, gates, cands, prods


def _softmax(h: np.ndarray, w: np.ndarray, bias: np.ndarray, j: np.ndarray, weight: np.ndarray | None):
    """Log-probability of class ``j`` of each row; with ``weight`` also the gradients of w, bias and h.

    Biases enter by their exponents, so that the logits are gone through once.
    Weights are bounded (``MOST_WEIGHT``), so nothing needs to be shifted.
    """
    rows, mass = np.arange(len(h)), np.exp(bias)
    e = h @ w
    lp = e[rows, j].astype(np.float64) + bias[j]
    np.exp(e, out=e)
    total = e @ mass
    lp -= np.log(total)
    if weight is None:
        return lp, None, None, None
    e[rows, j] -= total / mass[j]
    share = weight / total
    return lp, ((h * share[:, None]).T @ e) * mass, (share @ e) * mass, (e @ (w * mass).T) * share[:, None]


def output(p: dict[str, np.ndarray], v: Vocabulary, h: np.ndarray, target: np.ndarray, grads: dict | None = None, weight: np.ndarray | None = None):
    """Log-probability of each target's class and, of head words, of the word in it.

    With ``grads``: adds those of the loss weighted by ``weight``, and returns that of the states too.
    """
    cls = v.class_of(target)
    out, dc, dcb, dh = _softmax(h, p["c"], p["cb"], cls, weight)
    if grads is not None:
        grads["c"] += dc
        grads["cb"] += dcb
    # rows of a head class stand together, all tails after them
    group = np.minimum(cls, v.n_head_classes).astype(np.int16)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(v.n_head_classes + 1))
    for g in np.flatnonzero(np.diff(cuts)):
        part = order[cuts[g] : cuts[g + 1]]
        lp, dw, dwb, dpart = _softmax(h[part], p["w"][g], p["wb"][g], target[part] % HEAD_CLASS, None if weight is None else weight[part])
        out[part] += lp
        if grads is not None:
            grads["w"][g] += dw
            grads["wb"][g] += dwb
            dh[part] += dpart
    return out, dh


def backward(p: dict[str, np.ndarray], v: Vocabulary, s: np.ndarray, y: np.ndarray, live: np.ndarray, h: np.ndarray):
    """Gradients of the mean loss of one window, and the state after it.

    ``s``, ``y`` and ``live`` are (steps, rows): inputs, targets, and whether
    they count. The state starts anew at a start symbol; gradients end at the
    window.
    """
    steps, rows = s.shape
    n, kind = h.shape[1], p["u"].dtype
    carries = (s != v.symbols - 1).astype(kind)
    keep = [None if c.all() else c[:, None] for c in carries]
    states, gates, cands, prods = forward(p, s, h, keep)
    grads = {k: np.zeros_like(x) for k, x in p.items()}
    weight = (live.ravel() / max(1, live.sum())).astype(kind)
    _, dh_out = output(p, v, states[1:].reshape(-1, n), y.ravel(), grads, weight)
    dh_out = dh_out.reshape(steps, rows, n)
    before = states[:steps] if carries.all() else states[:steps] * carries[:, :, None]
    # what a state's gradient is multiplied by to give those of update gate, reset gate and candidate
    z, r = gates
    to_cand = (1 - z) * (1 - cands * cands)
    by = np.empty((3, steps, rows, n), kind)
    np.multiply(z * (1 - z), before - cands, out=by[0])
    np.multiply(to_cand * prods[2], r - r * r, out=by[1])
    np.multiply(to_cand, r, out=by[2])
    back = np.ascontiguousarray(p["u"].transpose(0, 2, 1))
    d_prods, d_states = np.empty((3, steps, rows, n), kind), np.empty((steps, rows, n), kind)
    dh = np.zeros((rows, n), kind)
    for t in range(steps - 1, -1, -1):
        here = np.add(dh, dh_out[t], out=d_states[t])
        np.multiply(by[:, t], here, out=d_prods[:, t])
        dh = here * z[t]
        for d in d_prods[:, t] @ back:
            dh += d
        if keep[t] is not None:
            dh *= keep[t]
    grads["u"] += before.reshape(-1, n).T @ d_prods.reshape(3, -1, n)
    # of the inputs, the candidate's gradient is without the reset gate
    np.multiply(to_cand, d_states, out=d_prods[2])
    flat_s = s.ravel()
    order = np.argsort(flat_s.astype(np.int16), kind="stable")
    firsts = np.flatnonzero(np.r_[True, np.diff(flat_s[order]) != 0])
    grads["x"][:, flat_s[order][firsts]] = np.add.reduceat(d_prods.reshape(3, -1, n)[:, order], firsts, axis=1)
    return grads, states[steps]


def lanes_of(docs: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, lengths): whole documents one after another in ``STREAMS`` lanes, (time, lane)."""
    parts = [d[i : i + LANE_TOKENS] for d in docs for i in range(0, len(d), LANE_TOKENS)]
    long = sorted((d for d in parts if len(d) > LONG_TOKENS), key=len, reverse=True)
    lanes: list[list[np.ndarray]] = [[] for _ in range(STREAMS)]
    heap = [(0, k) for k in range(STREAMS)]
    for d in [*long, *(d for d in parts if len(d) <= LONG_TOKENS)]:
        size, k = heap[0]
        lanes[k].append(d)
        heapreplace(heap, (size + len(d), k))
    sizes = np.array([sum(map(len, lane)) for lane in lanes])
    target = np.zeros((int(sizes.max(initial=0)), STREAMS), np.int32)
    inputs = np.full(target.shape, start, np.int32)
    for k, lane in enumerate(lanes):
        if lane:
            target[: sizes[k], k] = np.concatenate(lane)
            inputs[1 : sizes[k], k] = target[: sizes[k] - 1, k]
            inputs[np.cumsum([0, *map(len, lane[:-1])]), k] = start
    return inputs, target, sizes


def train(p: dict[str, np.ndarray], v: Vocabulary, docs: list[np.ndarray], rate: float = RATE) -> dict[str, np.ndarray]:
    """One pass of truncated backpropagation over documents of symbols; Adam, clipped."""
    p = {k: x.copy() for k, x in p.items()}
    m, m2 = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    inputs, target, sizes = lanes_of(docs, v.symbols - 1)
    h = np.zeros((STREAMS, HIDDEN), np.float32)
    for t, lo in enumerate(range(0, len(target), WINDOW), 1):
        s = inputs[lo : lo + WINDOW]
        live = np.arange(lo, lo + len(s))[:, None] < sizes
        grads, h = backward(p, v, s, target[lo : lo + WINDOW], live, h)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g *= min(1.0, 1.0 / (norm + 1e-9))
            m[k] += 0.1 * (g - m[k])
            m2[k] += 0.01 * (g * g - m2[k])
            p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.99**t)) + 1e-6)
        for k in ("c", "w"):
            np.clip(p[k], -MOST_WEIGHT, MOST_WEIGHT, out=p[k])
    return p


def encode(docs: DataFrame, train_rows: Column, v: Vocabulary) -> DataFrame:
    """Texts as symbols: rows of documents and of the tail words that a chunk has.

    A document has its chunk, its place ``pos`` in it, ``train``, ``symbols``
    (two bytes a token) and ``tails`` (four bytes a tail token: the word's
    number in the chunk); a word has chunk, ``word`` and its number ``tail``.
    Chunks are cut by bytes as a task reads its rows, so equal rows are spread
    like any others.
    """
    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    names = ["chunk", "pos", "doc_id", "train", "symbols", "tails", "word", "tail"]
    types = [pa.int64(), pa.int64(), id_type, pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunks = count(TaskContext.get().partitionId() << 32)
        ids: list = []
        trains: list = []
        found: list[np.ndarray] = []
        place: defaultdict[bytes, int] = defaultdict(count().__next__)
        size = 0

        def batch_of(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in zip(names, types, strict=True)], names)

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = next(chunks)
            symbol = np.array([v.symbol(w) for w in place], np.uint16)
            is_tail = symbol >= len(v.head)
            number = np.cumsum(is_tail, dtype=np.int32) - np.int32(1)
            symbols = [symbol[at].tobytes() for at in found]
            tails = [number[at[is_tail[at]]].tobytes() for at in found]
            yield batch_of(len(ids), chunk=np.full(len(ids), chunk), pos=np.arange(len(ids)), doc_id=ids, train=trains, symbols=symbols, tails=tails)
            words = [w for w, t in zip(place, is_tail.tolist(), strict=True) if t]
            yield batch_of(len(words), chunk=np.full(len(words), chunk), word=words, tail=np.arange(len(words), dtype=np.int32))

        for batch in batches:
            for i, t, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "train", "text")], strict=True):
                words = tokens(text)
                ids.append(i)
                trains.append(t)
                found.append(np.fromiter(map(place.__getitem__, words), np.int32, len(words)))
                size += len(text)
                if size >= CHUNK_BYTES:
                    yield from flush()
                    ids, trains, found, size = [], [], [], 0
                    place = defaultdict(count().__next__)
        if ids:
            yield from flush()

    rows = docs.select("doc_id", F.coalesce(train_rows, F.lit(False)).alias("train"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"chunk long, pos long, doc_id {kind.simpleString()}, train boolean, symbols binary, tails binary, word binary, tail int")


def _worker(p: dict[str, np.ndarray], v: Vocabulary):
    """The training function of a worker that begins with weights ``p``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keep_freed_memory()
        seqs = [np.frombuffer(s, np.uint16) for s in pdf.sort_values(["chunk", "pos"])["symbols"]]
        return pd.DataFrame({"weights": [flat(train(p, v, seqs)).tolist()]})

    return run


def fit(coded: DataFrame, v: Vocabulary, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights from all training documents of ``encode``'s table, each of them gone through once.

    The work grows with the table: each worker has about ``WORKER_TOKENS``
    tokens in a round, and only the mean of the workers' weights reaches the
    driver. Documents are dealt by their place in the table, so repeated ones
    do not meet in one worker.
    """
    p = initial(v)
    if not v.head:
        return p
    workers = max(1, round(v.total / ROUNDS / WORKER_TOKENS))
    dealt = F.pmod(F.xxhash64(F.lit(seed), "chunk", "pos"), F.lit(ROUNDS * workers))
    rows = coded.where("train").select("chunk", "pos", "symbols", dealt.alias("part"))
    for k in range(ROUNDS):
        made = rows.where(F.col("part") % ROUNDS == k).groupBy("part").applyInPandas(_worker(p, v), "weights array<float>")
        mean = made.select(F.posexplode("weights")).groupBy("pos").agg(F.avg("col").alias("x")).orderBy("pos").collect()
        if mean:
            p = unflat(np.array([r["x"] for r in mean]), p)
    return p


def score_symbols(p: dict[str, np.ndarray], v: Vocabulary, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document's classes and head words, the state carried throughout.

    Documents of like length go side by side; those that end leave.
    """
    out = np.zeros(len(docs))
    lengths = np.array([len(d) for d in docs], np.int64)
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        rows = order[at : at + max(1, min(SCORED, SCORED_CELLS // int(lengths[order[at]])))]
        at += len(rows)
        ends = lengths[rows]
        every = np.zeros((len(rows), int(ends[0])), np.uint16)
        for i, k in enumerate(rows):
            every[i, : ends[i]] = docs[k]
        h = np.zeros((len(rows), HIDDEN), np.float32)
        last = np.full(len(rows), v.symbols - 1, np.uint16)
        for lo in range(0, int(ends[0]), WINDOW):
            n = int(np.searchsorted(-ends, -lo, "left"))
            target = np.ascontiguousarray(every[:n, lo : lo + WINDOW].T)
            steps = len(target)
            states = forward(p, np.concatenate([last[None, :n], target[:-1]]), h[:n], [None] * steps)[0]
            h, last = states[steps], target[-1]
            states, target = states[1:].reshape(-1, HIDDEN), target.ravel().astype(np.int64)
            if ends[n - 1] >= lo + steps:
                out[rows[:n]] += output(p, v, states, target)[0].reshape(steps, n).sum(0)
            else:
                live = np.flatnonzero(np.arange(lo, lo + steps)[:, None] < ends[:n])
                out[rows[:n]] += np.bincount(live % n, output(p, v, states[live], target[live])[0], n)
    return out


def score_model(coded: DataFrame, v: Vocabulary, p: dict[str, np.ndarray]) -> DataFrame:
    """(chunk, pos, doc_id, n_tokens, n_head, head, model): what symbols alone tell of a document, without a shuffle.

    ``head`` sums log10(c + 0.5) of its head words; ``model`` is its
    log10-probability but for log10(c + 0.5) of its tail words.
    """
    n_head = len(v.head)
    kind = coded.schema["doc_id"].dataType.simpleString()
    by_symbol = np.log10(np.r_[v.head_counts + 0.5, np.ones(TAIL_CLASSES + 1)])
    mass = np.log10(np.r_[np.ones(n_head), v.tail_mass, 1.0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_freed_memory()
        for batch in batches:
            seqs = [np.frombuffer(s, np.uint16) for s in batch["symbols"]]
            if not seqs:
                continue
            model = score_symbols(p, v, seqs) / np.log(10)
            yield pd.DataFrame({
                "chunk": batch["chunk"],
                "pos": batch["pos"],
                "doc_id": batch["doc_id"],
                "n_tokens": [len(s) for s in seqs],
                "n_head": [int((s < n_head).sum()) for s in seqs],
                "head": [float(by_symbol[s].sum()) for s in seqs],
                "model": [float(m - mass[s].sum()) for m, s in zip(model, seqs, strict=True)],
            })

    made = f"chunk long, pos long, doc_id {kind}, n_tokens long, n_head long, head double, model double"
    return coded.where("word is null").select("chunk", "pos", "doc_id", "symbols").mapInPandas(run, made)


def tail_sums(coded: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, pos, tail, n_known): of each document with tail words the sum of log10(c + 0.5) and how many are known.

    The tail words of a chunk, not its tokens, go to the table of counts and
    back, so that no task and no driver holds the counts of the corpus.
    """
    known = coded.where("word is not null").select(F.col("chunk").alias("of"), "word", "tail").join(counts, "word").select("of", "tail", "c")
    rows = coded.where("word is null and length(tails) > 0").select("chunk", "pos", "tails")

    def run(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"chunk": [], "pos": [], "tail": [], "n_known": []})
        owner = np.repeat(np.arange(len(docs)), [len(t) // 4 for t in docs["tails"]])
        tails = np.frombuffer(b"".join(docs["tails"]), np.int32)
        c = np.zeros(int(tails.max()) + 1)
        c[known["tail"].to_numpy(np.int64)] = known["c"].to_numpy(np.float64)
        return pd.DataFrame({
            "chunk": docs["chunk"],
            "pos": docs["pos"],
            "tail": np.bincount(owner, np.log10(c + 0.5)[tails], len(docs)),
            "n_known": np.bincount(owner, (c > 0)[tails], len(docs)).astype(np.int64),
        })

    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInPandas(run, "chunk long, pos long, tail double, n_known long")


def score(coded: DataFrame, counts: DataFrame, v: Vocabulary, p: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every document of ``encode``'s table."""
    both = score_model(coded, v, p).join(tail_sums(coded, counts), ["chunk", "pos"], "left")
    tail = F.coalesce("tail", F.lit(0.0))
    base = F.col("head") + tail - F.col("n_tokens") * float(np.log10(v.total + 0.5 * (v.distinct + 1)))
    return both.select("doc_id", "n_tokens", (F.col("n_head") + F.coalesce("n_known", F.lit(0))).alias("n_known"), base.alias("base_score"), (F.col("model") + tail).alias("score"))


def train_and_score(docs: DataFrame, train_rows: Column) -> tuple[DataFrame, Vocabulary]:
    """Scores of all rows from what the rows where ``train_rows`` holds teach.

    Null texts are empty: a text of nothing but its end. With no training row
    the counts are empty and all tokens unseen. Equal texts have equal scores
    up to rounding; repeated rows have rows of their own; an empty table gives
    an empty result. The network's weights depend on how the table is laid out
    in files, as that deals documents to workers; the same files give the same.
    """
    taught = F.coalesce(train_rows, F.lit(False)).alias("__train")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), taught)
    counts = materialize(count_words(rows, F.col("__train")), "lm-counts")
    v = learn_vocabulary(counts)
    coded = materialize(encode(rows, F.col("__train"), v), "lm-symbols")
    return score(coded, counts, v, fit(coded, v)), v
