"""Language ID by compression.

Each language is a zstandard raw-content dictionary of sample text. A text is
compressed with every dictionary; the language whose dictionary makes it
smallest wins, and a narrow margin rejects the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of sample text in a language's dictionary: with the number of languages, the bound of the model.
DICT_BYTES = 64 << 10
#: Sample texts longer than this are passed over while the language has shorter ones; then they give a span of so much.
SAMPLE_CHARS = 16_000
#: Texts that a language's sample is drawn from, about, however long they are.
SAMPLE_TEXTS = 32
#: Texts are compressed in blocks, as a long text would soon be its own dictionary.
BLOCK = 4096
#: A text is rejected where the two smallest sizes differ by less than this share of the smaller, and always where they are equal.
REJECT_MARGIN = 0.004
#: Sizes are whole bytes. A text so short that a byte is more than the margin is measured more finely: by what it
#: adds to so many samples of so many bytes of each language, besides its size with the dictionary.
CONTEXTS, CONTEXT_BYTES = 16, 1024
UNKNOWN = "und"

#: ASCII other than letters reads as a space, so that marks, digits and layout weigh nothing.
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))

RESULT = "lang_pred string, score double, margin double, accepted boolean"


def fit(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Dictionaries by language, from a sample of the rows where ``train`` holds.

    The sample is bounded by ``dict_bytes`` a language and chosen by a hash of
    key and text, so the same table gives the same model. Repeated rows count
    once, and null or repeated keys are told apart by their texts. Null
    languages and null or empty texts teach nothing; no labelled row gives an
    empty model. The driver receives about twice the dictionaries' bytes a
    language; the number of languages is the model's own.
    """
    whole = F.col(text)
    rows = docs.where(train & F.col(lang).isNotNull() & (F.length(whole) > 0)).select(F.col(lang).alias("lang"), F.substring(whole, 1, SAMPLE_CHARS).alias("text"), (F.length(whole) > SAMPLE_CHARS).alias("long"), F.pmod(F.xxhash64(F.lit(5), F.col(key), whole), F.lit(1 << 40)).alias("h"))
    totals = {(r["lang"], r["long"]): (r["size"], r["n"]) for r in rows.groupBy("lang", "long").agg(F.avg(F.octet_length("text")).alias("size"), F.approx_count_distinct("h").alias("n")).collect()}
    # twice the bytes that are needed, and SAMPLE_TEXTS at least, so that chance leaves no language short
    need = 2 * (dict_bytes + SAMPLE_CHARS)
    picked = F.lit(False)
    for (k, long), (size, n) in totals.items():
        short_size, short_n = totals.get((k, False), (0, 0))
        if long and short_size * short_n >= need:
            continue
        most = int((1 << 40) * min(1.0, 2 * max(need / size, SAMPLE_TEXTS) / n))
        picked = picked | ((F.col("lang") == k) & (F.col("long") == F.lit(long)) & (F.col("h") <= most))
    once = rows.where(picked).groupBy("lang", "long", "h").agg(F.min("text").alias("text"))
    before = Window.partitionBy("lang", "long").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    once = once.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))).where(F.col("before") < need).drop("before")
    model: dict[str, bytes] = {}
    for r in sorted(once.collect(), key=lambda r: (r["lang"], r["long"], r["h"])):
        have = model.get(r["lang"], b"")
        if len(have) < dict_bytes:
            model[r["lang"]] = have + plain(r["text"])[: dict_bytes - len(have)] + b" "
    return model


def plain(text: str) -> bytes:
    """Lower-case letters and single spaces, as UTF-8."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


class Classifier:
    """The dictionaries, made ready for compression."""

    def __init__(self, model: dict[str, bytes]):
        import zstandard

        params = zstandard.ZstdCompressionParameters(window_log=17, hash_log=15, chain_log=15, search_log=3, min_match=4, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0)
        self.langs = sorted(model)
        self.packers = []
        for k in self.langs:
            d = zstandard.ZstdCompressionDict(model[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.packers.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)
        self.pack = zstandard.ZstdCompressor(compression_params=params).compress
        steps = {k: max(1, len(model[k]) // CONTEXTS) for k in self.langs}
        parts = [[model[k][i * steps[k] :][:CONTEXT_BYTES] for i in range(CONTEXTS)] for k in self.langs]
        self.contexts = [[(c, len(self.pack(c))) for c in cs] for cs in parts]

    def sizes(self, text: bytes) -> np.ndarray:
        """What each language makes of a text: bytes with its dictionary, and with its samples where a byte is coarse."""
        blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)] if len(text) > BLOCK else [text]
        sizes = np.array([sum(len(p(b)) for b in blocks) for p in self.packers], dtype=np.float64)
        if sizes.min() * REJECT_MARGIN < 1:
            sizes = (sizes + [sum(len(self.pack(c + text)) - n for c, n in cs) for cs in self.contexts]) / (1 + CONTEXTS)
        return sizes

    def classify(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, accepted; a text without letters is unknown."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, False
        raw = plain(text)
        sizes = self.sizes(raw)
        best = int(sizes.argmin())
        odds = np.exp(-0.5 * (sizes - sizes[best]))
        if len(sizes) == 1:
            return self.langs[0], 1.0, 1.0, True
        second = float(np.partition(sizes, 1)[1])
        margin = (second - sizes[best]) / sizes[best]
        return self.langs[best], float(1.0 / odds.sum()), float(margin), bool(margin > 0 and margin >= REJECT_MARGIN)


def identify(docs: DataFrame, model: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, margin and accepted (columns so named are replaced).

    Null and empty texts and texts without letters are ``und``, score 0, not
    accepted. Every text is compressed whole. Order, ties and repeated rows do
    not matter: a row's answer depends on its text alone.
    """

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = Classifier(model)
        for texts in batches:
            found = [classifier.classify(t) for t in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "margin", "accepted"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "margin", "accepted")]
    return docs.select(*kept, run(F.col(text)).alias("__id")).select(*kept, "__id.lang_pred", "__id.score", "__id.margin", "__id.accepted")
