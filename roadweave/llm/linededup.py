"""Line dedup: drop lines that an earlier document holds already; the answer is a bitmap, not a text.

Lines are named by 128 bits of hash, dealt by ranges of the hash and sorted by
document and position within it, so that one pass meets the first occurrence of
each before all others. A line so frequent that it would fill much of a range
goes round the sort: its first document is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.words import ascii_lower
from roadweave.storage import materialize

LEAST_CHARS = 10
#: Lines that are looked at for each range to find frequent ones, and how many of them make a line frequent.
LOOKED_AT, FREQUENT = 64, 16
BLANK = " \t\n\x0b\x0c\r"
#: Lines in a word of a bitmap.
WORD = 64


def lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def _document(id_col: str, text: str) -> Column:
    """Rows of one id and one text are alike, so this names a row's answer."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.lit(11), text).alias("text"))


def keyed_lines(docs: DataFrame, id_col: str, text: str, least: int) -> DataFrame:
    """(doc, pos, h1, h2): the lines whose key has ``least`` code points or more."""
    key = line_key(F.col("line"))
    rows = docs.select(_document(id_col, text).alias("doc"), F.posexplode(lines(F.col(text))).alias("pos", "line"))
    return rows.where(F.length(key) >= least).select("doc", "pos", F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"))


def repeats(rows: DataFrame, ranges: int) -> DataFrame:
    """(doc, pos) of lines whose key is in a document of a lesser id; a null id is after all others."""
    n = rows.count()
    share = min(1.0, LOOKED_AT * ranges / max(n, 1))
    looked_at = rows if share == 1.0 else rows.sample(share, seed=3)
    # at most LOOKED_AT / FREQUENT keys a range, so the broadcasts below are bounded by the number of ranges
    frequent = materialize(looked_at.groupBy("h1", "h2").count().where(F.col("count") >= FREQUENT).select("h1", "h2"), "frequent-lines")
    first = rows.join(F.broadcast(frequent), ["h1", "h2"]).groupBy("h1", "h2").agg(F.min("doc.id").alias("first"))
    of_frequent = rows.join(F.broadcast(first), ["h1", "h2"])
    others = rows.join(F.broadcast(frequent), ["h1", "h2"], "left_anti")

    in_order = Window.partitionBy("h1", "h2").orderBy(F.asc_nulls_last("doc.id"), "doc.text", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = others.repartitionByRange(ranges, "h1", "h2").withColumn("first", F.first("doc.id").over(in_order))
    return of_frequent.select("doc", "pos", "first").unionAll(streamed.select("doc", "pos", "first")).where(~F.col("doc.id").eqNullSafe(F.col("first"))).select("doc", "pos")


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """(doc, drops): a document's dropped lines as words of 64 bits, the least bit the first line; words without a bit are left out."""
    words = dropped.groupBy("doc", F.floor(F.col("pos") / WORD).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits"))
    return words.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST_CHARS, ranges: int | None = None) -> DataFrame:
    """(doc, n_dropped, drops): a row for each document that loses a line, with the bitmap of what it loses.

    ``doc`` is the struct (id, text): the id and a hash of the text, as
    ``document_key`` makes it. A key of ``least`` code points or more stays in
    the document of the least id that holds it, as often as it is there, and
    goes from all others. Rows of one id are one document, repeated rows have
    one answer; null ids are one document, after all others. Null and empty
    texts hold one empty line, which is never long enough. An empty table gives
    an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = materialize(keyed_lines(docs, id_col, text, least), "lines")
    out = drop_bitmaps(repeats(rows, ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return out.select("doc", F.aggregate("drops", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"])).alias("n_dropped"), "drops")


def document_key(id_col: str = "doc_id", text: str = "text") -> Column:
    """What ``doc`` of ``dedup_lines`` is for a row."""
    return _document(id_col, text)


def kept_text(text: Column, drops: Column) -> Column:
    """The lines that ``drops`` leaves, joined; all work is linear in the lines."""
    all_of = lines(text)
    places = F.flatten(F.transform(drops, lambda w: F.filter(F.transform(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.when(F.getbit(w["bits"], k) == 1, w["word"] * WORD + k)), lambda p: p.isNotNull())))
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_of) - 1), places)
    return F.when(drops.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(F.transform(kept, lambda i: F.element_at(all_of, i + 1)), "\n"))


def with_kept(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept, the text without its dropped lines; columns so named are replaced."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    bitmaps = found.select(F.col("doc.id").alias("__id"), F.col("doc.text").alias("__hash"), F.col("n_dropped").alias("__n"), F.col("drops").alias("__drops"))
    held = docs.select(*names, F.xxhash64(F.lit(11), text).alias("__text_hash"))
    # a null id has no partner in a plain join, and a null-safe one would be no equi-join on the hash alone
    joined = held.join(bitmaps.hint("merge"), (held["__text_hash"] == bitmaps["__hash"]) & held[id_col].eqNullSafe(bitmaps["__id"]), "left")
    return joined.select(*names, F.size(lines(F.col(text))).cast("long").alias("n_lines"), F.coalesce("__n", F.lit(0)).cast("long").alias("n_dropped"), kept_text(F.col(text), F.col("__drops")).alias("kept"))
