"""Document fingerprints: one-permutation MinHash, densified, b bits a bin.

Every shingle is hashed once. The top bits of the hash are its bin, the rest
its value, and the least value of each bin is kept. An empty bin takes the
value of a filled one by optimal densification: its own fixed random order of
the bins is followed to the first that is filled. Of each value the low bits
are stored, and likeness is corrected for the chance that they agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.words import ascii_lower, words
from roadweave.storage import materialize

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
SEED = 11
#: Bins that an empty bin asks before all filled ones are compared.
ASKED = 48
PER_LONG = 64 // LOW_BITS
LONGS = BINS // PER_LONG

_M = (1 << 64) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda over an array of one."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mix(x: int) -> int:
    """A fixed 64-bit scrambler for the order in which bins are asked."""
    x = (x + 0x9E3779B97F4A7C15) & _M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M
    return x ^ (x >> 31)


def asked(b: Column, t: int) -> Column:
    """The bin that bin b asks at attempt t: a 2-universal hash, odd multiplier and offset."""
    return (b * F.lit(_mix(2 * t + SEED) % BINS | 1) + F.lit(_mix(2 * t + 1 + SEED) % BINS)).bitwiseAND(F.lit(BINS - 1))


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """A hash for each run of ``size`` words (repeats too); of fewer words, one for all; of none, none."""
    each = F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))
    runs = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[h[i + k] for k in range(size)]))
    short = lambda h: F.when(F.size(h) == 0, F.expr("cast(array() as array<bigint>)")).otherwise(F.array(F.xxhash64(h)))
    return _let(each, lambda h: F.when(F.size(h) >= size, runs(h)).otherwise(short(h)))


def least_by_bin(hashes: Column) -> Column:
    """The least hash of each filled bin, ascending."""
    top = lambda x: F.shiftright(x, 64 - BIN_BITS)
    return _let(F.sort_array(hashes), lambda s: F.filter(s, lambda x, i: (i == 0) | (top(x) != top(F.get(s, i - 1)))))


def densify(least: Column) -> Column:
    """The low bits of all bins' values, empty bins filled from others; null if no bin is filled."""
    top = lambda x: (F.shiftright(x, 64 - BIN_BITS) + BINS // 2).cast("int")
    low = lambda x: x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int")
    def value(m: Column, filled: Column, b: Column) -> Column:
        tries = [F.get(filled, asked(b, t)) for t in range(ASKED)]
        last = F.array_min(F.transform(m, lambda x: F.struct(F.xxhash64(F.lit(SEED), b, top(x)).alias("h"), low(x).alias("v"))))["v"]
        return F.coalesce(F.get(filled, b), *tries, last)

    def fill(m: Column) -> Column:
        bins = F.sequence(F.lit(0), F.lit(BINS - 1))
        sparse = _let(
            F.map_from_arrays(F.transform(m, top), F.transform(m, low)),
            lambda q: _let(F.transform(bins, lambda b: F.element_at(q, b)), lambda filled: F.transform(bins, lambda b: value(m, filled, b))),
        )
        return F.when(F.size(m) == BINS, F.transform(m, low)).when(F.size(m) > 0, sparse)

    return _let(least, fill)


def pack(low: Column) -> Column:
    """Low bits of all bins in longs, ``PER_LONG`` bins in each; null for null."""
    one = lambda v, k: F.aggregate(F.slice(v, k * PER_LONG + 1, F.lit(PER_LONG)), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, LOW_BITS).bitwiseOR(x.cast("long")))
    return _let(low, lambda v: F.when(v.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(LONGS - 1)), lambda k: one(v, k))))


def packed(text: Column) -> Column:
    """The fingerprint of a text as longs; null without words."""
    return pack(densify(least_by_bin(shingle_hashes(text))))


def as_string(fp: Column) -> Column:
    """Lower-case hex digits, two a bin; zeros for a text without words."""
    return F.when(fp.isNull(), F.lit("0" * (16 * LONGS))).otherwise(F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1; two texts without words are alike, one is like no other."""
    ones = F.lit(sum(1 << (LOW_BITS * i) for i in range(PER_LONG)))

    def differ(x: Column) -> Column:
        """The lowest bit of each bin that is not zero; a shift never brings a neighbour's bits so far down."""
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return x.bitwiseAND(ones)

    unlike = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(differ(x.bitwiseXOR(y)))), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << LOW_BITS)
    corrected = (1.0 - unlike / float(BINS) - chance) / (1.0 - chance)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected)))


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) in descending order of distinct ids, null last; the last is followed by the first.

    Ids are cut into ranges, as many as the session's partitions, and sorted in
    each; only one row a range meets in one task.
    """
    order = F.col("doc_id").desc_nulls_last()
    rows = materialize(ids.select("doc_id").repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ids")
    firsts = rows.groupBy("part").agg(F.max("doc_id").alias("first"))
    alone = Window.orderBy("part")
    whole = alone.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begins = F.struct("first")
    after = firsts.select("part", F.coalesce(F.lead(begins).over(alone), F.first(begins).over(whole))["first"].alias("after"))
    rows = rows.withColumn("lead", F.lead(F.struct("doc_id")).over(Window.partitionBy("part").orderBy(order)))
    return rows.join(F.broadcast(after), "part").select("doc_id", F.when(F.col("lead").isNull(), F.col("after")).otherwise(F.col("lead")["doc_id"]).alias("next_id"))


def with_next(docs: DataFrame) -> DataFrame:
    """Every document with half of itself replaced by the next one's beginning, and fingerprints of all three.

    Columns doc_id, text, n_chars, edited, fp, next_fp. Null texts are empty.
    Of rows that share a doc_id the one with the greatest text hash stands for
    them as a next document; each of them has a row of its own. An only
    document is its own next. An empty table gives an empty result.
    """
    # both joins take these same columns, so that they share one exchange
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("fp", packed(F.col("text")))
    ids = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    follows = next_ids(ids.select("doc_id"))
    # what each document gives, and to whom: the beginning that its predecessor needs
    gives = follows.join(ids.withColumnRenamed("doc_id", "i"), F.col("doc_id").eqNullSafe(F.col("i"))).select(F.col("next_id").alias("giver"), F.col("doc_id").alias("taker"), F.floor(F.col("n") / 2).cast("int").alias("most"))
    given = rows.join(gives, F.col("doc_id").eqNullSafe(F.col("giver")))
    # keyed as a null-safe join keys its other side, so that what is grouped is not dealt out again
    key = [F.coalesce("taker", F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("tk"), F.isnull("taker").alias("tb")]
    given = given.select(*key, F.struct(F.xxhash64("text").alias("h"), F.substr("text", F.lit(1), F.col("most")).alias("head"), F.col("fp").alias("next_fp")).alias("g"))
    given = given.groupBy("tk", "tb").agg(F.max("g").alias("g"))
    same = (F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)) == F.col("tk")) & (F.isnull("doc_id") == F.col("tb"))
    joined = rows.join(given, same).withColumn("n", F.length("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n") - half), F.substr(F.col("g")["head"], F.lit(1), half))
    return joined.select("doc_id", F.col("n").cast("long").alias("n_chars"), edited.alias("edited"), "fp", F.col("g")["next_fp"].alias("next_fp"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """The digest of ``with_next``: hashes, fingerprints and likenesses."""
    x = with_next(docs).select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fp", "next_fp", packed(F.col("edited")).alias("edited_fp"))
    return x.select("doc_id", "n_chars", "edited_sha256", as_string(F.col("fp")).alias("fingerprint"), as_string(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
