"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm import chat, decontam, itemsets, langid, linededup, lm, merkle, minhash, mixing, sharding, simhash, tokencounts, warc
from roadweave.llm.words import word_count
from roadweave.storage import materialize, new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % n, F.lit(0))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, its text too, in one of 24 shards by the key law; the digest is of what comes out."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")
    out = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 24, size)
    return out.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", sharding.shard_of(F.col("doc_id"), 25).alias("grown_shard"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from two of three folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, fold(F.col("doc_id"), 3) != 1)
    out = langid.identify(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back, and conversation -1 with control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat.read_back(chat.windows(turns.unionByName(extra)))


OP4_SQL = r"""
with recursive t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), n as (
  select *, coalesce(floor(turn / 256.0)::bigint, -1) as block, row_number() over w - 1 as i, len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\s]')) + 4 as tokens,
    length(role) + length(text) + 8 + 1 + 8 + len(regexp_extract_all(role || text, '\\')) + len(regexp_extract_all(text, '[<\[](\||/?s>|/?INST\]|<?/?SYS)')) as chars
  from t window w as (partition by conv_id order by turn nulls first, role, text)
), s as (
  select *, i = 0 and role = 'system' as system from n
), y as (
  select s.*, coalesce(x.tokens, 0) as taken, coalesce(x.chars, 0) as system_chars from s left join (select conv_id, tokens, chars from s where system) x on s.conv_id is not distinct from x.conv_id
), b as (
  select conv_id, block, i, tokens, chars, taken, system_chars, greatest(1, 1024 - 128 - taken) as room, row_number() over (partition by conv_id, block order by i) as k from y where not system
), g(conv_id, block, i, k, used, first) as (
  select conv_id, block, i, k, tokens, i from b where k = 1
  union all
  select b.conv_id, b.block, b.i, b.k, case when g.used + b.tokens > b.room then b.tokens else g.used + b.tokens end, case when g.used + b.tokens > b.room then b.i else g.first end
  from g join b on b.conv_id is not distinct from g.conv_id and b.block = g.block and b.k = g.k + 1
), w as (
  select g.conv_id, g.first, sum(b.chars) as chars, any_value(b.system_chars) as system_chars from g join b on g.conv_id is not distinct from b.conv_id and g.i = b.i group by 1, 2
), h as (
  select w.conv_id, w.first, sum(case when p.i = w.first - 1 and p.tokens <= 128 or p.i = w.first - 2 and p.tokens + q.tokens <= 128 then p.chars else 0 end) as chars
  from w join b p on w.conv_id is not distinct from p.conv_id and p.i between w.first - 2 and w.first - 1 join b q on w.conv_id is not distinct from q.conv_id and q.i = w.first - 1 group by 1, 2
), f as (
  select w.conv_id, sum(w.chars + w.system_chars + coalesce(h.chars, 0)) as chars from w left join h on w.conv_id is not distinct from h.conv_id and w.first = h.first group by 1
), l as (
  -- a system turn with no other turn of its range is a window by itself
  select conv_id, chars from y where system and not exists (select 1 from b where b.conv_id is not distinct from y.conv_id and b.block = y.block)
), d as (
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256, coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '') as loss from y group by 1
)
select d.conv_id, n_turns, turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256, (coalesce(f.chars, 0) + coalesce(l.chars, 0))::bigint as formatted_chars
from d left join f on d.conv_id is not distinct from f.conv_id left join l on d.conv_id is not distinct from l.conv_id
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes of each."""
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), digest=True)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint as n,
         (('0x' || substr(md5('7:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double as u
  from documents
), d2 as (select doc_id, source, coalesce(n, 0) as size, u from d),
s as (select source, sum(size)::bigint as source_size from d2 group by source),
w as (
  select *, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source collate "binary" nulls last) - 1) % 3 + 1)::int] as w,
         (source_size * 3)::double as capped
  from s
), t as (select *, capped / w as turn from w),
l as (
  select *, (sum(source_size) over () - coalesce(sum(capped) over (order by turn, source nulls last rows between unbounded preceding and 1 preceding), 0))
          / (sum(w) over () - coalesce(sum(w) over (order by turn, source nulls last rows between unbounded preceding and 1 preceding), 0)) as lev
  from t
), g as (
  select source, source_size, least(capped, max(lev) over () * w) as target from l
), g2 as (
  select *, case when source_size > 0 then target / source_size else 0.0 end as ratio from g
), k as (
  select d2.*, g2.source_size, g2.target, floor(ratio)::bigint as whole, ratio - floor(ratio) as p,
         target - floor(ratio) * g2.source_size as need
  from d2 join g2 on d2.source is not distinct from g2.source
), q as (
  select *, case when p > 0 and p < 1 then (u / (1 - u)) / (p / (1 - p)) end as key from k
), c as (
  select *, sum(size) over (partition by source order by key, doc_id rows between unbounded preceding and current row) - size / 2.0 as reach from q
)
select doc_id, size, source_size, target, (size * (whole + case when key is not null and reach <= need then 1 else 0 end))::bigint as taken from c
""".replace(' collate "binary"', "")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash and the class that links of at most 3 bits make."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", simhash.hex16(F.col("__fp")).alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each test item that it holds."""
    return decontam.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, learnt from four of five folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, v = lm.train_and_score(docs, fold(F.col("doc_id"), 5) != 1)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages, linked to their responses."""
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return minhash.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents are inserted by words and revised to tokens; a second delivery by mistake is deleted again, and each batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select("source", "lang", "text")
    none = F.lit(None)
    counted = materialize(tokencounts.count_tokens(docs.withColumn("words", word_count(F.col("text")))).select("source", "lang", "words", "n_tokens"), "token-counts")
    by_words, by_tokens = F.lit("words"), F.lit(tokencounts.TOKENIZER)
    inserts = counted.select(F.lit("insert").alias("op"), "source", "lang", by_words.alias("tokenizer"), F.col("words").alias("n_tokens"), none.cast("string").alias("old_source"), none.cast("string").alias("old_lang"), none.cast("string").alias("old_tokenizer"), none.cast("long").alias("old_n_tokens"))
    revisions = counted.select(F.lit("revise").alias("op"), "source", "lang", by_tokens.alias("tokenizer"), "n_tokens", F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), by_words.alias("old_tokenizer"), F.col("words").alias("old_n_tokens"))
    rollup = tokencounts.Rollup(spark, new_path(spark, "rollup"))
    deletes = inserts.withColumn("op", F.lit("delete"))
    for batch, changes in (("load", inserts), ("again", inserts), ("retokenize", revisions), ("withdraw", deletes)):
        rollup.commit(batch, changes)
        rollup.commit(batch, changes)
    rollup.compact()
    return rollup.totals()


def op11_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed itemsets of all sales and their rules."""
    rows = table(spark, sf_dir, "sale_lines").select("sale_id", "item_id")
    found = itemsets.closed_itemsets(rows, "sale_id", "item_id", least=5, share=20_000)
    return itemsets.rules(found)


OP11_SQL = r"""
with recursive r as (
  select distinct sale_id as t, item_id as i from sale_lines where sale_id is not null and item_id is not null
), b as (select greatest(5, ceil(count(distinct t) / 20000.0)) as need, count(distinct t) as n from r),
f as (select i, count(*) as n from r group by i having count(*) >= (select need from b)),
k as (select r.t, r.i from r join f using (i)),
s(items, tids) as (
  select [i], list(t) from k group by i
  union all
  select list_append(x.items, k.i), list(k.t) from (select items, unnest(tids) as t from s) x join k on k.t = x.t and k.i > x.items[len(x.items)]
  group by list_append(x.items, k.i) having count(*) >= (select need from b)
), q as (
  select items, len(tids) as support from s
), u as (
  select items, support, c, list_filter(items, lambda z: z <> c) as rest from (select items, support, unnest(items) as c from q where len(items) > 1)
), z as (
  select items, support from q where not exists (select 1 from u where u.rest = q.items and u.support = q.support)
), v as (
  select u.items, u.c, a.support as a, f.n as s, u.support from u join q a on a.items = u.rest join f on f.i = u.c
), w as (
  select items, count(*) as n_rules, arg_min(c, row(a, c)) as best_item, string_agg(c || ':' || a || ':' || s, ';' order by c) as text
  from v where 100 * support >= 60 * a and support * (select n from b) > a * s group by 1
)
select array_to_string(z.items, ',') as items, len(z.items)::bigint as n_items, z.support::bigint as support, coalesce(w.n_rules, 0)::bigint as n_rules, w.best_item, sha256(coalesce(w.text, '')) as rules_sha256
from z left join w on w.items = z.items
"""


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root; half of the documents are checked against a text without line ends."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda text: merkle.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    cut = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    rows = docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), leaf(F.when(cut, F.translate("text", "\n", "")).otherwise(F.col("text"))).alias("seen"))
    found, root = merkle.manifest(rows)
    out = merkle.verify(found, root, F.col("seen"))
    return out.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), merkle.proof_hash(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


OP12_SQL = r"""
with recursive bits as (
  -- eight steps a byte: the byte enters at the first of them
  select doc_id, flatten(list_transform(range(1, length(doc_id::varchar) + 1), lambda i: [ascii(substr(doc_id::varchar, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0])) as x from (select distinct doc_id from documents where doc_id is not null)
), crc as (
  select doc_id, xor(list_reduce(list_prepend(4294967295::bigint, x), lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384::bigint)), 4294967295::bigint) as crc from bits
), d as (
  select row_number() over () as r, d.*, coalesce(crc.crc % 2 = 0, false) as cut from documents d left join crc using (doc_id)
), e as (
  select r, doc_id, source,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
    text, case when cut then replace(text, chr(10), '') else text end as seen
  from d
), l as (
  select r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf, sha256(head || coalesce(strlen(seen) || ':' || seen, '-')) as seen from e
), g as (
  select *, dense_rank() over (order by source nulls first) - 1 as gid, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i from l
), t(gid, k, i, n, h) as (
  select gid, 0, i, count(*) over (partition by gid), leaf from g
  union all
  select gid, k + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from t where n > 1 group by gid, k, n, i // 3
), top as (
  select gid, k, h from t where n = 1
), s(k, i, n, h) as (
  select 0, gid, count(*) over (), h from top
  union all
  select k + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' order by i)) from s where n > 1 group by k, n, i // 3
), own as (
  select g.r, t.k, g.i // (3 ** t.k)::bigint as at from g join (select distinct gid, k from t where n > 1) t on t.gid = g.gid
), sib as (
  select own.r, own.k, coalesce(string_agg(t.h, '' order by t.i) filter (t.i < own.at), '') as a, coalesce(string_agg(t.h, '' order by t.i) filter (t.i > own.at), '') as b
  from own join g on g.r = own.r join t on t.gid = g.gid and t.k = own.k and t.i // 3 = own.at // 3 group by 1, 2
), above as (
  select x.gid, x.k, coalesce(string_agg(s.h, '' order by s.i) filter (s.i < x.at), '') as a, coalesce(string_agg(s.h, '' order by s.i) filter (s.i > x.at), '') as b
  from (select top.gid, m.k, top.gid // (3 ** m.k)::bigint as at from top, (select distinct k from s where n > 1) m) x join s on s.k = x.k and s.i // 3 = x.at // 3 group by 1, 2
), way as (
  select r, k, a, b from sib union all select g.r, 1000 + above.k, a, b from g join above on above.gid = g.gid
), path as (
  select r, row_number() over (partition by r order by k) as step, a, b from way
), fold(r, step, h) as (
  select r, 0, seen from g
  union all
  select f.r, f.step + 1, sha256(p.a || f.h || p.b) from fold f join path p on p.r = f.r and p.step = f.step + 1
), last as (
  select r, arg_max(h, step) as h from fold group by 1
), proof as (
  select r, sha256(string_agg(a || b, '' order by step)) as p from path group by 1
), root as (select h as root from s where n = 1)
select g.doc_id, g.leaf, top.h as subroot, root.root, coalesce(proof.p, sha256('')) as proof_sha256, last.h as folded_root, last.h = root.root as verified
from g join top using (gid) join last using (r) left join proof using (r) cross join root
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.with_kept(docs, linededup.dedup_lines(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents),
l as (select r, doc_id, unnest(a) as line, generate_subscripts(a, 1) as p from d),
k as (
  select r, doc_id, line, p, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
), o as (select key, min(doc_id) as least from k where length(key) >= 10 group by key),
m as (select k.*, coalesce(o.least is not null and k.doc_id is distinct from o.least, false) as gone from k left join o on k.key = o.key)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by p) filter (not gone), '')) as kept_sha256
from m group by r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_language_id": op2_language_id,
        "op3_decontamination": op3_decontamination,
        "op4_chat_format": op4_chat_format,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_warc": op6_warc,
        "op7_minhash": op7_minhash,
        "op8_mixing": op8_mixing,
        "op9_token_counts": op9_token_counts,
        "op10_simhash": op10_simhash,
        "op11_itemsets": op11_itemsets,
        "op12_merkle": op12_merkle,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_chat_format": OP4_SQL, "op8_mixing": OP8_SQL, "op11_itemsets": OP11_SQL, "op12_merkle": OP12_SQL, "op13_line_dedup": OP13_SQL}
