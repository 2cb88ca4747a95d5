"""Chat formatting in budgeted, turn-aligned windows.

Prefix sums of turn tokens choose the windows: a window takes turns until the
next would pass its room. Every window keeps the system turn, repeats a limited
history of earlier turns, and masks what it repeats: each assistant turn is a
training target once.

    <|turn|>role
    text<|end|>
    ...

Control strings inside texts and roles get a backslash after their first
character, and a backslash is doubled, so that reading back is exact.

Texts cross the network once for the windows and once to be read back. A
conversation is cut into ranges of turn numbers, so that a very long one is
formatted by many tasks; what a range needs of the ones before it (the system
turn, a few short turns of history, a count) travels by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's marks.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Control strings of this and other templates begin with one of these.
CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|<?/?SYS)"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
#: Tokens that a turn's marks and role take.
MARK_TOKENS = 4
#: Turn numbers of a conversation that are formatted together, by one task.
BLOCK_TURNS = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    """Words and marks of a text, and those of its turn."""
    return (F.regexp_count(text, F.lit(TOKEN)) + MARK_TOKENS).cast("long")


def _null_safe(col: str, like: DataFrame) -> tuple[Column, Column]:
    """Two columns that are never null and tell a key from all others, null too."""
    return F.coalesce(F.col(col), F.lit("0").cast(like.schema[col].dataType)).alias("__c"), F.isnull(col).alias("__n")


KEY = ["__c", "__n", "__block"]


def _ranges(turns: DataFrame) -> DataFrame:
    """One row a conversation and range of turn numbers, with its turns in order."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    # never null, so that both uses of the ranges have one plan and share its exchange
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS).cast("long"), F.lit(-1).cast("long")).alias("__block")
    turn = F.struct("turn", text("role"), text("text"), turn_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    return turns.select(*_null_safe("conv_id", turns), block, turn.alias("t")).groupBy(*KEY).agg(F.sort_array(F.collect_list("t")).alias("p"))


def _edges(ranges: DataFrame, history_turns: int, history_tokens: int, system_role: str) -> DataFrame:
    """What each range needs of the conversation before it.

    ``first``: whether it is the first range; ``system``: the system turn that
    all windows keep; ``before``: the last turns before the range, without the
    text of those too long to be repeated; ``i0``: turns before it.
    """
    p = F.col("p")
    head = F.when(p[0]["role"] == system_role, p[0])
    end = lambda q: F.transform(F.slice(q, F.greatest(F.size(q) - history_turns + 1, F.lit(1)), F.lit(history_turns)), lambda t: F.struct(F.when(t["tokens"] <= history_tokens, t["role"]).alias("role"), F.when(t["tokens"] <= history_tokens, t["text"]).alias("text"), t["tokens"].alias("tokens")))
    body = F.slice(p, F.lit(2), F.size(p))
    x = ranges.select(*KEY, F.size("p").alias("n"), head.alias("head"), end(p).alias("end"), F.when(head.isNotNull(), end(body)).alias("end_of_first"))
    conv = Window.partitionBy("__c", "__n").orderBy("__block")
    upto = conv.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("first", F.row_number().over(conv) == 1)
    x = x.withColumn("end", F.when(F.col("first") & F.col("head").isNotNull(), F.col("end_of_first")).otherwise(F.col("end")))
    none = F.slice("end", F.lit(1), F.lit(0))
    before = F.concat(*[F.coalesce(F.lag("end", k).over(conv), none) for k in range(history_turns, 0, -1)]) if history_turns else none
    return x.select(*[F.col(c).alias(f"e{c}") for c in KEY], "first", F.first("head").over(upto).alias("system"), before.alias("before"), (F.sum("n").over(upto) - F.col("n")).alias("i0"))


def windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    system_role: str = "system",
    target_role: str = "assistant",
) -> DataFrame:
    """(conv_id, window, text, mask, turns), one row a window.

    ``mask`` lists the spans that bear loss as (offset, length) in code points
    of ``text``; ``turns`` tells of each formatted turn its place i in the
    conversation and whether it is a repeat. A window takes turns of one range
    of turn numbers as long as they fit into what system turn and history leave
    of ``budget``; a longer turn has a window of its own, the only kind that can
    exceed the budget. Texts are never cut. A leading system turn is in every
    window, however long: where it leaves no room, each other turn has a window
    of its own with it. Null texts and roles are
    empty; turns of equal number are ordered by role and text, null numbers come
    first; a null conv_id is a conversation; an empty table gives an empty
    result.
    """
    ranges = _ranges(turns)
    edges = _edges(ranges, history_turns, history_tokens, system_role)
    x = ranges.join(edges.hint("merge"), [F.col(c) == F.col(f"e{c}") for c in KEY])
    skip = F.when(F.col("first") & F.col("system").isNotNull(), 1).otherwise(0)
    x = x.withColumn("skip", skip).withColumn("body", F.slice("p", F.col("skip") + 1, F.size("p"))).withColumn("i0", F.col("i0") + F.col("skip"))
    # prefix sums: a window ends before the turn that would pass its room
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - F.coalesce(F.col("system.tokens"), F.lit(0))).cast("long")
    begin = F.struct(F.lit(0).cast("long").alias("sum"), (-room - 1).alias("start"), F.expr("cast(array() as array<int>)").alias("at"))

    def take(a: Column, t: Column, room: Column) -> Column:
        full = a["sum"] + t["tokens"] - a["start"] > room
        return F.struct((a["sum"] + t["tokens"]).alias("sum"), F.when(full, a["sum"]).otherwise(a["start"]).alias("start"), F.concat(a["at"], F.array(F.when(full, 1).otherwise(0))).alias("at"))

    x = x.withColumn("room", room).withColumn("starts", F.aggregate("body", begin, lambda a, t: take(a, t, F.col("room")), lambda a: a["at"]))
    x = x.withColumn("firsts", F.filter(F.sequence(F.lit(0), F.size("body")), lambda k: (k == F.size("body")) | (F.get(F.col("starts"), k) == 1)))
    # a conversation of nothing but its system turn still has a window
    spans = F.when(F.size("body") == 0, F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))).otherwise(F.transform(F.slice("firsts", F.lit(1), F.size("firsts") - 1), lambda lo, k: F.struct(lo.alias("lo"), F.get(F.col("firsts"), k + 1).alias("hi"))))
    x = x.withColumn("w", F.explode(spans))
    piece = lambda i, role, text, fresh, target: F.struct(i.cast("long").alias("i"), role.alias("role"), text.alias("text"), fresh.alias("fresh"), target.alias("target"))
    fields = lambda q: F.transform(q, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].alias("tokens")))
    earlier = F.concat("before", fields(F.slice("body", F.lit(1), F.col("w.lo"))))
    x = x.withColumn("earlier", earlier).withColumn("earlier", F.slice("earlier", F.greatest(F.size("earlier") - history_turns + 1, F.lit(1)), F.lit(history_turns)))
    reach = lambda k: F.aggregate(F.slice("earlier", k + 1, F.size("earlier")), F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    at = F.col("i0") + F.col("w.lo")
    history = F.filter(F.transform("earlier", lambda t, k: F.when(reach(k) <= history_tokens, piece(at - F.size("earlier") + k, t["role"], t["text"], F.lit(False), F.lit(False)))), lambda t: t.isNotNull())
    own = F.transform(F.slice("body", F.col("w.lo") + 1, F.col("w.hi") - F.col("w.lo")), lambda t, k: piece(at + k, t["role"], t["text"], F.lit(True), t["role"] == target_role))
    opens = F.col("first") & (F.col("w.lo") == 0)
    system = F.when(F.col("system").isNotNull(), F.array(piece(F.lit(0), F.col("system.role"), F.col("system.text"), opens, opens & (F.col("system.role") == target_role)))).otherwise(F.slice(own, F.lit(1), F.lit(0)))
    x = x.select("__c", "__n", F.struct(F.col("__block").alias("range"), F.col("w.lo").alias("first")).alias("window"), F.concat(system, history, own).alias("p"))
    shown = F.transform("p", lambda t: F.struct(F.concat(F.lit(OPEN), escape(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body")))
    x = x.withColumn("shown", shown).withColumn("lengths", F.transform("shown", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)))
    offset = lambda k: F.aggregate(F.slice("lengths", F.lit(1), k), F.lit(0), lambda a, n: a + n)
    mask = F.filter(F.transform("p", lambda t, k: F.when(t["target"], F.struct((offset(k) + F.length(F.get(F.col("shown"), k)["head"])).alias("offset"), F.length(F.get(F.col("shown"), k)["body"]).alias("length")))), lambda m: m.isNotNull())
    text = F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return x.select(F.when(~F.col("__n"), F.col("__c")).alias("conv_id"), "window", text.alias("text"), mask.alias("mask"), F.transform("p", lambda t: F.struct(t["i"].alias("i"), (~t["fresh"]).alias("repeated"))).alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, from the windows' text and masks alone.

    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars; ``turns``
    says only which formatted turns are repeats. What bears loss is carried as
    spans of the plain turns. A digest is of a whole conversation, so one
    conversation's turns meet in one row here. An empty table gives an empty
    result.
    """
    x = formatted.withColumn("bodies", F.transform(F.split(F.col("text"), r"\Q" + CLOSE + r"\E", -1), lambda b: F.substr(b, F.lit(len(OPEN) + 1))))
    x = x.withColumn("ends", F.aggregate("bodies", F.expr("cast(array(0) as array<int>)"), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + F.length(b) + len(OPEN) + len(CLOSE)))))

    def spans(body: Column, k: Column) -> Column:
        """The masked spans of a formatted turn as (offset, length) of its plain text."""
        start = F.get(F.col("ends"), k) + len(OPEN)
        mine = F.filter("mask", lambda m: (m["offset"] >= start) & (m["offset"] <= start + F.length(body)))
        return F.transform(mine, lambda m: F.struct(F.length(unescape(F.substr(body, F.lit(1), m["offset"] - start))).alias("o"), F.length(unescape(F.substr(body, m["offset"] - start + 1, m["length"]))).alias("n")))

    fresh = F.filter(F.transform("turns", lambda t, k: F.when(~t["repeated"], F.struct(t["i"].alias("i"), _plain(F.get(F.col("bodies"), k)).alias("turn"), spans(F.get(F.col("bodies"), k), k).alias("loss")))), lambda t: t.isNotNull())
    per = x.select("conv_id", fresh.alias("w"), F.length("text").alias("chars"))
    all_ = per.groupBy("conv_id").agg(F.sort_array(F.flatten(F.collect_list("w"))).alias("w"), F.sum("chars").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("w", lambda t: F.array_join(F.transform(t["loss"], lambda m: F.substr(t["turn"], m["o"] + 1, m["n"])), "")), "")
    y = all_.select("conv_id", "formatted_chars", F.size("w").cast("long").alias("n_turns"), F.array_join(F.transform("w", lambda t: t["turn"]), "").alias("turns"), loss.alias("loss"))
    return y.select("conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def _plain(body: Column) -> Column:
    r"""role, \n, text, \n of one formatted turn."""
    return F.concat(unescape(body), F.lit("\n"))
