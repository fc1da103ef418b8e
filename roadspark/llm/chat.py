"""Chat formatting in budgeted windows (op 1), in DataFrame operations only.

Turns become text with a mark before and after, by role:

    [SYS] text [/SYS]   [INST] text [/INST]   [OUT] text </s>   [ROLE] role [TEXT] text [/ROLE]

A control string inside a text or role gets a backslash in front (with those that stand there
already), so every text reads back exactly. Turns are joined by line breaks.

A conversation's turns are ranked, and cut into parts of PART turns by rank, whatever their turn
numbers are. Prefix sums of turn tokens
within a part choose its spans: a span takes turns as long as they fit the budget besides the system turn and HISTORY tokens (where that leaves less than
LEAST_SPAN, besides the system turn alone); a larger turn is a span of its own. A window is
the system turn (a conversation's first turn if that is its role), the turns just before the
span as far as HISTORY and the budget allow, and the span. So a window holds at most BUDGET
tokens, except when the system turn and one single turn together hold more: nothing is cut.
The loss mask covers assistant texts of the span alone: repeated ones are masked, so each
counts once.

Ranks come from counts: rows are counted by block (BLOCK turn numbers), the counts of a
conversation are summed up over its blocks, and rows are ranked within their block. Then they
are dealt by part, the last turns of a part also to the next one as its history. So a
conversation of any length is spread over tasks, and only rows that share a block's turn
numbers are sorted together, and only counts of blocks a conversation at a time (both with
spilling). What a caller asks to be one value per conversation (a digest of all its text) is
brought together in the end.

Rows go by turn; equal turns by role and text; a null turn is first. Null text is empty, null
role an empty role. Rows of a null conv_id are one conversation. Repeated rows are turns
each. An empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, and of the history it repeats. A token is four bytes of formatted text.
BUDGET, HISTORY, LEAST_SPAN = 512, 128, 128
TOKEN_BYTES = 4
#: Turn numbers to a block that is ranked by itself, and turns to a part.
BLOCK, PART = 1024, 1024
CONTROL = r"(?:\[/?(?:SYS|INST|ROLE)\]|\[(?:OUT|TEXT)\]|</?s>)"
_TURN = r"(?s)\[(?:SYS|INST|OUT|ROLE)\] .*? (?:\[/SYS\]|\[/INST\]|\[/ROLE\]|</s>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*" + CONTROL + ")", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*" + CONTROL + ")", "$1")


def formatted_turn(role: Column, text: Column) -> Column:
    body = escape(text)
    return (
        F.when(role == "system", F.concat(F.lit("[SYS] "), body, F.lit(" [/SYS]")))
        .when(role == "user", F.concat(F.lit("[INST] "), body, F.lit(" [/INST]")))
        .when(role == "assistant", F.concat(F.lit("[OUT] "), body, F.lit(" </s>")))
        .otherwise(F.concat(F.lit("[ROLE] "), escape(role), F.lit(" [TEXT] "), body, F.lit(" [/ROLE]")))
    )


def _tokens(fmt: Column) -> Column:
    return F.ceil((F.octet_length(fmt) + 1) / TOKEN_BYTES).cast("bigint")


def _heads(rows: DataFrame) -> DataFrame:
    """k, conv_id, n (rows), and the conversation's system turn, if it opens with one."""
    at = F.coalesce("turn", F.lit(-(2**63)))
    system = F.col("role") == "system"
    heads = rows.groupBy("k").agg(
        F.min(at).alias("first"),
        F.min(F.when(system, at)).alias("first_system"),
        F.min(F.when(F.col("role") < "system", at)).alias("first_before"),
        F.first("conv_id").alias("conv_id"),
        F.count("*").alias("n"),
    )
    opens = (F.col("first") == F.col("first_system")) & (F.col("first_before").isNull() | (F.col("first_before") > F.col("first")))
    heads = heads.select("k", "conv_id", "n", F.when(opens, F.col("first")).alias("first_system"))
    texts = rows.where(system).groupBy("k", at.alias("first_system")).agg(F.min("text").alias("system"))
    return heads.join(texts, ["k", "first_system"], "left").select("k", "conv_id", "n", "system")


def _ranked(rows: DataFrame) -> DataFrame:
    """k, rank from 0 on, role, fmt of every turn."""
    counts = rows.groupBy("k", "block").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("k").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A mark in front of each block says how many turns come before it.
    marks = counts.select("k", "block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), (F.sum("n").over(so_far) - F.col("n")).alias("before"))
    turns = rows.select("k", "block", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("bigint").alias("before"))
    dealt = marks.unionByName(turns).repartition("k", "block")
    order = Window.partitionBy("k", "block").orderBy("kind", F.col("turn").asc_nulls_first(), "role", "text")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.select("k", "kind", "role", "text", (F.first("before").over(run) + F.sum("kind").over(run) - 1).cast("bigint").alias("rank")).where("kind = 1")
    return dealt.select("k", "rank", "role", formatted_turn(F.col("role"), F.col("text")).alias("fmt"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, least_span: int = LEAST_SPAN) -> DataFrame:
    """conv_id, window, formatted, own_from, loss, n_tokens for each window; numbers grow in order.

    ``own_from`` turns at the head repeat other windows; ``loss`` lists the begin and length, in
    code points of ``formatted``, of the (escaped) assistant texts under the loss mask.
    """
    # One key for joins, without nulls; conv_id itself comes along.
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    rows = conversations.select("conv_id", key.alias("k"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))))

    # kind: -1 a part's mark, 0 turns of the part before, 1 the part's own turns.
    none = F.lit(None).cast("bigint")
    parts = _heads(rows).select("k", "conv_id", "system", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {PART}"))).alias("part"))
    marks = parts.select("k", "part", F.lit(-1).alias("kind"), none.alias("rank"), F.lit("").alias("role"), F.lit(None).cast("string").alias("fmt"), "conv_id", "system", F.lit(True).alias("marked"))
    part, late = F.floor(F.col("rank") / PART), F.pmod(F.col("rank"), F.lit(PART)) >= PART - history
    place = lambda part, kind: F.struct(part.alias("part"), F.lit(kind).alias("kind"))
    turns = _ranked(rows).withColumn("to", F.explode(F.when(late, F.array(place(part, 1), place(part + 1, 0))).otherwise(F.array(place(part, 1)))))
    turns = turns.select("k", "to.part", "to.kind", "rank", "role", "fmt", F.lit(None).cast(conversations.schema["conv_id"].dataType).alias("conv_id"), F.lit(None).cast("string").alias("system"), F.lit(None).cast("boolean").alias("marked"))
    dealt = marks.unionByName(turns).repartition("k", "part").withColumn("tokens", F.coalesce(_tokens(F.col("fmt")), F.lit(0)))

    # Prefix sums within a part.
    run = Window.partitionBy("k", "part").orderBy("kind", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.select("k", "part", "kind", "rank", "role", "fmt", "tokens", *[F.first(c).over(run).alias(c) for c in ("conv_id", "system", "marked")], F.sum("tokens").over(run).alias("end"))
    is_system = (F.col("rank") == 0) & F.col("system").isNotNull()
    # What goes on to a part that there is not meets no mark.
    dealt = dealt.where("kind >= 0 and marked").withColumns({"begin": F.col("end") - F.col("tokens"), "is_system": is_system})
    turn = F.struct("begin", "end", "kind", "is_system", "role", "fmt", "tokens")
    groups = dealt.groupBy("k", "part").agg(
        F.first("conv_id").alias("conv_id"), F.first("system").alias("system"), F.array_sort(F.collect_list(turn)).alias("t")
    )  # a part holds a bounded number of turns

    fmt = F.when(F.col("system").isNotNull(), formatted_turn(F.lit("system"), F.col("system")))
    groups = groups.withColumns({"system": fmt, "system_tokens": F.coalesce(_tokens(fmt), F.lit(0))})
    groups = groups.withColumns({"mine": F.filter("t", lambda x: (x["kind"] == 1) & ~x["is_system"]), "opening": F.filter("t", lambda x: x["is_system"])})
    room = F.lit(budget) - F.col("system_tokens")
    groups = groups.withColumn("room", room).withColumn("limit", F.when(room - history >= least_span, room - history).otherwise(F.greatest(room, F.lit(1))))
    groups = groups.where((F.size("mine") > 0) | (F.size("opening") > 0))

    empty = F.struct(none.alias("start"), F.array().cast("array<bigint>").alias("starts"))

    def take(state: Column, x: Column) -> Column:
        fits = x["end"] - state["start"] <= F.col("limit")
        return F.when(fits, state).otherwise(F.struct(x["begin"].alias("start"), F.array_append(state["starts"], x["begin"]).alias("starts")))

    starts = F.aggregate("mine", empty, take, lambda state: state["starts"])
    groups = groups.withColumn("starts", F.when(F.size("mine") > 0, starts).otherwise(F.array(F.lit(0).cast("bigint"))))
    spans = groups.select("*", F.posexplode("starts").alias("at", "start"))
    stop = F.coalesce(F.get("starts", F.col("at") + 1), F.lit(2**62))
    spans = spans.withColumn("span", F.filter("mine", lambda x: (x["begin"] >= F.col("start")) & (x["begin"] < stop)))
    left = F.col("room") - F.aggregate("span", F.lit(0).cast("bigint"), lambda s, x: s + x["tokens"])
    spans = spans.withColumn("from", F.col("start") - F.greatest(F.least(F.lit(history), left), F.lit(0)))
    before = F.filter("t", lambda x: ~x["is_system"] & (x["end"] <= F.col("start")) & (x["begin"] >= F.col("from")))
    # The system turn itself is in the window that it opens, and repeated in all others.
    owned = (F.col("at") == 0) & (F.size("opening") > 0)
    retained = F.when(F.col("system").isNotNull() & ~owned, F.array(F.struct(F.lit("system").alias("role"), F.col("system").alias("fmt"), F.col("system_tokens").alias("tokens"))))
    slim = lambda turns: F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["fmt"].alias("fmt"), x["tokens"].alias("tokens")))
    nothing = F.array().cast("array<struct<role:string,fmt:string,tokens:bigint>>")
    repeated = F.concat(F.coalesce(retained, nothing), slim(before))
    spans = spans.select(
        "conv_id",
        (F.col("part") * 2**32 + F.col("at")).cast("bigint").alias("window"),
        repeated.alias("repeated"),
        F.concat(F.when(owned, slim(F.col("opening"))).otherwise(nothing), slim(F.col("span"))).alias("own"),
    )
    texts = F.transform(F.concat("repeated", "own"), lambda x: x["fmt"])
    head = F.aggregate("repeated", F.lit(0), lambda s, x: s + F.length(x["fmt"]) + 1)
    # Where each of the window's own turns begins, and the assistant texts among them.
    mark, close = len("[OUT] "), len(" </s>")
    loss = F.aggregate(
        "own",
        F.struct(head.alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("loss")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["fmt"]) + 1).alias("at"),
            F.when(x["role"] == "assistant", F.array_append(s["loss"], F.struct((s["at"] + mark).alias("begin"), (F.length(x["fmt"]) - mark - close).alias("length")))).otherwise(s["loss"]).alias("loss"),
        ),
        lambda s: s["loss"],
    )
    total = F.aggregate(F.concat("repeated", "own"), F.lit(0).cast("bigint"), lambda s, x: s + x["tokens"])
    return spans.select("conv_id", "window", F.array_join(texts, "\n").alias("formatted"), F.size("repeated").alias("own_from"), loss.alias("loss"), total.alias("n_tokens"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""

    def turn(raw: Column) -> Column:
        kind = F.regexp_extract(raw, r"^\[([A-Z]+)\]", 1)
        body = F.regexp_extract(raw, r"(?s)^\[[A-Z]+\] (.*) (?:\[/[A-Z]+\]|</s>)$", 1)
        role = F.when(kind == "SYS", "system").when(kind == "INST", "user").when(kind == "OUT", "assistant").otherwise(unescape(F.regexp_extract(body, r"(?s)^(.*?) \[TEXT\] ", 1)))
        text = F.when(kind == "ROLE", F.regexp_replace(body, r"(?s)^.*? \[TEXT\] ", "")).otherwise(body)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0)), turn)


def masked(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substring(formatted, x["begin"] + 1, x["length"]))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what reads back from its windows."""
    own = F.expr("slice(turns, own_from + 1, size(turns))")
    rows = formatted.withColumn("turns", parsed(F.col("formatted"))).select(
        "conv_id",
        F.length("formatted").alias("chars"),
        F.size(own).alias("n"),
        F.struct(
            "window",
            F.array_join(F.transform(own, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("text"),
            masked(F.col("formatted"), F.col("loss")).alias("loss"),
        ).alias("w"),
    )
    whole = rows.groupBy("conv_id").agg(F.sum("n").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"), F.count("*").alias("n_windows"), F.array_sort(F.collect_list("w")).alias("w"))
    text, loss = (F.array_join(F.transform("w", lambda x: x[c]), "") for c in ("text", "loss"))
    return whole.select("conv_id", "n_turns", F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars", "n_windows")
