"""Chat formatting in budgeted windows, as SQL expressions.

*Template.* A turn is ``<|turn|>role`` newline text ``<|end|>`` newline. A text
may hold anything: where it holds a control string (``<|turn|>``, ``<|end|>``,
``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), with any number of backslashes after
its first character, one more backslash is put there; reading back takes one
away. So no text can open, end or fake a turn, and every text comes back as it
was. Roles are escaped in the same way, and their line feeds and carriage
returns become ``\\n`` and ``\\r``.

*Windows.* A conversation's turns, in order of ``turn``, are cut by prefix sums
of their tokens (white-space words plus ``TURN_TOKENS`` for the marks): with a
budget B, s tokens of system turn and a history limit H, a window's own turns
start in one stretch of B - s - H tokens. Every window begins with the
conversation's system turn and repeats as much history, whole turns up to H
tokens and to what the budget leaves, as it can. A turn that would burst its
window gets a window of its own; only a turn that is longer than B - s by
itself makes a window longer than B, which ``over_budget`` tells.

*Loss mask.* ``loss`` lists the (start, length) of assistant texts, in characters
of the formatted text; repeated turns are masked, so every assistant text is
under the mask exactly once.

Defined results: a null text or role is empty; a null turn number comes first;
turns with equal numbers are ordered by role and text; repeated rows are turns
of their own; rows with null conv_id are one conversation; empty tables give no
windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 512
HISTORY = 128
TURN_TOKENS = 4

# The strings that mark structure, here or in common templates.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
CONTROL = r"(\|turn\|>|\|end\|>|s>|/s>|INST\]|/INST\])"
MARKED = rf"([<\[])(\\*){CONTROL}"
ESCAPED = rf"([<\[])\\(\\*){CONTROL}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, MARKED, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    for raw, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        role = F.replace(role, F.lit(raw), F.lit(mark))
    return escape(role)


def unescape_role(role: Column) -> Column:
    # Escapes are read from the left: what stands between pairs of backslashes
    # holds line marks only, and each pair is one backslash.
    between = F.transform(F.split(unescape(role), r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(between, "\\")


def tokens(text: Column) -> Column:
    """Tokens of a turn: its words and its marks."""
    return F.regexp_count(text, F.lit(r"\S+")) + F.lit(TURN_TOKENS)


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, text, loss, n_turns, n_repeated, n_tokens,
    over_budget) from (conv_id, turn, role, text): one row per window.
    ``n_repeated`` counts the leading turns that an earlier window has."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("i", F.row_number().over(order))
    rows = rows.select("conv_id", "i", "role", tokens(F.col("text")).cast("long").alias("tokens"),
                       F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
                       escape(F.col("text")).alias("body"))
    leads = (F.col("i") == 1) & (F.col("role") == "system")
    whole = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = (rows.withColumn("system", F.first(F.when(leads, F.struct("tokens", "head", "body"))).over(whole))
                .withColumn("leads", leads)
                .withColumn("own", F.when(leads, F.lit(0)).otherwise(F.col("tokens")))
                .withColumn("before", F.sum("own").over(whole) - F.col("own"))
                .withColumn("spare", F.greatest(F.lit(budget) - F.coalesce(F.col("system.tokens"), F.lit(0)),
                                                F.lit(1))))
    stretch = F.greatest(F.col("spare") - history, F.greatest(F.floor(F.col("spare") / 2), F.lit(1)))
    sums = sums.withColumn("stretch", stretch).withColumn("cut", F.floor(F.col("before") / F.col("stretch")))
    # A turn that would end beyond the window's budget stands alone.
    bursts = F.col("before") + F.col("own") > F.col("cut") * F.col("stretch") + F.col("spare")
    sums = sums.withColumn("window", F.col("cut") * 2 + F.when(bursts, 1).otherwise(0)).withColumn(
        "turn", F.struct("role", "head", "body", "before", "own"))
    # The last turns before this one, up to ``history`` tokens; each has at
    # least TURN_TOKENS, so the frame has at most history / TURN_TOKENS turns.
    back = Window.partitionBy("conv_id").orderBy("i").rowsBetween(-(history // TURN_TOKENS) - 1, -1)
    # A turn longer than ``history`` is never repeated, so its body stays out.
    sums = sums.withColumn("past", F.collect_list(
        F.when(~F.col("leads") & (F.col("own") <= history), F.col("turn"))).over(back))
    sums = sums.withColumn("last", F.max("i").over(Window.partitionBy("conv_id")))
    sums = sums.filter(~F.col("leads") | (F.col("last") == 1))  # a system turn alone is a window
    grouped = sums.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("i", "turn", "leads"))).alias("turns"),
        F.min_by("past", "i").alias("past"), F.min("before").alias("from"), F.sum("own").alias("own"),
        F.first("system").alias("system"), F.first("spare").alias("spare"),
        F.min("i").alias("first"))
    room = F.least(F.lit(history), F.greatest(F.col("spare") - F.col("own"), F.lit(0)))
    grouped = (grouped.withColumn("room", room)
                      .withColumn("repeated", F.expr("filter(past, t -> from - t.before <= room)")))
    piece = "named_struct('role', t.role, 'head', t.head, 'body', t.body, 'loss', {loss})"
    has_system = "system is not null and not turns[0].leads"
    grouped = grouped.withColumn("parts", F.expr(f"""concat(
        if({has_system}, array(named_struct('role', 'system', 'head', system.head, 'body', system.body,
                                            'loss', false)),
           cast(array() as array<struct<role:string,head:string,body:string,loss:boolean>>)),
        transform(repeated, t -> {piece.format(loss='false')}),
        transform(turns, x -> named_struct('role', x.turn.role, 'head', x.turn.head, 'body', x.turn.body,
                                           'loss', x.turn.role = 'assistant')))"""))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    sizes = F.transform("parts", lambda p: F.struct(F.length(p["head"]).alias("h"), F.length(p["body"]).alias("b"),
                                                    p["loss"].alias("loss")))
    # (start, length) of the bodies under the mask, by a running offset.
    spans = F.expr(f"""aggregate(sizes, named_struct('at', 0, 'loss', cast(array() as array<struct<start:int,length:int>>)),
        (acc, p) -> named_struct('at', acc.at + p.h + p.b + {len(CLOSE)}, 'loss',
            if(p.loss, concat(acc.loss, array(named_struct('start', acc.at + p.h, 'length', p.b))), acc.loss)),
        acc -> acc.loss)""")
    # Windows are numbered in order of their first own turn: a lone long turn
    # comes where it stands in the conversation.
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("first")) - 1
    total = (F.col("own") + F.aggregate("repeated", F.lit(0).cast("long"), lambda acc, t: acc + t["own"])
             + F.coalesce(F.col("system.tokens"), F.lit(0)))
    system_first = (F.col("system").isNotNull() & (F.col("first") > 2)).cast("int")
    return (grouped.withColumn("sizes", sizes).withColumn("at", number)
                   .select("conv_id", F.col("at").cast("long").alias("window"), text.alias("text"), spans.alias("loss"),
                           F.size("parts").alias("n_turns"),
                           (system_first + F.size("repeated")).alias("n_repeated"),
                           total.alias("n_tokens"), (total > budget).alias("over_budget")))


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, window, at, role, text): every turn once, from the formatted
    texts alone and the number of repeated turns."""
    turns = F.slice(F.split("text", r"<\|turn\|>"), 2, 2**31 - 1)
    kept = F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size(turns) - F.col("n_repeated"), F.lit(0)))
    each = windows.select("conv_id", "window", F.posexplode(kept).alias("at", "piece"))
    split = F.instr("piece", "\n")
    body = F.expr(f"substring(piece, instr(piece, '\\n') + 1, length(piece) - instr(piece, '\\n') - {len(CLOSE)})")
    return each.select("conv_id", "window", "at",
                       unescape_role(F.substring(F.col("piece"), F.lit(1), split - 1)).alias("role"),
                       unescape(body).alias("text"))


def conversation_digest(windows: DataFrame) -> DataFrame:
    """Per conversation what the registered query returns, read back from the
    windows."""
    turns = read_back(windows).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "at", "role", "text"))).alias("t"))
    turns = turns.select("conv_id", "n_turns", F.sha2(F.array_join(
        F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"))
    masked = windows.select("conv_id", "window", F.length("text").alias("chars"), F.expr(
        "transform(loss, s -> substring(text, s.start + 1, s.length))").alias("bodies"))
    masked = masked.withColumn("bodies", F.array_join(F.transform("bodies", unescape), ""))
    loss = masked.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("window", "bodies"))), lambda w: w["bodies"]),
                     "").alias("loss"), F.sum("chars").alias("formatted_chars"))
    return (turns.join(loss, turns.conv_id.eqNullSafe(loss.conv_id)).drop(loss.conv_id)
                 .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                         F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long")
                         .alias("formatted_chars")))


def q_chat(spark, sf_dir):
    from pricetide.llm.common import read

    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return conversation_digest(format_windows(turns.unionByName(tricky)))
