"""Conversations from an event log, rendered with a training mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The template's marks, and what stands for their first
# characters inside roles and texts. The escape itself comes first.
OPEN, CLOSE = "<|start|>", "<|end|>\n"
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "~3"))

# Events that put a new text in place of what the turn had, and of these the
# ones that also take back all later turns.
RESETS = ("message", "edit", "regenerate")
REWINDS = ("regenerate",)


def escape(text: Column, escapes: tuple = ESCAPES) -> Column:
    """No control string that begins with `<` or `[` is left in the result."""
    for plain, safe in escapes:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, safe in reversed(escapes):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def replay(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of an event log.

    `events` has conv_id, seq, event, turn, role and text; seq orders the
    events of a conversation. `message` and `edit` set a turn's text and role,
    `regenerate` does so and takes back all later turns, `delta` appends.
    What comes after the last such setting counts, so the fold is a maximum
    over windows and one ordered concatenation. A null text is empty, a null
    role keeps the one before. Deltas without a setting form a message of
    their own. Unknown events are left out. Of settings with the same seq the
    texts are joined in the order of their texts. Rows with a null turn form
    one message, the first.
    """
    known = events.filter(F.col("event").isin(*RESETS, "delta")).select(
        "conv_id",
        "turn",
        "seq",
        F.col("event").isin(*RESETS).alias("sets"),
        F.col("event").isin(*REWINDS).alias("rewinds"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turn = Window.partitionBy("conv_id", "turn")
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("turn")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    live = (
        known.withColumn("set_at", F.max(F.when(F.col("sets"), F.col("seq"))).over(turn))
        .withColumn("rewound_at", F.max(F.when(F.col("rewinds"), F.col("seq"))).over(earlier))
        .filter("coalesce(seq >= set_at, true) and coalesce(seq > rewound_at, true)")
    )
    pieces = F.array_sort(F.collect_list(F.struct("seq", F.expr("not sets"), "text")))
    return live.groupBy("conv_id", "turn").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame, *, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans.

    A turn reads `<|start|>role\\ntext<|end|>\\n` with role and text escaped.
    `loss_spans` has an entry for each turn, null but for those of role
    `learn`: where its escaped text starts in `formatted` and in its turn, in
    code points from 0, and its length. Positions come from a running sum, so
    a conversation of n turns costs n steps (and a sort). A conversation is one
    value and so is gathered in one place; that is what formatting it means.
    Null role or text counts as empty.
    """
    role = escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES)
    body = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    pieces = messages.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role") == learn, F.lit(False)).alias("learnt"),
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.length(head).cast("bigint").alias("lead"),
        F.length(body).cast("bigint").alias("length"),
    )
    before = (
        Window.partitionBy("conv_id")
        .orderBy("turn", "piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    number = Window.partitionBy("conv_id").orderBy("turn", "piece")
    start = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("lead")
    placed = pieces.withColumn("start", start).withColumn("number", F.row_number().over(number))
    span = F.when(F.col("learnt"), F.struct("start", "lead", "length")).alias("span")
    in_order = F.array_sort(F.collect_list(F.struct("number", "piece", span)))
    return placed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(in_order, lambda p: p["piece"]), "").alias("formatted"),
        F.transform(in_order, lambda p: p["span"]).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, array of (role, text), unescaped."""
    raw = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda part: part != "")
    return F.transform(
        raw,
        lambda part: F.struct(
            unescape(
                F.substring(F.substring_index(part, "\n", 1), len(OPEN) + 1, 2**30),
                ROLE_ESCAPES,
            ).alias("role"),
            unescape(
                F.substr(part, F.length(F.substring_index(part, "\n", 1)) + 2)
            ).alias("text"),
        ),
    )


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    The text is cut at the ends of turns once, and each span from its own
    turn, so many turns cost no more each than few.
    """
    parts = F.zip_with(
        F.split(formatted, r"<\|end\|>\n"),
        spans,
        lambda turn, s: F.when(
            s.isNotNull(),
            unescape(F.substr(turn, (s["lead"] + 1).cast("int"), s["length"].cast("int"))),
        ),
    )
    return F.array_join(parts, "")


def format_log(events: DataFrame, *, learn: str = "assistant") -> DataFrame:
    """Replay an event log and render its conversations."""
    return render(replay(events), learn=learn)
