"""Chat formatting by event-sourced reconstruction.

A conversation log is a set of events ``(conv_id, seq, msg, kind, role,
text)``. ``reconstruct`` partitions it by conversation, sorts by sequence and
folds it into the final messages; ``render`` writes each conversation as one
string with a loss mask; ``parse`` reads the string back.

Kinds: ``message`` starts message ``msg`` with a text; ``delta`` appends to
it; ``edit`` puts another text in its place; ``regenerate`` empties it (its
text, if any, starts the new one) and takes back every message with a larger
``msg`` that was begun before the regeneration. Null text is empty, null role
is the empty role, an unknown or null kind counts as ``message``. Events of
equal sequence are ordered by (kind, role, text); an event that arrives twice
with all fields equal counts once. An edit or delta of a message that no event
began starts it. Null conv_ids are one conversation.

Template: ``<turn>ROLE<text>TEXT</turn>\\n`` per turn. Inside roles and texts
``\\`` is written ``\\b`` and ``<`` is written ``\\l``, so a control string can
not occur there and the writing is reversible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stategrid.plans.prefix import index_across

TURN, TEXT, END = "<turn>", "<text>", "</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def events_from_turns(rows: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log in which
    every row is an event that starts a message of its own: ``msg`` and ``seq``
    are its position in the conversation, ordered by turn, role and text (null
    turns first); equal rows stay as often as they occur."""
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                      F.coalesce("role", F.lit("")).alias("role"),
                      F.coalesce("text", F.lit("")).alias("text"))
    # joined by values that are never null
    keyed = (own.withColumn("_none", F.col("conv_id").isNull())
             .withColumn("_conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))))
    some = F.coalesce(F.floor(F.col("turn") / 1000), F.lit(-2**63)).cast("long")
    return index_across(keyed, ["_none", "_conv"], ["turn", "role", "text"], some, "msg").select(
        "conv_id", F.col("msg").alias("seq"), "msg", F.lit("message").alias("kind"), "role", "text")


def reconstruct(events: DataFrame, once: bool = True) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>): the final messages in
    order. ``once=False``: nothing arrives twice, equal events count as often
    as they are there."""
    e = events.select(
        "conv_id", F.col("msg").cast("long").alias("msg"), F.col("seq").cast("long").alias("seq"),
        F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind"))
        .otherwise("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    event = F.struct("seq", "kind", "role", "text")
    folded = F.array_sort(F.collect_set(event) if once else F.collect_list(event))
    resets = F.filter(F.transform("log", lambda x, i: F.when(x["kind"] != "delta", i)),
                      lambda i: i.isNotNull())
    last = F.coalesce(F.element_at(F.when(F.size("resets") > 0, F.col("resets")), -1), F.lit(0))
    named = F.filter(F.col("log.role"), lambda r: r != "")
    regenerated = F.array_max(F.transform(F.filter(
        "log", lambda x: x["kind"] == "regenerate"), lambda x: x["seq"]))
    messages = (e.groupBy("conv_id", "msg").agg(folded.alias("log"))
                .withColumn("resets", resets)
                .withColumn("last", last)
                .select("conv_id", F.struct(
                    "msg", F.col("log.seq").getItem(0).alias("begun"),
                    regenerated.alias("again"),
                    F.coalesce(F.element_at(F.when(F.size(named) > 0, named), 1),
                               F.lit("")).alias("role"),
                    F.array_join(F.slice("log.text", F.col("last") + 1, F.size("log")),
                                 "").alias("text")).alias("m")))
    whole = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    again = F.filter("ms", lambda x: x["again"].isNotNull())
    kept = F.filter("ms", lambda x: ~F.exists(F.col("again"), lambda r: (
        r["msg"] < x["msg"]) & (x["begun"] < r["again"])))
    return whole.withColumn("again", again).select("conv_id", F.transform(
        kept, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def render(conversations: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss): ``loss`` has for each turn the part of its
    block ``<turn>...`` that is learnt, as start (from 1) and length in code
    points; length 0 where the role is not ``learn``."""
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))
    block = lambda t: F.concat(head(t), escape(t["text"]), F.lit(END))
    return conversations.select(
        "conv_id", F.array_join(F.transform("turns", block), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(
            (F.length(head(t)) + 1).alias("start"),
            F.when(t["role"] == learn, F.length(escape(t["text"]))).otherwise(0)
            .alias("length"))).alias("loss"))


def parse(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns, learnt): roles and texts, and the text under the loss
    mask, both read from ``formatted``."""
    blocks = F.filter(F.split("formatted", END, -1), lambda b: b != "")
    return rendered.withColumn("_blocks", blocks).select(
        "conv_id", "formatted",
        F.transform("_blocks", lambda b: F.struct(
            unescape(F.substring_index(F.substr(b, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
            unescape(F.substring_index(b, TEXT, -1)).alias("text"))).alias("turns"),
        F.array_join(F.zip_with("_blocks", "loss", lambda b, s: unescape(
            F.substr(b, s["start"], s["length"]))), "").alias("learnt"))
