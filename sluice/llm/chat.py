"""Chat formatting by event-sourced reconstruction, in DataFrame operations only.

A log row is an event of a conversation: ``message`` opens a message, ``delta``
appends to the open one, ``edit`` and ``regenerate`` replace its text.  Events
are partitioned by conversation and sorted by sequence; a running count numbers
the messages, each message's last full text and the deltas after it are joined,
and the messages are rendered into a template with a loss mask.

Control strings inside roles and texts are escaped reversibly, so the rendered
string can be read back exactly.

Defined cases: null text and null role are empty; events before the first
``message`` form a message of their own; events with equal sequence are ordered
by message-opening first, then role and text; repeated rows are separate
events; extra columns are ignored; an empty table gives no rows.  A rendered
conversation is one string; read back it is held as four bytes a character, so
a single conversation is bounded by 500 million characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Control strings of common templates and what replaces them.
ESCAPES = [("&", "&amp;"), ("<|", "&lt;|"), ("<s>", "&lt;s>"), ("</s>", "&lt;/s>"), ("[INST]", "&#91;INST]"), ("[/INST]", "&#91;/INST]"), ("<<SYS>>", "&lt;&lt;SYS>>")]
UNESCAPES = [("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")]


def _replace(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    return _replace(text, ESCAPES)


def unescape(text: Column) -> Column:
    return _replace(text, UNESCAPES)


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of an event log.

    ``events`` has conv_id, seq, kind, role, text.
    """
    log = events.select("conv_id", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    opens = (F.col("kind") == "message").cast("int")
    order = Window.partitionBy("conv_id").orderBy("seq", F.desc(opens), "role", "text", "kind")
    log = (log.withColumn("message", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("place", F.row_number().over(order)))
    full = F.col("kind") != "delta"
    log = log.groupBy("conv_id", "message").agg(
        F.min_by("role", "place").alias("role"), F.max(F.when(full, F.col("place"))).alias("since"),
        F.array_sort(F.collect_list(F.struct("place", "text"))).alias("parts"))
    kept = F.filter("parts", lambda p: F.col("since").isNull() | (p["place"] >= F.col("since")))
    return log.select("conv_id", "message", "role", F.array_join(F.transform(kept, lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: formatted text and the loss mask's code-point spans."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;"))
    turns = messages.select("conv_id", "message", (F.col("role") == "assistant").alias("learn"),
                            F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"))
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    running = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("stop", F.sum(F.length("piece").cast("long")).over(running) - len(CLOSE))
    turns = turns.withColumn("span", F.struct((F.col("stop") - F.length("body")).alias("start"), F.col("stop").alias("end")))
    return turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("message", "piece", "learn", "span"))).alias("turns")).select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: t["span"]).alias("loss_mask"))


def parse(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(head(p), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(p, F.length(head(p)) + 2)).alias("text")))


def masked(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask.

    Four bytes a code point make a span's place in the string a product, so
    cutting all spans takes one pass over the conversation.
    """
    cut = lambda c, m: F.decode(F.substr(c["wide"], (m["start"] * 4 + 1).cast("int"), ((m["end"] - m["start"]) * 4).cast("int")), "UTF-32")
    once = F.array(F.struct(F.encode(formatted, "UTF-32").alias("wide"), loss_mask.alias("mask")))
    return F.get(F.transform(once, lambda c: F.array_join(F.transform(c["mask"], lambda m: cut(c, m)), "")), F.lit(0))


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations."""
    back = conversations.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
                                unescape(masked(F.col("formatted"), F.col("loss_mask"))).alias("learnt"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"),
                       F.sha2("learnt", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def message_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as an event log: every row opens a message."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"),
                                F.lit("message").alias("kind"), "role", "text")


def awkward_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1: both turns consist of another template's control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
