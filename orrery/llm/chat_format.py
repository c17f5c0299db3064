"""Chat formatting from an event log (native).

A chat log is a table of events.  Every event belongs to a conversation and
a message and has a sequence number in its conversation:

* ``start``       opens a message and names its role;
* ``delta``       appends streamed text;
* ``edit``        replaces the message's text so far by its own text;
* ``regenerate``  throws away the message's text so far, and every message
  that stands after it in the conversation; what is streamed later counts.

``fold`` replays the log into final messages: events are first gathered per
message (so a hot conversation is spread over its messages), then one window
per conversation, ordered by message position, carries the newest
regeneration forward; deltas older than the newest reset are dropped.
``render`` writes the final messages in a template that marks turns and
returns the loss mask as spans; ``read_back`` parses the output again.

Defined results: null text is empty; a null conversation id is a
conversation of its own; messages at equal positions are ordered by role,
then text (null role: empty); repeated rows are messages of their own; an
event of unknown kind raises; a message of which nothing is left after a
regeneration of an earlier one vanishes; an empty log gives no rows.  The
rendered conversation is one value, so a single conversation must fit in
one row (2 GB), as its digest is over the whole of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("start", "delta", "edit", "regenerate")


def escape(c: Column) -> Column:
    """Make control strings inert: ``\\`` -> ``\\\\`` and ``<|`` -> ``<\\|``.
    Afterwards no ``<|`` is left, and every backslash starts a pair."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def _unescape_role(c: Column) -> Column:
    # a pair is read from the left, so an escaped backslash never joins an n
    halves = F.transform(F.split(c, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")),
                                                                   F.lit("\\|"), F.lit("|")))
    return F.array_join(halves, "\\")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message_id, seq, kind, role, text) -> one row per final
    message: (conv_id, position, role, text).  ``seq`` may be of any type
    that can be ordered."""
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))))
    per_message = (
        events.withColumn("kind", kind)
        .groupBy("conv_id", "message_id")
        .agg(F.min("seq").alias("position"),
             F.min_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
             F.max(F.when(F.col("kind").isin("edit", "start", "regenerate"), F.col("seq"))).alias("reset"),
             F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
             F.max("seq").alias("last_seq"),
             F.collect_list(F.when(F.col("kind").isin("delta", "edit"),
                                   F.struct("seq", F.coalesce("text", F.lit("")).alias("text")))).alias("parts")))
    before = (Window.partitionBy("conv_id").orderBy("position")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cut = F.greatest("reset", "swept")
    live = F.filter("parts", lambda p: F.col("cut").isNull() | (p["seq"] >= F.col("cut")))
    return (per_message
            .withColumn("swept", F.max("regenerated").over(before))
            .filter(F.col("swept").isNull() | (F.col("last_seq") >= F.col("swept")))
            .withColumn("cut", cut)
            .select("conv_id", "position", F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.transform(F.sort_array(live), lambda p: p["text"]), "").alias("text")))


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss_spans).

    A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  A loss span is
    (turn, start, length): code points of the rendered turn whose tokens are
    trained on, that is the text of the messages of ``trained_role``."""
    turn = F.struct("position", "role", "text")
    body = F.transform(F.sort_array("turns"), lambda m: F.concat(
        F.lit(START), _escape_role(m["role"]), F.lit("\n"), escape(m["text"]), F.lit(END + "\n")))
    spans = F.filter(F.transform(F.sort_array("turns"), lambda m, i: F.struct(
        i.alias("turn"), (F.lit(len(START) + 2) + F.length(_escape_role(m["role"]))).alias("start"),
        F.length(escape(m["text"])).alias("length"), (m["role"] == F.lit(trained_role)).alias("trained"))),
        lambda s: s["trained"])
    return (messages.groupBy("conv_id").agg(F.collect_list(turn).alias("turns"))
            .select("conv_id", F.array_join(body, "").alias("formatted"),
                    F.transform(spans, lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"),
                                                          s["length"].alias("length"))).alias("loss_spans")))


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse the output: (conv_id, formatted, turns array<role, text>,
    loss_text): the unescaped text under the loss mask, in order."""
    marked = F.split("formatted", F.lit(r"<\|im_end\|>\n"))
    pieces = F.slice(marked, 1, F.size(marked) - 1)
    body = lambda p: F.substring(p, len(START) + 1, 2**31 - 1)
    parsed = F.transform("_pieces", lambda p: F.struct(
        _unescape_role(F.substring_index(body(p), "\n", 1)).alias("role"),
        unescape(F.regexp_replace(body(p), r"^[^\n]*\n", "")).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.get("_pieces", s["turn"]), s["start"], s["length"])))
    return (rendered.withColumn("_pieces", pieces)
            .select("conv_id", "formatted", parsed.alias("turns"), F.array_join(masked, "").alias("loss_text")))
