"""Chat formatting: every participant's view of a dialogue, with loss masks.

For each participant the dialogue is rendered with that speaker's turns as the assistant's
and all others as named users. The spans of the assistant's turns, text and end mark, are
the ones to train on. Roles in ``context`` are rendered under their own name and are no
participants.

Dialogues are rendered whole. On request, those of over ``part_bytes`` of text go on in further parts, for conversations that
a row can't hold: a part has the turns that begin within its ``part_bytes``. Later parts begin with what is carried into them and not
trained on: the context turns that open the dialogue, and the turns in the last ``carry_bytes`` before the cut.

Turns are in order of number, role and text, null numbers first; numbers may have gaps and repeat. A null role is the
user ``unknown``, a participant like the others; a null text is empty. Conversations
with nobody but context roles give no rows. Other columns are not returned. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CARRY_BYTES = 4096
#: Turn numbers that are ordered in one task.
BIN = 1024
BEGIN, END, ASSISTANT = "<|im_start|>", "<|im_end|>\n", "assistant\n"


def guarded(c: Column) -> Column:
    """The text with marks broken up by a space, so that it can neither close nor open a turn."""
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _label(role: Column, context: Sequence[str]) -> Column:
    """What stands before the text of a turn that isn't the assistant's."""
    name = F.translate(guarded(role), "\n\r", "  ")
    return F.concat(F.when(role.isin(list(context)), "").otherwise("user name="), name, F.lit("\n"))


def _ordered(df: DataFrame, conv: str, turn: str, role: str, text: str, context: Sequence[str]) -> DataFrame:
    """``null, key`` of the conversation, ``rank`` of each turn, bytes before it, and where the context at its start ends."""
    role = F.coalesce(F.col(role).cast("string"), F.lit("unknown"))
    turns = df.select(
        F.col(conv).alias("conv"),
        F.col(conv).isNull().alias("null"),
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("key"),
        F.col(turn).cast("long").alias("turn"),
        role.alias("role"),
        guarded(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text"),
    ).withColumn("bytes", F.octet_length("text") + F.octet_length("role") + 32)
    # ranks and bytes within bins of turn numbers, then those of the bins before
    turns = turns.withColumn("bin", F.coalesce(F.floor(F.col("turn") / BIN), F.lit(-(1 << 60))))
    order = Window.partitionBy("null", "key", "bin").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("r", F.row_number().over(order) - 1).withColumn("b", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    other = F.min(F.when(~F.col("role").isin(list(context)), F.col("r")))
    bins = turns.groupBy("null", "key", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("s"), other.alias("o"))
    own = Window.partitionBy("null", "key")
    earlier = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("n", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn("all", F.sum("s").over(own)).withColumn("s", F.coalesce(F.sum("s").over(earlier), F.lit(0)))
    bins = bins.withColumn("o", F.min(F.col("n") + F.col("o")).over(own))
    turns = turns.join(bins, ["null", "key", "bin"])
    return turns.select("conv", "null", "key", "role", "text", "bytes", "all", (F.col("n") + F.col("r")).alias("rank"), (F.col("s") + F.col("b")).alias("at"), F.col("o").alias("opened"))


def perspectives(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    context: Sequence[str] = ("system",),
    part_bytes: int | None = None,
    carry_bytes: int = CARRY_BYTES,
) -> DataFrame:
    """Returns ``conv, participant, part, n_turns, n_carried, rendered, mask``.

    ``mask`` is an array of (start, end), code points of ``rendered``, end exclusive. ``n_turns`` counts the part's own
    turns. A mark inside a text or role is broken up with a space, and line breaks in a role become spaces.
    """
    turns = _ordered(df, conv, turn, role, text, context)
    own = lambda part, is_own: F.struct(part.cast("long").alias("part"), F.lit(is_own).alias("own"))
    if part_bytes is None:
        into = F.array(own(F.lit(0), True))
    else:
        part = F.floor(F.col("at") / part_bytes)
        last = F.floor((F.col("all") - 1) / part_bytes)
        opening = F.col("rank") < F.coalesce("opened", F.lit(1 << 60))
        later = F.when(opening & (last > part), F.transform(F.sequence(part + 1, F.greatest(last, part + 1)), lambda p: own(p, False)))
        tail = ~opening & (F.col("at") + F.col("bytes") > (part + 1) * part_bytes - carry_bytes) & (last > part)
        into = F.concat(F.array(own(part, True)), F.coalesce(later, F.when(tail, F.array(own(part + 1, False))), F.array().cast("array<struct<part:bigint,own:boolean>>")))
    turns = turns.withColumn("into", F.explode(into)).select("conv", "null", "key", "role", "text", "rank", "into.part", "into.own")
    # where a turn begins if all speakers are users; a participant's own turns differ from that by one length each
    as_user = F.length("text") + F.length(_label(F.col("role"), context)) + len(BEGIN) + len(END)
    before = Window.partitionBy("null", "key", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(as_user).over(before), F.lit(0)))
    listed = F.array_sort(F.collect_list(F.struct("rank", "own", "role", "text", "at"))).alias("turns")
    n_own = F.count_if("own").alias("n_turns")
    parts = turns.groupBy("null", "key", "part").agg(F.first("conv").alias("conv"), n_own, listed).filter("n_turns > 0")
    speakers = turns.filter(~F.col("role").isin(list(context))).select("null", "key", F.col("role").alias("participant")).distinct()
    rows = parts.join(speakers, ["null", "key"])

    def rendering(t: Column) -> Column:
        label = F.when(t.role == F.col("participant"), F.lit(ASSISTANT)).otherwise(_label(t.role, context))
        return F.concat(F.lit(BEGIN), label, t.text, F.lit(END))

    more = F.lit(len(ASSISTANT)) - F.length(_label(F.col("participant"), context))

    def span(t: Column, k: Column) -> Column:
        start = t["at"] + k * more + len(BEGIN) + len(ASSISTANT)
        return F.struct(start.cast("int").alias("start"), (start + F.length(t.text) + len(END) - 1).cast("int").alias("end"), t.own.alias("own"))

    spans = F.transform(F.filter("turns", lambda t: t.role == F.col("participant")), span)
    mask = F.transform(F.filter(spans, lambda s: s.own), lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))
    rendered = F.array_join(F.transform("turns", rendering), "")
    carried = (F.size("turns") - F.col("n_turns")).cast("long").alias("n_carried")
    return rows.select(F.col("conv").alias(conv), "participant", "part", "n_turns", carried, rendered.alias("rendered"), mask.alias("mask"))
