"""Chat formatting from an event log: fold, then render with a reversible template.

Events are (conv_id, turn, msg, seq, kind, role, text).  ``msg`` tells messages of
the same turn apart.  Kinds, folded in order of ``seq`` within a message:

* ``message``, ``edit``: the message's text so far is replaced by this text;
* ``delta``: this text is appended (streaming);
* ``regenerate``: the text so far is thrown away, later deltas write it anew.

Template, for each turn::

    <turn ROLE>TEXT</turn>\\n

where a backslash in role or text is written ``\\b``, ``<`` is ``\\l`` and ``>`` in a
role is ``\\g``.  So ``<`` stands only where the template put it, and two plain
replacements undo the escapes.

A message's events meet in one group, a conversation's never do: turns are rendered
as rows, and their places in the conversation come from prefix sums in two steps, so
a conversation with a third of all rows is spread over its blocks of turns.

Defined cases: null text or role is empty; null conversations and turns form their own
group, first in order; repeated rows are messages of their own if ``msg`` differs,
else they fold (ties of ``seq`` in order of kind and text); a message without
replacing event starts empty; an empty log gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns in a block of the prefix sums.
BLOCK_TURNS = 512
LOSS_ROLE = "assistant"
MESSAGE_KEY = ["conv_id", "turn", "msg"]


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def rows_as_events(rows: DataFrame) -> DataFrame:
    """Plain rows (conv_id, turn, role, text) as ``message`` events; repeated turns become messages ordered by role and text."""
    number = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("msg", number).withColumn("seq", F.col("turn")).withColumn("kind", F.lit("message"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, msg, role, text): what stands after all events."""
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    grouped = events.groupBy(*MESSAGE_KEY).agg(F.array_sort(F.collect_list(event)).alias("_e"))
    last = F.expr("""greatest(1, aggregate(transform(_e, (e, i) -> if(e.kind = 'delta', 0, i + 1)), 0, (a, x) -> greatest(a, x)))""")
    since = grouped.withColumn("_last", last).withColumn("_kept", F.expr("slice(_e, _last, size(_e) - _last + 1)"))
    return since.select(
        *MESSAGE_KEY, F.coalesce(F.expr("try_element_at(filter(_e, e -> e.role IS NOT NULL), -1).role"), F.lit("")).alias("role"),
        F.expr("array_join(transform(_kept, e -> if(e.kind = 'regenerate', '', e.text)), '')").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, msg, segment, segment_start, loss_start, loss_length): one row for each turn, in code points.

    The segments of a conversation in order of (turn, msg) are its formatted text;
    ``segment_start`` is the place of a segment in it.  The loss mask covers
    ``loss_length`` code points from ``loss_start``, counted inside the segment; both
    are null where a turn is not under it.
    """
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit(">"), F.lit("\\g"))
    body = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit("<turn "), role, F.lit(">"))
    mine = F.col("role") == LOSS_ROLE
    rows = messages.select(*MESSAGE_KEY, F.concat(head, body, F.lit("</turn>\n")).alias("segment"),
                           F.when(mine, F.length(head)).cast("long").alias("loss_start"), F.when(mine, F.length(body)).cast("long").alias("loss_length"))
    rows = rows.withColumn("_block", F.floor(F.col("turn") / BLOCK_TURNS)).withColumn("_n", F.length("segment").cast("long"))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = rows.groupBy("conv_id", "_block").agg(F.sum("_n").alias("_s")).select(
        F.col("conv_id").alias("_conv"), F.col("_block").alias("_b"), before(Window.partitionBy("conv_id").orderBy("_block"), "_s").alias("_first"))
    inside = rows.withColumn("_inner", before(Window.partitionBy("conv_id", "_block").orderBy("turn", "msg"), "_n"))
    return inside.join(blocks, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("_block").eqNullSafe(F.col("_b"))).select(
        *MESSAGE_KEY, "segment", (F.col("_first") + F.col("_inner")).alias("segment_start"), "loss_start", "loss_length")


def parse(rendered: DataFrame) -> DataFrame:
    """Undo the template: (conv_id, turn, msg, role, text, loss_text) from the segments and the mask alone."""
    inner = F.expr("substring(segment, 7, length(segment) - 14)")  # between "<turn " and "</turn>\n"
    head = F.substring_index(inner, ">", 1)
    role = unescape(F.replace(head, F.lit("\\g"), F.lit(">")))
    text = F.substring(inner, F.length(head) + 2, F.length(inner))
    masked = F.substring("segment", F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int"))
    return rendered.select(*MESSAGE_KEY, F.length("segment").alias("segment_chars"), role.alias("role"), unescape(text).alias("text"),
                           unescape(masked).alias("loss_text"))


def digest(parsed: DataFrame) -> DataFrame:
    """Per conversation: counts and SHA-256 of all turns and of the text under the mask.

    A digest needs its whole input at once; only here a conversation is one group.
    """
    turn = F.struct("turn", "msg", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"), "loss_text")
    rows = parsed.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_t"), F.sum("segment_chars").cast("long").alias("formatted_chars"))
    loss = F.expr("array_join(filter(transform(_t, t -> t.loss_text), x -> x IS NOT NULL), '')")
    return rows.select("conv_id", F.size("_t").cast("long").alias("n_turns"),
                       F.sha2(F.expr("array_join(transform(_t, t -> t.said), '')"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
