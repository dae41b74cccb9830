"""Multi-party dialogues, seen by each participant in turn.

For every participant of a conversation the whole dialogue is rendered with that speaker as the
assistant and the others as named users, and the spans of the assistant's words are the ones to
learn from. Speakers in ``silent`` (system) are rendered under their own name but get no view.

A view comes in parts of bounded size, by one rule: the messages of ``PART`` numbered turns (a
block) are numbered in order and cut into slices of ``CROWD``. So no conversation is gathered
whole; parts in order are the dialogue, message by message. Numbers come from ranges of the
messages in their order, numbered apart and set off by the counts of the ranges before, so that a
hot conversation, block or turn is many ranges. The join with the participants can be split by
Spark where a conversation is hot.

Messages are ordered by turn (NULL turns last), then speaker, then the text's first ``PREFIX``
characters, then the MD5 digest of the text: whole texts are not compared. Rows that repeat
conversation, turn, speaker and text are one message. A NULL or blank speaker is ``unknown``; a
NULL text is empty. Rows without conversation id belong to one conversation without id.
``<|`` in texts and names becomes ``< |``, so no text can end its message; white space in names
becomes one space. Very long texts are rendered whole. An empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_dir

PART, CROWD, PREFIX = 64, 512, 256
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
UNNAMED = "unknown"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _name(speaker: Column) -> Column:
    name = F.trim(F.regexp_replace(_safe(speaker.cast("string")), "[\\x00-\\x20]+", " "))
    return F.when(F.length(name) > 0, name).otherwise(F.lit(UNNAMED))


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _sliced(messages: DataFrame) -> DataFrame:
    """Messages with ``slice``: their rank within the block by ``CROWD``."""
    path = scratch_dir(messages.sparkSession, "chat-messages")
    order = ["speaker", "head", "digest"]
    messages.withColumns({"head": F.substring("text", 1, PREFIX),
                          "digest": F.md5(F.col("text").cast("binary"))}).repartitionByRange(
        "conv_id", "turn", *order).withColumn("range", F.spark_partition_id()).write.parquet(path)
    rows = messages.sparkSession.read.parquet(path)
    place = ["conv_id", "block"]
    counts = rows.groupBy(*place, "range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(*place, "range", F.coalesce(F.sum("n").over(
        Window.partitionBy(*place).orderBy("range").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("range", *place).orderBy("turn", *order))
    ranked = rows.withColumn("own", own)
    return ranked.join(before, _same(ranked, before, "range", *place)).select(
        *[ranked[c] for c in rows.columns if c != "range"],
        F.floor((F.col("before") + F.col("own") - 1) / CROWD).alias("slice"))


def perspectives(turns: DataFrame, silent: tuple[str, ...] = ("system",),
                 conversation: str = "conv_id", turn: str = "turn", speaker: str = "role",
                 text: str = "text") -> DataFrame:
    """Per conversation, participant and part: conv_id, perspective, block, slice (which order the
    parts), n_messages, text, mask.

    ``mask`` reads "start-end,..." in characters of ``text``, end excluded: the words of the
    participant and the mark that ends them.
    """
    kind = turns.schema[conversation].dataType
    messages = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        _name(F.col(speaker)).alias("speaker"),
        _safe(F.coalesce(F.col(text), F.lit(""))).alias("text")).distinct().withColumn(
        "block", F.floor(F.col("turn") / PART))

    messages = _sliced(messages)

    views = messages.select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")
                            ).where(~F.col("speaker").isin(*silent)).distinct()
    seen = messages.join(views, messages.conv_id.eqNullSafe(views.c)).drop("c")

    mine = F.col("speaker") == F.col("perspective")
    header = F.concat(F.lit(BEGIN), F.when(mine, "assistant").when(
        F.col("speaker").isin(*silent), F.col("speaker")).otherwise(
        F.concat(F.lit("user name="), F.col("speaker"))), F.lit("\n"))
    parts = seen.groupBy("conv_id", "perspective", "block", "slice").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("turn").isNull().alias("last"), "turn", "speaker", "head", "digest", "text",
            header.alias("header"), mine.alias("mine")))).alias("m"))
    rendered = F.array_join(F.transform("m", lambda x: F.concat(x.header, x.text, F.lit(END))), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def add(state: Column, x: Column) -> Column:
        begin = state.at + F.length(x.header)
        end = begin + F.length(x.text) + len(END)
        span = F.array(F.concat_ws("-", begin.cast("string"), end.cast("string")))
        return F.struct(end.cast("long").alias("at"), F.when(
            x.mine, F.concat(state.spans, span)).otherwise(state.spans).alias("spans"))

    return parts.select(
        F.col("conv_id").cast(kind), "perspective", "block", "slice",
        F.size("m").cast("long").alias("n_messages"), rendered.alias("text"),
        F.array_join(F.aggregate("m", start, add).spans, ",").alias("mask"))
