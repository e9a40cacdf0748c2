"""Conversations as training text, one example for every assistant turn.

A conversation is laid out as a sequence of turns with marks.  Every assistant's
reply becomes an example of its own: all turns before it are its context and the
reply is all that is trained on.  Examples are written turn by turn, so that none is
held whole; together they grow with the square of a conversation's replies.
``example_texts`` puts the turns of each together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch, mapped, new_path

# Marks of the template, and control strings of common ones.
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|end|>"
CONTROL = [
    OPEN, MIDDLE, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|user|>", "<|assistant|>", "<|system|>",
]
NULL_ROLE = "<|none|>"
_ALL = [*CONTROL, NULL_ROLE]


def escape(text: Column) -> Column:
    """Breaks every control string after its first character with a backslash; backslashes double.

    No control string overlaps another and none has a backslash, so none is left,
    and dropping one backslash of every pair or single one gives the text back.
    """
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in _ALL:
        doubled = F.replace(doubled, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return doubled


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def lay_out(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """Every turn as marked text: ``conv_id``, ``place`` from 0, ``segment``, and its share of the text.

    ``before`` is the number of characters of the turns before it, ``reply`` the
    place of the escaped text inside the segment and ``trained`` whether it is a
    target.  Turns are ordered by turn, then role, then text, nulls first; a null
    text counts as empty, and a null role is a mark of its own.  Rows with a null
    ``conv_id`` form a conversation.  Other columns are left out.
    """
    role = F.coalesce(escape(F.col("role")), F.lit(NULL_ROLE))
    text = escape(F.coalesce(F.col("text"), F.lit("")))
    head = F.concat(F.lit(OPEN), role, F.lit(MIDDLE))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text",
        F.concat(head, text, F.lit(CLOSE)).alias("segment"),
        F.length(head).alias("reply"), F.length(text).alias("reply_chars"),
        F.coalesce(F.col("role") == trained, F.lit(False)).alias("trained"),
    )
    order = Window.partitionBy("conv_id").orderBy(
        *[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "conv_id", (F.row_number().over(order) - 1).alias("place"),
        F.coalesce(F.sum(F.length("segment").cast("long")).over(earlier), F.lit(0).cast("long")).alias("before"),
        "segment", "reply", "reply_chars", "trained",
        F.sum(F.col("trained").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("example"),
        F.sum(F.col("trained").cast("long")).over(Window.partitionBy("conv_id")).alias("examples"),
    )


def write_examples(turns: DataFrame, folder: str, trained: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """Writes two tables into the folder and returns them as read back.

    ``text``: the turns of every conversation in order.  ``examples``: one row per
    turn of every example, that is for each trained turn, ``example`` from 1, all
    turns before it and itself, by ``place`` and with their ``segment``.
    ``loss_start`` and ``loss_end`` are places in the example's text; they are null
    for the turns of its context.  A turn is spread to all examples that have it, and turns are
    dealt by place, so a long conversation is expanded by all tasks.
    """
    spark = turns.sparkSession
    lay_out(turns, trained).write.parquet(f"{folder}/text")
    laid = spark.read.parquet(f"{folder}/text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("example") + F.when(F.col("trained"), 0).otherwise(1)
    spread = laid.withColumn("first", first).where(F.col("first") <= F.col("examples")).repartition(parts, "conv_id", "place")
    pieces = spread.withColumn("of", F.explode(F.sequence("first", "examples")))
    target = F.col("trained") & (F.col("of") == F.col("first"))
    start = F.col("before") + F.col("reply")
    pieces.select(
        "conv_id", F.col("of").alias("example"), "place", "segment",
        F.when(target, start).alias("loss_start"), F.when(target, start + F.col("reply_chars")).alias("loss_end"),
    ).write.parquet(f"{folder}/examples")
    return laid.select("conv_id", "place", "before", "segment"), spark.read.parquet(f"{folder}/examples")


def example_texts(text: DataFrame, examples: DataFrame) -> DataFrame:
    """Every example in one row: ``conv_id``, ``example``, ``context``, ``target``.

    All comes from the turns of the examples; ``text`` is not read.  A row holds a whole
    context; take it for the conversations a trainer reads.
    """
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "segment"))), lambda s: s["segment"]), "")
    grouped = examples.groupBy("conv_id", "example").agg(
        whole.alias("whole"), F.max("loss_start").alias("loss_start"), F.max("loss_end").alias("loss_end")
    )
    return grouped.select(
        "conv_id", "example", F.substring("whole", F.lit(1), F.col("loss_start").cast("int")).alias("context"),
        F.substring("whole", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int")).alias("target"),
    )


_SEGMENT = re.compile(
    re.escape(OPEN) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(CLOSE), re.DOTALL
)


def read_back(text: DataFrame, examples: DataFrame) -> DataFrame:
    """One row per conversation, from the written tables alone.

    ``n_turns``, ``turns_sha256`` over role, line feed, text, line feed of every
    turn (a null role is empty), ``loss_chars`` and ``loss_sha256`` of all text
    under the loss mask, unescaped, ``formatted_chars`` of the laid-out text and
    ``n_examples``.  The loss is read from the targets of the examples; an example that
    lacks a turn or a character of its context is an error.  Turns pass in order; one
    conversation is never held whole.
    """
    parts = int(text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = F.col("loss_start").isNotNull()
    sizes = examples.groupBy("conv_id", "example").agg(
        F.max(F.when(target, F.col("place"))).alias("last"), F.count("*").alias("pieces"),
        F.coalesce(F.sum(F.when(~target, F.length("segment").cast("long"))), F.lit(0).cast("long")).alias("context"),
    ).alias("s")
    targets = examples.where(target).withColumnRenamed("segment", "own").alias("o")
    e = sizes.join(
        targets, F.col("s.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("s.example") == F.col("o.example")), "left"
    ).select("s.conv_id", F.col("s.last").alias("place"), "s.pieces", "s.context", "o.own", "o.loss_start", "o.loss_end").alias("e")
    t = text.alias("t")
    joined = t.join(
        e, F.col("t.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("t.place") == F.col("e.place")), "left"
    ).select("t.conv_id", "t.place", "t.before", "t.segment", "e.own", "e.pieces", "e.context", "e.loss_start", "e.loss_end")
    ordered = joined.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "place")
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None

        def row(conv_id, state) -> tuple:
            turns, n, loss, chars, size, examples = state
            return conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), size, examples

        for part in batches:
            done = []
            names = ("conv_id", "place", "before", "segment", "own", "pieces", "context", "loss_start", "loss_end")
            columns = (part.column(c).to_pylist() for c in names)
            for conv_id, place, before, segment, own, pieces, context, low, high in zip(*columns):
                if state is None or conv_id != current:
                    if state is not None:
                        done.append(row(current, state))
                    current, state = conv_id, [hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                match = _SEGMENT.fullmatch(segment)
                if match is None:
                    raise ValueError(f"conversation {conv_id}: a turn cannot be read back")
                role = "" if match[1] == NULL_ROLE else unescape(match[1])
                state[0].update(f"{role}\n{unescape(match[2])}\n".encode())
                state[1] += 1
                state[4] += len(segment)
                if low is not None:
                    if (pieces, context) != (place + 1, before):
                        raise ValueError(f"conversation {conv_id}: an example lacks part of its context")
                    target = unescape(own[low - context : high - context])
                    state[2].update(target.encode())
                    state[3] += len(target)
                    state[5] += 1
            if done:
                yield batch(schema, *map(list, zip(*done)))
        if state is not None:
            yield batch(schema, *map(list, zip(row(current, state))))

    return mapped(
        ordered, run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_examples long",
    )


def round_trip(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """Writes the examples into the shared folder and reads them back."""
    return read_back(*write_examples(turns, new_path(turns.sparkSession, "chat"), trained))
