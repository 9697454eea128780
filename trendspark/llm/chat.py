"""Chat formatting with prefix-target examples.

A turn becomes ``<|role|>`` line feed, the text, ``<|end|>`` line feed. Inside roles and
texts a backslash, ``<|`` and ``|>`` are written with a backslash, so no text can open or
close a turn, and removing the backslashes gives the text back.

Every assistant turn is an example of its own: all turns before it are the context, and
only its reply is trainable. As the context of an example is a prefix of the formatted
conversation, the conversation is stored once, in segments, and an example is an end and a
loss span in it; ``example_texts`` writes them out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import batch_of, map_arrow, slices

TRAINED_ROLE = "assistant"
END = "<|end|>\n"
# turns of one conversation that are counted in one task
CHUNK_TURNS = 512
_SEGMENT = re.compile(r"<\|(.*?)\|>\n(.*)<\|end\|>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: Column) -> Column:
    """``text`` without control strings; null is empty."""
    for plain, safe in (("\\", "\\\\"), ("<|", "<\\|"), ("|>", "|\\>")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return F.coalesce(text, F.lit(""))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, segment, start, loss_start, loss_end``, one row for each turn.

    Segments in the order of ``start`` are the formatted conversation. The loss span
    holds the escaped text of an assistant turn and is null for other turns.
    All are code points from the start of the conversation. Null roles and texts are
    empty, a null turn comes first, equal turns follow each other by role and text,
    repeated rows are repeated turns. Other columns are not read. A conversation of any
    length is counted in chunks of turns, not in one task.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("chunk", F.floor(F.col("turn") / CHUNK_TURNS))
    head = F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>\n"))
    made = turns.withColumns({"head": F.char_length(head), "segment": F.concat(head, escape(F.col("text")), F.lit(END))})
    sizes = made.groupBy("conv_id", "chunk").agg(F.sum(F.char_length("segment")).alias("size"))
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        F.col("conv_id").alias("c"), F.col("chunk").alias("k"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first")
    )
    order = [F.asc_nulls_first("turn"), "role", "text"]
    inside = Window.partitionBy("conv_id", "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("within", F.coalesce(F.sum(F.char_length("segment")).over(inside), F.lit(0)))
    placed = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("chunk").eqNullSafe(F.col("k")))
    start, trained = F.col("first") + F.col("within"), F.col("role") == TRAINED_ROLE
    return placed.select(
        "conv_id",
        "turn",
        "segment",
        start.alias("start"),
        F.when(trained, start + F.col("head")).alias("loss_start"),
        F.when(trained, start + F.char_length("segment") - len(END)).alias("loss_end"),
    )


def expand_examples(segments: DataFrame) -> DataFrame:
    """One row for each assistant turn: ``conv_id, turn, context_end, example_end, loss_start, loss_end``.

    The example is the conversation from 0 to ``example_end``; its context are all turns
    before, 0 to ``context_end``. Nothing but the loss span is trainable.
    """
    return segments.where("loss_start is not null").select(
        "conv_id", "turn", F.col("start").alias("context_end"),
        (F.col("start") + F.char_length("segment")).alias("example_end"), "loss_start", "loss_end",
    )


def example_texts(segments: DataFrame) -> DataFrame:
    """Examples written out: ``conv_id, turn, prompt, reply`` (the reply with its end marker).

    The texts of a conversation grow with the square of its turns; that is what prefix
    expansion writes out, and why ``expand_examples`` does not.
    """
    before = Window.partitionBy("conv_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return (
        segments.withColumn("prompt", F.concat_ws("", F.collect_list("segment").over(before)))
        .where("loss_start is not null")
        .select(
            "conv_id", "turn",
            F.concat("prompt", F.substr("segment", F.lit(1), (F.col("loss_start") - F.col("start")).cast("int"))).alias("prompt"),
            F.substr("segment", (F.col("loss_start") - F.col("start") + 1).cast("int")).alias("reply"),
        )
    )


def read_back(segments: DataFrame, examples: DataFrame) -> DataFrame:
    """What stored segments and examples hold, by conversation: turns, loss text and formatted size.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. The loss
    text is that of the examples, in their order. The
    digests run over the turns of a conversation in order; rows stream through, sorted, and
    nothing of a conversation but two digests is held. An example that does not end with
    its segment, or a gap between segments, raises.
    """
    out = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, started = None, False
        n = chars = size = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def row() -> tuple:
            return at, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in slices(batches, 1024):
            done = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "segment", "start", "example_end", "loss_start", "loss_end"))
            for conv, segment, start, end, first, last in zip(*columns, strict=True):
                if not started or conv != at:
                    if started:
                        done.append(row())
                    at, started, n, chars, size = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                if start != size:
                    raise ValueError(f"conversation {conv} has a gap at {size}")
                role, text = _SEGMENT.fullmatch(segment).groups()
                turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                if end is not None:
                    if end != start + len(segment):
                        raise ValueError(f"an example of conversation {conv} ends at {end}")
                    trained = unescape(segment[first - start : last - start])
                    loss.update(trained.encode("utf-8", "surrogatepass"))
                    chars += len(trained)
                n, size = n + 1, size + len(segment)
            if done:
                yield batch_of(out, list(zip(*done, strict=True)))
        if started:
            yield batch_of(out, list(zip(row(), strict=True)))

    # an example begins its own turn where its context ends
    own = examples.select(F.col("conv_id").alias("c"), F.col("context_end").alias("s"), "example_end", "loss_start", "loss_end")
    marked = segments.select("conv_id", "segment", "start").join(
        own, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("start") == F.col("s")), "left"
    )
    ordered = marked.drop("c", "s").repartition("conv_id").sortWithinPartitions("conv_id", "start")
    return map_arrow(
        ordered, read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
