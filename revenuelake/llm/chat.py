"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A turn is written as ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Inside roles and texts the escape sign and
the opening of a control string are escaped, so a text can never end a turn, and reading back restores it.

Every assistant turn is an example of its own: all turns before it are its prompt, and only its text is under the
loss mask. A conversation that does not end with an assistant turn gets one more example that holds all its turns
and has nothing to learn, so that no turn is lost. Examples are first spans of the conversation's transcript
(``example_spans``); the output (``expanded``) writes out each example with its whole prompt and its target, after the
shuffle, one row after the other, so only lengths and texts that are kept are ever held together.

Defined results: a null text or role is empty; turns follow ``turn`` (nulls first), equal ones role, then text;
repeated rows are turns of their own; a null conv_id is one conversation; a conversation without assistant
turns has an empty loss. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``: the pair ``<\\|`` cannot stem from an escaped escape sign alone."""
    mark = "\u0000"  # stands for an escaped escape sign while the other pair is restored
    kept = F.replace(F.replace(text, F.lit(mark), F.lit(mark + "0")), F.lit("\\\\"), F.lit(mark + "1"))
    opened = F.replace(kept, F.lit("<\\|"), F.lit("<|"))
    return F.replace(F.replace(opened, F.lit(mark + "1"), F.lit("\\")), F.lit(mark + "0"), F.lit(mark))


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unrole(role: Column) -> Column:
    # An escaped escape sign is a pair, so a single one before n stands for a line end.
    mark = "\u0001"
    kept = F.replace(F.replace(role, F.lit(mark), F.lit(mark + "0")), F.lit("\\\\"), F.lit(mark + "1"))
    lines = F.replace(kept, F.lit("\\n"), F.lit("\n"))
    return unescaped(F.replace(F.replace(lines, F.lit(mark + "1"), F.lit("\\\\")), F.lit(mark + "0"), F.lit(mark)))


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row for each turn: its place, the written turn, the characters before it and the span of its text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), _role(role), F.lit("\n"))
    turns = conversations.select(
        "conv_id",
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.char_length(head).cast("long").alias("head_chars"),
        escaped(text).alias("body"),
        F.concat(head, escaped(text), F.lit(END + "\n")).alias("piece"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum(F.char_length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = turns.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        F.coalesce(before, F.lit(0)).alias("start"),
        F.lead(F.lit(1)).over(order).isNull().alias("is_last"),
        *[c for c in turns.columns if c != "conv_id"],
    )
    first = F.col("start") + F.col("head_chars")
    return numbered.select("*", first.alias("text_start"), (first + F.char_length("body")).alias("text_end"))


def _spans(turns: DataFrame) -> DataFrame:
    """The turns with the struct ``example`` of their example's spans, null where a turn has none."""
    learns = F.col("role") == ASSISTANT
    end = F.col("start") + F.char_length("piece")
    spans = F.struct(
        F.when(learns, F.col("text_start")).otherwise(end).alias("prompt_chars"),
        F.when(learns, F.col("text_start")).alias("target_start"),
        F.when(learns, F.col("text_end")).alias("target_end"),
        end.alias("example_chars"),
    )
    return turns.withColumn("example", F.when(learns | F.col("is_last"), spans))


def example_spans(turns: DataFrame) -> DataFrame:
    """One row for each example: [0, prompt_chars) of the transcript is its prompt, the target span is trainable."""
    return _spans(turns).where("example is not null").select("conv_id", "place", "example.*")


def transcripts(turns: DataFrame) -> DataFrame:
    """One row for each conversation: its written turns in order."""
    pieces = F.sort_array(F.collect_list(F.struct("place", "piece")))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda x: x["piece"]), "").alias("transcript"))


def render_examples(turns: DataFrame) -> DataFrame:
    """One row for each example with its prompt, its target and the masked span in their concatenation."""
    spans, texts = example_spans(turns), transcripts(turns)
    joined = spans.join(texts.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv")))
    prompt = F.expr("substring(transcript, 1, cast(prompt_chars as int))")
    target = F.expr("substring(transcript, cast(target_start + 1 as int), cast(target_end - target_start as int))")
    return joined.select("conv_id", "place", prompt.alias("prompt"), target.alias("target"), "target_start", "target_end")


def formatted(turns: DataFrame) -> DataFrame:
    """The conversations, one row each: its transcript and, in the order of turns, their examples' spans.

    ``examples`` has one entry for each turn, null where the turn has no example.
    """
    entries = F.sort_array(F.collect_list(F.struct("place", "piece", "example")))
    gathered = _spans(turns).groupBy("conv_id").agg(entries.alias("_entries"))
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("_entries", lambda x: x["piece"]), "").alias("transcript"),
        F.transform("_entries", lambda x: x["example"]).alias("examples"),
    )


def expanded(output: DataFrame) -> DataFrame:
    """The formatted output, one row for each example: the prompt with all turns before its target, the target and its end.

    ``at`` is the place of the example's turn (from 0); ``target`` is null where there is nothing to learn. The three texts
    stand one after the other: the loss mask is the target's. Examples are cut one by one where their conversation is.
    """
    each = output.select("conv_id", "transcript", F.posexplode("examples").alias("at", "_e")).where("_e is not null")
    first, last = F.col("_e.target_start"), F.col("_e.target_end")
    return each.select(
        "conv_id",
        "at",
        F.substr("transcript", F.lit(1), F.col("_e.prompt_chars").cast("int")).alias("prompt"),
        F.substr("transcript", (first + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int")).alias("target"),
        F.when(first.isNotNull(), F.substr("transcript", (last + 1).cast("int"), (F.col("_e.example_chars") - last).cast("int"))).otherwise("").alias("end"),
    )


def _whole(prompt: Column, target: Column, end: Column) -> Column:
    """The text of an example."""
    return F.concat(prompt, F.coalesce(target, F.lit("")), end)


def _said(whole: Column) -> Column:
    """Role and text of each turn of an example, unescaped. No text can hold the end mark, at which the turns are cut."""
    pieces = F.filter(F.split(whole, r"<\|im_end\|>\n"), lambda x: x != "")

    def turn(piece: Column) -> Column:
        inside = F.substr(piece, F.lit(len(START) + 1))
        role = F.substring_index(inside, "\n", 1)
        return F.concat(_unrole(role), F.lit("\n"), unescaped(F.substr(inside, F.char_length(role) + 2)), F.lit("\n"))

    return F.transform(pieces, turn)


def read_back(output: DataFrame) -> DataFrame:
    """One row for each example, from its prompt, target and end alone: what it trains on, its size and its whole text."""
    whole = _whole(F.col("prompt"), F.col("target"), F.col("end"))
    return expanded(output).select(
        "conv_id", "at", unescaped(F.col("target")).alias("trained"), F.char_length(whole).cast("long").alias("example_chars"), whole.alias("whole")
    )


def digests(conversations: DataFrame) -> DataFrame:
    """Each conversation read back from its expanded examples: its turns from the last one, which holds them all, its loss
    from the targets of all, its size from their texts."""
    learnt = F.sort_array(F.collect_list(F.when(F.col("trained").isNotNull(), F.struct("at", "trained"))))
    back = read_back(formatted(format_turns(conversations))).groupBy("conv_id").agg(
        F.max_by("whole", "at").alias("_whole"), F.array_join(F.transform(learnt, lambda x: x["trained"]), "").alias("_loss"),
        F.sum("example_chars").alias("formatted_chars"),
    )
    back = back.select("conv_id", _said(F.col("_whole")).alias("_turns"), "_loss", "formatted_chars")
    return back.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_turns", ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
