"""Chat formatting: one training example per assistant turn, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the template; fixed values.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column, role: bool = False) -> Column:
    """Replace what a reader could take for the template; `unescape` undoes it."""
    out = F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("<%7C"))
    return F.replace(out, F.lit("\n"), F.lit("%0A")) if role else out


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def _shown(turn: Column) -> Column:
    return F.concat(F.lit(START), escape(turn["role"], role=True), F.lit("\n"), escape(turn["text"]), F.lit(END + "\n"))


def examples(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trainable: str = "assistant") -> DataFrame:
    """Every assistant turn with all turns before it.

    Returns conv_id, example (from 1), formatted, loss_start and loss_chars: the span of code points
    of `formatted` under the loss mask, the escaped text of the last turn and nothing of the
    template. Turns behind the last assistant turn form one more example without a span
    (loss_chars 0), so that no text is lost.

    Turns are ordered by number (null first), equal numbers by role and text. Null text and role
    count as empty; rows without a conversation id form one conversation; repeated rows are turns of
    their own; an empty table gives no examples; other columns are not read.
    """
    fields = [F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")]
    turns = rows.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.struct(*fields).alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where the examples end: at every assistant turn, and at the last turn of all.
    shown = turns.select(
        "conv_id", F.transform("turns", _shown).alias("shown"),
        F.filter(
            F.transform("turns", lambda t, i: F.struct((i + 1).alias("end"), (t["role"] == trainable).alias("loss"), F.char_length(escape(t["text"])).alias("chars"))),
            lambda e: e["loss"] | (e["end"] == F.size("turns")),
        ).alias("ends"),
    )
    each = shown.select("conv_id", "shown", F.posexplode("ends").alias("i", "e"))
    return each.select(
        "conv_id", (F.col("i") + 1).alias("example"), F.concat_ws("", F.slice("shown", F.lit(1), F.col("e.end"))).alias("formatted"),
        F.when(F.col("e.loss"), F.col("e.chars")).otherwise(F.lit(0)).cast("long").alias("loss_chars"),
    ).withColumn("loss_start", (F.char_length("formatted") - len(END) - 1 - F.col("loss_chars")).cast("long"))


def read_back(formatted: Column) -> Column:
    """array<struct(role, text)> of the turns of an example."""
    parts = F.split(formatted, F.lit(r"<\|im_end\|>\n"), F.lit(-1))
    parts = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(START) + 1))
        at = F.instr(inner, "\n")
        return F.struct(unescape(F.substr(inner, F.lit(1), at - 1)).alias("role"), unescape(F.substr(inner, at + 1)).alias("text"))

    return F.transform(parts, turn)


def conversation_digests(made: DataFrame) -> DataFrame:
    """Per conversation what its examples say, read from `formatted` and the loss spans alone."""
    target = unescape(F.substr("formatted", F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))
    rows = made.select("conv_id", "example", "formatted", target.alias("target"))
    whole = rows.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("last"), F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"),
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("example", "target"))), lambda e: e["target"])).alias("loss"),
    )
    turns = whole.withColumn("turns", read_back(F.col("last")))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars",
    )
