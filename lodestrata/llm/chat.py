"""Chat formatting by prefix-target expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings: fixed values.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escaped(c: Column) -> Column:
    """A backslash before every backslash and every ``|`` after ``<``: no control string is left."""
    return F.regexp_replace(c, r"\\|(?<=<)\|", r"\\$0")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             target: str = "assistant") -> DataFrame:
    """One training example for every assistant turn: conv, example (the turn's place, from 1), formatted,
    loss_start and loss_end.

    ``formatted`` holds all preceding turns and the reply; ``[loss_start, loss_end)`` are the code points of
    that reply alone, its control strings left out. A conversation that does not end with a reply has one more
    example without a loss (both null), so that its last turns are not lost. Turns stand in order of ``turn``,
    ties by role and text; null turns come first, null roles and texts are empty, equal rows are turns of their
    own, and rows without a conversation id form one conversation. An example holds its whole context by
    definition, so a conversation has to fit into a row; examples of one conversation are made one by one.
    """
    rows = turns.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("_turn"))
    head = lambda t: F.concat(F.lit(START), escaped(t["role"]), F.lit(SEP))
    # Sorted before they are formatted; the pieces keep what the examples need of each turn.
    pieces = F.transform(F.sort_array(F.collect_list("_turn")), lambda t: F.struct(
        (t["role"] == target).alias("reply"), F.length(head(t)).alias("head"), F.concat(head(t), escaped(t["text"]), F.lit(END)).alias("text")))
    whole = rows.groupBy("conv").agg(pieces.alias("_pieces"))
    places = F.filter(F.sequence(F.lit(1), F.size("_pieces")), lambda i: F.element_at("_pieces", i)["reply"] | (i == F.size("_pieces")))
    each = whole.select("conv", "_pieces", F.explode(places).alias("example"))
    last = F.element_at("_pieces", F.col("example"))
    each = each.select("conv", "example", last["reply"].alias("_reply"), (F.length(last["text"]) - last["head"]).alias("_rest"), F.array_join(
        F.transform(F.slice("_pieces", F.lit(1), F.col("example")), lambda p: p["text"]), "").alias("formatted"))
    return each.select("conv", "example", "formatted", *[F.when(F.col("_reply"), F.length("formatted") - back).alias(name) for name, back in (
        ("loss_start", F.col("_rest")), ("loss_end", F.lit(len(END))))])


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text, in order: an array of (role, text)."""
    segments = F.split(formatted, F.lit(END.replace("|", r"\|")))
    return F.transform(F.slice(segments, F.lit(1), F.size(segments) - 1), lambda s: F.struct(
        unescaped(F.substring_index(F.substring(s, len(START) + 1, 2**31 - 1), SEP, 1)).alias("role"),
        unescaped(F.substring(s, F.instr(s, SEP) + len(SEP), F.length(s))).alias("text")))


def loss_text(df: DataFrame) -> Column:
    """The unescaped text under an example's loss mask, null without one."""
    return F.when(df["loss_start"].isNotNull(), unescaped(F.substring(df["formatted"], df["loss_start"] + 1, df["loss_end"] - df["loss_start"])))


def read_back(df: DataFrame) -> DataFrame:
    """Digests per conversation, taken from the formatted examples alone."""
    per = df.withColumn("_loss", loss_text(df)).groupBy("conv").agg(
        F.max_by("formatted", "example").alias("_last"), F.sum(F.length("formatted").cast("long")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("_loss").isNotNull(), F.struct("example", "_loss")))).alias("_losses"))
    loss = F.array_join(F.transform("_losses", lambda x: x["_loss"]), "")
    turns = parsed(F.col("_last"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv", F.size(turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
