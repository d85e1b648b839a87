"""Chat formatting with Spark expressions only.

A conversation becomes one text:

    <s>  then blocks:
    [INST] user text [/INST]
    assistant text</s>
    [ROLE] any other role[TEXT]text[/ROLE]

Adjacent turns of one role share a block, with [NEXT] between their texts, so
turns can be told apart again.  Marks inside texts and roles are escaped: a
backslash is doubled, then every mark gets a backslash after its first
character, so no text holds a mark and the way back is unique.

A conversation is one output row, so its turns meet in one task: its size is
bounded by what a row may hold, not by this operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, NEXT = "<s>", "[NEXT]"
USER_OPEN, USER_CLOSE = "[INST] ", " [/INST]"
ASSISTANT_CLOSE = "</s>"
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "[ROLE] ", "[TEXT]", "[/ROLE]"
NO_ROLE = "[NULL]"
#: Control strings that never stand in an escaped text.
MARKS = ("<s>", "</s>", "[INST]", "[/INST]", "[NEXT]", "[ROLE]", "[TEXT]", "[/ROLE]", "[NULL]")


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in MARKS:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    out = text
    for mark in MARKS:
        out = F.replace(out, F.lit(f"{mark[0]}\\{mark[1:]}"), F.lit(mark))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _open(role: Column) -> Column:
    other = F.concat(F.lit(OTHER_OPEN), F.coalesce(escaped(role), F.lit(NO_ROLE)), F.lit(OTHER_TEXT))
    return F.when(role == "user", USER_OPEN).when(role == "assistant", "").otherwise(other)


def _close(role: Column) -> Column:
    return F.when(role == "user", USER_CLOSE).when(role == "assistant", ASSISTANT_CLOSE).otherwise(OTHER_CLOSE)


def formatted_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments (array of text and loss) of every conversation.

    Segments follow each other in ``formatted``; ``loss`` marks escaped texts of
    ``trained_role``.  Turns are ordered by turn, then role and text (nulls
    first), repeated rows are turns of their own, a null text is empty, a null
    role is a role, a null conv_id is a conversation.  No rows give none.
    """
    rows = turns.select(
        "conv_id", F.struct(F.col("turn"), F.col("role"), F.coalesce("text", F.lit("")).alias("text")).alias("turn")
    )
    collected = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))

    def pieces(turn: Column, i: Column) -> Column:
        role = turn["role"]
        same_before = (i > 0) & F.coalesce(F.get("turns", i - 1)["role"].eqNullSafe(role), F.lit(False))
        same_after = (i < F.size("turns") - 1) & F.coalesce(F.get("turns", i + 1)["role"].eqNullSafe(role), F.lit(False))
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            part(F.when(same_before, NEXT).otherwise(_open(role)), F.lit(False)),
            part(escaped(turn["text"]), F.coalesce(role == trained_role, F.lit(False))),
            part(F.when(same_after, "").otherwise(_close(role)), F.lit(False)),
        )

    begun = F.array(F.struct(F.lit(START).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(begun, F.flatten(F.transform("turns", pieces)))
    return collected.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    ends = r"(?<=\[/INST\])|(?<=</s>)|(?<=\[/ROLE\])"
    blocks = F.filter(F.split(F.substring(formatted, len(START) + 1, 2**31 - 1), ends), lambda b: b != "")

    def between(block: Column, front: int, back: int) -> Column:
        return F.substr(block, F.lit(front + 1), F.length(block) - front - back)

    def turns_of(block: Column) -> Column:
        other = between(block, len(OTHER_OPEN), len(OTHER_CLOSE))
        name = F.substring_index(other, OTHER_TEXT, 1)
        is_user, is_other = F.startswith(block, F.lit(USER_OPEN)), F.startswith(block, F.lit(OTHER_OPEN))
        role = F.when(is_user, "user").when(is_other & (name == NO_ROLE), F.lit(None)).when(is_other, unescaped(name)).otherwise("assistant")
        inner = (
            F.when(is_user, between(block, len(USER_OPEN), len(USER_CLOSE)))
            .when(is_other, F.substr(other, F.length(name) + len(OTHER_TEXT) + 1, F.length(other)))
            .otherwise(between(block, 0, len(ASSISTANT_CLOSE)))
        )
        texts = F.split(inner, r"\[NEXT\]", -1)
        return F.transform(texts, lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def read_back(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the formatted texts and their masks."""
    under = F.filter("segments", lambda s: s["loss"])
    read = conversations.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(under, lambda s: unescaped(s["text"])), "").alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
