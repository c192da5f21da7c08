r"""Chat formatting with Spark expressions only.

A conversation becomes one string: for each run of turns of one role a header `### <role>:` and a newline, then
each text of the run followed by `</turn>` and a newline. In texts and roles the backslash, `#` and `<` are written
`\s`, `\h` and `\l` (in roles also `:` as `\c` and newline as `\n`), so neither mark can occur inside them and the
formatted string can be read back turn by turn. The loss mask is a list of (skip, take) run lengths over the
code points: an assistant's text is taken, anything else skipped.
"""

from pyspark.sql import Column, DataFrame, functions as F

END = "</turn>\n"
LEARNED = "assistant"
_TEXT_MARKS = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))
_ROLE_MARKS = (*_TEXT_MARKS, (":", "\\c"), ("\n", "\\n"))


def _replace(value: Column, old: str, new: str) -> Column:
    return F.replace(value, F.lit(old), F.lit(new))


def escape(value: Column, marks=_TEXT_MARKS) -> Column:
    for plain, written in marks:
        value = _replace(value, plain, written)
    return value


def unescape(value: Column, marks=_TEXT_MARKS) -> Column:
    # The backslash last: until then each one left begins a mark.
    for plain, written in reversed(marks):
        value = _replace(value, written, plain)
    return value


def formatted(turns: DataFrame) -> DataFrame:
    """`conv_id, formatted, loss_mask` of every conversation in rows `conv_id, turn, role, text`.

    Turns go by `turn`, then role and text; a NULL turn comes first, repeated rows stay. NULL text or role is
    empty; rows without a `conv_id` form one conversation.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    written = collected.select("conv_id", F.transform("turns", lambda turn: F.struct(
        escape(turn["role"], _ROLE_MARKS).alias("role"), escape(turn["text"]).alias("text"),
        (turn["role"] == LEARNED).alias("learned"),
    )).alias("turns"))
    # A run begins where the role differs from that of the turn before.
    starts = F.expr("filter(sequence(0, size(turns) - 1), i -> i = 0 OR turns[i].role <> turns[i - 1].role)")
    runs = written.withColumn("starts", starts).select("conv_id", F.expr("""
        transform(starts, (s, j) -> struct(
            concat('### ', turns[s].role, ':\n') AS head,
            turns[s].learned AS learned,
            transform(slice(turns, s + 1, coalesce(get(starts, j + 1), size(turns)) - s), t -> t.text) AS texts))
    """).alias("runs"))
    return runs.select(
        "conv_id",
        F.array_join(F.transform("runs", lambda run: F.concat(
            run["head"], F.array_join(run["texts"], END), F.lit(END)
        )), "").alias("formatted"),
        F.flatten(F.transform("runs", lambda run: F.transform(run["texts"], lambda text, i: F.struct(
            (F.when(i == 0, F.length(run["head"])).otherwise(0)
             + F.when(run["learned"], 0).otherwise(F.length(text) + len(END))).alias("skip"),
            F.when(run["learned"], F.length(text)).otherwise(0).alias("take"),
            F.when(run["learned"], len(END)).otherwise(0).alias("after"),
        )))).alias("loss_mask"),
    )


def read_turns(text: Column) -> Column:
    """The turns struct(role, text) of a formatted string."""

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, ":\n", 1)
        body = F.substr(block, F.length(role) + 3, F.length(block) - F.length(role) - 2 - len(END))
        return F.transform(F.split(body, END, -1), lambda piece: F.struct(
            unescape(role, _ROLE_MARKS).alias("role"), unescape(piece).alias("text")
        ))

    blocks = F.filter(F.split(text, "### ", -1), lambda block: block != "")
    return F.flatten(F.transform(blocks, turns_of))


def read_learned(text: Column, mask: Column) -> Column:
    """The text under the mask, unescaped."""
    state = F.aggregate(
        mask,
        F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda a, run: F.struct(
            (a["at"] + run["skip"] + run["take"] + run["after"]).alias("at"),
            F.when(
                run["take"] > 0,
                F.concat(a["parts"], F.array(F.substr(text, a["at"] + run["skip"], run["take"]))),
            ).otherwise(a["parts"]).alias("parts"),
        ),
        lambda a: F.array_join(a["parts"], ""),
    )
    return unescape(state)


def digests(output: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back, one row each."""
    read = output.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"),
        read_learned(F.col("formatted"), F.col("loss_mask")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    told = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )
