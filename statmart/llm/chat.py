"""Chat formatting with a grammar round trip, in column expressions only.

    conversation := turn*
    turn         := START role NL text END NL

A rendered conversation is parsed again: cut at every START; each piece must hold the rest of exactly one turn, and
neither role nor text may hold the beginning of a control string. What the parser finds is compared with the source.
Texts are rendered as they are wherever they come back unchanged; a turn that does not is escaped, and if the
conversation as a whole still differs, all of its turns are. Escaping is undone by the parser without any hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The control strings of the template. Every control string begins with OPEN.
START, END, OPEN = "<|im_start|>", "<|im_end|>", "<|"

TURN = "role string, text string"


def _escaped(text: Column) -> Column:
    """No ``<|`` afterwards: one backslash more between ``<`` and ``|`` (so ``<\\|`` becomes ``<\\\\|``)."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role: Column) -> Column:
    """Also without line ends, since a line end closes the role."""
    return _escaped(F.replace(F.replace(role, F.lit("~"), F.lit("~t")), F.lit("\n"), F.lit("~n")))


def _unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(_unescaped(role), F.lit("~n"), F.lit("\n")), F.lit("~t"), F.lit("~"))


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parsed(rendered: Column) -> Column:
    """The turns of a rendered conversation, or null if it does not follow the grammar."""
    pieces = F.split(rendered, r"<\|im_start\|>")
    tail = len(END) + 1

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(1), F.greatest(F.length(piece) - tail, F.lit(0)))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        fits = piece.endswith(END + "\n") & body.contains("\n") & ~body.contains(OPEN)
        return F.when(fits, F.struct(_unescaped_role(role).alias("role"), _unescaped(text).alias("text")))

    turns = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)
    return F.when((F.get(pieces, F.lit(0)) == "") & ~F.exists(turns, lambda t: t.isNull()), turns)


def conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, ordered by turn, then role, then text.

    A null role or text is empty; a null turn comes first; rows without a conversation id form one conversation;
    repeated rows are turns of their own. A conversation becomes one value, so it must fit into memory as a string.
    """
    first = F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role")
    turns = F.sort_array(F.collect_list(F.struct(F.col("turn"), F.col("role"), F.col("text"))))
    return (
        df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), first,
                  F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        .groupBy("conv_id").agg(turns.alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    )


def formatted(chats: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` -> also ``formatted`` and ``escaped_turns`` (how many had to be escaped).

    An empty conversation is an empty string.
    """
    def as_is(t: Column) -> Column:
        return rendered_turn(t["role"], t["text"])

    def safe(t: Column) -> Column:
        return rendered_turn(_escaped_role(t["role"]), _escaped(t["text"]))

    def returns(t: Column) -> Column:
        return F.coalesce(parsed(as_is(t)) == F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"))), F.lit(False))

    tried = chats.withColumn("_held", F.transform("turns", returns))
    plain = F.array_join(F.zip_with("turns", "_held", lambda t, h: F.when(h, as_is(t)).otherwise(safe(t))), "")
    every = F.array_join(F.transform("turns", safe), "")
    tried = tried.withColumn("_first", plain).withColumn("_same", F.coalesce(parsed(F.col("_first")) == F.col("turns"), F.lit(False)))
    return tried.select(
        "conv_id", "turns", F.when(F.col("_same"), F.col("_first")).otherwise(every).alias("formatted"),
        F.when(F.col("_same"), F.size(F.filter("_held", lambda h: ~h))).otherwise(F.size("turns")).cast("long").alias("escaped_turns"))


def read_back(done: DataFrame) -> DataFrame:
    """What training would see, from ``formatted`` alone: ``recovered`` turns (null: not grammatical), ``same`` as the
    source, and ``segments``, the loss mask: consecutive parts of ``formatted`` that together are all of it, each with
    whether it counts for the loss. Assistant texts do, with their escapes; the template and other roles do not."""
    pieces = F.split("formatted", r"<\|im_start\|>")
    tail = len(END) + 1

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def segments(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.greatest(F.length(piece) - F.length(role) - 1 - tail, F.lit(0)))
        return F.array(segment(F.concat(F.lit(START), role, F.lit("\n")), F.lit(False)),
                       segment(body, role == "assistant"), segment(F.lit(END + "\n"), F.lit(False)))

    out = done.withColumn("recovered", parsed(F.col("formatted")))
    return out.withColumn("same", F.coalesce(F.col("recovered") == F.col("turns"), F.lit(False))).withColumn(
        "segments", F.flatten(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), segments)))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back; the loss text is what the mask of ``segments`` lets through."""
    turns = F.array_join(F.transform("recovered", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: _unescaped(s["text"])), "")
    return read.withColumn("_loss", loss).select(
        "conv_id", F.size("recovered").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "same")
