"""Chat text by a grammar that is read back before it is accepted.

A turn is ``### Name: `` + payload + newline + ``</turn>`` + newline. ``### `` and ``</turn>`` are control strings. In a payload, one
backslash before a control string (and before backslashes that lead to it) takes its meaning away; reading drops one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.quality import let

END = "\n</turn>\n"
CONTROL = "(### |</turn>)"
NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}


def held(text: Column) -> Column:
    """Whether a control string occurs at all; a plain search spares most texts the expressions below."""
    return text.contains("### ") | text.contains("</turn>")


def escape(text: Column) -> Column:
    return F.when(held(text), F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")).otherwise(text)


def unescape(text: Column) -> Column:
    return F.when(held(text), F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")).otherwise(text)


def header(role: Column) -> Column:
    """``### Name: ``; other roles than the four known ones are kept URL-encoded behind an @."""
    name = F.concat(F.lit("@"), F.url_encode(role))
    for r, n in NAMES.items():
        name = F.when(role == r, n).otherwise(name)
    return F.concat(F.lit("### "), name, F.lit(": "))


def role_of(name: Column) -> Column:
    role = F.url_decode(F.substring(name, 2, 1 << 30))
    for r, n in NAMES.items():
        role = F.when(name == n, r).otherwise(role)
    return role


def name_of(piece: Column) -> Column:
    """What stands between ``### `` and the first colon and space."""
    return F.substring(F.substring_index(piece, ": ", 1), 5, 1 << 30)


def parse(formatted: Column) -> Column:
    """array<struct<role,text>>, or null where the text is not of the grammar: a payload holds a live control string."""
    def turn(piece: Column) -> Column:
        return let(name_of(piece), lambda name: let(F.substring(piece, F.length(name) + 7, F.length(piece)), lambda raw: F.when(
            piece.startswith("### ") & (name.isin(*NAMES.values()) | name.startswith("@")) & ~(held(raw) & raw.rlike(r"(?<!\\)" + CONTROL)),
            F.struct(role_of(name).alias("role"), unescape(raw).alias("text")))))

    return let(F.split(formatted, END), lambda pieces: let(
        F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn),
        lambda turns: F.when((F.element_at(pieces, -1) == "") & ~F.exists(turns, lambda t: t.isNull()), turns)))


def render(turns: Column, escaped: bool) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(
        header(t["role"]), escape(t["text"]) if escaped else t["text"], F.lit(END))))


def format_conversations(df: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, mask, recovered, identical) per conversation of rows (conv_id, turn, role, text).

    The plain rendering is parsed and kept if it gives back the very turns; else all payloads of that conversation are
    escaped and parsed again. ``mask`` holds runs (trained, n_chars) over the formatted characters; the trained runs are the
    payloads of role ``trained``. ``recovered`` are the turns parsed from the text that was kept.

    Null texts and null roles are empty strings, null turns come first, ties go by role and text, repeated rows are
    repeated turns, a null conv_id is a conversation of its own. Other columns are left out. A conversation is one output
    text and so has to fit a task, however many turns it has; nothing in it is worked on more than once per turn.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (df.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
             .select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))
    plain = turns.withColumn("plain", render(F.col("turns"), False))
    same = F.coalesce(parse(F.col("plain")) == F.col("turns"), F.lit(False))
    kept = plain.select("conv_id", "turns", F.when(same, F.col("plain")).otherwise(render(F.col("turns"), True)).alias("formatted"))
    read = kept.withColumn("recovered", parse(F.col("formatted")))

    def runs(piece: Column) -> Column:
        head = F.length(name_of(piece)) + 6
        on = piece.startswith(f"### {NAMES[trained]}: ")
        run = lambda flag, n: F.struct(flag.alias("trained"), n.cast("long").alias("n_chars"))
        return F.array(run(F.lit(False), head), run(on, F.length(piece) - head), run(F.lit(False), F.lit(len(END))))

    mask = let(F.split("formatted", END), lambda pieces: F.flatten(F.transform(F.slice(pieces, 1, F.size(pieces) - 1), runs)))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "formatted", mask.alias("mask"), "recovered",
                       F.coalesce(F.col("recovered") == F.col("turns"), F.lit(False)).alias("identical"))


def chat_digest(df: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted text."""
    f = format_conversations(df)
    # Each turn has three runs; the middle one says whether its payload is trained on.
    chosen = let(F.col("mask"), lambda m: F.filter("recovered", lambda t, i: F.get(m, i * 3 + 1)["trained"]))
    loss = F.concat_ws("", F.transform(chosen, lambda t: t["text"]))
    every = F.concat_ws("", F.transform("recovered", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return (f.withColumn("loss", loss)
            .select("conv_id", "n_turns", F.sha2(every.cast("binary"), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "identical"))
