"""Chat formatting: conversations rebuilt from event logs, rendered and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template. Inside texts and roles a backslash is doubled and each control
# string is broken by a backslash after its first character, so that what marks
# turns in the output never comes from a text.
HEAD, AFTER_ROLE, FOOT = "<turn ", ">\n", "</turn>\n"
CONTROL = ("</turn>", "<turn")
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Reversible: a backslash stands for the character after it."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def escape_role(role: Column) -> Column:
    """As texts are, and line ends too, as the line's end closes the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(
    events: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    seq_col: str = "seq",
    kind_col: str = "kind",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Final messages of conversations from their event logs: ``conv``, ``turn``, ``role``, ``text``.

    Events of a conversation are taken in order of sequence. For their turn,
    ``message``, ``edit`` and ``regenerate`` start a new text, ``delta``
    appends to it, and ``delete`` removes the turn until something starts it
    anew. The role is that of the last starting event that has one; a text that
    only deltas made has their first role.

    Null text is empty; a null kind is a message; an unknown kind fails the
    job. Events of one sequence number are ordered by kind, role and text.
    Null conversations, turns and sequence numbers are values like others,
    first in order. Repeated events repeat their effect.
    """
    kinds = ("delete", "delta", "edit", "message", "regenerate")
    kind = F.coalesce(F.col(kind_col), F.lit("message"))
    checked = F.when(kind.isin(*kinds), kind).otherwise(
        F.raise_error(F.concat(F.lit("unknown event kind "), kind)).cast("string")
    )
    log = events.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(seq_col).alias("seq"),
        checked.alias("kind"),
        F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv", "turn").orderBy("seq", "kind", "role", "text")
    versions = log.withColumns(
        {
            "version": F.sum(F.when(F.col("kind") == "delta", 0).otherwise(1)).over(order),
            "named": F.last(F.when(F.col("kind") != "delta", F.col("role")), True).over(order),
            "place": F.row_number().over(order),
        }
    )
    last = versions.withColumn("latest", F.max("version").over(Window.partitionBy("conv", "turn")))
    parts = last.where("version = latest")
    folded = parts.groupBy("conv", "turn").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda p: p["text"]), ""
        ).alias("text"),
        F.max_by("named", "place").alias("named"),
        F.min_by("role", "place").alias("first_role"),
        F.min_by("kind", "place").alias("start_kind"),
    )
    return folded.where("start_kind <> 'delete'").select(
        "conv", "turn", F.coalesce("named", "first_role", F.lit("")).alias("role"), "text"
    )


def render(messages: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``spans``.

    ``spans`` is the loss mask: start and end, in code points of
    ``formatted``, of each text of the ``trained`` role, still escaped.
    ``messages`` has ``conv``, ``turn``, ``role``, ``text``; turns that are
    equal are put in order by role and text. A conversation becomes one row, as
    it is one training text; positions are summed up over its rows before that.
    """
    head = F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(AFTER_ROLE))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    parts = messages.select("*", head.alias("head"), escape(F.col("text")).alias("body"))
    placed = parts.select(
        "conv",
        "role",
        F.concat("head", "body", F.lit(FOOT)).alias("part"),
        F.char_length("head").alias("before"),
        F.char_length("body").alias("size"),
        F.row_number().over(order).alias("n"),
        (
            F.sum(F.char_length("head") + F.char_length("body") + len(FOOT)).over(order)
            - F.char_length("body")
            - len(FOOT)
        ).alias("start"),
    )
    span = F.struct("n", "start", (F.col("start") + F.col("size")).alias("end"))
    grouped = placed.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("n", "part"))).alias("parts"),
        F.array_sort(F.collect_list(F.when(F.col("role") == trained, span))).alias("marked"),
    )
    return grouped.select(
        "conv",
        F.array_join("parts.part", "").alias("formatted"),
        F.transform("marked", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation: an array of (role, text)."""
    parts = F.split(formatted, FOOT, -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, AFTER_ROLE, 1)
        text = F.substr(part, F.char_length(role) + len(AFTER_ROLE) + 1)
        named = unescape(F.substr(role, F.lit(len(HEAD) + 1)))
        return F.struct(named.alias("role"), unescape(text).alias("text"))

    return F.transform(whole, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    cut = F.transform(
        spans,
        lambda s: unescape(
            F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return F.array_join(cut, "")


def format_log(events: DataFrame, **columns: str) -> DataFrame:
    """Events to rendered conversations: ``conv``, ``formatted``, ``spans``. See ``fold_events``, ``render``."""
    return render(fold_events(events, **columns))
