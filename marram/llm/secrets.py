"""Secret scanning with a ledger of scanned contents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.common import stored, whole_row


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``, kept if ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed patterns. The first three are the base kinds, in the order of results.
RULES = (
    Rule(
        "assign",
        1,
        "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
        "([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hub", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
)


def blob_id(text: Column) -> Column:
    """Address of a content; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _pieces(text: Column, rule: Rule) -> Column:
    """Matches of a rule and the texts between them, or null where nothing matches."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.struct(
        F.lit(rule.name).alias("rule"),
        F.transform(found, F.char_length).alias("lengths"),
        F.transform(F.split(text, rule.pattern), F.char_length).alias("gaps"),
        F.transform(
            found,
            lambda match: F.char_length(F.regexp_extract(match, rule.pattern, rule.group))
            >= rule.least,
        ).alias("kept"),
    )
    return F.when(F.array_contains("pending", rule.name) & text.rlike(rule.pattern), pieces)


def unseen(blobs: DataFrame, rules: Sequence[Rule], scanned: DataFrame | None) -> DataFrame:
    """Blobs with the rules not yet run on them: columns ``blob``, ``pending``."""
    names = F.array(*[F.lit(rule.name) for rule in rules])
    if scanned is None:
        return blobs.select("blob", names.alias("pending"))
    pairs = blobs.select("blob", F.explode(names).alias("rule"))
    left = pairs.join(scanned.select("blob", "rule"), ["blob", "rule"], "left_anti")
    return left.groupBy("blob").agg(F.collect_set("rule").alias("pending"))


def scan(
    versions: DataFrame,
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    scanned: DataFrame | None = None,
    findings: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The ledger after all contents of ``versions``: (findings, scanned).

    ``versions`` has one row for every historical version at every path. A
    content is addressed by its hash and scanned once by each version of each
    rule, however many paths hold it; pairs listed in ``scanned`` (``blob``,
    ``rule``) are not run again, and ``findings`` (``blob``, ``rule``,
    ``start``, ``end``) that they gave are taken over. Spans are in code
    points, the end exclusive. Secrets themselves are never stored.

    A null text is an empty content; repeated rows are one content; extra
    columns are ignored; an empty table leaves the ledger as it is. Positions
    come from the lengths of matches and of the texts between them, row by row,
    so a text with very many matches costs no more than its share.
    """
    contents = versions.select(F.coalesce(F.col(text_col), F.lit("")).alias("content"))
    contents = contents.select(blob_id(F.col("content")).alias("blob"), "content")
    todo = contents.dropDuplicates(["blob"])
    if scanned is None:
        todo = todo.withColumn("pending", F.array(*[F.lit(rule.name) for rule in rules]))
    else:
        pending = unseen(contents.select("blob").distinct(), rules, scanned)
        todo = contents.join(stored(pending, "pending"), "blob").dropDuplicates(["blob"])
    pieces = F.explode(F.array(*[_pieces(F.col("content"), rule) for rule in rules]))
    matched = todo.select("blob", pieces.alias("p")).where("p IS NOT NULL")
    each = matched.select(
        "blob",
        F.col("p.rule").alias("rule"),
        F.posexplode(
            F.arrays_zip(F.col("p.lengths"), F.slice("p.gaps", 1, F.size("p.lengths")), F.col("p.kept"))
        ).alias("i", "m"),
    ).select("blob", "rule", "i", "m.*").toDF("blob", "rule", "i", "length", "gap", "keep")
    order = Window.partitionBy("blob", "rule").orderBy("i")
    end = F.sum(F.col("gap") + F.col("length")).over(order)
    new = (
        each.withColumn("end", end.cast("bigint"))
        .where("keep")
        .select("blob", "rule", (F.col("end") - F.col("length")).alias("start"), "end")
    )
    new_pairs = unseen(contents.select("blob").distinct(), rules, scanned).select(
        "blob", F.explode("pending").alias("rule")
    )
    if findings is not None:
        new = new.unionByName(findings.select("blob", "rule", "start", "end"))
    if scanned is not None:
        new_pairs = new_pairs.unionByName(scanned.select("blob", "rule"))
    return stored(new, "findings"), new_pairs


def spans_by_blob(findings: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Findings of each blob in order: ``blob``, ``spans`` (start, place of the kind, end, kind)."""
    kinds = F.array(*[F.lit(rule.name) for rule in rules])
    place = F.array_position(kinds, F.col("rule")).cast("int") - 1
    listed = findings.where(place >= 0).select(
        "blob",
        F.struct(
            "start",
            place.alias("place"),
            "end",
            F.split_part("rule", F.lit("@"), F.lit(1)).alias("kind"),
        ).alias("span"),
    )
    return listed.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""

    def one(span: Column) -> Column:
        return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")


def attach(
    versions: DataFrame,
    findings: DataFrame,
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    name: str = "spans",
) -> DataFrame:
    """Every row of ``versions`` with the spans of its content, an empty array if it has none.

    Copies of one content, however many, each get its spans. A column of
    ``versions`` that is called as the result is replaced; all others stay as
    they are, whatever their names. An empty table gives no rows.
    """
    summary = stored(spans_by_blob(findings, rules), "spans")
    row = whole_row(versions, name).alias("row")
    named = versions.select(row, blob_id(F.col(text_col)).alias("blob"))
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    # No broadcast: the findings grow with the contents.
    return named.join(summary.hint("merge"), "blob", "left").select("row.*", F.coalesce("spans", none).alias(name))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the union of its spans replaced by ``mark``; null stays null."""

    def between(start: Column, end: Column) -> Column:
        return F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))

    done = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    step = F.aggregate(
        spans,
        done,
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.when(s["start"] < a["at"], a["out"])
                .otherwise(
                    F.array_append(
                        a["out"],
                        F.concat(between(a["at"], s["start"]), F.lit(mark)),
                    )
                )
                .alias("out"),
            )
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, (a["at"] + 1).cast("int"))),
    )
    return F.when(F.size(spans) > 0, step).otherwise(text)
