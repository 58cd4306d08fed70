"""The corpus pipeline: documents through five stages to a training mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps;
what it returns is written as Parquet and read again for the next one. Stages
work on any table with the columns of ``documents``; nulls, empty texts and
tables and repeated rows are treated as the operators' own descriptions say.
Further columns stay as they are, whatever their names; only the last stage
replaces those called like its results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.llm import contamination, language, mixing, secrets, simhash
from marram.llm.common import count_tokens, remainder, stored, whole_row, work_tables
from marram.sources.tables import read_table

# A text of whose n-grams the best language has a smaller share is in no language learned.
LEAST_LANGUAGE_SHARE = 0.1


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without letters go."""
    filters = language.train(docs.where(remainder(F.col("doc_id")) != 0))
    told = language.with_language(docs.select(whole_row(docs).alias("row"), "text"), filters)
    return told.where(language.accepted(F.col("language"), LEAST_LANGUAGE_SHARE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return simhash.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark text, or with less than a twentieth of their words."""
    with work_tables(spark):
        found = contamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
        told = found.where("contaminated").select(F.col("doc_id").alias("id"), F.col("same").alias("hash"))
        bad = stored(told, "contaminated", lasts=True)
    rows = docs.select(whole_row(docs).alias("row"), "doc_id", F.xxhash64("text").alias("same"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("hash"))
    return rows.join(bad, same, "left_anti").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and lengths brought up to date."""
    findings, _ = secrets.scan(docs)
    found = secrets.attach(docs.select(whole_row(docs).alias("row")), findings, "row.text")
    told = found.select("row", "spans", secrets.redact(F.col("row.text"), F.col("spans")).alias("told"))
    n_chars = F.when(F.size("spans") > 0, F.char_length("told")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("told"), "n_chars": n_chars.cast("bigint")}
    return told.select(*[new.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix with ``size``, ``source_size``, ``target`` and ``taken`` words."""
    sized = docs.withColumn("size", count_tokens(F.col("text")))
    return mixing.mix(sized).where("taken > 0")


STAGES = [
    ("language", keep_languages),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

# Fingerprints and language filters have no form in SQL; tests hold the stages
# against plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
