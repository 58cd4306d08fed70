"""Columns of a caller, whatever their names, come through as they are."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as pipeline  # noqa: E402

from marram.llm import language, mixing, secrets, simhash  # noqa: E402
from marram.sources.tables import read_table  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = (
    "_key _row _language _text _spans _s _h _z _blob _doc _same _hash _runs _cut _epochs _part "
    "row key at same hash id fp root told language spans blob rank mass start pending a.b"
).split()


@pytest.fixture(scope="module")
def docs(spark):
    read = read_table(spark, SF, "documents")
    return read.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in NAMES])


def unchanged(frame, names=NAMES):
    rows = frame.select("doc_id", *[F.col(f"`{name}`") for name in names]).collect()
    assert rows
    for row in rows:
        assert list(row)[1:] == [f"{name} {row.doc_id}" for name in names]
    return len(rows)


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_leave_columns_alone(spark, docs, name, stage):
    out = stage(spark, docs, SF)
    plain = stage(spark, docs.drop(*NAMES), SF)
    assert [c for c in out.columns if c not in NAMES] == plain.columns
    assert unchanged(out) == plain.count()
    kept = [F.col(c) for c in plain.columns]
    assert not out.select(*kept).exceptAll(plain).count()


def test_operators_leave_columns_alone(docs):
    findings, _ = secrets.scan(docs)
    assert unchanged(secrets.attach(docs, findings, name="found")) == docs.count()
    attached = secrets.attach(docs, findings)
    assert unchanged(attached, [n for n in NAMES if n != "spans"]) == docs.count()
    assert attached.schema["spans"].dataType.typeName() == "array"
    assert unchanged(mixing.mix(docs.withColumn("size", F.lit(3)))) == docs.count()
    assert unchanged(simhash.first_of_each(docs)) <= docs.count()


def test_rejection_does_not_depend_on_how_many_languages_are_learned(spark):
    text = "the quick brown fox jumps over the lazy dog"
    for n in (1, 80):
        rows = spark.createDataFrame([(i, text, f"l{i:02}") for i in range(n)], "doc_id long, text string, lang string")
        filters = language.train(rows)
        told = language.with_language(rows.select("text"), filters).where(language.accepted(F.col("language"), 0.9))
        assert told.count() == n
        other = spark.createDataFrame([("жзщ ъыьэ юяшж",), ("",), (None,), ("12 34",)], "text string")
        found = language.with_language(other, filters)
        assert not found.where(language.accepted(F.col("language"), pipeline.LEAST_LANGUAGE_SHARE)).count()


def test_the_second_part_of_a_history_is_scanned_only_where_it_is_new(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    findings, scanned = secrets.scan(docs)
    blobs = docs.select(secrets.blob_id(F.col("text")).alias("blob"))
    assert not secrets.unseen(blobs.distinct(), secrets.RULES, scanned).count()
    again, _ = secrets.scan(docs, scanned=scanned, findings=findings)
    assert again.count() == findings.count()
