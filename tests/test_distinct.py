"""Distinct contributors from stored bitmaps and sketches, and dumps read as XML."""

import random

import pytest
from pyspark.sql import functions as F
from test_articles import page, revision, user

from marram.operators import distinct
from marram.sources.dumps import (
    corrupt_pages,
    page_trees,
    read_page_trees,
    read_revisions,
    revisions_of_trees,
)


def revisions(spark, rows):
    return spark.createDataFrame(rows, "aid long, rid long, contributor string, ts string").withColumn(
        "ts", F.to_timestamp_ntz("ts")
    )


def drawn(seed, n, names):
    draw = random.Random(seed)
    return [(1, i, f"c{int(draw.random() ** 3 * names)}" if i % 50 else None, f"20{draw.randint(10, 16)}-01-01") for i in range(n)]


def names(rows, first=2000, last=2100):
    return {c for _, _, c, ts in rows if c is not None and first <= int(ts[:4]) <= last}


def test_numbers_have_no_gaps(spark):
    rows = drawn(1, 3_000, 900)
    more = revisions(spark, [(1, 1, "other", "2012-01-01")])
    found = distinct.contributor_numbers(revisions(spark, rows), more, parts=16).collect()
    assert {r.contributor for r in found} == names(rows) | {"other"}
    assert sorted(r.number for r in found) == list(range(len(found)))


def test_any_years_from_stored_bitmaps_and_newer_revisions(spark):
    rows, newer = drawn(2, 4_000, 60_000), drawn(3, 500, 90_000)
    both = [revisions(spark, each) for each in (rows, newer)]
    numbers = distinct.contributor_numbers(*both)
    stored = distinct.year_bitmaps(both[0], numbers).collect()
    bitmaps = spark.createDataFrame(stored, "year int, bucket long, bits binary")
    merged = distinct.merged_bitmaps(bitmaps.unionByName(distinct.year_bitmaps(both[1], numbers)), "year")
    for first, last in ((2010, 2010), (2011, 2014), (2010, 2016), (2020, 2021)):
        some = distinct.merged_bitmaps(merged.where(F.col("year").between(first, last)))
        assert distinct.counted_bitmaps(some).first().n_contributors == len(names(rows + newer, first, last))


def test_common_contributors_and_empty_sides(spark):
    rows = drawn(4, 2_000, 3_000), drawn(5, 2_000, 3_000), []
    sides = [revisions(spark, each) for each in rows]
    numbers = distinct.contributor_numbers(*sides, parts=4)
    bits = [distinct.merged_bitmaps(distinct.year_bitmaps(side, numbers)) for side in sides]
    common = distinct.counted_bitmaps(distinct.common_bitmaps(bits[0], bits[1])).first().n_contributors
    assert common == len(names(rows[0]) & names(rows[1])) > 0
    assert distinct.counted_bitmaps(distinct.common_bitmaps(bits[0], bits[2])).first().n_contributors == 0


@pytest.mark.parametrize("log_entries", [6, 12])
def test_sketches_merge_and_keep_their_error(spark, log_entries):
    rows, newer = drawn(6, 6_000, 20_000), drawn(7, 3_000, 20_000)
    parts = [distinct.year_sketches(revisions(spark, each), log_entries) for each in (rows, newer)]
    merged = distinct.merged_sketches(parts[0].unionByName(parts[1]), log_entries=log_entries)
    told = merged.select(distinct.estimate().alias("n")).first().n
    exact = len(names(rows + newer))
    assert abs(told - exact) <= exact * distinct.error(log_entries)
    if exact <= 1 << log_entries:
        assert told == exact
    sides = [distinct.merged_sketches(part, log_entries=log_entries) for part in parts]
    both = distinct.common_estimate(*sides).first().n_contributors
    assert abs(both - len(names(rows) & names(newer))) <= exact * distinct.error(log_entries)


def dump(spark, tmp_path, *texts):
    folder = str(tmp_path / "dump")
    spark.createDataFrame([("\n".join(texts),)], "value string").write.text(folder)
    return folder


def test_trees_equal_the_pattern_parser_where_elements_stand_in_place(spark, tmp_path):
    folder = dump(
        spark, tmp_path,
        page(revision(1, user("Ann")), revision(2, "<ip>1.2.3.4</ip>"), revision(None, "")),
        page(revision(5, user("Bob") + "<ip>9.9.9.9</ip>"), aid="8", title="Other"),
        page(aid="9"),
        "<foot/>",
    )
    found = sorted(map(tuple, revisions_of_trees(read_page_trees(spark, folder)).collect()))
    assert found == sorted(map(tuple, read_revisions(spark, folder).collect())) and len(found) == 4


def test_a_malformed_page_leaves_the_others(spark, tmp_path):
    bad = page(revision(4, user("open"))).replace("</username>", "")
    folder = dump(spark, tmp_path, "<dump><head>x</head>", page(revision(1, user("Ann"))), bad, page(revision(5, "")), "</dump>")
    trees = read_page_trees(spark, folder)
    assert sorted(r.rid for r in revisions_of_trees(trees).collect()) == [1, 5]
    assert [r.corrupt for r in corrupt_pages(trees).collect()] == [bad]


def test_trees_resolve_entities_and_need_exact_names(spark):
    texts = [
        page(revision(1, user("A &amp; B")), title="x &lt; y"),
        page(revision(2, user("C")), aid=None),
        page(revision(3, "<usernames>D</usernames>"), title="<![CDATA[a<b]]>"),
        page(revision(4, user("open"))).replace("</username>", ""),
    ]
    trees = page_trees(spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, page string"))
    found = {r.rid: r for r in revisions_of_trees(trees).collect()}
    assert (found[1].contributor, found[1].title) == ("A & B", "x < y")
    assert found[2].aid == -1
    assert (found[3].contributor, found[3].title) == ("", "a<b")
    assert 4 not in found
    assert [r.corrupt for r in corrupt_pages(trees).collect()] == [texts[3]]
