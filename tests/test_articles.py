import datetime as dt

import pytest
from conftest import exchanges, plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marram.functions.markup import element_text
from marram.operators import articles
from marram.plans import tables
from marram.sources.dumps import (
    parse_articles,
    parse_revisions,
    read_articles,
    read_page_records,
    read_revisions,
)

SF = "/root/testdata/sf0.001"


def revision(rid=None, who="", ts="2009-10-24T03:36:18Z"):
    id_part = f"<id>{rid}</id>" if rid is not None else ""
    ts_part = f"<timestamp>{ts}</timestamp>" if ts is not None else ""
    return f"<revision>\n{id_part}{ts_part}<contributor>{who}</contributor></revision>"


def user(name):
    return f"<username>{name}</username>"


def page(*revisions, aid="7", title="T"):
    id_part = f"<id>{aid}</id>" if aid is not None else ""
    return f"<page>\n<title>{title}</title>{id_part}{''.join(revisions)}\n</page>"


def pages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "page string")


def parsed(spark, *texts, **options):
    return parse_articles(pages(spark, *texts), **options).collect()


def flat(spark, rows):
    return spark.createDataFrame(
        [(a, r, c, dt.datetime.fromisoformat(t)) for a, r, c, t in rows],
        "aid bigint, rid bigint, contributor string, ts timestamp_ntz",
    )


def test_parse_takes_user_then_address_then_nothing(spark):
    (row,) = parsed(
        spark,
        page(
            revision(1, user("Ann") + "<ip>1.2.3.4</ip>"),
            revision(2, "<ip>1.2.3.4</ip>"),
            revision(3, ""),
            revision(4, "<ip>1.2.3.4</ip>" + user("Bob")),
        ),
    )
    assert (row.aid, row.title) == (7, "T")
    assert [(r.rid, r.contributor) for r in row.revisions] == [
        (1, "Ann"),
        (2, "1.2.3.4"),
        (3, ""),
        (4, "Bob"),
    ]
    assert row.revisions[0].ts == dt.datetime(2009, 10, 24, 3, 36, 18)


def test_missing_ids_become_minus_one(spark):
    (row,) = parsed(spark, page(revision(None, user("Ann")), aid=None))
    assert row.aid == -1
    assert row.revisions[0].rid == -1


def test_first_id_anywhere_wins(spark):
    (row,) = parsed(spark, page(revision(42, user("Ann")), aid=None))
    assert row.aid == 42


def test_prefix_match_runs_to_the_real_end_tag(spark):
    text = "<page><idx>5</idx><title>x</title><id>6</id></page>"
    found = pages(spark, text).select(element_text("page", "id").alias("t")).first().t
    assert found == "5</idx><title>x</title><id>6"


def test_pages_without_revisions_are_dropped(spark):
    assert parsed(spark, page()) == []
    assert parse_revisions(pages(spark, page())).collect() == []


def test_text_ids_fail(spark):
    with pytest.raises(PySparkException):
        parsed(spark, page(revision("x")))


@pytest.mark.parametrize("bad", [None, "yesterday", "2009-10-24 03:36:18", "2009-13-24T03:36:18Z", "2009-10-24T03:36:18"])
def test_bad_timestamps_fail_or_become_null(spark, bad):
    text = page(revision(1, user("Ann"), ts=bad))
    with pytest.raises(PySparkException):
        parsed(spark, text)
    (row,) = parsed(spark, text, on_bad_ts="null")
    assert row.revisions[0].ts is None


def test_on_bad_ts_is_checked(spark):
    with pytest.raises(ValueError):
        parse_articles(pages(spark, page()), on_bad_ts="skip")


def test_fractional_seconds(spark):
    articles_frame = parse_articles(
        pages(spark, page(revision(1, user("Ann"), ts="2009-10-24T03:36:18.5Z")))
    )
    assert articles_frame.first().revisions[0].ts.microsecond == 500000
    assert articles.article_text(articles_frame).first().text == (
        "7,T\n\t1,Ann,2009-10-24T03:36:18.500Z\n"
    )


def test_years_do_not_depend_on_the_session_zone(spark):
    frame = pages(spark, page(revision(1, ts="2013-12-31T23:30:00Z")))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Pacific/Auckland", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            years = articles.years_of_articles(parse_articles(frame)).collect()
            assert [row.year for row in years] == [2013]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flat_and_nested_parses_agree(spark):
    frame = tables.page_records(spark, SF)
    nested = articles.flatten(parse_articles(frame))
    direct = parse_revisions(frame)
    assert nested.columns == direct.columns
    assert nested.exceptAll(direct).count() == 0
    assert direct.exceptAll(nested).count() == 0


def test_dump_round_trip_through_files(spark, tmp_path):
    source = tables.page_records(spark, SF)
    directory = str(tmp_path / "dump")
    source.repartition(3).write.text(directory)
    records = read_page_records(spark, directory)
    # One record more per file than it has pages: what stands after the last page.
    assert records.count() == source.count() + 3
    expected = parse_revisions(source)
    for found in (read_revisions(spark, directory), articles.flatten(read_articles(spark, directory))):
        assert found.exceptAll(expected).count() == 0
        assert expected.exceptAll(found).count() == 0


def test_dump_files_are_split(spark, tmp_path):
    directory = str(tmp_path / "dump")
    source = tables.page_records(spark, SF)
    source.coalesce(1).write.text(directory)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        records = read_page_records(spark, directory)
        assert records.rdd.getNumPartitions() > 5
        found = parse_revisions(records)
        assert found.exceptAll(parse_revisions(source)).count() == 0
        assert found.count() == parse_revisions(source).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_totals_of_nothing_are_zero(spark):
    nothing = flat(spark, [])
    assert tuple(articles.article_totals(nothing).first()) == (0, 0)
    none_nested = parse_articles(pages(spark, page()))
    assert tuple(articles.totals_of_articles(none_nested).first()) == (0, 0)


def test_last_listed_differs_from_earliest(spark):
    text = page(
        revision(1, ts="2012-01-01T00:00:00Z"), revision(2, ts="2010-01-01T00:00:00Z")
    )
    frame = parse_articles(pages(spark, text))
    assert articles.years_of_articles(frame).first().year == 2010
    assert articles.years_of_articles(frame, pick="earliest").first().year == 2010
    rows = articles.flatten(frame)
    assert articles.article_years(rows, order="ord").first().year == 2010
    assert articles.article_years(rows, order="ts").first().year == 2012
    with pytest.raises(ValueError):
        articles.article_years(rows, pick="first")
    with pytest.raises(ValueError):
        articles.years_of_articles(frame, pick="first")


def test_contributors_counted_per_revision_or_distinct(spark):
    rows = flat(spark, [(1, i, "Ann", "2013-01-01") for i in range(3)])
    assert articles.count_busy_articles(rows, 3, 3).first().n_articles == 1
    assert articles.count_busy_articles(rows, 3, 3, distinct_contributors=True).first().n_articles == 0
    text = page(*[revision(i, user("Ann")) for i in range(3)])
    frame = parse_articles(pages(spark, text))
    assert articles.busy_articles(frame, 3, 3).count() == 1
    assert articles.busy_articles(frame, 3, 3, distinct_contributors=True).count() == 0
    answers = articles.with_accessors(frame).first()
    assert answers.contributor_count == answers.revision_count == 3


def test_ties_are_broken_by_key(spark):
    rows = flat(spark, [(a, 1, c, "2013-01-01") for a, c in ((3, "x"), (1, "z"), (2, "y"))])
    assert [r.aid for r in articles.articles_by_revisions(rows).collect()] == [1, 2, 3]
    assert [r.contributor for r in articles.top_contributors(rows, 2).collect()] == ["x", "y"]


def test_top_articles_look_up_titles(spark):
    rows = flat(spark, [(a, i, "x", "2013-01-01") for a in range(5) for i in range(a)])
    titles = spark.createDataFrame([(a, f"T{a}") for a in range(9)], "aid bigint, title string")
    found = list(map(tuple, articles.top_articles(rows, titles, 2).collect()))
    assert found == [(1, 4, "T4", 4), (2, 3, "T3", 3)]
    untitled = list(map(tuple, articles.top_articles(rows, titles.where("aid <> 4"), 2).collect()))
    assert untitled == [(1, 4, None, 4), (2, 3, "T3", 3)]
    listed = articles.articles_by_revisions(rows, titles.where("aid <> 3")).collect()
    assert list(map(tuple, listed)) == [(4, "T4", 4), (3, None, 3), (2, "T2", 2), (1, "T1", 1)]


def test_contributors_may_be_estimated(spark):
    rows = flat(spark, [(1, i, f"c{i % 20}", "2013-01-01") for i in range(200)])
    assert articles.unique_contributors(rows).first().n_contributors == 20
    assert 18 <= articles.unique_contributors(rows, approximate=True).first().n_contributors <= 22


def test_user_aggregates_per_year(spark):
    rows = flat(
        spark,
        [(1, 5, "Ann", "2013-01-01"), (1, 9, "Bob", "2013-05-01"), (2, 7, "Ann", "2014-01-01")],
    )
    by_year = articles.keyed_by_year(rows)
    answer = articles.per_year(by_year, highest=F.max("rid"), n=articles.contributors_in_group())
    assert sorted(map(tuple, answer.collect())) == [(2013, 9, 2), (2014, 7, 1)]
    with pytest.raises(ValueError):
        articles.per_year(by_year)
    assert articles.contributor_year_lookup(by_year, 2013, "Cid").collect() == []


LEFT = [(1, 1, "Ann", "2013-01-01"), (1, 2, "Ann", "2014-01-01"), (2, 3, "Bob", "2012-01-01")]
RIGHT = [(3, 4, "Ann", "2013-06-01"), (3, 5, "Cid", "2013-01-01"), (4, 6, "Bob", "2013-02-02")]


def test_cogroup_sides(spark):
    left, right = flat(spark, LEFT), flat(spark, RIGHT)
    sizes = {r.contributor: (r.n_left, r.n_right) for r in articles.cogroup_sizes(left, right).collect()}
    assert sizes == {"Ann": (2, 1), "Bob": (1, 1), "Cid": (0, 1)}
    grouped = articles.cogroup(left, right, {"last": F.max("rid")}).where("contributor = 'Cid'").first()
    assert (grouped.left_last, grouped.right_last) == (None, 5)
    assert articles.cogroup_rows(left, right).count() == 6


def test_cogroup_filters(spark):
    left, right = flat(spark, LEFT), flat(spark, RIGHT)

    def names(frame):
        return sorted(r.contributor for r in frame.collect())

    assert names(articles.filter_cogroup(left, right, articles.not_empty())) == ["Ann", "Bob"]
    assert names(articles.filter_cogroup(left, right, articles.active_in(2013))) == ["Ann"]
    few = F.count(F.lit(1)) < 2
    assert names(articles.filter_cogroup(left, right, few)) == ["Bob"]
    # For a side without the contributor the predicate's value on nothing counts.
    assert names(articles.filter_cogroup(left, right, few, when_absent=True)) == ["Bob", "Cid"]
    assert names(articles.contributors_in_both(left, right)) == ["Ann", "Bob"]
    assert names(articles.contributors_in_both(left, right, F.year("ts") == 2013)) == ["Ann"]


def test_cogroup_shuffles_each_side_once(spark):
    left, right = flat(spark, LEFT), flat(spark, RIGHT)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert exchanges(articles.cogroup_sizes(left, right)) == 2
        assert exchanges(articles.contributors_in_both(left, right)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scans_read_only_what_is_asked(spark):
    plan = plan_of(articles.article_totals(tables.edits(spark, SF)))
    assert "ReadSchema: struct<l_partkey:bigint>" in plan
    lookup = articles.contributor_year_lookup(
        articles.keyed_by_year(tables.revisions(spark, SF, True)), 1998, "7"
    )
    assert "EqualTo(l_returnflag,R)" in plan_of(lookup)


def test_flat_parse_extracts_once(spark, tmp_path):
    directory = str(tmp_path / "dump")
    pages(spark, page(revision(1))).write.text(directory)
    plan = plan_of(read_revisions(spark, directory))
    assert plan.count("regexp_extract_all") == 1
    above, below = plan.split("Generate posexplode", 1)
    # Id and title are read once per page, below the generator, not per revision.
    assert "<title" not in above and "<title" in below


def test_partitioning_by_contributor(spark):
    rows = flat(spark, [(1, i, f"c{i % 5}", "2013-01-01") for i in range(50)])
    placed = articles.partition_by_contributor(rows, 2, shares=5)
    assert placed.rdd.getNumPartitions() == 2
    spread = placed.select("contributor", "part", F.spark_partition_id().alias("p")).distinct()
    assert spread.count() == 5
    many = rows.unionByName(flat(spark, [(1, i, "busy", "2013-01-01") for i in range(950)]))
    parts = articles.partition_by_contributor(many, 4, shares=20).groupBy("contributor", "part").count()
    sizes = {(r.contributor, r.part): r["count"] for r in parts.collect()}
    assert sum(name == "busy" for name, _ in sizes) == 19
    assert max(sizes.values()) == 50 and sum(sizes.values()) == 1000
