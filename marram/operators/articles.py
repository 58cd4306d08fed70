"""Questions about article revision histories.

Two forms of the data are taken. *Articles* are what a dump parses to:
``aid, title, revisions`` with an array per page record. *Revisions* are flat
rows ``aid, rid, contributor, ts`` and perhaps ``title``. Articles turn into
revisions without a shuffle; nothing turns revisions back into arrays, since
one article, year or contributor may own a large part of all rows. What would
be a group's list elsewhere is here an aggregate over the flat rows.

Arrays are taken apart with outer generators and a filter behind them. Ahead of
an inner one Spark puts a filter of its own, which would parse every page twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.functions import fixed, markup
from marram.operators.skew import SHARES, with_parts


# Hash buckets that bound the counts of keys.
BUCKETS = 1 << 16


def _row_count() -> Column:
    return F.count(F.lit(1))


# Articles -------------------------------------------------------------------


def flatten(articles: DataFrame) -> DataFrame:
    """One row per revision; ``ord`` is its place in the page, from 0."""
    others = [name for name in articles.columns if name != "revisions"]
    return (
        articles.select(*others, F.posexplode_outer("revisions").alias("ord", "revision"))
        .where(F.col("ord").isNotNull())
        .select(*others, "ord", "revision.rid", "revision.contributor", "revision.ts")
    )


def contributor_pairs(articles: DataFrame) -> DataFrame:
    """One row per revision: ``contributor, revision``, the latter a struct."""
    return (
        articles.select(F.explode_outer("revisions").alias("revision"))
        .where(F.col("revision").isNotNull())
        .select(F.col("revision.contributor").alias("contributor"), "revision")
    )


def with_accessors(articles: DataFrame) -> DataFrame:
    """Adds what can be asked of one article.

    ``contributor_count`` is the length of the contributor list, repeats
    included, and so equals ``revision_count``.
    """
    return articles.withColumns(
        {
            "revision_count": F.size("revisions"),
            "contributors": F.col("revisions.contributor"),
            "contributor_count": F.size("revisions.contributor"),
            "revision_years": F.transform("revisions", lambda r: F.year(r["ts"])),
            "last_revision": F.element_at("revisions", -1),
        }
    )


def article_text(articles: DataFrame) -> DataFrame:
    """``aid, text``: a heading line and one indented line per revision."""
    line = lambda r: F.concat(
        F.lit("\t"),
        r["rid"].cast("string"),
        F.lit(","),
        r["contributor"],
        F.lit(","),
        markup.instant_text(r["ts"]),
        F.lit("\n"),
    )
    heading = F.concat(F.col("aid").cast("string"), F.lit(","), F.col("title"), F.lit("\n"))
    body = F.array_join(F.transform("revisions", line), "")
    return articles.select("aid", F.concat(heading, body).alias("text"))


def totals_of_articles(articles: DataFrame) -> DataFrame:
    """``n_articles, n_revisions``; zeros for no articles."""
    revisions = F.sum(F.size("revisions").cast("bigint"))
    return articles.agg(
        _row_count().alias("n_articles"),
        F.coalesce(revisions, F.lit(0).cast("bigint")).alias("n_revisions"),
    )


def years_of_articles(articles: DataFrame, pick: str = "last", distinct: bool = False) -> DataFrame:
    """One year per article: of the last listed or of the earliest revision."""
    if pick == "last":
        year = F.year(F.element_at("revisions", -1)["ts"])
    elif pick == "earliest":
        year = F.year(F.array_min(F.col("revisions.ts")))
    else:
        raise ValueError(f"pick must be 'last' or 'earliest', not {pick!r}")
    if distinct:
        return articles.select(year.alias("year")).distinct()
    return articles.select("aid", year.alias("year"))


def busy_articles(
    articles: DataFrame,
    min_revisions: int = fixed.MINIMUM_REVISIONS,
    min_contributors: int = fixed.MINIMUM_CONTRIBUTORS,
    distinct_contributors: bool = False,
) -> DataFrame:
    """Articles with enough revisions and contributors."""
    contributors = F.col("revisions.contributor")
    if distinct_contributors:
        contributors = F.array_distinct(contributors)
    enough = (F.size("revisions") >= min_revisions) & (F.size(contributors) >= min_contributors)
    return articles.where(enough)


def articles_with(articles: DataFrame, condition) -> DataFrame:
    """Articles with any revision that fulfils ``condition``, a function on its struct."""
    return articles.where(F.exists("revisions", condition))


# Revisions ------------------------------------------------------------------


def article_activity(revisions: DataFrame, distinct_contributors: bool = False) -> DataFrame:
    """``aid, n_revisions, n_contributors`` per article.

    Contributors are counted per revision unless ``distinct_contributors``.
    """
    contributors = (
        F.count_distinct("contributor") if distinct_contributors else F.count("contributor")
    )
    return revisions.groupBy("aid").agg(
        _row_count().alias("n_revisions"), contributors.alias("n_contributors")
    )


def article_totals(revisions: DataFrame) -> DataFrame:
    """``n_articles, n_revisions``; zeros for no rows."""
    per_article = revisions.groupBy("aid").agg(_row_count().alias("n"))
    return per_article.agg(
        _row_count().alias("n_articles"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_revisions"),
    )


def unique_contributors(revisions: DataFrame, approximate: bool = False) -> DataFrame:
    """``n_contributors``: exact, or a sketch's estimate without any large shuffle."""
    count = (
        F.approx_count_distinct("contributor") if approximate else F.count_distinct("contributor")
    )
    return revisions.agg(count.alias("n_contributors"))


def article_years(
    revisions: DataFrame, pick: str = "last", distinct: bool = False, order: str = "ts"
) -> DataFrame:
    """One year per article: ``aid, year``, or only the distinct ``year`` values.

    ``last`` takes the revision with the greatest ``order`` (``ord`` after
    ``flatten``), ``earliest`` the first in time.
    """
    if pick == "last":
        year = F.max_by(F.year("ts"), order)
    elif pick == "earliest":
        year = F.year(F.min("ts"))
    else:
        raise ValueError(f"pick must be 'last' or 'earliest', not {pick!r}")
    years = revisions.groupBy("aid").agg(year.alias("year"))
    return years.select("year").distinct() if distinct else years


def count_busy_articles(
    revisions: DataFrame,
    min_revisions: int = fixed.MINIMUM_REVISIONS,
    min_contributors: int = fixed.MINIMUM_CONTRIBUTORS,
    distinct_contributors: bool = False,
) -> DataFrame:
    """``n_articles`` with at least so many revisions and contributors."""
    enough = (F.col("n_revisions") >= min_revisions) & (
        F.col("n_contributors") >= min_contributors
    )
    activity = article_activity(revisions, distinct_contributors)
    return activity.where(enough).agg(_row_count().alias("n_articles"))


def articles_by_revisions(revisions: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """All articles, most revised first; ties by ``aid``.

    With ``titles`` (``aid, title``) also their titles, NULL for an article
    that has none there.
    """
    counts = revisions.groupBy("aid").agg(_row_count().alias("n_revisions"))
    if titles is not None:
        counts = counts.join(titles.select("aid", "title"), "aid", "left")
        counts = counts.select("aid", "title", "n_revisions")
    return counts.orderBy(F.desc("n_revisions"), "aid")


def top_articles(revisions: DataFrame, titles: DataFrame, k: int = fixed.TOP) -> DataFrame:
    """The ``k`` most revised articles in order: ``rank, aid, title, n_revisions``.

    Titles (``aid, title``) are looked up for the winners only; a winner
    without a title stays, with NULL.
    """
    best = articles_by_revisions(revisions).limit(k)
    place = F.row_number().over(Window.orderBy(F.desc("n_revisions"), "aid"))
    ranked = best.withColumn("rank", place)
    return (
        ranked.join(titles.select("aid", "title"), "aid", "left")
        .select("rank", "aid", "title", "n_revisions")
        .orderBy("rank")
    )


def contributor_counts(revisions: DataFrame) -> DataFrame:
    """``contributor, n_revisions``."""
    return revisions.groupBy("contributor").agg(_row_count().alias("n_revisions"))


def contributors_by_revisions(revisions: DataFrame) -> DataFrame:
    """All contributors, most active first; ties by name."""
    return contributor_counts(revisions).orderBy(F.desc("n_revisions"), "contributor")


def top_contributors(revisions: DataFrame, k: int = fixed.TOP) -> DataFrame:
    return contributors_by_revisions(revisions).limit(k)


def top_by_count(rows: DataFrame, key: str, k: int = fixed.TOP, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` most frequent keys, ``key, n``, without shuffling the others; ties by key.

    The number of rows in a key's hash bucket bounds the key's own from
    above. The ``k`` fullest buckets have ``k`` keys or more, whose exact
    counts give a count that ``k`` keys reach; only keys in buckets that reach
    it too are counted. The result is exact: with flat counts all buckets
    stay, and it costs what grouping all keys costs. Both tables of buckets
    have ``buckets`` rows at most. The rows are read three times.
    """
    dealt = rows.select(key, F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket"))
    sizes = dealt.groupBy("_bucket").agg(_row_count().alias("_size"))
    fullest = F.broadcast(sizes.orderBy(F.desc("_size"), "_bucket").limit(k).select("_bucket"))
    probe = dealt.join(fullest, "_bucket", "left_semi").groupBy(key).agg(_row_count().alias("n"))
    reached = probe.orderBy(F.desc("n")).limit(k).agg(
        F.when(_row_count() >= k, F.min("n")).otherwise(0).alias("least")
    )
    kept = F.broadcast(sizes.where(F.col("_size") >= reached.scalar()).select("_bucket"))
    counted = dealt.join(kept, "_bucket", "left_semi").groupBy(key).agg(_row_count().alias("n"))
    return counted.orderBy(F.desc("n"), key).limit(k)


# Years ----------------------------------------------------------------------


def keyed_by_year(revisions: DataFrame) -> DataFrame:
    """Revisions with their ``year``.

    This is the grouping by year with the groups left as rows: aggregate it
    with ``per_year`` instead of collecting a year's revisions in one place.
    """
    return revisions.withColumn("year", F.year("ts"))


def per_year(by_year: DataFrame, **aggregates: Column) -> DataFrame:
    """One row per year with the caller's aggregate columns."""
    if not aggregates:
        raise ValueError("give at least one aggregate")
    columns = [column.alias(name) for name, column in aggregates.items()]
    return by_year.groupBy("year").agg(*columns)


def revisions_in_group() -> Column:
    return _row_count()


def contributors_in_group() -> Column:
    return F.count_distinct("contributor")


def of_year(per_year_rows: DataFrame, year: int) -> DataFrame:
    """The row or rows of one year."""
    return per_year_rows.where(F.col("year") == year)


def contributor_year_counts(by_year: DataFrame) -> DataFrame:
    """``year, contributor, n_revisions``: a year's contributor counts as rows."""
    return by_year.groupBy("year", "contributor").agg(_row_count().alias("n_revisions"))


def contributor_year_lookup(by_year: DataFrame, year: int, contributor: str) -> DataFrame:
    """How often one contributor revised in one year; no row if never.

    The filters run before the grouping and reach the scan where they can.
    """
    wanted = by_year.where((F.col("year") == year) & (F.col("contributor") == contributor))
    return contributor_year_counts(wanted)


# Two datasets ---------------------------------------------------------------


def partition_by_contributor(
    revisions: DataFrame, partitions: int, shares: int = SHARES
) -> DataFrame:
    """Rows with ``part``, placed so that rows of one contributor and part share a partition.

    A contributor has one part, or several if more than a ``shares``-th of all
    revisions are theirs, so that no partition has to hold all of these.
    """
    parted = with_parts(revisions, "contributor", F.col("rid"), shares)
    return parted.repartition(partitions, "contributor", "part")


def cogroup_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both datasets' revisions, ``side`` telling which one a row is from.

    The whole content of a cogroup by contributor, as rows: grouping it by
    ``contributor`` gives a contributor's revisions from both sides.
    """
    columns = ["contributor", "aid", "rid", "ts"]
    return (
        left.select(F.lit("left").alias("side"), *columns)
        .unionByName(right.select(F.lit("right").alias("side"), *columns))
    )


def cogroup(left: DataFrame, right: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Per contributor of either dataset, the aggregates of both sides.

    Columns are ``left_<name>`` and ``right_<name>``, NULL on a side without
    the contributor. Each side is reduced before it is shuffled, and the join
    reuses that shuffle.
    """

    def side(revisions: DataFrame, prefix: str) -> DataFrame:
        columns = [column.alias(f"{prefix}_{name}") for name, column in aggregates.items()]
        return revisions.groupBy("contributor").agg(*columns)

    return side(left, "left").join(side(right, "right"), "contributor", "full_outer")


def cogroup_sizes(left: DataFrame, right: DataFrame) -> DataFrame:
    """``contributor, n_left, n_right``; 0 on a side without the contributor."""
    zero = F.lit(0).cast("bigint")
    return cogroup(left, right, {"n": _row_count()}).select(
        "contributor",
        F.coalesce("left_n", zero).alias("n_left"),
        F.coalesce("right_n", zero).alias("n_right"),
    )


def filter_cogroup(
    left: DataFrame, right: DataFrame, predicate: Column, when_absent: bool = False
) -> DataFrame:
    """Contributors for whom ``predicate`` holds on both sides.

    ``predicate`` is an aggregate that gives a boolean over a contributor's
    revisions; ``when_absent`` is its value for no revisions at all.
    """
    absent = F.lit(when_absent)
    return (
        cogroup(left, right, {"holds": predicate})
        .where(F.coalesce("left_holds", absent) & F.coalesce("right_holds", absent))
        .select("contributor")
    )


def not_empty() -> Column:
    return _row_count() > 0


def active_in(year: int) -> Column:
    return F.bool_or(F.year("ts") == year)


def contributors_in_both(
    left: DataFrame, right: DataFrame, condition: Column | None = None
) -> DataFrame:
    """Contributors with a revision in both datasets that fulfils ``condition``.

    Rows are filtered first and reduced to distinct names before the shuffle;
    the intersection then needs no further one.
    """

    def names(revisions: DataFrame) -> DataFrame:
        kept = revisions if condition is None else revisions.where(condition)
        return kept.select("contributor").distinct()

    return names(left).join(names(right), "contributor", "left_semi")
