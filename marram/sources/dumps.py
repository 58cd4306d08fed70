"""Article dumps: text files made of ``<page>`` records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions import fixed, markup


def read_page_records(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per page: ``page``, the text up to and with the page's end tag.

    Files split between pages, so one large dump is read by many tasks. As
    any text after the last page also ends up with an end tag, a dump yields
    one more record than it has pages; ``parse_articles`` drops it.
    """
    records = spark.read.option("lineSep", fixed.PAGE_END).text(list(paths))
    return records.where(F.col("value") != "").select(
        F.concat("value", F.lit(fixed.PAGE_END)).alias("page")
    )


def parse_articles(pages: DataFrame, page_column: str = "page", on_bad_ts: str = "fail") -> DataFrame:
    """Articles with at least one revision: ``aid, title, revisions``.

    ``revisions`` is an array of ``struct<rid, contributor, ts>`` in page
    order. Columns other than the page are kept in front. A timestamp that
    cannot be read fails the job, or becomes NULL with ``on_bad_ts='null'``.
    """
    texts = F.transform(markup.elements(page_column, "revision"), markup.revision_texts)
    return pages.where(markup.has_element(page_column, "revision")).select(
        *_article_columns(pages, page_column),
        F.transform(texts, lambda t: markup.revision_struct(t, on_bad_ts)).alias("revisions"),
    )


def page_totals(pages: DataFrame, page_column: str = "page") -> DataFrame:
    """``n_articles, n_revisions`` of pages with revisions, without parsing these.

    The revisions are cut out and counted; what stands in them is not read, so
    bad timestamps go unnoticed.
    """
    cut = pages.select(F.size(markup.elements(page_column, "revision")).cast("bigint").alias("n"))
    return cut.agg(
        F.count_if(F.col("n") > 0).alias("n_articles"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_revisions"),
    )


def _article_columns(pages: DataFrame, page_column: str) -> list[Column]:
    return [
        *[F.col(name) for name in pages.columns if name != page_column],
        markup.id_or_default(markup.element_text(page_column, "id")).alias("aid"),
        markup.element_text(page_column, "title").alias("title"),
    ]


def parse_revisions(pages: DataFrame, page_column: str = "page", on_bad_ts: str = "fail") -> DataFrame:
    """The same articles as flat revisions: ``aid, title, ord, rid, contributor, ts``.

    ``ord`` is the revision's place in its page, from 0. Cheaper than parsing
    to arrays and flattening them: no array of parsed revisions is built.
    """
    articles = _article_columns(pages, page_column)
    names = [name for name in pages.columns if name != page_column] + ["aid", "title"]
    found = pages.select(*articles, markup.elements(page_column, "revision").alias("all_found"))
    # An outer generator, as Spark would evaluate the extraction a second time
    # to filter out pages without revisions ahead of an inner one; and a step of
    # its own, as it would otherwise read id and title off the page once per
    # revision.
    cut = found.select(*names, F.posexplode_outer("all_found").alias("ord", "found")).where(
        F.col("ord").isNotNull()
    )
    parsed = cut.select(*names, "ord", markup.revision_texts("found").alias("texts"))
    revision = markup.revision_struct(F.col("texts"), on_bad_ts)
    return parsed.select(*names, "ord", revision.alias("revision")).select(
        *names, "ord", "revision.rid", "revision.contributor", "revision.ts"
    )


def read_articles(spark: SparkSession, *paths: str, on_bad_ts: str = "fail") -> DataFrame:
    """Articles of a dump; call it once per dump to compare two of them."""
    return parse_articles(read_page_records(spark, *paths), on_bad_ts=on_bad_ts)


def read_revisions(spark: SparkSession, *paths: str, on_bad_ts: str = "fail") -> DataFrame:
    """Flat revisions of a dump."""
    return parse_revisions(read_page_records(spark, *paths), on_bad_ts=on_bad_ts)


# Markup as a tree -----------------------------------------------------------

_PAGE_TREE = (
    "title string, id string, revision array<struct<id string, timestamp string, "
    "contributor struct<username string, ip string>>>, corrupt string"
)
_XML_OPTIONS = {"rowTag": "page", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}


def read_page_trees(spark: SparkSession, *paths: str) -> DataFrame:
    """Pages of a dump, read as XML: ``title, id, revision, corrupt``.

    A page that is no well-formed XML has its text in ``corrupt`` and leaves
    the others as they are. Entities and character data sections are resolved,
    and white space around a text goes. Pages are cut by their end tags, so
    that files split between them; Spark's reader of XML files would take each
    file in one task, and fail with its first malformed page.
    """
    records = read_page_records(spark, *paths)
    # What stands before a page, such as the dump's head, is none of it.
    cut = records.select(F.regexp_extract("page", r"(?s)<page[\s>].*", 0).alias("page"))
    return page_trees(cut.where(F.col("page") != ""))


def page_trees(pages: DataFrame, page_column: str = "page") -> DataFrame:
    """The same from a column of page texts; other columns are kept in front."""
    others = [name for name in pages.columns if name != page_column]
    tree = F.from_xml(F.col(page_column), _PAGE_TREE, _XML_OPTIONS)
    return pages.select(*others, tree.alias("tree")).select(*others, "tree.*")


def revisions_of_trees(trees: DataFrame, on_bad_ts: str = "fail") -> DataFrame:
    """Flat revisions ``aid, title, ord, rid, contributor, ts`` of pages that could be read.

    They are those of ``parse_revisions`` where elements stand where they
    belong, but for what patterns cannot tell: entities are resolved; an
    element must have the very name; and a page without an id of its own has
    the default, not the id of its first revision. Of elements that should
    stand once, the last counts.
    """
    read = trees.where(F.col("corrupt").isNull()).select(
        markup.id_or_default(F.coalesce("id", F.lit(""))).alias("aid"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.posexplode_outer("revision").alias("ord", "r"),
    )
    user, address = F.col("r.contributor.username"), F.col("r.contributor.ip")
    contributor = F.when(F.coalesce(user, F.lit("")) != "", user).otherwise(F.coalesce(address, F.lit("")))
    return read.where(F.col("ord").isNotNull()).select(
        "aid",
        "title",
        "ord",
        markup.id_or_default(F.coalesce("r.id", F.lit(""))).alias("rid"),
        contributor.alias("contributor"),
        markup.utc_instant(F.coalesce("r.timestamp", F.lit("")), on_bad_ts).alias("ts"),
    )


def corrupt_pages(trees: DataFrame) -> DataFrame:
    """``corrupt``: the texts of pages that could not be read."""
    return trees.where(F.col("corrupt").isNotNull()).select("corrupt")
