"""Revision history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marram.functions import markup
from marram.functions.columns import map_get
from marram.operators import articles
from marram.plans.tables import (
    edits,
    page_records,
    revisions,
    titles,
    web_pages,
    with_tables,
)
from marram.sources.dumps import (
    page_totals,
    page_trees,
    parse_articles,
    parse_revisions,
    revisions_of_trees,
)


def _sides(spark, sf):
    return revisions(spark, sf, returned=False), revisions(spark, sf, returned=True)


def _parsed(spark, sf):
    return parse_articles(page_records(spark, sf))


def _partitions_per_contributor(spark, sf):
    """How the contributors' revisions are dealt out, in parts of at most a 5,000th of all."""
    placed = articles.partition_by_contributor(revisions(spark, sf), 16, shares=5000)
    return placed.groupBy("contributor", "part").agg(F.count(F.lit(1)).alias("n_revisions"))


def _accessors(spark, sf):
    answers = articles.with_accessors(_parsed(spark, sf))
    return answers.select(
        "aid",
        "title",
        "revision_count",
        "contributor_count",
        F.array_join("contributors", "|").alias("contributors"),
        F.array_join(F.col("revision_years").cast("array<string>"), "|").alias("years"),
        F.col("last_revision.rid").alias("last_rid"),
        F.col("last_revision.ts").alias("last_ts"),
    )


def _contributor_pairs(spark, sf):
    return articles.contributor_pairs(_parsed(spark, sf)).select(
        "contributor", "revision.rid", "revision.ts"
    )


def _page_counts(spark, sf):
    """How often each page's contributors revised it, asked of a map for one of them."""
    flat = parse_revisions(page_records(spark, sf, numbered=True))
    page = ["page_id", "aid", "title"]
    counted = flat.groupBy(*page, "contributor").agg(F.count(F.lit(1)).cast("int").alias("n"))
    maps = counted.groupBy(*page).agg(
        F.map_from_entries(F.collect_list(F.struct("contributor", "n"))).alias("counts")
    )
    return maps.select("aid", "title", map_get("counts", F.lit("")).alias("n_unnamed"))


QUERIES = {
    # Flat revisions
    "article_totals": lambda s, d: articles.article_totals(edits(s, d)),
    "unique_contributors": lambda s, d: articles.unique_contributors(revisions(s, d)),
    "article_years": lambda s, d: articles.article_years(edits(s, d)),
    "article_years_distinct": lambda s, d: articles.article_years(
        edits(s, d), pick="earliest", distinct=True
    ),
    "articles_min_activity": lambda s, d: articles.count_busy_articles(revisions(s, d), 32, 10),
    "articles_min_activity_distinct": lambda s, d: articles.count_busy_articles(
        revisions(s, d), 25, 30, distinct_contributors=True
    ),
    "articles_by_revisions": lambda s, d: articles.articles_by_revisions(edits(s, d), titles(s, d)),
    "top_articles": lambda s, d: articles.top_articles(edits(s, d), titles(s, d), 3),
    "contributors_by_revisions": lambda s, d: articles.contributors_by_revisions(revisions(s, d)),
    "top_contributors": lambda s, d: articles.top_contributors(revisions(s, d), 3),
    "revisions_keyed_by_year": lambda s, d: articles.keyed_by_year(edits(s, d)),
    "revisions_per_year": lambda s, d: articles.per_year(
        articles.keyed_by_year(edits(s, d)), n_revisions=articles.revisions_in_group()
    ),
    "revisions_in_year": lambda s, d: articles.per_year(
        articles.of_year(articles.keyed_by_year(edits(s, d)), 1998),
        n_revisions=articles.revisions_in_group(),
    ),
    "contributors_per_year": lambda s, d: articles.per_year(
        articles.keyed_by_year(revisions(s, d)),
        n_contributors=articles.contributors_in_group(),
    ),
    "year_summary": lambda s, d: articles.per_year(
        articles.keyed_by_year(edits(s, d)),
        first_ts=F.min("ts"),
        last_ts=F.max("ts"),
        n_articles=F.count_distinct("aid"),
    ),
    "contributor_year_counts": lambda s, d: articles.contributor_year_counts(
        articles.keyed_by_year(revisions(s, d))
    ),
    "contributor_year_lookup": lambda s, d: articles.contributor_year_lookup(
        articles.keyed_by_year(revisions(s, d)), 1998, "7"
    ),
    # Two datasets
    "cogroup_rows": lambda s, d: articles.cogroup_rows(*_sides(s, d)),
    "cogroup_sizes": lambda s, d: articles.cogroup_sizes(*_sides(s, d)),
    "cogroup_filter": lambda s, d: articles.filter_cogroup(
        *_sides(s, d), F.count(F.lit(1)) >= 15
    ),
    "cogroup_filter_active": lambda s, d: articles.filter_cogroup(
        *_sides(s, d), articles.active_in(1998)
    ),
    "contributors_in_both": lambda s, d: articles.contributors_in_both(*_sides(s, d)),
    "contributors_in_both_year": lambda s, d: articles.contributors_in_both(
        *_sides(s, d), F.year("ts") == 1998
    ),
    "contributor_partitions": _partitions_per_contributor,
    # Pages of a dump
    "article_parse": lambda s, d: parse_revisions(page_records(s, d)),
    "article_parse_tree": lambda s, d: revisions_of_trees(page_trees(page_records(s, d))),
    "article_parse_nested": lambda s, d: articles.flatten(_parsed(s, d)),
    "article_accessors": _accessors,
    "article_contributor_pairs": _contributor_pairs,
    "article_text": lambda s, d: articles.article_text(_parsed(s, d)),
    "article_page_counts": _page_counts,
    "article_page_totals": lambda s, d: page_totals(page_records(s, d)),
    "article_totals_nested": lambda s, d: articles.totals_of_articles(_parsed(s, d)),
    "article_page_years": lambda s, d: articles.years_of_articles(_parsed(s, d)),
    "article_page_first_years": lambda s, d: articles.years_of_articles(
        _parsed(s, d), pick="earliest", distinct=True
    ),
    "article_page_activity": lambda s, d: articles.busy_articles(
        _parsed(s, d), 3, 2, distinct_contributors=True
    ).select("aid", "title", F.size("revisions").alias("n_revisions")),
    "article_page_in_year": lambda s, d: articles.articles_with(
        _parsed(s, d), lambda r: F.year(r["ts"]) == 1998
    ).select("aid", "title"),
    # Web pages
    "page_title": lambda s, d: web_pages(s, d).select(
        "page_id", markup.element_text("html", "title").alias("title")
    ),
    "page_elements": lambda s, d: web_pages(s, d).select(
        "page_id", F.posexplode(markup.elements("html", "p")).alias("ord", "element")
    ),
    "page_element_texts": lambda s, d: web_pages(s, d).select(
        "page_id", F.explode(markup.elements("html", "li")).alias("element")
    ).select("page_id", markup.element_text("element", "a").alias("link_text")),
}

ORACLE = {
    "article_parse_tree": with_tables(
        "articles",
        then="""SELECT CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE o_orderkey END AS aid,
  title, CAST(ord AS INTEGER) AS ord, rid, contributor, ts FROM flat""",
    ),
    "article_totals": with_tables(
        "edits", then="SELECT count(DISTINCT aid) AS n_articles, count(*) AS n_revisions FROM edits"
    ),
    "unique_contributors": with_tables(
        "revisions", then="SELECT count(DISTINCT contributor) AS n_contributors FROM revisions"
    ),
    "article_years": with_tables(
        "edits",
        then="SELECT aid, CAST(year(max(ts)) AS INTEGER) AS year FROM edits GROUP BY aid",
    ),
    "article_years_distinct": with_tables(
        "edits",
        then="""SELECT DISTINCT year FROM
  (SELECT aid, CAST(year(min(ts)) AS INTEGER) AS year FROM edits GROUP BY aid)""",
    ),
    "articles_min_activity": with_tables(
        "revisions",
        then="""SELECT count(*) AS n_articles FROM (SELECT aid FROM revisions GROUP BY aid
  HAVING count(*) >= 32 AND count(contributor) >= 10)""",
    ),
    "articles_min_activity_distinct": with_tables(
        "revisions",
        then="""SELECT count(*) AS n_articles FROM (SELECT aid FROM revisions GROUP BY aid
  HAVING count(*) >= 25 AND count(DISTINCT contributor) >= 30)""",
    ),
    "articles_by_revisions": with_tables(
        "edits",
        then="""SELECT aid, p_name AS title, n_revisions FROM
  (SELECT aid, count(*) AS n_revisions FROM edits GROUP BY aid) LEFT JOIN part ON aid = p_partkey
  ORDER BY n_revisions DESC, aid""",
    ),
    "top_articles": with_tables(
        "edits",
        then="""SELECT CAST(rank AS INTEGER) AS rank, aid, p_name AS title, n_revisions FROM
  (SELECT aid, n_revisions, row_number() OVER (ORDER BY n_revisions DESC, aid) AS rank
   FROM (SELECT aid, count(*) AS n_revisions FROM edits GROUP BY aid))
  LEFT JOIN part ON aid = p_partkey WHERE rank <= 3""",
    ),
    "contributors_by_revisions": with_tables(
        "revisions",
        then="""SELECT contributor, count(*) AS n_revisions FROM revisions GROUP BY contributor
  ORDER BY n_revisions DESC, contributor""",
    ),
    "top_contributors": with_tables(
        "revisions",
        then="""SELECT contributor, count(*) AS n_revisions FROM revisions GROUP BY contributor
  ORDER BY n_revisions DESC, contributor LIMIT 3""",
    ),
    "revisions_keyed_by_year": with_tables(
        "edits", then="SELECT *, CAST(year(ts) AS INTEGER) AS year FROM edits"
    ),
    "revisions_per_year": with_tables(
        "edits",
        then="SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS n_revisions FROM edits GROUP BY 1",
    ),
    "revisions_in_year": with_tables(
        "edits",
        then="""SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS n_revisions FROM edits
  WHERE year(ts) = 1998 GROUP BY 1""",
    ),
    "contributors_per_year": with_tables(
        "revisions",
        then="""SELECT CAST(year(ts) AS INTEGER) AS year, count(DISTINCT contributor) AS n_contributors
  FROM revisions GROUP BY 1""",
    ),
    "year_summary": with_tables(
        "edits",
        then="""SELECT CAST(year(ts) AS INTEGER) AS year, min(ts) AS first_ts, max(ts) AS last_ts,
  count(DISTINCT aid) AS n_articles FROM edits GROUP BY 1""",
    ),
    "contributor_year_counts": with_tables(
        "revisions",
        then="""SELECT CAST(year(ts) AS INTEGER) AS year, contributor, count(*) AS n_revisions
  FROM revisions GROUP BY 1, 2""",
    ),
    "contributor_year_lookup": with_tables(
        "revisions",
        then="""SELECT CAST(year(ts) AS INTEGER) AS year, contributor, count(*) AS n_revisions
  FROM revisions WHERE year(ts) = 1998 AND contributor = '7' GROUP BY 1, 2""",
    ),
    "cogroup_rows": with_tables(
        "sides",
        then="""SELECT 'left' AS side, contributor, aid, rid, ts FROM a
  UNION ALL SELECT 'right' AS side, contributor, aid, rid, ts FROM r""",
    ),
    "cogroup_sizes": with_tables(
        "sides",
        then="""SELECT coalesce(l.contributor, g.contributor) AS contributor,
  coalesce(l.n, 0) AS n_left, coalesce(g.n, 0) AS n_right
  FROM (SELECT contributor, count(*) AS n FROM a GROUP BY 1) l
  FULL OUTER JOIN (SELECT contributor, count(*) AS n FROM r GROUP BY 1) g
  ON l.contributor = g.contributor""",
    ),
    "cogroup_filter": with_tables(
        "sides",
        then="""SELECT contributor FROM a GROUP BY 1 HAVING count(*) >= 15
  INTERSECT SELECT contributor FROM r GROUP BY 1 HAVING count(*) >= 15""",
    ),
    "cogroup_filter_active": with_tables(
        "sides",
        then="""SELECT contributor FROM a WHERE year(ts) = 1998
  INTERSECT SELECT contributor FROM r WHERE year(ts) = 1998""",
    ),
    "contributors_in_both": with_tables(
        "sides", then="SELECT contributor FROM a INTERSECT SELECT contributor FROM r"
    ),
    "contributors_in_both_year": with_tables(
        "sides",
        then="""SELECT contributor FROM a WHERE year(ts) = 1998
  INTERSECT SELECT contributor FROM r WHERE year(ts) = 1998""",
    ),
    "contributor_partitions": with_tables(
        "revisions",
        then="""SELECT contributor, part, count(*) AS n_revisions FROM
  (SELECT contributor, rid % CASE WHEN n * 5000 > total THEN CAST(ceil(n * CAST(5000 AS DOUBLE) / total) AS BIGINT)
    ELSE 1 END AS part FROM (SELECT *, count(*) OVER (PARTITION BY contributor) AS n, count(*) OVER () AS total
    FROM revisions)) GROUP BY 1, 2""",
    ),
    "article_parse": with_tables(
        "articles",
        then="""SELECT aid, title, CAST(ord AS INTEGER) AS ord, rid, contributor, ts FROM flat""",
    ),
    "article_parse_nested": with_tables(
        "articles",
        then="""SELECT aid, title, CAST(ord AS INTEGER) AS ord, rid, contributor, ts FROM flat""",
    ),
    "article_accessors": with_tables(
        "articles",
        then="""SELECT aid, title, CAST(count(*) AS INTEGER) AS revision_count,
  CAST(count(*) AS INTEGER) AS contributor_count,
  string_agg(contributor, '|' ORDER BY ord) AS contributors,
  string_agg(CAST(year(ts) AS VARCHAR), '|' ORDER BY ord) AS years,
  last(rid ORDER BY ord) AS last_rid, last(ts ORDER BY ord) AS last_ts
  FROM flat GROUP BY o_orderkey, aid, title""",
    ),
    "article_contributor_pairs": with_tables(
        "articles", then="SELECT contributor, rid, ts FROM flat"
    ),
    "article_text": with_tables(
        "articles",
        then=r"""SELECT aid, aid || ',' || title || E'\n' || string_agg(E'\t' || rid || ',' || contributor
    || ',' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || E'\n', '' ORDER BY ord) AS text
  FROM flat GROUP BY o_orderkey, aid, title""",
    ),
    "article_page_counts": with_tables(
        "articles",
        then="""SELECT aid, title, CAST(nullif(count(*) FILTER (contributor = ''), 0) AS INTEGER) AS n_unnamed
  FROM flat GROUP BY o_orderkey, aid, title""",
    ),
    "article_page_totals": with_tables(
        "articles",
        then="SELECT count(DISTINCT o_orderkey) AS n_articles, count(*) AS n_revisions FROM flat",
    ),
    "article_totals_nested": with_tables(
        "articles",
        then="SELECT count(DISTINCT o_orderkey) AS n_articles, count(*) AS n_revisions FROM flat",
    ),
    "article_page_years": with_tables(
        "articles",
        then="""SELECT aid, CAST(year(last(ts ORDER BY ord)) AS INTEGER) AS year
  FROM flat GROUP BY o_orderkey, aid""",
    ),
    "article_page_first_years": with_tables(
        "articles",
        then="""SELECT DISTINCT year FROM (SELECT CAST(year(min(ts)) AS INTEGER) AS year
  FROM flat GROUP BY o_orderkey)""",
    ),
    "article_page_activity": with_tables(
        "articles",
        then="""SELECT aid, title, CAST(count(*) AS INTEGER) AS n_revisions FROM flat
  GROUP BY o_orderkey, aid, title HAVING count(*) >= 3 AND count(DISTINCT contributor) >= 2""",
    ),
    "article_page_in_year": with_tables(
        "articles",
        then="""SELECT aid, title FROM flat GROUP BY o_orderkey, aid, title
  HAVING bool_or(year(ts) = 1998)""",
    ),
    "page_title": """SELECT page_id, regexp_extract(html, '(?s)<title[^>]*?>(.+?)</title>', 1) AS title
FROM pages""",
    "page_elements": """SELECT page_id, unnest(found) AS element,
  CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS ord FROM
  (SELECT page_id, regexp_extract_all(html, '(?s)(<p[^>]*?>.+?</p>)', 1) AS found FROM pages)""",
    "page_element_texts": """SELECT page_id, regexp_extract(element, '(?s)<a[^>]*?>(.+?)</a>', 1) AS link_text
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?s)(<li[^>]*?>.+?</li>)', 1)) AS element FROM pages)""",
}
