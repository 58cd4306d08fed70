"""Queries on stored placement, on rows in order, and on lines of files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marram.operators import articles, distinct, index, ordered, placed, words
from marram.plans.tables import documents, lines, revisions, with_tables
from marram.session import work_dir
from marram.sources.text import numbered_table_lines, read_numbered_lines

# Documents of so many ids in a row are written to one text file.
DOCUMENTS_A_FILE = 500


def _placed_sides(spark, sf):
    sides = (revisions(spark, sf, returned=False), revisions(spark, sf, returned=True))
    return placed.place(work_dir(spark), *sides, buckets=16, shares=500)


def _placed_activity(spark, sf):
    """First and last revision of each contributor on both stored sides."""
    span = {"first_ts": F.min("ts"), "last_ts": F.max("ts"), "n_articles": F.count_distinct("aid")}
    return placed.cogroup(*_placed_sides(spark, sf), span)


def _file_lines(spark, sf):
    """All documents' lines as text files, read back with their file's number and line numbers."""
    shelf = F.floor(F.col("doc_id") / DOCUMENTS_A_FILE).cast("bigint").alias("shelf")
    folder = f"{work_dir(spark)}/lines-{uuid.uuid4().hex}"
    written = lines(spark, sf).select(shelf, "doc_id", "line_id", "line")
    written = written.repartitionByRange("shelf").sortWithinPartitions("shelf", "doc_id", "line_id")
    written.select("shelf", "line").write.partitionBy("shelf").text(folder)
    numbered = read_numbered_lines(spark, folder)
    number = F.regexp_extract("file", r"shelf=(\d+)", 1).cast("bigint")
    return numbered.select(number.alias("file"), "line_no", "line")


# Line 4 of an order stands for a revert, any other for a plain revision.
_REVERTED_TWICE = ordered.Automaton(
    kinds=[lambda r: r["rid"] % 10 == 4],
    # None yet, one revert, two in a row, revised again.
    moves=[[1, 2, 2, 3], [0, 0, 3, 3]],
    accepting=[3],
)


def _year_spans(years):
    """All spans of the years of a table: ``first, last``, a row for each two of them."""
    one = years.select("year").distinct()
    first, last = one.select(F.col("year").alias("first")), one.select(F.col("year").alias("last"))
    return F.broadcast(first.join(last, F.col("first") <= F.col("last")))


def _in_spans(by_year):
    return by_year.join(_year_spans(by_year), F.col("year").between(F.col("first"), F.col("last")))


def _span_contributors(spark, sf):
    """Distinct contributors of every span of years, from the years' bitmaps."""
    rows = revisions(spark, sf)
    bitmaps = distinct.year_bitmaps(rows, distinct.contributor_numbers(rows))
    merged = distinct.merged_bitmaps(_in_spans(bitmaps), "first", "last")
    return distinct.counted_bitmaps(merged, "first", "last")


def _common_by_bitmaps(spark, sf):
    left, right = revisions(spark, sf, returned=False), revisions(spark, sf, returned=True)
    numbers = distinct.contributor_numbers(left, right)
    sides = (distinct.merged_bitmaps(distinct.year_bitmaps(side, numbers)) for side in (left, right))
    return distinct.counted_bitmaps(distinct.common_bitmaps(*sides))


def _estimates(spark, sf):
    """Of every span of years whether the years' sketches, merged, give its contributors within the error."""
    exact = _span_contributors(spark, sf)
    sketches = _in_spans(distinct.year_sketches(revisions(spark, sf)))
    told = distinct.merged_sketches(sketches, "first", "last").withColumn("estimate", distinct.estimate())
    off = F.abs(F.col("estimate") - F.col("n_contributors"))
    return exact.join(told, ["first", "last"]).select(
        "first", "last", "n_contributors", (off <= F.col("n_contributors") * distinct.error()).alias("within_error")
    )


def _common_estimate(spark, sf):
    """Whether sketches of both sides give the contributors in both within the error of the larger side."""
    sides = [revisions(spark, sf, returned=kind) for kind in (False, True)]
    sketches = [distinct.merged_sketches(distinct.year_sketches(side)) for side in sides]
    told = distinct.common_estimate(*sketches).withColumnRenamed("n_contributors", "told")
    larger = sketches[0].unionAll(sketches[1]).agg(F.max(distinct.estimate()).alias("larger"))
    both = _common_by_bitmaps(spark, sf).join(told, F.lit(True)).join(larger, F.lit(True))
    off = F.abs(F.col("told") - F.col("n_contributors"))
    return both.select("n_contributors", (off <= F.col("larger") * distinct.error()).alias("within_error"))


QUERIES = {
    "span_contributors": _span_contributors,
    "common_contributors": _common_by_bitmaps,
    "span_contributor_estimates": _estimates,
    "common_contributor_estimate": _common_estimate,
    "placed_lookup": lambda s, d: placed.lookup(_placed_sides(s, d)[0], "7"),
    "placed_cogroup_sizes": lambda s, d: placed.cogroup_sizes(*_placed_sides(s, d)),
    "placed_activity": _placed_activity,
    "longest_runs_per_year": lambda s, d: ordered.fold_groups(
        articles.keyed_by_year(revisions(s, d)), ["year"], ["ts", "rid"], ordered.longest_run("contributor"), "longest_run"
    ),
    "article_longest_runs": lambda s, d: ordered.fold_groups(
        revisions(s, d).withColumn("year", F.year("ts")), ["aid"], ["ts", "rid"], ordered.longest_run("year"), "longest_run"
    ),
    "reverted_twice_in_both": lambda s, d: ordered.filter_cogroup_in_order(
        revisions(s, d, returned=False), revisions(s, d, returned=True), _REVERTED_TWICE
    ),
    "top_contributors_pruned": lambda s, d: articles.top_by_count(revisions(s, d), "contributor", 10),
    "top_words_pruned": lambda s, d: articles.top_by_count(words.word_stream(documents(s, d)), "word", 25),
    "file_lines": _file_lines,
    "file_line_search": lambda s, d: words.find_lines(numbered_table_lines(_file_lines(s, d)), "the", k=20),
    "file_header_carry": lambda s, d: index.carry_documents(_with_headers(_file_lines(s, d)), lines_per_block=64),
}


def _with_headers(numbered):
    """Lines of files, of which every seventh opens a document."""
    header = F.concat(F.lit('<Document docno="'), F.col("line_no").cast("string"), F.lit('">'))
    return numbered.select("file", "line_no", F.when(F.col("line_no") % 7 == 0, header).otherwise(F.col("line")).alias("line"))


_FILE_LINES = f"""file_lines AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id, line_id) AS line_no, line
    FROM (SELECT *, CAST(floor(doc_id / {DOCUMENTS_A_FILE}) AS BIGINT) AS file FROM lines))"""


def _of_files(then: str) -> str:
    return with_tables("lines", then="").rstrip() + ",\n  " + _FILE_LINES + "\n" + then


def _runs(key: str, value: str) -> str:
    """Longest runs by the difference of two row numbers."""
    return f"""SELECT {key}, max(n) AS longest_run FROM (
    SELECT {key}, count(*) AS n FROM (
      SELECT {key}, {value} AS v, row_number() OVER (PARTITION BY {key} ORDER BY ts, rid)
        - row_number() OVER (PARTITION BY {key}, {value} ORDER BY ts, rid) AS run
      FROM (SELECT *, CAST(year(ts) AS INTEGER) AS year FROM revisions))
    GROUP BY {key}, v, run) GROUP BY {key}"""


def _reverted(side: str) -> str:
    return f"""SELECT contributor FROM (
      SELECT contributor, rid % 10 = 4 AS revert, row_number() OVER w AS n,
        rid % 10 = 4 AND coalesce(lag(rid) OVER w % 10 = 4, false) AS second FROM {side}
      WINDOW w AS (PARTITION BY contributor ORDER BY ts, rid))
    GROUP BY contributor HAVING min(n) FILTER (second) < max(n) FILTER (NOT revert)"""


_SPANS = """SELECT f.year AS first, l.year AS last, (SELECT count(DISTINCT contributor) FROM revisions
    WHERE year(ts) BETWEEN f.year AND l.year) AS n_contributors
  FROM (SELECT DISTINCT CAST(year(ts) AS INTEGER) AS year FROM revisions) f
  JOIN (SELECT DISTINCT CAST(year(ts) AS INTEGER) AS year FROM revisions) l ON f.year <= l.year"""
_COMMON = "SELECT count(*) AS n_contributors FROM (SELECT contributor FROM a INTERSECT SELECT contributor FROM r)"

ORACLE = {
    "span_contributors": with_tables("revisions", then=_SPANS),
    "common_contributors": with_tables("sides", then=_COMMON),
    "span_contributor_estimates": with_tables("revisions", then=f"SELECT *, true AS within_error FROM ({_SPANS})"),
    "common_contributor_estimate": with_tables("sides", then=f"SELECT *, true AS within_error FROM ({_COMMON})"),
    "placed_lookup": with_tables("sides", then="SELECT aid, rid, contributor, ts FROM a WHERE contributor = '7'"),
    "placed_cogroup_sizes": with_tables(
        "sides",
        then="""SELECT coalesce(x.contributor, y.contributor) AS contributor,
  coalesce(n, 0) AS n_left, coalesce(m, 0) AS n_right
  FROM (SELECT contributor, count(*) AS n FROM a GROUP BY contributor) x
  FULL JOIN (SELECT contributor, count(*) AS m FROM r GROUP BY contributor) y ON x.contributor = y.contributor""",
    ),
    "placed_activity": with_tables(
        "sides",
        then="""SELECT coalesce(x.contributor, y.contributor) AS contributor,
  x.f AS left_first_ts, x.l AS left_last_ts, x.n AS left_n_articles,
  y.f AS right_first_ts, y.l AS right_last_ts, y.n AS right_n_articles
  FROM (SELECT contributor, min(ts) AS f, max(ts) AS l, count(DISTINCT aid) AS n FROM a GROUP BY contributor) x
  FULL JOIN (SELECT contributor, min(ts) AS f, max(ts) AS l, count(DISTINCT aid) AS n FROM r GROUP BY contributor) y
  ON x.contributor = y.contributor""",
    ),
    "longest_runs_per_year": with_tables("revisions", then=_runs("year", "contributor")),
    "article_longest_runs": with_tables("revisions", then=_runs("aid", "year")),
    "reverted_twice_in_both": with_tables("sides", then=f"{_reverted('a')} INTERSECT {_reverted('r')}"),
    "top_contributors_pruned": with_tables(
        "revisions",
        then="SELECT contributor, count(*) AS n FROM revisions GROUP BY contributor ORDER BY n DESC, contributor LIMIT 10",
    ),
    "top_words_pruned": with_tables(
        "words", then="SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 25"
    ),
    "file_lines": _of_files("SELECT file, line_no, line FROM file_lines"),
    "file_line_search": _of_files(
        """SELECT CAST(strpos(line, 'the') - 1 AS INTEGER) AS idx, file AS doc_id, line_no AS line_id, line
  FROM file_lines WHERE strpos(line, 'the') > 0 ORDER BY idx DESC, file, line_no LIMIT 20"""
    ),
    "file_header_carry": _of_files(
        """SELECT file, (line_no // 7) * 7 AS doc_id, line_no - (line_no // 7) * 7 AS line_id,
    CASE WHEN line_no % 7 = 0 THEN '<Document docno="' || line_no || '">' ELSE line END AS line
  FROM file_lines"""
    ),
}
