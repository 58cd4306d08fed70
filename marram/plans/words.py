"""Word, line and index queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marram.functions import text
from marram.operators import index, stored_index, words
from marram.plans.tables import (
    STOP_WORDS,
    collection_records,
    documents,
    files_with_headers,
    item_words,
    lines,
    with_tables,
)
from marram.session import work_dir
from marram.sources.text import documents_from_records

# A word that the stored index is asked for, and from and to which document.
_ASKED, _FROM_DOCUMENT, _TO_DOCUMENT = "of", 100, 700


def _stream(spark, sf):
    return words.word_stream(documents(spark, sf))


def _postings(spark, sf):
    return index.postings(lines(spark, sf), STOP_WORDS)


def _stored(spark, sf):
    postings = _postings(spark, sf).withColumn("line_id", F.col("line_id").cast("bigint"))
    return stored_index.store(f"{work_dir(spark)}/index-{uuid.uuid4().hex}", postings)


def _index_words(spark, sf):
    return index.distinct_words(index.occurrences(lines(spark, sf), STOP_WORDS))


def _case_blind(line, target):
    return F.instr(F.lower(line), target.lower()) - 1


def _placed(spark, sf):
    """Words with their length range and part of it, in parts of about a fiftieth of all."""
    return index.place_by_bucket(_index_words(spark, sf), 8, shares=50)


def _counters(spark, sf):
    """Both counters of the index job in one pass over the distinct words."""
    kinds = _index_words(spark, sf).select(text.word_kind("word").alias("kind"))
    return kinds.where("kind IS NOT NULL").groupBy("kind").agg(F.count(F.lit(1)).alias("n_words"))


QUERIES = {
    "word_total": lambda s, d: words.count_words(_stream(s, d)),
    "word_unique": lambda s, d: words.unique_words(_stream(s, d)),
    "word_longest": lambda s, d: words.longest_word(_stream(s, d)),
    "word_three": lambda s, d: words.count_words_of_length(_stream(s, d), 3),
    "word_avg_len": lambda s, d: words.average_word_length(_stream(s, d)),
    "word_counts": lambda s, d: words.word_counts(_stream(s, d)),
    "word_lookup": lambda s, d: words.word_counts(_stream(s, d).where(F.col("word") == "the")),
    "words_by_letter": lambda s, d: words.words_by_first_letter(_stream(s, d)),
    "letter_set_sizes": lambda s, d: words.letter_set_sizes(_stream(s, d)),
    "text_lines": lines,
    "collection_documents": lambda s, d: documents_from_records(collection_records(s, d)),
    "line_search": lambda s, d: words.find_lines(lines(s, d), "the", k=20),
    "line_search_matcher": lambda s, d: words.find_lines(lines(s, d), "The", _case_blind, k=20),
    "frequent_words": lambda s, d: words.sorted_by_word(words.frequent_words(documents(s, d))),
    "all_word_frequencies": lambda s, d: words.frequent_words(documents(s, d), min_count=1),
    "index_occurrences": lambda s, d: index.occurrences(lines(s, d), STOP_WORDS),
    "index_postings": _postings,
    "index_postings_grouped": lambda s, d: index.count_occurrences(
        index.occurrences(lines(s, d), STOP_WORDS)
    ),
    "index_stop_table": lambda s, d: index.occurrences_without(lines(s, d), item_words(s, d)),
    "index_doc_lines": lambda s, d: index.document_counts(_postings(s, d)),
    "index_totals": lambda s, d: index.token_totals(lines(s, d), STOP_WORDS),
    "index_totals_of_postings": lambda s, d: index.word_totals(_postings(s, d)),
    "index_number_words": lambda s, d: index.number_words(_index_words(s, d)),
    "index_palindromes": lambda s, d: index.palindromes(_index_words(s, d)),
    "index_counters": _counters,
    "index_partitions": lambda s, d: index.with_bucket(_index_words(s, d), 8),
    "index_placement": _placed,
    "index_tree": lambda s, d: index.tree_rows(_postings(s, d), 8),
    "index_stored": lambda s, d: stored_index.all_postings(_stored(s, d)),
    "index_stored_words": lambda s, d: stored_index.words_of(_stored(s, d).dictionary).drop("word_id"),
    "index_stored_lookup": lambda s, d: stored_index.lookup(
        _stored(s, d), _ASKED, _FROM_DOCUMENT, _TO_DOCUMENT
    ),
    "index_header_carry": lambda s, d: index.carry_documents(
        files_with_headers(s, d), lines_per_block=4
    ),
}

_DELIMITERS = r"""[ \t\n\r\f!"\\#$%&()''*+,\-./:;<=>?@\[\]^`{|}~]+"""

_TOKENS = rf"""tokens AS (SELECT doc_id, line_id, unnest(kept) AS word,
    CAST(generate_subscripts(kept, 1) - 1 AS INTEGER) AS pos FROM
    (SELECT doc_id, line_id, list_filter(string_split_regex(line, '{_DELIMITERS}'),
      lambda t: t <> '' AND t NOT IN ('the', 'and', 'en', 'de')) AS kept FROM lines)),
  postings AS (SELECT word, doc_id, line_id, min(pos) AS pos, count(*) AS n
    FROM tokens GROUP BY word, doc_id, line_id),
  doc_lines AS (SELECT word, doc_id, count(*) AS n_lines, CAST(sum(n) AS BIGINT) AS n
    FROM postings GROUP BY word, doc_id),
  totals AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM doc_lines GROUP BY word)"""

_BUCKET = "CAST(least(ceil(octet_length(encode(word)) * 8 / CAST(30 AS DOUBLE)) - 1, 7) AS INTEGER)"
_NUMBER = "regexp_full_match(word, '[0-9]+')"
_PALINDROME = "length(word) > 2 AND lower(word) = reverse(lower(word))"


def _words(then: str) -> str:
    return with_tables("words", then=then)


def _lines(then: str) -> str:
    return with_tables("lines", then=then)


def _index(then: str) -> str:
    return with_tables("lines", then=then).replace("\nSELECT", ",\n  " + _TOKENS + "\nSELECT", 1)


ORACLE = {
    "word_total": _words("SELECT count(*) AS n_words FROM words"),
    "word_unique": _words("SELECT DISTINCT word FROM words ORDER BY word DESC"),
    "word_longest": _words(
        """SELECT word, CAST(length(word) AS INTEGER) AS n_letters FROM words
  ORDER BY length(word) DESC, doc_id, pos LIMIT 1"""
    ),
    "word_three": _words("SELECT count(*) FILTER (length(word) = 3) AS n_words FROM words"),
    "word_avg_len": _words(
        "SELECT CAST(sum(length(word)) AS DOUBLE) / count(*) AS avg_letters FROM words"
    ),
    "word_counts": _words("SELECT word, count(*) AS n FROM words GROUP BY word"),
    "word_lookup": _words("SELECT word, count(*) AS n FROM words WHERE word = 'the' GROUP BY word"),
    "words_by_letter": _words("SELECT DISTINCT word[1] AS letter, word FROM words"),
    "letter_set_sizes": _words(
        "SELECT word[1] AS letter, count(DISTINCT word) AS n_words FROM words GROUP BY 1"
    ),
    "text_lines": _lines("SELECT doc_id, line_id, line FROM lines"),
    "collection_documents": """SELECT CAST(0 AS BIGINT) AS doc_id, 'He said "' || doc_id || '" once' AS text FROM documents
  UNION ALL SELECT doc_id, '<Document docno="' || doc_id || E'">\n' || text FROM documents""",
    "line_search": _lines(
        """SELECT CAST(instr(line, 'the') - 1 AS INTEGER) AS idx, doc_id, line_id, line FROM lines
  WHERE instr(line, 'the') > 0 ORDER BY idx DESC, doc_id, line_id LIMIT 20"""
    ),
    "line_search_matcher": _lines(
        """SELECT CAST(instr(lower(line), 'the') - 1 AS INTEGER) AS idx, doc_id, line_id, line FROM lines
  WHERE instr(lower(line), 'the') > 0 ORDER BY idx DESC, doc_id, line_id LIMIT 20"""
    ),
    "frequent_words": r"""SELECT word, count(*) AS n FROM
  (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents)
  WHERE word <> '' GROUP BY word HAVING count(*) >= 500 ORDER BY word""",
    "all_word_frequencies": r"""SELECT word, count(*) AS n FROM
  (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents)
  WHERE word <> '' GROUP BY word""",
    "index_occurrences": _index("SELECT word, doc_id, line_id, pos FROM tokens"),
    "index_postings": _index("SELECT word, doc_id, line_id, pos, n FROM postings"),
    "index_stored": _index("SELECT word, doc_id, CAST(line_id AS BIGINT) AS line_id, pos, n FROM postings"),
    "index_stored_words": _index(
        "SELECT word, count(*) AS n_lines, CAST(sum(n) AS BIGINT) AS n FROM postings GROUP BY word"
    ),
    "index_stored_lookup": _index(
        f"""SELECT word, doc_id, CAST(line_id AS BIGINT) AS line_id, pos, n FROM postings
WHERE word = '{_ASKED}' AND doc_id BETWEEN {_FROM_DOCUMENT} AND {_TO_DOCUMENT}"""
    ),
    "index_postings_grouped": _index("SELECT word, doc_id, line_id, pos, n FROM postings"),
    "index_stop_table": with_tables(
        "lines",
        then=rf"""SELECT word, doc_id, line_id,
  CAST(row_number() OVER (PARTITION BY doc_id, line_id ORDER BY raw) - 1 AS INTEGER) AS pos
  FROM (SELECT doc_id, line_id, unnest(string_split_regex(line, '{_DELIMITERS}')) AS word,
    generate_subscripts(string_split_regex(line, '{_DELIMITERS}'), 1) AS raw FROM lines)
  WHERE word <> '' AND word NOT IN (SELECT unnest(string_split(text, ' ')) FROM benchmark)""",
    ),
    "index_doc_lines": _index("SELECT word, doc_id, n_lines, n FROM doc_lines"),
    "index_totals": _index("SELECT word, n FROM totals"),
    "index_totals_of_postings": _index("SELECT word, n FROM totals"),
    "index_number_words": _index(
        f"""SELECT word[1] AS first_digit, count(*) AS n_words FROM totals
  WHERE {_NUMBER} GROUP BY 1"""
    ),
    "index_palindromes": _index(
        f"SELECT count(*) FILTER (NOT {_NUMBER} AND {_PALINDROME}) AS n_words FROM totals"
    ),
    "index_counters": _index(
        f"""SELECT kind, count(*) AS n_words FROM (SELECT CASE WHEN {_NUMBER} THEN 'number'
  WHEN {_PALINDROME} THEN 'palindrome' END AS kind FROM totals) WHERE kind IS NOT NULL GROUP BY 1"""
    ),
    "index_partitions": _index(f"SELECT word, {_BUCKET} AS bucket FROM totals"),
    "index_placement": _index(
        f"""SELECT word, bucket, CAST('0x' || md5(word)[1:8] AS BIGINT) %
  CASE WHEN n * 50 > total THEN CAST(ceil(n * CAST(50 AS DOUBLE) / total) AS BIGINT) ELSE 1 END AS part
  FROM (SELECT *, count(*) OVER (PARTITION BY bucket) AS n, count(*) OVER () AS total
    FROM (SELECT word, {_BUCKET} AS bucket FROM totals))"""
    ),
    "index_tree": _index(
        rf"""SELECT word, doc_id, line_id, text, {_BUCKET} AS bucket,
  CAST(length(word) AS INTEGER) AS length FROM (
    SELECT word, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS BIGINT) AS line_id,
      word || E'\t' || n AS text FROM totals
    UNION ALL SELECT word, doc_id, NULL, E'\t' || doc_id || E'\t' || n_lines FROM doc_lines
    UNION ALL SELECT word, doc_id, line_id, E'\t\t' || line_id || E'\t' || pos FROM postings)"""
    ),
    "index_header_carry": _lines(
        """SELECT file, coalesce(opened, 0) AS doc_id, line_no - coalesce(opened_at, 0) AS line_id, line
  FROM (SELECT *, last_value(CASE WHEN opens THEN doc END IGNORE NULLS) OVER w AS opened,
      last_value(CASE WHEN opens THEN line_no END IGNORE NULLS) OVER w AS opened_at
    FROM (SELECT doc_id AS file, CAST(line_id + 1 AS BIGINT) AS line_no,
        (length(line) + line_id) % 5 = 3 AS opens, doc_id * 1000 + line_id + 1 AS doc,
        CASE WHEN (length(line) + line_id) % 5 = 3
          THEN '<Document docno="' || (doc_id * 1000 + line_id + 1) || '">' ELSE line END AS line
      FROM lines)
    WINDOW w AS (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING))"""
    ),
}
