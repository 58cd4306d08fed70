"""Operator inputs derived from the given tables.

All of them are narrow or a single join, over whole tables, so that they grow
with the data. ``SQL`` holds the same derivations as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.numbers import idiv
from marram.sources.tables import read_table, spread
from marram.sources.text import table_lines

STOP_WORDS = ("the", "and", "en", "de")


# Revisions: every line item is a revision of the article its part stands for.


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``aid, rid, ts``: revisions without their contributor, read without a join."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("aid"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rid"),
        F.col("l_shipdate").alias("ts"),
    )


def revisions(spark: SparkSession, sf_dir: str, returned: bool | None = None) -> DataFrame:
    """``aid, rid, contributor, ts``; with ``returned`` only line items that were, or were not."""
    items = read_table(spark, sf_dir, "lineitem")
    if returned is not None:
        items = items.where((F.col("l_returnflag") == "R") == returned)
    orders = read_table(spark, sf_dir, "orders")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").alias("aid"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rid"),
        F.col("o_custkey").cast("string").alias("contributor"),
        F.col("l_shipdate").alias("ts"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("aid"), F.col("p_name").alias("title")
    )


# Dump pages: every order is written out as one page of a dump.


def page_records(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """``page``: one ``<page>`` text per order, and with ``numbered`` its ``page_id``.

    An order has 0 to 4 revisions. Some pages lack their id, some revisions
    theirs; contributors are users, addresses or missing; listed order is not
    order in time.
    """
    key = F.col("o_orderkey")

    def revision(i: Column) -> Column:
        rid = F.when((key % 13 == 0) & (i == 2), "").otherwise(
            F.concat(F.lit("<id>"), (key * 10 + i).cast("string"), F.lit("</id>"))
        )
        day = F.date_add(F.to_date("o_orderdate"), ((i * 37) % 50).cast("int")).cast("string")
        user = F.concat(
            F.lit("<username>"), F.col("o_custkey").cast("string"), F.lit("</username>")
        )
        address = F.concat(F.lit("<ip>10.0.0."), (key % 256).cast("string"), F.lit("</ip>"))
        who = F.when((key + i) % 7 == 0, "").when(i % 3 == 0, address).otherwise(user)
        return F.concat(
            F.lit("\n<revision>"),
            rid,
            F.lit("<timestamp>"),
            day,
            F.lit("T03:36:0"),
            i.cast("string"),
            F.lit("Z</timestamp><contributor>"),
            who,
            F.lit("</contributor></revision>"),
        )

    listed = F.filter(F.sequence(F.lit(1), F.lit(4)), lambda i: i <= key % 5)
    own_id = F.when(key % 11 == 0, "").otherwise(
        F.concat(F.lit("<id>"), key.cast("string"), F.lit("</id>"))
    )
    page = F.concat(
        F.lit("<page><title>Order "),
        F.col("o_orderpriority"),
        F.lit("</title>"),
        own_id,
        F.array_join(F.transform(listed, revision), ""),
        F.lit("\n</page>"),
    )
    keys = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    orders = spread(read_table(spark, sf_dir, "orders").select(*keys))
    number = [key.alias("page_id")] if numbered else []
    return orders.select(*number, page.alias("page"))


# Texts.


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "pages").select("page_id", "html"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, line_id, line`` of all documents, lines counted from 0."""
    return table_lines(documents(spark, sf_dir), "doc_id", "text")


def files_with_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file, line_no, line``: each document as a file in which some lines open documents."""
    number = F.col("line_id") + 1
    header = F.concat(
        F.lit('<Document docno="'), (F.col("doc_id") * 1000 + number).cast("string"), F.lit('">')
    )
    opens = (F.length("line") + F.col("line_id")) % 5 == 3
    return lines(spark, sf_dir).select(
        F.col("doc_id").alias("file"),
        number.cast("bigint").alias("line_no"),
        F.when(opens, header).otherwise(F.col("line")).alias("line"),
    )


def collection_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, first``: each document behind a preamble, as a file cut at its header."""
    number = F.col("doc_id").cast("string")
    preamble = F.concat(F.lit('He said "'), number, F.lit('" once'))
    document = F.concat(F.lit(' docno="'), number, F.lit('">\n'), F.col("text"))
    cut = F.array(
        F.struct(preamble.alias("value"), F.lit(True).alias("first")),
        F.struct(document.alias("value"), F.lit(False).alias("first")),
    )
    return documents(spark, sf_dir).select(F.inline(cut))


def item_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``: the whitespace-separated pieces of the benchmark items."""
    return read_table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("word"))


# Persons and plans: every customer is a person with a plan.


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("gender"),
        (key % 91 + 1928).cast("int").alias("birth_year"),
        key.alias("source_order"),
    )


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    strategies = F.array(*[F.lit(s) for s in ("growth", "balanced", "conservative", "cash")])
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        (key % 16 + 25).cast("int").alias("start_age"),
        F.get(strategies, (key % 4).cast("int")).alias("strategy"),
        (key % 16 + 5).cast("int").alias("contribution"),
        (key % 11 + 60).cast("int").alias("retirement_age"),
    )


def person_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, source_order``: every customer as a line of a persons file."""
    people = persons(spark, sf_dir)
    fields = [F.col(name).cast("string") for name in ("name", "gender", "birth_year")]
    return people.select(F.concat_ws(",", *fields, F.lit("more")).alias("value"), "source_order")


def shared_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons of whom many share a name: customers named by their segment."""
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("name"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("gender"),
        (key % 91 + 1928).cast("int").alias("birth_year"),
        (1000000000 - key).alias("source_order"),
    )


def plans_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plan per order, in its customer's name; a third of them name nobody."""
    key = F.col("o_orderkey")
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    strategies = F.array(*[F.lit(s) for s in ("Growth", "BALANCED", "conservative", "cash")])
    return read_table(spark, sf_dir, "orders").select(
        key.alias("plan_id"),
        F.concat(F.when(key % 3 == 0, "Nobody#").otherwise("Customer#"), number).alias("name"),
        (key % 16 + 25).cast("int").alias("start_age"),
        F.get(strategies, (key % 4).cast("int")).alias("strategy"),
        (key % 16 + 5).cast("int").alias("contribution"),
        (key % 11 + 60).cast("int").alias("retirement_age"),
    )


# Rasters: every embedding is a square image, as 64 numbers are 8 by 8 pixels.


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``image_id, width, height, x, y, r, g, b``."""
    size = F.size("embedding")
    cells = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"),
        "embedding",
        F.ceil(F.sqrt(size)).cast("int").alias("side"),
        F.explode(F.sequence(F.lit(0), size - 1)).alias("p"),
    )

    def shade(third: int) -> Column:
        shift = idiv(size * third, 3).cast("int")
        value = F.get("embedding", (F.col("p") + shift) % size).cast("double")
        return F.floor((value + 1) * 127.5).cast("int")

    return cells.select(
        "image_id",
        F.col("side").alias("width"),
        F.col("side").alias("height"),
        (F.col("p") % F.col("side")).alias("x"),
        idiv("p", F.col("side")).cast("int").alias("y"),
        shade(0).alias("r"),
        shade(1).alias("g"),
        shade(2).alias("b"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``image``: every embedding as an image of two rows, the second one mirrored.

    The layout is that of Spark's image source, with three bytes per pixel.
    """
    shades = F.transform("embedding", lambda v: F.floor((v.cast("double") + 1) * 127.5).cast("int"))

    def byte(value: Column) -> Column:
        return F.lpad(F.hex(value), 2, "0")

    def row(values: Column) -> Column:
        pixel = lambda v: F.concat(byte(idiv(v, 2)), byte(255 - v), byte(v))
        return F.array_join(F.transform(values, pixel), "")

    return read_table(spark, sf_dir, "embeddings").select(
        F.struct(
            F.concat(F.lit("vec/"), F.col("vec_id").cast("string")).alias("origin"),
            F.lit(2).alias("height"),
            F.size("embedding").alias("width"),
            F.lit(3).alias("nChannels"),
            F.lit(16).alias("mode"),
            F.unhex(F.concat(row(shades), row(F.reverse(shades)))).alias("data"),
        ).alias("image")
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name``: every part's type as a picture's file name, some without a known ending."""
    ending = F.element_at(
        F.array(*[F.lit(e) for e in (".JPG", ".png", ".jpg", ".tar.gif", "")]),
        (F.col("p_partkey") % 5 + 1).cast("int"),
    )
    return read_table(spark, sf_dir, "part").select(F.concat("p_name", ending).alias("name"))


def strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One large image of all embeddings below one another, as wide as they are long.

    Its size is taken from the embeddings, before they become pixels.
    """
    vectors = read_table(spark, sf_dir, "embeddings")
    width = vectors.agg(F.max(F.size("embedding"))).scalar()
    height = vectors.agg((F.max("vec_id") + 1).cast("int")).scalar()
    cells = vectors.select("vec_id", F.posexplode("embedding").alias("x", "value"))
    shade = F.floor((F.col("value").cast("double") + 1) * 127.5).cast("int")
    return cells.select(
        F.lit(0).cast("bigint").alias("image_id"),
        width.alias("width"),
        height.alias("height"),
        "x",
        F.col("vec_id").cast("int").alias("y"),
        shade.alias("r"),
        (255 - shade).alias("g"),
        idiv(shade, 2).cast("int").alias("b"),
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("value"))


_REVISION_COLUMNS = """l_partkey AS aid, l_orderkey * 10 + l_linenumber AS rid,
    CAST(o_custkey AS VARCHAR) AS contributor, l_shipdate AS ts"""

SQL = {
    "edits": """edits AS (SELECT l_partkey AS aid, l_orderkey * 10 + l_linenumber AS rid,
    l_shipdate AS ts FROM lineitem)""",
    "revisions": f"""revisions AS (SELECT {_REVISION_COLUMNS}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "sides": f"""a AS (SELECT {_REVISION_COLUMNS}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'),
  r AS (SELECT {_REVISION_COLUMNS}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')""",
    "articles": """listed AS (SELECT *, unnest(range(1, o_orderkey % 5 + 1)) AS i FROM orders),
  parsed AS (SELECT o_orderkey, 'Order ' || o_orderpriority AS title, i - 1 AS ord,
    CASE WHEN o_orderkey % 13 = 0 AND i = 2 THEN -1 ELSE o_orderkey * 10 + i END AS rid,
    CASE WHEN (o_orderkey + i) % 7 = 0 THEN ''
         WHEN i % 3 = 0 THEN '10.0.0.' || (o_orderkey % 256)
         ELSE CAST(o_custkey AS VARCHAR) END AS contributor,
    CAST(CAST(o_orderdate AS DATE) + CAST((i * 37) % 50 AS INTEGER) AS TIMESTAMP)
      + INTERVAL 3 HOUR + INTERVAL 36 MINUTE + to_seconds(i) AS ts
    FROM listed),
  flat AS (SELECT CASE WHEN o_orderkey % 11 = 0
        THEN first_value(rid) OVER (PARTITION BY o_orderkey ORDER BY ord)
        ELSE o_orderkey END AS aid,
    o_orderkey, title, ord, rid, contributor, ts FROM parsed)""",
    "words": r"""pieces AS (SELECT doc_id, unnest(string_split_regex(text, '[ \t\n\x0B\f\r]+')) AS word,
    generate_subscripts(string_split_regex(text, '[ \t\n\x0B\f\r]+'), 1) AS pos FROM documents),
  words AS (SELECT * FROM pieces WHERE regexp_full_match(word, '[a-zA-Z]+'))""",
    "lines": r"""lines AS (SELECT doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS line,
    CAST(generate_subscripts(string_split_regex(text, '\r\n|\r|\n'), 1) - 1 AS INTEGER) AS line_id
    FROM documents)""",
    "persons": """persons AS (SELECT c_name AS name,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
    CAST(1928 + c_custkey % 91 AS INTEGER) AS birth_year FROM customer)""",
    "plans": """plans AS (SELECT c_name AS name, CAST(25 + c_custkey % 16 AS INTEGER) AS start_age,
    ['growth', 'balanced', 'conservative', 'cash'][c_custkey % 4 + 1] AS strategy,
    CAST(5 + c_custkey % 16 AS INTEGER) AS contribution,
    CAST(60 + c_custkey % 11 AS INTEGER) AS retirement_age FROM customer)""",
    "rasters": """cells AS (SELECT vec_id, embedding, len(embedding) AS n,
    CAST(ceil(sqrt(len(embedding))) AS INTEGER) AS side, unnest(range(0, len(embedding))) AS p FROM embeddings),
  rasters AS (SELECT vec_id AS image_id, side AS width, side AS height,
    CAST(p % side AS INTEGER) AS x, CAST(p // side AS INTEGER) AS y,
    CAST(floor((CAST(embedding[p + 1] AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) AS INTEGER) AS r,
    CAST(floor((CAST(embedding[(p + n // 3) % n + 1] AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) AS INTEGER) AS g,
    CAST(floor((CAST(embedding[(p + n * 2 // 3) % n + 1] AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) AS INTEGER) AS b
    FROM cells)""",
    "strip": """size AS (SELECT CAST(max(vec_id) + 1 AS INTEGER) AS height,
    CAST(max(len(embedding)) AS INTEGER) AS width FROM embeddings),
  cells AS (SELECT vec_id, embedding, unnest(range(0, len(embedding))) AS p FROM embeddings),
  shades AS (SELECT vec_id, CAST(p AS INTEGER) AS x,
    CAST(floor((CAST(embedding[p + 1] AS DOUBLE) + 1) * CAST(127.5 AS DOUBLE)) AS INTEGER) AS shade
    FROM cells),
  rasters AS (SELECT CAST(0 AS BIGINT) AS image_id, width, height, x,
    CAST(vec_id AS INTEGER) AS y, shade AS r, 255 - shade AS g, shade // 2 AS b
    FROM shades, size)""",
}


def with_tables(*names: str, then: str) -> str:
    """A query over the named derived tables."""
    return "WITH " + ",\n  ".join(SQL[name] for name in names) + "\n" + then
