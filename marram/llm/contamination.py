"""Benchmark decontamination with a stored positional inverted index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.common import stored, words, work_tables

WINDOW = 13
# A task sorts the postings of one in so many of the rows it would read otherwise.
SLICES = 4


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings of all words of all texts: ``term``, ``doc``, ``pos``, stored in segments.

    ``term`` is the 64-bit hash of the word. Each task writes the postings of
    its rows as one segment sorted by term, so building shuffles nothing, a
    term's list may be of any length, and repeated terms take next to no space.
    The rows are read in ``SLICES`` by their hash, as postings take many times
    the memory of the texts while they are sorted. Null and empty texts have no
    postings; rows that share an id have theirs under one id.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))

    def segments(part: int) -> DataFrame:
        own = rows.where(F.pmod(F.xxhash64("doc", "text"), F.lit(SLICES)) == part)
        tokens = own.select("doc", F.posexplode(words(F.col("text"))).alias("pos", "word"))
        return tokens.select(F.xxhash64("word").alias("term"), "doc", "pos").sortWithinPartitions("term")

    return stored(reduce(DataFrame.union, map(segments, range(SLICES))), "postings")


def item_windows(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = WINDOW
) -> DataFrame:
    """Windows of items: ``item`` (text), ``phrase`` (its words with spaces), ``size``.

    ``length`` consecutive words each; an item of fewer, but not none, is one
    window. An item without an id is listed under the empty id.
    """
    split = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        words(F.col(text_col)).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - length + 1))
    cut = split.select("item", "words", F.explode(starts).alias("at"))
    window = F.slice("words", F.col("at"), F.lit(length))
    return cut.select(
        "item", F.array_join(window, " ").alias("phrase"), F.size(window).alias("size")
    ).distinct()


def _terms(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Terms of each phrase with offset and rank, the rarest first; phrases with an unknown term are left out."""
    split = phrases.select("phrase", "size", F.posexplode(F.split("phrase", " ")).alias("offset", "word"))
    terms = split.select("phrase", "size", "offset", F.xxhash64("word").alias("term"))
    # Stored, its size is known, and postings need not move to meet it.
    wanted = stored(terms.select("term").distinct(), "wanted")
    counts = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    by_rarity = Window.partitionBy("phrase").orderBy("n", "offset")
    known = terms.join(counts, "term").withColumn("rank", F.row_number().over(by_rarity))
    whole = F.count(F.lit(1)).over(Window.partitionBy("phrase")) == F.col("size")
    return known.withColumn("whole", whole).where("whole").drop("whole", "n")


def candidates(index: DataFrame, phrases: DataFrame, lists: int = 2) -> DataFrame:
    """Places where a phrase may stand: ``doc``, ``start``, ``phrase``, ``size``.

    The lists of the ``lists`` rarest terms of each phrase, each shifted by the
    term's offset, are intersected; a phrase of fewer terms uses all of them.
    No true place is lost.
    """
    terms = stored(_terms(phrases, index).where(F.col("rank") <= lists), "anchors")
    shifted = index.join(terms, "term").select(
        "doc", (F.col("pos") - F.col("offset")).alias("start"), "phrase", "size", "rank"
    )
    # The rarest list goes first: only its places can be in the intersection.
    places = shifted.where("rank = 1 and start >= 0").drop("rank")
    for rank in range(2, lists + 1):
        met = shifted.where(F.col("rank") == rank).select("doc", "start", "phrase").distinct()
        met = met.toDF("_doc", "_start", "_phrase")
        same = (
            F.col("doc").eqNullSafe(F.col("_doc"))
            & (F.col("start") == F.col("_start"))
            & (F.col("phrase") == F.col("_phrase"))
        )
        short = F.col("size") < rank
        places = places.join(met, same, "left").where(F.col("_start").isNotNull() | short)
        places = places.drop("_doc", "_start", "_phrase")
    return places.distinct()


def covered(hits: Column) -> Column:
    """Number of places inside the union of ``hits``, an array of (start, size)."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("sum"))
    return F.aggregate(
        F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["size"].alias("size")))),
        state,
        lambda a, h: F.struct(
            F.greatest(a["end"], h["start"] + h["size"]).alias("end"),
            (a["sum"] + F.greatest(F.lit(0), h["start"] + h["size"] - F.greatest(a["end"], h["start"]))).alias("sum"),
        ),
        lambda a: a["sum"],
    )


def phrase_matches(
    docs: DataFrame, index: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with its exact matches, stored.

    Columns ``doc``, ``same`` (hash of the text, which tells rows of one id
    apart), ``n_words`` and ``hits``, an array of (start, phrase, size).
    Candidates of the index are held against the words themselves.
    """
    spots = candidates(index, phrases.select("phrase", "size").distinct())
    listed = spots.groupBy(F.col("doc").alias("_doc")).agg(
        F.collect_list(F.struct("start", "phrase", "size")).alias("spots")
    )
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    met = rows.join(listed, F.col("doc").eqNullSafe(F.col("_doc")), "left").drop("_doc")
    split = met.select("doc", F.xxhash64("text").alias("same"), words(F.col("text")).alias("words"), "spots")
    exact = F.filter(
        "spots",
        lambda s: F.array_join(F.slice("words", s["start"] + 1, s["size"]), " ") == s["phrase"],
    )
    none = F.array().cast("array<struct<start:int,phrase:string,size:int>>")
    # One pass makes the words; the projection after it must not make them again.
    return stored(
        split.select(
            "doc", "same", F.size("words").cast("bigint").alias("n_words"),
            F.when(F.col("spots").isNotNull(), exact).otherwise(none).alias("hits"),
        ),
        "matches",
        lasts=True,
    )


def near_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """Proximity matches: ``phrase``, ``doc``, ``pos`` of its rarest term.

    All distinct terms of the phrase stand at most ``within`` words from that
    place, in any order. Lists are joined by term, document and stretch of
    ``within`` positions, so a frequent term meets its neighbourhood only.
    """
    terms = stored(_terms(phrases, index), "terms")
    needed = terms.groupBy("phrase").agg(F.countDistinct("term").alias("needed"))
    anchors = index.join(terms.where("rank = 1"), "term").select("phrase", "doc", "pos").distinct()
    others = terms.select("phrase", "term").distinct()
    wide = max(1, within)
    around = F.explode(F.array(*[F.floor(F.col("pos") / wide) + step for step in (-1, 0, 1)]))
    asked = anchors.join(others, "phrase").withColumn("block", around)
    lists = index.select(
        F.col("term").alias("_term"), F.col("doc").alias("_doc"), F.col("pos").alias("at"),
        F.floor(F.col("pos") / wide).alias("_block"),
    )
    same = (
        (F.col("term") == F.col("_term"))
        & F.col("doc").eqNullSafe(F.col("_doc"))
        & (F.col("block") == F.col("_block"))
        & (F.abs(F.col("at") - F.col("pos")) <= within)
    )
    met = asked.join(lists, same)
    found = met.groupBy("phrase", "doc", "pos").agg(F.countDistinct("term").alias("n"))
    return found.join(needed, "phrase").where("n = needed").select("phrase", "doc", "pos")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    length: int = WINDOW,
    one_in: int = 20,
) -> DataFrame:
    """How much of each document is benchmark text.

    One row for every row of ``docs``: the id under its own name, ``n_words``,
    ``n_hit`` (words inside any occurrence of an item's window), ``items`` (ids
    of the items with occurring windows, as sorted text) and ``contaminated``
    (words are hit, and at least one in ``one_in``).

    A null or empty text has no words and is clean; so is every document if
    there are no items or none has a word. Rows of one id are judged each by
    its own text; a null id is an id like others. Items that repeat count once.
    """
    windows = stored(item_windows(items, item_id_col, item_text_col, length), "windows")
    with work_tables(docs.sparkSession):
        index = build_index(docs, id_col, text_col)
        rows = phrase_matches(docs, index, windows, id_col, text_col)
    hit = rows.where(F.size("hits") > 0)
    found = hit.select("doc", "same", F.explode(F.array_distinct("hits.phrase")).alias("phrase"))
    listed = (
        found.join(windows.select("phrase", "item"), "phrase")
        .groupBy("doc", "same")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .toDF("_doc", "_same", "items")
    )
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("same") == F.col("_same"))
    n_hit = F.when(F.size("hits") > 0, covered(F.col("hits"))).otherwise(0).cast("bigint")
    return rows.join(listed, same, "left").select(
        F.col("doc").alias(id_col),
        "same",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )
