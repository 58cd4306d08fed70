import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from marram.operators import index, stored_index
from marram.plans import tables

SF = "/root/testdata/sf0.001"
SCHEMA = "word string, doc_id bigint, line_id bigint, pos int, n bigint"


def postings(spark):
    return index.postings(tables.lines(spark, SF)).withColumn("line_id", F.col("line_id").cast("bigint"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return stored_index.store(str(tmp_path_factory.mktemp("index") / "stored"), postings(spark))


def rows(frame):
    return sorted(tuple(row) for row in frame.select("word", "doc_id", "line_id", "pos", "n").collect())


def test_all_postings_come_back(spark, stored):
    assert rows(stored_index.all_postings(stored)) == rows(postings(spark))
    again = stored_index.open_index(spark, stored.blocks.inputFiles()[0].rsplit("/", 2)[0])
    assert again.blocks.count() == stored.blocks.count()


def test_dictionary_has_every_word_once_and_in_order(spark, stored):
    found = stored_index.words_of(stored.dictionary).orderBy("word_id").collect()
    totals = {r.word: r.n for r in index.word_totals(postings(spark)).collect()}
    assert {r.word: r.n for r in found} == totals and len(found) == len(totals)
    assert [r.word.encode() for r in found] == sorted(r.word.encode() for r in found)
    blocks = stored.dictionary.collect()
    assert all(1 <= len(b.rest) <= stored_index.WORDS_PER_BLOCK for b in blocks)
    assert sum(map(len, (w for b in blocks for w in b.rest))) < sum(map(len, totals))


def test_lookup_gives_a_words_postings_and_prunes(spark, stored):
    everything = rows(postings(spark))
    frequent = max(index.word_totals(postings(spark)).collect(), key=lambda r: r.n).word
    for word in (frequent, everything[0][0], everything[-1][0]):
        own = [r for r in everything if r[0] == word]
        assert rows(stored_index.lookup(stored, word)) == own
        low, high = own[len(own) // 3][1], own[-1 - len(own) // 3][1]
        found = stored_index.lookup(stored, word, low, high)
        assert rows(found) == [r for r in own if low <= r[1] <= high]
        pushed = plan_of(found).split("PushedFilters: ")[1]
        assert "EqualTo(word_id," in pushed and "IsNotNull(last_doc)" in pushed
    assert rows(stored_index.lookup(stored, "no such word")) == []
    assert rows(stored_index.lookup(stored, "")) == []


def test_a_frequent_word_is_many_blocks(spark, tmp_path):
    frame = spark.range(20_000).selectExpr(
        "'often' AS word", "id div 2 AS doc_id", "id % 2 * 70000 AS line_id", "0 AS pos", "1L AS n"
    )
    rare = spark.createDataFrame([("rare", 3, 5, 1, 2), ("rare", 9_000, 1, 0, 1)], SCHEMA)
    frame = frame.select([F.col(f.name).cast(f.dataType) for f in rare.schema]).unionByName(rare)
    found = stored_index.store(str(tmp_path / "index"), frame)
    sizes = [r.n for r in found.blocks.select(F.size("docs").alias("n")).collect()]
    assert max(sizes) <= stored_index.POSTINGS_PER_BLOCK and sum(sizes) == 20_002
    assert rows(stored_index.all_postings(found)) == rows(frame)
    assert rows(stored_index.lookup(found, "often", 9_990)) == [r for r in rows(frame) if r[0] == "often" and r[1] >= 9_990]


def test_odd_words_and_an_empty_table(spark, tmp_path):
    words = ["a" * 100 + end for end in ("", "b", "bb", "c")] + ["é", "éa", "éab", "😀", "😀😀", "日本", "日本語", "x" * 50_000, "x" * 50_000 + "y"]
    content = [(word, at % 3 - 1, 10 * at, at, at + 1) for at, word in enumerate(words)]
    found = stored_index.store(str(tmp_path / "odd"), spark.createDataFrame(content, SCHEMA))
    assert rows(stored_index.all_postings(found)) == sorted(content)
    for row in content:
        assert rows(stored_index.lookup(found, row[0])) == [row]
    empty = stored_index.store(str(tmp_path / "empty"), spark.createDataFrame([], SCHEMA))
    assert rows(stored_index.all_postings(empty)) == rows(stored_index.lookup(empty, "a")) == []


def test_postings_are_made_once(spark, tmp_path):
    """Storing needs them for totals, the span, frequent words and blocks, and reads them back for these."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(pos):
        made.add(1)
        return pos

    rows = spark.createDataFrame(
        [(word, doc, line, 0, 1) for word in "abc" for doc in range(5) for line in range(2)],
        "word string, doc_id long, line_id long, pos int, n long",
    )
    stored = stored_index.store(str(tmp_path / "index"), rows.withColumn("pos", counted("pos")))
    assert sorted(stored_index.all_postings(stored).collect()) == sorted(rows.collect())
    assert made.value == rows.count()


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum("shuffle" in str(disk.getAllFiles().apply(at)) for at in range(disk.getAllFiles().size()))


def test_only_the_index_stays_on_disk(spark, tmp_path):
    """Postings, words, lists and coded blocks stayed beside it, and the files of every shuffle until the driver's next garbage collection."""
    import time

    before = _shuffle_files(spark)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    folder = tmp_path / "index"
    stored_index.store(str(folder), postings(spark))
    assert sorted(path.name for path in folder.iterdir()) == ["blocks", "dictionary"]
    assert spark.conf.get(setting, None) == was
    until = time.time() + 30
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.5)
    assert _shuffle_files(spark) <= before


def test_postings_travel_in_a_few_bytes(spark):
    """Flat postings took some 64 bytes a row in memory and in the files of three shuffles; rows of bytes take no more than a tenth."""
    rows = spark.range(40_000, numPartitions=2).selectExpr(
        "concat('w', id * id % 97) word", "id div 20 doc_id", "id % 20 line_id", "int(id % 7) pos", "1L n"
    )
    made = stored_index._gathered(rows)
    assert made.count() <= 2 * 97
    assert made.agg(F.sum(F.octet_length("coded"))).first()[0] < 6 * 40_000


@pytest.mark.parametrize("at_once", [1 << 20, 5])
def test_nulls_repeats_and_extremes_come_back(spark, tmp_path, monkeypatch, at_once):
    """Whatever is null but the word, repeated or out of order, in stretches that several tasks and batches have."""
    from marram.operators import packed

    monkeypatch.setattr(packed, "POSTINGS_AT_ONCE", at_once)
    big = 1 << 40
    numbers = [None, 0, 1, 70_000, -1, -70_000, big, -big]
    rows_in = [("a", doc, line, pos, n) for doc in numbers for line in numbers for pos, n in ((0, 1), (None, 2), (3, None))]
    rows_in += [("b", 1, 1, pos, 1) for pos in (3, 1, 2, 1, 1)] + [("", 0, 0, 0, -5), ("é", 5, 6, 7, big)]
    frame = spark.createDataFrame(rows_in[::-1], SCHEMA).repartition(3)
    found = stored_index.store(str(tmp_path / "index"), frame)
    key = str
    assert sorted(map(tuple, stored_index.all_postings(found).collect()), key=key) == sorted(rows_in, key=key)
    totals = {r.word: (r.n_lines, r.n) for r in stored_index.words_of(found.dictionary).collect()}
    assert totals == {
        word: (sum(r[0] == word for r in rows_in), sum(r[4] or 0 for r in rows_in if r[0] == word)) for word in ("", "a", "b", "é")
    }
    assert stored_index.all_postings(found).schema.simpleString() == frame.schema.simpleString()


def test_numbers_of_variable_length():
    import numpy as np

    from marram.operators import packed

    random = np.random.default_rng(1)
    for most in (3, 1 << 20, 1 << 62):
        group = np.sort(random.integers(0, 9, 500))
        values = [random.integers(-most, most, 500) for _ in range(4)]
        order = packed.in_order(group, values)
        assert (order == np.lexsort((*values[::-1], group))).all() or most == 3
        values = [each[order] for each in values]
        starts = packed.starts_of(group)
        sizes = np.diff(np.append(starts, 500))
        coded = packed.pack(values, starts)
        for one in (0, 4):
            back = packed.unpack(coded.slice(one), sizes[one:], values[0][starts][one:])
            assert all((a[starts[one] :] == b).all() for a, b in zip(values, back, strict=True))
