import pytest
from conftest import exchanges, plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marram.functions import text
from marram.operators import index
from marram.plans import tables
from marram.sinks.text import write_index_tree
from marram.sources.text import document_lines, read_document_collection, read_word_list, table_lines

SF = "/root/testdata/sf0.001"
COLLECTION = """before the first
Level, level foo_bar
<Document id="17" name="a">
the cat it's the cat
12 12 anna

<Document id="18">
Level cat
"""


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id bigint, line_id int, line string")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def collection(spark, tmp_path, content=COLLECTION, name="docs.txt"):
    (tmp_path / name).write_text(content)
    return read_document_collection(spark, str(tmp_path / name))


def test_tokens_keep_underscores_and_lose_other_punctuation(spark):
    frame = lines(spark, (1, 0, "foo_bar it's a-b <x>\\y `q`{z}|~ [w]^v !\"#$%&()*+,./:;=?@"))
    found = [r.word for r in index.occurrences(frame).orderBy("pos").collect()]
    assert found == ["foo_bar", "it", "s", "a", "b", "x", "y", "q", "z", "w", "v"]


def test_stop_words_do_not_count_for_positions_and_match_case(spark):
    frame = lines(spark, (1, 0, "the cat The the dog"))
    expected = [("The", 1, 0, 1), ("cat", 1, 0, 0), ("dog", 1, 0, 2)]
    assert rows(index.occurrences(frame, ["the"])) == expected
    stop_table = spark.createDataFrame([("the",), ("the",)], "word string")
    assert rows(index.occurrences_without(frame, stop_table)) == expected


def test_repeats_on_a_line_keep_the_first_position(spark):
    frame = lines(spark, (1, 0, "a b a a"), (1, 1, "a"), (2, 0, ""))
    expected = [("a", 1, 0, 0, 3), ("a", 1, 1, 0, 1), ("b", 1, 0, 1, 1)]
    assert rows(index.postings(frame)) == expected
    assert rows(index.count_occurrences(index.occurrences(frame))) == expected
    counts = index.document_counts(index.postings(frame))
    assert rows(counts) == [("a", 1, 2, 4), ("b", 1, 1, 1)]
    assert rows(index.word_totals(counts)) == [("a", 4), ("b", 1)]


def test_postings_need_no_shuffle(spark):
    frame = tables.lines(spark, SF)
    assert exchanges(index.postings(frame, tables.STOP_WORDS)) == exchanges(frame)


def test_same_line_in_several_rows_is_merged(spark):
    frame = lines(spark, (0, 1, "a b"), (0, 1, "b a"))
    assert rows(index.merge_postings(index.postings(frame))) == [("a", 0, 1, 0, 2), ("b", 0, 1, 0, 2)]


def test_documents_are_cut_at_headers(spark, tmp_path):
    found = rows(document_lines(collection(spark, tmp_path)))
    assert found == [
        (0, 1, "before the first"),
        (0, 2, "Level, level foo_bar"),
        (17, 0, '<Document id="17" name="a">'),
        (17, 1, "the cat it's the cat"),
        (17, 2, "12 12 anna"),
        # The empty line in front of the next header has no words and is not listed.
        (18, 0, '<Document id="18">'),
        (18, 1, "Level cat"),
    ]


def test_a_file_may_start_with_a_header(spark, tmp_path):
    found = rows(document_lines(collection(spark, tmp_path, '<Document id="5">\nx\n')))
    assert found == [(5, 0, '<Document id="5">'), (5, 1, "x")]


def test_a_file_may_start_with_another_tag(spark, tmp_path):
    content = '<corpus size="300">\ntext\n<Document id="5">\nx\n'
    found = rows(document_lines(collection(spark, tmp_path, content)))
    assert found == [
        (0, 1, '<corpus size="300">'),
        (0, 2, "text"),
        (5, 0, '<Document id="5">'),
        (5, 1, "x"),
    ]


def test_a_header_without_id_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        collection(spark, tmp_path, "<Document>\nx\n").collect()


def test_a_header_with_another_id_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        collection(spark, tmp_path, '<Document id="1">\nx\n<Document id="abc">\ny\n').collect()


def test_the_first_record_is_told_by_its_place(spark, tmp_path):
    texts = ['He said "42" once\n<Document id="7">\nx', '<Document id="8">\ny\n<Document id="9">\nz', ' id="5">\nplain']
    for at, content in enumerate(texts):
        (tmp_path / f"{at}.txt").write_text(content)
    found = rows(read_document_collection(spark, str(tmp_path)))
    assert found == sorted(
        [(0, 'He said "42" once'), (7, '<Document id="7">\nx'), (8, '<Document id="8">\ny'),
         (9, '<Document id="9">\nz'), (0, ' id="5">\nplain')]
    )


def test_header_words_are_indexed_too(spark, tmp_path):
    frame = document_lines(collection(spark, tmp_path))
    header = index.occurrences(frame).where("doc_id = 18 and line_id = 0").orderBy("pos")
    assert [r.word for r in header.collect()] == ["Document", "id", "18"]


def test_documents_survive_any_split(spark, tmp_path):
    body = "".join(f'<Document id="{i}">\nword{i} line one\nline two\n' for i in range(300))
    frame = collection(spark, tmp_path, body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        split = read_document_collection(spark, str(tmp_path / "docs.txt"))
        assert spark.read.text(str(tmp_path / "docs.txt")).rdd.getNumPartitions() > 8
        assert rows(document_lines(split)) == rows(document_lines(frame))
        assert split.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("block", [1, 2, 3, 100])
def test_headers_carry_over_blocks(spark, tmp_path, block):
    numbered = [("f", i + 1, line) for i, line in enumerate(COLLECTION.splitlines())]
    numbered += [("g", 1, "no header here"), ("g", 2, "none")]
    frame = spark.createDataFrame(numbered, "file string, line_no bigint, line string")
    found = index.carry_documents(frame, lines_per_block=block)
    expected = rows(document_lines(collection(spark, tmp_path)))
    not_empty = found.where("file = 'f' and line <> ''").drop("file")
    assert rows(not_empty) == expected
    assert found.where("line = ''").drop("file").first() == (17, 3, "")
    assert rows(found.where("file = 'g'").drop("file")) == [(0, 1, "no header here"), (0, 2, "none")]


def test_counters_tell_numbers_from_palindromes(spark):
    words = spark.createDataFrame(
        [(w,) for w in ("121", "12", "19", "anna", "Anna", "aa", "noon1", "xyz", "٣٣٣")], "word string"
    )
    kinds = {r.word: r.kind for r in words.select("word", text.word_kind("word").alias("kind")).collect()}
    assert kinds == {
        "121": "number",
        "12": "number",
        "19": "number",
        "anna": "palindrome",
        "Anna": "palindrome",
        "aa": None,
        "noon1": None,
        "xyz": None,
        "٣٣٣": "palindrome",
    }
    assert rows(index.number_words(words)) == [("1", 3)]
    assert index.palindromes(words).first().n_words == 3
    watched, observation = index.observe_words(words)
    watched.count()
    assert observation.get["palindromes"] == 3
    assert observation.get["first_digit_1"] == 3
    assert observation.get["first_digit_2"] == 0


def test_length_ranges(spark):
    words = spark.createDataFrame(
        [("a" * n,) for n in (1, 3, 4, 7, 8, 30, 31, 100)] + [("éé",)], "word string"
    )
    found = {r.word: r.bucket for r in index.with_bucket(words, 8).collect()}
    assert [found["a" * n] for n in (1, 3, 4, 7, 8, 30, 31, 100)] == [0, 0, 1, 1, 2, 7, 7, 7]
    assert found["éé"] == 1
    assert {r.bucket for r in index.with_bucket(words, 1).collect()} == {0}
    placed = index.place_by_bucket(words, 8, shares=1000)
    parts = placed.withColumn("at", F.spark_partition_id()).collect()
    assert all(r.bucket == found[r.word] for r in parts)
    assert len({(r.bucket, r.part, r["at"]) for r in parts}) == len({(r.bucket, r.part) for r in parts}) > 4


def test_words_sort_by_length_then_text(spark):
    words = spark.createDataFrame([(w,) for w in ("b", "ccc", "aa", "a", "bbb")], "word string")
    found = [r.word for r in index.by_length(words.coalesce(1)).collect()]
    assert found == ["bbb", "ccc", "aa", "a", "b"]


def read_tree(directory):
    return {
        int(bucket.name.split("=")[1]): "".join(
            part.read_text() for part in sorted(bucket.glob("part-*"))
        )
        for bucket in directory.glob("bucket=*")
    }


@pytest.mark.parametrize("files", [1, 5, None])
def test_tree_is_written_in_order(spark, tmp_path, files):
    frame = document_lines(collection(spark, tmp_path))
    stop = read_word_list(spark, str(tmp_path / "docs.txt")).where("word = 'the'")
    assert stop.count() == 0
    tree = index.tree_rows(index.merge_postings(index.postings(frame, ["the"])), buckets=8)
    write_index_tree(tree, str(tmp_path / "tree"), files)
    found = read_tree(tmp_path / "tree")
    assert found[0] == (
        "cat\t3\n"
        "\t17\t1\n\t\t1\t0\n"
        "\t18\t1\n\t\t1\t1\n"
        "12\t2\n\t17\t1\n\t\t2\t0\n"
        "17\t1\n\t17\t1\n\t\t0\t2\n"
        "18\t1\n\t18\t1\n\t\t0\t2\n"
        "id\t2\n\t17\t1\n\t\t0\t1\n\t18\t1\n\t\t0\t1\n"
        "it\t1\n\t17\t1\n\t\t1\t1\n"
        "a\t1\n\t17\t1\n\t\t0\t4\n"
        "s\t1\n\t17\t1\n\t\t1\t2\n"
    )
    assert found[1].startswith("foo_bar\t1\n\t0\t1\n\t\t2\t2\n")
    assert found[2].startswith("Document\t2\n")
    assert sum(block.count("\n") for block in found.values()) == tree.count()


def test_large_tree_keeps_words_whole_across_files(spark, tmp_path):
    tree = index.tree_rows(index.postings(tables.lines(spark, SF)))
    write_index_tree(tree, str(tmp_path / "tree"), 12)
    found = read_tree(tmp_path / "tree")
    order = [F.desc("length"), "word", F.asc_nulls_first("doc_id"), F.asc_nulls_first("line_id")]
    for bucket in (0, 2):
        expected = tree.where(F.col("bucket") == bucket).orderBy(*order).select("text").collect()
        assert found[bucket].splitlines() == [r.text for r in expected]


def test_lines_of_a_text_column(spark):
    frame = spark.createDataFrame([(3, "a\nb")], "id bigint, body string")
    assert rows(table_lines(frame, "id", "body")) == [(3, 0, "a"), (3, 1, "b")]


def test_postings_keep_types_and_batches_apart(spark, monkeypatch):
    """Nulls, file names as documents, words of other scripts, more postings than one batch holds; no lambda sorts a line."""
    frame = spark.createDataFrame(
        [("f", 1, "b a b"), (None, 2, "a"), ("f", None, None), ("g", 3, " ., "), ("g", 4, "é z\u0000 \U0001f600 é")],
        "doc_id string, line_id int, line string",
    )
    monkeypatch.setattr(index, "ROWS_PER_BATCH", 2)
    found = index.postings(frame)
    assert dict(found.dtypes) == {"word": "string", "doc_id": "string", "line_id": "int", "pos": "int", "n": "bigint"}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        map(tuple, index.count_occurrences(index.occurrences(frame)).collect()), key=str
    )
    assert "array_sort" not in plan_of(found) and "sort_array" not in plan_of(found)
