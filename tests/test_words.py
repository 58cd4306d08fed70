import pytest
from conftest import exchanges, plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marram.functions import text
from marram.operators import words
from marram.plans import tables
from marram.sinks.text import write_key_values
from marram.sources.text import read_lines, read_word_list, table_lines

SF = "/root/testdata/sf0.001"
TEXT = "  The the cat, 89B sat\ton\x0bthe mat ab_c\nElephantine cats\r\nsee\relephantile\n"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def stream(spark, *texts):
    return words.word_stream(docs(spark, *texts))


def test_words_are_letters_between_whitespace(spark):
    found = [r.word for r in stream(spark, TEXT).orderBy("pos").collect()]
    assert found == ["The", "the", "sat", "on", "Elephantine", "cats", "see", "elephantile"]


def test_words_of_a_text_are_those_of_its_lines(spark):
    whole = words.word_counts(stream(spark, TEXT))
    lines = table_lines(docs(spark, TEXT), "doc_id", "text")
    by_line = words.word_counts(words.word_stream(lines, "line_id", "line"))
    assert sorted(whole.collect()) == sorted(by_line.collect())


@pytest.mark.parametrize("tail", ["\n", "\u0085", " "])
def test_a_word_ends_where_the_text_ends(spark, tail):
    frame = spark.createDataFrame([("abc" + tail,), ("abc",)], "w string")
    assert frame.where(text.is_word("w")).count() == 1
    assert frame.select(F.translate("w", "abc", "123").alias("w")).where(text.is_number("w")).count() == 1


def test_unique_words_in_reverse_order(spark):
    found = [r.word for r in words.unique_words(stream(spark, "b a B c b Z")).collect()]
    assert found == ["c", "b", "a", "Z", "B"]


def test_longest_word_is_the_first_of_equals(spark):
    row = words.longest_word(stream(spark, "aa bbb", "ccc ddd")).first()
    assert (row.word, row.n_letters) == ("bbb", 3)
    assert words.longest_word(stream(spark, "1 2")).collect() == []


def test_counts_and_average(spark):
    frame = stream(spark, TEXT)
    assert words.count_words(frame).first().n_words == 8
    assert words.count_words_of_length(frame).first().n_words == 4
    assert words.average_word_length(frame).first().avg_letters == 40 / 8
    assert words.average_word_length(stream(spark, "")).first().avg_letters is None
    assert words.count_words(stream(spark, "")).first().n_words == 0


def test_first_letters_keep_their_case(spark):
    frame = stream(spark, "apple Ant ant apple bee")
    assert sorted(map(tuple, words.words_by_first_letter(frame).collect())) == [
        ("A", "Ant"),
        ("a", "ant"),
        ("a", "apple"),
        ("b", "bee"),
    ]
    assert {r.letter: r.n_words for r in words.letter_set_sizes(frame).collect()} == {
        "A": 1,
        "a": 2,
        "b": 1,
    }


def test_lines_end_as_a_text_reader_sees_them(spark):
    frame = docs(spark, "a\nb", "a\r\nb\r", "", "\n", "a\n\nb")
    found = {}
    for row in table_lines(frame, "doc_id", "text").orderBy("doc_id", "line_id").collect():
        found.setdefault(row.doc_id, []).append(row.line)
    assert found == {0: ["a", "b"], 1: ["a", "b"], 3: [""], 4: ["a", "", "b"]}


def test_line_search_order_and_limit(spark):
    frame = table_lines(docs(spark, "xx a\na\nb", "x a\nxx a"), "doc_id", "text")
    found = words.find_lines(frame, "a", k=3).collect()
    assert [(r.idx, r.doc_id, r.line_id) for r in found] == [(3, 0, 0), (3, 1, 1), (2, 1, 0)]
    from_the_end = lambda line, target: F.instr(F.reverse(line), target) - 1
    assert [r.idx for r in words.find_lines(frame, "x", from_the_end).collect()] == [2, 2, 2]
    plan = plan_of(words.find_lines(frame, "a"))
    assert "TakeOrderedAndProject" in plan


def test_frequent_words_include_the_minimum(spark):
    frame = docs(spark, "a " * 500 + "b " * 499, " c,\f c, ")
    assert [tuple(r) for r in words.frequent_words(frame).collect()] == [("a", 500)]
    assert sorted(map(tuple, words.frequent_words(frame, min_count=2).collect())) == [
        ("a", 500),
        ("b", 499),
        ("c,", 2),
    ]


def test_counts_are_reduced_before_the_shuffle(spark):
    plan = plan_of(words.word_counts(words.word_stream(tables.documents(spark, SF))))
    assert plan.count("HashAggregate") == 2
    assert "BatchEvalPython" not in plan
    assert exchanges(words.count_words(stream(spark, "a"))) == 0


def test_files_and_directories_of_lines(spark, tmp_path):
    (tmp_path / "dir").mkdir()
    (tmp_path / "dir" / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.txt").write_text("two\nthree")
    paths = str(tmp_path / "dir"), str(tmp_path / "b.txt")
    assert sorted(r.line for r in read_lines(spark, *paths).collect()) == ["one", "three", "two", "two"]
    assert sorted(r.word for r in read_word_list(spark, str(tmp_path / "dir")).collect()) == ["one", "two"]
    with pytest.raises(PySparkException):
        read_lines(spark, str(tmp_path / "nowhere"))


def test_key_values_are_written_tab_separated(spark, tmp_path):
    counts = words.sorted_by_word(words.word_counts(stream(spark, "b a b")))
    path = str(tmp_path / "out")
    write_key_values(counts, path, single_file=True)
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "a\t1\nb\t2\n"
