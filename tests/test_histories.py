"""Line numbers of files, stored placement, folds over rows in order, pruned top lists."""

import random
import re
from collections import Counter, defaultdict
from itertools import groupby

import pytest
from conftest import exchanges, plan_of
from pyspark.sql import functions as F

from marram.operators import articles, index, ordered, placed, words
from marram.sources.text import numbered_table_lines, read_numbered_lines


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "7", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


FILES = {
    "a.txt": "one\ntwo\n\nfour is a longer line than any split\r\nfive\n",
    "b.txt": "no end",
    "c.txt": "",
    "d.txt": "\n\n\nx\n",
    "e.txt": "\n".join(f"line {i} " + "y" * (i * 7 % 31) for i in range(60)),
    "f.txt": 'lead\n<Document docno="7">\nthe the\n<Document docno="9">\n\nend of the\n',
}


def written(tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content.encode())
    return str(tmp_path)


def split(content):
    lines = re.split(r"\r\n|\n", content)
    return lines if lines[-1] else lines[:-1]


def test_lines_of_files_are_numbered_at_any_split(spark, tmp_path, tiny_splits):
    numbered = read_numbered_lines(spark, written(tmp_path))
    found = sorted((r.file.rsplit("/", 1)[1], r.line_no, r.line) for r in numbered.collect())
    assert found == [(name, n, line) for name, content in FILES.items() for n, line in enumerate(split(content), 1)]
    assert len(spark.read.text(str(tmp_path)).inputFiles()) == 6
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50


def test_documents_are_carried_straight_from_files(spark, tmp_path, tiny_splits):
    carried = index.carry_documents(read_numbered_lines(spark, written(tmp_path)), lines_per_block=2, blocks_per_group=2)
    found = sorted((r.doc_id, r.line_id, r.line) for r in carried.collect() if r.file.endswith("f.txt"))
    assert found == [
        (0, 1, "lead"), (7, 0, '<Document docno="7">'), (7, 1, "the the"),
        (9, 0, '<Document docno="9">'), (9, 1, ""), (9, 2, "end of the"),
    ]


def test_line_search_keeps_the_order_of_files(spark, tmp_path, tiny_splits):
    (tmp_path / "g.txt").write_text("the the\nx\nthe the\n")
    found = words.find_lines(numbered_table_lines(read_numbered_lines(spark, written(tmp_path))), "the", k=10).collect()
    assert [(r.idx, r.doc_id[-5:], r.line_id) for r in found] == [
        (7, "f.txt", 6), (0, "f.txt", 3), (0, "g.txt", 1), (0, "g.txt", 3),
    ]


def revisions(spark, rows):
    return spark.createDataFrame(rows, "aid long, rid long, contributor string, ts string").withColumn(
        "ts", F.to_timestamp_ntz("ts")
    )


def drawn(seed, n, busy=0.0):
    draw = random.Random(seed)
    names = [f"c{i}" for i in range(40)]
    return [
        (draw.randrange(9), i, "busy" if draw.random() < busy else draw.choice(names), f"20{draw.randint(10, 14)}-01-0{draw.randint(1, 9)}")
        for i in range(n)
    ]


def test_placed_lookup_reads_one_bucket_and_cogroup_moves_nothing(spark, tmp_path):
    sides = [drawn(1, 900, 0.4) + [(1, 9_999, None, "2012-01-01")], drawn(2, 700)]
    frames = [revisions(spark, rows) for rows in sides]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        left, right = placed.place(str(tmp_path), *frames, buckets=4, shares=8)
        assert {r.contributor for r in left.busy.collect()} == {"busy", None}
        assert right.busy.count() == 0
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        assert "SelectedBucketsCount: 1 out of 4" in plan_of(placed.lookup(left, "c7"))
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        # The plan does not say so, but other buckets' files are not opened either.
        assert left.rest.where("contributor = 'c7'").select("_metadata.file_path").distinct().count() == 1
        for name in ("c7", "busy", "nobody"):
            assert placed.lookup(left, name).count() == sum(c == name for _, _, c, _ in sides[0])
        # Only the busy contributors' aggregates move: one shuffle of each side.
        assert exchanges(placed.cogroup_sizes(left, right)) == 2
        assert exchanges(articles.cogroup_sizes(left.rest, right.rest)) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    counts = [Counter(c for _, _, c, _ in rows) for rows in sides]
    found = {r.contributor: (r.n_left, r.n_right) for r in placed.cogroup_sizes(left, right).collect()}
    assert found == {c: (counts[0][c], counts[1][c]) for c in counts[0] | counts[1]}
    assert left.rows().count() == len(sides[0])


@pytest.mark.parametrize("bits", [3, ordered.BITS])
def test_longest_run_where_one_year_holds_most_rows(spark, bits):
    draw = random.Random(8)
    rows = []
    for i in range(2_000):
        year = 2013 if draw.random() < 0.9 else draw.randint(2010, 2015)
        name = draw.choice(["a", "a", "a", "b", None])
        rows.append((1, i, name, f"{year}-01-01"))
    grouped = articles.keyed_by_year(revisions(spark, rows)).repartition(6)
    found = ordered.fold_groups(grouped, ["year"], ["ts", "rid"], ordered.longest_run("contributor"), bits=bits)
    expected = {}
    for year in range(2010, 2016):
        names = [c for _, _, c, ts in rows if ts.startswith(str(year))]
        if names:
            expected[year] = max(len(list(run)) for _, run in groupby(names))
    assert {r.year: r.result for r in found.collect()} == expected


def test_folds_of_odd_groups(spark):
    rows = revisions(spark, [(1, 1, "x", "2013-01-01"), (1, 2, "x", "2013-01-02"), (2, 3, "x", None)])
    fold = ordered.longest_run("contributor")
    found = ordered.fold_groups(rows.withColumn("year", F.year("ts")), ["year"], ["ts", "rid"], fold, bits=4)
    assert {r.year: r.result for r in found.collect()} == {2013: 2, None: 1}
    assert ordered.fold_groups(rows.limit(0), ["aid"], ["rid"], fold, bits=4).count() == 0
    with pytest.raises(ValueError):
        ordered.fold_groups(rows, ["aid"], ["rid"], fold, bits=0)


def test_automaton_on_both_sides_against_plain_python(spark):
    machine = ordered.Automaton(
        kinds=[lambda r: r["rid"] % 5 == 0, lambda r: r["aid"] == 3],
        moves=[[1, 1, 1, 3], [0, 2, 0, 3], [0, 0, 3, 3]],
        accepting=[3],
    )

    def accepts(rows):
        state = 0
        for aid, rid, _, _ in sorted(rows, key=lambda r: (r[3], r[1])):
            state = machine.moves[0 if rid % 5 == 0 else 1 if aid == 3 else 2][state]
        return state in machine.accepting

    sides = [drawn(5, 1_500, 0.5), drawn(6, 1_500, 0.5)]
    named = [defaultdict(list), defaultdict(list)]
    for groups, rows in zip(named, sides, strict=True):
        for row in rows:
            groups[row[2]].append(row)
    expected = {c for c in named[0].keys() | named[1].keys() if all(accepts(groups[c]) for groups in named)}
    found = ordered.filter_cogroup_in_order(*(revisions(spark, rows) for rows in sides), machine, bits=4)
    assert {r.contributor for r in found.collect()} == expected and expected
    with pytest.raises(ValueError):
        ordered.Automaton(kinds=[], moves=[[0], [0]], accepting=[])


def test_automaton_on_a_side_without_the_contributor(spark):
    # Holds unless a revision of article 1 was seen.
    never = ordered.Automaton(kinds=[lambda r: r["aid"] == 1], moves=[[1, 1], [0, 1]], accepting=[0])
    left = revisions(spark, [(1, 1, "x", "2013-01-01"), (2, 2, "y", "2013-01-01")])
    found = ordered.filter_cogroup_in_order(left, left.limit(0), never, bits=8)
    assert [r.contributor for r in found.collect()] == ["y"]


@pytest.mark.parametrize("k,buckets", [(3, 1 << 16), (3, 4), (50, 16), (1, 1)])
def test_pruned_top_list_equals_the_full_one(spark, k, buckets):
    skewed = [(1, i, f"c{min(i % 97, i % 13)}", "2013-01-01") for i in range(2_000)] + [(1, 5_000, None, "2013-01-01")]
    flat = [(1, i, f"c{i % 40}", "2013-01-01") for i in range(400)]
    for rows in (skewed, flat, []):
        frame = revisions(spark, rows)
        full = [(r.contributor, r.n_revisions) for r in articles.top_contributors(frame, k).collect()]
        assert [tuple(r) for r in articles.top_by_count(frame, "contributor", k, buckets).collect()] == full


def test_pruned_top_list_counts_few_keys(spark):
    rows = [(1, i, f"c{i}", "2013-01-01") for i in range(5_000)] + [(1, i, f"top{i % 3}", "2013-01-01") for i in range(3_000)]
    frame = articles.top_by_count(revisions(spark, rows), "contributor", 3)
    assert [r.n for r in frame.collect()] == [1000] * 3
    # Keys in the buckets that stay; grouping all would shuffle 5,003.
    counted = revisions(spark, rows).select("contributor", F.pmod(F.xxhash64("contributor"), F.lit(articles.BUCKETS)).alias("b"))
    full = counted.where(F.col("contributor").startswith("top")).select("b").distinct()
    assert counted.join(full, "b", "left_semi").select("contributor").distinct().count() < 10
    everyone = articles.top_by_count(revisions(spark, rows), "contributor", 5_003)
    assert everyone.count() == 5_003
