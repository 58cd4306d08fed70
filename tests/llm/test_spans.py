"""Removal of repeated sentences against plain Python over a whole table."""

from marram.llm import spans

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """Kept texts and removed spans: equal runs of words, the first of the smallest id stays."""
    parsed, first = {}, {}
    for doc_id, text in sorted(rows):
        parts = spans.sentences(text)
        runs = []
        for a in range(len(parts)):
            b, n = a, 0
            while b < len(parts) and (b - a < spans.SENTENCES or n < spans.WORDS):
                n += len(parts[b][2])
                b += 1
            if b - a >= spans.SENTENCES and n >= spans.WORDS:
                run = tuple(w for _, _, words in parts[a:b] for w in words)
                runs.append((a, b, run))
                first.setdefault(run, (doc_id, a))
        parsed[doc_id] = parts, runs
    out = {}
    for doc_id, text in rows:
        parts, runs = parsed[doc_id]
        gone = {i for a, b, run in runs if first[run] != (doc_id, a) for i in range(a, b)}
        kept = "".join(text[s:e] for i, (s, e, _) in enumerate(parts) if i not in gone)
        out[doc_id] = kept, len(parts), len(gone)
    return out


def test_whole_smallest_table_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    expected = plain([tuple(r) for r in docs.collect()])
    found = {r.doc_id: (r.text, r.n_sentences, r.n_removed) for r in spans.without_repeats(docs).collect()}
    assert found == expected
    assert sum(n for _, _, n in expected.values()) > 100


def test_a_filter_of_any_size_gives_the_same_runs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    table = spans.run_table(docs, "doc_id", "text", spans.SENTENCES, spans.WORDS)
    bits = {slots: spans.repeating_slots(table, slots) for slots in (spans.PAGE, spans.SLOTS)}
    again = [r.h for r in table.selectExpr("explode(h) h").groupBy("h").count().where("count > 1").collect()]
    for slots, found in bits.items():
        assert all(found[h % slots >> 3] >> (h % slots & 7) & 1 for h in again)
    few, many = (
        {(r.doc, r.same): (r.n, sorted(r.runs)) for r in spans.repeated_runs(table, slots).collect()} for slots in bits
    )
    assert few == many and any(runs for _, runs in few.values())


def test_callers_columns_stay_as_they_are(spark):
    names = "_doc _same _runs _hash _cut doc same row runs n cut run h g first last".split()
    text = "One two three four five six seven. " * 3 + "Eight nine ten, eleven twelve thirteen."
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    for name in names:
        docs = docs.selectExpr("*", f"'{name}' AS `{name}`")
    found = spans.without_repeats(docs).orderBy("doc_id").collect()
    assert [r.text for r in found] == [text, "", None]
    assert all(r[name] == name for r in found for name in names)


def test_a_long_text(spark):
    line = " ".join(f"word{i}" for i in range(60)) + ". "
    body = "".join(f"a{i} b{i * 7} c{i % 13} d{i}, " for i in range(100_000))
    docs = spark.createDataFrame([(1, line), (2, body + line)], "doc_id long, text string")
    found = spans.without_repeats(docs).where("doc_id = 2").first()
    assert found.text.startswith(body[:2_000_000]) and len(found.text) < len(body) + 130
