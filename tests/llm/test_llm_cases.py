"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marram.llm import (
    caps,
    chat,
    common,
    contamination,
    language,
    language_model,
    mixing,
    quality,
    secrets,
    simhash,
    spans,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, spans string, size string"
LONG = " ".join(f"w{i % 997}" for i in range(60_000))


def odd_documents(spark, *texts):
    rows = [(i, t, "en", "s", 5, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [
        (None, "no id at all here", None, None, None, None, None, None),
        (100, None, None, None, None, None, None, None),
        (101, "", "en", "", 0, "", "", ""),
        (102, LONG, "en", "s", 1, "x", "y", "z"),
        (103, "same row twice", "en", "s", 1, "x", "y", "z"),
        (103, "same row twice", "en", "s", 1, "x", "y", "z"),
        (104, "one id", "fr", "s", 1, "x", "y", "z"),
        (104, "two texts", "fr", "s", 1, "x", "y", "z"),
    ]
    return spark.createDataFrame(rows, DOCS)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **{i: 0 for i in range(41)},
        **{100 + i: 100 for i in range(50)},
    }


def test_blocks_bring_every_pair_together(spark):
    rows = spark.range(50).select((F.col("id") % 2).alias("key"), "id")
    dealt = common.in_blocks(rows, "key", F.col("id"), 4)

    def pairs(rows):
        a, b = np.meshgrid(rows["id"], rows["id"])
        return {"a": a.ravel(), "b": b.ravel()}

    met = common.by_runs(dealt, ["key", "_i", "_j"], pairs, "a long, b long").distinct().where("a < b")
    assert met.count() == 2 * 25 * 24 / 2


# Decontamination


def plain_contamination(docs, items, length=13):
    def words(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)

    out = []
    for text in docs:
        split, hit, found = words(text), set(), set()
        for item, item_text in items:
            w = words(item_text)
            size = min(length, len(w))
            for at in range(len(w) - size + 1) if w else ():
                for i in range(len(split) - size + 1):
                    if split[i : i + size] == w[at : at + size]:
                        hit.update(range(i, i + size))
                        found.add(str(item) if item is not None else "")
        out.append((len(split), len(hit), sorted(found)))
    return out


def test_contamination_against_brute_force(spark):
    draw = random.Random(5)
    vocabulary = ["alpha", "beta", "Gamma", "É", "x1", "y-z"]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 40))) for _ in range(30)]
    items = [(i, " ".join(draw.choices(vocabulary, k=n))) for i, n in enumerate((3, 2, 5, 13, 14, 20, 1))]
    texts += [f"{items[5][1]} and {items[5][1]}", items[4][1].upper(), LONG + " " + items[3][1]]
    items += [(3, items[3][1]), (None, "beta beta"), (9, None), (10, " . ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for length in (13, 4):
        found = contamination.contamination(docs, bench, length=length).orderBy("doc_id").collect()
        expected = plain_contamination(texts, items, length)
        assert [(r.n_words, r.n_hit, r["items"]) for r in found] == expected
        assert [r.contaminated for r in found] == [h > 0 and 20 * h >= n for n, h, _ in expected]


def test_contamination_of_odd_rows(spark):
    docs = odd_documents(spark, "clean", "one id here")
    bench = spark.createDataFrame([(1, "one id"), (2, "no id")], "item_id long, text string")
    rows = contamination.contamination(docs, bench).collect()
    assert len(rows) == docs.count()
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"])) for r in rows)
    assert ("None", 5, 2, ("2",)) in found and ("1", 3, 2, ("1",)) in found
    assert [f for f in found if f[0] == "104"] == [("104", 2, 0, ()), ("104", 2, 2, ("1",))]
    assert [f for f in found if f[0] in ("100", "101")] == [("100", 0, 0, ()), ("101", 0, 0, ())]
    assert sum(f[0] == "103" for f in found) == 2
    assert contamination.contamination(docs.limit(0), bench).count() == 0
    assert contamination.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_index_is_sorted_in_slices(spark):
    """A task sorts the postings of a part of its rows only; all postings are there once, also of rows that repeat."""
    chosen = np.random.default_rng(4)
    own = [(i % 300, " ".join(chosen.choice(["a", "b", "cc"], 20))) for i in range(400)]
    texts = [*own, *own[:50], (None, "a b a"), (7, None), (8, "")]
    docs = common.stored(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), "docs")
    found = contamination.build_index(docs).withColumn("file", F.input_file_name()).collect()
    expected = Counter((i, at) for i, text in texts for at in range(len((text or "").split())))
    assert Counter((r.doc, r.pos) for r in found) == expected
    sizes = Counter(r.file for r in found)
    assert len(sizes) == contamination.SLICES and 2 * max(sizes.values()) < len(found)
    for file in sizes:
        terms = [r.term for r in found if r.file == file]
        assert terms == sorted(terms)


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "red x blue y green"), (2, "red a b c d e f green blue")], "doc_id long, text string")
    index = contamination.build_index(docs)
    phrases = spark.createDataFrame([("blue red green", 3)], "phrase string, size int")
    assert {(r.doc) for r in contamination.near_matches(index, phrases, 4).collect()} == {1}
    assert {(r.doc) for r in contamination.near_matches(index, phrases, 9).collect()} == {1, 2}


# Quality


def test_machine_terms_equal_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    machine = quality.Machine(0.5, draw.normal(size=9), draw.normal(size=(9, quality.RANK)))
    index, value = np.array([1, 4, 7]), np.array([0.5, 2.0, -1.0])
    pairs = sum(
        machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j]
        for i in range(3)
        for j in range(i)
    )
    raw, _ = machine.terms(index, value, np.array([0]))
    assert raw[0] == pytest.approx(0.5 + machine.weights[index] @ value + pairs)


def test_machine_learns_an_interaction():
    """Neither feature tells the label alone, both together do."""
    draw = np.random.default_rng(3)
    a, b = draw.integers(0, 2, 600), draw.integers(0, 2, 600)
    rows = [(np.array([x, 2 + y]), np.ones(2)) for x, y in zip(a, b, strict=True)]
    machine = quality.fit(rows, (a ^ b).astype(float), epochs=30)
    assert ((machine.scores(rows) > 0.5) == (a ^ b)).mean() > 0.95


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark, *[f"good text number {i}" for i in range(10)], *["### $$$ !!!"] * 5)
    labels = spark.createDataFrame(
        [(i, int(i < 10)) for i in range(15)] + [(3, 1), (None, 1), (4, None), (500, 0), (5, 7)],
        "doc_id long, quality int",
    )
    scored = quality.with_score(docs, quality.train(docs, labels), name="quality").collect()
    assert len(scored) == docs.count()
    assert all(0 <= r.quality <= 1 for r in scored)
    assert len({r.quality for r in scored if r.doc_id == 103}) == 1
    none = quality.train(docs, labels.limit(0))
    assert {r.quality for r in quality.with_score(docs, none, name="quality").collect()} == {0.5}
    assert quality.with_score(docs.limit(0), none).count() == 0


# Language


def test_language_of_odd_rows(spark):
    english, french = "the cat and the dog of the house", "le chat et le chien de la maison"
    docs = odd_documents(spark, "12 34 !!", "½ ² ٣", "the dog", "LE CHIEN ET LA MAISON").unionByName(
        spark.createDataFrame(
            [(200 + i, english if i % 2 else french, "en" if i % 2 else "fr", "s", 1, "", "", "") for i in range(20)],
            DOCS,
        )
    )
    filters = language.train(docs.where("doc_id >= 200"))
    rows = language.with_language(docs, filters).collect()
    told = {r.doc_id: r.language.lang for r in rows}
    assert len(rows) == docs.count()
    assert (told[0], told[1], told[100], told[101]) == ("und",) * 4
    assert (told[2], told[3]) == ("en", "fr")
    assert all(0 <= r.language.score <= 1 for r in rows)
    nothing = language.train(docs.limit(0))
    assert {r.language.lang for r in language.with_language(docs, nothing).collect()} == {"und"}


def test_filters_hold_more_than_64_languages(spark):
    rows = [(i, f"{chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 3, f"l{i:02}") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language.train(docs)
    assert filters.masks.shape[1] == 2
    assert all(filters.predict(text)[0] == lang for _, text, lang in rows)


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "abc déf " * 500
    whole = np.sort(np.concatenate(list(language.grams(text))))
    monkeypatch.setattr(language, "_AT_ONCE", 97)
    assert (np.sort(np.concatenate(list(language.grams(text)))) == whole).all()


# Vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")


def test_vectors_with_clusters_and_copies(spark):
    draw = np.random.default_rng(2)
    rows = []
    for centre in range(12):
        base = draw.normal(size=32)
        for _ in range(60):
            rows.append((len(rows), (base + 0.25 * draw.normal(size=32)).tolist(), centre % 2, "x"))
    rows += [(len(rows) + i, rows[5][1], 0, "x") for i in range(150)]
    frame = vectors(spark, rows)
    found = caps.near_vectors(frame).toPandas().set_index("vec_id").sort_index()
    unit = np.array([r[1] for r in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    assert (found.n_links <= near.sum(axis=1)).all()
    assert found.n_links.sum() >= 0.99 * near.sum() > 10_000
    assert (found.kept == (found.index == found.component_id)).all()


def test_recall_at_the_threshold():
    """Pairs of a cosine just above the threshold share a cap in nearly all cases."""
    draw = np.random.default_rng(4)
    a = draw.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = draw.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.931 * a + (1 - 0.931**2) ** 0.5 * side
    lists = []
    for unit in (a, b):
        row, name = caps.decode(unit, caps.code_size(5_000))
        lists.append([set(name[row == i]) for i in range(len(unit))])
    met = np.mean([bool(x & y) for x, y in zip(*lists, strict=True)])
    assert met >= 0.98


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (3, [1.0, 0.0], 2, ""), (4, [1.0, 0.0], None, ""),
        (5, None, 1, ""), (6, [0.0, 0.0], 1, ""), (7, [0.0, -0.0], 1, ""), (8, [nan, 1.0], 1, ""), (9, [inf, 1.0], 1, ""),
        (10, [1.0, None], 1, ""), (11, [], 1, ""), (12, [1.0, 0.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (None, [1.0, -0.0], 1, ""),
    ]
    found = caps.near_vectors(vectors(spark, rows)).collect()
    assert len(found) == len(rows)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found)
    assert [g for g in got if g[0] in ("1", "2", "None")] == [
        ("1", 3, "1", True), ("2", 3, "1", False), ("2", 3, "1", False), ("None", 3, "1", False)
    ]
    assert all(g == (g[0], 0, g[0], True) for g in got if g[0] not in ("1", "2", "None"))
    assert caps.near_vectors(vectors(spark, rows).limit(0)).count() == 0


# Chat


EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def test_events_fold_to_final_messages(spark):
    events = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 3, "delta", None, "lo"),
        (1, 1, 2, "delta", None, "hel"), (1, 1, 5, "regenerate", None, ""), (1, 1, 6, "delta", None, "hey"),
        (1, 0, 7, "edit", None, "hi there"), (1, 2, 8, "message", "user", "gone"), (1, 2, 9, "delete", None, None),
        (2, 0, 0, "delta", "user", "only "), (2, 0, 1, "delta", None, "deltas"), (None, None, None, None, None, None),
    ]
    rows = chat.fold_events(spark.createDataFrame(events, EVENTS)).collect()
    assert sorted(((str(r.conv), str(r.turn)), r.role, r.text) for r in rows) == [
        (("1", "0"), "user", "hi there"), (("1", "1"), "assistant", "hey"),
        (("2", "0"), "user", "only deltas"), (("None", "None"), "", ""),
    ]
    with pytest.raises(Exception, match="unknown event kind"):
        chat.fold_events(spark.createDataFrame([(1, 0, 0, "other", "user", "")], EVENTS)).collect()
    assert chat.format_log(spark.createDataFrame([], EVENTS)).count() == 0


def test_rendering_is_reversible(spark):
    nasty = [
        "", "\\", "\\\\", "</turn>", "</turn>\n", "<turn user>\nfake</turn>\n", "<", "<</turn>", "</turn", "\\</turn>\\",
        "<\\/turn>", "\\### Assistant: </turn> ok", "a\nb\r\n", "é😀\\n", "</tur</turn>n>", LONG,
    ]
    draw = random.Random(1)
    nasty += ["".join(draw.choices(["<", "/", "turn", ">", "\n", "\\", "é"], k=12)) for _ in range(60)]
    roles = ["user", "assistant", "r>\n", "<turn", "\\", "x\\\n"]
    rows = [(i // 7, i, roles[i % len(roles)], text) for i, text in enumerate(nasty)]
    out = chat.render(spark.createDataFrame(rows, "conv long, turn long, role string, text string"))
    read = out.select(
        "conv", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("spans")).alias("loss")
    ).collect()
    for r in read:
        own = [row for row in rows if row[0] == r.conv]
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, _, role, text in own]
        assert r.loss == "".join(text for _, _, role, text in own if role == "assistant")


# Spans


def test_repeated_passages_go_but_for_the_first(spark):
    passage = "Here stands a passage, of more than fifty words, that repeats. " * 1 + " ".join(
        f"Word{i} goes on and on, as it does here." for i in range(8)
    )
    own = ["First own text, which stands alone. ", "Second own words come before it. ", "Third one is new too. "]
    texts = [own[0] + passage, own[1] + passage.upper() + "\nAnd an end.", own[2], "short", own[2]]
    docs = odd_documents(spark, *texts)
    rows = {(r.doc_id, r.text): r for r in spans.without_repeats(docs).collect()}
    assert (0, texts[0]) in rows
    changed = [r for (d, _), r in rows.items() if d == 1][0]
    assert changed.text == own[1] + "And an end." and changed.n_removed > 5
    assert changed.removed == f"{len(own[1])}:{len(own[1] + passage) + 1}"
    assert all((i, texts[i]) in rows for i in (2, 3, 4))
    assert rows[(100, None)].n_sentences == 0 and rows[(101, "")].n_removed == 0
    assert spans.without_repeats(docs).count() == docs.count()
    assert spans.without_repeats(docs).columns == [*docs.columns, "n_sentences", "n_removed", "removed"]
    assert spans.without_repeats(docs.limit(0)).count() == 0


def test_sentences_cover_the_text():
    for text in ("", "a", "One. Two, three!\n\nFour", "  lead. tail  ", "x " * 100, "3.14 is. e.g. here\n", "\n\n", "a.\nb"):
        parts = spans.sentences(text)
        assert "".join(text[a:b] for a, b, _ in parts) == text
        assert [w for _, _, words in parts for w in words] == text.lower().split()


def test_passages_of_fifty_words_share_a_run_at_every_offset():
    draw = np.random.default_rng(3)
    marks = np.array(["", ".", ",", " \u0964"])
    for odds in ([1, 0, 0, 0], [0.95, 0.02, 0.02, 0.01], [0.8, 0.1, 0.1, 0]):
        for kinds in (1000, 30, 1):
            passage = " ".join(f"w{i}{m}" for i, m in zip(draw.integers(0, kinds, 50), draw.choice(marks, 50, p=odds)))
            found = []
            for offset in range(17):
                own = " ".join(f"own{offset}x{i}" for i in range(offset))
                parts = spans.sentences(f"{own} {passage} end{offset} " + own)
                joined = [" ".join(words) for _, _, words in parts]
                at = np.cumsum([0, *(len(w) for *_, w in parts)])
                found.append({" ".join(joined[a:b]) for a, b in zip(*spans.runs(at), strict=True)})
                assert max(len(words) for _, _, words in parts) <= 8
            assert set.intersection(*found)


def test_a_passage_without_marks_goes_wherever_it_stands(spark):
    passage = " ".join(f"item{i}" for i in range(51))
    texts = [" ".join([*(f"own{n}x{i}" for i in range(n)), passage]) for n in range(17)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = [r.n_removed for r in spans.without_repeats(docs).orderBy("doc_id").collect()]
    assert n[0] == 0 and min(n[1:]) > 2


# Language model


def test_exchange_finds_two_classes():
    pairs = np.zeros((8, 8))
    for i in range(3):
        for j in range(3, 6):
            pairs[i, j] = pairs[j, i] = 10 + i + j
    member = language_model.exchange(pairs, 6, 2)
    assert len(set(member[:3])) == len(set(member[3:6])) == 1 and member[0] != member[3]
    assert list(member[6:]) == [2, 3]


def test_exchange_never_lowers_the_likelihood():
    pairs = np.random.default_rng(0).poisson(1.0, (14, 14)).astype(float)

    def likelihood(member):
        table = np.zeros((6, 6))
        np.add.at(table, (member[:, None].repeat(14, 1), member[None].repeat(14, 0)), pairs)
        gain = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1e-9)), 0).sum()
        return gain(table) - gain(table.sum(0)) - gain(table.sum(1))

    values = [likelihood(language_model.exchange(pairs, 12, 4, rounds)) for rounds in range(5)]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False)) and values[-1] > values[0]


@pytest.mark.parametrize("held", [3, 50])
def test_language_model_of_odd_rows(spark, held):
    docs = odd_documents(spark, "a b a c", "A b d")
    model, counts = language_model.train(docs, clustered=2, held=held, classes=2)
    rows = language_model.score(docs, model, counts).collect()
    assert len(rows) == docs.count()
    total = {bytes(r.word): r.c for r in counts.collect()}
    assert model.n_tokens == sum(total.values()) and total[b""] == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[100].n_tokens, by_id[101].n_known, by_id[0].n_tokens) == (1, 1, 5)
    assert all(r.n_known == r.n_tokens and r.score < 0 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 103}) == 1
    empty, none = language_model.train(docs.limit(0))
    assert language_model.score(docs.limit(0), empty, none).count() == 0
    assert all(r.n_known == 0 for r in language_model.score(docs, empty, none).collect())


def test_words_outside_the_held_ones_have_the_same_classes(spark):
    draw = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(words[(draw.zipf(1.3, 40) - 1) % 60]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0], "", "new1 new2 w59"])), "doc_id long, text string")
    found = []
    for held in (5, 20, 1000):
        model, counts = language_model.train(docs, clustered=10, held=held, classes=4)
        rows = language_model.score(docs, model, counts).orderBy("doc_id").collect()
        found.append([r.score for r in rows])
        assert model.whole == (held == 1000)
        assert model.transitions.sum() == model.n_tokens
        assert [r.n_known == r.n_tokens for r in rows] == [True] * docs.count()
    assert found[0] == pytest.approx(found[2]) and found[1] == pytest.approx(found[2])


def test_exchange_goes_on_until_no_word_moves():
    pairs = np.random.default_rng(2).poisson(0.3, (302, 302)).astype(float)
    member = language_model.exchange(pairs, 300, 8)
    assert (member == language_model.exchange(pairs, 300, 8, 500)).all()
    assert (member != language_model.exchange(pairs, 300, 8, 12)).any()


# SimHash


def test_words_within_two_bits_share_a_codeword():
    draw = random.Random(2)
    tables = simhash.golay_tables()
    words = [draw.getrandbits(23) for _ in range(300)]
    other = [w ^ 1 << draw.randrange(23) ^ (1 << draw.randrange(23)) * draw.getrandbits(1) for w in words]
    lists = [simhash.codeword_indices(np.array(x), tables) for x in (words, other)]
    for a, b in zip(*lists, strict=True):
        assert {x for x in a if x >= 0} & {x for x in b if x >= 0}


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 91}" for i in range(400)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("block", [3, 1024])
def test_links_against_all_pairs(spark, block):
    draw = random.Random(8)
    prints = {draw.getrandbits(64) for _ in range(200)}
    for centre in list(prints)[:10]:
        prints |= {centre ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for _ in range(40)}
    values = np.array(sorted(prints), np.uint64)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = common.components(simhash.links(frame, block=block)).toPandas()
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    signed = values.view(np.int64)
    first = common.local_links(near)
    smallest = {}
    for i, group in enumerate(first):
        smallest[group] = min(smallest.get(group, signed[i]), signed[i])
    got = dict(zip(found.node, found.component, strict=True))
    assert all(got.get(int(v), int(v)) == smallest[first[i]] for i, v in enumerate(signed))


def test_simhash_of_odd_rows(spark):
    docs = odd_documents(spark, "Same  ROW\ttwice", " \n ")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    found = {r.doc_id: r for r in rows}
    assert found[100].fp == found[101].fp == found[1].fp == 0 and found[101].component_id == 1
    assert found[103].component_id == 0
    assert found[None].component_id is None
    first = simhash.first_of_each(docs)
    assert first.columns == docs.columns
    assert sorted(str(r.doc_id) for r in first.collect()) == ["0", "1", "102", "104", "104", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# Mixing


def test_targets_are_reshared_until_none_is_above(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 400, None: 90}
    rows = [(i, s, z) for i, (s, z) in enumerate(sizes.items())]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = {r.source: r.target for r in mixing.mix(frame).collect()}
    weights, free, left = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True)), set(sizes), 1.5 * 2000
    expected = {}
    while True:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if 2 * sizes[s] <= weights[s] * level}
        if not full:
            break
        expected |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    expected |= {s: weights[s] * level for s in free}
    assert found == pytest.approx(expected)
    assert sum(found.values()) == pytest.approx(3000)


@pytest.mark.parametrize("rows_per_bucket", [1, 8, 64])
def test_prefix_sums_over_levels(spark, rows_per_bucket, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_BITS", 3)
    frame = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.col("id").cast("string")).alias("source"),
        (F.col("id") % 7).alias("size"),
    )
    found = mixing.mix(frame, rows_per_bucket=rows_per_bucket).toPandas()
    sums = found.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (sums.taken == np.floor(sums.target)).all()
    assert (found.taken <= 2 * found["size"]).all()
    assert sorted(found.doc_id) == list(range(3000))


def test_mixing_of_odd_rows(spark):
    docs = odd_documents(spark, "a b c").drop("size").withColumn("size", common.count_tokens(F.col("text")))
    found = mixing.mix(docs)
    assert found.columns == [*docs.columns, "source_size", "target", "taken"]
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert mixing.mix(docs.limit(0)).count() == 0
    nothing = docs.withColumn("size", F.lit(None).cast("long"))
    assert {(r.taken, r.target) for r in mixing.mix(nothing).collect()} == {(0, 0.0)}
    copies = spark.createDataFrame([(1, "s", 3)] * 10 + [(2, "t", 100)], "doc_id long, source string, size long")
    assert len({r.taken for r in mixing.mix(copies).where("doc_id = 1").collect()}) == 1


# Secrets


def test_ledger_scans_only_what_it_has_not_seen(spark):
    key, hexes = "AKIA" + "B" * 16, "0123456789abcdef0"
    first = spark.createDataFrame([(1, f"x {key}"), (2, f"x {key}"), (3, None)], "path long, text string")
    findings, scanned = secrets.scan(first)
    assert scanned.count() == 2 * len(secrets.RULES)
    assert [(r.rule, r.start, r.end) for r in findings.collect()] == [("access@1", 2, 22)]
    newer = tuple(r for r in secrets.RULES if r.kind != "hex") + (secrets.Rule("hex", 2, "[0-9a-f]{17,}", 0, 17),)
    more = spark.createDataFrame([(1, f"x {key}"), (4, f"é {hexes}")], "path long, text string")
    todo = secrets.unseen(more.select(secrets.blob_id(F.col("text")).alias("blob")), newer, scanned)
    assert sorted(len(r.pending) for r in todo.collect()) == [1, len(newer)]
    again, all_scanned = secrets.scan(more, rules=newer, scanned=scanned, findings=findings)
    assert sorted((r.rule, r.start, r.end) for r in again.collect()) == [("access@1", 2, 22), ("hex@2", 2, 19)]
    assert all_scanned.count() == scanned.count() + 1 + len(newer)
    found = {r.path: [(s.kind, s.start) for s in r.spans] for r in secrets.attach(more, again, rules=newer).collect()}
    assert found == {1: [("access", 2)], 4: [("hex", 2)]}


def test_spans_against_plain_matching(spark):
    draw = random.Random(4)
    pieces = ["password", "PASSWD: ", "secret=", "token", "api_key", "apikey' = '", ":", "=", " ", '"', "AKIA", "AKIA1", "A1B2C3D4E5F6G7H8",
              "0123456789abcdef", "fe", "é", "\n", "😀", "abcDEF+/_.=-", "-----BEGIN RSA PRIVATE KEY-----"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 25))) for _ in range(300)] + ["token: secret: abcdefghijklmnop"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    findings, _ = secrets.scan(docs)
    rows = secrets.attach(docs, findings).orderBy("doc_id").collect()
    rules = [
        ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16),
    ]
    for text, row in zip(texts, rows, strict=True):
        expected = sorted(
            (m.start(), place, m.end(), kind)
            for place, (kind, pattern, group, least) in enumerate(rules)
            for m in pattern.finditer(text)
            if len(m[group]) >= least
        )
        assert [tuple(s) for s in row.spans if s.place < 3] == expected


def test_redaction_and_odd_rows(spark):
    key = "AKIA" + "C" * 16
    docs = odd_documents(spark, f"{key} and token={key}.", "nothing")
    findings, _ = secrets.scan(docs)
    found = secrets.attach(docs, findings)
    assert found.count() == docs.count() and set(found.columns) == set(docs.columns)
    out = found.select("doc_id", secrets.redact(F.col("text"), F.col("spans")).alias("text")).collect()
    by_id = {r.doc_id: r.text for r in out}
    assert by_id[0] == "[SECRET] and [SECRET]" and by_id[1] == "nothing" and by_id[100] is None and by_id[102] == LONG
    findings, scanned = secrets.scan(docs.limit(0))
    assert findings.count() == scanned.count() == 0


def test_pipeline_stages_on_odd_and_empty_tables(spark):
    import corpus_pipeline as pipeline

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd_documents(spark, "one two three", "12").select(*columns, F.lit("x").alias("spans")), odd_documents(spark).select(*columns).limit(0)):
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
        for _, stage in pipeline.STAGES:
            docs = common.stored(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert {"taken", "target"} <= set(docs.columns)
