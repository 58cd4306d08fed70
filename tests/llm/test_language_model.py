"""The language model's scores against plain Python, and words held by their hashes."""

import math
import zlib
from collections import Counter

import pytest

from marram.llm import language_model

SF_DIR = "/root/testdata/sf0.001"


def plain_scores(model, classes, texts, train):
    """Log10 probability of each text by the definition: class after class, word within its class."""
    words = [t.encode().lower().split() if t else [] for t in texts]
    seen = Counter(w for t, used in zip(words, train, strict=True) if used for w in t)
    rest, end = model.rest, model.rest + 1

    def kind(word):
        return rest if seen[word] < language_model.HELD_FROM else classes[word]

    pairs, sizes = Counter(), Counter()
    for t, used in zip(words, train, strict=True):
        if used:
            path = [end, *map(kind, t), end]
            pairs.update(zip(path, path[1:], strict=False))
            sizes.update(path[1:])
    total = sum(sizes.values())
    n_classes = end + 1
    before = Counter()
    for (a, _), n in pairs.items():
        before[a] += n
    rare = sum(1 for w, n in seen.items() if n < language_model.HELD_FROM)
    out = []
    for t in words:
        path, value = [end, *map(kind, t), end], 0.0
        for a, b in zip(path, path[1:], strict=False):
            share = (sizes[b] + 0.5) / (total + 0.5 * n_classes)
            value += math.log10((pairs[a, b] + language_model.PRIOR * share) / (before[a] + language_model.PRIOR))
        for w in t:
            if kind(w) == rest:
                value += math.log10((seen[w] + 0.5) / (sizes[rest] + 0.5 * (rare + 1)))
            else:
                value += math.log10(seen[w] / sizes[kind(w)])
        out.append(value)
    return out


def classes_of(model, counts):
    """Class of every word with one: of those that tasks hold, and of the others by their table."""
    out = {}
    for row in counts.collect():
        word = bytes(row.word)
        if word and row.c >= language_model.HELD_FROM:
            at = int(language_model.ids_of([word], model.place, model.further)[0])
            out[word] = int(model.member[at]) if at >= 0 else row["class"]
    return out


@pytest.mark.parametrize("named,held", [(100_000, 1 << 22), (1_000, 2_000), (1_000, 1 << 22)])
def test_scores_of_the_smallest_table_against_plain_python(spark, monkeypatch, named, held):
    monkeypatch.setattr(language_model, "NAMED", named)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = docs.collect()
    train = [zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in rows]
    chosen = spark.createDataFrame([tuple(r) for r, used in zip(rows, train, strict=True) if used], docs.schema)
    model, counts = language_model.train(chosen, held=held)
    assert model.whole == (held > 2_000) and len(model.place) == min(named, len(model.member))
    expected = plain_scores(model, classes_of(model, counts), [r.text for r in rows], train)
    found = {r.doc_id: r.score for r in language_model.score(docs, model, counts).collect()}
    assert [found[r.doc_id] for r in rows] == pytest.approx(expected, rel=1e-9)


def test_a_long_text(spark):
    text = " ".join(f"w{i % 5_000}" for i in range(300_000))
    docs = spark.createDataFrame([(1, text), (2, "w1 w2")], "doc_id long, text string")
    model, counts = language_model.train(docs, clustered=20, classes=4)
    found = {r.doc_id: r.n_tokens for r in language_model.score(docs, model, counts).collect()}
    assert found == {1: 300_001, 2: 3}
