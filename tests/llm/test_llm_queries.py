"""Registered queries against SQL, brute force or held-out accuracy on the small tables."""

import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    with compare.connect(LARGER) as opened:
        yield opened


@pytest.mark.parametrize("name", [n for n in entry.LLM_QUERIES if n in entry.oracle_sql()])
def test_query_agrees_with_sql(spark, connection, name):
    assert compare.compare(spark, connection, LARGER, name, {}) == ""


def table(spark, name, sf=LARGER):
    return spark.read.parquet(f"{sf}/{name}.parquet").toPandas()


def answer(spark, name, sf=LARGER):
    return entry.queries()[name](spark, sf).toPandas()


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def test_quality_on_held_out_documents(spark):
    found = answer(spark, "op2_quality").merge(table(spark, "labels"), on="doc_id")
    held = found[found.held_out]
    assert (found.held_out == found.doc_id.map(fold).eq(0)).all()
    assert found.score.between(0, 1).all()
    assert (held.predicted == held.quality).mean() > 0.93


def test_language_on_held_out_documents(spark):
    found = answer(spark, "op3_language").merge(table(spark, "documents"), on="doc_id")
    held = found[found.held_out]
    assert found.score.between(0, 1).all()
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_embedding_links_against_all_pairs(spark):
    vectors = table(spark, "embeddings", "/root/testdata/sf0.1")
    check_links(vectors, answer(spark, "op4_embeddings", "/root/testdata/sf0.1"), recall=1.0)


def check_links(vectors, found, recall):
    unit = np.stack(vectors.embedding).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    same = vectors.label.to_numpy()[:, None] == vectors.label.to_numpy()[None, :]
    near = (unit @ unit.T >= 0.93) & same
    np.fill_diagonal(near, False)
    n = found.set_index("vec_id").n_links.loc[vectors.vec_id].to_numpy()
    assert (n <= near.sum(axis=1)).all()
    assert n.sum() >= recall * near.sum()
    return near


def test_language_model_base_and_gain(spark):
    found = answer(spark, "op7_language_model").set_index("doc_id")
    docs = table(spark, "documents").set_index("doc_id").text
    counts, split = Counter(), {}
    for doc_id, text in docs.items():
        split[doc_id] = text.encode().lower().split() + [b""]
        if fold(doc_id) != 1:
            counts.update(split[doc_id])
    total, distinct = sum(counts.values()), len(counts)
    assert (found.train_tokens == total).all()
    for doc_id, words in split.items():
        row = found.loc[doc_id]
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert row.base_score == pytest.approx(base)
        assert (row.n_tokens, row.n_known) == (len(words), sum(counts[w] > 0 for w in words))
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum()


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams] if words else []
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, near):
    """Brute force over a matrix of links."""
    label = np.asarray(ids).copy()
    while True:
        new = np.array([min(label[i], label[row.nonzero()[0]].min(initial=label[i])) for i, row in enumerate(near)])
        if (new == label).all():
            return label
        label = new


def test_simhash_against_all_pairs(spark):
    docs = table(spark, "documents")
    found = answer(spark, "op8_simhash").set_index("doc_id").loc[docs.doc_id]
    prints = np.array([fingerprint(text) for text in docs.text], np.uint64)
    assert [int(p, 16) for p in found.fingerprint] == [int(p) for p in prints]
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    assert (found.component_id.to_numpy() == smallest_reachable(docs.doc_id, near)).all()


def test_mixing_takes_the_budget_of_each_source(spark):
    found = answer(spark, "op9_mixing").merge(table(spark, "documents")[["doc_id", "source"]])
    assert (found.taken <= 2 * found["size"]).all()
    sums = found.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (sums.taken == np.floor(sums.target)).all()
    again = answer(spark, "op9_mixing").sort_values("doc_id").taken.tolist()
    assert found.sort_values("doc_id").taken.tolist() == again


def alike(texts, size=5, least=0.8):
    """All pairs whose sets of word shingles have the similarity, by the words themselves."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        grams = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        sets.append(set(grams or [tuple(words)]))
    near = np.zeros((len(sets), len(sets)), bool)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b) if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) else 0
            near[i, j] = near[j, i] = both >= least * (len(a) + len(b) - both)
    return near


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline as pipeline
    from marram.llm.common import stored

    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    seen = {}
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, LARGER), name)
        seen[name] = docs.toPandas()
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    told = seen["language"]
    assert len(told) == 1000
    first = smallest_reachable(told.doc_id, alike(told.text))
    assert set(seen["simhash"].doc_id) == set(first)
    bad = entry.queries()["op1_decontamination"](spark, LARGER).where("contaminated").toPandas().doc_id
    assert set(seen["decontamination"].doc_id) == set(first) - set(bad)
    left = seen["secrets"]
    assert set(left.doc_id) == set(seen["decontamination"].doc_id)
    assert (left.text.str.len() == left.n_chars).all()
    assert left.text.str.contains("[SECRET]", regex=False).any()
    assert not left.text.str.contains("AKIA[A-Z0-9]{14}").any()
    mixed = seen["mixing"]
    sums = mixed.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (sums.taken == np.floor(sums.target)).all()
    final = pipeline.run(spark, LARGER).toPandas()
    assert sorted(zip(final.doc_id, final.taken)) == sorted(zip(mixed.doc_id, mixed.taken))


def test_every_query_runs_on_the_smallest_tables(spark):
    for name in entry.LLM_QUERIES:
        assert entry.queries()[name](spark, SF_DIR).count() > 0, name
