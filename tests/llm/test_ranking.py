"""Ranked lexical search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marram.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_top(docs, items, top):
    split = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    split = [(doc_id, c, sum(c.values())) for doc_id, c in split if c]
    n_docs, n_terms = len(split), sum(n for *_, n in split)
    df = Counter(term for _, c, _ in split for term in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c, n in split:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def drawn(seed, n_docs=200, n_items=25):
    draw = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma-ray", "É", "x1", "del_ta", "日本", "o'clock", *map(str, range(30))]
    docs = [(draw.randrange(n_docs), " ".join(draw.choices(vocabulary, k=draw.randint(0, 25)))) for _ in range(n_docs)]
    docs += [(900 + i, "alpha Beta x1") for i in range(40)] + [(None, "alpha Beta x1"), (None, None), (7, None), (8, "")]
    docs.append((950, " ".join(draw.choices(vocabulary, k=50_000))))
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 12)))) for i in range(n_items)]
    items += [(3, "alpha"), (3, "alpha"), (None, "beta x1 x1"), (70, None), (71, ""), (72, "nowhere"), (73, "x1 " * 3_000)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [ranking.BLOCK_BYTES, 300])
def test_top_documents_against_brute_force(spark, block_bytes):
    docs, items = drawn(11)
    found = ranking.top_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
        top=7,
        block_bytes=block_bytes,
    )
    assert sorted(map(tuple, found.collect()), key=str) == plain_top(docs, items, 7)


def test_other_columns_string_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "red fish", 1, 2), ("a", "red fish", 1, 2)], "doc_id string, text string, score int, rank int")
    items = spark.createDataFrame([("q", "fish", 1)], "item_id string, text string, doc_id int")
    found = ranking.top_documents(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert [(r.rank, r.doc_id) for r in found.orderBy("rank").collect()] == [(1, "a"), (2, "b")]
    for left, right in ((docs.limit(0), items), (docs, items.limit(0))):
        none = ranking.top_documents(left, right)
        assert none.dtypes == found.dtypes and none.count() == 0


def test_tiles_keep_sums_below_the_limit(monkeypatch):
    monkeypatch.setattr(ranking, "TERM_TILE", 16)
    rng = np.random.default_rng(5)
    entries = np.unique(rng.integers(0, [9, 100], (400, 2)), axis=0)
    factor = rng.integers(1, 60, len(entries))
    total = np.zeros((9, 100), np.int64)
    for columns, item, column, value in ranking.term_tiles(entries[:, 0], entries[:, 1], factor, 50):
        assert len(columns) <= 16
        sums = np.bincount(item, value)
        assert sums.max() <= 50
        np.add.at(total, (item, columns[column]), value)
    expected = np.zeros((9, 100), np.int64)
    expected[entries[:, 0], entries[:, 1]] = factor
    assert (total == expected).all()


def test_products_of_the_largest_factors_are_exact():
    assert ranking.LIMIT * (ranking.IMPACT - 1) < 1 << 53
