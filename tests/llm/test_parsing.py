"""Removal of long repeats against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marram.llm import parsing

SF_DIR = "/root/testdata/sf0.001"


def plain(texts, length):
    texts = [t if isinstance(t, bytes) else (t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int(np.diff(gone.astype(int), prepend=0).clip(0).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def answer(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = parsing.without_repeats(docs, **options).orderBy("doc_id").collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]


def drawn(seed, length):
    draw = random.Random(seed)
    vocabulary = ["ab", "c", "déjà", "the", "日", "x" * 7, "qu"]

    def some(n):
        return " ".join(draw.choices(vocabulary, k=n))

    passages = [some(k) for k in (1 + length // 6, length // 3, length, 2 * length)]
    texts = [some(draw.randint(0, length)) for _ in range(20)]
    for _ in range(30):
        p = draw.choice(passages)
        a, b = sorted((draw.randrange(len(p)), draw.randrange(len(p))))
        texts.append(some(draw.randint(0, 20)) + draw.choice([p, p[a:], p[:b], p[a:b]]) + some(draw.randint(0, 20)))
    texts += [passages[3], passages[3], passages[3] * 2, "a" * length, "a" * (length - 1), "ab" * length, "b" * (3 * length)]
    texts += [None, "", "short", *(passages[2][:k] + "!" + passages[2][k:] for k in range(0, len(passages[2]), 29))]
    return texts


@pytest.mark.parametrize("length,options", [
    (400, {}), (400, {"at_once": 300}), (400, {"block": 2}), (60, {}), (60, {"at_once": 64, "block": 1}), (20, {}), (5, {"block": 3}),
])
def test_without_repeats_against_brute_force(spark, length, options):
    texts = drawn(length, length)
    assert answer(spark, texts, length=length, **options) == plain(texts, length)


def test_whole_smallest_table_against_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()]
    found, expected = answer(spark, texts), plain(texts, 400)
    assert found == expected and sum(n for _, n, _, _ in found) > 10_000


def test_long_text_kept_bytes_and_spans(spark):
    line = "".join(chr(97 + i * i % 23) for i in range(500))
    draw = random.Random(1)
    body = "".join(draw.choices("abcdefgh ", k=2_500_000))
    docs = spark.createDataFrame([(1, line + body + line), (2, "é" + line), (2, "é")], "doc_id long, text string")
    found = parsing.without_repeats(docs, keep_text=True, at_once=1 << 18).orderBy("doc_id", "n_bytes").collect()
    assert bytes(found[0].kept).decode() == body
    assert found[0].removed == f"0:500,{500 + len(body)}:{1000 + len(body)}"
    assert [bytes(r.kept).decode() for r in found[1:]] == ["é", "é"]


def test_equal_rows_null_ids_other_columns_and_no_rows(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(200))
    rows = [(1, text, 1), (1, text, 1), (None, "x" + text, 2), (None, "no repeat", 3), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, same int").selectExpr("*", "same doc", "same known", "text kept")
    found = parsing.without_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes - r.n_removed) for r in found) == [("1", 0), ("1", 0), ("4", 0), ("None", 1), ("None", 9)]
    assert parsing.without_repeats(docs.limit(0)).count() == 0
