"""Cross-tokenizer alignment against plain Python."""

import hashlib
import random
from collections import Counter
from itertools import product

import pytest

from marram.llm import alignment
from marram.llm.queries import TOKENIZERS

SF_DIR = "/root/testdata/sf0.001"
A = (TOKENIZERS / "byte_bpe_50k.json").read_bytes()
B = (TOKENIZERS / "piece_bpe_32k.model").read_bytes()


@pytest.fixture(scope="module")
def encoders():
    return alignment.byte_level(A), alignment.pieces(B)


def plain(encoders, text):
    """Ids of both sides and groups as lists of ids; None without tokens."""
    (a_encode, a_bytes), (b_encode, b_bytes) = encoders
    if not text:
        return None
    a, b = a_encode([" " + text])[0], b_encode([text])[0]
    spans = []
    for ids, table in ((a, a_bytes), (b, b_bytes)):
        if b"".join(table[x] for x in ids) != (" " + text).encode():
            return None
        end, ends = 0, []
        for x in ids:
            end += len(table[x])
            ends.append(end)
        spans.append(ends)
    groups = []
    left = right = 0
    for end in sorted(set(spans[0]) & set(spans[1])):
        i, j = (len([e for e in ends if e <= end]) for ends in spans)
        groups.append((a[left:i], b[right:j]))
        left, right = i, j
    return a, b, groups


def expected(encoders, texts):
    found = [plain(encoders, text) for text in texts]
    links = [Counter(p for g in f[2] for p in product(*g)) if f else Counter() for f in found]
    n_docs = Counter(pair for each in links for pair in each)
    best = Counter()
    for (a, _), n in n_docs.items():
        best[a] = max(best[a], n)
    out = []
    for f, each in zip(found, links, strict=True):
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in f[2]) if f else ""
        out.append((
            *((len(f[0]), len(f[1]), len(f[2])) if f else (0, 0, 0)),
            sum(each.values()),
            sum(n for p, n in each.items() if n_docs[p] == best[p[0]]),
            sum(n * n_docs[p] for p, n in each.items()),
            hashlib.sha256(written.encode()).hexdigest() if f else "",
        ))
    return out


ODD = [
    None, "", " ", "a", "  two  spaces ", "▁ marked", "<|endoftext|> <s> </s> <unk> <0x41>", "tabs\tand\nlines\r\n\n",
    "日本語のテキスト 混ぜた text", "🙂🙃 emoji 🏳️‍🌈", "é combining", "ﬁ ligature   space", "x" * 3_000, "1234567890" * 20,
    "same text here", "same text here", "\x00\x01 control", "Ａ full width",
]


@pytest.mark.parametrize("held", [alignment.HELD, 3, 0])
def test_alignment_against_brute_force(spark, encoders, held):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).collect() if len(r.text) < 3_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = alignment.alignment(docs, A, B, held=held).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == expected(encoders, texts)


def test_both_byte_level_libraries_agree(encoders):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(A.decode())
    tokenizer.encode_special_tokens = True
    texts = [" " + (text or "") for text in ODD]
    assert encoders[0][0](texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    other = alignment.byte_level(A.replace(b'"normalizer":null', b'"normalizer":{"type":"NFC"}').replace(b'"normalizer": null', b'"normalizer": {"type":"NFC"}'))
    assert other[1] == encoders[0][1]


def test_large_groups_are_counted(encoders, monkeypatch):
    listed = alignment.Aligner(encoders[0][1], encoders[1][1])
    counted = alignment.Aligner(encoders[0][1], encoders[1][1])
    for text in filter(None, ODD):
        whole, a, b = (" " + text).encode(), encoders[0][0]([" " + text])[0], encoders[1][0]([text])[0]
        if listed.gives_back(whole, a, b):
            found = []
            for limit, aligner in ((256, listed), (1, counted)):
                monkeypatch.setattr(alignment, "LISTED", limit)
                found.append(aligner.counted(aligner.windows([whole], [a], [b])[0]))
            assert all((x == y).all() for x, y in zip(*found, strict=True))


def test_memo_that_forgets_and_texts_cut_in_pieces(spark, encoders):
    draw = random.Random(3)
    words = ["the", "überall", "x9", "don't", "naïve", "--", "日本", "over-the-top", "\n", " "]
    texts = [" ".join(draw.choices(words, k=200)) for _ in range(12)] + ODD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = alignment.align(docs, A, B, keep_groups=True).drop("row").orderBy("doc").collect()
    parts = alignment.align(docs, A, B, keep_groups=True, at_once=40, remembered=50).drop("row").orderBy("doc").collect()
    assert whole == parts
    assert all(len(alignment.cut(text, 40)) > 5 for text in texts[:12])


def test_rows_without_text_and_further_columns(spark):
    rows = [(1, b"\xff\xfe bad", "x"), (1, b"good words", "x"), (None, b"good words", "x"), (2, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text binary, row string").selectExpr("doc_id", "cast(text as string) text", "row", "row pair", "row n_a")
    found = alignment.alignment(docs, A, B).collect()
    assert sorted((str(r.doc_id), r.n_a > 0, r.groups_sha256 == "") for r in found) == [
        ("1", False, True), ("1", True, False), ("2", False, True), ("None", True, False),
    ]
    assert alignment.alignment(docs.limit(0), A, B).count() == 0
