"""Near-duplicates by sets of five-word shingles, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marram.llm import common, similar, simhash


def changed(random, words, n):
    """``words`` with ``n`` of them replaced."""
    out = list(words)
    for at in random.choice(len(words), n, replace=False):
        out[at] = f"x{random.integers(1 << 40)}"
    return out


def made(seed=5):
    """Texts of 60 to 600 words, copies with changes on both sides of the threshold, and a common passage."""
    random = np.random.default_rng(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        words = [f"w{i}" for i in random.integers(0, 500, random.integers(60, 600))]
        if random.random() < 0.4:
            words[30:30] = passage
        texts.append(words)
        for _ in range(random.integers(0, 5)):
            texts.append(changed(random, words, int(random.integers(0, len(words) // 30))))
    return [" ".join(words) for words in texts]


def components(n, pairs):
    label = list(range(n))
    for _ in range(n):
        before = list(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def pairs(texts, least=similar.LEAST):
    grams = []
    for text in texts:
        words = (text or "").lower().split()
        grams.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)})
    return [
        (i, j)
        for i, a in enumerate(grams)
        for j, b in enumerate(grams[:i])
        if len(a & b) >= least * len(a | b)
    ]


def kept(spark, texts, **given):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(row.doc_id for row in simhash.first_of_each(docs, **given).collect())


@pytest.mark.parametrize("block", [1024, 3])
def test_first_of_each_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similar.candidates, "__defaults__", (block,))
    monkeypatch.setattr(similar.links, "__defaults__", (similar.LEAST, block))
    texts = made()
    linked = pairs(texts)
    assert 10 < len(linked) < len(pairs(texts, 0.5))
    assert kept(spark, texts) == sorted(set(components(len(texts), linked)))


def test_a_large_group_of_near_copies(spark):
    """A chain of copies, each changed a little more: one group only by its links, no two of them equal."""
    random = np.random.default_rng(7)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(400):
        words = changed(random, words, 1)
        texts.append(" ".join(words))
    assert kept(spark, texts) == [0]
    assert kept(spark, texts[::40]) == sorted(set(components(10, pairs(texts[::40]))))


def test_odd_texts(spark):
    texts = [None, "", " \n", "a", "A", "a b", "a b c d e", "a b c d e f", "a  b c\td E", "é", "É", "long " * 30000, "long " * 20000]
    assert kept(spark, texts) == [0, 3, 5, 6, 7, 9, 10, 11]
    docs = spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b"), (None, "c"), (None, "c")], "doc_id long, text string")
    rows = sorted(map(tuple, simhash.first_of_each(docs).collect()), key=str)
    assert rows == [(4, "a b"), (None, "c")]
    assert simhash.first_of_each(docs.limit(0)).count() == 0


def test_forest_is_cheapest_and_spans():
    random = np.random.default_rng(3)
    for n in (2, 3, 9, 40):
        cost = random.integers(0, 60, (n, n)).astype(np.int16)
        cost = np.minimum(cost, cost.T)
        a, b = similar.forest(cost, similar.MOST_BITS)
        near = cost <= similar.MOST_BITS
        np.fill_diagonal(near, False)
        parts = common.local_links(near)
        assert len(a) == n - len(set(parts))
        assert components(n, zip(a, b)) == components(n, zip(*near.nonzero()))
        edges = sorted((cost[i, j], i, j) for i in range(n) for j in range(i) if near[i, j])
        taken, label = 0, list(range(n))
        for price, i, j in edges:
            if label[i] != label[j]:
                taken, old = taken + price, label[i]
                label = [label[j] if x == old else x for x in label]
        assert cost[a, b].sum() == taken


def test_sketch_in_parts_is_the_same(monkeypatch):
    hashes = similar.shingles(" ".join(f"w{i * i}" for i in range(900)).encode())
    whole = similar.sketch(hashes)
    monkeypatch.setattr(similar, "_AT_ONCE", 7)
    for a, b in zip(whole, similar.sketch(hashes), strict=True):
        assert np.array_equal(a, b)



def test_a_failed_edge_of_the_forest_hides_no_link(spark, monkeypatch):
    """Sketches that say nothing: the forest is any tree, most of its edges fail, and links are elsewhere."""
    plain = similar.sketch

    def blunt(hashes):
        name, print_, bits, keys = plain(hashes)
        return name, print_, np.zeros_like(bits), keys

    monkeypatch.setattr(similar, "sketch", blunt)
    texts = made(seed=11)
    assert kept(spark, texts) == sorted(set(components(len(texts), pairs(texts))))


def test_links_that_no_band_finds(spark, monkeypatch):
    """Without any candidate of the sketches every link comes from first members."""
    monkeypatch.setattr(similar, "candidates", lambda nodes, keys, block=None: nodes.selectExpr("node a", "node b").limit(0))
    texts = made(seed=12)
    expected = sorted(set(components(len(texts), pairs(texts))))
    assert kept(spark, texts) == expected
    # Keys of more than three sets move to the end of the order.
    monkeypatch.setattr(similar.missed, "__defaults__", (similar.LEAST, 4, 3))
    assert kept(spark, texts) == expected


def test_first_members_and_parities_lose_no_similar_pair(monkeypatch):
    random = np.random.default_rng(4)
    monkeypatch.setattr(similar, "_PARITIES", 64)
    for _ in range(300):
        a = np.unique(random.integers(0, 1 << 63, random.integers(1, 120), np.uint64))
        drop = random.integers(0, len(a) // 5 + 1)
        b = np.unique(np.concatenate([random.permutation(a)[drop:], random.integers(0, 1 << 63, random.integers(0, 12), np.uint64)]))
        late = np.unique((random.permutation(a)[: len(a) // 2] >> np.uint64(32)).astype(np.uint32).view(np.int32))
        odd = np.array([similar.parities(a), similar.parities(b)], object)
        assert similar.differing(odd, np.array([0]), np.array([1]))[0] <= len(np.setxor1d(a, b))
        for least in (0.5, 0.8, 1.0):
            if len(a) and len(b) and similar.jaccard(a, b) >= least:
                for order in (None, late):
                    firsts = [similar.first_members(x, least, order) for x in (a, b)]
                    assert len(np.intersect1d(*firsts))


def test_a_block_of_two_chunks_is_compared_in_little_memory():
    """2,048 sets that are nearly all alike: whole matrices of all pairs took 216 MB."""
    import tracemalloc

    random = np.random.default_rng(3)
    n = 2 * similar.BLOCK
    bits = random.integers(0, 2, 512).astype(bool)
    odd = [np.packbits(bits ^ (random.random(512) < 0.01 * (i % 9))).tobytes() for i in range(n)]
    rows = {
        "node": random.permutation(n).astype(np.int64),
        "root": np.arange(n) // 2,
        "size": random.integers(95, 120, n),
        "odd": np.array(odd, object),
        "b0": random.integers(0, 4, n),
        "b1": random.integers(0, 4, n),
        "_c": np.arange(n) % 2,
        "_i": np.zeros(n, np.int64),
        "_j": np.ones(n, np.int64),
    }
    for compare, most in ((similar.open_in_block, 80), (similar.cheapest_edges, 30)):
        tracemalloc.start()
        found = compare(rows)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert len(found["a"])
        assert peak < most, (compare.__name__, peak)
    # Strips give what all pairs at once give.
    a, b = np.triu_indices(n, 1)
    size, node = rows["size"], rows["node"]
    most = size[a] + size[b] - 2 * np.ceil(0.8 / 1.8 * (size[a] + size[b]) - 1e-9).astype(np.int64)
    near = (rows["root"][a] != rows["root"][b]) & (rows["_c"][a] != rows["_c"][b])
    near &= np.minimum(size[a], size[b]) >= 0.8 * np.maximum(size[a], size[b]) - 1e-9
    a, b, most = a[near], b[near], most[near]
    keep = similar.differing(rows["odd"], a, b) <= most
    pairs = np.sort(np.column_stack([node[a[keep]], node[b[keep]]]), axis=1)
    got = similar.open_in_block(rows)
    assert sorted(map(tuple, pairs.tolist())) == sorted(zip(got["a"].tolist(), got["b"].tolist(), strict=True))


@pytest.mark.parametrize("operator", ["near", "contaminated"])
def test_work_tables_go_when_they_are_done(spark, tmp_path, monkeypatch, operator):
    """A stage leaves the one small table that its result is read from."""
    import corpus_pipeline

    kept_in = tmp_path / "kept"
    monkeypatch.setattr(common, "shared_dir", lambda session: str(kept_in))
    texts = made(seed=13)[:40]
    spark.createDataFrame([("i", texts[0])], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if operator == "near":
        found, left = simhash.first_of_each(docs), ["stay"]
    else:
        found, left = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)), ["contaminated"]
    assert [path.name.rpartition("-")[0] for path in kept_in.iterdir()] == left
    assert 0 < found.count() < 40


@pytest.mark.parametrize("least, most", [(0.5, 5), (0.8, 5), (0.8, 99), (1.0, 9)])
def test_pairs_by_shared_keys_lose_no_similar_pair(spark, least, most):
    """Also where some keys are common to too many sets and do not count."""
    random = np.random.default_rng(7)
    base = [np.unique(random.integers(0, 1 << 63, n, np.uint64)) for n in (8, 30, 90, 200)]
    sets = []
    for a in base:
        for share in (0, 0.02, 0.05, 0.08, 0.1, 0.3, 0.8):
            kept = random.permutation(a)[int(share * len(a)) :]
            sets.append(np.unique(np.concatenate([kept, random.integers(0, 1 << 63, int(share * len(a)), np.uint64)])))
    firsts = [set(similar.first_members(s, least).tolist()) for s in sets]
    held = {k: sum(k in f for f in firsts) for f in firsts for k in f}
    few = [{k for k in f if held[k] <= most} for f in firsts]
    rows = [(k, i, i, len(sets[i]), len(f)) for i, f in enumerate(few) for k in f]
    frame = spark.createDataFrame(rows, "key int, node long, root long, size long, n_keys int")
    found = {(r.a, r.b) for r in similar.common_pairs(frame, least).collect()}
    sharing = {(i, j) for j in range(len(sets)) for i in range(j) if few[i] & few[j]}
    alike = {(i, j) for i, j in sharing if similar.jaccard(sets[i], sets[j]) >= least}
    assert alike <= found <= sharing
    assert alike and (most < 99 or len(found) < len(sharing))
    prints = spark.createDataFrame(
        [(i, len(s), bytearray(similar.parities(s))) for i, s in enumerate(sets)], "node long, size long, odd binary"
    )
    pairs = spark.createDataFrame(sorted(sharing), "a long, b long")
    assert alike <= {(r.a, r.b) for r in similar.by_parities(pairs, prints, least).collect()}


def test_sets_made_again_need_one_python_worker_a_task(spark, monkeypatch):
    """Each stored step runs Python once in a task; what ``moved`` gives is that of all texts by the other order."""
    texts = [*made(), None, ""]
    rows = [((i, i), i, text) for i, text in enumerate(texts)]
    schema = "key struct<id:long,same:long>, id long, text string"
    table = common.stored(spark.createDataFrame(rows, schema), "texts")
    prints = common.stored(similar.with_sketches(table, "text"), "prints")
    nodes = prints.groupBy("node").agg(F.min("key").alias("key"))
    sets = [similar.shingles((text or "").encode()) for text in texts]
    late = np.unique(np.concatenate([similar.first_members(hashes)[:1] for hashes in sets[::2]]))
    seen = []

    def watched(frame, name, lasts=False):
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        seen.append(sum(plan.count(f"{kind} ") for kind in ("ArrowEvalPython", "MapInPandas", "MapInArrow")))
        return common.stored(frame, name, lasts)

    monkeypatch.setattr(similar, "stored", watched)
    found = similar.moved(prints, nodes, table.select("key", "text"), late, similar.LEAST).distinct().collect()
    assert seen and max(seen) <= 1
    expected = {
        (int(np.uint64(similar.name_of(hashes)).view(np.int64)), len(hashes), tuple(similar.first_members(hashes, late=late)))
        for hashes in sets
    }
    assert {(r.node, r.size, tuple(r.firsts)) for r in found} == expected


def test_many_late_keys_are_looked_up_for_all_lists_at_once():
    """A million keys were searched anew for each list: 2,000 lists took over a minute."""
    import time

    import pandas as pd

    random = np.random.default_rng(9)
    late = np.unique(random.integers(-(1 << 31), 1 << 31, similar.MOST_KEYS).astype(np.int32))
    lists = [random.integers(-(1 << 31), 1 << 31, random.integers(0, 60)).astype(np.int32) for _ in range(2000)]
    lists[::3] = [np.append(keys, random.choice(late)).astype(np.int32) for keys in lists[::3]]
    began = time.process_time()
    found = similar.has_some(pd.Series(lists), late)
    assert time.process_time() - began < 5
    held = set(late.tolist())
    assert found.tolist() == [not held.isdisjoint(keys.tolist()) for keys in lists]
    assert similar.has_some(pd.Series([], dtype=object), late).tolist() == []


def test_shingles_hash_each_word_once(monkeypatch):
    calls = []
    plain = similar.xxhash.xxh64_intdigest
    monkeypatch.setattr(similar.xxhash, "xxh64_intdigest", lambda *given: calls.append(given) or plain(*given))
    words = [f"w{i % 90}" for i in range(700)]
    found = similar.shingles(" ".join(words).upper().encode())
    assert len(calls) == len(words)
    assert len(found) == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)}) == 90
    assert (found[1:] > found[:-1]).all()
    sets = [similar.shingles(text) for text in (b"a b c d e", b"b a c d e", b"a b c d", b"e d c b a", b"a", b"a a", b"a b c d e f")]
    assert [len(each) for each in sets] == [1, 1, 1, 1, 1, 1, 2] and len(set(np.concatenate(sets).tolist())) == 7
    assert sets[0][0] in sets[6]


def test_equal_texts_are_one_set_for_the_exact_step(spark, monkeypatch):
    given = []
    plain = similar.missed
    monkeypatch.setattr(similar, "missed", lambda prints, *rest: given.append(prints.select("node").collect()) or plain(prints, *rest))
    texts = made(seed=14)[:30]
    assert kept(spark, [text for text in texts for _ in range(5)]) == [5 * at for at in kept(spark, texts)]
    assert [len(nodes) == len(set(nodes)) == len(set(texts)) for nodes in given] == [True, True]


def test_frequent_keys_are_those_of_too_many_sets(spark, monkeypatch):
    lists = [[1, -7, i] for i in range(2, 9)] + [[-7, 30], [40, 41, 42], []]
    firsts = spark.createDataFrame([(i, keys) for i, keys in enumerate(lists)], "node long, firsts array<int>")
    assert similar.frequent_keys(firsts, 6).tolist() == [-7, 1]
    assert similar.frequent_keys(firsts, 7).tolist() == [-7]
    assert similar.frequent_keys(firsts, 8).tolist() == []
    monkeypatch.setattr(similar, "MOST_KEYS", 1)
    assert similar.frequent_keys(firsts, 6).tolist() == [-7]
