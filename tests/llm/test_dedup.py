import random

import pytest
from pyspark.sql import functions as F

from cellwatch.llm import components as C
from cellwatch.llm import exact_dedup, ngram_join
from tests.llm import brute
from tests.llm.conftest import PLAIN, SCHEMA


def test_exact_odd_rows(odd):
    rows = exact_dedup.deduplicate(odd).collect()
    assert len(rows) == 13
    by = {}
    for r in rows:
        by.setdefault(r.text_sha256, []).append(r)
    assert all(sum(r.kept for r in g) == 1 and g[0].group_size == len(g) for g in by.values())
    assert [r.kept for r in rows if r.doc_id == 1].count(True) == 1            # of a repeated row one stays
    empty = [r for r in rows if r.doc_id in (3, 4)] + [r for r in rows if r.doc_id is None and r.keep_id == 3]
    assert {r.text_sha256 for r in empty} == {empty[0].text_sha256} and len(empty) == 3
    assert {r.keep_id for r in rows if r.doc_id is None} == {None, 3}


def test_exact_index_keeps_earlier_batches(spark, scratch):
    first = spark.createDataFrame([(5, "a  b"), (6, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a\nb"), (2, "d"), (3, "d")], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, scratch + "/index", 4)
    exact_dedup.deduplicate(first, index).collect()
    for _ in range(2):     # a retried batch changes nothing
        got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(
            second, exact_dedup.DigestIndex(spark, scratch + "/index", 4)).collect()}
        assert got[1] == (5, False) and got[3] == (2, False)
        assert index.read().count() == 3
    spark.sql(f"DESCRIBE EXTENDED {index.table}").where("col_name = 'Sort Columns'").collect()


def test_empty_tables(none):
    assert exact_dedup.deduplicate(none).count() == 0
    assert ngram_join.near_duplicates(none).count() == 0
    assert ngram_join.keep_one(none).count() == 0


def test_keeping_forms_keep_all_columns(odd):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "5", "6", "7", "8", "9", "9", "None"]
    near = ngram_join.keep_one(odd)
    assert near.columns == odd.columns
    # 1, 2 and the null id are one group; rows without a word stay.
    assert sorted(str(r.doc_id) for r in near.collect()) == ["1", "3", "4", "5", "6", "7", "8", "9", "9", "None"]


def test_near_odd_rows(odd):
    rows = ngram_join.near_duplicates(odd).collect()
    got = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert len(rows) == 13
    n = len(brute.shingles(PLAIN))
    assert got[(1, n)] == 1 and got[(2, n)] == 1 and got[(None, n + 1)] == 1
    assert got[(3, 0)] == 3 and got[(4, 0)] == 4 and got[(None, 0)] is None


def _planted(seed=5):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    shared = " ".join(rnd.choices(vocab, k=60))
    texts = []
    for g in range(60):
        base = rnd.choices(vocab, k=rnd.choice([6, 9, 30, 120, 400]))
        for _ in range(rnd.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(base) // 25))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            texts.append(" ".join(copy) + (" " + shared if g % 3 == 0 else ""))
    hot = rnd.choices(vocab, k=80)
    for _ in range(150):                                       # a large group of near copies
        copy = list(hot)
        for _ in range(rnd.randrange(0, 4)):
            copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
        texts.append(" ".join(copy))
    texts += ["a b", "A  b", "a b c", "same same same same same same", "same same same same same", "x"] * 2
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [1000, 20])
def test_near_brute_force(spark, monkeypatch, block):
    rows = _planted()
    monkeypatch.setattr(ngram_join, "BLOCK", block)            # 20: the way for large clusters
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute.components(rows)


def _passages(docs, seed=3):
    """Documents of 5 of 9 shared passages and some words of their own: nearly all share a signature, few are alike."""
    rnd = random.Random(seed)
    passages = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(9)]
    return [(d, " ".join(rnd.sample(passages, 5) + [f"o{rnd.getrandbits(40)}" for _ in range(rnd.randrange(10, 40))]))
            for d in range(docs)]


def test_common_passages_fall_apart(spark, monkeypatch):
    rows = _passages(500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = ngram_join.written(ngram_join.candidate_sets(df, 4), "sets")
    whole = ngram_join.clusters(sets).agg(F.max("members")).first()[0]
    monkeypatch.setattr(ngram_join, "BLOCK", 50)
    monkeypatch.setattr(ngram_join, "SKETCHES", 100)           # signatures in parts, compared two by two
    fine = ngram_join.clusters(sets)
    assert fine.count() == fine.select("id").distinct().count()
    assert whole > 400 and fine.agg(F.max("members")).first()[0] < 50
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()}
    assert got == brute.components(rows)


def test_sketches_never_part_what_is_alike():
    """Pairs of enough similarity are always connected, short and long sets alike."""
    import numpy as np
    rnd = np.random.default_rng(4)
    alike = apart = 0
    for n in [2, 3, 7, 30, 200, 3000] * 12:
        a = rnd.integers(0, 1 << 63, n, np.uint64)
        b = np.concatenate([a[:n - int(rnd.integers(0, n // 4 + 1))], rnd.integers(0, 1 << 63, int(rnd.integers(0, n // 6 + 2)), np.uint64)])
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        linked = 100 * common >= 75 * (len(a) + len(b) - common)
        kept = [s[np.isin(s, t) | (rnd.random(len(s)) < 0.5)] for s, t in ((a, b), (b, a))]     # the others are lone
        sizes = np.array([len(a), len(b)])
        got = ngram_join.sketch_forest(
            sizes, sizes - [len(k) for k in kept],
            ngram_join.sketches(np.repeat([0, 1], [len(k) for k in kept]), np.concatenate(kept), 2))
        assert not linked or got == [(0, 1)]
        alike, apart = alike + linked, apart + (not got)
    assert alike > 20 and apart > 10
    assert ngram_join.sketch_forest(np.zeros(0, int), np.zeros(0, int), np.zeros((0, 16), np.uint64)) == []


def test_signatures_meet():
    """Any two sets of enough similarity share a signature, whatever the classes of their tokens."""
    import numpy as np
    rnd = random.Random(2)
    for _ in range(1500):
        n = rnd.randrange(2, 90)
        a = {rnd.getrandbits(63) for _ in range(n)}
        b = set(a)
        for t in rnd.sample(sorted(a), rnd.randrange(0, n // 4 + 1)):
            b.discard(t)
            if rnd.random() < 0.5:
                b.add(rnd.getrandbits(63))
        if a == b or not b or 100 * len(a & b) < 75 * len(a | b):
            continue
        hot = rnd.random()
        cls = {t: 9 if rnd.random() < hot else rnd.randrange(2, 9) for t in a | b}
        alone = {t for t in a ^ b if rnd.random() < 0.8}
        sigs = []
        for s in (a, b):
            t = np.array(sorted(s - alone), np.uint64)
            sigs.append(set(ngram_join.signatures(len(s), np.array([cls[int(x)] for x in t]), t).tolist()))
        assert sigs[0] & sigs[1]


@pytest.mark.parametrize("local", [0, 10_000])
def test_components(spark, local):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(140)] + [(300 + i, 301 + i) for i in range(40)] + [(999, 999)]
    frame = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long")
    got = {r.id: r.root for r in C.components(frame, local).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_exact_rows_have_hot_group_spread(spark):
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("text"))
    got = exact_dedup.deduplicate(df)
    assert got.where("kept").count() == 401 and got.where("group_size = 200").count() == 200
    assert df.schema["text"].dataType.simpleString() in SCHEMA


def test_exact_retried_batch_gives_the_same_answer(spark, scratch):
    """A result that was lost after the append can be made again; other batches see the texts as known."""
    path = scratch + "/index"
    rows = [(1, "a"), (2, "b"), (3, "a "), (4, "b"), (None, "n"), (5, "q")]
    batch = spark.createDataFrame(rows, "doc_id long, text string")
    keys = lambda d: sorted(str(tuple(r)) for r in d.collect())
    first = keys(exact_dedup.deduplicate(batch, exact_dedup.DigestIndex(spark, path)))
    assert sum("True" in r for r in first) == 5
    again = keys(exact_dedup.deduplicate(batch.repartition(3), exact_dedup.DigestIndex(spark, path)))
    assert again == first
    more = spark.createDataFrame([*rows, (6, "new")], "doc_id long, text string")
    third = exact_dedup.deduplicate(more, exact_dedup.DigestIndex(spark, path)).collect()
    assert {r.doc_id for r in third if r.kept} == {6}
    named = [keys(exact_dedup.deduplicate(spark.createDataFrame([(7, "z")], "doc_id long, text string"),
                                          exact_dedup.DigestIndex(spark, path), batch="b")) for _ in range(2)]
    assert named[0] == named[1] and "True" in named[0][0]
    assert exact_dedup.DigestIndex(spark, path).read().count() == 7


def test_exact_index_is_sized_when_made(spark, scratch):
    made = exact_dedup.DigestIndex(spark, scratch + "/sized", rows=100 * exact_dedup.BUCKET_ROWS)
    assert made.buckets == 100 and exact_dedup.DigestIndex(spark, scratch + "/sized", rows=1).buckets == 100
    assert exact_dedup.DigestIndex(spark, scratch + "/small", rows=1).buckets == exact_dedup.LEAST_BUCKETS


def _roots(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    return {x: find(x) for x in root}


def test_star_rounds_at_the_size_of_the_check(spark):
    """The distributed route on tens of thousands of edges: random ones, a hub, a long path."""
    rnd = random.Random(5)
    edges = [(rnd.randrange(30_000), rnd.randrange(30_000)) for _ in range(25_000)]
    edges += [(50_000, 50_000 + rnd.randrange(9_000)) for _ in range(9_000)] + [(70_000 + i, 70_001 + i) for i in range(3_000)] + [(9, 9)]
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.root for r in C.components(df, local=0).collect()} == _roots(edges)
    with pytest.raises(RuntimeError, match="not settled"):
        C.components(df, local=0, steps=2)
