import math
import os
import random
import re
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellwatch.llm import language_id, lm_scoring, pii, quality_classifier, quality_rules
from tests.llm import brute


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_language_held_out(corpus):
    rows = language_id.identify(corpus).collect()
    truth = {r.doc_id: r.lang for r in corpus.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and {r.doc_id for r in held} == {i for i in truth if crc(i) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_never_sees_held_out_labels(corpus):
    """Other labels on held-out rows change nothing."""
    other = corpus.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    key = lambda df: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_id.identify(df).collect())
    assert key(corpus) == key(other)


def test_language_odd_rows(odd, none):
    rows = language_id.identify(odd).collect()
    assert len(rows) == 13
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (3, 4, 5, 7))
    assert language_id.identify(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    kept = language_id.keep_identified(odd, language_id.train(odd))
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 6, 8, 9}


def test_lm_base_columns_and_gain(corpus):
    rows = lm_scoring.score(corpus).collect()
    tokens = {r.doc_id: brute.words((r.text or "").translate(brute.LOWER)) + [None] for r in corpus.collect()}
    c = Counter()
    for i, t in tokens.items():
        if crc(i) % 5 != 1:
            c.update(t)
    n, v = sum(c.values()), len(c)
    assert len(rows) == len(tokens)
    for r in rows:
        t = tokens[r.doc_id]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(r.doc_id) % 5 == 1, len(t), sum(c[w] > 0 for w in t), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert r.score < 0 and abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one():
    """Over the vocabulary and one unknown word, in every context, after all sweeps."""
    rng = np.random.default_rng(2)
    n_words, n_contexts = 60, 25
    count = rng.poisson(rng.gamma(0.3, 8, (n_contexts, n_words + 1))).astype(np.int64)
    count[:, -1] = 0                                        # the unknown word
    context, word = (x.ravel() for x in np.indices(count.shape))
    count = count.ravel()
    own = np.bincount(word, count, n_words + 1) > 0
    seated = np.minimum(count, 1)
    tables = np.bincount(context, seated).astype(float)
    customers = np.bincount(word, seated, n_words + 1).astype(np.int64)
    root = np.minimum(customers, 1)
    g = {"known": int(own.sum()), "root": int(root.sum()), "customers": int(customers.sum())}
    p = lm_scoring._sample(rng, count, word, context, seated, tables, np.bincount(context, count), own,
                           np.full(n_words + 1, np.nan), root, g)
    assert np.allclose(np.bincount(context, p * (own | (np.arange(n_words + 1) == n_words))[word]), 1, atol=1e-6)
    assert (p > 0).all()


def test_lm_scores_of_one_word_texts(spark):
    train = [(i, f"v{i % 40} v{(i * 7) % 40}") for i in range(2000) if crc(i) % 5 != 1]
    df = spark.createDataFrame(train, "doc_id long, text string")
    vocab = [f"v{i}" for i in range(40)]
    free = [i for i in range(10_000, 20_000) if crc(i) % 5 == 1]
    ask = spark.createDataFrame([(free[k], w) for k, w in enumerate([*vocab, "unknown"])] + [(free[50], "")], "doc_id long, text string")
    scored = {r.doc_id: r.score for r in lm_scoring.score(df.union(ask)).collect()}
    total = sum(10 ** scored[free[k]] for k in range(41))       # P(w | start) P(end | w)
    assert 0 < total < 1 and 10 ** scored[free[50]] < 1


def test_lm_hot_pair_is_dealt_by_text(spark):
    """A pair with half of all tokens: its references are spread, its probability is one and right."""
    from cellwatch.llm.common import texts
    line = "same same same same same same"
    train = [i for i in range(3000) if crc(i) % 5 != 1]
    rows = [(i, f"{line} w{i}" if i % 2 else f"a{i} b{i}") for i in train]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    source = texts(df, F.xxhash64("text").alias("key"), F.lit(True).alias("train"))
    pairs = lm_scoring._hot(source.mapInArrow(lm_scoring._measure, "doc_id long, key long, n long, word long, times long, pair boolean"), True)[0]
    hot = lm_scoring._hot(source.mapInArrow(lm_scoring._measure, "doc_id long, key long, n long, word long, times long, pair boolean"), False)[0]
    blocks = source.mapInArrow(lm_scoring._occurrences(8, hot, pairs), "part int, data binary").collect()
    sizes = Counter()
    for b in blocks:
        sizes[b.part] += len(lm_scoring._unpack(bytes(b.data))["ref"])
    assert len(sizes) == 8 and max(sizes.values()) < 2 * sum(sizes.values()) / 8
    scored = {r.doc_id: r for r in lm_scoring.score(df).collect()}
    odd = [i for i in train if i % 2]
    gap = [scored[i].score - scored[i].base_score for i in odd]
    assert all(g > 0 for g in gap) and all(scored[i].n_tokens == 8 for i in odd)
    # In its context "same" follows with 5 of 6 tokens: a text's five repeats cost about 5 log10(5 / 6).
    whole = np.mean([scored[i].score for i in odd])
    assert whole > 5 * math.log10(5 / 6) - 12


def test_lm_packed_numbers_come_back_and_are_small():
    rng = np.random.default_rng(3)
    arrays = {"hashes": np.sort(rng.integers(0, 1 << 64, 100_000, np.uint64)), "any": rng.integers(-1 << 63, (1 << 63) - 1, 1000),
              "small": rng.integers(0, 2000, 50_000).astype(np.uint32), "real": rng.random(100), "short": np.arange(300, dtype=np.uint16),
              "none": np.zeros(0, np.int64), "nothing": np.zeros(0, np.uint16)}
    got = lm_scoring._unpack(lm_scoring._pack(**arrays))
    assert list(got) == list(arrays)
    assert all(got[n].dtype == a.dtype and (got[n] == a).all() and len(got[n]) == len(a) for n, a in arrays.items())
    assert len(lm_scoring._pack(a=arrays["hashes"])) < 7 * 100_000
    assert len(lm_scoring._pack(a=arrays["small"])) < 1.7 * 50_000


def test_lm_blocks_name_a_context_once(spark, corpus):
    from cellwatch.llm.common import texts
    source = texts(corpus, F.xxhash64("text").alias("key"), F.lit(True).alias("train"))
    none = np.zeros(0, np.uint64)
    blocks = [lm_scoring._unpack(bytes(b.data)) for b in source.mapInArrow(
        lm_scoring._occurrences(2, none, none), "part int, data binary").collect()]
    assert all((np.diff(b["contexts"].astype(object)) > 0).all() and len(b["contexts"]) < len(b["context"]) for b in blocks)


def test_lm_exchanged_files_are_removed(spark):
    import time

    def files() -> int:
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return sum("shuffle_" in line for line in found.split("\n"))
    before, name = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    rows = spark.range(1000).repartition(4, "id").groupBy("id").count()
    stored = lm_scoring._stored(rows, "rows")
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before and spark.conf.get(name, None) == setting
    assert stored.count() == 1000


def test_lm_sums_of_many_partitions(corpus, monkeypatch):
    """Partitions that are scored together, and the last ones left over, lose no token of a text."""
    whole = {r.doc_id: r for r in lm_scoring.score(corpus).collect()}
    monkeypatch.setattr(lm_scoring, "partitions_for", lambda *a: 2 * lm_scoring.TOGETHER + 1)
    split = {r.doc_id: r for r in lm_scoring.score(corpus).collect()}
    assert split.keys() == whole.keys()
    for k, r in whole.items():
        assert (split[k].n_tokens, split[k].n_known, split[k].train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
        assert abs(split[k].base_score - r.base_score) < 1e-9 * abs(r.base_score)


def test_lm_contexts_are_words(corpus, monkeypatch):
    raw = np.frombuffer(" ".join(f"w{i}" for i in range(200_000)).encode(), np.uint8)
    token, context, _ = lm_scoring.tokens_of(raw, np.array([0, len(raw)]))
    assert len(np.unique(context)) == len(token) == 200_001
    # Totals summed over many partitions: about the scores of one.
    whole = {r.doc_id: r.score for r in lm_scoring.score(corpus).collect()}
    monkeypatch.setattr(lm_scoring, "PARTITION_BYTES", 100_000)
    split = {r.doc_id: r.score for r in lm_scoring.score(corpus).collect()}
    assert whole.keys() == split.keys()
    assert abs(sum(split.values()) / sum(whole.values()) - 1) < 0.02


def test_lm_odd_rows(odd, none):
    rows = lm_scoring.score(odd).collect()
    assert len(rows) == 13
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4, 5))
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert lm_scoring.score(none).count() == 0
    untrained = lm_scoring.score(odd.where("doc_id IS NULL")).collect()
    assert [r.train_tokens for r in untrained] == [0, 0] and all(math.isfinite(r.score) for r in untrained)


def _exact_tables(c, mass, d, most):
    """Exact mean number of tables of one dish with c customers, by the recursion of log Stirling numbers."""
    s = np.full(most + 1, -np.inf)
    s[1] = 0.0
    t = np.arange(most + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for n in range(1, c):
            stay = np.where(n - d * t > 0, np.log(np.maximum(n - d * t, 1e-300)) + s, -np.inf)
            s = np.logaddexp(stay, np.append(-np.inf, s[:-1]))
        w = s + t * np.log(mass)
    w = np.exp(w - w[1:].max())
    return (w[1:] * t[1:]).sum() / w[1:].sum()


@pytest.mark.parametrize("c,mass,d", [(2, 20.0, 0.75), (12, 0.8, 0.75), (12, 200.0, 0.5), (90, 3.0, 0.75), (2000, 0.8, 0.75), (2000, 20.0, 0.75),
                                      (2000, 200.0, 0.75), (20_000, 5.0, 0.5), (100_000, 20.0, 0.75), (100_000, 300.0, 0.75)])
def test_gibbs_matches_exact_table_posterior(c, mass, d):
    """Mean number of tables against the exact posterior, within 3 % (and the sampling error)."""
    exact = _exact_tables(c, mass, d, min(c, 4000))
    n = 20_000 if c < 100 else 2000
    seating = lm_scoring.Seating(np.full(n, c), np.full(n, 0.01), np.random.default_rng(1), d)
    seating.sweep(lambda dish, change: np.full(len(dish), mass))
    error = seating.tables.std() / n ** 0.5
    assert abs(seating.tables.mean() - exact) < 0.03 * exact + 4 * error
    assert seating.tables.min() >= 1 and seating.tables.max() <= c


def test_gibbs_of_enormous_dishes_scales():
    """Beyond the table of ratios the numbers carry on: with mass kept, the mean hardly moves from 1e6 to 1e9 customers."""
    means = []
    for c in (100_000, 1_000_000, 1_000_000_000):
        seating = lm_scoring.Seating(np.full(500, c), np.full(500, 20.0), np.random.default_rng(1), 0.75)
        means.append(seating.tables.mean())
    limit = 20 / 0.75 + 1     # tables beside the one big one follow Poisson(mass / discount) as c grows
    assert abs(means[1] - limit) < 1.0 and abs(means[2] - limit) < 1.0 and means[0] <= means[1] + 1


def _peak(work):
    """What the work returns, and the most memory that it held at once."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_packing_holds_one_copied_array_at_a_time():
    arrays = {f"a{k}": np.arange(k, k + 500_000, dtype=np.uint32) // 7 for k in range(8)} | {
        "empty": np.zeros(0, np.int64), "steps": np.arange(9) - 4, "real": np.array([0.5, -2.0])}
    size = sum(a.nbytes for a in arrays.values())
    data, peak = _peak(lambda: lm_scoring._pack(**arrays))
    assert peak < size
    got, peak = _peak(lambda: lm_scoring._unpack(data))
    assert peak < 1.7 * size
    assert list(got) == list(arrays) and all(got[k].dtype == a.dtype and (got[k] == a).all() for k, a in arrays.items())


def test_model_of_a_partition_holds_few_bytes_an_occurrence():
    rng = np.random.default_rng(3)
    n, few = 400, np.zeros(0, np.uint64)
    text = pa.array([" ".join(f"w{x}" for x in rng.zipf(1.2, 1500) % 50_000) for _ in range(n)])
    docs = pa.RecordBatch.from_arrays([pa.array(range(n)), text, pa.array(range(n)), pa.array([True] * n)],
                                      ["doc_id", "text", "key", "train"])
    blocks = [d for b in lm_scoring._occurrences(1, few, few)([docs]) for d in b.column("data")]
    table = pa.table({"part": pa.array([0] * len(blocks), pa.int32()), "data": pa.array([d.as_py() for d in blocks], pa.binary())})
    lm_scoring.ratios(lm_scoring.DISCOUNT), lm_scoring.ratios(lm_scoring.ROOT_DISCOUNT)
    model, peak = _peak(lambda: lm_scoring._build(1, few, np.zeros(0), few)((pa.scalar(0, pa.int32()),), table))
    assert model.column("train")[0].as_py() == n * 1501
    assert peak < 80 * n * 1501


def _lm_models(parts, n=400):
    """Blocks of texts by partition, and a function that makes the partitions' models of them."""
    rng = np.random.default_rng(5)
    few = np.zeros(0, np.uint64)
    text = pa.array([" ".join(f"w{x}" for x in rng.zipf(1.2, 1500) % 50_000) for _ in range(n)])
    docs = pa.RecordBatch.from_arrays([pa.array(range(n)), text, pa.array(range(n)), pa.array([True] * n)],
                                      ["doc_id", "text", "key", "train"])
    blocks = sorted(((p, d) for b in lm_scoring._occurrences(parts, few, few)([docs])
                     for p, d in zip(b.column("part").to_pylist(), b.column("data").to_pylist())), key=lambda r: r[0])
    return blocks, lm_scoring._build_sorted(lm_scoring._build(parts, few, np.zeros(0), few))


def test_lm_models_are_cut_into_small_rows(monkeypatch):
    """A model's rows have PIECE bytes at most and come in small batches; its sums stand in the first row alone."""
    monkeypatch.setattr(lm_scoring, "PIECE", 10_000)
    monkeypatch.setattr(lm_scoring, "BATCH_BYTES", 50_000)
    blocks, build = _lm_models(3)
    batches = list(build(iter([pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([d], pa.binary())], ["part", "data"])
                               for p, d in blocks])))
    assert max(b.num_rows for b in batches) == 5 and max(len(d) for b in batches for d in b.column("data").to_pylist()) == 10_000
    rows = pa.Table.from_batches(batches).to_pylist()
    assert sum(r["train"] or 0 for r in rows) == 400 * 1501
    for part in range(3):
        own = [r for r in rows if r["part"] == part]
        assert len(own) > 5 and [r["piece"] for r in own] == list(range(len(own)))
        assert [r["totals"] is None for r in own] == [False] + [True] * (len(own) - 1)
        model = lm_scoring._unpack(b"".join(r["data"] for r in own))
        assert model["count"].sum() == own[0]["train"] and len(model["context"]) == len(model["count"])


def test_lm_scoring_holds_one_packed_partition_at_a_time():
    """Of the partitions that a task scores together, the packed rows of one are held, not of all."""
    parts = 2 * lm_scoring.TOGETHER
    blocks, build = _lm_models(parts)
    models = pa.Table.from_batches(build(iter([pa.RecordBatch.from_arrays(
        [pa.array([p], pa.int32()), pa.array([d], pa.binary())], ["part", "data"]) for p, d in blocks])))
    dealt = pa.Table.from_batches(lm_scoring._deal_totals(1)(models.filter(models.column("totals").is_valid()).select(["part", "totals"]).to_batches()))
    totals = lm_scoring._add_totals(None, dealt)
    sums = {k: sum(x or 0 for x in models.column(k).to_pylist()) for k in ("known", "train", "customers", "root")}
    rows = sorted([*zip(*(models.column(k).to_pylist() for k in ("part", "piece", "data"))),
                   *((p, lm_scoring._TOTALS, d) for p, d in zip(totals.column("part").to_pylist(), totals.column("data").to_pylist()))])
    empty, none = np.zeros(0, np.uint64), np.zeros(0)
    shared = type("Shared", (), {"value": sums | {
        "hot": empty, "hot_count": np.zeros(0, np.int64), "buckets": 3, "pair_context": empty, "pair_tables": np.zeros(0, np.int64),
        "pairs": empty, "pair_log_p": none, "hot_p0": none}})
    whole, before, most, read = sum(len(d) for *_, d in rows), pa.total_allocated_bytes(), 0, 0

    def batches():
        nonlocal most, read
        for p, piece, d in rows:
            read += 1
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([piece], pa.int32()), pa.array([d], pa.binary())],
                                             ["part", "piece", "data"])
            most = max(most, pa.total_allocated_bytes() - before)
    got = []
    for batch in lm_scoring._score(shared)(batches()):
        assert got or read < len(rows)      # the first partitions' sums are given before the others are read
        got.append(batch)
    assert most < whole / 4
    found = [lm_scoring._unpack(d) for b in got for d in b.column("data").to_pylist()]
    assert sum(x["n"].sum() for x in found) == sum(x["known"].sum() for x in found) == 400 * 1501
    assert len(found) == 2 * 3 and all(len(np.unique(x["key"])) == len(x["key"]) for x in found)


def test_lm_tasks_get_no_more_partitions_than_meant(corpus, monkeypatch):
    """A task makes one partition's model, and scores TOGETHER of them, whatever a hash of their numbers would do."""
    monkeypatch.setattr(lm_scoring, "partitions_for", lambda *a: 3 * lm_scoring.TOGETHER)

    def limited(make, most):
        def made(*args):
            run = make(*args)

            def task(batches):
                parts = set()

                def noted():
                    for batch in batches:
                        parts.update(batch.column(0).to_pylist())
                        assert len(parts) <= most
                        yield batch
                yield from run(noted())
            return task
        return made
    monkeypatch.setattr(lm_scoring, "_build_sorted", limited(lm_scoring._build_sorted, 1))
    monkeypatch.setattr(lm_scoring, "_score", limited(lm_scoring._score, lm_scoring.TOGETHER))
    assert lm_scoring.score(corpus).count() == corpus.count()


def test_lm_tables_of_packed_bytes_have_small_row_groups(spark):
    import pyarrow.parquet as pq
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(n, None) for n in names]
    rows = spark.range(0, 150, 1, 1).select("id", F.expr("unhex(repeat(sha2(cast(id AS string), 512), 3000))").alias("data"))
    stored = lm_scoring._stored(rows, "packed", lm_scoring._PACKED)
    assert [spark.conf.get(n, None) for n in names] == before
    groups = [meta.row_group(k) for f in stored.inputFiles() for meta in (pq.read_metadata(f.removeprefix("file://").removeprefix("file:")),)
              for k in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 150 and max(g.total_byte_size for g in groups) < 10 << 20
    assert stored.select(F.sum(F.length("data"))).first()[0] == 150 * 64 * 3000


def test_rules(corpus, labels, odd):
    good = corpus.join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    for df, target in ((corpus, good), (odd, good)):
        rows = quality_rules.quality_rules(df, target).collect()
        want = Counter((r.doc_id, *brute.rules(r.text)) for r in df.collect())
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD)


def test_rules_ratio_against_counts(spark):
    """The ratio of one text against both multinomials, with hashed tokens told apart by Spark's own hash."""
    docs = spark.createDataFrame([(1, "a a b"), (2, "c b"), (3, None)], "doc_id long, text string")
    target = docs.where("doc_id = 1")
    buckets = 1 << 12
    grams = {1: [("a",), ("a",), ("b",), ("a", "a"), ("a", "b")], 2: [("c",), ("b",), ("c", "b")]}
    hashed = lambda g: spark.range(1).select(F.pmod(
        F.xxhash64(*(F.xxhash64(F.lit(x)) for x in g)) if len(g) > 1 else F.xxhash64(F.lit(g[0])), F.lit(buckets))).first()[0]
    at = {g: hashed(g) for gs in grams.values() for g in gs}
    t, r = Counter(at[g] for g in grams[1]), Counter(at[g] for gs in grams.values() for g in gs)
    llr = lambda g: math.log((t[at[g]] + 1) / (5 + buckets)) - math.log((r[at[g]] + 1) / (8 + buckets))
    rows = {x.doc_id: x.llr for x in quality_rules.quality_rules(docs, target, buckets).collect()}
    for i in (1, 2):
        assert abs(rows[i] - sum(map(llr, grams[i])) / len(grams[i])) < 1e-12
    assert rows[3] == 0


def test_rules_of_short_and_repeating_texts(spark, none):
    """Texts of 0 to 40 of three words: windows that overlap, touch or lie at an end, and too few words for one."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["a", "B", "\u00e9"], i % 41))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in quality_rules.quality_rules(df, none).collect()}
    assert got == {(i, *brute.rules(t)) for i, t in rows}


def test_rules_count_grams_in_compiled_expressions(corpus):
    """No lambda function, which Spark interprets, and no filter by an unfolded array's size, which makes the tokens twice."""
    plan = quality_rules.gram_counts(corpus)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("regexp_extract_all") == 1
    assert not [line for line in plan.splitlines() if "Filter" in line and "size(" in line]


def test_rules_without_target_or_rows(none, corpus):
    assert quality_rules.quality_rules(none, none).count() == 0
    rows = quality_rules.quality_rules(corpus, none).collect()
    assert {r.llr for r in rows} == {0.0}


def test_rules_plan_is_native(corpus):
    df = quality_rules.quality_rules(corpus, corpus)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_pii_base(corpus, odd):
    for df in (corpus, odd):
        want = Counter((r.doc_id, tuple((brute.PII[k][0], a, b) for a, k, b in brute.pii(r.text))) for r in df.collect())
        got = pii.find(df).collect()
        assert Counter((r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.base)) for r in got) == want
        for r in got:
            assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}


def test_pii_finds_unseen_forms_in_learned_contexts(spark, none):
    rows = [(i, f"some filler {i} and Call me at +1 (555) 010-{1000 + i} today ok") for i in range(30)]
    rows += [(100 + i, f"other text, Call me at 555 010 77{10 + i} today fine") for i in range(5)]
    rows += [(200, "we counted 555 010 7799 apples at the farm"), (201, None), (202, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans] for r in pii.find(df).collect()}
    assert all(got[100 + i] == [("phone", 23, 35)] for i in range(5))
    assert got[200] == got[201] == got[202] == []
    clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert clean[100] == "other text, Call me at <phone> today fine" and clean[201] is None
    assert pii.find(none).count() == 0 and pii.redact(none).count() == 0


def _found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    return {r.doc_id: [(s.kind, text[r.doc_id][s.start:s.stop]) for s in r.spans] for r in pii.find(df).collect()}


def test_pii_candidates_of_other_shapes(spark):
    rows = [(i, f"filler {i} and Call me at +1 (555) 010-{1000 + i} today ok") for i in range(30)]
    rows += [(100 + i, f"row {i} we bill card 4111 1111 1111 {1111 + k} monthly yes") for i, k in enumerate(
        k for k in range(200) if pii._luhn(f"411111111111{1111 + k}"))]
    rows += [(200 + i, f"line {i} please write to user{i}@example.org soon thanks") for i in range(30)]
    want = {
        300: ("phone", "x Call me at", ["555.123.4567"], "today"),
        301: ("phone", "x Call me at", ["555-010-7711", "555-010-7712"], "today"),
        302: ("phone", "x Call me at", ["555-010-7711"], "2024-01-05 today"),
        303: ("card", "x bill card", ["4111.1111.1111.1112"], "monthly"),
        304: ("card", "x bill card", ["4111/1111/1111/1112"], "monthly"),
        305: ("email", "x please write to", ["bob AT example DOT org"], "soon"),
        306: ("email", "x please write to", ["bob{at}example.org"], "soon"),
        307: ("phone", "x Call me at", ["555 010 7711", "555 010 7712"], "today")}
    rows += [(k, " ".join([a, *v, z])) for k, (_, a, v, z) in want.items()]
    rows += [(400, "we counted 555.123.4567 apples, 4111.1111.1111.1112 pears, see bob AT example DOT org")]
    got = _found(spark, rows)
    for k, (kind, _, values, _) in want.items():
        assert got[k] == [(kind, v) for v in values], k
    assert got[400] == []


def test_pii_contexts_at_signs_and_starts(spark):
    rows = [(i, f"note {i} from Bob <user{i}@example.org> here") for i in range(10)]
    rows += [(50 + i, f"see href=mailto:user{i}@example.com , {i}") for i in range(10)]
    rows += [(100 + i, f"user{i}@example.net wrote this {i}") for i in range(10)]
    rows += [(150 + i, f"item {i} tel:+1 555 010 {1000 + i} open") for i in range(10)]
    rows += [(200, "and Ann <ann(at)example.org> there"), (201, "x mailto:ann(at)example.com y"),
             (202, "ann (at) example.net wrote that"), (203, "y tel:555 010 7711 z")]
    got = _found(spark, rows)
    assert got[200] == [("email", "ann(at)example.org")]
    assert got[201] == [("email", "ann(at)example.com")]
    assert got[202] == [("email", "ann (at) example.net")]
    assert got[203] == [("phone", "555 010 7711")]


def test_redaction_keeps_rows_and_columns(odd):
    got = pii.redact(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    row = got.where("doc_id = 8").first()
    assert row.text == "<phone> mail me at <email>" and row.n_chars == len(row.text)


def test_classifier(corpus, labels, odd, none):
    rows = {r.doc_id: r for r in quality_classifier.co_train(corpus, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in rows}
    bad = [i for i, q in truth.items() if q == 0]
    fine = [i for i, q in truth.items() if q == 1]
    assert len(rows) == corpus.count()
    assert np.mean([rows[i].quality_score for i in bad]) + 0.3 < np.mean([rows[i].quality_score for i in fine])
    assert quality_classifier.co_train(none, labels).count() == 0
    blind = quality_classifier.co_train(odd, labels.where("false")).collect()
    assert len(blind) == 13 and all(abs(r.quality_score - 0.5) < 1e-9 for r in blind)
    twice = labels.union(labels)
    assert quality_classifier.co_train(odd, twice).count() == 13


def test_pii_recall_of_unseen_forms(spark):
    """Identifiers written in ways that the fixed patterns don't know, in contexts learned from others."""
    rnd = random.Random(12)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + digits(14)
        return next(body + c for c in "0123456789" if pii._luhn(body + c))

    name = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(7))
    known = {"email": lambda: f"{name()}@{name()}.org", "ip": lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)),
             "card": card, "phone": lambda: f"+1 555 {digits(3)} {digits(4)}"}
    unseen = {"email": [lambda: f"{name()} (at) {name()} (dot) org", lambda: f"{name()}[at]{name()}.net", lambda: f"{name()} at {name()} dot com"],
              "ip": [lambda: "-".join(str(rnd.randrange(10, 256)) for _ in range(4)), lambda: "[.]".join(str(rnd.randrange(256)) for _ in range(4))],
              "card": [lambda: ".".join(re.findall("....", card())), lambda: "/".join(re.findall("....", card()))],
              "phone": [lambda: f"555.{digits(3)}.{digits(4)}", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"555-{digits(3)}-{digits(4)}"]}
    frames = {"email": ["please write to {} for details", "our address: {} ; thanks"], "ip": ["logged in from host {} yesterday", "the server <{}> went down"],
              "card": ["charged to card {} in full", "visa number: {} , valid"], "phone": ["call me on {} tonight", "tel:{} any time"]}
    filler = lambda: " ".join(name() for _ in range(rnd.randrange(5, 40)))
    rows, planted = [], {}
    for kind, makers in unseen.items():
        for k in range(60):
            rows.append((len(rows), f"{filler()} {frames[kind][k % 2].format(known[kind]())} {filler()}"))
        for k in range(60):
            value = rnd.choice(makers)()
            text = f"{filler()} {frames[kind][k % 2].format(value)} {filler()}"
            planted[len(rows)] = (text.index(value), text.index(value) + len(value))
            rows.append((len(rows), text))
    clean = {len(rows) + k: f"{filler()} in 2024 we sold 1200 to 1500 items, {digits(5)} in all {filler()}" for k in range(150)}
    rows += list(clean.items())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in pii.find(df).collect()}
    caught = sum(any(a <= want[0] + 1 and b >= want[1] - 1 for a, b in got[i]) for i, want in planted.items())
    assert caught / len(planted) >= 0.9
    assert not any(got[i] for i in clean)
    safe = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert all(safe[i] == t for i, t in clean.items())


def test_pii_memory_is_linear_in_numbers():
    """A text of 1 MB of single digits: all its runs are looked at, in blocks, when every context is learned."""
    code = """
import resource, sys
import numpy as np, pyarrow as pa
from cellwatch.llm import pii
text = " ".join(str(i % 10) for i in range(500_000))
batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([b"k"])], ["doc_id", "text", "key"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
pii._scan_seeds(batch)
pii._scan_candidates(batch, np.zeros(1024, bool))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, env={**os.environ, "PYTHONPATH": root})
    assert int(done.stdout) < 500, done.stderr


def test_pii_filter_follows_the_patterns(spark):
    few, many = (spark.range(n).select(F.xxhash64("id").alias("pattern")) for n in (10, 5000))
    assert len(pii._pattern_filter(few)) == 1024 and len(pii._pattern_filter(many)) == 131072
    assert 4500 < pii._pattern_filter(many).sum() <= 5000
