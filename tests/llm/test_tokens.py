import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellwatch.llm import bpe, packing, token_counts

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def strange():
    rnd = random.Random(4)
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    parts = ["a", " ", "\n", "12", "'s", "don't", "É", "İ", "Σ", "  ", "\t", "<|endoftext|>", "<|ENDOFTEXT|>",
             "<|startoftext|>", "\x85", "\x1c", "\xa0", "aaaa", "!?", " the", "word"]
    out = ["", " ", "a" * 3000, " " * 50, "x \n y", "\n\n a", "a ́ b"]
    for _ in range(1500):
        out.append("".join(rnd.choice([*parts, chr(rnd.choice(points)), chr(rnd.choice(points[:0x3000]))])
                           for _ in range(rnd.randrange(30))))
    return out


def test_byte_level_equals_library(strange):
    content = open(BYTE, "rb").read()
    want = [e.ids for e in Tokenizer.from_file(BYTE).encode_batch(strange, add_special_tokens=False)]
    assert [np.frombuffer(bpe.encode_text(t, content), np.int32).tolist() for t in strange] == want
    assert token_counts.count_texts(strange, content) == [len(w) for w in want]


def test_word_level_equals_library(strange):
    want = [e.ids for e in Tokenizer.from_file(WORD).encode_batch(strange, add_special_tokens=False)]
    got = packing.encode_texts(strange, open(WORD, encoding="utf-8").read())
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def test_rank_synchronous_merging_of_equal_symbols():
    content = open(BYTE, "rb").read()
    vocab = token_counts.parse(content)
    runs = [b"a" * n for n in range(1, 40)] + [b"-" * n for n in range(1, 40)]
    assert token_counts.merge_counts(runs, vocab).tolist() == [len(bpe.merge(r, vocab)) for r in runs]


def test_counts_of_odd_rows(odd, none, odd_rows):
    rows = token_counts.token_counts(odd, BYTE).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(Tokenizer.from_file(BYTE).encode(
        r[1] or "", add_special_tokens=False).ids)) for r in odd_rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)
    assert token_counts.token_counts(none, BYTE).count() == 0


def test_round_trip(odd, none, corpus):
    for df in (odd, corpus):
        coded = bpe.encode(df, BYTE)
        texts = sorted((r.text or "") for r in df.select("text").collect())
        assert sorted(r.text for r in bpe.decode(coded, BYTE).collect()) == texts
    assert bpe.decode(bpe.encode(none, BYTE), BYTE).count() == 0


def test_decode_nulls_and_broken_bytes(spark):
    vocab = bpe.parse(open(BYTE, "rb").read())
    half = vocab.strings.index("é".encode()[:1])
    got = bpe.decode(spark.createDataFrame([(1, None), (2, []), (3, [half])], "doc_id long, ids array<int>"), BYTE)
    assert {r.doc_id: r.text for r in got.collect()} == {1: None, 2: "", 3: "�"}


def test_round_trip_digests(corpus):
    tok = Tokenizer.from_file(BYTE)
    from cellwatch.llm.queries import op5_bpe_round_trip
    rows = op5_bpe_round_trip(corpus.sparkSession, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in corpus.collect()}
    for r in rows:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("which", ["odd", "corpus"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    cut = packing.pieces(df, WORD).withColumn("ids_crc32", F.crc32("ids")).cache()
    tok = Tokenizer.from_file(WORD)
    want = []
    for r in df.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want.append((str(r.doc_id), k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in cut.drop("ids").collect()) == sorted(want)
    rows = packing.place(cut.drop("ids"), shard=60).collect()
    assert len(rows) == len(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_encoding_looks_up_its_own_runs_only(monkeypatch):
    """A slice costs what its own runs cost, however many a worker remembers; ids are the library's."""
    import time
    with open(WORD, encoding="utf-8") as f:
        content = f.read()
    values = ["one two, three: 1,5 (x) caf\u00e9! \u00dcber;", "Two Three,,! ### a1. " + "long" * 100 + ", <|end|>", "", ",", "\u4e2d\u6587. z\u0142."]
    want = [np.array(e.ids, "<u4").tobytes() for e in packing._tokenizer(content).encode_batch(values, add_special_tokens=False)]
    monkeypatch.setattr(packing, "_IDS", {})
    assert packing.encode_texts(values, content) == want
    memory = packing._IDS[content]
    memory.update((b"remembered%d" % i, b"") for i in range(900_000))
    start = time.process_time()
    set().difference_update(memory)
    whole = time.process_time() - start
    start = time.process_time()
    for k in range(20):
        packing.encode_texts([f"fresh{k} word, fresh{k}."], content)
    assert time.process_time() - start < 20 * whole / 2
    assert packing.encode_texts(values, content) == want


def test_packing_spreads_repeated_rows(spark):
    cut = spark.range(0, 4000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(700 AS BIGINT) AS length")
    shards = [r["count"] for r in packing.place(cut, shard=400).groupBy(F.expr("sequence_id >> 32")).count().collect()]
    assert sum(shards) == 4000 and len(shards) == 10 and max(shards) < 800


def test_packing_of_nothing(none):
    assert packing.place(packing.pieces(none, WORD).cache()).count() == 0


def test_local_search_raises_squares_and_saves_bins():
    rnd = random.Random(3)
    for low, high, n in ((300, 900, 4000), (1, 2048, 2000), (600, 750, 500)):
        sizes = [rnd.randrange(low, high) for _ in range(n)]
        start = packing.best_fit(sizes, 2048)
        end = packing.local_search([list(b) for b in start], sizes, 2048)
        square = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
        assert sorted(i for b in end for i in b) == list(range(n))
        assert max(sum(sizes[i] for i in b) for b in end) <= 2048
        assert len(end) <= len(start) and square(end) >= square(start)
    # Best fit needs three bins, an exchange makes two: 6+4 / 5+3+2.
    sizes = [6, 5, 4, 3, 2]
    assert len(packing.local_search([[0, 3], [1, 2], [4]], sizes, 10)) == 2
