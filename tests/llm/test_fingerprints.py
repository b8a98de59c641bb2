import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwatch.llm import fill_in_middle, winnowing
from tests.llm import brute

LINES = re.compile(r"[^\n]*\n|[^\n]+")


# ---------------------------------------------------------------- winnowing

def plain_winnow(text, k, window, hash_of):
    signs = [(c, i) for i, c in enumerate(text.translate(brute.LOWER)) if c not in " \t\n\v\f\r"]
    if not signs:
        return []
    runs = [(hash_of("".join(c for c, _ in signs[i:i + k])), signs[i][1]) for i in range(max(1, len(signs) - k + 1))]
    out = []
    for i in range(max(1, len(runs) - window + 1)):
        low = min(h for h, _ in runs[i:i + window])
        at = max(j for j in range(i, min(i + window, len(runs))) if runs[j][0] == low)
        if runs[at] not in out:
            out.append(runs[at])
    return out


def hash_of(run):
    """The operator's hash of one run of signs."""
    h, _, _ = winnowing.winnow_signs(np.array([ord(c) for c in run], np.uint64), np.array([len(run)]), len(run), 1)
    return int(h[0])


@pytest.mark.parametrize("k,window", [(3, 4), (5, 1), (4, 7), (16, 32)])
def test_winnow_equals_plain_version(k, window):
    rnd = random.Random(k)
    values = ["", " ", "a", "ab", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "Aé\U0001F600漢 b"]
    values += ["".join(rnd.choice("abA \né\U0001F600") for _ in range(rnd.randrange(120))) for _ in range(60)]
    for value, (hashes, places) in zip(values, winnowing.winnow(values, k, window)):
        assert list(zip(hashes.tolist(), places.tolist())) == plain_winnow(value, k, window, hash_of)


def test_long_texts_by_blocks(monkeypatch):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abc de\n") for _ in range(5000)) + " " * 300 + "x" * 400
    whole = winnowing.winnow([text], 5, 9)[0]
    monkeypatch.setattr(winnowing, "BLOCK", 37)
    for got, want in zip(winnowing.winnow([text], 5, 9)[0], whole):
        assert got.tolist() == want.tolist()
    assert [len(x) for x in winnowing.winnow([" " * 100, "a " * 20 + " " * 50], 25, 9)[0]] == [0, 0]
    assert len(winnowing.winnow(["a " * 20 + " " * 50], 25, 9)[0][0]) == 1


def test_match_guarantee():
    rnd = random.Random(2)
    k, window = 6, 10
    for _ in range(200):
        shared = "".join(rnd.choice("abcdefgh") for _ in range(k + window - 1))
        a, b = ("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(60))) for _ in range(2))
        (h1, p1), (h2, p2) = winnowing.winnow([a + shared + b, b + shared.upper() + a], k, window)
        inside = {int(h) for h, p in zip(h1, p1) if len(a) <= p <= len(a) + window - 1}
        assert inside & {int(h) for h, p in zip(h2, p2) if len(b) <= p <= len(b) + window - 1}


def neighbours(rows, k, window):
    """Brute-force result of distinct (id, text) keys: by id (null first), ties by the given order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        changed = text[:len(text) - q] + after[:q]
        sets = [{h for h, _ in plain_winnow(t, k, window, hash_of)} for t in (text, changed, after)]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *like))
    return out


@pytest.mark.parametrize("least", [1, 3, 50])
def test_neighbours_equal_brute_force(spark, least):
    rnd = random.Random(least)
    rows = [(i * 7 - 90, "".join(rnd.choice("ab é") for _ in range(rnd.randrange(40)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").orderBy("text")
    got = winnowing.neighbour_likeness(df, 3, 4, least=least).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == \
        [pytest.approx(x) for x in neighbours(rows, 3, 4)]
    by = {r.doc_id: list(zip(r.hashes, r.positions)) for r in got}
    assert all(by[i] == plain_winnow(t, 3, 4, hash_of) for i, t in rows)


def test_neighbours_of_odd_rows(spark, odd, none, odd_rows):
    for least in (1, 8, 100):
        got = winnowing.neighbour_likeness(odd, least=least).collect()
        assert sorted(str((r.doc_id, r.n_chars)) for r in got) == sorted(str((r[0], len(r[1] or ""))) for r in odd_rows)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        texts = {(r[0], len(r[1] or "")): r[1] or "" for r in odd_rows}
        same = [r for r in got if r.doc_id == 1]
        assert [r.near_next for r in same].count(1.0) == 2  # its copy follows, then the same words in capitals
        for r in got:
            assert r.hashes == winnowing.winnow([texts[r.doc_id, r.n_chars]])[0][0].tolist()
    assert winnowing.neighbour_likeness(none).count() == 0 and winnowing.fingerprints(none).count() == 0
    alone = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    r = winnowing.neighbour_likeness(alone).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_many_equal_rows_keep_all(spark):
    df = spark.range(0, 900).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "IF(id % 3 = 0, 'same old words here', concat('text number ', id)) AS text")
    got = winnowing.neighbour_likeness(df, least=40).groupBy("doc_id").count().collect()
    assert sum(r["count"] for r in got) == 900 and {r["count"] for r in got if r.doc_id is not None} == {1}


def test_fingerprint_query(spark):
    from cellwatch.llm.queries import op12_document_fingerprints
    rows = op12_document_fingerprints(spark, "/root/testdata/sf0.001").collect()
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())
    text = dict(docs)
    assert len(rows) == len(docs)
    by_text = {}
    for r in rows:
        by_text.setdefault(text[r.doc_id], set()).add(r.fingerprint)
        hashes, places = winnowing.winnow([text[r.doc_id]])[0]
        assert r.fingerprint == ",".join(f"{h:016x}@{p}" for h, p in zip(hashes.tolist(), places.tolist()))
    assert all(len(v) == 1 for v in by_text.values())
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        r = next(r for r in rows if r.doc_id == i)
        q = len(t) // 4
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - q] + after[:q]).encode()).hexdigest()


def test_fingerprints_alone(odd, odd_rows):
    got = winnowing.fingerprints(odd, 4, 5).collect()
    want = [(len(r[1] or ""), *(x.tolist() for x in winnowing.winnow([r[1] or ""], 4, 5)[0])) for r in odd_rows]
    assert sorted((r.n_chars, r.hashes, r.positions) for r in got) == sorted(want)


# ---------------------------------------------------------------- fill in the middle

def plain_cut(doc_id, text, unit="line", seed=7, percent=100, spm=50, markers=fill_in_middle.MARKERS):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = LINES.findall(text) if unit == "line" else list(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = markers
    if not text or any(x in text for x in markers) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(pre), len(mid), s + suf + p + pre + m + mid
    return len(units), "psm", len(pre), len(mid), p + pre + s + suf + m + mid


def rows_equal(df, rows, **how):
    named = {{"spm": "spm_percent"}.get(k, k): v for k, v in how.items()}
    made = fill_in_middle.fill_in_middle(df, **named)
    markers = how.get("markers", fill_in_middle.MARKERS)
    got = made.withColumn("back", fill_in_middle.restored("output", "form", markers)).collect()
    want = sorted(str((i, *plain_cut(i, t or "", **how), t or "")) for i, t in rows)
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back)) for r in got) == want


def strange_texts():
    rnd = random.Random(9)
    values = ["", "\n", "\n\n", "a", "a\n", "\na", "<P>", "x<M>y", "<S", "P>\n<", "é\n漢\n\U0001F600", "\0\n\0", "\r\n\r", None,
              "line\n" * 5000, "x" * 9000]
    values += ["".join(rnd.choice(["a", "\n", "é", "漢", "\U0001F600", "<", "P>", "S>", "\0", "\x8a", "ਊ"])
                       for _ in range(rnd.randrange(50))) for _ in range(400)]
    return list(enumerate(values, -3)) + [(None, "no id\nat all"), (None, None), (5, "again\n"), (5, "again\n")]


@pytest.mark.parametrize("how", [{}, {"unit": "char"}, {"seed": 3, "percent": 40, "spm": 90},
                                 {"unit": "char", "markers": ("[pre]", "<suf>", "{mid}")}])
def test_fill_in_middle_equals_plain_version(spark, how):
    rows = strange_texts()
    rows_equal(spark.createDataFrame(rows, "doc_id long, text string"), rows, **how)


def test_fill_in_middle_of_odd_rows(odd, none, odd_rows):
    rows_equal(odd, [r[:2] for r in odd_rows])
    assert fill_in_middle.fill_in_middle(none).count() == 0


def test_swar_rank_and_select():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 7, 8, 9, 1000):
        raw = rnd.choice(np.array([10, 0, 11, 9, 138, 128, 255, 65], np.uint8), n)
        words = fill_in_middle.as_words(raw)
        marks = fill_in_middle.Marks(fill_in_middle.newline_marks(words))
        at = np.flatnonzero(raw == 10)
        assert marks.rank(np.arange(n + 1)).tolist() == [int((raw[:i] == 10).sum()) for i in range(n + 1)]
        assert marks.select(np.arange(1, len(at) + 1)).tolist() == at.tolist()
        letters = fill_in_middle.Marks(fill_in_middle.letter_marks(words))
        assert letters.rank(np.array([n]))[0] == int(((raw & 0xC0) != 0x80).sum())


def test_markers_are_checked(spark, none):
    for bad in (("<P>", "<P>", "<M>"), ("<<", "<S>", "<M>"), ("", "a", "b"), ("P", "xP", "c")):
        with pytest.raises(ValueError):
            fill_in_middle.fill_in_middle(none, markers=bad)
    with pytest.raises(ValueError):
        fill_in_middle.fill_in_middle(none, unit="page")


def test_shares_follow_the_parameters(spark):
    df = spark.range(0, 4000).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    forms = {r.form: r["count"] for r in fill_in_middle.fill_in_middle(df, percent=60, spm_percent=25).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 1600) < 150 and abs(forms["spm"] - 600) < 100
