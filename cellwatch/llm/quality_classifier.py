"""Quality classifier by co-training of two views.

The content view sees the text (hashed words and sign runs), the metadata view the other columns
(source, language and length, hashed). Both are multinomial naive Bayes models, so a model is a
table of counts that Spark sums over all documents, and a pseudo-label is one more document in a
count. In each round every view labels the unlabelled documents it is confident of, these are
counted into the other view, and both models are made anew. At the end each view is calibrated on
labelled documents that were never trained on, and the calibrated log odds are added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import map_slices, mix, text_bytes, texts, word_hashes, written

BUCKETS = 1 << 14          # hashed words; at most 65536
META_BUCKETS = 1 << 12     # hashed metadata values
ROUNDS = 3
CONFIDENT = 0.95           # posterior above which a view lends its label
CALIBRATION_PART = 5       # labelled documents whose crc32(doc_id) leaves 0 modulo this calibrate
BINS = 40                  # score bins that the calibration sees
SMOOTHING = 0.5
SHAPES, STEPS = 4, 16      # shape features of a text and their steps
_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _words(column, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words of each text (without their signs) and runs of signs, and owners."""
    raw, offsets = text_bytes(column)
    sign = _SIGN[raw]
    letters, signs = raw.copy(), raw.copy()
    letters[sign] = 32
    signs[~sign] = 32
    found = [word_hashes(letters, offsets), word_hashes(signs, offsets)]
    value = np.concatenate([(h + np.uint64(k)) for k, (h, _) in enumerate(found)])
    owner = np.concatenate([o for _, o in found])
    # A text counts a feature once, so length alone does not decide.
    words = buckets - SHAPES * STEPS
    pair = np.unique(owner * words + (mix(value) % np.uint64(words)).astype(np.int64))
    return pair % words, pair // words


def _shapes(column, buckets: int) -> np.ndarray:
    """Feature numbers of each text's shape: shares of distinct words, distinct lines, signs, capitals."""
    raw, offsets = text_bytes(column)
    n = len(column)
    words, owner = word_hashes(raw, offsets)
    count = lambda at, of: np.bincount(of[at], minlength=n)
    order = np.lexsort((words, owner))
    new = np.append(True, (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])) \
        if len(words) else np.zeros(0, bool)
    texts_ = column.to_pylist()
    lines = [[x for x in t.split("\n") if x.strip()] for t in texts_]
    byte_owner = np.repeat(np.arange(n), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)
    n_words = np.maximum(np.bincount(owner, minlength=n), 1)
    shares = [count(new, owner[order]) / n_words,
              np.array([len(set(x)) / max(len(x), 1) for x in lines]),
              np.minimum(1, 4 * count(_SIGN[raw], byte_owner) / size),
              count((raw >= 65) & (raw <= 90), byte_owner) / size]
    step = np.stack([np.minimum((np.asarray(x) * (STEPS - 1)).astype(np.int64), STEPS - 1) for x in shares], 1)
    return buckets - SHAPES * STEPS + np.arange(SHAPES) * STEPS + step


def _log_odds(counts: np.ndarray) -> np.ndarray:
    """Log ratio of each feature between good (row 1) and bad (row 0) documents."""
    p = counts + SMOOTHING
    p = np.log(p / p.sum(axis=1, keepdims=True))
    return p[1] - p[0]


def _meta_values(docs: DataFrame, buckets: int) -> Column:
    """Hashed metadata of a row: each column by itself, and source with language."""
    size = F.floor(F.log2(F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1)) + 0.5) * 2).cast("string")
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    parts = [F.concat(F.lit("s:"), value("source")), F.concat(F.lit("l:"), value("lang")), F.concat(F.lit("n:"), size),
             F.concat_ws("|", value("source"), value("lang")), F.concat_ws("|", F.lit("ln"), value("lang"), size)]
    return F.array(*(F.pmod(F.xxhash64(p), F.lit(buckets)).cast("int") for p in parts))


def _featured(docs: DataFrame, buckets: int, meta_buckets: int) -> DataFrame:
    """``doc_id, words, shape, meta``: feature numbers as bytes, a fraction of the text's size."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(batch)
        at, owner = _words(batch.column(1), buckets)
        cuts = 2 * np.searchsorted(owner, np.arange(n + 1))
        data = at.astype(np.uint16).tobytes()
        words = [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        shape = [x.tobytes() for x in _shapes(batch.column(1), buckets).astype(np.uint16)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary()), pa.array(shape, pa.binary()),
                                           batch.column(2)], ["doc_id", "words", "shape", "meta"])

    source = texts(docs, _meta_values(docs, meta_buckets).alias("meta"))
    return map_slices(source, work, "doc_id bigint, words binary, shape binary, meta array<int>")


class _Rows:
    """Features of some rows of a featured table, as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        self.n = len(batch)
        data = batch.column(batch.schema.get_field_index("words")).to_pylist()
        self.words = np.frombuffer(b"".join(data), np.uint16).astype(np.int64)
        self.size = np.fromiter((len(x) // 2 for x in data), np.int64, self.n)
        self.owner = np.repeat(np.arange(self.n), self.size)
        shape = b"".join(batch.column(batch.schema.get_field_index("shape")).to_pylist())
        self.shape = np.frombuffer(shape, np.uint16).astype(np.int64).reshape(self.n, SHAPES)
        self.meta = np.array(batch.column(batch.schema.get_field_index("meta")).to_pylist(), np.int64).reshape(self.n, -1)

    def scores(self, models: dict) -> tuple[np.ndarray, np.ndarray]:
        """Log odds by each view, not calibrated."""
        log_odds = models["content"]
        content = np.bincount(self.owner, log_odds[self.words], self.n) / np.sqrt(np.maximum(self.size, 1))
        return content + log_odds[self.shape].sum(axis=1), models["meta"][self.meta].sum(axis=1)


def _in_rows(batches, rows: int = 1000):
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def _views(featured: DataFrame, models: dict, *more: str) -> DataFrame:
    """Per row the log odds of both views, and the columns ``more``."""
    shared = featured.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for part in _in_rows(batches):
            content, meta = _Rows(part).scores(shared.value)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(content), pa.array(meta), *part.columns[4:]],
                                             ["doc_id", "content", "meta", *more])

    source = featured.select("doc_id", "words", "shape", "meta", *more)
    rest = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[4:])
    return source.mapInArrow(run, "doc_id bigint, content double, meta double" + rest)


def _counts(marked: DataFrame, models: dict | None, buckets: int, meta_buckets: int) -> dict:
    """Models from the class counts over all rows: true labels, and the other view's confident ones.

    Tasks add up arrays of fixed size; Spark sums them by feature, so the driver gets at most
    2 * (buckets + meta_buckets) sums. Without models only the labelled rows count.
    """
    shared = marked.sparkSession.sparkContext.broadcast(models)

    def count(batches):
        m = shared.value
        content, meta = np.zeros((2, buckets), np.int64), np.zeros((2, meta_buckets), np.int64)
        for part in _in_rows(batches):
            rows = _Rows(part)
            label = np.array([-1 if x is None else x for x in part.column(4).to_pylist()])
            known = np.where(part.column(5).to_numpy(zero_copy_only=False), -1, label)
            for_content, for_meta = known.copy(), known.copy()
            if m is not None:
                open_ = label < 0
                for view, score, other in zip(("content", "meta"), rows.scores(m), (for_meta, for_content)):
                    a, b = m[view + "_fit"]
                    lend = 1 / (1 + np.exp(-np.clip(a + b * score, -50, 50)))
                    other[open_ & (lend >= CONFIDENT)] = 1
                    other[open_ & (lend <= 1 - CONFIDENT)] = 0
            for y in (0, 1):
                content[y] += np.bincount(rows.words[for_content[rows.owner] == y], minlength=buckets)
                content[y] += np.bincount(rows.shape[for_content == y].ravel(), minlength=buckets)
                meta[y] += np.bincount(rows.meta[for_meta == y].ravel(), minlength=meta_buckets)
        flat = np.concatenate([content.ravel(), meta.ravel()])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["at", "n"])

    source = marked.select("doc_id", "words", "shape", "meta", "quality", _calibrates().alias("held"))
    sums = source.mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(2 * (buckets + meta_buckets))
    flat[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return {"content": _log_odds(flat[:2 * buckets].reshape(2, -1)), "meta": _log_odds(flat[2 * buckets:].reshape(2, -1))}


def _calibrates() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % CALIBRATION_PART == 0, F.lit(False))


def _platt(score: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not negative) of a logistic fit to binned scores, with a weak ridge."""
    w = np.zeros(2)
    x = np.stack([np.ones_like(score), score], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        total = good + bad
        gradient = x.T @ (good - total * p) - 0.1 * w
        hessian = (x * (total * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(float(w[1]), 0.0)


def _calibrate(marked: DataFrame, models: dict) -> dict:
    """Fit of both views on the calibration rows, from at most 2 * (BINS + 1) bins of scores."""
    scored = written(_views(marked.where(_calibrates() & F.col("quality").isNotNull()), models, "quality"), "calibration")
    for view in ("content", "meta"):
        ends = scored.agg(F.min(view).alias("lo"), F.max(view).alias("hi")).first()
        lo, hi = ends["lo"] or 0.0, ends["hi"] or 0.0
        width = (hi - lo) / BINS or 1.0
        rows = scored.groupBy(F.floor((F.col(view) - lo) / width).alias("bin")).agg(
            F.avg(view).alias("x"), F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).orderBy("bin").collect()
        x, good, bad = (np.array([float(r[c]) for r in rows]) for c in ("x", "good", "bad"))
        models[f"{view}_fit"] = _platt(x, good, bad) if len(rows) else (0.0, 0.0)
    return models


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, buckets: int = BUCKETS,
             meta_buckets: int = META_BUCKETS) -> DataFrame:
    """One row per input row: ``doc_id, content_score, meta_score, quality_score, quality_pred``.

    ``labels`` has doc_id and quality (0 or 1; rows with another value or a null are left out; of
    several rows for a doc_id the smallest quality counts). Scores are calibrated probabilities of
    good quality by each view and by both; quality_pred is 1 from 0.5 on. A null text counts as
    empty, missing or null metadata as the empty value. Rows with a null doc_id are scored, never
    labelled; repeated rows are scored alike. Without any label all scores are 0.5. An empty table
    gives no rows. Of ``docs`` only doc_id, text, source and lang are read.
    """
    known = written(labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("quality")), "labels")
    # The labels grow with the documents, so they are never broadcast; features are shuffled, not texts.
    marked = written(_featured(docs, buckets, meta_buckets).join(known.hint("merge"), "doc_id", "left"), "features")
    models = _calibrate(marked, _counts(marked.where("quality IS NOT NULL"), None, buckets, meta_buckets))
    for _ in range(rounds):
        models = _calibrate(marked, _counts(marked, models, buckets, meta_buckets))
    (c0, c1), (m0, m1) = models["content_fit"], models["meta_fit"]
    odds_c, odds_m = F.lit(c0) + F.lit(c1) * F.col("content"), F.lit(m0) + F.lit(m1) * F.col("meta")
    # Both fits hold the share of good documents; the sum holds it once.
    prior = marked.where(_calibrates()).agg(F.avg("quality").alias("q")).first()["q"]
    prior = 0.5 if prior is None else min(max(prior, 0.001), 0.999)
    both = odds_c + odds_m - F.lit(float(np.log(prior / (1 - prior))))
    sigmoid = lambda x: 1 / (1 + F.exp(-x))
    return _views(marked, models).select(
        "doc_id", sigmoid(odds_c).alias("content_score"), sigmoid(odds_m).alias("meta_score"),
        sigmoid(both).alias("quality_score"), (sigmoid(both) >= 0.5).cast("int").alias("quality_pred"))
