"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every task counts its texts' n-grams into ``buckets`` counters per language and emits the
counters that are not zero; one aggregate sums them. The log-probability matrix (buckets x
languages) is broadcast and whole slices of texts are scored at once in numpy.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import map_slices, slices, texts

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.5
SLICE = 1 << 19            # text that is worked on at a time
MAX_LANGUAGES = 1000       # the broadcast matrix holds at most BUCKETS x this; beyond it training raises
UNDETERMINED = "und"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(1)
def _letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(values: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of all n-grams, the text each belongs to, and whether a text has a letter.

    Texts are lower-cased and every sign that is no letter counts as a space; n-grams of spaces
    alone are left out.
    """
    values = [v.lower() for v in values]
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    signs = np.frombuffer("".join(values).encode("utf-32-le"), np.uint32)
    letter = _letter_table()[signs]
    signs = np.where(letter, signs, 32).astype(np.uint64)
    owner = np.repeat(np.arange(len(values)), lengths)
    has_letter = np.bincount(owner[letter], minlength=len(values)) > 0
    shift = np.uint64(64 - (buckets - 1).bit_length())
    found, owners = [], []
    for n in ORDERS:
        if len(signs) < n:
            continue
        end = len(signs) - n + 1
        mixed = np.full(end, n, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        some = np.zeros(end, bool)
        for k in range(n):
            mixed = (mixed ^ signs[k:k + end]) * _ODD[k % len(_ODD)]
            mixed ^= mixed >> np.uint64(29)
            some |= letter[k:k + end]
        some &= owner[:end] == owner[n - 1:]
        found.append(((mixed[some] * _ODD[0]) >> shift).astype(np.int64))
        owners.append(owner[:end][some])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    return np.concatenate(found), np.concatenate(owners), has_letter


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the doc_id as text leaves ``part`` modulo ``parts`` (null: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def train(labelled: DataFrame, buckets: int = BUCKETS) -> dict:
    """Model of the rows ``text, lang`` (rows with a null in either are left out).

    Returns ``languages`` (sorted), ``log_p`` (buckets x languages) and ``prior``. The driver
    gets at most buckets x languages counts, whatever the number of texts.
    """
    def count(batches):
        memory: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(np.fromiter(map(len, values), np.int64, len(values)), SLICE):
                names = sorted(set(langs[a:b]))
                number = np.array([names.index(x) for x in langs[a:b]])
                at, owner, _ = grams(values[a:b], buckets)
                n = np.bincount(number[owner] * buckets + at, minlength=len(names) * buckets).reshape(-1, buckets)
                docs = np.bincount(number, minlength=len(names))
                for i, name in enumerate(names):
                    row = memory.setdefault(name, np.zeros(buckets + 1, np.int64))
                    row[:-1] += n[i]
                    row[-1] += docs[i]
        for name, row in memory.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()),
                                              pa.array(row[at])], ["lang", "bucket", "n"])

    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    counts = (known.mapInArrow(count, "lang string, bucket bigint, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # The distinct languages come first: they bound what is fetched next.
    languages = sorted(r["lang"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = counts.toArrow()
    matrix = np.zeros((len(languages), buckets + 1))
    row = np.searchsorted(np.array(languages, object), np.array(table.column("lang").to_pylist(), object))
    matrix[row, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    smooth = matrix[:, :-1] + SMOOTHING
    return {"languages": languages, "prior": np.log(np.maximum(matrix[:, -1], 1) / max(matrix[:, -1].sum(), 1)),
            "log_p": np.ascontiguousarray(np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32))}


def classify(values: list[str], model: dict) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability for each text."""
    languages, log_p = model["languages"], model["log_p"]
    at, owner, has_letter = grams(values, len(log_p))
    out, score = [UNDETERMINED] * len(values), np.zeros(len(values))
    if not languages:
        return out, score
    total = np.stack([np.bincount(owner, log_p[at, k], len(values)) for k in range(len(languages))], 1)
    total = total + model["prior"]
    total -= total.max(axis=1, keepdims=True)
    best = total.argmax(axis=1)
    posterior = 1 / np.exp(total).sum(axis=1)
    out = [languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), has_letter.tolist())]
    return out, np.where(has_letter, posterior, 0.0)


def predict(docs: DataFrame, model: dict, *more: str) -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score`` and the columns ``more`` of ``docs``.

    A null or empty text, or one without a letter, gives ``und`` with score 0, as does a model
    that saw no labelled text. Equal probabilities go to the first language by name. Only doc_id,
    text and ``more`` are read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pred, score = classify(batch.column(1).to_pylist(), shared.value)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score),
                                           *batch.columns[2:]], ["doc_id", "lang_pred", "score", *more])

    source = texts(docs, *more)
    rest = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    return map_slices(source, work, "doc_id bigint, lang_pred string, score double" + rest, SLICE)


def keep_identified(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a letter and a language of at least ``least`` probability, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            values = ["" if t is None else t for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            for a, b in slices(np.fromiter(map(len, values), np.int64, len(values)), SLICE):
                pred, score = classify(values[a:b], shared.value)
                keep = (np.array(pred, object) != UNDETERMINED) & (score >= least)
                yield batch.slice(a, b - a).filter(pa.array(keep.astype(bool)))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, parts: int = 4, part: int = 2) -> DataFrame:
    """Train on the rows that are not held out and have a lang; predict every row.

    ``doc_id, held_out, lang_pred, score``. A null doc_id is neither held out nor learned from.
    """
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, part)))
    return predict(docs, model).select("doc_id", held_out("doc_id", parts, part).alias("held_out"),
                                       "lang_pred", "score")
