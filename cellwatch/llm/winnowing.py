"""Document fingerprints by winnowing.

Signs other than white space are taken as code points (A-Z lower-cased) and every run of K of them
is hashed by a rolling polynomial. Of every window of WINDOW consecutive hashes the smallest stays, of
equal ones the rightmost, once for each position. So any stretch of ``WINDOW + K - 1`` signs that two
texts share gives both a common hash, and its position says where it stands in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import map_slices, mix, slices, texts

K = 16
WINDOW = 32
BLOCK = 1 << 19         # code points of a long text that are worked on at a time
SLICE_BYTES = 32 << 20  # text that neighbouring documents of one slice have together, about
SAMPLES = 8             # sampled keys for each slice bound

# An odd base of the polynomial and its inverse, both modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NONE = np.int64(2 ** 63 - 1)   # above every hash
_SMALLEST = -(2 ** 63)


def _power_table(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


_TABLES = {"up": _power_table(_BASE, 1024), "down": _power_table(_INVERSE, 1024)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_TABLES["up"]) < n:
        _TABLES.update(up=_power_table(_BASE, 2 * n), down=_power_table(_INVERSE, 2 * n))
    return _TABLES["up"][:n], _TABLES["down"][:n]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _signs(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased signs that are not white space, and where each stands."""
    at = np.flatnonzero((points != 32) & ((points < 9) | (points > 13)))
    signs = points[at].astype(np.uint64)
    signs[(signs >= 65) & (signs <= 90)] += np.uint64(32)
    return signs, at


def _window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Index of the rightmost smallest hash of every window, by windows of doubled lengths."""
    n = len(hashes) - window + 1
    best, size = np.arange(len(hashes)), 1

    def later(index: np.ndarray, shift: int) -> np.ndarray:
        left, right = index[:len(index) - shift], index[shift:]
        return np.where(hashes[right] <= hashes[left], right, left)

    while 2 * size <= window:
        best, size = later(best, size), 2 * size
    return later(best, window - size)[:n] if size < window else best[:n]


def winnow_signs(signs: np.ndarray, sizes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of sign sequences laid end to end.

    Returns the hashes, each one's index among all signs, and the number of hashes of each sequence. A
    sequence shorter than ``k`` counts as one run, one with fewer runs than a window as one window.
    """
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
    up, down = _powers(total)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum(mix(signs + np.uint64(1)) * up, out=sums[1:])
    # Runs of every sequence, then one window less one of fillers, so that no window spans two sequences.
    runs = np.where(sizes > 0, np.maximum(sizes - k + 1, 1), 0)
    spread = np.where(runs > 0, runs + window - 1, 0)
    first = np.cumsum(spread) - spread
    which = np.repeat(np.arange(len(sizes)), runs)
    inside = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = starts[which] + inside
    values = mix((sums[np.minimum(begin + k, ends[which])] - sums[begin]) * down[begin])
    hashes = np.full(int(spread.sum()), _NONE, np.int64)
    hashes[first[which] + inside] = (values >> np.uint64(2)).astype(np.int64)
    best = _window_minima(hashes, window)
    real = np.zeros(len(best) + 1, np.int64)
    windows = np.maximum(runs - window + 1, np.minimum(runs, 1))
    some = windows > 0
    np.add.at(real, first[some], 1)
    np.add.at(real, (first + windows)[some], -1)
    chosen = best[np.cumsum(real[:-1]) > 0]
    chosen = chosen[np.append(True, np.diff(chosen) != 0)]
    owner = np.searchsorted(first[some], chosen, "right") - 1
    counts = np.zeros(len(sizes), np.int64)
    counts[some] = np.bincount(owner, minlength=int(some.sum()))
    return hashes[chosen], chosen - first[some][owner] + starts[some][owner], counts


def winnow(values: list[str], k: int = K, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and positions (code points) of every text's fingerprint."""
    out: list = [None] * len(values)
    short = [i for i, v in enumerate(values) if len(v) <= BLOCK]
    for a, b in slices(np.array([len(values[i]) for i in short], np.int64), BLOCK):
        mine = short[a:b]
        points = _code_points("".join(values[i] for i in mine))
        bounds = np.cumsum([0, *(len(values[i]) for i in mine)])
        signs, at = _signs(points)
        sizes = np.diff(np.searchsorted(at, bounds))
        hashes, where, counts = winnow_signs(signs, sizes, k, window)
        cuts = np.append(0, np.cumsum(counts)).tolist()
        where = at[where]
        for j, i in enumerate(mine):
            out[i] = hashes[cuts[j]:cuts[j + 1]], where[cuts[j]:cuts[j + 1]] - bounds[j]
    for i, value in enumerate(values):
        if out[i] is None:
            out[i] = _winnow_long(value, k, window)
    return out


def _winnow_long(text: str, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of one long text, block by block: each block starts at the first window not seen."""
    signs, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, places = [], []
    need = k + window - 1
    for start in range(0, len(text), BLOCK):
        more, where = _signs(_code_points(text[start:start + BLOCK]))
        signs, at = np.append(signs, more), np.append(at, where + start)
        if len(signs) >= need:
            h, w, _ = winnow_signs(signs, np.array([len(signs)]), k, window)
            hashes.append(h)
            places.append(at[w])
            signs, at = signs[len(signs) - need + 1:], at[len(at) - need + 1:]
    if not hashes:
        h, w, _ = winnow_signs(signs, np.array([len(signs)]), k, window)
        return h, at[w]
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    new = np.append(True, np.diff(places) != 0)
    return hashes[new], places[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of two fingerprints that both have (two empty ones are alike)."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - both
    return both / every if every else 1.0


def _lists(items: list[np.ndarray]) -> pa.Array:
    """The arrays as one Arrow list column."""
    offsets = np.cumsum([0, *map(len, items)], dtype=np.int32)
    flat = np.concatenate([np.zeros(0, np.int64), *items]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, hashes array<bigint>, positions array<bigint>``.

    Positions are code points from 0, where a hashed run starts, and rise. Null text counts as empty: no
    hashes. A text of white space alone has none either; one with fewer than ``k`` other signs has one.
    doc_id may be null or repeated, rows stay as they are; an empty table gives no rows; other
    columns are not read. Long texts are worked on in blocks; one text is a task's largest object.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(1).to_pylist()
        found = winnow(values, k, window)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(v) for v in values], pa.int64()), _lists([h for h, _ in found]),
             _lists([p for _, p in found])], ["doc_id", "n_chars", "hashes", "positions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(texts(docs), work, f"doc_id {kind}, n_chars bigint, hashes array<bigint>, positions array<bigint>")


def _dealt_in_order(docs: DataFrame, slice_bytes: int, least: int) -> DataFrame | None:
    """``doc_id, text, slice, extra``: runs of neighbouring documents, each followed by the next one's first.

    The order is by doc_id (null as the smallest), then text. Bounds of the slices are sampled rows' keys
    (id and hash of the text), so the row that starts a slice is known by its key: it is dealt to its
    slice and, as ``extra``, to the one before; the first of all follows the last slice.
    """
    keyed = texts(docs).select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST)).alias("at"),
                               F.xxhash64("text").alias("tie"))
    stats = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"),
                      F.min(F.struct("at", "tie")).alias("first")).first()
    if not stats["n"]:
        return None
    n_slices = max(least, -(-int(stats["bytes"]) // slice_bytes))
    share = min(1.0, SAMPLES * n_slices / stats["n"])
    sampled = keyed.select("at", "tie").sample(share, seed=1).toPandas().sort_values(["at", "tie"])
    sampled = sampled.iloc[len(sampled) // n_slices or 1::len(sampled) // n_slices or 1].drop_duplicates()
    start = (stats["first"]["at"], stats["first"]["tie"])
    keys = [start, *((a, t) for a, t in zip(sampled["at"].tolist(), sampled["tie"].tolist()) if (a, t) > start)]
    bounds = docs.sparkSession.sparkContext.broadcast((np.array([a for a, _ in keys], np.int64),
                                                       np.array([t for _, t in keys], np.int64)))

    @F.pandas_udf("bigint")
    def deal(at: pd.Series, tie: pd.Series) -> pd.Series:
        ids, ties = bounds.value
        a, t = at.to_numpy(np.int64), tie.to_numpy(np.int64)
        low, high = np.searchsorted(ids, a, "left"), np.searchsorted(ids, a, "right")
        own = low - 1
        for i in np.unique(low[high > low]).tolist():   # ids that a bound has: the ties decide
            mine = (low == i) & (high > low)
            own[mine] = i - 1 + np.searchsorted(ties[i:high[mine][0]], t[mine], "right")
        return pd.Series(own * 2 + ((ids[own] == a) & (ties[own] == t)))

    # Placed by number: neighbouring slices stand in one partition, and partitions are evenly filled.
    parts = -(-len(keys) // 2)
    place = "struct(dealt DIV 2 AS slice, false AS extra)"
    ahead = f"struct(IF(dealt < 2, {len(keys) - 1}L, dealt DIV 2 - 1) AS slice, true AS extra)"
    return (keyed.withColumn("dealt", deal("at", "tie"))
            .selectExpr("doc_id", "text", "at", "tie", f"inline(IF(dealt % 2 = 1, array({place}, {ahead}), array({place})))")
            .repartitionById(parts, (F.col("slice") % parts).cast("int"))
            .sortWithinPartitions("slice", "extra", "at", "tie", "text")
            .select("doc_id", "text", "slice", "extra"))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following`` (or all of it)."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def _rows_of(batches: Iterator[pa.RecordBatch], slice_bytes: int) -> Iterator[list[tuple]]:
    """Rows in lists of about ``slice_bytes`` of text."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).to_numpy()
        for a, b in slices(sizes, slice_bytes):
            yield list(zip(*(c.to_pylist() for c in batch.slice(a, b - a).columns)))


def neighbour_likeness(docs: DataFrame, k: int = K, window: int = WINDOW, slice_bytes: int = SLICE_BYTES,
                       least: int = 8) -> DataFrame:
    """Every document's fingerprint beside that of an edited text and of the next document.

    One row per input row: ``doc_id, n_chars, edited_sha256, hashes, positions, edited_hashes,
    edited_positions, near_edited, near_next``. The next document is the next by doc_id (null counts as
    the smallest id; of equal ids, by the hash of the text, then the text); after the last comes the first, which for one
    document alone is itself. The edited text has the last quarter of its code points replaced by as many
    of the next document's first. Nearness is the share of distinct hashes in common; two texts without
    any sign are alike (1). Null text counts as empty; repeated rows follow each other; an empty table
    gives no rows; other columns are not read.

    Whole texts are shuffled once, to runs of neighbours (``slice_bytes`` of text each, about); a task
    streams its rows and keeps one document between them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_chars bigint, edited_sha256 string, hashes array<bigint>, positions array<bigint>, "
              "edited_hashes array<bigint>, edited_positions array<bigint>, near_edited double, near_next double")
    dealt = _dealt_in_order(docs, slice_bytes, least)
    if dealt is None:
        return docs.sparkSession.createDataFrame([], schema)
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else None

    def work(batches):
        last = None
        for rows in _rows_of(batches, 2 << 20):
            rows = [*last, *rows] if last else rows
            prints = winnow([r[1] for r in rows], k, window)
            # A slice ends with the first row of the next one; repeats of that row follow it unused.
            here = [i for i in range(len(rows) - 1) if not rows[i][3]]
            changed = [edited(rows[i][1], rows[i + 1][1]) for i in here]
            again = winnow(changed, k, window)
            last = rows[-1:]
            if here:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[i][0] for i in here], id_type), pa.array([len(rows[i][1]) for i in here], pa.int64()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                     _lists([prints[i][0] for i in here]), _lists([prints[i][1] for i in here]),
                     _lists([h for h, _ in again]), _lists([p for _, p in again]),
                     pa.array([likeness(prints[i][0], h) for i, (h, _) in zip(here, again)], pa.float64()),
                     pa.array([likeness(prints[i][0], prints[i + 1][0]) for i in here], pa.float64())],
                    ["doc_id", "n_chars", "edited_sha256", "hashes", "positions", "edited_hashes", "edited_positions",
                     "near_edited", "near_next"])

    return dealt.mapInArrow(work, schema)


def as_text(hashes: str, positions: str) -> Column:
    """A fingerprint as ``hash@position`` (16 hexadecimal digits, decimal), comma-joined by position."""
    return F.array_join(F.zip_with(hashes, positions, lambda h, p: F.concat(
        F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit("@"), p.cast("string"))), ",")
