"""Helpers shared by the corpus operators: scratch tables, unused column names, text slices."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.session import ensure_checkpoint_dir

# Fixed value: the white space of the word contract, as a Java / DuckDB / Python character class.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` as Parquet (with the writer's ``options``) to the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of the files, not a re-computation,
    and a value that depends on the row order of one run (a row number) stays as it was.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Jobs that run in here have these settings of the session."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession):
    """Jobs that end in here leave no shuffle files; else these stay until the driver collects its garbage.

    For jobs that write a table. Where files are wanted once more, Spark runs their stage again.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def unused(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty), and the further columns asked for; all others are pruned."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def row_key() -> Column:
    """128-bit digest of a row's doc_id and text (null text counts as empty)."""
    line = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit("")))
    return F.unhex(F.substring(F.sha2(line, 256), 1, 32))


def with_keys(keyed: DataFrame, key: str, stays: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose ``key`` is in ``stays``, each key once.

    Always a sort-merge join: the keys grow with the rows, so they are never broadcast. The rows are
    shuffled once; bringing repeated rows together uses the same partitioning.
    """
    return keyed.join(stays.hint("merge"), key, "left_semi").dropDuplicates([key])


def words_of(text: str | Column) -> Column:
    """Array of the words (maximal runs without the six white-space bytes)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(c, SPACE_CLASS), lambda w: w != F.lit(""))


def partitions_for(df: DataFrame, column: str, bytes_each: int, least: int) -> int:
    """Number of partitions that hold about ``bytes_each`` of ``column`` each (one scan)."""
    total = df.select(F.sum(F.octet_length(F.col(column))).alias("b")).first()["b"] or 0
    return max(least, -(-int(total) // bytes_each))


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit`` (a larger item stands alone)."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


ROWS_A_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in an Arrow batch where the session leaves that open: texts are wide rows, and a batch is
    held by the JVM and by the Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(ROWS_A_BATCH))


def map_slices(docs: DataFrame, work, schema: str, slice_bytes: int = 2 << 20) -> DataFrame:
    """Apply ``work(RecordBatch) -> RecordBatch`` to slices of about ``slice_bytes`` of text.

    ``docs`` has the columns doc_id and text (not null) first. Slicing bounds a task's working
    memory by the slice (or one very long text), whatever Arrow's batch size is.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            sizes = np.diff(np.frombuffer(column.buffers()[1], offset_type(column), len(column) + 1,
                                          column.offset * offset_type(column)().itemsize)) if len(column) else []
            for a, b in slices(np.asarray(sizes), slice_bytes):
                yield work(batch.slice(a, b - a))
    return docs.mapInArrow(run, schema)


def offset_type(column):
    """numpy type of a (large) string or binary array's offsets."""
    return np.int64 if str(column.type).startswith("large") else np.int32


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a null-free Arrow string array as one uint8 array, and the n + 1 offsets."""
    kind = offset_type(column)
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * kind().itemsize)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


# Word hashing: a polynomial over random byte values, mixed at the end. 64 bits; the constants are
# fixed so that every task and every run agrees.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS = {"p": np.ones(1, np.uint64)}


def _powers(n: int) -> np.ndarray:
    if len(_POWERS["p"]) < n:
        factors = np.full(max(n, 256), _BASE, np.uint64)
        factors[0] = 1
        _POWERS["p"] = np.multiply.accumulate(factors)
    return _POWERS["p"]


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice (A-Z lower-cased) in order, and the text each belongs to."""
    space = _IS_SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    start[inner] = ~space[inner]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    spans = np.diff(np.append(starts, len(raw)))
    position = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
    values = _BYTE_VALUES[_LOWER[raw[starts[0]:]]]
    # A span runs to the next word, so its trailing white space counts as nothing.
    values[space[starts[0]:]] = 0
    values *= _powers(int(spans.max()))[position]
    return mix(np.add.reduceat(values, starts - starts[0])), np.searchsorted(offsets, starts, "right") - 1
