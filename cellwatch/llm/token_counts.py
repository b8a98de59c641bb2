"""Token counts by rank-synchronous merging of ragged symbol arrays.

Distinct pre-tokens of a slice are held as one flat array of symbols with start offsets. In each
round every sequence finds the lowest rank among its adjacent pairs and merges all occurrences of
that pair at once (from the left, not overlapping); sequences without a known pair leave with
their number of symbols. A merge can only make pairs of higher rank than its own, so merging all
occurrences together gives what merging them one by one gives.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellwatch.llm.common import map_slices, texts
from cellwatch.llm.vocabulary import Vocabulary, chunks, parse, split_pretokens

CONTEXT = 1024
KEPT = 400_000       # chunks and pre-tokens whose counts a worker remembers
KEPT_LENGTH = 200    # longer ones (such as texts that can't be cut) are forgotten with their slice
_COUNTS: dict[bytes, tuple[dict, dict]] = {}


def merge_counts(sequences: Sequence[bytes], vocab: Vocabulary) -> np.ndarray:
    """Number of tokens of each non-empty byte sequence."""
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    out = lengths.copy()
    symbols = vocab.byte_ids[np.frombuffer(b"".join(sequences), np.uint8)]
    which = np.flatnonzero(lengths > 1)
    symbols = symbols[np.repeat(lengths > 1, lengths)]
    lengths = lengths[which]
    none = len(vocab.ranks)
    while len(which):
        starts = np.cumsum(lengths) - lengths
        keys = np.append(symbols[:-1] * vocab.size + symbols[1:], -1)
        at = np.minimum(np.searchsorted(vocab.keys, keys), none - 1)
        ranks = np.where(vocab.keys[at] == keys, vocab.key_ranks[at], none)
        ranks[starts + lengths - 1] = none
        lowest = np.minimum.reduceat(ranks, starts)
        alive = lowest < none
        if not alive.all():
            out[which[~alive]] = lengths[~alive]
            keep = np.repeat(alive, lengths)
            symbols, ranks = symbols[keep], ranks[keep]
            which, lengths, lowest = which[alive], lengths[alive], lowest[alive]
            if not len(which):
                break
        hit = np.flatnonzero(ranks == np.repeat(lowest, lengths))
        # Overlapping occurrences (a pair of equal symbols): of a run, every other one from the left.
        new_run = np.append(True, np.diff(hit) != 1)
        run_start = hit[new_run][np.cumsum(new_run) - 1]
        hit = hit[(hit - run_start) % 2 == 0]
        symbols[hit] = vocab.merged[ranks[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        lengths = np.add.reduceat(keep, np.cumsum(lengths) - lengths, dtype=np.int64)
        symbols = symbols[keep]
    return out


def _learn(missing: set[str], by_chunk: dict, by_pretoken: dict, vocab: Vocabulary) -> None:
    """Add the counts of chunks that are not known yet."""
    split = {c: split_pretokens(c) for c in missing}
    new = list({p for ps in split.values() for p in ps if p not in by_pretoken})
    if new:
        by_pretoken.update(zip(new, merge_counts([p.encode() for p in new], vocab).tolist()))
    for c, ps in split.items():
        by_chunk[c] = sum(map(by_pretoken.__getitem__, ps))


def count_texts(values: list[str], content: bytes) -> list[int]:
    """Token count of each text."""
    vocab = parse(content)
    by_chunk, by_pretoken = _COUNTS.setdefault(content, ({}, {}))
    for memory in (by_chunk, by_pretoken):
        if len(memory) > KEPT:
            memory.clear()
    cut, special, missing = [], [], set()
    for text in values:
        mine, n = [], 0
        for part, special_id in vocab.parts(text):
            if special_id is not None:
                n += 1
            else:
                mine += chunks(part) or ([part] if part else [])
        cut.append(mine)
        special.append(n)
        missing.update(mine)
    _learn(missing - by_chunk.keys(), by_chunk, by_pretoken, vocab)
    counts = [n + sum(map(by_chunk.__getitem__, mine)) for mine, n in zip(cut, special)]
    if any(len(c) > KEPT_LENGTH for c in missing):
        for memory in (by_chunk, by_pretoken):
            for x in [x for x in memory if len(x) > KEPT_LENGTH]:
                del memory[x]
    return counts


def token_counts(docs: DataFrame, vocabulary: str, context: int = CONTEXT) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit`` (n_tokens > context).

    ``vocabulary`` is the path of a byte-level BPE file on the driver; its content is broadcast
    (a file of fixed size). A special string inside a text is one token. Null text counts as
    empty: 0 bytes, 0 tokens. doc_id may be null or repeated, rows stay as they are; an empty
    table gives no rows; other columns are not read.
    """
    with open(vocabulary, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(1).to_pylist()
        counts = pa.array(count_texts(values, content.value), pa.int64())
        sizes = pa.compute.cast(pa.compute.binary_length(batch.column(1)), pa.int64())
        over = pa.compute.greater(counts, context)
        return pa.RecordBatch.from_arrays([batch.column(0), sizes, counts, over],
                                          ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_slices(texts(docs), work, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
