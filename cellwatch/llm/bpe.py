"""Byte-level BPE encoding and decoding.

Encoding keeps the symbols of a pre-token in a doubly linked list and its known pairs in a
priority queue of merge ranks; an entry whose symbols have changed since is stale and skipped.
Decoding concatenates the vocabulary's byte strings.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellwatch.llm.common import map_slices, texts
from cellwatch.llm.vocabulary import Vocabulary, chunks, parse, split_pretokens

KEPT = 800_000       # chunks and pre-tokens whose ids a worker remembers
KEPT_LENGTH = 200    # only shorter ones are
_IDS: dict[bytes, tuple[dict, dict]] = {}


def merge(sequence: bytes, vocab: Vocabulary) -> list[int]:
    """Ids of one pre-token."""
    ranks, merged, byte_ids = vocab.ranks, vocab.merged_list, vocab.byte_list
    symbols = [byte_ids[b] for b in sequence]
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            queue.append((rank, i, symbols[i], symbols[i + 1]))
    heapify(queue)
    while queue:
        rank, i, left, right = heappop(queue)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # stale
        symbols[i] = merged[rank]
        symbols[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heappush(queue, (rank, i, symbols[i], symbols[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get((symbols[h], symbols[i]))
            if rank is not None:
                heappush(queue, (rank, h, symbols[h], symbols[i]))
    return [s for s in symbols if s >= 0]


def _ids_of(chunk: str, by_pretoken: dict, vocab: Vocabulary) -> bytes:
    out = []
    for p in split_pretokens(chunk):
        ids = by_pretoken.get(p)
        if ids is None:
            ids = np.array(merge(p.encode(), vocab), np.int32).tobytes()
            if len(p) < KEPT_LENGTH:
                by_pretoken[p] = ids
        out.append(ids)
    return b"".join(out)


def encode_text(text: str, content: bytes) -> bytes:
    """Ids of a text as native int32 bytes."""
    vocab = parse(content)
    by_chunk, by_pretoken = _IDS.setdefault(content, ({}, {}))
    for memory in (by_chunk, by_pretoken):
        if len(memory) > KEPT:
            memory.clear()
    out = []
    for part, special_id in vocab.parts(text):
        if special_id is not None:
            out.append(np.int32(special_id).tobytes())
            continue
        for chunk in chunks(part) or ([part] if part else []):
            ids = by_chunk.get(chunk)
            if ids is None:
                ids = _ids_of(chunk, by_pretoken, vocab)
                if len(chunk) < KEPT_LENGTH:
                    by_chunk[chunk] = ids
            out.append(ids)
    return b"".join(out)


def _content(df: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array of int).

    ``vocabulary`` is the path of a byte-level BPE file on the driver; its content is broadcast
    (a file of fixed size). A special string inside a text becomes its id. Null and empty texts
    give an empty array. doc_id may be null or repeated, rows stay as they are; an empty table
    gives no rows; other columns are not read.
    """
    content = _content(docs, vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoded = [encode_text(t, content.value) for t in batch.column(1).to_pylist()]
        offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return map_slices(texts(docs), work, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids, text`` of rows ``doc_id, ids``: the vocabulary's strings in order, as UTF-8.

    Bytes that are not UTF-8 become U+FFFD. A null array gives null; an id that the vocabulary
    does not have raises an IndexError.
    """
    content = _content(encoded, vocabulary)

    def run(batches):
        strings = parse(content.value).strings
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.slice(start, 500)
                values = [None if ids is None else
                          b"".join(map(strings.__getitem__, ids.values.tolist())).decode("utf-8", "replace")
                          for ids in (None if not x.is_valid else _Values(x) for x in part.column(1))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.string())],
                                                 ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")


class _Values:
    """The numbers of one Arrow list value."""

    def __init__(self, scalar):
        self.values = scalar.values.to_numpy(zero_copy_only=False)
