"""Packing of documents into sequences: best fit, then swap-based local search.

Pieces are dealt by a stored row number into shards of about ``SHARD`` pieces, so that no task grows with the
input; each shard is packed by itself and ends with at most a few sequences that are not full. In
a shard, best fit over decreasing lengths gives the start. The local search then takes the sequences
from the least filled one on and moves their documents into fuller ones, alone or in exchange for one shorter
document or for two that are shorter together. Every step makes a fuller sequence fuller, so the
sum of squared fills rises until no packing has fewer sequences or no step is left.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, insort
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import map_slices, texts, unused, written

LENGTH = 2048
SHARD = 20_000             # pieces that one task packs together, at about
END_ID = 0                 # appended to every document
KEPT = 1_000_000           # runs whose ids a worker remembers
KEPT_LENGTH = 200          # longer ones are forgotten with their slice
_IDS: dict[str, dict[bytes, bytes]] = {}


@lru_cache(2)
def _tokenizer(content: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(content)


def encode_texts(values: list[str], content: str) -> list[bytes]:
    """Token ids of each text as little-endian uint32 bytes, by the tokenizers library.

    For a tokenizer that drops white space before it splits, every run without ASCII white space
    is encoded by itself, so runs are encoded once and remembered. A tokenizer of another kind
    gets whole texts.
    """
    tokenizer = _tokenizer(content)
    if not _drops_space(content):
        got = tokenizer.encode_batch(values, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]
    memory = _IDS.setdefault(content, {})
    if len(memory) > KEPT:
        memory.clear()
    # ASCII capitals are the same to a lower-casing tokenizer, but for its special strings ("<|").
    raw = [v.encode() for v in values]
    cut = [(r if b"<|" in r else r.lower()).split() for r in raw]
    missing = set().union(*cut).difference(memory)      # looks up each run; "- memory.keys()" would go through the memory
    _learn(missing, memory, content)
    out = [b"".join(map(memory.__getitem__, words)) for words in cut]
    for m in missing:
        if len(m) > KEPT_LENGTH:
            del memory[m]
    return out


def _learn(missing: set[bytes], memory: dict[bytes, bytes], content: str) -> None:
    """Add the ids of runs that are not known yet.

    Signs after a letter or digit start a pre-token of their own, so ``word,`` is ``word`` and ``,``.
    Runs of letters are one pre-token each; many are encoded as one text and told apart by the
    tokens that end a word. All others are encoded one by one.
    """
    ends = _word_ends(content)
    joined, wanted = [], set()
    for m in missing:
        stem = m.rstrip(_SIGNS)
        if len(stem) < len(m) and _LETTER_END.search(stem):
            signs = m[len(stem):]
            joined.append((m, stem, signs))
            wanted.add(stem)
            wanted.add(signs)
        else:
            wanted.add(m)
    wanted = wanted.difference(memory)
    tokenizer = _tokenizer(content)
    words = [m for m in wanted if _LETTERS.fullmatch(m)] if ends is not None else []
    for k in range(0, len(words), 5_000):
        part = words[k:k + 5_000]
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
        cuts = (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
        if len(cuts) != len(part):
            continue                     # not one pre-token each: encoded one by one below
        data = ids.tobytes()
        memory.update(zip(part, (data[a:b] for a, b in zip([0, *cuts[:-1]], cuts))))
    rest = [m for m in wanted if m not in memory]
    for k in range(0, len(rest), 10_000):
        part = rest[k:k + 10_000]
        got = tokenizer.encode_batch_fast([m.decode() for m in part], add_special_tokens=False)
        memory.update((m, array("I", e.ids).tobytes()) for m, e in zip(part, got))
    for m, stem, signs in joined:
        memory[m] = memory[stem] + memory[signs]


_SIGNS = b"#*$%&.,!?;:"
_LATIN = rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf\x9f])"     # a-z and the lower-case letters of Latin-1
_LETTERS = re.compile(_LATIN + rb"+")
_LETTER_END = re.compile(rb"(?:[0-9]|" + _LATIN + rb")\Z")


@lru_cache(2)
def _word_ends(content: str) -> np.ndarray | None:
    """Whether a token ends a word, by id; None where the vocabulary doesn't mark it."""
    model = json.loads(content)["model"]
    suffix = model.get("end_of_word_suffix")
    if not suffix:
        return None
    out = np.zeros(max(model["vocab"].values()) + 1000, bool)
    for token, i in model["vocab"].items():
        out[i] = token.endswith(suffix)
    return out


@lru_cache(4)
def _drops_space(content: str) -> bool:
    """Whether the file lower-cases and splits on white space that it removes."""
    spec = json.loads(content)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (any(s.get("type") == "Lowercase" for s in steps) and split.get("type") == "Split"
            and split.get("behavior") == "Removed" and split.get("invert") is True
            and spec.get("truncation") is None and spec.get("padding") is None
            and all(not t.get("normalized") and not t.get("single_word") for t in spec.get("added_tokens", [])))


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every row, cut only where it is longer than ``length``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers. ``vocabulary`` is the
    path of a tokenizers file on the driver, whose content is broadcast (a file of fixed size).
    Null and empty texts give the end id alone. doc_id may be null or repeated: every row has its
    own pieces. An empty table gives no rows; other columns are not read.
    """
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.uint32(END_ID).astype("<u4").tobytes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [], [], [], [], []
        coded = encode_texts(batch.column(1).to_pylist(), content.value)
        for doc_id, ids in zip(batch.column(0).to_pylist(), coded):
            ids += end
            for k, at in enumerate(range(0, len(ids), 4 * length)):
                part = ids[at:at + 4 * length]
                for column, value in zip(rows, (doc_id, k, at // 4, len(part) // 4, part)):
                    column.append(value)
        kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)],
                                          ["doc_id", "piece", "start", "length", "ids"])

    return map_slices(texts(docs), work, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers) by best fit over decreasing sizes."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    has = 0                                     # bit f: some bin has f free
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        fits = has >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                has &= ~(1 << free)
        else:
            b, free = len(bins), capacity
            bins.append([])
        bins[b].append(item)
        by_free[free - size].append(b)
        has |= 1 << (free - size)
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """No packing has fewer bins: the largest of the bounds by dual feasible functions.

    Each function gives items new sizes that fit wherever the old ones fit together: the sizes themselves;
    large items rounded up to a whole bin and as small ones to nothing; multiples of a k-th of the bin.
    """
    many = np.bincount(np.asarray(sizes, np.int64), minlength=capacity + 1)
    size = np.arange(capacity + 1)
    below = np.concatenate([[0], np.cumsum(many * size)])              # total of the sizes below
    above = np.concatenate([np.cumsum(many[::-1])[::-1], [0]])         # number of the sizes from here on
    least = np.arange(capacity // 2 + 1)
    totals = above[capacity - least + 1] * capacity + below[capacity - least + 1] - below[least]
    best = -(-int(totals.max()) // capacity)
    for k in range(1, 100):
        steps, rest = np.divmod((k + 1) * size, capacity)
        total = int((many * np.where(rest == 0, k * size, steps * capacity)).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


class _Fuller:
    """Underfull bins by room, by (item size, room) and by (sum of two items, room).

    An index entry holds the bin's state by number, so entries of earlier states are known and dropped when met.
    """

    def __init__(self, items: list[list], fill: list[int], capacity: int):
        self.items, self.fill, self.capacity = items, fill, capacity
        self.state = [0] * len(items)
        self.by_room: list[list] = [[] for _ in range(capacity + 1)]
        self.rooms = 0                                                 # bit r: there may be a bin with room r
        self.with_size: list[list] = [[] for _ in range(2 * (capacity + 1))]     # items, then sums of two
        self.reach = np.zeros((2, capacity + 1), np.int64)             # most room of the bins of with_size
        self.least = []
        for b in range(len(items)):
            self.add(b)

    def add(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if not 0 < room < self.capacity:
            return
        entry = (-room, b, self.state[b])
        heappush(self.least, entry)
        self.by_room[room].append(entry)
        self.rooms |= 1 << room
        own = [s for s, _ in self.items[b]]
        sizes = sorted(set(own))
        sums = {x + y for k, x in enumerate(sizes) for y in sizes[k + 1:]} | {
            2 * x for x, y in zip(own, own[1:]) if x == y}
        for kind, found in enumerate((sizes, sums)):
            for size in found:
                heappush(self.with_size[kind * (self.capacity + 1) + size], entry)
                if room > self.reach[kind, size]:
                    self.reach[kind, size] = room

    def drop(self, b: int) -> None:
        self.state[b] += 1

    def valid(self, entry: tuple) -> bool:
        return self.state[entry[1]] == entry[2]

    def take_least(self) -> int | None:
        """The least filled bin, out of the index; None when the index is empty."""
        while self.least:
            entry = heappop(self.least)
            if self.valid(entry):
                self.drop(entry[1])
                return entry[1]
        return None

    def fitting(self, size: int) -> int | None:
        """The fullest bin with room for ``size``."""
        fits = self.rooms >> size
        while fits:
            room = size + (fits & -fits).bit_length() - 1
            entries = self.by_room[room]
            while entries and not self.valid(entries[-1]):
                entries.pop()
            if entries:
                return entries[-1][1]
            self.rooms &= ~(1 << room)
            fits = self.rooms >> size
        return None

    def exchange(self, size: int) -> tuple[int, list[int]] | None:
        """A bin and the sizes of its one or two items, shorter than ``size``, that leave room for it; the least of these."""
        found = None
        for kind in (0, 1):
            reach = self.reach[kind]
            while True:
                good = np.flatnonzero(np.arange(size) + reach[:size] >= size)
                if not len(good) or (found and found[0] <= good[0]):
                    break
                given = int(good[0])
                entries = self.with_size[kind * (self.capacity + 1) + given]
                while entries and not self.valid(entries[0]):
                    heappop(entries)
                reach[given] = -entries[0][0] if entries else 0
                if given + reach[given] >= size:
                    found = given, kind, entries[0][1]
                    break
        if found is None:
            return None
        given, kind, b = found
        own = [s for s, _ in self.items[b]]
        if kind == 0:
            return b, [given]
        i, j = 0, len(own) - 1
        while own[i] + own[j] != given:
            if own[i] + own[j] < given:
                i += 1
            else:
                j -= 1
        return b, [own[i], own[j]]


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Empty as many bins as single steps can; every step raises the sum of squared fills.

    A round takes the underfull bins from the least filled one on and gives their items, the longest first,
    to bins at least as full: alone, or for one or two items that are shorter. All such bins are looked at, through an
    index. It ends where no packing has fewer bins, or where a whole round finds no step.
    """
    bound = lower_bound(sizes, capacity)
    items = [sorted((sizes[i], i) for i in b) for b in bins]
    fill = [sum(s for s, _ in b) for b in items]
    used, moved = sum(map(bool, items)), True

    def hand_over(fuller: _Fuller, donor: int) -> bool:
        """One step of the donor; False if there is none."""
        for size in sorted({s for s, _ in items[donor]}, reverse=True):
            b, back = fuller.fitting(size), []
            if b is None:
                if (found := fuller.exchange(size)) is None:
                    continue
                b, back = found
            for source, target, gone in ((donor, b, [size]), (b, donor, back)):
                for s in gone:
                    item = items[source].pop(bisect_left(items[source], (s, -1)))
                    insort(items[target], item)
                    fill[source] -= s
                    fill[target] += s
            fuller.drop(b)
            fuller.add(b)
            return True
        return False

    while moved and used > bound:
        moved, fuller = False, _Fuller(items, fill, capacity)
        while used > bound and (donor := fuller.take_least()) is not None:
            while items[donor] and hand_over(fuller, donor):
                moved = True
            used -= not items[donor]
    return [[i for _, i in b] for b in items if b]


def place(cut: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """``cut`` (any columns, among them ``length``) with ``sequence_id`` and ``offset`` added.

    Every row has a place; the places of a sequence follow each other without a gap from 0 and sum
    to at most ``length``. A row longer than that raises. ``cut`` is counted and read once each, so
    give it as a written table. An empty table gives no rows.
    """
    count = cut.count()
    shards = max(1, -(-count // shard))
    given = cut.schema.fields
    names = [f.name for f in given]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given)

    def pack(key, table: pa.Table) -> pa.Table:
        sizes = table.column("length").to_pylist()
        if sizes and max(sizes) > length:
            raise ValueError(f"a piece is longer than {length}")
        number = np.zeros(len(sizes), np.int64)
        offset = np.zeros(len(sizes), np.int64)
        full = [i for i, s in enumerate(sizes) if s == length]
        number[full] = np.arange(len(full))
        rest = [i for i, s in enumerate(sizes) if s < length]
        own = [sizes[i] for i in rest]
        for k, b in enumerate(local_search(best_fit(own, length), own, length), len(full)):
            at = 0
            for i in b:
                number[rest[i]], offset[rest[i]] = k, at
                at += own[i]
        return pa.table([*(table.column(n) for n in names), pa.array(number + (key[0].as_py() << 32)),
                         pa.array(offset)], [*names, "sequence_id", "offset"])

    # Dealt by a stored number of the row, so that repeated rows are spread too.
    row, part = unused(cut, "row_number"), unused(cut, "shard")
    numbered = written(cut.withColumn(row, F.monotonically_increasing_id()), "numbered")
    dealt = numbered.withColumn(part, F.pmod(F.xxhash64(row), F.lit(shards))).groupBy(part)
    return dealt.applyInArrow(lambda key, table: pack(key, table.select(names)),
                              schema + ", sequence_id bigint, offset bigint")

