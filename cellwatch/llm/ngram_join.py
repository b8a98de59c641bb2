"""Jaccard join of documents on word n-grams, by token-combination prefixes.

A document is the set of its distinct 5-word shingles. Two sets that are similar enough share most
of the first tokens (the prefix) of a global order in which rare tokens come first. A token of the
rare class is a signature by itself. A token of the frequent class is worth little alone, so
frequent tokens are indexed as two-token combinations, and the prefix is extended by one token for
every class of which one shared token gives no combination yet. Frequent tokens are dealt into
sub-classes, as many as the size of the set asks for, so a set has about as many combinations as
prefix tokens. Documents that share a signature are verified on their whole sets.

1. Every task packs its documents' tokens into one binary block per token partition. A token that
   a task itself sees in more than ``RARE`` documents is frequent, whatever the others see: its
   occurrences skip the token partition, which gets one mark per task instead. So no token, however
   common, gathers its documents in one place.
2. A token partition finds the class of its tokens and passes on those in two or more sets.
3. A document partition has each set's shared tokens. A set with more unshared tokens than it may
   miss cannot have a partner; the others get their prefix and signatures.
4. Documents of a signature are connected to its smallest one; the connected clusters are the
   candidates. Small clusters are verified whole. In a large one, which chains of common passages may make
   of documents that are not alike, the documents of each signature are compared by sketches: parities of
   their hashed tokens, which can't differ in more places than the sets do. Documents whose sketches allow
   a link are connected anew, so what is not alike falls apart before any set travels.
5. What is large still is cut into blocks; blocks are first compared with some pivots, after which pairs
   of blocks that lie within one component are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.llm.common import mix, partitions_for, row_key, slices, text_bytes, texts, unused, with_keys, word_hashes, written
from cellwatch.llm.components import components

WORDS = 5                  # words of a shingle
PERCENT = 75               # similarity that links, in percent
RARE = 8                   # a token in at most so many sets is rare
FLUSH = 1_000_000          # tokens that a task packs at a time
PARTITION_BYTES = 16 << 20     # text whose tokens one token partition holds, at about
BLOCK = 1000               # documents that are compared at a time
PIVOTS = 16                # documents of a large cluster that all its others are compared with first
SKETCH_BITS = 1024         # parities of a sketch
SKETCHES = 4096            # sketches of a signature that are compared at a time
TASK_SKETCHES = 50_000     # sketches that a task compares, at about
_M = np.uint64(0xD1342543DE82EF95)
_SALT = np.uint64(0x2545F4914F6CDD1D)


# ---------------------------------------------------------------- sets

def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text of a slice, sorted, one after another; set sizes."""
    docs = len(offsets) - 1
    words, owner = word_hashes(raw, offsets)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(docs, np.int64)
    n_words = np.bincount(owner, minlength=docs)
    first = np.cumsum(n_words) - n_words
    n = np.where(n_words > 0, np.maximum(n_words - WORDS + 1, 1), 0)
    of = np.repeat(np.arange(docs), n)
    at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    left = n_words[of]
    tokens = np.minimum(left, WORDS).astype(np.uint64) * _SALT
    for k in range(WORDS):
        tokens = tokens * _M
        tokens += np.where(k < left, words[np.minimum(at + k, len(words) - 1)], np.uint64(0))
    tokens = mix(tokens)
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
    return tokens[keep], np.bincount(of[keep], minlength=docs)


def set_keys(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 128-bit digest of each set (two columns); equal sets have equal keys."""
    keys = np.zeros((len(sizes), 2), np.uint64)
    if len(tokens):
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        keys[sizes > 0, 0] = np.add.reduceat(mix(tokens + _SALT), starts)
        keys[sizes > 0, 1] = np.add.reduceat(mix(tokens ^ _M), starts)
    return keys


def _sliced_sets(batch: pa.RecordBatch, limit: int = 2 << 20):
    column = batch.column(batch.schema.get_field_index("text"))
    _, offsets = text_bytes(column)
    for a, b in slices(np.diff(offsets), limit):
        tokens, sizes = shingle_sets(*text_bytes(column.slice(a, b - a)))
        yield a, b, tokens, sizes, set_keys(tokens, sizes)


def _document_keys(*more: str):
    def run(batches):
        for batch in batches:
            for a, b, _, sizes, keys in _sliced_sets(batch):
                keys = keys.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sizes),
                     *(c.slice(a, b - a) for c in batch.columns[2:])], ["doc_id", "k1", "k2", "n", *more])
    return run


# ---------------------------------------------------------------- packed blocks

def _pack(keys: np.ndarray, n: np.ndarray, counts: np.ndarray, tokens: np.ndarray, classes=None) -> bytes:
    """Documents (key, set size, number of tokens here) and their tokens, as bytes."""
    head = np.array([len(keys), len(tokens), classes is not None], np.int64)
    parts = [head, np.ascontiguousarray(keys), n.astype(np.uint32), counts.astype(np.uint32), tokens]
    return b"".join(p.tobytes() for p in parts) + (b"" if classes is None else classes.astype(np.uint8).tobytes())


def _unpack(data: bytes):
    docs, total, has = np.frombuffer(data, np.int64, 3).tolist()
    at = 24
    keys = np.frombuffer(data, np.uint64, 2 * docs, at).reshape(-1, 2)
    n = np.frombuffer(data, np.uint32, docs, at := at + 16 * docs)
    counts = np.frombuffer(data, np.uint32, docs, at := at + 4 * docs)
    tokens = np.frombuffer(data, np.uint64, total, at := at + 4 * docs)
    classes = np.frombuffer(data, np.uint8, total, at + 8 * total) if has else None
    return keys, n, counts, tokens, classes


def _deal(keys, n, owner, tokens, dest, parts, classes=None):
    """(destination, packed block) for every destination that gets a token.

    ``owner`` is the row of ``keys`` each token belongs to.
    """
    order = np.lexsort((owner, dest))
    dest, owner, tokens = dest[order], owner[order], tokens[order]
    classes = None if classes is None else classes[order]
    ends = np.searchsorted(dest, np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(ends)).tolist():
        a, b = ends[p], ends[p + 1]
        rows, counts = np.unique(owner[a:b], return_counts=True)
        yield p, _pack(keys[rows], n[rows], counts, tokens[a:b], None if classes is None else classes[a:b])


def _distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first row of every distinct key, and each row's number among them."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.append(True, (keys[order][1:] != keys[order][:-1]).any(axis=1))
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


_TOKENS, _MARKS, _FREQUENT = 0, 1, 2
_ROW = "part int, kind int, bucket int, data binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, kind, bucket, data = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                                       pa.array(bucket, pa.int32()), pa.array(data, pa.binary())],
                                      ["part", "kind", "bucket", "data"])


def _part_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys[:, 0] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _blocks(parts: int):
    """Map side: blocks of tokens by token partition; frequent ones by document partition."""
    def flush(pending):
        keys, sizes = np.concatenate([p[0] for p in pending]), np.concatenate([p[1] for p in pending])
        tokens = np.concatenate([p[2] for p in pending])
        first, _ = _distinct_keys(keys)                   # a text leaves a task once, however often it is there
        stays = np.zeros(len(keys), bool)
        stays[first] = True
        stays &= sizes > 1
        tokens, keys, sizes = tokens[np.repeat(stays, sizes)], keys[stays], sizes[stays]
        if not len(tokens):
            return
        owner = np.repeat(np.arange(len(keys)), sizes)
        distinct, inverse, times = np.unique(tokens, return_inverse=True, return_counts=True)
        frequent = times > RARE
        direct = frequent[inverse]
        rows = [(p, _TOKENS, 0, d) for p, d in
                _deal(keys, sizes, owner[~direct], tokens[~direct], _part_of(tokens[~direct], parts), parts)]
        marks = distinct[frequent]
        to = _part_of(marks, parts)
        rows += [(p, _MARKS, 0, marks[to == p].tobytes()) for p in np.unique(to).tolist()]
        bucket = _bucket_of(keys, parts)[owner[direct]]
        rows += [(q, _FREQUENT, q, d) for q, d in
                 _deal(keys, sizes, owner[direct], tokens[direct], bucket, parts,
                       np.full(int(direct.sum()), RARE + 1))]
        for k in range(0, len(rows), 64):
            yield _rows(rows[k:k + 64])

    def run(batches):
        pending, held = [], 0
        for batch in batches:
            for _, _, tokens, sizes, keys in _sliced_sets(batch):
                pending.append((keys, sizes, tokens))
                held += len(tokens)
                if held >= FLUSH:
                    yield from flush(pending)
                    pending, held = [], 0
        if pending:
            yield from flush(pending)

    return run


def _gather(datas):
    """All blocks of a partition as (keys, sizes, owner, token, class) with documents numbered once."""
    got = [_unpack(d) for d in datas]
    keys = np.concatenate([g[0] for g in got])
    sizes = np.concatenate([g[1] for g in got]).astype(np.int64)
    counts = np.concatenate([g[2] for g in got])
    tokens = np.concatenate([g[3] for g in got])
    classes = np.concatenate([g[4] for g in got]) if got[0][4] is not None else None
    first, number = _distinct_keys(keys)
    return keys[first], sizes[first], np.repeat(number, counts), tokens, classes


def _classify(parts: int):
    """Token partition: pass on the tokens of two or more sets, with their class."""
    def run(key, table):
        part = key[0].as_py()
        kinds = np.array(table.column("kind").to_pylist())
        data = table.column("data").to_pylist()
        rows = [(part, _FREQUENT, b, d) for k, b, d in
                zip(kinds.tolist(), table.column("bucket").to_pylist(), data) if k == _FREQUENT]
        own = [d for k, d in zip(kinds.tolist(), data) if k == _TOKENS]
        if own:
            marks = np.unique(np.concatenate([np.zeros(0, np.uint64), *(
                np.frombuffer(d, np.uint64) for k, d in zip(kinds.tolist(), data) if k == _MARKS)]))
            keys, sizes, owner, tokens, _ = _gather(own)
            order = np.lexsort((owner, tokens))
            tokens, owner = tokens[order], owner[order]
            new = np.ones(len(tokens), bool)              # one text may come from many tasks
            new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
            tokens, owner = tokens[new], owner[new]
            starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            times = np.diff(np.append(starts, len(tokens)))
            times[np.isin(tokens[starts], marks, assume_unique=True)] = RARE + 1
            per = np.repeat(np.minimum(times, RARE + 1), np.diff(np.append(starts, len(tokens))))
            keep = per > 1
            owner, tokens, per = owner[keep], tokens[keep], per[keep]
            rows += [(part, _TOKENS, q, d) for q, d in
                     _deal(keys, sizes, owner, tokens, _bucket_of(keys, parts)[owner], parts, per)]
        return pa.Table.from_batches([_rows(rows)] if rows else [], _ARROW_ROW)
    return run


_ARROW_ROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary())])


# ---------------------------------------------------------------- prefixes

def signatures(n: int, classes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Signatures of a set of ``n`` tokens, given its shared ones; empty if it can have no partner.

    Shared tokens are those of two or more sets, with their number of sets (RARE + 1 and more:
    frequent); the other tokens come first in the order.
    """
    may_miss = n - -(-n * PERCENT // 100)
    need = may_miss + 1 - (n - len(tokens))
    if n < 2 or need <= 0:
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, classes))
    tokens, rare = tokens[order], int((classes <= RARE).sum())
    if rare >= need:
        return mix(tokens[:need])
    out, need, frequent = [mix(tokens[:rare])], need - rare, tokens[rare:]
    band = n.bit_length() - 1
    for scheme in (band, band + 1):
        # A partner has at most n * 100 / PERCENT tokens; the larger one's band is the pair's.
        if scheme > band and n * 100 // PERCENT < 1 << scheme:
            continue
        sub = mix(frequent + _SALT) % np.uint64(max(1, (1 << scheme) // 8))
        first = np.zeros(len(sub), bool)
        first[np.unique(sub, return_index=True)[1]] = True
        end = int(np.searchsorted(np.cumsum(~first), need)) + 1
        own = np.argsort(sub[:end], kind="stable")
        s, t = sub[:end][own], frequent[:end][own]
        for step in range(1, end):
            same = s[step:] == s[:-step]
            if not same.any():
                break
            out.append(mix(t[:-step][same] * _M + mix(t[step:][same]) + np.uint64(scheme)))
    return np.concatenate(out)


def _prefixes(key, table):
    """Document partition: sets that can have a partner, with their shared tokens and signatures."""
    keys, sizes, owner, tokens, classes = _gather(table.column("data").to_pylist())
    order = np.lexsort((tokens, owner))
    owner, tokens, classes = owner[order], tokens[order], classes[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    owner, tokens, classes = owner[new], tokens[new], classes[new]
    ends = np.searchsorted(owner, np.arange(len(keys) + 1))
    rows = [], [], [], [], [], []
    may = sizes - -(-sizes * PERCENT // 100) + 1 > sizes - np.diff(ends)
    for d in np.flatnonzero(may & (sizes > 1)).tolist():
        a, b = ends[d], ends[d + 1]
        sigs = signatures(int(sizes[d]), classes[a:b], tokens[a:b])
        if len(sigs):
            for column, value in zip(rows, ((key[0].as_py() << 32) + d, *keys[d].view(np.int64).tolist(),
                                            int(sizes[d]), tokens[a:b].tobytes(), sigs.view(np.int64))):
                column.append(value)
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(rows, kinds)], ["id", "k1", "k2", "n", "tokens", "signatures"])


# ---------------------------------------------------------------- verification

def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def link_sets(ids, sizes, tokens: list[np.ndarray], group, side=None) -> list[tuple[int, int]]:
    """Links that connect documents of different groups, enough of them to connect all that are linked.

    All pairs are compared on whole sets through an inverted index; pairs that are connected
    already are left out, as are pairs of one side where ``side`` (0 or 1) is given.
    """
    m = len(ids)
    lengths = np.fromiter(map(len, tokens), np.int64, m)
    flat = np.concatenate([*tokens, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(m), lengths)
    _, number = np.unique(flat, return_inverse=True)
    by_token = np.argsort(number, kind="stable")
    posting = owner[by_token]
    bounds = np.searchsorted(number[by_token], np.arange(number.max() + 2 if len(number) else 1))
    ends = np.cumsum(lengths)
    seen: dict[int, int] = {}
    parent = [seen.setdefault(int(g), i) for i, g in enumerate(group)]
    links = []
    sizes = np.asarray(sizes, np.int64)
    for i in range(m):
        if side is not None and side[i]:
            continue
        mine = number[ends[i] - lengths[i]:ends[i]]
        reach = [posting[bounds[t]:bounds[t + 1]] for t in mine.tolist()]
        if not reach:
            continue
        common = np.bincount(np.concatenate(reach), minlength=m)
        good = 100 * common >= PERCENT * (sizes[i] + sizes - common)
        good[:i + 1 if side is None else 0] = False
        good[i] = False
        for j in np.flatnonzero(good).tolist():
            if side is not None and not side[j]:
                continue
            a, b = _find(parent, i), _find(parent, j)
            if a != b:
                parent[b] = a
                links.append((int(ids[i]), int(ids[j])))
    return links


def _link_table(links) -> pa.Table:
    return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
                    ["a", "b"])


def _link_clusters(key, table):
    """Links of all (small) clusters of a group."""
    cluster = table.column("cluster").to_numpy()
    table = table.take(pa.array(np.argsort(cluster, kind="stable")))
    cluster = table.column("cluster").to_numpy()
    ids, sizes = table.column("id").to_numpy(), table.column("n").to_numpy()
    starts = np.flatnonzero(np.append(True, cluster[1:] != cluster[:-1]))
    links = []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(cluster)]):
        tokens = [np.frombuffer(t, np.uint64) for t in table.column("tokens").slice(a, b - a).to_pylist()]
        links += link_sets(ids[a:b], sizes[a:b], tokens, ids[a:b])
    return _link_table(links)


def _link_blocks(key, table):
    """Links between the two blocks of a pair (or within one block, where both are the same)."""
    side = table.column("side").to_numpy()
    tokens = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
    return _link_table(link_sets(table.column("id").to_numpy(), table.column("n").to_numpy(), tokens,
                                 table.column("root").to_numpy(), None if (side == 2).all() else side))


def _compare(sets: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links ``a, b`` of block pairs. members: id, root, block; pairs: left, right (block numbers)."""
    numbered = pairs.select(F.struct("left", "right").alias("pair"), "left", "right")
    ends = numbered.where("left <> right")
    wanted = (ends.select("pair", F.col("left").alias("block"), F.lit(0).alias("side"))
              .union(ends.select("pair", F.col("right").alias("block"), F.lit(1).alias("side")))
              .union(numbered.where("left = right").select("pair", F.col("left").alias("block"), F.lit(2).alias("side"))))
    rows = members.join(wanted, "block").join(sets.select("id", "n", "tokens"), "id")
    return rows.groupBy("pair").applyInArrow(_link_blocks, "a bigint, b bigint")


def _link_large(sets: DataFrame, large: DataFrame) -> DataFrame:
    """Links of clusters that are too large for one task. large: id, cluster, members."""
    spread = lambda parts: F.pmod(F.xxhash64("id"), F.ceil(parts).cast("long"))
    block = large.select("id", "cluster", F.col("id").alias("root"), F.xxhash64(
        "cluster", spread(F.col("members") / BLOCK)).alias("block"), "members")
    pivots = block.where(F.pmod(F.xxhash64("id", F.lit(1)), F.ceil(F.col("members") / PIVOTS)) == 0).select(
        "id", "cluster", "root", F.xxhash64("cluster", F.lit("pivots")).alias("block"))
    plain = block.select("id", "cluster", "root", "block")
    first = written(_compare(sets, plain.select("id", "root", "block").union(pivots.select("id", "root", "block")),
                             plain.select("cluster", F.col("block").alias("right")).distinct().join(
                                 pivots.select("cluster", F.col("block").alias("left")).distinct(), "cluster")), "pivots")
    # What the pivots connected needs no more comparing: its blocks are kept apart from the rest.
    known = written(components(first), "pivot-components")
    rooted = block.drop("root", "block").join(known, "id", "left").select(
        "id", "cluster", "members", F.coalesce("root", "id").alias("root"))
    weight = rooted.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("together"))
    rooted = rooted.join(weight, ["cluster", "root"])
    whole = F.when(2 * F.col("together") >= BLOCK, F.col("root"))
    rest = rooted.where(2 * F.col("together") < BLOCK).groupBy("cluster").agg(F.count(F.lit(1)).alias("rest"))
    again = written(rooted.join(rest, "cluster", "left").select("id", "cluster", "root", whole.alias("whole"), F.when(
        whole.isNotNull(), F.xxhash64("cluster", "root", spread(F.col("together") / BLOCK))).otherwise(
        F.xxhash64("cluster", spread(F.col("rest") / BLOCK))).alias("block")), "blocks")
    blocks = again.select("cluster", "block", "whole").distinct()
    pairs = (blocks.select("cluster", F.col("block").alias("left"), F.col("whole").alias("w"))
             .join(blocks.select("cluster", F.col("block").alias("right"), "whole"), "cluster")
             .where("left <= right AND NOT coalesce(w = whole, false)"))
    return first.union(_compare(sets, again.select("id", "root", "block"), pairs.select("left", "right")))


# ---------------------------------------------------------------- sketches

def sketches(owner: np.ndarray, tokens: np.ndarray, docs: int) -> np.ndarray:
    """For every document, which hashed token classes hold an odd number of its tokens, as 64-bit words.

    A token that one of two sets lacks changes one place, so sketches differ in at most as many places as sets.
    """
    at = owner * SKETCH_BITS + (tokens % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = (np.bincount(at, minlength=docs * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(docs, SKETCH_BITS), axis=1).view(np.uint64)


def _sketch_rows(batches):
    for batch in batches:
        ids, sizes, column = batch.columns
        tokens = [np.frombuffer(t, np.uint64) for t in column.to_pylist()]
        for a, b in slices(np.fromiter(map(len, tokens), np.int64, len(tokens)) + SKETCH_BITS, FLUSH):
            counts = np.fromiter(map(len, tokens[a:b]), np.int64, b - a)
            made = sketches(np.repeat(np.arange(b - a), counts), np.concatenate(tokens[a:b]), b - a)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), sizes.slice(a, b - a), pa.array(sizes.slice(a, b - a).to_numpy() - counts),
                 pa.array([row.tobytes() for row in made], pa.binary())], ["id", "n", "lone", "sketch"])


def sketch_forest(n: np.ndarray, lone: np.ndarray, sketch: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect all documents between which a link is possible by size, lone tokens and sketch.

    ``lone`` tokens are in no other set. A document is compared only with those that are not connected
    to an earlier one yet, so a group of near copies costs about its size.
    """
    edges, left = [], np.arange(len(n))
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            allowed = (n[left] + n[x]) * (100 - PERCENT) // (100 + PERCENT)     # places in which alike sets may differ
            differ = np.maximum(np.abs(n[left] - n[x]), lone[left] + lone[x])
            near = np.flatnonzero(differ <= allowed)
            if not len(near):
                continue
            places = np.bitwise_count(sketch[left[near]] ^ sketch[x]).sum(axis=1, dtype=np.int64)
            near = near[places + lone[left[near]] + lone[x] <= allowed[near]]
            found = left[near].tolist()
            edges += [(x, y) for y in found]
            queue += found
            left = np.delete(left, near)
    return edges


def _connect_sketches(key, table):
    """Edges of all (signature, part, part) groups of a task."""
    group = [table.column(c).to_numpy() for c in ("signature", "lo", "hi")]
    order = np.lexsort(group)
    new = np.zeros(len(order), bool)
    for column in group:
        new[1:] |= column[order][1:] != column[order][:-1]
    ids, n, lone = (table.column(c).to_numpy()[order] for c in ("id", "n", "lone"))
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(order), -1)[order]
    starts = [0, *np.flatnonzero(new).tolist(), len(order)]
    edges = [(int(ids[a + x]), int(ids[a + y])) for a, b in zip(starts, starts[1:])
             for x, y in sketch_forest(n[a:b], lone[a:b], sketch[a:b])]
    return _link_table(set(edges))


def _refined(sets: DataFrame, posting: DataFrame, shared: DataFrame, large: DataFrame) -> DataFrame:
    """``id, cluster``: the documents of large clusters that may have a link, connected by sketches.

    posting: id, signature; shared: signature, m, d1, d2 (digests of its documents); large: id. Signatures of the
    same documents are looked at once. A signature of more than SKETCHES documents is cut into parts, and
    its parts are compared two by two.
    """
    within = posting.join(large, "id", "left_semi")
    chosen = shared.join(within.select("signature").distinct(), "signature", "left_semi").groupBy("m", "d1", "d2").agg(
        F.min("signature").alias("signature")).withColumn("parts", F.ceil(F.col("m") / SKETCHES)).select(
        "signature", "m", "parts")
    chosen = written(chosen, "signatures")
    total = chosen.agg(F.sum(F.col("m") * F.greatest(F.lit(1), F.col("parts") - 1))).first()[0] or 0
    groups = max(1, -(-total // TASK_SKETCHES))
    made = written(sets.select("id", "n", "tokens").join(large, "id", "left_semi").mapInArrow(
        _sketch_rows, "id bigint, n bigint, lone bigint, sketch binary"), "sketches")
    own = F.pmod(F.xxhash64("id", F.lit(2)), F.col("parts"))
    rows = within.join(chosen, "signature").withColumn("own", own).withColumn("other", F.explode(F.expr(
        "CASE WHEN parts = 1 THEN array(0L) ELSE filter(sequence(0L, parts - 1), p -> p <> own) END"))).select(
        "id", "signature", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    rows = rows.join(made, "id").withColumn("g", F.pmod(F.xxhash64("signature", "lo", "hi"), F.lit(groups)))
    edges = rows.groupBy("g").applyInArrow(_connect_sketches, "a bigint, b bigint")
    return components(edges).select("id", F.col("root").alias("cluster"))


# ---------------------------------------------------------------- operator

def candidate_sets(docs: DataFrame, parts: int) -> DataFrame:
    """``id, k1, k2, n, tokens, signatures`` of the distinct sets that may have a partner."""
    blocks = texts(docs).mapInArrow(_blocks(parts), _ROW)
    shared = blocks.groupBy("part").applyInArrow(_classify(parts), _ROW)
    return shared.groupBy("bucket").applyInArrow(
        _prefixes, "id bigint, k1 bigint, k2 bigint, n bigint, tokens binary, signatures array<bigint>")


def _sized(cluster: DataFrame) -> DataFrame:
    size = cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    return written(cluster.join(size, "cluster"), "clusters")


def clusters(sets: DataFrame) -> DataFrame:
    """``id, cluster, members`` of the sets that may have a link: only sets of one cluster may be linked."""
    posting = sets.select("id", F.explode("signatures").alias("signature"))
    shared = written(posting.groupBy("signature").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("id")).alias("d1"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("d2")).where("m > 1"), "shared")
    star = posting.join(shared.select("signature", "least"), "signature").where("id <> least").select(
        F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    found = _sized(components(star).select("id", F.col("root").alias("cluster")))
    large = found.where(F.col("members") > BLOCK).select("id")
    if large.isEmpty():
        return found
    fine = _refined(sets, posting, shared.drop("least"), large)
    return _sized(found.where(F.col("members") <= BLOCK).select("id", "cluster").union(fine.select("id", "cluster")))


def links(sets: DataFrame) -> DataFrame:
    """``a, b``: links between ids of ``sets`` that connect all that are linked (written tables)."""
    cluster = clusters(sets)
    facts = cluster.agg(F.count_if(F.col("members") <= BLOCK).alias("small"),
                        F.count_if(F.col("members") > BLOCK).alias("large")).first()
    groups = max(1, facts["small"] // BLOCK)
    found = (sets.select("id", "n", "tokens").join(cluster.where(F.col("members") <= BLOCK), "id")
             .groupBy(F.pmod(F.xxhash64("cluster"), F.lit(groups)).alias("g")).applyInArrow(
                 _link_clusters, "a bigint, b bigint"))
    if facts["large"]:
        found = found.union(_link_large(sets, cluster.where(F.col("members") > BLOCK)))
    return written(found, "links")


def _classes(docs: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, k1, k2, n and ``more``), and for every non-empty set (k1, k2) its component's first row.

    The first row is a struct: null_id, doc_id, then ``more``; null ids come last.
    """
    spark: SparkSession = docs.sparkSession
    source = texts(docs, *more)
    rest = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    rows = written(source.mapInArrow(_document_keys(*more), "doc_id bigint, k1 bigint, k2 bigint, n bigint" + rest), "keys")
    parts = partitions_for(source, "text", PARTITION_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sets = written(candidate_sets(docs, parts), "sets")
    roots = components(links(sets))
    known = written(sets.select("id", "k1", "k2").join(roots, "id").select("k1", "k2", "root"), "roots")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", *more)).alias("first")
    classes = rows.where("n > 0").groupBy("k1", "k2").agg(first)
    classes = written(classes.join(known, ["k1", "k2"], "left"), "classes")
    joined = classes.where("root IS NOT NULL")
    by_root = joined.groupBy("root").agg(F.min("first").alias("first"))
    named = joined.drop("first").join(by_root, "root").select("k1", "k2", "first").union(
        classes.where("root IS NULL").select("k1", "k2", "first"))
    return rows, written(named, "named")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    ``n_shingles`` is the size of the row's set of distinct 5-word shingles (A-Z lower-cased; with
    fewer words the whole sequence is one; null or no words: 0). ``component_id`` is the smallest
    doc_id reachable over links of at least 75 % Jaccard similarity, the row's own included; equal
    sets are linked, empty ones with nothing. Nulls are not compared: a null doc_id takes the
    smallest doc_id of its component, null if there is none. Repeated rows give repeated results;
    an empty table gives none; other columns are not read.
    """
    rows, named = _classes(docs)
    # Both sides are plain scans: a text with a third of the rows is split by the skew join.
    joined = rows.where("n > 0").join(named, ["k1", "k2"])
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id")).union(
        rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: one of every component, all without a word.

    It is the row with the smallest doc_id (a null one only if there is no other); of several rows
    with that id one stays. A row is known by its doc_id and text, so of fully repeated rows one stays.
    """
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, row_key())
    rows, named = _classes(keyed.select("doc_id", "text", F.col(key).alias("row")), "row")
    stays = written(named.select("first.row").union(rows.where("n = 0").select("row")).distinct(), "stays")
    return with_keys(keyed, key, stays.select(F.col("row").alias(key))).select(*docs.columns)


ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM words
  UNION SELECT l.a, reach.r FROM reach JOIN links l ON l.b = reach.doc_id)
SELECT words.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id
FROM words JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY words.doc_id
"""
