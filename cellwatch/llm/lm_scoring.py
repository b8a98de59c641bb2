"""Language-model scores from a hierarchical Pitman-Yor model of words.

Every context (the word before, or a text's start; a 64-bit hash) is a restaurant whose dishes
are words; all restaurants share one parent, the word restaurant, whose base is uniform over the
known words and one unknown. ``P(w|u) = (c_uw - d t_uw + (theta + d T_u) P0(w)) / (theta + c_u)``
with customers c and tables t; the parent's customers are the tables of its children. Seating is
sampled by Gibbs sweeps: a dish's customers all leave and are seated again, by a number of tables drawn
from its exact conditional (``Seating``), in the contexts and in the parent. The predictive
probabilities of several samples are averaged.

The work is dealt by word. A word's counts in all contexts lie in one partition, which also has
every occurrence's text, so tokens are exchanged once. Words with a large share of all tokens (at
most ``2 * HOT_SHARE`` of them, by construction) are dealt by word and context. Pairs of a context and
a word with as large a share (as few) are dealt by text: the driver seats each once, from the sum of
its customers, and broadcasts the probabilities. Partitions tell each
other only the restaurants' totals, a table summed by context and given back to the partitions. First every partition samples with its
own share of these as an estimate; the totals are summed; then it samples on with the true totals
and scores its occurrences, as one Gibbs sweep after another over parallel blocks.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import mix, partitions_for, settings, shuffles_removed, slices, small_batches, text_bytes, texts, word_hashes, written
from cellwatch.llm.language_id import held_out

HOT_SHARE = 1024           # a word with more than 1 / (2 HOT_SHARE) of all tokens is hot; with more partitions, of 1 / (2 partitions)
FLUSH = 1_000_000          # tokens that a task packs at a time
PARTITION_BYTES = 10 << 20     # text whose tokens one partition holds, at about
TOGETHER = 4               # partitions that are scored one after another by one task
PIECE = 192 << 10          # bytes of a model that a row holds: Spark copies and doubles rows on its heap
BATCH_BYTES = 4 << 20      # of packed blocks or pieces that travel between Spark and Python at a time
DISCOUNT, STRENGTH = 0.75, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.5, 10.0
BURN, SAMPLES = 2, 3
SEED = 7
_END, _START = np.uint64(0x0DDBA11CAFEF00D5), np.uint64(0x5EEDC0DE12345677)
_SALT = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens (word hashes, then an end) of all texts of a slice, their contexts and texts."""
    words, owner = word_hashes(raw, offsets)
    docs = len(offsets) - 1
    n = np.bincount(owner, minlength=docs) + 1
    ends = np.cumsum(n) - 1
    out = np.empty(int(n.sum()), np.uint64)
    out[ends] = _END
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = words
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[ends - n + 1] = _START
    return out, mix(before ^ _SALT), np.repeat(np.arange(docs), n)


# ---------------------------------------------------------------- packing

def _pack(**arrays) -> bytes:
    """Named number arrays as compressed bytes: steps instead of 64-bit integers (short where these are sorted),
    and the first bytes of all numbers, then the second ones, and so on. One array is copied at a time."""
    arrays = {name: np.ascontiguousarray(a) for name, a in arrays.items()}
    line = ";".join(f"{name}:{a.dtype.str}:{len(a)}" for name, a in arrays.items()).encode()
    packer = zstandard.ZstdCompressor(level=1).compressobj(size=4 + len(line) + sum(a.nbytes for a in arrays.values()))
    out = [packer.compress(len(line).to_bytes(4, "little") + line)]
    for a in arrays.values():
        if a.dtype.kind in "iu" and a.itemsize == 8:
            a = np.diff(a.view(np.uint64), prepend=np.uint64(0))     # wraps, and so does the sum
        out.append(packer.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()))
    return b"".join([*out, packer.flush()])


def _unpack(data) -> dict[str, np.ndarray]:
    """The arrays of some packed bytes, unpacked one after another."""
    reader = zstandard.ZstdDecompressor().stream_reader(data)
    out = {}
    for part in reader.read(int.from_bytes(reader.read(4), "little")).decode().split(";"):
        name, kind, n = part.rsplit(":", 2)
        kind, n = np.dtype(kind), int(n)
        a = np.frombuffer(reader.read(n * kind.itemsize), np.uint8).reshape(kind.itemsize, n)
        a = np.ascontiguousarray(a.T).view(kind).reshape(n)
        out[name] = np.cumsum(a.view(np.uint64)).view(kind) if kind.kind in "iu" and kind.itemsize == 8 else a
    return out


def _pair(token: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Hash of a word in a context."""
    return mix(token + context * _SALT)


def _among(values: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every value in the sorted ``few``, and whether it is there."""
    at = np.minimum(np.searchsorted(few, values), max(len(few) - 1, 0))
    return at, (few[at] == values if len(few) else np.zeros(len(values), bool))


def _pieces(n: int, most: int = 1 << 18) -> list[slice]:
    """Slices of ``n`` items, for work whose steps then need memory by a slice only."""
    return [slice(a, min(a + most, n)) for a in range(0, n, most)]


def _runs(x: np.ndarray) -> np.ndarray:
    """Start of every run of equal values."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


# ---------------------------------------------------------------- pass 1: texts and hot words

def _measure(batches, hot_share: int = HOT_SHARE):
    """Token count of every text, and the words and pairs with a large share of this task's tokens."""
    frequent = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * 2
    total = 0
    for batch in batches:
        _, offsets = text_bytes(batch.column(1))
        for a, b in slices(np.diff(offsets), 2 << 20):
            token, context, owner = tokens_of(*text_bytes(batch.column(1).slice(a, b - a)))
            n = np.bincount(owner, minlength=b - a)
            train = batch.column(3).slice(a, b - a).to_numpy(zero_copy_only=False)
            token, context = token[train[owner]], context[train[owner]]
            total += len(token)
            for k, values in enumerate((token, _pair(token, context))):
                w, t = np.unique(values, return_counts=True)
                # Space saving: what is kept has at least its share of the tokens so far, or a slice's.
                merged, at = np.unique(np.concatenate([frequent[k][0], w]), return_inverse=True)
                sums = np.bincount(at, np.concatenate([frequent[k][1], t]), len(merged)).astype(np.int64)
                keep = sums * 4 * hot_share > total
                frequent[k] = merged[keep], sums[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n.astype(np.int64)),
                 pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.bool_())],
                ["doc_id", "key", "n", "word", "times", "pair"])
    (words, times), (pairs, pair_times) = frequent
    k = len(words) + len(pairs)
    yield pa.RecordBatch.from_arrays([pa.nulls(k + 1, pa.int64())] * 3 + [
        pa.array([*words.view(np.int64).tolist(), *pairs.view(np.int64).tolist(), None], pa.int64()),
        pa.array([*times.tolist(), *pair_times.tolist(), total], pa.int64()),
        pa.array([False] * len(words) + [True] * len(pairs) + [None], pa.bool_())],
        ["doc_id", "key", "n", "word", "times", "pair"])


# ---------------------------------------------------------------- pass 2: occurrences by word

def _occurrences(parts: int, hot: np.ndarray, hot_pairs: np.ndarray):
    """Blocks of occurrences for the partition of each word (hot words: of word and context; hot pairs: of text).

    A block names a text once for each pair, with the number of times it holds it, and every context once.
    """
    def flush(pending):
        keys = np.concatenate([p[0] for p in pending])
        weight = np.concatenate([p[1] for p in pending])
        token = np.concatenate([p[2] for p in pending])
        context = np.concatenate([p[3] for p in pending])
        owner = np.concatenate([p[4] + s for p, s in zip(
            pending, np.cumsum([0, *(len(p[0]) for p in pending[:-1])]))]).astype(np.int32)
        pending.clear()                     # each array of tokens is held once
        first, number = np.unique(keys, return_index=True, return_inverse=True)[1:]
        weight = np.bincount(number, weight, len(first)).astype(np.int64)   # copies in the training set
        keep = np.zeros(len(keys), bool)
        keep[first] = True
        keys, keep = keys[first], keep[owner]
        token, context, owner = token[keep], context[keep], number.astype(np.int32)[owner[keep]]
        del keep
        dest = mix(token)
        pair = _pair(token, context)
        is_hot = _among(token, hot)[1]
        dest[is_hot] = pair[is_hot]
        is_hot = _among(pair, hot_pairs)[1]
        dest[is_hot] = mix(keys.view(np.uint64)[owner[is_hot]] ^ pair[is_hot])
        del pair, is_hot
        dest = (dest % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((owner, context, token, dest))
        dest, token, context, owner = dest[order], token[order], context[order], owner[order]
        del order
        new = np.ones(len(dest), bool)
        new[1:] = (dest[1:] != dest[:-1]) | (token[1:] != token[:-1]) | (context[1:] != context[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        often = np.diff(np.append(first, len(dest)))
        dest, token, context, owner = dest[first], token[first], context[first], owner[first]
        ends = np.append(_runs(dest), len(dest))
        rows = []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            w, c, o, times = token[a:b], context[a:b], owner[a:b], often[a:b]
            more = np.flatnonzero(times > 1)
            kinds = _runs(w), np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1])))
            here, local = np.unique(o, return_inverse=True)
            contexts, number_of = np.unique(c[kinds[1]], return_inverse=True)
            rows.append((int(dest[a]), _pack(
                word=w[kinds[0]], types=np.diff(np.append(np.searchsorted(kinds[1], kinds[0]), len(kinds[1]))).astype(np.uint32),
                contexts=contexts, context=number_of.astype(np.uint32), refs=np.diff(np.append(kinds[1], len(w))).astype(np.uint32),
                ref=local.astype(np.uint16), more=more.astype(np.uint32), times=times[more].astype(np.uint32), key=keys[here], weight=weight[here].astype(np.uint32))))
        for a, b in slices(np.array([len(d) for _, d in rows]), BATCH_BYTES):
            p, d = zip(*rows[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(d, pa.binary())], ["part", "data"])

    def run(batches):
        pending, held, docs = [], 0, 0
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for a, b in slices(np.diff(offsets), 2 << 20):
                for a2, b2 in ((x, min(x + 20_000, b)) for x in range(a, b, 20_000)):
                    token, context, owner = tokens_of(*text_bytes(batch.column(1).slice(a2, b2 - a2)))
                    pending.append((batch.column(2).slice(a2, b2 - a2).to_numpy(),
                                    batch.column(3).slice(a2, b2 - a2).to_numpy(zero_copy_only=False).astype(np.int64),
                                    token, context, owner))
                    held += len(token)
                    docs += b2 - a2
                    if held >= FLUSH or docs >= 40_000:
                        yield from flush(pending)
                        pending, held, docs = [], 0, 0
        if pending:
            yield from flush(pending)

    return run


# ---------------------------------------------------------------- seating

class Ratios:
    """Ratios of generalised Stirling numbers, S(n, t + 1) / S(n, t), for one discount.

    S(n, t) sums the weights of all ways to seat n customers of a dish at t tables. The ratios follow a
    stable recursion in n. They are kept for every n up to ``EXACT``, for n 3 % apart up to ``LAST``, and carried
    on beyond: f(n, t) = S(n, t) t! d^t depends on t / n^d alone as n grows, so
    log(f(t + 1) / f(t)) / log((t + 1) / t) is read at the same t / n^d.
    """

    EXACT, LAST, TABLES = 64, 1 << 15, 1 << 13

    def __init__(self, discount: float):
        self.d = discount
        grid = list(range(2, self.EXACT + 1))
        while grid[-1] < self.LAST:
            grid.append(min(self.LAST, max(grid[-1] + 1, int(grid[-1] * 1.03))))
        self.grid = np.array(grid)
        wanted, rows = set(grid), []
        t = np.arange(1.0, self.TABLES + 1)
        v = np.zeros(self.TABLES)                        # v[t - 1] = S(n, t + 1) / S(n, t), 0 from t = n on
        steps = np.log((t + 1) / t)
        for n in range(1, self.LAST):
            k = min(n, self.TABLES)
            below = n - discount * t[:k]
            below[1:] += 1 / v[:k - 1]
            v[:k] = (1 + (n - discount * (t[:k] + 1)) * v[:k]) / below
            if n + 1 in wanted:
                k = min(n, self.TABLES)
                rows.append(np.log(v[:k] * (t[:k] + 1) * discount) / steps[:k])
        self.rows = rows

    def log_ratio(self, row: int, n: np.ndarray, tables: int) -> np.ndarray:
        """log S(n, t + 1) / S(n, t) for t = 1 .. tables - 1, of customers ``n`` that belong to a row of the grid."""
        t = np.arange(1.0, tables)
        kept = self.rows[row]
        known = int(self.grid[row])
        if known <= self.EXACT or (n == known).all():
            k = np.append(kept, np.full(max(0, tables - 1 - len(kept)), kept[-1]))[None, :tables - 1]
        else:
            at = (known / n[:, None]) ** self.d * t[None, :] - 1
            k = np.interp(at.ravel(), np.arange(len(kept)), kept).reshape(at.shape)
        out = k * np.log((t + 1) / t) - np.log((t + 1) * self.d)
        return np.where(t[None, :] >= n[:, None], -np.inf, out)


@lru_cache(4)
def ratios(discount: float) -> Ratios:
    """The ratios of a discount (made once in a worker)."""
    return Ratios(discount)


class Seating:
    """Numbers of tables of dishes, sampled one dish at a time from the exact conditional.

    Given the other dishes, t tables for c customers have the weight S(c, t) times the masses of the new
    tables, (mass + slope (t - 1)) .. mass: all seatings of all the dish's customers are summed, so one draw
    is as good as any number of single customers' moves, whatever c. Dishes of one size are drawn together;
    totals are brought up to date after each size.
    """

    CELLS = 1 << 20     # weights that are drawn from one state of the totals
    AT_ONCE = 1 << 18   # weights that are held at a time

    def __init__(self, customers: np.ndarray, prior: np.ndarray, rng, discount: float, tables: np.ndarray | None = None):
        """``prior``: mass of a new table for each dish as a first estimate; ``tables``: a state to go on from."""
        self.rng, self.d, self.customers = rng, discount, customers
        self.tables = np.minimum(customers, 1).astype(np.int64)
        many = np.flatnonzero(customers > 1)
        self.ratios = ratios(discount) if len(many) else None
        if len(many):
            row = np.searchsorted(self.ratios.grid, customers[many], "right") - 1
            order = np.argsort(row, kind="stable")
            cuts = _runs(row[order])[1:]
            self.groups = list(zip(np.unique(row).tolist(), np.split(many[order], cuts)))
        else:
            self.groups = []
        if tables is not None:
            self.tables = np.array(tables, np.int64)
        else:
            self._draw_all(lambda dish: (prior[dish], 0.0))

    def _draw_all(self, masses, changed=None) -> None:
        for row, dishes in self.groups:
            for dish in np.array_split(dishes, max(1, -(-len(dishes) * 64 // self.CELLS))):
                new = self._draw(row, dish, *masses(dish))
                if changed is not None:
                    changed(dish, new - self.tables[dish])
                self.tables[dish] = new

    def _draw(self, row: int, dish: np.ndarray, mass, slope) -> np.ndarray:
        """A number of tables for each dish; the range looked at grows until the rest has no weight."""
        n = self.customers[dish]
        mass, slope = (np.broadcast_to(np.asarray(x, float), n.shape) for x in (mass, slope))
        out = np.zeros(len(dish), np.int64)
        left, size, top = np.arange(len(dish)), 64, int(n.max())
        while len(left):
            size = min(size, top)
            for part in np.array_split(left, max(1, -(-len(left) * size // self.AT_ONCE))):
                logs = np.zeros((len(part), size))
                t = np.arange(1, size)
                logs[:, 1:] = np.log(np.maximum(mass[part, None] + slope[part, None] * t, 1e-300))
                logs[:, 1:] += self.ratios.log_ratio(row, n[part], size)
                np.cumsum(logs, axis=1, out=logs)
                logs -= logs.max(axis=1, keepdims=True)
                whole = (logs[:, -1] < -45) | (n[part] <= size)
                weight = np.cumsum(np.exp(logs[whole]), axis=1)
                draw = self.rng.random(len(weight)) * weight[:, -1]
                out[part[whole]] = 1 + (weight <= draw[:, None]).sum(axis=1).clip(max=size - 1)
            left, size = left[out[left] == 0], size * 4
        return out

    def sweep(self, new_mass, slope=None) -> None:
        """Draw every dish once. ``new_mass(dishes, change)``: mass of a new table, after noting the change of
        tables; ``slope(dishes)``: what one table more in the restaurant adds to it (none: nothing)."""
        def masses(dish):
            step = slope(dish) if slope else np.zeros(len(dish))
            return np.maximum(new_mass(dish, np.zeros(len(dish), np.int64)) - step * self.tables[dish], 1e-300), step

        self._draw_all(masses, new_mass)


def _seat_words(customers: np.ndarray, total_tables: float, known: float, rng) -> np.ndarray:
    """Tables of words in the parent restaurant, given its total of tables."""
    mass = (ROOT_STRENGTH + ROOT_DISCOUNT * total_tables) / (known + 1)
    return Seating(customers, np.full(len(customers), mass), rng, ROOT_DISCOUNT).tables


class _Contexts:
    """Table totals of the context restaurants, kept up to date while dishes are seated."""

    def __init__(self, totals: np.ndarray, context: np.ndarray, p0: np.ndarray):
        self.totals, self.context, self.p0 = totals.astype(float), context.astype(np.int32), p0

    def mass(self, dish, change=None):
        at = self.context[dish]
        if change is not None:
            np.add.at(self.totals, at[change != 0], change[change != 0])
        return (STRENGTH + DISCOUNT * np.maximum(self.totals[at], 0)) * self.p0[dish]

    def slope(self, dish):
        """What one table more adds to a dish's mass."""
        return DISCOUNT * self.p0[dish]


# ---------------------------------------------------------------- model partitions

def _cut(data: bytes) -> pa.BinaryArray:
    """Packed bytes as rows of ``PIECE`` bytes (the last one shorter), without a copy."""
    ends = np.append(np.arange(0, len(data), PIECE), len(data)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _rows_by_part(batches):
    """Every part (the first column, which batches are sorted by) and its rows, as one-row tables read on demand."""
    rows = ((part, batch.slice(i, 1)) for batch in batches for i, part in enumerate(batch.column(0).to_pylist()))
    for part, own in groupby(rows, lambda r: r[0]):
        yield part, (row for _, row in own)


def _build(parts: int, hot: np.ndarray, hot_share: np.ndarray, hot_pairs: np.ndarray):
    """All occurrences of a partition's words, and a first sample of their seating: rows of ``_MODEL``, the first
    of which has the sums and totals, and each a piece of the data."""
    def run(key, table):
        part = key[0].as_py()
        blocks = [_unpack(d.as_buffer()) for d in table.column("data")]
        doc0 = np.cumsum([0, *(len(b["key"]) for b in blocks)])
        keys = np.concatenate([b["key"] for b in blocks])
        weight = np.concatenate([b["weight"] for b in blocks]).astype(np.int64)
        words, number = np.unique(np.concatenate([b["word"] for b in blocks]), return_inverse=True)
        # A kind is a word in a context: their numbers in one.
        kind = np.repeat(number.astype(np.int64) << 32, np.concatenate([b["types"] for b in blocks]))
        contexts, number = np.unique(np.concatenate([b["contexts"] for b in blocks]), return_inverse=True)
        context0 = np.cumsum([0, *(len(b["contexts"]) for b in blocks)])
        kind0 = np.cumsum([0, *(len(b["context"]) for b in blocks)])
        for b, s, k in zip(blocks, context0.tolist(), kind0.tolist()):
            kind[k:k + len(b["context"])] |= number[b["context"].astype(np.int64) + s]
        kinds, number = np.unique(kind, return_inverse=True)
        del kind
        number = np.repeat(number.astype(np.int32), np.concatenate([b["refs"] for b in blocks]))
        ref = np.concatenate([b["ref"].astype(np.int32) + s for b, s in zip(blocks, doc0.tolist())])
        often = np.ones(len(ref), np.uint32)
        ref0 = np.cumsum([0, *(len(b["ref"]) for b in blocks)])
        often[np.concatenate([b["more"] + s for b, s in zip(blocks, ref0.tolist())])] = np.concatenate(
            [b["times"] for b in blocks])
        del blocks, table
        refs, all_count = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        for x in _pieces(len(ref)):
            at = number[x].astype(np.intp)
            np.add.at(refs, at, 1)
            np.add.at(all_count, at, weight[ref[x]] * often[x])
        order = np.argsort(number, kind="stable")
        del number
        ref, often = ref[order], often[order]
        del order
        word, context = kinds >> 32, (kinds & 0xFFFFFFFF).astype(np.int32)
        del kinds
        at, is_hot = _among(words, hot)
        # The driver seats hot pairs; here they have no customers.
        pair_at, is_pair = _among(_pair(words[word], contexts[context]), hot_pairs)
        count = np.where(is_pair, 0, all_count)
        # Estimates from this partition's own words: a 1 / parts share of all but the hot ones.
        seen = count > 0
        per_word = np.bincount(word[seen], minlength=len(words)).astype(float)
        share = per_word / max(1.0, per_word[~is_hot].sum() * parts * (1 + hot_share.sum()))
        if is_hot.any():
            share[is_hot] = hot_share[at[is_hot]]
        share = np.maximum(share, 1e-12)
        totals = np.bincount(context[seen], minlength=len(contexts)) * float(parts)
        rng = np.random.default_rng([SEED, 1, part])
        room = _Contexts(totals, context, share[word])
        seating = Seating(count, room.mass(np.arange(len(count))), rng, DISCOUNT)
        np.add.at(room.totals, context, seating.tables - seen)
        for _ in range(BURN):
            seating.sweep(room.mass, room.slope)
        t = seating.tables
        del seating, room
        customers = np.bincount(word, t, len(words)).astype(np.int64)
        c_word = np.bincount(word, all_count, len(words)).astype(np.int64)
        own = ~is_hot & (c_word > 0)
        root = np.zeros(len(words), np.int64)
        root[own] = _seat_words(customers[own], float(own.sum() * parts), float(own.sum() * parts), rng)
        data = _pack(word=words, kinds=np.bincount(word, minlength=len(words)).astype(np.uint32), context=context,
                     contexts=contexts,
                     count=count.astype(np.uint32 if not len(count) or count.max() < 1 << 32 else np.int64),
                     tables=t.astype(np.uint32), refs=refs.astype(np.uint32), ref=ref, more=np.flatnonzero(often > 1),
                     times=often[often > 1], key=keys, root=root.astype(np.uint32))
        hot_rows = [{"word": int(w), "customers": int(a), "count": int(c)} for w, a, c in
                    zip(words[is_hot].view(np.int64), customers[is_hot], c_word[is_hot])]
        pair_rows = [{"pair": int(k), "word": int(w), "context": int(c), "count": int(n)} for k, w, c, n in
                     zip(pair_at[is_pair], at[word[is_pair]], contexts.view(np.int64)[context[is_pair]], all_count[is_pair])]
        totals = _pack(context=contexts, tables=np.bincount(context, t, len(contexts)).astype(np.int64),
                       counts=np.bincount(context, all_count, len(contexts)).astype(np.int64))
        data = _cut(data)
        first = lambda value, kind=None: pa.array([value] + [None] * (len(data) - 1), kind)
        return pa.table({
            "part": pa.array([part] * len(data), pa.int32()), "piece": pa.array(range(len(data)), pa.int32()), "data": data,
            "known": first(int(own.sum())), "train": first(int(all_count.sum())), "customers": first(int(customers[own].sum())),
            "root": first(int(root.sum())),
            "totals": first(totals, pa.binary()),
            "pairs": first(pair_rows, pa.list_(pa.struct([(n, pa.int64()) for n in ("pair", "word", "context", "count")]))),
            "hot": first(hot_rows, pa.list_(pa.struct(
                [("word", pa.int64()), ("customers", pa.int64()), ("count", pa.int64())])))})
    return run


def _build_sorted(build):
    """The models of some partitions, whose blocks come sorted by partition: one is held at a time."""
    def run(batches):
        for part, rows in _rows_by_part(batches):
            yield from build((pa.scalar(part, pa.int32()),), pa.Table.from_batches(rows)).to_batches(BATCH_BYTES // PIECE)
    return run


_MODEL = ("part int, piece int, data binary, known bigint, train bigint, customers bigint, root bigint, "
          "totals binary, "
          "pairs array<struct<pair:bigint,word:bigint,context:bigint,count:bigint>>, "
          "hot array<struct<word:bigint,customers:bigint,count:bigint>>")


def _sample(rng, count, word, context, seated, tables, counts, own, hot_p0, root, g) -> np.ndarray:
    """Averaged predictive probability of each dish (a word in a context), by sweeps on from ``seated``.

    ``tables`` and ``counts`` are the contexts' totals, the dishes' own tables included; ``own`` words have all
    their dishes here, ``hot_p0`` holds the parent's probability of the others (NaN: an unknown word, which
    all share one type). ``root`` is the parent's seating so far; ``g`` has the totals over all partitions. What changes here is noted at once,
    so the probabilities of a context sum to one, up to what other partitions have moved meanwhile.
    """
    n_words = len(own)
    room = _Contexts(tables, context, np.zeros(len(count)))
    seating = Seating(count, None, rng, DISCOUNT, seated)
    before = int(np.bincount(word, seating.tables, n_words)[own].sum()), int(root[own].sum())
    total = np.zeros(len(count))
    for k in range(BURN + SAMPLES):
        # The parent is seated again under its new customers, the tables of these restaurants.
        customers = np.where(own, np.bincount(word, seating.tables, n_words), 0).astype(np.int64)
        mass = (ROOT_STRENGTH + ROOT_DISCOUNT * (g["root"] - before[1] + int(root[own].sum()))) / (g["known"] + 1)
        root = Seating(customers, np.full(n_words, mass), rng, ROOT_DISCOUNT).tables
        mass = (ROOT_STRENGTH + ROOT_DISCOUNT * (g["root"] - before[1] + int(root[own].sum()))) / (g["known"] + 1)
        everyone = g["customers"] - before[0] + int(customers.sum())
        p0 = np.where(own, customers - ROOT_DISCOUNT * root + mass, mass) / (ROOT_STRENGTH + everyone)
        room.p0 = np.where(np.isnan(hot_p0), p0, hot_p0)[word]
        seating.sweep(room.mass, room.slope)
        if k >= BURN:
            for x in _pieces(len(count)):
                c = count[x]
                total[x] += ((c - DISCOUNT * seating.tables[x] * (c > 0) + room.mass(np.arange(x.start, x.stop)))
                             / (STRENGTH + counts[context[x]]))
    return total / SAMPLES


_TOTALS = (1 << 31) - 1      # in place of a piece's number: contexts' totals, which are sorted behind the model


def _score(shared):
    """Seat on with the true totals and sum every text's log probabilities in some partitions.

    The rows (part, piece, data) come sorted by part and piece; one partition is held at a time."""
    def one(g, part, rows):
        pieces, later = [], None
        for row in rows:
            if row.column(1)[0].as_py() == _TOTALS:
                later = row
                break
            pieces.append(row.column(2)[0].as_py())
        m = _unpack(b"".join(pieces))
        del pieces
        words, context, count = m["word"], m["context"].astype(np.int32), m["count"].astype(np.int64)
        contexts = m["contexts"]
        tables, counts = np.zeros(len(contexts)), np.zeros(len(contexts))
        for row in ([] if later is None else chain([later], rows)):
            got = _unpack(row.column(2)[0].as_buffer())
            at = np.searchsorted(contexts, got["context"])
            tables[at], counts[at] = got["tables"], got["counts"]
        at, here = _among(g["pair_context"], contexts)
        np.add.at(tables, at[here], g["pair_tables"][here])
        word = np.repeat(np.arange(len(words), dtype=np.int32), m["kinds"])
        c_word = np.bincount(word, count, len(words)).astype(np.int64)
        rng = np.random.default_rng([SEED, 2, part])
        at, is_hot = _among(words, g["hot"])
        hot_p0 = np.full(len(words), np.nan)
        if is_hot.any():
            hot_p0[is_hot] = g["hot_p0"][at[is_hot]]
            c_word[is_hot] = g["hot_count"][at[is_hot]]
        p = _sample(rng, count, word, context, m["tables"], tables, counts, ~is_hot & (c_word > 0), hot_p0,
                    m["root"].astype(np.int64), g)
        log_p = np.log10(p)
        pair_at, is_pair = _among(_pair(words[word], contexts[context]), g["pairs"])
        if is_pair.any():
            log_p[is_pair] = g["pair_log_p"][pair_at[is_pair]]
        log_base = np.log10((c_word + 0.5) / (g["train"] + 0.5 * (g["known"] + 1)))
        del p
        per = np.repeat(np.arange(len(count), dtype=np.int32), m["refs"])
        ref, n = m["ref"], len(m["key"])
        often = np.ones(len(ref))
        often[m["more"]] = m["times"]
        return (m["key"], np.bincount(ref, log_p[per] * often, n), np.bincount(ref, log_base[word[per]] * often, n),
                np.bincount(ref, (c_word[word[per]] > 0) * often, n), np.bincount(ref, often, n))

    def run(batches):
        g, sums, at = shared.value, None, None
        for part, rows in _rows_by_part(batches):
            if sums is not None and part // TOGETHER != at:
                yield from _sums(*sums, g["buckets"])
                sums = None
            at, got = part // TOGETHER, one(g, part, rows)
            # A text's sums are added partition by partition.
            sums = got if sums is None else [np.concatenate(x) for x in zip(sums, got)]
            del got
            keys, number = np.unique(sums[0], return_inverse=True)
            sums = [keys, *(np.bincount(number, x, len(keys)) for x in sums[1:])]
        if sums is not None:
            yield from _sums(*sums, g["buckets"])
    return run


def _sums(key, score, base, known, n, buckets):
    """Partial sums of texts, packed by text bucket."""
    bucket = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.append(_runs(bucket[order]), len(order))
    rows = [(int(bucket[order[a]]), _pack(key=key[x], score=score[x], base=base[x], known=known[x].astype(np.uint32),
                                          n=n[x].astype(np.uint32)))
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()) for x in (order[a:b],)]
    for a, b in slices(np.array([len(d) for _, d in rows]), BATCH_BYTES):
        b, d = zip(*rows[a:b])
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(d, pa.binary())], ["bucket", "data"])


def _total(key, table):
    """Sum of a bucket's texts."""
    blocks = [_unpack(d) for d in table.column("data").to_pylist()]
    keys, number = np.unique(np.concatenate([b["key"] for b in blocks]), return_inverse=True)
    add = lambda name: np.bincount(number, np.concatenate([b[name] for b in blocks]), len(keys))
    return pa.table({"key": keys, "score": add("score"), "base": add("base"),
                     "known": add("known").astype(np.int64), "n": add("n").astype(np.int64)})


def _deal_totals(buckets: int):
    """Contexts' totals of every partition, packed by bucket of contexts."""
    def run(batches):
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                m = _unpack(data.as_buffer())
                bucket = (m["context"] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                first = _runs(bucket[order])
                rows = [(int(bucket[x[0]]), _pack(**{k: v[x] for k, v in m.items()})) for x in np.split(order, first[1:])]
                b, d = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(b), pa.int32()), pa.array(b, pa.int32()),
                                                  pa.array(d, pa.binary())], ["part", "bucket", "data"])
    return run


def _add_totals(key, table):
    """Sums by context of a bucket, given back to every partition that has the context."""
    blocks = [_unpack(d) for d in table.column("data").to_pylist()]
    contexts, number = np.unique(np.concatenate([b["context"] for b in blocks]), return_inverse=True)
    tables, counts = (np.bincount(number, np.concatenate([b[k] for b in blocks]), len(contexts)).astype(np.int64)
                      for k in ("tables", "counts"))
    cuts = np.cumsum([len(b["context"]) for b in blocks])[:-1]
    return pa.table({"part": table.column("part"), "data": pa.array(
        [_pack(context=contexts[n], tables=tables[n], counts=counts[n]) for n in np.split(number, cuts)], pa.binary())})


def _totals_of(totals: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables and customers of the few sorted contexts ``wanted``."""
    def pick(batches):
        for batch in batches:
            for data in batch.column(0):
                m = _unpack(data.as_buffer())
                at, here = _among(m["context"], wanted)
                yield pa.RecordBatch.from_arrays([pa.array(at[here]), pa.array(m["tables"][here]), pa.array(m["counts"][here])],
                                                 ["at", "tables", "counts"])
    tables, counts = np.zeros(len(wanted)), np.zeros(len(wanted))
    if len(wanted):
        for r in (totals.select("data").mapInArrow(pick, "at bigint, tables bigint, counts bigint").groupBy("at")
                  .agg(F.max("tables").alias("tables"), F.max("counts").alias("counts")).collect()):
            tables[r["at"]], counts[r["at"]] = r["tables"], r["counts"]
    return tables, counts


def _hot(measured: DataFrame, pair: bool, hot_share: int = HOT_SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hot words (or pairs) and their shares; at most 2 * hot_share, as their counts sum to all tokens."""
    total = measured.where("word IS NULL AND times IS NOT NULL").agg(F.sum("times").alias("n")).first()["n"] or 0
    rows = (measured.where(F.col("word").isNotNull() & (F.col("pair") == pair)).groupBy("word")
            .agg(F.sum("times").alias("times")).where(F.col("times") * 2 * hot_share > total).collect())
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    share = np.array([r["times"] for r in rows], float) / max(total, 1)
    order = np.argsort(words)
    return words[order], share[order]


class _HotPairs:
    """Seating of the hot pairs on the driver: at most two dishes for each partition, or 2 * HOT_SHARE."""

    def __init__(self, model: DataFrame, pairs: np.ndarray, share: np.ndarray, totals: DataFrame):
        rows = (model.select(F.explode("pairs").alias("p")).select("p.*").groupBy("pair", "word", "context")
                .agg(F.sum("count").alias("count")).orderBy("pair").collect())
        self.place, self.word, self.context, self.count = (
            np.array([r[c] for r in rows], np.int64) for c in ("pair", "word", "context", "count"))
        self.rng = np.random.default_rng([SEED, 4])
        self.log_p = np.zeros(len(pairs))
        self.contexts, self.context = np.unique(self.context.view(np.uint64), return_inverse=True)
        self.others, self.customers = _totals_of(totals, self.contexts)
        # Own tables are added to the totals of their contexts as they are seated.
        self.room = _Contexts(self.others.copy(), self.context, share[self.word])
        np.add.at(self.room.totals, self.context, np.minimum(self.count, 1))
        self.seating = Seating(self.count, self.room.mass(np.arange(len(rows))), self.rng, DISCOUNT)
        self._sweeps(BURN)

    def _sweeps(self, n: int) -> None:
        np.copyto(self.room.totals, self.others)
        np.add.at(self.room.totals, self.context, self.seating.tables)
        for _ in range(n):
            self.seating.sweep(self.room.mass, self.room.slope)

    def score(self, prior: np.ndarray) -> None:
        """Average the samples' probabilities under the words' final ``prior``."""
        self.room.p0 = prior[self.word]
        self._sweeps(BURN)
        total = np.zeros(len(self.count))
        for _ in range(SAMPLES):
            self._sweeps(1)
            total += ((self.count - DISCOUNT * self.seating.tables + self.room.mass(np.arange(len(total))))
                      / (STRENGTH + self.customers[self.context]))
        self.log_p[self.place] = np.log10(total / SAMPLES)


#: For tables of packed bytes: Spark would hold as many of these rows as of numbers, and pack them again.
_PACKED = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(8 << 20),
           "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def _stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """``df`` as a stored table; what was exchanged for it (packed tokens, the model) is removed from the disk.

    Rows of packed bytes are read and given to Python a few at a time.
    """
    with shuffles_removed(df.sparkSession), settings(df.sparkSession, {
            "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES), "spark.sql.parquet.columnarReaderBatchSize": "32"}):
        return written(df, name, options)


def score(docs: DataFrame, parts: int = 5, part: int = 1) -> DataFrame:
    """One row per input row, learned from the rows whose crc32(doc_id) modulo ``parts`` is not ``part``.

    Columns: doc_id, held_out, n_tokens (words and the end), n_known (tokens seen in training),
    train_tokens (long), base_score, score, perplexity (double). base_score sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens; score is the model's log10 probability of
    the text, perplexity 10^(-score / n_tokens). Null and empty texts have the end alone. A null
    doc_id is neither learned from nor held out. Without training texts every count is 0. Repeated
    rows count and are scored like others. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = held_out("doc_id", parts, part)
    source = texts(docs, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key"),
                   (F.col("doc_id").isNotNull() & ~out).alias("train"))
    n_parts = partitions_for(source, "text", PARTITION_BYTES, 1)
    hot_share = max(HOT_SHARE, n_parts)     # no word or pair that is not hot fills a partition
    measured = written(source.mapInArrow(lambda batches: _measure(batches, hot_share), "doc_id bigint, key bigint, n bigint, word bigint, times bigint, pair boolean"),
                       "measured")
    hot, share = _hot(measured, False, hot_share)
    pairs = np.sort(_hot(measured, True, hot_share)[0])
    blocks = source.mapInArrow(_occurrences(n_parts, hot, pairs), "part int, data binary")
    model = _stored(blocks.repartitionById(n_parts, "part").sortWithinPartitions("part").mapInArrow(
        _build_sorted(_build(n_parts, hot, share, pairs)), _MODEL), "model", _PACKED)
    sums = model.agg(*(F.sum(c).alias(c) for c in ("known", "train", "customers", "root"))).first().asDict()
    sums = {k: v or 0 for k, v in sums.items()}
    totals = _stored(model.where("totals IS NOT NULL").select("part", "totals").mapInArrow(_deal_totals(n_parts), "part int, bucket int, data binary")
                     .groupBy("bucket").applyInArrow(_add_totals, "part int, data binary"), "context_totals", _PACKED)
    hot_rows = {r["word"]: r for r in model.select(F.explode("hot").alias("h")).select("h.*").groupBy("word").agg(
        F.sum("customers").alias("customers"), F.sum("count").alias("count")).collect()}
    seen = [hot_rows.get(int(w)) for w in hot.view(np.int64)]
    customers = np.array([r["customers"] if r else 0 for r in seen], np.int64)
    counts = np.array([r["count"] if r else 0 for r in seen], np.int64)
    hot_pairs = _HotPairs(model, pairs, share, totals)
    customers = customers + np.bincount(hot_pairs.word, hot_pairs.seating.tables, len(hot)).astype(np.int64)
    known = sums["known"] + int((counts > 0).sum())
    root = _seat_words(customers, float(sums["root"]), float(known), np.random.default_rng([SEED, 3]))
    all_customers, all_root = sums["customers"] + int(customers.sum()), sums["root"] + int(root.sum())
    mass = (ROOT_STRENGTH + ROOT_DISCOUNT * all_root) / (known + 1)
    hot_p0 = (customers - ROOT_DISCOUNT * root + mass) / (ROOT_STRENGTH + all_customers)
    hot_pairs.score(hot_p0)
    buckets = max(1, n_parts)
    shared = spark.sparkContext.broadcast({
        "hot": hot, "hot_count": counts, "known": known, "train": sums["train"], "customers": all_customers,
        "root": all_root, "buckets": buckets,
        "pair_context": hot_pairs.contexts[hot_pairs.context], "pair_tables": hot_pairs.seating.tables, "pairs": pairs, "pair_log_p": hot_pairs.log_p, "hot_p0": hot_p0})
    # Sums of a text are added for some partitions before they are exchanged.
    rows = model.select("part", "piece", "data").union(totals.select("part", F.lit(_TOTALS), "data"))
    partial = (rows.repartitionById(-(-n_parts // TOGETHER), F.floor(F.col("part") / TOGETHER).cast("int"))
               .sortWithinPartitions("part", "piece").mapInArrow(_score(shared), "bucket int, data binary"))
    total = _stored(partial.groupBy("bucket").applyInArrow(
        _total, "key bigint, score double, base double, known bigint, n bigint"), "totals")
    # A text that several tasks packed was summed once for each of them: total.n counts how often.
    times = F.col("total.n") / F.col("rows.n")
    return (measured.where("n IS NOT NULL").alias("rows").join(total.alias("total"), "key")
            .select("doc_id", out.alias("held_out"), F.col("rows.n").alias("n_tokens"),
                    F.round(F.col("known") / times).cast("long").alias("n_known"),
                    F.lit(sums["train"]).cast("long").alias("train_tokens"),
                    (F.col("base") / times).alias("base_score"), (F.col("score") / times).alias("score"),
                    F.pow(F.lit(10.0), -(F.col("score") / times) / F.col("rows.n")).alias("perplexity")))
