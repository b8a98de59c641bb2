"""Personal data: fixed patterns, and bootstrapped contextual extraction of what they miss.

1. The fixed patterns find seed entities. Every seed has lexical contexts: the token before, the two and
   three tokens before, the tokens around. Signs (brackets, quotes, colons) are tokens of their own, so
   a glued prefix is a context. A context with enough different seeds of a kind is a pattern of that kind.
2. The corpus is read once more against a filter of these patterns. It is counted how often each one's
   context occurs at all, before whatever word: a common word that happens to stand before a few seeds
   gets no confidence. Near-miss spans (identifiers written in another way) are candidates where they
   stand in a pattern's context, and only there, so what a task holds grows with the text, not with the
   number of ways to cut it.
3. Pattern and instance confidences are computed from each other over a few rounds of joins:
   a pattern's is the share of its occurrences that its instances account for, a candidate's is
   1 - prod(1 - confidence of its patterns). Candidates that a confident pattern reaches are
   added; what they are then strengthens further patterns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import (_BYTE_VALUES, _IS_SPACE, _LOWER, _powers, map_slices, mix, text_bytes, texts, unused,
                                  written)

# Kinds in their order and the patterns of the contract.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Candidates: the same identifiers written in ways the fixed patterns don't know.
# Patterns that begin with a plain letter or digit are searched for fast; what stands before is checked after.
_MAYBE_AT = re.compile(r"a[tT](?=[\x20)\]}>_*-])|A[tT](?=[\x20)\]}>_*-])|@|＠|#|%40")
_AT = re.compile(r"\x20?[(\[{<]\x20?(?:at|@)\x20?[)\]}>]\x20?|\x20(?:at|@)\x20|[-_*]at[-_*]|&#64;|%40|[@＠#]", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]+((?:\x20?[(\[{<]\x20?(?:dot|\.)\x20?[)\]}>]\x20?|\x20dot\x20|[-_*]dot[-_*]|\.)[A-Za-z0-9-]+)*", re.I)
_SITE = re.compile(r"\.[A-Za-z]{2}")
_IP_LIKE = re.compile(r"[0-9][0-9]{0,2}(?:(?:\x20?(?:[(\[{](?:\.|dot)[)\]}]|dot|[.,:_-])\x20?|\x20)[0-9]{1,3}){3}(?![0-9\[])")
_BEFORE_IP = frozenset("0123456789.]")
_GAP = r"().\x20\t /_:,|*~·‐-―-"
_CHAIN = re.compile(rf"[0-9][0-9{_GAP}]{{5,}}[0-9]\)?")
_UNIT = re.compile(r"\(?[0-9]+(?:[^0-9\s]{1,3}[0-9]+)*\)?")
_SHAPE = str.maketrans("123456789", "000000000")
_DIGITS = ((3, 7, 15), (2, 12, 19))      # kind, least and most digits

MIN_SEEDS = 3              # different seed values that make a context a pattern
CONFIDENCE = 0.5           # of a candidate that is added
ROUNDS = 3
FILTER_LOAD = 16           # slots of the broadcast filter for each pattern hash
FILTER_MOST = 1 << 26      # its size at most, in bytes; fuller, it lets more through, which a join takes out
BLOCK = 100_000            # candidates of a long chain of numbers that are looked at together


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by the fixed patterns, sorted. Linear in the text's length."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _DOTTED.finditer(text):
        parts, begin = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            stop = begin + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                out.append((begin, 1, stop))
            begin = stop + 1
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _email_like(text: str) -> list[tuple[int, int, int]]:
    found, end = [], 0
    for maybe in _MAYBE_AT.finditer(text):
        # The longest sign around: "(at)" may have blanks inside and outside.
        m = next(filter(None, (_AT.match(text, k) for k in range(max(end, maybe.start() - 3), maybe.start() + 1))), None)
        if m is None or m.end() <= maybe.start():
            continue
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, m.end()) if start < m.start() else None
        # Between blanks "at" is a common word, and "#" is a common sign: the host needs a dot.
        if host and (host.group(1) or m.group().strip().lower() not in ("at", "#", "%40")):
            found.append((start, 0, host.end()))
            end = host.end()
    done = 0
    for m in _SITE.finditer(text):
        if m.start() >= max(done, 1) and text[m.start() - 1].isalnum():
            start, done = m.start(), m.end()
            while start > 0 and text[start - 1] in _LOCAL:
                start -= 1
            while done < len(text) and text[done] in _LOCAL:
                done += 1
            found.append((start, 0, start + len(text[start:done].rstrip(".-_%+"))))
    return found


def _numbers(text: str, base: list[tuple[int, int, int]]) -> Iterator[np.ndarray]:
    """Runs of number groups that may be phones or cards, in blocks of rows
    (start, kind, end, rank, from, to).

    Where a chain of groups is too long, its repeated shapes and then all runs of groups take its
    place. Repeats of the chain's first shape stand in the same slot: their context is that of
    ``from`` and ``to``.
    """
    b, known = 0, {}
    for chain in _CHAIN.finditer(text):
        parts: list[list] = [[]]
        for m in _UNIT.finditer(text, chain.start() - (text[chain.start() - 1:chain.start()] == "("), chain.end()):
            s, e = m.span()
            while b < len(base) and base[b][2] <= s:
                b += 1
            glued = (s and (text[s - 1] == "+" or text[s - 1].isalnum())) or (e < len(text) and text[e].isalnum())
            if glued or any(x[0] < e and x[2] > s for x in _upto(base, b, e)):
                parts.append([])
            else:
                shape = m.group().translate(_SHAPE)
                parts[-1].append((s, e, known.setdefault(shape, shape), sum(map(str.isdigit, shape))))
        for units in parts:
            if units:
                yield from _ranges(text, units)


def _upto(base, b, end):
    while b < len(base) and base[b][0] < end:
        yield base[b]
        b += 1


def _ranges(text: str, units: list) -> Iterator[np.ndarray]:
    shapes, digits = [u[2] for u in units], [u[3] for u in units]
    n, total = len(units), sum(digits)
    begin, end = (np.array([u[k] for u in units]) for k in (0, 1))
    low = int(begin[0])
    part = np.frombuffer(text[low:int(end[-1])].encode("utf-32-le", "surrogatepass"), "<u4")
    opened, closed = (np.append(0, np.cumsum(part == ord(c))) for c in "()")
    upto = np.append(0, np.cumsum(digits))

    def spans(i, j):
        """Start and end of the units i to j - 1, without a bracket that has no partner inside."""
        s, e = begin[i], end[j - 1]
        has = opened[e - low] > opened[s - low], closed[e - low] > closed[s - low]
        return s + ((part[s - low] == ord("(")) & ~has[1]), e - ((part[e - 1 - low] == ord(")")) & ~has[0])

    def rows(kind, rank, s, e, a, z):
        return np.stack(np.broadcast_arrays(s, kind, e, rank, a, z), 1)

    for kind, least, most in _DIGITS:
        if total < least:
            continue
        if total <= most:
            s, e = spans(np.array([0]), np.array([n]))
            yield rows(kind, 0, s, e, s, e)
            continue
        for p in range(min(n // 2, most), 0, -1):
            if least <= upto[p] <= most and shapes[p:2 * p] == shapes[:p]:
                k = 2
                while shapes[k * p:(k + 1) * p] == shapes[:p]:
                    k += 1
                at = np.arange(k) * p
                s, e = spans(at, at + p)
                whole = spans(np.array([0]), np.array([k * p]))[1]
                yield rows(kind, 0, s, e, np.where(at > 0, begin[0], s[0]), whole)
                break
        for i in range(0, n, BLOCK // 20):
            first = np.arange(i, min(n, i + BLOCK // 20))
            # Runs from each unit: those whose digits are enough and not too many.
            one, last = (np.searchsorted(upto, upto[first] + d, side) for d, side in ((least, "left"), (most, "right")))
            count = np.maximum(last - one, 0)
            start = np.repeat(first, count)
            stop = np.repeat(one, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            s, e = spans(start, stop)
            yield rows(kind, 1, s, e, s, e)


def candidate_blocks(text: str, base: list[tuple[int, int, int]]) -> Iterator[np.ndarray]:
    """Near misses that overlap no base span, in blocks of rows (start, kind, end, rank, from, to)."""
    found = _email_like(text)
    found += [(m.start(), 1, m.end()) for m in _IP_LIKE.finditer(text)
              if text[m.start() - 1:m.start()] not in _BEFORE_IP and all(int(x) <= 255 for x in re.findall("[0-9]+", m.group()))]
    out, b = [], 0
    for span in sorted(set(found)):
        while b < len(base) and base[b][2] <= span[0]:
            b += 1
        if not any(x[2] > span[0] for x in _upto(base, b, span[2])):
            out.append((*span, 0, span[0], span[2]))
    if out:
        yield np.array(out)
    yield from _numbers(text, base)


_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "._%+-@"]] = True
_NONE = np.uint64(0x3C6EF372FE94F82B)          # stands for the word before a text's first


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, hashes and texts of a slice's tokens: signs one by one, and what stands between them."""
    n = len(raw)
    space, sign, later = _IS_SPACE[raw], _SIGN[raw], np.zeros(n, bool)
    if n and raw.max() >= 0x80:
        after, third = np.append(raw[1:], 0), np.append(raw[2:], [0, 0])[:n]
        two = (raw == 0xC2) & ((after == 0xAB) | (after == 0xBB))
        three = (((raw == 0xE2) | (raw == 0xE3)) & (after == 0x80)) | (
            (raw == 0xEF) & (after == 0xBC) & ((third <= 0x8F) | ((third >= 0x9A) & (third <= 0x9F))))
        sign |= two | three
        later[1:] |= (two | three)[:-1]
        later[2:] |= three[:-2]
    start = sign | ~space
    start[1:] &= sign[1:] | space[:-1] | sign[:-1] | later[:-1]
    # A plus before a digit starts a number.
    start[1:-1] |= (raw[1:-1] == 43) & (_DIGIT[raw[2:]]) & ~_DIGIT[raw[:-2]]
    inner = offsets[(offsets > 0) & (offsets < n)]
    start[inner] = ~space[inner]
    start &= ~later
    starts = np.flatnonzero(start)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    spans = np.diff(np.append(starts, n))
    values = _BYTE_VALUES[_LOWER[raw[starts[0]:]]]
    values[space[starts[0]:]] = 0
    values *= _powers(int(spans.max()))[np.arange(starts[0], n) - np.repeat(starts, spans)]
    return starts, mix(np.add.reduceat(values, starts - starts[0])), np.searchsorted(offsets, starts, "right") - 1


_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _patterns(words: np.ndarray, owner: np.ndarray, at: np.ndarray, after: np.ndarray):
    """Hashes of the contexts of slots from token ``at`` to before token ``after``, and which exist.

    One, two and three tokens before; the tokens around (a text's start counts as one).
    """
    n = len(words)
    before = [np.where(at >= k, words[np.maximum(at - k, 0)], _NONE) for k in (1, 2, 3)]
    has = [(at >= k) & (owner[np.maximum(at - k, 0)] == owner[at]) for k in (1, 2, 3)]
    b1 = np.where(has[0], before[0], _NONE)
    ok = (after < n) & (owner[np.minimum(after, n - 1)] == owner[at])
    c = words[np.minimum(after, n - 1)]
    one, two, three, four = (np.uint64(x) for x in (0x51ED270B, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93))
    h = np.stack([mix(b1 + one), mix(before[1] * two + b1), mix(mix(before[2] * four + before[1]) * two + b1),
                  mix(b1 * three + c + two)])
    return h.view(np.int64), np.stack([*has, ok])


def _instance(kind: int, value: str) -> int:
    return int.from_bytes(blake2b(f"{kind}:{value.lower()}".encode(), digest_size=8).digest(), "little", signed=True)


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])


class _Slots:
    """The tokens of a slice of texts, and the contexts of spans in it."""

    def __init__(self, column):
        self.raw, self.offsets = text_bytes(column)
        self.starts, self.words, self.owner = _tokens(self.raw, self.offsets)
        self.chars = np.append(np.flatnonzero((self.raw & 0xC0) != 0x80), len(self.raw))
        self.first = np.searchsorted(self.chars, self.offsets[:-1])   # each text's first code point

    def contexts(self, number, a: np.ndarray, z: np.ndarray):
        """(hashes, which exist, token of the span, token after it) of spans a to z (code points) of texts."""
        a, z = self.chars[self.first[number] + a], self.chars[self.first[number] + z]
        at = np.minimum(np.searchsorted(self.starts, a), len(self.starts) - 1)
        after = np.searchsorted(self.starts, z)
        h, ok = _patterns(self.words, self.owner, at, after)
        return h, ok & (self.starts[at] == a), at, after          # inside a token there is no slot


def _span_lists(spans: list[list[tuple[int, int, int]]]) -> pa.Array:
    """(start, kind, end) lists as an Arrow column of structs."""
    flat = np.array([x for row in spans for x in row], np.int32).reshape(-1, 3)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, spans)], dtype=np.int32)), pa.StructArray.from_arrays(
        [pa.array(flat[:, k]) for k in (1, 0, 2)], fields=list(_SPAN)))


def _scan_seeds(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Base spans of each text; its seeds' contexts as two lists in step (pattern, and kind with instance)."""
    values = batch.column(1).to_pylist()
    base = [base_spans(t) for t in values]
    seeds = [(i, *x) for i, row in enumerate(base) for x in row]
    patterns, which = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if seeds:
        number, start, kind, stop = np.array(seeds).T
        h, ok, _, _ = _Slots(batch.column(1)).contexts(number, start, stop)
        which, nth = np.nonzero(ok.T)
        patterns = h[nth, which]
    named = [(k, _instance(k, values[i][s:e])) for i, s, k, e in seeds]
    owner = np.array([x[0] for x in seeds], np.int64)[which] if seeds else which
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=len(values)))).astype(np.int32))
    rows = pa.StructArray.from_arrays([pa.array([named[k][0] for k in which.tolist()], pa.int32()),
                                       pa.array([named[k][1] for k in which.tolist()], pa.int64()), pa.array(patterns, pa.int64())],
                                      names=["kind", "instance", "pattern"])
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), _span_lists(base), pa.ListArray.from_arrays(offsets, rows)],
                                      ["doc_id", "key", "base", "seeds"])


_FOUND = [("key", pa.binary()), ("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("rank", pa.int32()),
          ("instance", pa.int64()), ("pattern", pa.int64()), ("total", pa.int64())]


def _scan_candidates(batch: pa.RecordBatch, filled: np.ndarray) -> pa.RecordBatch:
    """Occurrences of the filter's contexts (pattern, total), and candidates in them (one row a pattern)."""
    slots, mask = _Slots(batch.column(1)), len(filled) - 1
    totals, rows, wide = [], [], []
    if len(slots.words):
        for i in range(0, len(slots.words), BLOCK):
            at = np.arange(i, min(len(slots.words), i + BLOCK))
            h, ok = _patterns(slots.words, slots.owner, at, at + 1)
            got = h[ok]
            totals.append(got[filled[got & mask]])
        keys = batch.column(2).to_pylist()
        for number, text in enumerate(batch.column(1).to_pylist()):
            spans = base_spans(text)
            seeds = [np.array([(*x, -1, x[0], x[2]) for x in spans])] if spans else []
            for block in seeds:
                _, h, ok, at, after = _inside(slots, number, block, filled)
                wide.append(_wide(h, ok, at, after))
            for block in candidate_blocks(text, spans):
                block, h, ok, at, after = _inside(slots, number, block, filled)
                wide.append(_wide(h, ok, at, after))
                which, nth = np.nonzero(ok.T)
                instances = {k: _instance(int(block[k, 1]), text[block[k, 0]:block[k, 2]]) for k in np.unique(which).tolist()}
                rows += [(keys[number], *block[k, [1, 0, 2, 3]].tolist(), instances[k], int(h[n, k]), None)
                         for k, n in zip(which.tolist(), nth.tolist())]
    # A slot of several tokens, which the count of single tokens doesn't see, counts once.
    slots_of = np.unique(np.concatenate([np.zeros((0, 3), np.int64), *wide]), axis=0)
    value, times = np.unique(np.concatenate([np.zeros(0, np.int64), *totals, slots_of[:, 2]]), return_counts=True)
    columns = list(zip(*rows)) if rows else [()] * len(_FOUND)
    none = [None] * len(value)
    return pa.RecordBatch.from_arrays(
        [pa.array([*c, *(value.tolist() if name == "pattern" else times.tolist() if name == "total" else none)], kind)
         for c, (name, kind) in zip(columns, _FOUND)], [name for name, _ in _FOUND])


def _inside(slots: _Slots, number: int, block: np.ndarray, filled: np.ndarray):
    """The rows of a block that stand in a context of the filter, and which contexts these are."""
    h, ok, at, after = slots.contexts(np.full(len(block), number), block[:, 4], block[:, 5])
    ok &= filled[h & (len(filled) - 1)]
    some = ok.any(axis=0)
    return block[some], h[:, some], ok[:, some], at[some], after[some]


def _wide(h, ok, at, after) -> np.ndarray:
    """(token, token after, pattern) of the slots of several tokens whose context around is in the filter."""
    mine = ok[3] & (after - at > 1)
    return np.stack([at[mine], after[mine], h[3, mine]], 1)


def _pattern_filter(supported: DataFrame) -> np.ndarray:
    """Which slots of a table the patterns' hashes fall into: sized by their number, at most ``FILTER_MOST``.

    The slots are found in Spark; no more than the table's size of numbers reach the driver.
    """
    size = 1 << 10
    while size < min(FILTER_MOST, FILTER_LOAD * supported.count()):
        size *= 2
    filled = np.zeros(size, bool)
    filled[supported.select(F.expr(f"pattern & {size - 1}").alias("slot")).distinct().toArrow().column("slot").to_numpy()] = True
    return filled


def _discovered(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``key, kind, start, stop, rank`` of candidates that confident patterns reach."""
    seeds = rows.select(F.explode("seeds").alias("s")).select("s.*")
    seeds = written(seeds.groupBy("kind", "instance", "pattern").agg(F.count(F.lit(1)).alias("n")), "seeds")
    supported = written(seeds.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= MIN_SEEDS),
                        "supported")
    table = docs.sparkSession.sparkContext.broadcast(_pattern_filter(supported))
    found = written(map_slices(texts(docs, _text_key().alias("key")), lambda batch: _scan_candidates(batch, table.value),
                               "key binary, kind int, start int, stop int, rank int, instance bigint, pattern bigint, total bigint"),
                    "candidates")
    totals = found.where("total IS NOT NULL").groupBy("pattern").agg(F.sum("total").alias("total"))
    candidates = found.where("total IS NULL")
    patterns = written(supported.join(totals, "pattern").select("kind", "pattern", "total"), "patterns")
    maybe = candidates.groupBy("kind", "instance", "pattern").agg(F.count(F.lit(1)).alias("n"))
    edges = seeds.withColumn("seed", F.lit(True)).unionByName(maybe.withColumn("seed", F.lit(False)))
    graph = written(edges.join(patterns, ["kind", "pattern"]), "graph")
    score = graph.select("kind", "instance", F.col("seed").cast("double").alias("score")).distinct()
    for k in range(ROUNDS):
        confidence = (graph.join(score, ["kind", "instance"]).groupBy("kind", "pattern")
                      .agg(F.least(F.lit(1.0), F.sum(F.col("n") * F.col("score")) / F.max("total")).alias("confidence")))
        reached = graph.join(confidence, ["kind", "pattern"]).groupBy("kind", "instance").agg(
            F.max("seed").alias("seed"),
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-12)))))).alias("score"))
        score = written(reached.select("kind", "instance", F.when(F.col("seed"), 1.0).otherwise(
            F.when(F.col("score") >= CONFIDENCE, F.col("score")).otherwise(0.0)).alias("score")), f"score{k}")
    sure = confidence.where(F.col("confidence") >= CONFIDENCE).select("kind", "pattern")
    return (candidates.join(sure, ["kind", "pattern"]).groupBy("key", "kind", "start", "stop")
            .agg(F.min("rank").alias("rank")))


def _apart(batches):
    """Of a text's overlapping spans of a kind the one of lower rank stays, then the longer one."""
    for batch in batches:
        out = []
        for row in batch.column(1).to_pylist():
            taken: dict[int, list] = {}
            kept = []
            for s in sorted(row, key=lambda s: (s["rank"], s["start"] - s["stop"], s["start"])):
                own = taken.setdefault(s["kind"], [])
                k = bisect_left(own, (s["start"], s["stop"]))
                if (k and own[k - 1][1] > s["start"]) or (k < len(own) and own[k][0] < s["stop"]):
                    continue
                own.insert(k, (s["start"], s["stop"]))
                kept.append({"kind": s["kind"], "start": s["start"], "stop": s["stop"]})
            out.append(kept)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(_SPAN))], ["key", "more"])


def _text_key():
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def _spans(docs: DataFrame) -> DataFrame:
    """``doc_id, key, base, spans`` (arrays of kind number, start, stop; sorted by start, kind)."""
    rows = written(map_slices(
        texts(docs, _text_key().alias("key")), _scan_seeds, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, "
        "base array<struct<kind:int,start:int,stop:int>>, seeds array<struct<kind:int,instance:bigint,pattern:bigint>>"), "scan")
    more = written(_discovered(docs, rows).groupBy("key").agg(
        F.collect_set(F.struct("kind", "start", "stop", "rank")).alias("more")).mapInArrow(
        _apart, "key binary, more array<struct<kind:int,start:int,stop:int>>"), "more")
    joined = rows.drop("seeds").join(more, "key", "left")
    order = lambda a, b: (F.when(a["start"] != b["start"], a["start"] - b["start"])
                          .when(a["kind"] != b["kind"], a["kind"] - b["kind"]).otherwise(a["stop"] - b["stop"]))
    return joined.select("doc_id", "key", "base", F.array_sort(
        F.concat("base", F.coalesce("more", F.array().cast(joined.schema["base"].dataType))), order).alias("spans"))


def find(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, base, spans`` (arrays of ``kind, start, stop``).

    ``base`` holds the spans of the fixed patterns, ``spans`` these and the discovered ones, by
    start, then kind; code points, stop exclusive. Spans depend on the text alone, so repeated rows
    and copies get the same. Null text counts as empty and has none; an empty table gives no rows;
    other columns are not read.
    """
    names = F.array(*map(F.lit, KINDS))
    named = lambda c: F.transform(c, lambda s: F.struct(
        F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return _spans(docs).select("doc_id", named("base").alias("base"), named("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in angle brackets.

    All rows and columns stay (overlapping spans are replaced together, by the first one's kind);
    ``n_chars``, where present, is the new length. A null text stays null.
    """
    key, extra = unused(docs, "text_key"), unused(docs, "text_spans")
    found = _spans(docs).where(F.size("spans") > 0).dropDuplicates(["key"])
    found = written(found.select(F.col("key").alias(key), F.col("spans").alias(extra)), "redactions")
    names = "array(" + ", ".join(f"'<{k}>'" for k in KINDS) + ")"
    cleaned = F.expr(f"""aggregate(`{extra}`, struct('' AS done, 0 AS at),
        (a, s) -> CASE WHEN s.start < a.at THEN struct(a.done AS done, greatest(a.at, s.stop) AS at)
                  ELSE struct(concat(a.done, substring(text, a.at + 1, s.start - a.at),
                                     get({names}, s.kind)) AS done, s.stop AS at) END,
        a -> concat(a.done, substring(text, a.at + 1)))""")
    # What was found grows with the texts, so it is never broadcast.
    joined = docs.withColumn(key, _text_key()).join(found.hint("merge"), key, "left")
    out = joined.withColumn("text", F.when(F.col(extra).isNull(), F.col("text")).otherwise(cleaned))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(extra).isNull(), F.col("n_chars")).otherwise(length))
    return out.select(*docs.columns)
