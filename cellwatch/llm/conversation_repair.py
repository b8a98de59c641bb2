"""Conversation structure repair: a min-plus dynamic programme over grammar-compressed conversations.

A conversation is a sequence of row symbols (role initial and fault). Its roles are repaired by the
cheapest edits after which they read ``(s?(ua)+)?``. A symbol's transfer matrix holds, for each pair of
states of that pattern, the least cost of getting from one to the other by inserted rows and the row's
own edit, with the edits' initials as a rope. The sequences of a block of conversations are compressed
together by Re-Pair; each rule's matrix is the min-plus product of the two it stands for, evaluated
once, from the bottom up, and kept for the blocks after. What is left of a conversation is then a few
products of shared matrices.

Strings of equal cost for the same rows have the same number of row edits and inserts, so none is a
prefix of another, and picking the ASCII-least at each product gives the least of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Costs of the edits, and the signs that count as white space and as a sentence's end.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_SIGN = r"[^\x20\x09-\x0D]"
_ENDS = r"[.!?][\x20\x09-\x0D]*\z"

# Symbols: initial (s, u, a, other) + 4 if truncated; 8 is a row that has to go.
INITIALS = "sua"
GONE, SYMBOLS = 8, 9
# States: nothing yet, after a system row, after a user row, after an assistant row.
STATES, FINAL = 4, (0, 3)
_NEXT = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}

ROWS_A_BLOCK = 50_000     # rows whose conversations are compressed together, about
KEPT_RULES = 20_000       # rules whose matrices a worker keeps
_FLAT = 48                # ropes up to this length are plain strings
_PRIME = (1 << 127) - 1


# ---------------------------------------------------------------- ropes

class Rope:
    """A string as a tree of parts, with its length and a 127-bit hash of its letters."""

    __slots__ = ("left", "right", "size", "hash", "scale")

    def __init__(self, left, right):
        self.left, self.right = left, right
        self.size = len_of(left) + len_of(right)
        h1, s1 = _hash(left)
        h2, s2 = _hash(right)
        self.hash, self.scale = (h1 * s2 + h2) % _PRIME, s1 * s2 % _PRIME


def len_of(x) -> int:
    return len(x) if isinstance(x, str) else x.size


def _hash(x) -> tuple[int, int]:
    """Polynomial hash, and the base's power of the length."""
    if not isinstance(x, str):
        return x.hash, x.scale
    h = 0
    for c in x.encode():
        h = (h * 1_000_003 + c) % _PRIME
    return h, pow(1_000_003, len(x), _PRIME)


def joined(a, b):
    """The rope of two strings or ropes."""
    if not len_of(a):
        return b
    if not len_of(b):
        return a
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= _FLAT:
        return a + b
    return Rope(a, b)


def leaves(x) -> Iterator[str]:
    """The strings of a rope, from the left."""
    stack = [x]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += (top.right, top.left)


def less(a, b) -> bool:
    """Whether rope ``a`` comes before rope ``b`` in ASCII order; equal parts are skipped by their hashes."""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y or (not isinstance(x, str) and not isinstance(y, str) and x.size == y.size and x.hash == y.hash):
            continue
        n, m = len_of(x), len_of(y)
        if not isinstance(x, str) and (n >= m or isinstance(y, str)):
            left += (x.right, x.left)
            right.append(y)
        elif not isinstance(y, str):
            right += (y.right, y.left)
            left.append(x)
        else:
            k = min(n, m)
            if x[:k] != y[:k]:
                return x[:k] < y[:k]
            if n > k:
                left.append(x[k:])
            if m > k:
                right.append(y[k:])
    return not left and bool(right)


# ---------------------------------------------------------------- min-plus matrices of (cost, rope)

def better(a, b):
    """The cheaper of two (cost, rope) or None; of equal cost the one that is ASCII-least."""
    if a is None:
        return b
    if b is None or a[0] != b[0]:
        return a if b is None or a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def row_times(row: list, matrix: list) -> list:
    """One row of states times a matrix."""
    out = [None] * STATES
    for p, have in enumerate(row):
        if have is None:
            continue
        cost, edits = have
        for q, step in enumerate(matrix[p]):
            if step is not None and (out[q] is None or cost + step[0] <= out[q][0]):
                out[q] = better(out[q], (cost + step[0], joined(edits, step[1])))
    return out


def times(a: list, b: list) -> list:
    return [row_times(row, b) for row in a]


def _insert_matrix() -> list:
    """Fewest inserted rows from state to state."""
    out = [[None] * STATES for _ in range(STATES)]
    for p in range(STATES):
        out[p][p], now, n = (0, ""), p, 0
        while n < STATES:
            now, n = (3 if now == 2 else 2), n + 1
            if out[p][now] is None:
                out[p][now] = (INSERT * n, "I" * n)
    return out


INSERTS = _insert_matrix()


def _symbol_matrix(symbol: int) -> list:
    """Inserted rows, then the edit of a row."""
    own = [[(DELETE, "D") if p == q else None for q in range(STATES)] for p in range(STATES)]
    if symbol != GONE:
        initial, extra = "sua?"[symbol % 4], TRUNCATED * (symbol // 4)
        for role in "sua":
            for p, q in _NEXT[role]:
                edit = (extra, "K") if role == initial else (REROLE + extra, "R") if role != "s" else None
                own[p][q] = better(own[p][q], edit)
    return times(INSERTS, own)


class Grammar:
    """Rules (pairs of symbols) with the transfer matrix of each, shared by all that use them."""

    def __init__(self):
        self.rules: dict[tuple[int, int], int] = {}
        self.matrices = [_symbol_matrix(x) for x in range(SYMBOLS)]

    def rule(self, left: int, right: int) -> int:
        """The symbol of a pair; its matrix is evaluated when it is new."""
        found = self.rules.get((left, right))
        if found is None:
            found = self.rules[left, right] = len(self.matrices)
            self.matrices.append(times(self.matrices[left], self.matrices[right]))
        return found

    def solve(self, sequence: list[int]) -> tuple[int, str]:
        """Least cost of a sequence of symbols, and its edits."""
        steps = [self.matrices[symbol] for symbol in sequence]
        while len(steps) > 64:   # long ones are multiplied pairwise, so that ropes stay shallow
            steps = [times(*steps[i:i + 2]) if i + 1 < len(steps) else steps[i] for i in range(0, len(steps), 2)]
        row = [(0, ""), None, None, None]
        for step in steps:
            row = row_times(row, step)
        row = row_times(row, INSERTS)
        cost, edits = better(*(row[q] for q in FINAL))
        return cost, "".join(leaves(edits))


def re_pair(symbols: np.ndarray, sizes: np.ndarray, weights: np.ndarray, grammar: Grammar) -> list[list[int]]:
    """Sequences (laid end to end) with every pair that occurs twice replaced by a rule.

    Each round replaces the pairs that occur most often, as many as have no symbol in common (so that
    no two of them overlap); an occurrence counts as often as its sequence stands in the block.
    """
    symbols, owner = symbols.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    while len(symbols) > 1:
        inside = owner[:-1] == owner[1:]
        top = int(symbols.max()) + 1
        keys = symbols[:-1] * top + symbols[1:]
        found, back = np.unique(keys[inside], return_inverse=True)
        counts = np.bincount(back, weights[owner[:-1][inside]], len(found))
        used, chosen = set(), []
        for i in np.lexsort((found, -counts)).tolist():
            if counts[i] < 2:
                break
            a, b = divmod(int(found[i]), top)
            if a not in used and b not in used:
                used |= {a, b}
                chosen.append((int(found[i]), grammar.rule(a, b)))
        if not chosen:
            break
        chosen.sort()
        wanted, named = np.array([k for k, _ in chosen]), np.array([s for _, s in chosen])
        at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        hit = np.flatnonzero(inside & (wanted[at] == keys))
        # Pairs of one symbol overlap in a run: of each run every other one from the left.
        fresh = np.append(True, np.diff(hit) != 1)
        hit = hit[(hit - hit[fresh][np.cumsum(fresh) - 1]) % 2 == 0]
        symbols[hit] = named[at[hit]]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    cuts = np.searchsorted(owner, np.arange(len(sizes) + 1))
    flat = symbols.tolist()
    return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


_KEPT = {"grammar": Grammar()}


def repair_sequences(sequences: list[bytes]) -> list[tuple[int, str]]:
    """(cost, edits) of each sequence of symbols."""
    if len(_KEPT["grammar"].matrices) > KEPT_RULES:
        _KEPT["grammar"] = Grammar()
    grammar = _KEPT["grammar"]
    often: dict[bytes, int] = {}
    for s in sequences:
        often[s] = often.get(s, 0) + 1
    distinct = list(often)
    sizes = np.array([len(s) for s in distinct], np.int64)
    packed = re_pair(np.frombuffer(b"".join(distinct), np.uint8), sizes, np.array(list(often.values())), grammar)
    solved = dict(zip(distinct, map(grammar.solve, packed)))
    return [solved[s] for s in sequences]


# ---------------------------------------------------------------- Spark

def damage(conversations: DataFrame, modulus: int = 20) -> DataFrame:
    """Rows of conversations, damaged by the CRC-32 of ``conv_id:turn`` modulo ``modulus`` (null: one space).

    0 drops a row (it stays, marked ``dropped``, so that its conversation is still known), 1 empties its
    text, 2 removes ``. ! ?`` from it, 3 repeats the row, 4 makes it the user's. Null role and text become
    one space. Columns: ``conv_id, turn, role, text, dropped``; others are not read.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % modulus
    coded = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), code.alias("code"))
    return (coded.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                         F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
                         .otherwise(F.col("text")).alias("text"), (F.col("code") == 0).alias("dropped"),
                         F.explode(F.array_repeat(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))).alias("again"))
            .drop("again"))


def with_faults(rows: DataFrame, blocks: int) -> DataFrame:
    """``block, conv_id, turn, role, text, at, fault, illegal, new_turn`` of every row that is not dropped.

    ``at`` numbers a conversation's rows by turn (null first; of one turn by role and text), ``fault`` is
    the first that holds of blank (1), duplicate (2), truncated (3), or 0. Blocks hold whole
    conversations and decide the partition, so all windows and the streaming after use one shuffle.
    """
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    own = (rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")),
                       F.coalesce(dropped, F.lit(False)).alias("dropped"))
           .withColumn("block", F.pmod(F.xxhash64("conv_id"), F.lit(blocks)).cast("int"))
           .repartitionById(blocks, F.col("block")))
    order = Window.partitionBy("block", "conv_id", "dropped").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    initial = F.substring("role", 1, 1)
    same = Window.partitionBy("block", "conv_id", "dropped", "role", "text").orderBy("at")
    return (own.withColumns({"at": F.row_number().over(order), "before": F.lag(initial).over(order),
                             "new_turn": F.col("turn").isNotNull() & ~F.coalesce(F.lag("turn").over(order) == F.col("turn"), F.lit(False))})
            .withColumn("earlier", F.row_number().over(same) > 1)
            .withColumn("fault", F.when(~F.col("text").rlike(_SIGN), 1).when(F.col("earlier"), 2)
                        .when(~F.col("text").rlike(_ENDS), 3).otherwise(0))
            .withColumn("illegal", F.col("before").isNotNull()
                        & ~F.concat_ws(":", "before", initial).isin("s:u", "u:a", "a:u")))


def _stream(faulty: DataFrame) -> DataFrame:
    """Each block's rows without texts (phase 0, all of them), then the texts of those that can stay (phase 1)."""
    initial = F.substring("role", 1, 1)
    code = F.coalesce(*(F.when(initial == c, i) for i, c in enumerate(INITIALS)), F.lit(3))
    symbol = F.when(F.col("dropped"), -1).when(F.col("fault").isin(1, 2), GONE).otherwise(
        code + F.when(F.col("fault") == 3, 4).otherwise(0))
    stays = ~F.col("dropped") & F.col("fault").isin(0, 3)
    both = F.when(stays, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    marks = F.col("fault") + 4 * F.col("illegal").cast("int") + 8 * F.col("new_turn").cast("int")
    return (faulty.select("block", "conv_id", "turn", "at", symbol.cast("int").alias("symbol"), marks.alias("marks"), "role", "text",
                          F.explode(both).alias("phase"))
            .select("block", "phase", "conv_id", "at", "symbol", "marks", "turn",
                    *(F.when(F.col("phase") == 1, F.col(c)).alias(c) for c in ("role", "text")))
            .sortWithinPartitions("block", "phase", "conv_id", "at"))


class _Block:
    """Conversations of one block: summaries from phase 0, then repaired rows as the texts come."""

    def __init__(self):
        self.ids, self.symbols, self.counts, self.turns = [], [], [], []

    def add(self, ids, symbols: np.ndarray, marks: np.ndarray, turns: np.ndarray, has_turn: np.ndarray) -> None:
        """Phase 0 rows in order; a conversation may go on from the rows before."""
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
            key = ids[a]
            if not self.ids or self.ids[-1] != key:
                self.ids.append(key)
                self.symbols.append(bytearray())
                self.counts.append(np.zeros(5, np.int64))   # blank, duplicate, truncated, illegal, distinct turns
                self.turns.append(None)
            here = symbols[a:b] >= 0
            own = marks[a:b][here]
            self.symbols[-1] += symbols[a:b][here].astype(np.uint8).tobytes()
            self.counts[-1] += [int((own & 3 == 1).sum()), int((own & 3 == 2).sum()), int((own & 3 == 3).sum()),
                                int((own & 4 > 0).sum()), int((own & 8 > 0).sum())]
            known = turns[a:b][here & has_turn[a:b]]
            if len(known):
                low, high = int(known.min()), int(known.max())
                old = self.turns[-1]
                self.turns[-1] = (min(low, old[0]), max(high, old[1])) if old else (low, high)

    def solve(self) -> None:
        self.solved = repair_sequences([bytes(s) for s in self.symbols])

    def summary(self, i: int) -> tuple:
        blank, duplicate, truncated, illegal, turns = self.counts[i].tolist()
        gaps = self.turns[i][1] - self.turns[i][0] + 1 - turns if self.turns[i] else 0
        return (self.ids[i], gaps, blank, duplicate, truncated, illegal, *self.solved[i])


def _repaired(edits: str, symbols: bytes) -> Iterator[tuple[str, int, str | None]]:
    """(edit, row or -1, new role or None) of every row of the repaired conversation, and of deleted rows."""
    state, row = 0, 0
    for e in edits:
        needed = "assistant" if state == 2 else "user"
        if e == "I":
            yield "I", -1, needed
            state = 3 if needed == "assistant" else 2
            continue
        if e == "K":
            state = 1 if symbols[row] % 4 == 0 else 3 if needed == "assistant" else 2
            yield "K", row, None
        elif e == "R":
            state = 3 if needed == "assistant" else 2
            yield "R", row, needed
        else:
            yield "D", row, None
        row += 1


def _events(batches) -> Iterator[tuple]:
    """('text', conversation, at, role, text) and ('block', block) as the sorted rows of a partition come."""
    block, number, phase = None, None, None
    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        groups = columns["block"].to_numpy() * 2 + columns["phase"].to_numpy()
        starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else []
        for a, b in zip(list(starts), [*list(starts[1:]), len(groups)]):
            now = divmod(int(groups[a]), 2)
            ids = np.array(columns["conv_id"].slice(a, b - a).to_pylist(), object)
            if now[0] != number:
                if block and phase == 0:
                    block.solve()
                    yield "block", block
                if block:
                    yield "end", block
                block, number = _Block(), now[0]
            elif now[1] == 1 and phase == 0:
                block.solve()
                yield "block", block
            phase = now[1]
            if phase == 0:
                turns = columns["turn"].slice(a, b - a)
                block.add(ids, columns["symbol"].slice(a, b - a).to_numpy(), columns["marks"].slice(a, b - a).to_numpy(),
                          turns.fill_null(0).to_numpy(zero_copy_only=False), turns.is_valid().to_numpy(zero_copy_only=False))
            else:
                yield "texts", list(zip(ids.tolist(), *(columns[c].slice(a, b - a).to_pylist() for c in ("at", "role", "text"))))
    if block:
        if phase == 0:
            block.solve()
            yield "block", block
        yield "end", block


def _rows(batches) -> Iterator[tuple]:
    """Repaired conversations in order: ('row', conversation, edit, role, text) and ('done', summary)."""
    block, at, steps, waiting = None, 0, None, None

    def until(row: int | None):
        """Events of the conversation at hand up to an original row (None: to the end)."""
        nonlocal waiting
        while True:
            step = waiting or next(steps, None)
            waiting = None
            if step is None:
                return
            if step[0] != "I" and row is not None and step[1] >= row:
                waiting = step
                return
            yield step

    def finish(stop):
        """Conversations without further texts up to the one with id ``stop`` (or all)."""
        nonlocal at, steps
        while at < len(block.ids) and (stop is _END or block.ids[at] != stop):
            steps = steps or _repaired(block.solved[at][1], bytes(block.symbols[at]))
            for edit, _, role in until(None):
                if edit == "I":
                    yield "row", block.ids[at], "I", role, ""
            yield "done", block.summary(at)
            at, steps = at + 1, None

    for kind, value in _events(batches):
        if kind == "block":
            block, at, steps, waiting = value, 0, None, None
        elif kind == "end":
            yield from finish(_END)
        else:
            for conv, place, role, text in value:
                yield from finish(conv)
                steps = steps or _repaired(block.solved[at][1], bytes(block.symbols[at]))
                for edit, _, new in until(place - 1):
                    if edit == "I":
                        yield "row", conv, "I", new, ""
                step, waiting = waiting, None
                if step[0] != "D":
                    yield "row", conv, step[0], step[2] or role, text


_END = object()


def _block_count(rows: DataFrame, rows_a_block: int) -> int:
    return max(8, -(-rows.count() // rows_a_block))


def _made(rows: DataFrame, rows_a_block: int, work, fields: list[tuple[str, pa.DataType]]) -> DataFrame:
    """The tuples that ``work`` makes of each partition's sorted rows, conv_id first."""
    from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
    fields = [("conv_id", to_arrow_type(rows.schema["conv_id"].dataType)), *fields]
    schema = ", ".join(f"`{name}` {from_arrow_type(kind).simpleString()}" for name, kind in fields)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), fields)], [n for n, _ in fields])

    def run(batches):
        out, size = [], 0
        for made in work(batches):
            out.append(made)
            size += sum(len(x) for x in made if isinstance(x, str))
            if len(out) >= 5000 or size > 4 << 20:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    return _stream(with_faults(rows, _block_count(rows, rows_a_block))).mapInArrow(run, schema)


def summarise(rows: DataFrame, rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``.

    ``rows`` has ``conv_id, turn, role, text`` and may have ``dropped`` (rows that only make their
    conversation known); other columns are not read. Rows are taken by turn (null first), rows of one turn
    by role and text. Null role and text count as one space; null conv_id is a conversation of its own.
    ``gaps`` counts the turns missing between the first and the last. ``audit`` has one letter per edit
    (keep, rerole, delete, insert), ``cost`` is their sum. The hash is over ``role:text`` of the repaired
    rows, joined by line feeds. A conversation without rows has zeros, no edits and the hash of nothing;
    an empty table gives no rows.

    Rows are shuffled once. A task holds a byte a row and the edits of a block's conversations, and streams
    the texts: a hash is made in order, so a conversation is one task's work, but never held whole.
    """
    def work(batches):
        state = None
        for event in _rows(batches):
            if event[0] == "done":
                yield *event[1], (state or hashlib.sha256()).hexdigest()
                state = None
                continue
            if state is None:
                state = hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{event[3]}:{event[4]}".encode())

    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return _made(rows, rows_a_block, work, [*((c, pa.int64()) for c in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repair(rows: DataFrame, rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """The repaired conversations: ``conv_id, position, role, text, edit`` (position from 1, edit K, R or I).

    Input, order and odd values as in :func:`summarise`; conversations without rows left have none here.
    """
    def work(batches):
        position = 0
        for event in _rows(batches):
            position = 0 if event[0] == "done" else position + 1
            if position:
                yield event[1], position, event[3], event[4], event[2]

    return _made(rows, rows_a_block, work, [("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
