import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from cellwatch.llm import conversation_repair as cr

SPACE = " \t\n\v\f\r"
GOAL = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        code = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        kept = text.strip(SPACE)
        out.append(1 if not kept else 2 if (role, text) in seen else 3 if kept[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def plain_repair(initials, faults):
    """Cheapest edits, from the last row backwards: (cost, edits) to finish from a state."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {q: min(((3 * k, "I" * k) for k in range(3) if walk(step, q, k) in ("", "a")), default=None) for q in ("", "s", "u", "a")}
    for initial, fault in list(zip(initials, faults))[::-1]:
        row = {}
        for q in best:
            ways = [(4 + best[q][0], "D" + best[q][1])]
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                for role in "sua":
                    to = step.get((q, role))
                    if to and initial == role:
                        ways.append((extra + best[to][0], "K" + best[to][1]))
                    if to and role != "s":
                        ways.append((3 + extra + best[to][0], "R" + best[to][1]))
            row[q] = min(ways)
        best = {q: min((3 * k + row[t][0], "I" * k + row[t][1]) for k in range(4) if (t := walk(step, q, k)) is not None) for q in row}
    return best[""]


def walk(step, state, k):
    """State after k inserted rows."""
    for _ in range(k):
        state = "a" if state == "u" else "u"
    return state


def plain_rows(rows, edits):
    out, left = [], list(rows)
    for e in edits:
        needed = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if e == "I":
            out.append((needed, ""))
            continue
        _, _, role, text = left.pop(0)
        if e != "D":
            out.append((role if e == "K" else needed, text))
    return out


def plain(rows, ids):
    """Results by conversation, of damaged rows."""
    out = {}
    for conv in ids:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, initials = plain_faults(mine), [r[2][:1] for r in mine]
        turns = {r[1] for r in mine if r[1] is not None}
        cost, edits = plain_repair(initials, faults)
        fixed = plain_rows(mine, edits)
        assert GOAL.match("".join(r[:1] for r, _ in fixed))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in (1, 2, 3)),
                     sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, edits,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def exhaustive(initials, faults):
    """Least (cost, edits) over every choice of edits and inserted rows."""
    best = None

    def go(i, roles, cost, edits, inserts):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(initials) and GOAL.match(roles):
            best = min(best or (cost, edits), (cost, edits))
        if inserts < 6:
            for role in "ua":
                go(i, roles + role, cost + 3, edits + "I", inserts + 1)
        if i < len(initials):
            go(i + 1, roles, cost + 4, edits + "D", inserts)
            if faults[i] not in (1, 2):
                extra = 3 * (faults[i] == 3)
                go(i + 1, roles + (initials[i] or "?"), cost + extra, edits + "K", inserts)
                for role in "ua":
                    go(i + 1, roles + role, cost + 3 + extra, edits + "R", inserts)

    go(0, "", 0, "", 0)
    return best


def symbols(initials, faults):
    return bytes(8 if f in (1, 2) else ("sua".find(i) if i and i in "sua" else 3) + 4 * (f == 3) for i, f in zip(initials, faults))


def test_plain_repair_is_the_least_of_all():
    rnd = random.Random(5)
    for _ in range(60):
        n = rnd.randrange(4)
        initials, faults = [rnd.choice("suax") for _ in range(n)], [rnd.choice([0, 0, 1, 3]) for _ in range(n)]
        assert plain_repair(initials, faults) == exhaustive(initials, faults)


def test_grammar_equals_plain_repair(monkeypatch):
    rnd = random.Random(6)
    cases = [([rnd.choice("suuaaa?") for _ in range(n)], [rnd.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)])
             for n in [*range(30), *[rnd.randrange(12) for _ in range(400)], 300, 300, 900]]
    cases += [(list("ua") * 200, [0] * 400), (list("u") * 500, [0] * 500), (list("ax") * 130, [3] * 260), (["a"] * 700, [2] * 700)]
    for flat in (48, 3):
        monkeypatch.setattr(cr, "_FLAT", flat)
        monkeypatch.setitem(cr._KEPT, "grammar", cr.Grammar())
        assert cr.repair_sequences([symbols(*c) for c in cases]) == [plain_repair(*c) for c in cases]
        rnd.shuffle(cases)
        assert cr.repair_sequences([symbols(*c) for c in cases]) == [plain_repair(*c) for c in cases]


def test_re_pair_shares_rules_and_loses_nothing():
    rnd = random.Random(7)
    grammar = cr.Grammar()
    sequences = [bytes(rnd.choice([0, 1, 2, 1, 2, 5]) for _ in range(rnd.randrange(40))) for _ in range(200)] + [b"", bytes([1]) * 33]
    sizes = np.array([len(s) for s in sequences])
    packed = cr.re_pair(np.frombuffer(b"".join(sequences), np.uint8), sizes, np.ones(len(sequences), np.int64), grammar)
    back = {v: k for k, v in grammar.rules.items()}

    def unfold(x):
        return unfold(back[x][0]) + unfold(back[x][1]) if x in back else [x]

    assert [bytes(y for x in p for y in unfold(x)) for p in packed] == sequences
    pairs = [(a, b) for p in packed for a, b in itertools.pairwise(p) if a != b]
    assert len(set(pairs)) == len(pairs)                 # no pair is left twice
    assert len(grammar.matrices) == cr.SYMBOLS + len(grammar.rules)
    # Equal conversations become one symbol.
    again = cr.re_pair(np.array([1, 2, 1, 2], np.uint8), np.array([4]), np.array([2]), grammar)
    assert len(again[0]) == 1


def test_ropes_compare_like_strings(monkeypatch):
    monkeypatch.setattr(cr, "_FLAT", 2)
    rnd = random.Random(8)

    def build(text):
        if len(text) < 2:
            return text
        k = rnd.randrange(len(text) + 1)
        return cr.joined(build(text[:k]), build(text[k:])) if 0 < k < len(text) else text

    for _ in range(500):
        head = "".join(rnd.choice("DIKR") for _ in range(rnd.randrange(20)))
        a, b = (head + "".join(rnd.choice("DK") for _ in range(4)) for _ in range(2))
        x, y = build(a), build(b)
        assert "".join(cr.leaves(x)) == a and cr.less(x, y) == (a < b) and cr.less(y, x) == (b < a)


ODD = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (1, 4, "user", "Bye"),
       (2, 0, "user", None), (2, None, None, "No turn."), (2, None, "user", "No turn."), (2, 3, "assistant", "\t \n"),
       (None, 1, "user", "Nobody."), (None, None, None, None), (3, 5, "", "x."), (3, 5, "", "x."), (3, 5, "tool", "y?"),
       (3, -9, "unknown", "z!  "), (4, 1, "assistant", "long. " * 40_000), (5, 7, "user", "é漢\U0001F600"), (5, 8, "User", "A."),
       (6, 1, "user", "Same."), (6, 2, "assistant", "One."), (6, 3, "user", "Same."), (7, 1, ":", "s.")]


def frame(spark, rows, more=""):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", *(F.lit(3).alias(c) for c in ("block", "phase", "at", "symbol", "marks", "code", "again", "fault", "audit", "cost"))) if more else df


def as_rows(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("size", [1, 4, 50_000])
def test_summary_of_odd_rows(spark, size):
    df = frame(spark, ODD, "clash")
    # Without damage nulls count as a space as well.
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD]
    assert as_rows(cr.summarise(df, size)) == plain(rows, {r[0] for r in ODD})
    assert as_rows(cr.summarise(cr.damage(df), size)) == plain(plain_damage(ODD), {r[0] for r in ODD})


def test_many_and_long_conversations(spark):
    rnd = random.Random(11)
    words = ["Yes.", "No", "Why?", "", "  ", "Go on!", "It is so. ", "Hm"]
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", "tool"]), rnd.choice(words) if rnd.random() < .5 else f"Row {c} {t}.")
            for c in range(300) for t in range(rnd.randrange(1, 9)) if rnd.random() < .9]
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}." if t % 17 else "again.") for t in range(6000)]
    ids = {r[0] for r in rows}
    got = as_rows(cr.summarise(cr.damage(frame(spark, rows)), 500))
    assert got == plain(plain_damage(rows), ids)


def test_repaired_rows(spark):
    df = cr.damage(frame(spark, ODD))
    hashes = {r.conv_id: r.repaired_sha256 for r in cr.summarise(df, 3).collect()}
    made = {}
    for r in cr.repair(df, 3).collect():
        made.setdefault(r.conv_id, []).append((r.position, r.role, r.text, r.edit))
    for conv, want in hashes.items():
        mine = sorted(made.get(conv, []))
        assert [p for p, *_ in mine] == list(range(1, len(mine) + 1))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t, _ in mine).encode()).hexdigest() == want


def test_nothing(spark):
    none = frame(spark, [])
    assert cr.summarise(none).count() == 0 and cr.repair(none).count() == 0 and cr.summarise(cr.damage(none)).count() == 0


def test_conversation_without_rows_left(spark):
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = cr.summarise(cr.damage(frame(spark, [(*gone, "user", "Hello.")]))).collect()
    assert [tuple(r) for r in got] == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query(spark):
    from cellwatch.llm.queries import op11_conversation_repair
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(op11_conversation_repair(spark, path)) == plain(plain_damage(rows), {r[0] for r in rows})


def test_one_shuffle(spark):
    plan = cr.summarise(frame(spark, ODD))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
