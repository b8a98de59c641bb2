"""Plain versions of the operators' contracts, for small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}
PII = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
       ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
       ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """Component label (smallest id) of (id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def rules(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def pii(text):
    out = []
    for k, (_, pattern) in enumerate(PII):
        for m in pattern.finditer(text or ""):
            g = m.group()
            digits = re.sub(r"[^0-9]", "", g)
            if k == 1 and any(int(p) > 255 for p in g.split(".")):
                continue
            if k == 2:
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
                if not 14 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in doubled) % 10:
                    continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)
