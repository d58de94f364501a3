"""Plain versions of the operators, for small tables."""

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def low(text):
    return (text or "").translate(UPPER)


def words(text):
    return SPACE.findall(text or "")


def shingles(text, n):
    w = words(low(text))
    if not w:
        return frozenset()
    if len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_dup(rows, n, percent=80):
    """[(id, text)] -> sorted [(id, size, component, kept)]; quadratic."""
    sets = [shingles(t, n) for _, t in rows]
    named = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    root = {s: s for s in {sets[i] for i in named}}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    distinct = list(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                root[find(a)] = find(b)
    least = {}
    for i in named:
        r = find(sets[i])
        least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    out = []
    for (d, _), s in zip(rows, sets):
        c = least[find(s)] if d is not None and s else d
        out.append((d, len(s), c, d is None or d == c))
    return sorted(out, key=repr)


KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secrets(rows, length=16, digits=2, bits=3.0, max_owners=1):
    """[(id, owner, text)] -> [(id, base spans, all spans)]"""
    import math
    from collections import Counter

    def entropy(v):
        return -sum(c / len(v) * math.log2(c / len(v)) for c in Counter(v).values())

    found, owners = [], {}
    for d, owner, text in rows:
        base = base_spans(text)
        extra = []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text or ""):
            n = sum(c.isdigit() for c in m[0])
            if len(m[0]) >= length and digits <= n < len(m[0]) and entropy(m[0]) >= bits - 1e-12:
                if not any(m.start() < e and s < m.end() for s, _, e, _ in base):
                    extra.append((m.start(), 3, m.end(), m[0]))
        for *_, value in base + extra:
            owners.setdefault(value, set()).add(owner)
        found.append((d, base, extra))
    out = []
    for d, base, extra in found:
        kept = sorted(base + [s for s in extra if len(owners[s[3]]) <= max_owners])
        out.append((d, *(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in x) for x in (base, kept))))
    return sorted(out, key=repr)


def quality_base(text):
    w = words(text)
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i : i + 5]), []).append(i)
    hit = {i + k for places in grams.values() if len(places) > 1 for i in places for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(rows, items, n=10):
    """[(id, text)], [(item, text)] -> sorted [(id, n_words, n_hit, [items])]"""
    grams = {}
    for item, text in items:
        w = ALNUM.findall(low(text))
        for i in range(max(len(w) - n + 1, 1) if w else 0):
            if item is not None:
                grams.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for d, text in rows:
        w, hit, found = ALNUM.findall(low(text)), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found |= grams[tuple(w[i : i + size])]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def line_key(line):
    return low(line.strip(" \t\n\x0b\x0c\r"))


def common_lines(rows, least, keep_first=False):
    """[(id, text)] -> sorted [(id, n_lines, n_dropped, text)]"""
    held, first = {}, {}
    for d, text in rows:
        for key in {line_key(x) for x in (text or "").split("\n")}:
            held[key] = held.get(key, 0) + 1
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        gone = [line_key(x) != "" and held[line_key(x)] >= least and not (keep_first and first.get(line_key(x)) == d) for x in lines]
        out.append((d, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)
