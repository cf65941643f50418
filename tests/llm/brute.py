"""Plain one-machine versions of the operators, on lists of rows."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def joined(edges, nodes):
    """Least member of each node's component."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), sha(t or "")) for i, t in rows}


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def near(rows, k, threshold=80):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    edges = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    comp = joined(edges, sets)
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def repeats(rows, window=13):
    first, out = {}, {}
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first.setdefault(tuple(w[j:j + window]), i) < i:
                gone[j:j + window] = [True] * window
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def addresses(pattern, text):
    """An address holds no blank and one @: stretches without one are passed over, where the pattern would try each letter to the stretch's end."""
    blank = r"[\x20\n\t\r]"
    for stretch in re.finditer(blank.replace("[", "[^") + "+", text):
        if "@" in stretch[0]:
            yield from re.compile(pattern).finditer(text, *stretch.span())


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in addresses(pattern, text or "") if kind == "email" else re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def pfair(counts, weights, block_rows):
    """{(source, block): (phase, slot, release, deadline)} by going through the slots one by one."""
    left = {s: -(-n // block_rows) for s, n in counts.items() if n}
    out, done, slot, phase = {}, Counter(), 0, 0
    while left:
        total, begin, ran, over = sum(weights[s] for s in left), slot, Counter(), False
        while not over:
            ready = [(-(-(ran[s] + 1) * total // weights[s]), -(-(ran[s] + 2) * total // weights[s]), s) for s in left if ran[s] * total // weights[s] <= slot - begin]
            due, _, s = min(ready)
            out[s, done[s]] = (phase, slot, begin + ran[s] * total // weights[s], begin + due)
            ran[s] += 1
            done[s] += 1
            left[s] -= 1
            slot += 1
            for x in ran | dict.fromkeys(left, 0):
                assert abs(ran[x] - weights[x] / total * (slot - begin)) < 1
            if not left[s]:
                del left[s]
                over = True
        phase += 1
    return out
