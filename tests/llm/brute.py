"""Plain answers to small inputs, one document at a time."""

import collections
import hashlib
import re

ANY_WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicates(docs, width):
    """[(id, text)] -> {id: (n_shingles, component, kept)}"""
    sets = {}
    for i, t in docs:
        w = ANY_WORD.findall(low(t))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for j in {j for x in sets[i] for j in holders[x]}:
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for x in sets[i]:
            holders[x].append(i)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def contamination(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM_WORD.findall(low(t))
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n and i is not None else ():
            windows[tuple(w[k : k + n])].add(str(i))
    sizes, out = {len(w) for w in windows}, {}
    for i, t in docs:
        w = ALNUM_WORD.findall(low(t))
        hit, items_hit = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    items_hit |= found
                    hit.update(range(k, k + n))
        out[i] = (len(w), len(hit), sorted(items_hit), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    spans = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((kind, m.start(), m.end()))
    return spans


def without_boilerplate(docs, sites=10):
    """[(id, text, source)] -> {id: text}"""
    seen = collections.defaultdict(set)
    for _, t, s in docs:
        for line in (t or "").split("\n"):
            if line.strip(" ") and s is not None:
                seen[line].add(s)
    out = {}
    for i, t, _ in docs:
        if t is None:
            out[i] = None
            continue
        kept = [x for x in t.split("\n") if not (x.strip(" ") and len(seen[x]) >= sites)]
        out[i] = "\n".join(kept) if any(x.strip(" ") for x in kept) else t
    return out
