"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """{(id, text): (keep_id, size)} by normalised text."""
    groups = {}
    for i, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    return [(i, min((x for x in g if x is not None), default=None), len(g), sha(n))
            for i, t in rows for n in [SPACE.sub(" ", t or "")] for g in [groups[n]]]


def shingles(text, k=5):
    w = words(lower(text))
    return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows):
    """{id: (n_shingles, component)}: all pairs compared, ids distinct."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((top(a), top(b)))
                parent[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


def removed(rows, n=13):
    """[(id, n_words, n_removed, sha)] in row order."""
    first = {}
    cut = [(i, words(t)) for i, t in rows]
    rank = lambda i: float("inf") if i is None else i
    for i, w in cut:
        for j in range(len(w) - n + 1):
            g = tuple(w[j:j + n])
            first[g] = min(first.get(g, float("inf")), rank(i))
    out = []
    for i, w in cut:
        gone = {j + d for j in range(len(w) - n + 1) if first[tuple(w[j:j + n])] < rank(i) for d in range(n)}
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + d for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for d in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    """[(start, kind number, kind, end)] of the base kinds."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)
