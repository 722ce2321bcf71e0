"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def lower(text):
    return (text or "").translate(UPPER)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminated(docs, items, window=10):
    """doc_id -> n_words, n_hit, n_items, digest of items."""
    found = defaultdict(set)
    for item, text in items:
        w = LETTERS.findall(lower(text))
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            found[tuple(w[i : i + k])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, met = LETTERS.findall(lower(text)), set(), set()
        for k in {len(x) for x in found}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in found:
                    hit.update(range(i, i + k))
                    met |= found[tuple(w[i : i + k])]
        out.append((doc, len(w), len(hit), len(met), sha(",".join(sorted(met)))))
    return out


def substring_dedup(docs, window=13):
    last = math.inf
    first: dict = {}
    for doc, text in docs:
        w = SPACED.findall(text or "")
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, last), last if doc is None else doc)
    out = []
    for doc, text in docs:
        w, gone = SPACED.findall(text or ""), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (last if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), sha(kept)))
    return out


def jaccard_components(docs, k, num, den):
    """(doc_id, set size, component) of each row; one node per doc_id."""
    rows = []
    for doc, text in docs:
        w = SPACED.findall(lower(text))
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        rows.append((doc, grams))
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and den * len(x & y) >= num * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(d, len(g), find(d) if g or find(d) != d else d) for d, g in rows]


def lm_scores(docs, add=0.1, folds=10, shares=(0.02, 0.98)):
    end = None
    rows = []
    for doc, text in docs:
        held = zlib.crc32(("" if doc is None else str(doc)).encode()) % folds == 0
        rows.append((doc, held, [*SPACED.findall(lower(text)), end]))
    words, pairs = Counter(), Counter()
    for _, held, t in rows:
        if not held:
            words.update(t)
            pairs.update(zip([end, *t], t, strict=False))
    n, v = sum(words.values()), len(words)
    kind = lambda c: math.frexp(c)[1]
    steps, once = Counter(), Counter()
    for (u, _), c in pairs.items():
        steps[kind(words[u])] += c
        once[kind(words[u])] += c == 1
    low, high = shares
    share = {k: min(max(once[k] / steps[k], low), high) for k in steps}
    root = lambda w: (words[w] + add) / (n + add * (v + 1))
    out = []
    for doc, held, t in rows:
        base = sum(math.log10(root(w)) for w in t)
        score = 0.0
        for u, w in zip([end, *t], t, strict=False):
            s = share[kind(words[u])] if words[u] else 1
            arc = (1 - s) * pairs[u, w] / words[u] if words[u] else 0
            score += math.log10(arc + s * root(w))
        out.append((doc, held, len(t), sum(words[w] > 0 for w in t), n, base, score))
    return out, words, pairs, share, root


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def within(a, b, most):
    """Are the texts at most that many edits apart? Only the band of the table is filled."""
    if abs(len(a) - len(b)) > most:
        return False
    far = most + 1
    last = {j: j for j in range(most + 1)}
    for i, x in enumerate(a, 1):
        row = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            row[j] = (
                i
                if j == 0
                else min(last.get(j, far) + 1, row.get(j - 1, far) + 1, last.get(j - 1, far) + (x != b[j - 1]))
            )
        last = row
        if min(row.values()) > most:
            return False
    return last.get(len(b), far) <= most


def line_dedup(docs, most=2, min_chars=20):
    """Kept text of each row; of equal ids the row that is given first comes first."""
    last = math.inf
    first: dict = {}
    place = lambda row, doc, i: (last if doc is None else doc, row, i)
    for row, (doc, text) in enumerate(docs):
        for i, line in enumerate((text or "").split("\n")):
            if len(line) >= min_chars:
                first[line] = min(first.get(line, (last, last, last)), place(row, doc, i))
    early = {a: min(first[b] for b in first if within(a, b, most)) for a in first}
    return [
        (
            doc,
            None
            if text is None
            else "\n".join(
                x
                for i, x in enumerate(text.split("\n"))
                if len(x) < min_chars or early[x] >= place(row, doc, i)
            ),
        )
        for row, (doc, text) in enumerate(docs)
    ]


def emptied(text, kept):
    """Did line dedup take all the words there were?"""
    return bool(SPACED.search(text or "")) and not SPACED.search(kept or "")
