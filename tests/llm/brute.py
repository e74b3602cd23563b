"""Plain versions of the operators, and the documents they are compared on."""

import hashlib
import random
import re
from collections import Counter

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def documents(seed=7, count=60):
    """Documents with copies, near copies, shared passages, runs, odd texts, nulls and repeated rows."""
    rng = random.Random(seed)
    word = lambda: rng.choice("ab") + "".join(rng.choice("eiortn") for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(70))
    rows = []
    for i in range(count):
        text = " ".join(word() for _ in range(rng.randint(3, 160)))
        kind = i % 6
        if kind == 1:
            text = rows[-1][1]
        elif kind == 2:
            words = rows[-1][1].split()
            words[rng.randrange(len(words))] = "edit"
            text = " ".join(words)
        elif kind == 3:
            text += "\n" + passage + "\t" + text[:200]
        elif kind == 4:
            text = "again " * rng.randint(40, 130) + text
        rows.append((i, text))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one"), (905, " nbsp　wide É")]
    rows += [(None, passage), rows[3], (906, rows[3][1])]
    return rows


def words(text):
    return SPACE.findall((text or "").encode())


def repeats(rows, window=50):
    last = float("inf")
    order = lambda key: last if key is None else key
    first = {}
    split = [(k, words(t)) for k, t in rows]
    for k, w in split:
        for i in range(len(w) - window + 1):
            at = tuple(w[i : i + window])
            first[at] = min(first.get(at, last), order(k))
    out = []
    for k, w in split:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(k):
                keep[i : i + window] = [False] * window
        kept = [x for x, y in zip(w, keep) if y]
        out.append((k, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def shingles(text, width):
    w = [x.lower() for x in words(text)]
    n = min(width, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def components(names, linked):
    """Least name reachable, for rows by index; `linked(i, j)` tells direct links."""
    parent = list(range(len(names)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(names)):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    best = {}
    for i, name in enumerate(names):
        if name is not None:
            best[root(i)] = min(best.get(root(i), name), name)
    return [best.get(root(i)) for i in range(len(names))]


def leaks(docs, items, least=0.8):
    def runs(text):
        w = [x.lower() for x in words(text)]
        return w

    def grams(w, n):
        n = min(n, len(w))
        return [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] if w else []

    out = set()
    for d, text in docs:
        for item, passage in items:
            want = runs(passage)
            size = min(5, len(want))
            target, have = Counter(grams(want, size)), grams(runs(text), size) if len(runs(text)) >= size else []
            if not want or not have:
                continue
            total, span, best = sum(target.values()), min(len(grams(want, size)), len(have)), 0
            for i in range(len(have) - span + 1):
                part = Counter(have[i : i + span])
                both = sum((part & target).values())
                best = max(best, both / (total + span - both))
            if best >= least:
                out.add((d, item, round(best, 6)))
    return out
