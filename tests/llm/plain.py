"""Plain versions of the operators for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def targets(sizes, weights=(1, 2, 3), most=3):
    """Round by round: give by weight, cap, give out the excess."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    share = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total = sum(share[s] for s in open_)
        for s in open_:
            target[s] += left * share[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def substring(docs, size=13):
    """id -> (n_words, n_removed, kept) of (id, text) pairs."""
    first = {}
    for i, t in docs:
        w = words(t)
        for j in range(len(w) - size + 1):
            key = tuple(w[j : j + size])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = {k for j in range(len(w) - size + 1) if first[tuple(w[j : j + size])] < i for k in range(j, j + size)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def lines(docs, size=2, long=40):
    """id -> text without repeated runs of lines."""
    first, runs = {}, defaultdict(list)
    for i, t in docs:
        own = [(n, x) for n, x in enumerate((t or "").split("\n")) if WORD.search(x)]
        for j in range(len(own)):
            parts = [own[j : j + size]] if j + size <= len(own) else []
            parts += [own[j : j + 1]] if len(own[j][1]) >= long else []
            for part in parts:
                key = tuple(x for _, x in part)
                at = (i, part[0][0])
                first[key] = min(first.get(key, at), at)
                runs[i].append((key, at, [n for n, _ in part]))
    out = {}
    for i, t in docs:
        gone = {n for key, at, nos in runs[i] if at > first[key] for n in nos}
        out[i] = "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in gone) if gone else t
    return out


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def classes(docs, similarity=0.8):
    """id -> (class, links)."""
    sets = [(i, shingles(t)) for i, t in docs]
    link = {i: [j for j, b in sets if j != i and jaccard(a, b) >= similarity] for i, a in sets}
    out = {}
    for start in sorted(link):
        todo, seen = [start], {start}
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[start] = (min(seen), len(link[start]))
    return out
