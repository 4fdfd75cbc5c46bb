"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def least_id(doc_id):
    return -(1 << 63) if doc_id is None else doc_id


def dedup_lines(rows):
    """(doc_id, n_lines, n_dropped, kept) of every (doc_id, text)."""
    holder = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(SPACES))
            if len(key) >= 10:
                holder[key] = min(holder.get(key, least_id(doc_id)), least_id(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if holder.get(lower(x.strip(SPACES)), least_id(doc_id)) == least_id(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text):
    w = words(lower(text or ""))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def classes(rows):
    """{id: smallest id reachable}; rows of one id are one document."""
    parent = {least_id(i): least_id(i) for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(least_id(i), shingles(t)) for i, t in rows]
    for a, (i, s) in enumerate(sets):
        for j, other in sets[:a]:
            if s and other and 100 * len(s & other) >= 75 * len(s | other):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def cut_repeats(rows, size=35):
    """(doc_id, n_words, n_removed, kept) of every (doc_id, text)."""
    times = Counter()
    for _, text in rows:
        w = words(text)
        times.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if times[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def quality_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    places = defaultdict(list)
    for i in range(len(w) - 2):
        places[tuple(w[i : i + 3])].append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated),
    )


def near_copies(base: list[str], n: int, edits: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**9)}"
        out.append(" ".join(copy))
    return out
