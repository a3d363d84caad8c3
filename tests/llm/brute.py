"""Plain Python versions of the operators, without any of their code."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def line_dedup(docs, size=3):
    """{doc_id: (n_lines, n_removed, kept)} for (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: order(d[0])):
        lines = [] if text is None else text.split("\n")
        gone = set()
        for i in range(len(lines) - size + 1):
            window = tuple(lines[i : i + size])
            gone |= set(range(i, i + size)) if window in seen else set()
            seen.add(window)
        out[doc_id] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def substring_dedup(docs, size=20):
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: order(d[0])):
        words = SPACE_WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            gone |= set(range(i, i + size)) if window in seen else set()
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def simhash(text, k=3):
    words = SPACE_WORD.findall(lower(text or ""))
    if not words:
        return 0
    pieces = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(nodes, linked):
    """{node: least node reachable}."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def decontaminate(docs, items, span=10):
    """{doc_id: (n_words, n_hit, [item ids])}."""
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM_WORD.findall(lower(text or ""))
        m = min(len(words), span)
        for i in range(len(words) - m + 1 if m else 0):
            windows[tuple(words[i : i + m])].add(item)
    out = {}
    for doc_id, text in docs:
        words = ALNUM_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for m in {len(w) for w in windows}:
            for i in range(len(words) - m + 1):
                ids = windows.get(tuple(words[i : i + m]))
                if ids:
                    hit |= set(range(i, i + m))
                    found |= ids
        out[doc_id] = (len(words), len(hit), sorted(map(str, found)))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target}: excess above the stop is shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        free = [s for s in names if s not in fixed]
        left = sum(sizes.values()) - sum(fixed.values())
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: most * sizes[s] for s in over}
