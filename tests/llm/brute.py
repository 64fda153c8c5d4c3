"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def exact_groups(docs):
    """doc_id -> (keep_id, group_size, kept, sha256)."""
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return {
        d: (min(ids), len(ids), d == min(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for d in ids
    }


def shingles(text, width=5):
    w = words(lowered(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def near_groups(docs, percent=85):
    """doc_id -> (n_shingles, component_id, kept)."""
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    found = components(ids, links)
    return {d: (len(sets[d]), found[d], found[d] == d) for d in ids}


def _covered(starts, width, n):
    gone = [False] * n
    for s in starts:
        gone[s : s + width] = [True] * width
    return gone


def without_windows(docs, parts, width, counts=lambda window: True):
    """doc_id -> list of (part, whether it goes): windows that also start earlier take their parts."""
    first = {}
    places = defaultdict(list)
    for doc_id, text in sorted(docs):
        p = parts(text)
        for i in range(len(p) - width + 1):
            window = tuple(p[i : i + width])
            if counts(window):
                if first.setdefault(window, (doc_id, i)) < (doc_id, i):
                    places[doc_id].append(i)
    return {d: list(zip(p := parts(t), _covered(places[d], width, len(p)), strict=True)) for d, t in docs}


def lines_left(docs):
    """doc_id -> (n_lines, n_removed, text)."""
    found = without_windows(
        docs, lambda t: [] if t is None else t.split("\n"), 3, lambda w: bool(words("\n".join(w)))
    )
    texts = dict(docs)
    return {
        d: (len(p), sum(g for _, g in p), None if texts[d] is None else "\n".join(x for x, g in p if not g))
        for d, p in found.items()
    }


def words_left(docs, width=20):
    """doc_id -> (n_words, n_removed, sha256 of the rest)."""
    return {
        d: (len(p), sum(g for _, g in p), hashlib.sha256(" ".join(x for x, g in p if not g).encode()).hexdigest())
        for d, p in without_windows(docs, words, width).items()
    }
