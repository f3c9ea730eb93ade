"""Plain versions of the operators, one row or pair at a time."""

import hashlib
import itertools
import re

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))      # A-Z to a-z


def az(text):
    return text.encode().translate(LOWER).decode()


def least_reachable(nodes, links):
    """node -> the smallest node reachable."""
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", az(text or ""))
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def near_documents(rows, width, percent):
    """doc_id -> (n_shingles, component)."""
    sets = {i: shingles(t, width) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    of = least_reachable(sets, links)
    return {i: (len(sets[i]), of[i]) for i in sets}


def lines(rows, min_chars=20, min_docs=3):
    """doc_id -> (n_lines, n_dropped, kept text)."""
    key = lambda line: az(line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in rows:
        whole = (t or "").split("\n")
        kept = [x for x in whole if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(whole), len(whole) - len(kept), "\n".join(kept))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contained(docs, items, threshold=0.8, width=5):
    """{(doc_id, item_id): (n_shared, n_item)}."""
    words = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())
    runs = lambda w, n: {(n, *w[i:i + n]) for i in range(len(w) - n + 1)}
    out = {}
    texts = {i: words(t) for i, t in docs}
    for j, t in items:
        w = words(t)
        if w:
            n = min(width, len(w))
            own = runs(w, n)
            for i, d in texts.items():
                shared = len(own & runs(d, n))
                if shared >= threshold * len(own):
                    out[i, j] = (shared, len(own))
    return out
