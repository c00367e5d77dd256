"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def line_dedup(docs, documents=3, shortest=20):
    """(doc_id, text, kept text, lines, dropped) per row."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    rows = [(k, t, (t or "").split("\n")) for k, t in docs]
    held = Counter(x for k, _, lines in rows if k is not None for x in {key(line) for line in lines})
    last = {}
    for k, _, lines in rows:
        for line in lines:
            if k is not None:
                last[key(line)] = max(k, last.get(key(line), k))
    out = []
    for k, t, lines in rows:
        bad = [
            k is not None and len(key(x)) >= shortest and held[key(x)] >= documents and k < last[key(x)] for x in lines
        ]
        out.append((k, t, "\n".join(x for x, b in zip(lines, bad) if not b), len(lines), sum(bad)))
    return out


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def components(docs, size=5, percent=75):
    sets = [(k, shingles(t, size)) for k, t in docs]
    group = {k: k for k, _ in docs}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {k: (len(s), root(k)) for k, s in sets}


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, size=13):
    """(words, hit words, items with hits)."""
    w, hit, found = normal(text), set(), set()
    for item, t in items:
        v = normal(t)
        wins = [v[k : k + size] for k in range(max(1, len(v) - size + 1))] if v else []
        for win in wins:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def repeated_strings(docs, length):
    """(bytes, removed, runs, digest of the rest) per row."""
    raw = [(t or "").encode() for t in docs]
    seen = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    return out


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text, lower=False)
    lines = [x for x in text.split("\n") if words(x)]
    wins = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = {k + d for k in range(len(w) - 2) if wins[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def backoff(docs, alpha=0.4, least=2):
    import math

    texts = [words(t) for _, t in docs]
    one, two = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
    total, out = sum(one.values()), defaultdict(float)
    for (k, _), t in zip(docs, texts):
        out[k] += 0.0
        for i, w in enumerate(t):
            if i and two[t[i - 1], w] >= least:
                out[k] += math.log(two[t[i - 1], w] / one[t[i - 1]])
            else:
                out[k] += math.log((alpha if i else 1) * one[w] / total)
    return out
