"""Simple-8b word-aligned coding of unsigned integers, vectorised both ways.

A 64-bit word holds a selector in its top four bits and as many equal-width values as fit in the
other sixty. Values of more than sixty bits are escapes: they take a place of 0 and are listed apart.
"""

import numpy as np

#: Fixed values of the format: selector -> (values in a word, bits of a value).
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
COUNTS = np.array([c for c, _ in SELECTORS], dtype=np.int64)
BITS = np.array([b for _, b in SELECTORS], dtype=np.int64)
_DOUBLED = 6
LARGEST = np.uint64((1 << 60) - 1)


def _runs(holds: np.ndarray, count: int) -> np.ndarray:
    """Whether ``count`` places in a row hold, for every place that has as many."""
    width = 1
    while width < count:
        step = min(width, count - width)
        holds = holds[:-step] & holds[step:]
        width += step
    return holds


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, places of escapes, values of escapes)."""
    values = values.astype(np.uint64)
    n = len(values)
    places = np.flatnonzero(values > LARGEST)
    escaped = values[places]
    if len(places):
        values = values.copy()
        values[places] = 0
    # widest first: a narrower selector that holds at i takes over
    chosen = np.full(n, len(SELECTORS) - 1, dtype=np.uint8)
    most = int(values.max()) if n else 0
    narrow = values.astype(np.uint32) if most < 1 << 32 else values
    for k in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[k]
        if count > n:
            break
        if most < 1 << bits:
            chosen[: n - count + 1] = k
            continue
        holds = _runs(narrow < (1 << bits), count)
        if not holds.any():
            if bits < 8:  # nor will narrower ones
                break
            continue
        chosen[: len(holds)][holds] = k
    # words begin at 0 and then where the last one ends: steps are doubled a few times, the long
    # ones are walked one by one and the shorter ones fill the places between
    steps = [np.append(np.minimum(np.arange(n) + COUNTS[chosen], n), n)]
    for _ in range(_DOUBLED):
        steps.append(steps[-1][steps[-1]])
    long, coarse, place = steps.pop(), [], 0
    while place < n:
        coarse.append(place)
        place = int(long[place])
    at = np.array(coarse, dtype=np.int64)
    for short in reversed(steps):
        at = np.stack((at, short[at]), axis=1).ravel()
    at = at[: np.searchsorted(at, n)]
    selector = chosen[at].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    for k in np.unique(selector):
        count, bits = SELECTORS[k]
        if bits:
            rows = np.flatnonzero(selector == k)
            first, packed = at[rows], np.zeros(len(rows), dtype=np.uint64)
            for place in range(count):
                packed |= values[first + place] << np.uint64(place * bits)
            words[rows] |= packed
    return words, places, escaped


def decode(words: np.ndarray, places: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for k in np.unique(selector):
        count, bits = SELECTORS[k]
        if bits:
            rows = np.flatnonzero(selector == k)
            first, packed = begin[rows], words[rows]
            mask = np.uint64((1 << bits) - 1)
            for place in range(count):
                out[first + place] = (packed >> np.uint64(place * bits)) & mask
    out[places] = escaped
    return out


def offsets(words: np.ndarray, step: int) -> np.ndarray:
    """Number of values before every ``step``-th word, for decoding from the middle."""
    counts = COUNTS[(words >> np.uint64(60)).astype(np.int64)]
    return (np.cumsum(counts) - counts)[::step]
