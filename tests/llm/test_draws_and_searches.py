"""Importance resampling, spelling variants and top products against plain versions: odd rows, ties, repeats, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tallyloom.llm import cover_search, importance, spelling
from tallyloom.llm.crc import of_runs, shift


def test_checksums_of_runs_and_of_strings_put_together():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 6000).astype(np.uint8)
    starts = rng.integers(0, 5000, 200)
    ends = starts + rng.integers(0, 1000, 200)
    got = of_runs(data, starts, ends)
    raw = data.tobytes()
    assert got.tolist() == [zlib.crc32(raw[a:b]) for a, b in zip(starts, ends)]
    before = np.array([zlib.crc32(b"7:")] * 200, dtype=np.uint32)
    assert of_runs(data, starts, ends, before).tolist() == [zlib.crc32(b"7:" + raw[a:b]) for a, b in zip(starts, ends)]
    joined = shift(got[:-1], ends[1:] - starts[1:]) ^ got[1:]
    assert joined.tolist() == [zlib.crc32(raw[a:b] + raw[c:d]) for a, b, c, d in zip(starts, ends, starts[1:], ends[1:])]


# --- importance resampling ----------------------------------------------------------------


def plain_features(text):
    words = brute.normal(text)
    return words, [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def plain_resample(rows, target, percent=5, buckets=10_000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    ours = Counter(bucket(g) for _, t in rows for g in plain_features(t)[1])
    theirs = Counter(bucket(g) for t in target for g in plain_features(t)[1])
    s_all, t_all = sum(ours.values()) + buckets, sum(theirs.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((theirs[b] + 1) * s_all / ((ours[b] + 1) * t_all)))
    out = []
    for k, t in rows:
        words, grams = plain_features(t)
        weight, score = sum(gain(bucket(g)) for g in grams), None
        if k is not None:
            h = int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((k, len(words), len(grams), weight, score))
    able = sorted((k for k, r in enumerate(out) if r[1] >= 20 and r[4] is not None), key=lambda k: (-out[k][4], out[k][0], out[k][2]))
    rank = {k: place + 1 for place, k in enumerate(able[: percent * len(able) // 100])}
    return sorted((r[0] or 0, r[2], r[3], r[4] or 0, rank.get(k, 0)) for k, r in enumerate(out))


@pytest.mark.parametrize("percent", [5, 40])
def test_importance(spark, docs, percent):
    rng = random.Random(percent)
    vocabulary = ["The", "of", "É", "àb", "x1", "2", "a-b", "lorem", "ipsum\n", "ab" * 200] + [f"w{k}" for k in range(60)]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(k, make(rng.randint(1, 60))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " -- "), (103, make(20_000)), (104, "word " * 20), (105, "word " * 20), (None, make(30))]
    rows += [(106, rows[0][1] + " tail " * 20)] * 2  # a repeated row
    target = [make(12) for _ in range(8)] + [None, "", "w1 w2 w3"]
    frame = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    got = importance.resample(docs(*rows), frame, percent=percent).collect()
    assert sorted((r.doc_id or 0, r.n_features, r.weight, r.score or 0, r["rank"] or 0) for r in got) == plain_resample(rows, target, percent)
    assert [r["rank"] for r in got if r.doc_id is None] == [None]


def test_importance_of_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(docs((1, "a b")).where("false"), none).collect() == []
    got = importance.resample(docs((1, "a b"), (2, "word " * 25)), none, percent=100).collect()
    assert {r.doc_id: r["rank"] for r in got} == {1: None, 2: 1}


def test_a_small_dictionary_gives_the_same_features():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(500)) for _ in range(6)]
    for most, often in ((200_000, 3), (50, 1), (1, 2)):
        dictionary = importance.Dictionary(most=most, often=often, longest=4)
        for text in texts:
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            words, owners, found = importance.features(dictionary, data, np.array([0, len(data)]), 3, 10_000)
            assert found.tolist() == [zlib.crc32(g.encode()) % 10_000 for g in plain_features(text)[1]]
            assert len(words) == 500 and not owners.any()
        assert len(dictionary.numbers) <= most


# --- spelling variants --------------------------------------------------------------------


def plain_variants(rows, least=3):
    counts = Counter()
    for k, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "")):
            w = w.translate(brute.LOWER)
            h = zlib.crc32(f"{k}:{w}".encode())
            if k is not None and h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    others = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(others[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(others[w]), words.get(form.get(w))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling(docs, seed):
    rng = random.Random(seed)
    letters = "abcé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(150)]
    words += ["aaaaa", "aaaaaa", "Straße", "strasse", "straße", "ÀÉÿ÷×", "àéÿ÷×", "one-two", "naïvety", "naivety"]
    pick = lambda: words[int(len(words) * rng.random() ** 4)]
    rows = [(k, rng.choice([" ", "\n", "9", "."]).join(pick() for _ in range(rng.randint(0, 80)))) for k in range(80)]
    rows += [(500, None), (501, ""), (502, " ".join(pick() for _ in range(20_000))), (None, "aaaaa bbbbb " * 9), (7, rows[7][1])]
    rows += [(None, "kettle " * 40 + "kettles " * 15 + "kettlest " * 5)]
    got = {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling.variants(docs(*rows)).collect()}
    assert got == plain_variants(rows)
    assert ("kettlest", "kettles", "kettle", 5, 1, 15) in got


def test_spelling_of_an_empty_table(docs):
    assert spelling.variants(docs((1, "x")).where("false")).collect() == []
    assert spelling.variants(docs((1, "x"), (2, None))).collect() == []


def test_every_single_edit_is_found(spark):
    word, letters = "abcdefghi", "abxé"
    edits = {word[:k] + word[k + 1 :] for k in range(9)} | {word[:k] + c + word[k:] for k in range(10) for c in letters}
    edits |= {word[:k] + c + word[k + 1 :] for k in range(9) for c in letters} - {word}
    far = {"abcdefg", "bacdefghi", "xbcdefghx", "abcdefghixy"}
    frame = spark.createDataFrame([(w, 3) for w in edits | far | {word}], "word string, n long")
    got = [r.other for r in spelling.near_words(frame).where(F.col("word") == word).collect()]
    assert sorted(got) == sorted(edits)


# --- top products -------------------------------------------------------------------------


def plain_top(rows, every=50, k=5):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            point = [math.floor(256 * x) for x in v]
            while point and point[-1] == 0:
                point.pop()
            usable.append((i, tuple(point)))
    usable = set(usable)
    out = []
    for q in usable:
        if q[0] % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q[1], r[1])), r[0], r[1]) for r in usable if r != q)
            out += [(q[0], place + 1, i, -less) for place, (less, i, _) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shape", ["spread", "clusters", "copies"])
def test_top_products(spark, shape):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(700, 6))
    if shape == "clusters":
        points = rng.normal(size=(10, 6))[rng.integers(0, 10, 700)] * rng.uniform(0.1, 9, (700, 1)) + rng.normal(size=(700, 6)) / 99
    if shape == "copies":
        points = np.round(points[rng.integers(0, 30, 700)], 1)
        points[:300] = points[0]  # a very common vector
    rows = [(int(k), [float(x) for x in p]) for k, p in enumerate(points)]
    rows += [(1000, None), (None, [1.0] * 6), (1050, [1.0, None, 1.0]), (1051, [float("nan")] * 6), (1052, [float("inf")] * 6)]
    rows += [(1100, []), (1101, [0.5]), (1150, [0.5, 0.25]), (50, rows[50][1]), (100, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double").repartition(3)
    small = {"branch_rows": 100, "most_cells": 4, "leaf": 16, "query_leaf": 8}
    for more in ({}, small, small | {"block_bytes": 1500}):
        got = sorted(map(tuple, cover_search.top_products(frame, **more).select("query_id", "rank", "vec_id", "score").collect()))
        assert got == plain_top(rows)


def test_top_products_of_few_rows_and_large_numbers(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_search.top_products(none).collect() == []
    few = [(0, [3e5, 4e5]), (1, [-1e5, 3e6]), (2, [2e5, 1.5])]
    frame = spark.createDataFrame(few, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, cover_search.top_products(frame).collect()))
    assert got == plain_top(few) and len(got) == 2
    assert cover_search.top_products(frame.where("vec_id > 0")).collect() == []


def test_node_pairs_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (40, 8))
    points = centres[rng.integers(0, 40, 8000)] + rng.integers(-20, 20, (8000, 8))
    data, order = cover_search.built(points, 64)
    queries, asked = cover_search.built(points[:400], 16)
    for node in data.nodes:  # every radius covers its node
        members = data.points[node["low"] : node["high"]]
        assert cover_search.distances(members, data.points[node["centre"]]).max() <= node["radius"] + 1e-6
    best = cover_search.Best(400, 6, np.full(400, np.iinfo(np.int64).min))
    looked_at = cover_search.search(queries, data, order, np.arange(1, 8001), best, True)
    assert looked_at < 400 * 8000 / 5
    scores = -np.sort(-(points[:400][asked] @ points.T), axis=1)[:, :6]
    assert (best.score == scores).all()
