"""Spelling variants: words one edit apart, found by asymmetric chunks, grouped under the frequent form.

One edit leaves one of two disjoint chunks of a word as it was. So the shorter word of a pair gives
its chunks, the longer one its positional grams, of which only those matter that stand where such a
chunk can be: at its place, or shifted by the difference of the lengths, one at most. The chunk with
the edit has one edit itself, so it is cut in two in the same way, and a key holds the whole
chunk together with the half that is left of the other. Whoever shares a key is compared.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.arrays import LOWER, NOT_SPACE, Hasher, pieces, runs, tidy
from tallyloom.llm.crc import of_runs
from tallyloom.session import materialise

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LATIN = 0xC3  # lead byte of U+00C0 to U+00FF, and of nothing else


def _lowered(data: np.ndarray) -> np.ndarray:
    """Letters A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased; every other byte becomes a space."""
    inside = _LETTER[data]
    lead = data == _LATIN
    inside |= lead
    inside[1:] |= lead[:-1]
    return np.where(inside, LOWER[data], np.uint8(32))


def _words_of(ids: list, data: np.ndarray, offsets: np.ndarray, shortest: int, one_in: int):
    """(hashes, counts, words) of the distinct words of a piece of texts, and a counter of the altered ones."""
    data = _lowered(data)
    starts, ends, docs = runs(data, offsets, NOT_SPACE)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    length = points[ends] - points[starts]
    named = np.array([k is not None for k in ids], dtype=bool)
    before = np.array([zlib.crc32(f"{k}:".encode()) for k in ids], dtype=np.uint32)
    h = of_runs(data, starts, ends, before[docs])
    cut = named[docs] & (h % np.uint32(one_in) == 0)
    altered: Counter[str] = Counter()
    raw = data.tobytes()
    some = np.flatnonzero(cut & (length > shortest))
    for a, b, at in zip(starts[some].tolist(), ends[some].tolist(), (h[some] % length[some]).tolist()):
        word = raw[a:b].decode()
        altered[word[:at] + word[at + 1 :]] += 1
    kept = np.flatnonzero(~cut & (length >= shortest))
    starts, ends = starts[kept], ends[kept]
    hashes, first, counts = np.unique(Hasher(data).of(starts, ends), return_index=True, return_counts=True)
    words = [raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return hashes, counts, pa.array(words, pa.string()), altered


def _count(shortest: int, one_in: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [pa.array([], pa.string())]
            altered: Counter[str] = Counter()
            for row, data, offsets in pieces(batch.column(1)):
                ids = batch.column(0).slice(row, len(offsets) - 1).to_pylist()
                h, n, w, a = _words_of(ids, data, offsets, shortest, one_in)
                hashes.append(h)
                counts.append(n)
                words.append(w)
                altered.update(a)
            hashes, counts = np.concatenate(hashes), np.concatenate(counts)
            _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
            total = np.bincount(place, weights=counts, minlength=len(first)).astype(np.int64)
            names = ["word", "n"]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(words).take(pa.array(first)), pa.array(total)], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(altered), pa.string()), pa.array(list(altered.values()), pa.int64())], names=names
            )

    return run


def word_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, one_in: int = 97
) -> DataFrame:
    """(word, n): words of ``shortest`` code points and ``least`` occurrences or more, after one run in ``one_in`` lost a code point.

    Which runs lose one is a function of the document's id and the run; runs of documents without an id stay.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_count(shortest, one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _keys(size: Column, shift: Column) -> Column:
    """Keys of ``word`` for a word of ``size`` code points: what stands before and behind each half of each chunk.

    ``shift`` is how many code points longer ``word`` is itself.
    """
    middle = F.floor(size / 2)
    cuts = [F.lit(0), F.floor(middle / 2), middle, middle + F.floor((size - middle) / 2), size]
    whole = F.col("word")
    return F.array(
        *[
            F.xxhash64(
                size, F.lit(k), F.substring(whole, F.lit(1), low.cast("int")),
                F.substring(whole, (high + shift + 1).cast("int"), (size - high).cast("int")),
            )
            for k, (low, high) in enumerate(zip(cuts, cuts[1:]))
        ]
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways round, for all pairs of ``words`` (word, n) exactly one edit apart."""
    size = F.char_length("word")
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(_keys(size, F.lit(0))).alias("key"))
    shifts = F.array(F.lit(0), F.lit(1))
    grams = words.select("word", "n", F.explode(shifts).alias("shift"))
    grams = grams.select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), "shift", F.explode(_keys(size - F.col("shift"), F.col("shift"))).alias("key")
    )
    # of two words of one length, the smaller gives the chunks
    longer = F.char_length("b") == F.char_length("a") + F.col("shift")
    once = (F.col("shift") == 1) | (F.col("a") < F.col("b"))
    met = chunks.join(grams, "key").where(longer & once & (F.levenshtein("a", "b", 1) == 1))
    pairs = met.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    return pairs.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow each other; every round doubles the step.

    A form is at least ``times`` as frequent as its word, so there are no circles and few rounds.
    """
    step = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        far = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = materialise(step.join(far, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if step.where("_moved").isEmpty():
            return step.select("word", "root")
        step = step.select("word", "root")


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, times: int = 2, one_in: int = 97
) -> DataFrame:
    """One row per word of the corpus: word, form, root, n, n_near, form_n.

    Words are maximal runs of letters A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, of ``shortest`` code
    points and ``least`` occurrences or more (:func:`word_counts`). Two are near if one inserted, deleted or
    replaced code point makes one of the other. A word's form is its most frequent near word (ties: the
    smallest in code-point order), if that is at least ``times`` as frequent; root is the last of the forms
    that follow, the word itself if it has none.

    Null and empty texts have no words; a repeated row counts again; an empty table gives no rows. Other
    columns are ignored, whatever their names. Words of a batch are counted before they are shuffled, so a very
    frequent one is no hot spot; a chunk shared by very many words is split by Spark's skew join.
    """
    words = materialise(word_counts(docs, doc_id, text, shortest, least, one_in))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    found = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    is_form = -F.col("best.less") >= times * F.col("n")
    formed = materialise(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
