"""Importance resampling towards a target distribution, over hashed runs of words.

Runs of one to three words fall into buckets by the checksum of their text. No run is ever put together as
text: an Aho-Corasick automaton over a dictionary of words emits, for each word of a scanned text, the
word's checksum and length, and the checksum of a run is composed of those of its words.
"""

import zlib
from collections.abc import Iterator
from itertools import chain
from math import floor, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.arrays import pieces, tidy
from tallyloom.llm.crc import of_runs, shift
from tallyloom.session import materialise

#: A-Z become a-z, other letters, digits and bytes of 0x80 and more stay, the rest separates words.
_NORMAL = np.full(256, 32, dtype=np.uint8)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _NORMAL[_low:_high] = np.arange(_low, _high)
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)


class Dictionary:
    """Words with their payloads: checksum, checksum with a space in front, length.

    The automaton's patterns are words between separators, so each word of a text is matched once
    and never as part of a longer one. A word that it does not know is given its payload directly, and
    learned if it comes up ``often``; the automaton is built anew when it has grown by half. So
    results never depend on what a worker has seen. Beyond ``most`` words it starts over;
    words of more than ``longest`` bytes are not learned.
    """

    def __init__(self, most: int = 200_000, longest: int = 64, often: int = 3):
        self.most, self.longest, self.often = most, longest, often
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.crc, self.spaced = (np.zeros(0, np.uint32) for _ in range(2))
        self.machine, self.built = None, 0

    def _learn(self, words: list[bytes], crc: np.ndarray, spaced: np.ndarray) -> None:
        if len(self.numbers) + len(words) > self.most:
            self._clear()
        for word in words:
            self.numbers[word] = len(self.numbers)
        self.crc, self.spaced = np.append(self.crc, crc), np.append(self.spaced, spaced)
        if 2 * len(self.numbers) >= 3 * self.built:
            self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for word, number in self.numbers.items():
                self.machine.add_word(f" {word.decode('latin-1')} ", number)
            self.machine.make_automaton()
            self.built = len(self.numbers)

    def payloads(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(checksums, checksums with a space in front) of the words text[start:end]."""
        number = np.full(len(starts), -1, dtype=np.int64)
        if self.built:
            found = np.fromiter(chain.from_iterable(self.machine.iter(text.decode("latin-1"))), dtype=np.int64)
            number[np.searchsorted(ends, found[0::2])] = found[1::2]
        crc, spaced = (np.zeros(len(starts), dtype=np.uint32) for _ in range(2))
        known, unknown = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        crc[known], spaced[known] = self.crc[number[known]], self.spaced[number[known]]
        if len(unknown):
            starts, ends = starts[unknown], ends[unknown]
            own = of_runs(np.frombuffer(text, dtype=np.uint8), starts, ends)
            crc[unknown] = own
            spaced[unknown] = shift(np.full(len(own), zlib.crc32(b" "), dtype=np.uint32), ends - starts) ^ own
            _, first, n = np.unique(own, return_index=True, return_counts=True)
            first = first[(n >= self.often) & (ends[first] - starts[first] <= self.longest)]
            new = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            fresh = np.array([w not in self.numbers for w in new], dtype=bool)
            if fresh.any():
                chosen = np.flatnonzero(fresh)[: self.most]
                self._learn([new[k] for k in chosen], own[first[chosen]], spaced[unknown[first[chosen]]])
        return crc, spaced


def features(dictionary: Dictionary, data: np.ndarray, offsets: np.ndarray, order: int, buckets: int):
    """(documents of words, documents of features, buckets of features) of a piece of texts."""
    n = len(offsets) - 1
    # one separator in front of each text and one behind the last
    held = np.full(len(data) + n + 1, 32, dtype=np.uint8)
    lengths = np.diff(offsets)
    held[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), lengths)] = _NORMAL[data]
    inside = held != 32
    edges = np.diff(inside.view(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    docs = np.searchsorted(offsets[:-1] + np.arange(n), starts, "right") - 1
    crc, spaced = dictionary.payloads(held.tobytes(), starts, ends)
    size = ends - starts
    owners, found, first = [docs], [crc], np.arange(len(docs))
    for k in range(1, order):
        last = first + k
        fits = last < len(docs)
        first, last, crc = first[fits], last[fits], crc[fits]
        same = docs[first] == docs[last]
        first, last = first[same], last[same]
        crc = shift(crc[same], size[last] + 1) ^ spaced[last]
        owners.append(docs[first])
        found.append(crc)
    return docs, np.concatenate(owners), np.concatenate(found).astype(np.int64) % buckets


def _count(order: int, buckets: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, total = Dictionary(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0)):
                total += np.bincount(features(dictionary, data, offsets, order, buckets)[2], minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", order: int = 3, buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts fall into each bucket; every task sends one row per bucket."""
    rows = texts.select(F.col(text).alias("text")).mapInArrow(_count(order, buckets), "bucket long, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: the smoothed log ratio of target and source, in thousandths, rounded down."""
    n = len(source)
    s_all, t_all = float(source.sum() + n), float(target.sum() + n)
    return np.array(
        [floor(1000 * log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


def _weigh(held, order: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, dictionary = held.value, Dictionary()
        for batch in batches:
            for row, data, offsets in pieces(batch.column(1)):
                n = len(offsets) - 1
                words, owners, buckets = features(dictionary, data, offsets, order, len(gain))
                # sums of whole numbers below 2**53, so exact as doubles
                weight = np.bincount(owners, weights=gain[buckets], minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        pa.array(np.bincount(words, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(owners, minlength=n).astype(np.int64)),
                        pa.array(weight),
                    ],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, a function of the id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, drawn: int, *order) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the first ``drawn`` rows in ``order``, else null.

    Rows are dealt out by ranges of the order, ranges are counted, and each numbers its own rows: no
    task holds more than its range, whatever the number of rows or drawn ones.
    """
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = scored.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    placed = materialise(placed)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("k"))
    starts = starts.select("_range", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order)
    rank = (F.col("_start") + F.row_number().over(inside)).cast("long")
    numbered = placed.join(F.broadcast(starts), "_range").withColumn("rank", rank)
    return numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("_range", "_start")


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    order: int = 3, buckets: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42,
) -> DataFrame:
    """Draw ``percent`` of the documents of ``least_words`` words or more, without replacement, so that they look like ``target``.

    Per row of ``docs``: doc_id, n_words, n_features, weight (summed gains of its features), score (weight plus
    Gumbel noise of the id) and rank (place among the drawn, from 1; null if not drawn). The highest scores
    are drawn, ties going to the smaller id. A-Z are lower-cased; words are runs of digits, letters a-z and
    characters beyond ASCII; features are runs of one to ``order`` words, repeats counted.

    Null and empty texts have no features and weigh 0. A row without an id has no noise: its score
    and rank are null and it is not among those that are drawn from. Rows that repeat an id are rows of
    their own with the same noise. An empty target leaves the gains to the smoothing; an empty table
    gives no rows. Other columns are ignored, whatever their names. ``docs`` is scanned twice; all that is
    gathered are ``buckets`` counts for each of both tables.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    gain = gains(bucket_counts(docs, text, order, buckets), bucket_counts(target, target_text, order, buckets))
    held = spark.sparkContext.broadcast(gain)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _weigh(held, order), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    scored = materialise(rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    eligible = scored.where((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    drawn = percent * eligible.count() // 100
    others = scored.where((F.col("n_words") < least_words) | F.col("score").isNull())
    order_by = (F.desc("score"), F.asc("doc_id"), F.asc("n_features"))
    return ranked(eligible, drawn, *order_by).unionByName(others.withColumn("rank", F.lit(None).cast("long")))
