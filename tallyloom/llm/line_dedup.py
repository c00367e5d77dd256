"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of (hash, number of documents, largest document id), bucketed and sorted by
hash, so that runs meet by merge joins without a shuffle. Documents come in batches, from
the largest ids down. A batch's lines are counted, merge-anti-joined with the lines already
settled in the runs, and added as a run of level 0. When a level is full, its runs are merged
into one run of the next level.
"""

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrays import LOWER, NOT_SPACE, Hasher, pieces, runs, tidy
from tallyloom.session import scratch_folder


def line_keys(data: np.ndarray, offsets: np.ndarray, shortest: int):
    """Per line of the piece: (start, end without line feed, document, hash, is long enough).

    The hash is that of the line without white space at its ends and with A-Z lower-cased.
    """
    feeds = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate((feeds + 1, offsets[:-1])), kind="stable")
    stop = np.sort(np.concatenate((feeds, offsets[1:])), kind="stable")
    counts = np.diff(np.concatenate(([0], np.cumsum(data == 10)))[offsets]) + 1
    docs = np.repeat(np.arange(len(offsets) - 1), counts)
    word_from, word_to, _ = runs(data, offsets, NOT_SPACE)
    first = np.searchsorted(word_from, begin, "left")
    last = np.searchsorted(word_to, stop, "right") - 1
    filled = first <= last
    key_from = np.where(filled, word_from[np.minimum(first, max(len(word_from) - 1, 0))] if len(word_from) else 0, 0)
    key_to = np.where(filled, word_to[np.maximum(last, 0)] if len(word_to) else 0, 0)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    hashes = Hasher(LOWER[data]).of(key_from, key_to)
    return begin, stop, docs, hashes, points[key_to] - points[key_from] >= shortest


def _hashes(shortest: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in pieces(batch.column(1)):
                _, _, docs, hashes, long = line_keys(data, offsets, shortest)
                docs, hashes = docs[long], hashes[long]
                order = np.lexsort((hashes, docs))
                docs, hashes = docs[order], hashes[order]
                new = np.ones(len(docs), dtype=bool)
                new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[new].view(np.int64)), pa.array(ids[row + docs[new]])], names=["h", "doc_id"]
                )

    return run


def _drop(shortest: int, keep: tuple[str, ...]):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            drops = batch.column("drops")
            out, n_lines, n_dropped = [], [], []
            for row, data, offsets in pieces(texts):
                counts = np.diff(np.concatenate(([0], np.cumsum(data == 10)))[offsets]) + 1
                n_lines += counts.tolist()
                held = [k for k in range(len(counts)) if drops[row + k].is_valid]
                gone = dict.fromkeys(range(len(counts)), 0)
                changed = {}
                if held:
                    begin, stop, docs, hashes, long = line_keys(data, offsets, shortest)
                    at = np.concatenate(([0], np.cumsum(counts)))
                    for k in held:
                        part = slice(at[k], at[k + 1])
                        wanted = np.array(drops[row + k].as_py(), dtype=np.int64).view(np.uint64)
                        bad = long[part] & np.isin(hashes[part], wanted)
                        gone[k] = int(bad.sum())
                        changed[k] = b"\n".join(
                            data[a:b].tobytes() for a, b in zip(begin[part][~bad], stop[part][~bad])
                        ).decode()
                n_dropped += [gone[k] for k in range(len(counts))]
                out += [changed[k] if k in changed else (texts[row + k].as_py() or "") for k in range(len(counts))]
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*keep, "kept_text", "n_lines", "n_dropped"],
            )

    return run


class LineRuns:
    """Levelled runs of counted line hashes in a folder that all executors share."""

    def __init__(self, spark, documents: int = 3, fanout: int = 4, buckets: int | None = None):
        self.spark, self.documents, self.fanout = spark, documents, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder, self.levels = scratch_folder(spark), []

    def _write(self, frame: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            frame.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h")
            .option("path", f"{self.folder}/level={level}/{name}").saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _runs(self) -> list[DataFrame]:
        return [self.spark.read.table(name) for level in self.levels for name in level]

    @staticmethod
    def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one, by a merge join of their sorted buckets."""
        b = b.select(F.col("h"), F.col("n").alias("n2"), F.col("last").alias("last2"))
        return a.join(b, "h", "full").select(
            "h", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
            F.greatest("last", "last2").alias("last"),
        )

    def add(self, lines: DataFrame) -> None:
        """A batch of (h, doc_id), one row per document and line; ids below those of earlier batches.

        Lines that some run has already found in enough documents are settled: their last
        document is known, and the batch's occurrences add nothing.
        """
        new = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
        for run in self._runs():
            new = new.join(run.where(F.col("n") >= self.documents).select("h"), "h", "left_anti")
        self._write(new, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        names, self.levels[level] = self.levels[level], []
        self._write(reduce(self._merge, map(self.spark.read.table, names)), level + 1)
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def repeated(self) -> DataFrame:
        """(h, last): lines found in enough documents, and the largest document that holds them."""
        return reduce(self._merge, self._runs()).where(F.col("n") >= self.documents).select("h", "last")

    def close(self) -> None:
        for name in (n for level in self.levels for n in level):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    documents: int = 3,
    shortest: int = 20,
    batches: int = 4,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Documents without lines that at least ``documents`` documents hold, but for the largest id holding them.

    Lines are split at line feeds and compared without white space at their ends and with A-Z
    lower-cased; lines of fewer than ``shortest`` code points always stay. Returns doc_id, the
    columns in ``keep``, kept_text, n_lines (before) and n_dropped. Null or empty text is
    one empty line and comes out as empty text. A doc_id must be an integer; rows that share one count
    as documents of their own, and all of them keep the lines whose largest id it is. A row without id
    keeps all its lines and counts for none. Other columns are ignored, whatever their names.
    Lines are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *keep)
    lines = frame.where("doc_id is not null").select("doc_id", "text")
    bounds = lines.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)]).alias("p")).first()["p"]
    edges = [None, *sorted(set(bounds or []), reverse=True), None]
    index = LineRuns(spark, documents)
    for high, low in zip(edges, edges[1:]):
        batch = lines
        if high is not None:
            batch = batch.where(F.col("doc_id") <= high)
        if low is not None:
            batch = batch.where(F.col("doc_id") > low)
        index.add(batch.mapInArrow(_hashes(shortest), "h long, doc_id long"))
    path = f"{index.folder}/repeated"
    index.repeated().write.parquet(path)
    index.close()
    repeated = spark.read.parquet(path)
    drops = (
        lines.mapInArrow(_hashes(shortest), "h long, doc_id long")
        .join(repeated, "h").where(F.col("doc_id") < F.col("last"))
        .groupBy(F.col("doc_id").alias("drop_id")).agg(F.collect_set("h").alias("drops"))
    )
    joined = frame.join(drops, F.col("doc_id") == F.col("drop_id"), "left").drop("drop_id")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select("doc_id", *keep).schema)
    return joined.mapInArrow(_drop(shortest, ("doc_id", *keep)), f"{kept}, kept_text string, n_lines long, n_dropped long")
