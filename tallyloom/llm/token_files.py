"""Binary token files: blocks of Simple-8b words, in ascending order of document ids.

A file is a row of frames, each followed by a line feed. All numbers are little-endian. A frame has

    magic "S8B1", then unsigned 32-bit: documents, ids, words, escapes, offsets
    document ids (signed 64-bit), one byte each whether there is an id at all,
    end of each document's ids within the frame (unsigned 32-bit),
    ids before every 64th word (unsigned 32-bit), words (unsigned 64-bit),
    places (unsigned 32-bit) and values (unsigned 64-bit) of escapes

Frames hold whole documents and can be read on their own. Files are written by Spark's own
committer, so a task that is run again leaves one copy.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.arrays import tidy
from tallyloom.llm import simple8b
from tallyloom.llm.tokens import encoded, vocabulary
from tallyloom.session import materialise

MAGIC = b"S8B1"
_HEAD = struct.Struct("<4s5I")
STEP = 64


def frame(doc_ids: np.ndarray, valid: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
    words, places, escaped = simple8b.encode(ids)
    index = simple8b.offsets(words, STEP)
    return b"".join(
        [
            _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(words), len(places), len(index)),
            doc_ids.astype("<i8").tobytes(),
            valid.astype(np.uint8).tobytes(),
            ends.astype("<u4").tobytes(),
            index.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            places.astype("<u4").tobytes(),
            escaped.astype("<u8").tobytes(),
        ]
    )


def frames(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document ids, validity, ends, ids) of each frame of a file."""
    at = 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += found.nbytes
        return found

    while at < len(data):
        magic, n_docs, n_ids, n_words, n_escapes, n_offsets = _HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += _HEAD.size
        doc_ids, valid, ends = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
        take("<u4", n_offsets)
        words, places, escaped = take("<u8", n_words), take("<u4", n_escapes), take("<u8", n_escapes)
        at += 1  # the line feed
        # the last word may have room for more values than there were
        yield doc_ids, valid.astype(bool), ends, simple8b.decode(words, places, escaped)[:n_ids]


def _encode(path: str, end_id: int, block_ids: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def flush():
            doc_ids, valid, counts, ids = (np.concatenate(x) for x in zip(*held))
            ends = np.cumsum(counts)
            out, low = [], 0
            while low < len(ends):
                before = int(ends[low - 1]) if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + block_ids, "right")))
                out.append(frame(doc_ids[low:high], valid[low:high], ends[low:high] - before, ids[before : int(ends[high - 1])]))
                low = high
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

        for batch in batches:
            keys = batch.column(0)
            valid = ~keys.is_null().to_numpy(zero_copy_only=False)
            keys = keys.fill_null(0).to_numpy()
            for row, ids, offsets in encoded(batch.column(1), path):
                n = len(offsets) - 1
                ended = np.full(len(ids) + n, end_id, dtype=np.uint32)
                ended[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
                held.append((keys[row : row + n], valid[row : row + n], np.diff(offsets) + 1, ended))
                waiting += len(ended)
                if waiting >= 16 * block_ids:
                    yield flush()
                    held, waiting = [], 0
        if held:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
    end_id: int = 0, block_ids: int = 65_536, file_blocks: int = 256, partitions: int | None = None,
) -> None:
    """Whole texts as token files, ordered by document id (rows of one id by their text, no id first).

    Each document's ids are followed by ``end_id``; null and empty texts have that id alone. A frame
    holds about ``block_ids`` ids (one document at least), a file at most ``file_blocks`` frames. Texts are
    dealt out by ranges of ids before they are encoded. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    coded = rows.mapInArrow(_encode(path or vocabulary(), end_id, block_ids), "frame binary")
    # a string of Spark is a row of bytes: the text writer puts them out as they are
    coded.select(F.col("frame").cast("string")).write.option("maxRecordsPerFile", file_blocks).text(folder)


@tidy
def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, piece, content in zip(*(batch.column(c) for c in ("part", "piece", "content"))):
            before = 0
            for doc_ids, valid, ends, ids in frames(content.as_buffer().to_pybytes()):
                raw = memoryview(ids.astype("<u4").tobytes())
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * n, pa.int64()),
                        pa.array([piece.as_py()] * n, pa.int64()),
                        pa.array(doc_ids, mask=~valid),
                        pa.array(before + starts),
                        pa.array(ends.astype(np.int64) - starts),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "piece", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )
                before += len(ids)


def read_tokens(spark, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Files are summed up first; the sums before each file are a prefix scan over the list of files.
    """
    # a small file list per task: a row carries a whole file, which the writer keeps small
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    files = files.select(
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("part"),
        F.regexp_extract(name, r"-c(\d+)\.", 1).cast("long").alias("piece"),
        "content",
    ).where(F.octet_length("content") > 0)
    found = materialise(
        files.mapInArrow(_decode, "part long, piece long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    )
    ahead = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.groupBy("part", "piece").agg(F.sum("n_tokens").alias("k"))
    before = sums.select("part", "piece", F.coalesce(F.sum("k").over(ahead), F.lit(0)).alias("before"))
    return found.join(before, ["part", "piece"]).select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
