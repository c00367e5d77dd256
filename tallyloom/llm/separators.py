"""Token counts of flat token files without an index, by a scan for the end-of-document id.

A flat file is nothing but ids of a fixed width. Its documents are found by cutting it
into blocks of bytes, whatever lies at their edges, searching each block on its own, and stitching
the documents that cross edges with a prefix scan over the blocks.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.tokens import encoded, vocabulary
from tallyloom.session import materialise


def _flat(path: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, offsets in encoded(batch.column(0), path):
                n = len(offsets) - 1
                if len(ids) and int(ids.max()) + 1 >= 1 << (8 * width):
                    raise ValueError("the ids need a larger width")
                out = np.zeros(len(ids) + n, dtype=f"<u{width}")
                out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids + 1
                # the end of the last document is the line end that the writer adds
                yield pa.RecordBatch.from_arrays([pa.array([out[:-1].tobytes()], pa.binary())], names=["ids"])

    return run


def write_flat(docs: DataFrame, folder: str, text: str = "text", path: str | None = None, width: int = 2) -> None:
    """Whole texts as flat files of ``width``-byte little-endian ids.

    The id 0 ends a document, so vocabulary ids are one larger than in the vocabulary. Null and
    empty texts are an end alone. Spark's committer keeps one copy of a task that is run again.
    """
    coded = docs.select(F.col(text).alias("text")).mapInArrow(
        _flat(path or vocabulary("byte_bpe_50k.tiktoken"), width), "ids binary"
    )
    coded.select(F.col("ids").cast("string")).write.option("lineSep", "\0" * width).text(folder)


def _search(width: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for uri, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))):
                # Spark writes a local path with one slash
                store, name = pyarrow.fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?=[^/])", r"\1:///", uri))
                with store.open_input_file(name) as file:
                    ids = np.frombuffer(file.read_at(length, offset), dtype=f"<u{width}")
                found.append(np.flatnonzero(ids == end_id).astype(np.int32))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block"),
                    pa.array(np.array(batch.column("offset")) // width, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                ],
                names=["file", "block", "first", "n_ids", "ends"],
            )

    return run


def count_tokens(spark, folder: str, end_id: int = 0, width: int = 2, block_bytes: int = 2 << 20) -> DataFrame:
    """Documents of the flat files in a folder: file, doc_no, start, n_tokens, ended.

    doc_no and start (in ids) count within the file; n_tokens leaves out the end id. Ids after a file's last
    end are a document with ``ended`` false; empty files have none, and neighbouring ends are empty
    documents. A file whose length is no multiple of ``width`` is refused. Files may have any size: tasks
    read blocks of ``block_bytes`` by range, and only the positions of ends leave them.
    """
    if block_bytes % width:
        raise ValueError("a block must hold whole ids")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    files = files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"))
    files = files.where("size > 0").withColumn(
        "size", F.when(F.col("size") % width == 0, F.col("size")).otherwise(F.raise_error(F.lit("a file ends within an id")))
    )
    last = F.floor((F.col("size") - 1) / block_bytes).cast("long")
    blocks = files.select("path", "file", "size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    offset = F.col("block") * block_bytes
    blocks = blocks.select(
        "path", "file", "block", offset.alias("offset"), F.least(F.col("size") - offset, F.lit(block_bytes)).alias("length")
    ).repartition("file", "block")
    found = materialise(
        blocks.mapInArrow(_search(width, end_id), "file string, block long, first long, n_ids long, ends array<int>")
    )
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    # without the positions: a row of a few numbers per block
    summary = found.select(
        "file", "block", F.size("ends").cast("long").alias("n"),
        F.when(F.size("ends") > 0, F.col("first") + F.element_at("ends", -1)).alias("last_end"),
        (F.col("first") + F.col("n_ids")).alias("stop"),
    )
    carried = summary.select(
        "file", "block",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("doc_before"),
        (F.coalesce(F.max("last_end").over(ahead), F.lit(-1)) + 1).alias("open_from"),
        F.max("last_end").over(whole).alias("final_end"),
        F.max("stop").over(whole).alias("file_stop"),
        F.max("block").over(whole).alias("final_block"),
    )
    joined = found.join(carried, ["file", "block"])
    ends = F.transform("ends", lambda e: F.col("first") + e)
    tail = (F.col("block") == F.col("final_block")) & (F.coalesce("final_end", F.lit(-1)) + 1 < F.col("file_stop"))
    stops = F.concat(ends, F.when(tail, F.array("file_stop")).otherwise(F.array().cast("array<bigint>")))
    rows = joined.select(
        "file", "doc_before", "open_from", F.size("ends").alias("n_ends"), stops.alias("stops"),
    ).select("file", "doc_before", "open_from", "n_ends", "stops", F.posexplode("stops").alias("k", "stop"))
    start = F.when(F.col("k") == 0, F.col("open_from")).otherwise(F.element_at("stops", F.greatest(F.col("k"), F.lit(1))) + 1)
    return rows.select(
        "file", (F.col("doc_before") + F.col("k")).alias("doc_no"), start.alias("start"),
        (F.col("stop") - start).alias("n_tokens"), (F.col("k") < F.col("n_ends")).alias("ended"),
    )
