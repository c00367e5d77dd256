"""Packing: optimal length buckets from the global histogram, token-budget batches inside them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.llm.arrays import tidy
from tallyloom.llm.tokens import counted, vocabulary
from tallyloom.session import materialise


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that pad the fewest tokens in all.

    Dynamic programming over the sorted distinct lengths: the best cost of the first j lengths with
    k buckets is the least, over the last bucket's first length i, of the cost before i plus the
    padding of i..j up to length j.
    """
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate(([0], np.cumsum(counts)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths)))
    # padding[i, j]: of lengths i..j in one bucket; the lower triangle cannot be
    padding = lengths[None, :] * (rows[None, 1:] - rows[:-1, None]) - (tokens[None, 1:] - tokens[:-1, None])
    padding = np.where(np.arange(n)[:, None] <= np.arange(n)[None, :], padding.astype(np.float64), np.inf)
    best, back = padding[0], []
    for _ in range(1, min(buckets, n)):
        total = np.concatenate(([0.0], best[:-1]))[:, None] + padding
        back.append(total.argmin(axis=0))
        best = total.min(axis=0)
    bounds, j = [], n - 1
    for step in reversed(back):
        bounds.append(int(lengths[j]))
        j = int(step[j]) - 1
        if j < 0:
            return sorted(bounds)
    return sorted([*bounds, int(lengths[j])])


def _count(path: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = counted(batch.column(1), path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n"])

    return run


def token_lengths(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n): tokens of every whole text; none for null and empty texts."""
    kind = docs.schema[doc_id].dataType.simpleString()
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return frame.mapInArrow(_count(path or vocabulary("byte_bpe_50k.tiktoken")), f"doc_id {kind}, n long")


def pack(
    lengths: DataFrame,
    longest: int = 2048,
    buckets: int = 16,
    budget: int = 65_536,
    block_rows: int = 50_000,
) -> DataFrame:
    """Padded batches of at most ``budget`` tokens.

    ``lengths`` has doc_id and n. Each document gets one end token; what is longer than
    ``longest`` is cut into pieces of that length, so no token is left out. Returns one row
    per piece: doc_id, piece, token_from, n_tokens, bucket (the padded length), batch_id, slot (place
    in the batch) and padding. The histogram has at most ``longest`` lengths, so the choice of
    bounds is made on the driver, whatever the number of documents.

    Places in a bucket are given out block by block, a block being a share of the rows by hash:
    the counts of the blocks are summed up first, then every block numbers its own rows. No
    bucket is ever in one task. Documents without tokens are one end token long; repeated rows are
    packed as often as they come; an empty table gives no rows. ``budget`` is at least ``longest``.
    """
    if budget < longest:
        raise ValueError("a batch must hold the longest piece")
    total = F.coalesce("n", F.lit(0)) + 1
    pieces = lengths.select(
        "doc_id", total.alias("all"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((total - 1) / longest).cast("long"))).alias("piece"),
    ).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("token_from"),
        F.least(F.col("all") - F.col("piece") * longest, F.lit(longest)).alias("n_tokens"),
    )
    counted = pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("k")).collect()
    sizes = np.array([r["n_tokens"] for r in counted], dtype=np.int64)
    counts = np.array([r["k"] for r in counted], dtype=np.int64)
    bounds = bucket_bounds(sizes, counts, buckets)
    fit, base, first = {}, {}, 0
    for low, high in zip([0, *bounds], bounds):
        rows = int(counts[(sizes > low) & (sizes <= high)].sum())
        fit[high], base[high] = budget // high, first
        first += -(-rows // fit[high])
    blocks = max(1, int(counts.sum()) // block_rows)

    def by_bucket(values: dict[int, int]):
        chosen = F.lit(None).cast("long")
        for bound in reversed(bounds):
            chosen = F.when(F.col("n_tokens") <= bound, F.lit(values[bound]).cast("long")).otherwise(chosen)
        return chosen

    named = pieces.withColumn("bucket", by_bucket({b: b for b in bounds})).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks))
    )
    before = Window.partitionBy("bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = named.groupBy("bucket", "block").agg(F.count(F.lit(1)).alias("k"))
    starts = starts.select("bucket", "block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket", "block").orderBy(F.xxhash64(F.col("piece"), F.col("doc_id")), "doc_id", "piece", "n_tokens")
    placed = named.withColumn("place", F.row_number().over(inside) - 1).join(starts, ["bucket", "block"])
    place = F.col("start") + F.col("place")
    return placed.select(
        "doc_id", "piece", "token_from", "n_tokens", "bucket",
        (by_bucket(base) + F.floor(place / by_bucket(fit))).cast("long").alias("batch_id"),
        (place % by_bucket(fit)).cast("long").alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, **choices) -> DataFrame:
    """Token lengths of the whole texts, packed; other columns are ignored, whatever their names."""
    return pack(materialise(token_lengths(docs, doc_id, text, path)), **choices)
