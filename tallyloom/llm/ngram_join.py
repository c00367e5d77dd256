"""Near duplicates by an n-gram Jaccard self-join, as a blocked sparse matrix product.

Rows of the matrix are sets of word n-grams (one row per different set, so exact copies never
meet), columns are n-grams, blocks are ranges of n-gram hashes. First, over a sample of the columns
that is a function of the n-gram alone, every block counts in how many rows each column is: a row with
so many columns of its own that no other row can share enough of the rest is left out for good. Of
the rows that stay, only the columns of a prefix enter the product: with columns in one fixed order,
frequent ones last, two similar sets share columns among their first ones. The product adds up
how many of them two rows share; pairs that cannot reach the wanted overlap by their sizes are dropped, the rest is
compared exactly.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrays import LOWER, NOT_SPACE, Hasher, distinct_pairs, mix, pieces, runs, tidy, windows
from tallyloom.llm.graph import components
from tallyloom.session import materialise

_ZSTD = "zstd"


def sets(data: np.ndarray, offsets: np.ndarray, size: int):
    """(documents, hashes): the distinct n-grams of each text; fewer words are one n-gram."""
    data = LOWER[data]
    starts, ends, docs = runs(data, offsets, NOT_SPACE)
    words = Hasher(data).of(starts, ends)
    grams, first = windows(words, docs, size)
    found = [(docs[first], grams)]
    counts = np.bincount(docs, minlength=len(offsets) - 1)
    for few in range(1, size):
        short = counts[docs] == few
        if short.any():
            whole, first = windows(words[short], docs[short], few)
            found.append((docs[short][first], mix(whole + np.uint64(few))))
    return distinct_pairs(np.concatenate([d for d, _ in found]), np.concatenate([h for _, h in found]))


def signatures(docs: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, signatures) of each document's set; equal sets have equal signatures."""
    sizes = np.bincount(docs, minlength=n).astype(np.int64)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    ends = np.cumsum(sizes)
    return sizes, mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64))


def parities(docs: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """256 bits for each document's set: of every 256th part of all n-grams, whether it holds an odd number.

    Sets that differ in d n-grams differ in d bits at most, so many different bits tell that two sets
    are not similar, without a look at the sets.
    """
    bit = mix(hashes ^ np.uint64(0x2545F4914F6CDD1D))
    found = np.zeros(4 * n, dtype=np.uint64)
    np.bitwise_xor.at(found, 4 * docs + (bit >> np.uint64(6) & np.uint64(3)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return found.reshape(n, 4)


_PARITY = ("p0", "p1", "p2", "p3")


def _survey(size: int):
    """Rows (doc_id, copy, n, sampled, node and parities): of each document's set its size, its sampled columns, its signature."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in pieces(batch.column(2)):
                count = len(offsets) - 1
                docs, hashes = sets(data, offsets, size)
                sizes, nodes = signatures(docs, hashes, count)
                sampled = np.bincount(docs[_in_sample(hashes)], minlength=count).astype(np.int64)
                parity = parities(docs, hashes, count).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(row, count) for c in batch.columns[:2]),
                        pa.array(sizes), pa.array(sampled), pa.array(nodes.view(np.int64)),
                        *(pa.array(parity[:, k]) for k in range(4)),
                    ],
                    names=["doc_id", "copy", "n", "sampled", "node", *_PARITY],
                )

    return run


def _in_sample(hashes: np.ndarray) -> np.ndarray:
    """Every other column, by its hash."""
    return hashes & np.uint64(1) == 0


_SAMPLE = "block long, low binary, high binary, node binary, nodes binary"


def _samples(size: int, blocks: int):
    """Sampled columns of every different set of the partition, cut into tiles by n-gram hash.

    A column is told apart by 48 bits and its block; a tile lists its rows once and points at them.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            held = []
            for _, data, offsets in pieces(batch.column(0)):
                count = len(offsets) - 1
                docs, hashes = sets(data, offsets, size)
                sizes, nodes = signatures(docs, hashes, count)
                new = np.zeros(count, dtype=bool)
                new[np.unique(nodes, return_index=True)[1]] = True
                new &= (sizes > 0) & ~np.isin(nodes, seen)
                seen = np.union1d(seen, nodes[new])
                wanted = new[docs] & _in_sample(hashes)
                held.append((hashes[wanted], nodes[docs[wanted]]))
            if not held:
                continue
            h, node = (np.concatenate(x) for x in zip(*held))
            block = ((h >> np.uint64(1)) % np.uint64(blocks)).astype(np.int64)
            order = np.lexsort((node, block))
            block, h, node = block[order], mix(h[order]), node[order]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)])) if len(block) else [0]
            rows = []
            for a, b in zip(cuts, cuts[1:]):
                new = np.concatenate(([True], node[a + 1 : b] != node[a : b - 1]))
                place = np.cumsum(new) - 1
                rows.append(
                    (
                        int(block[a]), h[a:b].astype("<u4").tobytes(), (h[a:b] >> np.uint64(32)).astype("<u2").tobytes(),
                        place.astype("<u2" if place[-1] < 1 << 16 else "<u4").tobytes(), node[a:b][new].tobytes(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))],
                names=["block", "low", "high", "node", "nodes"],
            )

    return run


_SHARED = "bucket long, nodes binary, shared binary"


def _shared_counts(buckets: int):
    """How many columns of a block each row has in common with another row, packed by buckets of rows."""

    def run(tiles: pa.Table) -> pa.Table:
        columns, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for low, high, place, nodes in zip(*(tiles.column(c).to_pylist() for c in ("low", "high", "node", "nodes"))):
            low = np.frombuffer(low, "<u4")
            columns.append(low.astype(np.uint64) | (np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32)))
            place = np.frombuffer(place, f"<u{len(place) // len(low)}")
            rows.append(np.frombuffer(nodes, np.uint64)[place])
        column, row = np.concatenate(columns), np.concatenate(rows)
        order = np.lexsort((row, column))
        column, row = column[order], row[order]
        new = np.ones(len(column), dtype=bool)  # tasks that hold copies of one set send it each
        new[1:] = (column[1:] != column[:-1]) | (row[1:] != row[:-1])
        column, row = column[new], row[new]
        same = column[1:] == column[:-1]
        shared = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        nodes, counts = np.unique(row[shared[: len(row)]], return_counts=True)
        return _by_bucket(nodes, counts, buckets)

    return run


def _by_bucket(nodes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    bucket = (mix(nodes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, nodes, counts = bucket[order], nodes[order], counts[order].astype("<u4")
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)])) if len(bucket) else np.zeros(1, int)
    return pa.table(
        {
            "bucket": pa.array(bucket[cuts[:-1]], pa.int64()),
            "nodes": pa.array([nodes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            "shared": pa.array([counts[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        }
    )


def _add_up(parts: pa.Table) -> pa.Table:
    """Shared columns of the rows of one bucket over all blocks."""
    nodes = np.frombuffer(b"".join(parts.column("nodes").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(parts.column("shared").to_pylist()), "<u4")
    nodes, place = np.unique(nodes, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(nodes)).astype(np.int64)
    return pa.table({"node": nodes.view(np.int64), "shared": total})


def _texts(batch: pa.RecordBatch) -> Iterator[pa.Array]:
    """The packed texts of a batch, some at a time."""
    codec = pa.Codec(_ZSTD)
    z, sizes = batch.column("z"), batch.column("z_len").to_pylist()
    at = 0
    while at < batch.num_rows:
        texts, held = [], 0
        while at < batch.num_rows and held < 4 << 20:
            texts.append(codec.decompress(z[at].as_py(), decompressed_size=sizes[at], asbytes=True) if sizes[at] else b"")
            held += sizes[at]
            at += 1
        yield pa.array(texts, pa.large_binary())


_COLUMNS = "block long, h binary, n binary"


def _columns(size: int, blocks: int):
    """All n-grams of the rows with their numbers of rows, some rows at a time, packed by blocks of their hashes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _texts(batch):
                held = [np.zeros(0, np.uint64)]
                held += [sets(data, offsets, size)[1] for _, data, offsets in pieces(texts)]
                h, n = np.unique(np.concatenate(held), return_counts=True)
                block = ((h >> np.uint64(16)) % np.uint64(blocks)).astype(np.int64)
                order = np.argsort(block, kind="stable")
                block, h, n = block[order], h[order], n[order].astype("<u4")
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)])) if len(block) else np.zeros(1, int)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block[cuts[:-1]], pa.int64()),
                        pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        pa.array([n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["block", "h", "n"],
                )

    return run


def _frequent(least: int):
    """N-grams of one block that at least so many rows hold, with their number of rows."""

    def run(parts: pa.Table) -> pa.Table:
        h, n = (np.frombuffer(b"".join(parts.column(c).to_pylist()), kind) for c, kind in (("h", np.uint64), ("n", "<u4")))
        grams, place = np.unique(h, return_inverse=True)
        counts = np.bincount(place, weights=n, minlength=len(grams)).astype(np.int64)
        often = counts >= least
        return pa.table({"gram": grams[often].view(np.int64), "n": counts[often]})

    return run


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first columns of a set of n must be looked at."""
    return n - (percent * n + 99) // 100 + 1


_TILE = "block long, h binary, node binary, n binary, pos binary"
_TILE_NAMES = ["block", "h", "node", "n", "pos"]


def _tiles(size: int, percent: int, blocks: int, hot):
    """Prefix columns of the rows, cut into tiles by n-gram hash.

    The rarer of the frequent columns come before the others, all of them after the rest. Columns in the ``hot`` table go to tiles of their own, numbered from ``blocks`` on, one per batch.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, level = hot.value
        for batch in batches:
            held = []
            for texts in _texts(batch):
                for _, data, offsets in pieces(texts):
                    count = len(offsets) - 1
                    docs, hashes = sets(data, offsets, size)
                    sizes, nodes = signatures(docs, hashes, count)
                    at = np.searchsorted(frequent[:-1], hashes)
                    rank = np.where(frequent[at] == hashes, level[at], 0)
                    common = rank > 0
                    order = np.lexsort((hashes, rank, docs))
                    docs, hashes, common = docs[order], hashes[order], common[order]
                    place = np.arange(len(docs)) - (np.cumsum(sizes) - sizes)[docs]
                    keep = place < prefix_length(sizes, percent)[docs]
                    docs = docs[keep]
                    held.append((hashes[keep], nodes[docs], sizes[docs], place[keep], common[keep]))
            if not held:
                continue
            h, node, n, place, common = (np.concatenate(x) for x in zip(*held))
            block = (h >> np.uint64(16)) % np.uint64(blocks)
            block = np.where(common, blocks + (mix(h) ^ node) % np.uint64(4 * blocks), block).astype(np.int64)
            order = np.lexsort((h, block))
            block, h, node = block[order], h[order], node[order]
            n, place = n[order].astype(np.int32), place[order].astype(np.int32)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)])) if len(block) else [0]
            rows = [
                (int(block[a]), h[a:b].tobytes(), node[a:b].tobytes(), n[a:b].tobytes(), place[a:b].tobytes())
                for a, b in zip(cuts, cuts[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3, 4))],
                names=_TILE_NAMES,
            )

    return run


def _shared_columns(blocks: int):
    """The incidences of one block whose column holds two different rows or more."""

    def run(tiles: pa.Table) -> pa.Table:
        if tiles.num_rows:
            h, node = (
                np.frombuffer(b"".join(tiles.column(c).to_pylist()), dtype=np.uint64) for c in ("h", "node")
            )
            n, place = (np.frombuffer(b"".join(tiles.column(c).to_pylist()), dtype=np.int32) for c in ("n", "pos"))
            order = np.lexsort((node, h))
            h, node, n, place = h[order], node[order], n[order], place[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
            h, node, n, place = h[new], node[new], n[new], place[new]
            if tiles.column("block")[0].as_py() < blocks:
                same = h[1:] == h[:-1]
                keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
                h, node, n, place = h[keep], node[keep], n[keep], place[keep]
        else:
            h = node = np.zeros(0, np.uint64)
            n = place = np.zeros(0, np.int32)
        return pa.table({"h": h.view(np.int64), "node": node.view(np.int64), "n": n, "pos": place})

    return run


def need(a: str, b: str, percent: int):
    """Smallest overlap of two sets of these sizes with the wanted similarity."""
    return F.ceil(F.lit(percent) * (F.col(a) + F.col(b)) / F.lit(100 + percent))


def shared_least(percent: int):
    """How many columns two rows of sizes na and nb must share among the first ones looked at.

    With overlap ``need`` or more, two rows share at least k columns among the first
    n - need + k of each: what lies behind them in the row whose first ones end earlier adds
    less than the rest. k is about a hundredth of the smaller row, as far as the prefixes reach: a larger
    one would leave fewer pairs to compare, but the product would look at more columns.
    """
    first = lambda c: F.ceil(F.lit(percent) * F.col(c) / 100)
    reach = need("na", "nb", percent) - F.greatest(first("na"), first("nb"))
    return 1 + F.least(F.floor(F.least("na", "nb") / 100), reach)


def product(left: DataFrame, right: DataFrame, percent: int, condition) -> DataFrame:
    """Pairs (a, b, na, nb) of rows that share enough columns to be similar, by adding up columns."""
    first = shared_least(percent) - need("na", "nb", percent)
    looked_at = (F.col("pa") < F.col("na") + first) & (F.col("pb") < F.col("nb") + first)
    pairs = left.join(right, "h").where(condition & _sizes_fit("na", "nb", percent) & looked_at)
    pairs = pairs.groupBy("a", "b").agg(F.first("na").alias("na"), F.first("nb").alias("nb"), F.count(F.lit(1)).alias("shared"))
    return pairs.where(F.col("shared") >= shared_least(percent))


def parities_fit(percent: int):
    """Whether two rows differ in so few bits that they can have the wanted overlap."""
    bits = [F.bit_count(F.col(f"{p}a").bitwiseXOR(F.col(f"{p}b"))) for p in _PARITY]
    return sum(bits[1:], bits[0]) <= F.col("na") + F.col("nb") - 2 * need("na", "nb", percent)


def _sizes_fit(a: str, b: str, percent: int):
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


@tidy
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different text of the partition once, packed."""
    codec = pa.Codec(_ZSTD, compression_level=1)
    seen: set[int] = set()
    for batch in batches:
        copies = batch.column(0).to_pylist()
        new = [k for k, c in enumerate(copies) if not (c in seen or seen.add(c))]
        raw = [(t.as_py() or "").encode() for t in batch.column(1).take(pa.array(new, pa.int64()))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(new, pa.int64())),
                pa.array([codec.compress(t, asbytes=True) for t in raw], pa.binary()),
                pa.array([len(t) for t in raw], pa.int64()),
            ],
            names=["copy", "z", "z_len"],
        )


def _compare(size: int, percent: int):
    """Of pairs with both packed texts, those with the wanted similarity."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(_ZSTD)
        for batch in batches:
            linked = np.zeros(batch.num_rows, dtype=bool)
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for z, length in (("za", "la"), ("zb", "lb")):
                    texts += [
                        codec.decompress(x, decompressed_size=k, asbytes=True).decode() if k else ""
                        for x, k in zip(part.column(z).to_pylist(), part.column(length).to_pylist())
                    ]
                found = []
                for row, data, offsets in pieces(pa.array(texts, pa.large_string())):
                    docs, hashes = sets(data, offsets, size)
                    found.append((docs + row, hashes))
                docs, hashes = (np.concatenate(x) for x in zip(*found))
                m = part.num_rows
                sizes = np.bincount(docs, minlength=2 * m)
                pair = docs % m
                order = np.lexsort((hashes, pair))
                pair, hashes = pair[order], hashes[order]
                both = np.bincount(
                    pair[1:][(pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1])], minlength=m
                )
                linked[at : at + m] = (100 * both >= percent * (sizes[:m] + sizes[m:] - both)) & (both > 0)
            kept = pa.array(np.flatnonzero(linked))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"]
            )

    return run


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("z").alias("za"), F.col("z_len").alias("la"))
    right = texts.select(F.col("node").alias("b"), F.col("z").alias("zb"), F.col("z_len").alias("lb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(_compare(size, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 75,
    block_rows: int = 1_000_000,
    most_hot: int = 200_000,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Words are cut at white space, with A-Z lower-cased; sets are distinct n-grams of ``size``
    words (the whole text as one if it is shorter). Documents link when the Jaccard similarity of their sets is at
    least ``percent`` / 100. Null, empty and blank texts have the empty set and link with nothing.
    Documents of equal sets are one row of the matrix, whatever their number. Rows that repeat a
    doc_id, with equal or different texts, are documents of their own, linked as their texts say. Rows without a
    doc_id link others, and are linked, like any; a group of such rows alone has no component_id. doc_id
    must be an integer. Other columns are ignored, whatever their names. Sets, texts and n-grams are told
    apart by 64-bit hashes.

    Links inside a large group are found in two products. The first pairs the rows of a column with
    its smallest row only and joins what is similar; the second takes the pairs of a column that
    are in different components by then. So a group of thousands of near copies costs about one comparison each,
    and no link is lost. ``most_hot`` bounds the table of frequent n-grams that is broadcast; it only decides
    which columns come last in the order, never which pairs are found.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copy = F.xxhash64(F.coalesce(text, F.lit(""))).alias("copy")
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), copy, F.col(text).alias("text"))
    members = materialise(frame.mapInArrow(_survey(size), "doc_id long, copy long, n long, sampled long, node long, p0 long, p1 long, p2 long, p3 long"))
    nodes = members.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("copy").alias("copy"), F.first("n").alias("n"), F.first("sampled").alias("sampled"),
        *(F.first(p).alias(p) for p in _PARITY),
    )
    blocks = max(partitions, int((nodes.agg(F.sum("sampled").alias("t")).first()["t"] or 0) // block_rows) + 1)
    shared = (
        frame.select("text").mapInArrow(_samples(size, blocks), _SAMPLE)
        .groupBy("block").applyInArrow(_shared_counts(blocks), _SHARED)
        .groupBy("bucket").applyInArrow(_add_up, "node long, shared long")
    )
    # with this many columns of its own, a row has too few left that another one can have
    alone = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    alike = nodes.join(shared, "node", "left").where(F.col("sampled") - F.coalesce("shared", F.lit(0)) < alone)
    packed = frame.select("copy", "text").mapInArrow(_pack, "copy long, z binary, z_len long")
    texts = packed.join(alike.select("copy", "node", "n"), "copy").groupBy("node").agg(
        F.first("n").alias("n"), F.first(F.struct("z", "z_len")).alias("t")
    )
    texts = materialise(texts.select("node", "n", "t.z", "t.z_len"))

    total, columns = texts.agg(F.sum(F.col("n") / 4 + 1), F.sum("n")).first()
    blocks = max(partitions, int((total or 0) // block_rows) + 1)
    parts = max(partitions, int((columns or 0) // block_rows) + 1)
    # counted over all rows, so that neither the partitions nor the batches decide what is frequent
    hot = texts.select("z", "z_len").mapInArrow(_columns(size, parts), _COLUMNS)
    hot = hot.groupBy("block").applyInArrow(_frequent(64), "gram long, n long")
    hot = hot.orderBy(F.desc("n"), "gram").limit(most_hot).toPandas()
    grams, counts = hot["gram"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)
    order = np.argsort(grams)
    # the last entry only keeps a search inside the array
    hot = spark.sparkContext.broadcast(
        (np.append(grams[order], np.uint64(0)), np.append(np.log2(counts[order]).astype(np.uint8), np.uint8(0)))
    )
    incidence = materialise(
        texts.select("z", "z_len").mapInArrow(_tiles(size, percent, blocks, hot), _TILE)
        .groupBy("block").applyInArrow(_shared_columns(blocks), "h long, node long, n int, pos int")
    )
    hot.unpersist()

    # the row of a column that shares most of its columns stands for the others: of near copies,
    # that is the one they were copied from
    weight = incidence.groupBy("node").agg((F.count(F.lit(1)) * 1000 / F.first("n")).cast("long").alias("weight"))
    leaders = incidence.join(weight, "node").groupBy("h").agg(F.max(F.struct("weight", "node", "n", "pos")).alias("first"))
    leaders = leaders.select(
        "h", F.col("first.node").alias("a"), F.col("first.n").alias("na"), F.col("first.pos").alias("pa")
    )
    right = incidence.select("h", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    first = materialise(product(leaders, right, percent, F.col("a") != F.col("b")))
    near = materialise(_verified(first, texts, size, percent))
    groups = components(near)

    grouped = incidence.join(groups, "node", "left").select(
        "h", "node", "n", "pos", F.coalesce("component", "node").alias("component")
    )
    mixed = grouped.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    grouped = materialise(grouped.join(mixed.select("h"), "h").join(nodes.select("node", *_PARITY), "node"))
    left, right = (
        grouped.select("h", F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("pos").alias(f"p{c}"), F.col("component").alias(f"c{c}"), *(F.col(p).alias(f"{p}{c}") for p in _PARITY))
        for c in "ab"
    )
    # near copies of one text may share what all of them hold and still be too far from each other: their parities tell most
    apart = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & parities_fit(percent)
    rest = product(left, right, percent, apart)
    rest = rest.join(
        first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
    )
    rest = materialise(rest)
    more = materialise(_verified(rest, texts, size, percent))
    groups = components(near.unionByName(more))

    named = nodes.join(groups, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component_id")
    keyed = members.withColumn("key", F.when(F.col("n") > 0, F.col("node")))
    return keyed.join(named.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
