"""Removal of long repeated strings, by sorting the suffixes that may hold them.

A string of ``length`` bytes that occurs twice holds the same grams of half that length at the
same places. Each window of ``length`` bytes picks the gram with the smallest hash in it, its
anchor, by its content alone; so equal windows pick equal anchors. Only about one position in a
hundred is an anchor, and only anchors whose gram occurs elsewhere go on. Their suffixes (and the
text before them, read backwards) are sorted within the group of equal grams, and from
what neighbours have in common follows which windows around each anchor occur again.
"""

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrays import Hasher, mix, pieces, tidy
from tallyloom.llm.suffix_sort import common, deep_shallow
from tallyloom.session import materialise

_SEGMENT = 1 << 20
_PLACE = np.uint64(_SEGMENT - 1)
BAND = 25


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the grams that windows of the documents pick."""
    gram = length // 2
    found = []
    last = len(data) - length
    for low in range(0, max(last + 1, 0), _SEGMENT - length + 1):
        part = data[low : low + _SEGMENT]
        hasher = Hasher(part)
        at = np.arange(len(part) - gram + 1)
        hashes = mix((hasher.sums[gram:] - hasher.sums[:-gram]) * hasher.back[: len(at)])
        least = _least((hashes & ~_PLACE) | at.astype(np.uint64), length - gram + 1)
        window = np.arange(len(least)) + low
        inside = offsets[np.searchsorted(offsets, window, "right")] - window >= length
        picked = np.unique((least[inside] & _PLACE).astype(np.int64))
        found.append((picked + low, hashes[picked]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    positions, hashes = (np.concatenate(x) for x in zip(*found))
    positions, first = np.unique(positions, return_index=True)
    return positions, hashes[first]


def _anchors(length: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in pieces(batch.column(2)):
                positions, hashes = anchors(data, offsets, length)
                docs = np.searchsorted(offsets, positions, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + docs)),
                        batch.column(1).take(pa.array(row + docs)),
                        pa.array(positions - offsets[docs], pa.int64()),
                        pa.array(hashes.view(np.int64)),
                    ],
                    names=["doc_id", "copy", "pos", "gram"],
                )

    return run


@tidy
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        raw = [(t.as_py() or "").encode() for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([codec.compress(t, asbytes=True) for t in raw], pa.binary()),
                pa.array([len(t) for t in raw], pa.int64()),
            ],
            names=["doc_id", "copy", "z", "z_len"],
        )


def _open(codec, z: bytes, size: int) -> bytes:
    return codec.decompress(z, decompressed_size=size, asbytes=True) if size else b""


_AROUND = "bucket long, part long, lo long, hi long, before binary, after binary, members binary"
#: A member of a surrounding: id of its document (no id as the least number), hash of its text, place of the anchor.
_MEMBER, _MEMBER_BYTES = "<3q", 24
_NO_ID = -(1 << 63)


def _around(length: int, buckets: int, limit: int, most: int = 16 << 20):
    """What surrounds each anchor; equal surroundings of a batch are one row with all their places.

    Grams of more than ``limit`` places are cut into bands of offsets. All windows of a band share
    a longer core, so a band's rows are dealt out by that core's hash.
    """
    gram = length // 2
    reach = length - gram

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        held: dict[tuple, list] = {}
        size = 0

        def flush():
            rows = list(held.items())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] % buckets for k, _ in rows], pa.int64()),
                    *(pa.array([k[c] for k, _ in rows], pa.int64()) for c in range(3)),
                    *(pa.array([k[c] for k, _ in rows], pa.binary()) for c in (3, 4)),
                    pa.array([b"".join(m) for _, m in rows], pa.binary()),
                ],
                names=["bucket", "part", "lo", "hi", "before", "after", "members"],
            )

        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_pylist()
            listed = batch.column(4)
            ends, held_places = listed.offsets.to_pylist(), listed.values
            positions, grams, times = (held_places.field(c).to_pylist() for c in ("pos", "gram", "n"))
            for row, (doc_id, copy, z, n) in enumerate(zip(ids, *(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                text = _open(codec, z, n)
                for place in range(ends[row], ends[row + 1]):
                    at, part, often = positions[place], grams[place], times[place]
                    end = at + gram
                    member = struct.pack(_MEMBER, doc_id, copy, at)
                    bands = [(0, reach)] if often <= limit else [
                        (b, min(b + BAND - 1, reach)) for b in range(0, reach + 1, BAND)
                    ]
                    for lo, hi in bands:
                        if at < lo or len(text) - end < reach - hi:
                            continue  # no window of the band lies in the document
                        key = part
                        if often > limit:
                            core = text[at - lo : end + reach - hi]
                            key = int.from_bytes(hashlib.blake2b(core + bytes([lo]), digest_size=8).digest(), "little", signed=True)
                        key = (key, lo, hi, text[max(0, at - hi) : at][::-1], text[end : end + reach - lo])
                        if key not in held:
                            held[key] = []
                            size += 2 * reach
                        held[key].append(member)
                        size += 24
                if size >= most:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    return run


def repeated_offsets(around: list[tuple[bytes, bytes]], counts: list[int], lo: int, hi: int, reach: int) -> list[np.ndarray]:
    """For each (text before, backwards; text after) of one gram: per offset from ``lo`` to ``hi``, whether the
    window that begins that many bytes before the gram occurs again."""
    m, width = len(around), hi - lo + 1
    marks = np.zeros((m, width + 1), dtype=np.int64)

    def fits(k: int) -> tuple[int, int]:
        before, after = around[k]
        return max(lo, reach - len(after)), min(hi, len(before))

    def mark(k: int, a: int, b: int) -> None:
        if a <= b:
            marks[k, a - lo] += 1
            marks[k, b - lo + 1] -= 1

    for k, count in enumerate(counts):
        if count > 1:
            mark(k, *fits(k))
    if m == 2:
        a = max(lo, reach - common(around[0][1], around[1][1]))
        b = min(hi, common(around[0][0], around[1][0]))
        mark(0, a, b)
        mark(1, a, b)
    elif m > 2:
        by_after, after = deep_shallow([a for _, a in around])
        by_before, before = deep_shallow([b for b, _ in around])
        if m <= 128:
            shared = []
            for order, lengths in ((by_after, after), (by_before, before)):
                table = np.zeros((m, m), dtype=np.int64)
                lengths = np.array(lengths)
                order = np.array(order)
                for k in range(m - 1):
                    least = np.minimum.accumulate(lengths[k + 1 :])
                    table[order[k], order[k + 1 :]] = least
                    table[order[k + 1 :], order[k]] = least
                shared.append(table)
            a, b = np.maximum(lo, reach - shared[0]), np.minimum(hi, shared[1])
            meet = a <= b
            np.fill_diagonal(meet, False)
            i, j = np.nonzero(meet)
            np.add.at(marks, (i, a[i, j] - lo), 1)
            np.add.at(marks, (i, b[i, j] - lo + 1), -1)
        else:
            after_of, before_of = np.zeros(m, np.int64), np.zeros(m, np.int64)
            starts = np.array([fits(k)[0] for k in range(m)])
            ends = np.array([fits(k)[1] for k in range(m)])
            covered = np.zeros((m, width), dtype=bool)
            after, before = np.array(after), np.array(before)
            for offset in range(lo, hi + 1):
                after_of[by_after] = np.cumsum(after < reach - offset)
                before_of[by_before] = np.cumsum(before < offset)
                real = np.flatnonzero((starts <= offset) & (offset <= ends))
                _, inverse, many = np.unique(after_of[real] * m + before_of[real], return_inverse=True, return_counts=True)
                covered[real, offset - lo] = many[inverse] > 1
            return [covered[k] | (np.cumsum(marks[k, :-1]) > 0) for k in range(m)]
    return list(np.cumsum(marks[:, :-1], axis=1) > 0)


def _resolve(length: int):
    """Repeated stretches of all members of one bucket."""
    reach = length - length // 2

    def run(rows: pa.Table) -> pa.Table:
        groups: dict[tuple, dict] = {}
        for row in zip(*(rows.column(c).to_pylist() for c in ("part", "lo", "hi", "before", "after", "members"))):
            groups.setdefault(row[:3], {}).setdefault(row[3:5], []).append(row[5])
        out = []
        for (_, lo, hi), around in groups.items():
            members = [b"".join(m) for m in around.values()]
            if len(members) == 1 and len(members[0]) == _MEMBER_BYTES:
                continue
            found = repeated_offsets(list(around), [len(m) // _MEMBER_BYTES for m in members], lo, hi, reach)
            for own, again in zip(members, found):
                if not again.any():
                    continue
                edge = np.diff(np.concatenate(([0], again.view(np.int8), [0])))
                for a, b in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()):
                    out += [(doc_id, copy, pos - lo - b, pos - lo - a + length) for doc_id, copy, pos in struct.iter_unpack(_MEMBER, own)]
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "copy", "a", "b"), columns)})

    return run


@tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for batch in batches:
        kept, sizes, removed, spans = [], [], [], []
        for z, n, cuts in zip(*(batch.column(c).to_pylist() for c in ("z", "z_len", "cuts"))):
            text, merged = _open(codec, z, n), []
            for a, b in sorted((c["a"], c["b"]) for c in cuts or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            low, rest = 0, []
            for a, b in merged:
                rest.append(text[low:a])
                low = b
            kept.append(b"".join([*rest, text[low:]]))
            sizes.append(n)
            removed.append(sum(b - a for a, b in merged))
            spans.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeated_strings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400,
    bucket_rows: int = 20_000, limit: int = 20_000,
) -> DataFrame:
    """Documents without the bytes of strings of ``length`` bytes that also start anywhere else.

    Texts are taken as UTF-8 bytes; strings do not cross documents; overlapping occurrences in one
    text count. Returns doc_id, n_bytes, n_removed, spans (maximal removed runs, as byte offsets of the
    original) and kept (bytes, which may begin or end inside a character). Null and empty texts have no
    bytes, shorter texts than ``length`` stay whole. Repeated rows are documents of their own, so their texts
    repeat each other; doc_id must be an integer or null. Other columns are ignored, whatever their names.
    Grams are found by 64-bit hashes of ``length`` / 2 bytes.
    """
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # rows with one id and different texts are told apart by a hash; a null id takes part like any other
    frame = frame.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"), "text")
    places = frame.mapInArrow(_anchors(length), "doc_id long, copy long, pos long, gram long")
    often = materialise(places.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    total = often.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // bucket_rows + 1)
    key = [F.coalesce("doc_id", F.lit(_NO_ID)).alias("k"), F.col("copy").alias("c")]
    packed = frame.mapInArrow(_pack, "doc_id long, copy long, z binary, z_len long").select("*", *key)
    # a set, since repeated rows bring equal places; nothing between join and shuffle needs a gram's
    # places together, so that Spark can split a gram that a third of all documents hold
    wanted = places.join(often, "gram").groupBy(*key).agg(F.collect_set(F.struct("pos", "gram", "n")).alias("places"))
    around = packed.join(wanted, ["k", "c"]).select("doc_id", "copy", "z", "z_len", "places")
    cuts = (
        around.mapInArrow(_around(length, buckets, limit), _AROUND)
        .groupBy("bucket").applyInArrow(_resolve(length), "doc_id long, copy long, a long, b long")
        .groupBy(*key).agg(F.collect_set(F.struct("a", "b")).alias("cuts"))
    )
    return packed.join(cuts, ["k", "c"], "left").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    )
