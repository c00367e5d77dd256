"""Benchmark decontamination: one automaton over normalised test items, one scan of every text."""

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrays import tidy

#: Words are runs of digits, letters a-z and bytes of 0x80 and more, after A-Z became a-z.
SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
NORMAL = bytes.maketrans(
    bytes(range(65, 91)) + SEPARATORS, bytes(range(97, 123)) + b" " * len(SEPARATORS)
)

SCHEMA = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<start: long, end: long>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_BUILT: dict[str, object] = {}


def item_windows(items: list[tuple[str, str]], size: int) -> dict[bytes, list[str]]:
    """Normalised windows, each with the items that hold it. An item of fewer words is one window."""
    found: dict[bytes, list[str]] = {}
    for item_id, text in items:
        words = (text or "").encode().translate(NORMAL).split()
        for k in range(max(1, len(words) - size + 1) if words else 0):
            owners = found.setdefault(b" ".join(words[k : k + size]), [])
            if not owners or owners[-1] != item_id:
                owners.append(item_id)
    return found


def _automaton(key: str, shared, size: int):
    """The automaton of a broadcast block of items, built once in each worker."""
    if key not in _BUILT:
        _BUILT.clear()
        machine = ahocorasick.Automaton()
        for window, owners in item_windows(shared.value, size).items():
            # spaces at both ends make a match begin and end at words
            machine.add_word((b" " + window + b" ").decode("latin-1"), (window.count(b" ") + 1, owners))
        if len(machine):
            machine.make_automaton()
        _BUILT[key] = machine
    return _BUILT[key]


def _scan(machine, text: str | None):
    """(words, which words are hit or None, items)."""
    words = (text or "").encode().translate(NORMAL).split()
    if not words or not len(machine):
        return len(words), None, ()
    found = list(machine.iter((b" " + b" ".join(words) + b" ").decode("latin-1")))
    if not found:
        return len(words), None, ()
    joined = np.cumsum([0] + [len(w) + 1 for w in words])  # positions of the spaces
    change = np.zeros(len(words) + 1, dtype=np.int64)
    items = set()
    ends = np.searchsorted(joined, [end for end, _ in found])
    for end, (_, (length, owners)) in zip(ends, found):
        change[end - length] += 1
        change[end] -= 1
        items.update(owners)
    return len(words), np.cumsum(change[:-1]) > 0, items


def _sorted(items) -> list:
    """Ids in order; no id (of all items without one) comes last."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def _spans(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words, in code points of the text.

    Normalising keeps every byte's place, so word k of the scan is run k of the original.
    """
    raw = text.encode()
    inside = np.frombuffer(raw.translate(NORMAL), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    turn = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) - 1
    return [{"start": a, "end": b} for a, b in zip(points[starts[first]].tolist(), points[stops[last]].tolist())]


def _scan_with(shared, size: int, text_at: int):
    key = uuid.uuid4().hex

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(key, shared, size)
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for text in batch.column(text_at):
                text = text.as_py()
                words, hit, owners = _scan(machine, text)
                n_words.append(words)
                n_hit.append(0 if hit is None else int(hit.sum()))
                items.append(_sorted(owners))
                spans.append([] if hit is None else _spans(text, hit))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, _SPAN),
                ],
                names=[*batch.schema.names, "n_words", "n_hit", "items", "spans"],
            )

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    size: int = 13,
    block_bytes: int = 64 << 20,
    keep_text: bool = False,
    unnamed: bool = False,
) -> DataFrame:
    """Passages of ``benchmark`` items in documents.

    Per row of ``docs``: its id, ``n_words``, ``n_hit`` (words inside any occurrence of an
    item's window of ``size`` words), ``items`` (ids as strings, sorted as strings) and
    ``spans`` (runs of hit words, as code point offsets into the original text). Scanning takes
    no shuffle.

    The automaton of a block of items is broadcast. A block holds at most ``block_bytes`` of
    item text (one item at least); a larger benchmark is scanned block by block, each pass
    adding to the last, so it may have any size. Documents of null, empty or separators only
    have 0 words and no hits; items without words match nothing; items of fewer than
    ``size`` words count as one window; an item listed twice counts once; an empty
    benchmark hits nothing. Items without an id match nothing, or with ``unnamed`` as any other: together they are one
    null, the last of ``items``. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    sized = benchmark.select(
        F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"), F.octet_length(text).alias("b")
    ).where("t is not null" if unnamed else "t is not null and i is not null")
    total = sized.agg(F.sum("b").alias("b")).first()["b"] or 0
    blocks = max(1, -(-total * 2 // block_bytes))
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if blocks == 1:
        items = [(r["i"], r["t"]) for r in sized.collect()]
        out = frame.mapInArrow(
            _scan_with(spark.sparkContext.broadcast(items), size, 1), f"doc_id {_kind(docs, doc_id)}, text string, {SCHEMA}"
        )
        return out if keep_text else out.drop("text")
    return _scan_blocks(frame, sized, blocks, size, _kind(docs, doc_id), keep_text)


def _kind(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.simpleString()


def _union_with(shared, size: int):
    """A further block: hit words of earlier passes come as bits and are added to."""
    key = uuid.uuid4().hex

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(key, shared, size)
        for batch in batches:
            n_words, bits, items, spans = [], [], [], []
            for text, b, i, s in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4, 5))):
                words, hit, owners = _scan(machine, text)
                if hit is not None:
                    if b:
                        hit |= np.unpackbits(np.frombuffer(b, np.uint8), count=words).astype(bool)
                    b, s = np.packbits(hit).tobytes(), _spans(text, hit)
                n_words.append(words)
                bits.append(b or b"")
                items.append(_sorted({*i, *owners}))
                spans.append(s)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, _SPAN),
                ],
                names=["doc_id", "text", "n_words", "bits", "items", "spans"],
            )

    return run


def _scan_blocks(frame, sized, blocks: int, size: int, kind: str, keep_text: bool) -> DataFrame:
    context = frame.sparkSession.sparkContext
    schema = (
        f"doc_id {kind}, text string, n_words long, bits binary, items array<string>, "
        "spans array<struct<start: long, end: long>>"
    )
    frame = frame.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.lit(b"").alias("bits"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start: long, end: long>>").alias("spans"),
    )
    for block in range(blocks):
        items = [(r["i"], r["t"]) for r in sized.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == block).collect()]
        frame = frame.mapInArrow(_union_with(context.broadcast(items), size), schema)
    counted = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length("bits"), F.lit(1))),
                    lambda k: F.coalesce(F.bit_count(F.conv(F.hex(F.substring("bits", k, F.lit(1))), 16, 10).cast("int")), F.lit(0))),
        F.lit(0).cast("long"), lambda a, b: a + b,
    )
    kept = ["doc_id", "text"] if keep_text else ["doc_id"]
    return frame.select(*kept, "n_words", counted.alias("n_hit"), "items", "spans")


def is_contaminated(share: int = 20):
    """A document with hits of at least one word in ``share``."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
