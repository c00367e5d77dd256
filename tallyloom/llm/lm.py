"""Language-model scores: stupid backoff over n-grams, computed by joining counts to n-grams by hash.

score(word | two words before) is count(triple) / count(pair before) for triples seen at least
``least`` times, else ``backoff`` * score(word | word before), which is count(pair) / count(word before)
for pairs seen as often, else ``backoff`` * count(word) / N; a first word has count(word) / N. A word that the
counts do not have at all counts as seen once.
Order 2 begins at the pairs.

Counts come from the whole corpus or, with several folds, from the other folds: documents are dealt out to folds by a
hash of their id, and a place is scored with the counts of all folds but its own, so that words and n-grams that
the rest of the corpus does not have are met, and back off. The count of every word is an aggregate of sums made per batch.
The n-grams are dealt out by the hash of a word, so that a word's count, the counts of its pairs
with the words on either side, of the triples around it, and all places where they are to be joined are in one block.
The block of a word adds what it gives to the next word; only the count of a next word seen too rarely
after it comes from the next word's block. The most frequent words would make blocks without bound: their counts are
broadcast (a few hundred numbers), they have no blocks, and their terms are added where their neighbours are,
or, for a pair of two of them, right where the text is read. A triple around a frequent word is in the blocks of
its other words, and each adds the part of the logarithm that it knows. Triples of three frequent words have blocks
of their own, but for the most frequent ones, which are counted first and broadcast.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.arrays import LOWER, NOT_SPACE, Hasher, mix, pieces, runs, tidy
from tallyloom.session import materialise

#: Marks of neighbours: none, one of the frequent words (its number added), or another word's hash.
NONE, FREQUENT, OTHER = 0, 1, 1 << 20
_BYTES = 5
_TILE = (
    "block long, words binary, runs binary, before binary, after binary, before_hot binary, after_hot binary, doc binary, docs binary"
)
_TRIPLES = "block long, words binary, runs binary, doc binary, docs binary"


def _words(texts: pa.Array, most: int = 1 << 23):
    """(first row, number of rows, hashes of words, row of each word), some megabytes at a time."""
    held, first, size = [], 0, 0
    for row, data, offsets in pieces(texts):
        lower = LOWER[data]
        starts, ends, docs = runs(lower, offsets, NOT_SPACE)
        held.append((Hasher(lower).of(starts, ends), docs + row - first))
        size += len(data)
        last = row + len(offsets) - 1
        if size >= most or last == len(texts):
            yield first, last - first, *(np.concatenate(x) for x in zip(*held))
            held, first, size = [], last, 0


def fold_of(ids: np.ndarray, folds: int) -> np.ndarray:
    """The fold of each document, by its id."""
    if folds == 1:
        return np.zeros(len(ids), dtype=np.int64)
    return ((mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(33)) % np.uint64(folds)).astype(np.int64)


def _counted(name: str, folds: int, keys_of):
    """Counts per fold of what ``keys_of`` finds in some megabytes of words, one row per key."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = fold_of(batch.column(0).to_numpy(zero_copy_only=False), folds)
            for row, n_rows, words, docs in _words(batch.column(1)):
                keys, own = keys_of(words, docs)
                values, place = np.unique(keys, return_inverse=True)
                counts = np.bincount(place * folds + ids[row : row + n_rows][own], minlength=len(values) * folds).reshape(-1, folds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), *(pa.array(counts[:, f].astype(np.int64)) for f in range(folds))],
                    names=[name, *(f"n{f}" for f in range(folds))],
                )

    return run


def _summed(frame: DataFrame, name: str, folds: int, keys_of) -> DataFrame:
    """``name``, n0, n1, ... (per fold) and n (in all), summed over the corpus."""
    each = [f"n{f}" for f in range(folds)]
    rows = frame.mapInArrow(_counted(name, folds, keys_of), f"{name} long, " + ", ".join(f"{c} long" for c in each))
    summed = rows.groupBy(name).agg(*[F.sum(c).alias(c) for c in each])
    return summed.withColumn("n", sum((F.col(c) for c in each[1:]), F.col(each[0])))


def _elsewhere(rows, folds: int) -> np.ndarray:
    """Counts for the places of each fold: those of all others, or of the whole corpus if there is one fold."""
    each = np.stack([rows[f"n{f}"].to_numpy(np.int64) for f in range(folds)])
    return each if folds == 1 else each.sum(axis=0) - each


def _places(words: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Number of each word among the sorted frequent ones, or -1."""
    at = np.minimum(np.searchsorted(frequent, words), max(len(frequent) - 1, 0))
    return np.where(frequent[at] == words, at, -1) if len(frequent) else np.full(len(words), -1)


def _pairs_of(frequent):
    """Pairs of two frequent words."""

    def keys(words: np.ndarray, docs: np.ndarray):
        at = _places(words, frequent.value[0])
        both = (at[:-1] >= 0) & (at[1:] >= 0) & (docs[:-1] == docs[1:])
        return at[:-1][both] * len(frequent.value[0]) + at[1:][both], docs[1:][both]

    return keys


def _triples(words: np.ndarray, docs: np.ndarray, hot: np.ndarray):
    """Places whose word and the two before it are frequent, and the triple's number."""
    at = _places(words, hot)
    all_hot = (at[2:] >= 0) & (at[1:-1] >= 0) & (at[:-2] >= 0) & (docs[2:] == docs[:-2])
    place = np.flatnonzero(all_hot) + 2
    return place, (at[place - 2] * len(hot) + at[place - 1]) * len(hot) + at[place]


def _found(keys: np.ndarray, table: tuple, fold: np.ndarray) -> np.ndarray:
    """Counts of sorted keys for places of each ``fold``, 0 for others."""
    known, counts = table
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    return np.where(known[at] == keys, counts[fold, at], 0) if len(known) else np.zeros(len(keys), np.int64)


def _known(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ``known`` ones."""
    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    return known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)


def _triples_of(frequent, often_pairs):
    """Triples of frequent words whose pairs are both among the given ones: others are rarer."""

    def keys(words: np.ndarray, docs: np.ndarray):
        hot = frequent.value[0]
        place, triple = _triples(words, docs, hot)
        size = max(len(hot), 1)
        often = _known(triple // size, often_pairs.value) & _known(triple % size**2, often_pairs.value)
        return triple[often], docs[place[often]]

    return keys


def _pack(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // _BYTES, 8), dtype=np.uint8)
    out[:, :_BYTES] = np.frombuffer(data, dtype=np.uint8).reshape(-1, _BYTES)
    return out.view("<u8").ravel()


def _cuts(values: np.ndarray) -> np.ndarray:
    """Edges of the runs of equal values."""
    return np.concatenate(([0], np.flatnonzero(np.diff(values)) + 1, [len(values)])) if len(values) else np.zeros(1, np.int64)


def _local(docs: np.ndarray, ids: np.ndarray) -> tuple[bytes, bytes]:
    """Rows as numbers among the rows of a tile, and the ids of these."""
    here, local = np.unique(docs, return_inverse=True)
    return local.astype("<u2" if len(here) <= 1 << 16 else "<u4").tobytes(), ids[here].astype("<i8").tobytes()


def _is_frequent(marks: np.ndarray) -> np.ndarray:
    return (marks >= FREQUENT) & (marks < OTHER)


def _tiles(frequent, blocks: int, order: int):
    """Places of words that are not frequent, with their neighbours, in tiles by the word's hash."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value[0]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, n_rows, words, docs in _words(batch.column(1)):
                at = _places(words, hot)
                mark = np.where(at >= 0, FREQUENT + at, 0).astype(np.uint64)
                space = np.uint64((1 << (8 * _BYTES)) - OTHER)
                mark = np.where(at >= 0, mark, mix(words) % space + np.uint64(OTHER))
                same = docs[1:] == docs[:-1]
                before, after = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
                before[1:][same] = mark[:-1][same]
                after[:-1][same] = mark[1:][same]
                # the word on the other side of a frequent neighbour
                far_before, far_after = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
                far_before[1:][same] = before[:-1][same]
                far_after[:-1][same] = after[1:][same]
                own = np.flatnonzero(at < 0)
                block = ((words[own] >> np.uint64(20)) % np.uint64(blocks)).astype(np.int64)
                by = np.lexsort((words[own], block))
                block, own = block[by], own[by]
                words, docs, before, after = words[own], docs[own], before[own], after[own]
                far_before, far_after = far_before[own], far_after[own]
                cuts = _cuts(block)
                out = []
                for a, b in zip(cuts, cuts[1:]):
                    edge = _cuts(words[a:b])
                    far = (b"", b"")
                    if order > 2:
                        far = (_pack(far_before[a:b][_is_frequent(before[a:b])]), _pack(far_after[a:b][_is_frequent(after[a:b])]))
                    out.append(
                        (
                            int(block[a]), words[a:b][edge[:-1]].tobytes(), np.diff(edge).astype("<u4").tobytes(),
                            _pack(before[a:b]), _pack(after[a:b]), *far, *_local(docs[a:b], ids[row : row + n_rows]),
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[k] for r in out], pa.binary()) for k in range(1, 9))],
                    names=["block", "words", "runs", "before", "after", "before_hot", "after_hot", "doc", "docs"],
                )

    return run


def _triple_tiles(frequent, often, blocks: int):
    """Places of triples of frequent words that are not broadcast, in tiles by the triple's hash."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, n_rows, words, docs in _words(batch.column(1)):
                place, triple = _triples(words, docs, frequent.value[0])
                own = ~_known(triple, often.value[0])
                docs, triple = docs[place[own]], triple[own]
                block = (mix(triple.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
                by = np.lexsort((triple, block))
                docs, triple, block = docs[by], triple[by], block[by]
                cuts = _cuts(block)
                out = []
                for a, b in zip(cuts, cuts[1:]):
                    edge = _cuts(triple[a:b])
                    out.append(
                        (
                            int(block[a]), triple[a:b][edge[:-1]].astype("<i8").tobytes(), np.diff(edge).astype("<u4").tobytes(),
                            *_local(docs[a:b], ids[row : row + n_rows]),
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[k] for r in out], pa.binary()) for k in range(1, 5))],
                    names=["block", "words", "runs", "doc", "docs"],
                )

    return run


def _counts(keys: np.ndarray, fold: np.ndarray, folds: int) -> np.ndarray:
    """How often each key occurs in the other folds (in all, if there is one fold), at each place."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    if folds == 1:
        return counts[inverse]
    own = inverse * folds + fold
    return counts[inverse] - np.bincount(own, minlength=len(counts) * folds)[own]


_SUMS = "bucket long, docs binary, sums binary"


def _packed_sums(docs: np.ndarray, sums: np.ndarray, buckets: int) -> pa.Table:
    """Sums per document, a row per bucket of documents."""
    ids, inverse = np.unique(docs, return_inverse=True)
    sums = np.bincount(inverse, weights=sums)
    bucket = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    bucket, ids, sums = bucket[by], ids[by], sums[by]
    cuts = _cuts(bucket)
    return pa.table(
        {
            "bucket": pa.array(bucket[cuts[:-1]], pa.int64()),
            "docs": pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            "sums": pa.array([sums[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        }
    )


def _logs(counts: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(counts, 1).astype(np.float64))


def _frequent_pair(first, second, fold, log_counts, pairs, total, backoff: float, least: int) -> np.ndarray:
    """Score of a frequent word after a frequent word, both by number."""
    n = _found(first * log_counts.shape[1] + second, pairs, fold)
    return np.where(n >= least, _logs(n) - log_counts[fold, first], log_counts[fold, second] + np.log(backoff) - _logs(total)[fold])


def _score(frequent, pairs, total: np.ndarray, backoff: float, least: int, buckets: int, order: int):
    """Sums per document of what a block knows about its places, packed by buckets of documents."""

    def run(tiles: pa.Table) -> pa.Table:
        hot_counts = _logs(frequent.value[1])
        held, far = [], []
        for t in tiles.to_pylist():
            words = np.repeat(np.frombuffer(t["words"], np.uint64), np.frombuffer(t["runs"], "<u4"))
            docs = np.frombuffer(t["docs"], "<i8")[np.frombuffer(t["doc"], f"<u{len(t['doc']) // len(words)}")]
            held.append((words, docs, _unpack(t["before"]), _unpack(t["after"])))
            far.append((_unpack(t["before_hot"]), _unpack(t["after_hot"])))
        words, docs, before, after = (np.concatenate(x) for x in zip(*held))
        far_before, far_after = (np.concatenate(x) for x in zip(*far))
        del held, far
        docs = docs.astype(np.int64)
        folds = len(total)
        fold = fold_of(docs, folds)
        count = lambda keys, k=slice(None): _counts(keys, fold[k], folds)
        lower, whole = np.log(backoff), _logs(total)[fold]
        own = _logs(count(words))
        salt = mix(words)
        pair_before, pair_after = mix(before ^ salt), mix(after ^ salt) + np.uint64(1)
        n_before, n_after = count(pair_before), count(pair_after)
        hot_before, hot_after = _is_frequent(before), _is_frequent(after)
        number = lambda marks: (marks - np.uint64(FREQUENT)).astype(np.int64)
        # the word itself, if nothing comes before it, or only its count is missing where the word before is
        sums = np.where((before == NONE) | (n_before < least), own - whole, 0.0)
        # after a frequent word, which has no block
        k = np.flatnonzero(hot_before)
        seen = n_before[k] >= least
        term = np.where(seen, _logs(n_before[k]) - hot_counts[fold[k], number(before[k])], own[k] + lower - whole[k])
        if order > 2 and len(k):
            further = far_before != NONE
            n = count(mix(far_before ^ pair_before[k]), k)
            term = np.where(further, np.where(n >= least, _logs(n), lower + term), term)
            known = np.flatnonzero(_is_frequent(far_before) & (n >= least))
            pair = number(far_before[known]) * len(frequent.value[0]) + number(before[k[known]])
            term[known] -= _logs(_found(pair, pairs.value, fold[k[known]]))
        sums[k] = term
        # the next word
        k = np.flatnonzero(after != NONE)
        rare = np.full(len(k), lower)
        hot = k[hot_after[k]]
        rare[hot_after[k]] += hot_counts[fold[hot], number(after[hot])] - whole[hot]
        term = np.where(n_after[k] >= least, _logs(n_after[k]) - own[k], rare)
        if order > 2:
            n = count(mix(before[k] ^ pair_after[k]), k)
            term = np.where(before[k] == NONE, term, np.where(n >= least, _logs(n) - _logs(n_before[k]), lower + term))
        sums[k] += term
        # the word after a frequent next word: all of it if it is frequent, else what its block does not know
        k = np.flatnonzero(hot_after)
        if order > 2 and len(k):
            n = count(mix(far_after ^ pair_after[k]), k)
            sums[k] -= np.where((far_after != NONE) & (n >= least), _logs(n_after[k]), 0.0)
            both = np.flatnonzero(_is_frequent(far_after))
            here = k[both]
            pair = _frequent_pair(number(after[here]), number(far_after[both]), fold[here], hot_counts, pairs.value, total, backoff, least)
            sums[here] += np.where(n[both] >= least, _logs(n[both]), lower + pair)
        return _packed_sums(docs, sums, buckets)

    return run


def _score_triples(frequent, pairs, total: np.ndarray, backoff: float, least: int, buckets: int):
    """Sums per document of the triples of frequent words of a block."""

    def run(tiles: pa.Table) -> pa.Table:
        held = []
        for t in tiles.to_pylist():
            triple = np.repeat(np.frombuffer(t["words"], "<i8"), np.frombuffer(t["runs"], "<u4"))
            held.append((triple, np.frombuffer(t["docs"], "<i8")[np.frombuffer(t["doc"], f"<u{len(t['doc']) // len(triple)}")]))
        triple, docs = (np.concatenate(x) for x in zip(*held))
        docs = docs.astype(np.int64)
        fold = fold_of(docs, len(total))
        terms = _triple_terms(triple, _counts(triple, fold, len(total)), fold, frequent, pairs, total, backoff, least)
        return _packed_sums(docs, terms, buckets)

    return run


def _triple_terms(triple, n, fold, frequent, pairs, total: np.ndarray, backoff: float, least: int) -> np.ndarray:
    """Scores of the last words of triples of frequent words, seen ``n`` times."""
    size = len(frequent.value[0])
    log_counts = _logs(frequent.value[1])
    lower = _frequent_pair(triple // size % size, triple % size, fold, log_counts, pairs.value, total, backoff, least)
    return np.where(n >= least, _logs(n) - _logs(_found(triple // size, pairs.value, fold)), np.log(backoff) + lower)


def _add_up(parts: pa.Table) -> pa.Table:
    """Sums per document of one bucket over all blocks."""
    docs = np.frombuffer(b"".join(parts.column("docs").to_pylist()), "<i8")
    sums = np.frombuffer(b"".join(parts.column("sums").to_pylist()), "<f8")
    ids, inverse = np.unique(docs, return_inverse=True)
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "part": pa.array(np.bincount(inverse, weights=sums, minlength=len(ids)))})


def _direct(frequent, pairs, often, total: np.ndarray, backoff: float, least: int, order: int):
    """Per row: words, and the terms of frequent words at a start or after a frequent word (order 3: that is
    first, or in a triple that is broadcast)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, counts = frequent.value
        log_counts, whole = _logs(counts), _logs(total)
        for batch in batches:
            sums, sizes = [], []
            folds = fold_of(batch.column(0).to_numpy(zero_copy_only=False), len(total))
            for row, n_rows, words, docs in _words(batch.column(1)):
                at = _places(words, hot)
                fold = folds[row : row + n_rows][docs]
                first = np.ones(len(words), dtype=bool)
                first[1:] = docs[1:] != docs[:-1]
                score = np.zeros(len(words))
                lone = first & (at >= 0)
                score[lone] = log_counts[fold[lone], at[lone]] - whole[fold[lone]]
                both = np.zeros(len(words), dtype=bool)
                both[1:] = ~first[1:] & (at[1:] >= 0) & (at[:-1] >= 0)
                if order > 2:
                    both[1:] &= first[:-1]
                    place, triple = _triples(words, docs, hot)
                    own = _known(triple, often.value[0])
                    place, triple = place[own], triple[own]
                    if len(place):
                        n = _found(triple, often.value, fold[place])
                        score[place] = _triple_terms(triple, n, fold[place], frequent, pairs, total, backoff, least)
                later = np.flatnonzero(both)
                if len(later):
                    score[later] = _frequent_pair(at[later - 1], at[later], fold[later], log_counts, pairs.value, total, backoff, least)
                sums.append(np.bincount(docs, weights=score, minlength=n_rows))
                sizes.append(np.bincount(docs, minlength=n_rows))
            none = np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate([none, *sums])),
                    pa.array(np.concatenate([none, *sizes]).astype(np.int64)),
                ],
                names=["doc_id", "part", "n_words"],
            )

    return run


def backoff_scores(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    backoff: float = 0.4,
    least: int = 2,
    most_frequent: int = 512,
    block_rows: int = 1_000_000,
    order: int = 2,
    folds: int = 1,
) -> DataFrame:
    """Per doc_id: n_words, log_prob (natural logarithm, summed over the words) and perplexity.

    Words are cut at white space, with A-Z lower-cased. Null, empty and blank texts have no words, a
    log_prob of 0 and no perplexity. Rows that share a doc_id are scored as texts of their own and summed;
    doc_id must be an integer, and rows without one count for the model but get no score. Other columns
    are ignored, whatever their names. ``most_frequent`` words are broadcast with their exact counts, and so are
    the counts of pairs among them: never more than that number and its square. Of triples among them, those that would
    fill a good part of a block are broadcast, at most 16 a block and never more than there can be pairs. Words are told apart
    by 64 bits, neighbours of one word by 40. ``order`` is 2 (pairs) or 3 (triples). With several ``folds``, a document
    is scored by the counts of all folds but its own (rows without an id are in one fold): ``least=1`` backs off too then.
    """
    if order not in (2, 3):
        raise ValueError(f"order must be 2 or 3, not {order}")
    context = docs.sparkSession.sparkContext
    # rows without an id still count: their places are dealt out under an id that is dropped again
    nobody = -(1 << 63)
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = frame.select(F.coalesce("doc_id", F.lit(nobody)).alias("doc_id"), "text")
    table = materialise(_summed(named, "word", folds, lambda words, docs: (words, docs)))
    sums = table.agg(*[F.coalesce(F.sum(f"n{f}"), F.lit(0)).alias(f"n{f}") for f in range(folds)]).toPandas()
    every, total = int(sums.to_numpy().sum()), _elsewhere(sums, folds)[:, 0]
    top = table.orderBy(F.desc("n"), "word").limit(most_frequent).where("n >= 64").toPandas()
    top = top.iloc[np.argsort(top["word"].to_numpy(np.int64).view(np.uint64))]
    rest = every - int(top["n"].sum())
    frequent = context.broadcast((top["word"].to_numpy(np.int64).view(np.uint64), _elsewhere(top, folds)))
    pairs = _summed(named, "pair", folds, _pairs_of(frequent)).orderBy("pair").toPandas()
    pair_keys, pair_counts = pairs["pair"].to_numpy(np.int64), pairs["n"].to_numpy(np.int64)
    pairs = context.broadcast((pair_keys, _elsewhere(pairs, folds)))

    blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rest // block_rows + 1)
    keyed = frame.where("doc_id is not null")
    tiles = named.mapInArrow(_tiles(frequent, blocks, order), _TILE)
    # a document has a sum in every block that holds one of its words: packed, they are a row per block
    # and bucket, and a bucket has about as many sums as a block has places
    parts = tiles.groupBy("block").applyInArrow(_score(frequent, pairs, total, backoff, least, blocks, order), _SUMS)
    often = context.broadcast((np.zeros(0, np.int64), np.zeros((folds, 0), np.int64)))
    if order > 2:
        # as many as there are pairs at most: beyond that, triples go to blocks whatever their number
        bound = max(64, every // (16 * blocks), every // most_frequent**2 if most_frequent else 0)
        often_pairs = context.broadcast(pair_keys[pair_counts >= bound])
        triples = _summed(named, "triple", folds, _triples_of(frequent, often_pairs)).where(F.col("n") >= bound)
        triples = triples.orderBy("triple").toPandas()
        often = context.broadcast((triples["triple"].to_numpy(np.int64), _elsewhere(triples, folds)))
        tiles = named.mapInArrow(_triple_tiles(frequent, often, blocks), _TRIPLES)
        scored = tiles.groupBy("block").applyInArrow(_score_triples(frequent, pairs, total, backoff, least, blocks), _SUMS)
        parts = parts.unionByName(scored)
    parts = parts.groupBy("bucket").applyInArrow(_add_up, "doc_id long, part double")
    direct = keyed.mapInArrow(
        _direct(frequent, pairs, often, total, backoff, least, order), "doc_id long, part double, n_words long"
    )
    every = direct.unionByName(parts.where(F.col("doc_id") != nobody).withColumn("n_words", F.lit(0).cast("long")))
    summed = every.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.round(F.sum("part"), 6).alias("log_prob"))
    return summed.withColumn(
        "perplexity", F.when(F.col("n_words") > 0, F.round(F.exp(-F.col("log_prob") / F.col("n_words")), 4))
    )
