"""Token ids of whole columns of texts with a public tokenizer."""

import base64
import json
import os
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: A space with white space before it and white space or the text's end behind it: such texts are cut elsewhere.
_BLANK = r"[\s\v\x{85}\x{1c}-\x{1f}\p{Z}]"
_WIDE = rf"{_BLANK} (?:{_BLANK}|$)"
_SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters, signs behind them, and the same again on the next line: the public pattern cuts between these parts.
_LETTERS, _SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-/:-@\[-`{-~"
_PARTS = re.compile(rf"([{_LETTERS}]+)([{_SIGNS}]*)(?:\n([{_LETTERS}]+)([{_SIGNS}]*))?")
_OPEN: dict[str, "Encoder"] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts by a vocabulary file of the tokenizers (.json) or tiktoken (.tiktoken) library.

    A byte-level BPE of this kind never merges across the space that begins a word, so a text's ids
    are those of its words put together. Words met before come from a cache of two generations of
    ``most`` words each. Others that are letters with signs behind them are put together from the ids
    of these parts, where the file's pattern cuts there; the rest is encoded as one text and told
    apart by the bytes that each id stands for.
    """

    def __init__(self, path: str, most: int = 200_000):
        self.most, self.known, self.older, self._model, self._signs = most, {}, {}, None, {}
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._ids, widths = model.encode_ordinary, {k: len(b) for b, k in ranks.items()}
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer, pre_tokenizers

            model = Tokenizer.from_file(path)
            special = {t.content for t in model.get_added_tokens_decoder().values()}
            # one letter stands for one byte, but for special tokens
            widths = {k: len(t.encode()) if t in special else len(t) for t, k in model.get_vocab().items()}
            self._ids = lambda text: model.encode_batch_fast([text], add_special_tokens=False)[0].ids
            cut = json.loads(model.pre_tokenizer.__getstate__()) if model.pre_tokenizer else {}
            public = cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
            if public and model.normalizer is None and all(re.search(rf"[^{_LETTERS}]", t) for t in special):
                plain = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
                letters = re.findall(rf"[ {_LETTERS}]", "".join(map(chr, range(0x250))))
                self._bytes = str.maketrans({c: plain.pre_tokenize_str(c)[0][0] for c in letters})
                self._model, self._space = model.model, self._bytes[ord(" ")]
        self.widths = np.zeros(max(widths, default=0) + 1, dtype=np.int64)
        for k, width in widths.items():
            self.widths[k] = width

    def one(self, text: str) -> bytes:
        return np.array(self._ids(text), dtype="<u4").tobytes()

    def _run(self, letters: str) -> bytes:
        """Ids of letters that the pattern does not cut, with a space before them or none."""
        mapped = letters.replace(" ", self._space) if letters.isascii() else letters.translate(self._bytes)
        return array("I", [t.id for t in self._model.tokenize(mapped)]).tobytes()

    def _tail(self, signs: str) -> bytes:
        ids = self._signs.get(signs)
        if ids is None:
            if len(self._signs) >= 10_000:
                self._signs.clear()
            ids = self._signs[signs] = self.one(signs)
        return ids

    def _from_parts(self, words: list[str], missing: list[int], found: list[bytes | None]) -> list[int]:
        """Fills in the words that are made of letters and signs and gives the places of the others.

        Letters with a space before them are kept as the word they are, without one as bytes.
        """
        known, older, left = self.known, self.older, []
        for k in missing:
            word = words[k]
            ids = older.get(word)
            if ids is None and word.isascii() and word.isalpha():
                ids = self._run(" " + word)
            if ids is not None:
                found[k] = known[word] = ids
                continue
            parts = _PARTS.fullmatch(word)
            if parts is None:
                left.append(k)
                continue
            stem, signs, head, more = parts.groups()
            ids = known.get(stem)
            if ids is None:
                ids = older.get(stem)
                known[stem] = ids = self._run(" " + stem) if ids is None else ids
            if signs:
                ids += self._tail(signs)
            if head:
                key = head.encode()
                next_ids = known.get(key)
                if next_ids is None:
                    next_ids = older.get(key)
                    known[key] = next_ids = self._run(head) if next_ids is None else next_ids
                ids += self._tail("\n") + next_ids
                if more:
                    ids += self._tail(more)
            found[k] = ids
        return left

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it, as bytes of unsigned 32-bit integers."""
        found = list(map(self.known.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if self._model is not None:
            missing = self._from_parts(words, missing, found)
        if self.older:
            before = map(self.older.get, [words[k] for k in missing])
            again = [(k, ids) for k, ids in zip(missing, before) if ids is not None]
            for k, ids in again:
                found[k] = self.known[words[k]] = ids
            missing = [k for k in missing if found[k] is None]
        # white space inside a word does not matter, at its ends it does
        plain = [k for k in missing if words[k] and words[k] == words[k].strip()]
        for at in range(0, len(plain), 50_000):
            part = plain[at : at + 50_000]
            new = [words[k] for k in part]
            ids = np.array(self._ids(" " + " ".join(new)), dtype="<u4")
            ends = np.cumsum(pc.binary_length(pa.array(new, pa.large_string())).to_numpy() + 1)
            cuts = np.searchsorted(np.cumsum(self.widths[ids]), ends, "left") + 1
            raw, low = ids.tobytes(), 0
            for k, word, high in zip(part, new, (4 * cuts).tolist()):
                found[k] = self.known[word] = raw[low:high]
                low = high
        for k in missing:
            if found[k] is None:
                found[k] = self.known[words[k]] = self.one(" " + words[k])
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        return found

    def _parts(self, texts: pa.LargeStringArray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(ids of distinct parts, number of the part at each place, first place of each text and behind the last)."""
        n = len(texts)
        wide = np.flatnonzero(pc.match_substring_regex(texts, _WIDE).to_numpy(zero_copy_only=False))
        own = {int(k): texts[int(k)].as_py() for k in wide}
        if own:  # rare: cut between single spaces only
            mask = np.zeros(n, dtype=bool)
            mask[wide] = True
            texts = pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), texts)
        cut = pc.split_pattern(texts, " ")
        begin = np.asarray(cut.offsets)[: n + 1].astype(np.int64)
        coded = pc.dictionary_encode(cut.flatten())
        first = cut.flatten().take(pa.array(begin[:-1])).to_numpy(zero_copy_only=False).tolist()
        for k, text in own.items():
            parts = _SINGLE.split(text)
            first[k] = b"".join([self.one(parts[0]), *self.words(parts[1:])])
        table = self.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        alone: dict[str, bytes] = {}
        for f in first:
            if isinstance(f, bytes):
                table.append(f)
            else:
                ids = alone.get(f)
                if ids is None:
                    ids = alone[f] = self.one(f) if f else b""
                table.append(ids)
        word = coded.indices.to_numpy().astype(np.int64)
        word[begin[:-1] - begin[0]] = len(coded.dictionary) + np.arange(n)
        return table, word, begin - begin[0]

    def column(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids); texts without nulls."""
        table, word, begin = self._parts(texts)
        lengths = np.fromiter(map(len, table), dtype=np.int64, count=len(table)) // 4
        starts = np.cumsum(lengths) - lengths
        pool = np.frombuffer(b"".join(table), dtype="<u4")
        count = lengths[word]
        ends = np.cumsum(count)
        ids = pool[np.repeat(starts[word] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate(([0], ends))[begin]

    def counts(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Number of ids of each text, without putting the ids together; texts without nulls."""
        table, word, begin = self._parts(texts)
        lengths = np.fromiter(map(len, table), dtype=np.int64, count=len(table)) // 4
        return np.diff(np.concatenate(([0], np.cumsum(lengths[word])))[begin])


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


def _some(texts: pa.Array, limit: int):
    """(first row, texts) of consecutive rows of some megabytes; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(texts):
        before = int(ends[row - 1]) if row else 0
        last = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield row, texts.slice(row, last - row)
        row = last


def encoded(texts: pa.Array, path: str, limit: int = 4 << 20):
    """(first row, ids, offsets) of consecutive rows of some megabytes; null counts as empty."""
    for row, part in _some(texts, limit):
        yield row, *encoder(path).column(part)


def counted(texts: pa.Array, path: str, limit: int = 4 << 20) -> np.ndarray:
    """Number of ids of each text; null counts as empty."""
    return np.concatenate([np.zeros(0, np.int64), *(encoder(path).counts(part) for _, part in _some(texts, limit))])
