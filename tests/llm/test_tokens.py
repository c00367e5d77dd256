"""Token files, packing, WARC records: round trips and plain versions."""

import itertools
import random
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import packing, separators, simple8b, token_files, tokens, warc

TEXTS = [
    "Hello world", "a  b", " \n x  y ", "foo\n \nbar", "x \n", "", None, "I'm it's  'll", "\t tab \t x", "\x1c \x1d a", "\xa0 \xa0 b",
    " ", "  ", "a \nb\n c", "naïve café ÀÉ 日本語 テスト 🙂", "word " * 500, "1234567 " * 3, "é a  b", "<|endoftext|> x",
]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(tokens.vocabulary())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab\n\t '\xa0\x1c1é.", max_size=25), max_size=6))
def test_encoder_equals_the_library(texts):
    coder = tokens.encoder(tokens.vocabulary())
    ids, ends = coder.column(pa.array(texts, pa.large_string()))
    model = Tokenizer.from_file(tokens.vocabulary()) if not hasattr(test_encoder_equals_the_library, "m") else test_encoder_equals_the_library.m
    test_encoder_equals_the_library.m = model
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == model.encode(text, add_special_tokens=False).ids


def test_encoder_forgets_without_harm(model):
    coder = tokens.Encoder(tokens.vocabulary(), most=3)
    for _ in range(3):
        ids, ends = coder.column(pa.array([t or "" for t in TEXTS], pa.large_string()))
        for k, text in enumerate(TEXTS):
            assert ids[ends[k] : ends[k + 1]].tolist() == model.encode(text or "", add_special_tokens=False).ids


def test_signs_behind_letters_cost_no_new_words(model, monkeypatch):
    coder = tokens.Encoder(tokens.vocabulary())
    stems = ["the", "edthly", "Geer\u00e9", "\u00d6heitsch\u00df", "I", "x" * 300]
    ends = ["", ".", ",", "'", "...", "$$$", "<|", "'.\nNext", "\ns", ".\n\u00dcber,", "!\nedthly?!"]
    odd = ["don't", "a1.", "a.b", "a.\n\nb", "a \nb", "a.\n", "\nb", "<|endoftext|>", "a<|endoftext|>", "e\u0301.", "\u65e5.", "a_b", "a\n'b"]
    plain = [stem + end for stem in stems for end in ends]
    seen, encode = [], coder._ids
    monkeypatch.setattr(coder, "_ids", lambda text: seen.append(text) or encode(text))
    for words in (plain, odd, plain + odd):
        text = "x " + " ".join(words)
        ids, _ = coder.column(pa.array([text], pa.large_string()))
        assert ids.tolist() == model.encode(text, add_special_tokens=False).ids
        # letters go to the model as they are; what is encoded as text are signs, each kind once, and the texts' first words
        assert words is not plain or not any(stem in text for text in seen for stem in stems[1:4])
    assert len(seen) == len(set(seen)) + 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_256), st.integers(0, 2**64 - 1)), max_size=400))
def test_simple8b_round_trip(values):
    values = np.array(values, dtype=np.uint64)
    words, places, escaped = simple8b.encode(values)
    assert (simple8b.decode(words, places, escaped)[: len(values)] == values).all()
    assert len(places) == int((values > simple8b.LARGEST).sum())


def test_simple8b_packs():
    words, _, _ = simple8b.encode(np.zeros(240, dtype=np.uint64))
    assert len(words) == 1 and simple8b.offsets(simple8b.encode(np.arange(1000, dtype=np.uint64))[0], 64)[0] == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.booleans(), max_size=60), st.integers(1, 30))
def test_simple8b_places_in_a_row(holds, count):
    found = simple8b._runs(np.array(holds, dtype=bool), count)
    assert found.tolist() == [all(holds[k : k + count]) for k in range(len(holds) - count + 1)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_256), st.integers(0, 2**60 - 1)), max_size=400))
def test_simple8b_takes_the_narrowest_word_that_holds(values):
    words, _, _ = simple8b.encode(np.array(values, dtype=np.uint64))
    at, selectors = 0, []
    while at < len(values):
        selectors.append(next(
            k for k, (count, bits) in enumerate(simple8b.SELECTORS)
            if at + count <= len(values) and all(v < 1 << bits for v in values[at : at + count])
        ))
        at += simple8b.SELECTORS[selectors[-1]][0]
    assert (words >> np.uint64(60)).tolist() == selectors


def test_token_files(spark, docs, model, tmp_path):
    rows = [(3 * k - 5, t) for k, t in enumerate(TEXTS)] + [(1, "again"), (None, "no id")]
    folder = str(tmp_path / "ids")
    token_files.write_tokens(docs(*rows), folder, block_ids=50, file_blocks=2)
    got = token_files.read_tokens(spark, folder).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for row, (key, text) in zip(got, order, strict=True):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.doc_id, row.start, row.n_tokens) == (key, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    files = [p.name for p in (tmp_path / "ids").iterdir() if p.name.startswith("part")]
    assert len(files) > 3


def test_no_token_files(spark, docs, tmp_path):
    folder = str(tmp_path / "none")
    token_files.write_tokens(docs((1, "x")).where("doc_id = 2"), folder)
    assert token_files.read_tokens(spark, folder).collect() == []


@pytest.mark.parametrize("block_bytes", [2, 6, 50, 1 << 20])
def test_separators(spark, docs, model, tmp_path, block_bytes):
    separators.write_flat(docs(*enumerate(TEXTS)).coalesce(1).orderBy("doc_id"), str(tmp_path / "flat"))
    (tmp_path / "flat" / "part-tail").write_bytes(np.array([0, 0, 5, 6, 0, 7], dtype="<u2").tobytes())
    (tmp_path / "flat" / "part-void").write_bytes(b"")
    got = separators.count_tokens(spark, str(tmp_path / "flat"), block_bytes=block_bytes).collect()
    # special tokens are ordinary text to the library that writes these files
    want = sorted(len(model.encode(t or "", add_special_tokens=False).ids) for t in TEXTS if not (t or "").startswith("<|"))
    flat = [r for r in got if r.file != "part-tail"]
    assert len(flat) == len(TEXTS) and all(r.ended for r in flat)
    sizes = sorted(r.n_tokens for r in flat)
    assert all(sizes.count(n) >= want.count(n) for n in want)
    for file in {r.file for r in flat}:
        rows = sorted((r.doc_no, r.start, r.n_tokens) for r in flat if r.file == file)
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert all(b[1] == a[1] + a[2] + 1 for a, b in zip(rows, rows[1:]))
    tail = sorted((r.doc_no, r.start, r.n_tokens, r.ended) for r in got if r.file == "part-tail")
    assert tail == [(0, 0, 0, True), (1, 1, 0, True), (2, 2, 2, True), (3, 5, 1, False)]


def test_a_torn_file_is_refused(spark, tmp_path):
    (tmp_path / "part-0").write_bytes(b"abc")
    with pytest.raises(Exception, match="ends within an id"):
        separators.count_tokens(spark, str(tmp_path)).collect()


def test_bucket_bounds_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(150):
        lengths = np.unique(rng.integers(1, 40, rng.integers(1, 8)))
        counts, buckets = rng.integers(1, 9, len(lengths)), int(rng.integers(1, 5))
        bounds = packing.bucket_bounds(lengths, counts, buckets)
        cost = lambda bs: sum(c * (min(x for x in bs if x >= n) - n) for n, c in zip(lengths, counts))
        every = (set(s) | {lengths[-1]} for k in range(buckets) for s in itertools.combinations(lengths, k))
        assert len(bounds) <= buckets and cost(bounds) == min(map(cost, every))
    assert packing.bucket_bounds(np.zeros(0, np.int64), np.zeros(0, np.int64), 4) == []


def test_packing(spark, docs, model):
    rng = random.Random(3)
    rows = [(k, "word " * rng.randint(0, 90)) for k in range(200)] + [(9, "twice"), (9, "twice"), (None, "no id"), (500, None)]
    got = packing.pack_documents(docs(*rows), longest=32, buckets=4, budget=128, block_rows=20).collect()
    lengths = sorted(len(model.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.n_tokens for r in got) == sum(lengths) and sum(-(-n // 32) for n in lengths) == len(got)
    batches = {}
    for r in got:
        assert r.padding == r.bucket - r.n_tokens >= 0 and r.token_from == 32 * r.piece
        batches.setdefault(r.batch_id, []).append(r)
    for rows in batches.values():
        assert len({r.bucket for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(len(rows)))
        assert sum(r.bucket for r in rows) <= 128
    assert sorted(batches) == list(range(len(batches))) and len({r.bucket for r in got}) <= 4
    # only the last batch of a bucket may have room left
    assert sum((len(b) + 1) * b[0].bucket <= 128 for b in batches.values()) <= 4
    assert packing.pack_documents(docs((1, "x")).where("doc_id = 2")).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(docs((1, "x")), longest=64, budget=32)


class Plain(HTMLParser):
    """Words of a page as the standard library's parser finds them."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_plain_text(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        parser = Plain()
        parser.feed(row.html)
        assert "".join(warc.plain_text(row.html).split()) == "".join(parser.words), row.page_id


def test_derivatives(spark, tmp_path):
    page = '<html lang=fr><head><title>A &amp; b</title></head><body><p>x<!-- no --><a href="/q?a&amp;b">l</a><a href=>e</a></p>é &lt;</body>'
    pages = spark.createDataFrame([(1, "http://h/", page), (1, "http://h/", page), (2, None, None), (3, "u", ""), (None, "v", "a < b")], "page_id bigint, url string, html string")
    responses = warc.responses_of(pages)
    warc.write_records(responses, str(tmp_path / "warc"), file_records=2)
    back = warc.read_records(spark, str(tmp_path / "warc"))
    assert sorted(bytes(r.record) for r in back.collect()) == sorted(bytes(r.record) for r in responses.collect())
    for record in ([b"junk"], [b""], [None], [b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nx"],
                   [b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 0\r\n\r\n"]):
        bad = warc.derivatives(spark.createDataFrame([record], "record binary")).collect()
        assert [r.record_type for r in bad] == ["rejected"] and bad[0].reason
    got = warc.derivatives(back.withColumn("record_type", F.lit("clash")), keep=("path",)).collect()
    assert len(got) == 10 and {r.record_type for r in got} == {"metadata", "conversion"}
    ids = {dict(warc.split(bytes(r.record))[0])["WARC-Record-ID"] for r in responses.collect()}
    assert {r.refers_to for r in got} == ids and all(r.source_digest_ok for r in got)
    for r in got:
        headers, block = warc.split(bytes(r.record))
        headers = dict(headers)
        assert headers["WARC-Refers-To"] == r.refers_to and headers["WARC-Type"] == r.record_type
        assert headers["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        assert len(block) == r.content_length and headers["WARC-Target-URI"] == r.target_uri
    one = [r for r in got if r.target_uri == "http://h/"]
    assert len(one) == 4 and len({r.record_id for r in one}) == 2
    conversion = next(r for r in one if r.record_type == "conversion")
    assert warc.split(bytes(conversion.record))[1].decode() == "xle\né <"
    about = warc.split(bytes(next(r for r in one if r.record_type == "metadata").record))[1].decode()
    for line in ("title: A & b", "language: fr", "outlink: /q?a&b", "http-status: 200", f"conversion: {conversion.record_id}"):
        assert line in about.split("\r\n")


def test_wrong_digests_and_other_charsets(spark):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9</p>"
    record = warc.make([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x:1>"), ("WARC-Payload-Digest", "sha1:WRONG"), ("WARC-Date", "2020")], block)
    got = warc.derivatives(spark.createDataFrame([(record,)], "record binary")).collect()
    assert [r.source_digest_ok for r in got] == [False, False] and {r.source_digest for r in got} == {"sha1:WRONG"}
    assert warc.split(bytes(got[1].record))[1].decode() == "café" and got[1].warc_date == "2020"
