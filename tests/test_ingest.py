"""Event lines, transactions, JSON rows."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from tallyloom.sources.json_rows import from_json_rows, to_json_rows
from tallyloom.sources.lines import (
    accepted, indicators_from_lines, parse_lines, read_lines, rejected,
)
from tallyloom.sources.transactions import parse_transactions

SAMPLE = (
    "loom_Room,shift=early,loom_no=42,hall=north-2,cloth=7f3a ends_broken=1,rpm=412.5,picks=90210,warp_tension=3.25,"
    'weft_left="18",stops="0",humidity=61.0,lint=0.004,width_cm=160,beam=12,oil=0.75,defects=2 1700000000123000007'
)


def parse(spark, *lines):
    frame = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    return {row.n: row for row in parse_lines(frame).collect()}


def test_sample_line(spark):
    row = parse(spark, SAMPLE)[0]
    assert row.error is None
    assert (row.table_name, row.event_ms, len(row.fields)) == ("loom_Room", 1700000000123, 16)
    assert row.fields["stops"] == '"0"'
    assert row.fields["hall"] == "north-2"


@pytest.mark.parametrize(
    "line, expected",
    [
        ("m,t=1 a= 1000000", None),
        ("m,t=1 a=b=c 1000000", None),
        ("m,t=1 = 1000000", None),
        ("m,t=1  1000000", None),
        ("m,t=1 a=b= 1000000", {"t": "1", "a": "b"}),
        ("m,t=1 =b 1000000", {"t": "1", "": "b"}),
        ('m,t=1 f="x y" 1000000', {"t": "1", "f": '"x y"'}),
        ('m,t=1 f="x,y" 1000000', None),
        ("m,a=1 a=2 1000000", {"a": "2"}),
        ("m,a=1,a=3,b=1 a=2,b=4,a=5 1000000", {"a": "5", "b": "4"}),
        ("m f=1 abc", None),
        ("m f=1 1.5", None),
        ("m f=1 +1000000", {"f": "1"}),
        ("m f=1", None),
        ("m f=1 1000000 7", None),
        (",, f=1 1000000", None),
        ("m,t=1 ,,, 1000000", {"t": "1"}),
        ("m ,,, 1000000", {}),
        ("m,t=1,, f=1,, 1000000", {"t": "1", "f": "1"}),
        ("m,,t=1 f=1 1000000", None),
        (" \t m,t=1 f=1 1000000 \x01", {"t": "1", "f": "1"}),
        # an odd number of quotes pairs up from the right: the blank inside the name is kept
        ('a b",t=1 f=1 1000000', {"t": "1", "f": "1"}),
        ('m,t=1 f="1 1000000', None),
        ("", None),
        (None, None),
    ],
)
def test_line_edges(spark, line, expected):
    row = parse(spark, line)[0]
    assert (row.error is None) == (expected is not None), row
    assert row.fields == expected


def test_random_lines_against_a_plain_parser(spark):
    """Random short lines over the special characters, against splitting by hand."""
    rng = random.Random(3)
    lines = ["".join(rng.choices('ab=, "1', k=rng.randint(1, 14))) + rng.choice(["", " 1000000"]) for _ in range(3000)]
    lines += [f"m,{''.join(rng.choices('ab=,', k=5))} {''.join(rng.choices('ab=,', k=6))} 1000000" for _ in range(2000)]

    def drop_empty_end(parts):
        while parts and parts[-1] == "":
            parts = parts[:-1]
        return parts

    def split(text, sep):
        return [text] if text == "" else drop_empty_end(text.split(sep))

    def plain(line):
        text = line.strip("".join(map(chr, range(33))))
        parts, quotes_after = [""], text.count('"')
        for ch in text:
            quotes_after -= ch == '"'
            if ch == " " and quotes_after % 2 == 0:
                parts.append("")
            else:
                parts[-1] += ch
        if len(parts) != 3 or not split(parts[0], ","):
            return None
        fields = {}
        for pair in split(parts[0], ",")[1:] + split(parts[1], ","):
            kv = split(pair, "=")
            if len(kv) != 2:
                return None
            fields[kv[0]] = kv[1]
        return fields if parts[2].lstrip("+-").isdigit() else None

    got = parse(spark, *lines)
    wrong = [(line, got[n].fields, plain(line)) for n, line in enumerate(lines) if got[n].fields != plain(line)]
    assert not wrong, wrong[:5]
    assert sum(row.error is None for row in got.values()) > 50


def test_good_and_bad_lines_add_up(spark):
    frame = spark.createDataFrame([(SAMPLE,), ("nonsense",), (None,)], "line string")
    parsed = parse_lines(frame)
    assert accepted(parsed).count() == 1
    assert [r.error for r in rejected(parsed).collect()] == ["part count", "part count"]


def test_file_source_and_stamp(spark, tmp_path):
    (tmp_path / "a.txt").write_text(SAMPLE + "\n" + "bad\n")
    rows = indicators_from_lines(read_lines(spark, str(tmp_path))).collect()
    assert len(rows) == 1 and rows[0].ingestion_time is not None


def test_transactions(spark):
    lines = [
        "5,2024-01-02 03:04:05,7,8,CSH,12.50,99",
        "5,2024-01-02 03:04:05,7,8,XXX,12.50,99",
        "5,2024-01-02,7,8,CSH,12.50,99",
        "5,2024-01-02 03:04:05,7,8,CSH,much,99",
        "5,2024-01-02 03:04:05,7,8,CSH,1",
        "5,2024-13-02 03:04:05,7,8,CSH,1,99",
    ]
    frame = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    rows = {r.n: r for r in parse_transactions(frame).withColumn("ms", F.unix_millis("event_time")).collect()}
    assert rows[0].error is None and rows[0].ms == 1704164645000
    assert (rows[0].transaction_id, float(rows[0].payment_amount), rows[0].payment_type) == (5, 12.5, "CSH")
    assert rows[1].error is None and rows[1].payment_type is None
    assert [rows[i].error for i in (2, 3, 4, 5)] == [
        "bad event_time", "bad payment_amount", "part count", "bad event_time",
    ]


def test_json_rows(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    frame = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("{oops",)], "json string")
    rows = from_json_rows(frame, schema).orderBy(F.col("a").desc_nulls_last()).collect()
    assert (rows[0].a, rows[0].b, rows[0].error) == (1, "x", None)
    assert rows[1].error == "bad json"
    back = to_json_rows(spark.createDataFrame([(1, "x")], schema)).first().json
    assert back == '{"a":1,"b":"x"}'
