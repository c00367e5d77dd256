"""The evaluation: matching, values, windows, documents, look-ups, running values."""

import json
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.fields import FieldColumns
from tallyloom.functions.numbers import mean
from tallyloom.functions.windows import bound_text, window_start
from tallyloom.operators import bounded, fork as fork_module
from tallyloom.operators.aggregate import finish, last_event, merge, partials, partials_of_rules
from tallyloom.operators.asof import rule_versions
from tallyloom.operators.documents import (
    addressed, compact, current_results, document_json, documents, write_versions,
)
from tallyloom.operators.fork import fork
from tallyloom.operators.lookup import widen
from tallyloom.operators.rules import repeated_ids
from tallyloom.operators.running import lookback_values, running_values
from tallyloom.operators.thresholds import passes
from tallyloom.plans import evaluate as evaluate_module
from tallyloom.plans.evaluate import evaluate, evaluate_table, replay
from tallyloom.sources.rules import parse_rules, usable

ALL = "v:sum&v:count&v:avg&v:min&v:max"


def values(results):
    return {
        (r.rule_id, tuple(r.grouping_values), r.window_start_ms, r.metric): float(r.value if r.approx is None else r.approx)
        for r in results.collect()
    }


def test_dirty_values(events, rules):
    texts = ['"0"', "abc", "NaN", "15i", "2.5", None, "", "-Infinity"]
    rows = [(i, "t", 10, {"v": text, "k": "a"}) for i, text in enumerate(texts)]
    got = values(evaluate(events(*rows), rules(f"1,t,active,k,{ALL},1")))
    metric = lambda m: got[(1, ("a",), 0, f"v-{m}")]
    assert (metric("SUM"), metric("COUNT"), metric("MIN"), metric("MAX")) == (2.5, 8, 0, 2.5)
    assert metric("AVG") == 0.3125


def test_numbers_beyond_the_decimal_type_count_in_full(events, rules):
    rows = [
        (i, "t", 10, {"v": v, "k": k})
        for i, (k, v) in enumerate(
            [("a", "1e25"), ("a", "2"), ("a", "4e-9"), ("b", "-1e300"), ("b", "7"), ("c", "3"), ("c", "4.5"), ("d", "4e-9")]
        )
    ]
    done = evaluate(events(*rows), rules(f"1,t,active,k,{ALL},1"))
    got = {(k[1][0], k[3][2:]): v for k, v in values(done).items()}
    assert got[("a", "SUM")] == 1e25 + 2 and got[("a", "MIN")] == 4e-9 and got[("a", "MAX")] == 1e25
    assert got[("a", "COUNT")] == 3 and got[("a", "AVG")] == (1e25 + 2) / 3
    assert got[("b", "SUM")] == -1e300 and got[("b", "MIN")] == -1e300 and got[("b", "MAX")] == 7
    assert got[("c", "SUM")] == 7.5 and got[("d", "MAX")] == 4e-9
    rows = {(r.grouping_values[0], r.metric): r for r in done.collect()}
    assert rows[("a", "v-SUM")].n_overflow == 2 and rows[("c", "v-SUM")].approx is None
    assert rows[("b", "v-SUM")].value is None and float(rows[("a", "v-MAX")].value) == 1e25
    bodies = {d.doc_id[1]: json.loads(d.body) for d in document_json(documents(done)).collect()}
    assert bodies["b"]["v-SUM"] == -1e300 and bodies["b"]["v-COUNT"] == 2 and bodies["c"]["v-SUM"] == 7.5


def test_partials_of_large_numbers_merge(events, rules):
    rows = [(0, "t", 10, {"v": "1e25", "k": "a"}), (1, "t", 90_000, {"v": "3", "k": "a"}), (2, "t", 95_000, {"v": "-1e26", "k": "a"})]
    some = rules(f"1,t,active,k,{ALL},1")
    merged = values(finish(merge(partials(fork(events(*rows), some)), 10)))
    assert merged == values(evaluate(events(*rows), rules(f"1,t,active,k,{ALL},10")))


def test_a_rule_id_that_comes_twice_is_one_rule(spark, events, rules):
    rows = events(*[(i, "t", 10, {"v": str(i), "k": "a"}) for i in (1, 2)])
    line = "1,t,active,k,v:sum&v:count,1"
    want = {(1, ("a",), 0, "v-SUM"): 3, (1, ("a",), 0, "v-COUNT"): 2}
    assert values(evaluate(rows, rules(line, line))) == want
    assert evaluate(rows, rules(line, "1,t,delete,k,v:sum&v:count,1")).count() == 0
    log = spark.createDataFrame([(1, line.replace("active", "pause")), (2, line)], "seq bigint, line string")
    ordered = usable(parse_rules(log)).drop("line")
    assert values(evaluate(rows, ordered)) == want
    assert [(r.rule_id, r.n_rows) for r in repeated_ids(ordered).collect()] == [(1, 2)]


def test_missing_lookup_values_are_dealt_out(spark, events):
    rows = events(*[(i, "t", i, {"x": str(i)}) for i in range(50)])
    dim = spark.createDataFrame([("h", "o")], "h string, owner string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = widen(rows, dim, {"host": "h"}, ["owner"])
        assert wide.count() == 50 and "coalesce" in wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_matching(events, rules):
    rows = [
        (0, "t", 10, {"v": "1"}),
        (1, "t", 10, {"w": "1"}),
        (2, "other", 10, {"v": "1"}),
        (3, "t", 10, {"v": None}),
    ]
    some = rules("1,t,active,zone,v:count,1", "2,t,pause,zone,v:count,1", "3,t,active,zone,v:sum&w:sum,1")
    got = values(evaluate(events(*rows), some))
    assert got == {(1, ("null",), 0, "v-COUNT"): 2}


def test_negative_values_and_repeated_specs(events, rules):
    rows = [(0, "t", 10, {"v": "-3", "k": "a"}), (1, "t", 10, {"v": "-5", "k": "a"})]
    got = values(evaluate(events(*rows), rules("1,t,active,k,v:max&v:sum&v:sum,1")))
    assert got == {(1, ("a",), 0, "v-MAX"): -3, (1, ("a",), 0, "v-SUM"): -8}


def test_values_that_print_alike_stay_apart(events, rules):
    rows = [(0, "t", 10, {"v": "1", "a": "x-y", "b": "z"}), (1, "t", 10, {"v": "2", "a": "x", "b": "y-z"})]
    results = evaluate(events(*rows), rules("1,t,active,a&b,v:sum,1"))
    assert sorted(values(results).values()) == [1, 2]
    docs = documents(results).collect()
    assert {d.doc_id for d in docs} == {"{x\\-y-z-0-60000}", "{x-y\\-z-0-60000}"}


def test_window_bounds(spark):
    at = lambda ms, size: spark.range(1).select(window_start(F.lit(ms).cast("bigint"), F.lit(size).cast("bigint"))).first()[0]
    assert at(1623283990075, 600000) == 1623283800000
    assert at(1623284400000, 600000) == 1623284400000
    assert at(-1, 600000) == -600000
    text = spark.range(1).select(
        bound_text(F.lit(1623283800000), "Asia/Shanghai").alias("east"), bound_text(F.lit(1623283800000)).alias("utc")
    ).first()
    assert (text.east, text.utc) == ("2021-06-10 08:10:00:000", "2021-06-10 00:10:00:000")


def test_sample_document(events, rules):
    # fixed values: the published sample document, whose printed form results must equal
    start, host, key = 1623283800000, "18.18.1.113", "246181c7b2e4401bb52b0e30eb7fa56f"
    rows = [
        (i, "esb_as_ProcBizFuncLibs", start + i, {"host": host, "monitorKey": key, "cur_excCount": v})
        for i, v in enumerate(["7.0"] * 3 + ["8.0"] * 4)
    ]
    rule = "1,esb_as_ProcBizFuncLibs,active,host&monitorKey," + ALL.replace("v:", "cur_excCount:") + ",10"
    results = evaluate(events(*rows), rules(rule))
    doc = documents(results, "Asia/Shanghai").first()
    assert doc["index"] == "esb_as_procbizfunclibs"
    assert doc.doc_id == "{18.18.1.113-246181c7b2e4401bb52b0e30eb7fa56f-1623283800000-1623284400000}"
    assert (doc.startTime, doc.endTime) == ("2021-06-10 08:10:00:000", "2021-06-10 08:20:00:000")
    assert doc.fields == {"host": host, "monitorKey": key}
    assert {k: float(v) for k, v in doc.metrics.items()} == {
        "cur_excCount-MAX": 8, "cur_excCount-MIN": 7, "cur_excCount-AVG": 7.5714,
        "cur_excCount-COUNT": 7, "cur_excCount-SUM": 53,
    }
    body = document_json(documents(results)).first().body
    assert '"host":"18.18.1.113"' in body and '"cur_excCount-SUM":53' in body


def test_two_rules_share_a_document(events, rules):
    rows = [(0, "t", 10, {"v": "1", "k": "a"}), (1, "t", 11, {"v": "4", "k": "a"})]
    docs = documents(evaluate(events(*rows), rules("1,t,active,k,v:sum,1", "2,t,active,k,v:max&v:sum,1"))).collect()
    assert len(docs) == 1 and {k: float(v) for k, v in docs[0].metrics.items()} == {"v-SUM": 5, "v-MAX": 4}


def test_rule_without_keys(events, rules):
    rows = [(i, "t", i * 60_000, {"v": str(i)}) for i in range(5)]
    some = rules("1,t,active,,v:sum,1")
    row = evaluate(events(*rows), some).first()
    assert (float(row.value), row.window_start_ms, row.window_end_ms) == (10, 240_000, 300_000)
    assert addressed(evaluate(events(*rows), some)).first().doc_id == "{}"
    assert evaluate(events(*rows), some, keyless="windowed").count() == 5


def test_mean_is_rounded_once(spark):
    rng = random.Random(1)
    rows = [(Decimal("-0.00005"), 1), (Decimal(53), 7), (Decimal(0), 0), (Decimal(10) ** 27, 10**9)]
    with localcontext() as ctx:
        ctx.prec = 60
        for i in range(3000):
            size = rng.choice([1, 5, 9, 10, 12, 18, 19, 20, 25, 29])
            total = Decimal(rng.randint(-10 ** (size + 8), 10 ** (size + 8))).scaleb(-8)
            n = rng.choice([1, 2, 3, 7, 10**6 + 1, rng.randint(1, 10**9)])
            if i % 3 == 0:  # a tie
                total = ((Decimal(rng.randint(-(10**6), 10**6)) + Decimal("0.5")) * n / 10**4).quantize(Decimal("1e-8"))
            rows.append((total, n))
        frame = spark.createDataFrame(rows, "t decimal(38,8), n bigint")
        for row in frame.select("t", "n", mean(F.col("t"), F.col("n")).alias("m")).collect():
            exact = (row.t / row.n).quantize(Decimal("0.0001"), ROUND_HALF_UP) if row.n else 0
            assert row.m == exact, row


def brute(rows, keys, minutes):
    groups = {}
    for _, _, ms, fields in rows:
        size = minutes * 60_000
        groups.setdefault((tuple(fields.get(k) or "null" for k in keys), ms // size * size), []).append(float(fields["v"]))
    return groups


def skewed_rows(n=400):
    rng = random.Random(5)
    return [
        (i, "t", rng.randrange(0, 600_000), {"v": str(rng.randrange(-500, 500) / 4), "k": "hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}"})
        for i in range(n)
    ]


@pytest.mark.parametrize("small", [True, False])
def test_broadcast_and_salted_join_agree(events, rules, small):
    rows = skewed_rows()
    got = values(evaluate(events(*rows), rules(f"1,t,active,k,{ALL},2", "2,u,active,k,v:sum,1"), small_rules=small))
    want = {}
    for (key, start), vs in brute(rows, ["k"], 2).items():
        for metric, value in {"SUM": sum(vs), "COUNT": len(vs), "MIN": min(vs), "MAX": max(vs)}.items():
            want[(1, key, start, f"v-{metric}")] = value
    assert {k: v for k, v in got.items() if not k[3].endswith("AVG")} == want


def test_size_check_decides(events, rules, monkeypatch):
    some = rules(*[f"{i},t,active,k,v:sum,2" for i in range(1, 6)])
    assert bounded.check_size(some).small
    assert not bounded.check_size(some, max_rows=4).small
    assert not bounded.check_size(some, max_bytes=50).small
    monkeypatch.setattr(fork_module, "check_size", lambda df, most: bounded.check_size(df, most, max_rows=4))
    plan = fork(events(*skewed_rows(10)), some)._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle_hash" in plan and "broadcast" not in plan


def test_columns_give_the_same_as_the_map(spark, events, rules):
    rows = skewed_rows()
    frame = spark.createDataFrame(
        [(i, t, ms, float(f["v"]), f["k"]) for i, t, ms, f in rows], "id int, t string, ms bigint, v double, k string"
    ).withColumn("ts", F.timestamp_millis("ms"))
    some = rules(f"1,t,active,k,{ALL},2", "2,t,active,zone&k,v:avg,3", "3,t,active,k,k:count&v:sum,5")
    assert values(evaluate_table(frame, "t", "ts", ["v", "k"], some)) == values(evaluate(events(*rows), some))


def test_fields_side_by_side_give_the_same_as_a_row_per_field(events, rules):
    texts = ["1.5", "abc", None, "1e25", "4e-9", "-2.25", "NaN"]
    rows = [
        (i, "t", 1000 * i, {"v": texts[i % 7], "w": texts[i % 5], "k": "ab"[i % 2]} | ({"x": "3"} if i % 3 else {}))
        for i in range(200)
    ]
    some = rules(
        f"1,t,active,k,{ALL}&w:sum&x:max,1", "2,t,active,,v:sum&w:avg,2", "3,t,active,zone&k,w:count,3",
        "4,t,pause,k,v:sum,1", "5,t,active,k,nosuch:sum,1", "6,u,active,k,v:sum,1",
    )
    assert 3 <= evaluate_module._MAX_FIELDS
    for keyless in ("running", "windowed"):
        key = lambda r: tuple(map(str, r))
        want = sorted(finish(partials(fork(events(*rows), some), keyless)).collect(), key=key)
        got = sorted(evaluate(events(*rows), some, keyless).collect(), key=key)
        assert len(want) > 40 and got == want


def test_rules_edited_while_the_job_runs_are_an_error(events, rules):
    forked = fork(events((1, "t", 10, {"v": "1", "w": "2", "k": "a"})), rules("1,t,active,k,v:sum&w:sum,1"))
    for line, most in (("1,t,active,k,v:sum&w:max,1", 2), ("1,t,active,k,v:sum,1", 1)):
        with pytest.raises(Exception, match="run it again"):
            partials_of_rules(forked, fork_module.matcher(rules(line)), most).collect()


def test_column_values_as_zero(spark, rules):
    frame = spark.createDataFrame(
        [(float("nan"), "a"), (float("inf"), "b"), (None, "c"), (1e25, "d"), (2.5, "e")], "v double, w string"
    ).withColumn("ts", F.timestamp_millis(F.lit(10)))
    got = evaluate_table(frame, F.lit("t"), "ts", ["v", "w"], rules("1,t,active,,v:sum&v:count&w:sum,1")).collect()
    assert {r.metric: float(r.value) for r in got} == {"v-SUM": 1e25, "v-COUNT": 5, "w-SUM": 0}
    assert {r.metric: r.n_overflow for r in got}["v-SUM"] == 1


def test_merge_into_coarser_windows(events, rules):
    rows = skewed_rows()
    fine = partials(fork(events(*rows), rules(f"1,t,active,k,{ALL},2")))
    direct = evaluate(events(*rows), rules(f"1,t,active,k,{ALL},10"))
    assert values(finish(merge(fine, 10))) == values(direct)
    with pytest.raises(Exception, match="coarser window"):
        merge(fine, 3).collect()


def test_running_values_with_a_hot_group(events, rules):
    rows = skewed_rows(600)
    done = running_values(fork(events(*rows), rules("1,t,active,k,v:sum,10")), "event_id").collect()
    state, want = {}, {}
    for i, _, ms, f in sorted(rows, key=lambda r: (r[2], r[0])):
        vs = state.setdefault(f["k"], [])
        vs.append(float(f["v"]))
        want[i] = (sum(vs), len(vs), min(vs), max(vs))
    assert {r.event_id: (float(r.total), r.n, float(r.low), float(r.high)) for r in done} == want


def test_lookback(events, rules):
    rows = skewed_rows(500)
    got = lookback_values(fork(events(*rows), rules("1,t,active,k,v:sum,1"))).collect()
    want = {}
    for _, _, ms, f in rows:
        near = [float(g["v"]) for _, _, at, g in rows if g["k"] == f["k"] and ms - 60_000 <= at <= ms]
        want[(f["k"], ms)] = (sum(near), len(near))
    assert {(r.grouping_values[0], r.event_ms): (float(r.total), r.n) for r in got} == want


def test_last_event(events, rules):
    rows = [(0, "t", 10, {"v": "1", "k": "a"}), (1, "t", 30, {"v": "2", "k": "a"}), (2, "t", 30, {"v": "3", "k": "a"})]
    row = last_event(fork(events(*rows), rules("1,t,active,k,v:sum,1")), "event_id").first()
    assert (row.event_id, row.fields["v"]) == (2, "3")


def test_lookup(spark, events):
    rows = [
        (0, "t", 10, {"host": "h1", "owner": "old"}), (1, "t", 10, {"host": "none"}), (2, "t", 10, {"x": "1"}),
        (3, "t", 10, {"host": "h2", "owner": "old"}),
    ]
    dim = spark.createDataFrame(
        [("h1", "first", 1), ("h1", "last", 2), (None, "nobody", 3), ("h2", None, 1)], "h string, owner string, at int"
    )
    got = {r.event_id: r.fields for r in widen(events(*rows), dim, {"host": "h"}, ["owner"], order="at").collect()}
    assert got == {
        0: {"host": "h1", "owner": "last"}, 1: {"host": "none"}, 2: {"x": "1"}, 3: {"host": "h2", "owner": None},
    }


def test_rules_change_on_the_way(spark, events):
    log = spark.createDataFrame(
        [(0, "1,t,active,k,v:sum,1"), (10, "1,t,pause,k,v:sum,1"), (20, "1,t,active,k,v:sum,1"), (30, "1,t,delete,k,v:sum,1")],
        "seq bigint, line string",
    )
    changes = usable(parse_rules(log)).drop("line")
    assert sorted((r.from_seq, r.to_seq) for r in rule_versions(changes).collect()) == [
        (0, 10), (10, 20), (20, 30), (30, 2**63 - 1),
    ]
    rows = events(*[(i, "t", 10, {"v": "1", "k": "a"}) for i in range(40)]).withColumn("seq", F.col("event_id"))
    assert values(replay(rows, changes)) == {(1, ("a",), 0, "v-SUM"): 20}


def test_versions_merge_and_compact(spark, events, rules, tmp_path):
    rows = [(0, "T", 10, {"v": "1", "k": "a"})]
    late = rows + [(1, "T", 11, {"v": "2", "k": "a"})]
    path, small = str(tmp_path / "results"), str(tmp_path / "compacted")
    write_versions(evaluate(events(*rows), rules("1,T,active,k,v:sum&v:max,1")), path, 0)
    write_versions(evaluate(events(*late), rules("1,T,active,k,v:sum,1")), path, 1)
    write_versions(evaluate(events(*late), rules("1,T,active,k,v:sum,1")), path, 1)  # a repeated batch
    want = {(1, ("a",), 0, "v-SUM"): 3, (1, ("a",), 0, "v-MAX"): 1}
    assert values(current_results(spark, path)) == want
    compact(spark, path, small)
    assert values(current_results(spark, small)) == want
    write_versions(evaluate(events(*rows), rules("1,T,active,k,v:sum,1")), path, 0, generation=1)
    assert values(current_results(spark, path))[(1, ("a",), 0, "v-SUM")] == 1


@pytest.mark.parametrize(
    "op, want", [("=", [False, True, False]), ("!=", [True, False, True]), (">=", [False, True, True]),
                 ("<=", [True, True, False]), (">", [False, False, True]), ("<", [True, False, False]), ("~", [None] * 3)]
)
def test_thresholds(spark, op, want):
    frame = spark.range(1, 4).select(passes(F.col("id"), F.lit(op), F.lit(2)).alias("p"))
    assert [r.p for r in frame.collect()] == want


def test_running_and_lookback_values_beyond_the_decimal_type(events, rules):
    """A huge number counts while it is in the window and leaves no trace after it."""
    values = [(1, "1e300"), (2, "5"), (60_002, "3e25"), (60_003, "-7"), (120_003, "2"), (120_003, "x"), (200_000, "4")]
    forked = fork(events(*[(i, "t", ms, {"v": v, "k": "a"}) for i, (ms, v) in enumerate(values)]), rules("1,t,active,k,v:sum,1"))
    got = {r.event_ms: r for r in lookback_values(forked, wide=True).collect()}
    assert {ms: r.n_overflow for ms, r in got.items()} == {1: 1, 2: 1, 60_002: 1, 60_003: 1, 120_003: 0, 200_000: 0}
    assert [got[ms].approx.total for ms in (1, 2, 60_002, 60_003)] == [1e300, 1e300, 3e25, 3e25]
    assert got[60_002].n == 2 and got[120_003].n == 3 and got[120_003].approx is None
    assert [float(got[ms].total) for ms in (120_003, 200_000)] == [-5, 4] and got[1].total is None
    assert float(got[60_003].total) == 3e25
    plain = {r.event_ms: (r.total, r.n_overflow) for r in lookback_values(forked).collect()}
    assert plain[60_002] == (None, 1) and float(plain[120_003][0]) == -5
    rows = fork(events(*[(i, "t", 10 + i, {"v": v, "k": "a"}) for i, v in enumerate(["2", "-1e40", "3", "1e30"])]), rules("1,t,active,k,v:sum,1"))
    done = sorted(running_values(rows, "event_id").collect(), key=lambda r: r.event_id)
    assert [r.n_overflow for r in done] == [0, 1, 1, 2] and float(done[0].low) == 2 and done[0].approx is None
    assert done[3].approx.low == -1e40 and done[3].approx.high == 1e30 and done[2].approx.high == 3
