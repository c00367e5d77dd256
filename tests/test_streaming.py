"""Streams: late events, closing windows, ending state, live rules, recovery, side outputs."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import partials
from tallyloom.operators.documents import compact_parts, live_results
from tallyloom.operators.fork import fork
from tallyloom.operators.health import with_latency
from tallyloom.operators.lookup import widen
from tallyloom.operators.rollup import read_rollup, update_rollup
from tallyloom.plans.evaluate import evaluate
from tallyloom.sources.lines import indicators_from_lines, stream_lines
from tallyloom.sources.rules import parse_rules, usable
from tallyloom.streaming.change_feed import asof_partials, live_changes, maintain_rules, stream_changes
from tallyloom.streaming.closing import closed_results, late_rows, start_closing
from tallyloom.streaming.dimension_feed import live_dimension, publish_dimension, seen_versions
from tallyloom.streaming.job import (
    closing_partials, heartbeat, observed, start, update_partials, window_lengths,
)
from tallyloom.streaming.latency import read_latency, start_latency
from tallyloom.streaming.rule_feed import current_epoch, live_rules

MINUTE = 60_000
DAY = 24 * 60 * MINUTE


class Source:
    """A folder of event lines that grows by one file per call."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.n, self.base = spark, tmp_path, 0, time.time() - 1000
        (tmp_path / "in").mkdir()

    def add(self, *events):
        self.n += 1
        lines = [f"{t},k={k} v={v} {ms * 1_000_000}" for t, k, v, ms in events]
        path = self.root / "in" / f"{self.n:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (self.base + self.n, self.base + self.n))  # files are read in order of age

    def stream(self):
        return indicators_from_lines(stream_lines(self.spark, str(self.root / "in"), files_per_batch=1))

    def run(self, parts, **options):
        query = start(parts, str(self.root / "out"), str(self.root / "checkpoint"), **options)
        query.awaitTermination()
        return query

    def results(self):
        rows = live_results(self.spark, str(self.root / "out")).collect()
        return {(r.rule_id, tuple(r.grouping_values), r.window_start_ms, r.metric): float(r.value) for r in rows}


@pytest.fixture
def source(spark, tmp_path):
    return Source(spark, tmp_path)


def test_late_events_correct_results(source, rules):
    some = rules("1,t,active,k,v:sum&v:count,1", "2,t,active,,v:max,1")
    source.add(("t", "a", 1, 10), ("t", "a", 2, 5 * MINUTE))
    source.run(update_partials(source.stream(), some))
    assert source.results()[(1, ("a",), 0, "v-SUM")] == 1
    source.add(("t", "a", 10, 20))
    source.run(update_partials(source.stream(), some))
    got = source.results()
    assert got[(1, ("a",), 0, "v-SUM")] == 11 and got[(1, ("a",), 0, "v-COUNT")] == 2
    assert got[(2, (), 5 * MINUTE, "v-MAX")] == 10


def test_closed_windows_come_once_and_late_events_are_dropped(source, rules):
    some = rules("1,t,active,k,v:sum,1", "2,t,active,k,v:sum,2")
    assert window_lengths(some) == [1, 2]
    source.add(("t", "a", 1, 10))
    source.add(("t", "a", 2, MINUTE + 600))
    source.add(("t", "b", 2, MINUTE + 700))  # the watermark of a batch holds for lateness in the next but one
    source.add(("t", "a", 50, 20))
    source.run(closing_partials(source.stream(), some), mode="append")
    assert source.results() == {(1, ("a",), 0, "v-SUM"): 1}


def test_a_heartbeat_closes_windows(source, spark, rules, tmp_path):
    (tmp_path / "beats").mkdir()
    (tmp_path / "beats" / "1.json").write_text('{"event_time": "1970-01-01T01:00:00Z"}\n')
    beats = spark.readStream.schema("event_time timestamp").json(str(tmp_path / "beats"))
    source.add(("t", "a", 1, 10))
    source.run(closing_partials(heartbeat(source.stream(), beats), rules("1,t,active,k,v:sum,1")), mode="append")
    assert source.results() == {(1, ("a",), 0, "v-SUM"): 1}


def test_state_ends_after_the_allowed_lateness(source, rules):
    some = rules("1,t,active,k,v:sum,10")
    source.add(("t", "a", 1, 10))
    source.add(("t", "a", 1, DAY + 10 * MINUTE))
    source.add(("t", "a", 8, 20))  # late for its window, within the allowance
    source.add(("t", "a", 1, 4 * DAY))
    source.add(("t", "a", 1, 4 * DAY + 1))
    source.add(("t", "a", 100, 30))  # days too late
    query = source.run(update_partials(source.stream(), some))
    assert source.results()[(1, ("a",), 0, "v-SUM")] == 9
    operators = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(o["numRowsDroppedByWatermark"] for o in operators) == 1
    assert operators[-1]["numRowsTotal"] == 1


def test_any_window_and_none_with_state_that_ends(source, rules):
    """Seven minutes across midnight, three days, no keys: the parts of each day are added up."""
    some = rules("1,t,active,k,v:sum&v:max,7", "2,t,active,k,v:count&v:avg,4320", "3,t,active,,v:sum,60")
    times = [DAY - 2 * MINUTE, DAY - 1, DAY, DAY + MINUTE, 2 * DAY + 5, 5 * DAY, 9 * DAY]
    for n, at in enumerate(times):
        source.add(("t", "a", n + 1, at))
    query = source.run(update_partials(source.stream(), some))
    size = 7 * MINUTE
    assert source.results()[(1, ("a",), DAY // size * size, "v-SUM")] == 1 + 2 + 3 + 4
    assert source.results()[(1, ("a",), DAY // size * size, "v-MAX")] == 4
    assert source.results()[(2, ("a",), 0, "v-COUNT")] == 5 and source.results()[(2, ("a",), 0, "v-AVG")] == 3
    assert source.results()[(3, (), 9 * DAY, "v-SUM")] == 28
    operators = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert operators[-1]["numRowsTotal"] <= 6 and sum(o["numRowsRemoved"] for o in operators) > 0


def test_compaction_in_place(source, spark, rules):
    some, path = rules("1,t,active,k,v:sum,1", "2,t,active,,v:max,1"), str(source.root / "out")
    for n in range(3):
        source.add(("t", "a", n + 1, 10 + n), ("t", f"b{n}", 1, 10))
        source.run(update_partials(source.stream(), some))
        before = source.results()
        compact_parts(spark, path)
        assert source.results() == before
    assert before[(1, ("a",), 0, "v-SUM")] == 6 and len(before) == 5
    compact_parts(spark, path)
    assert source.results() == before


def test_a_new_length_stops_closing_windows(source, rules):
    source.add(("t", "a", 1, 10))
    with pytest.raises(Exception, match="restart the stream"):
        source.run(closing_partials(source.stream(), rules("1,t,active,k,v:sum,7"), lengths=[5]), mode="append")


def test_rule_lines_are_changes(spark, tmp_path):
    (tmp_path / "1.txt").write_text("1,t,active,k,v:sum,1\n1,t,delete,k,v:sum,1\n2,t,active,k,v:sum,1\n2,t,pause,k,v:sum,1\n3,t,active,k,v:sum,1\n")
    got = lambda: {(r.rule_id, r.rule_state) for r in live_rules(spark, str(tmp_path), patience=0.3).collect()}
    assert got() == {(2, "PAUSE"), (3, "ACTIVE")}
    (tmp_path / "2.txt").write_text('2,t,active,k,v:sum,1\n{"ruleState": "CONTROL", "controlType": "EXPORT_RULES_CURRENT"}\n')
    assert got() == {(2, "ACTIVE"), (3, "ACTIVE")}
    (tmp_path / "3.txt").write_text('{"ruleState": "CONTROL", "controlType": "DELETE_RULES_ALL"}\n4,t,active,k,v:sum,1\n')
    assert got() == {(4, "ACTIVE")}
    (tmp_path / "_temporary").mkdir()
    with pytest.raises(Exception, match="no complete set"):
        got()


def test_only_complete_sets_of_rules_are_read(spark, tmp_path):
    with pytest.raises(Exception, match="no complete set"):
        live_rules(spark, str(tmp_path / "nowhere"), patience=0.1).count()
    for n, done in ((1, True), (2, True), (10, False)):
        (tmp_path / f"version={n}").mkdir()
        (tmp_path / f"version={n}" / "part-0").write_text(f"{n},t,active,k,v:sum,1\n")
        if done:
            (tmp_path / f"version={n}" / "_SUCCESS").write_text("")
    assert [r.rule_id for r in live_rules(spark, str(tmp_path)).collect()] == [2]


def test_rules_change_while_the_stream_runs(source, spark, tmp_path):
    folder = tmp_path / "rules"
    folder.mkdir()
    (folder / "r.txt").write_text("1,t,active,k,v:sum,1\nnonsense\n")
    parts = partials(fork(source.stream(), live_rules(spark, str(folder)), small_rules=True))
    query = start(
        parts, str(source.root / "out"), str(source.root / "checkpoint"), trigger={"processingTime": "0 seconds"}
    )
    try:
        source.add(("t", "a", 1, 10))
        query.processAllAvailable()
        (folder / "r.txt").write_text("1,t,pause,k,v:sum,1\n2,t,active,k,v:max,1\n")
        source.add(("t", "a", 5, 20))
        query.processAllAvailable()
        (folder / "r.txt").write_text("1,t,active,k,v:sum&v:count,1\n")
        source.add(("t", "a", 7, 30))
        query.processAllAvailable()
    finally:
        query.stop()
    # the paused rule missed one event; an edit goes on with the totals it has
    assert source.results() == {
        (1, ("a",), 0, "v-SUM"): 8, (2, ("a",), 0, "v-MAX"): 5, (1, ("a",), 0, "v-COUNT"): 2,
    }


def test_rule_folder_holds_to_its_bound(spark, tmp_path):
    (tmp_path / "r.txt").write_text("1,t,active,k,v:sum,1\n2,t,active,k,v:sum,1\n")
    assert live_rules(spark, str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="exceed 1 rows"):
        live_rules(spark, str(tmp_path), max_rows=1).count()


def test_stream_equals_batch(source, spark, rules):
    some = rules("1,t,active,k,v:sum&v:avg&v:min,1", "2,u,active,k,v:max,2", "3,u,active,,v:count,1")
    rows = [("t" if i % 3 else "u", f"k{i % 4}", i % 7, (i * 7919) % 300_000) for i in range(200)]
    for at in range(0, 200, 50):
        source.add(*rows[at : at + 50])
    source.run(update_partials(source.stream(), some))
    lines = spark.read.text(str(source.root / "in")).withColumnRenamed("value", "line")
    batch = evaluate(indicators_from_lines(lines), some).collect()
    assert source.results() == {
        (r.rule_id, tuple(r.grouping_values), r.window_start_ms, r.metric): float(r.value) for r in batch
    }


def test_restart_goes_on_from_the_checkpoint(source, rules):
    some = rules("1,t,active,k,v:count,1")
    for i in range(3):
        source.add(("t", "a", 1, 10 + i))
        source.run(update_partials(source.stream(), some))
    assert source.results() == {(1, ("a",), 0, "v-COUNT"): 3}


def test_state_is_kept_on_disk_unless_the_session_names_a_store(spark, tmp_path):
    """The store shows in the metrics; a session's own choice holds, and a stream keeps the store that it began with."""
    session = spark.newSession()
    given = "spark.sql.streaming.stateStore.providerClass"
    in_memory = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    some = usable(parse_rules(session.createDataFrame([("1,t,active,k,v:sum,1",)], "line string"))).drop("line")

    def on_disk(source, value):
        source.add(("t", "a", value, 10))
        query = source.run(update_partials(source.stream(), some, None))
        state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        assert state[-1]["numRowsTotal"] == 1
        return "rocksdbPutCount" in state[-1]["customMetrics"]

    (tmp_path / "free").mkdir()
    (tmp_path / "named").mkdir()
    free, named = Source(session, tmp_path / "free"), Source(session, tmp_path / "named")
    session.conf.unset(given)
    assert on_disk(free, 1) and session.conf.get(given, None) is None
    assert on_disk(free, 2) and list(free.results().values()) == [3]
    session.conf.set(given, in_memory)
    assert not on_disk(named, 1) and session.conf.get(given) == in_memory
    session.conf.unset(given)
    assert not on_disk(named, 2) and list(named.results().values()) == [3]


def test_side_outputs(source, spark, rules):
    seen = []
    source.add(("t", "a", 1, 10), ("t", "b", 1, 10))
    forked = observed(fork(source.stream(), rules("1,t,active,k,v:count,1")))
    query = source.run(partials(forked), side_output=lambda results, number: seen.append((number, results.count())))
    assert seen and seen[0][1] == 2
    metrics = [p["observedMetrics"]["evaluation"] for p in query.recentProgress if p["observedMetrics"]]
    assert metrics[0]["events"] == 2 and metrics[0]["max_latency_ms"] >= 0


def test_side_output_reads_what_was_written_instead_of_a_copy_in_memory(source, rules):
    seen = []

    def look(results, number):
        plan = results._jdf.queryExecution().executedPlan().toString()
        rows = {(r.grouping_values[0], r.metric): float(r.value) for r in results.collect()}
        seen.append(("InMemoryTableScan" in plan, rows))

    some = rules("1,t,active,k,v:sum,1")
    source.add(("t", "a", 1, 10), ("t", "b", 2, 10))
    source.add(("other", "a", 1, 10))  # changes nothing
    source.add(("t", "a", 4, 20))
    source.run(update_partials(source.stream(), some, None), side_output=look)
    assert seen == [(False, {("a", "v-SUM"): 1, ("b", "v-SUM"): 2}), (False, {}), (False, {("a", "v-SUM"): 5})]


def test_latency(events, rules):
    rows = events((0, "t", 10, {"v": "1", "k": "a"})).withColumn("ingestion_time", F.timestamp_millis(F.lit(1000)))
    forked = fork(rows, rules("1,t,active,k,v:sum,1"))
    assert with_latency(forked, F.timestamp_millis(F.lit(1250))).first().latency_ms == 250


def test_a_stream_widened_from_a_dimension(source, spark, rules):
    dim = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("c", "x", 1)], "k string, owner string, at int")
    wide = widen(source.stream(), dim, {"k": "k"}, ["owner"], order="at")
    source.add(("t", "a", 1, 10), ("t", "b", 2, 10))
    source.add(("t", "a", 5, 20))
    source.run(update_partials(wide, rules("1,t,active,owner,v:sum,1")))
    assert source.results() == {(1, ("new",), 0, "v-SUM"): 6, (1, ("null",), 0, "v-SUM"): 2}


def test_rules_too_many_to_broadcast_join_a_stream_by_shuffle(source, rules):
    source.add(*[("t", f"k{i % 3}", i, i) for i in range(30)])
    source.run(update_partials(source.stream(), rules("1,t,active,k,v:sum,1"), small_rules=False))
    assert source.results() == {(1, (f"k{j}",), 0, "v-SUM"): float(sum(range(j, 30, 3))) for j in range(3)}


def test_a_dimension_is_read_anew_whole_and_never_too_old(spark, tmp_path):
    path, on = str(tmp_path / "dim"), {"k": "key"}
    read = lambda **more: live_dimension(spark, path, on, ["owner"], "at", **more)
    with pytest.raises(FileNotFoundError):
        read()
    make = lambda *rows: spark.createDataFrame(rows, "key string, owner string, at int, unused double").repartition(2)
    assert publish_dimension(make(("a", "old", 1, 0.5), ("b", None, 2, 0.5)), path) == 1
    frame = read(max_age=600)
    rows = lambda: {(r.key, r.owner, r.at, r.version) for r in frame.collect()}
    assert frame.columns == ["key", "owner", "at", "version", "published"]
    assert rows() == {("a", "old", 1, 1), ("b", None, 2, 1)}
    assert publish_dimension(make(("a", "new", 3, 0.5)), path) == 2
    (tmp_path / "dim" / "version=3").mkdir()  # not complete
    assert rows() == {("a", "new", 3, 2)}
    assert [r.version for r in seen_versions(frame).collect()] == [2]
    with pytest.raises(Exception, match="too old"):
        read(max_age=0).count()
    with pytest.raises(Exception, match="exceeds 10 bytes"):
        read(max_bytes=10).count()
    publish_dimension(make(("a", "x", 1, 0.5)).where("false"), path)
    assert rows() == set()


def test_a_stream_follows_its_dimension(source, spark, rules, tmp_path):
    path = str(tmp_path / "dim")
    publish_dimension(spark.createDataFrame([("a", "old")], "key string, owner string"), path)
    wide = widen(source.stream(), live_dimension(spark, path, {"k": "key"}, ["owner"], max_age=600), {"k": "key"}, ["owner"], small=True)
    parts = update_partials(wide, rules("1,t,active,owner,v:sum,1"))
    running = start(parts, str(source.root / "out"), str(source.root / "checkpoint"), trigger={"processingTime": "0 seconds"})
    try:
        source.add(("t", "a", 1, 10), ("t", "b", 2, 10))
        running.processAllAvailable()
        publish_dimension(spark.createDataFrame([("a", "new"), ("b", "own")], "key string, owner string"), path)
        source.add(("t", "a", 5, 20), ("t", "b", 7, 20))
        running.processAllAvailable()
    finally:
        running.stop()
    assert source.results() == {(1, (k,), 0, "v-SUM"): v for k, v in {"old": 1, "null": 2, "new": 5, "own": 7}.items()}


class Closing:
    """Runs of a closing stream over a source, one micro-batch per file."""

    def __init__(self, source, **options):
        self.source, self.path, self.options = source, str(source.root / "closing"), options

    def run(self, rules):
        start_closing(self.source.stream(), rules, self.path, str(self.source.root / "checkpoint"), **self.options).awaitTermination()

    def results(self):
        rows = [
            (r.rule_id, r.grouping_values[0], r.window_start_ms, r.metric, float(r.value))
            for r in closed_results(self.source.spark, self.path).collect()
        ]
        assert len(rows) == len({r[:4] for r in rows})  # each once
        return set(rows)

    def late(self):
        return {(r.rule_id, r.grouping_values[0], r.window_start_ms, r.n) for r in late_rows(self.source.spark, self.path).collect()}


def test_windows_of_any_length_close_once(source, rules):
    """Restarted and compacted on the way; a rule of a new length joins; late rows are listed and change nothing."""
    closing, first = Closing(source, compact_every=2), ["1,t,active,k,v:sum,1", "2,t,active,k,v:sum&v:max,3"]
    source.add(("t", "a", 1, 10), ("t", "b", 2, 20))
    source.add(("t", "a", 4, MINUTE + 400))  # the mark is still before the first window's end
    closing.run(rules(*first))
    assert closing.results() == set() and closing.late() == set()
    source.add(("t", "a", 8, 30), ("u", "x", 0, MINUTE + 501))  # in time; and an event that no rule wants moves the mark
    source.add(("t", "a", 16, 40), ("t", "c", 1, 2 * MINUTE))  # late for one rule, not for the other
    closing.run(rules(*first))
    assert closing.results() == {(1, "a", 0, "v-SUM", 9), (1, "b", 0, "v-SUM", 2)}
    assert closing.late() == {(1, "a", 0, 1)}
    both = rules(*first, "3,t,active,k,v:count,7", "4,t,active,,v:sum,1")
    source.add(("t", "a", 32, 3 * MINUTE), ("t", "d", 1, 3 * MINUTE + 600))
    source.add(("t", "e", 1, 8 * MINUTE))
    closing.run(both)
    assert closing.results() == {
        (1, "a", 0, "v-SUM", 9), (1, "b", 0, "v-SUM", 2), (1, "a", MINUTE, "v-SUM", 4), (1, "c", 2 * MINUTE, "v-SUM", 1),
        (2, "a", 0, "v-SUM", 29), (2, "a", 0, "v-MAX", 16), (2, "b", 0, "v-SUM", 2), (2, "b", 0, "v-MAX", 2),
        (2, "c", 0, "v-SUM", 1), (2, "c", 0, "v-MAX", 1), (1, "a", 3 * MINUTE, "v-SUM", 32), (1, "d", 3 * MINUTE, "v-SUM", 1),
        (2, "a", 3 * MINUTE, "v-SUM", 32), (2, "a", 3 * MINUTE, "v-MAX", 32), (2, "d", 3 * MINUTE, "v-SUM", 1),
        (2, "d", 3 * MINUTE, "v-MAX", 1), (3, "a", 0, "v-COUNT", 1), (3, "d", 0, "v-COUNT", 1),
    }


def test_a_closing_batch_that_fails_after_writing_is_repeated(source, rules, monkeypatch):
    from tallyloom.streaming import closing as module

    closing, some, failed = Closing(source, compact_every=1), rules("1,t,active,k,v:sum,1"), []
    written = module.write_versions

    def fails_once(results, path, number):
        written(results, path, number)
        if number not in failed:
            failed.append(number)
            raise RuntimeError("after the results, before the mark")

    monkeypatch.setattr(module, "write_versions", fails_once)
    source.add(("t", "a", 1, 10), ("t", "a", 2, 2 * MINUTE))
    source.add(("t", "a", 4, 20), ("t", "a", 8, 4 * MINUTE))
    for _ in range(2):
        with pytest.raises(Exception, match="before the mark"):
            closing.run(some)
    closing.run(some)
    assert failed == [0, 1]
    assert closing.results() == {(1, "a", 0, "v-SUM", 1), (1, "a", 2 * MINUTE, "v-SUM", 2)} and closing.late() == {(1, "a", 0, 1)}


def test_changes_are_folded_once_across_restarts(spark, tmp_path):
    folder, path = tmp_path / "changes", str(tmp_path / "kept")
    folder.mkdir()
    row = lambda i, state, agg="v:sum": {"id": i, "table_name": "t", "rule_state": state, "grouping_key_names": "k", "agg_fields": agg, "window_minutes": 1}

    def add(name, *records):
        (folder / f"{name}.json").write_text("\n".join(json.dumps({"seq": s, "op": o, "after": a}) for s, o, a in records) + "\n")

    def run():
        maintain_rules(stream_changes(spark, str(folder), files_per_batch=1), path, str(tmp_path / "checkpoint")).awaitTermination()
        return {(r.rule_id, r.rule_state, r.aggs[0].func) for r in live_rules(spark, f"{path}/rules").collect()}

    add("1", (1, "c", row(1, "active")), (2, "c", row(2, "active")), (3, "u", row(1, "pause")), (4, "c", row(9, "asleep")))
    assert run() == {(1, "PAUSE", "SUM"), (2, "ACTIVE", "SUM")}
    add("2", (6, "u", row(2, "delete")), (8, "u", row(1, "active", "v:max")))
    add("3", (5, "u", row(2, "active")), (7, "d", row(1, "delete")))  # older than what is known; a physical delete
    assert run() == {(1, "ACTIVE", "MAX")}
    assert run() == {(1, "ACTIVE", "MAX")}  # nothing new
    command = {"rule_state": "control", "control_type": "DELETE_RULES_ALL"}
    add("4", (10, "c", command), (11, "c", row(3, "active")))
    add("5", (9, "c", row(4, "active")))  # voided by the command, though it comes after it
    assert run() == {(3, "ACTIVE", "SUM")}


def test_one_batch_on_both_sides_of_an_edit(spark, source, tmp_path):
    folder = tmp_path / "edits"
    folder.mkdir()
    rule = lambda seq, func, state="ACTIVE": json.dumps(
        {"seq": seq, "ruleId": 1, "tableName": "t", "ruleState": state, "groupingKeyNames": ["k"], "aggFields": [{"f0": "v", "f1": func}], "windowMinutes": 1}
    )
    (folder / "1.txt").write_text(rule(3, "MAX") + "\n" + rule(0, "SUM") + "\nnonsense\n" + rule(6, "SUM", "PAUSE") + "\n")
    for k in range(8):
        source.add(("t", "a", 2**k, k))
    stream = indicators_from_lines(stream_lines(spark, str(tmp_path / "in"))).withColumn("seq", F.col("event_ms"))
    source.run(asof_partials(stream, live_changes(spark, str(folder)), small_rules=True))
    got = source.results()
    assert got == {(1, ("a",), 0, "v-SUM"): 63, (1, ("a",), 0, "v-MAX"): 32}


def test_a_command_clears_the_state_of_a_running_stream(source, spark, tmp_path):
    folder, path = tmp_path / "rules", str(source.root / "out")
    folder.mkdir()
    (folder / "1.txt").write_text("1,t,active,k,v:sum,1\n2,t,active,,v:sum,1\n")
    parts = update_partials(source.stream(), live_rules(spark, str(folder)), small_rules=True)
    running = start(parts, path, str(source.root / "checkpoint"), trigger={"processingTime": "0 seconds"})
    command = '{"ruleState": "CONTROL", "controlType": "CLEAR_STATE_ALL"}\n'
    try:
        source.add(("t", "a", 1, 10), ("t", "b", 2, 10))
        running.processAllAvailable()
        assert len(source.results()) == 3 and current_epoch(spark, str(folder)) == 0
        (folder / "2.txt").write_text(command)
        assert live_results(spark, path, current_epoch(spark, str(folder))).count() == 0
        source.add(("t", "a", 4, 20))
        running.processAllAvailable()
        assert source.results() == {(1, ("a",), 0, "v-SUM"): 4, (2, (), 0, "v-SUM"): 4}
        compact_parts(spark, path)
        assert source.results() == {(1, ("a",), 0, "v-SUM"): 4, (2, (), 0, "v-SUM"): 4}
        (folder / "3.txt").write_text(command)
        source.add(("t", "c", 8, 30))
        source.add(("t", "c", 8, 40))
        running.processAllAvailable()
    finally:
        running.stop()
    assert source.results() == {(1, ("c",), 0, "v-SUM"): 16, (2, (), 0, "v-SUM"): 16}


def test_a_rollup_makes_changed_windows_anew_and_reads_no_others(source, spark, rules, tmp_path):
    some, path, target = rules("1,t,active,k,v:sum&v:max,10", "2,t,active,,v:sum,10"), str(source.root / "out"), str(tmp_path / "days")

    def days():
        return {(r.grouping_values[0], r.window_start_ms // DAY, r.metric): float(r.value) for r in read_rollup(spark, target).collect()}

    source.add(("t", "a", 1, 5), ("t", "a", 2, 11 * MINUTE), ("t", "b", 4, 3 * DAY))
    source.run(update_partials(source.stream(), some, None))
    assert update_rollup(spark, path, target, 1440) == [0, 3 * DAY] and update_rollup(spark, path, target, 1440) == []
    assert days() == {("a", 0, "v-SUM"): 3, ("a", 0, "v-MAX"): 2, ("b", 3, "v-SUM"): 4, ("b", 3, "v-MAX"): 4}
    first = list((tmp_path / "days" / "fine").glob("*/coarse=0/*.parquet"))
    for file in first:  # an unreadable file of a day that nothing touches
        file.write_bytes(b"")
    source.add(("t", "b", 8, 3 * DAY + 1), ("t", "c", 16, 4 * DAY))
    source.run(update_partials(source.stream(), some, None))
    assert first and update_rollup(spark, path, target, 1440) == [3 * DAY, 4 * DAY]
    assert days() == {
        ("a", 0, "v-SUM"): 3, ("a", 0, "v-MAX"): 2, ("b", 3, "v-SUM"): 12, ("b", 3, "v-MAX"): 8, ("c", 4, "v-SUM"): 16, ("c", 4, "v-MAX"): 16,
    }


def test_latency_of_several_batches(source, spark, rules, tmp_path):
    some = rules("1,t,active,k,v:sum,1", "2,t,active,k,v:sum,7")
    stream = source.stream().withColumn("ingestion_time", F.col("event_time"))
    now = F.timestamp_millis(F.col("event_ms") + F.col("fields")["v"].cast("bigint"))
    for n in range(3):
        source.add(*[("t", "a", v, n * MINUTE) for v in range(n * 100, n * 100 + 100)])
        start_latency(stream, some, str(tmp_path / "latency"), str(tmp_path / "check"), now=now).awaitTermination()
    got = {r.rule_id: r for r in read_latency(spark, str(tmp_path / "latency")).collect()}
    assert got.keys() == {1, 2} and got[1].events == 300 and (got[2].min_ms, got[2].max_ms, got[2].avg_ms) == (0, 299, 149.5)
    assert abs(got[1].p50_ms - 150) <= 6 and abs(got[2].p99_ms - 297) <= 6
    part = read_latency(spark, str(tmp_path / "latency"), MINUTE, 2 * MINUTE).where("rule_id = 1").first()
    assert (part.events, part.min_ms, part.max_ms) == (100, 100, 199)
