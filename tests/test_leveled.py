"""Results in bucketed runs: the latest version holds, whatever has been merged, and nothing is shuffled to read it."""

import uuid
from decimal import Decimal

import pytest

from tallyloom.model import RESULTS
from tallyloom.operators.leveled import LeveledResults, Run


@pytest.fixture
def kept(spark):
    made = LeveledResults(spark, f"t_{uuid.uuid4().hex}", buckets=3, fanout=2)
    yield made
    made.drop()


def batch(spark, *rows):
    return spark.createDataFrame(
        [(rule, "T", ["k"], [k], 0, 60_000, metric, Decimal(value), 0, None) for rule, k, metric, value in rows], RESULTS
    )


def held(kept):
    rows = [((r.rule_id, r.grouping_values[0], r.metric), int(r.value)) for r in kept.read().collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_the_latest_version_holds(spark, kept):
    assert held(kept) == {}
    want = {}
    for number in range(7):
        rows = [(1, f"k{number + j}", m, 10 * number + j) for j in range(3) for m in ("v-SUM", "v-MAX")] + [(2, "k0", "v-SUM", number)]
        kept.add(batch(spark, *rows), number)
        want |= {(rule, k, m): v for rule, k, m, v in rows}
        assert held(kept) == want
    assert kept.runs() == [Run(2, 0, 3), Run(1, 4, 5), Run(0, 6, 6)]
    kept.add(batch(spark, (1, "k0", "v-SUM", 99)), 2)  # merged long ago: a repeated batch changes nothing
    assert held(kept) == want
    kept.add(batch(spark, (1, "k6", "v-SUM", 7)), 6)  # not merged yet: it replaces its run
    assert held(kept)[(1, "k6", "v-SUM")] == 7 and (1, "k8", "v-SUM") not in held(kept)


def test_runs_that_a_failed_merge_left_are_not_read(spark, kept):
    kept.add(batch(spark, (1, "a", "v-SUM", 1)), 0)
    kept._write(kept.spark.table(kept._table(Run(0, 0, 0))), Run(1, 0, 1))
    kept._write(kept.spark.table(kept._table(Run(0, 0, 0))), Run(0, 1, 1))
    assert kept.runs() == [Run(1, 0, 1)] and held(kept) == {(1, "a", "v-SUM"): 1}
    kept.add(batch(spark, (1, "a", "v-SUM", 3)), 2)
    assert sorted(kept._all()) == sorted(kept.runs()) == [Run(0, 2, 2), Run(1, 0, 1)] and held(kept) == {(1, "a", "v-SUM"): 3}


def test_a_read_has_no_exchange(spark, kept):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for number in range(5):
            kept.add(batch(spark, *[(1, f"k{j}", "v-SUM", number) for j in range(20)]), number)
        plan = kept.read()._jdf.queryExecution().executedPlan().toString()
        assert len(kept.runs()) == 2 and "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
