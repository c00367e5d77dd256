"""The physical plans that make the evaluation fit for large inputs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers every query
from tallyloom.operators.aggregate import finish, partials
from tallyloom.operators.fork import fork
from tallyloom.operators.running import running_values
from tallyloom.plans.catalogue import QUERIES, event_indicators, rule_lines, table
from tallyloom.plans.evaluate import evaluate_table
from tallyloom.sources.tables import spread

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events_side(text):
    """The plan without what is below a broadcast: the rules, which are few."""
    kept, below = [], None
    for line in text.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*"))
        if below is not None and depth > below:
            continue
        below = depth if "BroadcastExchange" in line else None
        kept.append(line)
    return "\n".join(kept)


def test_evaluation_is_one_shuffle_of_partial_hash_aggregates(spark, rules):
    text = events_side(plan(finish(partials(fork(event_indicators(spark, FOLDER), rules("1,click,active,user_id,value:sum,60"))))))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "ObjectHash" not in text
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_fields_of_a_rule_stand_side_by_side_under_a_narrow_key(spark, rules):
    lines = table(spark, FOLDER, "lineitem")
    some = rules("1,li,active,l_suppkey,l_quantity:sum&l_tax:max,60", "2,li,active,l_linestatus,l_tax:avg,60")
    columns = ["l_suppkey", "l_linestatus", "l_quantity", "l_tax"]
    done = evaluate_table(lines, F.lit("li"), "l_shipdate", columns, some)
    exchange = [x for x in events_side(plan(done)).split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchange) == 1
    assert not [x for x in ("table_name", "grouping_keys", "field") if x in exchange[0]]
    text = events_side(plan(done))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "ObjectHash" not in text


def test_only_needed_columns_are_read(spark, rules):
    lines = table(spark, FOLDER, "lineitem")
    done = evaluate_table(
        lines, F.lit("li"), "l_shipdate", ["l_suppkey", "l_quantity"], rules("1,li,active,l_suppkey,l_quantity:sum,60")
    )
    text = plan(done)
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_rules_beyond_the_bound_are_shuffled(spark, rules):
    text = plan(fork(event_indicators(spark, FOLDER), rules("1,click,active,user_id,value:sum,60"), small_rules=False))
    assert "ShuffledHashJoin" in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_query_multiplies_rows(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_running_values_shuffle_the_rows_once(spark, rules):
    done = running_values(
        fork(event_indicators(spark, FOLDER), rules("1,click,active,user_id,value:sum,60")), "event_id"
    )
    done.write.format("noop").mode("overwrite").save()
    text = events_side(plan(done))
    assert text.count("REPARTITION_BY_COL") <= 2 and "RDDScan" not in text and "rangepartitioning" not in text


def test_small_inputs_are_dealt_out_and_large_ones_left_alone(spark):
    lines = table(spark, FOLDER, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    assert spread(lines).rdd.getNumPartitions() == cores
    assert spread(lines).count() == lines.count()
    wide = spark.range(0, 1000, 1, cores * 2)
    assert spread(wide) is wide
