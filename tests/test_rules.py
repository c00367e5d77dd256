"""Rule parsing, checks, folding, export."""

import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.rules import export_rules, fold_changes, rule_counts
from tallyloom.sources.rules import changed_rows, parse_rules, rules_from_table, unusable, usable
from tallyloom.sources.topics import topic_options


def parse(spark, line):
    return parse_rules(spark.createDataFrame([(line,)], "line string")).first()


def test_plain_rule(spark):
    row = parse(
        spark,
        "1,esb_as_ProcBizFuncLibs,active,host&monitorKey,"
        "cur_excCount:sum&cur_excCount:max&cur_excCount:min,10",
    )
    assert row.error is None
    assert (row.rule_id, row.rule_state, row.grouping_keys, row.window_minutes) == (1, "ACTIVE", ["host", "monitorKey"], 10)
    assert [a.func for a in row.aggs] == ["SUM", "MAX", "MIN"]


def test_json_rule_with_unknown_members(spark):
    line = json.dumps(
        {"ruleId": 1, "ruleState": "ACTIVE", "groupingKeyNames": ["taxiId", "driverId"], "unique": [],
         "limit": 50, "windowMinutes": 20},
        indent=2,
    )
    row = parse(spark, line)
    assert (row.rule_id, row.rule_state, row.grouping_keys, row.window_minutes) == (1, "ACTIVE", ["taxiId", "driverId"], 20)
    assert row.error == "no table"


def test_json_rule_in_full(spark):
    line = json.dumps(
        {"ruleId": 4, "tableName": "t", "ruleState": "ACTIVE", "groupingKeyNames": [],
         "aggFields": [{"f0": "v", "f1": "AVG"}, {"f0": "v", "f1": "AVG"}], "windowMinutes": 5}
    )
    row = parse(spark, line)
    assert row.error is None and len(row.aggs) == 1 and row.grouping_keys == []


@pytest.mark.parametrize(
    "line, error",
    [
        ("1,t,active,k,v:sum", "part count"),
        ("1,t,active,k,v:sum,", "part count"),
        ("1,t,active,k,v:sum,10,x", "part count"),
        ("", "part count"),
        (None, "part count"),
        ("x,t,active,k,v:sum,10", "bad id"),
        (" 1,t,active,k,v:sum,10", "bad id"),
        ("1,t,foo,k,v:sum,10", "bad state"),
        ("1,t,active,k,v,10", "bad aggregate"),
        ("1,t,active,k,v:median,10", "bad aggregate"),
        ("1,t,active,k,v:sum,0", "bad window"),
        ("1,t,active,k,v:sum,ten", "bad window"),
        ("1,t,active,k,,10", "no aggregates"),
        ("1,t,active,,v:SUM:extra&,10", None),
        ("2,t,delete,,,0", None),
        ('{"ruleId": "x"', "bad json"),
        ('{"ruleState": "CONTROL", "controlType": "DELETE_RULES_ALL"}', None),
        ('{"ruleState": "CONTROL", "controlType": "REBOOT"}', "bad control"),
        ('{"ruleState": "ACTIVE"}', "bad id"),
        ('{"ruleId": 1, "ruleState": "active"}', "bad state"),
    ],
)
def test_rule_checks(spark, line, error):
    assert parse(spark, line).error == error


def test_null_grouping_in_a_table_is_no_grouping(spark):
    table = spark.createDataFrame(
        [(1, "t", "active", None, "v:sum&v:sum", 10)],
        "id int, table_name string, rule_state string, grouping_key_names string, agg_fields string, window_minutes bigint",
    )
    row = rules_from_table(table).first()
    assert row.error is None and row.grouping_keys == [] and len(row.aggs) == 1


def changes(spark, *rows):
    frame = spark.createDataFrame(list(rows), "seq bigint, line string")
    return usable(parse_rules(frame)).drop("line")


def test_last_change_wins_and_delete_removes(spark):
    log = changes(
        spark,
        (1, "1,t,active,k,v:sum,10"), (2, "2,t,active,k,v:sum,10"), (3, "1,t,pause,k,v:max,20"),
        (4, "2,t,delete,k,v:sum,10"), (5, "3,t,delete,k,v:sum,10"),
    )
    rows = fold_changes(log).collect()
    assert [(r.rule_id, r.rule_state, r.window_minutes) for r in rows] == [(1, "PAUSE", 20)]


def test_physical_delete_is_ignored(spark):
    row = "struct<id:int,table_name:string,rule_state:string,grouping_key_names:string,agg_fields:string,window_minutes:bigint>"
    after = (1, "t", "active", "k", "v:sum", 10)
    log = spark.createDataFrame([(1, "c", after), (2, "d", None)], f"seq bigint, op string, after {row}")
    rows = fold_changes(usable(rules_from_table(changed_rows(log)))).collect()
    assert [r.rule_id for r in rows] == [1]


def test_delete_all_command(spark):
    log = changes(
        spark,
        (1, "1,t,active,k,v:sum,10"),
        (2, '{"ruleState": "CONTROL", "controlType": "DELETE_RULES_ALL"}'),
        (3, "2,t,active,k,v:sum,10"),
        (4, '{"ruleState": "CONTROL", "controlType": "CLEAR_STATE_ALL"}'),
    )
    assert [r.rule_id for r in fold_changes(log).collect()] == [2]


def test_export_reads_back(spark, rules):
    some = rules("1,t,active,k1&k2,v:sum&w:avg,10", "2,t,pause,,v:max,5")
    back = usable(parse_rules(export_rules(some).select(F.col("json").alias("line")))).drop("line")
    order = lambda df: sorted(map(str, df.collect()))
    assert order(back) == order(some)


def test_rule_counts(rules):
    row = rule_counts(rules("1,t,active,,v:sum,10", "2,t,pause,,v:max,5")).first()
    assert (row.rules, row.active_rules) == (2, 1)


def test_topic_options():
    assert topic_options("h", 9092, "t") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
    }
