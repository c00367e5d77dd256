"""Rule queries: parsing, checks, change feed, commands, versions."""

from pyspark.sql import functions as F

from tallyloom.operators.aggregate import finish, partials
from tallyloom.operators.fork import fork
from tallyloom.operators.rules import (
    clear_state, export_rules, flag_rules, fold_changes, rule_counts,
)
from tallyloom.plans.catalogue import (
    EV, event_indicators, events, flat, query, rule_lines, sql_rule, table,
)
from tallyloom.plans.evaluate import evaluate, replay
from tallyloom.sources.json_rows import to_json_rows
from tallyloom.sources.rules import changed_rows, parse_rules, rules_from_table, unusable, usable


def readable(rules):
    """Rules in plain columns."""
    specs = F.transform("aggs", lambda a: F.concat(a["field"], F.lit(":"), a["func"]))
    return rules.select(
        "rule_id",
        "table_name",
        "rule_state",
        F.array_join("grouping_keys", "&").alias("grouping_keys"),
        F.array_join(specs, "&").alias("aggs"),
        "window_minutes",
    )


_CUSTOMER_RULES = """SELECT CAST(c_custkey AS INTEGER) AS rule_id, c_mktsegment AS table_name,
  CASE WHEN c_acctbal < 0 THEN 'PAUSE' ELSE 'ACTIVE' END AS rule_state,
  'host&' || c_name AS grouping_keys, 'c_acctbal:SUM&c_acctbal:MAX&nation:AVG' AS aggs,
  CAST(c_nationkey + 1 AS INTEGER) AS window_minutes FROM customer"""


@query("rules_parse_plain", _CUSTOMER_RULES)
def rules_parse_plain(spark, sf_dir):
    state = F.when(F.col("c_acctbal") < 0, F.lit("pause")).otherwise(F.lit("Active"))
    lines = table(spark, sf_dir, "customer").select(
        F.concat_ws(
            ",", "c_custkey", "c_mktsegment", state, F.concat(F.lit("host&"), "c_name"),
            F.lit("c_acctbal:sum&c_acctbal:Max&&c_acctbal:sum&nation:avg"), F.col("c_nationkey") + 1,
        ).alias("line")
    )
    return readable(usable(parse_rules(lines)))


@query("rules_parse_json", _CUSTOMER_RULES)
def rules_parse_json(spark, sf_dir):
    pair = lambda field, func: F.struct(F.lit(field).alias("f0"), F.lit(func).alias("f1"))
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ruleId"),
        F.col("c_mktsegment").alias("tableName"),
        F.when(F.col("c_acctbal") < 0, "PAUSE").otherwise("ACTIVE").alias("ruleState"),
        F.array(F.lit("host"), F.col("c_name")).alias("groupingKeyNames"),
        F.array(pair("c_acctbal", "SUM"), pair("c_acctbal", "MAX"), pair("nation", "AVG")).alias("aggFields"),
        (F.col("c_nationkey") + 1).alias("windowMinutes"),
        F.lit("ignored").alias("unique"),
    )
    return readable(usable(parse_rules(to_json_rows(rows, "line"))))


@query(
    "rules_rejects",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'part count' WHEN 'view' THEN 'bad id'
  WHEN 'error' THEN 'bad state' WHEN 'purchase' THEN 'bad aggregate' ELSE 'bad window' END AS error FROM events""",
)
def rules_rejects(spark, sf_dir):
    """A rule line per event, wrong in a way that depends on its type."""
    kind = F.col("event_type")
    pick = lambda bad_kind, bad, good: F.when(kind == bad_kind, F.lit(bad)).otherwise(good)
    lines = events(spark, sf_dir).select(
        "event_id",
        F.concat_ws(
            ",",
            pick("view", "x", F.col("event_id").cast("string")),
            kind,
            pick("error", "asleep", F.lit("active")),
            F.lit("user_id"),
            pick("purchase", "value", F.lit("value:sum")),
            F.when(kind == "signup", F.lit("0")).when(kind != "click", F.lit("60")),
        ).alias("line"),
    )
    return unusable(parse_rules(lines)).select("event_id", "error")


@query(
    "rules_table_checks",
    """SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'no aggregates' WHEN p_type = 'SMALL' THEN 'no table'
  ELSE 'usable' END AS outcome FROM part""",
)
def rules_table_checks(spark, sf_dir):
    """Typed rule table rows; a NULL grouping column is no grouping, not the text null."""
    kind = F.col("p_type")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("int").alias("id"),
        F.when(kind != "SMALL", F.col("p_brand")).alias("table_name"),
        F.lit("active").alias("rule_state"),
        F.lit(None).cast("string").alias("grouping_key_names"),
        F.when(kind != "ECONOMY", F.lit("p_size:sum")).alias("agg_fields"),
        F.col("p_size").cast("bigint").alias("window_minutes"),
    )
    checked = rules_from_table(rows)
    no_keys = F.when(F.size("grouping_keys") == 0, "usable").otherwise("grouped")
    return checked.select("p_partkey", F.coalesce("error", no_keys).alias("outcome"))


def change_feed(spark, sf_dir):
    """A change record per event: rule = user, what happens by event type."""
    kind = F.col("event_type")
    op = F.when(kind == "click", "c").when(kind == "signup", "d").otherwise("u")
    state = F.when(kind == "error", "pause").when(kind == "purchase", "delete").otherwise("active")
    after = F.struct(
        F.col("user_id").cast("int").alias("id"),
        kind.alias("table_name"),
        state.alias("rule_state"),
        F.lit("user_id").alias("grouping_key_names"),
        F.lit("value:sum&k:max").alias("agg_fields"),
        (F.col("k").cast("bigint") + 1).alias("window_minutes"),
    )
    return events(spark, sf_dir).select(F.col("event_id").alias("seq"), op.alias("op"), after.alias("after"))


_FEED = f"""{EV}, feed AS (SELECT event_id AS seq, CAST(user_id AS INTEGER) AS rule_id, event_type AS table_name,
  CASE event_type WHEN 'error' THEN 'PAUSE' WHEN 'purchase' THEN 'DELETE' ELSE 'ACTIVE' END AS rule_state,
  'user_id' AS grouping_keys, 'value:SUM&k:MAX' AS aggs, CAST(k + 1 AS INTEGER) AS window_minutes
  FROM ev WHERE event_type <> 'signup')"""

FOLDED_SQL = f"""WITH {_FEED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY seq DESC) AS rn FROM feed)
SELECT rule_id, table_name, rule_state, grouping_keys, aggs, window_minutes FROM ranked
WHERE rn = 1 AND rule_state <> 'DELETE'"""


def _current_rules(spark, sf_dir):
    return fold_changes(usable(rules_from_table(changed_rows(change_feed(spark, sf_dir)))))


@query("rules_fold_changes", FOLDED_SQL)
def rules_fold_changes(spark, sf_dir):
    return readable(_current_rules(spark, sf_dir))


@query("rules_export", FOLDED_SQL)
def rules_export(spark, sf_dir):
    """The current rules written as JSON and read back."""
    exported = export_rules(_current_rules(spark, sf_dir)).select(F.col("json").alias("line"))
    return readable(usable(parse_rules(exported)))


@query(
    "active_rules",
    f"WITH folded AS ({FOLDED_SQL}) SELECT count(*) AS rules, count(*) FILTER (rule_state = 'ACTIVE') AS active_rules FROM folded",
)
def active_rules(spark, sf_dir):
    return rule_counts(_current_rules(spark, sf_dir))


def _commands(spark, sf_dir, command):
    """Change records with commands among them, every so often in the first two fifths of the events."""
    feed = usable(rules_from_table(changed_rows(change_feed(spark, sf_dir))))
    seen = events(spark, sf_dir)
    cut = seen.agg(F.call_function("div", F.max("event_id") * 2, F.lit(5))).scalar()
    at = seen.filter((F.col("event_id") <= cut) & ((F.col("event_id") == cut) | (F.col("event_id") % 97 == 0))).select("event_id")
    commands = at.select(
        F.col("event_id").alias("seq"),
        F.lit(None).cast("int").alias("id"),
        F.lit(None).cast("string").alias("table_name"),
        F.lit("CONTROL").alias("rule_state"),
        F.lit(None).cast("string").alias("grouping_key_names"),
        F.lit(None).cast("string").alias("agg_fields"),
        F.lit(None).cast("bigint").alias("window_minutes"),
        F.lit(command).alias("control_type"),
    )
    return feed.unionByName(usable(rules_from_table(commands)))


@query(
    "rules_delete_all",
    f"""WITH {_FEED}, cut AS (SELECT max(event_id) AS seq FROM events WHERE event_id <= (SELECT max(event_id) * 2 // 5 FROM events)),
ranked AS (SELECT feed.*, row_number() OVER (PARTITION BY rule_id ORDER BY feed.seq DESC) AS rn
  FROM feed, cut WHERE cut.seq IS NULL OR feed.seq > cut.seq)
SELECT rule_id, table_name, rule_state, grouping_keys, aggs, window_minutes FROM ranked
WHERE rn = 1 AND rule_state <> 'DELETE'""",
)
def rules_delete_all(spark, sf_dir):
    return readable(fold_changes(_commands(spark, sf_dir, "DELETE_RULES_ALL")))


_KINDS = ["click", "view", "error", "purchase", "signup"]
_CLEARED = " UNION ALL ".join(
    sql_rule(
        i, kind, ["user_id"], [("value", "SUM"), ("value", "COUNT")], 60,
        f"event_type = '{kind}' AND event_id > (SELECT max(event_id) * 2 // 5 FROM events)",
    )
    for i, kind in enumerate(_KINDS)
)


CLEARED_SQL = f"WITH {EV} {_CLEARED}"
CLEARED_RULES = [f"{i},{kind},active,user_id,value:sum&value:count,60" for i, kind in enumerate(_KINDS)]


@query("state_clear_all", CLEARED_SQL)
def state_clear_all(spark, sf_dir):
    changes = _commands(spark, sf_dir, "CLEAR_STATE_ALL")
    seen = event_indicators(spark, sf_dir).withColumn("seq", F.col("event_id"))
    return flat(finish(partials(fork(clear_state(seen, changes), rule_lines(spark, *CLEARED_RULES)))))


@query(
    "rows_of_missing_rules",
    f"""WITH folded AS ({FOLDED_SQL})
SELECT event_id, CAST(user_id AS INTEGER) AS rule_id,
  CASE WHEN user_id IN (SELECT rule_id FROM folded) THEN 'kept' ELSE 'dropped' END AS outcome FROM events""",
)
def rows_of_missing_rules(spark, sf_dir):
    """Rows keyed by a rule that has been deleted since, told from those whose rule is there."""
    keyed = events(spark, sf_dir).select("event_id", F.col("user_id").cast("int").alias("rule_id"))
    rules = _current_rules(spark, sf_dir)
    return flag_rules(keyed, rules).select(
        "event_id", "rule_id", F.when(F.col("has_rule"), "kept").otherwise("dropped").alias("outcome")
    )


_TWICE = [
    # seq, rule line: versions of one rule that were never folded; the last one counts
    (1, "1,click,active,k,value:max,10"), (2, "1,click,active,user_id,value:sum&value:count,60"),
    (3, "1,click,active,user_id,value:sum&value:count,60"), (1, "2,view,pause,user_id,value:sum,60"),
    (2, "2,view,active,user_id&k,value:sum,1440"), (1, "3,error,active,user_id,value:count,60"),
    (2, "3,error,active,user_id,value:count,60"), (1, "4,purchase,active,user_id,value:sum,60"),
    (2, "4,purchase,delete,user_id,value:sum,60"), (1, "5,signup,active,k,value:min&value:max,30"),
    (2, "6,purchase,active,k,value:avg,60"),
]


@query(
    "rules_duplicate_ids",
    f"WITH {EV} "
    + " UNION ALL ".join(
        [
            sql_rule(1, "click", ["user_id"], [("value", "SUM"), ("value", "COUNT")], 60, "event_type = 'click'"),
            sql_rule(2, "view", ["user_id", "k"], [("value", "SUM")], 1440, "event_type = 'view'"),
            sql_rule(3, "error", ["user_id"], [("value", "COUNT")], 60, "event_type = 'error'"),
            sql_rule(5, "signup", ["k"], [("value", "MIN"), ("value", "MAX")], 30, "event_type = 'signup'"),
            sql_rule(6, "purchase", ["k"], [("value", "AVG")], 60, "event_type = 'purchase'"),
        ]
    ),
)
def rules_duplicate_ids(spark, sf_dir):
    """Rules that come in several versions: each id is one rule, the last one."""
    lines = spark.createDataFrame(_TWICE, "seq bigint, line string")
    rules = usable(parse_rules(lines)).drop("line")
    return flat(evaluate(event_indicators(spark, sf_dir), rules))


@query(
    "rules_table_out_of_range",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'bad id' WHEN 1 THEN 'bad window' ELSE 'usable' END AS outcome
  FROM part""",
)
def rules_table_out_of_range(spark, sf_dir):
    """Rule rows with numbers that do not fit: each is rejected alone."""
    third = F.col("p_partkey") % 3
    far = F.lit(3_000_000_000)
    rows = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(third == 0, F.col("p_partkey") + far).otherwise(F.col("p_partkey")).alias("id"),
        F.col("p_brand").alias("table_name"),
        F.lit("active").alias("rule_state"),
        F.col("p_type").alias("grouping_key_names"),
        F.lit("p_size:sum").alias("agg_fields"),
        F.when(third == 1, far).otherwise(F.col("p_size").cast("bigint")).alias("window_minutes"),
    )
    return rules_from_table(rows).select("p_partkey", F.coalesce("error", F.lit("usable")).alias("outcome"))


_CHANGES = [
    # when, as a tenth of the events; rule line
    (-1, "1,click,active,user_id,value:sum&value:count,60"),
    (2, "1,click,pause,user_id,value:sum&value:count,60"),
    (4, "1,click,active,user_id&k,value:sum&value:max,10"),
    (-1, "2,view,active,user_id,value:avg,1440"),
    (7, "2,view,delete,user_id,value:avg,1440"),
    (3, "3,click,active,user_id,k:sum,60"),
    (-1, "4,error,active,user_id,value:max,60"),
    (5, "4,error,active,user_id,value:min,30"),
    (-1, "5,purchase,active,k,value:sum,1440"),
    (6, "6,signup,active,user_id,value:count,60"),
    (9, "6,signup,pause,user_id,value:count,60"),
]
_TENTH = "(SELECT max(event_id) + 1 FROM events) * {} // 10"


def _during(kind, low=None, high=None):
    since = f" AND event_id >= {_TENTH.format(low)}" if low is not None else ""
    until = f" AND event_id < {_TENTH.format(high)}" if high is not None else ""
    return f"event_type = '{kind}'{since}{until}"


ASOF_SQL = (
    f"WITH {EV} "
    + " UNION ALL ".join(
        [
            sql_rule(1, "click", ["user_id"], [("value", "SUM"), ("value", "COUNT")], 60, _during("click", high=2)),
            sql_rule(1, "click", ["user_id", "k"], [("value", "SUM"), ("value", "MAX")], 10, _during("click", low=4)),
            sql_rule(2, "view", ["user_id"], [("value", "AVG")], 1440, _during("view", high=7)),
            sql_rule(3, "click", ["user_id"], [("k", "SUM")], 60, _during("click", low=3)),
            sql_rule(4, "error", ["user_id"], [("value", "MAX")], 60, _during("error", high=5)),
            sql_rule(4, "error", ["user_id"], [("value", "MIN")], 30, _during("error", low=5)),
            sql_rule(5, "purchase", ["k"], [("value", "SUM")], 1440, _during("purchase")),
            sql_rule(6, "signup", ["user_id"], [("value", "COUNT")], 60, _during("signup", 6, 9)),
        ]
    )
)


def rule_changes(spark, seen):
    """The changes of the list above at tenths of the events, each with its ``seq``."""
    events_seen = seen.agg(F.max("seq") + 1).scalar()
    lines = spark.createDataFrame(_CHANGES, "tenth int, line string")
    lines = lines.select(
        F.when(F.col("tenth") < 0, F.lit(-1)).otherwise(F.call_function("div", events_seen * F.col("tenth"), F.lit(10))).alias("seq"),
        "line",
    )
    return usable(parse_rules(lines)).drop("line")


@query("asof_rules", ASOF_SQL)
def asof_rules(spark, sf_dir):
    """All events against rules that change on the way: a pause, edits, a delete, late starts."""
    seen = event_indicators(spark, sf_dir).withColumn("seq", F.col("event_id"))
    return flat(replay(seen, rule_changes(spark, seen)))
