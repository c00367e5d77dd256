"""Evaluation queries: fork, windows, aggregates, look-ups, documents."""

import uuid

from pyspark.sql import functions as F

from tallyloom.functions.keys import doc_id
from tallyloom.functions.windows import MINUTE_MS, epoch_ms, window_start
from tallyloom.operators.aggregate import (
    distinct_counts, distinct_values, finish, last_event, long_average, merge, metric_map, partials,
)
from tallyloom.operators.documents import addressed, document_json, documents, latest
from tallyloom.operators.fork import fork
from tallyloom.operators.health import event_rate
from tallyloom.operators.leveled import LeveledResults
from tallyloom.operators.lookup import widen
from tallyloom.operators.running import lookback_values, running_values
from tallyloom.operators.thresholds import over_limit
from tallyloom.plans.catalogue import (
    EV, event_indicators, events, flat, query, rule_lines, sql_aggregate, sql_rule, sql_running, table,
)
from tallyloom.plans.evaluate import evaluate, evaluate_table
from tallyloom.session import materialise
from tallyloom.sources.tables import indicators_from_table, spread

TYPES = ["click", "view", "error", "purchase", "signup"]

# --- fork, keys, windows ------------------------------------------------------------------

_FORK_RULES = [
    "1,click,active,user_id,value:sum,60",
    "2,view,active,user_id&k,value:sum&k:max,10",
    "3,purchase,pause,user_id,value:sum,60",
    "4,error,active,user_id,nosuch:sum,60",
    "5,error,active,zone&user_id,value:max,1440",
    "6,signup,delete,user_id,value:max,1440",
    "7,click,active,k,k:avg,30",
]


@query(
    "fork_match",
    f"""WITH {EV} SELECT CAST(rule_id AS INTEGER) AS rule_id, table_name, count(*) AS n FROM (
  SELECT 1 AS rule_id, event_type AS table_name FROM ev WHERE event_type = 'click'
  UNION ALL SELECT 2, event_type FROM ev WHERE event_type = 'view'
  UNION ALL SELECT 5, event_type FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 7, event_type FROM ev WHERE event_type = 'click') GROUP BY 1, 2""",
)
def fork_match(spark, sf_dir):
    forked = fork(event_indicators(spark, sf_dir), rule_lines(spark, *_FORK_RULES))
    return forked.groupBy("rule_id", "table_name").agg(F.count(F.lit(1)).alias("n"))


def _sql_key(rule_id, kind, keys, minutes):
    size = minutes * 60000
    start = f"(ms - ms % {size})"
    values = " || '-' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys)
    return (
        f"SELECT event_id, CAST({rule_id} AS INTEGER) AS rule_id, "
        f"'{{' || {values} || '-' || {start} || '-' || ({start} + {size}) || '}}' AS doc_id "
        f"FROM ev WHERE event_type = '{kind}'"
    )


@query(
    "group_key",
    f"WITH {EV} "
    + " UNION ALL ".join(
        [
            _sql_key(1, "click", ["user_id"], 60),
            _sql_key(2, "view", ["user_id", "k"], 10),
            _sql_key(5, "error", ["NULL", "user_id"], 1440),
            _sql_key(7, "click", ["k"], 30),
        ]
    ),
)
def group_key(spark, sf_dir):
    forked = fork(event_indicators(spark, sf_dir), rule_lines(spark, *_FORK_RULES))
    key = doc_id(F.col("grouping_values"), F.col("window_start_ms"), F.col("window_end_ms"))
    return forked.select("event_id", "rule_id", key.alias("doc_id"))


@query(
    "window_assign",
    f"WITH {EV} SELECT event_id, ms - ms % 60000 AS start_1, ms - ms % 600000 AS start_10, "
    "ms - ms % 5400000 AS start_90, ms - ms % 86400000 AS start_1440 FROM ev",
)
def window_assign(spark, sf_dir):
    ms = epoch_ms(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        *[window_start(ms, F.lit(m * MINUTE_MS)).alias(f"start_{m}") for m in (1, 10, 90, 1440)],
    )


# --- one function at a time, then all together --------------------------------------------


def _register_metric(func):
    sql = " UNION ALL ".join(
        sql_rule(i, kind, ["user_id"], [("value", func), ("k", func)], 60, f"event_type = '{kind}'")
        for i, kind in enumerate(TYPES)
    )

    @query(f"metric_{func.lower()}", f"WITH {EV} {sql}")
    def run(spark, sf_dir):
        lines = [f"{i},{kind},active,user_id,value:{func}&k:{func},60" for i, kind in enumerate(TYPES)]
        return flat(evaluate(event_indicators(spark, sf_dir), rule_lines(spark, *lines)))


for _func in ("SUM", "COUNT", "MIN", "MAX", "AVG"):
    _register_metric(_func)

MULTI_RULES = [
    "1,click,active,user_id,value:sum&value:avg&value:max&value:min&value:count&k:sum,60",
    "2,view,active,user_id&k,value:sum&value:count,10",
    "3,purchase,pause,user_id,value:sum,60",
    "4,error,active,user_id,nosuch:sum,60",
    "5,signup,active,,value:sum&value:avg,1440",
    "6,error,active,zone&user_id,value:max&k:avg,1440",
    "7,click,active,user_id,value:sum&k:max,60",
    "8,signup,active,k,value:avg&k:count,720",
]
KEYED_SQL = " UNION ALL ".join(
    [
        sql_rule(1, "click", ["user_id"], [("value", f) for f in ("SUM", "AVG", "MAX", "MIN", "COUNT")] + [("k", "SUM")], 60, "event_type = 'click'"),
        sql_rule(2, "view", ["user_id", "k"], [("value", "SUM"), ("value", "COUNT")], 10, "event_type = 'view'"),
        sql_rule(6, "error", ["NULL", "user_id"], [("value", "MAX"), ("k", "AVG")], 1440, "event_type = 'error'"),
        sql_rule(7, "click", ["user_id"], [("value", "SUM"), ("k", "MAX")], 60, "event_type = 'click'"),
        sql_rule(8, "signup", ["k"], [("value", "AVG"), ("k", "COUNT")], 720, "event_type = 'signup'"),
    ]
)
RUNNING_SQL = sql_running(5, "signup", [("value", "SUM"), ("value", "AVG")], 1440, "event_type = 'signup'")


@query("multi_rule_eval", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def multi_rule_eval(spark, sf_dir):
    """The flagship: several rules over all events, with a pause, a missing field, no keys."""
    return flat(evaluate(event_indicators(spark, sf_dir), rule_lines(spark, *MULTI_RULES)))


_GLOBAL_RULES = [
    f"{i},{kind},active,,value:sum&value:count&value:min&value:max&k:avg,{minutes}"
    for i, (kind, minutes) in enumerate(zip(TYPES, (60, 10, 1440, 90, 720)))
]
_GLOBAL_SPECS = [("value", "SUM"), ("value", "COUNT"), ("value", "MIN"), ("value", "MAX"), ("k", "AVG")]


@query(
    "global_running",
    f"WITH {EV} "
    + " UNION ALL ".join(
        sql_running(i, kind, _GLOBAL_SPECS, minutes, f"event_type = '{kind}'")
        for i, (kind, minutes) in enumerate(zip(TYPES, (60, 10, 1440, 90, 720)))
    ),
)
def global_running(spark, sf_dir):
    return flat(evaluate(event_indicators(spark, sf_dir), rule_lines(spark, *_GLOBAL_RULES)))


@query(
    "global_windowed",
    f"WITH {EV} "
    + " UNION ALL ".join(
        sql_rule(i, kind, [], _GLOBAL_SPECS, minutes, f"event_type = '{kind}'")
        for i, (kind, minutes) in enumerate(zip(TYPES, (60, 10, 1440, 90, 720)))
    ),
)
def global_windowed(spark, sf_dir):
    return flat(
        evaluate(event_indicators(spark, sf_dir), rule_lines(spark, *_GLOBAL_RULES), keyless="windowed")
    )


_DIRTY = f"""{EV}, dirty AS (SELECT 'dirty_' || left(CAST(k AS VARCHAR), 1) AS t, user_id, ms,
  CASE event_type WHEN 'click' THEN value WHEN 'purchase' THEN value ELSE 0 END AS v FROM ev)"""
_DIRTY_TABLES = [f"dirty_{digit}" for digit in range(10)]


@query(
    "dirty_values_as_zero",
    f"WITH {_DIRTY} "
    + " UNION ALL ".join(
        sql_rule(i, t, ["user_id"], [("v", f) for f in ("SUM", "COUNT", "MIN", "MAX", "AVG")], 10080, f"t = '{t}'", "dirty")
        for i, t in enumerate(_DIRTY_TABLES)
    ),
)
def dirty_values_as_zero(spark, sf_dir):
    """Quotes are dropped; words, not-a-number and missing values count as 0."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        .when(kind == "purchase", F.col("value").cast("string"))
        .when(kind == "view", F.lit("NaN"))
        .when(kind == "error", F.concat(F.col("value").cast("string"), F.lit("i")))
    )
    name = F.concat(F.lit("dirty_"), F.left("k", F.lit(1)))
    seen = indicators_from_table(events(spark, sf_dir), name, "ts", {"user_id": "user_id", "v": text})
    funcs = "v:sum&v:count&v:min&v:max&v:avg"
    rules = rule_lines(spark, *[f"{i},{t},active,user_id,{funcs},10080" for i, t in enumerate(_DIRTY_TABLES)])
    return flat(evaluate(seen, rules))


_BALANCES = "bal AS (SELECT c_nationkey, c_mktsegment, c_acctbal, CAST(1704067200000 AS BIGINT) AS ms FROM customer)"


@query(
    "signed_balances",
    f"WITH {_BALANCES} "
    + sql_rule(1, "customer", ["c_nationkey", "c_mktsegment"], [("c_acctbal", f) for f in ("SUM", "AVG", "MIN", "MAX")], 60, "true", "bal")
    + " UNION ALL "
    + sql_rule(2, "debtor", ["c_mktsegment"], [("c_acctbal", f) for f in ("SUM", "AVG", "MIN", "MAX")], 60, "c_acctbal < 0", "bal"),
)
def signed_balances(spark, sf_dir):
    """Values of both signs, and groups of negative values only."""
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    customer = table(spark, sf_dir, "customer")
    fields = ["c_nationkey", "c_mktsegment", "c_acctbal"]
    everyone = indicators_from_table(customer, F.lit("customer"), day, fields)
    debtors = indicators_from_table(customer.filter("c_acctbal < 0"), F.lit("debtor"), day, fields)
    rules = rule_lines(
        spark,
        "1,customer,active,c_nationkey&c_mktsegment,c_acctbal:sum&c_acctbal:avg&c_acctbal:min&c_acctbal:max,60",
        "2,debtor,active,c_mktsegment,c_acctbal:sum&c_acctbal:avg&c_acctbal:min&c_acctbal:max,60",
    )
    return flat(evaluate(everyone.unionByName(debtors), rules))


@query(
    "metric_map",
    f"""WITH {EV} SELECT event_type AS table_name, CAST(user_id AS VARCHAR) AS grp, ms - ms % 3600000 AS window_start_ms,
  {sql_aggregate('SUM', 'value')} AS value_sum, {sql_aggregate('AVG', 'value')} AS value_avg,
  {sql_aggregate('MAX', 'k')} AS k_max, CAST(3 AS INTEGER) AS n_metrics
  FROM ev GROUP BY 1, 2, 3""",
)
def metrics_of_group(spark, sf_dir):
    lines = [f"{i},{kind},active,user_id,value:sum&value:avg&k:max,60" for i, kind in enumerate(TYPES)]
    rules = rule_lines(spark, *lines)
    maps = metric_map(evaluate(event_indicators(spark, sf_dir), rules))
    pick = lambda name: F.col("metrics")[name].cast("double")
    return maps.select(
        "table_name",
        F.array_join("grouping_values", "|").alias("grp"),
        "window_start_ms",
        pick("value-SUM").alias("value_sum"),
        pick("value-AVG").alias("value_avg"),
        pick("k-MAX").alias("k_max"),
        F.size("metrics").alias("n_metrics"),
    )


_ALL_FUNCS = "value:sum&value:count&value:min&value:max&value:avg"
_ALL_SPECS = [("value", f) for f in ("SUM", "COUNT", "MIN", "MAX", "AVG")]


# fixed values of the test: powers of two, whose sums are exact in any order
_BIG, _HUGE = 2**90, "8.452712498170644e270"
_WIDE = f"""CASE WHEN event_id % 7 = 0 THEN {_BIG}::DOUBLE WHEN event_id % 11 = 0 THEN -{_BIG}::DOUBLE
  WHEN event_id % 113 = 0 THEN {_HUGE}::DOUBLE END"""


def _sql_huge(func):
    total = "CAST(coalesce(sum(cents), 0) AS BIGINT) / 100::DOUBLE"
    wide_or = lambda wide, plain: f"CASE WHEN count(wide) > 0 THEN {wide} ELSE {plain} END"
    low = lambda f, g: f"{f}(CAST(coalesce(wide, value) AS DOUBLE))"
    rounded = "CAST((CAST(sum(cents) AS BIGINT) * 200 + count(*)) // (2 * count(*)) AS DOUBLE) / 10000::DOUBLE"
    value = {
        "SUM": f"{total} + coalesce(sum(wide), 0)",
        "COUNT": "CAST(count(*) AS DOUBLE)",
        "MIN": low("min", "least"),
        "MAX": low("max", "greatest"),
        "AVG": wide_or(f"({total} + sum(wide)) / count(*)", rounded),
    }[func]
    return (
        f"SELECT event_type AS table_name, CAST(user_id AS VARCHAR) AS grp, ms - ms % 3600000 AS window_start_ms, "
        f"'value-{func}' AS metric, {value} AS value, count(wide) AS n_overflow FROM w GROUP BY 1, 2, 3"
    )


@query(
    "huge_values",
    f"""WITH {EV}, marked AS (SELECT *, {_WIDE} AS wide FROM ev),
w AS (SELECT *, CASE WHEN wide IS NULL THEN CAST(round(value * 100) AS BIGINT) END AS cents FROM marked) """
    + " UNION ALL ".join(map(_sql_huge, ["SUM", "COUNT", "MIN", "MAX", "AVG"])),
)
def huge_values(spark, sf_dir):
    """Numbers far beyond twenty digits among ordinary ones: none is lost, ordinary groups stay exact."""
    at = lambda n: F.col("event_id") % n == 0
    text = (
        F.when(at(7), F.lit(str(_BIG))).when(at(11), F.lit(str(-_BIG))).when(at(113), F.lit(_HUGE))
        .otherwise(F.col("value").cast("string"))
    )
    seen = event_indicators(spark, sf_dir, value=text)
    lines = [f"{i},{kind},active,user_id,{_ALL_FUNCS},60" for i, kind in enumerate(TYPES)]
    return flat(evaluate(seen, rule_lines(spark, *lines)), "n_overflow").drop("rule_id", "window_end_ms")


@query(
    "document_ids_unique",
    f"""WITH {EV}, parted AS (SELECT *, CASE WHEN k % 2 = 0 THEN user_id || '-' || k % 5 ELSE CAST(user_id AS VARCHAR) END AS a,
  CASE WHEN k % 2 = 0 THEN CAST(k % 3 AS VARCHAR) ELSE k % 5 || '-' || k % 3 END AS b FROM ev)
SELECT event_type AS index_name, '{{' || replace(a, '-', '\\-') || '-' || replace(b, '-', '\\-') || '-' || (ms - ms % 86400000)
  || '-' || (ms - ms % 86400000 + 86400000) || '}}' AS doc_id, CAST(count(*) AS DOUBLE) AS n, CAST(1 AS BIGINT) AS n_documents
FROM parted GROUP BY event_type, a, b, ms - ms % 86400000""",
)
def document_ids_unique(spark, sf_dir):
    """Groups such as (a-b, c) and (a, b-c), whose values joined plainly would give one id."""
    even = F.col("k").cast("int") % 2 == 0
    user, five, three = F.col("user_id").cast("string"), (F.col("k") % 5).cast("int"), (F.col("k") % 3).cast("int")
    seen = event_indicators(
        spark, sf_dir,
        a=F.when(even, F.concat_ws("-", user, five)).otherwise(user),
        b=F.when(even, three.cast("string")).otherwise(F.concat_ws("-", five, three)),
    )
    lines = [f"{i},{kind},active,a&b,value:count,1440" for i, kind in enumerate(TYPES)]
    docs = documents(evaluate(seen, rule_lines(spark, *lines)))
    return docs.groupBy(F.col("index").alias("index_name"), "doc_id").agg(
        F.max(F.col("metrics")["value-COUNT"]).cast("double").alias("n"), F.count(F.lit(1)).alias("n_documents")
    )


@query(
    "rollup_10_to_60",
    f"WITH {EV} "
    + " UNION ALL ".join(
        sql_rule(i, kind, ["user_id"], _ALL_SPECS, 60, f"event_type = '{kind}'") for i, kind in enumerate(TYPES)
    ),
)
def rollup_10_to_60(spark, sf_dir):
    """Ten-minute aggregates merged into hours."""
    lines = [f"{i},{kind},active,user_id,{_ALL_FUNCS},10" for i, kind in enumerate(TYPES)]
    fine = partials(fork(event_indicators(spark, sf_dir), rule_lines(spark, *lines)))
    return flat(finish(merge(fine, 60)))


# --- running values, last events, sets ----------------------------------------------------


@query(
    "running_values",
    f"""WITH {EV}, cents AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM ev)
SELECT event_id, event_type AS table_name, CAST(user_id AS VARCHAR) AS grp, ms - ms % 86400000 AS window_start_ms,
  CAST(sum(c) OVER w AS BIGINT) / 100::DOUBLE AS total, count(*) OVER w AS n,
  min(value) OVER w AS low, max(value) OVER w AS high,
  CAST((CAST(sum(c) OVER w AS BIGINT) * 200 + count(*) OVER w) // (2 * count(*) OVER w) AS DOUBLE) / 10000::DOUBLE AS average
FROM cents WINDOW w AS (PARTITION BY event_type, user_id, ms - ms % 86400000 ORDER BY ms, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_values_by_user(spark, sf_dir):
    lines = [f"{i},{kind},active,user_id,{_ALL_FUNCS},1440" for i, kind in enumerate(TYPES)]
    forked = fork(event_indicators(spark, sf_dir), rule_lines(spark, *lines))
    done = running_values(forked, "event_id")
    return done.select(
        "event_id",
        "table_name",
        F.array_join("grouping_values", "|").alias("grp"),
        "window_start_ms",
        F.col("total").cast("double").alias("total"),
        "n",
        F.col("low").cast("double").alias("low"),
        F.col("high").cast("double").alias("high"),
        F.col("average").cast("double").alias("average"),
    )


@query(
    "lookback_sum",
    f"""WITH {EV}, cents AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM ev),
each AS (SELECT event_type AS table_name, ms AS event_ms,
  CAST(sum(c) OVER w AS BIGINT) AS s, count(*) OVER w AS n
FROM cents WINDOW w AS (PARTITION BY event_type ORDER BY ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW))
SELECT DISTINCT table_name, event_ms - 3600000 AS from_ms, event_ms, s / 100::DOUBLE AS total, n,
  CAST((s * 200 + n) // (2 * n) AS DOUBLE) / 10000::DOUBLE AS average FROM each""",
)
def lookback_sum(spark, sf_dir):
    """The hour up to each event time, over all users of an event type."""
    lines = [f"{i},{kind},active,,value:sum&value:avg,60" for i, kind in enumerate(TYPES)]
    forked = fork(event_indicators(spark, sf_dir), rule_lines(spark, *lines))
    return lookback_values(forked).select(
        "table_name",
        "from_ms",
        "event_ms",
        F.col("total").cast("double").alias("total"),
        "n",
        F.col("average").cast("double").alias("average"),
    )


# powers of two, whose sums are exact as doubles in any order: beyond twenty digits, some of them far beyond
_FAR, _FARTHEST = 2**90, 2.0**300
_FAR_SQL = f"""{EV}, w AS (SELECT *, CASE WHEN event_id % 113 = 0 THEN {_FARTHEST!r}::DOUBLE WHEN event_id % 7 = 0 THEN {float(_FAR)!r}::DOUBLE
  WHEN event_id % 11 = 0 THEN -{float(_FAR)!r}::DOUBLE END AS wide, CAST(round(value * 100) AS BIGINT) AS cents FROM ev),
c AS (SELECT *, CASE WHEN wide IS NULL THEN cents END AS c FROM w)"""


def _far_values(spark, sf_dir):
    at = lambda n: F.col("event_id") % n == 0
    text = (
        F.when(at(113), F.lit(repr(_FARTHEST))).when(at(7), F.lit(str(_FAR))).when(at(11), F.lit(str(-_FAR)))
        .otherwise(F.col("value").cast("string"))
    )
    return event_indicators(spark, sf_dir, value=text)


_SUM_C = "CAST(coalesce(sum(c) OVER w, 0) AS BIGINT)"
_LOW_C, _HIGH_C = "min(c) OVER w / 100::DOUBLE", "max(c) OVER w / 100::DOUBLE"


@query(
    "running_huge_values",
    f"""WITH {_FAR_SQL}
SELECT event_id, event_type AS table_name, ms - ms % 86400000 AS window_start_ms, count(*) OVER w AS n, count(wide) OVER w AS n_overflow,
  {_SUM_C} / 100::DOUBLE + coalesce(sum(wide) OVER w, 0) AS total,
  least({_LOW_C}, min(wide) OVER w) AS low, greatest({_HIGH_C}, max(wide) OVER w) AS high
FROM c WINDOW w AS (PARTITION BY event_type, ms - ms % 86400000 ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_huge_values(spark, sf_dir):
    """Running values over numbers beyond the decimal type: none is lost or read as 0."""
    lines = [f"{i},{kind},active,,value:sum&value:min&value:max,1440" for i, kind in enumerate(TYPES)]
    done = running_values(fork(_far_values(spark, sf_dir), rule_lines(spark, *lines)), "event_id")
    figure = lambda name: F.coalesce(F.col(f"approx.{name}"), F.col(name).cast("double")).alias(name)
    return done.select("event_id", "table_name", "window_start_ms", "n", "n_overflow", *map(figure, ("total", "low", "high")))


@query(
    "lookback_huge_values",
    f"""WITH {_FAR_SQL}
SELECT DISTINCT event_type AS table_name, ms AS event_ms, count(*) OVER w AS n, count(wide) OVER w AS n_overflow,
  {_SUM_C} / 100::DOUBLE + coalesce(sum(wide) OVER w, 0) AS total
FROM c WINDOW w AS (PARTITION BY event_type ORDER BY ms RANGE BETWEEN 43200000 PRECEDING AND CURRENT ROW)""",
)
def lookback_huge_values(spark, sf_dir):
    """Half a day up to each event time, with numbers beyond the decimal type that come and go."""
    lines = [f"{i},{kind},active,,value:sum,720" for i, kind in enumerate(TYPES)]
    done = lookback_values(fork(_far_values(spark, sf_dir), rule_lines(spark, *lines)), wide=True)
    total = F.coalesce("approx.total", F.col("total").cast("double")).alias("total")
    return done.select("table_name", "event_ms", "n", "n_overflow", total)


@query(
    "trigger_event",
    f"""WITH {EV}, ranked AS (SELECT *, ms - ms % 3600000 AS w, row_number() OVER (
  PARTITION BY event_type, user_id, ms - ms % 3600000 ORDER BY ms DESC, event_id DESC) AS rn FROM ev)
SELECT event_type AS table_name, CAST(user_id AS VARCHAR) AS grp, w AS window_start_ms, event_id, ms AS event_ms,
  value FROM ranked WHERE rn = 1""",
)
def trigger_event(spark, sf_dir):
    lines = [f"{i},{kind},active,user_id,value:sum,60" for i, kind in enumerate(TYPES)]
    forked = fork(event_indicators(spark, sf_dir), rule_lines(spark, *lines))
    return last_event(forked, "event_id").select(
        "table_name",
        F.array_join("grouping_values", "|").alias("grp"),
        "window_start_ms",
        "event_id",
        "event_ms",
        F.col("fields")["value"].cast("double").alias("value"),
    )


@query(
    "avg_long",
    "SELECT event_type, sum(user_id) / count(*)::DOUBLE AS average FROM events GROUP BY 1",
)
def avg_long(spark, sf_dir):
    return long_average(table(spark, sf_dir, "events"), ["event_type"], "user_id")


@query("distinct_set", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_set(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "events"), ["event_type"], "user_id")


@query(
    "distinct_set_size",
    "SELECT event_type, count(DISTINCT user_id) AS n_distinct FROM events GROUP BY 1",
)
def distinct_set_size(spark, sf_dir):
    return distinct_counts(table(spark, sf_dir, "events"), ["event_type"], "user_id")


# --- look-up ------------------------------------------------------------------------------

_SEGMENT_SQL = f"""{EV}, wide AS (SELECT ev.*, c_mktsegment AS seg, c_acctbal FROM ev
  LEFT JOIN customer ON ev.user_id * 10 = customer.c_custkey)"""


@query(
    "lookup_join",
    f"WITH {_SEGMENT_SQL} "
    + " UNION ALL ".join(
        [
            sql_rule(1, "click", ["seg"], [("value", "SUM"), ("value", "COUNT")], 1440, "event_type = 'click'", "wide"),
            sql_rule(2, "view", ["user_id", "seg"], [("c_acctbal", "MAX"), ("value", "AVG")], 1440, "event_type = 'view' AND seg IS NOT NULL", "wide"),
        ]
    ),
)
def lookup_join(spark, sf_dir):
    """Events widened by the customer, whose columns then serve as group key and as value.

    Users beyond the customers find no match: they group under ``null``, and a rule that
    aggregates a looked-up column does not match them.
    """
    ten_fold = F.col("user_id") * 10
    seen = event_indicators(spark, sf_dir, customer=ten_fold)
    wide = widen(
        seen, table(spark, sf_dir, "customer"), {"customer": "c_custkey"}, ["c_mktsegment", "c_acctbal"], unique=True
    )
    rules = rule_lines(
        spark,
        "1,click,active,c_mktsegment,value:sum&value:count,1440",
        "2,view,active,user_id&c_mktsegment,c_acctbal:max&value:avg,1440",
    )
    return flat(evaluate(wide, rules))


@query(
    "lookup_multi_match",
    """WITH last_order AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status,
  arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(status, 'kept') AS status, price
FROM customer LEFT JOIN last_order ON c_custkey = o_custkey""",
)
def lookup_multi_match(spark, sf_dir):
    """Each customer with the last of its orders; without an order the old value stays."""
    people = indicators_from_table(
        table(spark, sf_dir, "customer"), F.lit("customer"), F.lit("2024-01-01").cast("timestamp"),
        {"c_custkey": "c_custkey", "o_orderstatus": F.lit("kept")},
    )
    wide = widen(
        people, table(spark, sf_dir, "orders"), {"c_custkey": "o_custkey"},
        ["o_orderstatus", "o_totalprice"], order="o_orderkey",
    )
    return wide.select(
        F.col("fields")["c_custkey"].cast("bigint").alias("c_custkey"),
        F.col("fields")["o_orderstatus"].alias("status"),
        F.col("fields")["o_totalprice"].cast("double").alias("price"),
    )


_DOCS = """docs AS (SELECT lang, source, n_chars, quality, toxic, CAST(1704067200000 AS BIGINT) AS ms
  FROM documents LEFT JOIN labels USING (doc_id))"""
_LANGS = ["en", "de", "fr", "es"]


@query(
    "documents_by_label",
    f"WITH {_DOCS} "
    + " UNION ALL ".join(
        sql_rule(i, lang, ["source", "quality"], [("n_chars", f) for f in ("SUM", "AVG", "MAX", "COUNT")], 60, f"lang = '{lang}'", "docs")
        + " UNION ALL "
        + sql_rule(10 + i, lang, ["toxic"], [("n_chars", "AVG"), ("quality", "SUM")], 60, f"lang = '{lang}' AND toxic IS NOT NULL", "docs")
        for i, lang in enumerate(_LANGS)
    ),
)
def documents_by_label(spark, sf_dir):
    """Document lengths by language, source and a looked-up label."""
    docs = indicators_from_table(
        table(spark, sf_dir, "documents"), "lang", F.lit("2024-01-01").cast("timestamp"),
        ["doc_id", "source", "n_chars"],
    )
    wide = widen(
        docs, table(spark, sf_dir, "labels"), {"doc_id": "doc_id"}, ["quality", "toxic"], unique=True
    )
    lines = []
    for i, lang in enumerate(_LANGS):
        lines.append(f"{i},{lang},active,source&quality,n_chars:sum&n_chars:avg&n_chars:max&n_chars:count,60")
        lines.append(f"{10 + i},{lang},active,toxic,n_chars:avg&quality:sum,60")
    return flat(evaluate(wide, rule_lines(spark, *lines)))


# --- documents ----------------------------------------------------------------------------


@query(
    "result_docs",
    f"WITH {EV} SELECT event_type AS index_name, "
    "'{' || user_id || '-' || (ms - ms % 600000) || '-' || (ms - ms % 600000 + 600000) || '}' AS doc_id, "
    "CAST(user_id AS VARCHAR) AS user_id, "
    "strftime(make_timestamp((ms - ms % 600000) * 1000), '%Y-%m-%d %H:%M:%S:%g') AS start_time, "
    "strftime(make_timestamp((ms - ms % 600000 + 600000) * 1000), '%Y-%m-%d %H:%M:%S:%g') AS end_time, "
    f"{sql_aggregate('SUM', 'value')} AS value_sum, {sql_aggregate('MAX', 'value')} AS value_max "
    "FROM ev GROUP BY event_type, user_id, ms - ms % 600000",
)
def result_docs(spark, sf_dir):
    """Documents as they are stored; the index is the table name in lower case."""
    seen = indicators_from_table(
        events(spark, sf_dir), F.upper("event_type"), "ts", ["user_id", "value"], keep=["event_id"]
    )
    lines = [f"{i},{kind.upper()},active,user_id,value:sum&value:max,10" for i, kind in enumerate(TYPES)]
    docs = documents(evaluate(seen, rule_lines(spark, *lines)))
    return docs.select(
        F.col("index").alias("index_name"),
        "doc_id",
        F.col("fields")["user_id"].alias("user_id"),
        F.col("startTime").alias("start_time"),
        F.col("endTime").alias("end_time"),
        F.col("metrics")["value-SUM"].cast("double").alias("value_sum"),
        F.col("metrics")["value-MAX"].cast("double").alias("value_max"),
    )


@query(
    "document_body",
    f"WITH {EV} SELECT event_type AS index_name, CAST(user_id AS VARCHAR) AS user_id, "
    "strftime(make_timestamp((ms - ms % 3600000) * 1000), '%Y-%m-%d %H:%M:%S:%g') AS start_time, "
    f"{sql_aggregate('SUM', 'value')} AS value_sum, {sql_aggregate('COUNT', 'value')} AS value_count "
    "FROM ev GROUP BY event_type, user_id, ms - ms % 3600000",
)
def document_body(spark, sf_dir):
    """The flat JSON of every document, read back member by member."""
    lines = [f"{i},{kind},active,user_id,value:sum&value:count,60" for i, kind in enumerate(TYPES)]
    rows = document_json(documents(evaluate(event_indicators(spark, sf_dir), rule_lines(spark, *lines))))
    body = F.from_json("body", "user_id string, startTime string, `value-SUM` double, `value-COUNT` double")
    return rows.select(F.col("index").alias("index_name"), body.alias("b")).select(
        "index_name",
        "b.user_id",
        F.col("b.startTime").alias("start_time"),
        F.col("b.value-SUM").alias("value_sum"),
        F.col("b.value-COUNT").alias("value_count"),
    )


@query(
    "upsert_merge",
    f"WITH {EV} SELECT event_type AS index_name, '{{' || user_id || '-' || (ms - ms % 3600000) || '-' || (ms - ms % 3600000 + 3600000) || '}}' AS doc_id, "
    f"{sql_aggregate('SUM', 'value')} AS value_sum, {sql_aggregate('MAX', 'k')} AS k_max, CAST(2 AS INTEGER) AS n_metrics "
    "FROM ev GROUP BY event_type, user_id, ms - ms % 3600000",
)
def upsert_merge(spark, sf_dir):
    """Two rules per type, two versions: one document holds the latest version of both metrics."""
    seen = event_indicators(spark, sf_dir)
    lines = [f"{i}1,{kind},active,user_id,value:sum,60" for i, kind in enumerate(TYPES)]
    first = rule_lines(spark, *lines, *[f"{i}2,{kind},active,user_id,k:max,60" for i, kind in enumerate(TYPES)])
    results = addressed(evaluate(seen, first))
    stale = results.withColumn("value", F.lit(-1).cast("decimal(38,8)")).withColumn("version", F.lit(0))
    versions = stale.unionByName(results.withColumn("version", F.lit(1)))
    docs = documents(latest(versions))
    return docs.select(
        F.col("index").alias("index_name"),
        "doc_id",
        F.col("metrics")["value-SUM"].cast("double").alias("value_sum"),
        F.col("metrics")["k-MAX"].cast("double").alias("k_max"),
        F.size("metrics").alias("n_metrics"),
    )


@query("upsert_leveled", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def upsert_leveled(spark, sf_dir):
    """Results of four batches, each over more of the events, in bucketed runs that are merged on the way."""
    seen = event_indicators(spark, sf_dir)
    rules = rule_lines(spark, *MULTI_RULES)
    kept = LeveledResults(spark, f"results_{uuid.uuid4().hex}", buckets=8, fanout=2)
    try:
        for batch in range(4):
            kept.add(evaluate(seen.filter(f"event_id % 4 <= {batch}"), rules), batch)
        return flat(materialise(kept.read()))
    finally:
        kept.drop()


_LIMITS = {"value-SUM": (">", 50), "value-MIN": ("<=", 1), "value-COUNT": ("=", 3), "value-MAX": ("!=", 9.99)}


@query(
    "threshold_filter",
    f"""WITH {EV}, r AS ({" UNION ALL ".join(
        sql_rule(i, kind, ['user_id'], _ALL_SPECS, 1440, f"event_type = '{kind}'") for i, kind in enumerate(TYPES)
    )})
SELECT * FROM r WHERE (metric = 'value-SUM' AND value > 50) OR (metric = 'value-MIN' AND value <= 1)
  OR (metric = 'value-COUNT' AND value = 3) OR (metric = 'value-MAX' AND value <> 9.99)""",
)
def threshold_filter(spark, sf_dir):
    """Each metric against its own limit; one with an unknown operator passes nothing."""
    rules = rule_lines(spark, *[f"{i},{kind},active,user_id,{_ALL_FUNCS},1440" for i, kind in enumerate(TYPES)])
    metric = F.col("metric")
    operator, limit = F.when(metric == "value-AVG", F.lit("~")), F.when(metric == "value-AVG", F.lit(0.0))
    for name, (op, bound) in _LIMITS.items():
        operator = operator.when(metric == name, F.lit(op))
        limit = limit.when(metric == name, F.lit(float(bound)))
    results = evaluate(event_indicators(spark, sf_dir), rules)
    marked = results.withColumns({"op": operator, "bound": limit.cast("decimal(38,8)")})
    return flat(over_limit(marked, "op", "bound"))


@query(
    "event_rate",
    f"""WITH {EV} SELECT ms - ms % 60000 AS minute_ms, count(*) AS events, count(*) / 60::DOUBLE AS per_second
FROM ev GROUP BY 1""",
)
def event_rate_per_minute(spark, sf_dir):
    lines = [f"{i},{kind},active,user_id,value:sum,{10 + i}" for i, kind in enumerate(TYPES)]
    rules = rule_lines(spark, *lines, "9,error,pause,user_id,value:sum,10")
    return event_rate(fork(event_indicators(spark, sf_dir), rules))


# --- the large table ----------------------------------------------------------------------

_LI = """li AS (SELECT l_returnflag, l_suppkey, l_linestatus, l_quantity, l_extendedprice, l_discount,
  epoch_us(l_shipdate) // 1000 AS ms FROM lineitem)"""
_LI_FLAGS = ["A", "N", "R"]
_LI_SPECS = [("l_extendedprice", f) for f in ("SUM", "COUNT", "MIN", "MAX", "AVG")] + [("l_quantity", "SUM")]


def _line_rules(spark):
    funcs = "&".join(f"{field}:{func}" for field, func in _LI_SPECS)
    lines = [f"{i},li_{flag},active,l_suppkey,{funcs},1440" for i, flag in enumerate(_LI_FLAGS)]
    return rule_lines(spark, *lines, "10,li_R,active,l_linestatus,l_discount:avg&l_quantity:max,720")


_LI_COLUMNS = ["l_suppkey", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount"]
_LI_SQL = (
    f"WITH {_LI} "
    + " UNION ALL ".join(
        sql_rule(i, f"li_{flag}", ["l_suppkey"], _LI_SPECS, 1440, f"l_returnflag = '{flag}'", "li")
        for i, flag in enumerate(_LI_FLAGS)
    )
    + " UNION ALL "
    + sql_rule(10, "li_R", ["l_linestatus"], [("l_discount", "AVG"), ("l_quantity", "MAX")], 720, "l_returnflag = 'R'", "li")
)


@query("lineitem_metrics", _LI_SQL)
def lineitem_metrics(spark, sf_dir):
    """The bench query: every line, by flag, supplier and day, straight from the columns."""
    flag = F.concat(F.lit("li_"), F.col("l_returnflag"))
    lines = spread(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", *_LI_COLUMNS))
    return flat(evaluate_table(lines, flag, "l_shipdate", _LI_COLUMNS, _line_rules(spark)))


@query("lineitem_metrics_from_map", _LI_SQL)
def lineitem_metrics_from_map(spark, sf_dir):
    """The same from a field map, as events of free form would come."""
    flag = F.concat(F.lit("li_"), F.col("l_returnflag"))
    lines = spread(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate", *_LI_COLUMNS))
    seen = indicators_from_table(lines, flag, "l_shipdate", _LI_COLUMNS)
    return flat(evaluate(seen, _line_rules(spark)))
