"""Streaming queries over the events, compared with the batch SQL where the outcome is fixed."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyloom.operators.documents import compact_parts, live_results
from tallyloom.operators.fork import fork
from tallyloom.operators.aggregate import partials
from tallyloom.operators.health import RANK_ERROR
from tallyloom.operators.lookup import widen
from tallyloom.operators.rollup import read_rollup, update_rollup
from tallyloom.operators.rules import export_rules
from tallyloom.plans.catalogue import EV, event_indicators, events, flat, query, rule_lines, sql_rule, table
from tallyloom.plans.queries_metrics import KEYED_SQL, MULTI_RULES, RUNNING_SQL
from tallyloom.plans.queries_rules import ASOF_SQL, CLEARED_SQL, CLEARED_RULES, FOLDED_SQL, change_feed, rule_changes, readable
from tallyloom.session import scratch_folder
from tallyloom.sources.lines import indicators_from_lines, stream_lines
from tallyloom.streaming.change_feed import asof_partials, live_changes, maintain_rules, stream_changes
from tallyloom.streaming.closing import closed_results, late_rows, start_closing
from tallyloom.streaming.dimension_feed import live_dimension, publish_dimension
from tallyloom.streaming.latency import read_latency, start_latency
from tallyloom.streaming.job import closing_partials, heartbeat, start, update_partials
from tallyloom.streaming.rule_feed import live_rules


def _staged(spark, sf_dir, pieces):
    """The events copied into a source folder by ``pieces``, conditions that come in turn.

    Returns the folder, the streaming frame over it and the writers of the pieces.
    """
    folder = scratch_folder(spark)
    seen = event_indicators(spark, sf_dir)

    def put(condition):
        seen.filter(condition).write.mode("append").parquet(f"{folder}/source")

    put("false")  # the folder has to be there before it is watched
    stream = spark.readStream.schema(seen.schema).parquet(f"{folder}/source")
    return folder, stream, [lambda c=c: put(c) for c in pieces]


def _run(parts, folder, **options):
    start(parts, f"{folder}/results", f"{folder}/checkpoint", **options).awaitTermination()


_ODD, _EVEN = "event_id % 2 = 1", "event_id % 2 = 0"  # both pieces go into the same groups
_EARLY = "table_name IN ('click', 'view')"
_LATE = "table_name NOT IN ('click', 'view')"


@query("stream_update_equals_batch", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def stream_update_equals_batch(spark, sf_dir):
    """All events through the stream; the table ends up as the batch results."""
    folder, stream, put = _staged(spark, sf_dir, [_ODD, _EVEN])
    rules = rule_lines(spark, *MULTI_RULES)
    for piece in put:
        piece()
        _run(update_partials(stream, rules, None), folder)
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_late_refire", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def stream_late_refire(spark, sf_dir):
    """Dear values come first, cheap ones late and out of order: late events correct results."""
    dear = "CAST(fields['value'] AS DOUBLE) > 5"
    folder, stream, put = _staged(spark, sf_dir, [dear, f"NOT {dear}"])
    rules = rule_lines(spark, *MULTI_RULES)
    for piece in put:
        piece()
        _run(update_partials(stream, rules, None), folder)
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_compacted", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def stream_compacted(spark, sf_dir):
    """The table is compacted in place between two runs of the stream, and again after them."""
    folder, stream, put = _staged(spark, sf_dir, [_ODD, _EVEN])
    rules = rule_lines(spark, *MULTI_RULES)
    for piece in put:
        piece()
        _run(update_partials(stream, rules, None), folder)
        compact_parts(spark, f"{folder}/results")
    return flat(live_results(spark, f"{folder}/results"))


_LONG_RULES = ["9,view,active,user_id,value:sum&value:avg,7", "10,purchase,active,k,value:max&value:count,10080"]
_LONG_SQL = " UNION ALL ".join(
    [
        sql_rule(9, "view", ["user_id"], [("value", "SUM"), ("value", "AVG")], 7, "event_type = 'view'"),
        sql_rule(10, "purchase", ["k"], [("value", "MAX"), ("value", "COUNT")], 10080, "event_type = 'purchase'"),
    ]
)


@query("stream_ttl", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL} UNION ALL {_LONG_SQL}")
def stream_ttl(spark, sf_dir):
    """State that ends a day after its day, over events that come in four pieces by time.

    The rules have windows of seven minutes, which cross midnight, of a week, and none at all. By
    the later pieces the state of earlier days is gone; nothing comes late enough to be lost.
    """
    cuts = event_indicators(spark, sf_dir).selectExpr("percentile_approx(event_ms, array(0.25, 0.5, 0.75)) AS p").first()["p"]
    edges = [0, *cuts, 1 << 62]
    pieces = [f"event_ms >= {a} AND event_ms < {b}" for a, b in zip(edges, edges[1:])]
    folder, stream, put = _staged(spark, sf_dir, pieces)
    for piece in put:
        piece()
        _run(update_partials(stream, rule_lines(spark, *MULTI_RULES, *_LONG_RULES)), folder)
    return flat(live_results(spark, f"{folder}/results"))


_CLOSING_RULES = [
    "1,click,active,user_id,value:sum&value:count,60", "9,view,active,user_id,value:sum&value:avg,7",
    "10,purchase,active,k,value:max&value:count,10080", "12,error,active,user_id&k,value:min,1440",
]
_JOINING = "11,signup,active,user_id,value:sum&value:min,13"
# events come in four pieces by time; of the first, every tenth comes with the last one instead
_STAGED_SQL = f"""{EV}, cut AS (SELECT min(ms) AS lo, max(ms) - min(ms) + 1 AS size FROM ev), staged AS (
  SELECT ev.*, CASE WHEN event_id % 10 = 7 AND (ms - lo) * 4 // size = 0 THEN 3 ELSE (ms - lo) * 4 // size END AS piece FROM ev, cut
), marks AS (SELECT p, (SELECT max(ms) - 500 FROM staged WHERE piece < p) AS mark FROM range(0, 4) r(p)),
timed AS (SELECT staged.*, coalesce(mark, -1) AS mark FROM staged JOIN marks ON p = piece)"""


def _closing_sql(late):
    """The rules over rows whose window was open, or had closed, when they came."""
    rules = [
        (1, "click", ["user_id"], [("value", "SUM"), ("value", "COUNT")], 60, "true"),
        (9, "view", ["user_id"], [("value", "SUM"), ("value", "AVG")], 7, "true"),
        (10, "purchase", ["k"], [("value", "MAX"), ("value", "COUNT")], 10080, "true"),
        (12, "error", ["user_id", "k"], [("value", "MIN")], 1440, "true"),
        (11, "signup", ["user_id"], [("value", "SUM"), ("value", "MIN")], 13, "piece >= 2"),
    ]
    parts = []
    for rule_id, name, keys, specs, minutes, when in rules:
        size = minutes * 60000
        closed = f"ms - ms % {size} + {size} <= mark"
        where = f"event_type = '{name}' AND {when} AND {'' if late else 'NOT '}({closed})"
        parts.append(sql_rule(rule_id, name, keys, [("value", "COUNT")] if late else specs, minutes, where, "timed"))
    return " UNION ALL ".join(parts)


def _closed(spark, sf_dir):
    """Runs the stream piece by piece; a rule of a new length joins it on the way. Returns its folder."""
    bounds = event_indicators(spark, sf_dir).agg(F.min("event_ms").alias("lo"), F.max("event_ms").alias("hi")).first()
    lo, size = bounds["lo"], bounds["hi"] - bounds["lo"] + 1
    quarter = f"((event_ms - {lo}L) * 4 div {size}L)"
    piece = f"CASE WHEN event_id % 10 = 7 AND {quarter} = 0 THEN 3 ELSE {quarter} END"
    folder, stream, put = _staged(spark, sf_dir, [f"{piece} = {k}" for k in range(4)])

    def publish(version, lines):
        spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(f"{folder}/rules/version={version}")

    publish(1, _CLOSING_RULES)
    closing = start_closing(
        stream, live_rules(spark, f"{folder}/rules"), f"{folder}/closing", f"{folder}/checkpoint",
        compact_every=2, trigger={"processingTime": "0 seconds"}, small_rules=True,
    )
    try:
        for k in range(4):
            if k == 2:
                publish(2, [*_CLOSING_RULES, _JOINING])
            put[k]()
            closing.processAllAvailable()
    finally:
        closing.stop()
    return f"{folder}/closing"


@query(
    "stream_on_close",
    f"WITH {_STAGED_SQL}, r AS ({_closing_sql(False)}) SELECT * FROM r WHERE window_end_ms <= (SELECT max(ms) - 500 FROM ev)",
)
def stream_on_close(spark, sf_dir):
    """Each result once, when its window has closed, whatever its length: minutes, a day, a week.

    Windows close between the pieces; rows that come after that are late and change nothing; the last
    windows are still open. A rule of thirteen minutes joins while the stream runs.
    """
    return flat(closed_results(spark, _closed(spark, sf_dir)))


@query("stream_late_rows", f"WITH {_STAGED_SQL}, r AS ({_closing_sql(True)}) SELECT * FROM r")
def stream_late_rows(spark, sf_dir):
    """The rows that came after their window had closed, counted by rule, group and window."""
    late = late_rows(spark, _closed(spark, sf_dir))
    counted = late.select("*", F.lit("value-COUNT").alias("metric"), F.lit(None).cast("double").alias("approx"), F.col("n").alias("value"))
    return flat(counted)


@query(
    "stream_hot_rules",
    f"WITH {EV} "
    + " UNION ALL ".join(
        [
            sql_rule(1, "click", ["user_id"], [("value", "SUM"), ("value", "COUNT")], 60, "event_type = 'click'"),
            sql_rule(2, "purchase", ["user_id"], [("value", "MAX")], 60, "event_type = 'purchase'"),
            sql_rule(3, "view", ["user_id"], [("value", "MAX")], 60, "event_type = 'view'"),
        ]
    ),
)
def stream_hot_rules(spark, sf_dir):
    """Rules edited while the stream runs.

    Clicks and views come first, the rest later. In between rule 2 appears, in time for
    purchases, rule 3 is deleted after its views, and rule 4 is added too late for views.
    """
    folder, stream, put = _staged(spark, sf_dir, [_EARLY, _LATE])
    one = "1,click,active,user_id,value:sum&value:count,60"

    def publish(*lines):
        spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{folder}/rules")

    publish(one, "3,view,active,user_id,value:max,60")
    put[0]()
    parts = partials(fork(stream, live_rules(spark, f"{folder}/rules"), small_rules=True))
    running = start(
        parts, f"{folder}/results", f"{folder}/checkpoint", trigger={"processingTime": "0 seconds"}
    )
    try:
        running.processAllAvailable()
        publish(
            one, "2,purchase,active,user_id,value:max,60", "3,view,delete,user_id,value:max,60",
            "4,view,active,k,value:sum,60",
        )
        put[1]()
        running.processAllAvailable()
    finally:
        running.stop()
    return flat(live_results(spark, f"{folder}/results"))


_CHANGED_SQL = " UNION ALL ".join(
    [
        sql_rule(1, "click", ["user_id"], [("value", "SUM"), ("value", "COUNT")], 60, "event_type = 'click' AND event_id % 2 = 1"),
        sql_rule(1, "click", ["k"], [("value", "MAX")], 30, "event_type = 'click' AND event_id % 2 = 0"),
        sql_rule(2, "view", ["user_id"], [("value", "MAX")], 60, "event_type = 'view' AND event_id % 2 = 1"),
        sql_rule(3, "error", ["user_id"], [("value", "SUM")], 60, "event_type = 'error' AND event_id % 2 = 1"),
        sql_rule(4, "purchase", ["user_id"], [("value", "MIN")], 60, "event_type = 'purchase'"),
        sql_rule(5, "signup", ["k"], [("value", "AVG")], 1440, "event_type = 'signup' AND event_id % 2 = 0"),
    ]
)


@query("stream_rule_changes", f"WITH {EV} {_CHANGED_SQL}")
def stream_rule_changes(spark, sf_dir):
    """Rules of all five types changed by lines added to the folder while the stream runs.

    Between the two pieces rule 1 is edited, 2 is paused, 3 is deleted, 4 is repeated and 5 appears.
    """
    folder, stream, put = _staged(spark, sf_dir, [_ODD, _EVEN])

    def publish(name, *lines):
        spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.mode("append").text(
            f"{folder}/rules/{name}"
        )

    publish(
        "version=1", "1,click,active,user_id,value:sum&value:count,60", "2,view,active,user_id,value:max,60",
        "3,error,active,user_id,value:sum,60", "4,purchase,active,user_id,value:min,60",
    )
    put[0]()
    parts = update_partials(stream, live_rules(spark, f"{folder}/rules"), None, small_rules=True)
    running = start(
        parts, f"{folder}/results", f"{folder}/checkpoint", trigger={"processingTime": "0 seconds"}
    )
    try:
        running.processAllAvailable()
        # the next version begins with the lines of the last one: changes are added, not edited in
        publish(
            "version=2", "1,click,active,user_id,value:sum&value:count,60", "2,view,active,user_id,value:max,60",
            "3,error,active,user_id,value:sum,60", "4,purchase,active,user_id,value:min,60",
            "1,click,active,k,value:max,30", "2,view,pause,user_id,value:max,60", "3,error,delete,user_id,value:sum,60",
            "4,purchase,active,user_id,value:min,60", "5,signup,active,k,value:avg,1440",
        )
        put[1]()
        running.processAllAvailable()
    finally:
        running.stop()
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_from_line_files", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def stream_from_line_files(spark, sf_dir):
    """Event lines in text files, read as a stream and parsed on the way."""
    folder = scratch_folder(spark)
    text = lambda c: F.col(c).cast("string")
    pairs = [F.concat(F.lit(f"{c}="), text(c)) for c in ("user_id", "value", "k")]
    nanos = (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).cast("string")
    lines = events(spark, sf_dir).select(
        F.concat_ws(" ", F.concat_ws(",", "event_type", pairs[0]), F.concat_ws(",", *pairs[1:]), nanos)
    )
    lines.write.text(f"{folder}/lines")
    seen = indicators_from_lines(stream_lines(spark, f"{folder}/lines"))
    _run(update_partials(seen, rule_lines(spark, *MULTI_RULES), None), folder)
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_idle_source", f"WITH {EV} {KEYED_SQL}")
def stream_idle_source(spark, sf_dir):
    """The source falls silent; a heartbeat a week on closes every window that is still open."""
    folder, stream, put = _staged(spark, sf_dir, ["true"])
    put[0]()
    last = event_indicators(spark, sf_dir).agg(F.max("event_time").alias("t"))
    last.select((F.col("t") + F.expr("INTERVAL 7 DAYS")).alias("event_time")).write.parquet(f"{folder}/beats")
    beats = spark.readStream.schema("event_time timestamp").parquet(f"{folder}/beats")
    closing = closing_partials(heartbeat(stream, beats), rule_lines(spark, *MULTI_RULES))
    _run(closing, folder, mode="append")
    return flat(live_results(spark, f"{folder}/results"))


@query(
    "stream_side_output",
    f"WITH {EV}, r AS ({KEYED_SQL} UNION ALL {RUNNING_SQL}) SELECT * FROM r WHERE value >= 100",
)
def stream_side_output(spark, sf_dir):
    """Alerts on large values, put aside batch by batch while the results are written."""
    folder, stream, put = _staged(spark, sf_dir, ["true"])
    put[0]()

    def alert(results, number):
        results.filter("value >= 100").write.mode("overwrite").parquet(f"{folder}/alerts/batch={number}")

    _run(update_partials(stream, rule_lines(spark, *MULTI_RULES), None), folder, side_output=alert)
    return flat(spark.read.parquet(f"{folder}/alerts").drop("batch"))


_SEGMENT_RULES = ["1,click,active,c_mktsegment,value:sum&value:count,1440", "2,view,active,c_mktsegment&c_nationkey,value:max,60"]
# of the customers a later version moves every second one to another segment and drops every seventh
_DIMENSIONS = f"""{EV}, wide AS (
  SELECT ev.*, CASE WHEN moved AND c_custkey % 2 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment, c_nationkey
  FROM (SELECT ev.*, event_id % 2 = 0 AS moved FROM ev) ev
  LEFT JOIN customer ON user_id = c_custkey AND NOT (moved AND c_custkey % 7 = 0)
)"""


def _segment_sql(where):
    return " UNION ALL ".join(
        [
            sql_rule(1, "click", ["c_mktsegment"], [("value", "SUM"), ("value", "COUNT")], 1440, f"event_type = 'click' AND {where}", "wide"),
            sql_rule(2, "view", ["c_mktsegment", "c_nationkey"], [("value", "MAX")], 60, f"event_type = 'view' AND {where}", "wide"),
        ]
    )


def _widened(spark, stream, folder, max_age):
    extend = ["c_mktsegment", "c_nationkey"]
    dimension = live_dimension(spark, f"{folder}/customers", {"user_id": "c_custkey"}, extend, max_age=max_age)
    return widen(stream, dimension, {"user_id": "c_custkey"}, extend, unique=True, small=True)


def _moved(customers):
    segment = F.when(F.col("c_custkey") % 2 == 0, "NEW").otherwise(F.col("c_mktsegment"))
    return customers.filter("c_custkey % 7 <> 0").withColumn("c_mktsegment", segment)


@query("stream_dimension_refresh", f"WITH {_DIMENSIONS} {_segment_sql('true')}")
def stream_dimension_refresh(spark, sf_dir):
    """Customers edited while the stream runs: the next micro-batch sees the new version whole."""
    folder, stream, put = _staged(spark, sf_dir, [_ODD, _EVEN])
    customers = table(spark, sf_dir, "customer")
    publish_dimension(customers, f"{folder}/customers")
    parts = update_partials(_widened(spark, stream, folder, 3600), rule_lines(spark, *_SEGMENT_RULES), None)
    put[0]()
    running = start(parts, f"{folder}/results", f"{folder}/checkpoint", trigger={"processingTime": "0 seconds"})
    try:
        running.processAllAvailable()
        publish_dimension(_moved(customers), f"{folder}/customers")
        put[1]()
        running.processAllAvailable()
    finally:
        running.stop()
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_dimension_too_old", f"WITH {_DIMENSIONS} {_segment_sql('event_id % 2 = 1')}")
def stream_dimension_too_old(spark, sf_dir):
    """A version older than the bound is refused: the events of that micro-batch wait, none is widened by it."""
    folder, stream, put = _staged(spark, sf_dir, [_ODD, _EVEN])
    publish_dimension(table(spark, sf_dir, "customer"), f"{folder}/customers")
    rules = rule_lines(spark, *_SEGMENT_RULES)
    put[0]()
    _run(update_partials(_widened(spark, stream, folder, 3600), rules, None), folder)
    put[1]()
    try:
        _run(update_partials(_widened(spark, stream, folder, 0), rules, None), folder)
    except StreamingQueryException as refused:
        if "too old" not in str(refused):
            raise
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_recovery", f"WITH {EV} {KEYED_SQL} UNION ALL {RUNNING_SQL}")
def stream_recovery(spark, sf_dir):
    """Each micro-batch fails once after it has written its results and before they count as done; totals stay right."""
    folder, stream, put = _staged(spark, sf_dir, [_ODD, _EVEN])
    rules = rule_lines(spark, *MULTI_RULES)
    written = set()

    def fault(results, number):
        if number not in written:
            written.add(number)
            raise RuntimeError("a fault between write and commit")

    for piece in put:
        piece()
        try:
            _run(update_partials(stream, rules, None), folder, side_output=fault)
        except StreamingQueryException as failed:
            if "between write and commit" not in str(failed):
                raise
        _run(update_partials(stream, rules, None), folder, side_output=fault)
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_change_feed", FOLDED_SQL)
def stream_change_feed(spark, sf_dir):
    """The change feed as a live source: two runs over a folder of change files fold to the same rules."""
    folder = scratch_folder(spark)
    feed = change_feed(spark, sf_dir)
    changes = lambda: stream_changes(spark, f"{folder}/changes")
    # the newer changes come first: the larger seq holds, not the later file
    for piece in ("seq % 3 = 2", "seq % 3 < 2"):
        feed.filter(piece).write.mode("append").json(f"{folder}/changes")
        maintain_rules(changes(), folder, f"{folder}/checkpoint").awaitTermination()
    return readable(live_rules(spark, f"{folder}/rules", max_rows=None, max_bytes=None))


@query("stream_asof_rules", ASOF_SQL)
def stream_asof_rules(spark, sf_dir):
    """Rules that change on the way, at the same places as in ``asof_rules``, over two micro-batches with edits inside each."""
    half = event_indicators(spark, sf_dir).agg(F.max("event_id") + 1).first()[0] // 2
    folder, stream, put = _staged(spark, sf_dir, [f"event_id < {half}", f"event_id >= {half}"])
    changes = rule_changes(spark, event_indicators(spark, sf_dir).withColumn("seq", F.col("event_id")))
    exported = export_rules(changes, "seq")

    def publish(name, condition):
        exported.filter(condition).select("json").coalesce(1).write.text(f"{folder}/changes/{name}")

    parts = asof_partials(
        stream.withColumn("seq", F.col("event_id")), live_changes(spark, f"{folder}/changes"), None, small_rules=True
    )
    # a newer version of the folder has the lines of the one before it too: changes are only added
    publish("version=1", f"seq < {half}")
    put[0]()
    running = start(parts, f"{folder}/results", f"{folder}/checkpoint", trigger={"processingTime": "0 seconds"})
    try:
        running.processAllAvailable()
        publish("version=2", "true")
        put[1]()
        running.processAllAvailable()
    finally:
        running.stop()
    return flat(live_results(spark, f"{folder}/results"))


@query("stream_clear_state", CLEARED_SQL)
def stream_clear_state(spark, sf_dir):
    """A command clears all state while the stream runs: the results are those of the events after it."""
    cut = event_indicators(spark, sf_dir).agg(F.max("event_id")).first()[0] * 2 // 5
    folder, stream, put = _staged(spark, sf_dir, [f"event_id <= {cut}", f"event_id > {cut}"])

    def publish(name, *lines):
        spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(f"{folder}/rules/{name}")

    publish("version=1", *CLEARED_RULES)
    put[0]()
    parts = update_partials(stream, live_rules(spark, f"{folder}/rules"), small_rules=True)
    running = start(parts, f"{folder}/results", f"{folder}/checkpoint", trigger={"processingTime": "0 seconds"})
    try:
        running.processAllAvailable()
        publish("version=2", *CLEARED_RULES, '{"ruleState": "CONTROL", "controlType": "CLEAR_STATE_ALL"}')
        put[1]()
        running.processAllAvailable()
    finally:
        running.stop()
    return flat(live_results(spark, f"{folder}/results"))


_KINDS = ["click", "view", "error", "purchase", "signup"]
_ROLLED = [("value", f) for f in ("SUM", "COUNT", "MIN", "MAX", "AVG")]


@query(
    "stream_rollup",
    f"WITH {EV} " + " UNION ALL ".join(sql_rule(i, kind, ["user_id"], _ROLLED, 1440, f"event_type = '{kind}'") for i, kind in enumerate(_KINDS)),
)
def stream_rollup(spark, sf_dir):
    """Ten-minute aggregates of a stream rolled up into days after every micro-batch, changed days only.

    The pieces overlap in time, so days are made anew that an earlier update has made already.
    """
    folder, stream, put = _staged(spark, sf_dir, ["event_id % 3 = 0", "event_id % 3 = 1 AND event_id % 2 = 0", "event_id % 3 = 2 OR event_id % 6 = 1"])
    rules = rule_lines(spark, *[f"{i},{kind},active,user_id,value:sum&value:count&value:min&value:max&value:avg,10" for i, kind in enumerate(_KINDS)])
    for piece in put:
        piece()
        _run(update_partials(stream, rules, None), folder)
        update_rollup(spark, f"{folder}/results", f"{folder}/days", 1440)
    return flat(read_rollup(spark, f"{folder}/days"))


_LATENCY = "(event_id * 7919) % 100003"


@query(
    "stream_latency",
    f"""WITH {EV}, r AS (SELECT CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS rule_id,
  {_LATENCY} AS ms FROM ev)
SELECT CAST(rule_id AS INTEGER) AS rule_id, count(*) AS events, min(ms) AS min_ms, max(ms) AS max_ms, sum(ms) / count(*)::DOUBLE AS avg_ms,
  CAST(1 AS INTEGER) AS p50_right, CAST(1 AS INTEGER) AS p99_right FROM r GROUP BY 1""",
)
def stream_latency(spark, sf_dir):
    """Latency over several micro-batches: percentiles from merged sketches, held against the exact ranks."""
    folder, stream, put = _staged(spark, sf_dir, [_ODD, "event_id % 4 = 0", "event_id % 4 = 2"])
    rules = rule_lines(spark, *[f"{i},{kind},active,user_id,value:sum,60" for i, kind in enumerate(_KINDS)])
    late = lambda frame: F.timestamp_millis(F.unix_millis("ingestion_time") + F.expr(_LATENCY))
    read = stream.withColumn("ingestion_time", F.col("event_time"))
    for piece in put:
        piece()
        start_latency(read, rules, f"{folder}/latency", f"{folder}/checkpoint", now=late(read)).awaitTermination()
    found = read_latency(spark, f"{folder}/latency")
    exact = event_indicators(spark, sf_dir).select(
        F.array_position(F.array(*map(F.lit, _KINDS)), F.col("table_name")).cast("int").alias("rule_id"), F.expr(_LATENCY).alias("ms")
    ).withColumn("rule_id", F.col("rule_id") - 1)
    ranks = exact.join(F.broadcast(found.select("rule_id", "p50_ms", "p99_ms")), "rule_id").groupBy("rule_id").agg(
        *[F.avg((F.col("ms") < F.col(c)).cast("int")).alias(f"{c}_below") for c in ("p50_ms", "p99_ms")],
        *[F.avg((F.col("ms") <= F.col(c)).cast("int")).alias(f"{c}_upto") for c in ("p50_ms", "p99_ms")],
    )
    right = lambda c, p: ((F.col(f"{c}_below") <= p + RANK_ERROR) & (F.col(f"{c}_upto") >= p - RANK_ERROR)).cast("int")
    return found.join(ranks, "rule_id").select(
        "rule_id", "events", "min_ms", "max_ms", "avg_ms", right("p50_ms", 0.5).alias("p50_right"), right("p99_ms", 0.99).alias("p99_right")
    )
