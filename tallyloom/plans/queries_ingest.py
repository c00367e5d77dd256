"""Ingest queries: event lines, transactions, JSON rows."""

from pyspark.sql import functions as F

from tallyloom.plans.catalogue import EV, event_indicators, events, query, rule_lines, table
from tallyloom.operators.fork import fork
from tallyloom.operators.health import latency_stats, with_latency
from tallyloom.sources.json_rows import from_json_rows, to_json_rows
from tallyloom.sources.lines import accepted, parse_lines, rejected, stamp_ingestion
from tallyloom.sources.transactions import parse_transactions


def _nanos():
    return (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 9).cast("string")


def _text(column: str):
    return F.col(column).cast("string")


def _line(head, body, end):
    return F.concat_ws(" ", head, body, end)


@query(
    "line_protocol_roundtrip",
    f"WITH {EV} SELECT event_id, event_type AS table_name, user_id, value, k, "
    "'\"' || event_type || ' a b\"' AS note, CAST(4 AS INTEGER) AS n_fields, ms AS event_ms FROM ev",
)
def line_protocol_roundtrip(spark, sf_dir):
    ev = events(spark, sf_dir)
    lines = ev.select(
        "event_id",
        _line(
            F.concat(F.col("event_type"), F.lit(",user_id="), _text("user_id")),
            F.concat(
                F.lit("value="), _text("value"), F.lit(",k="), F.col("k"),
                F.lit(',note="'), F.col("event_type"), F.lit(' a b"'),
            ),
            _nanos(),
        ).alias("line"),
    )
    good = accepted(parse_lines(lines))
    return good.select(
        "event_id",
        "table_name",
        F.col("fields")["user_id"].cast("bigint").alias("user_id"),
        F.col("fields")["value"].cast("double").alias("value"),
        F.col("fields")["k"].cast("bigint").alias("k"),
        F.col("fields")["note"].alias("note"),
        F.size("fields").alias("n_fields"),
        "event_ms",
    )


@query(
    "line_protocol_rejects",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 'part count' WHEN 'error' THEN 'bad pair' "
    "WHEN 'purchase' THEN 'bad time' WHEN 'signup' THEN 'no measurement' END AS error "
    "FROM events WHERE event_type <> 'click'",
)
def line_protocol_rejects(spark, sf_dir):
    """Every event as a line, broken in a way of its own for each type but one."""
    ev = events(spark, sf_dir)
    kind = F.col("event_type")
    head = F.when(kind == "signup", F.lit(",,")).otherwise(F.concat(kind, F.lit(",user_id="), _text("user_id")))
    body = F.when(kind == "error", F.concat(F.lit("value="), _text("value"), F.lit(",k="))).otherwise(
        F.concat(F.lit("value="), _text("value"), F.lit(",k=7"))
    )
    end = F.when(kind == "purchase", F.lit("abc")).when(kind != "view", _nanos())
    lines = ev.select("event_id", _line(head, body, end).alias("line"))
    return rejected(parse_lines(lines)).select("event_id", "error")


@query(
    "ingest_dup_keys_last_wins",
    f"WITH {EV} SELECT event_id, event_type AS table_name, value, k, CAST(2 AS INTEGER) AS n_fields FROM ev",
)
def ingest_dup_keys_last_wins(spark, sf_dir):
    lines = events(spark, sf_dir).select(
        "event_id",
        _line(
            F.concat(F.col("event_type"), F.lit(",value=-1,k=x")),
            F.concat(F.lit("k=y,value="), _text("value"), F.lit(",k="), F.col("k"), F.lit("=,")),
            _nanos(),
        ).alias("line"),
    )
    return accepted(parse_lines(lines)).select(
        "event_id",
        "table_name",
        F.col("fields")["value"].cast("double").alias("value"),
        F.col("fields")["k"].cast("bigint").alias("k"),
        F.size("fields").alias("n_fields"),
    )


@query(
    "ingestion_stamp",
    f"WITH {EV} SELECT event_id, event_type AS table_name, ms AS event_ms, CAST(1 AS INTEGER) AS stamped FROM ev",
)
def ingestion_stamp(spark, sf_dir):
    """The stamp itself depends on the clock; it lies after every event and not after now."""
    stamp = F.col("ingestion_time")
    sound = (stamp > F.col("event_time")) & (stamp <= F.current_timestamp())
    return stamp_ingestion(event_indicators(spark, sf_dir)).select(
        "event_id", "table_name", "event_ms", F.when(sound, 1).otherwise(0).alias("stamped")
    )


@query(
    "transactions_csv",
    "SELECT o_orderkey AS transaction_id, epoch_us(o_orderdate) // 1000 AS event_ms, o_custkey AS payee_id, "
    "o_custkey + 1 AS beneficiary_id, CASE o_orderstatus WHEN 'O' THEN 'CSH' WHEN 'F' THEN 'CRD' END AS payment_type, "
    "o_totalprice AS payment_amount, epoch_us(o_orderdate) // 1000 + 5 AS ingestion_ms FROM orders",
)
def transactions_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stamp = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    kind = F.when(F.col("o_orderstatus") == "O", "CSH").when(F.col("o_orderstatus") == "F", "CRD").otherwise("other")
    lines = orders.select(
        F.concat_ws(
            ",", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "o_custkey",
            F.col("o_custkey") + 1, kind, F.col("o_totalprice").cast("string"), stamp + 5,
        ).alias("line")
    )
    good = parse_transactions(lines).filter("error IS NULL")
    return good.select(
        "transaction_id",
        F.unix_millis("event_time").alias("event_ms"),
        "payee_id",
        "beneficiary_id",
        "payment_type",
        F.col("payment_amount").cast("double").alias("payment_amount"),
        "ingestion_ms",
    )


@query(
    "transactions_rejects",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'part count' WHEN 'P' THEN 'bad payment_amount' "
    "ELSE 'bad event_time' END AS error FROM orders",
)
def transactions_rejects(spark, sf_dir):
    status = F.col("o_orderstatus")
    when = F.when(status == "F", F.lit("yesterday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    amount = F.when(status == "P", F.lit("much")).otherwise(F.col("o_totalprice").cast("string"))
    last = F.when(status != "O", F.lit("1"))
    lines = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat_ws(",", "o_orderkey", when, "o_custkey", "o_custkey", F.lit("CSH"), amount, last).alias("line"),
    )
    return parse_transactions(lines).filter("error IS NOT NULL").select("o_orderkey", "error")


@query(
    "json_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def json_roundtrip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    back = from_json_rows(to_json_rows(customer), customer.schema)
    return back.filter("error IS NULL").select(*customer.columns)


@query(
    "latency_stats",
    f"""WITH {EV} SELECT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 3 WHEN 'purchase' THEN 4
  ELSE 5 END AS INTEGER) AS rule_id,
  count(*) AS events, min(k) AS min_ms, max(k) AS max_ms, sum(k) / count(*)::DOUBLE AS avg_ms,
  quantile_disc(k, 0.5) AS p50_ms, quantile_disc(k, 0.99) AS p99_ms
FROM ev GROUP BY 1""",
)
def latency_stats_by_rule(spark, sf_dir):
    """Latency with a 'now' that lies ``k`` milliseconds after each event was read."""
    read = event_indicators(spark, sf_dir).withColumn("ingestion_time", F.col("event_time"))
    rules = rule_lines(
        spark, "1,click,active,user_id,value:sum,60", "2,view,active,user_id&k,value:sum,10",
        "3,error,active,,value:sum,10", "4,purchase,active,k,value:sum,5", "5,signup,active,user_id,value:max,1440",
    )
    now = F.timestamp_millis(F.unix_millis("ingestion_time") + F.col("fields")["k"].cast("bigint"))
    return latency_stats(with_latency(fork(read, rules), now), "rule_id").withColumns(
        {c: F.col(c).cast("bigint") for c in ("p50_ms", "p99_ms")}
    )
