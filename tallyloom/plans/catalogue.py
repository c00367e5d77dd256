"""Registry of queries over the test tables, each with its SQL counterpart if it has one."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators.documents import addressed
from tallyloom.sources.rules import parse_rules, usable
from tallyloom.sources.tables import indicators_from_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; bounds and dates are read and printed in UTC."""

    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with its one property as a column."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))


def event_indicators(spark: SparkSession, sf_dir: str, **fields) -> DataFrame:
    """Events by type, with user, value and property as fields."""
    named = {"user_id": "user_id", "value": "value", "k": "k", **fields}
    return indicators_from_table(events(spark, sf_dir), "event_type", "ts", named, keep=["event_id"])


def rule_lines(spark: SparkSession, *lines: str) -> DataFrame:
    """Rules written out as text, read by the parser."""
    frame = spark.createDataFrame(pa.table({"line": list(lines)}))
    return usable(parse_rules(frame)).drop("line")


def flat(results: DataFrame, *more) -> DataFrame:
    """Long results in plain columns."""
    return results.select(
        "rule_id",
        "table_name",
        F.array_join("grouping_values", "|").alias("grp"),
        "window_start_ms",
        "window_end_ms",
        "metric",
        F.coalesce("approx", F.col("value").cast("double")).alias("value"),
        *more,
    )


def flat_documents(results: DataFrame) -> DataFrame:
    return flat(addressed(results), F.col("index").alias("index_name"), "doc_id")


# --- SQL text shared by the counterparts ------------------------------------------------

EV = """ev AS (SELECT event_id, event_type, user_id, value, ts, epoch_us(ts) // 1000 AS ms,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)"""


def sql_aggregate(func: str, field: str) -> str:
    """An aggregate of a column with at most two decimals, without binary rounding."""
    cents = f"CAST(round({field} * 100) AS BIGINT)"
    total = f"CAST(sum({cents}) AS BIGINT)"
    return {
        "SUM": f"{total} / 100::DOUBLE",
        "COUNT": "CAST(count(*) AS DOUBLE)",
        "MIN": f"CAST(min({field}) AS DOUBLE)",
        "MAX": f"CAST(max({field}) AS DOUBLE)",
        "AVG": f"CAST((CASE WHEN {total} < 0 THEN -1 ELSE 1 END) * ((abs({total}) * 200 + count(*)) // (2 * count(*))) AS DOUBLE) / 10000::DOUBLE",
    }[func]


def sql_rule(
    rule_id: int, name: str, keys: list[str], specs: list[tuple[str, str]], minutes: int | None,
    where: str, source: str = "ev", ms: str = "ms",
) -> str:
    """One rule as GROUP BY statements, one per metric; no window with ``minutes=None``."""
    grp = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys) or "''"
    parts = []
    for field, func in specs:
        if minutes is None:
            raise ValueError("a running total needs its own statement")
        size = minutes * 60000
        start = f"CAST({ms} - {ms} % {size} AS BIGINT)"
        parts.append(
            f"SELECT CAST({rule_id} AS INTEGER) AS rule_id, '{name}' AS table_name, {grp} AS grp, "
            f"{start} AS window_start_ms, {start} + {size} AS window_end_ms, "
            f"'{field}-{func}' AS metric, {sql_aggregate(func, field)} AS value "
            f"FROM {source} WHERE {where} GROUP BY 1, 2, 3, 4, 5"
        )
    return " UNION ALL ".join(parts)


def sql_running(
    rule_id: int, name: str, specs: list[tuple[str, str]], minutes: int, where: str, source: str = "ev"
) -> str:
    """A rule without keys: one total over all time, dated by its latest window."""
    size = minutes * 60000
    start = f"CAST(max(ms - ms % {size}) AS BIGINT)"
    return " UNION ALL ".join(
        f"SELECT CAST({rule_id} AS INTEGER) AS rule_id, '{name}' AS table_name, '' AS grp, "
        f"{start} AS window_start_ms, {start} + {size} AS window_end_ms, "
        f"'{field}-{func}' AS metric, {sql_aggregate(func, field)} AS value "
        f"FROM {source} WHERE {where}"
        for field, func in specs
    )
