"""Schemas and value domains shared by every module."""

from pyspark.sql import types as T

# --- fixed values: the domains of a rule's enumerated columns ---------------
RULE_STATES = ("ACTIVE", "PAUSE", "DELETE", "CONTROL")
CONTROL_TYPES = (
    "CLEAR_STATE_ALL",
    "CLEAR_STATE_ALL_STOP",
    "DELETE_RULES_ALL",
    "EXPORT_RULES_CURRENT",
)
AGG_FUNCS = ("SUM", "AVG", "MIN", "MAX", "COUNT")
LIMIT_OPERATORS = ("=", "!=", ">=", "<=", ">", "<")
PAYMENT_TYPES = ("CSH", "CRD")
# ---------------------------------------------------------------------------

# A number read from an event. Eight decimals, twenty integer digits; others go on as doubles.
NUMBER = T.DecimalType(28, 8)
# What Spark gives for a sum of NUMBER.
TOTAL = T.DecimalType(38, 8)

INDICATORS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("event_ms", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingestion_time", T.TimestampType()),
    ]
)

AGG_SPEC = T.StructType(
    [T.StructField("field", T.StringType()), T.StructField("func", T.StringType())]
)

RULES = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("rule_state", T.StringType()),
        T.StructField("grouping_keys", T.ArrayType(T.StringType())),
        T.StructField("aggs", T.ArrayType(AGG_SPEC)),
        T.StructField("window_minutes", T.IntegerType()),
        T.StructField("control_type", T.StringType()),
    ]
)

# The external rule table.
RULE_TABLE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("rule_state", T.StringType()),
        T.StructField("grouping_key_names", T.StringType()),
        T.StructField("agg_fields", T.StringType()),
        T.StructField("window_minutes", T.LongType()),
    ]
)

# Mergeable aggregates as a stream writes them, one row per group, window, field and part.
PARTS = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("grouping_keys", T.ArrayType(T.StringType())),
        T.StructField("grouping_values", T.ArrayType(T.StringType())),
        T.StructField("window_start_ms", T.LongType()),
        T.StructField("window_end_ms", T.LongType()),
        T.StructField("field", T.StringType()),
        T.StructField("total", TOTAL),
        T.StructField("n", T.LongType()),
        T.StructField("low", NUMBER),
        T.StructField("high", NUMBER),
        T.StructField("funcs", T.IntegerType()),
        T.StructField("n_overflow", T.LongType()),
        T.StructField("wide_total", T.DoubleType()),
        T.StructField("wide_low", T.DoubleType()),
        T.StructField("wide_high", T.DoubleType()),
        T.StructField("running", T.BooleanType()),
        T.StructField("part", T.LongType()),
        T.StructField("epoch", T.LongType()),
    ]
)

# Long results: one row per group, window and metric.
RESULTS = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("grouping_keys", T.ArrayType(T.StringType())),
        T.StructField("grouping_values", T.ArrayType(T.StringType())),
        T.StructField("window_start_ms", T.LongType()),
        T.StructField("window_end_ms", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", TOTAL),
        T.StructField("n_overflow", T.LongType()),
        T.StructField("approx", T.DoubleType()),
    ]
)
