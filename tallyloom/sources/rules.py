"""Rules out of text lines, JSON, rule tables and change records."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.text import parts, settled, whole_number
from tallyloom.model import AGG_FUNCS, CONTROL_TYPES, RULE_STATES, RULES

_JSON_SCHEMA = (
    "ruleId INT, tableName STRING, ruleState STRING, groupingKeyNames ARRAY<STRING>, "
    "aggFields ARRAY<STRUCT<f0: STRING, f1: STRING>>, windowMinutes INT, controlType STRING, "
    "_unreadable STRING"
)


def grouping_keys(text: Column) -> Column:
    """``k1&k2`` as an array; no text means no keys."""
    return F.when(
        F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")
    ).otherwise(F.split(text, "&", -1))


def agg_specs(text: Column) -> Column:
    """``f1:sum&f2:max`` as ``array<struct<field, func>>``; a spec without a function has NULL there."""
    items = F.filter(grouping_keys(text), lambda item: item != "")
    return F.transform(
        items,
        lambda item: F.struct(
            F.get(F.split(item, ":", -1), F.lit(0)).alias("field"),
            F.upper(F.get(F.split(item, ":", -1), F.lit(1))).alias("func"),
        ),
    )


def _checked(df: DataFrame, others: list[str], misread: Column) -> DataFrame:
    """Add ``error``, the first reason a rule cannot be used, to typed rule columns.

    Only a rule that will aggregate needs a table, specs and a window; a pause or a
    delete needs its id alone, a control row not even that.
    """
    is_control = F.coalesce(F.col("rule_state") == "CONTROL", F.lit(False))
    active = F.col("rule_state") == "ACTIVE"
    error = (
        F.when(misread.isNotNull(), misread)
        .when(F.col("rule_id").isNull() & ~is_control, "bad id")
        .when(~F.coalesce(F.col("rule_state").isin(*RULE_STATES), F.lit(False)), "bad state")
        .when(~F.forall("aggs", lambda a: a["field"].isNotNull() & F.coalesce(a["func"].isin(*AGG_FUNCS), F.lit(False))), "bad aggregate")
        .when(F.col("control_type").isNotNull() & ~F.col("control_type").isin(*CONTROL_TYPES), "bad control")
        .when(active & F.col("table_name").isNull(), "no table")
        .when(active & (F.size(F.coalesce("aggs", F.array())) <= 0), "no aggregates")
        .when(active & F.coalesce(F.col("window_minutes") <= 0, F.lit(True)), "bad window")
    )
    return settled(df, others, **{name: F.col(name) for name in RULES.names}, error=error)


def parse_rules(lines: DataFrame, column: str = "line") -> DataFrame:
    """Rule columns plus ``error`` from text, plain or JSON by its first character.

    Plain: ``id,table,state,k1&k2,f1:func&f2:func,minutes``, exactly six parts, state and
    function in any case. JSON: enumerated names in upper case, unknown members ignored.
    The specs of a rule are made distinct here, so a repeated one cannot count twice.
    """
    others = lines.columns
    is_json = F.coalesce(F.substring(column, 1, 1) == "{", F.lit(False))
    step = lines.withColumns(
        {
            "_j": F.when(
                is_json,
                F.from_json(
                    column,
                    _JSON_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"},
                ),
            ),
            "_p": F.when(~is_json, parts(F.col(column), ",")),
        }
    )
    part = lambda i: F.get("_p", F.lit(i))
    either = lambda plain, json: F.when(is_json, json).otherwise(plain)
    json_aggs = F.transform(
        F.coalesce("_j.aggFields", F.array()),
        lambda a: F.struct(a["f0"].alias("field"), a["f1"].alias("func")),
    )
    no_keys = F.array().cast("array<string>")
    minutes = whole_number(part(5), "int")
    step = step.select(
        *others,
        "_j",
        "_p",
        either(whole_number(part(0), "int"), F.col("_j.ruleId")).alias("rule_id"),
        either(part(1), F.col("_j.tableName")).alias("table_name"),
        either(F.upper(part(2)), F.col("_j.ruleState")).alias("rule_state"),
        either(grouping_keys(part(3)), F.coalesce("_j.groupingKeyNames", no_keys)).alias("grouping_keys"),
        F.array_distinct(either(agg_specs(part(4)), json_aggs)).alias("aggs"),
        either(minutes, F.col("_j.windowMinutes")).alias("window_minutes"),
        either(F.lit(None).cast("string"), F.col("_j.controlType")).alias("control_type"),
    )
    misread = (
        F.when(F.col(column).isNull(), "part count")
        .when(is_json & (F.col("_j").isNull() | F.col("_j._unreadable").isNotNull()), "bad json")
        .when(~is_json & (F.size("_p") != 6), "part count")
        .when(~is_json & F.col("rule_id").isNull(), "bad id")
        .when(~is_json & F.col("window_minutes").isNull(), "bad window")
    )
    return _checked(step, others, misread)


def rules_from_table(table: DataFrame) -> DataFrame:
    """Rule columns plus ``error`` from a rule table; columns beyond its own are kept (``seq``).

    Read by column name and type: a NULL grouping column means no grouping. A number that
    does not fit is no number, so its row is rejected and the others are read.
    """
    known = {"id", "table_name", "rule_state", "grouping_key_names", "agg_fields", "window_minutes"}
    others = [c for c in table.columns if c not in known and c != "control_type"]
    control = F.col("control_type") if "control_type" in table.columns else F.lit(None)
    step = table.select(
        *others,
        F.col("id").try_cast("int").alias("rule_id"),
        "table_name",
        F.upper("rule_state").alias("rule_state"),
        grouping_keys(F.col("grouping_key_names")).alias("grouping_keys"),
        F.array_distinct(agg_specs(F.col("agg_fields"))).alias("aggs"),
        F.col("window_minutes").try_cast("int").alias("window_minutes"),
        control.cast("string").alias("control_type"),
    )
    return _checked(step, others, F.lit(None).cast("string"))


def changed_rows(changes: DataFrame) -> DataFrame:
    """The row after each change, with its ``seq``; a physical delete is not a change of rules."""
    return changes.filter(F.col("op") != "d").select("seq", "after.*")


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def unusable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull())


def read_rule_table(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    """Usable rules of a database table. Read again by every run and every micro-batch."""
    return usable(rules_from_table(spark.read.jdbc(url, table, properties=properties)))
