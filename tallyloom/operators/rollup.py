"""Coarser windows kept up to date: after each batch only the coarse windows that it changed are made anew.

The source is the table of parts that a stream writes. What has come since the last update names the
coarse windows to recompute; of those, and of no others, the finer aggregates are read, brought up to the
latest versions, merged, and written as the windows' next version. Older versions are left behind.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.windows import MINUTE_MS, window_start
from tallyloom.model import PARTS
from tallyloom.operators.aggregate import finish, merge
from tallyloom.operators.documents import latest_parts, read_parts

_MARKS = "version bigint, coarse bigint"


def _existing(spark: SparkSession, schema, path: str) -> DataFrame:
    """What is at ``path``; no rows if there is nothing yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _newest(marks: DataFrame) -> DataFrame:
    return marks.groupBy("coarse").agg(F.max("version").alias("version"))


_FINE = T.StructType([*PARTS.fields, T.StructField("coarse", T.LongType()), T.StructField("version", T.LongType())])


def update_rollup(spark: SparkSession, path: str, target: str, minutes: int) -> list[int]:
    """Bring the roll-up at ``target`` into windows of ``minutes`` up to date with the parts at ``path``.

    Returns the starts of the coarse windows that were made anew: a list of numbers as long as the stretch
    of time that the new batches touch. ``minutes`` has to be a multiple of the windows at hand, and totals
    without a window have no part in it. An update that failed is repeated by the next one; one at a time.
    """
    marks = _existing(spark, _MARKS, f"{target}/marks")
    done = marks.agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]
    parts = read_parts(spark, path).filter((F.col("version") > done) & ~F.col("running"))
    parts = parts.withColumn("coarse", window_start(F.col("window_start_ms"), F.lit(minutes * MINUTE_MS)))
    upto = read_parts(spark, path).agg(F.max("version")).first()[0]
    touched = sorted(row[0] for row in parts.filter(F.col("version") <= upto).select("coarse").distinct().collect()) if upto is not None else []
    if not touched:
        return []
    parts = parts.filter(F.col("version") <= upto)
    held = _newest(marks).filter(F.col("coarse").isin(touched)).collect()
    if held:  # partition values alone: files of other windows and versions are not read
        of_windows = F.lit(False)
        for row in held:
            of_windows = of_windows | ((F.col("coarse") == row["coarse"]) & (F.col("_of") == row["version"]))
        schema = T.StructType([*_FINE.fields, T.StructField("_of", T.LongType())])
        known = spark.read.schema(schema).parquet(f"{target}/fine").filter(of_windows).select(*_FINE.names)
        parts = known.unionByName(parts.select(*_FINE.names))
    fine = latest_parts(parts, "coarse")
    fine.write.mode("overwrite").partitionBy("coarse").parquet(f"{target}/fine/_of={upto}")
    written = spark.read.schema(_FINE).parquet(f"{target}/fine/_of={upto}")
    merged = merge(written.select(*PARTS.names), minutes)
    merged.withColumn("coarse", F.col("window_start_ms")).write.mode("overwrite").partitionBy("coarse").parquet(f"{target}/windows/_of={upto}")
    named = spark.createDataFrame([(upto, c) for c in touched], _MARKS)
    named.coalesce(1).write.mode("overwrite").parquet(f"{target}/marks/_of={upto}")
    return touched


def read_rollup(spark: SparkSession, target: str) -> DataFrame:
    """Long results of the roll-up as of its last update."""
    newest = _newest(spark.read.schema(_MARKS).parquet(f"{target}/marks")).withColumnRenamed("version", "_of")
    windows = spark.read.parquet(f"{target}/windows")
    return finish(windows.join(F.broadcast(newest), ["coarse", "_of"], "left_semi").drop("coarse", "_of"))
