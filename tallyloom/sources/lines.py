"""Line-protocol events: ``measurement[,tag=v...] field=v[,field=v...] epoch_ns``."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.text import settled, strip_controls, whole_number

# A run without blanks, where a double-quoted stretch may hold any.
_RUN = r'[^" ]*+(?:"[^"]*+"[^" ]*+)*+'
# Two such runs. Quotes pair up from the right, so with an odd number of quotes the
# first run also takes everything up to and including the first quote.
_TWO = rf'^((?:[^"]*+")?{_RUN}) ({_RUN})\z'
# One name=value pair in a comma list: one '=' inside, more only at the end.
_PAIR = r"(?:^|,)([^=,]*)=[^=,]+=*(?=,|\z)"

PART_COUNT = "part count"
NO_MEASUREMENT = "no measurement"
BAD_PAIR = "bad pair"
BAD_TIME = "bad time"


def parse_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Event columns plus ``error``, which is NULL for a good line.

    Tags and fields go into one map; of two equal names the later wins. Works on batch
    and streaming frames; all other columns of ``lines`` are kept.
    """
    kept = lines.columns
    step = lines.select(*kept, strip_controls(F.col(column)).alias("_text"))
    # A readable time holds no quote, so the last blank always comes before it. What is
    # left has to be two runs; only a line with quotes needs the pattern for that.
    step = step.select(
        *kept, "_text", F.substring_index("_text", " ", -1).alias("_time")
    ).select(
        *kept,
        "_time",
        F.left("_text", F.length("_text") - F.length("_time") - 1).alias("_rest"),
    )
    quoted = F.col("_rest").contains('"')
    step = step.select(
        *kept,
        "_time",
        "_rest",
        F.when(quoted, F.regexp_extract("_rest", _TWO, 1))
        .otherwise(F.substring_index("_rest", " ", 1))
        .alias("_1"),
        F.when(quoted, F.regexp_extract("_rest", _TWO, 2))
        .otherwise(F.substring_index("_rest", " ", -1))
        .alias("_2"),
    )
    # without a match, or with more or fewer than two runs, these do not join up again
    step = step.select(
        *kept,
        (F.concat_ws(" ", "_1", "_2") == F.col("_rest")).alias("_has_three"),
        F.rtrim("_1", F.lit(",")).alias("_head"),
        F.rtrim("_2", F.lit(",")).alias("_body"),
        (F.col("_2") != "").alias("_any_body"),
        whole_number(F.col("_time"), "bigint").alias("_ns"),
    )
    # A part of commas only has no pairs at all; an empty part is one bad pair.
    has_tags = F.col("_head").contains(",")
    has_body = (F.col("_body") != "") | ~F.col("_any_body")
    step = step.select(
        *kept,
        "_has_three",
        "_ns",
        "_head",
        "_body",
        F.substring_index("_head", ",", 1).alias("_measurement"),
        has_tags.alias("_tagged"),
        has_body.alias("_filled"),
    )
    tags = F.substr("_head", F.length("_measurement") + 2)
    step = step.select(
        *kept,
        "_has_three",
        "_ns",
        "_measurement",
        (F.col("_head") != "").alias("_named"),
        (F.col("_tagged") | F.col("_filled")).alias("_any_pairs"),
        F.when(F.col("_tagged") & F.col("_filled"), F.concat_ws(",", tags, "_body"))
        .when(F.col("_tagged"), tags)
        .otherwise(F.col("_body"))
        .alias("_list"),
    )
    step = step.select("*", F.regexp_extract_all("_list", F.lit(_PAIR), F.lit(1)).alias("_names"))
    pairs_ok = ~F.col("_any_pairs") | (F.size("_names") == F.size(F.split("_list", ",", -1)))
    # '=' at the end of a pair does not belong to its value
    loose = F.col("_list").contains("=,") | F.col("_list").endswith("=")
    step = step.select(
        *kept,
        "_ns",
        "_measurement",
        "_any_pairs",
        "_names",
        F.when(loose, F.regexp_replace("_list", r"=+(?=,|\z)", "")).otherwise(F.col("_list")).alias("_clean"),
        F.when(~F.coalesce("_has_three", F.lit(False)), PART_COUNT)
        .when(~F.col("_named"), NO_MEASUREMENT)
        .when(~pairs_ok, BAD_PAIR)
        .when(F.col("_ns").isNull(), BAD_TIME)
        .alias("_error"),
    )
    # Equal names are rare: only such a line pays for finding which pairs a later one hides.
    last_of_name = F.array_join(
        F.filter(
            F.split("_clean", ",", -1),
            lambda pair, i: ~F.array_contains(
                F.slice("_names", i + 2, F.size("_names")), F.substring_index(pair, "=", 1)
            ),
        ),
        ",",
    )
    unique = F.when(
        F.size(F.array_distinct("_names")) == F.size("_names"), F.col("_clean")
    ).otherwise(last_of_name)
    good = F.col("_error").isNull()
    fields = F.when(good & F.col("_any_pairs"), F.str_to_map(unique, F.lit(","), F.lit("="))).when(
        good, F.create_map().cast("map<string,string>")
    )
    ms = F.when(good, F.call_function("div", F.col("_ns"), F.lit(1_000_000)))
    return settled(
        step,
        kept,
        table_name=F.when(good, F.col("_measurement")),
        fields=fields,
        event_ms=ms,
        event_time=F.timestamp_millis(ms),
        error=F.col("_error"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull())


def stamp_ingestion(events: DataFrame) -> DataFrame:
    """Add the time of reading; on a stream, the time of the micro-batch."""
    return events.withColumn("ingestion_time", F.current_timestamp())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder of event lines, as a batch."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of event lines, as a stream: new files are new events."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).withColumnRenamed("value", "line")


def indicators_from_lines(lines: DataFrame) -> DataFrame:
    """Good lines as stamped events."""
    return stamp_ingestion(accepted(parse_lines(lines))).drop("line")
