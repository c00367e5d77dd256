"""Result documents and the versioned table they are kept in."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.keys import doc_id, index_name
from tallyloom.functions.windows import bound_text
from tallyloom.model import PARTS, RESULTS
from tallyloom.operators.aggregate import finish, whole

# A document is one group in one window of one index.
_DOC = ["index", "doc_id", "grouping_values"]


def addressed(results: DataFrame) -> DataFrame:
    """Results with the index they go to and the id of their document."""
    return results.withColumns(
        {
            "index": index_name(F.col("table_name")),
            "doc_id": doc_id(F.col("grouping_values"), F.col("window_start_ms"), F.col("window_end_ms")),
        }
    )


def documents(results: DataFrame, time_zone: str | None = None) -> DataFrame:
    """One document per group and window, with the metrics of all rules that share it.

    The number of rows of a document is bounded by the specs of the rules, so they are
    collected by one aggregate. If two rules give the same metric, the higher rule id holds.
    ``approximate`` has the metrics over numbers beyond the decimal type, as doubles.
    """
    rows = addressed(results) if "doc_id" not in results.columns else results
    merged = rows.groupBy(*_DOC).agg(
        F.collect_set("grouping_keys").alias("_names"),
        F.array_sort(F.collect_list(F.struct("metric", "rule_id", "value", "approx"))).alias("_all"),
        *[F.max(b).alias(b) for b in ("window_start_ms", "window_end_ms")],
    )
    following = lambda i: F.get(F.col("_all.metric"), i + 1)
    merged = merged.withColumn(
        "_all",
        F.filter("_all", lambda e, i: following(i).isNull() | (following(i) != e["metric"])),
    ).withColumn("_wide", F.filter("_all", lambda e: e["approx"].isNotNull())).withColumn(
        "_all", F.filter("_all", lambda e: e["approx"].isNull())
    ).withColumns(
        {
            "metrics": F.map_from_arrays("_all.metric", "_all.value"),
            "approximate": F.map_from_arrays("_wide.metric", "_wide.approx"),
        }
    )
    pairs = F.flatten(
        F.transform(
            F.array_sort("_names"),
            lambda names: F.transform(
                names, lambda name, i: F.struct(name.alias("k"), F.get("grouping_values", i).alias("v"))
            ),
        )
    )
    body = merged.withColumn("_pairs", F.array_distinct(pairs)).withColumn(
        "_pairs",
        # a name used twice by one rule keeps its last value
        F.filter(
            "_pairs",
            lambda p, i: ~F.array_contains(
                F.slice(F.col("_pairs.k"), i + 2, F.size("_pairs")), p["k"]
            ),
        ),
    )
    return body.select(
        *_DOC,
        F.map_from_entries("_pairs").alias("fields"),
        bound_text(F.col("window_start_ms"), time_zone).alias("startTime"),
        bound_text(F.col("window_end_ms"), time_zone).alias("endTime"),
        "metrics",
        "approximate",
    )


def document_json(docs: DataFrame) -> DataFrame:
    """Documents as ``(index, doc_id, body)``, the body being one flat JSON object."""
    inner = lambda column: F.regexp_replace(F.to_json(column), r"^\{|\}\z", "")
    bounds = inner(F.struct("startTime", "endTime"))
    members = F.filter(
        F.array(inner(F.col("fields")), bounds, inner(F.col("metrics")), inner(F.col("approximate"))),
        lambda text: text != "",
    )
    body = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    return docs.select("index", "doc_id", body.alias("body"))


def write_versions(results: DataFrame, path: str, batch: int, generation: int = 0) -> None:
    """Put one batch of results into the versioned table at ``path``.

    A batch has a folder of its own which a repeated batch replaces whole, so writing
    it twice changes nothing. Raise ``generation`` when a stream starts over with a new
    checkpoint and counts its batches from 0 again. The rows are spread by index with
    large indexes split, so neither one file per task and index nor one huge file
    comes out.
    """
    (
        addressed(results)
        .hint("rebalance", "index")
        .write.mode("overwrite")
        .partitionBy("index")
        .parquet(f"{path}/generation={generation}/batch={batch}")
    )


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all results."""
    schema = (
        T.StructType(list(RESULTS.fields))
        .add("doc_id", T.StringType())
        .add("generation", T.IntegerType())
        .add("batch", T.LongType())
        .add("index", T.StringType())
    )
    return spark.read.schema(schema).parquet(path)


def current_results(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of every metric of every document.

    A document is the union of its metrics, so results of several rules, and of a rule
    before and after an edit, merge. The version is a number and the value has a fixed
    width: a hash aggregate that reduces before its shuffle.
    """
    versions = read_versions(spark, path)
    version = F.col("generation").cast("bigint") * F.lit(1 << 40) + F.col("batch")
    return latest(versions.withColumn("version", version))


def latest(versions: DataFrame) -> DataFrame:
    """The latest ``version`` per rule, document and metric; running totals move their bounds."""
    return versions.groupBy(
        "rule_id", "table_name", "grouping_keys", "grouping_values", "index", "doc_id", "metric"
    ).agg(
        *[
            F.max_by(name, "version").alias(name)
            for name in ("value", "window_start_ms", "window_end_ms", "n_overflow", "approx")
        ]
    )


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the current results of ``path`` as the first version of a new table."""
    kept = current_results(spark, path).select(*RESULTS.names)
    write_versions(kept, target, batch=0)


# --- the table of a stream: versions of mergeable parts -----------------------------------


def _version() -> Column:
    return F.col("generation").cast("bigint") * F.lit(1 << 40) + F.col("batch")


def write_parts(parts: DataFrame, path: str, batch: int, generation: int = 0, folder: str = "batches") -> None:
    """Put the aggregates that a batch changed into the table at ``path``.

    As :func:`write_versions`, but parts are kept as they are, so those of one group can be added
    up whatever window or day they belong to. A repeated batch replaces its own folder.
    """
    (
        parts.withColumn("index", index_name(F.col("table_name")))
        .hint("rebalance", "index")
        .write.mode("overwrite")
        .partitionBy("index")
        .parquet(f"{path}/{folder}/generation={generation}/batch={batch}")
    )


def batch_parts(spark: SparkSession, path: str, batch: int, generation: int = 0) -> DataFrame:
    """The parts that one batch has written; its folder may hold none."""
    written = spark.read.schema(PARTS).parquet(f"{path}/batches/generation={generation}/batch={batch}")
    return written.select(*PARTS.names)


def read_parts(spark: SparkSession, path: str, folder: str = "batches") -> DataFrame:
    """All versions of all parts."""
    schema = T.StructType(list(PARTS.fields)).add("generation", T.IntegerType()).add("batch", T.LongType()).add("index", T.StringType())
    return spark.read.schema(schema).parquet(f"{path}/{folder}").withColumn("version", _version())


def live_parts(spark: SparkSession, path: str, until: int | None = None) -> DataFrame:
    """The latest version of every part (up to version ``until``): the last compaction and the batches after it."""
    versions = read_parts(spark, path, "batches")
    if until is not None:
        versions = versions.filter(F.col("version") <= until)
    try:
        kept = read_parts(spark, path, "compacted")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        last = kept.agg(F.max("version")).first()[0]
        if last is not None:  # versions are made of folder names only: other folders are not read
            versions = kept.filter(F.col("version") == last).unionByName(versions.filter(F.col("version") > last))
    return latest_parts(versions).select(*PARTS.names)


def latest_parts(versions: DataFrame, *more: str) -> DataFrame:
    """Of every part the latest ``version``; ``more`` columns are functions of the part and kept."""
    # files of tables that knew no epochs have none
    versions = versions.withColumn("epoch", F.coalesce("epoch", F.lit(0).cast("bigint")))
    key = ["rule_id", "table_name", "grouping_keys", "grouping_values", "field", "running", "part", "epoch"]
    window = [F.when(~F.col("running"), F.col(c)).alias(f"_{c}") for c in ("window_start_ms", "window_end_ms")]
    rest = [f.name for f in PARTS.fields if f.name not in key]
    done = versions.groupBy(*key, *window, *more).agg(
        *[F.max_by(c, "version").alias(c) for c in rest], F.max("version").alias("version")
    )
    return done.select(*PARTS.names, "version", *more)


def live_results(spark: SparkSession, path: str, epoch: int | None = None) -> DataFrame:
    """What a stream has computed so far, as long results: parts of a group added up.

    Of tables whose state has been cleared, only what came after counts: the latest epoch in the table, or the
    one given, which is later if no event has come since the command.
    """
    parts = live_parts(spark, path)
    if epoch is None:
        epoch = read_parts(spark, path, "batches").agg(F.coalesce(F.max("epoch"), F.lit(0))).scalar()
    return finish(whole(parts.filter(F.col("epoch") == epoch)))


def compact_parts(spark: SparkSession, path: str) -> None:
    """Gather all versions so far in one folder of the same table; the stream may go on meanwhile.

    Readers take the newest folder, which shows only when it is complete, and the batches after it.
    """
    last = read_parts(spark, path, "batches").select("generation", "batch").agg(
        F.max(F.struct("generation", "batch")).alias("m")
    ).first()["m"]
    if last is not None:
        until = (last["generation"] << 40) + last["batch"]
        write_parts(live_parts(spark, path, until), path, last["batch"], last["generation"], "compacted")
