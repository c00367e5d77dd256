"""The corpus pipeline: five stages over the documents table, each written and read again.

Every stage takes what the one before it kept. All but the last return the columns of
documents; the last returns the packed pieces.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import decontaminate, line_dedup, ngram_join, packing, quality
from tallyloom.llm.queries import reachable
from tallyloom.session import scratch_folder


def _with_key(docs: DataFrame) -> DataFrame:
    """Documents with a ``_key`` made of the whole row: rows without an id have one too, and rows of
    one key are the same row, so that whatever is decided of one holds for all."""
    parts = [x for c in docs.columns for x in (F.col(c).isNull(), F.col(c))]  # a null alone would leave the hash as it is
    return docs.withColumn("_key", F.xxhash64(*parts))


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``_key`` is among the ids of ``keys``."""
    return docs.join(keys.select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_semi").drop("_key")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    docs = _with_key(docs)
    return _only(docs, quality.outliers(docs, doc_id="_key", judge_all=True).where("kept"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that several documents hold; the length follows the text."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    kept = line_dedup.drop_repeated_lines(docs, keep=others)
    texts = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[texts[c].alias(c) if c in texts else F.col(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, and of rows with that id the one
    with the smallest key; a row without an id only if the group has no other. Texts without words are in no group."""
    columns = docs.columns
    docs = _with_key(docs)
    groups = ngram_join.near_duplicates(docs, doc_id="_key").select(
        F.col("doc_id").alias("_key"), (F.col("n_shingles") == 0).alias("_blank"), "component_id"
    ).distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key", "_blank")
    ids = docs.select("_key", "doc_id").distinct()
    first = groups.join(ids, "_key").groupBy("component_id").agg(F.min(order).alias("first"))
    # equal rows share a key, and one of them is left
    row = F.when(F.col("_blank"), F.monotonically_increasing_id())
    kept = docs.join(first.select("first._key", "first._blank"), "_key").withColumn("_row", row)
    return kept.dropDuplicates(["_key", "_row"]).select(*columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = _with_key(docs)
    found = decontaminate.contamination(docs, items, doc_id="_key", unnamed=True)
    return _only(docs, found.where(~decontaminate.is_contaminated()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in padded batches."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packed),
]

#: Robust estimates and a tokenizer are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = reachable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
