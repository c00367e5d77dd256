"""The operators over whole tables, and SQL for those that SQL can express."""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import (
    cover_search, decontaminate, importance, line_dedup, lm, ngram_join, packing, quality, separators, spelling,
    suffix_dedup, token_files, warc,
)
from tallyloom.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def reachable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, if it is not installed there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    held = spark.sparkContext.environment
    paths = [p for p in held.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        held["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(reachable(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Lower-case A-Z alone, as SQL.
SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL_LINES = """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k
  FROM documents
), keyed AS (
  SELECT doc_id, k, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, k, line, last IS NOT NULL AND doc_id < last AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

SQL_CONTAMINATION = f"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all({SQL_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), cut_items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all({SQL_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS k FROM cut_items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM cut, sizes WHERE len(w) >= size)
), found AS (
  SELECT doc_id, k, size, item_id FROM doc_windows JOIN item_windows USING (size, win)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM found)) GROUP BY 1
), owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM cut LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)"""


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    separators.write_flat(table(spark, sf_dir, "documents"), folder)
    return separators.count_tokens(spark, folder)


@query("op2_line_dedup", SQL_LINES)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op4_benchmark_decontamination", SQL_CONTAMINATION)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


SQL_JACCARD = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all({SQL_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM cut WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY 1, 2, s.n, t.n HAVING 100 * count(*) >= 75 * (s.n + t.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT links.v, reach.c FROM reach JOIN links ON links.u = reach.doc_id
)
SELECT doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


@query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op6_warc_derivatives")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses_of(table(spark, sf_dir, "pages")), keep=("page_id",))


@query("op7_ngram_jaccard_join", SQL_JACCARD)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outliers(table(spark, sf_dir, "documents"), judge_all=True).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2"
    )


@query("op9_token_binary_output")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_files.read_tokens(spark, folder)


@query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.backoff_scores(table(spark, sf_dir, "documents"), least=1, order=3, folds=4)


#: The table of CRC-32 by its rule, and the checksum of a text over it.
SQL_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS tab
  FROM range(0, 256) r(i)
)"""


def sql_crc(text: str) -> str:
    byte = f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)"
    steps = f"list_transform(range(0, octet_length(encode({text}))), lambda i: {byte})"
    return f"xor(list_reduce({steps}, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"


SQL_IMPORTANCE = f"""
WITH {SQL_CRC_TABLE}, texts AS (
  SELECT doc_id, text, true AS ours FROM documents UNION ALL SELECT NULL, text, false FROM benchmark
), cut AS (
  SELECT doc_id, ours, regexp_extract_all({SQL_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), grams AS (
  SELECT doc_id, ours, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM (SELECT doc_id, ours, w, unnest(range(1, len(w) + 1)) AS k FROM cut), range(1, 4) s(size) WHERE k + size - 1 <= len(w)
), named AS (
  SELECT g, {sql_crc('g')} % 10000 AS bucket FROM (SELECT DISTINCT g FROM grams), crc_table
), held AS (SELECT doc_id, ours, bucket FROM grams JOIN named USING (g)),
totals AS (SELECT count(*) FILTER (ours) AS s_all, count(*) FILTER (NOT ours) AS t_all FROM held),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM held GROUP BY 1), totals
), weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM held JOIN gains USING (bucket) WHERE ours GROUP BY 1
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM cut LEFT JOIN weights USING (doc_id) WHERE ours
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_words >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank
FROM placed"""

SQL_SPELLING = f"""
WITH RECURSIVE {SQL_CRC_TABLE}, runs AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all({SQL_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents
  ) GROUP BY 1, 2
), hashed AS (SELECT w, c, {sql_crc("(doc_id || ':' || w)")} AS h FROM runs, crc_table),
altered AS (
  SELECT c, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM altered WHERE length(word) >= 5 GROUP BY 1 HAVING sum(c) >= 3
), less AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, place) AS other, max(other_n) AS other_n
  FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near) GROUP BY 1
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS depth FROM formed
  UNION ALL SELECT chain.word, f.form, depth + 1 FROM chain JOIN formed f ON f.word = chain.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM formed JOIN (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY 1) USING (word)"""

SQL_TOP_PRODUCTS = """
WITH usable AS (
  SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM usable q JOIN usable r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored) WHERE place <= 5"""


@query("op11_importance_resampling", SQL_IMPORTANCE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_spelling_variants", SQL_SPELLING)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op13_top_products", SQL_TOP_PRODUCTS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_search.top_products(table(spark, sf_dir, "embeddings"))
