"""The registered queries against their SQL, and the pipeline against a plain version."""

import duckdb
import pytest

import brute
import corpus_pipeline
from tallyloom.llm.queries import ORACLES, QUERIES
from tallyloom.llm.tokens import encoder, vocabulary

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    want = duck.sql(ORACLES[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, FOLDER).select(*columns).collect()
    order = [want.columns.index(c) for c in columns]
    nulls_last = lambda row: [(v is None, v) if v is not None else (True, 0) for v in row]
    assert sorted(map(tuple, got), key=nulls_last) == sorted((tuple(row[k] for k in order) for row in want.fetchall()), key=nulls_last)


def test_one_query_of_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], FOLDER))
    rows = [{r.doc_id: r for r in f.collect()} for f in frames[:5]]
    assert all(f.columns == docs.columns and dict(f.dtypes) == dict(docs.dtypes) for f in frames[1:5])
    assert rows[1].keys() <= rows[0].keys() and 0 < len(rows[1]) < len(rows[0])
    kept = {k: t for k, _, t, _, _ in brute.line_dedup([(k, r.text) for k, r in rows[1].items()])}
    assert {k: r.text for k, r in rows[2].items()} == kept
    assert all(r.n_chars == len(r.text) and r.lang == rows[0][k].lang for k, r in rows[2].items())
    groups = brute.components(sorted(kept.items()))
    assert rows[3].keys() == {k for k, (_, c) in groups.items() if k == c}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    clean = set()
    for k, r in rows[3].items():
        n, hit, _ = brute.contamination(r.text, items)
        if not (hit and 20 * hit >= n):
            clean.add(k)
    assert rows[4].keys() == clean
    packed = frames[5].collect()
    coder = encoder(vocabulary())
    want = {k: len(coder.one(r.text)) // 4 + 1 for k, r in rows[4].items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == want


def test_pipeline_stages_take_odd_rows(spark, docs):
    frame = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id " * 60, "en", "s", 5), (3, "same words " * 60, "en", "s", 9)],
        docs((1, "x")).select("doc_id", "text", "lang", "source").schema.add("n_chars", "long"),
    )
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, FOLDER).collect() is not None
        assert stage(spark, frame.where("doc_id > 99"), FOLDER).collect() == []


def test_decisions_hold_for_rows_without_id_and_repeated_rows(spark, docs, tmp_path):
    item = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    spark.createDataFrame([(None, item)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    words = lambda low: " ".join(f"w{k}" for k in range(low, low + 80))
    schema = docs((1, "x")).select("doc_id", "text", "lang", "source").schema.add("n_chars", "long")
    frame = lambda *rows: spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], schema).repartition(3)
    stages = {name: lambda f, stage=stage: sorted((r.doc_id or 0, r.text) for r in stage(spark, f, str(tmp_path)).collect()) for name, stage in corpus_pipeline.STAGES[:4]}
    assert stages["quality rules"](frame((None, "too short"), (None, words(0)), (2, words(0)), (2, "short"))) == [(0, words(0)), (2, words(0))]
    near = words(0) + " end"
    rows = [(None, words(0)), (None, near), (3, near), (3, near), (5, words(0)), (None, words(200)), (None, words(200)), (7, ""), (7, ""), (None, "")]
    assert stages["n-gram Jaccard join"](frame(*rows)) == [(0, ""), (0, words(200)), (3, near), (7, ""), (7, "")]
    rows = [(None, item), (None, words(0)), (4, "x " + item), (5, words(0)), (5, item)]
    assert stages["benchmark decontamination"](frame(*rows)) == [(0, words(0)), (5, words(0))]


def test_items_without_id_mark_words(spark, duck, docs, monkeypatch):
    from tallyloom.llm import queries

    documents = docs((1, "a lost item here"), (2, "a lost item and a short item"), (3, "nothing"))
    items = spark.createDataFrame([(None, "lost item"), (None, "nothing"), (2, "short item")], "item_id int, text string")
    monkeypatch.setattr(queries, "table", lambda spark, sf_dir, name: documents if name == "documents" else items)
    name = "op4_benchmark_decontamination"
    own = duckdb.connect()
    for view, frame in (("documents", documents.select("doc_id", "text").toPandas()), ("benchmark", items.toPandas().astype({"item_id": "Int64"}))):
        own.register(view, frame)
    want = own.sql(ORACLES[name])
    got = QUERIES[name](spark, "").select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall()) and all(r.n_hit for r in got)
