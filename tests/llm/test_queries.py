"""The registered queries against their SQL or brute force, and the pipeline stage by stage."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from dockpulse.llm import decontamination, quality_rules, registry
from tests.llm.rows import documents, edge_rows
from tests.llm.test_near_dedup import brute
from tools.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    relation = duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in relation.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, relation.fetchall())


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
    assert set(registry.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_queries_run(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_pipeline_stages(spark, duck, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    outputs = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        outputs[name] = [r.doc_id for r in docs.collect()]
        if i < len(stages) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    text = {d: r.text for d, r in rows.items()}
    good = [d for d in sorted(rows) if not any(r.rejects(quality_rules.Text(text[d].encode())) for r in quality_rules.RULES)]
    assert sorted(outputs["quality rules"]) == good

    least = brute([(d, text[d]) for d in good])
    assert sorted(outputs["simhash near-dedup"]) == least

    items = [set(zip(*(w[i:] for i in range(5)), strict=False)) for _, t in duck.execute("SELECT * FROM benchmark").fetchall() if (w := decontamination.words_of(t))]
    held = {d for d in least if any(len(s & set(zip(*(decontamination.words_of(text[d])[i:] for i in range(5)), strict=False))) > 0.6 * len(s) for s in items)}
    assert set(outputs["benchmark decontamination"]) == set(least) - held
    assert set(outputs["source mixing"]) == set(outputs["benchmark decontamination"])
    assert sorted(outputs["token output"]) == sorted(outputs["source mixing"])
    assert corpus_pipeline.run(spark, SF).count() == len(outputs["token output"])


CLASHING = ("__id", "__node", "__times", "__copy", "__digest", "__source", "row", "times", "a.b", "digest", "node", "place")


def test_pipeline_on_awkward_tables(spark, folder):
    """Nulls, repeated rows, names that clash, and no rows at all: every stage but the last keeps all columns as they are."""
    texts, ids = edge_rows()
    good = [f"clean text number {i} with more than ten plain words that nothing here rejects at all" for i in range(20)]
    texts, ids = texts + good + good[:3] + good[:1], ids + list(range(100, 120)) + [100, 101, 102] + [None]
    for rows, count in ((texts, len(texts)), ([], 0)):
        docs = documents(spark, rows, ids[:count])
        for i, name in enumerate(CLASHING):
            docs = docs.drop(name).withColumn(name, F.lit(f"keep {i}"))
        names = docs.columns
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = stage(spark, docs, SF)
            assert out.columns == names
            path = f"{folder}/{count}-{i}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            assert all(r[names.index(c)] == f"keep {k}" for r in docs.collect() for k, c in enumerate(CLASHING)), name
        kept = {r.doc_id for r in docs.collect()}
        assert kept >= set(range(100, 120)) | {None} if count else not kept
        assert {r.doc_id for r in corpus_pipeline.tokens(spark, docs, SF).collect()} == kept
