"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_queries_against_sql(spark):
    from docgrain.llm import queries

    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{k}" for k in range(1, 14)]
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SF)
        cols = sorted(df.columns)
        assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(duckdb_rows(c, sql, cols), key=repr), name


def duckdb_rows(c, sql, cols):
    return c.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()


def test_pipeline(spark):
    import corpus_pipeline as p
    from docgrain.llm import decontaminate, quality
    from docgrain.llm.common import materialize

    names = [n for n, _ in p.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    at = {"": docs}
    for name, f in p.STAGES:
        docs = materialize(f(spark, docs, SF), f"test-{name}")
        at[name] = docs
    assert all(at[n].columns == at[""].columns for n in names[:-1])
    good = {r.doc_id for r in quality.score_documents(at[""], labels).where("predicted = 1").collect()}
    assert sorted(r.doc_id for r in at["quality"].collect()) == sorted(good)
    assert at["near_duplicates"].groupBy("text").count().where("count > 1").count() == 0
    assert at["near_duplicates"].join(at["quality"], "doc_id", "left_anti").count() == 0
    hits = {r.doc_id for r in decontaminate.decontaminate(at["near_duplicates"], spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert {r.doc_id for r in at["decontamination"].collect()} == {r.doc_id for r in at["near_duplicates"].collect()} - hits
    assert at["mixing"].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    last = at["sharding"]
    assert last.count() == at["mixing"].count()
    sizes = [r["count"] for r in last.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and last.select("shard", "slot").distinct().count() == last.count()


@pytest.mark.parametrize("table", ["documents"])
def test_run(spark, table):
    import corpus_pipeline as p

    out = p.run(spark, SF)
    assert {"shard", "slot"} <= set(out.columns) and out.count() > 0
