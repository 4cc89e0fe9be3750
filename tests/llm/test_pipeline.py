from collections import defaultdict

import duckdb
import pytest
from test_near_dedup import brute_groups

import corpus_pipeline
from tierstar.llm import common, queries, quality

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        after = common.stored(stage(spark, docs, FOLDER))
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_rejected_documents_go(spark, outputs):
    before, after = outputs[0]
    scores = {r.doc_id: r.score for r in quality.score_documents(before, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    assert {d for d, _ in rows(after)} == {d for d, s in scores.items() if s >= corpus_pipeline.LEAST_QUALITY}


def test_one_of_equal_texts_stays(outputs):
    before, after = outputs[1]
    last = defaultdict(int)
    for d, t in rows(before):
        last[t] = max(last[t], d)
    assert sorted(d for d, _ in rows(after)) == sorted(last.values())


def test_one_of_each_near_group_stays(outputs):
    before, after = outputs[2]
    assert sorted(d for d, _ in rows(after)) == sorted(set(brute_groups(rows(before)).values()))


def test_contaminated_documents_go(outputs):
    before, after = outputs[3]
    con = duckdb.connect()
    documents = before.toPandas()
    con.register("documents", documents)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{FOLDER}/benchmark.parquet'")
    clean = con.execute(f"SELECT doc_id FROM ({queries.ORACLES['op10_decontamination']}) WHERE NOT contaminated").fetchall()
    assert sorted(d for d, _ in rows(after)) == sorted(d for (d,) in clean)


def test_mix_takes_copies_and_columns_stay(outputs):
    before, after = outputs[4]
    given = outputs[0][0].columns
    assert all(a.columns == given for _, a in outputs[:-1]) and after.columns == [*given, "rate", "copies"]
    kept = after.toPandas()
    assert set(kept.doc_id) <= {d for d, _ in rows(before)} and (kept.copies >= 1).all() and (abs(kept.copies - kept.rate) < 1 + 1e-9).all()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, FOLDER))
    assert docs.count() == 0
