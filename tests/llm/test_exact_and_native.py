"""Operators with SQL: against DuckDB on given tables and on rows that are hard."""

import duckdb
import pandas as pd
import pytest

from tierstar.llm import decontaminate, exact_dedup, license_scan, queries

ROWS = [
    (1, None, "a"), (2, "", "b"), (3, "same text", "c"), (3, "same text", "c"), (4, "same text", "d"), (None, "same text", "e"), (5, "Same text", "f"),
    (6, "x " * 50_000 + "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "g"),
    (7, "One, TWO three-four five six seven eight nine ten eleven twelve THIRTEEN", "h"), (8, "short item", "i"), (9, "é short item ü", "j"),
    (10, "All rights reserved. Released under the MIT License.\nOther words.", "k"), (11, "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0", "l"),
]
ITEMS = [("q1", "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), ("q2", "Short ITEM"), ("q3", None), ("q4", "... !"), (None, "short item")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id int, text string, words string")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


def test_exact_groups(docs):
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark_copies(docs).collect())
    assert got[:7] == [(0, 4, 4, False), (1, 2, 2, False), (2, 2, 2, True), (3, 4, 4, False), (3, 4, 4, False), (4, 4, 4, True), (5, 5, 1, True)]
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9, 10, 11]
    twice = docs.filter("doc_id = 3")
    assert exact_dedup.keep_one(twice).count() == 1
    assert exact_dedup.mark_copies(docs.limit(0)).count() == exact_dedup.keep_one(docs.limit(0)).count() == 0


def test_windows(docs, items):
    got = {r.doc_id: (r.n_hit, r["items"], r.contaminated) for r in decontaminate.judge(docs.filter("doc_id is not null and doc_id <> 3"), items).collect()}
    assert got[6] == (14, ["q1"], False) and got[7] == (13, ["q1"], True)
    assert got[8] == (2, ["", "q2"], True) and got[9] == (2, ["", "q2"], True)
    assert got[1] == (0, [], False) and got[10] == (0, [], False)
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and not {7, 8, 9} & {r.doc_id for r in kept.collect()} and kept.count() == len(ROWS) - 3
    assert decontaminate.judge(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.judge(docs.limit(0), items).count() == 0


def test_rules(docs):
    got = {r.doc_id: (r.n_known, r.n_unmatched, r.licenses) for r in license_scan.scan(docs).collect()}
    assert got[10] == (2, 0, "MIT,All-rights-reserved") and got[11] == (4, 0, "Apache-2.0") and got[1] == (0, 0, "")
    assert license_scan.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_like_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, folder).toPandas()
    key = {"op11_collocations": ["lang", "rank"], "op13_vector_codes": ["vec_id"]}.get(name, ["doc_id"])
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True)[sorted(got)], want.sort_values(key, ignore_index=True)[sorted(want)], check_dtype=False)
