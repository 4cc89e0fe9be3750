import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierstar.llm import queries
from tierstar.llm.repeat_removal import LENGTH, anchors, remove_repeats, repeats_by_column


def brute(texts: list[bytes]) -> list[tuple[int, int, bytes]]:
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i + 1 : i + LENGTH + 1] = True
        out.append((int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(5, 14), st.integers(2, 5), st.integers(0, 1 << 30))
def test_columns_against_brute_force(rows, width, length, seed):
    rng = np.random.default_rng(seed)
    contexts = rng.integers(1, 3, (rows, width)).astype(np.uint16)
    for i in range(rows):  # as at the ends of texts
        contexts[i, : rng.integers(0, 3)] = 0
        contexts[i, width - rng.integers(0, 3) :] = 0
    found = repeats_by_column(contexts, length)
    for i in range(rows):
        for c in range(width - length + 1):
            own = contexts[i, c : c + length]
            other = any((contexts[j, c : c + length] == own).all() for j in range(rows) if j != i)
            assert found[i, c] == (other and bool((own > 0).all()))


def _check(spark, texts, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(docs, **options).collect()}
    expected = brute([(t or "").encode() for t in texts])
    assert len(got) == len(texts)
    for i, (n, spans, kept) in enumerate(expected):
        r = got[i]
        assert (sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) == (n, spans, kept), i


@pytest.fixture(scope="module")
def hard_texts():
    rng = np.random.default_rng(4)
    word = lambda n: "".join(rng.choice(list("abcdefghij é "), n))
    passage, other = word(320), word(199)
    texts = [None, "", "a" * 700, "a" * 199, "ab" * 300, passage, word(300) + passage + word(90), passage[60:] + word(200) + passage[:210], other, word(10) + other]
    texts += [word(int(rng.integers(0, 260))) + passage[: int(rng.integers(150, 320))] + word(int(rng.integers(0, 260))) for _ in range(40)]
    texts += [texts[6], texts[6], word(5000) + passage + word(100) + passage]
    edited = list(word(900))
    for _ in range(20):
        copy = edited.copy()
        copy[int(rng.integers(900))] = "Z"
        texts.append("".join(copy))
    return texts


@pytest.mark.parametrize("options", [{}, {"collection": 7}, {"sorted_contexts": 2}])
def test_hard_texts(spark, hard_texts, options):
    _check(spark, hard_texts, **options)


def test_texts_cut_into_pieces(spark, monkeypatch):
    rng = np.random.default_rng(9)
    long = "".join(rng.choice(list("abcd"), 5_000_000))
    _check_long = long[:1_048_500] + long[100:600] + long[1_048_500:]
    docs = spark.createDataFrame([(1, _check_long)], "doc_id long, text string")
    (row,) = remove_repeats(docs).collect()
    assert sum(s.end - s.start for s in row.spans) == 1000 and len(row.spans) == 2


@pytest.mark.parametrize("piece", [90, 1000, 4096])
def test_cuts_change_no_anchor(piece):
    rng = np.random.default_rng(10)
    text = bytes(rng.choice(list(b"abcd"), 30_000)) + b"a" * 3000 + b"bcab" * 500
    (whole,), (cut,) = (list(anchors(pa.array([text], pa.binary()), p)) for p in (1 << 20, piece))
    for x, y in zip(whole, cut, strict=True):
        assert np.array_equal(x, y)


def test_texts_beyond_16_mb_keep_clean_bytes(spark):
    rng = np.random.default_rng(11)
    docs = spark.createDataFrame([(1, rng.integers(97, 123, (1 << 24) + 1000, dtype=np.uint8).tobytes().decode())], "doc_id long, text string")
    (row,) = remove_repeats(docs).select("spans").collect()
    assert row.spans == []


def test_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([r.text.encode() for r in rows])
    got = {r.doc_id: r for r in queries.QUERIES["op3_repeat_removal"](spark, folder).collect()}
    for r, (n, spans, kept) in zip(rows, expected, strict=True):
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == (len(r.text.encode()), n, spans, hashlib.sha256(kept).hexdigest())


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x" * 50 + "y" * 200, 1), (1, "x" * 50 + "y" * 200, 2), (None, None, 3)], "doc_id int, text string, spans int")
    got = remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in got) == [(0, 0, 0), (1, 250, 0), (1, 250, 0)]
    assert remove_repeats(docs.limit(0)).count() == 0


def test_equal_rows_keep_their_runs_once(spark):
    rng = np.random.default_rng(8)
    text = "".join(map(chr, rng.integers(97, 123, 700)))
    docs = spark.createDataFrame([(7, text)] * 2000 + [(8, "other " + text[:300])], "doc_id long, text string")
    got = remove_repeats(docs).select("doc_id", "n_bytes", F.size("spans").alias("n"), F.length("kept").alias("kept")).groupBy("doc_id", "n_bytes", "n", "kept").count().collect()
    assert sorted((r.doc_id, r.n_bytes, r.n, r.kept, r["count"]) for r in got) == [(7, 700, 1, 0, 2000), (8, 306, 1, 6, 1)]


def test_texts_are_shuffled_once(spark, hard_texts, tmp_path):
    """Also with anchors whose windows are compared by fingerprints."""
    spark.createDataFrame([(i, t) for i, t in enumerate(hard_texts)], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = remove_repeats(spark.read.parquet(str(tmp_path / "docs")), sorted_contexts=2)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(re.findall(r"FileScan parquet \[doc_id#\d+L?,text#", plan)) == 1 and "ReusedExchange" in plan
