import numpy as np
import pyarrow as pa

from tierstar.llm import quality
from tierstar.llm.textarrays import blocks


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    out = scored[scored.held_out]
    assert len(out) > 500 and (out.predicted == out.quality).mean() > 0.97
    assert out[out.quality == 1].predicted.mean() > 0.98


def test_gradient():
    rng = np.random.default_rng(0)
    documents = [rng.standard_normal((k, quality.N_FEATURES)).astype(np.float32) for k in (1, 3, 2, 5)] * 20
    y = np.array([float(d[:, 0].max() > 0.8) for d in documents], np.float32)
    model = quality.fit(documents, y, np.ones(len(y), np.float32), epochs=150)
    begin = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
    assert ((model.score(np.concatenate(documents), begin) > 0.5) == y).mean() > 0.95


def test_every_passage_counts():
    text = " ".join(["plain words here."] * 400)
    (texts,) = blocks(pa.array([text, None, "", " \n ", "one"]))
    features, begin = quality.passages(texts)
    assert list(np.diff(begin)) == [8, 1, 1, 1, 1] or list(np.diff(begin)) == [12, 1, 1, 1, 1]
    assert features[begin[1] : begin[3]].sum() == 0


def test_nulls_and_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 0.0), (1, "", 0.0), (None, "a", 0.0)], "doc_id int, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, None)], "doc_id int, quality int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(docs.limit(0), labels).count() == 0
