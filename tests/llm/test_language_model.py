import re
import resource
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tierstar.llm import language_model as lm


def tokens(text):
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def test_contract_columns_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    held = {r.doc_id: crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows}
    counts = Counter(t for r in rows if not held[r.doc_id] for t in tokens(r.text))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in lm.score_held_out(docs).collect()}
    assert len(got) == len(rows)
    gain = 0.0
    for r in rows:
        own, g = tokens(r.text), got[r.doc_id]
        base = sum(np.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[r.doc_id], len(own), sum(counts[t] > 0 for t in own), n)
        assert g.base_score == pytest.approx(base, rel=1e-9)
        gain += (g.score - g.base_score) * held[r.doc_id]
    assert gain > 0  # the model predicts held-out documents better than the counts alone


def test_words_outside_the_hot_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = lm.corpus_counts(docs).cache()
    few, many = (lm.train(docs, counts, hot_words=k) for k in (50, 1 << 19))
    many.network = few.network
    one, other = ({r.doc_id: r for r in lm.score(docs, m, counts).collect()} for m in (few, many))
    for d, r in one.items():
        assert r.score == pytest.approx(other[d].score, rel=1e-9) and r.base_score == pytest.approx(other[d].base_score, rel=1e-9)
        assert r.n_known == r.n_tokens == other[d].n_known


def test_gradient_of_a_window():
    rng = np.random.default_rng(0)
    net = lm.Network.drawn(np.full(lm.N_CLASSES, 1 / lm.N_CLASSES))
    for k in ("E", "R", "O", "o"):
        setattr(net, k, getattr(net, k).astype(float))
    x, y = rng.integers(0, lm.N_CLASSES, (2, 6, 4))
    live = rng.random((6, 4)) > 0.2
    h = np.zeros((4, lm.HIDDEN))
    _, g, _ = net.window_gradient(x, y, live, h)
    for k in ("E", "R", "O", "o"):
        a = getattr(net, k)
        at = np.unravel_index(np.abs(g[k]).argmax(), a.shape)
        old, e = a[at], 1e-5
        a[at] = old + e
        up = net.window_gradient(x, y, live, h)[2]
        a[at] = old - e
        down = net.window_gradient(x, y, live, h)[2]
        a[at] = old
        assert g[k][at] * live.sum() == pytest.approx((up - down) / (2 * e), rel=1e-4)


def test_side_by_side_like_one_by_one():
    rng = np.random.default_rng(5)
    model = lm.Model(lm.Network.drawn(np.full(lm.N_CLASSES, 1 / lm.N_CLASSES)), *[np.zeros(0)] * 3, np.zeros(lm.N_CLASSES), 0.0, 0, 0)
    documents = [np.append(rng.integers(1, lm.N_CLASSES, k), 0) for k in (0, 5, 900, 31, 5)]
    together = model.class_log10(documents)
    assert together == pytest.approx([model.class_log10([d])[0] for d in documents], rel=1e-5)


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "a B b", 2)], "doc_id int, text string, score int")
    got = sorted((r.n_tokens, r.base_score <= 0) for r in lm.score_held_out(docs).collect())
    assert got == [(1, True), (1, True), (4, True)]
    assert lm.score_held_out(docs.limit(0)).count() == 0
    nothing = docs.limit(0)
    counts = lm.corpus_counts(nothing)
    assert [r.n_known for r in lm.score(docs, lm.train(nothing, counts), counts).collect()] == [0, 0, 0]


def test_every_token_is_learned_from(spark):
    """Only the order of the words behind the first 2000 differs, so all counts are equal: the network must not be."""
    tails = ["aa bbbbbbb " * 600, "aa " * 600 + "bbbbbbb " * 600]
    fitted = []
    for tail in tails:
        docs = spark.createDataFrame([(i, "c dddddd. " * 1500 + tail) for i in range(3)], "doc_id long, text string").coalesce(1)
        fitted.append(lm.train(docs, lm.corpus_counts(docs).cache(), rounds=1, group_tokens=1 << 20))
    one, other = fitted
    assert one.train_tokens == other.train_tokens == 3 * (3000 + 1200 + 1)
    assert np.abs(one.network.R - other.network.R).max() > 1e-3


def test_groups_are_averaged_by_tokens(spark):
    rng = np.random.default_rng(3)
    learner = lm.Learner.begin(np.full(lm.N_CLASSES, 1 / lm.N_CLASSES))
    groups = {0: [rng.integers(1, lm.N_CLASSES, n).astype(np.uint8) for n in (3, 700)], 1: [rng.integers(1, lm.N_CLASSES, 40).astype(np.uint8)]}
    rows = [(0, g, bytearray(d.tobytes())) for g, some in groups.items() for d in some]
    got = lm.averaged(learner, spark.createDataFrame(rows, "round long, group long, classes binary"), 0.0, 1.0)
    wanted, tokens = 0.0, 0
    for some in groups.values():
        own, n = learner.filled(learner.flat()), sum(map(len, some))
        own.learn(some)
        wanted, tokens = wanted + own.flat() * n, tokens + n
    assert got == pytest.approx(wanted / tokens, rel=1e-5, abs=1e-7)
    nothing = spark.createDataFrame([], "round long, group long, classes binary")
    assert (lm.averaged(learner, nothing, 0.0, 1.0) == learner.flat()).all()


def test_places_of_hashes():
    rng = np.random.default_rng(3)
    few_leads = np.uint64(5) << np.uint64(60)
    for hashes in (np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64)), np.unique(rng.integers(0, 300, 100, dtype=np.uint64) | few_leads), np.array([2**64 - 1], np.uint64)):
        asked = np.concatenate([hashes, rng.integers(0, 1 << 64, 500, dtype=np.uint64), rng.integers(0, 300, 200, dtype=np.uint64) | few_leads, np.array([0, 2**64 - 1], np.uint64)])
        place, there = lm.places(hashes, lm.begins(hashes), asked)
        assert there.tolist() == np.isin(asked, hashes).tolist()
        assert (hashes[place[there]] == asked[there]).all() and place.max() < len(hashes)


def test_learning_keeps_its_memory():
    """Temporaries are not handed back to the system between the windows, which would clear their pages each time."""
    net = lm.Network.drawn(np.full(lm.N_CLASSES, 1 / lm.N_CLASSES))
    x = np.random.default_rng(1).integers(0, lm.N_CLASSES, (lm.WINDOW, lm.ROWS))
    learn = lambda n: [net.window_gradient(x, x, x >= 0, np.zeros((lm.ROWS, lm.HIDDEN), np.float32)) for _ in range(n)] and None
    for _ in range(5):
        learn(1)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    for _ in range(20):
        learn(1)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before < 20 * 200
