import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tierstar.llm import near_dedup
from tierstar.llm.common import components, contracted_components
from tierstar.llm.near_dedup import classes, probability_jaccard, probminhash, shingles
from tierstar.llm.textarrays import blocks


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())


def weights(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(x, y):
    if set(x.values()) | set(y.values()) <= {1}:
        return len(x.keys() & y.keys()) / max(1, len(x.keys() | y.keys()))
    kinds = Counter((x[j], y[j]) for j in x.keys() | y.keys())
    return sum(n / sum(m * max(p / a, q / b) for (p, q), m in kinds.items()) for (a, b), n in kinds.items() if a and b)


def brute_groups(rows):
    """Class names by doc_id: connected components of all pairs at 0.8 or more, and of equal texts."""
    sets = [weights(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_text = {}
    for i, (_, t) in enumerate(rows):
        parent[i] = by_text.setdefault(t or "", i)
    holders = {}
    for i in by_text.values():
        for k in sets[i]:
            holders.setdefault(k, []).append(i)
    common = Counter((i, j) for h in holders.values() for i in h for j in h if i < j)
    for i, j in common:
        if root(i) != root(j) and similarity(sets[i], sets[j]) >= 0.8:
            parent[root(j)] = root(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return {d: low[root(i)] for i, (d, _) in enumerate(rows)}


def test_estimate_follows_probability_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(5):
        a = [f"w{k}" for k in rng.integers(0, 40, 120)]
        b = a[:100] + [f"v{k}" for k in rng.integers(0, 40, 20)] + a[:30]
        (texts,) = blocks(pa.array([" ".join(a), " ".join(b)]))
        text, hashes, counts = shingles(texts)
        held = probminhash(text, hashes, counts, 2, 4000)
        cut = int(np.searchsorted(text, 1))
        exact = probability_jaccard((hashes[:cut], counts[:cut]), (hashes[cut:], counts[cut:]))
        assert abs(exact - similarity(weights(" ".join(a)), weights(" ".join(b)))) < 1e-9
        assert abs((held[0] == held[1]).mean() - exact) < 0.04


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = brute_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: r.group_id for r in classes(docs).collect()}
    assert got == expected


def test_large_group_of_edited_copies(spark):
    rng = np.random.default_rng(1)
    base = [f"word{k}" for k in rng.integers(0, 5000, 150)]
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 5000, 60))) for i in range(100)]
    for i in range(100, 500):
        copy = base.copy()
        for k in rng.integers(0, 150, 2):
            copy[k] = f"edit{rng.integers(10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.group_id for r in classes(docs).collect()} == brute_groups(rows)


@pytest.mark.parametrize("options", [{}, {"bucket_nodes": 60, "group_nodes": 50}])
def test_copies_alike_only_to_their_original(spark, options):
    rng = np.random.default_rng(6)
    base = [f"word{k}" for k in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1200):
        copy = base.copy()
        for k in rng.choice(np.arange(5, 145), 3, replace=False):
            copy[k] = f"edit{i}x{k}"
        rows.append((i, " ".join(copy)))
    # At most 15 of 146 shingles differ on each side, so every copy is a match of the original.
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.group_id for r in classes(docs, **options).collect()} == {0}


def test_nulls_repeats_short_and_empty(spark):
    rows = [(5, None), (4, ""), (3, "a b"), (2, "A  b"), (1, "a b c"), (7, "x " * 40), (8, "x " * 40), (8, "x " * 40), (None, "a b")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, text string, node int")
    got = sorted((r.doc_id or 0, r.group_id, r.group_size, r.kept) for r in classes(docs).collect())
    assert got == [(0, 2, 3, False), (1, 1, 1, True), (2, 2, 3, True), (3, 2, 3, False), (4, 4, 2, True), (5, 4, 2, False), (7, 7, 3, True), (8, 7, 3, False), (8, 7, 3, False)]
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 7]
    assert classes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_contracted_components(spark, shape):
    rng = np.random.default_rng(2)
    edges = {
        "path": [(i, i + 1) for i in range(300)],
        "star": [(i, 500) for i in range(300)] + [(i, 500) for i in range(20)] + [(7, 7)],
        "random": [(int(x), int(y)) for x, y in rng.integers(0, 400, (300, 2)) if x != y],
        "none": [],
    }[shape]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in contracted_components(df).collect()}
    assert got == {r.node: r.component for r in components(df).collect()} and (shape != "path" or set(got.values()) == {0})


def test_components_compute_their_edges_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long").mapInArrow(counted, "a long, b long")
    assert {r.node: r.component for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}
    assert seen.value == 3
