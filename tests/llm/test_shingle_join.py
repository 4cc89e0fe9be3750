import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tierstar.llm import shingle_join
from tierstar.llm.textarrays import blocks


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows):
    """Sorted (doc_id, n_shingles, component_id, component_size) by all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and label[i] != label[j] and 100 * len(x & y) >= 85 * len(x | y):
                label = [label[j] if k == label[i] else k for k in label]
    out = []
    for i, (d, _) in enumerate(rows):
        same = [rows[k][0] for k in range(len(rows)) if label[k] == label[i]]
        out.append((d, len(sets[i]), min((x for x in same if x is not None), default=None), len(same)))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    ids, texts = zip(*rows, strict=True) if rows else ((), ())
    docs = spark.createDataFrame(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "node": pa.array(ids, pa.int64()), "n": pa.array(texts, pa.string())}))
    return sorted((tuple(r) for r in shingle_join.join_report(docs, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def edited():
    """Families of edited copies, some of them alike only to their original, and texts that share a passage only."""
    rng = random.Random(7)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passage = text(40)
    out = []
    for f in range(12):
        base = text(rng.choice([8, 30, 120, 400]))
        out.append(base)
        for _ in range(rng.randrange(9)):
            copy = list(base)
            for _ in range(rng.randrange(1, 1 + max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            out.append(copy)
        out.append(text(30 * f) + passage + text(20))
    rows = [(i, " ".join(t)) for i, t in enumerate(out)]
    rng.shuffle(rows)
    return rows + [(1000 + i, t) for i, t in enumerate(["", None, "a", "A", "a b c", "a  b\tc", "a b c d", " \n", "é à"])] + rows[:5] + [(7, "a"), (None, "a b c"), (None, "lone text of a null id")]


@pytest.mark.parametrize("options", [{}, {"leader_sets": 3, "group_sets": 3}, {"list_sets": 1}])
def test_like_all_pairs(spark, edited, options):
    assert found(spark, edited, **options) == brute(edited)


def test_copies_alike_only_to_their_original(spark):
    # Three words of 200 changed: 185 of 209 shingles in common with the original, mostly 177 of 217 or less with each other.
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for i in range(240):
        copy = list(base)
        for at in rng.sample(range(5, 195, 5), 3):
            copy[at] = f"x{i}-{at}"
        rows.append((i, " ".join(copy)))
    got = found(spark, rows, leader_sets=50, group_sets=20)
    assert {r[2:] for r in got} == {(0, 241)}


def test_whole_long_texts(spark):
    long = [f"w{i % 50_000}" for i in range(300_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:50_000] + ["other"])), (3, " ".join(long[:40_000])), (4, "w1 w2 w3 w4")]
    assert found(spark, rows) == brute(rows)


def test_nothing_to_link(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, ""), (2, None)]) == [(1, 0, 1, 1), (2, 0, 2, 1)]


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(103)]
    # 100 shingles; of the first 85 words 82 shingles are left, of the first 88 words 85.
    rows = [(1, " ".join(words)), (2, " ".join(words[:87])), (3, " ".join(words[:88]))]
    assert found(spark, rows[:2]) == [(1, 100, 1, 1), (2, 84, 2, 1)]
    assert found(spark, [rows[0], rows[2]]) == [(1, 100, 1, 2), (3, 85, 1, 2)]


def test_answers_are_derived_from_close_sets():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k:], rng.integers(0, 1 << 60, k, dtype=np.uint64)])) for k in range(20)]
    answers = shingle_join.Answers(sets)
    for k, x in enumerate(sets):
        assert answers.of(k).tolist() == [len(np.intersect1d(x, y)) for y in sets]
    assert answers.derived == 19


def test_blocks_are_skipped_only_where_no_link_can_be():
    rng = np.random.default_rng(4)
    for _ in range(100):
        n = rng.integers(2, 9)
        lists, size = rng.integers(0, 2, n), rng.integers(1, 40, n)
        pos = (rng.random(n) * (size - -(-85 * size // 100) + 1)).astype(int)
        order = np.lexsort((pos, size, lists))
        lists, size, pos, count = lists[order], size[order], pos[order], rng.integers(1, 3, n)
        label = shingle_join.live_blocks(lists, size, pos, count, 85)
        for i in range(n):
            for j in range(i, n):
                if lists[i] == lists[j] and (i != j or count[i] > 1) and 185 * min(size[i] - pos[i], size[j] - pos[j]) >= 85 * (size[i] + size[j]) and 100 * min(size[i], size[j]) >= 85 * max(size[i], size[j]):
                    assert label[i] == label[j] >= 0


def test_cells_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    for n in (5, 60, 700):
        base = rng.integers(0, 1 << 60, n, dtype=np.uint64)
        sets = [np.unique(base[rng.permutation(n)[: max(1, int(n * share))]]) for share in (1, 0.97, 0.93, 0.9, 0.7)]
        sets.append(np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64)))
        sizes = np.array([len(s) for s in sets])
        label = np.arange(len(sets))
        for a, b in shingle_join.likely(sizes, [shingle_join.cells(s) for s in sets], 85):
            label[label == label[b]] = label[a]
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y)):
                    assert label[i] == label[j]


def test_sets_of_texts():
    texts = next(blocks(pa.array(["A b c d e a b c d", "x", "", "a b"])))
    _, h, begin = shingle_join.shingle_sets(texts)
    assert np.diff(begin).tolist() == [5, 1, 0, 1]
    assert len(set(h.tolist())) == 7
