import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tierstar.llm import vector_codes


def brute(rows, parts=8, entries=16, rounds=6):
    """Rows (vec_id, vector, label) by plain loops: (vec_id, code, error, label_error, digest)."""
    kept = [(i, [math.floor(4096 * x) for x in v], b) for i, v, b in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(e, v, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[nearest(books[p], c[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(held[k]) for x in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(books[p])]
    out, by_label = [], defaultdict(int)
    for (i, _, label), c in zip(kept, cut, strict=True):
        best = [nearest(books[p], c[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, label))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[b], digest) for i, c, e, b in out), key=repr)


def found(spark, rows, kind=None, **options):
    ids, vectors, labels = zip(*rows, strict=True) if rows else ((), (), ())
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(kind or pa.float64())), "label": pa.array(labels, pa.int32()), "row": pa.array(ids, pa.int64()), "v": pa.array(labels, pa.int32())}))
    return sorted((tuple(r) for r in vector_codes.code_report(df, **options).collect()), key=repr)


def vectors(n, width, seed, spread=0.1):
    rng = random.Random(seed)
    return [(rng.randint(0, 3 * n), [rng.gauss(0, spread) for _ in range(width)], rng.choice([0, 1, 2, None])) for _ in range(n)]


@pytest.mark.parametrize(("rows", "options"), [
    (vectors(300, 64, 1), {}),
    (vectors(200, 16, 2) + [(5, [0.25] * 16, 1)] * 150, {"block": 16}),
    (vectors(150, 13, 3), {"parts": 4, "entries": 5, "rounds": 2}),
    (vectors(9, 8, 4), {}),
    (vectors(60, 8, 5, 1e5), {"block": 8}),
])
def test_like_plain_loops(spark, rows, options):
    plain = {k: v for k, v in options.items() if k != "block"}
    assert found(spark, rows, **options) == brute(rows, **plain)


def test_bad_vectors_go(spark):
    bad = [(1, None, 0), (2, [None] * 8, 0), (3, [float("nan")] * 8, 0), (4, [float("inf")] * 8, 1), (900, [0.5] * 9, 1), (None, [0.5] * 8, None)]
    rows = vectors(40, 8, 6) + bad
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, pa.float32()) == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], b) for i, v, b in rows])


def test_numbers_beyond_machine_kernels(spark):
    rows = [(i, [float(x) * 2.0**40 for x in range(i, i + 8)], 0) for i in range(20)]
    got, want = found(spark, rows, entries=3), brute(rows, entries=3)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert got[0][4] == want[0][4]
    assert all(a[2] == min(b[2], (1 << 63) - 1) for a, b in zip(got, want, strict=True))


def test_empty_tables_and_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 0)]) == []
    assert [r[:3] for r in found(spark, [(1, [], 0), (2, [], 0)])] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_neighbours_on_the_curve_are_neighbours_in_space():
    side = np.arange(16)
    points = np.stack(np.meshgrid(side, side), -1).reshape(-1, 2)
    key = vector_codes.hilbert_keys(points * 16, np.zeros(2, np.int64), np.full(2, 256))
    path = points[np.argsort(key)]
    assert len(set(key.tolist())) == 256
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(8)
    for _ in range(50):
        members, book = rng.integers(-9, 9, (20, 3)), rng.integers(-9, 9, (6, 3))
        listed = vector_codes.shortlists(members.min(0)[None], members.max(0)[None], book)[0]
        nearest = ((members[:, None] - book) ** 2).sum(2).argmin(1)
        assert listed[nearest].all()
