import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tierstar.llm import collocations
from tierstar.llm.textarrays import blocks


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, longest=5, top=2000, absorbed=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        big = {p: a for p, a in counts.items() if a >= least}
        found = []
        for p, a in big.items():
            if len(p) < 2:
                continue
            if any(100 * b >= absorbed * a for q, b in big.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def table(spark, rows):
    langs, texts = zip(*rows, strict=True) if rows else ((), ())
    return spark.createDataFrame(pa.table({"lang": pa.array(langs, pa.string()), "text": pa.array(texts, pa.string()), "n": pa.array([1] * len(rows), pa.int64()), "phrase": pa.array(["x"] * len(rows))}))


def found(spark, rows, **options):
    return sorted(tuple(r) for r in collocations.collocations(table(spark, rows), **options).collect())


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(5)
    words = ["aa", "Bb", "çé", "dd", "e", "日本", "aa"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r"]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    rows += [("en", "one two three four five six")] * 25 + [("en", "a a a a a a a")] * 9
    return rows + [("en", None), (None, ""), ("de", "."), ("rare", "once only")]


@pytest.mark.parametrize("options", [{"shards": 2, "row_words": 3}, {"shards": 1, "longest": 3, "top": 4}])
def test_like_brute_force(spark, mixed, options):
    plain = {k: v for k, v in options.items() if k in ("longest", "top")}
    got = found(spark, mixed, least=20, **options)
    assert got == brute(mixed, 20, **plain)
    if not plain:
        phrases = [r[2] for r in got if r[0] == "en"]
        assert "one two three four five" in phrases and "two three four five six" in phrases
        assert "two three" not in phrases


def test_scores_beyond_64_bits(spark):
    row = spark.sql(f"SELECT {10**15} AS a, {10**16} AS n, {10**15 + 7} AS l, {10**15 + 9} AS r")
    assert row.select(collocations.score()).first()[0] == 1000 * 10**31 // ((10**15 + 7) * (10**15 + 9))


def test_nothing_frequent_and_empty_tables(spark):
    assert found(spark, [("en", "a b"), (None, None)], least=3, shards=1) == []
    assert found(spark, [], shards=1) == []


class Sent:
    def __init__(self, value):
        self.value = value


def test_rare_phrases_leave_a_task_as_hashes():
    """A row for each size and range of hashes instead of one for each phrase and block of text; sums over shards are those of the phrases."""
    texts = [" ".join(f"w{k % 900}" for k in range(s, s + 4000)) for s in (0, 50, 7000)]
    full = np.full(collocations.SLOTS // 64, ~np.uint64(0))
    batch = lambda t: pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([t]), pa.array([4000], pa.int32())], ["lang", "words", "own"])
    scan = collocations._scanned(Sent((full, full)), True, 2, 4)
    rows = pa.Table.from_batches(scan(iter([batch(t) for t in texts])))
    assert rows.num_rows <= 2 * 4
    n = Counter()
    for r in rows.to_pylist():
        low, counts = np.frombuffer(r["low"], np.uint32), collocations._unpacked(r["few"], r["many"])
        assert len(low) == len(counts) and np.all(low[1:] > low[:-1])
        n[r["size"]] += counts.sum()
        assert set(counts) <= {12, 13, 14, 15}
    assert n == {1: 12000, 2: 11997}


def test_counts_of_255_and_more():
    n = np.array([1, 254, 255, 256, 10**12])
    assert collocations._unpacked(*collocations._packed(n)).tolist() == n.tolist()


def test_thresholds_are_reached_within_a_cycle():
    rows = lambda kind, size, low, n: (7, kind, size, np.array(low, np.uint32).tobytes(), *collocations._packed(np.array(n)))
    given = [rows(-1, 1, [3, 9], [300, 1]), rows(-1, 1, [9], [2]), rows(0, 1, [9, 11], [4, 90]), rows(0, 1, [9], [3]), rows(1, 1, [3], [])]
    out = collocations._joined(10)(pa.Table.from_arrays(collocations._hash_rows(given), collocations._NAMES)).to_pylist()
    assert [(r["kind"], np.frombuffer(r["low"], np.uint32).tolist(), collocations._unpacked(r["few"], r["many"]).tolist() if r["few"] else []) for r in out] == [(0, [3, 9], [300, 3]), (1, [9, 11], [])]


@pytest.mark.parametrize("cut", [1, 2, 100])
def test_rows_of_long_texts_overlap(cut):
    texts = next(blocks(pa.array(["a b, c d e", "", "f"])))
    rows = [(t, w.tobytes(), n) for t, w, n in collocations.pieces(texts, 3, cut)]
    assert sum(n for _, _, n in rows) == 6
    if cut == 2:
        assert rows == [(0, b"a b\nc d", 2), (0, b"c d e", 2), (0, b"e", 1), (2, b"f", 1)]
