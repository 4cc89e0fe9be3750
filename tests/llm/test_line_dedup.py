import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierstar.llm import line_dedup
from tierstar.llm.line_dedup import candidates, dedup_report, forest, matching, remove_later_lines
from tierstar.llm.textarrays import mix

FOLDER = "/root/testdata/sf0.001"


def words(line):
    return frozenset(re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), line.encode())))


def brute(rows):
    """By document: lines, removed line numbers, links, class id; and the text that is left."""
    lines = sorted((d, n, words(s)) for d, t in rows for n, s in enumerate((t or "").split("\n")) if words(s))
    sets = sorted({w for _, _, w in lines}, key=sorted)
    earliest = {}
    for d, n, w in lines:
        earliest.setdefault(w, (d, n))
    alike = {w: [] for w in sets}
    for i, x in enumerate(sets):
        for y in sets[:i]:
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y):
                alike[x].append(y)
                alike[y].append(x)
    out = {d: {"gone": set(), "links": 0, "first": d} for d, _ in rows}
    for d, n, w in lines:
        low = min([earliest[w], *[earliest[y] for y in alike[w]]])
        out[d]["links"] += len(alike[w])
        out[d]["first"] = min(out[d]["first"], low[0])
        if low < (d, n):
            out[d]["gone"].add(n)
    return out


def compare(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = {r.doc_id: (r.n_removed, r.n_links, r.class_id, r.n_lines) for r in dedup_report(docs, **options).collect()}
    assert got == {d: (len(want[d]["gone"]), want[d]["links"], want[d]["first"], len((t or "").split("\n"))) for d, t in rows}
    return docs, want


@pytest.fixture(scope="module")
def edited():
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in rng.integers(0, 900, 22)]
    rows = [(0, None), (1, ""), (2, "\n \nOne two\none  TWO\ntwo one\nthree"), (3, " ".join(base))]
    for d in range(4, 60):
        copies = []
        for _ in range(int(rng.integers(1, 4))):
            copy = base.copy()
            for k in rng.integers(0, 22, int(rng.integers(0, 4))):
                copy[k] = f"e{rng.integers(0, 50)}"
            copies.append(" ".join(rng.permutation(copy[int(rng.integers(0, 4)) :])))
        rows.append((d, "\n".join([*copies, "the same line in all", f"own {d}"])))
    return rows


@pytest.mark.parametrize("options", [{}, {"group_lines": 7}, {"list_lines": 5}, {"group_lines": 3, "list_lines": 2}])
def test_edited_lines(spark, edited, options):
    docs, want = compare(spark, edited, **options)
    if not options:
        left = {r.doc_id: r.text for r in remove_later_lines(docs).collect()}
        for d, t in edited:
            kept = None if t is None else "\n".join(s for n, s in enumerate(t.split("\n")) if n not in want[d]["gone"])
            assert left[d] == kept


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    compare(spark, rows)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 25), st.lists(st.tuples(st.integers(0, 24), st.integers(0, 24)), max_size=40))
def test_forest(n, edges):
    edges = [(a % n, b % n) for a, b in edges]
    label = forest(n, [(np.array([a for a, _ in edges], int), np.array([b for _, b in edges], int))] if edges else [])
    low = list(range(n))
    for _ in range(n):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert label.tolist() == low


def test_jaccard_is_exact():
    sets = [np.arange(k, dtype=np.uint64) for k in (4, 5, 8, 10)]
    assert matching(sets, np.arange(4), np.arange(4)).astype(int).tolist() == [[0, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 1], [0, 0, 1, 0]]


def test_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 0), (1, "a b c", 0), (None, "a b c", 1), (2, "A  c b\nx", 2)], "doc_id int, text string, line int")
    got = sorted((r.doc_id or 0, r.n_removed, r.n_links) for r in dedup_report(docs).collect())
    assert got == [(0, 0, 0), (1, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert remove_later_lines(docs).columns == docs.columns
    assert dedup_report(docs.limit(0)).count() == 0


def test_matching_in_slices_and_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(300) < rng.choice([0.02, 0.15, 0.4]), rng.integers(0, 1 << 62, 300, dtype=np.uint64), base)) for _ in range(60)]
    left, right = np.arange(0, 40), np.arange(20, 60)
    plain = [[i != j and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])) for j in right] for i in left]
    assert np.any(plain) and not np.all(plain)
    for slice_words, block_words in ((1 << 20, 1 << 11), (700, 16), (1, 1)):
        monkeypatch.setattr(line_dedup, "SLICE_WORDS", slice_words)
        monkeypatch.setattr(line_dedup, "BLOCK_WORDS", block_words)
        if slice_words == 1:
            assert matching(sets[:6], np.arange(3), np.arange(2, 6)).tolist() == [[i != j and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])) for j in range(2, 6)] for i in range(3)]
        else:
            assert matching(sets, left, right).tolist() == plain


class Sent:
    def __init__(self, value):
        self.value = value


def posted(texts, buckets=3, list_lines=40_000, held=1 << 20, monkeypatch=None):
    if monkeypatch:
        monkeypatch.setattr(line_dedup, "HELD", held)
    none = Sent((np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    batches = line_dedup._postings(none, list_lines, buckets)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))
    return pa.Table.from_batches(batches)


def test_unlike_long_lines_are_no_candidates():
    """With parity bits for 64 cells a fifth of such pairs passed, so that most lines of a common word were one group."""
    rng = np.random.default_rng(3)
    texts = ["\n".join(" ".join(f"x{k}" for k in rng.integers(0, 10**9, 149)) + " common" for _ in range(40))]
    lists, one, bits, size, pos = line_dedup._received(posted(texts, 1))
    each = np.unique(one, return_index=True)[1]
    n = len(each)
    pairs = sum(len(i) for i, _ in candidates(np.zeros(n, np.uint64), one[each], bits[each], size[each], np.zeros(n, int)))
    assert n == 40 and pairs < 40 * 39 // 2 // 50


def test_postings_are_a_row_for_each_bucket(monkeypatch):
    texts = ["\n".join(f"a{k} b{k} c{k} d{k} e{k} f" for k in range(500)), "a1 b1 c1 d1 e1 f\n" + " ".join(f"w{k}" for k in range(80_000)), None]
    texts.append(texts[0])  # nothing of its block is new
    whole = posted(texts)
    assert whole.num_rows == 3
    few = posted(texts, held=100, monkeypatch=monkeypatch)
    assert few.num_rows >= 3
    rows = []
    for table in (whole, few):
        got = [line_dedup._received(table.filter(pa.compute.equal(table["bucket"], b))) for b in range(3)]
        rows.append(sorted((b, *(int(x[k]) for x in (g[0], g[1], g[3], g[4])), *g[2][k].tolist()) for b, g in enumerate(got) for k in range(len(g[0]))))
    assert rows[0] == rows[1] and len(rows[0]) == 500 * 2 + 16_001 and max(r[3] for r in rows[0]) == 80_000


@pytest.mark.parametrize("bits", [64, 44])
def test_order_by_line_and_key(bits):
    rng = np.random.default_rng(6)
    line = np.sort(rng.integers(0, 3000, 20_000))
    key = mix(rng.integers(0, 500, 20_000).astype(np.uint64)) >> np.uint64(64 - bits)
    key[:50] ^= np.uint64(1)  # keys that differ only in their last bit
    ties = mix(key)
    for lines in (line, np.zeros(len(line), int)):
        order = line_dedup._by_line(lines, key, ties, bits)
        want = np.lexsort((ties, key, lines))
        assert (key[order] == key[want]).all() and (lines[order] == lines[want]).all()


def test_a_line_that_comes_twice_counts_once():
    words = [np.arange(k, dtype=np.uint64).tobytes() for k in (8, 8, 9)]
    columns = {"component": [5] * 3, "one": [1, 1, 2], "two": [1, 1, 2], "rank": [0, 0, 1], "words": words, "own": [0] * 3, "low": [0] * 3, "high": [0] * 3}
    out = line_dedup._verify(pa.table({k: pa.array(v, pa.binary() if k == "words" else pa.int64()) for k, v in columns.items()}))
    assert sorted(zip(*(out[c].to_pylist() for c in ("one", "links", "first")), strict=True)) == [(1, 1, 1), (2, 1, 0)]


def test_places_of_hashes():
    table = np.unique(mix(np.arange(5000, dtype=np.uint64)) & ~np.uint64(0xFF0))  # many share a slot
    asked = np.concatenate([table, table + np.uint64(1), table[::-1]])
    where = {int(h): k for k, h in enumerate(table)}
    assert line_dedup._places(line_dedup._slots(table), table, asked).tolist() == [where.get(int(h), -1) for h in asked]
    assert line_dedup._places(line_dedup._slots(table[:0]), table[:0], asked).max() == -1
