"""Phrase collocations by dynamic itemset counting.

Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs. The
words are dealt over shards, which are scanned in turn, round and round. Single words are counted from the first scan on;
a longer phrase from the scan after the one in which both its first and its last words (all but one) have reached the
threshold, whatever lengths are still being counted. Every phrase is counted in as many scans as there are shards, so in
each shard once, and its count is exact. The scans end when no phrase is active: with most phrases active early, long
before one pass for every length is over.

A scan decides by two bitmaps of a fixed size (phrases that have reached the threshold, and those that have done so
within the last cycle) which windows are active, and counts them by hash: tasks hand on sorted hashes with their counts, which are summed by
range of the hash and added to those of the scans before, a cycle of scans at a time. Every such sum holds each shard once, so what the bitmaps or equal
hashes let through in excess can only make more phrases reach the threshold, never fewer, and is left out at last: when no phrase is
active any more, the phrases that have reached it are counted once by their text. So only bitmaps are broadcast, and rare phrases never move as text.

Scores are whole numbers computed in decimals of 38 digits. Null texts are empty, a null language is ``und``; repeated
rows count as often as they occur; a table without frequent phrases gives an empty result; other columns are ignored.
Long texts are cut into rows that overlap by the length of a phrase less one word, and each window counts in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstar.llm.common import shared_path, small_side, stored, text_of
from tierstar.llm.textarrays import Texts, blocks, mix, prefix_hash, range_hash
from tierstar.llm.textarrays import _CODES as CODES

SHARDS, LONGEST, LEAST, TOP, ABSORBED = 3, 5, 100, 2000, 100
#: Bits of a bitmap, words of one row of a shard, bytes that are counted at once by their text.
SLOTS, ROW_WORDS, SCAN_BYTES = 1 << 24, 1 << 15, 1 << 21
#: Windows that a task holds before it sums them, ranges of hashes at least, words of the corpus for each range.
HELD, BUCKETS, BUCKET_WORDS = 1 << 22, 32, 1 << 21

_BLANK, _BREAK = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b" \t")] = _BLANK
_KINDS[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNTS = "lang string, phrase string, size int, n long"


def pieces(texts: Texts, longest: int, row_words: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Rows of words: text number, the words' bytes (a blank between two words of a piece, a line end between pieces), and the number of words that windows may start at."""
    n = len(texts.data)
    if not n:
        return
    kind = _KINDS[texts.data]
    inside = kind == 0
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, texts.offsets)
    breaks = np.append(0, np.cumsum(kind == _BREAK))
    gap = np.full(len(starts), 10, np.uint8)
    gap[:-1][breaks[starts[1:]] == breaks[ends[:-1]]] = 32
    size = ends - starts
    place = np.append(0, np.cumsum(size + 1))
    out = np.empty(place[-1], np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(starts)), size)] = _LOWER[texts.data[inside]]
    out[place[1:] - 1] = gap
    for t in np.flatnonzero(np.diff(first)):
        for a in range(first[t], first[t + 1], row_words):
            b = min(a + row_words, first[t + 1])
            c = min(b + longest - 1, first[t + 1])
            yield int(t), out[place[a] : place[c] - 1], int(b - a)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices data[starts:ends] as strings."""
    size = ends - starts
    offsets = np.append(0, np.cumsum(size))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes()))


def _rows_of_words(longest: int, row_words: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in blocks(batch.column(2)):
                rows = list(pieces(texts, longest, row_words))
                if rows:
                    at = pa.array([texts.first + t for t, _, _ in rows])
                    words = pa.array([w.tobytes() for _, w, _ in rows], pa.binary()).cast(pa.string())
                    own = pa.array([n for _, _, n in rows], pa.int32())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), words, own], ["shard", "lang", "words", "own"])

    return cut


def _salts(langs: pa.Array) -> np.ndarray:
    """A 64-bit number for the language of each row."""
    encoded = langs.dictionary_encode()
    each = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in encoded.dictionary.to_pylist()]
    return np.array(each, np.uint64)[encoded.indices.to_numpy()]


def _held(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(SLOTS - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _windows(texts: Texts, salt: np.ndarray, own: np.ndarray, reached: np.ndarray, fresh: np.ndarray | None, longest: int, words_too: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By size the active windows: size, hashes, rows, starts and ends. Without ``fresh`` those that have reached the threshold themselves."""
    starts, ends, first = texts.words()
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    mine = np.arange(len(row)) - first[row] < own[row]
    piece = np.cumsum(np.append(True, (row[1:] != row[:-1]) | (texts.data[ends[:-1]] == 10))) if len(row) else row
    sums = prefix_hash(CODES[texts.data])
    at = np.arange(len(row))
    was, new = (np.zeros(len(row), bool) for _ in range(2))
    for size in range(1, longest + 1):
        if size > 1:
            # Both parts have reached the threshold; one of them within the last cycle.
            at = np.flatnonzero(was[:-1] & was[1:])
            at = at[at + size <= len(row)]
            at = at[piece[at] == piece[at + size - 1]]
            active = mine[at] & (new[at] | new[at + 1])
        else:
            active = mine & words_too
        if not len(at):
            return
        h = mix(range_hash(sums, starts[at], ends[at + size - 1]) + salt[row[at]])
        if size < longest or fresh is None:
            was, new = (np.zeros(len(row), bool) for _ in range(2))
            was[at] = held = _held(reached, h)
            if fresh is None:
                active = mine[at] & held
            else:
                new[at] = _held(fresh, h)
        if active.any():
            one = at[active]
            yield size, h[active], row[one], starts[one], ends[one + size - 1]


def _packed(n: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as a byte each, those of 255 and more in full behind them."""
    return np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype(np.int64).tobytes()


def _unpacked(few: bytes, many: bytes) -> np.ndarray:
    n = np.frombuffer(few, np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(many, np.int64)
    return n


#: Sorted lower halves of hashes of one size in one range of hashes, their counts; kind: 0 a scan's sums, 1 what has reached the threshold.
HASHES = "bucket int, kind int, size int, low binary, few binary, many binary"


def _hash_rows(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))]


_NAMES = ["bucket", "kind", "size", "low", "few", "many"]


def _scanned(bitmaps, words_too: bool, longest: int, buckets: int):
    """Counts of the windows that may be active by hash, summed per task as far as ``HELD`` windows go; kind is -1."""

    def handed(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for size, each in enumerate(held):
            if each:
                h = np.concatenate(each)
                each.clear()
                # The range of the hash, from its upper half, and its lower half.
                h = ((h >> np.uint64(32)) * np.uint64(buckets)) & np.uint64(0xFFFFFFFF << 32) | h & np.uint64(0xFFFFFFFF)
                h.sort()
                begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                n, h = np.diff(begin, append=len(h)), h[begin]
                low, bucket = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.int32)
                cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(h))
                rows = [(int(bucket[i]), -1, size, low[i:j].tobytes(), *_packed(n[i:j])) for i, j in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(_hash_rows(rows), _NAMES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, fresh = bitmaps.value
        held: list[list[np.ndarray]] = [[] for _ in range(longest + 1)]
        n = 0
        for batch in batches:
            salts = _salts(batch.column(0))
            for texts in blocks(batch.column(1)):
                rows = slice(texts.first, texts.first + len(texts))
                for size, h, *_ in _windows(texts, salts[rows], batch.column(2).to_numpy()[rows], reached, fresh, longest, words_too):
                    held[size].append(h)
                    n += len(h)
                if n > HELD:
                    yield from handed(held)
                    n = 0
        yield from handed(held)

    return scan


def _summed(low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(low)
    low, n = low[order], n[order]
    begin = np.flatnonzero(np.append(True, low[1:] != low[:-1])) if len(low) else np.zeros(0, int)
    return low[begin], np.add.reduceat(n, begin) if len(low) else n


def _joined(least: int):
    """Of one range of hashes: this scan's sums, and what reaches the threshold with it in the scans of the last cycle."""

    def join(table: pa.Table) -> pa.Table:
        found = [x for batch in table.to_batches() for x in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True)]
        out = []
        for size in sorted({x[2] for x in found}):
            kinds = {k: [x for x in found if x[1] == k and x[2] == size] for k in (-1, 0, 1)}
            if not kinds[-1]:
                continue
            low = {k: np.concatenate([np.frombuffer(x[3], np.uint32) for x in rows] or [np.zeros(0, np.uint32)]) for k, rows in kinds.items()}
            n = {k: np.concatenate([_unpacked(*x[4:]) for x in rows] or [np.zeros(0, np.int64)]) for k, rows in kinds.items() if k < 1}
            now = _summed(low[-1], n[-1])
            out.append((found[0][0], 0, size, now[0].tobytes(), *_packed(now[1])))
            cycle = _summed(np.concatenate([now[0], low[0]]), np.concatenate([now[1], n[0]])) if kinds[0] else now
            new = cycle[0][cycle[1] >= least]
            new = new[~np.isin(new, low[1])]
            if len(new):
                out.append((found[0][0], 1, size, new.tobytes(), b"", b""))
        return pa.Table.from_arrays(_hash_rows(out), _NAMES)

    return join


def _texts(bitmap, longest: int):
    """Phrases that may have reached the threshold, counted per block of text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts = _salts(batch.column(0))
            for texts in blocks(batch.column(1), SCAN_BYTES):
                rows = slice(texts.first, texts.first + len(texts))
                for size, h, row, starts, ends in _windows(texts, salts[rows], batch.column(2).to_numpy()[rows], bitmap.value, None, longest):
                    order = np.argsort(h)
                    h = h[order]
                    begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                    one, n = order[begin], np.diff(begin, append=len(h))
                    langs = batch.column(0).take(pa.array(texts.first + row[one]))
                    yield pa.RecordBatch.from_arrays([langs, _strings(texts.data, starts[one], ends[one]), pa.array(np.full(len(one), size, np.int32)), pa.array(n.astype(np.int64))], ["lang", "phrase", "size", "n"])

    return count


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits that hashes set: word of the bitmap, bits."""
    for batch in batches:
        low = [np.frombuffer(x, np.uint32) for x in batch.column(0).to_pylist()]
        if low:
            slot = np.concatenate(low).astype(np.uint64) & np.uint64(SLOTS - 1)
            word, inverse = np.unique(slot >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, inverse, np.uint64(1) << (slot & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(bits.view(np.int64))], ["word", "bits"])


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of hashes; at most ``SLOTS`` / 64 rows reach the driver."""
    rows = hashes.select("low").mapInArrow(_bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(SLOTS // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def count_phrases(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, row_words: int = ROW_WORDS) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``least`` times or more (lang, phrase, size, n), and the number of all words by language (lang, words)."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang")
    rows = docs.select((F.monotonically_increasing_id() % shards).cast("int").alias("shard"), lang, text_of(text_column).alias("text"))
    dealt, met = (shared_path(spark) for _ in range(2))
    rows.mapInArrow(_rows_of_words(longest, row_words), "shard int, lang string, words string, own int").write.partitionBy("shard").parquet(dealt)
    words = spark.read.schema("lang string, words string, own int, shard int").parquet(dealt)
    totals = stored(words.groupBy("lang").agg(F.sum("own").alias("words")))
    buckets = max(BUCKETS, (totals.agg(F.sum("words")).first()[0] or 0) // BUCKET_WORDS)

    def read(steps: range, kind: int) -> DataFrame:
        found = spark.read.schema(f"{HASHES}, step int").parquet(met)
        return found.filter(F.col("step").between(steps[0], steps[-1]) & (F.col("kind") == kind)).select(*_NAMES)

    bitmaps: list[np.ndarray] = []
    none = np.zeros(SLOTS // 64, np.uint64)
    step = last = 0  # The empty phrase has reached the threshold before the first scan.
    while step < last + shards:
        step += 1
        both = spark.sparkContext.broadcast((np.bitwise_or.reduce([none, *bitmaps]), np.bitwise_or.reduce([none, *bitmaps[-shards:]])))
        shard = words.filter(F.col("shard") == (step - 1) % shards).select("lang", "words", "own")
        known = shard.mapInArrow(_scanned(both, step <= shards, longest, buckets), HASHES)
        if step > 1:
            # What reaches the threshold now has been counted in the last scans only.
            known = known.unionAll(read(range(1, step), 1))
            if shards > 1:
                known = known.unionAll(read(range(max(1, step - shards + 1), step), 0))
        known.groupBy("bucket").applyInArrow(_joined(least), HASHES).write.partitionBy("kind").parquet(f"{met}/step={step}")
        both.unpersist()
        bitmaps.append(_bitmap(read(range(step, step + 1), 1).filter(F.col("size") < longest)))
        if bitmaps[-1].any():
            last = step
    longest_ones = _bitmap(read(range(1, step + 1), 1).filter(F.col("size") == longest))
    reached = spark.sparkContext.broadcast(np.bitwise_or.reduce([longest_ones, *bitmaps]))
    counted = words.select("lang", "words", "own").mapInArrow(_texts(reached, longest), COUNTS)
    total = stored(counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
    reached.unpersist()
    return total, totals


def score(a: str = "a", n: str = "n", l: str = "l", r: str = "r") -> Column:  # noqa: E741
    """floor(1000 a n / (l r)), exactly: counts are below 10**17, the products below 10**38."""
    wide = {x: f"cast({x} AS decimal(17, 0))" for x in (a, n, l, r)}
    return F.expr(f"({wide[a]} * {wide[n]} * cast(1000 AS decimal(4, 0))) div ({wide[l]} * {wide[r]})")


def collocations(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, absorbed: int = ABSORBED, **options) -> DataFrame:
    """The first ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its weakest cut. Phrases inside a longer one that holds ``absorbed`` percent of their occurrences are left out.
    """
    counts, words = count_phrases(docs, text_column, lang_column, least, longest, **options)
    phrases = counts.filter(F.col("size") > 1).select("lang", "phrase", "size", F.col("n").alias("a"))
    split = phrases.withColumn("_words", F.split("phrase", " ", -1)).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = split.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(_words, 1, k)"), " ").alias("_first"), F.array_join(F.expr("slice(_words, k + 1, size)"), " ").alias("_rest"))
    firsts = counts.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r"))
    totals = small_side(words.select("lang", F.col("words").alias("n")), words.count())
    scored = cut.join(firsts, ["lang", "_first"]).join(rests, ["lang", "_rest"]).join(totals, "lang").withColumn("score", score())
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("_cut"))

    inside = phrases.filter(F.col("size") > 2).withColumn("_words", F.split("phrase", " ", -1))
    inside = inside.withColumn("_n", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_n") + 1)))
    longer = inside.groupBy("lang", F.array_join(F.expr("slice(_words, _at, _n)"), " ").alias("phrase")).agg(F.max("a").alias("_most"))
    left = weakest.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("_most") < absorbed * F.col("a"), F.lit(True)))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = left.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score").withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    # First within parts of a language, so that no task orders all of one.
    some = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, longest: int = LONGEST, top: int = TOP, absorbed: int = ABSORBED) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        windows AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS phrase
                    FROM split, (SELECT unnest(range(1, {longest} + 1)) AS size) WHERE len(w) >= size),
        f AS (SELECT lang, phrase, size, count(*) AS n FROM windows GROUP BY ALL HAVING count(*) >= {least}),
        total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
        c AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
        cuts AS (SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:], ' ') AS two
                 FROM (SELECT *, unnest(range(1, size)) AS k FROM c) AS c),
        scored AS (SELECT cuts.lang, cuts.phrase, a, x.n AS l, y.n AS r, t.n AS n, k,
                          CAST((1000::HUGEINT * a * t.n) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
                   FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = one JOIN f AS y ON y.lang = cuts.lang AND y.phrase = two
                   JOIN total AS t ON t.lang = cuts.lang),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(a) AS most
                   FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM c)) GROUP BY ALL),
        ranked AS (SELECT weakest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
                   FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < {absorbed} * a)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}"""
