"""Vector code compression: product quantisation learned over Hilbert-sorted blocks.

Vectors become whole numbers, floor(4096 x), and are cut into equal parts. The values of each part position are sorted along a
Hilbert curve (Spark sorts by range, equal keys by row, so a value that a third of all vectors hold is split as well) and stored in flat blocks: the members, a box of
the least and greatest component, and the sums. In each round the distances between a block's box and the codebook's
entries leave a shortlist: entries whose least distance to the box is not above the smallest greatest distance of any entry. If one is left,
the block's sums are its whole contribution; otherwise its members are compared with the shortlist, in whole numbers.
Only sums by part and entry reach the driver, as many as a codebook has components.

Dropped: vectors that are null or hold null or non-finite components, or have another length than that of the smallest vec_id. Lengths that the number of
parts does not divide are filled up with zeros. Rows that share a vec_id are rows of their own, ordered by their components; a null vec_id
comes last. With fewer rows than entries a codebook has as many entries as there are rows. Whole numbers are exact; beyond 2**62 they are cut off, and so are errors
at 2**63 - 1. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import small_side, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK = 128
_TOP, _LONG = 1 << 62, (1 << 63) - 1

BLOCKS = "part int, low array<long>, high array<long>, sums array<decimal(38,0)>, rows binary, members binary"


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """Kept rows: row (a number of their own), vec_id, label, v (whole numbers); stored."""
    v = F.col(vector_column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    top = F.lit(float(_TOP))
    whole = F.transform(v, lambda x: F.floor(F.greatest(-top, F.least(top, x.cast("double") * SCALE))).cast("long"))
    kept = vectors.filter(v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    out = kept.select(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), whole.alias("v"))
    return stored(out.withColumn("row", F.monotonically_increasing_id()))


def hilbert_keys(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of each row of ``values`` along a Hilbert curve through the box (low, high); at most 63 dimensions take part."""
    width = min(values.shape[1], 63)
    if not width or not len(values):
        return np.zeros(len(values), np.int64)
    bits = min(8, 63 // width)
    span = np.maximum(high[:width].astype(float) - low[:width].astype(float), 1)
    cells = (values[:, :width].astype(float) - low[:width].astype(float)) / span * (1 << bits)
    x = np.clip(cells, 0, (1 << bits) - 1).astype(np.int64).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(width):
            upper = (x[i] & q) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(upper, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, width):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in reversed(range(bits)):
        for i in range(width):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as rows, filled up with zeros to ``width``."""
    flat = column.flatten().to_numpy()
    rows = flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            v = _matrix(batch.column(0), len(batch.column(0)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(v.shape[1], dtype=np.int32)), pa.array(v.min(0)), pa.array(v.max(0))], ["place", "low", "high"])


def _parted(parts: int, low: np.ndarray, high: np.ndarray):
    """Every part of every vector with its place along the curve: part, key, row, v."""
    width = len(low) // parts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), len(low))
            for p in range(parts):
                at = slice(p * width, (p + 1) * width)
                mine = np.ascontiguousarray(v[:, at])
                each = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * width), len(mine), [None, pa.py_buffer(mine.tobytes())]).cast(pa.binary()) if width else pa.array([b""] * len(mine), pa.binary())
                key = hilbert_keys(mine, low[at], high[at])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), p, np.int32)), pa.array(key), batch.column(0), each], ["part", "key", "row", "v"])

    return cut


def _blocked(width: int, block: int):
    """Runs of sorted values of one part as blocks."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            v = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(len(part), width)
            out = []
            for edge, end in zip(*_runs(part), strict=True):
                for i in range(edge, end, block):
                    j = min(i + block, end)
                    sums = [Decimal(int(s)) for s in v[i:j].astype(object).sum(0)]
                    out.append((int(part[i]), v[i:j].min(0).tolist(), v[i:j].max(0).tolist(), sums, row[i:j].tobytes(), v[i:j].tobytes()))
            if out:
                kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.decimal128(38, 0)), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], ["part", "low", "high", "sums", "rows", "members"])

    return make


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of runs of equal values."""
    begin = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
    return begin, np.append(begin[1:], len(values)) if len(values) else begin


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries may be nearest to some point of each box: boxes x entries."""
    under, over = low[:, None] - entries, entries - high[:, None]
    near = np.maximum(np.maximum(under, over), 0)
    far = np.maximum(np.abs(under), np.abs(over))
    return (near * near).sum(2) <= (far * far).sum(2).min(1)[:, None]


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], kind, whole: bool):
    """Of each block: part, its row numbers, member values, and entry and distance by member (or one entry for all if ``whole`` allows it, with the sums)."""
    part = batch.column(0).to_numpy()
    for begin, end in zip(*_runs(part), strict=True):
        book = books[part[begin]]
        width = book.shape[1]
        low, high = (_matrix(batch.column(c).slice(begin, end - begin), width).astype(kind) for c in (1, 2))
        listed = shortlists(low, high, book)
        for i in range(begin, end):
            entry = np.flatnonzero(listed[i - begin])
            rows = np.frombuffer(batch.column(4)[i].as_py(), np.int64)
            if whole and len(entry) == 1:
                yield part[i], rows, [int(s) for s in batch.column(3)[i].as_py()], entry[0], None
                continue
            v = np.frombuffer(batch.column(5)[i].as_py(), np.int64).reshape(len(rows), width).astype(kind)
            apart = v[:, None] - book[entry]
            distance = (apart * apart).sum(2)
            best = distance.argmin(1)
            yield part[i], rows, v, entry[best], distance[np.arange(len(rows)), best]


def _kernel(width: int, top: int):
    """Machine numbers where no squared distance can pass them, else Python's."""
    return np.int64 if max(1, width) * (2 * top + 2) ** 2 < 1 << 62 else object


def _totals(shared):
    """Number of members (place -1) and sums of components by part and entry, of all blocks of a task."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, kind = shared.value
        found: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for part, rows, v, entry, distance in _assigned(batch, books, kind, True):
                if distance is None:
                    each = [(entry, len(rows), v)]
                else:
                    each = [(e, int((entry == e).sum()), v[entry == e].astype(object).sum(0) if kind is object else v[entry == e].sum(0)) for e in np.unique(entry)]
                for e, n, sums in each:
                    held = found.setdefault((int(part), int(e)), [0] * (len(sums) + 1))
                    held[0] += n
                    for k, s in enumerate(sums):
                        held[k + 1] += int(s)
        out = [(p, e, k - 1, Decimal(x)) for (p, e), held in found.items() for k, x in enumerate(held)]
        if out:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], ["part", "entry", "place", "total"])

    return total


def _codes(shared):
    """Entry and squared distance of every part of every vector: row, part, code, error."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, kind = shared.value
        for batch in batches:
            for part, rows, _, entry, distance in _assigned(batch, books, kind, False):
                error = pa.array([min(int(d), _LONG) for d in distance], pa.int64()) if kind is object else pa.array(distance.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.full(len(rows), part, np.int32)), pa.array(entry.astype(np.int32)), error], ["row", "part", "code", "error"])

    return code


def compress(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, list[np.ndarray]]:
    """One row per kept vector (vec_id, label, code, error), and the codebooks (entries x components) by part. At most 128 entries, 8 parts."""
    if entries > 128 or parts > 8:
        raise ValueError("a code has at most 8 parts of 128 entries")
    spark = vectors.sparkSession
    kept = whole_vectors(vectors, id_column, vector_column, label_column)
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).select(F.size("v")).collect()
    if not start:
        empty = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, [np.zeros((0, 0), np.int64)] * parts
    length = start[0][0]
    same = kept.filter(F.size("v") == length)
    first = same.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    full = -(-length // parts) * parts
    width = full // parts
    bounds = same.select("v").mapInArrow(_bounds, "place int, low long, high long").groupBy("place").agg(F.min("low"), F.max("high")).collect()
    low, high = np.zeros(full, np.int64), np.zeros(full, np.int64)
    for place, least, most in bounds:
        low[place], high[place] = least, most
    kind = _kernel(width, max([0, *(abs(int(x)) for x in (*low, *high))]))

    sorted_by = ["part", "key", "row"]
    parted = same.select("row", "v").mapInArrow(_parted(parts, low, high), "part int, key long, row long, v binary")
    flat = parted.repartitionByRange(*sorted_by).sortWithinPartitions(*sorted_by).select("part", "row", "v")
    blocks = stored(flat.mapInArrow(_blocked(width, block), BLOCKS))

    books = [np.array([list(r.v)[p * width : (p + 1) * width] + [0] * max(0, min(width, (p + 1) * width - length)) for r in first], kind).reshape(len(first), width) for p in range(parts)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((books, kind))
        sums = blocks.mapInArrow(_totals(shared), "part int, entry int, place int, total decimal(38,0)").groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
        shared.unpersist()
        totals = {(r.part, r.entry, r.place): int(r.total) for r in sums}
        books = [book.copy() for book in books]
        for (part, entry, place), total in totals.items():
            if place >= 0:
                books[part][entry, place] = total // totals[part, entry, -1]
    shared = spark.sparkContext.broadcast((books, kind))
    coded = blocks.mapInArrow(_codes(shared), "row long, part int, code int, error long")
    shift = 8 * (parts - 1 - F.col("part"))
    packed = F.bit_or(F.call_function("shiftleft", F.col("code").cast("long"), shift.cast("int")))
    wide = F.sum(F.col("error").cast("decimal(20,0)"))
    one = coded.groupBy("row").agg(F.lower(F.lpad(F.hex(packed), 2 * parts, "0")).alias("code"), F.least(wide, F.lit(Decimal(_LONG))).cast("long").alias("error"))
    return same.select("row", "vec_id", "label").join(one, "row").select("vec_id", "label", "code", "error"), books


def book_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.reshape(-1)).encode()).hexdigest()


def code_report(vectors: DataFrame, **options) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error (of all of its label), codebooks_sha256."""
    coded, books = compress(vectors, **options)
    coded = stored(coded)
    wide = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy(F.col("label").alias("_label")).agg(F.least(wide, F.lit(Decimal(_LONG))).cast("long").alias("label_error"))
    out = coded.join(small_side(labels, labels.count()), coded["label"].eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))


def compress_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same for vectors whose length the parts divide."""
    steps = [
        f"""
        kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cut AS (SELECT vec_id, label, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS v
                FROM kept, (SELECT unnest(range({parts})) AS p)),
        book0 AS (SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS e, v FROM cut
                  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""
    ]
    near = "SELECT vec_id, label, cut.p, e, cut.v, d FROM (SELECT vec_id, label, cut.p, cut.v, e, list_sum(list_transform(list_zip(cut.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM cut JOIN book{0} AS b USING (p)) AS cut QUALIFY row_number() OVER (PARTITION BY vec_id, cut.p ORDER BY d, e) = 1"
    for r in range(rounds):
        steps.append(f"near{r} AS ({near.format(r)})")
        steps.append(
            f"""
        mean{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM
                    (SELECT p, e, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{r}) GROUP BY p, e, i) GROUP BY p, e),
        book{r + 1} AS (SELECT p, e, coalesce(CAST(m.v AS BIGINT[]), b.v) AS v FROM book{r} AS b LEFT JOIN mean{r} AS m USING (p, e))"""
        )
    steps.append(f"last AS ({near.format(rounds)})")
    steps.append(
        f"""
        coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY vec_id),
        digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})"""
    )
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"
