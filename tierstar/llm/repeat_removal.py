"""Removal of repeated byte strings of a given length, by column-wise suffix sorting of aligned contexts.

A byte goes if it lies in a 200-byte string that also starts anywhere else, in the same text or another.

Sorting all suffixes of all texts column by column takes as many passes over the whole collection as
the longest text has bytes. Instead, texts are first aligned: every 200-byte window is represented by its
anchor, the 40-byte string of lowest hash in it (leftmost of equals). Equal windows have equal
anchors at equal distances, so only the surroundings of anchors that occur twice need comparing, and
only at equal columns. These contexts (160 bytes before an anchor, 200 from it on) are the documents of the
multi-document construction: each round inserts one symbol per context, from the last column to
the first, which stably re-sorts the contexts (the symbols in that order are the transform's
column) and updates the longest common prefixes of neighbours. A window repeats if a prefix shared with a neighbour
reaches 200. A collection takes as many rounds as a context has columns, whatever the length of texts.

How much is sorted is kept down by counts that Spark combines before each shuffle:
- an anchor that occurs once has no repeat; one with a single context repeats throughout;
- equal contexts are compared once, and repeat throughout;
- what is left goes to collections of bounded size. An anchor with more different contexts than
  ``sorted_contexts`` would not fit in one; its windows are compared by 128-bit fingerprints, which Spark groups.

Null and empty texts have no bytes; texts under 200 bytes keep all. Rows that repeat an id, or id and
text, are documents of their own, so the latter lose all 200-byte strings. Judged on the input, not on
what is left. An empty table gives an empty result; other columns are ignored.
Long texts are looked at in pieces, whose anchors are put together, so cuts change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.llm.common import same_row, stored, text_of
from tierstar.llm.textarrays import BLOCK_BYTES, Texts, blocks, prefix_hash, range_hash

LENGTH, ANCHOR = 200, 40
BEFORE = LENGTH - ANCHOR
WIDTH = BEFORE + LENGTH
#: Different contexts of one anchor that are sorted together, and contexts of a collection.
SORTED_CONTEXTS, COLLECTION = 16_384, 20_000
#: Columns that tell a row. The id has a name of its own: where the optimizer drops its renaming in one branch of a query only, Spark takes the
#: branches for different ones and shuffles all texts for each.
KEYS = ("_id", "_fp")
_CODES = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64)
_PLACE = np.uint64((1 << 24) - 1)


def _pieces(texts: Texts, piece: int) -> Iterator[tuple[Texts, int]]:
    """The texts, a single long one in pieces that overlap by a window less one, with the place of the piece."""
    if len(texts) > 1 or len(texts.data) < piece + LENGTH:
        yield texts, 0
        return
    for at in range(0, len(texts.data) - LENGTH + 1, piece):
        data = texts.data[at : at + piece + LENGTH - 1]
        yield Texts(texts.first, data, np.array([0, len(data)])), at


def _piece_anchors(texts: Texts) -> tuple[np.ndarray, ...] | None:
    """Of every anchor of a piece, in its order: text, hash, place, first and last window (all places in the piece)."""
    data, offsets = texts.data, texts.offsets
    if len(data) < LENGTH:
        return None
    sums = prefix_hash(_CODES[data])
    starts = np.arange(len(data) - ANCHOR + 1)
    hashes = range_hash(sums, starts, starts + ANCHOR)
    low = (hashes & ~_PLACE) | starts.astype(np.uint64)
    # Minimum over BEFORE + 1 neighbours, by doubling.
    span = 1
    while span * 2 <= BEFORE + 1:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = BEFORE + 1 - span
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    at = (low & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))[: len(at)]
    fits = np.arange(len(at)) + LENGTH <= offsets[text + 1]
    p = np.flatnonzero(fits)
    if not len(p):
        return None
    a, t = at[p], text[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (t[1:] != t[:-1])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(p)) - 1
    a, t = a[head], t[head]
    return t, hashes[a], a, p[head], p[last]


def anchors(column: pa.Array, piece: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, ...]]:
    """Of every anchor: row, hash, hash of the context, place, context's start and end, first and last window (all places in the text).

    A text of more than ``piece`` bytes is looked at in pieces; what they hold is put together before contexts are cut from the whole text.
    """
    for whole in blocks(column):
        found = []
        for texts, base in _pieces(whole, piece):
            if (got := _piece_anchors(texts)) is not None:
                t, h, a, first, final = got
                found.append((t, h, a + base, first + base, final + base))
        if not found:
            continue
        t, h, a, first, final = (np.concatenate(x) for x in zip(*found, strict=True))
        # An anchor of windows on both sides of a cut is one.
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (t[1:] != t[:-1])
        head = np.flatnonzero(new)
        t, h, a, first, final = t[head], h[head], a[head], first[head], final[np.append(head[1:], len(a)) - 1]
        offsets, raw = whole.offsets, whole.data.tobytes()
        begin, end = np.maximum(offsets[t], a - BEFORE), np.minimum(offsets[t + 1], a + LENGTH)
        context = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j], seed=k) for i, j, k in zip(begin.tolist(), end.tolist(), (a - begin).tolist(), strict=True)), np.uint64, len(a))
        zero = offsets[t]
        yield whole.first + t, h, context, a - zero, begin - zero, end - zero, first - zero, final - zero


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, anchor, context, *_ in anchors(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64))], ["anchor", "context"])


def _place_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, anchor, context, at, _, _, first, last in anchors(batch.column(2)):
            row = pa.array(row)
            numbers = [pa.array(x.astype(np.int64) if x.dtype != np.uint64 else x.view(np.int64)) for x in (anchor, context, at, first, last)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), *numbers], ["_id", "_fp", "anchor", "context", "at", "first", "last"])


def repeats_by_column(contexts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Of aligned contexts (rows, columns; 0: no symbol): which start, at which column, a string of ``length`` that another row has there too.

    Multi-document construction: round by round one symbol of every row is put in front of its suffix.
    """
    rows, width = contexts.shape
    columns = np.ascontiguousarray(contexts.T)
    order = np.arange(rows)
    shared = np.zeros(rows + 1, np.int16)  # longest common prefix of the suffixes at k - 1 and k; 0 at both ends
    found = np.zeros((width - length + 1, rows), bool)
    for c in range(width - 1, -1, -1):
        symbols = columns[c][order]
        moved = np.argsort(symbols, kind="stable")
        # Two suffixes that become neighbours share one symbol more than the least of what lay between them.
        least = np.minimum.reduceat(shared, moved + 1)[:-1]
        symbols = symbols[moved]
        same = (symbols[1:] == symbols[:-1]) & (symbols[1:] > 0)
        shared = np.zeros(rows + 1, np.int16)
        shared[1:rows] = np.where(same, np.minimum(least + 1, length), 0)
        order = order[moved]
        if c <= width - length:
            found[c][order] = np.maximum(shared[:-1], shared[1:]) >= length
    return found.T


def _aligned(batch: pa.Table | pa.RecordBatch) -> np.ndarray:
    texts, left = batch.column("bytes").to_pylist(), batch.column("left").to_numpy()
    out = np.zeros((len(texts), WIDTH), np.uint16)
    for i, (text, k) in enumerate(zip(texts, left, strict=True)):
        out[i, BEFORE - k : BEFORE - k + len(text)] = np.frombuffer(text, np.uint8).astype(np.uint16) + 1
    return out


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of every run of hits."""
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _sort_collection(table: pa.Table) -> pa.Table:
    found = repeats_by_column(_aligned(table))
    at, first, last, single = (table.column(c).to_numpy() for c in ("at", "first", "last", "single"))
    place = at[:, None] - BEFORE + np.arange(found.shape[1])
    row, low, high = _runs(found & single[:, None] & (place >= first[:, None]) & (place <= last[:, None]))
    take = pa.array(row)
    return pa.table({"_id": table.column("_id").take(take), "_fp": table.column("_fp").take(take), "first": at[row] - BEFORE + low, "last": at[row] - BEFORE + high})


def _window_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, place, one, two = [], [], [], []
        columns = [batch.column(c).to_pylist() for c in ("bytes", "left", "at", "first", "last")]
        for i, (text, left, at, first, last) in enumerate(zip(*columns, strict=True)):
            for p in range(first, last + 1):
                k = p - at + left
                digest = xxhash.xxh3_128_digest(text[k : k + LENGTH])
                row.append(i)
                place.append(p)
                one.append(int.from_bytes(digest[:8], "little", signed=True))
                two.append(int.from_bytes(digest[8:], "little", signed=True))
        take = pa.array(row, pa.int64())
        kept = [batch.column(c).take(take) for c in ("_id", "_fp", "single")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(place, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["_id", "_fp", "single", "first", "one", "two"])


def repeated_windows(rows: DataFrame, sorted_contexts: int = SORTED_CONTEXTS, collection: int = COLLECTION) -> DataFrame:
    """Runs of repeated windows of ``rows`` (_id, _text, _fp): _id, _fp, first, last (places where windows start)."""
    id_type = rows.schema["_id"].dataType.simpleString()
    counted = rows.select("_text").mapInArrow(_count_anchors, "anchor long, context long")
    counts = counted.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    shared = counts.filter(F.col("n") > 1).select("anchor", (F.col("low") != F.col("high")).alias("mixed"))
    placed = rows.select("_id", "_fp", "_text").mapInArrow(_place_anchors, f"_id {id_type}, _fp long, anchor long, context long, at long, first long, last long")
    found = stored(placed.join(shared, "anchor"))
    span = ["_id", "_fp", "first", "last"]
    alike = found.filter(~F.col("mixed")).select(*span)

    mixed = found.filter("mixed")
    one = F.struct("_id", "_fp", "at", "first", "last")
    kinds = stored(mixed.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one")))
    many = kinds.filter(F.col("n") > 1).select("anchor", "context")
    copied = mixed.join(many, ["anchor", "context"], "left_semi").select(*span)

    large = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > sorted_contexts).select("anchor")
    large = stored(large)
    n_large, n_kinds = large.count(), kinds.count()
    if n_large:
        kinds = stored(kinds.join(large.withColumn("large", F.lit(True)), "anchor", "left"))
    else:
        kinds = kinds.withColumn("large", F.lit(None).cast("boolean"))
    wanted = kinds.select("one._id", "one._fp", F.struct("anchor", (F.col("n") == 1).alias("single"), "large", "one.at", "one.first", "one.last").alias("c"))
    wanted = wanted.groupBy("_id", "_fp").agg(F.collect_list("c").alias("cs"))
    # Rows equal in id and text stand for each other: one of them gives the bytes.
    with_bytes = rows.join(wanted, same_row(rows, wanted, KEYS)).select(rows["_id"], rows["_fp"], F.col("_text").cast("binary").alias("bytes"), "cs")
    begin = lambda c: F.greatest(c["at"] - BEFORE, F.lit(0))
    cut = F.transform("cs", lambda c: F.struct(c.alias("c"), F.substring(F.col("bytes"), (begin(c) + 1).cast("int"), (c["at"] + LENGTH - begin(c)).cast("int")).alias("bytes")))
    each = with_bytes.select("_id", "_fp", F.explode(cut).alias("x")).select("_id", "_fp", "x.c.*", "x.bytes")
    contexts = each.withColumn("left", F.least(F.col("at"), F.lit(BEFORE)))
    buckets = max(1, -(-n_kinds // collection))
    small = contexts.filter(F.col("large").isNull()).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    sorted_runs = small.groupBy("bucket").applyInArrow(_sort_collection, f"_id {id_type}, _fp long, first long, last long")
    parts = [alike, copied, sorted_runs]
    if n_large:
        # Not stored: in one query with the rest, the documents are shuffled once for all that needs them (see KEYS).
        prints = contexts.filter("large").select("_id", "_fp", "single", "at", "first", "last", "left", "bytes")
        prints = prints.mapInArrow(_window_prints, f"_id {id_type}, _fp long, single boolean, first long, one long, two long")
        again = prints.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("one", "two")
        parts.append(prints.filter("single").join(again, ["one", "two"], "left_semi").select("_id", "_fp", "first", F.col("first").alias("last")))
    return reduce(DataFrame.unionByName, parts)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@F.arrow_udf(T.StructType([T.StructField("spans", SPANS), T.StructField("kept", T.BinaryType())]))
def _cut_out(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for texts, runs in batches:
        spans, kept = [], []
        for text, found in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
            if text is None:
                spans.append(None)
                kept.append(None)
                continue
            out: list[dict] = []
            for r in sorted(found, key=lambda r: r["first"]):
                end = r["last"] + LENGTH
                if out and r["first"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], end)
                else:
                    out.append({"start": r["first"], "end": end})
            places = [0, *[x for s in out for x in (s["start"], s["end"])], len(text)]
            kept.append(b"".join(text[i:j] for i, j in zip(places[::2], places[1::2], strict=True)))
            spans.append(out)
        yield pa.StructArray.from_arrays([pa.array(spans, span_type), pa.array(kept, pa.binary())], ["spans", "kept"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sorted_contexts: int = SORTED_CONTEXTS, collection: int = COLLECTION) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (maximal removed runs, start and end), kept (the remaining bytes)."""
    rows = docs.select(F.col(id_column).alias("_id"), text_of(text_column).alias("_text")).withColumn("_fp", F.xxhash64("_text"))
    # Rows equal in id and text have the same runs: kept once, or each of them would get those of all.
    runs = repeated_windows(rows, sorted_contexts, collection).groupBy(*KEYS).agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    joined = rows.join(runs, same_row(rows, runs, KEYS), "left").select(rows["_id"], F.col("_text").cast("binary").alias("_bytes"), "runs")
    has = F.col("runs").isNotNull()
    cut = joined.withColumn("_cut", _cut_out(F.when(has, F.col("_bytes")), F.col("runs")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return cut.select(F.col("_id").alias("doc_id"), F.length("_bytes").cast("long").alias("n_bytes"), F.coalesce("_cut.spans", empty).alias("spans"), F.when(has, F.col("_cut.kept")).otherwise(F.col("_bytes")).alias("kept"))
