"""Line dedup by an exact set-similarity join.

A line is the set of its words (ASCII lower case). Two lines match if their sets are equal or have a
Jaccard similarity of 4/5 or more; of matching lines the later ones go (in the order of document id, line
number), each judged on the input, not on what is left.

Lines with equal sets are one class from the start. Words are ordered by rarity: words outside the table of
the most frequent ones come first, by hash, then the table from rare to frequent (any fixed order is exact; this one
keeps lists short). A line posts its first |x| - ceil(4/5 |x|) + 1 words; two lines that match post a common
word. Lines that meet at a word pass the length filter, the positional filter and a parity
bitmap of 128 bits (its Hamming distance never exceeds the symmetric difference; with fewer bits long lines are taken for alike so often
that most of them become one group). What passes is not emitted pair by pair: each
task keeps a spanning forest, and the connected components of all forests are the groups of lines that may
match. Postings move as arrays, one row for each bucket of lists and task, the words of a line once for each tile that holds it. Each group is then verified on all its words by counting common words of all its pairs, and gives
one row per line: its links, and the first line that it matches.

A posting list or group above a bound is dealt over tiles: its lines are split into chunks, and each pair of
chunks meets in one task, so nothing is dropped and no task holds more than two chunks. Word counts
cover all documents; only the table of the most frequent ones, of a fixed size, reaches the driver.

Null and empty texts and lines without words have no matches and stay. Rows that share an id are told apart by their
text (in the order of its fingerprint); rows equal in both are the same lines and go or stay alike. A null id comes
first. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstar.llm.common import contracted_components, numbered, same_row, small_side, stored
from tierstar.llm.textarrays import Texts, blocks, mix

FREQUENT = 1 << 17
#: Lines of one word, or of one group, that are compared in one piece, and rows of a bucket of lists or groups.
LIST_LINES, GROUP_LINES, BUCKET_ROWS = 40_000, 1_500, 150_000
#: Words of a tile whose common ones are sought at once, and columns of a block of them.
SLICE_WORDS, BLOCK_WORDS = 1 << 20, 1 << 11
#: Postings that a task holds before it hands them on.
HELD = 1 << 20
_OTHER = np.uint64(0x9E3779B97F4A7C15)


def _by_line(line: np.ndarray, key: np.ndarray, ties: np.ndarray, bits: int) -> np.ndarray:
    """The order by line, then by keys of ``bits`` bits, then by ``ties``: one sort of packed numbers, unless such a number is not enough."""
    own = int(line[-1] if len(line) else 0).bit_length()
    over = max(0, own + bits - 64)
    packed = line.astype(np.uint64) << np.uint64(bits - over) | key >> np.uint64(over) if own else key
    order = np.argsort(packed)
    packed, last = packed[order], ties[order]
    return np.lexsort((ties, key, line)) if np.any((packed[1:] == packed[:-1]) & (last[1:] != last[:-1])) else order


def line_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines with words: text and line number, where their words begin (and the end), and the hashes of their different words."""
    starts, ends, first = texts.words()
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    breaks = np.flatnonzero(texts.data == 10)
    line = np.searchsorted(breaks, starts) + text  # a new text is a new line as well
    h = texts.word_hashes(starts, ends)
    order = _by_line(line, h, h, 64)
    line, h, text = line[order], h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (h[1:] != h[:-1])
    line, h, text = line[new], h[new], text[new]
    begin = np.flatnonzero(np.diff(line, prepend=-1))
    number = line[begin] - text[begin] - np.searchsorted(breaks, texts.offsets[:-1])[text[begin]]
    return text[begin], number, np.append(begin, len(h)), h


def _set_keys(begin: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of a set, whatever its order."""
    if len(begin) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return mix(np.add.reduceat(mix(h), begin[:-1])), mix(np.add.reduceat(mix(h ^ _OTHER), begin[:-1]))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in blocks(batch.column(2)):
            text, number, begin, h = line_words(texts)
            one, two = _set_keys(begin, h)
            row = pa.array(texts.first + text)
            arrays = [batch.column(0).take(row), batch.column(1).take(row), pa.array(number.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "_fp", "line", "one", "two"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        each = [texts.word_hashes(*texts.words()[:2]) for texts in blocks(batch.column(0))]
        if each:
            h, n = np.unique(np.concatenate(each), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["hash", "n"])


#: Postings of one task in one bucket of lists, each an array: lower half of the list's hash, line, parity bits (two numbers), size and place of the word.
POSTED = "bucket int, list binary, one binary, bits binary, size binary, pos binary"
_PARTS = ["list", "one", "bits", "size", "pos"]


def _handed(held: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[pa.RecordBatch]:
    if held:
        lists, one, bits, size, pos = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = (lists >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        order = np.argsort(bucket.astype(np.uint16), kind="stable") if buckets <= 1 << 16 else np.argsort(bucket)
        bucket = bucket[order].astype(np.int32)
        small = np.uint16 if size.max() < 1 << 16 else np.uint32
        arrays = [x[order] for x in (lists.astype(np.uint32), one, bits, size.astype(small), pos.astype(small))]
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        parts = [pa.array([x[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in arrays]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), *parts], ["bucket", *_PARTS])


def _received(table: pa.Table) -> tuple[np.ndarray, ...]:
    """The postings of a bucket: lists, lines, parity bits, sizes, places."""
    rows = [x for batch in table.to_batches() for x in zip(*(batch.column(c).to_pylist() for c in _PARTS), strict=True)]
    kinds = lambda x: (np.uint32, np.uint64, np.uint64, *[np.uint16 if 2 * len(x[4]) == len(x[0]) else np.uint32] * 2)
    each = [[np.frombuffer(part, kind) for part, kind in zip(x, kinds(x), strict=True)] for x in rows]
    lists, one, bits, size, pos = (np.concatenate(x) for x in zip(*each, strict=True))
    return lists, one, bits.reshape(-1, 2), size.astype(np.int64), pos.astype(np.int64)


def _slots(table: np.ndarray) -> np.ndarray:
    """A hash table of the places of different hashes, -1 where none is: from the slot of its lower bits on, a hash is in the first free one."""
    out = np.full(1 << max(4, (8 * len(table)).bit_length()), -1, np.int32)
    left, slot = np.arange(len(table), dtype=np.int32), (table & np.uint64(len(out) - 1)).astype(np.int64)
    while len(left):
        free = out[slot] < 0
        out[slot[free]] = left[free]
        wait = out[slot] != left
        left, slot = left[wait], (slot[wait] + 1) & (len(out) - 1)
    return out


def _places(slots: np.ndarray, table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each hash in the table, -1 if it is not there."""
    slot = (h & np.uint64(len(slots) - 1)).astype(np.int64)
    at = slots[slot]
    left = np.flatnonzero(at >= 0)
    while len(left):
        left = left[table[at[left]] != h[left]]
        slot[left] = (slot[left] + 1) & (len(slots) - 1)
        at[left] = slots[slot[left]]
        left = left[at[left] >= 0]
    return at


def _postings(frequent, tile_lines: int, buckets: int):
    """Of every line, its prefix words as postings by bucket; lines that repeat in a batch post once."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, places, counts = frequent.value
        slots = _slots(table)
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            seen = np.zeros(0, np.uint64)
            for texts in blocks(batch.column(0)):
                _, _, begin, h = line_words(texts)
                one, _ = _set_keys(begin, h)
                if not len(one):
                    continue
                fresh = np.zeros(len(one), bool)
                fresh[np.unique(one, return_index=True)[1]] = True
                if len(seen):
                    fresh &= seen[np.minimum(np.searchsorted(seen, one), len(seen) - 1)] != one
                seen = np.sort(np.concatenate([seen, one[fresh]]))
                size = np.diff(begin)
                line = np.repeat(np.arange(len(one)), size)
                at = _places(slots, table, h)
                known = at >= 0
                rank = np.where(known, (np.uint64(1) << np.uint64(43)) + places[at] if len(table) else np.uint64(0), h >> np.uint64(21))
                # Parity of the words in each of 128 cells.
                cell = mix(h)
                bit, upper = np.uint64(1) << (cell & np.uint64(63)), cell >> np.uint64(63) > 0
                bits = np.stack([np.bitwise_xor.reduceat(np.where(side, bit, np.uint64(0)), begin[:-1]) for side in (upper, ~upper)], 1)
                order = _by_line(line, rank, h, 44)
                word, lasting = h[order], line[order]
                pos = np.arange(len(word)) - begin[:-1][lasting]
                prefix = size - -(-4 * size // 5) + 1
                keep = (pos < prefix[lasting]) & fresh[lasting]
                if not np.any(keep):
                    continue
                n = np.where(known, counts[at] if len(table) else 0, 0)[order]
                words, lasting, pos, n = word[keep], lasting[keep], pos[keep], n[keep]
                # The words of very many lines are dealt over tiles: the line goes to all pairs of chunks with its own.
                chunks = 1 + n // tile_lines
                copies, tile = np.arange(len(words)), np.zeros(1, int)
                if np.any(chunks > 1):
                    copies = np.repeat(copies, chunks)
                    other = np.arange(len(copies)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                    own = (one[lasting[copies]] % chunks[copies].astype(np.uint64)).astype(np.int64)
                    tile = np.minimum(own, other) * chunks[copies] + np.maximum(own, other)
                lists = mix(words[copies] + mix(tile.astype(np.uint64)))
                who = lasting[copies]
                held.append((lists, one[who], bits[who], size[who], pos[copies]))
                if sum(len(x[0]) for x in held) > HELD:
                    yield from _handed(held, buckets)
                    held = []
        yield from _handed(held, buckets)

    return post


def candidates(lists: np.ndarray, one: np.ndarray, bits: np.ndarray, size: np.ndarray, pos: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that share a list and pass all filters; rows are ordered by list and size."""
    i = np.arange(len(lists))
    step = 0
    while len(i):
        step += 1
        i = i[i + step < len(lists)]
        j = i + step
        # Lists are in order of size: once too long, all that follow are.
        near = (lists[i] == lists[j]) & (5 * size[i] >= 4 * size[j])
        i, j = i[near], j[near]
        least = -(-4 * (size[i] + size[j]) // 9)
        ok = (1 + np.minimum(size[i] - pos[i], size[j] - pos[j]) - 1 >= least) & (one[i] != one[j])
        a, b, most = i[ok], j[ok], (size[i] + size[j] - 2 * least)[ok]
        ok = np.bitwise_count(bits[a] ^ bits[b]).sum(1) <= most
        yield a[ok], b[ok]


def forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row that each row is connected with."""
    a, b = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, int) for k in (0, 1))
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all() and (label[a] == label[b]).all():
            return label


def _meet(table: pa.Table) -> pa.Table:
    lists, one, bits, size, pos = _received(table)
    order = np.lexsort((one, size, lists))
    lists, one, bits, size, pos = (x[order] for x in (lists, one, bits, size, pos))
    # The same line from two tasks is one row.
    new = np.ones(len(lists), bool)
    new[1:] = (lists[1:] != lists[:-1]) | (one[1:] != one[:-1])
    lists, one, bits, size, pos = (x[new] for x in (lists, one, bits, size, pos))
    name, node = np.unique(one, return_inverse=True)
    label = np.arange(len(name))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for i, j in candidates(lists, one, bits, size, pos):
        held.append((node[i], node[j]))
        rows += len(i)
        if rows > 2_000_000:
            label = forest(len(name), [*held, (np.arange(len(name)), label)])
            held, rows = [], 0
    label = forest(len(name), [*held, (np.arange(len(name)), label)])
    tied = np.flatnonzero(label != np.arange(len(name)))
    return pa.table({"a": name[tied].view(np.int64), "b": name[label[tied]].view(np.int64)})


_WANTED = {"component": "long", "one": "long", "two": "long", "rank": "long", "chunks": "int"}


def _wanted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted lines of documents: text, wanted (line and what is known of it)."""
    kinds = [pa.int64() if kind == "long" else pa.int32() for kind in _WANTED.values()]
    for batch in batches:
        wanted = batch.column(1).to_pylist()
        for texts in blocks(batch.column(0)):
            text, number, begin, h = line_words(texts)
            at = {(t, n): k for k, (t, n) in enumerate(zip(text.tolist(), number.tolist(), strict=True))}
            out = [(*(x[c] for c in _WANTED), h[begin[k] : begin[k + 1]].tobytes()) for t in range(len(texts)) for x in wanted[texts.first + t] for k in [at[(t, x["line"])]]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate([*kinds, pa.binary()])], [*_WANTED, "words"])


def matching(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which sets numbered ``left`` match which ones numbered ``right``: Jaccard of 4/5 or more, not the set itself."""
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    both = np.zeros((len(left), len(right)), np.float32)
    # Words a slice at a time, those that occur twice in it in blocks of columns: memory does not grow with the length of lines.
    slices = 1 + len(flat) // SLICE_WORDS
    for part in range(slices):
        mine = flat % np.uint64(slices) == part
        _, where, n = np.unique(flat[mine], return_inverse=True, return_counts=True)
        here = n[where] > 1
        column, line = (np.cumsum(n > 1) - 1)[where[here]], owner[mine][here]
        order = np.argsort(column, kind="stable")
        column, line = column[order], line[order]
        for first in range(0, int((n > 1).sum()), BLOCK_WORDS):
            a, b = np.searchsorted(column, (first, first + BLOCK_WORDS))
            full = np.zeros((len(sets), BLOCK_WORDS), np.float32)
            full[line[a:b], column[a:b] - first] = 1
            both += full[left] @ full[right].T
    return (9 * both >= 4 * (sizes[left][:, None] + sizes[right])) & (left[:, None] != right)


def _verify(table: pa.Table) -> pa.Table:
    """Of every line in a tile of its group: how many lines it matches there, and the keys of the matches' classes as (first rank)."""
    one, two, group, low, high, own, first = (table.column(c).to_numpy() for c in ("one", "two", "component", "low", "high", "own", "rank"))
    words = table.column("words").combine_chunks()
    place = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    data = np.frombuffer(words.buffers()[2], np.uint8) if place[-1] else np.zeros(0, np.uint8)
    order = np.lexsort((two, one, high, low, group))
    tile = np.stack([group[order], low[order], high[order]], 1)
    # A line of a document that occurs twice comes twice.
    new = np.append(True, np.any(tile[1:] != tile[:-1], axis=1) | (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))[: len(order)]
    order, tile = order[new], tile[new]
    cut = np.append(np.flatnonzero(np.any(np.diff(tile, axis=0, prepend=tile[:1] - 1), axis=1)), len(order))
    ones, twos, links, firsts = [], [], [], []
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        rows = order[i:j]
        sets = [data[place[k] : place[k + 1]].view(np.uint64) for k in rows]
        left, right = np.flatnonzero(own[rows] == low[rows[0]]), np.flatnonzero(own[rows] == high[rows[0]])
        if not len(left) or not len(right):
            continue
        found = matching(sets, left, right)
        sides = [(left, right, found)] if low[rows[0]] == high[rows[0]] else [(left, right, found), (right, left, found.T)]
        for me, others, hit in sides:
            n = hit.sum(1)
            best = np.where(hit, first[rows[others]][None, :], np.iinfo(np.int64).max).min(1)
            for k in np.flatnonzero(n):
                ones.append(one[rows[me[k]]])
                twos.append(two[rows[me[k]]])
                links.append(n[k])
                firsts.append(best[k])
    return pa.table({"one": pa.array(ones, pa.int64()), "two": pa.array(twos, pa.int64()), "links": pa.array(links, pa.int64()), "first": pa.array(firsts, pa.int64())})


def _frequent(spark: SparkSession, counts: DataFrame, limit: int):
    top = counts.orderBy(F.desc("n"), "hash").limit(limit).toArrow()
    h, n = top["hash"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(h)
    return spark.sparkContext.broadcast((h[order], (len(h) - order).astype(np.uint64), n[order]))


def _groups(rows: DataFrame, n_lines: int, list_lines: int) -> DataFrame:
    """Lines that may match, by group: one, component. Nothing of the postings is held on to, so that their files can go."""
    counts = rows.select("_text").mapInArrow(_counts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    buckets = max(1, n_lines * 10 // BUCKET_ROWS)
    posted = rows.select("_text").mapInArrow(_postings(_frequent(rows.sparkSession, counts, FREQUENT), list_lines, buckets), POSTED)
    edges = stored(posted.groupBy("bucket").applyInArrow(_meet, "a long, b long"))
    return stored(contracted_components(edges).withColumnsRenamed({"node": "one"}))


def match_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", list_lines: int = LIST_LINES, group_lines: int = GROUP_LINES) -> DataFrame:
    """One row per line with words: doc_id, _fp, line, links (other sets it matches), removed (an earlier line matches), first_doc (of the earliest match or itself)."""
    rows = numbered(docs, id_column, text_column)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    lines = stored(rows.select("doc_id", "_fp", "_text").mapInArrow(_lines, f"doc_id {id_type}, _fp long, line int, one long, two long"))
    place = F.struct("doc_id", "_fp", "line")
    kinds = stored(lines.groupBy("one", "two").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")))
    groups = _groups(rows, lines.count(), list_lines)

    # The first lines of the classes in such groups, and their rank in the order of lines: it need only order them.
    near = kinds.join(small_side(groups, groups.count()), "one").select("component", "one", "two", "at")
    chosen = stored(near.orderBy("at").withColumn("rank", F.monotonically_increasing_id()))
    many = chosen.count()
    sizes = chosen.groupBy("component").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_lines)
    sizes = stored(sizes.select("component", F.ceil(F.col("_n") / group_lines).cast("int").alias("chunks")))
    known = chosen.join(small_side(sizes, sizes.count()), "component", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    by_doc = known.groupBy("at.doc_id", "at._fp").agg(F.collect_list(F.struct("at.line", *_WANTED)).alias("wanted"))
    by_doc = small_side(by_doc, many)
    wanted = ", ".join(f"{c} {kind}" for c, kind in _WANTED.items())
    texts = rows.join(by_doc, same_row(rows, by_doc)).select("_text", "wanted").mapInArrow(_wanted_words, f"{wanted}, words binary")
    own = F.pmod(F.xxhash64("one"), F.col("chunks")).cast("int")
    tiles = texts.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiles = tiles.select("component", "one", "two", "rank", "words", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    # Lines as often as tiles hold them.
    spread = max(1, int(known.agg(F.sum("chunks")).first()[0] or 0) // 1_000)
    tiles = tiles.withColumn("bucket", F.pmod(F.xxhash64("component", "low", "high"), F.lit(spread)))
    verified = tiles.groupBy("bucket").applyInArrow(_verify, "one long, two long, links long, first long")
    links = stored(verified.groupBy("one", "two").agg(F.sum("links").alias("links"), F.min("first").alias("rank")))
    first_of = small_side(chosen.select("rank", F.col("at").alias("match")), many)
    links = small_side(links.join(first_of, "rank", "left").select("one", "two", "links", "match"), many)

    info = stored(kinds.join(links, ["one", "two"], "left").filter((F.col("n") > 1) | F.col("links").isNotNull()).select("one", "two", "at", "links", "match"))
    earliest = F.least("at", F.coalesce("match", "at"))
    found = lines.join(small_side(info, info.count()), ["one", "two"], "left").withColumn("earliest", F.coalesce(earliest, place))
    return found.select("doc_id", "_fp", "line", F.coalesce("links", F.lit(0)).alias("links"), (F.col("earliest") < place).alias("removed"), F.col("earliest.doc_id").alias("first_doc"))


def _by_document(lines: DataFrame) -> DataFrame:
    # Dealt by document once, for both.
    return lines.repartition("doc_id", "_fp").dropDuplicates(["doc_id", "_fp", "line"]).groupBy("doc_id", "_fp").agg(
        F.sum("links").alias("links"), F.min("first_doc").alias("first_doc"), F.collect_list(F.when(F.col("removed"), F.col("line"))).alias("gone")
    )


def dedup_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id with a line equal or similar to one of its own), n_lines, n_removed, n_links."""
    rows = numbered(docs, id_column, text_column).select("doc_id", "_fp", (F.regexp_count("_text", F.lit("\n")) + 1).cast("long").alias("n_lines"))
    found = _by_document(match_lines(docs, id_column, text_column, **options))
    out = rows.join(found, same_row(rows, found), "left")
    return out.select(
        rows["doc_id"], F.coalesce("first_doc", rows["doc_id"]).alias("class_id"), "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links")
    )


def remove_later_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents, all columns as they came, their text without the later of matching lines."""
    gone = _by_document(match_lines(docs, id_column, text_column, **options)).filter(F.size("gone") > 0)
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("_fp").alias("__fp"), F.col("gone").alias("__gone"))
    text = F.coalesce(F.col(text_column), F.lit(""))
    both = docs.join(gone, docs[id_column].eqNullSafe(gone["__id"]) & (F.xxhash64(text) == gone["__fp"]), "left")
    kept = F.array_join(F.filter(F.split(text_column, "\n"), lambda s, i: ~F.array_contains("__gone", i)), "\n")
    return both.withColumn(text_column, F.when(F.col("__gone").isNull(), F.col(text_column)).otherwise(kept)).select(*docs.columns)
