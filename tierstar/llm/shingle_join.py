"""Exact Jaccard join of documents as sets of word n-grams, by set relations.

A document is the set of its different shingles of four words (ASCII lower case; fewer words are one shingle, no words none). Two
documents link if 100 |x & y| >= 85 |x | y|. Documents with equal sets are one node from the start.

Index. Shingles have one order, from rare to frequent: by the count of a slot in a table of a fixed size that covers all documents, then
by hash (any order is exact, this one keeps lists short). A set posts its first |x| - ceil(85/100 |x|) + 1 shingles: sets that link
share one of these, and their first common one stands early in both. The entries of a list are kept in blocks of equal
size and position. Two blocks whose remaining shingles can't give the overlap that their sizes ask for are skipped whole, and
no entry of theirs is looked at; the entries of blocks that are not skipped are tied to one leader, so a list never gives pairs. The nodes
tied to a leader are then compared by counts of shingles in hashed cells (as many as an eighth of the set, so the bound on the
overlap is tight; it never falls short): the central node first, then only nodes that are not yet connected with most of the others. What is connected so is a group.

Answers. In a group the overlaps of a set with all others come from an index of the group, or, if a set done before is close, from that
set's overlaps: the lists of shingles that only one of the two has are taken off or added. Links are exact. A set that links already connect with
most of the others is not asked again, which loses no link between components. First each chunk of a group is joined with itself and with the group's hub, then
what is left unconnected with all chunks.

Lists of very many sets, leaders and groups are split into chunks, and each pair of chunks meets in one task. Hashes of 64 bits stand for shingles and
sets. Null texts are empty; empty texts link with nothing. Rows that share an id are told apart by their text; a
null id names a component only if all its ids are null. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import components, numbered, same_row, small_side, stored
from tierstar.llm.line_dedup import forest
from tierstar.llm.textarrays import Texts, blocks, mix

SHINGLE, PERCENT = 4, 85
#: Slots of the table of counts and ranges it is summed in; sets of a list, a leader or a group that are handled in one piece.
SLOTS, RANGES, LIST_SETS, LEADER_SETS, GROUP_SETS = 1 << 18, 16, 50_000, 4_096, 400
BUCKET_ROWS, TASK_SETS, TASK_TEXTS = 150_000, 5_000, 500
_FACTORS = np.random.default_rng(13).integers(1 << 62, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def all_shingles(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle, as they come."""
    starts, ends, first = texts.words()
    n = np.diff(first)
    h = texts.word_hashes(starts, ends)
    text = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(h)) - first[text]
    left = n[text] - place
    total = h * _FACTORS[0]
    for k in range(1, min(size, len(h))):
        total[: len(h) - k] += h[k:] * _FACTORS[k] * (left[: len(h) - k] > k)
    keep = (left >= size) | (place == 0)
    return text[keep], mix(total[keep] + np.minimum(n, size)[text[keep]].astype(np.uint64) * _FACTORS[-1])


def shingle_sets(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles, ordered by text and hash: text number and hash of each, and where each text's begin (and the end)."""
    text, h = all_shingles(texts, size)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    text, h = text[new], h[new]
    return text, h, np.searchsorted(text, np.arange(len(texts) + 1))


def needed(total: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap that links two sets of ``total`` shingles together."""
    return -(-percent * total // (100 + percent))


def cells(h: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles in hashed cells, at most 255 each; cells of a smaller table are sums of neighbours."""
    bits = max(4, int(len(h) // 8).bit_length())
    return np.minimum(np.bincount((mix(h) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def _described(size: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in blocks(batch.column(2)):
                _, h, begin = shingle_sets(texts, size)
                sums = np.append(np.uint64(0), np.cumsum(mix(h)))
                n = np.diff(begin)
                node = mix(sums[begin[1:]] - sums[begin[:-1]] + n.astype(np.uint64)).view(np.int64)
                tables = [cells(h[i:j]).tobytes() if j > i else None for i, j in zip(begin[:-1], begin[1:], strict=True)]
                rows = slice(texts.first, texts.first + len(texts))
                arrays = [batch.column(0)[rows], batch.column(1)[rows], pa.array(node, mask=n == 0), pa.array(n.astype(np.int64)), pa.array(tables, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "_fp", "node", "n", "cells"])

    return describe


def _slot(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(SLOTS - 1)).astype(np.int64)


def _slot_counts(size: int):
    """How many shingles fall into each slot, by range of slots, once for each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for texts in blocks(batch.column(0)):
                found += np.bincount(_slot(all_shingles(texts, size)[1]), minlength=SLOTS)
        if found.any():
            parts = [x.tobytes() for x in found.reshape(RANGES, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(RANGES, dtype=np.int32)), pa.array(parts, pa.binary())], ["range", "counts"])

    return count


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(SLOTS // RANGES, np.int64)
    for x in table.column("counts"):
        total += np.frombuffer(x.as_buffer(), np.int64)
    return pa.table({"range": table.column("range").slice(0, 1).cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _postings(shared, size: int, percent: int, list_sets: int):
    """Of every set, its first shingles as rows (list, node, size_pos); sets that repeat in a batch post once."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        usual = 2 * int(counts.mean())
        for batch in batches:
            seen = np.zeros(0, np.uint64)
            for texts in blocks(batch.column(0)):
                text, h, begin = shingle_sets(texts, size)
                n = np.diff(begin)
                sums = np.append(np.uint64(0), np.cumsum(mix(h)))
                node = mix(sums[begin[1:]] - sums[begin[:-1]] + n.astype(np.uint64))
                fresh = np.zeros(len(node), bool)
                fresh[np.unique(node, return_index=True)[1]] = True
                fresh &= (n > 0) & ~np.isin(node, seen)
                seen = np.concatenate([seen, node[fresh]])
                often = counts[_slot(h)]
                order = np.lexsort((h, often, text))
                h, often = h[order], often[order]
                pos = np.arange(len(h)) - begin[text]
                keep = (pos < (n - -(-percent * n // 100) + 1)[text]) & fresh[text]
                word, who, pos, often = h[keep], text[keep], pos[keep], often[keep]
                chunks = 1 + np.maximum(0, often - usual) // list_sets
                copies = np.repeat(np.arange(len(word)), chunks)
                other = np.arange(len(copies)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                own = (node[who[copies]] % chunks[copies].astype(np.uint64)).astype(np.int64)
                tile = np.minimum(own, other) * chunks[copies] + np.maximum(own, other)
                lists = mix(word[copies] + mix(tile.astype(np.uint64)))
                size_pos = n[who[copies]].astype(np.int64) << 32 | pos[copies]
                yield pa.RecordBatch.from_arrays([pa.array(lists.view(np.int64)), pa.array(node[who[copies]].view(np.int64)), pa.array(size_pos)], ["list", "node", "size_pos"])

    return post


def live_blocks(lists: np.ndarray, size: np.ndarray, pos: np.ndarray, count: np.ndarray, percent: int) -> np.ndarray:
    """The smallest block that each block is tied to by pairs that can't be skipped, or -1; blocks are ordered by list, size and position."""
    i = np.arange(len(lists))
    alone = (count > 1) & (size - pos >= needed(2 * size, percent))
    pairs, tied, step = [], alone.copy(), 0
    while len(i):
        step += 1
        i = i[i + step < len(lists)]
        j = i + step
        near = (lists[i] == lists[j]) & (100 * size[i] >= percent * size[j])
        i, j = i[near], j[near]
        ok = np.minimum(size[i] - pos[i], size[j] - pos[j]) >= needed(size[i] + size[j], percent)
        pairs.append((i[ok], j[ok]))
        tied[i[ok]] = tied[j[ok]] = True
    return np.where(tied, forest(len(lists), pairs), -1)


def _meet(percent: int):
    """Rows (leader, node) of the nodes whose blocks meet in some list of a bucket."""

    def meet(table: pa.Table) -> pa.Table:
        lists, node, size_pos = (table.column(c).to_numpy() for c in ("list", "node", "size_pos"))
        order = np.lexsort((node, size_pos, lists))
        lists, node, size_pos = lists[order], node[order], size_pos[order]
        new = np.ones(len(lists), bool)
        new[1:] = (lists[1:] != lists[:-1]) | (node[1:] != node[:-1]) | (size_pos[1:] != size_pos[:-1])
        several = np.zeros(len(lists), bool)
        several[1:] = lists[1:] == lists[:-1]
        several[:-1] |= several[1:]
        keep = new & several
        lists, node, size_pos = lists[keep], node[keep], size_pos[keep]
        edge = np.ones(len(lists), bool)
        edge[1:] = (lists[1:] != lists[:-1]) | (size_pos[1:] != size_pos[:-1])
        begin = np.flatnonzero(edge)
        label = live_blocks(lists[begin], size_pos[begin] >> 32, size_pos[begin] & 0xFFFFFFFF, np.diff(begin, append=len(lists)), percent)
        label = np.repeat(label, np.diff(begin, append=len(lists)))
        label, node = label[label >= 0], node[label >= 0]
        # The leader is the node of the least hash, so that the lists of one family mostly agree on it.
        order = np.lexsort((mix(node.view(np.uint64)), label))
        label, node = label[order], node[order]
        first = np.flatnonzero(np.append(True, label[1:] != label[:-1])) if len(label) else np.zeros(0, int)
        leader = np.repeat(node[first], np.diff(first, append=len(node)))
        both = np.unique(np.stack([leader, node], 1), axis=0)
        return pa.table({"leader": both[:, 0], "node": both[:, 1]})

    return meet


def dealt(rows: DataFrame, group: str, sets: int) -> DataFrame:
    """Rows (group, node) with the tiles they meet in: own, low, high."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / sets).cast("int").alias("chunks")).filter(F.col("chunks") > 1)
    chunks = F.coalesce("chunks", F.lit(1))
    own = rows.join(sizes, group, "left").withColumn("own", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    each = own.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return each.drop("chunks").withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other")


def in_tasks(tiles: DataFrame, group: str, n: int):
    return tiles.withColumn("task", F.pmod(F.xxhash64(group, "low", "high"), F.lit(max(1, n)))).groupBy("task")


def _tiles(table: pa.Table, group: str) -> Iterator[np.ndarray]:
    """Row numbers of each tile."""
    name, low, high = (table.column(c).to_numpy() for c in (group, "low", "high"))
    order = np.lexsort((high, low, name))
    tile = np.stack([name[order], low[order], high[order]], 1)
    cut = np.append(np.flatnonzero(np.append(True, np.any(tile[1:] != tile[:-1], axis=1))), len(order)) if len(order) else [0]
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        yield order[i:j]


class _Connected:
    """Components of numbered rows, named by their smallest row."""

    def __init__(self, label: np.ndarray):
        self.label = label

    def tie(self, one: int, others: np.ndarray) -> np.ndarray:
        """Connect ``one`` with ``others``; of these, one for each component that was another one."""
        names, at = np.unique(self.label[others], return_index=True)
        far = names != self.label[one]
        if far.any():
            joined = np.append(names[far], self.label[one])
            self.label[np.isin(self.label, joined)] = joined.min()
        return others[at[far]]

    def open(self, rows: np.ndarray) -> np.ndarray:
        """Those of ``rows`` outside the largest component."""
        return rows[self.label[rows] != np.bincount(self.label).argmax()]


def _folded(table: np.ndarray, width: int) -> np.ndarray:
    return table if table.shape[1] == width else table.reshape(len(table), width, -1).sum(2)


def likely(sizes: np.ndarray, tables: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of sets that connect all whose cells do not rule a link out: the most central set first, then those not connected with most others."""
    widths = np.array([len(t) for t in tables])
    of = {w: np.flatnonzero(widths == w) for w in np.unique(widths)}
    matrix = {w: np.stack([tables[k] for k in rows]).astype(np.int32) for w, rows in of.items()}
    lost = np.empty(len(sizes), np.int64)
    central = []
    for w, rows in of.items():
        lost[rows] = sizes[rows] - matrix[w].sum(1)
        central.append(rows[np.abs(matrix[w] - np.median(matrix[w], axis=0)).sum(1).argmin()])
    narrow = {w: matrix[w].astype(np.int16) for w in matrix}
    connected = _Connected(np.arange(len(sizes)))
    pairs, done, place = [], np.zeros(len(sizes), bool), np.empty(len(sizes), np.int64)
    for rows in of.values():
        place[rows] = np.arange(len(rows))

    def ask(k: int) -> None:
        done[k] = True
        w = widths[k]
        mine = narrow[w][place[k]][None]
        for width in (w // 2, w, 2 * w):
            if width in of:
                rows = of[width]
                rows_ok = (percent * np.maximum(sizes[rows], sizes[k]) <= 100 * np.minimum(sizes[rows], sizes[k])) & (connected.label[rows] != connected.label[k])
                rows = rows[rows_ok]
                if len(rows):
                    least = min(w, width)
                    both = np.minimum(_folded(narrow[width][place[rows]], least), _folded(mine, least)).sum(1) + np.minimum(lost[rows], lost[k])
                    near = rows[both >= needed(sizes[rows] + sizes[k], percent)]
                    pairs.extend((k, int(x)) for x in connected.tie(k, near))

    for k in central:
        ask(k)
    while len(todo := connected.open(np.flatnonzero(~done))):
        for k in todo[:64]:
            ask(k)
    return pairs


def _grouped(percent: int):
    def group(table: pa.Table) -> pa.Table:
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        counts = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("cells")]
        out = []
        for rows in _tiles(table, "leader"):
            if len(rows) > 1:
                out += [(rows[a], rows[b]) for a, b in likely(n[rows], [counts[k] for k in rows], percent)]
        a, b = np.array(out, int).reshape(-1, 2).T
        return pa.table({"a": node[a], "b": node[b]})

    return group


class Answers:
    """Overlaps of sets with all sets of a tile, from an index or from the overlaps of a close set."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        _, self.where = np.unique(np.concatenate(sets), return_inverse=True)
        self.begin = np.append(0, np.cumsum(self.size))
        order = np.argsort(self.where, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.size)[order]
        self.lists = np.append(0, np.cumsum(np.bincount(self.where)))
        self.done: list[tuple[int, np.ndarray]] = []
        self.derived = 0

    def tokens(self, k: int) -> np.ndarray:
        return self.where[self.begin[k] : self.begin[k + 1]]

    def held(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each set has."""
        n = self.lists[tokens + 1] - self.lists[tokens]
        at = np.arange(n.sum()) + np.repeat(self.lists[tokens] - np.cumsum(n) + n, n)
        return np.bincount(self.owner[at], minlength=len(self.size))

    def of(self, k: int) -> np.ndarray:
        overlap = None
        if self.done:
            near, found = max(self.done, key=lambda x: 2 * x[1][k] - self.size[x[0]])
            if self.size[near] + self.size[k] - 2 * found[k] < self.size[k]:
                one, two = self.tokens(k), self.tokens(near)
                overlap = found + self.held(np.setdiff1d(one, two, True)) - self.held(np.setdiff1d(two, one, True))
                self.derived += 1
        if overlap is None:
            overlap = self.held(self.tokens(k))
        self.done.append((k, overlap))
        return overlap


def links_between(sets: list[np.ndarray], asked: np.ndarray, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all that links of the ``asked`` sets with any set connect; ``label`` names what is connected already."""
    answers, connected, out = Answers(sets), _Connected(label), []
    done = np.zeros(len(sets), bool)
    ask = list(asked[:1])
    while ask:
        for k in ask:
            done[k] = True
            overlap = answers.of(k)
            total = answers.size + answers.size[k]
            linked = np.flatnonzero((100 * overlap >= percent * (total - overlap)) & (np.arange(len(sets)) != k))
            out += [(int(k), int(x)) for x in connected.tie(k, linked)]
        ask = list(connected.open(asked[~done[asked]])[:16])
    return out


def _verified(size: int, percent: int):
    """Links (a, b) of the asked rows of every tile that connect different classes."""

    def verify(table: pa.Table) -> pa.Table:
        node, asked = table.column("node").to_numpy(), table.column("asked").to_numpy(zero_copy_only=False)
        kind, text = table.column("class").to_numpy(), table.column("_text").combine_chunks()
        out = []
        for rows in _tiles(table, "component"):
            if len(rows) < 2 or not asked[rows].any():
                continue
            sets = []
            for texts in blocks(text.take(pa.array(rows))):
                _, h, begin = shingle_sets(texts, size)
                sets += [h[i:j] for i, j in zip(begin[:-1], begin[1:], strict=True)]
            _, first, within = np.unique(kind[rows], return_index=True, return_inverse=True)
            out += [(rows[a], rows[b]) for a, b in links_between(sets, np.flatnonzero(asked[rows]), first[within], percent)]
        a, b = np.array(out, int).reshape(-1, 2).T
        return pa.table({"a": node[a], "b": node[b]})

    return verify


def _classes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    found = components(edges).withColumnsRenamed({"component": "_class"})
    return stored(nodes.join(found, "node", "left").select(*nodes.columns, F.coalesce("_class", "node").alias("class")))


def links(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE, percent: int = PERCENT, list_sets: int = LIST_SETS, leader_sets: int = LEADER_SETS, group_sets: int = GROUP_SETS) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, _fp, node, n) and links between nodes (a, b) that connect all documents that links connect."""
    spark = docs.sparkSession
    rows = numbered(docs, id_column, text_column)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    described = rows.select("doc_id", "_fp", "_text").mapInArrow(_described(size), f"doc_id {id_type}, _fp long, node long, n long, cells binary")
    described = stored(described)
    held = described.filter(F.col("node").isNotNull())
    sets = stored(held.groupBy("node").agg(F.min(F.struct("doc_id", "_fp")).alias("at"), F.first("n").alias("n"), F.first("cells").alias("cells")))

    text = rows.select("_text")
    ranges = text.mapInArrow(_slot_counts(size), "range int, counts binary").groupBy("range").applyInArrow(_summed, "range int, counts binary").collect()
    counts = np.zeros((RANGES, SLOTS // RANGES), np.int64)
    for r in ranges:
        counts[r["range"]] = np.frombuffer(r["counts"], np.int64)
    shared = spark.sparkContext.broadcast(counts.reshape(-1))
    posted = text.mapInArrow(_postings(shared, size, percent, list_sets), "list long, node long, size_pos long")
    many = held.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1)).first()[0] or 0
    met = posted.withColumn("bucket", F.pmod("list", F.lit(many // BUCKET_ROWS + 1))).groupBy("bucket").applyInArrow(_meet(percent), "leader long, node long")
    led = stored(met.distinct())

    # Groups of nodes that may link, by leader.
    tiles = stored(dealt(led, "leader", leader_sets))
    full = tiles.join(sets.select("node", "n", "cells"), "node")
    edges = stored(in_tasks(full, "leader", tiles.count() // TASK_SETS).applyInArrow(_grouped(percent), "a long, b long").distinct())
    groups = stored(components(edges))
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("ends"))
    hubs = groups.join(ends, "node").groupBy("component").agg(F.max_by("node", F.struct("ends", "node")).alias("hub"), F.count(F.lit(1)).alias("many"))

    # The text of each node of a group.
    wanted = stored(groups.join(sets.select("node", "at"), "node").select("node", "at.doc_id", "at._fp"))
    side = small_side(wanted, wanted.count())
    texts = stored(rows.join(side, same_row(rows, side)).select("node", "_text").dropDuplicates(["node"]))

    # First each chunk with itself and with the hub of its group.
    grown = stored(groups.join(hubs, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.ceil(F.col("many") / group_sets)).cast("int")))
    hub = grown.filter(F.col("node") == F.col("hub")).withColumn("other", F.explode(F.sequence(F.lit(0), F.ceil(F.col("many") / group_sets).cast("int") - 1)))
    extra = hub.filter(F.col("other") != F.col("own")).select("component", "node", F.col("other").alias("low"))
    first = grown.select("component", "node", F.col("own").alias("low")).unionByName(extra).withColumn("high", F.col("low"))
    first = first.withColumns({"asked": F.lit(True), "class": F.col("node")})
    tasks = wanted.count() // TASK_TEXTS
    early = stored(in_tasks(first.join(texts, "node"), "component", tasks).applyInArrow(_verified(size, percent), "a long, b long"))

    # Then, in groups of several chunks, the sets outside the largest class with those of all other chunks.
    named = _classes(grown.filter(F.col("many") > group_sets).select("component", "node"), early)
    sizes = named.groupBy("component", "class").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("component").agg(F.max_by("class", F.struct("n", "class")).alias("main"), F.count(F.lit(1)).alias("kinds"))
    split = stored(named.join(largest.filter(F.col("kinds") > 1), "component").withColumn("asked", F.col("class") != F.col("main")))
    if split.isEmpty():
        return described, early
    chunked = dealt(split.select("component", "node", "class", "asked"), "component", group_sets)
    live = chunked.filter(F.col("asked") & (F.col("low") < F.col("high"))).select("component", "low", "high").distinct()
    tiles = stored(chunked.join(live, ["component", "low", "high"], "left_semi"))
    late = in_tasks(tiles.join(texts, "node"), "component", tiles.count() // TASK_TEXTS).applyInArrow(_verified(size, percent), "a long, b long")
    return described, early.unionByName(stored(late))


def join_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach), component_size (documents)."""
    described, found = links(docs, id_column, text_column, **options)
    held = described.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    named = _classes(held, found)
    ids = named.groupBy("class").agg(F.min("low").alias("component_id"), F.sum("n").alias("component_size")).filter(F.col("component_size") > 1)
    several = stored(named.join(ids, "class").select("node", "component_id", "component_size"))
    out = described.select("doc_id", "node", "n").join(small_side(several, several.count()), "node", "left")
    low: Column = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), low.alias("component_id"), F.coalesce("component_size", F.lit(1)).cast("long").alias("component_size"))


def join_sql(size: int = SHINGLE, percent: int = PERCENT) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - {size} + 2, 2)), lambda i: array_to_string(list_slice(w, i, i + {size} - 1), ' '))) AS g
              FROM w WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        link AS (SELECT x, y FROM p JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y WHERE 100 * c >= {percent} * (a.n + b.n - c)),
        edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
        reach AS (SELECT x, y FROM edge UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y),
        low AS (SELECT x AS doc_id, least(x, min(y)) AS component_id, count(DISTINCT y) AS component_size FROM reach GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_size, 1) AS component_size
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)"""
