"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is the weighted set of its five-word shingles (weight: how often it occurs; a text of fewer words
is one shingle). Each shingle sends arrivals of a Poisson process of its weight to random registers; a
register keeps the earliest arrival, and a shingle stops as soon as its next arrival comes later than
every register of its document. Two documents agree in a register with the probability Jaccard
similarity of their weights, which is the plain Jaccard similarity where no shingle repeats.

Registers are banded (25 bands of 5: a pair at 0.8 meets in some band with probability above
0.9999). A first pass over five bands only saves work: every document of a bucket is compared with two leaders
of it, inside the task that holds the bucket or a part of it, and linked to one at most; the verified ones of these links
join most of a large group at few comparisons. The second pass then
compares, in every bucket of all bands, all pairs of documents that the first one left in different components. They are
estimated by their registers (``doubt`` below the threshold still passes), and tasks keep spanning forests of
what passes. The connected components of these forests are the groups that may hold further links; in each group
all pairs whose registers pass are compared exactly on their whole texts, except pairs that verified links connect
already. A bucket or group above a bound is dealt over tiles: it is split into chunks, and each pair of chunks meets in
one task. Classes are the connected components of all verified links.

Equal texts are one node of the graph from the start. Null texts are empty; empty texts have no
shingle and are alike only to each other. Rows that share id and text get the same answer; a null
id is never the name of a class unless all are null. An empty table gives an empty result; other
columns are ignored and carried along by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.llm.common import contracted_components, small_side, stored, text_of
from tierstar.llm.line_dedup import forest
from tierstar.llm.textarrays import Texts, blocks, mix

SHINGLE, THRESHOLD, DOUBT = 5, 0.8, 0.15
BANDS, ROWS, FIRST_BANDS = 25, 5, 5
REGISTERS = BANDS * ROWS
#: Documents of one bucket, or of one group, that are compared in one piece, and rows of a task of such pieces.
BUCKET_NODES, GROUP_NODES, TASK_ROWS, TASK_TEXTS = 1_000, 300, 10_000, 500
_FACTORS = np.random.default_rng(11).integers(1 << 62, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text: text number, hash and count, ordered by both."""
    starts, ends, first = texts.words()
    n = np.diff(first)
    h = texts.word_hashes(starts, ends)
    text = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(h)) - first[text]
    left = n[text] - place
    total = h * _FACTORS[0]
    for k in range(1, min(SHINGLE, len(h))):
        total[: len(h) - k] += h[k:] * _FACTORS[k] * (left[: len(h) - k] > k)
    keep = (left >= SHINGLE) | (place == 0)
    text, hashes = text[keep], mix(total[keep])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(at, append=len(text))


def probminhash(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that each register of each text holds (0 for texts without any), all texts side by side.

    In round t every live shingle makes its t-th arrival; it ends once that is past the latest register of its text.
    """
    best = np.full(n_texts * registers, np.inf)
    held = np.zeros(n_texts * registers, np.uint64)
    now, rate = np.zeros(len(text)), weights.astype(float)
    seed = 0
    while len(text):
        seed = (seed + int(_STEP)) & 0xFFFFFFFFFFFFFFFF
        draw = mix(hashes + np.uint64(seed))
        now = now - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate
        slot = text * registers + (mix(draw ^ _STEP) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, slot, now)
        won = best[slot] == now
        held[slot[won]] = hashes[won]
        live = now < best.reshape(n_texts, registers).max(1)[text]
        text, hashes, now, rate = text[live], hashes[live], now[live], rate[live]
    return held.reshape(n_texts, registers)


def band_keys(held: np.ndarray) -> np.ndarray:
    parts = held.reshape(len(held), BANDS, ROWS)
    key = np.zeros((len(held), BANDS), np.uint64)
    for r in range(ROWS):
        key = mix(key * _STEP + parts[:, :, r])
    return mix(key + np.arange(BANDS, dtype=np.uint64) * _FACTORS[0])


@F.arrow_udf(T.StructType([T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("registers", T.BinaryType())]))
def _sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        keys, registers = [], []
        for texts in blocks(batch):
            text, hashes, counts = shingles(texts)
            held = probminhash(text, hashes, counts, len(texts))
            some = np.bincount(text, minlength=len(texts)) > 0
            keys += [k if s else None for k, s in zip(band_keys(held).view(np.int64), some, strict=True)]
            registers += [r.tobytes() if s else None for r, s in zip(held.astype(np.uint32), some, strict=True)]
        yield pa.StructArray.from_arrays([pa.array(keys, pa.list_(pa.int64())), pa.array(registers, pa.binary())], ["keys", "registers"])


def probability_jaccard(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i); elements ordered, with counts."""
    (h, x), (g, y) = one, other
    common, i, j = np.intersect1d(h, g, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if x.max() == y.max() == 1:
        return len(common) / (len(h) + len(g) - len(common))
    alone_x, alone_y = np.delete(x, i), np.delete(y, j)
    weights = np.concatenate([np.stack([x[i], y[j]], 1), np.stack([alone_x, 0 * alone_x], 1), np.stack([0 * alone_y, alone_y], 1)]).astype(float)
    kinds, n = np.unique(weights, axis=0, return_counts=True)
    both = (kinds > 0).all(1)
    return float(sum(k / (n * np.maximum(kinds[:, 0] / a, kinds[:, 1] / b)).sum() for (a, b), k in zip(kinds[both], n[both], strict=True)))


def _weighted_sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for texts in blocks(column):
        text, hashes, counts = shingles(texts)
        cut = np.searchsorted(text, np.arange(len(texts) + 1))
        out += [(hashes[i:j], counts[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    return out


@F.arrow_udf(T.DoubleType())
def _similarity(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for one, other in batches:
        yield pa.array([probability_jaccard(a, b) for a, b in zip(_weighted_sets(one), _weighted_sets(other), strict=True)], pa.float64())


def _nodes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = text_of(text_column)
    return docs.select(F.col(id_column).alias("doc_id"), text.alias("_text"), F.unhex(F.md5(text.cast("binary"))).alias("node"))


def _led(rows: DataFrame, bucket_nodes: int) -> DataFrame:
    """Nodes of every bucket (key, node) of two or more, dealt over parts; those that lead it (rank 0: the smallest, 1: the largest) are in each part."""
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).filter(F.col("low") != F.col("high"))
    parts = F.ceil(F.col("n") / bucket_nodes).cast("int")
    others = rows.join(buckets, "key").filter((F.col("node") != F.col("low")) & (F.col("node") != F.col("high")))
    others = others.select("key", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), F.lit(2).alias("rank"), "node")
    each = buckets.select("key", "low", "high", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return others.unionByName(each.select("key", "part", F.posexplode(F.array("low", "high")).alias("rank", "node")))


def _follow(least: int):
    """Links (a, b) of the nodes of every part of a bucket to one of its two leaders whose registers agree, the smaller one if both do."""

    def follow(table: pa.Table) -> pa.Table:
        rank, part = (table.column(c).to_numpy() for c in ("rank", "part"))
        bucket = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
        registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint32).reshape(-1, REGISTERS)
        order = np.lexsort((rank, part, bucket))
        low = np.flatnonzero(rank[order] == 0)
        led = np.repeat(low, np.diff(low, append=len(order)))
        low, high = order[led], order[led + 1]
        to_low = ((registers[order] == registers[low]).sum(1) >= least) & (rank[order] > 0)
        to_high = ((registers[order] == registers[high]).sum(1) >= least) & (rank[order] > 1) & ~to_low
        one, other = np.concatenate([low[to_low], order[to_high]]), np.concatenate([order[to_low], high[to_high]])
        return pa.table({"a": table.column("node").take(pa.array(one)), "b": table.column("node").take(pa.array(other))})

    return follow


def _alike(registers: np.ndarray, classes: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of ``left`` and ``right`` (equal or without common rows) of different classes that agree in ``least`` registers, and in how many."""
    found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int))]
    # Pairs within the largest class need no look.
    names, n = np.unique(np.concatenate([classes[left], classes[right]]), return_counts=True)
    inside = lambda rows: classes[rows] == names[n.argmax()]
    same = left is right
    for some, others in [(left[~inside(left)], right)] if same else [(left[~inside(left)], right), (left[inside(left)], right[~inside(right)])]:
        columns = np.ascontiguousarray(registers[others].T)
        for at in range(0, len(some), 256):
            mine = registers[some[at : at + 256]].T
            agree = np.zeros((mine.shape[1], len(others)), np.uint8)
            for k in range(REGISTERS):
                agree += mine[k][:, None] == columns[k]
            i, j = np.nonzero((agree >= least) & (classes[some[at : at + 256]][:, None] != classes[others]))
            found.append((some[at : at + 256][i], others[j], agree[i, j]))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def _tiles(table: pa.Table, group: str) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Registers and classes (numbers) of all rows, and of each tile its rows and the two sides that meet there."""
    low, high, own = (table.column(c).to_numpy() for c in ("low", "high", "own"))
    name, kind = (table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in (group, "class"))
    registers = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint32).reshape(-1, REGISTERS)
    order = np.lexsort((high, low, name))
    tile = np.stack([name[order], low[order], high[order]], 1)
    cut = np.append(np.flatnonzero(np.any(np.diff(tile, axis=0, prepend=tile[:1] - 1), axis=1)), len(order))

    def each():
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            rows = order[i:j]
            left = rows if low[rows[0]] == high[rows[0]] else rows[own[rows] == low[rows[0]]]
            yield rows, left, left if low[rows[0]] == high[rows[0]] else rows[own[rows] == high[rows[0]]]

    return registers, kind, each()


def _meet(least: int):
    """A spanning forest (a, b) of the pairs of every bucket that may be alike."""

    def meet(table: pa.Table) -> pa.Table:
        registers, kind, tiles = _tiles(table, "key")
        one, other, pairs = [], [], []
        for rows, left, right in tiles:
            if len(rows) == 2:
                pairs.append(rows)
            elif len(left) and len(right):
                i, j, _ = _alike(registers, kind, left, right, least)
                at, ends = np.unique(np.concatenate([i, j]), return_inverse=True)
                label = forest(len(at), [(ends[: len(i)], ends[len(i) :])])
                tied = np.flatnonzero(label != np.arange(len(at)))
                one.append(at[tied])
                other.append(at[label[tied]])
        if pairs:
            i, j = np.array(pairs).T
            near = ((registers[i] == registers[j]).sum(1) >= least) & (kind[i] != kind[j])
            one.append(i[near])
            other.append(j[near])
        one, other = (pa.array(np.concatenate(x) if x else np.zeros(0, int), pa.int64()) for x in (one, other))
        return pa.table({"a": table.column("node").take(one), "b": table.column("node").take(other)})

    return meet


def _possible(sets: list[tuple[np.ndarray, np.ndarray]], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets may reach the threshold: exact where no shingle repeats, else by the share of common weight in each."""
    hashes, where, held = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    owner, counts = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets]), np.concatenate([n for _, n in sets])
    common = held[where] > 1
    owner, where, counts = owner[common], (np.cumsum(held > 1) - 1)[where[common]], counts[common]
    order = np.argsort(where, kind="stable")
    owner, where, counts = owner[order], where[order], counts[order]
    shared = np.zeros((len(sets), len(sets)))
    for at in range(0, int((held > 1).sum()), 8192):
        a, b = np.searchsorted(where, (at, at + 8192))
        has, weight = (np.zeros((len(sets), 8192), np.float32) for _ in range(2))
        has[owner[a:b], where[a:b] - at] = 1
        weight[owner[a:b], where[a:b] - at] = counts[a:b]
        shared += weight @ has.T
    total, plain = np.array([n.sum() for _, n in sets], float), np.array([n.max() == 1 for _, n in sets])
    x, y = shared[i, j], shared[j, i]
    most = np.where(plain[i] & plain[j], x / (total[i] + total[j] - x), np.minimum(x / total[i], y / total[j]))
    return most >= threshold - 1e-5


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = i = parent[parent[i]]
    return i


def _verify(threshold: float, least: int):
    """A spanning forest (a, b, similarity) of the verified links between the classes of every group."""

    def verify(table: pa.Table) -> pa.Table:
        registers, kind, tiles = _tiles(table, "component")
        nodes, text = table.column("node").to_pylist(), table.column("_text").combine_chunks()
        links = []
        for _, left, right in tiles:
            i, j, agree = _alike(registers, kind, left, right, least) if len(left) and len(right) else ((), (), np.zeros(0))
            if not len(i):
                continue
            rows, ends = np.unique(np.concatenate([i, j]), return_inverse=True)
            sets = _weighted_sets(text.take(pa.array(rows)))
            _, first, within = np.unique(kind[rows], return_index=True, return_inverse=True)
            parent = first[within].tolist()
            can = _possible(sets, ends[: len(i)], ends[len(i) :], threshold)
            agree, ends = agree[can], ends[np.concatenate([can, can])]
            # The most alike first: they are links most often, and connect what need not be compared any more.
            order = np.argsort(-agree.astype(int), kind="stable")
            for x, y in zip(ends[: len(agree)][order].tolist(), ends[len(agree) :][order].tolist(), strict=True):
                p, q = _root(parent, x), _root(parent, y)
                if p != q and (found := probability_jaccard(sets[x], sets[y])) >= threshold:
                    parent[max(p, q)] = min(p, q)
                    links.append((*sorted((nodes[rows[x]], nodes[rows[y]])), found))
        return pa.table({k: pa.array([x[n] for x in links], kind) for n, (k, kind) in enumerate((("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())))})

    return verify


def _dealt(rows: DataFrame, group: str, chunks: Column) -> DataFrame:
    """Rows (group, node, class) with the tile they meet in: own, low, high."""
    own = rows.withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    each = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return each.select(group, "node", "class", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def _in_tasks(tiles: DataFrame, group: str, n: int) -> DataFrame:
    return tiles.withColumn("task", F.pmod(F.xxhash64(group, "low", "high"), F.lit(max(1, n)))).groupBy("task")


def _texts_of(nodes: DataFrame, rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """The text of each node (different ones): node, _text; stored."""
    wanted = stored(nodes.join(sketches.select("node", "doc_id"), "node"))
    # By id as well, so that beyond the limit of a broadcast the rows of one text do not meet in one task.
    same = (rows["node"] == wanted["node"]) & rows["doc_id"].eqNullSafe(wanted["doc_id"])
    return stored(rows.join(small_side(wanted, wanted.count()), same, "left_semi").select("node", "_text").dropDuplicates(["node"]))


def _verified(pairs: DataFrame, rows: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """The pairs that are alike by their whole texts; stored."""
    likely = stored(pairs)
    texts = _texts_of(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), rows, sketches)
    compared = likely.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return stored(compared.select("a", "b", _similarity("ta", "tb").alias("similarity")).filter(F.col("similarity") >= threshold))


def links(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD, doubt: float = DOUBT, bucket_nodes: int = BUCKET_NODES, group_nodes: int = GROUP_NODES) -> DataFrame:
    """Verified links between different texts that connect all that is alike: a, b (md5 of the texts, a < b), similarity."""
    rows = _nodes(docs, id_column, text_column)
    drawn = rows.select("doc_id", "node", _sketch("_text").alias("s")).filter(F.col("s.registers").isNotNull())
    # One row per text: the smallest id stands for it.
    sketches = stored(drawn.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("s").alias("s")).select("node", "doc_id", "s.*"))
    banded = sketches.select("node", F.posexplode("keys").alias("band", "key"))
    least = int(np.ceil((threshold - doubt) * REGISTERS - 1e-9))
    # First a few bands, with the same leaders wherever possible: most members of a large group are linked there.
    led = stored(_led(banded.filter(F.col("band") < FIRST_BANDS).select("key", "node"), bucket_nodes))
    full = led.join(sketches.select("node", "registers"), "node").withColumn("task", F.pmod(F.xxhash64("key", "part"), F.lit(max(1, led.count() // TASK_ROWS))))
    early = _verified(full.groupBy("task").applyInArrow(_follow(least), "a binary, b binary").distinct(), rows, sketches, threshold)
    # Then all pairs of different components in all buckets.
    named = stored(sketches.select("node").join(contracted_components(early), "node", "left").select("node", F.coalesce("component", "node").alias("class")))
    held = banded.join(named, "node").select("key", "node", "class")
    mixed = held.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y"), F.count(F.lit(1)).alias("n")).filter(F.col("x") != F.col("y"))
    chunks = F.ceil(F.col("n") / bucket_nodes).cast("int")
    tiles = stored(_dealt(held.join(mixed.select("key", "n"), "key"), "key", chunks))
    full = tiles.join(sketches.select("node", "registers"), "node")
    near = stored(_in_tasks(full, "key", tiles.count() // TASK_ROWS).applyInArrow(_meet(least), "a binary, b binary").distinct())
    groups = contracted_components(near)
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_nodes)
    chunks = F.coalesce(F.ceil(F.col("n") / group_nodes), F.lit(1)).cast("int")
    tiles = stored(_dealt(groups.join(named, "node").join(sizes, "component", "left"), "component", chunks))
    full = tiles.join(sketches.select("node", "registers"), "node").join(_texts_of(groups.select("node"), rows, sketches), "node")
    late = _in_tasks(full, "component", tiles.count() // TASK_TEXTS).applyInArrow(_verify(threshold, least), "a binary, b binary, similarity double")
    return early.unionByName(stored(late))


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per document: doc_id, node, group_id (the smallest id of its class), group_size, kept."""
    parts = contracted_components(links(docs, id_column, text_column, threshold, **options))
    rows = _nodes(docs, id_column, text_column).select("doc_id", "node")
    named = stored(rows.join(parts, "node", "left").select("doc_id", "node", F.coalesce("component", "node").alias("class")))
    groups = named.groupBy("class").agg(F.min("doc_id").alias("group_id"), F.count(F.lit(1)).alias("group_size"))
    out = named.join(groups, "class")
    return out.select("doc_id", "node", "group_id", "group_size", F.col("doc_id").eqNullSafe(F.col("group_id")).alias("kept"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they came, less those of a class whose smallest id stays."""
    gone = classes(docs, id_column, text_column, threshold).filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"))
    node: Column = F.unhex(F.md5(text_of(text_column).cast("binary")))
    return docs.join(gone, docs[id_column].eqNullSafe(gone["__id"]) & (node == gone["__node"]), "left_anti")
