"""A gated recurrent language model in numpy, with a class-factored softmax.

Tokens are words (runs of other characters than white space, ASCII letters lower-cased) and one
end per document. A word's class is its own for the most frequent words, else it follows from the
spelling. P(token) = P(class | state) * P(token | class): the gated recurrent network sees the
classes so far and predicts the next one; within a class the smoothed counts of all training
tokens decide. All counts come from every training document. The network is fitted by truncated
backpropagation on a bounded, hash-chosen sample of training documents (``sample_docs``,
``sample_tokens`` of each); the state is carried from window to window, in training and in scoring,
so a score is the log likelihood of the complete document.

Counts of the ``hot_words`` most frequent words are sent to all tasks (a fixed number whatever the
corpus); the other words of a document are looked up by a shuffle, so no count is left out.

Null and empty texts are one end token. Rows are scored one at a time and numbered, so repeated rows or
ids get equal scores; other columns are ignored. Without training rows every count is zero and
the network stays as drawn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstar.llm.common import fold_of, stored, text_of
from tierstar.llm.textarrays import Texts, blocks

HOT_WORDS, OWN_CLASS = 1 << 19, 35
HIDDEN, WINDOW = 32, 32
#: Documents are learned from in ROUNDS parts, each in groups of about GROUP_TOKENS, in which ROWS run side by side.
ROUNDS, GROUP_TOKENS, ROWS = 4, 1 << 20, 128
RATE = 0.01
#: Corpora of fewer training tokens are gone over again, up to MOST_PASSES times.
LEAST_TOKENS, MOST_PASSES = 1 << 21, 4
SPELLED = 12 + 5 * 4
N_CLASSES = 1 + OWN_CLASS + SPELLED
#: Documents that are scored side by side, and rows of the output layer that are computed at a time.
SIDE_BY_SIDE, OUTPUT_ROWS = 512, 2_048


def spelling(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class a word's spelling gives it: its last byte and, if it is all ASCII, its length, else its first other character."""
    if not len(starts):
        return np.zeros(0, np.int64)
    data = texts.data
    last = data[ends - 1]
    letter = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128)
    end = np.where(letter, 0, np.where(last == 46, 1, np.where(last == 44, 2, 3)))
    size = np.digitize(ends - starts, [5, 9])
    other = np.flatnonzero(data >= 0xC0)
    at = np.searchsorted(other, starts)
    at = np.where(at < len(other), other[np.minimum(at, max(0, len(other) - 1))] if len(other) else len(data), len(data))
    foreign = at < ends
    second = data[np.minimum(at + 1, len(data) - 1)]
    return 1 + OWN_CLASS + np.where(foreign, 12 + (second % 5).astype(np.int64) * 4 + end, size * 4 + end)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, classes, counts = [], [], []
        for texts in blocks(batch.column(0)):
            starts, ends, _ = texts.words()
            h, first, n = np.unique(texts.word_hashes(starts, ends), return_index=True, return_counts=True)
            hashes.append(h)
            classes.append(spelling(texts, starts[first], ends[first]))
            counts.append(n)
        if not hashes:
            continue
        every = np.concatenate(hashes)
        h, first, back = np.unique(every, return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate(counts), len(h)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.concatenate(classes)[first].astype(np.int32)), pa.array(n)], ["hash", "class", "n"])


@dataclass
class Network:
    """A gated recurrent layer over classes. E: input weights by class, R: recurrent, O and o: output."""

    E: np.ndarray
    R: np.ndarray
    O: np.ndarray  # noqa: E741
    o: np.ndarray

    @staticmethod
    def drawn(share: np.ndarray, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.3 / np.sqrt(HIDDEN) * 3).astype(np.float32)
        return Network(draw(N_CLASSES, 3 * HIDDEN), draw(HIDDEN, 3 * HIDDEN), draw(HIDDEN, N_CLASSES), np.log(share + 1e-6).astype(np.float32))

    def step(self, x: np.ndarray, h: np.ndarray) -> np.ndarray:
        a, b = self.E[x], h @ self.R
        zr = a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = r * b[:, 2 * HIDDEN :]
        n += a[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        out = h - n
        out *= z
        out += n
        return out

    def log_softmax(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The log probability of class y[i] in state h[i]."""
        d = h @ self.O
        d += self.o
        d -= d.max(1, keepdims=True)
        hit = d[np.arange(len(y)), y]
        np.exp(d, out=d)
        return hit - np.log(d.sum(1))

    def window_gradient(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], float]:
        """State after a window of (steps, rows) classes, gradients of the mean log loss of the live cells, and its sum."""
        steps, rows, kind = *x.shape, self.E.dtype
        states, gates, new, given_back = (np.empty((steps + i, rows, k * HIDDEN), kind) for i, k in ((1, 1), (0, 2), (0, 1), (0, 3)))
        # The gates' weights with the other sign, which their exponential takes.
        sign = np.repeat(np.array([-1, 1], kind), (2 * HIDDEN, HIDDEN))
        states[0], given, recurrent = h, (self.E * sign)[x], self.R * sign
        for t in range(steps):
            b = np.matmul(states[t], recurrent, out=given_back[t])
            zr, n, out = gates[t], new[t], states[t + 1]
            np.add(given[t, :, : 2 * HIDDEN], b[:, : 2 * HIDDEN], out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[:, HIDDEN:], b[:, 2 * HIDDEN :], out=n)
            n += given[t, :, 2 * HIDDEN :]
            np.tanh(n, out=n)
            np.subtract(states[t], n, out=out)
            out *= zr[:, :HIDDEN]
            out += n
        back = given_back[:, :, 2 * HIDDEN :]
        flat, target, on = states[1:].reshape(-1, HIDDEN), y.ravel(), live.ravel()
        cells = np.arange(len(target))
        d = flat @ self.O
        d += self.o
        d -= d.max(1, keepdims=True)
        hit = d[cells, target]
        np.exp(d, out=d)
        size = d @ np.ones(N_CLASSES, kind)
        loss = (np.log(size) - hit)[on].sum()
        weight = (on / max(1, on.sum())).astype(kind)
        d *= (weight / size)[:, None]
        d[cells, target] -= weight
        dh_out = (d @ self.O.T).reshape(steps, rows, HIDDEN)
        z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
        # (1 - z) * (1 - new * new), (states[:-1] - new) * z * (1 - z), back * r * (1 - r)
        by_n, by_z, by_r, rest = new * new, states[:-1] - new, back * r, 1 - z
        np.subtract(1, by_n, out=by_n)
        by_n *= rest
        by_z *= z
        by_z *= rest
        by_r *= np.subtract(1, r, out=rest)
        dh = np.zeros_like(h)
        db = np.empty((steps, rows, 3 * HIDDEN), kind)
        dn = np.empty_like(new)
        to_before = np.ascontiguousarray(self.R.T)
        for t in range(steps - 1, -1, -1):
            dh += dh_out[t]
            one, own = db[t], np.multiply(dh, by_n[t], out=dn[t])
            np.multiply(dh, by_z[t], out=one[:, :HIDDEN])
            np.multiply(own, by_r[t], out=one[:, HIDDEN : 2 * HIDDEN])
            np.multiply(own, r[t], out=one[:, 2 * HIDDEN :])
            dh *= z[t]
            dh += one @ to_before
        h = states[-1]
        g = {"O": flat.T @ d, "o": np.ones(len(d), kind) @ d, "E": np.zeros_like(self.E), "R": states[:-1].reshape(-1, HIDDEN).T @ db.reshape(-1, 3 * HIDDEN)}
        # What is given differs from what comes back in the new state only.
        da = db
        da[:, :, 2 * HIDDEN :] = dn
        order = np.argsort(x.astype(np.uint8), axis=None, kind="stable")
        n = np.bincount(x.ravel(), minlength=N_CLASSES)
        g["E"][n > 0] = np.add.reduceat(da.reshape(-1, 3 * HIDDEN)[order], (np.cumsum(n) - n)[n > 0])
        return h, g, loss


NAMES = ("E", "R", "O", "o")


@dataclass
class Learner:
    """A network in the making, with the moments of its gradients (Adam) and the steps taken."""

    network: Network
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    steps: float = 0.0

    @staticmethod
    def begin(share: np.ndarray) -> Learner:
        net = Network.drawn(share)
        return Learner(net, *({k: np.zeros_like(getattr(net, k)) for k in NAMES} for _ in range(2)))

    def flat(self) -> np.ndarray:
        """All its numbers in one row, so that learners can be averaged."""
        parts = [[getattr(self.network, k) for k in NAMES], self.first.values(), self.second.values(), [np.array(self.steps)]]
        return np.concatenate([np.ravel(a).astype(float) for part in parts for a in part])

    def filled(self, numbers: np.ndarray) -> Learner:
        """A learner of the same shapes made of such a row."""
        shapes = [getattr(self.network, k).shape for k in NAMES] * 3
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])
        arrays = [a.reshape(s).astype(np.float32) for a, s in zip(np.split(numbers[:-1], cuts[:-1]), shapes, strict=True)]
        n = len(NAMES)
        return Learner(Network(*arrays[:n]), dict(zip(NAMES, arrays[n : 2 * n])), dict(zip(NAMES, arrays[2 * n :])), float(numbers[-1]))

    def move(self, g: dict[str, np.ndarray], rate: float) -> None:
        size = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        self.steps += 1
        for k in NAMES:
            a, m, v = g[k] * min(1.0, 1.0 / (size + 1e-9)), self.first[k], self.second[k]
            m += np.float32(0.1) * (a - m)
            v += np.float32(0.001) * (a * a - v)
            getattr(self.network, k)[...] -= (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)).astype(np.float32)

    def learn(self, documents: list[np.ndarray], done: float = 0.0, share: float = 1.0, rows: int = ROWS) -> None:
        """One pass over whole documents, each with its end: windows of WINDOW tokens, documents of like length side by side.

        ``done`` of all learning lies behind and these documents are ``share`` of it; the rate falls by nine tenths over the whole.
        """
        # Equal lengths in the order of their tokens: the same documents give the same network in whatever order they come.
        documents = sorted((d for d in documents if len(d)), key=lambda d: (len(d), d.tobytes()))
        groups = [documents[i : i + rows] for i in range(0, len(documents), rows)]
        total, seen = max(1, sum(len(d) for d in documents)), 0
        for k in np.random.default_rng(2).permutation(len(groups)):
            group = groups[k][::-1]
            sizes = np.array([len(d) for d in group])
            flat, begin = np.concatenate(group), np.cumsum(sizes) - sizes
            h = np.zeros((len(group), HIDDEN), np.float32)
            for at in range(0, sizes[0], WINDOW):
                n = int(np.searchsorted(-sizes, -at, "left"))  # those longer than at
                steps = np.arange(at, min(at + WINDOW, int(sizes[0])))[:, None]
                live = steps < sizes[:n]
                y = flat[np.minimum(begin[:n] + steps, len(flat) - 1)].astype(np.int64) * live
                x = np.concatenate([flat[begin[:n] + at - 1][None].astype(np.int64) * (at > 0), y[:-1]])
                h, g, _ = self.network.window_gradient(x, y, live, h[:n])
                self.move(g, RATE * (1 - 0.9 * (done + share * seen / total)))
                seen += int(live.sum())


def fit(share: np.ndarray, sequences: DataFrame, rounds: int = ROUNDS, passes: int = 1) -> Network:
    """The network fitted on all rows of ``sequences`` (stored: round, group, classes as bytes), each learned from in every pass."""
    learner = Learner.begin(share)
    for k in range(passes * rounds):
        learner = learner.filled(averaged(learner, sequences.filter(F.col("round") == k % rounds), k / (passes * rounds), 1 / (passes * rounds)))
    return learner.network


def averaged(learner: Learner, sequences: DataFrame, done: float, share: float) -> np.ndarray:
    """What ``learner`` becomes in each group, averaged over groups by their tokens. One number a place reaches the driver, however many groups there are."""
    start = learner.flat()

    def learned(table: pa.Table) -> pa.Table:
        own = learner.filled(start)
        documents = [np.frombuffer(c.as_buffer(), np.uint8) for c in table["classes"].combine_chunks()]
        own.learn(documents, done, share)
        n = float(sum(len(d) for d in documents))
        return pa.table({"place": pa.array(np.arange(len(start), dtype=np.int32)), "weighted": pa.array(own.flat() * n), "tokens": pa.array(np.full(len(start), n))})

    each = sequences.groupBy("group").applyInArrow(learned, "place int, weighted double, tokens double")
    got = each.groupBy("place").agg((F.sum("weighted") / F.sum("tokens")).alias("x")).toArrow()
    out = start.copy()  # a round without documents leaves it as it is
    out[got["place"].to_numpy()] = got["x"].to_numpy()
    return out


#: Leading bits of a hash by which its place among the hot words is looked up.
LEADING = 19


def begins(hashes: np.ndarray) -> np.ndarray:
    """Where, in hashes in order, those of each LEADING bits begin (and the end)."""
    return np.searchsorted(np.asarray(hashes, np.uint64) >> np.uint64(64 - LEADING), np.arange((1 << LEADING) + 1, dtype=np.uint64)).astype(np.int32)


def places(hashes: np.ndarray, begin: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``hashes`` (different ones, in order) hold each of ``h``, and whether they do; any place where not.

    Hashes of the same leading bits are few, so a word is found in one or two looks instead of a search through all.
    """
    lead = (h >> np.uint64(64 - LEADING)).astype(np.int64)
    place, end = begin[lead], begin[lead + 1]
    there = np.zeros(len(h), bool)
    left = np.flatnonzero(place < end)
    while len(left):
        hit = hashes[place[left]] == h[left]
        there[left[hit]] = True
        left = left[~hit]
        place[left] += 1
        left = left[place[left] < end[left]]
    return np.minimum(place, len(hashes) - 1), there


@dataclass
class Model:
    """The network, hot words (hashes in order, their classes and log10(count + 0.5)), and log10 sizes of classes and corpus."""

    network: Network
    hashes: np.ndarray
    classes: np.ndarray
    log_counts: np.ndarray
    class_sizes: np.ndarray
    corpus_size: float
    train_tokens: int
    train_docs: int

    def __post_init__(self) -> None:
        self.begins = begins(self.hashes)

    def look_up(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Classes and hashes of all words, places in the hot table, which are there, and the first word of each text."""
        starts, ends, first = texts.words()
        h = texts.word_hashes(starts, ends)
        if not len(self.hashes):
            return spelling(texts, starts, ends), h, np.zeros(len(h), int), np.zeros(len(h), bool), first
        place, there = places(self.hashes, self.begins, h)
        return np.where(there, self.classes[place], spelling(texts, starts, ends)), h, place, there, first

    def class_log10(self, documents: list[np.ndarray]) -> np.ndarray:
        """log10 P of the class sequences, each with its end token."""
        order = np.argsort([-len(d) for d in documents], kind="stable")
        back = np.empty(len(order))
        # As many side by side as the processor's cache holds, of like length.
        for i in range(0, len(order), SIDE_BY_SIDE):
            own = order[i : i + SIDE_BY_SIDE]
            back[own] = self._side_by_side([documents[k] for k in own]) / np.log(10)
        return back

    def _side_by_side(self, documents: list[np.ndarray]) -> np.ndarray:
        """log P of class sequences, from long to short."""
        sizes = np.array([len(d) for d in documents])
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        flat = np.concatenate(documents)
        out = np.zeros(len(documents))
        h = np.zeros((len(documents), HIDDEN), np.float32)
        kept, targets, live, held = [], [], [], 0
        for t in range(sizes[0]):
            n = int(np.searchsorted(-sizes, -t, "left"))  # those longer than t
            x = flat[begin[:n] + t - 1] if t else np.zeros(n, np.int64)
            h = self.network.step(x, h[:n])
            kept.append(h)
            targets.append(flat[begin[:n] + t])
            live.append(n)
            held += n
            if held >= OUTPUT_ROWS or t == sizes[0] - 1:
                p = self.network.log_softmax(np.concatenate(kept), np.concatenate(targets)).astype(float)
                out[: live[0]] += np.bincount(np.concatenate([np.arange(k) for k in live]), p, live[0])
                kept, targets, live, held = [], [], [], 0
        return out


def corpus_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Every word of a corpus: hash, class of its spelling, and count."""
    rows = docs.select(text_of(text_column).alias("text")).mapInArrow(_count_words, "hash long, class int, n long")
    return rows.groupBy("hash").agg(F.min("class").alias("class"), F.sum("n").alias("n"))


def train(training: DataFrame, counts: DataFrame, id_column: str = "doc_id", text_column: str = "text", hot_words: int = HOT_WORDS, rounds: int = ROUNDS, group_tokens: int = GROUP_TOKENS) -> Model:
    """The model of ``training`` documents, ``counts`` being their stored corpus_counts."""
    n_docs = training.count()
    hot = counts.orderBy(F.desc("n"), "hash").limit(hot_words).toArrow()
    own = {int(h): 1 + i for i, h in enumerate(hot["hash"].to_pylist()[:OWN_CLASS])}
    by_class = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n, v = np.zeros(N_CLASSES), np.zeros(N_CLASSES)
    for r in by_class:
        n[r["class"]], v[r["class"]] = r["n"], r["v"]
    classes, hot_counts = hot["class"].to_numpy().astype(np.int64).copy(), hot["n"].to_numpy().astype(float)
    for i in range(len(own)):
        n[classes[i]] -= hot_counts[i]
        v[classes[i]] -= 1
        classes[i] = 1 + i
        n[1 + i], v[1 + i] = hot_counts[i], 1
    total, distinct = int(n.sum()) + n_docs, int(v.sum()) + (n_docs > 0)
    n[0] = n_docs
    hashes = hot["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    sizes = np.log10(n + 0.5 * (v + 1))
    sizes[0] = 0.0  # the end is alone in its class
    share = (n + 0.5) / (n + 0.5).sum()
    model = Model(Network.drawn(share), hashes[order], classes[order], np.log10(hot_counts[order] + 0.5), sizes, float(np.log10(total + 0.5 * (distinct + 1))), total, n_docs)
    if not n_docs:
        return model
    shared = training.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("binary")
    def class_sequence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for texts in blocks(batch):
                cls, _, _, _, first = shared.value.look_up(texts)
                out += [cls[i:j].astype(np.uint8).tobytes() + b"\0" for i, j in zip(first[:-1], first[1:], strict=True)]
            yield pa.array(out, pa.binary())

    # Dealt by row, so that copies of a document do not meet in one group.
    row = F.xxhash64(F.col(id_column).cast("string"), F.monotonically_increasing_id())
    groups = max(1, round(total / rounds / group_tokens))
    passes = min(MOST_PASSES, -(-LEAST_TOKENS // total))
    dealt = training.select(class_sequence(text_of(text_column)).alias("classes"), F.pmod(row, F.lit(rounds * groups)).alias("at"))
    model.network = fit(share, stored(dealt.select((F.col("at") % rounds).alias("round"), F.floor(F.col("at") / rounds).alias("group"), "classes")), rounds, passes)
    return model


SCORED = "n_words long, n_hot long, log_counts double, class_score double, rare array<long>"


def score(docs: DataFrame, model: Model, counts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, base_score, score, all log10."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(SCORED)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in batches:
            words, hot, logs, rest, rare, sequences = [], [], [], [], [], []
            for texts in blocks(batch):
                cls, h, place, there, first = m.look_up(texts)
                n = np.diff(first)
                text = np.repeat(np.arange(len(n)), n)
                words.append(n)
                hot.append(np.bincount(text, there, len(n)).astype(np.int64))
                known = m.log_counts[place] * there if len(m.hashes) else np.zeros(len(h))
                logs.append(np.bincount(text, known, len(n)))
                rest.append(np.bincount(text, m.class_sizes[cls], len(n)))
                away = ~there
                cut = np.searchsorted(text[away], np.arange(len(n) + 1))
                rare += [(h[away].view(np.int64))[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
                cls = cls.astype(np.uint8)  # one byte a token: all documents of a batch wait for the network
                sequences += [np.append(cls[i:j], np.uint8(0)) for i, j in zip(first[:-1], first[1:], strict=True)]
            if not sequences:
                yield pa.array([], pa.struct([("n_words", pa.int64()), ("n_hot", pa.int64()), ("log_counts", pa.float64()), ("class_score", pa.float64()), ("rare", pa.list_(pa.int64()))]))
                continue
            yield pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate(words), pa.int64()),
                    pa.array(np.concatenate(hot), pa.int64()),
                    pa.array(np.concatenate(logs)),
                    pa.array(m.class_log10(sequences) - np.concatenate(rest)),
                    pa.array(rare, pa.list_(pa.int64())),
                ],
                ["n_words", "n_hot", "log_counts", "class_score", "rare"],
            )

    judged = docs.select(F.col(id_column).alias("doc_id"), scored(text_of(text_column)).alias("s"), F.monotonically_increasing_id().alias("row"))
    judged = stored(judged.select("doc_id", "row", "s.*"))
    away = judged.select("row", F.explode("rare").alias("hash")).join(counts.select("hash", "n"), "hash", "left")
    n = F.coalesce("n", F.lit(0))
    rare = away.groupBy("row").agg(F.sum((n > 0).cast("long")).alias("n_rare"), F.sum(F.log10(n + 0.5)).alias("log_rare"))
    both = judged.join(rare, "row", "left")
    log_words = F.col("log_counts") + F.coalesce("log_rare", F.lit(0.0))
    log_end = F.lit(float(np.log10(model.train_docs + 0.5)))
    n_tokens = F.col("n_words") + 1
    return both.select(
        "doc_id",
        n_tokens.alias("n_tokens"),
        (F.col("n_hot") + F.coalesce("n_rare", F.lit(0)) + F.lit(int(model.train_docs > 0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (log_words + log_end - n_tokens * F.lit(model.corpus_size)).alias("base_score"),
        (F.col("class_score") + log_words).alias("score"),
    )


def score_held_out(docs: DataFrame, folds: int = 5, held_out: int = 1) -> DataFrame:
    """All documents scored by the model of those outside one fold: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    training = docs.filter(fold_of("doc_id", folds) != held_out)
    counts = stored(corpus_counts(training))
    out = score(docs, train(training, counts), counts)
    return out.select("doc_id", (fold_of("doc_id", folds) == held_out).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
