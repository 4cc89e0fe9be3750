"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

Every passage (100 consecutive words) is described by shares of byte classes, word shapes and
hashed words, encoded by a dense layer, and weighted by gated attention; the weighted sum gives the
logit of the document. Only document labels are known in training. The network is fitted in numpy
on a bounded, hash-chosen sample of labelled rows (``per_class`` of each label); all rows are scored,
passage by passage, over their whole text.

Null and empty texts are one passage without words. Rows are scored one at a time, so repeated rows
get equal scores and ids or other columns play no part. Repeated labels of an id count once (the
largest). Without labels every score is 0.5; with labels of one class only it is their smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.llm.common import fold_of, labelled_texts, text_of
from tierstar.llm.textarrays import Texts, blocks

PASSAGE_WORDS = 100
#: Labelled documents of each class used in training, and the characters they may have together; all passages of these are used.
PER_CLASS, TRAIN_CHARS = 3000, 1 << 26
HIDDEN, GATE, HASHED = 24, 16, 32

#: Byte classes: lower case, upper case, digits, space, line ends, each common mark, other marks, non-ASCII, control.
_MARKS = ".,!?|#*%$&@-_:;/\\\"'()[]{}<>=+~^`"
_CLASSES = np.full(256, 6 + len(_MARKS), np.int64)
_CLASSES[97:123], _CLASSES[65:91], _CLASSES[48:58], _CLASSES[32], _CLASSES[128:] = 0, 1, 2, 3, 5
_CLASSES[[9, 10, 11, 12, 13]] = 4
for _i, _c in enumerate(_MARKS):
    _CLASSES[ord(_c)] = 6 + _i
N_CLASSES = 7 + len(_MARKS)
N_FEATURES = N_CLASSES + 5 + HASHED


def passages(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of the first passage of each text."""
    starts, ends, first = texts.words()
    n_words = np.diff(first)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    begin = np.concatenate([[0], np.cumsum(n_passages)])
    total = begin[-1]
    out = np.zeros((total, N_FEATURES), np.float32)
    if len(starts):
        text = np.repeat(np.arange(len(texts)), n_words)
        passage = begin[text] + (np.arange(len(starts)) - first[text]) // PASSAGE_WORDS
        size = np.bincount(passage, minlength=total)
        # The bytes of a passage reach to the next one; those of a text begin at its first passage.
        heads = np.flatnonzero(np.diff(passage, prepend=-1))
        begins = np.zeros(total, np.int64)
        begins[passage[heads]] = starts[heads]
        begins[begin[:-1]] = texts.offsets[:-1]
        owner = np.repeat(np.arange(total), np.diff(begins, append=len(texts.data)))
        counts = np.bincount(owner * N_CLASSES + _CLASSES[texts.data], minlength=total * N_CLASSES).reshape(total, N_CLASSES)
        bytes_in = np.maximum(1, counts.sum(1, keepdims=True))
        out[:, :N_CLASSES] = counts / bytes_in
        hashes = texts.word_hashes(starts, ends)
        length = np.minimum(ends - starts, 64).astype(float)
        same = np.zeros(len(starts), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
        per = np.maximum(1, size)
        mean = np.bincount(passage, length, total) / per
        out[:, N_CLASSES] = np.bincount(passage, same, total) / per
        out[:, N_CLASSES + 1] = mean / 10
        out[:, N_CLASSES + 2] = np.sqrt(np.maximum(0, np.bincount(passage, length**2, total) / per - mean**2)) / 10
        out[:, N_CLASSES + 3] = size / PASSAGE_WORDS
        out[:, N_CLASSES + 4] = np.bincount(passage, length == 1, total) / per
        bucket = (hashes % np.uint64(HASHED)).astype(np.int64)
        out[:, N_CLASSES + 5 :] = np.bincount(passage * HASHED + bucket, minlength=total * HASHED).reshape(total, HASHED) / per[:, None]
    return out, begin


@dataclass
class Attention:
    """Weights of the network; features are standardised by ``mean`` and ``scale``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, tuple]:
        p = self.weights
        h = np.tanh(x @ p["W"] + p["bW"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        which = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        e = np.exp(e - np.maximum.reduceat(e, begin[:-1])[which])
        a = e / np.add.reduceat(e, begin[:-1])[which]
        z = np.add.reduceat(a[:, None] * h, begin[:-1])
        return z @ p["c"] + p["b"], (h, t, s, a, z, which)

    def score(self, features: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(begin) - 1, self.constant)
        logit, _ = self.forward(((features - self.mean) / self.scale).astype(np.float32), begin)
        return 1 / (1 + np.exp(-np.clip(logit.astype(float), -40, 40)))


def fit(documents: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = 25, batch: int = 128, rate: float = 4e-3, decay: float = 1e-4, seed: int = 1) -> Attention:
    """Adam on the weighted log loss of document labels."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(documents)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    documents = [((d - mean) / scale).astype(np.float32) for d in documents]
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"W": draw(N_FEATURES, HIDDEN), "bW": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE), "c": draw(HIDDEN), "b": np.zeros(1, np.float32)}
    model = Attention(mean, scale, p)
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(documents))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            begin = np.concatenate([[0], np.cumsum([len(documents[i]) for i in chosen])])
            x = np.concatenate([documents[i] for i in chosen])
            logit, (h, t, s, a, z, which) = model.forward(x, begin)
            d = ((1 / (1 + np.exp(-logit)) - labels[chosen]) * weights[chosen] / len(chosen)).astype(np.float32)
            dz = d[:, None] * p["c"]
            da = (dz[which] * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, begin[:-1])[which])
            dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
            dh = a[:, None] * dz[which] + dt @ p["V"].T + ds @ p["U"].T
            dx = dh * (1 - h * h)
            grad = {"W": x.T @ dx, "bW": dx.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ d, "b": d.sum(keepdims=True)}
            step += 1
            for k, g in grad.items():
                g = g + decay * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


@F.arrow_udf(T.BinaryType())
def _features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for texts in blocks(batch):
            features, begin = passages(texts)
            out += [features[i:j].tobytes() for i, j in zip(begin[:-1], begin[1:], strict=True)]
        yield pa.array(out, pa.binary())


def train(docs: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text", folds: int = 4, held_out: int = 2, per_class: int = PER_CLASS) -> Attention:
    """The network fitted on labelled documents whose fold is not ``held_out``."""
    known = labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc_id")).agg(F.max(label_column).cast("int").alias("label"))
    known = known.filter(fold_of("doc_id", folds) != held_out)
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        of_class = known.filter(F.col("label") == value).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(per_class)
        chosen = of_class if chosen is None else chosen.union(of_class)
    rows = labelled_texts(docs, chosen.select(F.col("doc_id").alias("__id"), "label"), "label", TRAIN_CHARS, id_column, text_column)
    # In one order whatever task ends first, so that the same table gives the same network.
    got = sorted(rows.select("__id", "label", _features(F.col("__text")).alias("features")).collect(), key=lambda r: str(r["__id"]))
    y = np.array([r["label"] for r in got], np.float32)
    if len(set(y.tolist())) < 2:
        none = np.zeros(N_FEATURES, np.float32)
        return Attention(none, none + 1, {}, (float(y.sum()) + 1) / (len(y) + 2))
    # Each class weighs as much as it has labelled documents, however many of them are in the sample.
    weight = {v: shares[v] / sum(shares.values()) / np.mean(y == v) for v in (0, 1)}
    documents = [np.frombuffer(r["features"], np.float32).reshape(-1, N_FEATURES) for r in got]
    return fit(documents, y, np.array([weight[int(v)] for v in y], np.float32))


def score(model: Attention, text_column: str = "text") -> Column:
    """The score of a text column under a fitted network."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.score(*passages(texts)) for texts in blocks(batch)]
            yield pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())

    return scored(text_of(text_column))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = docs.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), score(train(docs, labels)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
