"""Mixing sources to target weights with soft memberships.

A softmax regression over hashed words, fitted on a bounded, hash-chosen sample of labelled rows
(``per_domain`` of each, one text an id, ``TRAIN_CHARS`` characters together), gives every document its domain posteriors. With a = tokens x posterior,
the nonnegative rates r of documents are fitted so that the expected tokens of each domain, the sum
of r x a, meet their targets: projected gradient on the least squares error, measured in the
metric of the domains' own Gram matrix, so that a step of 1 is safe. Each step is one pass over a
table of tokens and posteriors; only sums by domain reach the driver. What these steps leave is closed by Newton steps on
the documents whose rate stays above 0 (``settle``); targets that cannot be met give a warning, and the error left in every row. A document is then
taken floor(rate + u) times, u being a fraction drawn from a hash of its id and text.

Null and empty texts have no tokens, weigh nothing and keep the rate 1. Rows are scored one at a time;
rows equal in id and text get equal rates. Repeated labels of an id count once (the largest). With
fewer than two labelled domains every posterior is the labelled share, the rates stay alike.
Other columns are carried along by ``mix``.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.llm.common import labelled_texts, stored, text_of
from tierstar.llm.textarrays import Texts, blocks

#: Domains by label: low quality, else toxic, else clean.
DOMAINS = ("clean", "toxic", "low")
#: Labelled documents of each domain used in training, and the characters they may have together.
PER_DOMAIN, TRAIN_CHARS = 3000, 1 << 25
BUCKETS = 1 << 18
#: Share of all tokens by which a target may be missed without a warning.
REACHED = 1e-5


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different feature buckets of each text, where each text's begin, and its number of words."""
    starts, ends, first = texts.words()
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    bucket = (texts.word_hashes(starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    both = np.unique(text * BUCKETS + bucket)
    different = np.bincount(both // BUCKETS, minlength=len(n))
    # Length and variety as two more features, in buckets of their own.
    length = np.log2(n + 1).astype(np.int64)
    variety = 64 + (10 * different // np.maximum(1, n))
    extra = np.arange(len(n)) * BUCKETS
    both = np.sort(np.concatenate([both, extra + length, extra + variety]))
    begin = np.searchsorted(both, np.arange(len(n) + 1) * BUCKETS)
    return both % BUCKETS, begin, n


@dataclass
class Softmax:
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, bucket: np.ndarray, begin: np.ndarray) -> np.ndarray:
        z = np.add.reduceat(self.weights[bucket].astype(float), begin[:-1]) + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(documents: list[np.ndarray], domain: np.ndarray, weight: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.02, least: int = 5, seed: int = 1) -> Softmax:
    """Adam on the weighted cross entropy; features in fewer than ``least`` documents are left out."""
    k, rng = len(DOMAINS), np.random.default_rng(seed)
    share = np.array([weight[domain == d].sum() for d in range(k)]) / weight.sum()
    often = np.bincount(np.concatenate(documents), minlength=BUCKETS)
    used = np.flatnonzero(often >= least)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    rows = [(p := place[d])[p >= 0] for d in documents]
    w, bias = np.zeros((len(used) + 1, k)), np.log(share + 1e-9)
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    target = np.eye(k)[domain]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            sizes = np.array([len(rows[i]) for i in chosen])
            which = np.repeat(np.arange(len(chosen)), sizes)
            columns = np.concatenate([rows[i] for i in chosen])
            z = np.stack([np.bincount(which, w[columns, j], len(chosen)) for j in range(k)], 1) + bias
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - target[chosen]) * weight[chosen, None] / len(chosen)
            g = np.stack([np.bincount(columns, d[which, j], len(w)) for j in range(k)], 1) + 1e-5 * w
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    every = np.zeros((BUCKETS, k), np.float32)
    every[used] = w[: len(used)]
    return Softmax(every, bias)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = []
        for texts in blocks(batch):
            bucket, begin, _ = features(texts)
            out += [bucket[i:j].astype(np.int32) for i, j in zip(begin[:-1], begin[1:], strict=True)]
        yield pa.array(out, pa.list_(pa.int32()))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_domain: int = PER_DOMAIN) -> Softmax:
    known = labels.filter(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("__id")).agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    known = known.select("__id", F.when(F.col("q") == 0, 2).when(F.col("t") == 1, 1).otherwise(0).alias("__domain"))
    counts = {r["__domain"]: r["count"] for r in known.groupBy("__domain").count().collect()}
    share = np.array([counts.get(d, 0) for d in range(len(DOMAINS))], float)
    if (share > 0).sum() < 2:
        share = (share + 1) / (share + 1).sum()
        return Softmax(np.zeros((BUCKETS, len(DOMAINS)), np.float32), np.log(share))
    chosen = None
    for d in sorted(counts):
        some = known.filter(F.col("__domain") == d).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(per_domain)
        chosen = some if chosen is None else chosen.union(some)
    rows = labelled_texts(docs, chosen, "__domain", TRAIN_CHARS, id_column, text_column)
    # In one order whatever task ends first, so that the same table gives the same classifier.
    # As Arrow arrays, four bytes a bucket: rows of Python numbers would take ten times that of the driver's memory.
    table = rows.select("__id", "__domain", _buckets(F.col("__text")).alias("b")).toArrow().combine_chunks()
    got = sorted(range(len(table)), key=lambda i, ids=table["__id"].to_pylist(): str(ids[i]))
    domain = table["__domain"].to_numpy()[got].astype(int)
    if not len(got):
        return Softmax(np.zeros((BUCKETS, len(DOMAINS)), np.float32), np.log((share + 1) / (share + 1).sum()))
    seen = np.bincount(domain, minlength=len(DOMAINS))
    weight = (share / share.sum() / np.maximum(1, seen) * len(got))[domain]
    buckets = table["b"].combine_chunks()
    return fit([buckets[i].values.to_numpy() for i in got], domain, weight)


def memberships(docs: DataFrame, model: Softmax, text_column: str = "text") -> Column:
    """Tokens and domain posteriors of a text column, as one struct."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x domains, whatever the corpus
    fields = ["n_tokens", *[f"p_{d}" for d in DOMAINS]]

    @F.arrow_udf("n_tokens long, " + ", ".join(f"{f} double" for f in fields[1:]))
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n, p = [np.zeros(0, np.int64)], [np.zeros((0, len(DOMAINS)))]
            for texts in blocks(batch):
                bucket, begin, words = features(texts)
                n.append(words)
                p.append(shared.value.posteriors(bucket, begin))
            p = np.concatenate(p)
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(n), pa.int64()), *[pa.array(p[:, d]) for d in range(len(DOMAINS))]], fields)

    return judged(text_of(text_column))


def rate_of(pulls: list[np.ndarray], get: Callable[[str], Column] = F.col) -> Column:
    """The rate that a sequence of gradient steps leaves, over n_tokens and p_* as ``get`` finds them."""
    rate = F.lit(1.0)
    for pull in pulls:
        down = sum((get("n_tokens") * get(f"p_{d}") * F.lit(float(x)) for d, x in zip(DOMAINS, pull, strict=True)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - down)
    return rate


def targets(now: np.ndarray, weights: dict[str, float] | None = None, relative: dict[str, float] | None = None) -> np.ndarray:
    """Expected tokens wanted of each domain, ``now`` being the present ones.

    ``weights`` are the target shares of tokens by domain; ``relative`` instead scales the present
    share of the domains it names, the rest going to the others. The expected total stays as it is.
    """
    if relative is not None:
        share = now / now.sum() * np.array([relative.get(d, 0.0) for d in DOMAINS])
        free = np.array([d not in relative for d in DOMAINS])
        if now[free].any():
            share[free] = (1 - share.sum()) * now[free] / now[free].sum()
        else:  # Nothing else can take what they give up or give what they take.
            share = share / share.sum() if share.any() else now / now.sum()
    else:
        share = np.array([weights[d] for d in DOMAINS], float) / sum(weights.values())
    return share * now.sum()


def _summed(judged: DataFrame, pulls: list[np.ndarray], started: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
    """Of rows whose rate is above 0 after ``pulls``: half the sum of squared rates, the expected tokens by domain, and the Gram matrix.

    Rates begin at 1, or at the column __rate. They are worked out in tasks, in the arithmetic of ``rate_of``: as expressions of Spark the numbers of a
    step would be part of its generated code, so that the driver would compile other code for every step.
    """
    k = range(len(DOMAINS))
    names = ["r", *[f"s{i}" for i in k], *[f"g{i}{j}" for i in k for j in k]]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, *p = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(1 + len(DOMAINS)))
            parts = np.stack([n * x for x in p])
            rate = batch.column(1 + len(DOMAINS)).to_numpy(zero_copy_only=False) if started else np.ones(len(n))
            for pull in pulls:
                down = np.zeros(len(n))
                for part, x in zip(parts, pull, strict=True):
                    down = down + part * x
                rate = np.maximum(0.0, rate - down)
            parts, rate = parts[:, rate > 0], rate[rate > 0]
            out = [(rate * rate).sum() / 2, *(rate * parts).sum(1), *[(parts[i] * parts[j]).sum() for i in k for j in k]]
            yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in out], names)

    columns = ["n_tokens", *[f"p_{d}" for d in DOMAINS], *["__rate"] * started]
    by_batch = judged.select(*columns).mapInArrow(summed, ", ".join(f"{c} double" for c in names))
    got = by_batch.agg(*[F.sum(c).alias(c) for c in names]).first()
    sums = np.array([got[c] or 0.0 for c in names])
    return float(sums[0]), sums[1 : 1 + len(DOMAINS)], sums[1 + len(DOMAINS) :].reshape(len(DOMAINS), -1)


def fit_rates(judged: DataFrame, weights: dict[str, float] | None = None, relative: dict[str, float] | None = None, steps: int = 40, tolerance: float = 1e-7) -> list[np.ndarray]:
    """At most ``steps`` plain gradient steps towards the targets, a number for each domain; ``settle`` does the rest.

    The steps end when the error, measured in the metric, no longer shrinks: what is left then cannot be met by any rates.
    """
    _, now, gram = _summed(judged, [])
    if not now.sum():
        return []
    target = targets(now, weights, relative)
    # A domain without tokens cannot be raised: the pseudo-inverse leaves it alone.
    metric = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    pulls: list[np.ndarray] = []
    last, reached = np.inf, now
    for _ in range(steps):
        error = reached - target
        pull = metric @ error
        if np.abs(error).max() <= tolerance * now.sum() or error @ pull > 0.999 * last:
            break
        last = error @ pull
        if last <= 0:
            break
        pulls.append(pull)
        reached = _summed(judged, pulls)[1]
    return pulls


def settle(judged: DataFrame, pulls: list[np.ndarray], target: np.ndarray, passes: int = 60, tolerance: float = 1e-7) -> tuple[list[np.ndarray], float]:
    """One more pull, after which the expected tokens meet ``target``, and the largest error left, as a share of all tokens.

    Of all rates that meet the targets these are the nearest to the ones that ``pulls`` leave: max(0, rate - a x pull), with the
    pull found by Newton steps on the dual, in the Gram matrix of the documents whose rate stays above 0. Targets are first moved to the nearest
    ones within what the posteriors span (one point if they are all alike); a small penalty keeps the pull finite where no
    nonnegative rates meet these, and the steps end when the error has not shrunk by a hundredth for some passes. The error returned is that of the targets as given.
    """
    started = stored(judged.select("n_tokens", *[f"p_{d}" for d in DOMAINS], rate_of(pulls).alias("__rate")))

    def reachable(gram: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        return gram @ np.linalg.pinv(gram, rcond=1e-9, hermitian=True) @ wanted

    def look(pull: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        half, sums, gram = _summed(started, [pull], started=True)
        return half + pull @ goal, sums - goal, gram

    # The dual, value(pull) = sum of rate^2 / 2 + pull x target, is convex with the gradient -error.
    pull = np.zeros(len(DOMAINS))
    goal = reachable(_summed(judged, [])[2], target)
    value, error, gram = look(pull)
    total = target.sum()
    least, idle = np.abs(error).max(), 0
    penalty = 1e-9 * np.trace(gram) * np.eye(len(DOMAINS))
    for _ in range(passes):
        slope = penalty @ pull - error
        if np.abs(error).max() <= tolerance * total or not np.abs(slope).max() or idle >= 5:
            break
        move = -np.linalg.solve(gram + penalty + 1e-12 * np.trace(gram) * np.eye(len(DOMAINS)), slope)
        size, here = 1.0, value + pull @ penalty @ pull / 2
        while True:
            ahead = pull + size * move
            value, next_error, next_gram = look(ahead)
            if value + ahead @ penalty @ ahead / 2 <= here + 1e-4 * size * (slope @ move) or size < 1e-4:
                break
            size /= 4
        stuck = np.abs(ahead - pull).max() <= 1e-12 * np.abs(ahead).max()
        pull, error, gram = ahead, next_error, next_gram
        if stuck:
            break
        least, idle = (np.abs(error).max(), 0) if np.abs(error).max() < 0.99 * least else (least, idle + 1)
    return [*pulls, pull], float(np.abs(error + goal - target).max() / total)


def copies_of(rate: Column, id_column: str, text_column: str) -> Column:
    """floor(rate + u), u in [0, 1) from a hash of id and text."""
    u = (F.xxhash64(F.col(id_column).cast("string"), text_of(text_column)).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))
    return F.floor(rate + u).cast("long")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, relative: dict[str, float] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All documents with all their columns and a struct ``mix``: n_tokens, p_* of each domain, rate, copies, missed.

    ``missed`` is the same in all rows: the largest error of a domain's expected tokens against its target, as a share of all tokens.
    """
    names = docs.columns
    judged = docs.select(*[F.col(c) for c in names], memberships(docs, train(docs, labels, id_column, text_column), text_column).alias("__judged"))
    table = stored(judged.select("__judged.*"))
    pulls, left = fit_rates(table, weights, relative), 0.0
    now = _summed(table, [])[1]
    if now.any():
        pulls, left = settle(table, pulls, targets(now, weights, relative))
        if left > REACHED:
            warnings.warn(f"mixing: targets are missed by up to {left:.6f} of all tokens", stacklevel=2)
    rate = rate_of(pulls, lambda name: F.col("__judged")[name])
    out = judged.withColumn("__rate", rate).withColumn("__copies", copies_of(F.col("__rate"), id_column, text_column))
    fields = [F.col("__judged")[f].alias(f) for f in ("n_tokens", *[f"p_{d}" for d in DOMAINS])]
    return out.select(*[F.col(c) for c in names], F.struct(*fields, F.col("__rate").alias("rate"), F.col("__copies").alias("copies"), F.lit(left).alias("missed")).alias("mix"))
