import numpy as np
import pytest
from pyspark.sql import functions as F

from tierstar.llm import mixing

FOLDER = "/root/testdata/sf0.1"
TARGETS = {"clean": 0.9, "toxic": 0.05, "low": 0.05}


@pytest.fixture(scope="module")
def mixed(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    return mixing.mix(docs, labels, TARGETS).select("doc_id", "mix.*").toPandas()


def test_expected_tokens_meet_targets(mixed):
    total = mixed.n_tokens.sum()
    for d, share in TARGETS.items():
        assert (mixed.rate * mixed.n_tokens * mixed[f"p_{d}"]).sum() / total == pytest.approx(share, abs=1e-5)
    assert (mixed.rate >= 0).all() and np.allclose(mixed[[f"p_{d}" for d in mixing.DOMAINS]].sum(axis=1), 1)
    assert (mixed.copies * mixed.n_tokens).sum() == pytest.approx(total, rel=0.02)


def test_posteriors_fit_labels(spark, mixed):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    both = mixed.merge(labels, on="doc_id")
    truth = np.where(both.quality == 0, "low", np.where(both.toxic == 1, "toxic", "clean"))
    guess = both[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy().argmax(1)
    assert (np.array(mixing.DOMAINS)[guess] == truth).mean() > 0.9


def test_rates_like_plain_projected_gradient(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([2, 1, 1], 60)
    n = rng.integers(1, 500, 60)
    judged = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(60)], "i int, n_tokens long, p_clean double, p_toxic double, p_low double")
    pulls = mixing.fit_rates(judged, {"clean": 0.8, "toxic": 0.15, "low": 0.05})
    got = np.array([r.rate for r in judged.select("i", mixing.rate_of(pulls).alias("rate")).orderBy("i").collect()])
    a = (p * n[:, None]).T
    target, r = np.array([0.8, 0.15, 0.05]) * n.sum(), np.ones(60)
    metric = np.linalg.pinv(a @ a.T)
    for _ in range(len(pulls)):
        r = np.maximum(0, r - a.T @ (metric @ (a @ r - target)))
    assert np.allclose(got, r) and np.abs(a @ got - target).max() < 0.03 * n.sum()


def test_targets_are_met_with_skewed_lengths(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([2, 1, 1], 2000)
    n = np.minimum(20_000, rng.lognormal(6, 1.5, 2000)).astype(int) + 1
    judged = spark.createDataFrame([(int(m), *map(float, q)) for m, q in zip(n, p, strict=True)], "n_tokens long, p_clean double, p_toxic double, p_low double")
    now = (p * n[:, None]).sum(0)
    target = mixing.targets(now, relative={"toxic": 0.5, "low": 0.5})
    pulls = mixing.fit_rates(judged, relative={"toxic": 0.5, "low": 0.5})

    def missed(pulls):
        rate = mixing.rate_of(pulls)
        got = judged.agg(*[F.sum(rate * F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS]).first()
        return np.abs(np.array(got) - target).max() / n.sum()

    before = missed(pulls)
    pulls, left = mixing.settle(judged, pulls, target)
    print("missed", before, missed(pulls), left)
    assert missed(pulls) < 1e-6 < 1e-4 < before and left < 1e-6


def test_nulls_repeats_missing_labels(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, "a b", 2), (None, "c", 3)], "doc_id int, text string, mix2 int").withColumn("n_tokens", F.lit("clash"))
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 0)], "doc_id int, quality int, toxic int")
    out = mixing.mix(docs, labels, TARGETS)
    assert out.columns == [*docs.columns, "mix"]
    got = out.select("doc_id", "text", "mix.*").collect()
    assert len(got) == 4 and {r.rate for r in got if r.text is None} == {1.0}
    assert mixing.mix(docs, labels.limit(0), TARGETS).count() == 4
    assert mixing.mix(docs.limit(0), labels, TARGETS).count() == 0


def test_targets_out_of_reach_end_soon_and_are_named(spark):
    fields = "n_tokens long, p_clean double, p_toxic double, p_low double"
    # All posteriors alike: one direction is open, and the nearest point on it is taken.
    alike = spark.createDataFrame([(n, 0.5, 0.3, 0.2) for n in (10, 20, 30, 40)], fields)
    weights = {"clean": 0.9, "toxic": 0.05, "low": 0.05}
    pulls = mixing.fit_rates(alike, weights)
    assert len(pulls) <= 3
    target, p = np.array([90.0, 5.0, 5.0]), np.array([0.5, 0.3, 0.2])
    pulls, left = mixing.settle(alike, pulls, target)
    near = p * (p @ target) / (p @ p)
    assert left == pytest.approx(np.abs(near - target).max() / 100, abs=1e-4)
    rate = alike.select(F.sum(F.col("n_tokens") * mixing.rate_of(pulls))).first()[0]
    assert rate == pytest.approx((p @ target) / (p @ p), rel=1e-3)
    # The posteriors span all domains, but no nonnegative rates give this much of one.
    rng = np.random.default_rng(3)
    inside = rng.dirichlet([30, 30, 30], 200)
    cone = spark.createDataFrame([(50, *map(float, q)) for q in inside], fields)
    target = np.array([9000.0, 500.0, 500.0])
    pulls, left = mixing.settle(cone, mixing.fit_rates(cone, weights), target)
    got = cone.select(*[F.sum(F.col("n_tokens") * F.col(f"p_{d}") * mixing.rate_of(pulls)) for d in mixing.DOMAINS]).first()
    assert left > 0.05 and left == pytest.approx(np.abs(np.array(got) - target).max() / 10_000, rel=1e-6)


def test_no_other_domain_takes_the_rest():
    now = np.array([0.0, 6.0, 4.0])
    assert mixing.targets(now, relative={"toxic": 0.5, "low": 0.5}).tolist() == pytest.approx([0, 6, 4])
    assert mixing.targets(now, relative={"toxic": 0.0, "low": 0.0}).tolist() == pytest.approx([0, 6, 4])


def test_an_id_gives_one_whole_text_to_the_fit(spark):
    from tierstar.llm.common import labelled_texts

    docs = spark.createDataFrame([(1, "a b")] * 500 + [(1, "c d"), (2, None), (3, "x" * 200), (4, "y" * 9), (None, "n")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (9, 1)], "__id long, label int")
    got = {r["__id"]: (r["label"], r["__text"]) for r in labelled_texts(docs, chosen, "label", 160).collect()}
    assert set(got) == {1, 2, 4} and got[1][1] in ("a b", "c d") and got[2] == (0, "") and got[4] == (1, "y" * 9)
    assert labelled_texts(docs, chosen, "label", 160).count() == 3


def test_features_reach_the_driver_as_arrays(spark, monkeypatch):
    """Four bytes a feature: as rows of Python numbers they took the driver's memory. Ids keep their order, labels their rows."""
    docs = spark.createDataFrame([(i, f"w{i} common " + "x " * i) for i in (11, 2, 30, 1)], "doc_id long, text string")
    labels = spark.createDataFrame([(11, 1, 0), (2, 0, 0), (30, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = []
    monkeypatch.setattr(mixing, "fit", lambda documents, domain, weight: got.append((documents, domain)) or "fitted")
    assert mixing.train(docs, labels) == "fitted"
    documents, domain = got[0]
    assert [d.dtype for d in documents] == [np.int32] * 4 and domain.tolist() == [0, 0, 2, 1]  # by id as text: 1, 11, 2, 30
    assert [len(d) for d in documents] == [5] * 4


def test_steps_are_one_plan_whatever_their_numbers(spark):
    """Numbers of a step inside Spark's expressions made other code for the driver to compile, for each step."""
    from tierstar.llm.common import stored

    rng = np.random.default_rng(4)
    p = rng.dirichlet([2, 1, 1], 300)
    n = rng.integers(1, 900, 300)
    judged = spark.createDataFrame([(int(m), *map(float, q)) for m, q in zip(n, p, strict=True)], "n_tokens long, p_clean double, p_toxic double, p_low double")
    judged = stored(judged.coalesce(1))
    generated = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_GENERATED_CLASS_BYTECODE_SIZE()
    pulls = mixing.fit_rates(judged, TARGETS, steps=2)
    before = generated.getCount()
    more = mixing.fit_rates(judged, TARGETS, steps=9)
    assert len(pulls) == 2 < len(more) == 9 and np.array_equal(more[:2], pulls)
    assert generated.getCount() == before
