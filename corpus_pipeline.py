"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstar.llm import common, decontaminate, exact_dedup, mixing, near_dedup, quality

#: Documents of a lower quality score go.
LEAST_QUALITY = 0.7
#: The mixed corpus holds these shares of what the domains have before; the rest goes to clean text.
RELATIVE = {"toxic": 0.1, "low": 0.5}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.train(docs, _labels(spark, sf_dir))
    return docs.filter(quality.score(model) >= LEAST_QUALITY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a class of near-duplicates the row with the smallest id stays."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are taken at least once, with their rate and the number of copies."""
    out = mixing.mix(docs, _labels(spark, sf_dir), relative=RELATIVE)
    taken = out.filter(F.col("mix.copies") > 0)
    return taken.select(*docs.columns, F.col("mix.rate").alias("rate"), F.col("mix.copies").alias("copies"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixed),
]

#: No SQL: the classifiers and the sketches are beyond it; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
    return docs
