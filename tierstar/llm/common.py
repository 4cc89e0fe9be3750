"""Helpers shared by the operators: row keys, the shared folder, graph components.

A document row is known by its id together with a fingerprint of its text (``with_key``), so that
rows that share an id, or have none, never mix. Null texts are empty texts everywhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierstar.sources.store import shared_folder

#: Rows of a lookup table up to which it is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold_of(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty one."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only id, text and a fingerprint of the text, under names that cannot clash."""
    return docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text")).withColumn("_fp", F.xxhash64("_text"))


def labelled_texts(docs: DataFrame, chosen: DataFrame, by: str, chars: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Whole texts for fitting a classifier: __id, ``by``, __text of the labelled ids ``chosen`` (__id, ``by``; a bounded number).

    An id gives one text, however many rows have it (the one with the smallest hash). Of each label texts are taken in the order of
    their ids' hashes while they have ``chars`` characters or fewer together; texts of more than a sixteenth of that are left out. So what reaches the driver is bounded.
    """
    texts = docs.select(F.col(id_column).alias("__own"), text_of(text_column).alias("__text"))
    found = texts.join(F.broadcast(chosen), F.col("__own") == F.col("__id")).groupBy("__id", by).agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
    size = F.length("__text")
    so_far = F.sum(size).over(Window.partitionBy(by).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id"))
    return found.filter(size <= chars // 16).withColumn("__chars", so_far).filter(F.col("__chars") <= chars).drop("__chars")


def same_row(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("doc_id", "_fp")) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def shared_path(spark: SparkSession) -> str:
    """A new path in the shared folder of the cluster."""
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within the limit."""
    return F.broadcast(df) if rows <= limit else df


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) edges as (node, component), the smallest node being the name.

    Each round every node takes the smallest label among its neighbours and itself, then the label
    of that label. Rounds end when nothing changes; only counts reach the driver.
    """
    # One row made two, not a union, for which Spark would compute the edges twice.
    either = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(edges.select(F.explode(either).alias("_edge")).select("_edge.a", "_edge.b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component")))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low"))
        hooked = labels.join(near, "node").select("node", F.least("component", "low").alias("component"), F.col("component").alias("was"))
        ahead = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        after = stored(hooked.join(ahead, "component", "left").select("node", F.least("component", "far").alias("component"), "was"))
        changed = after.filter(F.col("component") != F.col("was")).limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def contracted_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """The same as ``components``, for graphs whose edges soon lie inside what is known to be connected.

    Each round every node goes into that of its neighbours and itself that comes first in an order drawn anew for the round; nodes that
    went into the same one are one node from then on, and edges inside it leave. So a round reads only the edges the one before left, and
    a constant share of the nodes is expected to go each time, whatever the shape of the graph. Only whether edges are left reaches the driver.
    """
    left = stored(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        if len(steps) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        drawn = lambda node: F.xxhash64(node, F.lit(len(steps)))  # noqa: B023, E731
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", drawn("b")).alias("near"))
        step = stored(first.select("node", F.when(drawn("near") < drawn("node"), F.col("near")).otherwise(F.col("node")).alias("into")))
        moved = left.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b").filter(F.col("x") != F.col("y"))
        left = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        steps.append(step)
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    named = steps[0].select("node", F.col("into").alias("root"))
    for step in steps[1:]:
        named = named.join(step.toDF("root", "into"), "root", "left").select("node", F.coalesce("into", "root").alias("root"))
    named = stored(named)
    return named.join(named.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component")
