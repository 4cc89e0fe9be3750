"""A table kept from a feed of changes: inserts, updates and deletes in any order, late or repeated.

Every change carries the key, a sequence number that grows with each change of the source, an operation and the whole
row. The table remembers the number of each key's last change, and of deleted keys a tombstone, so that
a late change never overwrites a later one or brings a deleted row back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.operators.aggregates import union_all
from tierstar.operators.dedup import first_per_key
from tierstar.sources.store import LayerStore, RunInfo

DELETE = "delete"
MARK = "batch_id long, mark long, changes long, keys long, tombstones long"


def fold(table: DataFrame | None, changes: DataFrame, keys: Sequence[str], sequence: str, operation: str) -> DataFrame:
    """The table (tombstones included) after the changes: per key the one with the largest sequence number.

    Changes are first reduced to the last of each key, where Spark limits every map task to one row per key, so a key with very
    many changes costs no more than others. Rows of other keys pass through. Changes without a key or number are left out. Of
    two different changes with one number a deletion wins, then the row that comes first in order of values.
    """
    numbered = changes.filter(F.col(sequence).isNotNull() & ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    gone = (F.lower(operation) == DELETE).alias("_gone")
    payload = [c for c in changes.columns if c not in (*keys, sequence, operation)]
    arrived = numbered.select(*keys, F.col(sequence).cast("long").alias("_sequence"), F.coalesce(gone, F.lit(False)).alias("_gone"), *payload)
    empty = [F.when(F.col("_gone"), F.lit(None)).otherwise(F.col(c)).alias(c) for c in payload]
    order = [F.col("_sequence").desc(), F.col("_gone").desc()]
    ties = [F.col(c) for c in payload if not isinstance(changes.schema[c].dataType, T.MapType)]
    last = first_per_key(arrived.select(*keys, "_sequence", "_gone", *empty), keys, order, ties)
    if table is None:
        return last
    touched = last.select(*keys)
    known = table.join(touched, list(keys), "left_semi").select(*last.columns)
    still = table.join(touched, list(keys), "left_anti").select(*last.columns)
    return union_all([still, first_per_key(union_all([known, last]), keys, order, ties)])


def live(table: DataFrame) -> DataFrame:
    """The rows that the feed has left, as a reader sees them."""
    return table.filter(~F.col("_gone")).drop("_gone", "_sequence")


def forget(table: DataFrame, before: int) -> DataFrame:
    """Without tombstones of changes numbered below ``before``: no change as old as that can still arrive."""
    return table.filter(~F.col("_gone") | (F.col("_sequence") >= before))


class Feed:
    """A table fed from a folder of change files into a layer of the store."""

    def __init__(self, store: LayerStore, name: str, keys: Sequence[str], sequence: str, operation: str):
        self.store, self.name, self.keys, self.sequence, self.operation = store, name, list(keys), sequence, operation
        self.layer = f"feed_{name}"

    def table(self) -> DataFrame | None:
        """The current table, tombstones included; None before the first batch."""
        return self.store.read(self.layer).get(self.name)

    def marks(self) -> DataFrame:
        """What the last batch did: its number, the largest sequence number so far, and counts."""
        return self.store.read(self.layer)[f"{self.name}_mark"]

    def apply(self, changes: DataFrame, batch_id: int) -> bool:
        """Publish the table after a batch, together with the mark; False if this batch has been published already.

        A stream repeats a batch that failed before it was noted as done. What such an attempt has written is never visible, because the table
        appears only with its manifest, and a batch that did appear is known by its number.
        """
        prefix = f"{self.name}-{batch_id:012d}-"
        done = self.store.manifest().filter((F.col("layer") == self.layer) & F.col("run_id").startswith(prefix))
        if not done.isEmpty():
            return False
        run = RunInfo(f"{prefix}{uuid.uuid4()}")
        folded = self.store.stage(run, self.layer, self.name, fold(self.table(), changes, self.keys, self.sequence, self.operation))
        counted = folded.df.agg(F.max("_sequence").alias("mark"), F.count(F.lit(1)).alias("keys"), F.count_if("_gone").alias("tombstones"))
        number = changes.agg(F.count(F.lit(1)).alias("changes"))
        mark = counted.join(number).select(F.lit(batch_id).cast("long").alias("batch_id"), "mark", "changes", "keys", "tombstones")
        self.store.publish(run, self.layer, [folded, self.store.stage(run, self.layer, f"{self.name}_mark", mark)])
        return True

    def run(self, spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str, files_per_batch: int = 1000) -> None:
        """Take in the change files that are new in ``folder`` and return; the checkpoint remembers which were."""
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
        query = arriving.writeStream.foreachBatch(lambda df, batch: self.apply(df, batch)).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
