"""A stored table whose parts are replaced one by one: only the parts that a change touches are written again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstar.operators.aggregates import union_all
from tierstar.sources.store import LayerStore, RunInfo, Staged

LISTING = "part string, path string, row_count long"


class PartedTable:
    """A table of a layer, stored by the values of a column; its manifest entry is a listing of parts, each with the path that holds it."""

    def __init__(self, store: LayerStore, layer: str, name: str, by: str):
        self.store, self.layer, self.name, self.by = store, layer, name, by

    @property
    def listing_name(self) -> str:
        return f"{self.name}_parts"

    def listing(self) -> DataFrame:
        """The current parts: value, path, rows."""
        return self.store.read(self.layer)[self.listing_name]

    def _opened(self, schema, listing: DataFrame) -> DataFrame:
        # One line per part reaches the driver, as the names of any partitioned table do.
        paths = [r.path for r in listing.select("path").collect()]
        spark = self.store.spark
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read(self, schema) -> DataFrame:
        return self._opened(schema, self.listing())

    def stage(self, run: RunInfo, rows: DataFrame, touched: DataFrame | None = None) -> Staged:
        """Write ``rows`` under the run and stage the new listing.

        Without ``touched`` the rows are the whole table. With it they are all rows of the parts it names (one text column, ``part``), which
        replace those parts; the others stay where they are. A touched part without rows is gone.
        """
        path = f"{self.store.root}/{self.layer}/runs/{run.run_id}/{self.name}"
        keyed = rows.withColumn("_part", F.coalesce(F.col(self.by).cast("string"), F.lit("none")))
        keyed.hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
        schema = F.concat(F.lit(f"{path}/_part="), F.col("_part"))
        written = self.store.spark.read.schema(keyed.schema).parquet(path)
        listing = written.groupBy(F.col("_part").alias("part"), schema.alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
        if touched is not None:
            listing = union_all([self.listing().join(touched.select("part").distinct(), "part", "left_anti").select("part", "path", "row_count"), listing])
        return self.store.stage(run, self.layer, self.listing_name, listing)

    def replace(self, run: RunInfo, schema, gone: DataFrame, came: DataFrame, key: str) -> Staged:
        """Stage the table with the rows of some keys replaced: ``came`` are all rows they have now, ``gone`` names the keys (those of ``came`` included).

        The parts to be written are those that hold such keys now or will. Where they are is read from two columns; of the rest of the
        table only the touched parts are read, and only they are written.
        """
        keys = gone.select(key).distinct()
        current = self.read(schema)

        def part_of(df: DataFrame) -> DataFrame:
            return df.select(F.coalesce(F.col(self.by).cast("string"), F.lit("none")).alias("part"))

        where = union_all([part_of(current.select(key, self.by).join(keys, key, "left_semi")), part_of(came)]).distinct()
        touched = self.store.stage(run, self.layer, f"{self.name}_touched", where).df
        held = self._opened(schema, self.listing().join(touched, "part", "left_semi"))
        stay = held.join(keys, key, "left_anti").select(*current.columns)
        return self.stage(run, union_all([stay, came.select(*current.columns)]), touched)
