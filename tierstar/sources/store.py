"""Layer storage: tables are written under a run of their own and made visible all at once.

A run never touches what an earlier run wrote. Its tables become the current ones when one
manifest file naming them all appears; a failure before that leaves the previous state in force.
Publications are numbered. A number is claimed by creating a file that must not exist yet, which file systems do for one
caller only, so two runs never share a number or a folder, and the highest number is the current one, whatever the clocks say.
Everything is read and written by Spark, so any shared file system Spark can reach will do.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstar.operators.quality import RESULT, Rule

MANIFEST = "run_id string, load_dts timestamp_ntz, published_at timestamp_ntz, layer string, table_name string, path string, row_count long, table_schema string, number long"


class ConcurrentPublish(RuntimeError):
    """Another run published after this one had read what it builds on."""


def utc_now() -> datetime:
    """The time without a zone, the same on every driver."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunInfo:
    """Identity of one run, fixed once on the driver."""

    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    load_dts: datetime = field(default_factory=lambda: utc_now().replace(microsecond=0))

    def text(self) -> str:
        return f"run_id={self.run_id} load_dts={self.load_dts:%Y-%m-%d %H:%M:%S}"


@dataclass(frozen=True)
class Staged:
    """A table written by a run but not yet published."""

    name: str
    path: str
    row_count: int
    df: DataFrame


class LayerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def stage(self, run: RunInfo, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = (), rebalance: bool = True) -> Staged:
        """Write one table of a run and hand it back as read from storage.

        The row count comes from the footers of the committed files, so retried tasks cannot
        distort it. With ``partition_by``, rows are first rebalanced on those columns: adaptive
        execution then splits large partitions and merges small ones into files of even size. Rows
        that already lie together can skip that with ``rebalance=False``.
        """
        path = f"{self.root}/{layer}/runs/{run.run_id}/{name}"
        if partition_by and rebalance:
            df = df.hint("rebalance", *partition_by)
        df.write.partitionBy(*partition_by).parquet(path)
        # By the known schema: an empty table has no file to infer one from, and partition values keep their type.
        written = self.spark.read.schema(df.schema).parquet(path)
        return Staged(name, path, written.count(), written)

    def stage_observed(self, run: RunInfo, layer: str, name: str, df: DataFrame, rules: Sequence[Rule] = (), lowest: Sequence[str] = ()) -> tuple[Staged, DataFrame, dict[str, object]]:
        """Write one table and observe it in the write itself: rows, broken row rules, and the least value of some columns.

        The table is not read again for its count or its row rules. The observation sits right below the write, behind any shuffle, where every
        committed task reports once. Returns the staged table, the result lines of the rules, and the least values.
        """
        path = f"{self.root}/{layer}/runs/{run.run_id}/{name}"
        seen = Observation(f"{name}-{run.run_id}")
        bad = [F.count_if(F.coalesce(r.bad, F.lit(False))).alias(f"bad_{i}") for i, r in enumerate(rules)]
        least = [F.min(c).alias(f"least_{i}") for i, c in enumerate(lowest)]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *bad, *least).write.parquet(path)
        found = seen.get
        n = found["rows"]
        lines = [(r.code, r.severity, r.message, found[f"bad_{i}"], n, found[f"bad_{i}"] <= n * r.max_bad_ratio) for i, r in enumerate(rules)]
        written = self.spark.read.schema(df.schema).parquet(path)
        return Staged(name, path, n, written), self.spark.createDataFrame(lines, RESULT), {c: found[f"least_{i}"] for i, c in enumerate(lowest)}

    def publish(self, run: RunInfo, layer: str, tables: Sequence[Staged], after: int | None = None) -> None:
        """Make all ``tables`` of a run the current ones of ``layer`` with a single new file."""
        self.publish_layers(run, {layer: tables}, after)

    def publish_layers(self, run: RunInfo, layers: Mapping[str, Sequence[Staged]], after: int | None = None) -> None:
        """The same for several layers that must never be seen apart.

        With ``after``, the ``head`` that a run saw when it read what it builds on, the run publishes only if no other has done so
        since then, and raises ``ConcurrentPublish`` otherwise.
        """
        number = self._claim(after)
        now = utc_now()
        rows = [(run.run_id, run.load_dts, now, layer, t.name, t.path, t.row_count, t.df.schema.json(), number) for layer, tables in layers.items() for t in tables]
        # A folder of its own: what another run clears away when it is done is not in it.
        self.spark.createDataFrame(rows, MANIFEST).drop("number").coalesce(1).write.json(f"{self._manifest_path}/number={number}")

    def head(self) -> int:
        """The highest number that is claimed, 0 before the first."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/claims")
        files = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return max([int(f.getPath().getName()) for f in files.listStatus(folder)], default=0) if files.exists(folder) else 0

    def _claim(self, after: int | None) -> int:
        """The next number, claimed by a new file: exactly one caller can create it."""
        number = self.head() if after is None else after
        while True:
            number += 1
            if self._created(f"{self.root}/claims/{number:012d}"):
                return number
            if after is not None:
                raise ConcurrentPublish(f"publication {number} of {self.root} is taken, this run builds on {after}")

    def _created(self, path: str) -> bool:
        """Whether this call is the one that created a file."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if files.getScheme() == "file":
            # The Hadoop client of local disks looks first and creates then; the system's own call does both in one.
            files.mkdirs(place.getParent())
            return jvm.java.io.File(files.makeQualified(place).toUri().getPath()).createNewFile()
        try:
            files.create(place, False).close()
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    @property
    def _manifest_path(self) -> str:
        return f"{self.root}/manifest"

    def manifest(self) -> DataFrame:
        """One line per published table and run: the load log."""
        try:
            return self.spark.read.schema(MANIFEST).json(self._manifest_path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error.getCondition() or error):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def current(self, layer: str) -> dict[str, str]:
        """Table name -> path of the latest published run of ``layer``."""
        return {name: line.path for name, line in self._latest(layer).items()}

    def row_counts(self, layer: str) -> dict[str, int]:
        """Table name -> rows of the latest published run of ``layer``."""
        return {name: line.row_count for name, line in self._latest(layer).items()}

    def _latest(self, layer: str) -> dict[str, Row]:
        lines = self.manifest().filter(F.col("layer") == layer)
        latest = lines.agg(F.max("number").alias("number"))
        return {r.table_name: r for r in lines.join(F.broadcast(latest), "number").select("table_name", "path", "table_schema", "row_count").collect()}

    def carried(self, layer: str, without: Sequence[str]) -> list[Staged]:
        """The current tables of ``layer`` less those named, to be published again, unread, beside tables that a run replaces."""
        left = self.manifest().filter(F.col("layer") == layer)
        counts = {r.path: r.row_count for r in left.select("path", "row_count").collect()}
        tables = self.read(layer)
        return [Staged(name, path, counts[path], tables[name]) for name, path in self.current(layer).items() if name not in set(without)]

    def exists(self, layer: str, name: str) -> bool:
        return name in self.current(layer)

    def read(self, layer: str) -> dict[str, DataFrame]:
        def opened(line: Row) -> DataFrame:
            return self.spark.read.schema(T.StructType.fromJson(json.loads(line.table_schema))).parquet(line.path)

        return {name: opened(line) for name, line in self._latest(layer).items()}

    def append_audit(self, run: RunInfo, layer: str, results: DataFrame) -> DataFrame:
        """Keep the check results of a run, passed or not, and return all of the run's so far as stored."""
        path = f"{self.root}/audit/layer={layer}/run_id={run.run_id}"
        results.withColumn("load_dts", F.lit(run.load_dts).cast("timestamp_ntz")).coalesce(1).write.mode("append").json(path)
        return self.spark.read.schema(results.schema).json(path)

    def audit(self) -> DataFrame:
        """All check results of all runs, for pass and fail trends."""
        extra = [T.StructField("load_dts", T.TimestampNTZType())]
        extra += [T.StructField(c, T.StringType()) for c in ("layer", "run_id")]
        schema = T.StructType([*RESULT.fields, *extra])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/audit").json(f"{self.root}/audit")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may go without: it gets a temporary
    folder, set once. On a cluster that would be another disk on every machine, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tierstar-"))
    return folder.rstrip("/")


_LOCAL: dict[str, str] = {}
