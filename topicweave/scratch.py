"""Tables written between the steps of iterative jobs.

A written table cuts the lineage, survives the loss of executors and gives the
planner real sizes for the next step.  The folder is the one the cluster names
in ``spark.checkpoint.dir``; only a local session may fall back to a temporary
folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="topicweave-")
    return _FALLBACK[app]


class Scratch:
    """One job's folder of intermediate tables."""

    def __init__(self, spark: SparkSession, name: str = "job"):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._paths: list[str] = []

    def table(
        self,
        df: DataFrame,
        name: str = "t",
        replaces: DataFrame | None = None,
        watch: Column | None = None,
    ) -> DataFrame:
        """Write ``df`` and read it back; drop the table it ``replaces``.

        The rows, and those where ``watch`` holds, are counted by the write.
        """
        self._n += 1
        path = f"{self.root}/{self._n:04d}-{name}"
        self._paths.append(path)
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("rows")]
        if watch is not None:
            counts.append(F.count_if(watch).alias("watched"))
        df.observe(seen, *counts).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        out._counts = seen.get
        if replaces is not None:
            self.drop(replaces)
        return out

    @staticmethod
    def rows(table: DataFrame) -> int:
        """Rows of a written table."""
        return table._counts["rows"]

    @staticmethod
    def watched(table: DataFrame) -> int:
        """Rows of a written table where the watched condition held."""
        return table._counts["watched"]

    def keep(self, *tables: DataFrame) -> None:
        """Delete all tables this job wrote but for these."""
        kept = {table._scratch_path for table in tables}
        for path in [p for p in self._paths if p not in kept]:
            self._delete(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a table this job wrote and no longer reads."""
        path = getattr(df, "_scratch_path", None)
        if path and path.startswith(self.root):
            self._delete(path)

    def _delete(self, path: str) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        target.getFileSystem(conf).delete(target, True)
        self._paths = [p for p in self._paths if p != path]
