"""Session and shared-folder helpers used by every subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, shared by driver and executors.

    Where a local session leaves it unset (as tests may) a temporary folder is made once per context;
    on a cluster that is an error, as executors can't see each other's folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    own = context.getCheckpointDir()
    if not own:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-quire-"))
        own = context.getCheckpointDir()
    return own.rstrip("/")


#: Rows, and bytes, that Spark hands to a Python worker at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def bounded_batches(spark: SparkSession | None = None) -> None:
    """Lower the session's Arrow batch to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes, so that whole texts fit a worker's memory.

    A smaller setting of the session stays. The lowered one holds for the session's later queries too:
    Spark reads it when a query runs, not when it is declared.
    """
    spark = spark or SparkSession.active()
    key = "spark.sql.execution.arrow.max%sPerBatch"
    if not 0 < int(spark.conf.get(key % "Records")) <= BATCH_ROWS:
        spark.conf.set(key % "Records", BATCH_ROWS)
    bytes_now = spark.conf.get(key % "Bytes", None)
    if bytes_now is None or not bytes_now.isdigit() or int(bytes_now) > BATCH_BYTES:
        spark.conf.set(key % "Bytes", BATCH_BYTES)


class Scratch:
    """Written tables in the shared folder: they cut lineage and survive lost executors. The folder goes when the application ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/quire-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(folder)
        store.deleteOnExit(folder)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._quire_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        jvm = self.spark._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._quire_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
