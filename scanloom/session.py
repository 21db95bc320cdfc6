"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession, estimates: bool = True) -> SparkSession:
    """Settings the operators rely on.  Partition counts stay with the cluster;
    AQE coalesces small shuffles, splits skewed join partitions and picks broadcasts
    from measured bytes.  Without ``estimates`` nothing else picks them: an estimate
    before the run is that of the files and knows nothing of exploded rows.  Small files
    are then also read by many in a task, as frames come one a file, and the shuffles of
    a written step go with it instead of staying until the driver collects garbage."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if estimates else "-1")
    conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    if not estimates:
        conf.set("spark.sql.files.openCostInBytes", "64KB")
        conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; on a local master
    without that setting a temporary one, on a cluster an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if current is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="scanloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives the
    loss of executors, and the new plan's size estimate is that of the files
    (a checkpoint would hand on the old plan's estimate, which joins multiply)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame):
    """The folders a table was read from, with their file system."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        yield folder, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_bytes(df: DataFrame) -> int:
    """Bytes on disk of a table made by ``cut``."""
    return sum(fs.getContentSummary(path).getLength() for _, path, fs in _folders(df))


def drop(*frames: DataFrame) -> None:
    """Delete the files of tables made by ``cut`` that no later step reads."""
    for df in frames:
        root = checkpoint_root(df.sparkSession).removeprefix("file:").rstrip("/").lstrip("/")
        for folder, path, fs in _folders(df):
            if f"/{root}/" in folder:
                fs.delete(path, True)
