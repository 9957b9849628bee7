"""Session helpers: the shared scratch folder and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, partitions: int | None = None, app: str = "spendcast") -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spendcast-"))
    return spark.sparkContext.getCheckpointDir()


#: Folders of the tables that ``materialize`` wrote in this process.
_written: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far; results that were not saved can't be read afterwards."""
    hadoop, deleted = spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _written:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_written.pop())
        deleted += path.getFileSystem(hadoop).delete(path, True)
    return deleted


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, which ``clear_scratch`` deletes."""
    path = f"{scratch_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and survives lost executors. Columnar, so each later reader
    scans only the columns it needs. With ``by`` the files are laid out in folders by these columns,
    each by few tasks; filters on them then skip folders.
    """
    path = f"{scratch_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    if by:
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(path)
    else:
        df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
