"""Sinks and readers for results: metrics, scored customers, model bundles, run log, registry."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from spendcast import __version__
from spendcast.config import FEATURE_COLS

RUN_SCHEMA = (
    "experiment string, run string, logged_at timestamp, params map<string,string>, metrics map<string,double>"
)
REGISTRY_SCHEMA = (
    "name string, version int, champion string, registered_at timestamp, "
    "params map<string,string>, metrics map<string,double>"
)
BUNDLE_SCHEMA = (
    "feature_names array<string>, target_transform string, defaults map<string,double>, "
    "created_at timestamp, version string"
)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_transactions(clean: DataFrame, path: str) -> None:
    """Clean transactions by month, each written by few tasks, so that a literal split date prunes files."""
    by_month = clean.withColumn("month", F.trunc(F.to_date("InvoiceDate"), "month")).hint("rebalance", "month")
    write_table(by_month, path, partition_by=["month"])


def write_segment_metrics(df: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(df, path, fmt)


def read_segment_metrics(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame | None:
    """The stored segment metrics, or ``None`` when there are none yet."""
    schema = (
        "Segment string, N bigint, RMSE double, MAE double, R2 double, `WAPE%` double, `SMAPE%` double, "
        "Avg_Actual double, Avg_Pred double"
    )
    try:
        reader = spark.read.schema(schema).format(fmt)
        return (reader.option("header", True) if fmt == "csv" else reader).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def write_scored(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "csv":
        write_table(df, path, "csv")
    else:
        write_table(df, path, fmt, partition_by=["Segment"])


def save_bundle(spark: SparkSession, model: Model, path: str, defaults: Mapping[str, float] | None = None) -> None:
    """The model with the names and fill values of its features."""
    PipelineModel(stages=[model]).write().overwrite().save(f"{path}/model")
    row = [(FEATURE_COLS, "log1p", dict(defaults or {}), None, __version__)]
    meta = spark.createDataFrame(row, BUNDLE_SCHEMA).withColumn("created_at", F.current_timestamp())
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> tuple[Model, dict]:
    """The model as it was saved, and its metadata; a missing bundle raises ``FileNotFoundError``."""
    try:
        meta = spark.read.schema(BUNDLE_SCHEMA).parquet(f"{path}/metadata").first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no model bundle at {path}; train one first") from error
        raise
    return PipelineModel.load(f"{path}/model").stages[0], meta.asDict()


def load_champion(spark: SparkSession, path: str, name: str, version: int | None = None) -> tuple[Model, dict]:
    """The bundle of a registered version under ``path``, the latest without ``version``."""
    known = read_registry(spark, f"{path}/registry").filter(F.col("name") == name)
    chosen = known if version is None else known.filter(F.col("version") == version)
    row = chosen.orderBy(F.desc("version"), F.desc("registered_at")).first()
    if row is None:
        raise FileNotFoundError(f"no version {version or ''} of {name} at {path}")
    return load_bundle(spark, f"{path}/{row['params']['bundle']}")


def log_runs(
    spark: SparkSession, path: str, experiment: str, runs: Sequence[tuple[str, Mapping, Mapping]]
) -> None:
    """Append runs (name, params, metrics). Missing or undefined metrics are stored as null."""
    rows = [
        (
            experiment,
            name,
            None,
            {k: str(v) for k, v in params.items()},
            {k: None if v is None or v != v else float(v) for k, v in metrics.items()},
        )
        for name, params, metrics in runs
    ]
    df = spark.createDataFrame(rows, RUN_SCHEMA).withColumn("logged_at", F.current_timestamp())
    df.coalesce(1).write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def register_champion(
    spark: SparkSession, path: str, name: str, champion: str, params: Mapping, metrics: Mapping, version: int | None = None
) -> int:
    """Append a champion under a claimed ``version`` of ``name``, the next one by default; returns the number.

    Writers at the same time get numbers of their own. A claim whose registration fails is given back.
    """
    given = {k: str(v) for k, v in params.items()}
    measured = {k: None if v is None else float(v) for k, v in metrics.items()}
    own = claim_version(spark, path, name) if version is None else version
    row = [(name, own, champion, None, given, measured)]
    df = spark.createDataFrame(row, REGISTRY_SCHEMA).withColumn("registered_at", F.current_timestamp())
    try:  # a folder for each entry: writers that share one also share its temporary files
        df.coalesce(1).write.parquet(f"{path}/entry-{uuid.uuid4().hex}")
    except Exception:
        release_version(spark, path, name, own)
        raise
    return own


def _claim(spark: SparkSession, path: str, name: str, version: int):
    """The file system and the file whose existence claims a version; readers of the table skip its folder."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}_claims/{quote(name, safe='')}/{version}")
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), file


def claim_version(spark: SparkSession, path: str, name: str) -> int:
    """The lowest version of ``name`` above all registered ones that no other writer holds.

    A version is held by a file that is created only if it is not there, which the file system
    decides; of two writers one succeeds, the other goes on to the next number.
    """
    version = next_version(spark, path, name)
    while True:
        files, file = _claim(spark, path, name, version)
        if files.getUri().getScheme() == "file":  # Hadoop looks first and creates then; Java does both in one step
            files.mkdirs(file.getParent())
            if spark.sparkContext._jvm.java.io.File(file.toUri().getPath()).createNewFile():
                return version
            version += 1
            continue
        try:
            files.create(file, False).close()
            return version
        except Py4JJavaError as error:
            if not files.exists(file):
                raise error
            version += 1


def release_version(spark: SparkSession, path: str, name: str, version: int) -> None:
    """Give a claimed version back that was not registered."""
    files, file = _claim(spark, path, name, version)
    files.delete(file, False)


def next_version(spark: SparkSession, path: str, name: str) -> int:
    try:
        known = read_registry(spark, path).filter(F.col("name") == name)
        return (known.agg(F.max("version")).first()[0] or 0) + 1
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 1


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", True).parquet(path)
