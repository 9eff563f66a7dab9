"""Session settings and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def local_session(cores: str = "*", app: str = "recordloom", **conf: str) -> SparkSession:
    """A session for tests and single-machine runs; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "16g",
        # Small splits, so that every core has a share of a small table.
        "spark.sql.files.maxPartitionBytes": "4m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster's ``spark.checkpoint.dir`` wins, then a folder the application
    set on the context.  Only a master of one process (``local``, ``local[8]``; not
    ``local-cluster``) may fall back to a temporary folder, made once per
    application: on a cluster that folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    chosen = context._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="recordloom-")
    return _local_roots[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the checkpoint root, which ``drop_staged`` deletes."""
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once under the checkpoint root and read it back.

    Cuts lineage and fixes values that a recomputation could change (partition
    ids, sampled range bounds).  Being a columnar table, later reads prune
    columns and know the real size, so join choices rest on facts.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables ``stage`` wrote in this application; call when results are saved."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step; an error if it exists."""
    fs, target = _filesystem(spark, path)
    if not fs.createNewFile(target):
        raise FileExistsError(path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _filesystem(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(folder)]
