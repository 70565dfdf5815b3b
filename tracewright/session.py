"""Scratch space and size checks that depend on the running session."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder of its
    own; a cluster session is refused, since executors could not share it.
    """
    configured = spark.conf.get(CHECKPOINT_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tracewright-")
    spark.conf.set(CHECKPOINT_DIR_CONF, folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def task_count(spark: SparkSession) -> int:
    """Tasks for work whose cost does not show in its rows, such as reading
    files named by path: one wave of cores at least, more if configured."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, spark.sparkContext.defaultParallelism)


def hadoop_path(spark: SparkSession, path: str):
    """Spark's own filesystem for ``path``, and the path in it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    return found.getFileSystem(configuration), found


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark would read it under, for readers in tasks."""
    filesystem, found = hadoop_path(spark, path)
    return filesystem.makeQualified(found).toString()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that nothing has written to yet."""
    app = spark.sparkContext.applicationId
    root = qualified(spark, scratch_root(spark))
    return f"{root}/tracewright/{app}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch space and read back: computed once however
    often it is used, and safe against lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application. A package that
    was itself submitted as an archive is there already."""
    application = spark.sparkContext.applicationId
    package = Path(__file__).parent
    if application in _shipped or not package.is_dir():
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    uri = f"{scratch_path(spark, 'package')}.zip"
    filesystem, path = hadoop_path(spark, uri)
    stream = filesystem.create(path)
    stream.write(archive.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(uri)
    _shipped.add(application)


def map_in_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def map_in_pandas(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInPandas`` with this package importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInPandas(function, schema)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes, negative when off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?[0-9]+)\s*([a-z]*)", text).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit.rstrip("b")[:1]]
