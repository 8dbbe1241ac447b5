"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are written for. They are defaults for our own session only: a caller's session is
# never changed behind its back.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "statmart", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; where it is unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of a session, once."""
    context = spark.sparkContext
    if getattr(context, "_statmart_code", None):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.TemporaryDirectory(prefix="statmart-code-")   # the driver serves it for as long as it runs
    archive = f"{folder.name}/statmart.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for top, _, names in os.walk(home):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(top, n), os.path.relpath(os.path.join(top, n), os.path.dirname(home)))
    context.addPyFile(archive)
    context._statmart_code = folder


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


_WRITTEN: ContextVar[list[str] | None] = ContextVar("tables written in the current scope", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Tables that :func:`checkpointed` writes inside are deleted at the end; those of other callers are not touched."""
    mine: list[str] = []
    token = _WRITTEN.set(mine)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in mine:
            fs, where = file_system(spark, path)
            fs.delete(where, True)


def written(df: DataFrame, by: list[str] | None = None) -> str:
    """Write ``df`` to a folder of its own in the shared one and return its path; see :func:`checkpointed`."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/statmart-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    mine = _WRITTEN.get()
    if mine is not None:
        mine.append(path)
    return path


def checkpointed(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and survives a lost executor.

    ``by``: partition columns, for readers that need one part each. A parquet table rather than ``df.checkpoint()``:
    columnar and compressed, later readers prune columns, and Catalyst knows its real size.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df, by))


_SCAN_KEEPS = ("Project", "Filter", "SubqueryAlias", "Relation", "LogicalRelation")


def is_plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` reads files and does no more than drop rows and columns: its rows are rows of files, none repeated,
    and Catalyst knows its size."""
    node = df._jdf.queryExecution().analyzed()
    while (name := node.nodeName().split()[0]) in _SCAN_KEEPS and node.children().size() == 1:
        node = node.children().head()
    return name in ("Relation", "LogicalRelation")
