"""Monthly snapshots of named tables, as files with the month in their names or as one partitioned table.

Both kinds are used alike. In a :class:`PartitionedMonths` the month is a partition column: writing one replaces just that
partition (dynamic partition overwrite), and reading one opens no other. Which months there are, and how many rows each
has, comes from a scan that reads no column: row counts stand in the footers of the files.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.scope import required_present
from ..registry import inline
from ..session import file_system
from .landing import counted, publish_counted
from .snapshots import list_snapshots, snapshot_path

CODE, MONTH = "dataset_code", "month"


class Months(ABC):
    """Snapshots below one root by name and month."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @abstractmethod
    def write(self, df: DataFrame, name: str, month: str, required: list[str]) -> dict[str, Any]:
        """Replace one month of one name; nothing happens for an empty frame. ``n_rows`` and ``extracted_at`` (the newest)
        come from the job that writes."""

    @abstractmethod
    def months(self) -> DataFrame:
        """``name`` and ``month`` of every snapshot."""

    @abstractmethod
    def open(self, name: str, month: str) -> DataFrame:
        """One snapshot; no file of another one is looked at."""

    @abstractmethod
    def place(self, name: str, month: str) -> str:
        """Where a snapshot lies, for logs."""

    def newest(self, names: list[str] | None = None, before: str | None = None) -> dict[str, str]:
        """Name -> newest month, optionally strictly before one. An entry per name, which the driver needs to open them."""
        found = self.months()
        if names is not None:
            found = found.filter(F.col("name").isin(names))
        if before is not None:
            found = found.filter(F.col("month") < before)
        return {r["name"]: r["month"] for r in found.groupBy("name").agg(F.max("month").alias("month")).collect()}

    def latest_two(self, name: str, upto: str) -> list[str]:
        """The newest month and the one before, up to a given one."""
        found = self.months().filter((F.col("name") == name) & (F.col("month") <= upto))
        return [r["month"] for r in found.orderBy(F.desc("month")).limit(2).collect()]


class MonthFiles(Months):
    """``<root>/<name>_<YYYY-MM>.parquet``."""

    def write(self, df, name, month, required):
        required_present(df, required)
        return publish_counted(df, self.place(name, month), skip_empty=True)

    def months(self):
        return list_snapshots(self.spark, self.root).select("name", "month")

    def open(self, name, month):
        return self.spark.read.parquet(self.place(name, month))

    def place(self, name, month):
        return snapshot_path(self.root, name, month)


class PartitionedMonths(Months):
    """One table, ``<root>/dataset_code=<name>/month=<YYYY-MM>/``; with ``name`` given, the table has that one name and is
    partitioned by month only."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None):
        super().__init__(spark, root)
        self.name = name
        self.keys = [CODE, MONTH] if name is None else [MONTH]

    def write(self, df, name, month, required):
        required_present(df, required)
        self._known(name)
        stamped = df.withColumn(MONTH, F.lit(month))
        return self._write(stamped if self.name else stamped.withColumn(CODE, F.lit(name)))

    def write_all(self, df: DataFrame) -> dict[str, Any]:
        """Replace every partition that ``df`` (with the partition columns) has rows of, in one job.

        Rows are dealt by partition and rebalanced, so that a partition has few files and a large one is still written by
        many tasks.
        """
        return self._write(df.hint("rebalance", *self.keys))

    def _write(self, df: DataFrame) -> dict[str, Any]:
        return counted(df, lambda w: w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                       .partitionBy(*self.keys).parquet(self.root))

    def _known(self, name: str) -> None:
        if self.name not in (None, name):
            raise ValueError(f"{self.root} holds {self.name}, not {name}")

    def _keys_only(self) -> DataFrame | None:
        """The partition columns of every row; None if there is no table yet. Names and months are text, whatever they
        look like."""
        fs, where = file_system(self.spark, self.root)
        if not fs.exists(where):
            return None
        return self.spark.read.schema(", ".join(f"{k} string" for k in self.keys)).parquet(self.root)

    def profile(self) -> DataFrame:
        """``name``, ``month``, ``n_rows`` of every snapshot, from the footers."""
        rows = self._keys_only()
        if rows is None:
            return inline(self.spark, [], "name string, month string, n_rows bigint")
        name = F.lit(self.name) if self.name else F.col(CODE)
        return rows.groupBy(name.alias("name"), MONTH).agg(F.count("*").alias("n_rows"))

    def months(self):
        return self.profile().select("name", "month")

    def open(self, name, month):
        """The columns are those this month was written with; older months may have had others."""
        self._known(name)
        columns = self.spark.read.parquet(self.place(name, month)).schema.fields
        schema = StructType([*columns, *(StructField(k, StringType()) for k in self.keys)])
        top = self.root if self.name else self.place(name, month).rsplit("/", 1)[0]      # other names are not listed
        table = self.spark.read.schema(schema).option("basePath", self.root).parquet(top)
        return table.filter(F.col(MONTH) == month).drop(MONTH)

    def read_newest(self, columns: StructType, before: str | None = None) -> DataFrame:
        """Every name's newest rows, with ``columns`` and the partition columns.

        The newest months are found first; as literals they choose the partitions before any file is opened.
        """
        tops = self.newest(before=before)
        schema = StructType([*(f for f in columns if f.name not in self.keys), *(StructField(k, StringType()) for k in self.keys)])
        table = self.spark.read.schema(schema).parquet(self.root)
        wanted = F.lit(False)
        for name, month in sorted(tops.items()):
            here = F.col(MONTH) == month
            wanted = wanted | (here if self.name else (F.col(CODE) == name) & here)
        return table.filter(wanted)

    def place(self, name, month):
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        parts = [f"{MONTH}={escaped(month)}"] if self.name else [f"{CODE}={escaped(name)}", f"{MONTH}={escaped(month)}"]
        return "/".join([self.root, *parts])
