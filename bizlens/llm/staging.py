"""Helpers shared by the operators: written tables in the shared folder,
bucketed tables, gapless numbering, and shipping this package to executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bizlens.session import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make ``bizlens`` importable by the Python workers of this session.

    The package is a few source files; they travel with ``addPyFile`` once per
    Spark context.
    """
    sc = spark.sparkContext
    if getattr(sc, "_bizlens_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="bizlens-src-"), "bizlens_src")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    sc._bizlens_shipped = True


def run_path(spark: SparkSession, name: str) -> str:
    """A new folder for one run's table, in the folder that the cluster shares."""
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    for written in _scratch(spark):
        written.append(path)
    return path


def _scratch(spark: SparkSession) -> list[list[str]]:
    """The tables and folders written in each open :func:`scratch`."""
    sc = spark.sparkContext
    if not hasattr(sc, "_bizlens_scratch"):
        sc._bizlens_scratch = []
    return sc._bizlens_scratch


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What operators write inside goes at the end: for a result that is stored inside, elsewhere."""
    _scratch(spark).append(written := [])
    try:
        yield
    finally:
        _scratch(spark).pop()
        tables = {t.name for t in spark.catalog.listTables()} if any(not w.startswith(shared_dir(spark)) for w in written) else set()
        for what in written:
            if what in tables:
                spark.sql(f"DROP TABLE {what}")
            elif what.startswith(shared_dir(spark)):
                folder = spark._jvm.org.apache.hadoop.fs.Path(what)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` as a written table (lineage ends there; a lost executor rereads files)."""
    spark = df.sparkSession
    path, schema = run_path(spark, name), df.schema
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(schema).parquet(path)


def staged_buckets(df: DataFrame, name: str, key: str, buckets: int,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` as a table bucketed by ``key``: later joins and groups on the key
    read the files as they lie, without moving them again."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    for written in _scratch(spark):
        written.append(table)
    writer = df.write.option("compression", "zstd").option("path", run_path(spark, name)).bucketBy(buckets, key)
    (writer.partitionBy(*partition_by) if partition_by else writer).format("parquet").saveAsTable(table)
    return spark.table(table)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_place(df: DataFrame) -> DataFrame:
    """Adds (``_part``, ``_seq``): the writing task and the row's order in it.
    Only meaningful in what :func:`staged` then writes: the file fixes them."""
    return df.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id())


def dense_rank_in(placed: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Numbers the rows of every key 0, 1, ... without gaps, however hot the key.

    ``placed`` is a staged table with ``_part`` and ``_seq``. Rows are numbered
    inside (part, key), so no task sorts more than one part's rows of a key;
    the counts per (part, key) give each part its first number.
    """
    inside = Window.partitionBy("_part", *keys).orderBy("_seq")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbered = placed.withColumn("_pos", F.row_number().over(inside) - 1)
    return numbered.join(first, ["_part", *keys]).withColumn(
        out, (F.col("_first") + F.col("_pos")).cast("bigint")).drop("_first", "_pos", "_part", "_seq")
