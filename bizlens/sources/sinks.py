"""Stored tables: every run writes to a folder of its own in the shared folder
and returns a reader of it, so runs never touch each other's files and a failed
run leaves nothing that is read. The table's name is a pointer: a session view
on the newest finished run (replace on rerun).

:func:`stored` keeps a table for as long as the files it was made from stay as they
are; :class:`NumberedTable` is one that inserts append to, with ids 1, 2, ... throughout.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.session import shared_dir, table_path
from bizlens.sources import files


def _publish(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    stored = spark.read.schema(schema).parquet(path)
    stored.createOrReplaceTempView(name)
    return stored


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``CREATE TABLE ... AS`` / ``SELECT ... INTO``: write ``df``, point the
    name at it and return the stored table (lineage cut)."""
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    return _publish(df.sparkSession, path, df.schema, name)


def insert_into_new(spark: SparkSession, name: str, schema: T.StructType, parts: Iterable[DataFrame]) -> DataFrame:
    """``CREATE TABLE`` with a declared schema, then one ``INSERT INTO`` per
    part; the name points at the table when all of them are in."""
    path = table_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(path)
    for part in parts:
        part.select(*schema.fieldNames()).to(schema).write.mode("append").parquet(path)
    return _publish(spark, path, schema, name)


def stored(df: DataFrame, name: str, again: bool = False) -> DataFrame:
    """``df`` as a stored table that knows its inputs. Beside it lies a manifest of the files that ``df`` reads
    (paths, sizes, times of change) and of its columns; while that holds the table is read as it is, in this
    session or a later one, else (or ``again``) it is written anew. The manifest is replaced when the new run is
    complete. The run before stays for readers that have begun; those before it are removed."""
    spark = df.sparkSession
    sources = files.describe(spark, df.inputFiles())
    folders = sorted({path.rpartition("/")[0] for path, *_ in sources})
    root = f"{shared_dir(spark)}/stored/{name}-{hashlib.sha256(json.dumps(folders).encode()).hexdigest()[:16]}"
    manifest, want = f"{root}/manifest.json", {"sources": sources, "schema": df.schema.json()}
    held = json.loads(files.get(spark, manifest)) if files.exists(spark, manifest) else {}
    if again or any(held.get(k) != v for k, v in want.items()) or not files.exists(spark, f"{root}/{held['run']}"):
        run = f"run-{uuid.uuid4().hex}"
        df.write.parquet(f"{root}/{run}")
        files.put(spark, manifest, json.dumps(want | {"run": run}), replace=True)
        for old in files.names_in(spark, root):
            if old.startswith("run-") and old not in (run, held.get("run")):
                files.remove(spark, f"{root}/{old}")
        held = {"run": run}
    return _publish(spark, f"{root}/{held['run']}", df.schema, name)


class NumberedTable:
    """A stored table with an identity column: ids 1, 2, ... over all inserts, each insert's in its order.

    An insert writes its rows dealt by range of the order, with their place in the file's task, to a folder of
    its own, then counts them per task. Its log entry claims the next ids: it is a file whose name is the next
    number, which only one writer can bring into being; a writer that comes second takes the number after, and
    with it the ids after. What has no entry is not read, so an insert that fails leaves neither rows nor a gap.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, id_col: str = "id"):
        self.spark, self.path, self.schema, self.id_col = spark, path, schema, id_col
        files.make_folder(spark, f"{path}/log")

    def _entries(self) -> list[dict]:
        """The inserts so far, in order; one small file each."""
        names = files.names_in(self.spark, f"{self.path}/log")
        return [json.loads(files.get(self.spark, f"{self.path}/log/{n}")) for n in names if n.isdigit()]

    def insert(self, df: DataFrame, order: Sequence[str]) -> tuple[int, int]:
        """Appends ``df`` in the order of the columns; returns the first and last of its ids."""
        columns = [f for f in self.schema if f.name != self.id_col]
        batch = uuid.uuid4().hex
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*[c.name for c in columns]).to(
            T.StructType(columns))
        place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        rows.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")).write.parquet(
            f"{self.path}/rows/batch={batch}")
        written = self.spark.read.schema("_part int").parquet(f"{self.path}/rows/batch={batch}")
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per writing task
        counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
        counts.select("_part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).write.parquet(
            f"{self.path}/parts/batch={batch}")
        n = self.spark.read.parquet(f"{self.path}/parts/batch={batch}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        while True:
            entries = self._entries()
            last = entries[-1]["first"] + entries[-1]["rows"] - 1 if entries else 0
            entry = json.dumps({"first": last + 1, "rows": n, "batch": batch})
            if files.put(self.spark, f"{self.path}/log/{len(entries):012d}", entry):
                return last + 1, last + n

    def read(self) -> DataFrame:
        entries = [(e["batch"], e["first"]) for e in self._entries() if e["rows"]]
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        batches = [b for b, _ in entries]
        first = self.spark.createDataFrame(entries, "batch string, first long")  # a row per insert
        starts = self.spark.read.schema("_part int, before long, batch string").parquet(f"{self.path}/parts").join(
            first, "batch").select("batch", "_part", (F.col("first") + F.col("before")).alias("_start"))
        columns = T.StructType([f for f in self.schema if f.name != self.id_col])
        schema = columns.add("_part", T.IntegerType()).add("_place", T.LongType()).add("batch", T.StringType())
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/rows").filter(F.col("batch").isin(batches))
        numbered = rows.join(starts, ["batch", "_part"]).withColumn(self.id_col, F.col("_start") + F.col("_place"))
        return numbered.select(*self.schema.fieldNames())


def register_views(spark: SparkSession, sf_dir: str, cache: bool = False) -> list[str]:
    """Register every canonical view (``v_*``) and the cleaned tables as
    session temp views, so questions can also be asked with ``spark.sql``.

    ``createOrReplaceTempView`` replaces on rerun (the temp-table idiom);
    ``cache=True`` caches the cleaned tables, which most jobs read.
    """
    from bizlens.plans import cleaning
    from bizlens.sources import bindings as b

    names = []
    for attr in dir(b):
        if attr.startswith("v_"):
            getattr(b, attr)(spark, sf_dir).createOrReplaceTempView(attr)
            names.append(attr)
    cleaned = {
        "clean_orders": cleaning.clean_orders(b.v_orders_raw(spark, sf_dir)),
        "clean_deliveries": cleaning.clean_deliveries(b.v_deliveries_raw(spark, sf_dir)),
        "clean_weekly_sales": cleaning.clean_weekly_sales(b.v_weekly_sales_raw(spark, sf_dir)),
    }
    for name, df in cleaned.items():
        (df.cache() if cache else df).createOrReplaceTempView(name)
        names.append(name)
    return names
