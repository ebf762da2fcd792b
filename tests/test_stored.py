"""Stored tables: those that know their inputs, and those with ids over many inserts."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens import catalog
from bizlens.plans import orders
from bizlens.session import shared_dir, table_path
from bizlens.sources import files, sinks
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])


def batch(spark, ks):
    return spark.createDataFrame([(k, f"n{k}") for k in ks], "k long, name string").repartition(3)


def new_table(spark):
    return sinks.NumberedTable(spark, table_path(spark, "numbered-test"), SCHEMA)


def test_ids_go_on_over_inserts(spark):
    table = new_table(spark)
    assert table.read().count() == 0 and table.read().columns == ["id", "k", "name"]
    assert table.insert(batch(spark, [30, 10, 20]), ["k"]) == (1, 3)
    assert table.insert(batch(spark, []), ["k"]) == (4, 3)
    assert table.insert(batch(spark, range(100, 140)), ["k"]) == (4, 43)
    again = sinks.NumberedTable(spark, table.path, SCHEMA)  # as another session would open it
    assert again.insert(batch(spark, [5]), ["k"]) == (44, 44)
    want = [10, 20, 30, *range(100, 140), 5]
    assert [(r.id, r.k, r.name) for r in again.read().orderBy("id").collect()] == [(i + 1, k, f"n{k}") for i, k in enumerate(want)]


def test_a_failing_insert_leaves_nothing(spark):
    table = new_table(spark)
    table.insert(batch(spark, [1, 2]), ["k"])
    with pytest.raises(Exception):
        table.insert(batch(spark, [3, 4]).withColumn("name", F.when(F.col("k") == 4, F.raise_error(F.lit("no"))).otherwise("x")), ["k"])
    with pytest.raises(Exception):
        table.insert(batch(spark, [3]).drop("name"), ["k"])
    assert table.insert(batch(spark, [7]), ["k"]) == (3, 3)
    assert rows(table.read(), "id", "k") == [(1, 1), (2, 2), (3, 7)]


def test_inserts_at_the_same_time(spark):
    table = new_table(spark)
    threads = [threading.Thread(target=lambda n=n: sinks.NumberedTable(spark, table.path, SCHEMA).insert(
        batch(spark, range(100 * n, 100 * n + n)), ["k"])) for n in range(1, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = table.read().collect()
    assert sorted(r.id for r in got) == list(range(1, 16))
    assert all(sorted(r.id for r in got if r.k // 100 == n)[-1] - min(r.id for r in got if r.k // 100 == n) == n - 1 for n in range(1, 6))


def test_only_one_writer_makes_a_file(spark):
    path = f"{shared_dir(spark)}/files-test/{dt.datetime.now().timestamp()}"
    assert files.put(spark, path, "é one") and not files.put(spark, path, "two")
    assert files.get(spark, path) == "é one"
    assert files.put(spark, path, "three", replace=True) and files.get(spark, path) == "three"
    assert [n for n in files.names_in(spark, path.rpartition("/")[0]) if n.startswith(".") and not n.endswith(".crc")] == []


def test_ratings_are_numbered_over_two_inserts(spark):
    out = catalog.queries()["ratings_table"](spark, "/root/testdata/sf0.001")
    got = out.orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, len(got) + 1)) and len(got) > 100
    assert [r.order_id for r in got] == sorted(r.order_id for r in got)
    assert out.schema == orders.RATING_SCHEMA


def test_a_stored_table_follows_its_sources(spark, tmp_path):
    source = str(tmp_path / "source")

    def table(again=False):
        df = spark.read.parquet(source).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        return sinks.stored(df, "stored_test", again)

    def runs(df):
        return {p.rpartition("/")[0] for p in df.inputFiles()}

    spark.range(100).selectExpr("id % 3 AS k").write.parquet(source)
    first = table()
    assert rows(first) == [(0, 34), (1, 33), (2, 33)] and runs(table()) == runs(first)  # read as it is
    spark.range(50).selectExpr("id % 2 AS k").write.mode("overwrite").parquet(source)
    second = table()
    assert rows(second) == [(0, 25), (1, 25)] and runs(second) != runs(first) and runs(table()) == runs(second)
    assert first.count() == 3  # one that has begun with the run before can end
    spark.range(1).selectExpr("bigint(7) AS k").write.mode("append").parquet(source)
    third = table()
    assert rows(third) == [(0, 25), (1, 25), (7, 1)]
    root = next(iter(runs(third))).rpartition("/")[0]
    assert len([n for n in files.names_in(spark, root) if n.startswith("run-")]) == 2  # older runs are gone
    assert runs(table(again=True)) != runs(third)
    wider = spark.read.parquet(source).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("one"))
    assert sinks.stored(wider, "stored_test").columns == ["k", "n", "one"]


def test_weekly_sales_are_not_stale(spark, tmp_path):
    """lineitem is cut in one session: the jobs on the stored weekly sales see it."""
    sf = "/root/testdata/sf0.001"
    for name in ("orders", "customer", "nation", "region", "lineitem"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    job = catalog.queries()["transactions_by_year"]
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert job(spark, str(tmp_path)).agg(F.sum("total_transactions")).first()[0] == n
    spark.read.parquet(f"{sf}/lineitem.parquet").limit(100).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert job(spark, str(tmp_path)).agg(F.sum("total_transactions")).first()[0] == 100
