"""Operators, including the branches the testdata never reaches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bizlens.functions.text import null_markers, strip_units
from bizlens.operators.aggregate import ordered_join, percentile_disc
from bizlens.operators.joins import point_in_interval_join
from bizlens.operators.ranking import first_by, rank_by_value, rows_at_extreme
from tests.conftest import rows

T = dt.datetime


@pytest.mark.parametrize("threshold", ["10MB", "-1"])  # broadcast, then shuffle join
def test_point_in_interval_overlap(spark, threshold):
    facts = spark.createDataFrame([(1, T(2024, 1, 1, 10)), (2, T(2024, 1, 2, 12)), (3, T(2024, 2, 1))],
                                  "id int, ts timestamp_ntz")
    iv = spark.createDataFrame([("x", T(2024, 1, 1), T(2024, 1, 2, 12)), ("y", T(2024, 1, 2), T(2024, 1, 3)),
                                ("open", T(2024, 2, 1), T(9999, 12, 31)), ("before", T(1, 1, 1), T(2023, 12, 31))],
                               "name string, s timestamp_ntz, e timestamp_ntz")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = point_in_interval_join(facts, "ts", iv, "s", "e", "left")
        assert rows(out, "id", "name") == [(1, "x"), (2, "x"), (2, "y"), (3, "open")]
        assert point_in_interval_join(facts.filter("id > 9"), "ts", iv, "s", "e", "left").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_text_helpers(spark):
    df = spark.createDataFrame([("23.4 km",), ("20km",), ("null",), ("",), (None,)], "d string")
    got = [r[0] for r in df.select(null_markers(strip_units("d", ["km"]))).collect()]
    assert got == ["23.4 ", "20", None, None, None]


def test_percentile_disc_matches_definition(spark):
    df = spark.createDataFrame([(g, v) for g in (0, 1) for v in range(1, 11 + g)], "g int, v int")
    got = {r.g: (r.p50, r.p80, r.p95) for r in percentile_disc(df, ["g"], "v", None,
                                                                {"p50": 0.5, "p80": 0.8, "p95": 0.95}).collect()}
    assert got == {0: (5, 8, 10), 1: (6, 9, 11)}


def test_ranks_keep_ties_and_multiplicity(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 5, "w")],
                               "k string, d int, p string")
    assert rows(rows_at_extreme(df, ["k"], "d", "min")) == [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"),
                                                          ("b", 5, "w")]
    assert rows(rank_by_value(df, ["k"], "d", "r"), "k", "d", "p", "r") == [
        ("a", 1, "x", 1), ("a", 1, "x", 1), ("a", 1, "y", 1), ("a", 2, "z", 4), ("b", 5, "w", 1)]
    assert rows(first_by(df, ["k"], ["d", "p"])) == [("a", 1, "x"), ("b", 5, "w")]


def test_ordered_join(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, None), (2, 1, None)], "g int, o int, v string")
    got = dict(rows(df.groupBy("g").agg(ordered_join(F.col("v"), F.col("o")).alias("s"))))
    assert got == {1: "a, c", 2: None}


def test_a_row_repeated_a_million_times(spark):
    """No operator builds the copies of a row in one task."""
    one = spark.range(1_000_000, numPartitions=8).select(F.lit("a").alias("k"), F.lit(1).alias("d"))
    df = one.unionByName(spark.createDataFrame([("a", 2), ("b", 3)], "k string, d int"))
    assert rows_at_extreme(df, ["k"], "d", "min").groupBy("k").count().orderBy("k").collect() == [("a", 1_000_000), ("b", 1)]
    ranked = rank_by_value(df, ["k"], "d", "r").groupBy("k", "r").count().orderBy("k", "r").collect()
    assert ranked == [("a", 1, 1_000_000), ("a", 1_000_001, 1), ("b", 1, 1)]


def test_stored_tables_do_not_touch_each_other(spark):
    from bizlens.sources import sinks

    first = sinks.materialise(spark.range(3).toDF("id"), "twice")
    second = sinks.materialise(spark.range(5).toDF("id"), "twice")
    assert (first.count(), second.count(), spark.table("twice").count()) == (3, 5, 5)
    with pytest.raises(Exception):
        sinks.materialise(spark.range(2).select(F.raise_error(F.lit("no")).alias("id")), "twice")
    assert spark.table("twice").count() == 5  # a failed run leaves the name where it was


def test_dense_ids_are_checked(spark):
    from bizlens.operators.ids import check_dense_id

    check_dense_id(spark.range(1, 6))
    check_dense_id(spark.range(0))
    with pytest.raises(ValueError):
        check_dense_id(spark.range(0, 5))
    with pytest.raises(ValueError):
        check_dense_id(spark.createDataFrame([(1,), (1,), (3,)], "id long"))


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from bizlens import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    fake = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(RuntimeError):
        session.shared_dir(fake)
