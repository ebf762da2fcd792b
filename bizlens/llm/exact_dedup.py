"""Exact dedup against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by the
SHA-256 of the text. A batch of new digests is reduced to one row per digest
(partial aggregation: a text with a third of all rows costs one row per map
task), then anti-joined with the index by sort-merge; the index side is read as
it lies. What is new is appended. :meth:`DigestIndex.open` reads an index that
an earlier session wrote.

Of equal texts the row with the largest doc_id stays, so a table is ingested
from its large ids down: the first batch holds the upper part of the ids.

Defined results: null text counts as the empty text; a null doc_id counts as
smaller than every id (in a group without any id keep_id is null, and the first
row as stored is kept); repeated (doc_id, text) rows are all kept when their id stays; an
empty table gives an empty result; other columns are left aside.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm import staging


@dataclass
class DigestIndex:
    """A bucketed, sorted table (digest binary, keep_id bigint)."""

    spark: SparkSession
    table: str
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int) -> DigestIndex:
        """The index at ``path``, made with ``buckets`` buckets if nothing is there. One that is there keeps
        its own number, which lies beside it: a digest is only found in the bucket it was written to."""
        beside = f"{path}.buckets"
        try:
            buckets = spark.read.schema("buckets int").parquet(beside).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            try:
                spark.read.schema("digest binary").parquet(path)
            except AnalysisException:
                spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(beside)
            else:
                raise ValueError(f"{path} has no number of buckets beside it ({beside})") from e
        table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {table} (digest BINARY, keep_id BIGINT) USING parquet OPTIONS (path '{path}') "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS")
        return cls(spark, table, path, buckets)

    def read(self) -> DataFrame:
        return self.spark.read.table(self.table)

    def add(self, batch: DataFrame) -> None:
        """Appends the digests of ``batch`` (digest, doc_id) that the index lacks."""
        # written, else the anti-join is pushed below the aggregation and moves every row of a hot digest
        new = staging.staged(batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "batch")
        fresh = new.join(self.read().hint("merge").select("digest"), "digest", "left_anti")
        (fresh.select("digest", "keep_id").repartition(self.buckets, "digest").write.mode("append")
         .format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)


def digests(docs: DataFrame) -> DataFrame:
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"))


def dedup(docs: DataFrame, index_path: str | None = None, batches: int = 2) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    ``batches`` is the number of doc_id ranges the table is ingested in, upper
    range first. Without ``index_path`` a new index is made for the run.
    """
    spark = docs.sparkSession
    rows = staging.staged(digests(docs).withColumn("row", F.monotonically_increasing_id()), "digests")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = DigestIndex.open(spark, index_path or staging.run_path(spark, "digest-index"),
                             staging.shuffle_partitions(spark))
    step = 0 if low is None else (high - low) // batches + 1
    for b in range(batches if step else 0):
        top = high - b * step
        index.add(rows.filter(F.col("doc_id").between(top - step + 1, top)))
    index.add(rows.filter("doc_id IS NULL"))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min("row").alias("first"))
    # written, so that the join below shuffles both sides plainly and Spark can split the rows of a hot text
    groups = staging.staged(sizes.join(index.read().hint("merge"), "digest"), "groups")
    stays = F.when(F.col("keep_id").isNull(), F.col("row") == F.col("first")).otherwise(
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)))
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
