"""Texts in blocks: a written table, bucketed by block, that an operator reads
several times and joins with what it learned about a block, without moving the
texts again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizlens.llm import staging

#: Bytes of a block, about: bounds the memory of a task, whatever the size of its partition.
BLOCK_BYTES = 8 << 20


def text_blocks(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """block, doc_id, text and ``rest``, a struct of the columns ``carry``."""
    spark = docs.sparkSession
    staging.ship_package(spark)
    rest = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), rest.alias("rest"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            sizes = np.append(0, np.cumsum([len(t) if t else 0 for t in batch.column("text").to_pylist()]))
            block = first + (held + sizes[:-1]) // BLOCK_BYTES
            held += int(sizes[-1])
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns], names=["block", *batch.schema.names])

    schema = T.StructType([T.StructField("block", T.LongType()), *rows.schema.fields])
    return staging.staged_buckets(rows.mapInArrow(number, schema), "text_blocks", "block",
                                  staging.shuffle_partitions(spark))


class Carried:
    """Takes a table apart into doc_id, text and the rest, whatever its columns
    are called, and puts changed texts back in place (``n_chars`` follows)."""

    def __init__(self, docs: DataFrame):
        self.schema, self.names = docs.schema, [f"_c{k}" for k in range(len(docs.columns))]
        self.place = dict(zip(docs.columns, self.names))
        self.rows = docs.toDF(*self.names).withColumns({
            "doc_id": F.col(self.place["doc_id"]), "text": F.col(self.place["text"]),
            "_null": F.col(self.place["text"]).isNull()})
        self.others = [n for c, n in self.place.items() if c not in ("doc_id", "text")]
        self.carry = [*self.others, "_null"]

    def put_back(self, changed: DataFrame, text: Column) -> DataFrame:
        """``changed`` has doc_id and rest; a null text stays null."""
        changed = changed.withColumn("_text", F.when(~F.col("rest._null"), text))
        columns = {c: F.col(f"rest.{n}") for c, n in self.place.items() if n in self.others}
        columns |= {"doc_id": F.col("doc_id").cast(self.schema["doc_id"].dataType), "text": F.col("_text")}
        if "n_chars" in columns:
            columns["n_chars"] = F.length("_text").cast(self.schema["n_chars"].dataType)
        return changed.select(*[columns[c].alias(c) for c in self.schema.names])
