"""Small files in the shared folder, through Hadoop's file systems: any store
that Spark reads, from the driver only."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def describe(spark: SparkSession, paths: Iterable[str]) -> list[list]:
    """[path, bytes, time of change] of each file, sorted."""
    out = []
    for path in sorted(paths):
        fs, p = _at(spark, path)
        status = fs.getFileStatus(p)
        out.append([path, status.getLen(), status.getModificationTime()])
    return out


def put(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Writes a file whole or not at all: it is written aside and renamed. Without ``replace`` only one writer
    can bring a file into being; False says that another one has."""
    fs, p = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{spark._jvm.java.util.UUID.randomUUID()}")
    out = fs.create(aside, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if replace else kinds.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(aside, p, options)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def get(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
