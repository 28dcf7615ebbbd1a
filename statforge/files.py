"""Paths on whatever file system the cluster uses (Hadoop's file system interface)."""

from __future__ import annotations

from pyspark.errors.exceptions.captured import UnsupportedOperationException
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as its object."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return bool(fs.exists(at))


def part_files(spark: SparkSession, folder: str) -> list:
    """The part files that a job wrote to ``folder``, in the order of their numbers."""
    fs, at = file_system(spark, folder)
    found = [s.getPath() for s in fs.listStatus(at) if s.isFile()]
    return sorted((p for p in found if p.getName().startswith("part-")), key=lambda p: p.getName())


def merge_parts(spark: SparkSession, folder: str, name: str = "part-00000.txt") -> None:
    """Join the part files of ``folder``, in their order, into one file (K3).

    A file system that can concatenate (HDFS) links the blocks of the parts, and no byte
    is moved. Others copy the parts one after the other through a small buffer. Either
    way the parts were written by as many tasks as there are, and none holds them all.
    """
    fs, at = file_system(spark, folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    parts = part_files(spark, folder)
    whole, target = path(at, "_merged"), path(at, name)
    if not parts:
        fs.create(target, True).close()
        return
    if len(parts) > 1 and not _linked(spark, fs, parts):
        _copied(spark, fs, parts, whole)
        for p in parts:
            fs.delete(p, False)
    else:
        fs.rename(parts[0], whole)
    fs.rename(whole, target)


def _linked(spark: SparkSession, fs, parts: list) -> bool:
    """Append all parts to the first one, if the file system can."""
    sc = spark.sparkContext
    rest = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for i, p in enumerate(parts[1:]):
        rest[i] = p
    try:
        fs.concat(parts[0], rest)
    except UnsupportedOperationException:
        return False
    return True


def _copied(spark: SparkSession, fs, parts: list, whole) -> None:
    io = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils
    out = fs.create(whole, True)
    try:
        for p in parts:
            source = fs.open(p)
            try:
                io.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
