"""Existence tests and clean-up on whatever file system a path belongs to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _handle(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _handle(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _handle(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _handle(spark, path)
    fs.mkdirs(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, where = _handle(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with this text, in place of an earlier one."""
    fs, where = _handle(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _handle(spark, path)
    source = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move ``source`` to where ``target`` was."""
    fs, src = _handle(spark, source)
    _, dst = _handle(spark, target)
    fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative paths of the partition folders ``depth`` levels down."""
    fs, _ = _handle(spark, path)
    found = [""]
    for _ in range(depth):
        found = [
            f"{parent}/{child.getPath().getName()}" for parent in found
            for child in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(path + parent))
            if child.isDirectory() and "=" in child.getPath().getName()
        ]
    return found


#: Folder value of a missing partition value, and the characters Spark escapes in one (fixed values).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = frozenset(map(chr, [*range(1, 32), 127])) | frozenset("\"#%'*/:=?\\{[]^")


def folder_of(cols: tuple[str, ...], values: tuple) -> str:
    """Relative folder of a partition, as Spark names it."""
    def name(value) -> str:
        text = NO_VALUE if value is None or str(value) == "" else str(value)
        return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)

    return "".join(f"/{c}={name(v)}" for c, v in zip(cols, values))


def values_of(folder: str) -> tuple:
    """Partition values (text, None where missing) of a relative folder."""
    def value(text: str):
        return None if text == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)

    return tuple(value(part.split("=", 1)[1]) for part in folder.strip("/").split("/"))


def is_table(spark: SparkSession, path: str) -> bool:
    """A finished columnar write, or a partitioned table with any file in it."""
    fs, where = _handle(spark, path)
    return fs.exists(where) and fs.getContentSummary(where).getFileCount() > 0


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's own, else a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="clickmill-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Inventory of a folder: path, size and modification time, contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(path).select("path", "length", "modificationTime")
    )
