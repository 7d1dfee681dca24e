"""Folders and small marker files beside the data, on whatever file system the table lives on.

Markers are a few bytes; they are written aside and renamed, so a reader sees the old one or the new one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    file, fs = _at(spark, path)
    return fs.exists(file)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The marker's text; None when there is none."""
    file, fs = _at(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a marker in one step."""
    file, fs = _at(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside = hadoop.Path(file.getParent(), f"_NEXT-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, file, how)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none when it does not exist."""
    file, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(file)) if fs.exists(file) else []


def partitions(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Value of each partition folder of a table, with the folder's name."""
    prefix = f"{column}="
    return {name.removeprefix(prefix): name for name in children(spark, path) if name.startswith(prefix)}


def delete(spark: SparkSession, path: str) -> None:
    file, fs = _at(spark, path)
    fs.delete(file, True)


def move(spark: SparkSession, folder: str, target: str) -> None:
    """Rename a folder to a place that is free."""
    source, fs = _at(spark, folder)
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {folder} to {target}")


def move_into(spark: SparkSession, folder: str, target: str) -> None:
    """Move the files of a folder into another one; names are unique, so a repeated move goes on where one stopped."""
    source, fs = _at(spark, folder)
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(place)
    for name in children(spark, folder):
        file = spark._jvm.org.apache.hadoop.fs.Path
        if name.startswith(("_", ".")):
            continue
        if not fs.rename(file(source, name), file(place, name)):
            raise OSError(f"cannot move {folder}/{name} to {target}")
    fs.delete(source, True)
