"""Folders and small files of whatever file system a path is on."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it does not exist."""
    files, target = files_of(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(target)] if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    files, target = files_of(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, target = files_of(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file appear, whole, unless there is one of that name; False if there is.

    It is written beside and renamed without replacing. The file system does that in one step,
    so of several writers one succeeds.
    """
    jvm, files = spark._jvm, files_of(spark, path)[0]
    parent, name = path.rsplit("/", 1)
    target, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{parent}/.{uuid.uuid4().hex}-{name}")
    files.mkdirs(jvm.org.apache.hadoop.fs.Path(parent))
    stream = files.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    nothing = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(beside), files.makeQualified(target), nothing)
    except Py4JJavaError as error:
        files.delete(beside, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True
