"""Folders of any file system that Spark reaches."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _folder(spark, path)
    return fs.exists(hadoop_path)


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path matches the glob ``pattern``."""
    fs, hadoop_path = _folder(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0


def create(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _folder(spark, path)
    fs.mkdirs(hadoop_path)


def discard(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _folder(spark, path)
    fs.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds; none where there is no such folder."""
    fs, hadoop_path = _folder(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _folder(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False if there is one of that name.

    It is written under another name and linked to its own by one rename that does not
    replace, so of two writers one gets the name and no reader sees half a file.
    """
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    fs, hadoop_path = _folder(spark, draft)
    stream = fs.create(hadoop_path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    named = jvm.org.apache.hadoop.fs.Path(path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark._sc._gateway.new_array(
        jvm.org.apache.hadoop.fs.Options.Rename, 0
    )
    try:
        files.rename(hadoop_path, named, options)
    except Py4JJavaError as error:
        fs.delete(hadoop_path, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True
