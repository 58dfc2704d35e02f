"""Small files and folders of any store that Spark reaches, through its file system interface."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some paths that exist; nothing else is listed."""
    return [p for p in paths if (lambda at, store: store.exists(at))(*_at(spark, p))]


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    at, store = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(at)) if store.exists(at) else []


def written(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder and the time, in epoch-ms, at which each was last written."""
    at, store = _at(spark, folder)
    return {s.getPath().getName(): s.getModificationTime() for s in store.listStatus(at)} if store.exists(at) else {}


def read_text(spark: SparkSession, path: str) -> str:
    at, store = _at(spark, path)
    stream = store.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file whole or not at all; FileExistsError if there is one by that name."""
    at, store = _at(spark, path)
    own, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = store.create(own, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    kept = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(own, at, kept)
    except Py4JJavaError as failed:
        store.delete(own, False)
        if store.exists(at):
            raise FileExistsError(path) from failed
        raise


def write(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file in place of any by that name."""
    at, store = _at(spark, path)
    stream = store.create(at, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    at, store = _at(spark, path)
    store.delete(at, True)


def until_exit(spark: SparkSession, folder: str) -> str:
    """Makes a folder that is removed when the application ends."""
    at, store = _at(spark, folder)
    store.mkdirs(at)
    store.deleteOnExit(at)
    return folder
