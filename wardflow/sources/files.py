"""Small files and folders on whatever file system Spark reads: pointers, listings, removal of what is no longer needed."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system it lies on."""
    fs, where = _located(spark, path)
    return fs.makeQualified(where).toString()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none where there is no such folder."""
    fs, where = _located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isFile()) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _located(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a file so that it is there as a whole or not at all. Without ``replace``, False where it exists already.

    The text goes to a hidden file first, which is then renamed; the rename is what takes effect.
    """
    fs, where = _located(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if replace else rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, where, options)
        return True
    except Exception as exc:
        fs.delete(hidden, False)
        if not replace and fs.exists(where):
            return False
        raise exc


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    fs, where = _located(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, where = _located(spark, path)
    if not fs.rename(where, _located(spark, to)[1]):
        raise OSError(f"{path} cannot be moved to {to}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _located(spark, path)
    fs.mkdirs(where)


def filled(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds anything but hidden files."""
    fs, where = _located(spark, folder)
    return fs.exists(where) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(where))


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _located(spark, path)
    return fs.exists(where)
