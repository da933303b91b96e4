"""What lies in a folder of tables that grow by whole sub-folders."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The names of the folders and of the files in ``path``, hidden ones left out; none if it is absent."""
    at, files = _at(spark, path)
    if not files.exists(at):
        return [], []
    found = sorted((s.getPath().getName(), s.isDirectory()) for s in files.listStatus(at))
    shown = [(name, folder) for name, folder in found if name[0] not in "_."]
    return [n for n, folder in shown if folder], [n for n, folder in shown if not folder]


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is there whole or not at all; an error if there is one already."""
    at, files = _at(spark, path)
    draft, _ = _at(spark, f"{path.rpartition('/')[0]}/_draft-{path.rpartition('/')[2]}")
    out = files.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not files.rename(draft, at):
        raise FileExistsError(path)


def get(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    return spark.read.text(path, wholetext=True).first()[0]
