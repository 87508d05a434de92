"""File operations on shared storage, through the cluster's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths below ``path``, relative to it, of the files that readers see
    (no part of the path begins with ``_`` or ``.``)."""
    fs, p = _fs(spark, path)
    out, todo = [], [(p, "")]
    while todo:
        folder, at = todo.pop()
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            name = s.getPath().getName()
            if not name.startswith(("_", ".")):
                if s.isDirectory():
                    todo.append((s.getPath(), f"{at}{name}/"))
                else:
                    out.append(f"{at}{name}")
    return sorted(out)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; its folder is made if missing.  A target that is already
    there is the same file, moved before."""
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.exists(b) and not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    fs.create(p, True).close()
