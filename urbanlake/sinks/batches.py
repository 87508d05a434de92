"""Restartable append (B1, B2): each batch enters a table exactly once.

A batch is written to a hidden folder beside the table's files, marked as
complete, and then moved in, file by file under names that carry the batch.
What a killed run has left behind is known from the marks:

* no mark: the hidden folder is written again from the start;
* ``<batch>.written``: the files are complete, those still there are moved;
* ``<batch>.done``: the batch is in the table, nothing is written.

So a run may be repeated after any failure, as long as one writer works on a
table at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files, write_table

BATCH = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*")


def append_batch(spark: SparkSession, make: Callable[[], DataFrame], path: str, batch: str, partition_by: list[str] | None = None) -> bool:
    """Append the rows of ``make()`` to the Parquet table ``path`` as ``batch``
    (letters, digits, dots and dashes).  False if it had been appended before;
    ``make`` is called only if the rows have to be written."""
    if not BATCH.fullmatch(batch):
        raise ValueError(f"not a batch name: {batch!r}")
    marks, hidden = f"{path}/_batches/{batch}", f"{path}/_incoming/{batch}"
    if files.exists(spark, f"{marks}.done"):
        return False
    if not files.exists(spark, f"{marks}.written"):
        write_table(make(), hidden, partition_by=partition_by)
        files.touch(spark, f"{marks}.written")
    for name in files.data_files(spark, hidden):
        folder, _, file = name.rpartition("/")
        files.move(spark, f"{hidden}/{name}", "/".join([path, *([folder] if folder else []), f"batch-{batch}+{file}"]))
    files.touch(spark, f"{marks}.done")
    files.delete(spark, hidden)
    return True


def batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that are in the table."""
    folder = f"{path}/_batches"
    names = files.data_files(spark, folder)
    return sorted(n.removesuffix(".done") for n in names if n.endswith(".done"))


def read_batch(spark: SparkSession, path: str, batch: str, like: DataFrame) -> DataFrame:
    """The rows of one batch of a table; ``like`` has its schema."""
    mine = [f"{path}/{n}" for n in files.data_files(spark, path) if n.rpartition("/")[2].startswith(f"batch-{batch}+")]
    if not mine:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).option("basePath", path).parquet(*mine).select(*[F.col(f"`{c}`") for c in like.columns])
