"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, and
    a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that no later step reads."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps: it acts
    once the driver's garbage collector has dropped their last references."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim_memory() -> None:
    """Hand what earlier tasks freed back to the system: Spark reuses its Python
    workers, and the C library keeps the freed memory of the largest task in each."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def per_batch(fn: Callable) -> Callable:
    """A ``mapInArrow`` body that applies ``fn(pyarrow.RecordBatch)`` to slices
    of at most ``SLICE_BYTES`` (one row at least), so that memory follows the
    slice and not the Arrow batch."""

    def body(batches: Iterator) -> Iterator:
        trim_memory()
        batch = part = out = None
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
        del batch, part, out
        trim_memory()

    return body


SLICE_BYTES = 4 << 20


def slices(batch, limit: int = SLICE_BYTES) -> Iterator:
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            size += np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    part = (np.cumsum(size) - size) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def utf8(column) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def crc_fold(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` of the rows (all, if there are no more), chosen by a
    digest of their key: the same rows on every run, and for either size."""
    share, n = 1 << 30, rows.count()
    return rows.where(F.pmod(F.xxhash64(key), F.lit(share)) < (share if n <= limit else share * limit // n))
