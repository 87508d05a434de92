"""Sinks and the matching report re-load.

``mode`` follows ``DataFrameWriter``: ``ignore`` is the reference's
``CREATE TABLE IF NOT EXISTS … AS`` (skip when present), ``append`` its
``INSERT INTO`` re-runs, ``overwrite`` the default for idempotent jobs
(S21).  Paths should live on shared storage; nothing here collects rows to
the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType

from .. import schemas
from ..sources.landing import csv_options


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    compression: str | None = "zstd",
) -> str:
    """Write ``df`` as a table directory (B1 create-if-absent, B2 append).

    Parquet is written with zstd by default: smaller files than snappy, so
    every later scan of the zone reads fewer bytes.  ``partition_by`` deals
    the rows out by partition value first (a rebalance, so that a large
    partition still goes to several tasks and a small one to one file).
    ``mode="replace"`` overwrites only the partitions that ``df`` has rows
    for; without ``partition_by`` it is ``overwrite``.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode("overwrite" if mode == "replace" else mode).format(fmt)
    if mode == "replace" and partition_by:
        w = w.option("partitionOverwriteMode", "dynamic")
    if compression and fmt == "parquet":
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Full scan of a written table (A11); ``schema`` keeps the declared types
    of partition columns."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def _rename(df: DataFrame, headers: Mapping[str, str] | None) -> DataFrame:
    if not headers:
        return df
    return df.select(*[F.col(c).alias(headers.get(c, c)) for c in df.columns])


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    headers: Mapping[str, str] | None = None,
    date_format: str | None = None,
    order: Sequence[Column] = (),
) -> str:
    """CSV with a header line (B3): one directory, one part file per task.

    With ``order`` the rows are sorted across the part files: read in file
    name order, they are the report in its order.
    Quotes inside fields are doubled, so the file re-loads with the
    ``COPY``-compatible reader.  ``date_format`` renders date columns as
    text first (e.g. the trip file's ``MM/dd/yyyy hh:mm:ss a``).
    """
    if date_format:
        df = df.select(
            *[
                F.date_format(F.col(f.name), date_format).alias(f.name) if isinstance(f.dataType, DateType) else F.col(f.name)
                for f in df.schema.fields
            ]
        )
    opts = {k: v for k, v in csv_options().items() if k in ("header", "sep", "quote", "escape")}
    # The writer trims spaces by default; padded values (' CA ') must survive.
    opts.update(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    df = df.orderBy(*order) if order else df
    _rename(df, headers).write.mode(mode).options(**opts).csv(path)
    return path


def read_report_csv(spark: SparkSession, path: str, report: str) -> DataFrame:
    """Re-load a report CSV into its declared schema, by position (A10)."""
    return spark.read.schema(schemas.report_schema(report)).options(**csv_options()).csv(path)


def json_documents(
    df: DataFrame, headers: Mapping[str, str] | None = None, types: Mapping[str, str] | None = None
) -> DataFrame:
    """One JSON object per row, shaped like the reference's service output.

    Keys are the (renamed) column names in sorted order; NULL is kept as
    ``null``; dates become ``yyyy-MM-ddT00:00:00Z``.  ``types`` names the
    declared type of each column (``schemas.report_types``): ``numeric`` is
    text, because the database driver hands it over as text; ``bigint`` and
    ``integer`` stay numbers.  Without it decimals count as numeric.
    """
    named = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        elif (types or {}).get(f.name) == "numeric" or (not types and isinstance(f.dataType, DecimalType)):
            c = c.cast("string")
        named.append(((headers or {}).get(f.name, f.name), c))
    cols = [c.alias(name) for name, c in sorted(named, key=lambda nc: nc[0])]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def write_json(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    headers: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    order: Sequence[Column] = (),
) -> str:
    """JSON lines of ``json_documents`` (B5), sorted across files by ``order``."""
    df = df.orderBy(*order) if order else df
    json_documents(df, headers, types).write.mode(mode).text(path)
    return path


def jdbc_properties(
    headers: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
    num_partitions: int = 8,
) -> dict[str, str]:
    """Writer options of ``write_jdbc``: batched inserts over ``num_partitions``
    connections, and the declared column types for a table it has to create."""
    props = dict(properties or {})
    props.setdefault("batchsize", "10000")
    props.setdefault("numPartitions", str(num_partitions))
    if types:
        names = {c: (headers or {}).get(c, c) for c in types}
        props.setdefault("createTableColumnTypes", ", ".join(f"`{names[c]}` {t.upper()}" for c, t in types.items()))
    return props


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    num_partitions: int = 8,
    headers: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
) -> None:
    """Publish to a relational database (B4).  Needs the JDBC driver on the
    classpath; Spark itself narrows the write to ``numPartitions``."""
    props = jdbc_properties(headers, types, properties, num_partitions)
    _rename(df, headers).write.jdbc(url, table, mode=mode, properties=props)
