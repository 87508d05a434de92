"""Safe publish of a report to a relational database.

The reference creates each remote table and loads a file into it, so a load
that fails half-way leaves half a table, and a second run doubles it.  Here a
report is loaded into a side table that is made from the declared column types,
its rows are counted against the report's, and only then the tables are
swapped in one transaction.  Readers see the old report or the new one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from . import write_jdbc


def quoted(name: str) -> str:
    """A standard SQL identifier; a dot inside belongs to the name."""
    return '"' + name.replace('"', '""') + '"'


def statements(table: str, headers: Mapping[str, str], types: Mapping[str, str]) -> dict[str, list[str]]:
    """The statements of each step for the report ``table``, whose columns are
    ``types`` (name: declared type) under ``headers`` (name: column header)."""
    side, old = f"{table}__next", f"{table}__old"
    columns = ", ".join(f"{quoted(headers.get(c, c))} {t.upper()}" for c, t in types.items())
    return {
        "prepare": [f"DROP TABLE IF EXISTS {quoted(side)}", f"CREATE TABLE {quoted(side)} ({columns})"],
        "count": [f"SELECT COUNT(*) FROM {quoted(side)}"],
        "swap": [
            f"DROP TABLE IF EXISTS {quoted(old)}",
            f"ALTER TABLE IF EXISTS {quoted(table)} RENAME TO {quoted(old)}",
            f"ALTER TABLE {quoted(side)} RENAME TO {quoted(table)}",
            f"DROP TABLE IF EXISTS {quoted(old)}",
        ],
    }


class Database:
    """One JDBC connection of the driver for the statements; the rows go over
    connections of the executors (``sinks.write_jdbc``)."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str] | None = None):
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in (properties or {}).items():
            props.setProperty(k, v)
        self.connection = jvm.java.sql.DriverManager.getConnection(url, props)

    def run(self, sql: list[str]) -> None:
        """All statements in one transaction."""
        c = self.connection
        c.setAutoCommit(False)
        statement = c.createStatement()
        try:
            for s in sql:
                statement.execute(s)
            c.commit()
        except Exception:
            c.rollback()
            raise
        finally:
            statement.close()

    def number(self, sql: str) -> int:
        statement = self.connection.createStatement()
        try:
            rows = statement.executeQuery(sql)
            rows.next()
            return rows.getLong(1)
        finally:
            statement.close()

    def close(self) -> None:
        self.connection.close()


def publish(
    df: DataFrame,
    url: str,
    table: str,
    headers: Mapping[str, str],
    types: Mapping[str, str],
    properties: Mapping[str, str] | None = None,
    num_partitions: int = 8,
    connect: Callable[[], Database] | None = None,
    load: Callable[..., None] = write_jdbc,
) -> int:
    """Replace ``table`` by the rows of ``df``, a written report; returns their
    number.  Raises, and leaves the table as it was, if the side table does not
    hold as many rows.  ``connect`` and ``load`` stand in for the database."""
    steps, n = statements(table, headers, types), df.count()
    database = connect() if connect else Database(df.sparkSession, url, properties)
    try:
        database.run(steps["prepare"])
        load(df, url, quoted(f"{table}__next"), mode="append", properties=dict(properties or {}), num_partitions=num_partitions, headers=headers)
        loaded = database.number(steps["count"][0])
        if loaded != n:
            raise RuntimeError(f"{table}: {loaded} of {n} rows were loaded; the table was not replaced")
        database.run(steps["swap"])
    finally:
        database.close()
    return n
