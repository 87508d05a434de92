"""Safe publish: the statements and their order, against a database in a dict."""

import re

import pytest

from urbanlake import schemas
from urbanlake.sinks import publish as pub

HEADERS, TYPES = schemas.REPORT_HEADERS["rpttbl04c"], schemas.report_types("rpttbl04c")


class Fake:
    """Tables of rows; understands the statements that are generated."""

    def __init__(self, tables, fail_at=None):
        self.tables, self.log, self.fail_at = tables, [], fail_at

    def run(self, sql):
        tables = dict(self.tables)
        for s in sql:
            self.log.append(s)
            if self.fail_at and self.fail_at in s:
                raise OSError("connection lost")
            names = [n.replace('""', '"') for n in re.findall(r'"((?:[^"]|"")*)"', s)]
            if s.startswith("CREATE TABLE"):
                assert names[0] not in tables
                tables[names[0]] = []
            elif s.startswith("DROP TABLE IF EXISTS"):
                tables.pop(names[0], None)
            elif "RENAME TO" in s:
                if "IF EXISTS" in s and names[0] not in tables:
                    continue
                assert names[1] not in tables
                tables[names[1]] = tables.pop(names[0])
            else:
                raise AssertionError(s)
        self.tables.clear()
        self.tables.update(tables)

    def number(self, sql):
        return len(self.tables[re.search(r'"(.*)"', sql)[1]])

    def close(self):
        self.log.append("closed")


def load_into(tables, lose=0):
    def load(df, url, table, mode, properties, num_partitions, headers):
        assert mode == "append" and headers == HEADERS
        rows = df.collect()
        tables[table.strip('"')] += rows[: len(rows) - lose]

    return load


def test_statements_come_from_the_declared_types():
    steps = pub.statements("SMZ.RPTTBL04C", HEADERS, TYPES)
    assert steps["prepare"] == [
        'DROP TABLE IF EXISTS "SMZ.RPTTBL04C__next"',
        'CREATE TABLE "SMZ.RPTTBL04C__next" ("Date" DATE, "ZIP" NUMERIC, "Total Trip Count" NUMERIC, "Forecasted Trip Count" INTEGER)',
    ]
    assert steps["count"] == ['SELECT COUNT(*) FROM "SMZ.RPTTBL04C__next"']
    assert steps["swap"][1:3] == ['ALTER TABLE IF EXISTS "SMZ.RPTTBL04C" RENAME TO "SMZ.RPTTBL04C__old"', 'ALTER TABLE "SMZ.RPTTBL04C__next" RENAME TO "SMZ.RPTTBL04C"']
    assert pub.quoted('a"b') == '"a""b"'


@pytest.mark.parametrize("report", sorted(schemas.REPORT_HEADERS))
def test_every_report_has_statements(report):
    made = pub.statements(report, schemas.REPORT_HEADERS[report], schemas.report_types(report))["prepare"][1]
    for column, header in schemas.REPORT_HEADERS[report].items():
        assert f'"{header}" {schemas.report_types(report)[column].upper()}' in made


def _publish(spark, tables, **kw):
    df = spark.range(7)
    fake = Fake(tables, kw.pop("fail_at", None))
    return fake, lambda: pub.publish(df, "jdbc:x", "r", HEADERS, TYPES, connect=lambda: fake, load=load_into(tables, **kw))


def test_a_table_is_replaced_or_made(spark):
    for tables in ({"r": ["old"]}, {}, {"r": ["old"], "r__next": ["left by a killed run"]}):
        fake, run = _publish(spark, tables)
        assert run() == 7 and sorted(tables) == ["r"] and len(tables["r"]) == 7
        assert fake.log[-1] == "closed"
        assert run() == 7 and len(tables["r"]) == 7  # again: not doubled


def test_a_short_load_or_a_failed_swap_leaves_the_old_table(spark):
    tables = {"r": ["old"]}
    fake, run = _publish(spark, tables, lose=1)
    with pytest.raises(RuntimeError, match="6 of 7"):
        run()
    assert tables["r"] == ["old"] and fake.log[-1] == "closed"
    fake, run = _publish(spark, tables, fail_at='ALTER TABLE "r__next"')
    with pytest.raises(OSError):
        run()
    assert tables["r"] == ["old"]


def test_without_a_driver_the_connection_fails(spark):
    with pytest.raises(Exception, match="No suitable driver"):
        pub.publish(spark.range(1), "jdbc:nowhere://h/db", "r", HEADERS, TYPES)
