"""Parallel CSV read against Spark's own one-task reader."""

import os
import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from urbanlake.sources import csv_blocks as cb
from urbanlake.sources import landing as ld

SCHEMA = StructType([StructField("a", StringType()), StructField("n", IntegerType()), StructField("d", DateType()), StructField("b", StringType())])
OPTIONS = ld.csv_options("MM/dd/yyyy")


@contextmanager
def conf(spark, **values):
    names = {"block": "spark.sql.files.maxPartitionBytes", "batch": "spark.sql.execution.arrow.maxRecordsPerBatch", "open": "spark.sql.files.openCostInBytes"}
    old = {names[k]: spark.conf.get(names[k]) for k in values}
    for k, v in values.items():
        spark.conf.set(names[k], str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def write(folder, **files):
    path = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(path, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(path, f"{name}.csv"), "w", newline="") as f:
            f.write(text)
    return folder


def body(rng, n):
    def field():
        return rng.choice(["plain", "", '""', 'q ""x"" y'.join('""'), '"line\nbreak, here\n\nmore"', '"' + "\n".join("z" * rng.randrange(9) for _ in range(rng.randrange(14))) + '"', '"tail "', "ünï"])

    return 'a,"n\nx",d,b\n' + "".join(f"{field()},{i},{f'01/0{1 + i % 9}/2024' if i % 3 else ''},{field()}\n" for i in range(n))


def one_task(spark, path):
    return Counter(map(tuple, spark.read.schema(SCHEMA).options(**OPTIONS).csv(path).collect()))


def in_blocks(spark, path):
    return Counter(map(tuple, cb.read_csv_blocks(spark, path, SCHEMA, OPTIONS).collect()))


@pytest.mark.parametrize("seed", range(8))
def test_equals_the_one_task_reader(spark, scratch, seed):
    rng = random.Random(seed)
    texts = {f"f{k}": body(rng, rng.choice([0, 1, 6, 50])) for k in range(2)}
    if seed % 4 == 1:
        texts = {k: t.rstrip("\n") for k, t in texts.items()}
    if seed % 4 == 2:
        texts = {k: t.replace("\n", "\r\n") for k, t in texts.items()}
    path = write(scratch("blocks"), **texts)
    with conf(spark, block=rng.choice([16, 40, 100, 1 << 20]), batch=rng.choice([1, 3, 10000]), open=1):
        assert in_blocks(spark, path) == one_task(spark, path)


def test_a_record_over_many_blocks(spark, scratch):
    long = '"' + "\n".join(f"line {i}" for i in range(200)) + '"'
    path = write(scratch("blocks"), f=f"a,n,d,b\nx,1,,y\n{long},2,,{long}\nz,3,,\n")
    with conf(spark, block=64, open=1, batch=2):
        df = cb.read_csv_blocks(spark, path, SCHEMA, OPTIONS)
        assert df.rdd.getNumPartitions() > 20
        rows = sorted(df.collect(), key=lambda r: r.n)
    assert [r.n for r in rows] == [1, 2, 3] and rows[1].a == rows[1].b == long.strip('"')


def test_large_quoted_file_lands_in_several_tasks(spark, scratch):
    path = write(scratch("blocks"), f="a,n,d,b\n" + "".join(f'"two\nlines {i}",{i},01/02/2024,"say ""x"""\n' for i in range(20_000)))
    with conf(spark, block=100_000, open=1):
        df = cb.read_csv_blocks(spark, path, SCHEMA, OPTIONS)
        assert df.rdd.getNumPartitions() >= 6
        assert Counter(map(tuple, df.collect())) == one_task(spark, path)


@pytest.mark.parametrize("row", ["x,notanumber,,y", "x,1,,y,one too many", "x,1", "x,1,2024-13-77,y"])
def test_a_malformed_row_fails_the_job(spark, scratch, row):
    path = write(scratch("blocks"), f=f'a,n,d,b\n"two\nlines",1,,y\n{row}\n"a\nb",2,,\n')
    with pytest.raises(Exception):
        one_task(spark, path)
    with conf(spark, block=16, open=1), pytest.raises(Exception):
        in_blocks(spark, path)


def test_an_unclosed_quote_fails(spark, scratch):
    path = write(scratch("blocks"), f='a,n,d,b\nx,1,,"never ends\ny,2,,z\n')
    with pytest.raises(ValueError, match="inside a quoted field"):
        in_blocks(spark, path)


def test_other_blocks_than_scanned_are_noticed(spark, scratch):
    path = write(scratch("blocks"), f=body(random.Random(3), 40))
    with conf(spark, block=1 << 20):
        df = cb.read_records(spark, path)
    with conf(spark, block=64, open=1), pytest.raises(Exception, match="changed while they were read"):
        df.collect()


def test_empty_files_and_headers_alone(spark, scratch):
    assert in_blocks(spark, write(scratch("blocks"), f="", g="a,n,d,b\n", h='"a\nb",n,d,b')) == Counter()


def test_landing_reads_quoted_newlines_in_several_tasks(spark, scratch):
    header = "the_geom,objectid,zip,shape_area,shape_len"
    path = write(scratch("blocks"), f=header + "\n" + "".join(f'"MULTIPOLYGON (((0 0,\n 1 0, 1 1, 0 0)))",{i},{i},0.5,\n' for i in range(3000)))
    with conf(spark, block=20_000, open=1):
        df = ld.read_csv(spark, path, "boundaries_zip")
        assert df.rdd.getNumPartitions() >= 4
        whole = ld.read_csv(spark, path, "boundaries_zip", multi_line=True)
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, whole.collect()))
        assert ld.load(spark, path, "boundaries_zip").selectExpr("size(geom[0]) AS n").distinct().collect()[0].n == 4
