"""Parallel read of CSV files whose quoted fields may hold line breaks.

Spark's ``multiLine`` reader takes each file in one task, because a block
cannot know whether it begins inside a quoted field.  Here the files are read
as physical lines, block by block:

1. One aggregate over the lines gives the parity of the quotes of every block.
   A running sum over the blocks of a file tells which blocks begin inside a
   quoted field: a line break counts as one in a field exactly when an odd
   number of quotes stands before it in the file, as ``COPY`` has it.
2. Each task joins the lines of its blocks to records.  Records within a block
   go straight on to the parser; no row is shuffled for them.
3. What a border cuts, at most two fragments a block, is read by a second pass
   over the lines (only if there is any), stitched and added.

The driver holds a few numbers per block (a block is
``spark.sql.files.maxPartitionBytes`` at most, so that is some 50 bytes in 128
MB), and one record must fit in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Kinds of rows of step 2: a whole record, the beginning of one (of the header), the rest of one.
WHOLE, BEGUN, HEADER_BEGUN, REST = 0, 1, 2, 3


@dataclass
class Blocks:
    """What the tasks need to know of the blocks, as sorted ids."""

    all: np.ndarray
    inside: np.ndarray  # begin inside a quoted field
    crlf: np.ndarray  # of files whose lines end in CR LF
    table: DataFrame  # of those inside: id, start, opener (the block that began the record)
    cut: bool  # whether a record crosses a border


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, id, path, start): the lines of all files with the block they
    begin in."""
    m = F.col("_metadata")
    place = (m["file_path"], m["file_block_start"], m["file_block_length"])
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64(*place).alias("id"), m["file_path"].alias("path"), m["file_block_start"].alias("start")
    )


def scan_blocks(lines: DataFrame) -> Blocks:
    """Step 1.  Raises if a file ends inside a quoted field."""
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    at = F.monotonically_increasing_id()
    per_block = (
        lines.select("id", "path", "start", odd.alias("odd"), at.alias("at"), F.endswith("value", F.lit("\r")).alias("cr"))
        .groupBy("id", "path", "start")
        .agg(
            F.sum(F.col("odd").cast("int")).alias("odds"),
            F.min(F.when(F.col("odd"), F.col("at"))).alias("first_odd"),
            F.max("at").alias("last"),
            F.min_by("cr", "at").alias("cr"),
        )
    )
    order = Window.partitionBy("path").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    found = per_block.withColumns(
        {
            "inside": F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1,
            "unclosed": F.sum("odds").over(whole) % 2 == 1,
            "crlf": F.first("cr").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    # a record begins in the block, unless all of it or all but its last line is inside a field
    begins = ~F.col("inside") | (F.col("first_odd") < F.col("last"))
    found = found.withColumn("opener", F.last(F.when(begins, F.col("id")), ignorenulls=True).over(before))
    rows = found.select("id", "start", "inside", "unclosed", "crlf", "opener").toArrow()
    ids, flag = np.asarray(rows["id"]), lambda name: np.asarray(rows[name]).astype(bool)
    if flag("unclosed").any():
        paths = [r.path for r in found.where("unclosed").select("path").distinct().limit(3).collect()]
        raise ValueError(f"a file ends inside a quoted field: {', '.join(paths)}")
    inside = np.sort(ids[flag("inside")])
    table = lines.sparkSession.createDataFrame(rows.filter(rows["inside"]).select(["id", "start", "opener"]))
    return Blocks(np.sort(ids), inside, np.sort(ids[flag("crlf")]), table, bool(len(inside)))


def _has(ids: np.ndarray, block: int) -> bool:
    k = int(np.searchsorted(ids, block))
    return k < len(ids) and int(ids[k]) == block


class _Block:
    """Joins the lines of one block, batch by batch."""

    def __init__(self, block: int, first: bool, blocks: tuple):
        known, inside, crlf = blocks
        if not _has(known, block):
            raise RuntimeError("the files or their blocks changed while they were read; set spark.sql.files.minPartitionNum to hold the blocks")
        self.id, self.header, self.crlf = block, first, _has(crlf, block)
        self.rest = self.open = _has(inside, block)
        self.held: list = []  # lines of the record that is open

    def add(self, values) -> list:
        """[(Arrow strings, kind)] of the records that end in ``values``."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.crlf:
            values = pc.replace_substring_regex(values, r"\r$", "")
        odd = np.asarray(pc.bit_wise_and(pc.count_substring(values, '"'), 1)).astype(bool)
        if self.held:
            odd, values = np.concatenate([[self.held_odd], odd]), pa.concat_arrays([pa.array(["\n".join(self.held)], values.type), values])
            self.held = []
            self.open = self.rest
        elif not self.open and not odd.any():
            return self._out(values)
        ended = (np.cumsum(odd) + self.open) % 2 == 0  # a record ends after these lines
        ends = np.flatnonzero(ended)
        cut = int(ends[-1]) + 1 if len(ends) else 0
        out = []
        if cut:
            offsets = pa.array(np.concatenate([[0], ends + 1]).astype(np.int32))
            out = self._out(pc.binary_join(pa.ListArray.from_arrays(offsets, values[:cut]), "\n"))
        if cut < len(values):
            # an open record has an odd number of quotes, the rest of one that another block began an even number
            self.held, self.held_odd = values[cut:].to_pylist(), not self.rest
            self.open = True
        else:
            self.open = False
        return out

    def _out(self, records) -> list:
        out = []
        if self.rest:
            out.append((records[:1], REST))
            self.rest, records = False, records[1:]
        if self.header and len(records):
            self.header, records = False, records[1:]
        return [*out, (records, WHOLE)]

    def end(self) -> list:
        import pyarrow as pa

        if not self.held:
            return []
        kind = REST if self.rest else HEADER_BEGUN if self.header else BEGUN
        return [(pa.array(["\n".join(self.held)]), kind)]


def joined(lines: DataFrame, blocks: Blocks, fragments: bool) -> DataFrame:
    """Step 2: whole records (record), or the fragments of cut ones (record, id, kind)."""
    known = (blocks.all, blocks.inside, blocks.crlf)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(block: int, found: list) -> Iterator:
            for records, kind in found:
                if len(records) and (kind != WHOLE) == fragments:
                    if not fragments:
                        yield pa.RecordBatch.from_arrays([records.cast(pa.string())], names=["record"])
                        continue
                    columns = [records.cast(pa.string()), pa.array([block] * len(records)), pa.array([kind] * len(records), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["record", "id", "kind"])

        now = None
        for batch in batches:
            ids = np.asarray(batch.column(1))
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is None or now.id != int(ids[a]):
                    if now is not None:
                        yield from rows(now.id, now.end())
                    now = _Block(int(ids[a]), batch.column(2)[a].as_py(), known)
                yield from rows(now.id, now.add(batch.column(0).slice(a, b - a)))
        if now is not None:
            yield from rows(now.id, now.end())

    schema = "record string, id long, kind int" if fragments else "record string"
    return lines.select("value", "id", (F.col("start") == 0).alias("first")).mapInArrow(run, schema)


def stitched(lines: DataFrame, blocks: Blocks) -> DataFrame:
    """Step 3: the records that cross a border, one row each."""
    parts = joined(lines, blocks, fragments=True)
    begun = F.col("kind").isin(BEGUN, HEADER_BEGUN)
    # the rest of a record goes to the block that began it; that part comes first
    keyed = parts.join(blocks.table, "id", "left").select(
        F.when(begun, F.col("id")).otherwise(F.col("opener")).alias("opener"),
        F.struct(F.when(begun, F.lit(-1)).otherwise(F.col("start")).alias("start"), "record").alias("part"),
        (F.col("kind") == HEADER_BEGUN).alias("header"),
    )
    whole = keyed.groupBy("opener").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.max("header").alias("header"))
    return whole.where(~F.col("header")).select(F.array_join(F.col("parts.record"), "\n").alias("record"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV record (``record``, its line breaks as LF) of the files
    under ``path``, without each file's header and empty lines.  Step 1 runs
    when this function is called; the rest is a lazy plan."""
    lines = physical_lines(spark, path)
    blocks = scan_blocks(lines)
    records = joined(lines, blocks, fragments=False)
    if blocks.cut:
        records = records.unionByName(stitched(lines, blocks))
    return records.where(F.col("record") != "")


def read_csv_blocks(spark: SparkSession, path: str, schema: StructType, options: dict[str, str]) -> DataFrame:
    """The files under ``path`` by ``schema``, as the ``multiLine`` reader with
    ``options`` gives them, in as many tasks as they have blocks.  A malformed
    record fails the job when ``mode`` is ``FAILFAST``."""
    opts = {k: v for k, v in options.items() if k not in ("header", "multiLine", "enforceSchema")}
    return read_records(spark, path).select(F.from_csv("record", schema.simpleString(), opts).alias("row")).select("row.*")
