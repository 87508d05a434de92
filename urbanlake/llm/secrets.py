"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text.
The ledger (Parquet segments in a shared folder) keeps, for each blob, the
rule versions that have been run over it and their raw hits.  A scan reads
only blobs with an unseen rule version, each distinct blob once, and appends a
segment; findings are then joined back to all paths that carry the blob.

Match positions: a text split at a pattern gives the gaps, the extracted
matches fill them, and the running sum of both lengths is each match's place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``least``: length that group ``group`` of a match needs; shorter matches
    are dropped after the leftmost, non-overlapping matches are found."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base kinds, in the order in which they are listed.  The
#: long s and the Kelvin sign are other cases of s and k.
BASE = (
    Rule(
        "assign", 2,
        r"""((?i:pa[sſ]{2}word|pa[sſ]{2}wd|[sſ]ecret|to[kK]en|api_?[kK]ey))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),  # a run of 16 or more is a run that is not dropped
)
RULES = (*BASE, Rule("pem", 1, r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", 0, 1))

#: Findings list the BEGIN line ("pem"); where texts are masked, the key itself
#: has to go too: from a BEGIN line to the END line that is the next such line.
KEY, KEY_END = "key", "key_end"
MASKED = (
    *RULES,
    Rule(KEY, 2, r"-----BEGIN [A-Z0-9 ]{0,32}PRIVATE KEY(?: BLOCK)?-----"),
    Rule(KEY_END, 1, r"-----END [A-Z0-9 ]{0,32}PRIVATE KEY(?: BLOCK)?-----"),
)

FOUND = "array<struct<rule:string,hits:array<struct<gap:int,len:int,key:int>>>>"


def _hits(text: Column, rule: Rule) -> Column:
    """Gap before, length and tested length of each raw match."""
    pattern = F.lit(rule.pattern)
    lengths = lambda column: F.transform(column, lambda x: F.length(x))
    return F.transform(
        F.arrays_zip(
            lengths(F.split(text, rule.pattern, -1)).alias("gap"),
            lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("len"),
            lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("key"),
        ),
        lambda x: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), x["key"].alias("key")),
    )


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class BlobLedger:
    """Scan results by blob and rule version under ``path`` (shared storage)."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.path, self.rules = spark, path, rules

    def records(self) -> DataFrame:
        """(blob, found): raw hits by rule version; empty before the first scan."""
        try:
            return self.spark.read.schema(f"blob string, found {FOUND}").parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"blob string, found {FOUND}")

    def scan(self, versions: DataFrame, text_col: str = "text") -> None:
        """Run every rule version over each blob of ``versions`` that has not
        seen it, and append the results.  Texts whose blob has seen all rules
        are left out before texts are shuffled."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        texts = versions.select(blob_id(text).alias("blob"), text.alias("text"))
        every = F.array(*[F.lit(r.name) for r in self.rules])
        records = self.records()
        if records.isEmpty():
            todo = texts.groupBy("blob").agg(F.any_value("text").alias("text")).withColumn("todo", every)
        else:
            done = records.join(texts.select("blob").distinct(), "blob", "left_semi").select("blob", F.explode("found.rule").alias("rule"))
            done = done.groupBy("blob").agg(F.collect_set("rule").alias("done"))
            full = done.where(F.size(F.array_except(every, "done")) == 0).select("blob")
            blobs = texts.join(full, "blob", "left_anti").groupBy("blob").agg(F.any_value("text").alias("text"))
            left = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
            todo = blobs.join(done, "blob", "left").withColumn("todo", left)
        unseen = todo.where(F.size("todo") > 0)
        found = F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.when(F.array_contains("todo", r.name), _hits(F.col("text"), r)).alias("hits"),
                )
                for r in self.rules
            ]
        )
        ran = F.filter(found, lambda x: x["hits"].isNotNull())
        # split always leaves a last gap without a match
        ran = F.transform(ran, lambda x: F.struct(x["rule"].alias("rule"), F.filter(x["hits"], lambda h: h["len"].isNotNull()).alias("hits")))
        unseen.select("blob", ran.cast(FOUND).alias("found")).write.mode("append").parquet(self.path)

    def findings(self, blobs: DataFrame | None = None) -> DataFrame:
        """(blob, kind, place, start, end): matches that pass, of the current
        rule versions, in ``blobs`` (a column blob) or all; ``place`` is the
        kind's position in the rule list.  A blob that two scans have read at
        once counts once."""
        rules = self.spark.createDataFrame(
            [(r.name, r.kind, i, r.least) for i, r in enumerate(self.rules)], "rule string, kind string, place int, least int"
        )
        records = self.records() if blobs is None else self.records().join(blobs, "blob", "left_semi")
        raw = records.select("blob", F.explode("found").alias("f")).where(F.size("f.hits") > 0)
        raw = raw.select("blob", "f.rule", "f.hits").dropDuplicates(["blob", "rule"])
        raw = raw.select("blob", "rule", F.posexplode("hits").alias("nth", "hit"))
        upto = Window.partitionBy("blob", "rule").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(F.col("hit.gap") + F.col("hit.len")).over(upto)
        return (
            raw.select("blob", "rule", "hit", end.cast("long").alias("end"))
            .join(F.broadcast(rules), "rule")  # as many rows as there are rules
            .where(F.col("hit.key") >= F.col("least"))
            .select("blob", "kind", "place", (F.col("end") - F.col("hit.len")).alias("start"), "end")
        )


def scan_texts(docs: DataFrame, ledger: BlobLedger, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: the ``carry`` columns and ``found``, an array of
    (start, place, kind, end) in order, in code points, end exclusive; empty
    without findings.

    Null counts as the empty text, copies and repeated rows share one scan and
    all get its findings, an empty table gives an empty result, and columns
    that are not carried are not read.
    """
    ledger.scan(docs, text_col)
    per_blob = (
        ledger.findings(docs.select(blob_id(F.col(text_col)).alias("blob")).distinct())
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", "place", "kind", "end"))).alias("found"))
        .checkpoint()
    )
    rows = docs.select(blob_id(F.col(text_col)).alias("blob"), F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"))
    empty = F.array().cast(per_blob.schema["found"].dataType)
    return rows.join(per_blob, "blob", "left").select("row.*", F.coalesce("found", empty).alias("found"))


def spans(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def masked_ranges(found: Column) -> Column:
    """array<struct<start,end>> of what is to be masked: every finding, a key
    from its BEGIN to its END line (the BEGIN line alone, if another one or
    none comes next), an END line without a BEGIN not at all."""
    marks = F.filter(found, lambda x: x["kind"].isin(KEY, KEY_END))
    zipped = F.arrays_zip(marks.alias("mark"), F.slice(marks, F.lit(2), F.greatest(F.size(marks), F.lit(1))).alias("next"))
    keys = F.transform(
        F.filter(zipped, lambda z: z["mark"]["kind"] == KEY),
        lambda z: F.struct(
            z["mark"]["start"].alias("start"),
            F.when(z["next"]["kind"] == KEY_END, z["next"]["end"]).otherwise(z["mark"]["end"]).alias("end"),
        ),
    )
    plain = F.filter(found, lambda x: ~x["kind"].isin(KEY, KEY_END))
    return F.concat(F.transform(plain, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))), keys)


#: Code points of a text's chunks, from which the gaps between masks are cut.
CHUNK = 1024


def redact(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every found range replaced; ranges that overlap or touch
    become one mask.  Time grows with the text and its findings: the sorted
    starts and ends tell the gaps (with k ranges begun, a gap follows where the
    k-th smallest end is before the next start), and each gap is cut out of the
    few chunks that hold it."""
    ranges = masked_ranges(found)
    long = F.lit(0).cast("bigint")
    # bound once as a lambda's variable, so that no gap evaluates them again
    bound = F.struct(
        F.sort_array(F.transform(ranges, lambda x: x["start"])).alias("starts"),
        F.sort_array(F.transform(ranges, lambda x: x["end"])).alias("ends"),
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"),
        F.length(text).cast("bigint").alias("n"),
    )

    def gaps(b: Column) -> Column:
        zipped = F.arrays_zip(F.concat(F.array(long), b["ends"]).alias("a"), F.concat(b["starts"], F.array(b["n"])).alias("b"))
        return F.filter(zipped, lambda z, i: (i == 0) | (i == F.size(b["starts"])) | (z["a"] < z["b"]))

    def cut(chunks: Column, z: Column) -> Column:
        first, last = F.floor(z["a"] / CHUNK).cast("int"), F.floor(z["b"] / CHUNK).cast("int")
        some = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
        return some.substr((z["a"] - first * CHUNK + 1).cast("int"), (z["b"] - z["a"]).cast("int"))

    def join(v: Column) -> Column:
        return F.array_join(F.transform(v["gaps"], lambda z: cut(v["chunks"], z)), mask)

    with_gaps = F.transform(F.array(bound), lambda b: F.struct(gaps(b).alias("gaps"), b["chunks"].alias("chunks")))
    return F.when((F.size(ranges) > 0) & text.isNotNull(), F.transform(with_gaps, join)[0]).otherwise(text)
