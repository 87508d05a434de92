"""Corpus pipeline: every stage calls one operator of ``urbanlake.llm`` over all
rows that the stage before it kept, and its decisions take effect.

Null and empty texts pass every filter stage like any other text; an empty
table passes through as an empty table with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import packing, secrets, simhash, suffix_dedup, toxicity
from urbanlake.llm.common import table, written
from urbanlake.llm.queries import WORD_BPE, tokenizer
from urbanlake.session import shared_dir


def _whole_rows(docs: DataFrame) -> DataFrame:
    """(doc, text): the row as a struct, so that no column of it can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")


def _with_text(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The documents of ``rows`` with the new text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar predicts as toxic go.  It is trained
    on the labelled rows of the documents given."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_whole_rows(docs), model).where("score < 0.5").select("doc.*")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the
    group's smallest id, whatever other groups that id occurs in; a row without
    an id only if no row of the group has one.  Of repeated rows one stays."""
    groups = simhash.near_duplicates(docs, shingle=4, radius=4, groups=True)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")
    keep = groups.groupBy("component").agg(F.min(place).alias("kept")).select("kept.*")
    named = _whole_rows(docs).withColumns({"doc_id": F.col("doc")["doc_id"].cast("long"), "content": F.xxhash64("text")})
    same = named["doc_id"].eqNullSafe(keep["doc_id"]) & (named["content"] == keep["content"])
    return named.join(keep, same, "left_semi").dropDuplicates(["doc_id", "content"]).select("doc.*")


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that occur elsewhere too are cut out of the
    texts; a character cut in two goes whole.  Documents stay, even if empty."""
    cut = suffix_dedup.cut_repeats(_whole_rows(docs), size=200, carry=("doc",))
    return _with_text(cut, docs.columns, F.when(F.col("doc.text").isNotNull(), F.col("kept_text")))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Secrets are masked in the texts, private keys from their BEGIN to their
    END line (the BEGIN line alone if there is no END); documents stay.
    ``ledger``: folder of a ledger that is kept from run to run, so that only
    texts it does not know are scanned; None is a new one."""
    kept = secrets.BlobLedger(spark, ledger or shared_dir(spark, "secret-ledger"), secrets.MASKED)
    found = secrets.scan_texts(_whole_rows(docs), kept, carry=("doc",))
    return _with_text(found, docs.columns, secrets.redact(F.col("doc.text"), F.col("found")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer(WORD_BPE))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Scoring, fingerprints, tokenizers and packing are beyond SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again.
    ``ledger`` is the secret scans' (see ``secrets_stage``)."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        more = {"ledger": ledger} if stage is secrets_stage else {}
        docs = written(stage(spark, docs, sf_dir, **more), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
