"""Small tables with nulls, empty and long texts, repeated rows and columns
whose names clash with the operators' own."""

from pyspark.sql import DataFrame, SparkSession

CLASHING = ("row", "uid", "fp", "h", "tid", "spans", "score", "ids", "found", "blob", "length", "number", "kept", "n_bytes", "id", "k")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)

WORDS = "the old house by a river stands in green hills where two roads cross and people meet".split()


def prose(seed: int, n: int) -> str:
    x, out = seed, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + ("." if x % 11 == 0 else ""))
    return " ".join(out)


def documents(spark: SparkSession, texts: list, ids: list | None = None) -> DataFrame:
    ids = list(range(1, len(texts) + 1)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t) if t is not None else None, *["x"] * len(CLASHING)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_texts() -> list:
    twin = prose(7, 120)
    return [None, "", " \t\n", "a", "é", "🙂 héllo wörld", twin, twin, twin + " end", prose(8, 60), "x" * 3000, prose(9, 4000), "\n\n\nline\nline\n", None]
