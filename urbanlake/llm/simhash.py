"""SimHash near-dedup: tiled exact comparison of 64-bit fingerprints.

Fingerprints are reduced to the distinct ones before anything is compared, so
copies cost nothing.  Distinct fingerprints are dealt into tiles by population
count; two fingerprints within the radius differ by at most the radius in
population count, so only tile pairs that close are compared, with numpy
exclusive-or and bit counts.  Inside a tile pair, sub-tiles ordered by the
population counts of the four 16-bit words are skipped by the same bound.
A tile pair emits a spanning forest of its links rather than all pairs, which
keeps every component whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import per_batch, utf8, written
from urbanlake.llm.components import components

SEED = 42
#: Fingerprints in a tile, which bounds what one task holds.
TILE_ROWS = 1 << 17
SUB_ROWS = 512


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text: majority bits over the XXH64 of its word shingles,
    repeats included; zero without words."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        b = min(n, a + (1 << 16))
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[a:b].tolist(), last[a:b].tolist())], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, content: bool = False
) -> DataFrame:
    """(id, fp) for every row; null, empty and wordless texts have fingerprint 0.
    ``content`` adds a digest of the text."""
    more = [F.xxhash64(text_col).alias("content")] if content else []

    def body(batch):
        import numpy as np
        import pyarrow as pa

        fps = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=["id", "fp", *batch.schema.names[2:]])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *more)
    return rows.mapInArrow(per_batch(body), "id long, fp long" + ", content long" * content)


def _words(fps):
    import numpy as np

    return np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _ordered(fps):
    """Fingerprints ordered by the population counts of their words, with the
    least and greatest counts of each sub-tile."""
    import numpy as np

    counts = _words(fps)
    order = np.lexsort(counts.T[::-1])
    fps, counts = fps[order], counts[order]
    cuts = np.arange(0, len(fps), SUB_ROWS)
    return fps, np.minimum.reduceat(counts, cuts), np.maximum.reduceat(counts, cuts)


def _forest(rows, cols, a, b):
    """Links of one sub-tile pair, reduced to (member, label) when they are many."""
    import numpy as np

    if len(rows) <= 2 * (len(a) + len(b)):
        return a[rows], b[cols]
    labels = np.concatenate((a, b))
    i, j = rows, cols + len(a)
    while True:
        low = np.minimum(labels[i], labels[j])
        new = labels.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == labels).all():
            break
        labels = new
    ends = np.concatenate((a, b))
    moved = ends != labels
    return ends[moved], labels[moved]


def linked(a, b, radius: int, same: bool):
    """Links (as two arrays of fingerprints) between two sets of distinct
    fingerprints at ``radius`` or fewer differing bits, as spanning forests of
    sub-tile pairs.  ``same``: both are one tile."""
    import numpy as np

    a, low_a, high_a = _ordered(a)
    b, low_b, high_b = (a, low_a, high_a) if same else _ordered(b)
    left, right = [], []
    for i in range(len(low_a)):
        gap = np.maximum(np.maximum(low_b - high_a[i], low_a[i] - high_b), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        x = a[i * SUB_ROWS : (i + 1) * SUB_ROWS]
        for j in near[near >= i] if same else near:
            y = b[j * SUB_ROWS : (j + 1) * SUB_ROWS]
            hit = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            if same and i == j:
                hit &= np.tri(len(x), len(y), -1, dtype=bool).T
            rows, cols = np.nonzero(hit)
            if len(rows):
                u, v = _forest(rows, cols, x, y)
                left.append(u)
                right.append(v)
    empty = np.empty(0, np.uint64)
    return np.concatenate(left or [empty]), np.concatenate(right or [empty])


def _tile(pop: Column, part: Column) -> Column:
    """A tile's number."""
    return pop.cast("long") * (1 << 32) + part


def links(distinct: DataFrame, radius: int = 4, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``) that keep
    every component of the full link graph connected."""
    spark = distinct.sparkSession
    distinct = distinct.select("fp", F.bit_count("fp").alias("pop"))
    # 65 rows at most, whatever the input
    sizes = {r["pop"]: r["n"] for r in distinct.groupBy("pop").agg(F.count("*").alias("n")).collect()}
    parts = {p: -(-n // tile_rows) for p, n in sizes.items()}
    if not parts:
        return spark.createDataFrame([], "u long, v long")
    per_pop = F.create_map(*[F.lit(x) for p, n in sorted(parts.items()) for x in (p, n)])
    tiled = distinct.withColumn("part", F.pmod(F.xxhash64("fp"), per_pop[F.col("pop")]).cast("int"))
    # A fingerprint goes to every tile pair of its own tile: pairs of tiles, not of rows.
    other = F.explode(F.filter(F.sequence(F.col("pop") - radius, F.col("pop") + radius), lambda p: per_pop[p].isNotNull()))
    pairs = tiled.withColumn("pop2", other).withColumn(
        "part2", F.explode(F.sequence(F.lit(0), (per_pop[F.col("pop2")] - 1).cast("int")))
    )
    mine, theirs = _tile(F.col("pop"), F.col("part")), _tile(F.col("pop2"), F.col("part2"))
    pairs = pairs.select(
        F.least(mine, theirs).alias("x"), F.greatest(mine, theirs).alias("y"), (mine <= theirs).alias("first"), "fp"
    )

    def compare(pdf):
        import numpy as np
        import pandas as pd

        fps, first = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["first"].to_numpy(bool)
        same = pdf["x"].iloc[0] == pdf["y"].iloc[0]
        if same or (first.any() and not first.all()):
            u, v = linked(fps[first], fps[~first], radius, same)
        else:
            u = v = np.empty(0, np.uint64)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return pairs.groupBy("x", "y").applyInPandas(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    tile_rows: int = TILE_ROWS,
    groups: bool = False,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits) and component_id,
    the smallest id reachable over links of ``radius`` or fewer differing bits.

    Null, empty and wordless texts share fingerprint 0 and link like any other.
    Repeated rows stay repeated.  Rows with a null id keep their row; they take
    the component of their text, which is null if no row of it has an id.  An
    empty table gives an empty result.  Other columns are not read.

    ``groups`` adds a digest of the text (content) and the group (component),
    since groups that share a repeated id may have the same smallest one.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle, groups), "simhash-fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("rep"))
    parts = components(links(distinct.select("fp"), radius, tile_rows), "u", "v")
    placed = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    # both sides of the join are written, so plainly shuffled: a large component can be split
    placed = written(placed, "simhash-placed")
    smallest = written(placed.groupBy("component").agg(F.min("rep").alias("component_id")), "simhash-smallest")
    named = placed.join(smallest, "component").select("fp", "component_id", *(["component"] if groups else [])).checkpoint()
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        *(["content", "component"] if groups else []),
    )
