"""Exact top-k by inner product: ball-tree branch and bound per shard.

Each shard of vectors becomes one ball tree, kept as one packed row.  A block
of queries searches a tree best first: nodes are ordered by how far their
upper bound (query . centre + |query| * radius) exceeds the queries' current
kth scores, and a node is left out once no query can gain from it.  The kth
scores are shared: a first pass over one tree seeds them for all, and a task
carries them from tree to tree.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlake.llm.common import written

LEAF_ROWS = 64
SHARD_ROWS = 1 << 15
BLOCK_ROWS = 1 << 12


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component; null for vectors that are null or hold
    null or non-finite components."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _packed(**arrays) -> bytes:
    import numpy as np

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(blob: bytes) -> dict:
    import numpy as np

    return dict(np.load(io.BytesIO(blob)))


def _matrix(vectors: list) -> object:
    """Rows of equal width; missing components count as zero."""
    import numpy as np

    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def ball_tree(vectors, ids) -> dict:
    """Rows reordered so that each node is a range, halved at the median of
    its widest dimension; node i has centre, radius, range and first child."""
    import numpy as np

    order, nodes, at = np.arange(len(ids)), [(0, len(ids), -1)], 0
    centres, radii = [], []
    while at < len(nodes):
        a, b, _ = nodes[at]
        part = vectors[order[a:b]].astype(float)
        centre = part.mean(axis=0)
        centres.append(centre)
        radii.append(np.sqrt(((part - centre) ** 2).sum(axis=1)).max())
        if b - a > LEAF_ROWS:
            widest = int((part.max(axis=0) - part.min(axis=0)).argmax())
            order[a:b] = order[a:b][np.argsort(part[:, widest], kind="stable")]
            mid = (a + b) // 2
            nodes[at] = (a, b, len(nodes))
            nodes += [(a, mid, -1), (mid, b, -1)]
        at += 1
    small = vectors.astype(np.int16) if np.abs(vectors).max(initial=0) < 1 << 15 else vectors
    return {"vectors": small[order], "ids": ids[order], "nodes": np.array(nodes), "centres": np.array(centres), "radii": np.array(radii)}


def _widths(a, b):
    import numpy as np

    width = max(a.shape[1], b.shape[1])
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))), np.pad(b, ((0, 0), (0, width - b.shape[1])))


def _dot(a, b):
    """Exact integer inner products."""
    import numpy as np

    if len(a) == 0 or len(b) == 0 or a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 1 << 52:  # every partial sum is exact in float64
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def search(tree: dict, queries, own, kth, k: int):
    """Best k (score, id) of each query in the tree, padded with the least
    integer; only scores that reach ``kth`` are looked for.  ``own``: ids that
    are no candidates of their query."""
    import numpy as np

    least = np.iinfo(np.int64).min
    scores, ids = np.full((len(queries), k), least), np.full((len(queries), k), np.iinfo(np.int64).max)
    vectors, queries = _widths(tree["vectors"], queries)
    centres, _ = _widths(tree["centres"], queries)
    length = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    bounds = queries.astype(float) @ centres.T + length[:, None] * tree["radii"][None, :]
    bounds += 1e-6 * (1 + np.abs(bounds))  # never below the exact bound
    floor = np.maximum(kth, least)
    heap = [(0.0, 0)]
    while heap:
        _, node = heapq.heappop(heap)
        active = np.flatnonzero(bounds[:, node] >= np.maximum(floor, scores[:, -1]))
        if not len(active):
            continue
        a, b, child = tree["nodes"][node]
        if child >= 0:
            now = np.maximum(floor, scores[:, -1])[active].astype(float)
            for c in (int(child), int(child) + 1):
                gain = float((bounds[active, c] - now).max())
                if gain >= 0:
                    heapq.heappush(heap, (-gain, c))
            continue
        got = _dot(queries[active], vectors[a:b])
        names = np.broadcast_to(tree["ids"][a:b], got.shape)
        got = np.where(names == own[active][:, None], least, got)
        both = np.concatenate((scores[active], got), axis=1)
        who = np.concatenate((ids[active], names), axis=1)
        best = _order(both, who, k)
        scores[active] = np.take_along_axis(both, best, axis=1)
        ids[active] = np.take_along_axis(who, best, axis=1)
    return scores, ids


def _order(scores, ids, k: int):
    """Columns of the k best of each row: highest score, then smallest id."""
    import numpy as np

    return np.lexsort((ids, ~scores), axis=1)[:, :k]  # ~x = -x - 1 never overflows


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products
    of the floored vectors for each row of ``queries``, ties to the smaller id.

    ``queries`` has the same two columns; a row is no candidate of a query
    with its id.  Rows with a null id, and vectors that are null or hold null
    or non-finite components, take no part.  Vectors of different widths count
    missing components as zero.  Repeated rows are candidates each; equal
    query rows are answered once.  Fewer than ``k`` candidates give fewer rows;
    an empty table gives none.  Other columns are not read.
    """
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col)).alias("v")).where(
        "id IS NOT NULL AND v IS NOT NULL"
    )

    def grow(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        def tree(ids, rows):
            return pd.DataFrame({"tree": [_packed(**ball_tree(_matrix(rows), np.array(ids, np.int64)))]})

        ids, rows = [], []
        for frame in frames:
            ids += frame["id"].tolist()
            rows += frame["v"].tolist()
            while len(ids) >= shard_rows:
                yield tree(ids[:shard_rows], rows[:shard_rows])
                ids, rows = ids[shard_rows:], rows[shard_rows:]
        if ids:
            yield tree(ids, rows)

    trees = written(pick(vectors).mapInPandas(grow, "tree binary"), "topk-trees")
    # rows with one id and different vectors are different queries
    asked = written(pick(queries).distinct().withColumn("twin", F.xxhash64("v")), "topk-queries")
    blocks = max(1, -(-asked.count() // block_rows))

    def block(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        rows = pd.concat(list(frames) or [pd.DataFrame({"id": [], "v": [], "twin": []})])
        for a in range(0, len(rows), block_rows):
            part = rows.iloc[a : a + block_rows]
            ids = part["id"].to_numpy(np.int64)
            kth = np.full(len(ids), np.iinfo(np.int64).min)
            yield pd.DataFrame({"block": [_packed(ids=ids, twin=part["twin"].to_numpy(np.int64), vectors=_matrix(part["v"].tolist()), kth=kth)]})

    packed = asked.repartition(blocks).mapInPandas(block, "block binary")

    def seed(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for frame in frames:
            out = []
            for tree, blob in zip(frame["tree"], frame["block"]):
                q = _unpacked(blob)
                scores, _ = search(_unpacked(tree), q["vectors"], q["ids"], q["kth"], k)
                out.append(_packed(**{**q, "kth": np.maximum(q["kth"], scores[:, -1])}))
            yield pd.DataFrame({"block": out})

    # a stated query set in blocks, against all trees
    seeded = written(packed.crossJoin(trees.limit(1)).mapInPandas(seed, "block binary"), "topk-blocks")

    def find(frames: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pandas as pd

        shared: dict[bytes, object] = {}
        for frame in frames:
            for tree, blob in zip(frame["tree"], frame["block"]):
                q = _unpacked(blob)
                key = hashlib.sha1(blob).digest()
                kth = shared.get(key, q["kth"])
                scores, ids = search(_unpacked(tree), q["vectors"], q["ids"], kth, k)
                shared[key] = np.maximum(kth, scores[:, -1])
                row, col = np.nonzero((scores > np.iinfo(np.int64).min) & (scores >= kth[:, None]))
                if len(row):
                    yield pd.DataFrame(
                        {"query_id": q["ids"][row], "twin": q["twin"][row], "vec_id": ids[row, col], "score": scores[row, col]}
                    )

    found = trees.crossJoin(seeded).mapInPandas(find, "query_id long, twin long, vec_id long, score long")
    best = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
