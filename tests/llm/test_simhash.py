import re

import numpy as np
import pytest
import xxhash

from llm.edges import documents, edge_texts, prose
from urbanlake.llm import simhash
from urbanlake.llm.components import components


def brute_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=4):
    parent = {i: i for i in range(len(ids))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(i)
    out = [None] * len(ids)
    for members in groups.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            out[m] = min(known) if known else None
    return out


@pytest.mark.parametrize("tile_rows", [7, simhash.TILE_ROWS])
def test_equals_brute_force(spark, tile_rows):
    base = [prose(s, 90) for s in range(20)]
    near = [b.replace("river", "stream", 1) for b in base] + [b + " more" for b in base]
    texts = edge_texts() + base + near + base[:3]
    ids = [*range(100, 100 + len(texts) - 3), 5, 5, None]
    got = simhash.near_duplicates(documents(spark, texts, ids), tile_rows=tile_rows).collect()
    prints = [brute_fingerprint(t) for t in texts]
    want = sorted(zip(map(str, ids), (f"{p:016x}" for p in prints), map(str, brute_components(ids, prints))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("same", [True, False])
def test_sub_tiles_keep_every_component(same):
    rng = np.random.RandomState(3)
    seeds = rng.randint(0, 1 << 62, 40).astype(np.uint64)
    flips = [np.uint64(1) << np.uint64(b) for b in rng.randint(0, 64, 1500)]
    prints = np.unique(np.concatenate((seeds, seeds[rng.randint(0, 40, 1500)] ^ np.array(flips, np.uint64))))
    a, b = (prints, prints) if same else (prints[::2], prints[1::2])
    u, v = simhash.linked(a, b, 4, same)
    assert (np.bitwise_count(u ^ v) <= 64).all()
    nodes = {int(x): i for i, x in enumerate(prints)}

    def parts(pairs):
        parent = list(range(len(prints)))

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, j in pairs:
            parent[find(i)] = find(j)
        return [find(i) for i in range(len(prints))]

    near = [(nodes[int(x)], nodes[int(y)]) for x in a for y in b[np.bitwise_count(b ^ x) <= 4]]
    one, two = parts(near), parts([(nodes[int(x)], nodes[int(y)]) for x, y in zip(u, v)])
    assert len({*zip(one, two)}) == len(set(one)) == len(set(two))


def test_components_of_chains_stars_and_self_links(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(got) == len({r.node for r in got})
    roots = {r.node: r.component for r in got}
    assert {roots[i] for i in range(1, 41)} == {1} and {roots[i] for i in range(100, 160)} == {100} and roots[201] == 200
