import random
import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from llm.edges import documents, edge_texts, prose
from urbanlake.llm import packing
from urbanlake.llm.tokens import tokenizer_json

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_and_places(spark):
    texts = edge_texts() + [prose(s, 30 + 37 * s) for s in range(40)] + ["<|endoftext|> IT'S ok", prose(5, 2047), prose(6, 9000)]
    ids = [None, *range(1, len(texts) - 1), 1]
    rows = packing.pack(documents(spark, texts, ids).repartition(5), tokenizer_json(PATH), with_ids=True).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want, total = [], 0
    for doc, text in zip(ids, texts):
        stream = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(stream)
        for k, at in enumerate(range(0, len(stream), 2048)):
            cut = stream[at : at + 2048]
            want.append((str(doc), k, at, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    sequences = {}
    for r in rows:
        assert zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids)) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in map(sorted, sequences.values()):
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 2048
    assert len(sequences) <= -(-total // 2048) + 1


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), tokenizer_json(PATH)).count() == 0


def test_fill_is_the_fullest_combination():
    rng = random.Random(4)
    for _ in range(200):
        room = rng.randint(1, 60)
        available = sorted(((n, rng.randint(1, 4)) for n in rng.sample(range(1, 40), rng.randint(1, 7))), reverse=True)
        sums = {0}
        for n, copies in available:
            sums = {s + n * k for s in sums for k in range(copies + 1) if s + n * k <= room}
        got = packing.fill(room, available)
        assert sum(n * k for n, k in got) == max(sums)
        assert all(k <= dict(available)[n] for n, k in got)


def test_plan_uses_every_piece_once_and_does_not_follow_the_corpus():
    rng = random.Random(9)
    counts = {n: rng.randint(1, 5000) for n in rng.sample(range(1, 2049), 600)}
    bins = packing.plan(counts)
    used = {}
    for times, chosen in bins:
        assert sum(n * k for n, k in chosen) <= 2048
        for n, k in chosen:
            used[n] = used.get(n, 0) + times * k
    assert used == counts
    # no two pieces of over half a bin fit together
    least = max(-(-sum(n * k for n, k in counts.items()) // 2048), sum(k for n, k in counts.items() if n > 1024))
    assert sum(t for t, _ in bins) <= 1.01 * least + 1
    assert len(packing.plan({n: 1000 * k for n, k in counts.items()})) < 4 * len(bins)
