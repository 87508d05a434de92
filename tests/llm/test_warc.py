import gzip
import hashlib
import io

import pytest

from urbanlake.llm import warc
from urbanlake.session import shared_dir

BIG, SMALL = "<p>" + "long page " * 30 + "</p>", "<p>short</p>"
ROWS = [
    (5, "http://a/", BIG), (3, "http://b/", BIG), (9, None, BIG), (None, "http://n/", BIG),
    (1, "http://c/", SMALL), (2, "http://d/", SMALL), (4, "http://e/\r\nX: y", None), (6, "", ""),
    (7, "http://f/", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 20), (8, "http://g/", "x" * 99), (10, "http://h/", "x" * 99),
    (11, "http://i/", "y" * 100), (11, "http://i/", "y" * 100), (12, "http://j/", "🙂" * 40000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id long, url string, html string, digest string, row string")


def test_round_trip(spark):
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS), path, file_records=7)
    rows = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(rows) == len(ROWS)
    first = {BIG: 3, "y" * 100: 11}
    want = []
    for page, _, html in ROWS:
        payload = (html or "").encode()
        origin = first.get(html)
        back = origin if origin not in (None, page) else None
        want.append((str(page), len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if back else "response", str(back)))
    got = [(str(r.response.page_id), r.response.payload_bytes, r.response.payload_digest, r.response.type, str(r.response.refers_to)) for r in rows]
    assert sorted(got) == sorted(want)
    for r in rows:
        assert [x.concurrent_to for x in (*r.requests, *r.metadata)] == [r.capture] * 2
        assert r.response.intact
        assert r.response.target_uri is None or "\n" not in r.response.target_uri
        if r.response.type == "response":
            assert hashlib.sha256(bytes(r.response.block).partition(b"\r\n\r\n")[2]).hexdigest() == r.response.payload_digest


def test_blocks_can_be_left_out_and_empty_table(spark):
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS[:2]), path)
    assert all(r.block is None for r in warc.read_records(spark, path, blocks=False).collect())
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, []), path)
    assert warc.assemble(warc.read_records(spark, path)).count() == 0


def test_lone_records_and_damage(spark):
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS[:3]), path)
    records = warc.read_records(spark, path)
    orphans = warc.assemble(records.where("type <> 'response' AND type <> 'revisit'")).collect()
    assert all(r.response is None and len(r.requests) == len(r.metadata) == 1 for r in orphans) and len(orphans) == 3
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(b"HTTP/1.1 200 OK\r\n\r\n")))


def test_files_are_bounded_by_bytes(spark):
    """Very long pages among small ones: they share no file, and the others keep within the bound."""
    rows = [(i, None, "s" * 40 + str(i)) for i in range(60)] + [(100 + i, None, chr(97 + i) * 40_000) for i in range(20)]
    rows += [(200, None, "long " * 2_000_000), (201, None, "🙂" * 1_500_000), (202, None, "long " * 2_000_000)]
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, rows).coalesce(1), path, file_bytes=1 << 20, date="2020-02-02T02:02:02Z")
    held: dict = {}
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content").collect():
        content = gzip.decompress(bytes(r.content))
        assert not content or b"WARC-Date: 2020-02-02T02:02:02Z" in content
        held[r.path] = [int(h["x-page-id"]) for h, _ in warc.parse(io.BytesIO(content)) if h["warc-type"] != "request" and h["warc-type"] != "metadata"]
        assert len(content) < (1 << 20) + 4000 * len(held[r.path]) or len(held[r.path]) == 1
    assert sorted(i for ids in held.values() for i in ids) == [i for i, _, _ in rows]
    assert [200] in held.values() and [201] in held.values()  # 202 is a revisit, and short
    back = warc.assemble(warc.read_records(spark, path, blocks=False)).collect()
    want = sorted((i, len(t.encode()), hashlib.sha256(t.encode()).hexdigest()) for i, _, t in rows)
    assert sorted((r.response.page_id, r.response.payload_bytes, r.response.payload_digest) for r in back) == want


def test_clashing_columns_and_repeated_rows_keep_their_captures(spark):
    names = ("first", "bytes", "revisit", "level", "value", "n", "type", "capture")
    rows = [(1, "u", BIG), (1, "u", BIG), (2, "u", BIG), (2, "u", "y" * 300_000), (None, None, None)]
    table = pages(spark, rows).withColumns({n: warc.F.lit("x") for n in names})
    path = shared_dir(spark, "warc-test")
    warc.write_archives(table.repartition(3), path)
    got = warc.assemble(warc.read_records(spark, path, blocks=False)).collect()
    assert len(got) == len({r.capture for r in got}) == 5
    assert sorted((str(r.response.page_id), r.response.type, len(r.requests), len(r.metadata)) for r in got) == [
        ("1", "response", 1, 1), ("1", "response", 1, 1), ("2", "response", 1, 1), ("2", "revisit", 1, 1), ("None", "response", 1, 1)
    ]
