"""Registered queries of this package on the smallest tables: their schema, and
their oracle where SQL has one."""

from collections import Counter

import duckdb
import pytest

from urbanlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMAS = {
    "op1_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op3_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, ratio double, kept boolean",
    "op4_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op7_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op11_pieces": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op12_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13_resampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op10_langid": "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean",
}


def test_names():
    assert list(QUERIES) and set(QUERIES) == set(SCHEMAS) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_schema_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == SCHEMAS[name]
    rows = df.collect()
    table, column = {"op6_warc": ("pages", "page_id"), "op9_topk": ("embeddings", "vec_id"), "op12_whitening": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(column).collect()}
    if name == "op9_topk":
        ids = {i for i in ids if i % 50 == 0}
    assert {r[0] for r in rows} == ids
    if name in ORACLE:
        con = duckdb.connect()
        for name_ in (table, "benchmark"):
            con.execute(f"CREATE VIEW {name_} AS SELECT * FROM read_parquet('{SF}/{name_}.parquet')")
        cursor = con.execute(ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        want = Counter(tuple(r[names.index(c)] for c in df.columns) for r in cursor.fetchall())
        assert Counter(map(tuple, rows)) == want
