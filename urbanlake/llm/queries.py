"""Registered queries of this package: ``QUERIES`` and, where SQL can express
one, ``ORACLE``.  Each applies its operator to whole tables and derives the
returned digest columns from the operator's own output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import bpe, langid, packing, pieces, quality, resampling, secrets, simhash, suffix_dedup, topk, toxicity, warc, whitening
from urbanlake.llm.common import table
from urbanlake.llm.tokens import tokenizer_json
from urbanlake.session import shared_dir

WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return tokenizer_json(public_tokenizers.path(name))


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn

    return add


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@query("op4_suffix_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.cut_repeats(table(spark, sf_dir, "documents"), size=200)
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _ledger_sql() -> str:
    """The same matches, rule by rule: split at the pattern, and each match
    begins after all gaps and matches before it."""
    parts = []
    for place, r in enumerate(secrets.RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
SELECT doc_id, {place} AS place, '{r.kind}' AS kind, {r.least} AS least,
       list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS gaps,
       list_transform(regexp_extract_all(t, '{pattern}', 0), lambda x: length(x)) AS lens,
       list_transform(regexp_extract_all(t, '{pattern}', {r.group}), lambda x: length(x)) AS keys
FROM d""")
    n = len(secrets.BASE)
    counts = ", ".join(f"count(kind) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, ifnull(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(parts).replace("SELECT doc_id,", "SELECT doc_id, r,")}),
hits AS (SELECT doc_id, r, place, kind, least, gaps, lens, keys, unnest(range(1, len(lens) + 1)) AS i FROM raw),
found AS (
    SELECT doc_id, r, place, kind, CAST(list_sum(gaps[1:i]) + list_sum(lens[1:i]) - lens[i] AS BIGINT) AS a, lens[i] AS n
    FROM hits WHERE keys[i] >= least),
spans AS (SELECT *, kind || ':' || a || ':' || (a + n) AS span FROM found)
SELECT doc_id, {counts},
       sha256(ifnull(string_agg(span, ',' ORDER BY a, place) FILTER (place < {n}), '')) AS base_sha256,
       ifnull(string_agg(span, ',' ORDER BY a, place), '') AS spans
FROM (SELECT doc_id, r FROM d) LEFT JOIN spans USING (doc_id, r) GROUP BY doc_id, r"""


ORACLE["op7_secrets"] = _ledger_sql()


@query("op7_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.BlobLedger(spark, shared_dir(spark, "secret-ledger"))
    found = secrets.scan_texts(table(spark, sf_dir, "documents"), ledger)
    base = F.filter("found", lambda x: x["place"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(r.kind) for r in secrets.BASE],
        F.sha2(secrets.spans(base), 256).alias("base_sha256"),
        secrets.spans(F.col("found")).alias("spans"),
    )


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE))


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), round_trip=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined_ids(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_warc")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_records(spark, path, blocks=False))
    return captures.select(
        "response.page_id",
        "response.payload_bytes",
        "response.payload_digest",
        F.col("response.type").alias("record_type"),
        "response.refers_to",
    )


@query("op9_topk")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query("op10_langid")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op11_pieces")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.model_bytes(public_tokenizers.path(PIECE_BPE))
    encoded = pieces.encode(table(spark, sf_dir, "documents"), model, round_trip=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined_ids(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query("op13_resampling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10)


#: crc32 by its table, over the distinct words only.
ORACLE["op13_resampling"] = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, translate(ifnull(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
goal AS (SELECT translate(ifnull(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
dw AS (SELECT r, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM docs),
gw AS (SELECT unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM goal),
crc_table AS (
    SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS e FROM range(256) AS x(i)),
vocabulary AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM gw)),
bytes AS (SELECT w, hex(encode(w)) AS h FROM vocabulary),
crcs AS (
    SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(w))),
           lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, e[CAST(xor(c & 255, b) + 1 AS BIGINT)])), 4294967295) % 10000 AS bucket
    FROM bytes, crc_table),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN crcs USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM gw JOIN crcs USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT ifnull(sum(n), 0) FROM s)::DOUBLE AS sa, (SELECT ifnull(sum(n), 0) FROM t)::DOUBLE AS ta),
gain AS (
    SELECT s.bucket, CAST(floor(1000 * ln((ifnull(t.n, 0) + 1) * (sa + 10000) / ((s.n + 1) * (ta + 10000)))) AS BIGINT) AS g
    FROM s LEFT JOIN t USING (bucket), sums),
weights AS (
    SELECT r, count(*) AS n_features, CAST(floor(sum(g)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM dw JOIN crcs USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (
    SELECT r, doc_id, ifnull(n_features, 0) AS n_features, ifnull(weight, 0) AS weight,
           ifnull(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || ifnull(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
               + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM docs LEFT JOIN weights USING (r)),
drawn AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE n_features >= 20
    QUALIFY rank <= (SELECT count(*) * 10 // 100 FROM scored WHERE n_features >= 20))
SELECT doc_id, n_features, weight, score, CAST(rank AS BIGINT) AS rank FROM scored LEFT JOIN drawn USING (r)"""

ORACLE["op6_warc"] = """
WITH p AS (SELECT page_id, ifnull(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
first AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type, nullif(first_id, page_id) AS refers_to
FROM d LEFT JOIN first USING (payload_digest)"""

ORACLE["op9_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(ifnull(list_sum(list_transform(list_zip(q.v, c.v), lambda z: ifnull(z[1] * z[2], 0))), 0) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
QUALIFY rank <= 5"""
