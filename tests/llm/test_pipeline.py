import corpus_pipeline
import pytest

from llm.edges import CLASHING, documents, edge_texts, prose
from llm.test_secrets import brute as secrets_of
from llm.test_simhash import brute_components, brute_fingerprint
from llm.test_suffix_dedup import PASSAGE, brute as repeats_of
from urbanlake.llm import toxicity
from urbanlake.session import shared_dir

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
TEXTS = edge_texts() + [prose(s, 60) + " " + PASSAGE for s in range(20, 26)] + [
    prose(40, 80), prose(40, 80).replace("river", "stream", 1), prose(50, 30) + " token=abcdefghijklmnop " + prose(51, 30),
]


def test_stages_are_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "suffix_array_dedup", "secret_scans", "best_fit_packing"
    ]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stages_keep_columns_and_take_empty_tables(spark, stage):
    out = stage[1](spark, documents(spark, []), SF)
    assert out.columns == COLUMNS and out.count() == 0


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in corpus_pipeline.toxicity_stage(spark, docs, "/root/testdata/sf0.1").select("doc_id").collect()}
    rows = labels.collect()
    clean, toxic = ([r.doc_id in kept for r in rows if r.toxic == t] for t in (0, 1))
    assert sum(clean) >= 0.99 * len(clean) and sum(toxic) <= 0.15 * len(toxic)


def test_toxicity_keeps_edge_rows(spark):
    docs = documents(spark, TEXTS)
    out = corpus_pipeline.toxicity_stage(spark, docs, SF)
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    grammar = toxicity.Grammar(model[0])
    assert sorted(r.doc_id for r in out.collect()) == [i for i, t in enumerate(TEXTS, 1) if not grammar.clauses(t or "")]


def test_one_document_of_each_group_stays(spark):
    ids = [*range(1, len(TEXTS)), 5]
    out = corpus_pipeline.simhash_stage(spark, documents(spark, TEXTS, ids), SF)
    parts = brute_components(ids, [brute_fingerprint(t) for t in TEXTS])
    assert out.columns == COLUMNS
    assert {r.doc_id for r in out.collect()} == set(parts)
    nameless = corpus_pipeline.simhash_stage(spark, documents(spark, ["a b", "a b", "a b"], [None, 3, 2]), SF)
    assert [r.doc_id for r in nameless.collect()] == [2]
    alone = [prose(60, 50), prose(60, 50), prose(61, 50), prose(61, 50) + "\n"]  # two groups, one of them all without ids
    out = corpus_pipeline.simhash_stage(spark, documents(spark, alone, [None, None, None, 8]), SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted([("None", alone[0]), ("8", alone[3])])


def test_one_text_of_a_repeated_id_stays(spark):
    near = prose(40, 80)
    other = prose(90, 80)
    assert len(set(brute_components([1, 2], [brute_fingerprint(near), brute_fingerprint(near + "\n")]))) == 1
    texts, ids = [near, near + "\n", near, other, other, near + " "], [7, 7, 7, 7, 3, 9]
    out = corpus_pipeline.simhash_stage(spark, documents(spark, texts, ids), SF).collect()
    assert len(out) == 2 and {r.doc_id for r in out} == {7, 3}  # near copies once, the other text under its smallest id
    twice = corpus_pipeline.simhash_stage(spark, documents(spark, [near, other], [5, 5]), SF).collect()
    assert sorted(r.text for r in twice) == sorted([near, other])  # two groups of one id


def test_repeats_are_cut_from_the_texts(spark):
    out = {r.doc_id: r for r in corpus_pipeline.suffix_stage(spark, documents(spark, TEXTS), SF).collect()}
    for i, (text, want) in enumerate(zip(TEXTS, repeats_of(TEXTS)), 1):
        assert (out[i].text is None) == (text is None)
        if text is not None:
            assert out[i].n_chars == len(out[i].text)
            assert (out[i].text == text) == (want[1] == 0)
    assert out[1].row == "x"


def test_secrets_are_masked(spark):
    out = {r.doc_id: r for r in corpus_pipeline.secrets_stage(spark, documents(spark, TEXTS), SF).collect()}
    for i, text in enumerate(TEXTS, 1):
        if secrets_of(text):
            assert "[SECRET]" in out[i].text and not secrets_of(out[i].text)
        else:
            assert out[i].text == text


def test_a_kept_ledger_scans_no_text_twice(spark):
    path = shared_dir(spark, "ledger-test")
    docs = documents(spark, TEXTS)
    first = corpus_pipeline.secrets_stage(spark, docs, SF, ledger=path).collect()
    scanned = spark.read.parquet(path).count()
    assert scanned == len({t or "" for t in TEXTS})
    again = corpus_pipeline.secrets_stage(spark, docs, SF, ledger=path).collect()
    assert spark.read.parquet(path).count() == scanned  # 0 old texts
    assert sorted(map(str, again)) == sorted(map(str, first))
    corpus_pipeline.secrets_stage(spark, documents(spark, [*TEXTS[:5], "a new one"]), SF, ledger=path).collect()
    assert spark.read.parquet(path).count() == scanned + 1


def test_private_keys_are_masked_whole(spark):
    body = "\n".join(f"MIIEvQ+{i:02}/" + "aB3x/Z+q" * 7 for i in range(400))
    keys = [
        f"-----BEGIN {kind}-----\n{head}{body}\n-----END {kind}-----"
        for kind, head in [("PRIVATE KEY", ""), ("RSA PRIVATE KEY", "DEK-Info: AES-128-CBC\n\n"), ("PGP PRIVATE KEY BLOCK", "Version: 2 - x\n\n")]
    ]
    texts = [f"before\n{k}\nafter" for k in keys] + ["\n".join(keys), "-----BEGIN PGP PRIVATE KEY BLOCK----- no end"]
    out = {r.doc_id: r.text for r in corpus_pipeline.secrets_stage(spark, documents(spark, texts), SF).collect()}
    assert [out[i] for i in (1, 2, 3)] == ["before\n[SECRET]\nafter"] * 3
    assert out[4] == "[SECRET]\n[SECRET]\n[SECRET]" and out[5] == "[SECRET] no end"


def test_run_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    used: dict = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert rows and max(used.values()) <= 2048
