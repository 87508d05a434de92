import numpy as np

from llm.edges import documents, edge_texts
from urbanlake.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    texts = edge_texts() + ["123 456 !!", "·" * 30]
    rows = langid.identify(documents(spark, texts, [None, *range(2, len(texts)), 2])).collect()
    assert len(rows) == len(texts)
    blank = {i for i, t in enumerate(texts) if not any(c.isalpha() for c in t or "")}
    assert {r.lang_pred for r in rows} == {"en", "und"}  # one language known
    assert sum(r.lang_pred == "und" for r in rows) == len(blank)
    assert langid.identify(documents(spark, [])).count() == 0
    unknown = documents(spark, ["some words"]).withColumn("lang", langid.F.lit(None).cast("string"))
    assert [(r.lang_pred, r.score) for r in langid.identify(unknown).collect()] == [("und", 0.0)]


def test_codewords_stay_apart():
    for n in (2, 3, 5, 6, 7, 30, 200):
        code = langid.codewords(n).astype(int)
        assert code.shape[0] == n and set(np.unique(code)) == {-1, 1}
        assert not (np.abs(code.sum(axis=0)) == n).any()  # no bit puts all languages on one side
        distance = (code.shape[1] - code @ code.T) // 2
        least = distance[~np.eye(n, dtype=bool)].min()
        assert least >= (2 if n > 2 else 1)


def test_a_wrong_bit_is_corrected():
    rng = np.random.RandomState(5)
    counts = rng.randint(0, 50, (6, langid.BUCKETS)) ** 2
    model = langid.Model([f"l{i}" for i in range(6)], counts)
    margin = model.code[3] * 50.0
    margin[4] *= -1
    loss = (np.logaddexp(0, -model.code * margin) * model.reliable).sum(axis=1)
    assert loss.argmin() == 3


def test_counts_are_the_whole_training_corpus(spark):
    texts = ["uno dos tres", "one two three", "uno más"]
    docs = documents(spark, texts).withColumn("lang", langid.F.when(langid.F.col("doc_id") == 2, "en").otherwise("es"))
    got = {(r.lang, r.bucket): r.n for r in langid.gram_counts(docs.repartition(2)).collect()}
    want: dict = {}
    for text, lang in zip(texts, ("es", "en", "es")):
        for b in langid.grams(text.encode()).tolist():
            want[lang, b] = want.get((lang, b), 0) + 1
    assert got == want
