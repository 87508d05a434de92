from llm.edges import documents, edge_texts
from urbanlake.llm import toxicity

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_grammar_weighs_context():
    g = toxicity.Grammar({"idiot": 4.0, "scum*": 3.0})
    score = lambda text: sum(g.clauses(text))
    assert score("what a day") == 0
    assert score("you idiot") > score("idiot") > score("never an idiot") > 0
    assert score("idiot") > score("they said idiot") > 0
    assert score('he wrote "idiot"') < score("idiot")
    assert score("scummy idiot") == 7.0  # a clause sums its matches, stems included
    assert len(g.clauses("idiot. fine. scumbag!")) == 2  # only matched clauses count
    assert score("not. idiot") == score("idiot")  # a clause end closes the negation
    assert score("i will kill you") > 0


def test_composed_machine_is_total():
    arcs = toxicity.compose()
    assert len(arcs) == 3 * 4 * 2 * len(toxicity.SYMBOLS)
    assert all((state, symbol) in arcs for (state, _) in arcs.values() for symbol in toxicity.SYMBOLS)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    assert right > 0.97 and caught > 0.85


def test_rare_labels_need_no_more_than_the_odds(spark):
    rows = [("zork" if i < 20 else "fine", 1) for i in range(300)] + [("zork" if i < 40 else "fine", 0) for i in range(9700)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert lexicon.keys() == {"zork", "zor*", "zork*"}  # 16 times the odds, in fewer toxic than clean documents
    assert toxicity.learn_lexicon(spark.createDataFrame([("zork", 0)] * 9, "text string, toxic int")) == {}


def test_edges_and_missing_labels(spark):
    docs = documents(spark, edge_texts(), [None, *range(2, len(edge_texts())), 2])
    labels = spark.createDataFrame([(2, 1, None), (None, 1, 1), (99, 0, 1)], LABELS)
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == len(edge_texts())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows}) == 1 and rows[0].predicted == 0  # nothing learned, nothing matched
    assert toxicity.classify(documents(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_scoring_keeps_other_columns(spark):
    out = toxicity.score(documents(spark, ["you idiot", None]), ({"idiot": 5.0}, toxicity.UNTRAINED))
    assert out.columns.count("score") == 1 and "row" in out.columns
    first, second = sorted(out.collect(), key=lambda r: r.doc_id)
    assert first.score > second.score and second.text is None
