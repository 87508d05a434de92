"""Toxicity: a weighted finite-state pattern grammar over clauses.

Three transducers read the word classes of a clause side by side and are
composed into one table-driven machine:

* reported speech: after a verb of saying, or inside quotes, what follows is
  someone else's;
* negation: the words just after a negation are weakened;
* target: once somebody is addressed or named, insults and threats weigh more.

Each insult or threat passes with its own weight times the factor of the arc
it takes; a clause scores the sum, and a document is judged by its matched
clauses.  The insult lexicon (words and word stems with their log-odds) and
the calibration are learned from labelled rows, on separate halves; the
other word classes are small closed lists.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import bounded_sample, crc_fold, per_batch, utf8

#: Word classes.  Weights of words not learned from labels are in nats.
THREATS = {w: 2.0 for w in "kill hurt destroy murder stab shoot strangle tuer frapper töten umbringen matar golpear".split()}
TARGETS = frozenset("you your yours he she they him her them tu toi vous du dich sie ihr tú usted vosotros ellos".split())
NEGATIONS = frozenset("not never no isn't aren't don't without jamais pas nicht kein keine nie nunca sin".split())
REPORTS = frozenset("said says say called wrote writes quoted claimed reported dit écrit sagte schrieb dijo escribió".split())
QUOTES = frozenset('"“”«»')
ENDS = frozenset(".!?;\n")

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n\"“”«»]")
STEMS = range(3, 9)
SYMBOLS = "itynrqo"  # insult, threat, target, negation, report, quote, other

#: Rows of labels that training may take.
MAX_TRAIN = 24_000


def _reported(state: int, symbol: str) -> tuple[int, float]:
    """0 own words, 1 after a verb of saying, 2 inside quotes."""
    if symbol == "q":
        return (0, 1.0) if state == 2 else (2, 1.0)
    if symbol == "r":
        return max(state, 1), 1.0
    return state, (1.0, 0.5, 0.4)[state]


def _negated(state: int, symbol: str) -> tuple[int, float]:
    """Words that a negation still covers."""
    if symbol == "n":
        return 3, 1.0
    return max(0, state - 1), 0.3 if state else 1.0


def _targeted(state: int, symbol: str) -> tuple[int, float]:
    return (1, 1.0) if symbol == "y" else (state, 1.5 if state else 1.0)


def compose() -> dict[tuple[tuple[int, int, int], str], tuple[tuple[int, int, int], float]]:
    """The product machine: (state, symbol) -> (next state, factor)."""
    arcs = {}
    for state in product(range(3), range(4), range(2)):
        for symbol in SYMBOLS:
            steps = [f(s, symbol) for f, s in zip((_reported, _negated, _targeted), state)]
            arcs[state, symbol] = tuple(s for s, _ in steps), steps[0][1] * steps[1][1] * steps[2][1]
    return arcs


class Grammar:
    """The composed machine with a lexicon of insults: {word or stem*: weight}."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.arcs, self.known = lexicon, compose(), {}

    def read(self, word: str) -> tuple[str, float] | None:
        """(class, weight); None for a word of no class."""
        if word in ENDS:
            return "e", 0.0
        if word in QUOTES:
            return "q", 0.0
        weight = max([self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:n] + "*", 0.0) for n in STEMS if n <= len(word))])
        if weight:
            return "i", weight
        if word in THREATS:
            return "t", THREATS[word]
        for symbol, words in (("y", TARGETS), ("n", NEGATIONS), ("r", REPORTS)):
            if word in words:
                return symbol, 0.0
        return None

    def clauses(self, text: str) -> list[float]:
        """Scores of the matched clauses."""
        words = TOKEN.findall(text.lower())
        known, read = self.known, self.read
        if len(known) > 400_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = read(w)
        scores, clause, hit = [], [], False
        for found in map(known.__getitem__, words):
            if found is None:
                clause.append(("o", 0.0))
                continue
            if found[0] == "e":
                if hit:
                    scores.append(self.clause(clause))
                clause, hit = [], False
                continue
            hit = hit or found[0] in "it"
            clause.append(found)
        if hit:
            scores.append(self.clause(clause))
        return scores

    def clause(self, clause: list[tuple[str, float]]) -> float:
        state, score = (0, 0, 0), 0.0
        for symbol, weight in clause:
            state, factor = self.arcs[state, symbol]
            if weight:
                score += weight * factor
        return score


def _features(scores: list[float]) -> list[float]:
    import math

    return [1.0, math.log1p(sum(scores)), min(max(scores, default=0.0), 12.0), math.log1p(len(scores))]


def units(text: str) -> set[str]:
    """Words and word stems of a text."""
    words = {w for w in set(TOKEN.findall(text.lower())) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in STEMS if n <= len(w)}


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, max_rows: int) -> DataFrame:
    """(text, toxic, half) of at most about ``max_rows`` labelled training rows,
    chosen by a digest of the id; half 0 feeds the lexicon, half 1 the calibration."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_fold("doc_id", 5) != 0))
    known = known.groupBy(F.col("doc_id").alias("k")).agg(F.max("toxic").alias("toxic"))
    # a bounded side: about max_rows rows of two numbers
    chosen = F.broadcast(bounded_sample(known, "k", max_rows))
    return docs.select(F.col(id_col).alias("k"), F.col("text")).join(chosen, "k").select(
        "text", "toxic", F.pmod(F.xxhash64("k", F.lit(1)), F.lit(2)).alias("half")
    )


def learn_lexicon(sample: DataFrame, least: int = 4, odds: float = 12.0) -> dict[str, float]:
    """{unit: weight}: units in at least ``least`` toxic documents whose odds
    of a toxic document are ``odds`` times the others' or more, if not even one
    of all units tested would get there by chance (Chernoff's bound on a unit
    without meaning falling on that many toxic documents)."""
    import math

    def body(batch):
        import pyarrow as pa

        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        rows = [0, 0]
        for text, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            t = int(toxic > 0)
            rows[t] += 1
            seen[t].update(units(text.decode()))
        seen[0][""], seen[1][""] = rows
        names = list(seen[0].keys() | seen[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([seen[1][u] for u in names], pa.int64()), pa.array([seen[0][u] for u in names], pa.int64())],
            names=["unit", "bad", "good"],
        )

    counts = sample.select("text", "toxic").mapInArrow(per_batch(body), "unit string, bad long, good long")
    counts = counts.groupBy("unit").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = counts.where((F.col("bad") >= least) | (F.col("unit") == "")).checkpoint()
    tested = max(1, counts.count())
    total = counts.where("unit = ''").select("bad", "good").first() or (0, 0)
    ratio = ((F.col("bad") + 0.5) / (total[0] + 1)) / ((F.col("good") + 0.5) / (total[1] + 1))
    n, share = F.col("bad") + F.col("good"), F.lit(min(max(total[0] / max(1, total[0] + total[1]), 1e-12), 1 - 1e-12))
    seen = F.col("bad") / n
    gain = seen * F.log(seen / share) + F.when(F.col("good") > 0, (1 - seen) * F.log((1 - seen) / (1 - share))).otherwise(0.0)
    likely = counts.where("unit <> '' AND bad > 0").withColumn("ratio", ratio).where(F.col("ratio") >= odds)
    # a bounded table: units of the sample, whose rows are bounded
    rows = likely.where(F.exp(-n * gain) * tested <= 1).select("unit", "ratio").collect()
    return {r["unit"]: math.log(r["ratio"]) for r in rows}


def calibrate(features, labels, ridge: float = 1e-3, rounds: int = 50):
    """Logistic regression by Newton's method."""
    import numpy as np

    x, y = np.asarray(features, float), np.asarray(labels, float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w)), x.T @ (y - p) - ridge * len(y) * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


#: Weights of ``_features`` when there are no labels to learn from.
UNTRAINED = (-4.0, 1.0, 0.5, 1.0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_train: int = MAX_TRAIN) -> tuple[dict[str, float], tuple[float, ...]]:
    """(lexicon, weights) from at most about ``max_train`` labelled rows whose
    crc32(id) mod 5 is not 0.  Without both kinds of labels: the closed lists
    alone, under ``UNTRAINED`` weights."""
    sample = _sample(docs, labels, id_col, max_train).checkpoint()
    lexicon = learn_lexicon(sample.where("half = 0"))
    grammar = Grammar(lexicon)

    def body(batch):
        import pyarrow as pa

        rows = [_features(grammar.clauses(t.decode())) for t in utf8(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    rows = sample.where("half = 1").select("text", F.col("toxic").cast("int")).mapInArrow(per_batch(body), "x array<double>, toxic int").collect()
    if not 0 < sum(r["toxic"] > 0 for r in rows) < len(rows):
        return lexicon, UNTRAINED
    return lexicon, tuple(float(w) for w in calibrate([r["x"] for r in rows], [r["toxic"] > 0 for r in rows]))


def score(docs: DataFrame, model: tuple[dict[str, float], tuple[float, ...]], text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1); null and empty texts get the
    score of a text without matches.  A column of that name is replaced."""
    lexicon, weights = model
    grammar = Grammar(lexicon)

    def body(batch):
        import math

        import pyarrow as pa

        out = []
        for text in utf8(batch.column(1)):
            z = sum(w * f for w, f in zip(weights, _features(grammar.clauses(text.decode()))))
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["row", "text", "score"])

    others = [c for c in docs.columns if c not in (text_col, "score")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(per_batch(body), f"row {kind}, text string, score double")
    order = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c != "score"]
    return scored.select(*order, "score")


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per input row: id, held_out, score, predicted (1 from 0.5 on).

    Only the text enters a score.  Null and empty texts are scored like a text
    without matches; repeated rows stay repeated; a null id counts as the empty
    text, whose crc32 is held out; labels without a document, or null, are ignored;
    an empty table gives an empty result.
    """
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels, "doc_id", max_train)
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))
    return score(rows, model).select(
        id_col, (crc_fold(id_col, 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
