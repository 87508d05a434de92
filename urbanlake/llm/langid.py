"""Language ID with error-correcting output codes.

Each language has a codeword of plus and minus ones; each bit has a binary
classifier of hashed byte n-grams that predicts it, the log-ratio between the
languages on either side.  A text's bit margins are decoded to the codeword
with the least loss, each bit weighted by how well it separates its sides,
and texts whose two best codewords are close are flagged as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import crc_fold, per_batch, slices, utf8

BUCKETS = 1 << 14
GRAM = 3
SMOOTHING = 0.5
#: n-grams of evidence that a decision counts at most.
EVIDENCE = 200.0
#: Share of the runner-up from which a text is ambiguous.
AMBIGUOUS = 0.2
#: Languages that the label column may hold: the model has a row for each.
MAX_LANGUAGES = 2000
LETTER = re.compile(r"[^\W\d_]")


def grams(text: bytes):
    """Buckets of the byte n-grams of a text, case folded, white space runs as
    one blank, with a blank at either end."""
    import numpy as np

    folded = b" " + b" ".join(text.decode().lower().encode().split()) + b" "
    data = np.frombuffer(folded, np.uint8).astype(np.uint32)
    n = len(data) - GRAM + 1
    if n < 1:
        return np.empty(0, np.uint32)
    x = np.zeros(n, np.uint32)
    for i in range(GRAM):
        x = x << np.uint32(8) | data[i : i + n]
    x *= np.uint32(0x9E3779B1)
    return x >> np.uint32(32 - BUCKETS.bit_length() + 1)


def codewords(languages: int):
    """Rows of plus and minus ones: every split of the languages if there are
    few, else one bit per language and a fixed series of balanced splits."""
    import numpy as np

    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= 6:
        splits = range(1, 1 << (languages - 1))
        bits = [[1 if s >> i & 1 else -1 for i in range(languages)] for s in splits]
        return np.array(bits, np.int8).T
    series, half = np.random.RandomState(7), languages // 2
    bits = [np.where(np.arange(languages) == i, 1, -1) for i in range(languages)]
    for _ in range(int(10 * np.log2(languages))):
        bits.append(np.where(np.argsort(np.argsort(series.rand(languages))) < half, 1, -1))
    return np.array(bits, np.int8).T


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows (text, lang), each partition summed first."""

    def body(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        count: dict[str, object] = {}
        for batch in (s for b in batches for s in slices(b)):
            for text, lang in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                found = np.bincount(grams(text), minlength=BUCKETS)
                if lang in count:
                    count[lang] += found
                else:
                    count[lang] = found
        for lang, total in count.items():
            used = np.flatnonzero(total)
            columns = [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    parts = rows.select("text", "lang").mapInArrow(body, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Bit classifiers and codewords of the learned languages."""

    def __init__(self, languages: list[str], counts):
        import numpy as np

        self.languages = languages
        self.code = codewords(len(languages))
        share = counts + SMOOTHING
        share = share / share.sum(axis=1, keepdims=True)
        plus, minus = (self.code > 0).astype(float), (self.code < 0).astype(float)
        sides = [side.T @ share / np.maximum(side.sum(axis=0), 1)[:, None] for side in (plus, minus)]
        self.weights = (np.log(sides[0]) - np.log(sides[1])).T  # bucket x bit
        # a bit counts by the least margin it gives to any language's own text
        margins = share @ self.weights * self.code
        reliable = np.maximum(margins.min(axis=0), 1e-3) if margins.size else np.ones(0)
        self.reliable = reliable / reliable.max() if len(reliable) else reliable
        self.weights = self.weights.astype(np.float32)

    def predict(self, text: bytes) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        import numpy as np

        if not self.languages or not LETTER.search(text.decode()):
            return "und", 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        g = grams(text)
        seen = np.bincount(g, minlength=BUCKETS)
        used = np.flatnonzero(seen)
        margin = seen[used].astype(np.float64) @ self.weights[used] / len(g) * min(len(g), EVIDENCE)
        loss = (np.logaddexp(0, -self.code * margin) * self.reliable).sum(axis=1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(np.partition(p, -2)[-2] >= AMBIGUOUS)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model from all rows with a language whose crc32(id) mod 4 is not 2."""
    import numpy as np

    rows = docs.where((crc_fold(id_col, 4) != 2) & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: {lang_col} is no language column")
    counts = np.zeros((len(languages), BUCKETS))
    place = {name: i for i, name in enumerate(languages)}
    for r in gram_counts(rows).toLocalIterator():  # languages x BUCKETS numbers, whatever the input
        counts[place[r["lang"]], r["bucket"]] += r["n"]
    return Model(languages, counts)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score and ambiguous.

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything if no language can be learned; with one learned language it is
    always that.  Up to six languages the code words are all splits of them,
    above a fixed series; more than ``MAX_LANGUAGES`` different labels raise, as
    the model has a row for each.  Only the text enters a prediction.  A null id counts as the
    empty text's crc32; repeated rows stay repeated, ties go to the language
    first in order, an empty table gives an empty result.
    """
    model = train(docs, id_col, text_col, lang_col)

    def body(batch):
        import pyarrow as pa

        found = list(zip(*[model.predict(t) for t in utf8(batch.column(1))]))
        kinds = (pa.string(), pa.float64(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, k) for c, k in zip(found, kinds)]], names=["id", "lang_pred", "score", "ambiguous"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(per_batch(body), f"id {kind}, lang_pred string, score double, ambiguous boolean")
    return out.select(F.col("id").alias(id_col), (crc_fold("id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
