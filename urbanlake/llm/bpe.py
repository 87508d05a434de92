"""BPE encoding and decoding by tree concatenation.

A long text is cut into leaves that are encoded in parallel, as rows of their
own.  Where the tokenizer itself always cuts, leaves just follow one another.
Inside one unsplit stretch (a single pre-token longer than a leaf) halves are
joined by re-encoding a window around the join, which grows until its first
token agrees with the left half and its last token with the right half.  In a
byte pair encoding every pair of neighbours that is stable on its own makes
the whole sequence stable, so agreement on both sides is exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import per_batch, utf8
from urbanlake.llm.tokens import CachedEncoder

#: Characters of a leaf.
LEAF = 1 << 15
#: A blank after a letter or digit: the tokenizer always cuts before it.
CUT = re.compile(r"(?<=[^\W_])[ \n]")
#: White space as the tokenizer sees it.  How it is cut depends on what follows.
SPACE = re.compile(r"[^\S\x1c-\x1f]")


def join(left: list[int], right: list[int], text_of: Callable, encode: Callable, window: int = 8) -> list[int]:
    """Encoding of two neighbouring stretches of one pre-token from theirs."""
    if not left or not right:
        return left + right
    while True:
        i, j = max(0, len(left) - window), min(len(right), window)
        middle = encode("".join(map(text_of, left[i:] + right[:j])))
        if (i == 0 or middle[0] == left[i]) and (j == len(right) or middle[-1] == right[j - 1]):
            return left[:i] + middle + right[j:]
        window *= 2


def concatenate(halves: list[list[int]], text_of: Callable, encode: Callable) -> list[int]:
    """Leaves of one pre-token, joined in pairs level by level."""
    while len(halves) > 1:
        pairs = [halves[i : i + 2] for i in range(0, len(halves), 2)]
        halves = [join(p[0], p[1], text_of, encode) if len(p) == 2 else p[0] for p in pairs]
    return halves[0] if halves else []


class TreeEncoder:
    """Cuts texts into leaves, encodes leaves and joins them."""

    def __init__(self, tokenizer: str, leaf: int = LEAF):
        self.cached = CachedEncoder(tokenizer, spaced=True)
        self.tokenizer, self.leaf = self.cached.tokenizer, leaf
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.text_of = self.tokenizer.id_to_token

    def raw(self, symbols: str) -> list[int]:
        """Merges alone, over one pre-token in the tokenizer's byte symbols."""
        return [t.id for t in self.tokenizer.model.tokenize(symbols)]

    def leaves(self, text: str) -> Iterator[tuple[bool, str]]:
        """(glued, part): plain parts stand for themselves; glued parts are
        consecutive stretches, in byte symbols, of one pre-token, which ends
        before the next plain part or empty glued part."""
        at, leaf = 0, self.leaf
        while at < len(text):
            cut = CUT.search(text, at + leaf, at + 2 * leaf) if len(text) - at > 2 * leaf else None
            if cut or len(text) - at <= 2 * leaf:
                end = cut.start() if cut else len(text)
                yield False, text[at:end]
                at = end
                continue
            cut = CUT.search(text, at + leaf)
            end = cut.start() if cut else len(text)
            yield from self._unsplit(text[at:end])
            at = end

    def _unsplit(self, text: str) -> Iterator[tuple[bool, str]]:
        at = 0
        for found in [*self.special.finditer(text), None]:
            yield from self._words(text[at : found.start() if found else len(text)])
            if found:
                yield False, found[0]
                at = found.end()

    def _words(self, text: str) -> Iterator[tuple[bool, str]]:
        """Leaves end after other characters than white space, which on its
        own may be cut differently; before a long pre-token it goes as the
        pre-tokens that it is."""
        start = end = 0
        spaces: list[str] = []  # pre-tokens after ``end``
        for symbols, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            if len(symbols) > 2 * self.leaf:
                if end > start:
                    yield False, text[start:end]
                for space in spaces:
                    yield from ((True, space), (True, ""))
                yield from ((True, symbols[i : i + self.leaf]) for i in range(0, len(symbols), self.leaf))
                yield True, ""
                start, end, spaces = b, b, []
                continue
            if b - start > self.leaf and end > start:
                yield False, text[start:end]
                start = end
            if SPACE.match(text, b - 1):
                spaces.append(symbols)
            else:
                end, spaces = b, []
        if start < len(text):
            yield False, text[start:]

    def encode_leaves(self, leaves: list[tuple[bool, str]]) -> list[list[int]]:
        import numpy as np

        plain = iter(self.cached.encode([t for glued, t in leaves if not glued]))
        return [self.raw(t) if glued else np.frombuffer(next(plain), "<u4").tolist() for glued, t in leaves]

    def joined(self, glued: list[bool], ids: list[list[int]]) -> list[int]:
        out, chain = [], []
        for g, part in zip([*glued, False], [*ids, []]):
            if g and part:
                chain.append(part)
                continue
            if chain:
                out += concatenate(chain, self.text_of, self.raw)
                chain = []
            out += part
        return out


def decoded_texts(tokenizer, ids: list[list[int]]) -> list[str]:
    """The ids' bytes as UTF-8, special tokens included, a few texts at a time."""
    out = []
    for a in range(0, len(ids), 64):
        out += tokenizer.decode_batch(ids[a : a + 64], skip_special_tokens=False)
    return out


def encode(
    docs: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    leaf: int = LEAF,
    round_trip: bool = False,
) -> DataFrame:
    """One row per input row: the ``carry`` columns and ``ids`` (array<int>),
    equal to the tokenizer's encoding of the whole text without added special
    tokens.  ``round_trip`` adds ``decoded``, the ids decoded again where they
    were made, which spares sending them to a second Python process.

    Null and empty texts get no ids.  Repeated rows stay repeated, an empty
    table gives an empty result, and columns not carried are not read.  Texts
    of up to two leaves are one leaf and encoded where they are; the leaves of
    longer ones are dealt out to all tasks and meet again by text.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def short(batches: Iterator) -> Iterator:
        encoder = TreeEncoder(tokenizer, leaf)

        def body(batch):
            import numpy as np
            import pyarrow as pa

            streams = encoder.cached.encode([t.decode() for t in utf8(batch.column(1))])
            ids = [np.frombuffer(s, "<u4").view(np.int32) for s in streams]
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32()))]
            if round_trip:
                texts = []
                for a in range(0, len(ids), 64):
                    texts += decoded_texts(encoder.tokenizer, [x.tolist() for x in ids[a : a + 64]])
                columns.append(pa.array(texts, pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=["row", *out])

        yield from per_batch(body)(batches)

    def split(batches: Iterator) -> Iterator:
        encoder = TreeEncoder(tokenizer, leaf)

        def body(batch):
            import pyarrow as pa

            where, nth, glued, parts = [], [], [], []
            for i, text in enumerate(utf8(batch.column(2))):
                for k, (g, part) in enumerate(encoder.leaves(text.decode())):
                    where.append(i)
                    nth.append(k)
                    glued.append(g)
                    parts.append(part)
            columns = [batch.column(0).take(pa.array(where)), pa.array(nth, pa.int32()), pa.array(glued), pa.array(parts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["uid", "nth", "glued", "part"])

        yield from per_batch(body)(batches)

    def encode_parts(batches: Iterator) -> Iterator:
        encoder = TreeEncoder(tokenizer, leaf)

        def body(batch):
            import pyarrow as pa

            ids = encoder.encode_leaves(list(zip(batch.column(2).to_pylist(), [t.decode() for t in utf8(batch.column(3))])))
            return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.list_(pa.int32()))], names=["uid", "nth", "glued", "ids"])

        yield from per_batch(body)(batches)

    def meet(batches: Iterator) -> Iterator:
        encoder = TreeEncoder(tokenizer, leaf)
        for batch in batches:
            import pyarrow as pa

            for i in range(batch.num_rows):  # one long text at a time
                parts = sorted(batch.column(1)[i].as_py(), key=lambda x: x["nth"])
                ids = encoder.joined([p["glued"] for p in parts], [p["ids"] for p in parts])
                columns = [batch.column(0).slice(i, 1), pa.array([ids], pa.list_(pa.int32()))]
                if round_trip:
                    columns.append(pa.array(decoded_texts(encoder.tokenizer, [ids]), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["uid", *out])

    out = ["ids", "decoded"] if round_trip else ["ids"]
    found = "ids array<int>, decoded string" if round_trip else "ids array<int>"
    is_long = F.length("text") > 2 * leaf
    near = rows.where(~is_long).mapInArrow(short, f"row {kind}, {found}")
    # Equal long texts are one: their address is their content.
    far = rows.where(is_long).withColumn("uid", F.sha2("text", 256))
    texts = far.groupBy("uid").agg(F.any_value("text").alias("text"))
    leaves = texts.select("uid", F.lit(0).alias("pad"), "text").mapInArrow(split, "uid string, nth int, glued boolean, part string")
    parts = leaves.repartition("uid", "nth").mapInArrow(encode_parts, "uid string, nth int, glued boolean, ids array<int>")
    whole = parts.groupBy("uid").agg(F.collect_list(F.struct("nth", "glued", "ids")).alias("parts"))
    whole = whole.mapInArrow(meet, f"uid string, {found}")
    long = far.select("row", "uid").join(whole, "uid").select("row", *out)
    return near.unionByName(long).select("row.*", *out)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the ids' bytes as UTF-8, special
    tokens included, as the tokenizer decodes them; null ids stay null."""

    def run(series: Iterator) -> Iterator:
        import os

        import pandas as pd
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        decoder = Tokenizer.from_str(tokenizer)
        for ids in series:
            texts = []
            for x in ids:
                texts += [None] if x is None else decoded_texts(decoder, [x.tolist()])
            yield pd.Series(texts, index=ids.index, dtype=object)

    return encoded.withColumn("decoded", F.pandas_udf(run, "string", F.PandasUDFType.SCALAR_ITER)(ids_col))


def joined_ids(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
