"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text's symbols are its characters.  An agenda (a heap) holds every pair of
adjacent symbols whose concatenation is a piece; the best score is merged
first, the leftmost of equal scores, and the two pairs that the new symbol
makes with its neighbours join the agenda.  What is left at the end are the
pieces; a character that is no piece becomes its UTF-8 bytes.

Two neighbouring characters that stand side by side in no piece are never
merged over, so a text may be cut there and equal parts are encoded once.
All parts that an Arrow batch brings for the first time are also encoded, and
decoded again, by the sentencepiece library, as one text; a difference raises.
Texts are made of parts, so what holds for the parts holds for them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import per_batch, utf8

#: The symbol that stands for a blank in pieces.  Inside this module it is the
#: blank itself, so that most texts need no copy.
MARK, BLANK = "▁", " "
#: Blanks and the letters, or the other characters, that follow them.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏͰ-ԯ"
SEGMENT = re.compile(f"{BLANK}*[{LETTERS}]+|{BLANK}*[^{LETTERS}{BLANK}]+|{BLANK}+")
LETTER = re.compile(f"[{LETTERS}]")
#: Longer segments are cut further and not remembered.
REMEMBERED = 64
#: Symbols up to which a list is faster than a heap.
SHORT = 24


NEVER = float("inf")


def agenda(symbols: list[str], order: dict[str, float]) -> list[str]:
    """The pieces that merging leaves of ``symbols``: the pair of least
    ``order`` (the negative score) first, the leftmost of equal ones."""
    return short_agenda(symbols, order) if len(symbols) <= SHORT else long_agenda(symbols, order)


def short_agenda(symbols: list[str], order: dict[str, float]) -> list[str]:
    """With the agenda as a list by place, searched for its best entry."""
    pieces, get = symbols, order.get
    ranks = [get(a + b, NEVER) for a, b in zip(pieces, pieces[1:])]
    while ranks:
        best = min(ranks)
        if best == NEVER:
            break
        i = ranks.index(best)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = get(pieces[i - 1] + pieces[i], NEVER)
        if i < len(ranks):
            ranks[i] = get(pieces[i] + pieces[i + 1], NEVER)
    return pieces


def long_agenda(symbols: list[str], order: dict[str, float]) -> list[str]:
    """With the agenda as a heap, which takes time n log n."""
    n = len(symbols)
    pieces, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = order.get(pieces[i] + pieces[i + 1])
        if rank is not None:
            heap.append((rank, i, pieces[i] + pieces[i + 1]))
    heapify(heap)
    while heap:
        _, i, merged = heappop(heap)
        j = after[i]
        # a pair is past if either side has been merged meanwhile
        if j >= n or not pieces[i] or len(pieces[i]) + len(pieces[j]) != len(merged) or pieces[i] + pieces[j] != merged:
            continue
        pieces[i], pieces[j] = merged, ""
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            rank = order.get(merged + pieces[k])
            if rank is not None:
                heappush(heap, (rank, i, merged + pieces[k]))
        h = before[i]
        if h >= 0:
            rank = order.get(pieces[h] + merged)
            if rank is not None:
                heappush(heap, (rank, h, pieces[h] + merged))
    return [p for p in pieces if p]


class PieceEncoder:
    """Encodes and decodes with the vocabulary of a model file's bytes.

    Only merge-type models with byte pieces are accepted, without unused
    pieces; a model whose normaliser does more than mark blanks, or whose pieces go on
    from letters to other characters, has its texts normalised by the library
    and encoded as one segment each.  Twice ``limit`` segments are remembered, and
    those of one slice of texts.
    """

    def __init__(self, model: bytes, limit: int = 500_000):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) for i in range(size)]
        if any(library.is_unused(i) for i in range(size)) or sum(map(library.is_byte, range(size))) != 256:
            raise ValueError("the vocabulary must have all byte pieces and no unused ones")
        names = library.id_to_piece(list(range(size)))
        self.ids = {p.replace(MARK, BLANK): i for i, p in enumerate(names) if not special[i]}
        self.order = {p: -library.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        self.pairs = {p[k : k + 2] for p in self.order for k in range(len(p) - 1)}
        # whether no piece goes on where SEGMENT cuts, or beside a line break
        kind = lambda c: c if c == BLANK else bool(LETTER.match(c))
        marks = library.normalize(" \ta  b \x00ＡǺ\n") == f"{MARK * 2}\ta{MARK * 2}b{MARK}\x00ＡǺ\n"
        self.segmented = marks and all((a == BLANK or kind(a) == kind(b)) and "\n" not in (a, b) for a, b in self.pairs)
        byte_ids = [i for i in range(size) if library.is_byte(i)]
        self.byte_id = {int(names[i][3:5], 16): i for i in byte_ids}
        self.bytes_of = [b"" if special[i] else names[i].replace(MARK, BLANK).encode() for i in range(size)]
        for value, i in self.byte_id.items():
            self.bytes_of[i] = bytes([value])
        self.is_byte = [False] * size
        for i in byte_ids:
            self.is_byte[i] = True
        for i in range(size):
            if library.is_unknown(i):
                self.bytes_of[i] = library.decode([i]).encode()
        self.first_blank = [n.startswith(MARK) for n in names]
        self.control = {i for i in range(size) if library.is_control(i)}
        self.raw_ids = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.limit, self.known, self.older = limit, {}, {}

    def normalized(self, text: str) -> str:
        if not self.segmented:
            text = self.library.normalize(text)
        elif text:
            text = BLANK + text
        return text.replace(MARK, BLANK) if MARK in text else text

    def by_agenda(self, part: str) -> bytes:
        """Ids of a part (little-endian uint32), by the agenda alone."""
        pieces, raw = agenda(list(part), self.order), self.raw_ids
        try:
            return b"".join([raw[p] for p in pieces])
        except KeyError:  # characters that are no piece
            return b"".join([raw[p] if p in raw else b"".join(self.byte_id[b].to_bytes(4, "little") for b in p.encode()) for p in pieces])

    def segment(self, segment: str) -> bytes:
        """Ids of a segment; a long one is cut where no piece goes on."""
        if len(segment) <= REMEMBERED:
            return self.by_agenda(segment)
        cuts = [0, *(k for k in range(1, len(segment)) if segment[k - 1 : k + 1] not in self.pairs), len(segment)]
        return b"".join(self.by_agenda(segment[a:b]) for a, b in zip(cuts, cuts[1:]))

    def _check(self, segments: list[str], ids: list[bytes]) -> None:
        """The library encodes the segments as lines of one text, or whole
        texts as they are."""
        import numpy as np

        if not segments:
            return
        if self.segmented:
            line, theirs = self.by_agenda("\n"), self.library.encode("\n" + "\n".join(segments))
            same = np.array(theirs, "<u4").tobytes() == line.join([self.by_agenda(BLANK), *ids]) and self.decode(theirs) == self.library.decode(theirs)
        else:
            theirs = self.library.encode(segments, num_threads=1)
            same = all(np.array(t, "<u4").tobytes() == i for t, i in zip(theirs, ids)) and list(map(self.decode, theirs)) == self.library.decode(theirs)
        if not same:
            raise ValueError("the agenda's pieces are not the library's")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian uint32 bytes, equal to the
        library's ``encode`` without begin and end ids."""
        texts = [self.normalized(t) for t in texts] if self.segmented else texts
        found = [SEGMENT.findall(t) if self.segmented else [t] for t in texts]
        wanted = set().union(*found)
        known, older = self.known, self.older
        missing = wanted.difference(known)
        back = missing.intersection(older)
        new = list(missing.difference(back))
        ids = [self.segment(s if self.segmented else self.normalized(s)) for s in new]
        self._check(new, ids)
        known.update((s, older[s]) for s in back)
        known.update(zip(new, ids))
        out = [b"".join(map(known.__getitem__, f)) for f in found]
        for s in new:
            if len(s) > REMEMBERED:
                del known[s]
        if len(known) > self.limit:  # what has not been met since the last time is forgotten
            self.known, self.older = {}, known
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: pieces with their blanks, the first one's blank
        dropped, control ids as nothing, bytes as UTF-8 with U+FFFD for each
        byte that is none."""
        if not ids:
            return ""
        try:  # bytes on both sides of a control id are no character
            text = b"".join(map(self.bytes_of.__getitem__, ids)).decode() if self.control.isdisjoint(ids) else self._decode_runs(ids)
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        first = next((i for i in ids if i not in self.control), ids[0])
        return text[1:] if self.first_blank[first] and text[:1] == " " else text

    def _decode_runs(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.bytes_of[i]
                continue
            while run:  # one character or one wrong byte at a time
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                run = run[n:]
            if i is not None:
                out.append(self.bytes_of[i].decode())
        return "".join(out)

    def decode_checked(self, ids: list[list[int]]) -> list[str]:
        out = [self.decode(i) for i in ids]
        if out != self.library.decode(ids):
            raise ValueError("not as the library decodes it")
        return out


_encoders: dict[bytes, PieceEncoder] = {}


def encoder_of(model: bytes) -> PieceEncoder:
    """One encoder per Python worker: what a task has learned serves the next."""
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders[key] = PieceEncoder(model)
    return _encoders[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def id_lists(streams: list[bytes]):
    """Arrow array<int> of little-endian uint32 byte strings."""
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *[len(s) // 4 for s in streams]]).astype(np.int32)
    values = np.frombuffer(b"".join(streams), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), round_trip: bool = False) -> DataFrame:
    """One row per input row: the ``carry`` columns and ``ids`` (array<int>),
    equal to the sentencepiece library's encoding of the whole text without
    begin and end ids.  ``round_trip`` adds ``decoded``, the ids decoded again
    where they were made.

    Null and empty texts get no ids, and decode to the empty text.  Repeated
    rows stay repeated, an empty table gives an empty result, and columns not
    carried are not read.  Rows stay where they are: nothing is shuffled, so
    copies of one text cannot meet in a task, and a task holds the texts of
    one slice of a batch (one text, if it is longer) and their ids.
    ``model`` is the content of a model file.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = encoder_of(model)

        def body(batch):
            streams = encoder.encode([t.decode() for t in utf8(batch.column(1))])
            columns = [batch.column(0), id_lists(streams)]
            if round_trip:
                columns.append(pa.array([encoder.decode(np.frombuffer(s, "<u4").tolist()) for s in streams], pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=["row", *out])

        yield from per_batch(body)(batches)

    out = ["ids", "decoded"] if round_trip else ["ids"]
    kind = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>" + ", decoded string" * round_trip
    return rows.mapInArrow(run, kind).select("row.*", *out)


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``, as the library's ``decode(ids)``;
    null ids stay null, no ids are the empty text."""

    def run(series: Iterator) -> Iterator:
        import pandas as pd

        encoder = encoder_of(model)
        for ids in series:
            lists = [[] if x is None else x.tolist() for x in ids]
            texts = encoder.decode_checked(lists)
            yield pd.Series([None if x is None else t for x, t in zip(ids, texts)], index=ids.index, dtype=object)

    return encoded.withColumn("decoded", F.pandas_udf(run, "string", F.PandasUDFType.SCALAR_ITER)(F.col(f"`{ids_col}`")))
