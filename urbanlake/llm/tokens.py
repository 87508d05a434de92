"""Whole-text encoding with a public tokenizer, each distinct word encoded once.

A text is cut where the tokenizer itself always cuts (at white space, and
between letters and other characters), so the parts can be encoded on their
own and remembered; a text with anything unusual is left to it whole.
"""

from __future__ import annotations

import re

WS = r" \t\n\r\x0b\x0c"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Texts of plain letters and symbols: no apostrophes (contractions), marks,
#: other scripts or white space that libraries disagree on.
PLAIN = re.compile(rf"[{WS}\x21-\x26\x28-\x7eÀ-ÖØ-öø-ÿ]*")
#: Where the tokenizers cut plain texts.  In a byte-level vocabulary a word
#: carries the blank before it; otherwise white space is dropped.
SPACED = re.compile(rf" ?[{LETTERS}]+| ?[^{LETTERS}{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
#: Kind of each character below 256: 0 white space, 1 letter, 2 other.  Where
#: white space is dropped, plain texts are cut where the kind changes.
KIND = bytes(0 if re.match(f"[{WS}]", chr(i)) else 1 if re.match(f"[{LETTERS}]", chr(i)) else 2 for i in range(256))


class CachedEncoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes,
    equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    ``spaced``: byte-level vocabulary, where a word carries the space before
    it; otherwise white space is dropped and case is folded by the tokenizer.
    ``limit`` bounds the remembered words.  Unusual texts are encoded whole.
    Folded words are kept as Latin-1 bytes; those met in the last ``limit / 2``
    outlive the bound.
    """

    def __init__(self, json_text: str, spaced: bool, limit: int = 300_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.fold = not spaced
        self.limit = limit
        #: For words of letters: the same model, without the steps that leave such a word as it is.
        self.words = _words_only(self.tokenizer) if self.fold else self.tokenizer
        vocabulary = sorted(self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        # tokens at which a word of letters begins (spaced) or ends
        self.edge = bytearray(max(i for _, i in vocabulary) + 1)
        for token, i in vocabulary:
            self.edge[i] = token.startswith("Ġ") if spaced else token.endswith("</w>")
        self.known: dict = {}
        self.older: dict = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _letters(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that are one pre-token each: many in one text, told
        apart by their first or last tokens."""
        import numpy as np

        out, edge = [], np.frombuffer(self.edge, np.uint8)
        chunks = [parts[i : i + 64] for i in range(0, len(parts), 64)]
        texts = ["".join(c) if not self.fold else " ".join(c) for c in chunks]
        for chunk, found in zip(chunks, self.words.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(edge[ids])
            if len(cuts) != len(chunk):  # not told apart: one by one
                out += self._library(chunk)
                continue
            ends = (cuts + 1 if self.fold else np.append(cuts[1:], len(ids))).tolist()
            raw, at = ids.tobytes(), 0
            for end in ends:
                out.append(raw[at : 4 * end])
                at = 4 * end
        return out

    def _spaced(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known.clear()
        known, parts = self.known, [SPACED.findall(t) for t in texts]
        new = set().union(*parts).difference(known)
        letters = [p for p in new if p[0] == " " and p[1:].isalpha()]
        others = list(new.difference(letters))
        known.update(zip(letters, self._letters(letters)))
        known.update(zip(others, self._library(others)))
        return [b"".join(map(known.__getitem__, p)) for p in parts]

    def _folded(self, texts: list[str]) -> list[bytes]:
        """All texts cut side by side; each distinct word is looked up once."""
        import numpy as np
        import pyarrow as pa

        if not texts:
            return []
        rows = [t.lower().encode("latin-1") + b" " for t in texts]
        text = np.cumsum([0, *map(len, rows)])
        raw = b"".join(rows)
        kind = np.frombuffer(KIND, np.uint8)[np.frombuffer(raw, np.uint8)]
        edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(raw)]))
        buffers = [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(raw)]
        parts = pa.Array.from_buffers(pa.large_binary(), len(edge) - 1, buffers).dictionary_encode()
        ids = self._ids(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        code = parts.indices.to_numpy()
        count = size[code]
        end = np.concatenate(([0], np.cumsum(count)))
        at = np.repeat((np.cumsum(size) - size)[code] - end[:-1], count) + np.arange(end[-1])
        stream = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        # white space has no ids, so a text's begin where its first whole part does
        cuts = (4 * end[np.searchsorted(edge, text)]).tolist()
        return [stream[a:b] for a, b in zip(cuts, cuts[1:])]

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """Ids of distinct folded parts; white space has none."""
        if len(self.known) > self.limit // 2:
            self.known, self.older = {}, self.known
        known, older, letters, others = self.known, self.older, [], []
        for part in parts:
            if part not in known:
                if part in older:
                    known[part] = older[part]
                elif KIND[part[0]]:
                    (letters if KIND[part[0]] == 1 else others).append(part)
                else:
                    known[part] = b""
        known.update(zip(letters, self._letters([p.decode("latin-1") for p in letters])))
        known.update(zip(others, self._library([p.decode("latin-1") for p in others])))
        return [known[p] for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain, unusual = [], []
        for i, text in enumerate(texts):
            (plain if PLAIN.fullmatch(text) and "<|" not in text else unusual).append(i)
        out = [b""] * len(texts)
        cut = self._folded if self.fold else self._spaced
        for where, found in ((plain, cut([texts[i] for i in plain])), (unusual, self._library([texts[i] for i in unusual]))):
            for i, ids in zip(where, found):
                out[i] = ids
        return out


def _words_only(tokenizer):
    """``tokenizer`` for lower-case words between blanks: no normalizer, cut at
    white space; itself, unless its cut is a pattern and then bytes."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split, WhitespaceSplit

    cut = tokenizer.pre_tokenizer
    if not isinstance(cut, Sequence) or [type(x) for x in cut] != [Split, ByteLevel]:
        return tokenizer
    words = Tokenizer(tokenizer.model)
    words.pre_tokenizer = Sequence([WhitespaceSplit(), cut[1]])
    return words


def tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
