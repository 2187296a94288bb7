"""Byte-pair encoding and decoding with a public vocabulary (operator 1).

``encode`` gives each document's ids as the tokenizers library does (no special tokens added, no truncation);
``decode`` turns ids back into text. A text is cut into pieces by the tokenizer's own normaliser and splitter, and each
distinct piece goes through the library's model once per worker and bounded memo. A piece too long for one merge pass
is encoded by tree concatenation, see ``encode_long``.

Defined cases: a null or empty text has no ids and decodes to the empty text; texts of any length are whole;
repeated rows each give a row; an empty table gives an empty table; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import DataFrame

from firnline.llm.common import map_rows

#: Bytes of a piece from which tree concatenation is used, and the longest leaf of its tree.
SPLIT_BYTES = 4096
LEAF_BYTES = 1024
#: Memo entries a worker keeps; beyond this it starts afresh, so memory stays bounded.
MEMO_ENTRIES = 300_000

#: Characters for which Python's lower() and splitting equal the library's normaliser: printable ASCII, line breaks,
#: and Latin letters that are their own composed form. Any other text takes the library's own normaliser.
_PLAIN = re.compile("[^\\t\\n\\r -~¡-©«¬®-±´¶-¸»¿-įı-ňŊ-ž]")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo(dict):
    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, key):
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[key] = self._make(key)
        return value


class PieceEncoder:
    """Ids of texts under one tokenizer file, equal to the library's ``encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        self.whole = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        bare = {k: v for k, v in spec.items() if k != "model"} | {"normalizer": None, "pre_tokenizer": None, "added_tokens": [], "truncation": None, "padding": None}
        self.final = Tokenizer.from_str(json.dumps(bare | {"model": spec["model"]}))  # the piece's last part carries the end-of-word mark
        self._inner = lambda: Tokenizer.from_str(json.dumps(bare | {"model": json.loads(open(path, encoding="utf-8").read())["model"] | {"end_of_word_suffix": None}}))
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.table = _byte_letters()
        self.token = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.token}
        self.pieces = _Memo(self._piece)
        self.chunks = _Memo(self._chunk)

    @cached_property
    def inner(self):
        """The model without end-of-word marks, for parts inside a piece; few texts need it."""
        return self._inner()

    def letters(self, piece: str) -> str:
        return piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.table)

    def _piece(self, letters: str) -> bytes:
        if len(letters) > SPLIT_BYTES:
            return b"".join([self.packed[i] for i in encode_long(letters, self)])
        return b"".join([self.packed[t.id] for t in self.final.model.tokenize(letters)])

    def _chunk(self, chunk: str) -> bytes:
        """A lower-case run without blanks."""
        if chunk.isalpha():
            return self._piece(self.letters(chunk))
        return b"".join([self.pieces[self.letters(p)] for p in _PIECES.findall(chunk)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not _PLAIN.search(text):
            parts = text.lower().split()
            if max(map(len, parts), default=0) > SPLIT_BYTES:  # too long to keep
                return b"".join([self._chunk(p) if len(p) > SPLIT_BYTES else self.chunks[p] for p in parts])
            return b"".join(map(self.chunks.__getitem__, parts))
        split = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(text))
        return b"".join([self.pieces[p] if len(p) <= SPLIT_BYTES else self._piece(p) for p, _ in split])

    def decode(self, ids) -> str:
        return " ".join(map(self.token.__getitem__, ids))


def encode_long(letters: str, encoder: PieceEncoder) -> list[int]:
    """Tree concatenation of one unsplit piece.

    Halves are cut down to leaves, which the library encodes in parallel; neighbours are then joined pairwise up the
    tree. At a join, a window of tokens on either side is encoded again and grows until its first and last token are
    the ones already there. Then every adjacent pair of tokens is one that the merge rules leave apart, which makes
    the joined sequence the encoding of the whole piece.
    """
    cuts = [0]
    while cuts[-1] < len(letters):
        cuts.append(min(len(letters), cuts[-1] + LEAF_BYTES))
    leaves = [letters[a:b] for a, b in zip(cuts, cuts[1:])]
    encoded = [e.ids for e in encoder.inner.encode_batch(leaves[:-1], add_special_tokens=False)] if len(leaves) > 1 else []
    encoded.append([t.id for t in encoder.final.model.tokenize(leaves[-1])])
    while len(encoded) > 1:
        paired = [_join(encoded[i], encoded[i + 1], i + 2 == len(encoded), encoder) for i in range(0, len(encoded) - 1, 2)]
        encoded = paired + encoded[len(paired) * 2 :]
    return encoded[0]


def _join(left: list[int], right: list[int], at_end: bool, encoder: PieceEncoder) -> list[int]:
    spell = encoder.token.__getitem__
    width = 4
    while True:
        a, b = max(0, len(left) - width), min(len(right), width)
        whole_right = b == len(right)
        text = "".join(map(spell, left[a:])) + "".join(map(spell, right[:b]))
        ends = at_end and whole_right
        model = encoder.final.model if ends else encoder.inner.model
        again = [t.id for t in model.tokenize(text[: len(text) - len(encoder.suffix)] if ends and encoder.suffix else text)]
        left_agrees = a == 0 or again[0] == left[a]
        right_agrees = whole_right or again[-1] == right[b - 1]
        if left_agrees and right_agrees:
            return left[:a] + again + right[b:]
        width *= 2


@lru_cache(maxsize=4)
def encoder_for(path: str) -> PieceEncoder:
    """One encoder per worker process and file."""
    return PieceEncoder(path)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long, ids binary): the ids of each whole text, little-endian unsigned 32-bit."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(columns):
        encoder = encoder_for(tokenizer_path)
        ids = [encoder.encode(t) for t in columns["text"].to_pylist()]
        return {id_col: columns[id_col], "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

    return map_rows(docs.select(docs[id_col], docs[text_col].alias("text")), run, f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id") -> DataFrame:
    """Adds ``decoded``: the library's ``decode(ids, skip_special_tokens=False)`` of the binary column ``ids``."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(columns):
        encoder = encoder_for(tokenizer_path)
        texts = [encoder.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in columns["ids"].to_pylist()]
        return {id_col: columns[id_col], "n_tokens": columns["n_tokens"], "ids": columns["ids"], "decoded": texts}

    return map_rows(encoded.select(id_col, "n_tokens", "ids"), run, f"`{id_col}` {kind}, n_tokens long, ids binary, decoded string")
