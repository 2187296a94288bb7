"""Counts over whole texts that the quality operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from firnline.llm.common import BLANKS, map_rows

SYMBOLS = b"#*$%&|<>"
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_distinct_words", "n_sentence_ends")


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in three-word windows that occur twice or more (first ones too), and the number of distinct words."""
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    n, d = len(ids), len(index)
    if n < 4:
        return 0, d
    pairs = ids[:-1] * d + ids[1:]
    if d > 1 << 20:  # three ids would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    triples = pairs[:-1] * d + ids[2:]
    order = np.argsort(triples, kind="stable")
    ordered = triples[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0, d
    repeated = np.zeros(len(triples), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= repeated
    covered[1:-1] |= repeated
    covered[2:] |= repeated
    return int(covered.sum()), d


_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def stats(text: str | None) -> tuple[int, ...]:
    """FIELDS of one text; words are runs of anything but ASCII blanks, a null text has none."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeat, distinct = repeated_words(words)
    return (
        len(words),
        len(text) - blanks,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat,
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LETTERS)),
        distinct,
        sum(map(raw.count, (b". ", b"! ", b"? ", b".\n", b"!\n", b"?\n"))) + (raw[-1:] in (b".", b"!", b"?")),
    )


def with_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and FIELDS (long) of each document."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), *(f"{f} long" for f in FIELDS)])

    def run(columns):
        rows = [stats(t) for t in columns["_text"].to_pylist()]
        return {k: columns[k] for k in keep} | dict(zip(FIELDS, map(list, zip(*rows)) if rows else [[]] * len(FIELDS)))

    return map_rows(docs.select(*[docs[k] for k in keep], docs[text_col].alias("_text")), run, schema)
