"""Removal of byte strings that occur more than once in the corpus (operator 9).

No suffix array is built. Content-defined samples are grouped by fingerprint of their gram, then of the region around it,
and what is left window by window: names, documents and places pass through a queue of sorted runs that spills to disk
(``RunQueue``), in which equal names are neighbours. See ``repeats`` for what is compared where.

Defined cases: a null text is empty; texts shorter than the length keep every byte; matches never cross documents;
rows with one id, of equal or different texts, are occurrences of their own; rows without an id are compared with nothing and stay
whole; an empty table gives an empty table; further columns are ignored. ``kept`` may split a character where a repeat begins inside
it, unless ``whole_characters`` is set.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from firnline.llm.common import Scratch, map_rows
from firnline.llm.repeats import NOTHING, OCCURRENCE, Units, covered, find_repeats, keyed, with_marks
from firnline.llm.wordhash import _CODE, to_bytes

GRAM = 64


def _cut(texts):
    raw = [to_bytes(t) for t in texts]
    return _CODE[np.frombuffer(b"".join(raw), np.uint8)], np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _whole(own: bytes, gone: np.ndarray) -> np.ndarray:
    """``gone`` without the bytes of characters that it holds in part."""
    codes = np.frombuffer(own, np.uint8)
    begin = np.flatnonzero((codes & 0xC0) != 0x80)
    if len(begin) == len(codes):
        return gone
    return np.repeat(np.minimum.reduceat(gone, begin), np.diff(np.append(begin, len(codes))))


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", first_stays: bool = False, whole_characters: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept): removed [start, end) runs and the remaining bytes.

    With ``first_stays`` the first occurrence of each string, by (id, start), keeps its place and all later ones go,
    those in the same document included; of one that overlaps the first, the bytes after the first's end.
    ``whole_characters`` leaves characters whole that a run holds in part. ``carry``: further columns to keep.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    slim = keyed(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")))
    marks = find_repeats(slim.where("id is not null"), Units(_cut, length, min(GRAM, length)), OCCURRENCE if first_stays else NOTHING, scratch)
    kinds = dict(docs.dtypes)
    kept_too = [f"_carried_{i}" for i in range(len(carry))]
    whole = keyed(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"), *[docs[c].alias(n) for c, n in zip(carry, kept_too)]))
    marked = with_marks(whole, marks).select("id", "text", "low", "high", *kept_too)

    def cut(columns):
        sizes, removed, spans, kept = [], [], [], []
        for text, low, high in zip(*(columns[c].to_pylist() for c in ("text", "low", "high"))):
            own = to_bytes(text)
            edges = np.zeros((0, 2), np.int64)
            left = own
            if low:
                gone = covered(len(own), low, high, length)
                if whole_characters:
                    gone = _whole(own, gone)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).view(np.int8))).reshape(-1, 2)
                left = np.frombuffer(own, np.uint8)[~gone].tobytes()
            sizes.append(len(own))
            removed.append(len(own) - len(left))
            spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
            kept.append(left)
        return {id_col: columns["id"], "n_bytes": sizes, "n_removed": removed, "spans": spans, "kept": kept} | {c: columns[n] for c, n in zip(carry, kept_too)}

    schema = f"`{id_col}` long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return map_rows(marked, cut, ", ".join([schema, *(f"`{c}` {kinds[c]}" for c in carry)]))
