"""Removal of word passages that a document with a smaller id has too (operator 5).

Prefix-partitioned suffix trees. Windows of a passage that could repeat are the suffixes; they are dealt into groups by
a prefix: the sampled gram of GRAM words that all windows around it share (see ``repeats``, which also settles what
needs no tree: grams that stand in one document only, and regions that equal one of a smaller id whole). Groups that
would not fit a task take a longer prefix, the gram and the window's own first words. Each task grows the subtree of
its group over the words themselves: a node at depth d splits by the node that its suffixes reach after d more words,
so depths double up to the window's length, and every comparison is of words, not of fingerprints. Internal nodes as
deep as a window, those with two leaves or more, are the maximal repeats; a leaf goes if its node has one of a smaller id.

Defined cases: words are runs of anything but ASCII blanks; a null or empty text has none and is kept empty; texts
shorter than a window keep every word; rows with one id, of equal or different texts, are the same document and
remove nothing of each other; rows without an id are compared with nothing and stay whole; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firnline.llm.common import Scratch, arrow_schema, map_rows
from firnline.llm.repeats import DOCUMENT, Units, covered, find_repeats, keyed, with_marks
from firnline.llm.wordhash import to_bytes, words

GRAM = 8
#: A share of ``repeats`` is cut into so many, as its windows' words take more room than their fingerprints.
PARTS = 4


def _cut(texts):
    hashes, _, _, owner = words([to_bytes(t) for t in texts])
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
    return hashes, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


#: A piece of a text: ``count`` windows from ``start`` on.
_PIECE = np.dtype([("doc", "<i8"), ("part", "<i8"), ("start", "<i4"), ("count", "<i4")])


def deep_nodes(codes: np.ndarray, depth: int) -> np.ndarray:
    """For each position with ``depth`` codes from it on, the number of its node at that depth of the suffix tree."""
    node, reached = codes, 1
    while reached < depth:
        step = min(reached, depth - reached)
        node = np.unique(node[:-step] * (int(node.max(initial=0)) + 1) + node[step:], return_inverse=True)[1]
        reached += step
    return node


def repeated_leaves(pieces: np.ndarray, words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start) of windows whose deep node has a leaf of a smaller document; ``words`` are the pieces' in turn."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(pieces):
        return nothing
    codes = np.asarray(pa.array(words, pa.binary()).dictionary_encode().indices).astype(np.int64)
    node = deep_nodes(codes, window)
    count = pieces["count"].astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(count + window - 1)[:-1]])
    piece = np.repeat(np.arange(len(pieces)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    leaf = node[begin[piece] + offset]
    doc = pieces["doc"][piece]
    least = np.full(int(leaf.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, leaf, doc)
    again = doc > least[leaf]
    return piece[again], pieces["start"][piece[again]] + offset[again]


def _grown(docs: DataFrame, asking: DataFrame, units: Units, stays: str, shares: int, scratch: Scratch) -> DataFrame:
    """Ranges of windows that repeat among those asked for, by the subtrees of their prefixes."""
    window, shares = units.length, shares * PARTS
    texts = docs.join(asking, (F.col("id") == F.col("_id")) & (F.col("part") == F.col("_part"))).select("id", "part", "text", "spans")

    def deal(columns):
        dealt = defaultdict(lambda: ([], []))
        for doc, part, text, spans in zip(*(columns[c].to_pylist() for c in ("id", "part", "text", "spans"))):
            own = to_bytes(text).split()
            for span in spans:
                low, high, salts = span["low"], span["high"], span["salts"]
                runs = [(low, high, 0)] if salts == 1 else [(s, s, zlib.crc32(b" ".join(own[s : s + units.gram])) % salts) for s in range(low, high + 1)]
                for a, b, salt in runs:
                    heads, parts = dealt[(span["gram"] ^ (salt * 0x9E3779B97F4A7C1)) % shares]
                    heads.append((doc, part, a, b - a + 1))
                    parts.append(b" ".join(own[a : b + window]))
        rows = list(dealt.items())
        return {"share": [k for k, _ in rows], "heads": [np.array(h, _PIECE).tobytes() for _, (h, _) in rows], "words": [b" ".join(t) for _, (_, t) in rows]}

    schema = StructType.fromDDL("id long, part long, low int, high int")
    out = arrow_schema(schema)

    def judge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, words = [np.zeros(0, _PIECE)], []
        for batch in batches:
            for head, text in zip(batch.column("heads").to_pylist(), batch.column("words").to_pylist()):
                heads.append(np.frombuffer(head, _PIECE))
                words += text.split()
        pieces = np.concatenate(heads)
        piece, start = repeated_leaves(pieces, words, window)
        doc, part = pieces["doc"][piece], pieces["part"][piece]
        order = np.lexsort((start, part, doc))
        doc, part, start = doc[order], part[order], start[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]) | (start[1:] > start[:-1] + 1)])) if len(doc) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(doc)) - 1 if len(doc) else new
        yield pa.RecordBatch.from_arrays([pa.array(doc[new], pa.int64()), pa.array(part[new], pa.int64()), pa.array(start[new].astype(np.int32)), pa.array(start[last].astype(np.int32))], schema=out)

    # applyInArrow sees by these annotations that a group comes batch by batch
    judge.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    dealt = map_rows(texts, deal, "share long, heads binary, words binary")
    return scratch.save(dealt.groupBy("share").applyInArrow(judge, schema), "judged")


def remove_passages(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): ``kept`` is the remaining words joined by one space, as UTF-8 bytes."""
    scratch = Scratch(docs.sparkSession, "substring")
    slim = keyed(docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")))
    marks = find_repeats(slim.where("id is not null"), Units(_cut, window, min(GRAM, window)), DOCUMENT, scratch, _grown)
    marked = with_marks(slim, marks).select("id", "text", "low", "high")

    def cut(columns):
        counts, removed, kept = [], [], []
        for text, low, high in zip(*(columns[c].to_pylist() for c in ("text", "low", "high"))):
            own = to_bytes(text).split()
            gone = covered(len(own), low, high, window) if low else None
            left = own if gone is None else [w for w, g in zip(own, gone.tolist()) if not g]
            counts.append(len(own))
            removed.append(len(own) - len(left))
            kept.append(b" ".join(left))
        return {id_col: columns["id"], "n_words": counts, "n_removed": removed, "kept": kept}

    return map_rows(marked, cut, f"`{id_col}` long, n_words long, n_removed long, kept binary")
