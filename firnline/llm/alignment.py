"""Cross-tokenizer alignment (operator 12): which tokens of one tokenizer cover the bytes of which tokens of another.

Every text, with a space put before it, is encoded by a byte-level BPE vocabulary (A) and a piece vocabulary with byte
fallback (B). Tokens times bytes is a sparse 0/1 matrix on either side; the product of A's with the transpose of B's
has an entry for each pair of tokens that overlap, its value the number of shared bytes. Tokens times groups (stretches
between places where tokens of both sides end) is a second pair of matrices, whose product pairs all tokens that share
a group. Matrices are compressed rows (``Csr``) and products go row by row (``product``), in slabs of bounded size.

Neither vocabulary joins letters across a blank that follows a letter, so both matrices fall into blocks, one per such
unit of text. A chunk of documents multiplies each distinct block once and gathers the blocks of each document.

Counts need all documents: a chunk writes its documents with the numbers of their pairs, and each of its distinct pairs
with the documents that hold it. Pairs are summed over all chunks, and their counts come back to each chunk by one join;
a pair stands in a chunk once, however many documents hold it, so no key is hot and nothing is broadcast.

Defined cases: null and empty texts, and texts whose tokens do not spell them, have no tokens, and get zeros and an
empty ``groups_sha256``; texts and words of any length are whole; repeated rows each count and give a row; an empty
table gives an empty table; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.bpe import _byte_letters
from firnline.llm.common import Scratch, arrow_schema

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Entries of the left matrix that one slab of a product takes.
SLAB = 1 << 20
#: Bytes of units that the tokenizers get at a time, and of a unit that is encoded by itself.
ENCODE_BYTES = 1 << 16
#: Fixed value: how byte-level BPE of this vocabulary splits a text before its merges.
SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A piece longer than this goes to the library whose merges take a heap.
LONG_PIECE = 2048
SPACE_MARK = "▁"


# Sparse matrices


class Csr(NamedTuple):
    """Compressed rows: row i has the columns indices[indptr[i]:indptr[i + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int


def incidence(ends: np.ndarray) -> Csr:
    """Tokens times bytes, from the tokens' ends."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(total, dtype=np.int64), total)


def memberships(group: np.ndarray, groups: int) -> Csr:
    """Tokens times groups: each token is in one."""
    return Csr(np.arange(len(group) + 1, dtype=np.int64), group.astype(np.int64), groups)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    indptr = np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=m.columns))])
    return Csr(indptr.astype(np.int64), rows[order], len(m.indptr) - 1)


def product(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of left times right, in slabs of rows: for each entry of a row of ``left``, the row of
    ``right`` that it names, summed up."""
    widths = np.diff(right.indptr)
    work = np.concatenate([[0], np.cumsum(widths[left.indices])])[left.indptr]  # products before each row
    low, n = 0, len(left.indptr) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(work, work[low] + SLAB, "right")) - 1)
        entries = left.indices[left.indptr[low] : left.indptr[high]]
        row = np.repeat(np.arange(low, high), np.diff(left.indptr[low : high + 1]))
        column, width = gathered(right.indptr, right.indices, entries)
        key = np.repeat(row, width) * right.columns + column
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            key.sort()
        lead = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        value = np.diff(np.concatenate([lead, [len(key)]]))
        yield *np.divmod(key[lead], max(1, right.columns)), value
        low = high


def product_size(left: Csr, right: Csr) -> np.ndarray:
    """Entries in each row of a product whose left rows have one entry each: the symbolic half of the product."""
    return np.diff(right.indptr)[left.indices]


def gathered(indptr: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows one after another, and how many each has."""
    width = indptr[rows + 1] - indptr[rows]
    at = np.repeat(indptr[rows] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
    return values[at], width


# Tokenizers


class _Side(NamedTuple):
    indptr: np.ndarray  # of the tokens of each unit
    ids: np.ndarray
    good: np.ndarray  # units whose tokens spell them


class _Spelling:
    """Bytes of a vocabulary's tokens, as one buffer."""

    def __init__(self, tokens: dict[int, bytes]):
        size = max(tokens) + 1
        spelled = [tokens.get(i, b"") for i in range(size)]
        self.length = np.array([len(t) for t in spelled], np.int64)
        self.indptr = np.concatenate([[0], np.cumsum(self.length)])
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.indptr, self.bytes, ids)[0]


class ByteTokenizer:
    """Byte-level BPE from a tokenizers file whose ids follow the order of its merges."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        vocab = spec["model"]["vocab"]
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        if [vocab[t] for t in joined] != sorted(vocab[t] for t in joined):
            raise ValueError(f"ids of {path} do not follow its merges")
        special = {t["content"] for t in spec["added_tokens"]}
        tokens = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items() if t not in special}
        self.spelling = _Spelling(tokens)
        self.fast = tiktoken.Encoding("alignment", pat_str=SPLITS, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={})
        self.whole = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.whole.encode_special_tokens = True
        self._long = regex.compile(rf"\S{{{LONG_PIECE},}}|\s{{{LONG_PIECE},}}")

    def encode(self, text: str, longest: int = LONG_PIECE + 1) -> list[int]:
        """``text`` begins with the space; its longest unit has ``longest`` bytes at most."""
        if longest > LONG_PIECE and self._long.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceTokenizer:
    """A sentencepiece model, which puts the space before the text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        piece = self.model.id_to_piece
        self.spelling = _Spelling({i: bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace(SPACE_MARK, " ").encode() for i in ids})

    def encode(self, text: str, longest: int = 0) -> list[int]:
        return self.model.encode(text[1:])


@lru_cache(maxsize=2)
def _tokenizers(byte_path: str, piece_path: str) -> tuple[ByteTokenizer, PieceTokenizer]:
    return ByteTokenizer(byte_path), PieceTokenizer(piece_path)


_BLANK_SPACE = re.compile(f"[\\s\x1c-\x1f\x85{SPACE_MARK}](?: |$)")


def units_of(text: str) -> list[str]:
    """The text with a space before it, cut before each space that follows neither a blank nor a space mark."""
    parts = (" " + text).split(" ")[1:]
    if not _BLANK_SPACE.search(text) and text[:1] != " ":
        return parts
    out, open_ = [], False
    for part in parts:
        if open_:
            out[-1] = f"{out[-1]} {part}"
        else:
            out.append(part)
        open_ = not out[-1] or _ends_blank(out[-1])
    if len(out) > 1 and open_:  # blanks at the end belong to the unit before them
        out[-2:] = [f"{out[-2]} {out[-1]}"]
    return out


def _ends_blank(part: str) -> bool:
    return part[-1:].isspace() or part[-1:] == SPACE_MARK or part[-1:] in "\x1c\x1d\x1e\x1f\x85"


def _encoded(units: list[bytes], offsets: np.ndarray, data: np.ndarray, tokenizer) -> _Side:
    """Tokens of each unit. Units are encoded many at a time, and cut at their ends; where that fails, one by one."""
    parts, low, longest = [], 0, np.diff(offsets)
    good = np.ones(len(units), bool)
    while low < len(units):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + ENCODE_BYTES, "right")) - 1)
        high = min(high, len(units))
        ids = np.array(tokenizer.encode(b"".join(units[low:high]).decode(), int(longest[low:high].max())), np.int64)
        ends = np.cumsum(tokenizer.spelling.length[ids])
        want = offsets[low + 1 : high + 1] - offsets[low]
        cut = np.searchsorted(ends, want)
        whole = len(ends) > 0 and ends[-1] == want[-1] and (ends[np.minimum(cut, len(ends) - 1)] == want).all()
        if whole and np.array_equal(tokenizer.spelling.spell(ids), data[offsets[low] : offsets[high]]):
            parts.append((ids, np.diff(np.concatenate([[0], cut + 1]))))
        else:
            for u in range(low, high):
                one = np.array(tokenizer.encode(units[u].decode()), np.int64)
                good[u] = tokenizer.spelling.spell(one).tobytes() == units[u]
                parts.append((one, np.array([len(one)])))
        low = high
    ids = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.int64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    return _Side(np.concatenate([[0], np.cumsum(counts)]), ids, good)


# Blocks


class Blocks(NamedTuple):
    """Per distinct unit: tokens, groups, overlap links and the written groups."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_group_links: np.ndarray
    link_indptr: np.ndarray
    pairs: np.ndarray  # distinct id pairs, A's id times 2**32 plus B's
    link_pair: np.ndarray  # each link's place in pairs
    written: list[bytes]


def blocks_of(texts: list[str], byte_path: str, piece_path: str) -> Blocks:
    """Matrix products of distinct units; ``texts`` are units without their first space."""
    a_tok, b_tok = _tokenizers(byte_path, piece_path)
    # units that end in a blank are encoded apart from what follows them
    units = [b" " + t.encode() for t in texts]
    closed = np.array([bool(t) and not _ends_blank(t) for t in texts], bool)
    order = np.concatenate([np.flatnonzero(closed), np.flatnonzero(~closed)])
    sides = []
    for tokenizer in (a_tok, b_tok):
        found = []
        for some in (np.flatnonzero(closed), np.flatnonzero(~closed)):
            mine = [units[i] for i in some]
            offsets = np.concatenate([[0], np.cumsum([len(u) for u in mine])]).astype(np.int64)
            if len(some) and not closed[some[0]]:
                ids = [np.array(tokenizer.encode(u.decode()), np.int64) for u in mine]
                good = np.array([tokenizer.spelling.spell(i).tobytes() == u for i, u in zip(ids, mine)])
                found.append(_Side(np.concatenate([[0], np.cumsum([len(i) for i in ids])]), np.concatenate(ids), good))
            else:
                found.append(_encoded(mine, offsets, np.frombuffer(b"".join(mine), np.uint8), tokenizer))
        first, second = found
        both = _Side(np.concatenate([first.indptr, second.indptr[1:] + first.indptr[-1]]), np.concatenate([first.ids, second.ids]), np.concatenate([first.good, second.good]))
        back = np.argsort(order, kind="stable")
        ids, counts = gathered(both.indptr, both.ids, back)
        sides.append(_Side(np.concatenate([[0], np.cumsum(counts)]), ids, both.good[back]))
    a, b = sides
    good = a.good & b.good
    if not good.all():  # a text with such a unit has no tokens at all
        a, b = (_Side(np.concatenate([[0], np.cumsum(np.where(good, np.diff(s.indptr), 0))]), s.ids[np.repeat(good, np.diff(s.indptr))], good) for s in (a, b))
    a_end, b_end = np.cumsum(a_tok.spelling.length[a.ids]), np.cumsum(b_tok.spelling.length[b.ids])
    both_end = np.zeros((int(a_end[-1]) if len(a_end) else 0) + 1, np.int8)
    both_end[a_end] += 1
    both_end[b_end] += 1
    group_of_end = np.cumsum(both_end == 2)  # groups closed up to each offset
    a_group, b_group = group_of_end[a_end - 1], group_of_end[b_end - 1]
    groups = int(group_of_end[-1])

    rows, columns = [], []
    for row, column, _ in product(incidence(a_end), transposed(incidence(b_end))):
        rows.append(row)
        columns.append(column)
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    column = np.concatenate(columns) if columns else np.zeros(0, np.int64)
    unit_of_a = np.repeat(np.arange(len(units)), np.diff(a.indptr))
    unit_of_b = np.repeat(np.arange(len(units)), np.diff(b.indptr))
    shared = product_size(memberships(a_group, groups), transposed(memberships(b_group, groups)))
    pairs, link_pair = np.unique((a.ids[row] << 32) | b.ids[column], return_inverse=True)
    closes = np.concatenate([a_group[1:] != a_group[:-1], [True]]) if len(a_group) else np.zeros(0, bool)
    n = len(units)

    def per_unit(unit, weight=None):
        return np.bincount(unit, weight, minlength=n).astype(np.int64)

    return Blocks(
        good, np.diff(a.indptr), np.diff(b.indptr), per_unit(unit_of_a[closes]), per_unit(unit_of_a, shared),
        np.concatenate([[0], np.cumsum(per_unit(unit_of_a[row]))]), pairs, link_pair, _written(a, b, a_group, b_group, unit_of_b),
    )


_DIGITS = 10


@lru_cache(maxsize=1)
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    text = [str(i).encode() for i in range(size)]
    return np.array(text, f"S{_DIGITS}").view(np.uint8).reshape(size, _DIGITS), np.array([len(t) for t in text])


def _written(a: _Side, b: _Side, a_group: np.ndarray, b_group: np.ndarray, unit_of_b: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each unit."""
    n = len(a.ids) + len(b.ids)
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    of_a, of_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    place_a = np.arange(len(a.ids)) + (np.cumsum(of_b) - of_b)[a_group]
    place_b = np.arange(len(b.ids)) + np.cumsum(of_a)[b_group]
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[place_a], ids[place_b] = a.ids, b.ids
    last = np.cumsum(of_a + of_b)
    mark[last - of_b - 1] = ord("|")
    mark[last - 1] = ord(";")
    if not n:
        return [b""] * (len(a.indptr) - 1)
    size = 1 << int(ids.max()).bit_length()
    digits, length = _decimals(size)
    wide, length = digits[ids], length[ids]
    wide[np.arange(n), length] = mark
    text = wide[np.arange(_DIGITS) <= length[:, None]].tobytes()
    stop = np.concatenate([[0], np.cumsum(length + 1)])[(a.indptr + b.indptr)]
    return [text[i : j - 1] if j > i else b"" for i, j in zip(stop[:-1].tolist(), stop[1:].tolist())]


# Spark


_CHUNK = "chunk long, doc_ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, n_group_links array<long>, sha array<string>, held array<int>, steps binary, times binary, pairs array<long>, holders array<int>"
_STATS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def _chunk(ids: list, texts: list[str | None], byte_path: str, piece_path: str) -> dict:
    number: dict[str, int] = {}
    in_doc = [units_of(t) if t else [] for t in texts]
    unit = np.array([number.setdefault(u, len(number)) for units in in_doc for u in units], np.int64)
    counts = np.array([len(u) for u in in_doc], np.int64)
    blocks = blocks_of(list(number), byte_path, piece_path)
    owner = np.repeat(np.arange(len(ids)), counts)
    spelled = np.bincount(owner, ~blocks.good[unit], minlength=len(ids)) == 0
    keep = spelled[owner]
    unit, owner = unit[keep], owner[keep]
    out = {name: np.bincount(owner, getattr(blocks, name)[unit], minlength=len(ids)).astype(np.int64) for name in ("n_a", "n_b", "n_groups", "n_group_links")}
    pair, width = gathered(blocks.link_indptr, blocks.link_pair, unit)
    doc = np.repeat(owner, width)
    out["n_links"] = np.bincount(doc, minlength=len(ids)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(np.where(spelled, counts, 0))]).tolist()
    unit, written = unit.tolist(), blocks.written.__getitem__
    out["sha"] = [hashlib.sha256(b";".join(map(written, unit[i:j]))).hexdigest() if j > i else "" for i, j in zip(first, first[1:])]

    key = np.sort(doc * max(1, len(blocks.pairs)) + pair)
    lead = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    times = np.diff(np.concatenate([lead, [len(key)]]))
    doc, pair = np.divmod(key[lead], max(1, len(blocks.pairs)))
    holders = np.bincount(pair, minlength=len(blocks.pairs))
    used = holders > 0  # a unit of none but texts without tokens
    pair = (np.cumsum(used) - 1)[pair]
    step = np.diff(pair, prepend=0) % (1 << 32)
    out |= {"doc_ids": ids, "held": np.bincount(doc, minlength=len(ids)), "steps": _narrow(step), "times": _narrow(times)}
    return out | {"pairs": blocks.pairs[used], "holders": holders[used]}


def _narrow(values: np.ndarray) -> bytes:
    """Counts in 16-bit steps; the few larger ones follow with their places."""
    big = np.flatnonzero(values >= 0xFFFF)
    small = np.minimum(values, 0xFFFF).astype("<u2")
    return np.int64(len(values)).tobytes() + small.tobytes() + big.astype("<i8").tobytes() + values[big].astype("<i8").tobytes()


def _wide(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    out = np.frombuffer(data, "<u2", n, 8).astype(np.int64)
    rest = np.frombuffer(data[8 + 2 * n :], "<i8")
    out[rest[: len(rest) // 2]] = rest[len(rest) // 2 :]
    return out


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and size + len(t or "") > CHUNK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t or "")
    if texts:
        yield ids, texts


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256).

    A pair's count is the number of documents that hold it as an overlap link. ``n_best`` counts the links whose count
    is the highest of their A token's, and ``count_sum`` adds up the counts of all links.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(docs[id_col], docs[text_col].alias("text"))
    schema = _CHUNK.format(kind=kind)
    from pyspark.sql.types import StructType

    arrow = arrow_schema(StructType.fromDDL(schema))

    def multiply(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_chunks(batches)):
            row = _chunk(ids, texts, byte_path, piece_path) | {"chunk": base + number}
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

    chunks = scratch.save(slim.mapInArrow(multiply, schema), "chunks")
    met = chunks.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("holders").alias("n")))).groupBy("pair").agg(F.sum("n").alias("count"))
    counts = scratch.save(met.withColumn("a", F.shiftright("pair", 32)), "counts")
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    ranked = counts.join(best, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    placed = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    of_chunk = placed.join(ranked, "pair").groupBy("chunk").agg(F.collect_list(F.struct("place", "count", "best")).alias("counts"))
    of_chunk = of_chunk.withColumnRenamed("chunk", "_chunk")
    result = f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_group_links long, n_best long, count_sum long, groups_sha256 string"
    given = arrow_schema(StructType.fromDDL(result))

    def add_up(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                flat = {n: one.column(k).flatten() for k, n in enumerate(one.schema.names) if pa.types.is_list(one.schema.field(k).type)}
                held = flat["held"].to_numpy()
                found = flat["counts"]
                count, top = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
                place = found.field("place").to_numpy()
                count[place], top[place] = found.field("count").to_numpy(), found.field("best").to_numpy(zero_copy_only=False)
                pair = np.cumsum(_wide(one.column("steps")[0].as_py())) % (1 << 32)
                times = _wide(one.column("times")[0].as_py())
                stop = np.cumsum(held)
                sums = [np.concatenate([[0], np.cumsum(times * x[pair])]) for x in (count, top)]
                sums = [s[stop] - s[stop - held] for s in sums]
                columns = [flat["doc_ids"], *[flat[s] for s in _STATS], pa.array(sums[1]), pa.array(sums[0]), flat["sha"]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, given)], schema=given)

    slim = chunks.drop("pairs", "holders").join(of_chunk, F.col("chunk") == F.col("_chunk"), "left").drop("_chunk")
    return slim.mapInArrow(add_up, result)


def token_links(docs: DataFrame, byte_path: str, piece_path: str, shared_group: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The links themselves: (id, a_place, b_place, a_id, b_id, weight), places counted from 0 in the document.

    Overlap links weigh their shared bytes; with ``shared_group``, tokens of one group are linked, with weight 1.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, a_place long, b_place long, a_id int, b_id int, weight int"
    from pyspark.sql.types import StructType

    arrow = arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        a_tok, b_tok = _tokenizers(byte_path, piece_path)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                spelled = f" {text}"
                a, b = (np.array(t.encode(spelled), np.int64) for t in (a_tok, b_tok))
                if any(t.spelling.spell(x).tobytes() != spelled.encode() for t, x in ((a_tok, a), (b_tok, b))):
                    continue
                ends = [np.cumsum(t.spelling.length[x]) for t, x in ((a_tok, a), (b_tok, b))]
                if shared_group:
                    common = np.intersect1d(*ends, assume_unique=True)
                    left, right = (memberships(np.searchsorted(common, e), len(common)) for e in ends)
                else:
                    left, right = map(incidence, ends)
                for row, column, weight in product(left, transposed(right)):
                    columns = [[i] * len(row), row, column, a[row], b[column], weight]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return docs.select(docs[id_col], docs[text_col].alias("text")).mapInArrow(run, schema)
