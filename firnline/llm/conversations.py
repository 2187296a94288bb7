"""Conversation structure repair (operator 11): the cheapest edits that give a conversation a proper order of roles.

A conversation's roles should read ``(s?(ua)+)?``: an optional system row, then user and assistant in turns. Rows may
be kept (0), given the role user or assistant (2) or deleted (3); empty user and assistant rows may be put in anywhere
(2). Blank rows and repetitions of an earlier row must go; an undeleted truncated row adds 1.

States of the pattern are: nothing yet, after the system row, after a user row, after an assistant row. A row is a
4 x 4 min-plus matrix over states: what may be put in before it, then what becomes of it. Equal consecutive symbols
(role and fault) are one run, and a run advances by binary powers of its symbol's matrix, which are cached. Costs to go
are carried backwards from run to run in this way; then choices are unrolled forwards, halving each run by the same
powers, always taking the ASCII-least choice among the cheapest ones. From one state, a letter of the audit leads to
one state only, and equally cheap audits of the same rows are never prefixes of one another, so this is the ASCII-least
audit.

A conversation of any size is dealt over many tasks: rows are sorted by conversation and turn into ranges, each range's
part of a conversation is a piece, and a piece passes on no more than its matrix, its ends and its runs. Pieces of one
conversation (at most one per range) settle their costs to go together, and then unroll on their own. Only
``repaired_digest`` needs a conversation's texts one after another in one task, since a hash is sequential; it streams
over sorted rows and keeps one row at a time.

Defined cases: a null role or text is one space; rows are ordered by turn (null first), then role, then text; equal rows
are a first one and its repetitions; roles are told by their first character; a null ``conv_id`` is a conversation
of its own; conversations and texts may be of any length; an empty table gives an empty table; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import Scratch, arrow_schema, map_rows

#: The six ASCII blanks, and what ends a sentence.
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = np.int64(1) << 60
#: A symbol is 3 * role + fault.
ROLES = "sua"  # others come fourth
FINE, CUT, GONE = range(3)
#: The state an inserted or re-roled row leads to, and the role it has.
_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF_STATE = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): each row may be lost, emptied, cut short, said twice or ascribed to the
    user, as the crc32 of its ids has it."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.pmod(F.crc32(F.concat(said[0], F.lit(":"), said[1])), F.lit(20))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    out = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind")).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


# Min-plus matrices


def _least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of two matrices, or of a matrix and a vector."""
    if b.ndim == 1:
        return np.minimum((a + b[None, :]).min(1), _FAR)
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _FAR)


def _insertions() -> np.ndarray:
    out = np.full((4, 4), _FAR)
    for state in range(4):
        at, cost = state, 0
        while cost < out[state, at]:
            out[state, at] = cost
            at, cost = _TURN[at], cost + INSERT
    return out


INSERTIONS = _insertions()
#: Costs of ending in each state.
FINAL = INSERTIONS[:, [START, ASSISTANT]].min(1)


def moves(symbol: int) -> list[tuple[int, str, int, int]]:
    """(state, letter, next state, cost) of everything a row of this symbol may become."""
    role, fault = divmod(symbol, 3)
    extra = TRUNCATED if fault == CUT else 0
    out = [(state, "D", state, DELETE) for state in range(4)]
    if fault != GONE:
        out += [(state, "R", _TURN[state], REROLE + extra) for state in range(4)]
        if role == 0:
            out.append((START, "K", SYSTEM, extra))
        elif role < 3:
            want = USER if role == 1 else ASSISTANT
            out += [(state, "K", want, extra) for state in range(4) if _TURN[state] == want]
    return out


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> np.ndarray:
    """The matrix of 2**k rows of one symbol, each with what may be put in before it."""
    if k:
        return _least(power(symbol, k - 1), power(symbol, k - 1))
    row = np.full((4, 4), _FAR)
    for state, _, after, cost in moves(symbol):
        row[state, after] = min(row[state, after], cost)
    return _least(INSERTIONS, row)


def _bits(length: int) -> list[int]:
    return [k for k in range(length.bit_length()) if length >> k & 1]


def matrix_of(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, _FAR).astype(np.int64)
    for symbol, length in zip(symbols.tolist(), lengths.tolist()):
        for k in _bits(length):
            out = _least(out, power(symbol, k))
    return out


def _shifted(after: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    low = min(after)
    return low, tuple(x - low for x in after)


@lru_cache(maxsize=1 << 14)
def _run_before(symbol: int, length: int, after: tuple[int, ...]) -> tuple[int, ...]:
    costs = np.array(after, np.int64)
    for k in _bits(length):
        costs = _least(power(symbol, k), costs)
    return tuple(costs.tolist())


def before(symbol: int, length: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a run, given those behind it. Only their differences matter, so few cases are worked out."""
    low, base = _shifted(after)
    return tuple(x + low for x in _run_before(symbol, length, base))


@lru_cache(maxsize=1 << 14)
def _row_choice(symbol: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least of the cheapest letters for what is put in before a row and for the row, and the state behind."""
    letters = ""
    to_go = _run_before(symbol, 1, after)  # with what may be put in
    while True:
        here, letter, then = min((cost + after[n], letter, n) for at, letter, n, cost in moves(symbol) if at == state)
        put_in = INSERT + to_go[_TURN[state]]
        if put_in < here or put_in == here and "I" < letter:
            letters, state = letters + "I", _TURN[state]
        else:
            return letters + letter, then


@lru_cache(maxsize=1 << 12)
def _short_choices(symbol: int, length: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    return _halves(symbol, length, state, after)


def _halves(symbol: int, length: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    half = 1 << (length - 1).bit_length() - 1
    first, middle = choices(symbol, half, state, before(symbol, length - half, after))
    second, last = choices(symbol, length - half, middle, after)
    return first + second, last


def choices(symbol: int, length: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The letters of a run from a state on, and the state behind it."""
    after = _shifted(after)[1]
    if length == 1:
        return _row_choice(symbol, state, after)
    return (_short_choices if length <= 1024 else _halves)(symbol, length, state, after)


def ending(state: int) -> str:
    """What is put in behind the last row: nothing where the pattern is complete."""
    out = ""
    while state not in (START, ASSISTANT):
        out, state = out + "I", _TURN[state]
    return out


def unroll(symbols: list[int], lengths: list[int], state: int, after: tuple[int, ...], last: bool) -> tuple[str, int]:
    """The audit of a piece that begins in ``state``, given the costs to go behind it, and the state behind it."""
    to_go = [after]
    for symbol, length in zip(reversed(symbols), reversed(lengths)):
        to_go.append(before(symbol, length, to_go[-1]))
    out = []
    for symbol, length, costs in zip(symbols, lengths, reversed(to_go[:-1])):
        letters, state = choices(symbol, length, state, costs)
        out.append(letters)
    if last:
        out.append(ending(state))
        state = ASSISTANT if state else START
    return "".join(out), state


# Spark


def _faults(text: Column) -> tuple[Column, Column]:
    """(blank, truncated)"""
    trimmed = F.rtrim(text, F.lit(BLANK_CHARACTERS))
    return trimmed == "", ~F.right(trimmed, F.lit(1)).isin(*SENTENCE_ENDS)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


_PIECE = "_conv {kind}, piece long, symbols binary, lengths binary, matrix array<long>, first string, last string, low long, high long, turns long, low_turn long, blank long, duplicate long, truncated long, illegal long"
_SUMS = ("blank", "duplicate", "truncated")


class Repair:
    """Rows as they came, with their ranges, and the edits of each piece."""

    def __init__(self, conversations: DataFrame):
        """``conversations``: conv_id, turn, role, text, and ``copies`` where a row stands for several equal ones."""
        spark = conversations.sparkSession
        self.scratch = scratch = Scratch(spark, "conversations")
        self.kind = kind = conversations.schema["conv_id"].dataType.simpleString()
        copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
        role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
        rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))
        rows = rows.withColumn("_uid", F.monotonically_increasing_id())  # equal rows, too, are dealt over ranges
        order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "_uid"]
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        blank, cut = _faults(F.col("text"))
        self.rows = scratch.save(ranged.select("conv_id", "turn", "role", "text", "copies", F.monotonically_increasing_id().alias("at"), F.sha2("text", 256).alias("_text"), blank.alias("_blank"), cut.alias("_cut")), "rows")

        # every row but the first of its conversation, role and text; most rows have no equal and don't meet anything
        slim = self.rows.select(F.col("conv_id").alias("_conv"), "turn", "role", "_text", "at", "copies", "_blank", "_cut")
        first = slim.where("not _blank").groupBy("_conv", "role", "_text").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
        first = first.select(F.col("_conv").alias("_c"), F.col("role").alias("_r"), F.col("_text").alias("_t"), "first")
        met = slim.join(first, _same(F.col("_conv"), F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_text") == F.col("_t")), "left")
        seen = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
        initial = F.substring("role", 1, 1)
        slim = met.select("_conv", F.shiftright("at", 33).alias("piece"), F.struct("at", "turn", initial.alias("initial"), "copies", F.col("_blank").alias("blank"), seen.alias("seen"), F.col("_cut").alias("cut")).alias("row"))
        listed = slim.groupBy("_conv", "piece").agg(F.array_sort(F.collect_list("row")).alias("rows"))
        self.pieces = scratch.save(map_rows(listed, _summed_up, _PIECE.format(kind=kind)), "pieces")

        parts = [f for f in self.pieces.columns if f not in ("_conv", "symbols", "lengths")]
        joined = self.pieces.groupBy("_conv").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("pieces"))
        settled = f"_conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, plan array<struct<piece: long, after: array<long>, first: boolean, last: boolean>>"
        self.settled = scratch.save(map_rows(joined, _settled, settled), "settled")
        plan = self.settled.select(F.col("_conv").alias("_c"), F.inline("plan")).withColumnRenamed("piece", "_p")
        unrolled = self.pieces.select("_conv", "piece", "low", "symbols", "lengths").join(plan, _same(F.col("_conv"), F.col("_c")) & (F.col("piece") == F.col("_p")))
        # audits for each state that a piece may begin in, then the states, which follow from piece to piece
        ways = scratch.save(map_rows(unrolled.drop("_c", "_p"), _unrolled, f"_conv {kind}, piece long, low long, ways array<struct<audit: string, state: int>>"), "ways")
        chain = ways.groupBy("_conv").agg(F.array_sort(F.collect_list(F.struct("piece", F.col("ways.state").alias("states")))).alias("pieces"))
        begin = map_rows(chain, _begun, f"_conv {kind}, begun array<struct<piece: long, start: int>>")
        begin = begin.select(F.col("_conv").alias("_c"), F.inline("begun")).withColumnRenamed("piece", "_p")
        chosen = ways.join(begin, _same(F.col("_conv"), F.col("_c")) & (F.col("piece") == F.col("_p")))
        self.audits = scratch.save(chosen.select("_conv", "piece", "low", "start", F.expr("ways[start].audit").alias("audit")), "audits")

    def summary(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of conversations that have rows."""
        whole = self.audits.groupBy("_conv").agg(F.array_sort(F.collect_list(F.struct("piece", "audit"))).alias("parts"))
        whole = whole.select(F.col("_conv").alias("_c"), F.array_join("parts.audit", "").alias("audit"))
        out = self.settled.drop("plan").join(whole, _same(F.col("_conv"), F.col("_c")), "left")
        return out.select(F.col("_conv").alias("conv_id"), "gaps", *_SUMS, "illegal", "cost", "audit")

    def _sources(self) -> DataFrame:
        """Rows, and before each piece's first row its audit."""
        none = [F.lit(None).cast(t).alias(n) for n, t in (("role", "string"), ("text", "string"), ("copies", "long"))]
        heads = self.audits.select(F.col("_conv").alias("conv_id"), "piece", F.col("low").alias("at"), F.lit(0).alias("kind"), *none, "start", "audit")
        rows = self.rows.select("conv_id", F.shiftright("at", 33).alias("piece"), "at", F.lit(1).alias("kind"), "role", "text", "copies", F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("audit"))
        return heads.unionByName(rows)

    def repaired(self) -> DataFrame:
        """(conv_id, piece, place, edit, role, text): the rows that are left and those put in, in order of piece and
        place. Pieces go to tasks on their own."""
        schema = f"conv_id {self.kind}, piece long, place long, edit string, role string, text string"
        dealt = self._sources().repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "at", "kind")
        arrow = _arrow(schema)
        return dealt.mapInArrow(lambda batches: _in_batches(_edited(batches), arrow), schema)

    def repaired_digest(self) -> DataFrame:
        """(conv_id, repaired_sha256) of ``role:text``, one line per row; one stream per conversation."""
        schema = f"conv_id {self.kind}, repaired_sha256 string"
        arrow = _arrow(schema)

        def run(batches):
            def digests():
                current, running, any_ = None, None, False
                for conv, _, _, _, role, text in _edited(batches, every=True):
                    if running is None or conv != current:
                        if running is not None:
                            yield current, running.hexdigest()
                        current, running, any_ = conv, hashlib.sha256(), False
                    if role is not None:
                        running.update(f"{'\n' if any_ else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                        any_ = True
                if running is not None:
                    yield current, running.hexdigest()

            return _in_batches(digests(), arrow)

        return self._sources().repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind").mapInArrow(run, schema)


def _rows_of(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            yield from zip(*[part.column(n).to_pylist() for n in ("conv_id", "piece", "kind", "role", "text", "copies", "start", "audit")])


def _edited(batches, every: bool = False):
    """Rows after the edits. ``every``: also a row without a role for each piece, so that no conversation is missing."""
    audit, at, state, place = "", 0, START, 0
    conv = piece = None
    rows_end = 0

    def put_in():
        nonlocal at, state, place
        while audit[at : at + 1] == "I":
            state = _TURN[state]
            yield conv, piece, place, "I", ROLE_OF_STATE[state], ""
            at, place = at + 1, place + 1

    for row in _rows_of(batches):
        if row[2] == 0:
            conv, piece, _, _, _, _, state, audit = row
            at, place, rows_end = 0, 0, len(audit.rstrip("I"))
            if every:
                yield conv, piece, -1, "", None, None
            continue
        _, _, _, role, text, copies, _, _ = row
        for _ in range(copies):
            yield from put_in()
            letter, at = audit[at], at + 1
            if letter != "D":
                state = SYSTEM if letter == "K" and state == START and role[:1] == "s" else _TURN[state]
                yield conv, piece, place, letter, role if letter == "K" else ROLE_OF_STATE[state], text
                place += 1
        if at >= rows_end:  # the conversation's end
            yield from put_in()


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.types import StructType

    return arrow_schema(StructType.fromDDL(schema))


def _in_batches(rows, arrow: pa.Schema, size: int = 512):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)


def _summed_up(columns: dict) -> dict:
    """What each piece passes on."""
    out: dict[str, list] = {n: [] for n in ("symbols", "lengths", "matrix", "first", "last", "low", "high", "turns", "low_turn", "blank", "duplicate", "truncated", "illegal")}
    for rows in columns["rows"].to_pylist():
        symbols, lengths = [], []
        blank = duplicate = truncated = illegal = turns = 0
        before = turn = None
        known = [r["turn"] for r in rows if r["turn"] is not None]
        for r in rows:
            initial, copies = r["initial"], r["copies"]
            role = ROLES.find(initial) if initial else 3
            role = 3 if role < 0 else role
            if r["blank"]:
                parts, blank = [(GONE, copies)], blank + copies
            elif r["seen"]:
                parts, duplicate = [(GONE, copies)], duplicate + copies
            else:
                parts = [(CUT if r["cut"] else FINE, 1), (GONE, copies - 1)]
                truncated, duplicate = truncated + r["cut"], duplicate + copies - 1
            for fault, n in parts:
                symbol = 3 * role + fault
                if n and symbols and symbols[-1] == symbol:
                    lengths[-1] += n
                elif n:
                    symbols.append(symbol)
                    lengths.append(n)
            illegal += (before is not None and not legal(before, initial)) + (copies - 1) * (not legal(initial, initial))
            before = initial
            if r["turn"] is not None and r["turn"] != turn:
                turn, turns = r["turn"], turns + 1
        values = {
            "symbols": np.array(symbols, np.uint8).tobytes(), "lengths": np.array(lengths, "<i8").tobytes(), "matrix": matrix_of(np.array(symbols), np.array(lengths)).ravel().tolist(), "first": rows[0]["initial"], "last": before, "low": rows[0]["at"],
            "high": known[-1] if known else None, "low_turn": known[0] if known else None, "turns": turns, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal,
        }
        for n, v in values.items():
            out[n].append(v)
    return {"_conv": columns["_conv"], "piece": columns["piece"]} | out


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au") and len(a) == 1


def _settled(columns: dict) -> dict:
    """Costs to go behind each piece, backwards from the conversation's end."""
    names = ("gaps", *_SUMS, "illegal", "cost", "plan")
    out: dict[str, list] = {n: [] for n in names}
    for pieces in columns["pieces"].to_pylist():
        after = [FINAL]
        for p in reversed(pieces):
            after.append(_least(np.array(p["matrix"], np.int64).reshape(4, 4), after[-1]))
        after.reverse()
        plan = [{"piece": p["piece"], "after": a.tolist(), "first": n == 0, "last": n + 1 == len(pieces)} for n, (p, a) in enumerate(zip(pieces, after[1:]))]
        known = [p for p in pieces if p["high"] is not None]
        turns = sum(p["turns"] for p in known) - sum(a["high"] == b["low_turn"] for a, b in zip(known, known[1:]))
        values = {s: sum(p[s] for p in pieces) for s in _SUMS}
        values |= {"gaps": known[-1]["high"] - known[0]["low_turn"] + 1 - turns if known else 0, "illegal": sum(p["illegal"] for p in pieces) + sum(not legal(a["last"], b["first"]) for a, b in zip(pieces, pieces[1:]))}
        values |= {"cost": int(after[0][START]), "plan": plan}
        for s in names:
            out[s].append(values[s])
    return {"_conv": columns["_conv"]} | out


def _unrolled(columns: dict) -> dict:
    ways = []
    for symbols, lengths, after, first, last in zip(*[columns[n].to_pylist() for n in ("symbols", "lengths", "after", "first", "last")]):
        runs = np.frombuffer(symbols, np.uint8).tolist(), np.frombuffer(lengths, "<i8").tolist()
        found = [unroll(*runs, state, tuple(after), last) for state in ([START] if first else range(4))]
        ways.append([{"audit": audit, "state": state} for audit, state in found])
    return {"_conv": columns["_conv"], "piece": columns["piece"], "low": columns["low"], "ways": ways}


def _begun(columns: dict) -> dict:
    out = []
    for pieces in columns["pieces"].to_pylist():
        state, begun = START, []
        for p in pieces:
            begun.append({"piece": p["piece"], "start": state})
            state = p["states"][state]
        out.append(begun)
    return {"_conv": columns["_conv"], "begun": out}
