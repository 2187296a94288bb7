"""Removal of lines that resemble an earlier line (operator 10), with DataFrame and SQL functions only.

An exact set-similarity join. A line's tokens are its distinct words, ordered by rarity: the count of the hash bucket a
word falls in, over all documents (a table of BUCKETS numbers whatever the corpus), then the word's hash. Any total
order makes the join exact; rarity makes it small. Lines of n and m tokens with Jaccard similarity t or more overlap in
at least o = ceil((n + m) t / (1 + t)) tokens, so they share one among the first n - ceil(t n) + 1 of either (prefix
filter), and one that lies at most n - o and m - o tokens from their starts (positional filter); n >= t m (length
filter). The parities of the tokens' hashes bound the difference of two lines from below, which removes most other
meetings, and what is left is verified on the words themselves. Postings meet in passes by token, so that the disk
never holds all of them.

A line is removed if an earlier line, by (document, line number), has similarity t or more with it; lines are judged on
the input. Equal word sets (told by 128 bits of hash) are one class from the start, so the most frequent line is one row.

Defined cases: lines are cut at line breaks; lines of fewer than ``min_words`` distinct words are never compared nor
removed; a null text is empty and stays so; repeated rows with one id count as the same document and repeat its line
numbers, so equal line numbers remove nothing of each other; rows without an id are compared with nothing and stay whole;
an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.llm.common import Scratch, release_shuffles

BUCKETS = 1 << 15
#: Rarity is told in so many steps for each doubling of a bucket's count.
STEPS = 6
#: The similarity as a fraction, so that bounds are exact integers.
NUMERATOR, DENOMINATOR = 4, 5
MIN_WORDS = 1
#: How many holders of a token before it a class meets at first, beside the earliest.
LAGS = 2
#: The tokens by which a class meets those at first: so many of its rarest, and one in so many of the others.
RAREST, SHARE = 2, 7
#: Postings meet in so many passes, by token, so that the disk holds one pass's exchange at a time.
PASSES = 2
#: Lines of more tokens than this have a second parity.
LONG = 64


def _spaced(text: Column) -> Column:
    """The text with a space for each other blank; translate() looks at every character, so only where there is one."""
    rare = "\t\x0b\x0c\r"
    some = F.lit(False)
    for blank in rare:
        some = some | F.contains(text, F.lit(blank))
    return F.when(some, F.translate(text, rare, " " * len(rare))).otherwise(text)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(_spaced(text), " "), "")


def _rarity(docs: DataFrame) -> Column:
    """Array literal: a bucket's count over all documents on a logarithmic scale, 0 to 255."""
    import numpy as np

    word = F.explode(F.split("text", "[ \\n\\t\\x0B\\f\\r]")).alias("word")
    counted = docs.select(word).select(_bucket(F.xxhash64("word")).alias("bucket")).groupBy("bucket").count()
    table = counted.toArrow()  # at most BUCKETS rows
    scale = np.zeros(BUCKETS, np.int64)
    scale[np.asarray(table.column("bucket"))] = np.minimum(255, np.log2(1 + np.asarray(table.column("count"))) * STEPS)
    return F.split(F.lit(",".join(map(str, scale.tolist()))), ",").cast("array<bigint>")  # folded into one literal


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select("id", "part", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "content"))


def _bucket(word_hash: Column) -> Column:
    return word_hash.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _classes(docs: DataFrame, scratch: Scratch, min_words: int, numerator: int, denominator: int) -> tuple[DataFrame, DataFrame]:
    """(id, line, class) of all lines that are compared, and a row per class: distinct token sets."""
    rarity = _rarity(docs)
    hashes = F.transform(F.split(_spaced(F.col("content")), " "), lambda w: F.xxhash64(w))
    hashes = _lines(docs).select(*_PLACE, F.array_except(hashes, F.array(F.xxhash64(F.lit("")))).alias("hashes"))
    # a token is a number that sorts by rarity, then by hash
    token = lambda h: F.shiftleft(F.get(rarity, _bucket(h)), 55).bitwiseOR(F.shiftrightunsigned(h, 9))
    tokens = hashes.select(*_PLACE, F.sort_array(F.transform("hashes", token)).alias("tokens"))
    n = "size(tokens)"
    prefix = F.expr(f"slice(tokens, 1, cast({n} - (({n} * {numerator} + {denominator} - 1) div {denominator}) + 1 as int))")
    prefix = F.transform(prefix, lambda t: t.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))  # enough to meet by
    # the second parity is that of half of the tokens; long lines fill the bits of one
    parity = F.expr("aggregate(tokens, 0L, (bits, t) -> bits ^ shiftleft(1L, cast(t & 63 as int)))")
    parity2 = F.expr(f"CASE WHEN {n} > {LONG} THEN aggregate(tokens, 0L, (bits, t) -> CASE WHEN (t & 64) = 0 THEN bits ELSE bits ^ shiftleft(1L, cast(t & 63 as int)) END) ELSE 0L END")
    told = [F.xxhash64("tokens").alias("class"), F.xxhash64("tokens", F.lit(1)).alias("class2")]
    lines = scratch.save(tokens.select(*_PLACE, *told, F.size("tokens").alias("n"), parity.alias("parity"), parity2.alias("parity2"), prefix.alias("prefix")), "lines")
    lines = lines.where(F.col("n") >= min_words)  # told from what was written, so that no words are split twice
    grouped = lines.groupBy("class", "class2").agg(F.min(F.struct(*_PLACE)).alias("first"), F.count("*").alias("lines"), *[F.first(c).alias(c) for c in ("n", "parity", "parity2", "prefix")])
    classes = scratch.save(grouped.select("class", "class2", *[F.col(f"first.{c}").alias(f"first_{c}") for c in _PLACE], "lines", "n", "parity", "parity2", "prefix"), "classes")
    return lines.select(*_PLACE, "class", "class2"), classes


def _flat(classes: DataFrame, *also: str) -> DataFrame:
    """A flat row per class and prefix token, the rows that joins move."""
    return classes.select(*_FIRST, "n", "parity", "parity2", *also, F.posexplode("prefix").alias("pos", "token"))


def _posted(classes: DataFrame, turn: int, *also: str) -> DataFrame:
    """The postings of a pass."""
    return _flat(classes, *also).where(F.expr(f"token % {PASSES} = {turn}"))


def _step(n: str) -> str:
    """A line's length on a scale of quarters."""
    return f"int(log({n}) / log(1.25D))"


def _parities(numerator: int, denominator: int, other: str = "_") -> str:
    """Whether the parities leave it open that two lines are similar; the second one's columns start with ``other``."""
    return f"bit_count(parity ^ {other}parity) * {numerator + denominator} <= (n + {other}n) * {denominator - numerator}"


def _near(numerator: int, denominator: int) -> str:
    """Whether no filter tells two postings of a token apart; the second one's columns start with an underscore."""
    overlap = f"(((n + _n) * {numerator} + {numerator + denominator} - 1) div {numerator + denominator})"
    return (
        f"{_parities(numerator, denominator)} and least(n, _n) * {denominator} >= greatest(n, _n) * {numerator} and pos <= n - {overlap} and _pos <= _n - {overlap}"
        f" and (least(n, _n) <= {LONG}"
        f" or bit_count(parity ^ _parity ^ parity2 ^ _parity2) + bit_count(parity2 ^ _parity2) <= n + _n - 2 * {overlap})"
    )


_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_PLACE = ["id", "part", "line"]
_FIRST = [f"first_{c}" for c in _PLACE]
_PAIR = [*_FIRST, *[f"_{c}" for c in _FIRST]]
_EARLIER = "(_first_id < first_id or (_first_id = first_id and _first_line < first_line))"


def _met_first(classes: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Each class with the earliest holder of some of its prefix tokens and with the LAGS ones just before it.

    Holders of a token are told apart by length, in steps of a quarter, which cuts a frequent token's into parts. The
    tokens are the rarest ones and, of the others, the same share in all lines; what they miss is left to ``_met_any``.
    """
    by_age = Window.partitionBy("token", "step").orderBy("first_id", "first_line", "first_part")
    so_far = by_age.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [*_FIRST, "n", "parity", "parity2", "pos"]
    one = F.struct(*names)
    others = {"o0": F.first(one).over(so_far), **{f"o{i}": F.lag(one, i).over(by_age) for i in range(1, LAGS + 1)}}
    posted = _flat(classes).where(f"pos < {RAREST} or token % {SHARE} = 0").withColumn("step", F.expr(_step("n")))
    met = posted.select(*names, *[o.alias(name) for name, o in others.items()])
    # the parities alone tell nearly all apart, in code short enough to be compiled
    some = " or ".join(_parities(numerator, denominator, f"{o}.") for o in others)
    pairs = met.where(some).select(*names, F.explode(F.array(*others)).alias("other")).select(*names, *[F.col(f"other.{c}").alias(f"_{c}") for c in names])
    return pairs.where(_EARLIER).where(_near(numerator, denominator)).select(*_PAIR).distinct()


def _met_any(classes: DataFrame, turn: int, numerator: int, denominator: int) -> DataFrame:
    """Classes that are still open, with every earlier class they could resemble.

    The shorter line of a pair stands at its own step of length, with tokens that a line as long could share; the longer
    one visits the steps of all shorter ones that it could resemble by that token. Both sides come from the same rows, so
    one exchange serves them: steps are told behind it, and no filter is on one side's columns alone.
    """
    posted = _posted(classes, turn, "open").repartition("token")
    both, overlap = numerator + denominator, f"((2 * n * {numerator} + {numerator + denominator - 1}) div {numerator + denominator})"
    least, most = f"((n * {numerator} + {denominator - 1}) div {denominator})", f"least(n, (n - pos) * {both} div {numerator} - n)"
    own = f"CASE WHEN pos <= n - {overlap} THEN array({_step('n')}) END"
    visited = f"CASE WHEN {most} >= {least} THEN sequence({_step(least)}, {_step(most)}) END"
    # explode_outer: the filter that comes with explode would go before the exchange, another one for each side
    left, right = (posted.select("*", F.explode_outer(F.expr(steps)).alias("step")) for steps in (own, visited))
    later = _EARLIER.replace("_first", "\0").replace("first", "_first").replace("\0", "first")
    test = f"token = _token and step = _step and n <= _n and (({_EARLIER} and open = 1) or (n < _n and {later} and _open = 1)) and {_near(numerator, denominator)}"
    of_side = lambda text: re.sub(rf"(?<!\w)(_?)({'|'.join(left.columns)})\b", lambda m: f"{'r' if m[1] else 'l'}.{m[2]}", text)
    met = left.alias("l").hint("shuffle_hash").join(right.alias("r"), F.expr(of_side(test)))  # renamed rows would be another exchange
    swapped = F.expr(of_side(later))
    pair = [F.when(swapped, F.col(f"{b}.{c}")).otherwise(F.col(f"{a}.{c}")).alias(f"{name}{c}") for a, b, name in (("l", "r", ""), ("r", "l", "_")) for c in _FIRST]
    return met.select(*pair).distinct()


def _met_in_passes(classes: DataFrame, scratch: Scratch, numerator: int, denominator: int) -> DataFrame:
    """All passes' pairs, each pass's exchange gone before the next one."""
    found, conf = [], classes.sparkSession.conf
    given = conf.get(_ALL_KEYS)
    for turn in range(PASSES):
        conf.set(_ALL_KEYS, "false")  # dealt by token is dealt by token and step
        try:
            found.append(scratch.save(_met_any(classes, turn, numerator, denominator), f"any-met-{turn}"))
        finally:
            conf.set(_ALL_KEYS, given)
        release_shuffles(classes.sparkSession)
    pairs = scratch.save(reduce(DataFrame.union, found).distinct(), "any-pairs")
    scratch.free(*[f"any-met-{turn}" for turn in range(PASSES)])
    return pairs


def _confirmed(docs: DataFrame, pairs: DataFrame, scratch: Scratch, name: str, numerator: int, denominator: int) -> DataFrame:
    """The first lines of classes that the words of one of their pairs confirm. Words travel as one string."""
    wanted = pairs.select(*_FIRST).union(pairs.select(*[f"_{c}" for c in _FIRST])).distinct()
    asked = scratch.save(wanted.groupBy(F.col("first_id").alias("_id"), F.col("first_part").alias("_part")).agg(F.collect_list("first_line").alias("asked")), f"{name}-asked")
    # asked is the smaller side by far, a row per document at most, so texts need no sort
    content = docs.join(asked.hint("shuffle_hash"), (F.col("id") == F.col("_id")) & (F.col("part") == F.col("_part")))
    wanted = F.filter(F.split("text", "\n"), lambda x, i: F.array_contains("asked", i))
    content = content.select("id", "part", F.inline(F.arrays_zip(F.sort_array("asked").alias("line"), wanted.alias("content"))).alias("line", "content"))
    content = content.select(*_PLACE, F.array_join(F.array_distinct(_words(F.col("content"))), " ").alias("words")).dropDuplicates(_PLACE)
    content = scratch.save(content, f"{name}-content")
    release_shuffles(docs.sparkSession)
    sized = content.withColumn("size", F.length("words") - F.length(F.replace("words", F.lit(" "))) + 1)
    left, right = (sized.select(*[F.col(c).alias(f"{s}{c}") for c in (*_PLACE, "words", "size")]) for s in ("l", "r"))
    same = lambda pair, side: F.expr(" and ".join(f"{pair}first_{c} = {side}{c}" for c in _PLACE))
    met = pairs.hint("merge").join(left, same("", "l")).hint("merge").join(right, same("_", "r"))
    # both sizes are known, so words are split and met once
    shared = F.size(F.array_intersect(F.split("lwords", " "), F.split("rwords", " ")))
    alike = met.where(shared * (numerator + denominator) >= (F.col("lsize") + F.col("rsize")) * numerator)
    out = scratch.save(alike.select(*_FIRST).distinct(), f"{name}-matched")
    scratch.free(*[f"{name}-{part}" for part in ("pairs", "asked", "content")])
    return out


def similar_lines(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """(id, part, line) of each line to remove; ``docs`` has id, part and text.

    One earlier match is enough, so classes first meet a few earlier holders of each of their prefix tokens, and only
    those that this leaves unmatched meet all others: families of many variants don't meet pair by pair.
    """
    spark = docs.sparkSession
    lines, classes = _classes(docs, scratch, min_words, numerator, denominator)
    release_shuffles(spark)
    matched = _confirmed(docs, scratch.save(_met_first(classes, numerator, denominator), "first-pairs"), scratch, "first", numerator, denominator)
    release_shuffles(spark)
    closed = classes.drop("class", "class2", "lines").join(matched.withColumn("_closed", F.lit(0)).hint("shuffle_hash"), _FIRST, "left")
    marked = scratch.save(closed.withColumn("open", F.coalesce("_closed", F.lit(1))).drop("_closed"), "marked")
    release_shuffles(spark)
    more = _confirmed(docs, _met_in_passes(marked, scratch, numerator, denominator), scratch, "any", numerator, denominator)
    scratch.free("marked")
    release_shuffles(spark)
    later = matched.union(more).withColumn("matched", F.lit(True))
    told = classes.select("class", "class2", "lines", *_FIRST).join(later.hint("shuffle_hash"), _FIRST, "left").where("matched or lines > 1").select(F.col("class").alias("_class"), F.col("class2").alias("_class2"), "first_id", "first_line", F.coalesce("matched", F.lit(False)).alias("matched"))
    told = scratch.save(told, "told")
    gone = lines.join(told.hint("shuffle_hash"), (F.col("class") == F.col("_class")) & (F.col("class2") == F.col("_class2"))).where(F.col("matched") | (F.col("id") > F.col("first_id")) | ((F.col("id") == F.col("first_id")) & (F.col("line") > F.col("first_line"))))
    gone = scratch.save(gone.select(*_PLACE), "gone-lines")
    scratch.free("classes", "told", "lines", "first-matched", "any-matched")
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_lines, n_removed, kept): ``kept`` is the text without the removed lines. ``carry``: further columns to keep."""
    scratch = Scratch(docs.sparkSession, "lines")
    part = F.coalesce(F.hash(docs[text_col]), F.lit(0)).alias("part")
    slim = docs.select(docs[id_col].cast("long").alias("id"), part, docs[text_col].alias("text"))
    gone = similar_lines(slim.where("id is not null"), scratch, min_words, numerator, denominator)
    gone = scratch.save(gone.groupBy(F.col("id").alias("_id"), F.col("part").alias("_part")).agg(F.collect_set("line").alias("gone")), "gone")
    joined = docs.select(docs[id_col].cast("long").alias("id"), part, docs[text_col].alias("text"), *[docs[c].alias(f"_carried_{i}") for i, c in enumerate(carry)]).join(gone.hint("shuffle_hash"), (F.col("id") == F.col("_id")) & (F.col("part") == F.col("_part")), "left")
    everything = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.filter(everything, lambda x, i: ~F.array_contains("gone", i)), "\n"))
    return joined.select(F.col("id").alias(id_col), F.size(everything).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), kept.alias("kept"), *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)])
