"""Quality rules with thresholds that follow each language and source (operator 7).

Fixed cut-offs misjudge sources whose ordinary text is unusual. Here each measure's distribution is summarised by a
mergeable quantile sketch (KLL) per (lang, source), built by map-side partial aggregation; a document fails a measure
if it lies more than FENCE spreads above its group's upper quartile or below its lower one. The spread is the group's
interquartile range, or, where the group is too even for one (most texts have no symbols at all), what a single event
adds to the measure in a text of the group's lower-quartile length, which is sketched as well. No limit is a constant.
Sketches of small groups are merged with their language's, then with the whole corpus's.

The thresholds are one row per group. They are broadcast only if their number is at most ``BROADCAST_GROUPS``;
otherwise both sides are salted, so a source that holds a third of all rows is dealt over many tasks.

Defined cases: null lang or source form groups of their own; a null or empty text has no words and fails the base rule;
repeated rows each get a verdict; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import Scratch
from firnline.llm.text_stats import with_stats

SKETCH_K = 400
FENCE = 3.0
#: A group with fewer documents uses its language's sketch, and a language with fewer that of the corpus.
MIN_GROUP = 30
BROADCAST_GROUPS = 100_000
SALTS = 32
#: Measure: what is counted, per what, and the count of a single event (a repeated three-word window counts six words).
MEASURES = {
    "symbol_ratio": ("n_symbols", "n_words", 1),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 1),
    "repeat_ratio": ("n_repeat_words", "n_words", 6),
    "word_length": ("word_chars", "n_words", 1),
}
SIZES = ("n_words", "n_lines")
SKETCHED = (*MEASURES, *(f"size_{s}" for s in SIZES))
LIMITS = tuple(f"{end}_{m}" for m in MEASURES for end in ("low", "high"))
KEYS = ("lang", "source")


def _sketches(measured: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One sketch per measure and group; a language's and the corpus's are merged from these."""
    return measured.groupBy(*keys).agg(F.count("*").alias("group_rows"), *[F.expr(f"kll_sketch_agg_double({m}, {SKETCH_K})").alias(m) for m in SKETCHED])


def _merged(sketches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.sum("group_rows").alias("group_rows"), *[F.expr(f"kll_merge_agg_double({m})").alias(m) for m in SKETCHED])


def _limits(measure: str) -> list:
    """The lowest and the highest value of a measure that its group lets pass."""
    _, per, event = MEASURES[measure]
    at = lambda sketch, rank: f"kll_sketch_get_quantile_double({sketch}, {rank}D)"
    spread = f"greatest({at(measure, 0.75)} - {at(measure, 0.25)}, {event}D / greatest({at(f'size_{per}', 0.25)}, 1D))"
    return [F.expr(f"{at(measure, 0.25)} - {FENCE}D * {spread}").alias(f"low_{measure}"), F.expr(f"{at(measure, 0.75)} + {FENCE}D * {spread}").alias(f"high_{measure}")]


def thresholds(measured: DataFrame, scratch: Scratch, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, ``low_<measure>`` and ``high_<measure>`` for each group; a table as long as there are groups."""
    own = scratch.save(_sketches(measured, keys), "sketches")
    out = own
    for width in range(len(keys) - 1, -1, -1):  # from narrow groups to the corpus
        wide = _merged(own, keys[:width]).select(*[F.col(k).alias(f"_{k}") for k in keys[:width]], F.col("group_rows").alias("_rows"), *[F.col(m).alias(f"_{m}") for m in SKETCHED])
        condition = F.lit(True)
        for k in keys[:width]:
            condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
        if width == 0:  # a single row
            wide = F.broadcast(wide)
        out = out.join(wide, condition, "left")
        small = F.col("group_rows") < MIN_GROUP
        out = out.select(*keys, *[F.when(small, F.coalesce(f"_{m}", m)).otherwise(F.col(m)).alias(m) for m in SKETCHED], F.when(small, F.coalesce("_rows", "group_rows")).otherwise(F.col("group_rows")).alias("group_rows"))
    return out.select(*keys, *[limit for m in MEASURES for limit in _limits(m)])


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The document's counts and measures, the base verdict, its group's limits, and ``kept``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "rules")
    counted = with_stats(docs, [id_col, *keys], text_col)
    counted = scratch.save(counted, "counts")
    measured = counted.select("*", *[F.expr(f"cast({count} as double) / greatest({per}, 1)").alias(m) for m, (count, per, _) in MEASURES.items()], *[F.col(c).cast("double").alias(f"size_{c}") for c in SIZES])
    limits = scratch.save(thresholds(measured, scratch, keys), "limits")
    same = F.lit(True)
    right = limits.select(*[F.col(k).alias(f"_{k}") for k in keys], *LIMITS)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    if limits.count() <= BROADCAST_GROUPS:
        judged = measured.join(F.broadcast(right), same, "left")
    else:
        salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        judged = measured.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")).join(salted, same & (F.col("salt") == F.col("_salt")), "left")
    base_failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    beyond = F.lit(False)
    for m in MEASURES:
        beyond = beyond | F.coalesce((F.col(m) > F.col(f"high_{m}")) | (F.col(m) < F.col(f"low_{m}")), F.lit(False))
    return judged.select(id_col, *keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & ~beyond).alias("kept"), *MEASURES, *LIMITS)
