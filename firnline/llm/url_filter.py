"""URL filters by stated rules and by association rules that are mined from labels (operator 13).

A stated rule names a host and the beginning of a path; it fits the host and all its subdomains, and the longest rule
that fits decides. Where none fits, mined rules do. A URL's tokens are the words of its scheme, host, path, query and
fragment, each marked with its part. Spark's FP-growth finds the token combinations that are frequent among labelled
URLs, with the label as one more item; a combination becomes a rule for its label if the lower end of the confidence
(Wilson's interval, Z deviations) reaches ``min_confidence``. A rule that holds no more than a shorter one of the same
label is pruned, since the shorter one fits wherever it does.

Each rule stands in an inverted index under its rarest token. A URL meets the rules of its tokens, those of which it
has all tokens fit, and the surest of them gives the verdict; with none, or as sure a rule on either side, the URL is
allowed.

Tokens that occur in just the same labelled URLs count as one item, and those in every one are none, so that many
copies of a long URL don't multiply combinations. All tables are joined on tokens by Spark's own choice of join; the
index is as small as the frequent combinations, and nothing is sent to the driver.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no stated rule and is judged by its
words, if any; URLs of any length are whole; repeated rows each count and give a row; without labels, or with fewer
than MIN_COUNT, there are no mined rules; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import Scratch

#: A combination must stand in this share of the labelled URLs, and in so many.
MIN_SUPPORT, MIN_COUNT = 0.005, 10
#: Deviations between a confidence and its lower end.
Z = 3.0
LABELS = ("allow", "block")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _marked(mark: str, words: Column) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(mark), w))


def tokens_of(url: Column) -> Column:
    """Distinct words of the URL, each after the name of its part."""
    rest = _rest(url)
    parts = {
        "scheme": F.when(rest.isNotNull(), F.substring(url, F.lit(1), F.instr(url, "://") - 1)),
        "host": F.regexp_extract(rest, "^[^/?#]*", 0),
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1),
        "fragment": F.regexp_extract(rest, r"^[^#]*#([\s\S]*)", 1),
        "text": F.when(rest.isNull(), url),
    }
    words = [_marked(f"{name}:", F.filter(F.split(F.lower(F.coalesce(p, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")) for name, p in parts.items()]
    return F.array_distinct(F.concat(*words))


def stated(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits as (rule, verdict), or null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.host) - len(r.path), r)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def wilson_low(hits: Column, n: Column) -> Column:
    """Lower end of the interval of a share."""
    p = hits / n
    return (p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def mine_rules(labelled: DataFrame, scratch: Scratch, min_support: float = MIN_SUPPORT, min_confidence: float = 0.5, url_col: str = "url", label_col: str = "label") -> DataFrame:
    """(tokens array, label, bound): rules mined from ``labelled``, whose labels are allow or block."""
    from pyspark.ml.fpm import FPGrowth

    spark = labelled.sparkSession
    given = labelled.where(F.col(label_col).isin(*LABELS)).select(tokens_of(F.col(url_col)).alias("tokens"), F.col(label_col).alias("label"))
    given = scratch.save(given.withColumn("row", F.monotonically_increasing_id()), "labelled")
    total = given.count()
    empty = spark.createDataFrame([], "tokens array<string>, label string, bound double, lead string")
    if total < MIN_COUNT:
        return empty
    least = max(min_support, MIN_COUNT / total)
    seen = given.select("row", F.explode("tokens").alias("token"))
    places = [F.bit_xor(F.xxhash64("row", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    frequent = seen.groupBy("token").agg(F.count("*").alias("n"), *places).where((F.col("n") >= least * total) & (F.col("n") < total))
    items = scratch.save(frequent.groupBy("n", "x1", "x2").agg(F.min("token").alias("token")).select("token", "n"), "items")  # one of those that always meet
    baskets = seen.join(items.select("token"), "token").groupBy("row").agg(F.collect_list("token").alias("tokens"))
    baskets = given.select("row", "label").join(baskets, "row").select(F.concat(F.col("tokens"), F.array(F.concat(F.lit("="), F.col("label")))).alias("items"))
    baskets = scratch.save(baskets, "baskets")
    model = FPGrowth(minSupport=least, minConfidence=min_confidence).fit(baskets)
    sets = scratch.save(model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq")), "sets")  # "=" sorts before every token
    is_label = F.col("items")[0].startswith("=")
    whole = sets.where(~is_label).select(F.col("items").alias("tokens"), F.col("freq").alias("n"))
    of_label = sets.where(is_label & (F.size("items") > 1)).select(F.expr("slice(items, 2, size(items) - 1)").alias("tokens"), F.expr("substring(items[0], 2)").alias("label"), F.col("freq").alias("hits"))
    bounded = of_label.join(whole, "tokens").withColumn("bound", wilson_low(F.col("hits"), F.col("n"))).where(F.col("bound") >= min_confidence)
    bounded = scratch.save(bounded.select("tokens", "label", "bound"), "bounded")
    # a rule less one token
    shorter = bounded.where(F.size("tokens") > 1).select("tokens", "label", "bound", F.explode("tokens").alias("_one")).withColumn("less", F.array_remove("tokens", F.col("_one")))
    known = bounded.select(F.col("tokens").alias("less"), "label", F.col("bound").alias("_bound"))
    pruned = shorter.join(known, ["less", "label"]).where("_bound >= bound").select("tokens", "label").distinct()
    left = bounded.join(pruned, ["tokens", "label"], "left_anti")
    # the rarest token of each
    rarest = left.select("tokens", "label", "bound", F.explode("tokens").alias("token")).join(items, "token").groupBy("tokens", "label", "bound").agg(F.min(F.struct("n", "token")).alias("_rarest"))
    return scratch.save(rarest.select("tokens", "label", "bound", F.col("_rarest.token").alias("lead")), "rules")


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, allow_bound, block_bound): one row per page; bounds are those of the surest mined
    rules that fit, null where a stated rule decides."""
    scratch = Scratch(pages.sparkSession, "urls")
    mined = mine_rules(labelled, scratch, min_support, min_confidence)
    url = pages[url_col]
    known = pages.select(pages[id_col].alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    known = known.withColumn("_stated", stated(F.col("host"), F.col("path"), rules)).withColumn("_row", F.monotonically_increasing_id())
    open_ = F.when(F.col("_stated").isNull(), F.col("tokens"))  # nothing to look up where a stated rule decides
    keys = [F.col(c) for c in ("_row", "_id", "host", "path")] + [F.col("_stated.rule").alias("rule"), F.col("_stated.verdict").alias("_verdict")]
    met = known.select(*keys, open_.alias("tokens"), F.explode_outer(open_).alias("_token"))
    index = mined.select(F.col("lead"), F.col("tokens").alias("_needs"), F.col("label"), F.col("bound"))
    met = met.join(index, F.col("_token") == F.col("lead"), "left")
    fits = F.size(F.array_except("_needs", "tokens")) == 0
    bounds = [F.max(F.when(fits & (F.col("label") == x), F.col("bound"))).alias(f"{x}_bound") for x in LABELS]
    out = met.groupBy("_row", "_id", "host", "path", "rule", "_verdict").agg(*bounds)
    surer = F.coalesce(F.col("block_bound") > F.coalesce("allow_bound", F.lit(0.0)), F.lit(False))
    verdict = F.coalesce("_verdict", F.when(surer, "block").otherwise("allow"))
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "allow_bound", "block_bound")


def page_labels(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """(url, label) of the pages whose document is labelled: the number that ends a page's path is its ``doc_id``.
    Documents of low quality or with a toxic text are to be blocked; rows of ``labels`` for one document are taken together."""
    number = F.regexp_extract(path_of(F.col(url_col)), r"(?<!\d)(\d{1,18})[^\d]*$", 1)
    shown = pages.select(F.col(url_col).alias("url"), number.alias("_n")).where("_n <> ''").select("url", F.col("_n").cast("long").alias("_doc"))
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0))
    by_doc = labels.where("quality is not null or toxic is not null").groupBy(F.col("doc_id").alias("_doc")).agg(bad.alias("_bad"))
    return shown.join(by_doc, "_doc").select("url", F.when(F.col("_bad") == 1, "block").otherwise("allow").alias("label"))
