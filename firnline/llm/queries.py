"""The registered queries of this subpackage: thin digests over the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.llm import alignment, bpe, conversations, line_dedup, near_dup, packing, quality_classifier, quality_rules, substring_dedup, suffix_dedup, topk, toxicity, url_filter
from firnline.llm.common import read_table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def alignment_paths() -> tuple[str, str]:
    """The byte-level vocabulary and the piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    out = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"), path), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), k=3, numerator=85, denominator=100)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_passages(read_table(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations")
    repair = conversations.Repair(conversations.damaged(given))
    digest = repair.repaired_digest()
    out = given.select(F.col("conv_id").alias("_id")).distinct()
    for part in (repair.summary(), digest):
        out = out.join(part, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.align(read_table(spark, sf_dir, "documents"), *alignment_paths())
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")


#: The rules that the query is stated with.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES, url_filter.page_labels(pages, read_table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_minhash": op2_minhash,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_topk": op6_topk,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_suffix_array": op9_suffix_array,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversations": op11_conversations,
    "op12_alignment": op12_alignment,
    "op13_url_filter": op13_url_filter,
}

_WORD = r"[^\x20\x09-\x0D]+"

#: The queries that SQL can express; the others are held against brute force in the tests.
ORACLES: dict[str, str] = {
    "op2_minhash": f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w),
t AS (SELECT doc_id, unnest(g) AS x, len(g) AS n FROM s), c AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c, any_value(a.n) + any_value(b.n) AS m FROM t a JOIN t b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT i, j FROM c WHERE 100 * c >= 85 * (m - c)), e AS (SELECT i, j FROM l UNION ALL SELECT j, i FROM l), r(i, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.j, r.root FROM r JOIN e ON r.i = e.i)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, k.root AS component_id, s.doc_id = k.root AS kept FROM s JOIN (SELECT i, min(root) AS root FROM r GROUP BY i) k ON k.i = s.doc_id""",
    "op5_substring_dedup": f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents), i AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM w WHERE len(w) >= 50),
h AS (SELECT doc_id, s, array_to_string(w[s : s + 49], ' ') AS k FROM i), f AS (SELECT k, min(doc_id) AS d FROM h GROUP BY k), r AS (SELECT DISTINCT doc_id, s + o AS p FROM h JOIN f USING (k) CROSS JOIN generate_series(0, 49) t(o) WHERE doc_id > d), g AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(array_to_string(list_filter(w, lambda x, n: NOT list_contains(coalesce(gone, []), n)), ' ')) AS kept_sha256 FROM w LEFT JOIN g USING (doc_id)""",
    "op6_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(generate_series(1, len(a.e)), lambda i: a.e[i] * b.e[i]))::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s) WHERE rank <= 5""",
    "op10_line_dedup": f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line, unnest(ls) AS t FROM d),
k AS (SELECT doc_id, line, list_sort(list_distinct(regexp_extract_all(t, '{_WORD}'))) AS w FROM l), c AS (SELECT w, len(w) AS n, min({{'d': doc_id, 'l': line}}) AS first, row_number() OVER () AS id FROM k WHERE len(w) >= 1 GROUP BY w),
t AS (SELECT id, n, unnest(w) AS x FROM c), f AS (SELECT x, count(*) AS f FROM t GROUP BY x), p AS (SELECT * FROM (SELECT id, n, t.x, row_number() OVER (PARTITION BY id ORDER BY f, t.x) AS i FROM t JOIN f USING (x)) WHERE i <= n - (n * 4 + 4) // 5 + 1),
q AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.x = b.x AND a.id <> b.id WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)), o AS (SELECT a.id, len(list_intersect(a.w, b.w)) AS s, a.n + b.n AS m FROM q JOIN c a ON a.id = q.a JOIN c b ON b.id = q.b WHERE b.first < a.first),
m AS (SELECT DISTINCT id FROM o WHERE 5 * s >= 4 * (m - s)), r AS (SELECT k.doc_id, list(line) AS gone FROM k JOIN c USING (w) WHERE c.id IN (SELECT id FROM m) OR {{'d': k.doc_id, 'l': k.line}} > c.first GROUP BY k.doc_id)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(array_to_string(list_filter(ls, lambda x, n: NOT list_contains(coalesce(gone, []), n - 1)), chr(10))) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)""",
}
