"""Defined cases of every operator: empty tables, repeated rows, ties, clashing columns, long texts and whole tables."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline.llm import bpe, line_dedup, near_dup, packing, quality_classifier, quality_rules, queries, substring_dedup, suffix_dedup, topk, toxicity
from firnline.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n=24, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    return [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(8, 15))).capitalize() + "." for _ in range(5)), "en", "s", -1) for i in range(n)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_tables(spark):
    none = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(none, labels).count() == 0
    assert toxicity.score_documents(none, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")).count() == 0
    assert bpe.decode(bpe.encode(none, tokenizer_path()), tokenizer_path()).count() == 0


def test_an_empty_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_repeated_rows_give_the_same_again(spark):
    """Each row of a table that holds all of its rows twice has the result of a row of its own."""
    rows = prose()
    once, twice = table(spark, rows), table(spark, rows + rows)
    path = tokenizer_path()
    labels = spark.createDataFrame([(i, i % 3 == 0, "x", 5) for i in range(24)] * 2, "doc_id long, toxic boolean, text string, n_chars int").withColumn("toxic", F.col("toxic").cast("int"))
    got = [sorted(map(tuple, f.collect())) for f in (bpe.encode(once, path).select("doc_id", "n_tokens"), bpe.encode(twice, path).select("doc_id", "n_tokens"))]
    assert got[1] == sorted(got[0] * 2)
    pieces = packing.pack(twice, path).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r["n"] == 2 * r["t"] for r in pieces)
    for make in (lambda d: toxicity.score_documents(d, labels).select("doc_id", F.round("score", 9)), lambda d: quality_rules.apply_rules(d).select("doc_id", "kept")):
        a, b = (sorted(map(tuple, make(d).collect())) for d in (once, twice))
        assert len(b) == 2 * len(a) and b[::2] == b[1::2]
    assert quality_classifier.classify(twice).count() == 48
    near = near_dup.near_duplicates(twice).collect()
    assert len(near) == 48 and all(r["component_id"] == r["doc_id"] and r["kept"] for r in near)
    assert {r["n_removed"] for r in line_dedup.dedup_lines(twice).collect()} == {0} == {r["n_removed"] for r in substring_dedup.remove_passages(twice).collect()}
    assert all(r["n_removed"] == r["n_bytes"] for r in suffix_dedup.remove_repeats(twice, 100).collect())


def test_lines_of_one_id(spark):
    """Two texts under one id keep their own lines, whichever order they come in."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(8)) for x in "abc")
    rows = [(1, f"{a}\n{b}", "en", "s", 0), (1, f"{c}\n{a}", "en", "s", 0), (2, f"{c}\nother words of this very line", "en", "s", 0)]
    for order in (rows, rows[::-1]):
        got = sorted((r["doc_id"], r["kept"]) for r in line_dedup.dedup_lines(table(spark, order).repartition(2)).collect())
        assert got == sorted([(1, rows[0][1]), (1, c), (2, "other words of this very line")])


def test_ties_of_neighbours_go_to_the_smaller_id():
    examples = [(i, i % 2 == 0, {0: 1}) for i in range(40, 0, -1)]
    index = toxicity.build_index(examples, {"t": 0}, np.ones(1), (20, 20))
    near = index.nearest(*index.vector({0: 3}))
    assert [int(index.example_ids[e]) for _, e in near] == list(range(1, toxicity.K + 1))


def test_curves_follow_the_labels():
    rng = np.random.default_rng(0)
    votes = rng.random(4000)
    truth = 1 / (1 + np.exp(-(2.5 * toxicity._logit(votes) - 1)))
    slope, offset = toxicity.fitted_curve(votes, (rng.random(4000) < truth).astype(float), np.ones(4000))
    assert abs(slope - 2.5) < 0.3 and abs(offset + 1) < 0.3
    assert toxicity.fitted_curve(np.zeros(5), np.zeros(5), np.ones(5))[0] > 0


def test_expectation_maximisation_document_by_document():
    """The model over counted patterns against one that goes through the votes of every document."""
    q, rng = quality_classifier, np.random.default_rng(1)
    votes = rng.integers(0, 3, (120, len(q.LABELLERS)))
    patterns = (votes * np.array(q._BASE3)).sum(1)
    unique, counts = np.unique(patterns, return_counts=True)
    posterior, _, share = q.estimate(unique, counts.astype(float))
    good = [0.15 if (v == 1).any() else 0.95 if (v == 2).any() else 0.5 for v in votes]
    for _ in range(q.ROUNDS):
        mass = [sum(1 - g for g in good), sum(good)]
        prior = (mass[1] + 4 * q.PRIOR_GOOD) / (sum(mass) + 4)
        accuracy = {}
        for j in range(votes.shape[1]):
            for c in (0, 1):
                seen = [1 * q.BELIEF[c][v] + q.BELIEF_WEIGHT * mass[c] * q.BELIEF[c][v] + sum((g if c else 1 - g) for g, own in zip(good, votes) if own[j] == v) for v in range(3)]
                accuracy[j, c] = [x / sum(seen) for x in seen]
        odds = [math.log(prior / (1 - prior)) + sum(math.log(accuracy[j, 1][v] / accuracy[j, 0][v]) for j, v in enumerate(own) if v) for own in votes]
        good = [1 / (1 + math.exp(-max(-30, min(30, o)))) for o in odds]
    of = dict(zip(unique.tolist(), posterior))
    assert np.allclose([of[p] for p in patterns.tolist()], good, atol=1e-9) and abs(share - prior) < 1e-9


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
def test_whole_tables(spark):
    """Encoding of a whole table against the library, and packing's pieces against the encoding."""
    import hashlib
    import zlib

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    got = {r["doc_id"]: r for r in queries.op1_bpe(spark, FOLDER).collect()}
    assert len(got) == len(texts)
    for i, own in ids.items():
        decoded = tokenizer.decode(own, skip_special_tokens=False)
        expected = len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == expected
    sequences = {}
    for r in queries.op3_packing(spark, FOLDER).collect():
        piece = np.array([*ids[r["doc_id"]], 2], "<u4")[r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]]) + 1
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["start"] + r["length"] == r["doc_tokens"]))
    lengths = {}
    for s, spans in sequences.items():
        at = 0
        for offset, length, _ in sorted(spans):
            assert offset == at
            at += length
        lengths[s] = at
    assert sum(n for n in lengths.values()) == sum(len(own) + 1 for own in ids.values()) and max(lengths.values()) <= 4096
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in lengths.values())
    assert padding < 0.02 * sum(lengths.values())


def test_top_k_of_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.9]), (0, [1.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == {1, 2} and {r["query_id"] for r in got} == {0}
