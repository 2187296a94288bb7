"""Words that sums of powers can't tell apart."""

import numpy as np
from pyspark.sql import functions as F

from firnline.llm import near_dup, substring_dedup, wordhash


def pair(n):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_long_words_differ():
    for n in (512, 1024, 2048, 4096):
        hashes, start, end, owner = wordhash.words([w.encode() for w in pair(n)])
        assert len(set(hashes.tolist())) == 2, n


def test_words_hash_alike_wherever_they_stand():
    texts = [b"x abc", b"abc  y abc", b"cab", "äbc abc".encode()]
    hashes, start, end, owner = wordhash.words(texts)
    data, _ = wordhash.join_texts(texts)
    by_word = {}
    for h, a, b in zip(hashes.tolist(), start, end):
        by_word.setdefault(data[a:b].tobytes(), set()).add(h)
    assert all(len(v) == 1 for v in by_word.values()) and len(set.union(*by_word.values())) == len(by_word) == 5


def test_near_duplicates_tell_them_apart(spark):
    docs = spark.createDataFrame(list(enumerate(pair(1024), 1)), "doc_id long, text string")
    out = near_dup.near_duplicates(docs, k=3, numerator=85, denominator=100).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == [(1, 1, True), (2, 2, True)]


def test_passages_that_differ_in_them_stay(spark):
    around = [f"w{n}" for n in range(60)]
    texts = [" ".join([*around[:30], w, *around[30:]]) for w in pair(1024)]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    out = substring_dedup.remove_passages(docs, window=50).select("doc_id", "n_words", F.col("n_removed")).collect()
    assert sorted(map(tuple, out)) == [(1, 61, 0), (2, 61, 0)]
