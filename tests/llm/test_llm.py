"""The dealt operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline.llm import bpe, components, line_dedup, near_dup, packing, quality_classifier, quality_rules, repeats, substring_dedup, suffix_dedup, topk, toxicity
from firnline.llm.common import Scratch
from firnline.llm.queries import tokenizer_path
from firnline.llm.text_stats import FIELDS, stats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, low string, class string"


def corpus() -> list[tuple]:
    """Prose with copies, near copies, shared passages and lines, junk, and the awkward cases."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    text = lambda: "\n".join(sentence(rng.randint(8, 20)) for _ in range(rng.randint(2, 9)))
    passage, line = " ".join(rng.choice(vocabulary) for _ in range(70)), sentence(12)
    texts = [text() for _ in range(40)]
    texts += texts[:6]  # copies
    for t in texts[6:14]:  # near copies
        words = t.split(" ")
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [f"{sentence(9)}\n{passage}\n{sentence(7)}" for _ in range(5)]
    texts += [f"{line}\n{text()}" for _ in range(4)]
    texts += [None, "", "  \n\t ", "one", "two words", "a b c", "a b c", "x" * 9000, "spam " * 900, "été naïve 中文 \U0001f600", "<|endoftext|> in text", "tab\tseparated\x0bwords\rhere and there"]
    texts += ["&&& ### " * 30, "LOUD WORDS EVERYWHERE!! " * 20]
    return [(i * 3 + 1, t, [None, "en", "de"][i % 3], [None, "s0", "s1"][i % 2], -1, 7, "clash", "clash") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(frame):
    return {r[0]: r for r in frame.collect()}


def ascii_words(text):
    return (text or "").encode().split()


def test_encode_and_decode(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = rows(bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()))
    for doc_id, text, *_ in corpus():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[doc_id]["ids"], "<u4").tolist() == ids
        assert got[doc_id]["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
    assert bpe.encode(empty, tokenizer_path()).count() == 0


def test_tree_concatenation():
    encoder, rng = bpe.PieceEncoder(tokenizer_path()), random.Random(3)
    for n, parts in ((5000, "abc"), (9000, ["th", "the", "ing", "a"]), (7001, ["a"]), (4097, "xyzé")):
        piece = "".join(rng.choice(parts) for _ in range(n))
        assert bpe.encode_long(encoder.letters(piece), encoder) == encoder.whole.encode(piece, add_special_tokens=False).ids


def test_packing(docs, empty):
    encoder = bpe.PieceEncoder(tokenizer_path())
    pieces, lengths, by_sequence = defaultdict(list), Counter(), defaultdict(list)
    for r in packing.pack(docs, tokenizer_path(), window=512).collect():
        pieces[r["doc_id"]].append(r)
        lengths[r["sequence_id"]] += r["length"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text, *_ in corpus():
        parts = sorted(pieces[doc_id], key=lambda r: r["start"])
        assert b"".join(bytes(p["ids"]) for p in parts) == encoder.encode(text) + (2).to_bytes(4, "little")
        assert all(p["doc_tokens"] * 4 == len(encoder.encode(text)) + 4 for p in parts)
        assert [p["start"] for p in parts] == np.cumsum([0] + [p["length"] for p in parts])[:-1].tolist()
    assert max(lengths.values()) <= 512
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
    padding = sum(0 if n & (n - 1) == 0 else 512 - n for n in lengths.values())
    assert padding < 0.02 * sum(lengths.values())
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_cuts_are_the_cheapest():
    rng = random.Random(1)
    for _ in range(40):
        places = sorted(rng.sample(range(1, 60), 20))
        places = [p for i, p in enumerate(places)]
        if max(np.diff([0, *places])) > 12:
            continue
        penalties = [rng.choice([0, 1, 3]) for _ in places]
        best = {0: 0}
        for i, p in enumerate(places):
            best[p] = min(best[q] + 12 - (p - q) + penalties[i] for q in best if 0 < p - q <= 12)
        cuts = packing.plan_cuts(places, penalties, 12, True)
        cost = sum(12 - (b - a) + penalties[places.index(b)] for a, b in zip([0, *cuts], cuts))
        assert cost == min(c for p, c in best.items() if p >= places[-1] - 12)


def brute_components(texts, k, numerator, denominator):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and denominator * shared >= numerator * (len(sets[a]) + len(sets[b]) - shared):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k, numerator, denominator", [(3, 85, 100), (5, 4, 5)])
def test_near_duplicates(docs, empty, k, numerator, denominator):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs, k, numerator, denominator).collect()}
    assert got == brute_components([r[:2] for r in corpus()], k, numerator, denominator)
    assert near_dup.near_duplicates(empty).count() == 0


def test_long_chains_become_one_component(spark):
    order = list(range(1500))
    random.Random(8).shuffle(order)
    links = list(zip(order, order[1:])) + [(2000 + i, 2001 + i) for i in range(40)] + [(-5, -9), (-9, -7), (3000, 3000)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test")).collect()
    expected = {i: 0 for i in order} | {i: 2000 for i in range(2000, 2041)} | {-5: -9, -9: -9, -7: -9, 3000: 3000}
    assert len(got) == len(expected) and {r["node"]: r["component"] for r in got} == expected


def test_blocks_link_what_pairs_do():
    rng = np.random.default_rng(0)
    base = rng.choice(1 << 40, 300, replace=False).astype(np.uint64)
    sets = [np.sort(np.concatenate([rng.choice(base, 280, replace=False), rng.choice(1 << 50, 10).astype(np.uint64)])) for _ in range(30)]
    links = near_dup.block_links(np.arange(30), sets, None, 4, 5)
    parent = list(range(30))
    for a, b in links:
        parent[max(a, b)] = min(a, b)
    expected = {i for i in range(30) for j in range(30) if i != j and 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))}
    assert {x for link in links for x in link} == expected


def test_registers_estimate():
    rng = np.random.default_rng(1)
    a = np.sort(rng.choice(1 << 55, 4000, replace=False).astype(np.uint64))
    b = np.sort(np.concatenate([a[:3000], rng.choice(1 << 55, 1000).astype(np.uint64)]))
    table = near_dup.registers([a, b])
    assert abs(near_dup.estimate(table[:1], table[1:])[0, 0] - 0.6) < 0.12


def test_substring_removal(docs, empty):
    texts = {i: ascii_words(t) for i, t, *_ in corpus()}
    first = {}
    for i in sorted(texts):
        for s in range(len(texts[i]) - 49):
            first.setdefault(tuple(texts[i][s : s + 50]), i)
    got = rows(substring_dedup.remove_passages(docs, 50))
    for i, words in texts.items():
        gone = set()
        for s in range(len(words) - 49):
            if first[tuple(words[s : s + 50])] < i:
                gone |= set(range(s, s + 50))
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(words), len(gone))
        assert bytes(got[i]["kept"]) == b" ".join(w for n, w in enumerate(words) if n not in gone)
    assert substring_dedup.remove_passages(empty).count() == 0


@pytest.mark.parametrize("length", [400, 80])
def test_suffix_removal(docs, empty, length):
    texts = {i: (t or "").encode() for i, t, *_ in corpus()}
    seen = Counter(t[s : s + length] for t in texts.values() for s in range(len(t) - length + 1))
    got = rows(suffix_dedup.remove_repeats(docs, length))
    for i, t in texts.items():
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int))).reshape(-1, 2).tolist()
        assert (got[i]["n_bytes"], got[i]["n_removed"], [list(s) for s in got[i]["spans"]]) == (len(t), int(gone.sum()), edges)
        assert hashlib.sha256(bytes(got[i]["kept"])).digest() == hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).digest()
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("length", [400, 80])
def test_first_occurrence_stays(spark, docs, length):
    """Every window against the first of its name by (id, start); a passage repeated inside one document too."""
    rng = random.Random(12)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage, other = letters(400), letters(150)
    more = [(2000, passage * 20), (2001, letters(30) + passage + letters(9) + passage[:300] + other), (2002, other * 7), (2003, letters(50) + other + passage + other), (2004, "y" * 700)]
    everything = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(3)
    texts = {i: (t or "").encode() for i, t in [r[:2] for r in corpus()] + more}
    first, expected = {}, {}
    for i, t in sorted(texts.items()):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            j, f = first.setdefault(t[s : s + length], (i, s))
            if (j, f) != (i, s):
                gone[max(s, f + length) if i == j else s : s + length] = True
        expected[i] = np.frombuffer(t, np.uint8)[~gone].tobytes()
    got = rows(suffix_dedup.remove_repeats(everything, length, first_stays=True))
    assert {i: bytes(r["kept"]) for i, r in got.items()} == expected
    assert len(expected[2004]) == length and (length < 400 or expected[2000] == passage.encode())


def test_hot_passages_are_salted(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_REGIONS", 3)
    rng = random.Random(2)
    passage = " ".join(str(rng.randrange(1000)) for _ in range(60))
    table = spark.createDataFrame([(i, f"{rng.random()} {passage} {rng.random()}") for i in range(40)], "doc_id long, text string")
    got = rows(substring_dedup.remove_passages(table, 50))
    assert [got[i]["n_removed"] for i in range(40)] == [0] + [60] * 39


def test_runs_spill(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    queue, rng, everything = repeats.RunQueue(limit=100, block=16), np.random.default_rng(0), []
    for _ in range(9):
        names = rng.integers(0, 50, 40).astype(np.uint64)
        everything += names.tolist()
        queue.push(names, np.zeros(40, repeats._REF))
    blocks = [n.tolist() for n, _ in queue.blocks()]
    assert sum(blocks, []) == sorted(everything)
    assert not set(blocks[0]) & set(blocks[1])


def test_line_removal(docs, empty):
    lines = [(i, n, frozenset(x.encode().split())) for i, t, *_ in corpus() for n, x in enumerate((t or "").split("\n"))]
    gone = defaultdict(set)
    for i, n, s in lines:
        if s and any((j, m) < (i, n) and o and 5 * len(s & o) >= 4 * len(s | o) for j, m, o in lines):
            gone[i].add(n)
    got = rows(line_dedup.dedup_lines(docs))
    for i, t, *_ in corpus():
        own = (t or "").split("\n")
        assert (got[i]["n_lines"], got[i]["n_removed"]) == (len(own), len(gone[i]))
        assert got[i]["kept"] == "\n".join(x for n, x in enumerate(own) if n not in gone[i])
    assert line_dedup.dedup_lines(empty).count() == 0


def test_counts_and_rules(docs, empty):
    got = rows(quality_rules.apply_rules(docs))
    for i, t, *_ in corpus():
        words = ascii_words(t)
        windows = Counter(zip(words, words[1:], words[2:]))
        repeated = {n + d for n, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
        own = [x for x in (t or "").split("\n") if x.encode().split()]
        expected = (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t or ""), len(own) - len(set(own)), len(repeated))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])
    assert quality_rules.apply_rules(empty).count() == 0


def test_labellers_and_scorer(docs, empty):
    got = rows(quality_classifier.classify(docs))
    texts = {i: t for i, t, *_ in corpus()}
    for i, t in texts.items():
        if t and ("&&&" in t or "LOUD" in t or t.startswith("spam")):
            assert not got[i]["kept"]
    prose = [i for i, t in texts.items() if t and t.count("\n") > 1 and t.isascii()]
    assert sum(got[i]["kept"] for i in prose) >= 0.95 * len(prose)
    good = {r["doc_id"] for r in quality_classifier.keep_good(docs).select("doc_id").collect()}
    assert good == {i for i in texts if got[i]["kept"]}
    assert quality_classifier.classify(empty).count() == 0
    assert dict(zip(FIELDS, stats(None)))["n_words"] == 0


def test_shapes_are_of_whole_words():
    buckets = quality_classifier._Buckets()
    start = "字" * 40
    plain, longer, mixed = (buckets[w.encode()] for w in (start, start + "文" * 400, start + "文1A" * 400))
    assert plain[1] == longer[1] != mixed[1] and plain[0] != longer[0]
    assert buckets[(start + "文1A" * 400).encode()] == mixed and not buckets  # long words are not remembered


def test_estimated_accuracies():
    """Votes drawn from known accuracies: the posterior orders documents by their true class."""
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.85
    patterns = np.zeros(4000, np.int64)
    for j in range(len(quality_classifier.LABELLERS)):
        right = rng.random(4000) < 0.9
        vote = np.where(rng.random(4000) < 0.3, 0, np.where(truth == right, 2, 1))
        patterns += vote * 3**j
    unique, counts = np.unique(patterns, return_counts=True)
    posterior, table, _ = quality_classifier.estimate(unique, counts.astype(float))
    of = dict(zip(unique.tolist(), posterior))
    agreed = np.mean([(of[p] >= 0.5) == t for p, t in zip(patterns.tolist(), truth)])
    assert agreed > 0.97


def toxic_rows(n=600):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6))) for _ in range(300)]
    out = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        bad = i % 6 == 0
        if bad:
            w[rng.randrange(len(w))] = "vile" + rng.choice(["", "st", "ness", "ly"])
            w[rng.randrange(len(w))] = "rotten"
        out.append((i, " ".join(w), int(bad)))
    return out


def test_toxicity(spark, docs):
    made = toxic_rows()
    table = spark.createDataFrame([(i, t) for i, t, _ in made] + [(9001, None), (9002, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made] + [(9001, None)], "doc_id long, toxic int")
    got = rows(toxicity.score_documents(table, labels))
    held = [(got[i]["score"], y) for i, _, y in made if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(s >= 0.3) == bool(y) for s, y in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[9001]["score"] == got[9002]["score"] < 0.3
    without = labels.where("false")
    assert {r["score"] for r in toxicity.score_documents(table, without).collect()} == {toxicity.PRIOR}


def test_block_max_search_is_exact():
    rng = random.Random(4)
    terms = {f"t{i}": i for i in range(30)}
    examples = [(i, rng.random() < 0.3, {rng.randrange(30): rng.randint(1, 4) for _ in range(rng.randint(0, 6))}) for i in range(500)]
    index = toxicity.build_index(examples, terms, np.array([1 + i / 10 for i in range(30)]), (350, 150))
    vectors = [dict(zip(*map(np.ndarray.tolist, index.vector(c)))) for _, _, c in examples]
    for _ in range(50):
        ids, weights = index.vector({rng.randrange(30): 1 for _ in range(3)})
        query = dict(zip(ids.tolist(), weights.tolist()))
        scores = sorted(((round(sum(w * v.get(i, 0) for i, w in query.items()), 12), e) for e, v in enumerate(vectors)), key=lambda x: (-x[0], x[1]))
        assert index.nearest(ids, weights) == [x for x in scores if x[0] > 0][: toxicity.K]


def test_top_k(spark):
    rng = np.random.default_rng(2)
    made = [(i, rng.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(300)]
    made += [(1000 + i, made[50][1]) for i in range(8)]  # ties
    made += [(2000, None), (2001, []), (2002, [None] * 8), (2050, [float("nan")] * 8), (2100, [float("inf")] * 8), (2003, [0.1, 0.2])]
    table = spark.createDataFrame([(*m, 3, "x") for m in made], "vec_id long, embedding array<float>, label int, dim string")
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in made if v and len(v) == 8 and v[0] is not None and np.isfinite(v).all()]
    expected = set()
    for i, q in good:
        if i % 50 == 0:
            best = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i))[:5]
            expected |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    assert {tuple(r) for r in topk.top_k(table).collect()} == expected
    assert topk.top_k(table.where("false")).count() == 0


def test_top_k_of_large_numbers(spark):
    table = spark.createDataFrame([(0, [1e5, 2e5]), (1, [3e5, -1e5]), (2, [1e6, 1.0])], "vec_id long, embedding array<double>")
    got = {(r["vec_id"], r["score"]) for r in topk.top_k(table).collect()}
    assert got == {(1, 256 * 256 * 10**10), (2, 256 * 256 * (10**11 + 2 * 10**5))}


def test_rows_without_an_id_stay(spark, docs):
    text = corpus()[0][1]
    both = docs.union(spark.createDataFrame([(None, text, "en", "s0", -1, 7, "clash", "clash"), (None, None, None, None, None, None, None, None)], SCHEMA))
    labels = spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, toxic int")
    for frame in (near_dup.near_duplicates(both), suffix_dedup.remove_repeats(both), substring_dedup.remove_passages(both), line_dedup.dedup_lines(both), quality_rules.apply_rules(both), quality_classifier.classify(both), toxicity.score_documents(both, labels), bpe.encode(both, tokenizer_path())):
        lost = frame.where("doc_id is null")
        assert frame.count() == len(corpus()) + 2 and lost.count() == 2
        if "n_removed" in frame.columns:
            assert lost.agg(F.sum("n_removed")).first()[0] == 0
    assert packing.pack(both, tokenizer_path()).where("doc_id is null").agg(F.count_if(F.col("start") == 0)).first()[0] == 2


def test_repeated_rows_do_no_harm(docs):
    twice = docs.union(docs)
    n = twice.count()
    for frame in (near_dup.near_duplicates(twice), suffix_dedup.remove_repeats(twice), substring_dedup.remove_passages(twice), line_dedup.dedup_lines(twice), quality_rules.apply_rules(twice)):
        assert frame.count() >= n / 2
