"""The dealt methods themselves: what their steps decide, held against brute force."""

import random

import numpy as np
import pytest

from firnline.llm import common, line_dedup, near_dup, quality_classifier, quality_rules, repeats, substring_dedup, suffix_dedup, topk
from firnline.llm.text_stats import FIELDS, stats

SCHEMA = "doc_id long, text string, lang string, source string"


def sentences(rng, n, letters, low, high):
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(300)]
    return ". ".join(" ".join(rng.choice(words) for _ in range(rng.randint(6, 14))) for _ in range(n))


def test_limits_follow_their_group(spark):
    """Exact quartiles of each group (sketches of so few rows hold them all), the verdicts they give, and a text that
    one group keeps and the other does not."""
    rng = random.Random(4)
    rows = [(i, sentences(rng, rng.randint(8, 30), "abcdefgh", 2, 5), "en", "plain") for i in range(60)]
    rows += [(100 + i, sentences(rng, rng.randint(8, 30), "abcdefgh", 9, 14), "en", "long") for i in range(60)]
    rows += [(200 + i, "# " * (5 + i % 7) + sentences(rng, 20, "abcdefgh", 2, 5), None, "marked") for i in range(60)]
    same = sentences(random.Random(1), 20, "abcdefgh", 9, 14)
    rows += [(300, same, "en", "plain"), (301, same, "en", "long"), (302, None, "en", "plain"), (303, "", None, "marked")]
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    counted = {i: dict(zip(FIELDS, stats(t))) for i, t, _, _ in rows}
    limits = {}
    for key in {r[2:] for r in rows}:
        own = [counted[r[0]] for r in rows if r[2:] == key]
        at = lambda values, rank: sorted(values)[max(0, -int(-rank * len(values) // 1) - 1)]
        for m, (count, per, event) in quality_rules.MEASURES.items():
            values = [c[count] / max(1, c[per]) for c in own]
            low, high = at(values, 0.25), at(values, 0.75)
            spread = quality_rules.FENCE * max(high - low, event / max(1, at([c[per] for c in own], 0.25)))
            limits[key, m] = low - spread, high + spread
    for i, _, *key in rows:
        beyond = False
        for m in quality_rules.MEASURES:
            low, high = limits[tuple(key), m]
            assert (got[i][f"low_{m}"], got[i][f"high_{m}"]) == pytest.approx((low, high))
            beyond |= not low <= got[i][m] <= high
        assert got[i]["kept"] == (not beyond and not got[i]["base_failed"])
    assert len({got[i]["high_word_length"] for i in (0, 100, 200)}) == 3
    assert got[301]["kept"] and not got[300]["kept"] and not got[300]["base_failed"]
    assert sum(got[i]["kept"] for i in got if i < 300) > 170


def test_small_groups_take_wider_sketches(spark):
    rng = random.Random(6)
    rows = [(i, sentences(rng, 20, "abcdefgh", 2, 5), "en", f"s{i}") for i in range(40)] + [(99, sentences(rng, 20, "abcdefgh", 9, 14), "de", "x")]
    got = quality_rules.apply_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({r["high_word_length"] for r in got if r["lang"] == "en"}) == 1
    assert not next(r for r in got if r["doc_id"] == 99)["kept"]  # judged by the corpus's sketch


def test_rows_of_one_id_keep_their_own_places(spark):
    """Two texts under one id: each loses its own repeated bytes; words shared only within an id stay."""
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage, own = letters(500), [letters(900), letters(40), letters(2000)]
    rows = [(7, own[0] + passage), (7, passage + own[1]), (9, own[2])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((r["n_bytes"], r["n_removed"], bytes(r["kept"]).decode()) for r in suffix_dedup.remove_repeats(table).collect())
    assert got == sorted([(1400, 500, own[0]), (540, 500, own[1]), (2000, 0, own[2])])
    assert {r["n_removed"] for r in substring_dedup.remove_passages(table).collect()} == {0}
    stays = sorted(bytes(r["kept"]).decode() for r in suffix_dedup.remove_repeats(table, first_stays=True).collect())
    assert stays in (sorted([own[0] + passage, own[1], own[2]]), sorted([own[0], passage + own[1], own[2]]))


def test_characters_stay_whole(spark):
    """Repeats that begin and end inside characters: the bytes differ from character borders by one or two."""
    rng = random.Random(5)
    shared = "".join(rng.choice("жщю") for _ in range(300))
    rows = [(i, a + shared + b) for i, (a, b) in enumerate([("x" * 50 + "б", "ш" + "y" * 40), ("z" * 30 + "в", "ъ" + "w" * 60)])]  # last bytes of ш, ъ and first of б, в agree
    table = spark.createDataFrame(rows, "doc_id long, text string")
    plain = rows_of(suffix_dedup.remove_repeats(table, 200))
    whole = rows_of(suffix_dedup.remove_repeats(table, 200, whole_characters=True))
    for i, text in rows:
        assert plain[i]["n_removed"] >= 600 and whole[i]["n_removed"] == 600
        assert bytes(whole[i]["kept"]).decode() == text.replace(shared, "")


def test_long_texts(spark):
    """A text of a megabyte in one line, beside its copy with a change."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(180_000))
    changed = long[:500_000] + "#" + long[500_000:]
    rows = [(1, long), (2, changed), (3, "short"), (4, None)]
    table = spark.createDataFrame([(*r, "en", "s") for r in rows], SCHEMA)
    removed = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(table).collect()}
    assert removed[1] == (len(long), len(long)) and removed[2] == (len(changed), len(changed) - 1) and removed[3] == (5, 0)
    found = rows_of(substring_dedup.remove_passages(table))
    assert found[1]["n_removed"] == 0 and found[2]["n_removed"] >= found[2]["n_words"] - 2
    assert rows_of(near_dup.near_duplicates(table))[2]["component_id"] == 1
    assert rows_of(line_dedup.dedup_lines(table))[2]["n_removed"] == 1
    assert quality_rules.apply_rules(table).count() == quality_classifier.classify(table).count() == 4


def rows_of(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_suffix_tree_leaves():
    """Deep nodes against windows held as tuples, with few words so that many prefixes agree."""
    rng = np.random.default_rng(3)
    for window in (1, 2, 3, 7, 12):
        codes = rng.integers(0, 2, 400)
        node = substring_dedup.deep_nodes(codes, window)
        names = [tuple(codes[i : i + window]) for i in range(400 - window + 1)]
        assert len(node) == len(names) and len(set(zip(node.tolist(), names))) == len(set(node.tolist())) == len(set(names))
        counts = rng.integers(1, 20, 9)
        pieces = np.array([(d, 0, 100, n) for d, n in zip([3, 1, 2, 2, 5, 3, 9, 1, 4], counts)], substring_dedup._PIECE)
        texts = [rng.integers(0, 2, n + window - 1) for n in counts]
        found = set(zip(*map(np.ndarray.tolist, substring_dedup.repeated_leaves(pieces, [str(c).encode() for t in texts for c in t], window))))
        least = {}
        for p, t in zip(pieces, texts):
            for i in range(p["count"]):
                least[tuple(t[i : i + window])] = min(p["doc"], least.get(tuple(t[i : i + window]), 99))
        assert found == {(k, 100 + i) for k, (p, t) in enumerate(zip(pieces, texts)) for i in range(p["count"]) if p["doc"] > least[tuple(t[i : i + window])]}


def test_samples_that_collide_change_nothing(spark, monkeypatch):
    """Fingerprints of three bits, in samples and in regions' first half: words decide all the same."""
    weak = lambda sums, start, end: (span(sums, start, end) >> np.uint64(61)) << np.uint64(61)
    span = repeats.span_hash
    rng = random.Random(14)
    vocabulary = [str(i) for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    texts = [[rng.choice(vocabulary) for _ in range(40)] + passage + [rng.choice(vocabulary) for _ in range(30)] for _ in range(5)] + [[rng.choice(vocabulary) for _ in range(150)] for _ in range(5)]
    monkeypatch.setattr(repeats, "span_hash", weak)
    codes, first = substring_dedup._cut([" ".join(t) for t in texts])
    found = repeats.sample(codes, first, repeats.Units(substring_dedup._cut, 50, 8))
    assert len(set(found["gram"].tolist())) <= 8
    spans = [(d, lo, hi) for d, lo, hi in zip(found["doc"].tolist(), found["low"].tolist(), found["high"].tolist())]
    pieces = np.array([(d, 0, lo, hi - lo + 1) for d, lo, hi in spans], substring_dedup._PIECE)
    words = [w.encode() for d, lo, hi in spans for w in texts[d][lo : hi + 50]]
    piece, start = substring_dedup.repeated_leaves(pieces, words, 50)
    assert {(int(pieces["doc"][p]), int(s)) for p, s in zip(piece, start)} == {(d, s) for d in range(1, 5) for s in range(40, 61)}


def test_lists_are_read_in_part():
    """Sparse directions: bounds stop reading early, and a block that can't reach the best is left unread."""
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (4000, 12))
    vectors[:40] += rng.integers(30, 60, (40, 12))
    low = rng.integers(-3, 4, (4000, 12))
    queries = rng.integers(1, 9, (20, 12))
    ids, query_ids = np.arange(4000), np.arange(20) + 100_000
    found, shares = topk.slab_top(query_ids, queries, [(ids, vectors), (ids + 4000, low)], 5)
    for n, q in zip(query_ids, queries):
        everything = np.concatenate([vectors, low]) @ q
        order = np.lexsort((np.arange(8000), -everything))[:5]
        assert [(v, s) for i, v, s in found if i == n] == [(int(o), int(everything[o])) for o in order]
    assert 0 < shares[0] <= 0.1 and shares[1] == 0.0


def test_top_k_against_all_products():
    rng = np.random.default_rng(6)
    for _ in range(6):
        n, dims = int(rng.integers(3, 60)), int(rng.integers(1, 7))
        vectors, queries = rng.integers(-4, 5, (n, dims)), rng.integers(-4, 5, (4, dims))
        ids = rng.permutation(100)[:n]
        cut = n // 2
        found, _ = topk.slab_top(ids[:4], queries[: len(ids[:4])], [(ids[:cut], vectors[:cut]), (ids[cut:], vectors[cut:])], 5)
        for i, q in zip(ids[:4], queries):
            best = sorted((-int(v @ q), int(j)) for v, j in zip(vectors, ids) if j != i)[:5]
            assert [(-s, v) for k, v, s in found if k == i] == best


def test_components_without_bounds_take_no_part(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1e300, 0.0]), (2, [-1e17, 1.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert {(r["query_id"], r["vec_id"]) for r in topk.top_k(table).collect()} == {(0, 3)}


def test_estimates_never_rule_out_a_link():
    """Sets of all sizes at and just above the threshold: the estimate stays within its margin."""
    rng = np.random.default_rng(9)
    for size in (3, 6, 10, 20, 40, 100, 400, 2000):
        for threshold in (0.8, 0.85):
            shared = int(np.ceil(2 * size * threshold / (1 + threshold)))
            for _ in range(60):
                values = rng.choice(1 << 55, 2 * size - shared, replace=False).astype(np.uint64)
                a, b = np.sort(values[:size]), np.sort(np.concatenate([values[:shared], values[size:]]))
                estimated = near_dup.estimate(near_dup.registers([a]), near_dup.registers([b]))[0, 0]
                assert estimated >= threshold - near_dup.margin(np.array([size]), threshold)[0]


def test_recall_at_the_threshold():
    """Pairs at 0.85 share a band of eight registers, as the banding promises."""
    rng = np.random.default_rng(10)
    rows, missed = near_dup.rows_per_band(0.85), 0
    for _ in range(400):
        values = rng.choice(1 << 55, 1081, replace=False).astype(np.uint64)
        table = near_dup.registers([np.sort(values[:1000]), np.sort(np.concatenate([values[:919], values[1000:]]))])
        left, right = near_dup.bands(table, rows)
        missed += not (left == right).any()
    assert rows == 8 and missed == 0


def test_clusters_need_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.Scratch(Session(), "x")


def test_postings_of_similar_lines_move_once(spark, tmp_path):
    """Each pass holds its own tokens, all passes all of them, and one exchange serves both sides of a pass's join."""
    rows = [(i, 0, 0, 9, i % 3, 0, [i, i + 1, i + 7], 1) for i in range(40)]
    spark.createDataFrame(rows, "first_id long, first_part int, first_line int, n int, parity long, parity2 long, prefix array<int>, open int").write.parquet(f"{tmp_path}/c")
    classes = spark.read.parquet(f"{tmp_path}/c")
    dealt = [line_dedup._posted(classes, turn) for turn in range(line_dedup.PASSES)]
    assert sorted(r["token"] for part in dealt for r in part.collect()) == sorted(t for r in rows for t in r[6])
    met = line_dedup._met_any(classes, 0, line_dedup.NUMERATOR, line_dedup.DENOMINATOR)
    assert met.count() and met.collect()
    assert "ReusedExchange" in met._jdf.queryExecution().executedPlan().toString()


def test_similar_lines_of_every_length(spark):
    """Lines about the threshold, on either side of the length from which they have a second parity, by brute force."""
    rng = random.Random(12)
    rows = []
    for family in range(60):
        n = rng.choice([1, 4, 5, 9, 10, 45, 60, 64, 65, 70, 81, 140])
        base = [f"w{family}x{i}" for i in range(n)]
        for _ in range(4):
            gone = set(rng.sample(range(n), rng.randint(0, max(0, n // 8))))
            line = [w for i, w in enumerate(base) if i not in gone] + [f"n{rng.random()}" for _ in range(rng.randint(0, n // 8))]
            rows.append((len(rows), " ".join(line), "en", "s"))
    rng.shuffle(rows)
    sets = {i: set(t.split()) for i, t, *_ in rows}
    near = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    expected = {i for i in sets if any(j < i and near(sets[i], sets[j]) for j in sets)}
    found = {r["doc_id"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect() if r["n_removed"]}
    assert found == expected and 40 < len(expected) < 200


def test_long_and_short_lines_meet_at_few_lengths(spark, tmp_path):
    """Only holders of a token whose lengths allow it are paired, and the exchange by token serves the join by token and length."""
    rows = [(n, 0, 0, n, 0, 0, [7], 1) for n in (10, 12, 13, 40, 49, 51, 400)]
    spark.createDataFrame(rows, "first_id long, first_part int, first_line int, n int, parity long, parity2 long, prefix array<int>, open int").write.parquet(f"{tmp_path}/c")
    classes = spark.read.parquet(f"{tmp_path}/c")
    spark.conf.set(line_dedup._ALL_KEYS, "false")
    try:
        met = line_dedup._met_any(classes, 7 % line_dedup.PASSES, line_dedup.NUMERATOR, line_dedup.DENOMINATOR)
        assert sorted((r["first_id"], r["_first_id"]) for r in met.collect()) == [(12, 10), (13, 12), (49, 40), (51, 49)]
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(line_dedup._ALL_KEYS)
    join = next(x for x in plan.splitlines() if "Join" in x)
    assert "token" in join and "step" in join and "hashpartitioning(token" in plan and ", step" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_nothing_stays_without_a_least_struct(spark, monkeypatch):
    """Where no occurrence stays, grams are counted without a minimum of structs, which Spark finds by sorting."""
    from firnline.llm import common

    plans, save = {}, common.Scratch.save

    def kept(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name)

    monkeypatch.setattr(common.Scratch, "save", kept)
    text = "".join(chr(97 + (i * i * 7 + i) % 23) for i in range(900))
    docs = spark.createDataFrame([(1, text), (2, "x" * 100 + text[:600]), (3, "y" * 700), (4, "short")], "doc_id long, text string")
    out = {r.doc_id: (r.n_removed, len(r.spans)) for r in suffix_dedup.remove_repeats(docs, 400).collect()}
    raw = {1: text.encode(), 2: ("x" * 100 + text[:600]).encode(), 3: b"y" * 700, 4: b"short"}
    seen = {}
    for i, t in raw.items():
        for a in range(len(t) - 399):
            seen.setdefault(t[a : a + 400], []).append((i, a))
    gone = {i: {p for places in seen.values() if len(places) > 1 for j, a in places if i == j for p in range(a, a + 400)} for i in raw}
    assert {i: n for i, (n, _) in out.items()} == {i: len(g) for i, g in gone.items()}
    assert "SortAggregate" not in plans["groups"] and "HashAggregate" in plans["groups"]
