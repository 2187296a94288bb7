"""Cross-tokenizer alignment against a plain version by byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from firnline.llm import alignment, queries


def plain(rows, a_tok, b_tok):
    """{id: (n_a, n_b, n_groups, n_links, n_best, count_sum, sha)} from whole texts, token by token."""
    docs = []
    for i, text in rows:
        a, b = [], []
        if text:
            spelled = (" " + text).encode()
            a = [(x, a_tok.spelling.spell(np.array([x])).tobytes()) for x in a_tok.whole.encode(" " + text, add_special_tokens=False).ids]
            b = [(x, b_tok.spelling.spell(np.array([x])).tobytes()) for x in b_tok.model.encode(text)]
            if b"".join(t for _, t in a) != spelled or b"".join(t for _, t in b) != spelled:
                a, b = [], []
        docs.append((i, *[[(x, e - len(t), e) for (x, t), e in zip(side, np.cumsum([len(t) for _, t in side]).tolist())] for side in (a, b)]))
    links = {}
    for k, (i, a, b) in enumerate(docs):
        links[k] = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
    count = Counter(p for found in links.values() for p in set(found))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for k, (i, a, b) in enumerate(docs):
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts = [",".join(str(x) for x, _, e in a if low < e <= high) + "|" + ",".join(str(x) for x, _, e in b if low < e <= high) for low, high in zip([0, *cuts], cuts)]
        sha = hashlib.sha256(";".join(parts).encode()).hexdigest() if cuts else ""
        out.append((i, len(a), len(b), len(cuts), len(links[k]), sum(count[p] == most[p[0]] for p in links[k]), sum(count[p] for p in links[k]), sha))
    return sorted(out, key=str)


def aligned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = alignment.align(docs, *queries.alignment_paths())
    return sorted(map(tuple, out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


HARD = [
    "", " ", "  ", "a", " a ", "a  b", "two  spaces  ", "tab\tx \t y", "line\n\n next \n", "nul\x00x", "café ﬁ ligature", "wide　space x", "mark▁x ▁ y▁ z", "<s>x</s> <unk> <|endoftext|> a<|endoftext|>",
    "don't we'll 'S x's", "12 345 67 8", "a" * 5000, "日本語 テキスト 🙂🙂", " \n", "x \n y", "  a  b", "\x1c a\x1c b", "<0x41> 0x41", "é ́", "a b c " * 300,
]


def test_rows_of_documents(spark):
    rng = random.Random(5)
    letters = ["a", "b", "th", "e", " ", "  ", "\n", "▁", "é", "1", ".", "'s", "日", "\t", " "]
    rows = [(n, t) for n, t in enumerate([None, *HARD, HARD[9]])]
    rows += [(100 + n, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for n in range(150)]
    rows += [(None, "no id here"), (7, "one id, another text"), (7, "one id, another text")]
    assert aligned(spark, rows) == plain(rows, *alignment._tokenizers(*queries.alignment_paths()))


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect() if len(r.text or "") < 3000][:60]
    assert aligned(spark, rows) == plain(rows, *alignment._tokenizers(*queries.alignment_paths()))


def test_units_spell_the_text():
    for text in HARD:
        if text:
            assert "".join(f" {u}" for u in alignment.units_of(text)) == f" {text}"


def test_a_product_of_matrices():
    rng = np.random.default_rng(3)
    left, right = (rng.random((40, 30)) < 0.2), (rng.random((30, 50)) < 0.2)

    def csr(m):
        return alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1])

    got = np.zeros((40, 50), int)
    for row, column, value in alignment.product(csr(left), csr(right)):
        got[row, column] = value
    assert (got == left.astype(int) @ right.astype(int)).all()
    back = alignment.transposed(csr(left))
    assert (back.indices == np.nonzero(left.T)[1]).all()


def test_small_slabs_and_chunks_change_nothing(spark, monkeypatch):
    rows = [(n, f"some text {n} of words and more words {n * n}") for n in range(30)]
    a, b = alignment._tokenizers(*queries.alignment_paths())
    want = plain(rows, a, b)
    monkeypatch.setattr(alignment, "SLAB", 7)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 90)
    monkeypatch.setattr(alignment, "ENCODE_BYTES", 20)
    out = [alignment._chunk([i for i, _ in rows[k : k + 3]], [t for _, t in rows[k : k + 3]], *queries.alignment_paths()) for k in range(0, 30, 3)]
    assert [x for c in out for x in c["sha"]] == [w[-1] for w in sorted(want)]


@pytest.mark.parametrize("shared", [False, True])
def test_links_as_rows(spark, shared):
    text = "Threonou edea, thly atrehe 12345 wörter"
    a_tok, b_tok = alignment._tokenizers(*queries.alignment_paths())
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {(r.a_place, r.b_place): r.weight for r in alignment.token_links(docs, *queries.alignment_paths(), shared_group=shared).collect()}
    ends = [np.cumsum(t.spelling.length[np.array(t.encode(f" {text}"))]).tolist() for t in (a_tok, b_tok)]
    starts = [[0, *e[:-1]] for e in ends]
    if shared:
        cuts = sorted(set(ends[0]) & set(ends[1]))
        group = [[sum(c < e for c in cuts) for e in side] for side in ends]
        want = {(i, j): 1 for i, g in enumerate(group[0]) for j, h in enumerate(group[1]) if g == h}
    else:
        want = {(i, j): min(ends[0][i], ends[1][j]) - max(starts[0][i], starts[1][j]) for i in range(len(ends[0])) for j in range(len(ends[1]))}
        want = {k: v for k, v in want.items() if v > 0}
    assert got == want


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_a int, chunk string")
    assert alignment.align(docs, *queries.alignment_paths()).collect() == []
