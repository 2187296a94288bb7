"""The corpus pipeline's stages on a small corpus, each against what its operator promises."""

import importlib

import pytest


def corpus_rows() -> list[tuple]:
    """Prose (1, 2), a copy (3), a near copy (4), junk (5), and more prose."""
    import random

    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    text = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(9, 18))).capitalize() + "." for _ in range(6))
    one, two = text(), text()
    near = one.split(" ")
    near[4] = "other"
    texts = [one, two, two, " ".join(near), "### $$$ &&& " * 60, None] + [text() for _ in range(40)]
    return [(i + 1, t, "en", "s", -1) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages(spark, pipeline, tmp_path):
    folder = tmp_path / "sf"
    table = spark.createDataFrame(corpus_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{folder}/documents.parquet")
    docs, counts = spark.read.parquet(f"{folder}/documents.parquet"), []
    for n, (_, stage) in enumerate(pipeline.STAGES):
        before = docs
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/stage-{n}")
        docs = spark.read.parquet(f"{folder}/stage-{n}")
        counts.append(docs.count())
        if n < len(pipeline.STAGES) - 1:
            assert docs.columns == list(pipeline.COLUMNS)
            assert docs.join(before, "doc_id", "left_anti").count() == 0
            assert n == 0 or docs.where("n_chars <> length(text)").count() == 0
    assert counts[0] < len(corpus_rows()) and counts[2] <= counts[1] <= counts[0]
    packed = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    kept = spark.read.parquet(f"{folder}/stage-3")
    assert packed == {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {1, 2} <= packed and 5 not in packed and 3 not in packed  # prose stays; junk and the copy go
    assert pipeline.run(spark, str(folder)).count() == docs.count()


def test_documents_without_an_id_stay(spark, pipeline, tmp_path):
    good = [r[1] for r in corpus_rows()[6:9]]
    table = spark.createDataFrame(corpus_rows() + [(None, t, "en", "s", -1) for t in good], "doc_id long, text string, lang string, source string, n_chars long")
    for n, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, table, "").write.parquet(f"{tmp_path}/null-{n}")
        table = spark.read.parquet(f"{tmp_path}/null-{n}")
        assert sorted(r["text"] for r in table.where("doc_id is null").collect()) == sorted(good)


def test_lines_of_few_words_are_compared(spark, pipeline):
    short, few = "all rights reserved", "la li lu " * 300
    texts = [f"{short}\n{few}\nsome text", f"other text\n{short}\n\n{few}", "text other", "one\ntwo\none", "reserved rights all", short + " here"]
    table = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in pipeline.new_lines(spark, table, "").collect()}
    assert got == {0: texts[0], 1: "other text\n", 3: "one\ntwo", 5: texts[5]}


def test_planted_passages_go(spark, pipeline):
    """Passages of 51 to 60 words in 40 of 80 documents: first places stay whole, later ones go, other texts are untouched."""
    import random

    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [some(51 + k % 10) for k in range(10)]
    texts, planted = [], {}
    for i in range(80):
        before, after = some(40), some(40)
        if i % 2:
            planted[i] = passages[i // 2 % 10]
            texts.append(f"{before} {planted[i]} {after}")
        else:
            texts.append(f"{before} {after}")
    table = spark.createDataFrame([(i, t, "en", "s", -1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = {r["doc_id"]: r["text"] for r in pipeline.new_passages(spark, table, "").collect()}
    assert len(got) == 80
    seen = set()
    for i, text in enumerate(texts):
        if i not in planted or planted[i] not in seen:
            assert got[i] == text
            seen.add(planted.get(i))
        else:
            removed = len(text) - len(got[i])
            assert len(planted[i]) <= removed <= len(planted[i]) + 6  # blanks and letters around may agree too
