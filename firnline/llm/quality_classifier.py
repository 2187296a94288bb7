"""Quality classifier from weak labels (operator 8).

Heuristic labellers vote good, bad or nothing on each document. Their votes overlap, so their accuracies can be
estimated without true labels: expectation-maximisation (Dawid and Skene's model, with independent labellers given the
class) over the counts of vote patterns. There are at most 3**len(LABELLERS) patterns whatever the corpus, so the
counts, taken over all documents, fit the driver. Each pattern's posterior is the label of its documents.

The posteriors of a sample of at most ``TRAIN_ROWS`` documents (the documented bound; those with the smallest hash of
the id) train a logistic scorer on hashed word, word-shape and profile features. It scores every whole text.

Defined cases: a null or empty text has no votes beyond its length's and a score like any other; repeated rows are each
scored; an empty table, or one whose votes agree throughout, keeps what the posterior says; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import SLICE_ROWS, map_rows
from firnline.llm.text_stats import FIELDS, stats

TRAIN_ROWS = 6000
DIMS = 1 << 15
EPOCHS = 120
LEARNING_RATE = 0.6
L2 = 1e-5
KEEP_FROM = 0.5
ROUNDS = 60
PRIOR_GOOD = 0.8
#: Beliefs about an unknown labeller, P(nothing, bad, good | class), and their weight in documents per document.
#: Most kinds of junk trip one or two labellers, so silence is common on both classes and a wrong vote rare.
BELIEF = ((0.70, 0.25, 0.05), (0.60, 0.01, 0.39))
BELIEF_WEIGHT = 0.1
MEMO_ENTRIES = 100_000
#: Longer words are not remembered.
MEMO_BYTES = 64

#: Labeller: (bad if, good if), over the counts of text_stats (fixed values). A labeller that knows one kind of junk
#: only says nothing of other texts; the last two know ordinary prose.
LABELLERS = {
    "symbols": ("n_symbols > 0.10 * n_words", "False"),
    "repeats": ("n_repeat_words > 0.40 * n_words", "False"),
    "lines": ("n_dup_lines > 0.50 * n_lines", "False"),
    "capitals": ("n_letters > 0 and n_upper > 0.50 * n_letters", "False"),
    "variety": ("n_words >= 20 and n_distinct_words < 0.35 * n_words", "False"),
    "word_length": ("word_chars > 12 * n_words", "False"),
    "sentences": ("n_words >= 30 and (n_sentence_ends == 0 or n_sentence_ends > 0.7 * n_words)", "0.02 * n_words <= n_sentence_ends <= 0.5 * n_words and n_symbols <= 0.02 * n_words"),
    "prose": ("n_words == 0", "n_words > 0 and n_distinct_words >= 0.45 * n_words and n_upper <= 0.2 * n_letters and n_symbols <= 0.02 * n_words"),
}
_BASE3 = [3**i for i in range(len(LABELLERS))]


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: (posterior of good per pattern, accuracy table [labeller, class, vote], share of good)."""
    votes = np.stack([patterns // w % 3 for w in _BASE3], axis=1) if len(patterns) else np.zeros((0, len(_BASE3)), int)
    good_votes, bad_votes = (votes == 2).sum(1), (votes == 1).sum(1)
    posterior = np.where(bad_votes >= 1, 0.15, np.where(good_votes >= 1, 0.95, 0.5)) if len(votes) else np.zeros(0)
    share, table = PRIOR_GOOD, np.full((votes.shape[1], 2, 3), 1 / 3)
    for _ in range(ROUNDS):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        for j in range(votes.shape[1]):
            for c in range(2):
                table[j, c] = np.bincount(votes[:, j], weight[c], 3) + (1 + BELIEF_WEIGHT * weight[c].sum()) * np.array(BELIEF[c])
                table[j, c] /= table[j, c].sum()
        share = (weight[1].sum() + 4 * PRIOR_GOOD) / (weight.sum() + 4)
        log_odds = np.full(len(votes), np.log(share / (1 - share)))
        for j in range(votes.shape[1]):
            voted = votes[:, j] > 0  # an abstention is no evidence
            log_odds[voted] += np.log(table[j, 1, votes[voted, j]] / table[j, 0, votes[voted, j]])
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return posterior, table, float(share)


_RUNS = [(re.compile("[^\\W\\d_A-Z]+"), "a"), (re.compile("[A-Z]+"), "A"), (re.compile(r"\d+"), "0")]


class _Buckets(dict):
    """Bytes of a word -> its two buckets, the word itself and the whole word's shape."""

    def __missing__(self, word: bytes):
        shape = word.decode("utf-8", "replace")
        for pattern, mark in _RUNS:
            shape = pattern.sub(mark, shape)
        value = (zlib.crc32(b"w" + word) % DIMS, zlib.crc32(b"s" + shape.encode("utf-8", "replace")) % DIMS)
        if len(word) <= MEMO_BYTES:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = value
        return value


_BUCKETS = _Buckets()


def features(text: str | None, counts: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of one whole text: shares of words and shapes, and the tenths its counts fall in."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    c = dict(zip(FIELDS, counts))
    n = max(1, c["n_words"])
    profile = [
        ("rep", c["n_repeat_words"] / n),
        ("var", c["n_distinct_words"] / n),
        ("sym", min(c["n_symbols"] / n, 1.0)),
        ("cap", c["n_upper"] / max(1, c["n_letters"])),
        ("dup", c["n_dup_lines"] / max(1, c["n_lines"])),
        ("end", min(c["n_sentence_ends"] / n, 1.0)),
    ]
    extra = np.array([zlib.crc32(f"p{name}{int(value * 10)}".encode()) % DIMS for name, value in profile])
    if not words:
        return extra, np.full(len(extra), 0.3)
    pairs = np.array([_BUCKETS[w] for w in words], np.int64)
    ids, times = np.unique(pairs.ravel(), return_counts=True)
    return np.concatenate([ids, extra]), np.concatenate([times / len(words), np.full(len(extra), 0.3)])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Logistic regression by full-batch Adagrad on posterior labels; the last weight is the intercept."""
    weights = np.zeros(DIMS + 1)
    if not rows:
        return weights
    ids, values = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    balance = np.where(target >= 0.5, 0.5 / max(1, (target >= 0.5).sum()), 0.5 / max(1, (target < 0.5).sum()))
    seen = np.full(DIMS + 1, 1e-8)
    for _ in range(EPOCHS):
        margin = np.bincount(owner, weights[ids] * values, len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) * balance
        gradient = np.append(np.bincount(ids, error[owner] * values, DIMS), error.sum()) + L2 * weights
        seen += gradient**2
        weights -= LEARNING_RATE * gradient / np.sqrt(seen)
    return weights


def _fitted(docs: DataFrame, id_col: str, text_col: str, train_rows: int) -> tuple[np.ndarray, dict[int, float]]:
    """The scorer's weights (bounded by DIMS) and the posterior of each vote pattern."""
    kind = dict(docs.dtypes)[id_col]
    slim = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))

    def vote(columns):
        return {"pattern": [_votes(stats(t))[1] for t in columns["_text"].to_pylist()]}

    # at most 3**len(LABELLERS) rows, summed in each task before the shuffle
    tally = map_rows(slim, vote, "pattern long").groupBy("pattern").count().toPandas().sort_values("pattern")
    patterns, counts = tally["pattern"].to_numpy(np.int64), tally["count"].to_numpy(float)
    posterior, _, _ = estimate(patterns, counts)
    label = dict(zip(patterns.tolist(), posterior.tolist()))
    total = counts.sum()
    if not total:
        return np.zeros(DIMS + 1, np.float32), label
    share = min(1.0, 1.5 * train_rows / total + 200 / total)
    chosen = slim.where(F.pmod(F.xxhash64("_id", F.lit(8)), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("_id", F.lit(8)), F.col("_id")).limit(train_rows)

    def sample(columns):
        made = [features(t, c) + (c,) for t in columns["_text"].to_pylist() for c in [stats(t)]]
        return {"_id": columns["_id"], "ids": [m[0].tolist() for m in made], "vals": [m[1].tolist() for m in made], "counts": [list(m[2]) for m in made]}

    train = map_rows(chosen, sample, f"_id {kind}, ids array<int>, vals array<float>, counts array<long>").toPandas()
    targets = np.array([label[_votes(tuple(c))[1]] for c in train["counts"]])
    return fit([(np.asarray(i, np.int64), np.asarray(v, float)) for i, v in zip(train["ids"], train["vals"])], targets).astype(np.float32), label


def _score(text: str | None, weights: np.ndarray) -> tuple[float, tuple[int, ...]]:
    counts = stats(text)
    ids, values = features(text, counts)
    margin = float(weights[ids].astype(float) @ values + weights[-1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))), counts


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(id, n_votes, posterior, score, kept): the weak label and the scorer's verdict on each document."""
    weights, label = _fitted(docs, id_col, text_col, train_rows)

    def score(columns):
        out = []
        for text in columns["_text"].to_pylist():
            value, counts = _score(text, weights)
            votes, pattern = _votes(counts)
            out.append((votes, label.get(pattern, 0.5), value, value >= KEEP_FROM))
        return {id_col: columns["_id"]} | dict(zip(("n_votes", "posterior", "score", "kept"), map(list, zip(*out)) if out else [[]] * 4))

    slim = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return map_rows(slim, score, f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_votes int, posterior double, score double, kept boolean")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``classify`` keeps; nothing is shuffled for it."""
    weights, _ = _fitted(docs, id_col, text_col, train_rows)

    def good(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                yield part.filter(pa.array([_score(t, weights)[0] >= KEEP_FROM for t in texts], pa.bool_()))

    return docs.mapInArrow(good, docs.schema)


_COMPILED = [(compile(bad, name, "eval"), compile(good, name, "eval")) for name, (bad, good) in LABELLERS.items()]


def _votes(counts) -> tuple[int, int]:
    scope = dict(zip(FIELDS, counts))
    digits = [1 if eval(bad, {}, scope) else 2 if eval(good, {}, scope) else 0 for bad, good in _COMPILED]  # noqa: S307  fixed expressions above
    return sum(d > 0 for d in digits), sum(d * w for d, w in zip(digits, _BASE3))

