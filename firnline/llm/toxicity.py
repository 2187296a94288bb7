"""Toxicity by nearest labelled examples (operator 4).

Labelled documents are the examples: at most REFERENCE_ROWS of either class, those with the smallest hash of the id
(the documented bound on what is learned from). Texts are TF-IDF vectors over all terms of the examples: words, and the
first five bytes of words, which also meet unseen endings, by their 64-bit hashes; document frequencies are counted over all documents. A
term's weight is its IDF times (lift - EVEN) ** POWER, where the lift is the logarithm of how much likelier the term is
in toxic examples, smoothed by PSEUDO examples; terms that are hardly likelier there weigh nothing, and no term is left
out for being rare or for its rank. The K nearest examples by exact cosine come from an inverted index in blocks of
BLOCK examples with each term's largest weight per block: blocks are taken by their upper bound until none left can
reach the K-th best; equal cosines go to the example with the smaller id. Votes are weighted by squared cosine and by
how many labelled documents an example stands for, and shrunk towards the share of toxic documents. A logistic curve
fitted to each example's vote without itself makes them probabilities; the nearest examples are given as evidence.

Labels, language, source and id are no inputs of a score. Defined cases: a null or empty text, or one without any term,
gets the curve of the share of toxic documents; documents without a label row are scored like any other;
null labels are none; repeated rows are each scored; without labels every score is PRIOR; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sized
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import map_rows
from firnline.llm.repeats import _bounded
from firnline.llm.wordhash import _CODE, join_texts, mix, span_hash, to_bytes, window_sums

REFERENCE_ROWS = 3000
K = 15
BLOCK = 64
#: Blocks that are scored first; then twice as many each time.
FIRST_BLOCKS = 8
SHRINK = 0.5
PRIOR = 0.1
EVEN, POWER, PSEUDO = 0.2, 3, 2.0
EVIDENCE = 5
#: Bytes of a word that make a term of their own.
START = 5
#: Letters of a word: a to z after lower-casing, and all bytes of other scripts' characters.
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = True
_IS_LETTER[128:] = True
_OF_START = np.uint64(0x51ED270B0B6F8C1D)


def term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, term) of each word and of each word's first START bytes; a term is a 64-bit hash."""
    data, offsets = join_texts([to_bytes((t or "").lower()) for t in texts])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _IS_LETTER[data], [False]]).view(np.int8)))
    start, end = edge[::2].astype(np.int64), edge[1::2].astype(np.int64)
    sums = window_sums(_CODE[data])
    owner = np.searchsorted(offsets, start, "right") - 1
    whole, first = span_hash(sums, start, end), span_hash(sums, start, np.minimum(end, start + START))
    return np.concatenate([owner, owner]), np.concatenate([whole, mix(first ^ _OF_START)])


def count_terms(texts: list[str | None], terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the numbers of its ``terms`` (ascending hashes), in order, and how often each stands in it."""
    out = []
    for a, b in _bounded(texts):
        owner, term = term_hashes(texts[a:b])
        at = np.minimum(np.searchsorted(terms, term), max(0, len(terms) - 1))
        known = terms[at] == term if len(terms) else np.zeros(len(term), bool)
        key, times = np.unique(owner[known] * np.int64(len(terms) + 1) + at[known], return_counts=True)
        edges = np.searchsorted(key, np.arange(b - a + 1) * np.int64(len(terms) + 1))
        ids = key % (len(terms) + 1)
        out += [(ids[i:j], times[i:j]) for i, j in zip(edges, edges[1:])]
    return out


@dataclass
class Index:
    """Examples in blocks. Postings (example, value) lie by term and example; an entry is a term's postings in one block."""

    terms: Sized  # ascending hashes
    idf: np.ndarray  # the terms' weights
    example_ids: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    prior: float
    curve: tuple[float, float] = (1.0, 0.0)
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    entry_first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # an entry's first posting
    entry_block: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    entry_max: np.ndarray = field(default_factory=lambda: np.zeros(0))
    term_first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # a term's first entry

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(sorted(counts), np.int64)
        return self.weighed(ids, np.array([counts[i] for i in ids.tolist()], np.int64))

    def weighed(self, ids: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(ids):
            return ids, np.zeros(0)
        weight = (1 + np.log(times)) * self.idf[ids]
        return ids, weight / np.sqrt((weight**2).sum())

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int = K, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example) of the k best with a positive cosine, by falling cosine, then by example."""
        entries, of_term = _ranges(self.term_first[ids], self.term_first[ids + 1])
        block, weight = self.entry_block[entries], weights[of_term]
        bound = np.bincount(block, weight * self.entry_max[entries], -(-len(self.toxic) // BLOCK) + 1)
        order = np.argsort(-bound, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        best: list[tuple[float, int]] = []
        done, upto = 0, FIRST_BLOCKS
        while done < len(order) and bound[order[done]] > 0 and not (len(best) == k and bound[order[done]] < best[-1][0] - 1e-11):
            here = np.flatnonzero((place[block] >= done) & (place[block] < upto))
            postings, of_entry = _ranges(self.entry_first[entries[here]], self.entry_first[entries[here] + 1])
            score = np.bincount(self.example[postings], weight[here][of_entry] * self.value[postings], len(self.toxic))
            if without >= 0:
                score[without] = 0
            hit = np.flatnonzero(score > 0)
            if len(hit) > 4 * k:  # ties with the k-th stay
                hit = hit[score[hit] >= np.partition(score[hit], len(hit) - k)[-k] - 1e-11]
            best = sorted(best + [(round(s, 12), e) for s, e in zip(score[hit].tolist(), hit.tolist())], key=lambda x: (-x[0], x[1]))[:k]
            done, upto = upto, 2 * upto
        return best

    def votes(self, near: list[tuple[float, int]]) -> float:
        mass = sum(c * c * self.stands_for[e] for c, e in near)
        toxic = sum(c * c * self.stands_for[e] for c, e in near if self.toxic[e])
        shrink = SHRINK * float(self.stands_for.min(initial=1.0))
        return (toxic + shrink * self.prior) / (mass + shrink)

    def score(self, ids: np.ndarray, times: np.ndarray) -> tuple[float, list[tuple[float, int]]]:
        if not len(self.toxic):
            return PRIOR, []
        near = self.nearest(*self.weighed(ids, times)) if len(ids) else []
        return _curved(self.votes(near), self.curve), near


def _ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each first to below its end, and which range each belongs to."""
    count = end - first
    owner = np.repeat(np.arange(len(count)), count)
    return np.arange(len(owner)) + (first - np.cumsum(count) + count)[owner], owner


def _logit(vote):
    vote = np.clip(vote, 1e-4, 1 - 1e-4)
    return np.log(vote / (1 - vote))


def _curved(vote: float, curve: tuple[float, float]) -> float:
    return float(1 / (1 + math.exp(-(curve[0] * float(_logit(vote)) + curve[1]))))


def fitted_curve(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from votes to labels, by Newton steps; a slight prior holds it near (1, 0)."""
    x = np.stack([_logit(votes), np.ones(len(votes))], axis=1)
    at, held = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    weight = weight / max(weight.sum(), 1e-9) * len(weight)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + (at - held)
        at = at - np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.eye(2), gradient)
    return (float(at[0]), float(at[1])) if at[0] > 0 and np.isfinite(at).all() else (1.0, 0.0)


def build_index(examples: list[tuple[int, bool, dict[int, int]]], terms: Sized, idf: np.ndarray, population: tuple[int, int]) -> Index:
    """``population``: labelled documents by class (clean, toxic) that the examples were drawn from."""
    examples = sorted(examples, key=lambda e: e[0])
    toxic = np.array([e[1] for e in examples], bool)
    drawn = (int((~toxic).sum()), int(toxic.sum()))
    stands_for = np.where(toxic, population[1] / max(1, drawn[1]), population[0] / max(1, drawn[0])) if len(examples) else np.zeros(0)
    prior = (population[1] + PRIOR) / (sum(population) + 1)
    index = Index(terms, idf, np.array([e[0] for e in examples], np.int64), toxic, stands_for, prior)
    vectors = [index.vector(e[2]) for e in examples]
    term = np.concatenate([v[0] for v in vectors] or [np.zeros(0, np.int64)])
    value = np.concatenate([v[1] for v in vectors] or [np.zeros(0)])
    example = np.repeat(np.arange(len(examples)), [len(v[0]) for v in vectors])
    order = np.argsort(term, kind="stable")
    term, index.value, index.example = term[order], value[order], example[order].astype(np.int32)
    block = index.example // BLOCK
    first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.zeros(0, np.int64)
    index.entry_first, index.entry_block = np.append(first, len(term)), block[first]
    index.entry_max = np.maximum.reduceat(index.value, first) if len(first) else np.zeros(0)
    index.term_first = np.searchsorted(term[first], np.arange(len(terms) + 1))
    if toxic.any() and not toxic.all():
        votes = np.array([index.votes(index.nearest(*v, without=n) if len(v[0]) else []) for n, v in enumerate(vectors)])
        index.curve = fitted_curve(votes, toxic.astype(float), stands_for)
    return index


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", reference_rows: int = REFERENCE_ROWS) -> Index:
    """The index; labels of rows that are held out are never read."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).where(F.col("_label").isNotNull() & F.col("_id").isNotNull()).where(~held_out("_id")).groupBy("_id").agg(F.max("_label").alias("_label"))
    counts = {int(bool(r["_label"])): r["count"] for r in usable.groupBy("_label").count().collect()}
    draw = lambda value: usable.where(F.col("_label") == value).orderBy(F.xxhash64("_id", F.lit(4)), "_id").limit(reference_rows)
    chosen = draw(0).union(draw(1))  # at most twice reference_rows rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "text", F.col("_label").cast("int").alias("label"))

    def spread(columns):
        found = [np.unique(term_hashes([text])[1]).view(np.int64) for text in columns["text"].to_pylist()]
        return {"term": np.concatenate([np.zeros(0, np.int64), *found]), "label": np.repeat(np.array(columns["label"].to_pylist(), np.int32), [len(f) for f in found])}

    per_term = map_rows(texts.select("text", "label"), spread, "term long, label int").groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    n1, n0 = (min(reference_rows, counts.get(y, 0)) for y in (1, 0))
    share = n1 / max(1, n0 + n1)
    lift = F.log(((F.col("a") + PSEUDO * share) / max(1, n1)) / ((F.col("b") + PSEUDO * (1 - share)) / max(1, n0))) - EVEN
    found = per_term.withColumn("weight", F.pow(F.greatest(lift, F.lit(0.0)), F.lit(float(POWER)))).where("weight > 0").toPandas()  # of at most twice reference_rows texts
    terms = found["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(terms)
    terms, weight = terms[order], found["weight"].to_numpy(float)[order]

    def examples_of(columns):
        made = count_terms(columns["text"].to_pylist(), terms)
        return {"id": columns["id"], "label": columns["label"], "terms": [ids.tolist() for ids, _ in made], "times": [times.tolist() for _, times in made]}

    examples = [(r["id"], bool(r["label"]), dict(zip(r["terms"], r["times"]))) for r in map_rows(texts, examples_of, "id long, label int, terms array<int>, times array<int>").collect()]

    def frequencies(columns):
        texts = columns["text"].to_pylist()
        total = np.bincount(np.concatenate([np.zeros(0, np.int64), *(ids for ids, _ in count_terms(texts, terms))]), minlength=len(terms))
        at = np.flatnonzero(total)
        return {"term": np.append(at, -1), "docs": np.append(total[at], len(texts))}

    tally = {r["term"]: r["docs"] for r in map_rows(docs.select(F.col(text_col).alias("text")), frequencies, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect()}
    everything = tally.get(-1, 0)
    idf = np.array([math.log((1 + everything) / (1 + tally.get(i, 0))) + 1 for i in range(len(terms))]) * weight
    return build_index(examples, terms, idf, (counts.get(0, 0), counts.get(1, 0)))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, score, evidence array of (doc_id, similarity, toxic))."""
    index = learn(docs, labels, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(index)  # as large as the texts of twice REFERENCE_ROWS documents
    kind = dict(docs.dtypes)[id_col]

    def score(columns):
        index = shared.value
        scores, evidence, known = [], [], {}
        for ids, times in count_terms(columns["text"].to_pylist(), index.terms):
            key = ids.tobytes(), times.tobytes()
            if key not in known:
                known[key] = index.score(ids, times)
            value, near = known[key]
            scores.append(float(min(1.0, max(0.0, value))))
            evidence.append([{"doc_id": int(index.example_ids[e]), "similarity": float(c), "toxic": bool(index.toxic[e])} for c, e in near[:EVIDENCE]])
        return {id_col: columns["id"], "score": scores, "evidence": evidence}

    return map_rows(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), score, f"`{id_col}` {kind}, score double, evidence array<struct<doc_id:long,similarity:double,toxic:boolean>>")
