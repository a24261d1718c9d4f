"""Weak-label quality classifier.

Overlapping heuristic labellers vote on each document (good, bad, abstain). Expectation-maximisation over the counts of
vote patterns, of which there are at most 3^labellers whatever the corpus, estimates each labeller's accuracy
and the posterior of every pattern. The posteriors are the soft labels that a hashed linear scorer learns from, on a sample of
bounded size; the scorer then judges every document by its whole text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import lean, release, small_batches


#: The scorer is fitted on at most this many documents, chosen by a hash of their id.
SAMPLE_ROWS = 2000
TRIGRAMS = 2048
BINS = 512
#: Places that the number of votes for bad has among the features.
VOTE_PLACES = 6

BAD, ABSTAIN, GOOD = 0, 1, 2

_KIND = np.full(256, 5, np.uint8)  # bytes of other scripts and accents
_KIND[[*range(9, 14), 32]] = 0
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6


_WORDLESS = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")


def statistics(text: str) -> tuple[np.ndarray, list[float], np.ndarray]:
    """Bytes, statistics and byte kinds of a text: words, shares of symbols and capitals, words without a letter or digit, punctuation a
    word, adjacent repeats, distinct words, mean word length, repeated lines, letters and digits, and how far the text can be
    compressed. Ratios that short texts would throw off are drawn towards usual values."""
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    kinds = _KIND[data]
    count = np.bincount(kinds, minlength=7)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    letters = int(count[1] + count[2] + count[5])
    values = [
        float(len(words)),
        float(count[6]) / max(1, len(data)),
        float(count[2]) / (letters + 40),
        len(_WORDLESS.findall(text)) / (n + 5),
        (float(count[4]) + 1) / (n + 5),
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        (float(len(data) - count[0]) + 25) / (len(words) + 5),
        1 - len(set(lines)) / max(1, len(lines)),
        (letters + int(count[3]) + 4) / (len(data) - int(count[0]) + 5),
        (len(zlib.compress(data, 1)) + 100) / (len(data) + 200),
    ]
    return data, values, kinds


def votes(v: list[float]) -> list[int]:
    """The labellers' votes on a document's statistics."""
    words, symbols, capitals, wordless, marks, repeats, distinct, length, lines, letters, squeezed = v
    return [
        BAD if symbols > 0.05 else GOOD if symbols < 0.01 else ABSTAIN,
        BAD if capitals > 0.4 else GOOD if capitals < 0.1 else ABSTAIN,
        BAD if wordless > 0.2 else GOOD if wordless < 0.02 else ABSTAIN,
        BAD if marks > 0.8 else GOOD if marks < 0.4 else ABSTAIN,
        ABSTAIN if words < 10 else BAD if repeats > 0.2 else GOOD if repeats < 0.05 else ABSTAIN,
        ABSTAIN if words < 20 else BAD if distinct < 0.4 else GOOD if distinct > 0.48 else ABSTAIN,
        BAD if length > 14 or length < 2 else GOOD if 3 < length < 8 else ABSTAIN,
        BAD if lines > 0.6 else GOOD if lines < 0.1 else ABSTAIN,
        BAD if letters < 0.75 else GOOD if letters > 0.9 else ABSTAIN,
        BAD if squeezed < 0.2 else GOOD if squeezed > 0.35 else ABSTAIN,
    ]


LABELLERS = ("symbols", "capitals", "wordless", "marks", "repeats", "distinct", "length", "lines", "letters", "squeezed")


def pattern_of(v: list[int]) -> int:
    code = 0
    for x in v:
        code = code * 3 + x
    return code


def votes_of(code: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        code, x = divmod(code, 3)
        out.append(x)
    return out[::-1]


@dataclass
class LabelModel:
    """What EM has found: prior of good, and for each labeller the chances of its votes on bad and on good documents."""

    prior: float
    chances: np.ndarray  # labeller, class (bad, good), vote; abstaining says nothing

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of good for each row of votes."""
        log = np.log(np.array([1 - self.prior, self.prior]))[None, :].repeat(len(votes), 0)
        for j in range(votes.shape[1]):
            cast = votes[:, j] != ABSTAIN
            log[cast] += np.log(self.chances[j][:, votes[cast, j]]).T
        log -= log.max(axis=1, keepdims=True)
        p = np.exp(log)
        return p[:, 1] / p.sum(axis=1)

    def accuracies(self) -> dict[str, float]:
        """Chance that a labeller is right where it votes."""
        c, w = self.chances, np.array([1 - self.prior, self.prior])
        right = w[0] * c[:, 0, BAD] + w[1] * c[:, 1, GOOD]
        cast = right + w[0] * c[:, 0, GOOD] + w[1] * c[:, 1, BAD]
        return dict(zip(LABELLERS, (right / cast).tolist(), strict=True))


def fit_labels(votes: np.ndarray, counts: np.ndarray, rounds: int = 100, prior_strength: float = 1.0) -> LabelModel:
    """EM from the share of good among the votes cast; every vote keeps a pseudo-count so no chance is zero."""
    good, bad = (votes == GOOD).sum(axis=1), (votes == BAD).sum(axis=1)
    p = np.where(bad > 0, 0.1, np.where(good > 0, 0.95, 0.5))
    model = LabelModel(0.5, np.full((votes.shape[1], 2, 3), 0.5))
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        total = weight.sum(axis=1)
        chances = np.empty((votes.shape[1], 2, 3))
        for j in range(votes.shape[1]):
            for vote in (BAD, GOOD):
                chances[j, :, vote] = weight[:, votes[:, j] == vote].sum(axis=1) + prior_strength
            chances[j, :, ABSTAIN] = 0.0
        chances /= chances.sum(axis=2, keepdims=True)
        model = LabelModel(float((total[1] + 1) / (total.sum() + 2)), chances)
        new = model.posterior(votes)
        if not len(p) or np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


_EDGES = [
    [4, 16, 64, 256, 1024, 4096], [0.005, 0.02, 0.05, 0.1, 0.2, 0.4], [0.02, 0.05, 0.1, 0.2, 0.4, 0.7], [0.005, 0.02, 0.05, 0.1, 0.3], [0.2, 0.3, 0.4, 0.6, 0.8, 1.2],
    [0.01, 0.03, 0.1, 0.2, 0.5, 0.8], [0.05, 0.1, 0.2, 0.3, 0.4, 0.45, 0.5, 0.6, 0.8], [2, 3, 4, 5, 6, 7, 9, 14], [0.05, 0.1, 0.3, 0.5, 0.7], [0.5, 0.7, 0.8, 0.9, 0.95], [0.1, 0.2, 0.3, 0.35, 0.4, 0.6],
]


def bins(values: list[float]) -> list[int]:
    """Hashed places of the statistics' bins, and, some times over, of the number of votes for bad.

    Bins that the sample lacks say nothing; the number of votes is what lets the scorer tell junk of a kind that it hasn't seen.
    """
    bad = min(3, votes(values).count(BAD))
    spots = [*((i, int(np.searchsorted(e, x))) for i, (e, x) in enumerate(zip(_EDGES, values, strict=True))), *((len(_EDGES) + k, bad) for k in range(VOTE_PLACES))]
    return [TRIGRAMS + (i * 0x9E37 + at * 0x85EB) % BINS for i, at in spots]


def trigrams(data: np.ndarray) -> np.ndarray:
    """Hashed places of a text's byte trigrams."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    x = data.astype(np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return (h >> np.uint32(21)).astype(np.int64)


def features(text: str) -> np.ndarray:
    data, values, _ = statistics(text)
    out = np.zeros(TRIGRAMS + BINS, np.float32)
    t = trigrams(data)
    if len(t):
        out[:TRIGRAMS] = np.bincount(t, minlength=TRIGRAMS) * (4.0 / len(t))
    np.add.at(out, bins(values), 1.0)
    return out


def score(text: str, weights: np.ndarray, bias: float) -> float:
    """Log odds of good, without building the feature vector."""
    data, values, _ = statistics(text)
    t = trigrams(data)
    total = bias + float(weights[bins(values)].sum())
    return total + (float(weights[t].sum()) * 4.0 / len(t) if len(t) else 0.0)


def fit_scorer(x: np.ndarray, p: np.ndarray, rounds: int = 400, rate: float = 0.5, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch gradient steps with momentum; deterministic."""
    w, b = np.zeros(x.shape[1]), 0.0
    vw, vb = np.zeros_like(w), 0.0
    x = x.astype(np.float32, copy=False)
    for _ in range(rounds if len(x) else 0):
        z = np.clip(x @ w.astype(np.float32) + b, -30, 30)
        g = (1 / (1 + np.exp(-z)) - p) / len(x)
        vw = 0.9 * vw - rate * (x.T @ g.astype(np.float32) + ridge * w)
        vb = 0.9 * vb - rate * float(g.sum())
        w, b = w + vw, b + vb
    return w, b


@dataclass
class Classifier:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    sample: int


def _slim(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Labels from all documents, the scorer from at most sample_rows of them."""

    def vote(batches):
        for b in batches:
            codes = [pattern_of(votes(statistics(t)[1])) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32())], names=["pattern"])

    slim = _slim(docs).filter(F.col("text") != "")
    counted = slim.select("text").mapInArrow(lean(vote), "pattern int").groupBy("pattern").count().collect()  # at most 3^10 rows
    patterns = sorted((r["pattern"], r["count"]) for r in counted)
    table = np.array([votes_of(c) for c, _ in patterns], dtype=np.int64).reshape(-1, len(LABELLERS))
    labels = fit_labels(table, np.array([n for _, n in patterns], dtype=np.float64))

    n = sum(c for _, c in patterns)
    draw = F.pmod(F.xxhash64(F.lit(7).cast("long"), F.col("doc_id")), F.lit(1 << 30))
    share = min(1.0, 1.2 * sample_rows / max(1, n))
    chosen = slim.withColumn("draw", draw).filter(F.col("draw") <= int(share * (1 << 30)))

    def extract(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            rows = [features(t).tobytes() for t in texts]
            codes = [pattern_of(votes(statistics(t)[1])) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(codes, pa.int32()), pa.array(rows, pa.binary())], names=["doc_id", "draw", "pattern", "x"])

    rows = chosen.mapInArrow(lean(extract), "doc_id long, draw long, pattern int, x binary").orderBy("draw", "doc_id", "x").limit(sample_rows).collect()
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(-1, TRIGRAMS + BINS)
    p = labels.posterior(np.array([votes_of(r["pattern"]) for r in rows], dtype=np.int64).reshape(-1, len(LABELLERS)))
    n = len(rows)
    del rows
    weights, bias = fit_scorer(x, p)
    del x
    release()
    return Classifier(labels, weights, bias, n)


def judge(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, posterior (of the labellers' votes), score (the scorer's chance of good), keep (score of 0.5 or more).

    Null and empty texts, and texts of white space alone, have score 0 and aren't kept. Repeated rows get equal results.
    """
    w, b, labels = model.weights, model.bias, model.labels

    def run(batches):
        known: dict[int, float] = {}
        for batch in batches:
            post, chance = [], []
            for t in batch.column(1).to_pylist():
                if not t or t.isspace():
                    post.append(0.0)
                    chance.append(0.0)
                    continue
                data, values, _ = statistics(t)
                code = pattern_of(votes(values))
                if code not in known:
                    known[code] = float(labels.posterior(np.array([votes_of(code)]))[0])
                g = trigrams(data)
                z = b + float(w[bins(values)].sum()) + (float(w[g].sum()) * 4.0 / len(g) if len(g) else 0.0)
                post.append(known[code])
                chance.append(float(1 / (1 + np.exp(-np.clip(z, -60, 60)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(post, pa.float64()), pa.array(chance, pa.float64())], names=["doc_id", "posterior", "score"])

    scored = _slim(docs).mapInArrow(lean(run), "doc_id long, posterior double, score double")
    return scored.withColumn("keep", F.col("score") >= 0.5)


def keep_good(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """The documents that the classifier keeps, with the columns of docs, in one pass beside the text.

    Null and empty texts, and texts of white space alone, go; null doc_ids, repeated rows and further columns of any name stay as
    they are with their text; very long texts are judged whole; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    model = model or fit(docs)
    w, b = model.weights, model.bias
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            good = [bool(t) and not t.isspace() and score(t, w, b) >= 0.0 for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, posterior, score, keep of every document, by a classifier fitted on the same table.

    Nulls, empty and very long texts and repeated rows as in judge; null doc_ids keep their row; an empty table gives an empty
    result; further columns of any name play no part.
    """
    return judge(docs, fit(docs))
