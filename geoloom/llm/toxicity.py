"""Toxicity by cumulative-link ordinal regression over sparse word features.

Grades are ordered: 0 clean, 1 mild, 2 marked, 3 severe. The model is ``P(grade <= k) = logistic(theta_k - w x)``
with one weight per feature, never negative, for all thresholds. Features are words and word beginnings of
four to eight letters; the value of a feature is the root of its occurrences per hundred words.

Training uses a bounded sample of labelled documents (``SAMPLE_ROWS``); features are chosen by how much
more often toxic documents of the sample hold them. Labels that only tell toxic from clean are graded by
the share of words with such features (``GRADE_CUTS``). Every document is scored over its whole text.

Defined results for odd rows: a NULL or blank text has no features and the score of one; labels that are
NULL or belong to no document are left out, several labels of one id count as their highest; without toxic
labels every document is clean; repeated rows get a row each; an empty table gives no rows; columns other
than id and text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise

#: Labelled documents used for training, about; candidate and final features; most and fewest toxic documents a feature must be in; its least lift.
SAMPLE_ROWS, CANDIDATES, FEATURES, LEAST_DOCS, FEWEST_DOCS, LEAST_LIFT = 20_000, 50_000, 4_000, 8, 3, 8.0
#: A document is toxic from the probability of a grade above 0 that has the best F1 on the sample, within these bounds.
TOXIC_FROM = (0.1, 0.5)
#: Share of words with toxic features from which a toxic document has grade 2 and grade 3.
GRADE_CUTS = (0.02, 0.05)
PREFIXES = (4, 5, 6, 7, 8)
MARKS = ".,!?;:\"'()[]{}<>*#-_…¡¿«»"
REMEMBERED_WORDS = 150_000


def word_features(word: str) -> tuple[str, ...]:
    """A word (lower case, without marks at its ends) and its beginnings."""
    return (word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)) if word else ()


def words_of(text: str | None) -> list[str]:
    return [w for w in (x.strip(MARKS) for x in (text or "").lower().split()) if w]


@dataclass
class OrdinalModel:
    """Fitted weights; ``thresholds`` has one value less than there are grades."""

    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    toxic_from: float = TOXIC_FROM[1]
    _known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}

    def hits(self, text: str | None) -> tuple[dict[int, int], int, int]:
        """Occurrences per feature, words with a feature, and words."""
        known, counts, hit = self._known, Counter(), 0
        words = (text or "").lower().split()
        for w in words:
            ids = known.get(w)
            if ids is None:
                if len(known) >= REMEMBERED_WORDS:
                    known.clear()
                ids = known[w] = tuple(self.features[f] for f in word_features(w.strip(MARKS)) if f in self.features)
            if ids:
                hit += 1
                counts.update(ids)
        return counts, hit, len(words)

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """One column per grade."""
        below = _logistic(self.thresholds[None, :] - scores[:, None])
        edges = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        return np.diff(edges, axis=1)

    def score(self, text: str | None) -> float:
        counts, _, n = self.hits(text)
        return float(sum(self.weights[f] * feature_value(c, n) for f, c in counts.items()))


def feature_value(count: float, words: int) -> float:
    return np.sqrt(100.0 * count / max(words, 1))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
                n_grades: int = 4, penalty: float = 0.3, positive: bool = False, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the penalised likelihood, by full-batch Adam; thresholds stay in order as sums of exponentials."""
    n = len(grades)
    w = np.zeros(n_features)
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(n, 1), 1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    moments = [np.zeros(n_features + len(free)) for _ in range(2)]
    for step in range(1, steps + 1):
        gaps = np.exp(np.clip(free[1:], -20, 20))
        theta = np.concatenate([free[:1], free[0] + np.cumsum(gaps)])
        s = np.bincount(rows, values * w[columns], minlength=n)
        edges = np.concatenate([[-1e9], theta, [1e9]])
        low, high = _logistic(edges[grades] - s), _logistic(edges[grades + 1] - s)
        p = np.maximum(high - low, 1e-12)
        d_s = low + high - 1.0
        d_edge = np.bincount(grades + 1, high * (1 - high) / p, minlength=n_grades + 1) - np.bincount(grades, low * (1 - low) / p, minlength=n_grades + 1)
        d_theta = d_edge[1:-1]
        d_free = np.concatenate([[d_theta.sum()], gaps * np.cumsum(d_theta[::-1])[::-1][1:]])
        d_w = np.bincount(columns, values * d_s[rows], minlength=n_features) - penalty * w
        g = np.concatenate([d_w, d_free])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.999 * moments[1] + 0.001 * g * g
        move = rate * (moments[0] / (1 - 0.9 ** step)) / (np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-9)
        w = np.maximum(w + move[:n_features], 0.0) if positive else w + move[:n_features]
        free += move[n_features:]
    gaps = np.exp(np.clip(free[1:], -20, 20))
    return w, np.concatenate([free[:1], free[0] + np.cumsum(gaps)])


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """Written table ``text, toxic``: about ``most`` labelled documents, drawn by a hash of the id."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    share = min(1.0, most / max(total, 1))
    drawn = known.filter(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # At most about SAMPLE_ROWS ids: a bounded table whatever the number of labels.
    found = materialise(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "toxic"))
    rows = found.count()
    if rows > 2 * most:  # ids with very many rows
        found = materialise(found.filter(F.rand(13) < most / rows))
    return found


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> OrdinalModel:
    """Model from a bounded sample of ``labels`` (``doc_id, toxic``) and the texts of ``docs``."""
    sample = labelled_sample(docs, labels, most)

    def documents_with(wanted: frozenset[str] | None):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for b in batches:
                for text in b.column(0).to_pylist():
                    held = {f for w in set(words_of(text)) for f in word_features(w)}
                    counts.update(held if wanted is None else held & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"])
        return each

    def counted(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
        return rows.select("text").mapInArrow(documents_with(wanted), "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))

    sizes = {bool(r["toxic"]): r["n"] for r in sample.groupBy(F.col("toxic") > 0).agg(F.count(F.lit(1)).alias("n")).toDF("toxic", "n").collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    toxic, clean = sample.filter("toxic > 0"), sample.filter("toxic <= 0")
    least = max(FEWEST_DOCS, min(LEAST_DOCS, n_toxic // 50))
    in_toxic = {r[0]: r[1] for r in counted(toxic, None).filter(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect()}
    in_clean = {r[0]: r[1] for r in counted(clean, frozenset(in_toxic)).collect()}
    lift = {f: (n / max(n_toxic, 1)) / ((in_clean.get(f, 0) + 1) / (n_clean + 1)) for f, n in in_toxic.items()}
    best = sorted((f for f in lift if lift[f] >= LEAST_LIFT), key=lambda f: (-in_toxic[f] * np.log(lift[f]), f))[:FEATURES]
    if not best:
        return OrdinalModel({}, np.zeros(0), np.array([10.0, 20.0, 30.0]))
    chosen = OrdinalModel({f: i for i, f in enumerate(best)}, np.zeros(len(best)), np.zeros(3))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [chosen.hits(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(c) for c, _, _ in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c, _, _ in found], pa.list_(pa.int32())),
                 pa.array([h for _, h, _ in found], pa.int64()), pa.array([n for _, _, n in found], pa.int64()), b.column(1)],
                names=["ids", "counts", "hit", "words", "toxic"])

    got = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        sparse, "ids array<int>, counts array<int>, hit bigint, words bigint, toxic int").collect()  # bounded by the sample
    rows = np.repeat(np.arange(len(got)), [len(r["ids"]) for r in got])
    columns = np.array([f for r in got for f in r["ids"]], np.int64)
    values = np.array([feature_value(c, r["words"]) for r in got for c in r["counts"]])
    dense = np.array([r["hit"] / max(r["words"], 1) for r in got])
    grades = np.where([r["toxic"] > 0 for r in got], 1 + (dense >= GRADE_CUTS[0]) + (dense >= GRADE_CUTS[1]), 0)
    weights, thresholds = fit_ordinal(rows, columns, values, grades, len(best), positive=True)
    model = OrdinalModel(chosen.features, weights, thresholds)
    above = 1.0 - model.probabilities(np.bincount(rows, values * weights[columns], minlength=len(got)))[:, 0]
    model.toxic_from = best_cut(above, grades > 0)
    return model


def best_cut(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The cut of best F1 within ``TOXIC_FROM``: halfway between the last score above it and the first below."""
    order = np.argsort(-scores, kind="stable")
    hit = np.cumsum(toxic[order])
    f1 = 2 * hit / (np.arange(1, len(scores) + 1) + toxic.sum())
    at = int(f1.argmax())
    below = scores[order][at + 1] if at + 1 < len(scores) else 0.0
    return float(np.clip((scores[order][at] + below) / 2, *TOXIC_FROM))


def grade(docs: DataFrame, model: OrdinalModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, severity, grade, toxic``: expected grade, likeliest grade, and whether a grade above 0 is as likely as the model's cut."""
    kind = docs.schema[doc_id].dataType.simpleString()
    out = f"doc_id {kind}, severity double, grade int, toxic boolean"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text)).mapInArrow(_grader(model, False), out)


def _grader(model: OrdinalModel, keep_rows: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.probabilities(np.array([model.score(t) for t in b.column("text" if keep_rows else 1).to_pylist()], float))
            toxic = 1.0 - p[:, 0] >= model.toxic_from
            if keep_rows:
                yield b.filter(pa.array(~toxic))
            else:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(1).astype(np.int32)), pa.array(toxic)],
                    names=["doc_id", "severity", "grade", "toxic"])
    return each


def keep_clean(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` (with its column ``text``) that are not toxic, with all their columns."""
    return docs.mapInArrow(_grader(model, True), docs.schema)
