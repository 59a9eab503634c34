"""Quality of whole texts by a generalised additive model with pairwise interactions.

Each text gives a fixed list of numeric features. Their values fall into bins whose edges come from a bounded labelled
sample. Boosting goes round the features; each step fits a tree of at most three leaves over the bins of one feature to
the logistic loss and adds it, damped, to that feature's lookup table. The pairs of features that explain most of what
is left get tables of their own, fitted by trees that split both features once. A score is the sigmoid of the sum of the
looked-up values, so scoring is a few additions a document.

Null and empty texts have the features of an empty text and the score these lead to; without labels of both kinds every
score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text, texts_of
from sievemark.llm.samples import held_out, sample, weights_of

PER_LABEL = 2000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, RATE = 120, 0.15
FEATURES = (
    "log_bytes log_words word_bytes upper digits marks space outside_ascii distinct_words distinct_lines line_bytes "
    "marks_at_word_ends top_word long_words repeated_marks capital_words".split()
)

# Kinds of bytes, by their place in this list.
_KINDS = np.zeros(256, dtype=np.uint8)
_LOWER, _UPPER, _DIGIT, _MARK, _SPACE, _HIGH = 1, 2, 3, 4, 5, 6
_KINDS[:] = [
    _LOWER if 97 <= b <= 122 else _UPPER if 65 <= b <= 90 else _DIGIT if 48 <= b <= 57 else _SPACE if b in b" \t\n\r\v\f" else _HIGH if b > 127 else _MARK
    for b in range(256)
]


def features_of(text: str) -> list[float]:
    """The features of one whole text, in the order of `FEATURES`."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    if not words:
        return [float(np.log1p(len(raw)))] + [0.0] * (len(FEATURES) - 1)
    kinds = _KINDS[raw]
    share = np.bincount(kinds, minlength=7) / len(raw)
    space = kinds == _SPACE
    mark = kinds == _MARK
    ends = mark[:-1] & space[1:]
    repeated = mark[1:] & (raw[1:] == raw[:-1])
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    capital = kinds[starts] == _UPPER
    all_capital = capital & (kinds[np.minimum(starts + 1, len(raw) - 1)] == _UPPER)
    counts = Counter(words)
    n = len(words)
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(n)),
        float((~space).sum() / n),
        *(float(share[kind]) for kind in (_UPPER, _DIGIT, _MARK, _SPACE, _HIGH)),
        len(counts) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(len(raw) / len(lines))),
        float(ends.sum() + mark[-1]) / n,
        max(counts.values()) / n,
        sum(len(word) > 15 for word in counts) / len(counts),
        float(repeated.sum()) / len(raw),
        float(all_capital.sum()) / n,
    ]


@dataclass
class Additive:
    """Bin edges and lookup tables."""

    edges: list[np.ndarray]
    constant: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, at], side="right") for at, e in enumerate(self.edges)])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Chance of label 1 for rows of features."""
        bins, total = self.bins(rows), np.full(len(rows), self.constant)
        for own, table in zip(bins, self.tables):
            total += table[own]
        for one, other, table in self.pairs:
            total += table[coarse(bins[one], self.edges[one]), coarse(bins[other], self.edges[other])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def coarse(bins: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bins joined to at most `PAIR_BINS`."""
    return bins * PAIR_BINS // (len(edges) + 1)


def _leaf(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return slope / (curve + 1.0)


def _gain(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return slope**2 / (curve + 1.0)


def small_tree(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Values by bin of the best tree with at most three leaves over bins with these sums of slope and curvature."""
    n = len(slope)
    s, c = np.concatenate([[0], np.cumsum(slope)]), np.concatenate([[0], np.cumsum(curve)])
    low, high = (a.ravel() for a in np.meshgrid(np.arange(1, n + 1), np.arange(1, n + 1), indexing="ij"))
    keep = low <= high
    low, high = low[keep], high[keep]
    gains = _gain(s[low], c[low]) + _gain(s[high] - s[low], c[high] - c[low]) + _gain(s[n] - s[high], c[n] - c[high])
    at = int(gains.argmax())
    a, b = low[at], high[at]
    values = np.empty(n)
    for left, right in ((0, a), (a, b), (b, n)):
        values[left:right] = _leaf(s[right] - s[left], c[right] - c[left])
    return values


def cross_tree(slope: np.ndarray, curve: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that splits both features once."""
    s = np.zeros((PAIR_BINS + 1, PAIR_BINS + 1))
    c = np.zeros_like(s)
    s[1:, 1:], c[1:, 1:] = slope.cumsum(0).cumsum(1), curve.cumsum(0).cumsum(1)

    def quarters(t: np.ndarray) -> list[np.ndarray]:
        inner, right, down = t[1:-1, 1:-1], t[1:-1, -1:], t[-1:, 1:-1]
        return [inner, right - inner, down - inner, t[-1, -1] - right - down + inner]

    parts = list(zip(quarters(s), quarters(c)))
    gains = sum(_gain(a, b) for a, b in parts)
    row, column = np.unravel_index(int(gains.argmax()), gains.shape)
    values = np.empty((PAIR_BINS, PAIR_BINS))
    leaves = [_leaf(a, b)[row, column] for a, b in parts]
    values[: row + 1, : column + 1], values[: row + 1, column + 1 :] = leaves[0], leaves[1]
    values[row + 1 :, : column + 1], values[row + 1 :, column + 1 :] = leaves[2], leaves[3]
    return float(gains.max() - _gain(s[-1, -1], c[-1, -1])), values


def train(rows: np.ndarray, wanted: np.ndarray, rounds: int = ROUNDS, weights: np.ndarray | None = None) -> Additive:
    """Cyclic boosting of single features, then of the pairs that explain most of the rest; rows weigh 1 by default."""
    weights = np.ones(len(wanted)) if weights is None else weights
    share = float(np.clip(np.average(wanted, weights=weights), 0.01, 0.99)) if len(wanted) else 0.5
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T] if len(rows) else [np.empty(0)] * len(FEATURES)
    model = Additive(edges, float(np.log(share / (1 - share))))
    model.tables = [np.zeros(len(e) + 1) for e in edges]
    if not len(wanted) or wanted.min() == wanted.max():
        return model
    bins = model.bins(rows)
    total = np.full(len(wanted), model.constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return weights * (wanted - chance), weights * chance * (1 - chance)

    for _ in range(rounds):
        for own, table in zip(bins, model.tables):
            slope, curve = slopes()
            step = RATE * small_tree(np.bincount(own, slope, len(table)), np.bincount(own, curve, len(table)))
            table += step
            total += step[own]
    joined = [coarse(own, e) for own, e in zip(bins, edges)]

    def sums(one: int, other: int) -> tuple[np.ndarray, np.ndarray]:
        at = joined[one] * PAIR_BINS + joined[other]
        return tuple(np.bincount(at, v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for v in slopes())

    rated = sorted(((cross_tree(*sums(*pair))[0], pair) for pair in combinations(range(len(edges)), 2)), reverse=True)
    model.pairs = [(*pair, np.zeros((PAIR_BINS, PAIR_BINS))) for _, pair in rated[:PAIRS]]
    for _ in range(rounds // 4):
        for one, other, table in model.pairs:
            step = RATE * cross_tree(*sums(one, other))[1]
            table += step
            total += step[joined[one], joined[other]]
    return model


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Additive:
    """Model of at most `per_label` documents of each label outside the held-out fold, weighted to the labels' shares there."""
    known = labels.filter(~held_out(5, 0)).filter("quality IN (0, 1)")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([features_of(text) for text in texts_of(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("doc_id", "label", "n")), found], names=["doc_id", "label", "n", "found"])

    # Features are made where the texts are, so texts of any length count and the driver gets a few numbers of each.
    chosen = sample(docs, known.withColumn("label", F.col("label").cast("int")), per_label)
    rows = chosen.mapInArrow(run, "doc_id long, label int, n long, found array<double>").collect()
    rows = sorted(rows, key=lambda row: (row["doc_id"], row["found"]))
    table = np.array([row["found"] for row in rows]).reshape(-1, len(FEATURES))
    return train(table, np.array([row["label"] for row in rows], dtype=float), weights=np.array(weights_of(rows)))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """Score of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features_of(text) for text in texts_of(batch)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(rows))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents, then score all."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
