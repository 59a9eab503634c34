"""Toxic spans and documents by a linear-chain conditional random field.

Tokens are white-space-separated chunks in lower case. The field has two tags, other and toxic; its token weights are
those of the token's word, the word's beginnings, and the words before and after it. Token labels come from labelled
documents: words far more frequent in toxic documents than in the others are found first, and their places in toxic
documents are the toxic tokens. Sequences are runs of at most `SEQUENCE` tokens of a document.

Forward-backward marginals give each token's chance to be toxic. A document's score is a logistic function, fitted to the
labelled documents, of its highest marginal and of the number of toxic tokens expected; tokens of at least one half are
the offending spans, in characters of the original text. Null and empty texts have no tokens and get the lowest score;
without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import held, id_and_text, texts_of, with_columns
from sievemark.llm.samples import held_out, sample, weights_of

SEQUENCE = 128
PER_LABEL = 1000
MOST_CHARS = 30_000
WEIGHTS = 1 << 16
CACHED_WORDS = 300_000
STEPS = 80
_EDGES = re.compile(r"^\W+|\W+$")
_TOKEN = re.compile(r"\S+")
ROLES = ("own", "before", "after")
BEGINNINGS = (3, 4, 5, 6)


def units(token: str) -> list[str]:
    """A token's word without marks around it, and the word's beginnings."""
    core = _EDGES.sub("", token) or "-"
    return [core, *(f"{core[:size]}-" for size in BEGINNINGS if len(core) > size)]


def features(token: str) -> tuple[list[int], int, int]:
    """Places of a token's weights in the three roles it can have for a token: itself, the one before, the one after."""
    places = [zlib.crc32(unit.encode("utf-8", "surrogatepass")) for unit in units(token)]
    before, after = places[0] ^ 0x5BD1E995, places[0] ^ 0x1B873593
    return [place % WEIGHTS for place in places], before % WEIGHTS, after % WEIGHTS


class Vocabulary:
    """Numbers of words, and per word the sums of its weights in each role. Emptied between batches when it is full."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.tolist()
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.sums = np.zeros((1024, len(ROLES)))

    def number(self, tokens: list[str]) -> np.ndarray:
        if len(self.numbers) > CACHED_WORDS:
            self.clear()
        found = list(map(self.numbers.get, tokens))
        if None in found:
            for token in {t for t, n in zip(tokens, found) if n is None}:
                at = self.numbers[token] = len(self.numbers)
                if at == len(self.sums):
                    self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
                own, before, after = features(token)
                self.sums[at] = sum(map(self.weights.__getitem__, own)), self.weights[before], self.weights[after]
            found = [self.numbers[t] if n is None else n for t, n in zip(tokens, found)]
        return np.array(found, dtype=np.int64)


def vocabulary_of(name: int, field: Field) -> Vocabulary:
    """The vocabulary of a field that a Python worker keeps from task to task."""
    return held("toxicity", name, lambda: Vocabulary(field.weights))


@dataclass
class Field:
    """Weights of the field and of the document score."""

    weights: np.ndarray
    moves: np.ndarray  # 2 x 2, from tag to tag
    start: float
    score: np.ndarray  # constant, highest marginal's log-odds, log of expected toxic tokens


def cut(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and sizes of the sequences of documents with these numbers of tokens, one after another."""
    counts = -(-lengths // SEQUENCE)
    document = np.repeat(np.arange(len(lengths)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    firsts = (np.cumsum(lengths) - lengths)[document] + within * SEQUENCE
    return firsts, np.minimum(lengths[document] - within * SEQUENCE, SEQUENCE)


def neighbours(sizes: np.ndarray, firsts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each token has one before and one after it in its sequence."""
    has_before, has_after = np.ones(total, dtype=bool), np.ones(total, dtype=bool)
    has_before[firsts] = False
    has_after[firsts + sizes - 1] = False
    return has_before, has_after


def marginals(emissions: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, moves: np.ndarray, start: float):
    """Chance of the toxic tag for each token, the expected moves, and the sum of the log partition functions.

    Forward and backward vectors are scaled at each place; all sequences of a batch advance together.
    """
    if not len(firsts):
        return np.empty(len(emissions)), np.zeros((2, 2)), np.empty(0), 0.0
    order = np.argsort(-sizes, kind="stable")
    firsts, sizes = firsts[order], sizes[order]
    longest = int(sizes[0])
    alive = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")  # sequences that reach each place
    factor = np.exp(moves)
    states = np.zeros((longest, len(firsts), 2))
    potentials = np.ones((longest, len(firsts), 2))
    top = np.zeros((longest, len(firsts)))
    for place in range(longest):
        n = alive[place]
        e = emissions[firsts[:n] + place] + (start if place == 0 else 0)
        top[place, :n] = np.maximum(e, 0)
        potentials[place, :n, 0], potentials[place, :n, 1] = np.exp(-top[place, :n]), np.exp(e - top[place, :n])
    scale = np.ones((longest, len(firsts)))
    for place in range(longest):
        n = alive[place]
        now = potentials[place, :n] * (states[place - 1, :n] @ factor if place else 1)
        scale[place, :n] = now.sum(axis=1)
        states[place, :n] = now / scale[place, :n, None]
    chances = np.empty(len(emissions))
    pairs = np.zeros((2, 2))
    begin = np.empty(len(firsts))
    behind = np.ones((len(firsts), 2))
    for place in range(longest - 1, -1, -1):
        n = alive[place]
        both = states[place, :n] * behind[:n]
        chances[firsts[:n] + place] = both[:, 1] / both.sum(axis=1)
        if place == 0:
            begin = both[:, 1] / both.sum(axis=1)
        else:
            ahead = potentials[place, :n] * behind[:n] / scale[place, :n, None]
            pairs += (states[place - 1, :n].T @ ahead) * factor
            behind[:n] = ahead @ factor.T
    return chances, pairs, begin, float((np.log(scale) + top).sum())


def telling_tokens(distinct: list[str], ids: np.ndarray, of_toxic: np.ndarray, n_toxic: int) -> np.ndarray:
    """Which of the distinct tokens hold a word or a beginning far more frequent in toxic documents than in the others.

    A token counts once for each different pair of tokens around it, so that a passage which copies share counts once.
    """
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    around = (np.roll(mixed, 1) >> np.uint64(7)) ^ mixed ^ (np.roll(mixed, -1) << np.uint64(9))
    counts = []
    for side in (of_toxic, ~of_toxic):
        _, first = np.unique(around[side], return_index=True)
        counts.append(np.bincount(ids[side][first], minlength=len(distinct)))
    sums: dict[str, list[int]] = {}
    for token, toxic, clean in zip(distinct, *counts):
        for unit in units(token):
            held = sums.setdefault(unit, [0, 0])
            held[0] += toxic
            held[1] += clean
    n_tokens, n_others = max(1, int(of_toxic.sum())), max(1, int((~of_toxic).sum()))
    enough = max(5, 0.02 * n_toxic)
    telling = {u for u, (t, c) in sums.items() if t >= enough and t / n_tokens >= 20 * (c + 0.5) / n_others and u != "-"}
    return np.array([any(unit in telling for unit in units(token)) for token in distinct], dtype=bool)


def train(
    texts: list[str],
    labels: list[int],
    steps: int = STEPS,
    weights: list[float] | None = None,
    whole: Callable[[Field], dict[int, tuple[float, float]]] | None = None,
) -> Field | None:
    """Fit the field to token labels by gradient steps on the likelihood, then the document score to document labels.

    `weights` of documents, 1 by default, hold for the document score: with them its constant follows the labels' shares
    among all labelled documents. The field learns from a fixed mixture of sequences and needs none. Where a text is only
    the beginning of a document, `whole` gives the facts of the whole one, by place in `texts`.
    """
    document_weights = np.ones(len(labels)) if weights is None else np.array(weights)
    toxic = np.array(labels, dtype=bool)
    if not toxic.any() or toxic.all():
        return None
    # Words become numbers text by text, so that the driver never holds all of them as strings.
    distinct: dict[str, int] = {}
    numbered = [np.array([distinct.setdefault(token, len(distinct)) for token in text.lower().split()], dtype=np.int64) for text in texts]
    lengths = np.array([len(numbers) for numbers in numbered])
    if not distinct:
        return None
    ids = np.concatenate(numbered)
    del numbered
    of_toxic = np.repeat(toxic, lengths)
    tags = telling_tokens(list(distinct), ids, of_toxic, int(toxic.sum()))[ids] & of_toxic
    firsts, sizes = cut(lengths)
    # All sequences with toxic tokens, and as many times four of the others.
    ends = np.concatenate([[0], np.cumsum(tags)])
    bad = ends[firsts + sizes] > ends[firsts]
    others = np.flatnonzero(~bad)
    random = np.random.default_rng(11)
    chosen = np.sort(np.concatenate([np.flatnonzero(bad), random.permutation(others)[: 4 * int(bad.sum()) + 50]]))
    at = np.concatenate([np.arange(f, f + s) for f, s in zip(firsts[chosen], sizes[chosen])]).astype(np.int64)
    ids, tags, sizes = ids[at], tags[at], sizes[chosen]
    firsts = np.cumsum(sizes) - sizes
    has_before, has_after = neighbours(sizes, firsts, len(ids))
    places = [features(token) for token in distinct]
    width = 1 + len(BEGINNINGS)  # tokens without all beginnings fill up with a weight that stays zero
    own = np.array([(p[0] + [WEIGHTS] * width)[:width] for p in places], dtype=np.int64)[ids]
    before = np.array([p[1] for p in places], dtype=np.int64)[np.roll(ids, 1)]
    after = np.array([p[2] for p in places], dtype=np.int64)[np.roll(ids, -1)]
    tag_pairs = np.zeros((2, 2))
    inside = np.flatnonzero(has_before)
    np.add.at(tag_pairs, (tags[inside - 1].astype(int), tags[inside].astype(int)), 1)
    weights, moves, start = np.zeros(WEIGHTS), np.zeros((2, 2)), -1.0
    first, second = np.zeros(WEIGHTS + 5), np.zeros(WEIGHTS + 5)
    for step in range(1, steps + 1):
        emissions = np.append(weights, 0.0)[own].sum(axis=1) + weights[before] * has_before + weights[after] * has_after
        chances, pairs, begin, _ = marginals(emissions, firsts, sizes, moves, start)
        error = tags - chances
        change = np.bincount(own.ravel(), np.repeat(error, width), WEIGHTS + 1)[:WEIGHTS]
        change += np.bincount(before, error * has_before, WEIGHTS) + np.bincount(after, error * has_after, WEIGHTS)
        begin_tags = tags[firsts].sum() - begin.sum()
        slope = np.concatenate([change - 0.3 * weights, (tag_pairs - pairs).ravel() - 0.3 * moves.ravel(), [begin_tags]])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, moves, start = weights + move[:WEIGHTS], moves + move[WEIGHTS:-1].reshape(2, 2), start + move[-1]
    field = Field(weights, moves, start, np.array([0.0, 1.0, 0.0]))
    vocabulary = Vocabulary(weights)
    facts = np.array([document_facts(c) for part in _parts(texts) for c in token_chances(part, field, vocabulary)])
    for place, found in (whole(field) if whole else {}).items():
        facts[place] = found
    field.score = logistic(facts, toxic, document_weights)
    return field


def _parts(texts: list[str], size: int = 100) -> Iterator[list[list[str]]]:
    """Tokens of some texts at a time."""
    for at in range(0, len(texts), size):
        yield [text.lower().split() for text in texts[at : at + size]]


def logistic(facts: np.ndarray, wanted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression of weighted rows with a small ridge, by Newton steps."""
    table = np.column_stack([np.ones(len(facts)), facts])
    found = np.zeros(table.shape[1])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(table @ found, -30, 30)))
        slope = table.T @ (weights * (wanted - chance)) - 0.5 * found
        curve = (table * (weights * chance * (1 - chance))[:, None]).T @ table + 0.5 * np.eye(len(found))
        found += np.linalg.solve(curve, slope)
    return found


def token_chances(documents: list[list[str]], field: Field, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Chance of the toxic tag for each token of each document."""
    lengths = np.array([len(document) for document in documents], dtype=np.int64)
    if not lengths.sum():
        return [np.empty(0) for _ in documents]
    ids = vocabulary.number([token for document in documents for token in document])
    firsts, sizes = cut(lengths)
    has_before, has_after = neighbours(sizes, firsts, len(ids))
    sums = vocabulary.sums
    emissions = sums[ids, 0] + sums[np.roll(ids, 1), 1] * has_before + sums[np.roll(ids, -1), 2] * has_after
    chances = marginals(emissions, firsts, sizes, field.moves, field.start)[0]
    return np.split(chances, np.cumsum(lengths)[:-1])


def document_facts(chances: np.ndarray) -> tuple[float, float]:
    """What a document's score rests on: log-odds of the highest marginal, log of the number of toxic tokens expected."""
    highest = float(np.clip(chances.max(initial=0.0), 1e-4, 1 - 1e-4))
    return np.log(highest / (1 - highest)), float(np.log1p(chances[chances >= 0.05].sum()))


def score_texts(texts: list[str], field: Field, vocabulary: Vocabulary) -> list[tuple[float, list[tuple[int, int]]]]:
    """Score and offending spans of each whole text."""
    documents = [text.lower().split() for text in texts]
    rows = []
    for text, chances in zip(texts, token_chances(documents, field, vocabulary)):
        value = float(np.clip(field.score @ np.array([1.0, *document_facts(chances)]), -30, 30))
        offending = set(np.flatnonzero(chances >= 0.5).tolist())
        places = [m.span() for at, m in enumerate(_TOKEN.finditer(text)) if at in offending] if offending else []
        rows.append((float(1 / (1 + np.exp(-value))), places))
    return rows


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Field | None:
    """Field fitted to at most `per_label` documents of each label outside the held-out fold, weighted to the labels' shares there.

    The driver gets the first `MOST_CHARS` characters of each, from which the field learns; the document score is fitted to
    whole documents, those of longer ones read in tasks.
    """
    known = labels.filter(~held_out(5, 0)).filter("toxic IN (0, 1)")
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label"))
    chosen = sample(docs, known, per_label).withColumns({"key": F.xxhash64("text"), "chars": F.length("text")})
    rows = chosen.withColumn("text", F.substring("text", 1, MOST_CHARS)).collect()
    rows = sorted(rows, key=lambda row: (row["doc_id"], row["text"], row["key"]))
    places: dict[tuple[int, int], list[int]] = {}
    for at, row in enumerate(rows):
        if row["chars"] > MOST_CHARS:
            places.setdefault((row["doc_id"], row["key"]), []).append(at)

    def whole(field: Field) -> dict[int, tuple[float, float]]:
        if not places:
            return {}
        long = id_and_text(docs).filter(F.col("doc_id").isin(sorted({key for key, _ in places}))).filter(F.length("text") > MOST_CHARS)
        found = facts_of(long, field).collect()
        return {at: (r["highest"], r["expected"]) for r in found for at in places[r["doc_id"], r["key"]]}

    return train([r["text"] for r in rows], [r["label"] for r in rows], weights=weights_of(rows), whole=whole)


def facts_of(docs: DataFrame, field: Field) -> DataFrame:
    """What the scores of whole texts rest on: doc_id, key (a hash of the text), highest, expected."""
    name = zlib.crc32(field.weights.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = [text.lower().split() for text in texts_of(batch)]
            facts = [document_facts(c) for c in token_chances(documents, field, vocabulary_of(name, field))]
            columns = [pa.array([float(f[at]) for f in facts], pa.float64()) for at in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *columns], names=["doc_id", "key", "highest", "expected"])

    return docs.withColumn("key", F.xxhash64("text")).mapInArrow(run, "doc_id long, key long, highest double, expected double")


SCORE_SCHEMA = "_score double, _spans array<struct<begin: int, end: int>>"
_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def scored(rows: DataFrame, field: Field | None) -> DataFrame:
    """The rows with the score (`_score`) and the offending spans (`_spans`) of their whole texts."""
    name = zlib.crc32(field.weights.tobytes()) if field else 0

    def make(texts: list[str]) -> list[pa.Array]:
        if field is None:
            return [pa.array([0.0] * len(texts)), pa.array([[]] * len(texts), _SPANS)]
        found = score_texts(texts, field, vocabulary_of(name, field))
        return [pa.array([s for s, _ in found]), pa.array([[{"begin": a, "end": b} for a, b in places] for _, places in found], _SPANS)]

    return with_columns(rows, SCORE_SCHEMA, make)


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """Score and offending spans of every whole text: doc_id, score, spans."""
    return scored(id_and_text(docs), field).select("doc_id", F.col("_score").alias("score"), F.col("_spans").alias("spans"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled documents, then score all."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
