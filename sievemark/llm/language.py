"""Language of whole texts by a byte-level convolutional network.

A text's UTF-8 bytes are cut into windows of a fixed length, the last one filled with spaces. Each byte has a learned
vector; filters of several widths slide over the window, each filter gives its highest answer, and a softmax over these
gives the window's languages. A document's probabilities are the mean over all its windows, weighted by their bytes; of
equal ones the alphabetically first language is taken. Equal texts have equal scores, whatever stands beside them.

The network is trained in numpy on `EXCERPT` characters, from a place that depends on the key, of a bounded sample of labelled documents. Texts that are null, empty or without a
letter get ``und`` and score 0; without labelled documents every text does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text, texts_of
from sievemark.llm.samples import held_out, labelled_texts

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
VECTOR = 8
PER_LANGUAGE = 400
EXCERPT = 2 * WINDOW
EPOCHS = 6
UNKNOWN = "und"
_BLOCK = 256  # windows that one matrix product takes


@dataclass
class Network:
    """Weights; filters narrower than the widest have zeros at the end."""

    languages: list[str]
    vectors: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # (widest * VECTOR) x all filters
    offsets: np.ndarray
    out: np.ndarray  # all filters x languages
    out_offsets: np.ndarray

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """What the widest filter sees from each place: windows x places x (widest * VECTOR)."""
        seen = self.vectors[windows]
        places = windows.shape[1] - max(WIDTHS) + 1
        return np.concatenate([seen[:, at : at + places] for at in range(max(WIDTHS))], axis=2)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Language probabilities of windows of bytes."""
        parts = [np.empty((0, len(self.languages)))]
        for at in range(0, len(windows), _BLOCK):
            answers = (self.patches(windows[at : at + _BLOCK]) @ self.filters).max(axis=1) + self.offsets
            parts.append(softmax(_products(np.maximum(answers, 0), self.out) + self.out_offsets))
        return np.concatenate(parts)


def _products(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Rows times a table in double precision, each row summed by itself: a matrix product would round by the number of rows,
    and a text's score would depend on the texts beside it."""
    return (rows.astype(np.float64)[:, :, None] * table.astype(np.float64)).sum(axis=1)


def softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all bytes of a text, with room for the widest filter, and the number of bytes in each."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    count = max(1, -(-len(raw) // WINDOW))
    filled = np.full(count * WINDOW, 0x20, dtype=np.uint8)
    filled[: len(raw)] = raw
    sizes = np.full(count, WINDOW)
    sizes[-1] = len(raw) - (count - 1) * WINDOW
    room = np.full((count, max(WIDTHS) - 1), 0x20, dtype=np.uint8)
    return np.concatenate([filled.reshape(count, WINDOW), room], axis=1), sizes


def train(texts: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit the network to labelled texts by Adam on cross-entropy."""
    random = np.random.default_rng(seed)
    languages = sorted(set(labels))
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    shown = np.concatenate([np.repeat(np.arange(widest) < width, VECTOR)[:, None].repeat(FILTERS, 1) for width in WIDTHS], axis=1)
    network = Network(
        languages,
        random.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        (random.normal(0, 0.3, (widest * VECTOR, total)) * shown).astype(np.float32),
        np.zeros(total, np.float32),
        random.normal(0, 0.2, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    cut = [windows_of(text)[0] for text in texts]
    windows = np.concatenate(cut)
    wanted = np.repeat([languages.index(label) for label in labels], [len(c) for c in cut])
    names = ("vectors", "filters", "offsets", "out", "out_offsets")
    first = {name: np.zeros_like(getattr(network, name)) for name in names}
    second = {name: np.zeros_like(getattr(network, name)) for name in names}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            changes = gradients(network, windows[chosen], wanted[chosen])
            changes["filters"] *= shown
            step += 1
            for name in names:
                first[name] = 0.9 * first[name] + 0.1 * changes[name]
                second[name] = 0.999 * second[name] + 0.001 * changes[name] ** 2
                change = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(network, name, (getattr(network, name) - 0.005 * change).astype(np.float32))
    return network


def gradients(network: Network, windows: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy; through the maximum, only the place that gave it learns."""
    patches = network.patches(windows)
    answers = patches @ network.filters
    best = answers.argmax(axis=1)  # windows x filters
    top = np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0] + network.offsets
    active = np.maximum(top, 0)
    error = softmax(active @ network.out + network.out_offsets)
    error[np.arange(len(wanted)), wanted] -= 1
    error /= len(wanted)
    back = (error @ network.out.T) * (top > 0)
    rows = np.arange(len(windows))[:, None]
    seen = patches[rows, best]  # windows x filters x (widest * VECTOR)
    vectors = np.zeros_like(network.vectors)
    by_place = back[:, :, None] * network.filters.T[None]
    for place in range(max(WIDTHS)):
        part = by_place[:, :, place * VECTOR : (place + 1) * VECTOR].reshape(-1, VECTOR)
        np.add.at(vectors, windows[rows, best + place].ravel(), part)
    return {
        "vectors": vectors,
        "filters": np.einsum("nfk,nf->kf", seen, back),
        "offsets": back.sum(axis=0),
        "out": active.T @ error,
        "out_offsets": error.sum(axis=0),
    }


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def languages_of(texts: list[str], network: Network | None) -> tuple[list[str], list[float]]:
    """Language and its probability for each whole text."""
    found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [at for at, text in enumerate(texts) if network and has_letter(text)]
    start = 0
    while start < len(known):  # some megabytes of text at a time
        end, held = start, 0
        while end < len(known) and (end == start or held + len(texts[known[end]]) < 1_000_000):
            held += len(texts[known[end]])
            end += 1
        cut = [windows_of(texts[at]) for at in known[start:end]]
        chances = network.probabilities(np.concatenate([c[0] for c in cut]))
        chances *= np.concatenate([c[1] for c in cut])[:, None]
        firsts = np.cumsum([0, *(len(c[1]) for c in cut[:-1])])
        sums = np.add.reduceat(chances, firsts, axis=0)
        sums /= sums.sum(axis=1, keepdims=True)
        for at, row in zip(known[start:end], sums):
            best = int(row.argmax())
            found[at], scores[at] = network.languages[best], float(min(1.0, row[best]))
        start = end
    return found, scores


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Network trained on at most `per_language` documents of each language outside the held-out fold."""
    labels = docs.filter(~held_out(4, 2)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("label"))
    rows = labelled_texts(docs, labels, per_language, excerpt=EXCERPT)
    return train([text for text, _ in rows], [label for _, label in rows]) if rows else None


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """Language and score of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = languages_of(texts_of(batch), network)
            columns = [batch.column("doc_id"), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """Train on the labelled documents, then identify all."""
    return identify(docs, fit(docs)).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
