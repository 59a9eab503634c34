"""Secrets in whole texts: keys of known shapes, and random strings told from ordinary identifiers by character models.

Base spans are the leftmost non-overlapping matches of one pattern a kind that pass the kind's check. Further spans, of kind
`random`, are stretches of runs of key characters that first-order Markov models of characters call random: a log-likelihood
ratio adds up along a run, its best stretch is taken, and a stretch of at least `LEAST_RANDOM` characters whose ratio exceeds the
odds against a secret is a span, with the letters and digits it touches. One that overlaps a base span is left out.

The ordinary model is an even mixture of labelled identifiers in the usual spellings, and of these with the characters of all
documents outside base spans, so that it is usable on few texts and knows identifiers in much prose. The random models are one for each alphabet, fitted to labelled strings drawn from it, and one
of the values in base spans of all documents; a stretch is judged by the best of them, less the price of choosing. So
the models of alphabets stay as they are however many keys of one shape a corpus holds. Counts are summed in tasks first;
the driver gets at most two tables of characters by characters.

Null and empty texts have no spans; rows with equal keys or texts get equal ones. Of equally good stretches the first, and
of these the shortest, is taken. Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.llm.inputs import id_and_text

KINDS = ("assign", "access", "hex", "random")

# What the base patterns match, over UTF-8 bytes.
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = "0123456789abcdef"
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABET = _UPPER + _LOWER + _DIGITS + "+/_=-"
SYMBOLS = len(ALPHABET) + 1  # 0 stands for everything else, so also for the start and the end of a run
FAMILIES = (
    _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "_-",
    _UPPER + _LOWER + _DIGITS,
    _LOWER + _DIGITS,
    _UPPER + _DIGITS,
    HEX.upper(),
)
LEAST_RANDOM = 16
LOG_ODDS = math.log(1e6)  # of a stretch being ordinary, before it is looked at
DRAWN, DRAWN_CHARS = 3000, 32
BATCH_BYTES = 4_000_000

# Labelled ordinary identifiers: these words, joined in the usual ways.
WORDS = (
    "get set user name file path index value count list table column row key item node tree page text line word char byte "
    "request response server client host port address config option default result error message handler listener event "
    "start stop open close read write update delete insert select create remove find search sort filter merge split join "
    "order customer product price total number date time month year hour version build test data model view control "
    "http json html xml url id max min sum left right first last next previous global local static public private"
).split()

_SYMBOL = np.zeros(256, dtype=np.uint8)
_SYMBOL[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SYMBOLS)
_PLAIN = (_SYMBOL > 0) & (_SYMBOL <= 62)  # letters and digits
_IS_HEX = np.zeros(256, dtype=bool)
_IS_HEX[np.frombuffer(HEX.encode(), np.uint8)] = True

Span = tuple[int, int, int]  # begin, end, kind


def _runs(inside: np.ndarray, least: int) -> np.ndarray:
    """Begins and ends of maximal runs of at least `least` marks, as two columns."""
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    if len(edges) % 2:
        edges = np.append(edges, len(inside))
    runs = edges.reshape(-1, 2)
    return runs[runs[:, 1] - runs[:, 0] >= least]


class Texts:
    """Some texts as one run of bytes, a line feed after each."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.raw = np.frombuffer(b"".join(part for text in texts for part in (text, b"\n")), dtype=np.uint8)
        sizes = np.array([len(text) + 1 for text in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.symbols = _SYMBOL[self.raw]

    def base(self) -> tuple[list[Span], list[tuple[int, int]]]:
        """Base spans in order, in bytes, and the places of their values."""
        spans, values = [], []
        for start, text in zip(self.starts.tolist(), self.texts):
            small = text.lower()
            if any(word in small for word in ASSIGN_WORDS):
                for match in ASSIGN.finditer(text):
                    if match.end(1) - match.start(1) >= LEAST_ASSIGN:
                        spans.append((start + match.start(), start + match.end(), 0))
                        values.append((start + match.start(1), start + match.end(1)))
            if b"AKIA" in text:
                for match in ACCESS.finditer(text):
                    if match.end() - match.start() >= LEAST_ACCESS:
                        spans.append((start + match.start(), start + match.end(), 1))
        spans += [(begin, end, 2) for begin, end in _runs(_IS_HEX[self.raw], LEAST_HEX).tolist()]
        values += [(begin, end) for begin, end, kind in spans if kind]
        return sorted(spans, key=lambda s: (s[0], s[2])), values

    def counts(self) -> np.ndarray:
        """How often each symbol follows each, outside the values of base spans (0) and in them (1)."""
        secret = np.zeros(len(self.raw), dtype=bool)
        for begin, end in self.base()[1]:
            secret[begin:end] = True
        both = []
        for symbols in (np.where(secret, 0, self.symbols), np.where(secret, self.symbols, 0)):
            both.append(_pairs(symbols))
        return np.array(both)

    def random(self, ratios: np.ndarray, base: list[Span]) -> list[Span]:
        """Random stretches that overlap no base span, in bytes."""
        found = []
        taken = np.array([(begin, end) for begin, end, _ in base], dtype=np.int64).reshape(-1, 2)
        for begin, end in _runs(self.symbols > 0, LEAST_RANDOM).tolist():
            symbols = np.concatenate([[0], self.symbols[begin:end], [0]])
            stretch = best_stretch(ratios[:, symbols[:-1], symbols[1:]])
            if stretch is not None:
                low, high = begin + stretch[0], begin + stretch[1]
                while low > begin and _PLAIN[self.raw[low]] and _PLAIN[self.raw[low - 1]]:
                    low -= 1
                while high < end and _PLAIN[self.raw[high - 1]] and _PLAIN[self.raw[high]]:
                    high += 1
                if not ((taken[:, 0] < high) & (taken[:, 1] > low)).any():
                    found.append((low, high, 3))
        return found

    def in_code_points(self, spans: list[Span]) -> list[list[Span]]:
        """Spans of each text, begins and ends counted in its code points."""
        by: list[list[Span]] = [[] for _ in self.texts]
        if not spans:
            return by
        of = np.searchsorted(self.ends, [begin for begin, _, _ in spans], side="right").tolist()
        before: dict[int, np.ndarray] = {}
        for text, (begin, end, kind) in zip(of, spans):
            start = int(self.starts[text])
            if text not in before:
                points = (self.raw[start : int(self.ends[text])] & 0xC0) != 0x80
                before = {text: np.concatenate([[0], np.cumsum(points)])}
            by[text].append((int(before[text][begin - start]), int(before[text][end - start]), kind))
        return by


def best_stretch(steps: np.ndarray) -> tuple[int, int] | None:
    """The stretch of a run with the highest ratio above the odds, if it is long enough; `steps` are those of each model.

    Step s leads to character s, and the last one to the end of the run.
    """
    price, best, found = math.log(len(steps)), LOG_ODDS, None
    sums = np.cumsum(steps, axis=1)
    for total in sums:
        # Begin before the first of the lowest sums so far; what leads into the first character counts for it.
        before = np.concatenate([[0.0], total[:-1]])
        low = np.minimum.accumulate(before)
        gain = total - low
        end = int(gain.argmax())
        if gain[end] - price > best:
            begin = int(np.flatnonzero(before[: end + 1] == low[end])[0])
            upto = min(end + 1, len(total) - 1)
            if upto - begin >= LEAST_RANDOM:
                best, found = float(gain[end]) - price, (begin, upto)
    return found


def _pairs(symbols: np.ndarray) -> np.ndarray:
    """How often each symbol follows each, the first one a start."""
    symbols = np.concatenate([[0], symbols]).astype(np.int64)
    return np.bincount(symbols[:-1] * SYMBOLS + symbols[1:], minlength=SYMBOLS * SYMBOLS)


def _transitions(strings: Iterable[str]) -> np.ndarray:
    return _pairs(Texts([string.encode() for string in strings]).symbols)


def labelled_identifiers(seed: int = 12, count: int = 4000) -> list[str]:
    """Identifiers made of the list of words, paths of them, numbers, and dates and other groups of numbers."""
    draw = random.Random(seed)
    made = []
    for _ in range(count):
        words = [draw.choice(WORDS) for _ in range(draw.randrange(1, 6))]
        style = draw.randrange(6)
        if style == 0:
            words = words[:1] + [word.capitalize() for word in words[1:]]
        elif style == 1:
            words = [word.capitalize() for word in words]
        elif style == 2:
            words = [word.upper() for word in words]
        number = str(draw.randrange(10 ** draw.randrange(1, 5))) if draw.random() < 0.2 else ""
        made.append(("", "", "_", "_", "-", "/")[style].join([""] * (style == 5) + words) + number)
    digits = lambda most: "".join(draw.choice(_DIGITS) for _ in range(draw.randrange(1, most)))
    made += [digits(20) for _ in range(count // 4)]
    return made + [draw.choice("-/_").join(digits(5) for _ in range(draw.randrange(2, 8))) for _ in range(count // 4)]


def labelled_random(family: str, seed: int = 12) -> list[str]:
    """Random strings over an alphabet."""
    draw = random.Random(f"{seed}{family}")
    return ["".join(draw.choice(family) for _ in range(DRAWN_CHARS)) for _ in range(DRAWN)]


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios of each random model against the ordinary one, by symbol and the symbol before it."""

    ratios: np.ndarray


def _shares(counts: np.ndarray, more: float = 0.1) -> np.ndarray:
    """Chance of each symbol after each."""
    table = counts.reshape(SYMBOLS, SYMBOLS).astype(float) + more
    return table / table.sum(axis=1, keepdims=True)


def model_of(ordinary: np.ndarray, secret: np.ndarray) -> Model:
    """The models of counted transitions outside base spans and in them."""
    labelled = _transitions(labelled_identifiers())
    plain = (_shares(_counted(ordinary) + labelled) + _shares(labelled)) / 2
    families = [_transitions(labelled_random(family)) for family in FAMILIES]
    families.append(_counted(secret) + sum(families))
    return Model(np.array([np.log(_shares(counts) / plain) for counts in families]))


def _counted(counts: np.ndarray) -> np.ndarray:
    """Transitions without those between characters that belong to no run."""
    kept = counts.copy()
    kept[0] = 0
    return kept


def _batches(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Rows and their texts, of about `BATCH_BYTES` or one text at a time."""
    for batch in batches:
        texts = [text.as_py() or b"" for text in batch.column(column).cast(pa.binary())]
        low = held = 0
        for at, text in enumerate(texts):
            if at > low and held + len(text) > BATCH_BYTES:
                yield batch.slice(low, at - low), Texts(texts[low:at])
                low, held = at, 0
            held += len(text)
        if len(texts) > low:
            yield batch.slice(low), Texts(texts[low:])


def train(docs: DataFrame) -> Model:
    """The models of a corpus; every document is counted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SYMBOLS * SYMBOLS), dtype=np.int64)
        for _, texts in _batches(batches):
            total += texts.counts()
        secret, pair = np.nonzero(total)
        columns = [pa.array(secret, pa.int32()), pa.array(pair, pa.int32()), pa.array(total[secret, pair], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["secret", "pair", "n"])

    texts = id_and_text(docs).filter("text IS NOT NULL").select("text")
    counted = texts.mapInArrow(run, "secret int, pair int, n long").groupBy("secret", "pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, SYMBOLS * SYMBOLS), dtype=np.int64)
    for row in counted.collect():  # at most two for each pair of symbols
        counts[row["secret"], row["pair"]] = row["n"]
    return model_of(counts[0], counts[1])


BASE_SPANS, MORE_SPANS = "_base_secrets", "_more_secrets"
_SPANS = "array<struct<begin: int, end: int, kind: int>>"
_ARROW_SPANS = pa.list_(pa.struct([(name, pa.int32()) for name in ("begin", "end", "kind")]))


def with_spans(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with the base spans and the random spans of their text, in order of begin and kind. Nothing is shuffled."""
    new = T.StructType.fromDDL(f"{BASE_SPANS} {_SPANS}, {MORE_SPANS} {_SPANS}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(batches):
            base = texts.base()[0]
            more = texts.random(model.ratios, base)
            columns = [pa.array([[dict(zip(("begin", "end", "kind"), s)) for s in spans] for spans in texts.in_code_points(part)], _ARROW_SPANS) for part in (base, more)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, BASE_SPANS, MORE_SPANS])

    return rows.mapInArrow(run, T.StructType(rows.schema.fields + new.fields))


def _ordered(left: Column, right: Column) -> Column:
    return F.when(left["begin"] != right["begin"], left["begin"] - right["begin"]).otherwise(left["kind"] - right["kind"])


def listed(spans: Column) -> Column:
    """Spans as kind:begin:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["begin"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secret_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All spans of each document: doc_id, text, spans (begin, end, kind as a name)."""
    found = with_spans(id_and_text(docs), model or train(docs))
    names = F.array(*map(F.lit, KINDS))
    every = F.array_sort(F.concat(BASE_SPANS, MORE_SPANS), _ordered)
    named = F.transform(every, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("kind")))
    return found.select("doc_id", "text", named.alias("spans"))


def masked(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with every secret in their text replaced by [SECRET]; overlapping ones become one, a null text stays null."""
    found = with_spans(docs, model or train(docs))
    text = F.col("text")

    def step(state: Column, s: Column) -> Column:
        gap = F.concat(F.substring(text, state["at"] + 1, s["begin"] - state["at"]), F.lit("[SECRET]"))
        made = F.when(s["begin"] >= state["at"], F.concat(state["made"], gap)).otherwise(state["made"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), made.alias("made"))

    every = F.array_sort(F.concat(BASE_SPANS, MORE_SPANS), _ordered)
    rest = lambda state: F.concat(state["made"], F.substring(text, state["at"] + 1, F.length(text)))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))
    clean = F.when(F.size(every) == 0, text).otherwise(F.aggregate(every, start, step, rest))
    return found.withColumn("text", clean).select(docs.columns)


def secrets(docs: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans of each document."""
    found = with_spans(id_and_text(docs), train(docs))
    of = lambda kind: F.size(F.filter(BASE_SPANS, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    every = F.array_sort(F.concat(BASE_SPANS, MORE_SPANS), _ordered)
    more = F.size(MORE_SPANS).cast("long").alias("n_random")
    return found.select("doc_id", *counts, F.sha2(listed(F.col(BASE_SPANS)), 256).alias("base_sha256"), listed(every).alias("spans"), more)
