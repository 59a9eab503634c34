"""Periodic runs of words, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q, at least `LEAST_WORDS` and 2 q words long, that no
neighbouring word extends. A maximal pair is a pair of places i < j whose following l words agree while the words before
them differ and those after do not agree either; with j - i <= l it is exactly the run from i to j + l with period j - i,
and a run's smallest period is the least distance of the pairs that give it. So runs need no extension step: pairs are
enumerated along the LCP-interval tree, bottom up.

Only places whose next six words stand twice in their document can begin such a pair (l >= 6, since l + q >= 12 and
q <= l). Ranks of all places of a batch by six words are found together in numpy and doubled (Larsson-Sadakane) for the
groups that are left; the tree is then walked for the documents with such places. A node holds its places in order, and
for each left word those that follow it; the smaller child's places look for partners at most l away in the larger one,
skipping places with their own left word by binary search, so the work is n log n and the number of pairs, which is linear.

Words are runs of other characters than the ASCII space, tab, line feed, vertical tab, form feed and carriage return.
Null, empty and blank texts have no words and no runs. Every row stands for itself, whatever its key; a document's words
are held by one task, in a few numbers each.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text

LEAST_WORDS = 12
SEED = LEAST_WORDS // 2  # words that the two places of a pair share at least
BATCH_BYTES = 4_000_000

Run = tuple[int, int, int]


def ranks_by(codes: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Rank of each place by document and its next `SEED` words; `codes` differ after the end of each document."""
    size = len(codes)
    padded = np.zeros(size + SEED, dtype=np.int64)
    padded[:size] = codes + 1

    def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * (int(right.max(initial=0)) + 1) + right
        return np.unique(key, return_inverse=True)[1].astype(np.int64) + 1

    two = np.zeros(size + SEED, dtype=np.int64)
    two[:size] = paired(padded[:size], padded[1 : size + 1])
    four = paired(two[:size], two[2 : size + 2])
    six = paired(four, two[4 : size + 4])
    return documents * (int(six.max(initial=0)) + 1) + six


def suffix_order(codes: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Places whose next `SEED` words stand twice in their document, in the order of their suffixes."""
    ranks = ranks_by(codes, documents)
    order = np.argsort(ranks, kind="stable")
    ordered = ranks[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    alone = fresh & np.append(fresh[1:], True)
    group = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = group
    order, heads = order[~alone], group[~alone]
    reach, slots = SEED, np.flatnonzero(~alone)
    active = np.arange(len(order))
    while len(active):
        held = order[active]
        key = rank[np.minimum(held + reach, len(rank) - 1)]
        sort = np.lexsort((key, heads[active]))
        order[active] = held = held[sort]
        key, head = key[sort], heads[active]
        new = np.ones(len(active), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (key[1:] != key[:-1])
        heads[active] = np.maximum.accumulate(np.where(new, slots[active], 0))
        rank[held] = heads[active]
        single = new & np.append(new[1:], True)
        active = active[~single]
        reach *= 2
    return order


def shared_words(codes: list[int], order: list[int], low: int) -> list[int]:
    """Words that each suffix shares with the one before it in the order, by Kasai's rule."""
    before = dict(zip(order[1:], order))
    shared, reach, last = {}, 0, -2
    for place in sorted(order):
        other = before.get(place)
        # The neighbour moves on with the place if what they go on to share makes its next place one of the order's too.
        reach = reach - 1 if last == place - 1 and reach > SEED else 0
        last = place
        if other is None:
            reach = 0
            continue
        a, b = place + reach - low, other + reach - low
        while codes[a] == codes[b]:
            a += 1
            b += 1
        reach = a - place + low
        shared[place] = reach
    return [0, *(shared[place] for place in order[1:])]


def _ahead(places: list[int], own: list[int], at: int) -> int:
    """First index from `at` on in `places` whose place is not one of `own`; both ascend, and `own` is part of `places`."""
    start = bisect_left(own, places[at]) if at < len(places) else 0
    if at >= len(places) or start >= len(own) or own[start] != places[at]:
        return at
    low, high = 1, min(len(places) - at, len(own) - start)
    while low < high:  # as long as the two go on together
        middle = (low + high + 1) // 2
        if places[at + middle - 1] == own[start + middle - 1]:
            low = middle
        else:
            high = middle - 1
    return at + low


def _behind(places: list[int], own: list[int], at: int) -> int:
    """Last index up to `at` in `places` whose place is not one of `own`, or -1."""
    if at < 0:
        return at
    start = bisect_left(own, places[at])
    if start >= len(own) or own[start] != places[at]:
        return at
    low, high = 1, min(at, start) + 1
    while low < high:
        middle = (low + high + 1) // 2
        if places[at - middle + 1] == own[start - middle + 1]:
            low = middle
        else:
            high = middle - 1
    return at - low


class Node:
    """Places below a node of the tree, ascending, and those that follow each left word."""

    __slots__ = ("places", "after")

    def __init__(self, place: int, left: int):
        self.places, self.after = [place], {left: [place]}


def _joined(one: Node, two: Node, depth: int, runs: dict[tuple[int, int], int]) -> Node:
    """The node of two children whose places share `depth` words, after their pairs have been noted as runs."""
    small, large = (one, two) if len(one.places) < len(two.places) else (two, one)
    places = large.places
    for left, held in small.after.items():
        own = large.after.get(left, ())
        if len(own) == len(places):
            continue
        for place in held:
            centre = bisect_left(places, place)
            at = _ahead(places, own, centre) if own else centre
            while at < len(places) and places[at] - place <= depth:
                _note(place, places[at], depth, runs)
                at = _ahead(places, own, at + 1) if own else at + 1
            at = _behind(places, own, centre - 1) if own else centre - 1
            while at >= 0 and place - places[at] <= depth:
                _note(places[at], place, depth, runs)
                at = _behind(places, own, at - 1) if own else at - 1
    for left, held in small.after.items():
        mine = large.after.setdefault(left, [])
        _add(mine, held)
    _add(places, small.places)
    return large


def _add(into: list[int], new: list[int]) -> None:
    if len(new) > 8:
        into.extend(new)
        into.sort()
    else:
        for place in new:
            insort(into, place)


def _note(i: int, j: int, depth: int, runs: dict[tuple[int, int], int]) -> None:
    if j - i + depth >= LEAST_WORDS:
        key = (i, j + depth)
        period = runs.get(key)
        if period is None or j - i < period:
            runs[key] = j - i


def pairs_as_runs(codes: list[int], order: list[int], low: int) -> list[Run]:
    """Runs (start, length, period) of one document from its places in suffix order.

    `codes` are its words and an end that equals none, and its first word is at place `low`.
    """
    shared = shared_words(codes, order, low)
    runs: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, Node]] = []  # nodes still open, with the words that their places share with those to come
    for at, place in enumerate(order):
        depth = shared[at]
        node = Node(place - low, codes[place - low - 1] if place > low else -1)
        if depth < SEED:
            _close(stack, runs)
            stack = [(0, node)]
            continue
        # Close what lies deeper than the words shared with this suffix.
        top = stack.pop()[1]
        while stack and stack[-1][0] > depth:
            open_depth, under = stack.pop()
            top = _joined(under, top, open_depth, runs)
        if stack and stack[-1][0] == depth:
            under = stack.pop()[1]
            top = _joined(under, top, depth, runs)
        stack.append((depth, top))
        stack.append((0, node))
    _close(stack, runs)
    return sorted((start, end - start, period) for (start, end), period in runs.items())


def _close(stack: list[tuple[int, Node]], runs: dict[tuple[int, int], int]) -> None:
    while len(stack) > 1:
        top = stack.pop()[1]
        depth, under = stack.pop()
        stack.append((0, _joined(under, top, depth, runs)))


def runs_of(documents: list[np.ndarray]) -> list[list[Run]]:
    """Runs of each document, given as word numbers from 0 that mean the same in all of them."""
    found: list[list[Run]] = [[] for _ in documents]
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    if not len(sizes) or sizes.max() < LEAST_WORDS:
        return found
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes = np.empty(int((sizes + 1).sum()), dtype=np.int64)
    most = max(int(d.max(initial=0)) for d in documents)
    for start, size, document in zip(starts.tolist(), sizes.tolist(), documents):
        codes[start : start + size] = document
    codes[starts + sizes] = most + 1 + np.arange(len(sizes))
    number = np.repeat(np.arange(len(sizes)), sizes + 1)
    order = suffix_order(codes, number)
    of = number[order]
    cuts = np.flatnonzero(np.diff(of)) + 1
    for part in np.split(order, cuts) if len(order) else []:
        document = int(number[part[0]])
        low, size = int(starts[document]), int(sizes[document])
        found[document] = pairs_as_runs(codes[low : low + size + 1].tolist(), part.tolist(), low)
    return found


def repeated(size: int, runs: list[Run]) -> np.ndarray:
    """Which words lie in a run after its first period."""
    steps = np.zeros(size + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) > 0


def planted_period(key: int | None, size: int) -> tuple[int, int] | None:
    """Where a document that the query makes periodic begins to be so, and its period; None for the others and without a key."""
    if key is None or not size:
        return None
    value = zlib.crc32(str(key).encode())
    if value % 10:
        return None
    start = value // 10 % size
    return start, 1 + (size - start) // (3 + value // 10 % 8)


SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[list[bytes]]]]:
    """Keys and words of some documents at a time, of about `BATCH_BYTES` or one document."""
    for batch in batches:
        keys: list[int | None] = []
        words: list[list[bytes]] = []
        held = 0
        texts = batch.column("text").cast(pa.binary())
        for key, text in zip(batch.column("doc_id"), texts):
            raw = text.as_py() or b""
            if keys and held + len(raw) > BATCH_BYTES:
                yield keys, words
                keys, words, held = [], [], 0
            keys.append(key.as_py())
            words.append(raw.split())  # at the six ASCII white-space characters
            held += len(raw)
        if keys:
            yield keys, words


def _with_runs(keys: list, words: list[list[bytes]], planted: bool) -> Iterator[tuple[object, list[bytes], list[Run]]]:
    """Key, words and runs of each document; with `planted`, after some were made periodic."""
    flat = pa.chunked_array([pa.array(w, pa.binary()) for w in words if w] or [pa.array([], pa.binary())])
    numbers = flat.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = [len(w) for w in words]
    documents = np.split(numbers, np.cumsum(sizes)[:-1])
    if planted:
        for at, (key, size) in enumerate(zip(keys, sizes)):
            period = planted_period(key, size)
            if period is not None:
                start, step = period
                source = np.arange(size)
                source[start:] = start + (source[start:] - start) % step
                documents[at] = documents[at][source]
                words[at] = [words[at][i] for i in source.tolist()]
    return zip(keys, words, runs_of(documents))


def _kept(words: list[bytes], runs: list[Run]) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = repeated(len(words), runs).tolist()
    return b" ".join([word for word, drop in zip(words, gone) if not drop])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of each document and its words without their repetitions, joined by one space: doc_id, runs, collapsed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])), pa.string()]
        for keys, words in _batches(batches):
            rows = [
                (key, [dict(zip(("start", "length", "period"), r)) for r in runs], _kept(own, runs).decode())
                for key, own, runs in _with_runs(keys, words, False)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "runs", "collapsed"])

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def _digest(key: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    exponent = 1000 * length // period if runs else None
    collapsed = hashlib.sha256(_kept(words, runs)).hexdigest()
    return key, len(runs), start, length, period, exponent, hashlib.sha256(listed.encode()).hexdigest(), collapsed


def planted_runs(docs: DataFrame) -> DataFrame:
    """Longest run and digests of each document, of which one in ten was made periodic by its key first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        names = [part.split()[0] for part in DIGEST.split(", ")]
        for keys, words in _batches(batches):
            rows = [_digest(*row) for row in _with_runs(keys, words, True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return id_and_text(docs).mapInArrow(run, DIGEST)
