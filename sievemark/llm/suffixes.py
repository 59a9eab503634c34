"""Bytes of documents that repeat a 50-byte string of an earlier document.

Every 50-byte window has an anchor, the place in it whose 16-byte hash is lowest; equal windows have equal anchors, so
only windows whose anchor stands in several documents can repeat. Documents are dealt into shards of a bounded size:

1. each shard sends the sorted hashes of its anchors, by hash range, and is told which of them other documents have too;
2. over the text around those anchors the shard builds a suffix array by Larsson-Sadakane refinement, with Kasai's
   common prefixes: windows that an earlier document of the shard has are settled there;
3. the windows left are sent as text, by anchor range; there the sorted runs of the shards are merged by binary search,
   which settles equal runs, and a suffix array over the runs that share an anchor but differ settles the others.

A hot passage reaches step 3 once a shard, not once a document. A long text is dealt out in overlapping pieces. Null and
empty texts have no bytes. Rows with equal keys never remove each other's bytes; rows without a key are left whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text, texts_of
from sievemark.sources.tables import materialise

LENGTH = 50
ANCHOR = 16
_PLACES = LENGTH - ANCHOR + 1
_PLACE_BITS = 16
PIECE = 1 << _PLACE_BITS  # bytes whose windows are anchored at once; their arrays stay in a core's cache
SETTLED_BYTES = 400_000
TEXT_PIECE = 1 << 19  # windows of a document that go to one shard
SHARD_BYTES, RANGE_BYTES, LEAST_RANGES = 2_000_000, 8_000_000, 64
_BEYOND = 128

_random = np.random.default_rng(50)
_BYTE_VALUES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_UP, _DOWN = _powers(_BASE, PIECE + 1), _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def _anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes from each place."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUES[raw] * _UP[: len(raw)], dtype=np.uint64)])
    values = (sums[ANCHOR:] - sums[:-ANCHOR]) * _DOWN[: len(raw) - ANCHOR + 1]
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def runs_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: first window, windows, anchor hash.

    `ends` are the ends of the documents that lie one after another in `raw`; no window crosses one.
    """
    parts = []
    for low in range(0, max(1, len(raw) - LENGTH + 1), PIECE - LENGTH + 1):
        piece = raw[low : low + PIECE]
        if len(piece) < LENGTH:
            break
        hashes = _anchor_hashes(piece)
        packed = (hashes >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        lowest, width = packed, 1
        while width < _PLACES:  # windows of doubling width
            step = min(width, _PLACES - width)
            lowest = np.minimum(lowest[:-step], lowest[step:])
            width += step
        anchor = (lowest & np.uint64(PIECE - 1)).astype(np.int64)
        within = ends[np.searchsorted(ends, low) : np.searchsorted(ends, low + len(piece))] - low
        inside = np.ones(len(anchor), dtype=bool)
        for end in within.tolist():  # windows that would cross the end of a document
            inside[max(0, end - LENGTH + 1) : end] = False
        change = np.flatnonzero((np.diff(anchor) != 0) | (inside[1:] != inside[:-1])) + 1
        first = np.concatenate([[0], change])
        count = np.diff(np.concatenate([first, [len(anchor)]]))
        keep = inside[first]
        parts.append((first[keep] + low, count[keep], hashes[anchor[first[keep]]]))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def words_at(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a number that orders as they do, with zeros after the end."""
    size = -(-len(text) // 8) * 8
    padded = np.zeros(size + 16, dtype=np.uint8)
    padded[: len(text)] = text
    words = np.empty(size, dtype=np.uint64)
    for at in range(8):
        words[at::8] = padded[at : at + size].view(">u8")
    return words[: len(text)]


def _first_of_equal(fresh: np.ndarray) -> np.ndarray:
    """For each place of a sorted list the first place with an equal value, from marks of new values."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh), dtype=np.int32), np.int32(0)))


def _fresh(values: np.ndarray) -> np.ndarray:
    """Marks of values that differ from the one before."""
    found = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=found[1:])
    return found


def suffix_array(text: np.ndarray, words: np.ndarray, starts: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """`starts` in the order of the `depth` bytes that follow each, by Larsson-Sadakane refinement.

    All places are ranked by eight bytes; then only groups that still hold several places are refined, each by the ranks
    of the places as far behind as the order already reaches, which doubles its reach. The last step reaches `depth`.
    """
    order = np.argsort(words)
    place = _first_of_equal(_fresh(words[order]))
    rank = np.zeros(len(text) + depth, dtype=np.int32)
    rank[order] = place + np.int32(1)
    single = np.empty(len(text), dtype=bool)
    single[order] = _fresh(place) & np.append(_fresh(place)[1:], True)
    reach = 8
    while reach < depth:
        last = 2 * reach >= depth
        step = depth - reach if last else reach
        active = starts[~single[starts]] if last else np.flatnonzero(~single)
        if len(active):
            key = rank[active].astype(np.int64) << 32 | rank[active + step]
            refined = np.argsort(key)
            active, key = active[refined], key[refined]
            fresh = _fresh(key)
            rank[active] = (key >> 32).astype(np.int32) + _first_of_equal(fresh) - _first_of_equal(_fresh(key >> 32))
            single[active] = fresh & np.append(fresh[1:], True)
        reach += step
    # Equal strings stand in text order, so that neighbours stay neighbours along a copied passage.
    return starts[np.argsort(rank[starts].astype(np.int64) << 32 | np.arange(len(starts)))]


def common_prefixes(words: np.ndarray, order: np.ndarray, most: int = 4096) -> np.ndarray:
    """Bytes that each place of a suffix array shares with the one before it, by Kasai's rule; beyond `most` a lower bound.

    Taken in text order, a place whose neighbour moves on with it shares one byte less than the place before, so only
    the heads of such chains are compared, and chains that run out of shared bytes begin anew.
    """
    if not len(order):
        return np.empty(0, dtype=np.int32)
    before = np.full(len(words) + 1, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    inside = np.zeros(len(words), dtype=bool)
    inside[order] = True
    places = np.flatnonzero(inside).astype(np.int32)
    other = before[places]
    shared = np.zeros(len(places), dtype=np.int32)
    padded = np.append(words, np.zeros(_BEYOND, dtype=np.uint64))
    left = np.flatnonzero(other >= 0)
    while len(left):
        own, neighbour = places[left], other[left]
        head = np.ones(len(left), dtype=bool)
        head[1:] = (np.diff(own) != 1) | (np.diff(neighbour) != 1)
        reach = np.zeros(len(left), dtype=np.int32)
        reach[head] = _extend(padded, len(words), own[head], neighbour[head], most)
        chain = _first_of_equal(head)
        values = reach[chain] - (own - own[chain])
        shared[left] = np.maximum(values, 0)
        left = left[(values < 0) | ((values < LENGTH) & (reach[chain] >= most) & ~head)]
    found = before
    found[places] = shared
    return found[order]


def _extend(words: np.ndarray, size: int, left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Shared bytes from pairs of places, compared some words at a time; `words` go on with `_BEYOND` zeros after the text."""
    shared = np.zeros(len(left), dtype=np.int64)
    open_ = np.arange(len(left))
    step, wide = 0, 4
    while step < most:
        open_ = open_[np.maximum(left[open_], right[open_]) + step < size]
        if not len(open_):
            break
        ahead = step + 8 * np.arange(wide)
        differ = words[left[open_][:, None] + ahead] ^ words[right[open_][:, None] + ahead]
        first = (differ != 0).argmax(axis=1)
        differ = differ[np.arange(len(open_)), first]
        ended = differ != 0
        # The first byte that differs is the highest one that is not zero.
        within = (differ[ended].byteswap().view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        shared[open_[ended]] += 8 * first[ended] + within
        open_ = open_[~ended]
        shared[open_] += 8 * wide
        step, wide = step + 8 * wide, 16
    return np.minimum(shared, size - np.maximum(left, right))


def repeated_windows(text: np.ndarray, starts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Which windows (by their starts, ascending) an earlier document has too; `documents` gives each window's document."""
    found = np.zeros(len(starts), dtype=bool)
    if not len(starts):
        return found
    words = words_at(text)
    order = suffix_array(text, words, starts)
    fresh = common_prefixes(words, order) < LENGTH
    number = np.empty(len(text), dtype=np.int32)
    number[starts] = np.arange(len(starts), dtype=np.int32)
    place = number[order]
    ordered = documents[place]
    firsts = np.flatnonzero(fresh)
    least = np.repeat(np.minimum.reduceat(ordered, firsts), np.diff(np.append(firsts, len(order))))
    found[place] = ordered > least
    return found


class Runs:
    """Runs of windows: document, key of its text, first window in the document, windows, anchor hash, and where the run's
    bytes start in a common text."""

    NAMES = ("document", "text_key", "first", "count", "anchor", "at")

    def __init__(self, text: np.ndarray, **columns: np.ndarray):
        self.text = text
        for name in self.NAMES:
            setattr(self, name, columns[name])

    def __len__(self) -> int:
        return len(self.first)

    def take(self, chosen: np.ndarray) -> Runs:
        return Runs(self.text, **{name: getattr(self, name)[chosen] for name in self.NAMES})

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Run and number within it of each window."""
        run = np.repeat(np.arange(len(self), dtype=np.int32), self.count)
        before = (np.cumsum(self.count) - self.count).astype(np.int32)
        return run, np.arange(len(run), dtype=np.int32) - np.repeat(before, self.count)

    def gathered(self) -> Runs:
        """The runs with a text of their bytes alone, one run after another."""
        sizes = self.count + LENGTH - 1
        at = np.cumsum(sizes) - sizes
        source = np.repeat(self.at - at, sizes) + np.arange(sizes.sum())
        columns = {name: getattr(self, name) for name in self.NAMES} | {"at": at}
        return Runs(self.text[source] if len(self) else np.empty(0, np.uint8), **columns)


def cut_runs(runs: Runs, keep: np.ndarray) -> Runs:
    """Parts of runs of windows to keep."""
    run, within = runs.windows()
    edge = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.empty(0, dtype=bool)
    before = np.concatenate([[False], keep[:-1]])[: len(keep)] & ~edge
    begins = np.flatnonzero(keep & ~before)
    after = np.concatenate([keep[1:], [False]])[: len(keep)] & ~np.concatenate([edge[1:], [True]])[: len(keep)]
    ends = np.flatnonzero(keep & ~after)
    parts = runs.take(run[begins])
    parts.first, parts.at, parts.count = parts.first + within[begins], parts.at + within[begins], ends - begins + 1
    return parts


def settle(runs: Runs) -> np.ndarray:
    """Which windows of the runs an earlier document among them has, by one suffix array over the text they lie in."""
    run, within = runs.windows()
    starts, documents = runs.at.astype(np.int32)[run] + within, runs.document[run]
    if (starts[1:] > starts[:-1]).all():
        return repeated_windows(runs.text, starts, documents)
    order = np.argsort(starts)
    found = np.empty(len(starts), dtype=bool)
    found[order] = repeated_windows(runs.text, starts[order], documents[order])
    return found


def merge(parts: list[Runs]) -> list[tuple[Runs, np.ndarray]]:
    """Runs of several shards and which of their windows an earlier document has.

    Each shard's runs, sorted by a hash of their bytes, are merged pair by pair by binary search; a run equal to one of an
    earlier document is settled as a whole. Among the runs left, those that share an anchor are settled by windows.
    """
    whole = joined_runs(parts)
    hashes = _run_hashes(whole)
    limits = np.cumsum([0, *map(len, parts)])
    tables = []
    for low, high in zip(limits[:-1], limits[1:]):
        own, first = np.unique(hashes[0][low:high], return_index=True)
        least = np.full(len(own), np.iinfo(np.int64).max)
        np.minimum.at(least, np.searchsorted(own, hashes[0][low:high]), whole.document[low:high])
        tables.append((own, hashes[1][low:high][first], least))
    while len(tables) > 1:
        tables = [_merged(*pair) if len(pair) == 2 else pair[0] for pair in (tables[at : at + 2] for at in range(0, len(tables), 2))]
    keys, checks, least = tables[0]
    place = np.searchsorted(keys, hashes[0])
    same = checks[place] == hashes[1]
    settled = same & (whole.document > least[place])
    left = np.flatnonzero(~settled)
    # Anchors that runs of several documents still share.
    anchors, group = np.unique(whole.anchor[left], return_inverse=True)
    low, high = np.full(len(anchors), np.iinfo(np.int64).max), np.full(len(anchors), np.iinfo(np.int64).min)
    np.minimum.at(low, group, whole.document[left])
    np.maximum.at(high, group, whole.document[left])
    done = whole.take(np.flatnonzero(settled))
    found = [(done, np.ones(int(done.count.sum()), dtype=bool))]
    left = left[(low < high)[group]]
    left = left[np.argsort(whole.anchor[left], kind="stable")]
    # Anchors are independent: some of them at a time, so that the arrays over their text stay small.
    ends = np.cumsum(whole.count[left] + LENGTH - 1)
    fresh = _fresh(whole.anchor[left])
    batch = (ends[_first_of_equal(fresh)] // SETTLED_BYTES) if len(left) else ends
    for part in np.split(left, np.flatnonzero(np.diff(batch)) + 1):
        runs = whole.take(part).gathered()
        found.append((runs, settle(runs)))
    return found


def joined_runs(parts: list[Runs]) -> Runs:
    """Runs of several texts over one."""
    before = np.cumsum([0, *(len(part.text) for part in parts)])
    columns = {name: np.concatenate([getattr(part, name) for part in parts]) for name in Runs.NAMES}
    columns["at"] = np.concatenate([part.at + base for part, base in zip(parts, before)])
    return Runs(np.concatenate([part.text for part in parts]), **columns)


def _run_hashes(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each run's bytes; the runs' texts lie one after another."""
    sizes = runs.count + LENGTH - 1
    found = (np.zeros(len(runs), dtype=np.uint64), np.zeros(len(runs), dtype=np.uint64))
    done = 0
    while done < len(runs):  # as many runs at a time as the table of powers reaches
        most = np.searchsorted(np.cumsum(sizes[done:]), PIECE, side="right")
        upto = done + max(1, int(most))
        low, high = runs.at[done], runs.at[upto - 1] + sizes[upto - 1]
        raw = runs.text[low:high]
        starts = runs.at[done:upto] - low
        for out, values in zip(found, (_BYTE_VALUES, _BYTE_VALUES[::-1])):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values[raw] * _UP[: len(raw)], dtype=np.uint64)])
            mixed = (sums[starts + sizes[done:upto]] - sums[starts]) * _DOWN[starts] + sizes[done:upto].astype(np.uint64)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            out[done:upto] = mixed ^ (mixed >> np.uint64(29))
        done = upto
    return found


def _merged(left: tuple, right: tuple) -> tuple:
    """Two sorted tables of (hash, second hash, smallest document) as one, by binary search of the second in the first."""
    if not len(left[0]):
        return right
    place = np.minimum(np.searchsorted(left[0], right[0]), len(left[0]) - 1)
    same = left[0][place] == right[0]
    least = left[2].copy()
    np.minimum.at(least, place[same], right[2][same])
    new = ~same
    at = np.searchsorted(left[0], right[0][new])
    return np.insert(left[0], at, right[0][new]), np.insert(left[1], at, right[1][new]), np.insert(least, at, right[2][new])


def _packed(values: np.ndarray) -> bytes:
    """Sorted hashes as compressed planes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _shard_runs(pieces: pa.Table) -> Runs:
    """Runs of all pieces of a shard over their joined text."""
    values = pieces.column("bytes").to_pylist()
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    ends = np.cumsum(lengths)
    raw = np.frombuffer(b"".join(values), dtype=np.uint8)
    first, count, anchor = runs_of(raw, ends)
    piece = np.searchsorted(ends, first, side="right")
    inside = first - (ends - lengths)[piece]
    columns = [pieces.column(name).to_numpy()[piece] for name in ("doc_id", "text_key", "offset")]
    return Runs(raw, document=columns[0], text_key=columns[1], first=columns[2] + inside, count=count, anchor=anchor, at=first)


def _short(anchor: np.ndarray) -> np.ndarray:
    """Anchor hashes as they are compared between shards: 48 bits; equal ones by chance only cost work. Anchors are the
    lowest hashes of their windows, so they are mixed again to spread evenly over ranges."""
    return (anchor ^ (anchor >> np.uint64(33))) * np.uint64(0x94D049BB133111EB) >> np.uint64(16)


def _range_of(short: np.ndarray, ranges: int) -> np.ndarray:
    return (short * np.uint64(ranges) >> np.uint64(48)).astype(np.int64)


def _anchor_sets(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Distinct short anchors of a shard, ascending, and which of them several of its documents have."""
    short = _short(runs.anchor)
    order = np.lexsort((runs.document, short))
    short, document = short[order], runs.document[order]
    fresh = np.concatenate([[True], short[1:] != short[:-1]])[: len(short)]
    firsts = np.flatnonzero(fresh)
    if not len(firsts):
        return short, np.empty(0, dtype=bool)
    return short[fresh], np.maximum.reduceat(document, firsts) > document[firsts]


MARK_SCHEMA = "shard int, range int, data binary, marks binary"
MOVED_SCHEMA = "range int, document binary, text_key binary, first binary, count binary, anchor binary, text binary"
GONE_SCHEMA = "doc_id long, text_key long, first binary, count binary"
# Types of moved columns. A run has at most `_PLACES` windows; of an anchor's hash the low half tells runs of a range apart,
# and equal ones by chance only cost work.
_TYPES = {"document": np.int64, "text_key": np.int64, "first": np.int64, "count": np.uint8, "anchor": np.uint32}


def _squeezed(values: np.ndarray) -> bytes:
    """Compressed bytes of a column; numbers as planes of their differences, since neighbours are alike."""
    if values.itemsize == 8:
        values = np.ascontiguousarray(np.diff(values, prepend=values.dtype.type(0)).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _expanded(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    if np.dtype(kind).itemsize == 8:
        return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(kind).ravel(), dtype=kind)
    return raw.view(kind)


def _send_anchors(ranges: int):
    def run(pieces: pa.Table) -> pa.Table:
        values, several = _anchor_sets(_shard_runs(pieces))
        shard, place = pieces.column("shard")[0].as_py(), _range_of(values, ranges)
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(cuts))
        data = [_packed(values[cuts[r] : cuts[r + 1]]) for r in used]
        marks = [np.packbits(several[cuts[r] : cuts[r + 1]]).tobytes() for r in used]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = [[shard] * len(used), used, data, marks]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "range", "data", "marks"])

    return run


def _answer(sent: pa.Table) -> pa.Table:
    """For each shard of a range, which of its anchors stand in several documents."""
    values = [_unpacked(data) for data in sent.column("data").to_pylist()]
    several = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(v)).astype(bool) for m, v in zip(sent.column("marks").to_pylist(), values)]
    _, place, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = counts > 1
    np.logical_or.at(shared, place, np.concatenate(several))
    parts = np.split(shared[place], np.cumsum([len(v) for v in values])[:-1])
    marks = pa.array([np.packbits(part).tobytes() for part in parts], pa.binary())
    return pa.table([sent.column("shard"), sent.column("range"), pa.nulls(len(parts), pa.binary()), marks], names=["shard", "range", "data", "marks"])


def _gone(runs: Runs, windows: np.ndarray) -> tuple[list, list, list, list]:
    """Settled windows as runs by document: keys, first windows and numbers of windows."""
    parts = cut_runs(runs, windows)
    order = np.lexsort((parts.first, parts.text_key, parts.document))
    parts = parts.take(order)
    change = (np.diff(parts.document) != 0) | (np.diff(parts.text_key) != 0)
    begins = np.concatenate([[0], np.flatnonzero(change) + 1]) if len(parts) else np.empty(0, dtype=np.int64)
    cuts = begins[1:]
    firsts = [f.astype(np.int64).tobytes() for f in np.split(parts.first, cuts)] if len(parts) else []
    counts = [c.astype(np.int64).tobytes() for c in np.split(parts.count, cuts)] if len(parts) else []
    return parts.document[begins].tolist(), parts.text_key[begins].tolist(), firsts, counts


def _local(ranges: int):
    """Suffix array of one shard: its settled windows, and the runs left, by range."""

    def run(pieces: pa.Table, marks: pa.Table) -> pa.Table:
        runs = _shard_runs(pieces)
        values, _ = _anchor_sets(runs)
        place = _range_of(values, ranges)
        shared = np.zeros(len(values), dtype=bool)
        cuts = np.searchsorted(place, np.arange(ranges + 1))
        for number, bits in zip(marks.column("range").to_pylist(), marks.column("marks").to_pylist()):
            low, high = cuts[number], cuts[number + 1]
            shared[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low)
        runs = runs.take(np.flatnonzero(shared[np.searchsorted(values, _short(runs.anchor))])) if len(values) else runs
        rows: list[tuple] = []
        if len(runs):
            near = _close(runs)
            found = settle(near)
            documents, keys, firsts, counts = _gone(near, found)
            for d, k, f, c in zip(documents, keys, firsts, counts):
                rows.append((hash((d, k)) % ranges, _squeezed(np.array([d])), _squeezed(np.array([k])), f, c, None, None))
            left = cut_runs(near, ~found)
            number = _range_of(_short(left.anchor), ranges)
            order = np.argsort(number, kind="stable")
            limits = np.searchsorted(number[order], np.arange(ranges + 1))
            for at in np.flatnonzero(np.diff(limits)):
                part = left.take(order[limits[at] : limits[at + 1]]).gathered()
                rows.append((int(at), *(_squeezed(getattr(part, n).astype(t)) for n, t in _TYPES.items()), _squeezed(part.text)))
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int32(), *[pa.binary()] * 6]
        names = ["range", *_TYPES, "text"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _close(runs: Runs) -> Runs:
    """The runs over a text without the bytes that none of them covers."""
    covered = np.zeros(len(runs.text) + 1, dtype=np.int32)
    np.add.at(covered, runs.at, 1)
    np.add.at(covered, runs.at + runs.count + LENGTH - 1, -1)
    kept = np.cumsum(covered[:-1]) > 0
    moved = np.cumsum(kept) - 1
    columns = {name: getattr(runs, name) for name in Runs.NAMES} | {"at": moved[runs.at]}
    return Runs(runs.text[kept], **columns)


def _across(moved: pa.Table) -> pa.Table:
    """Merge of the shards' runs of one range; what shards settled themselves passes through."""
    parts, keys, texts, firsts, counts = [], [], [], [], []
    for row in (row for batch in moved.to_batches(max_chunksize=200) for row in batch.to_pylist()):
        if row["text"] is None:
            keys.append(int(_expanded(row["document"], np.int64)[0]))
            texts.append(int(_expanded(row["text_key"], np.int64)[0]))
            firsts.append(row["first"])
            counts.append(row["count"])
            continue
        columns = {name: _expanded(row[name], kind) for name, kind in _TYPES.items()}
        columns["count"] = columns["count"].astype(np.int64)
        sizes = columns["count"] + LENGTH - 1
        parts.append(Runs(_expanded(row["text"], np.uint8), **columns, at=np.cumsum(sizes) - sizes))
    for runs, found in merge(parts) if parts else []:
        for out, new in zip((keys, texts, firsts, counts), _gone(runs, found)):
            out.extend(new)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip((keys, texts, firsts, counts), kinds)], names=["doc_id", "text_key", "first", "count"])


def dealt(docs: DataFrame, shards: int) -> DataFrame:
    """Texts long enough to have windows, in pieces, by shard: shard, doc_id, text_key, offset, whole, bytes.

    A text of one piece is `whole`; its shard gives the result for it too.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).filter(F.length("raw") >= LENGTH)
    offsets = F.sequence(F.lit(0), F.length("raw") - LENGTH, F.lit(TEXT_PIECE))
    placed = texts.select("doc_id", F.xxhash64("raw").alias("text_key"), "raw", F.explode(offsets).alias("offset"))
    shard = F.pmod(F.xxhash64("doc_id", "offset"), F.lit(shards)).cast("int")
    piece = F.substring("raw", F.col("offset") + 1, F.lit(TEXT_PIECE + LENGTH - 1))
    whole = F.length("raw") - LENGTH < TEXT_PIECE
    return placed.select(shard.alias("shard"), "doc_id", "text_key", F.col("offset").cast("long").alias("offset"), whole.alias("whole"), piece.alias("bytes"))


def repeats(pieces: DataFrame, ranges: int) -> DataFrame:
    """Repeated windows of texts dealt to shards: doc_id, text_key, first and count (binaries of equal length)."""
    # All uses read all columns, so that they share one exchange.
    answers = pieces.groupBy("shard").applyInArrow(_send_anchors(ranges), MARK_SCHEMA).groupBy("range").applyInArrow(_answer, MARK_SCHEMA)
    moved = pieces.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(_local(ranges), MOVED_SCHEMA)
    return moved.groupBy("range").applyInArrow(_across, GONE_SCHEMA)


def removed_bytes(size: int, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which bytes of a text of this size its repeated windows cover, given as runs of windows."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + count + LENGTH - 1, -1)
    return np.cumsum(steps[:-1]) > 0


RUNS = "array<struct<first: binary, count: binary>>"
KEPT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_KEPT_NAMES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")


def _kept(key: int | None, text: bytes, runs: tuple[np.ndarray, np.ndarray] | None) -> tuple:
    raw = np.frombuffer(text, dtype=np.uint8)
    if runs is None:
        return key, len(raw), 0, 0, text
    gone = removed_bytes(len(raw), *runs)
    spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]))
    return key, len(raw), int(gone.sum()), spans, raw[~gone].tobytes()


def _kept_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [*[pa.int64()] * 4, pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(_KEPT_NAMES))


def _runs_by_text(gone: pa.Table) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Firsts and counts of all window runs of each (key, text key)."""
    if not gone.num_rows:
        return {}
    keys, texts = gone.column("doc_id").to_numpy(), gone.column("text_key").to_numpy()
    order = np.lexsort((texts, keys))
    keys, texts = keys[order], texts[order]
    both, sizes = [], None
    for name in ("first", "count"):
        values = gone.column(name).to_pylist()
        sizes = np.array([len(value) for value in values], dtype=np.int64)[order] // 8
        both.append(np.frombuffer(b"".join([values[at] for at in order.tolist()]), dtype=np.int64))
    change = np.flatnonzero((keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])) + 1
    begins = np.concatenate([[0], change])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    limits = ends[np.append(begins, len(keys))]
    parts = zip(keys[begins].tolist(), texts[begins].tolist(), limits[:-1].tolist(), limits[1:].tolist())
    return {(key, text): (both[0][low:high], both[1][low:high]) for key, text, low, high in parts}


def _kept_of_shard(pieces: pa.Table, gone: pa.Table) -> pa.Table:
    """What stays of the whole texts of a shard."""
    runs = _runs_by_text(gone)
    columns = (pieces.column(name).to_pylist() for name in ("doc_id", "text_key", "whole"))
    rows = [_kept(key, text.as_py(), runs.get((key, text_key))) for key, text_key, whole, text in zip(*columns, pieces.column("bytes")) if whole]
    return pa.Table.from_batches([_kept_batch(rows)])


def _joined(runs: list[dict] | None) -> tuple[np.ndarray, np.ndarray] | None:
    return tuple(np.frombuffer(b"".join(run[name] for run in runs), dtype=np.int64) for name in ("first", "count")) if runs else None


def without_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document with its removed bytes counted and the bytes that stay: doc_id, n_bytes, n_removed, n_spans, kept.

    Repeated windows go back to the shards, whose texts have been shuffled already; only texts of several pieces are joined
    with theirs once more. Texts too short for a window, and those without a key, lose nothing.
    """
    texts = id_and_text(docs)
    keyed = texts.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    size = F.octet_length("text")
    read = keyed.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total"), F.coalesce(F.max(size), F.lit(0)).alias("longest")).first()
    shards, ranges = max(1, -(-read["total"] // shard_bytes)), max(LEAST_RANGES, -(-read["total"] // range_bytes))
    some_long = read["longest"] - LENGTH >= TEXT_PIECE
    pieces = dealt(keyed, shards)
    gone = materialise(repeats(pieces, ranges)) if some_long else repeats(pieces, ranges)  # read twice, or once
    # Also the shard of a text in one piece, which begins at 0.
    home = gone.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(0)), F.lit(shards)).cast("int"))
    in_shards = pieces.groupBy("shard").cogroup(home.groupBy("shard")).applyInArrow(_kept_of_shard, KEPT_SCHEMA)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 500):
                batch = whole.slice(low, 500)
                texts = (text.encode("utf-8", "surrogatepass") for text in texts_of(batch))
                rows = zip(batch.column("doc_id").to_pylist(), texts, map(_joined, batch.column("runs").to_pylist()))
                yield _kept_batch([_kept(*row) for row in rows])

    short = texts.filter((F.coalesce(size, F.lit(0)) < LENGTH) | F.col("doc_id").isNull()).select("doc_id", "text")
    unchanged = short.withColumn("runs", F.lit(None).cast(RUNS)).mapInArrow(run, KEPT_SCHEMA)
    found = in_shards.unionByName(unchanged)
    if not some_long:
        return found
    long = keyed.filter(size - LENGTH >= TEXT_PIECE).withColumn("text_key", F.xxhash64(F.col("text").cast("binary")))
    theirs = gone.join(long.select("doc_id", "text_key").distinct(), ["doc_id", "text_key"], "left_semi")
    theirs = theirs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    joined = long.join(theirs, ["doc_id", "text_key"], "left").select("doc_id", "text", "runs").mapInArrow(run, KEPT_SCHEMA)
    return found.unionByName(joined)


def repeated_text(docs: DataFrame, shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Counts of removed bytes and the digest of what stays."""
    found = without_repeats(docs, shard_bytes, range_bytes)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def digest(kept: bytes) -> str:
    """Digest as `repeated_text` gives it."""
    return hashlib.sha256(kept).hexdigest()
