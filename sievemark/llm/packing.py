"""Packing of documents into sequences of a fixed number of tokens.

Documents longer than a sequence are cut into full pieces and a rest. Pieces are dealt into shards of a bounded number
of rows, and each shard is packed best-fit decreasing and then improved by local search: pieces are moved, or exchanged
one for one or two for one, between underfull bins so that the sum of squared fills rises, until bins run empty. Bins
that stay underfull are opened again and their pieces packed once more in fresh shards, so that a shard's last bins do
not remain half full.

Pieces of equal length are packed in descending order of key and piece. Null texts are empty documents (the end id alone). Equal or null keys stay separate documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import id_and_text, texts_of
from sievemark.llm.tokens import default_path, encoder
from sievemark.sources.tables import materialise

SEQUENCE_TOKENS = 4096
SHARD_PIECES = 2048
ROUNDS = 3
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, fill long"


def pieces(docs: DataFrame, capacity: int = SEQUENCE_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece of each document's ids, with the end id."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or default_path()).document
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                ids = encode(text)
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((key, piece, start, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return id_and_text(docs).mapInArrow(cut, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, longest first into the fullest bin that still takes it."""
    bins = np.empty(len(lengths), dtype=np.int64)
    spaces: list[tuple[int, int]] = []  # free tokens and bin, ascending
    opened = 0
    for at in np.argsort(-lengths, kind="stable"):
        need = int(lengths[at])
        found = bisect_left(spaces, (need, -1))
        if found < len(spaces):
            free, chosen = spaces.pop(found)
        else:
            free, chosen, opened = capacity, opened, opened + 1
        bins[at] = chosen
        if free > need:
            insort(spaces, (free - need, chosen))
    return bins


def improve(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Raise the sum of squared fills by exchanges between underfull bins until none raises it.

    From the least filled bin one piece or two go to another bin, for one of its pieces or for nothing. More tokens given
    raise the sum more, so for each piece of another bin only the most that its bin has room for is looked up, among all
    pieces and all pairs of the bin.
    """
    lengths, bins = lengths.astype(np.int64), bins.copy()
    fills = np.bincount(bins, weights=lengths).astype(np.int64)
    tried = np.zeros(len(fills), dtype=bool)
    while True:
        open_bins = np.flatnonzero((fills > 0) & (fills < capacity) & ~tried)
        if len(open_bins) == 0:
            return bins
        source = open_bins[np.argmin(fills[open_bins])]
        own = np.flatnonzero(bins == source)
        others = np.flatnonzero((bins != source) & (fills[bins] < capacity))
        targets = np.concatenate([bins[others], np.unique(bins[others])])  # exchange for a piece, or move into a bin
        taken = np.concatenate([lengths[others], np.zeros(len(targets) - len(others), dtype=np.int64)])
        left, right = np.triu_indices(len(own), 1)
        sums = np.concatenate([lengths[own], lengths[own[left]] + lengths[own[right]]])
        order = np.argsort(sums, kind="stable")
        place = np.searchsorted(sums[order], capacity - fills[targets] + taken, side="right") - 1
        given = sums[order][np.maximum(place, 0)] - taken
        gains = np.where((place >= 0) & (given > 0), given * (fills[targets] + given - fills[source]), 0)
        if not len(gains) or gains.max() <= 0:
            tried[source] = True
            continue
        at = int(gains.argmax())
        chosen = int(order[place[at]])
        pair = [chosen] if chosen < len(own) else [left[chosen - len(own)], right[chosen - len(own)]]
        bins[own[pair]] = targets[at]
        if at < len(others):
            bins[others[at]] = source
        fills[source] -= given[at]
        fills[targets[at]] += given[at]
        tried[[source, targets[at]]] = False


def pack_shard(rows: pd.DataFrame, capacity: int, round_number: int) -> pd.DataFrame:
    """Sequences of one shard; numbers are unique over rounds and shards."""
    shard = int(rows["shard"].iloc[0])
    rows = rows.drop(columns="shard").sort_values(["length", "doc_id", "piece"], ascending=False, kind="stable", ignore_index=True)
    lengths = rows["length"].to_numpy()
    bins = improve(lengths, best_fit(lengths, capacity), capacity)
    order = np.argsort(bins, kind="stable")
    rows = rows.iloc[order].reset_index(drop=True)
    rows["sequence_id"] = (round_number << 58) + (shard << 24) + bins[order]
    by_bin = rows.groupby("sequence_id")["length"]
    rows["offset"] = by_bin.cumsum() - rows["length"]
    rows["fill"] = by_bin.transform("sum")
    return rows


def _packer(capacity: int, round_number: int):
    return lambda rows: pack_shard(rows, capacity, round_number)


def pack(cut: DataFrame, capacity: int = SEQUENCE_TOKENS, shard_pieces: int = SHARD_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Pieces with their sequence and the place in it.

    Every round stores what it packed; the pieces of bins that are not full go into the next round's shards. A later
    round has fewer shards, each with at most one badly filled bin, so the last one decides how much room is lost.
    """
    done, rest = [], materialise(cut)
    for number in range(rounds):
        shards = max(1, -(-rest.count() // shard_pieces))
        key = F.pmod(F.xxhash64("doc_id", "piece", "start", F.lit(number)), F.lit(shards)).alias("shard")
        packed = rest.select("*", key).groupBy("shard").applyInPandas(_packer(capacity, number), PACKED_SCHEMA)
        last = number == rounds - 1
        packed = packed if last else materialise(packed)
        done.append(packed if last else packed.filter(F.col("fill") == capacity))
        rest = packed.filter(F.col("fill") < capacity).select("doc_id", "piece", "start", "length", "ids_crc32")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("fill")


def packed_documents(docs: DataFrame, capacity: int = SEQUENCE_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """All documents packed: one row for each piece."""
    return pack(pieces(docs, capacity, tokenizer), capacity)
