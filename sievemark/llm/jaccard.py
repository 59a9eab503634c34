"""Near-duplicate documents by the Jaccard similarity of their word shingles.

Texts become runs of words (as `contamination` has them); a shingle is five words in a row, and a text of fewer words is
one shingle. Documents with equal shingle sets are one class of copies, and only classes are compared.

Candidates come from a MinHash forest: each tree orders the classes by its own run of minimum hashes, so that classes
under one node share a prefix of the run. Prefixes start at full depth and are shortened until pairs at the similarity
wanted share one in some tree with the target probability. Classes that share a node are joined to the node's first
class, and connected candidates form groups; inside a group every pair is verified on the whole sets, in blocks, so that
no list of pairs is ever written. A group of any size is dealt out as pairs of bounded blocks.

Null, empty and wordless texts have no shingles and are linked to nothing. Equal rows are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.contamination import words_of
from sievemark.llm.inputs import held, id_and_text, texts_of
from sievemark.llm.links import components, in_blocks, roots
from sievemark.sources.tables import materialise

SHINGLE_WORDS, SIMILARITY = 5, 0.8
TREES, DEPTH, TARGET_RECALL = 16, 6, 0.9995
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 500_000
_CHUNK = 1_000_000  # bytes of words hashed at once

_random = np.random.default_rng(2024)
_BYTE_VALUES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _random.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    length = max(1 << (size - 1).bit_length(), 2 * _CHUNK)
    return held("jaccard", length, lambda: (_powers(_BASE, length), _powers(pow(_BASE, -1, 1 << 64), length)))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _hashed(runs: list[bytes]) -> list[np.ndarray]:
    """Distinct shingle hashes of texts given as words each followed by a space. The hash of a run of bytes is a
    difference of prefix sums, so each byte is read once however many shingles hold it."""
    raw = np.frombuffer(b"".join(runs), dtype=np.uint8)
    up, down = _power_tables(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], dtype=np.uint64)])
    ends = np.flatnonzero(raw == 0x20) + 1
    lengths = np.array([len(run) for run in runs])
    limits = np.cumsum(lengths)
    counts = np.searchsorted(ends, limits, side="right")
    sets, done = [], 0
    for limit, length, count in zip(limits, lengths, counts):
        own = ends[done:count]
        starts = np.concatenate([[limit - length], own[:-1]])
        size = min(SHINGLE_WORDS, len(own))
        if size:
            first, last = starts[: len(own) - size + 1], own[size - 1 :]
            sets.append(np.unique(_mixed((sums[last] - sums[first]) * down[first])))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
        done = count
    return sets


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    held, size = [], 0
    for text in texts:
        words = words_of(text)
        held.append(b" ".join([*words, b""]) if words else b"")
        size += len(held[-1])
        if size >= _CHUNK:
            yield from _hashed(held)
            held, size = [], 0
    if held:
        yield from _hashed(held)


def prefix_length(similarity: float = SIMILARITY, target: float = TARGET_RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """Prefixes shortened from full depth until a pair at this similarity shares one in some tree with the target probability."""
    length = depth
    while length > 1 and 1 - (1 - similarity**length) ** trees < target:
        length -= 1
    return length


def signature(sets: list[np.ndarray], length: int) -> np.ndarray:
    """First `length` minimum hashes of each tree for sets that are not empty: sets x (trees * length)."""
    values = np.concatenate(sets)
    firsts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    chosen = [_SEEDS[tree * DEPTH + level] for tree in range(TREES) for level in range(length)]
    found = np.empty((len(sets), len(chosen)), dtype=np.uint32)
    for at, seed in enumerate(chosen):
        found[:, at] = np.minimum.reduceat(((values * seed) >> np.uint64(32)).astype(np.uint32), firsts)
    return found


def _nodes(sets: list[np.ndarray], length: int) -> np.ndarray:
    """Number of the node at prefix length in each tree: sets x trees."""
    runs = signature(sets, length).reshape(len(sets), TREES, length).astype(np.uint64)
    number = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), (len(sets), TREES)) * np.uint64(_BASE)
    for level in range(length):
        number = _mixed((number ^ runs[:, :, level]) * np.uint64(0x94D049BB133111EB))
    return number.view(np.int64)


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, length: int) -> DataFrame:
    """Set key, number of shingles and forest nodes of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = list(shingle_sets(texts_of(batch)))
                full = [s for s in sets if len(s)]
                nodes = iter(_nodes(full, length).tolist() if full else [])
                columns = [
                    batch.column("doc_id"),
                    pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([next(nodes) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "set_key", "n_shingles", "nodes"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, set_key binary, n_shingles long, nodes array<bigint>")


def classes_of(sketched: DataFrame) -> DataFrame:
    """One row for each shingle set: its first document, number of documents, shingles and nodes."""
    return sketched.filter("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("nodes").alias("nodes")
    )


def candidate_groups(classes: DataFrame) -> DataFrame:
    """Groups of classes connected by shared nodes: class_id, group. Classes alone in all their nodes are left out."""
    placed = classes.select("class_id", F.explode("nodes").alias("node"))
    heads = placed.groupBy("node").agg(F.min("class_id").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    edges = placed.join(heads, "node").select(F.col("class_id").alias("a"), F.col("head").alias("b"))
    found = components(edges)
    return found.select(F.col("node").alias("class_id"), F.col("component").alias("group")).union(
        found.select(F.col("component").alias("class_id"), F.col("component").alias("group")).distinct()
    )


def links_between(sets: list[np.ndarray], others: list[np.ndarray] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, column) of linked sets, of one list among themselves (row < column) or between two lists.

    Intersections are products of 0/1 tables over the shingles that more than one set holds, a slice of columns at a time.
    """
    every = sets if others is None else sets + others
    sizes = np.array([len(s) for s in every], dtype=np.int64)
    owner = np.repeat(np.arange(len(every)), sizes)
    values = np.concatenate(every)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    n = len(sets)
    rows_from = 0 if others is None else n
    common = np.zeros((n, len(every) - rows_from), dtype=np.float32)
    wide = max(1, 8_000_000 // max(1, len(every)))
    for low in range(0, int(shared.sum()), wide):
        inside = (column >= low) & (column < low + wide)
        table = np.zeros((len(every), wide), dtype=np.float32)
        table[owner[inside], column[inside] - low] = 1
        common += table[:n] @ table[rows_from:].T
    union = sizes[:n, None] + sizes[None, rows_from:] - common
    linked = common >= similarity * union - 1e-9 * union
    if others is None:
        linked = np.triu(linked, 1)
    return np.nonzero(linked)


def _verify(similarity: float):
    """Verified links inside a bucket of candidate blocks: for each class the documents linked, and a tree of links."""

    def run(batch: pa.Table) -> pa.Table:
        ids, sides = batch.column("class_id").to_numpy(), batch.column("side").to_numpy()
        copies, group = batch.column("copies").to_numpy(), batch.column("group").to_numpy()
        sets = [np.frombuffer(value, dtype=np.uint64) for value in batch.column("shingles").to_pylist()]
        across = batch.column("low")[0].as_py() != batch.column("high")[0].as_py()
        order = np.lexsort((ids, sides, group))
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for rows in np.split(order, cuts):
            rows = rows[np.concatenate([[True], ids[rows][1:] != ids[rows][:-1]])]  # a repeated document once
            left, right = rows[sides[rows] == 0], rows[sides[rows] == 1]
            a, b = (), ()
            if len(left) and (len(right) or not across):
                a, b = links_between([sets[r] for r in left], [sets[r] for r in right] if across else None, similarity)
            own = np.concatenate([left, right])
            b = np.asarray(b, dtype=np.int64) + (len(left) if across else 0)
            a = np.asarray(a, dtype=np.int64)
            linked = np.bincount(a, copies[own][b], len(own)) + np.bincount(b, copies[own][a], len(own))
            out.append((ids[own], linked.astype(np.int64), ids[own][roots(len(own), a, b)]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table({"class_id": columns[0], "linked": columns[1], "root": columns[2]})

    return run


def class_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Verified links of candidate classes: class_id, linked (documents of other classes), root (a class of the same tree).

    A group within one block goes to a bucket with others; a larger one is cut into blocks, and each pair of its blocks
    is a bucket, so a class goes to as many buckets as its group has blocks.
    """
    members = groups.join(classes.select("class_id", "set_key", "copies", "n_shingles"), "class_id")
    sizes = members.groupBy("group").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    members = members.join(sizes.select("group", blocks.alias("blocks"), "weight"), "group")
    total = sizes.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("total")).first()["total"]
    buckets = max(16, -(-total // BLOCK_SHINGLES))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sets = list(shingle_sets(texts_of(batch)))
                same = pa.array([_key(s) == key for s, key in zip(sets, batch.column("set_key").to_pylist())])
                column = pa.array([s.tobytes() for s in sets], pa.binary())
                yield batch.drop_columns(["text", "set_key"]).append_column("shingles", column).filter(same)

    texts = id_and_text(docs).withColumnRenamed("doc_id", "class_id").join(members.drop("n_shingles", "weight"), "class_id")
    kinds = "class_id long, group long, copies long, blocks int, shingles binary"
    whole = texts.select("class_id", "group", "copies", "blocks", "text", "set_key").mapInArrow(run, kinds)
    dealt = in_blocks(whole, "class_id", "group", buckets)
    return dealt.groupBy("bucket", "low", "high").applyInArrow(_verify(similarity), "class_id long, linked long, root long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, target: float = TARGET_RECALL) -> DataFrame:
    """One row a document: doc_id, copy_id (first document with the same shingles), class_id (first document of its
    component of links), n_links (other documents with at least the similarity, copies among them)."""
    sketched = materialise(sketches(docs, prefix_length(similarity, target)))
    classes = materialise(classes_of(sketched))
    groups = materialise(candidate_groups(classes))
    found = materialise(class_links(docs, classes, groups, similarity))
    linked = found.groupBy("class_id").agg(F.sum("linked").alias("linked"))
    joined = components(found.filter("class_id <> root").select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    by_class = (
        classes.select("set_key", F.col("class_id").alias("copy_id"), "copies")
        .join(linked.withColumnRenamed("class_id", "copy_id"), "copy_id", "left")
        .join(joined.withColumnRenamed("node", "copy_id"), "copy_id", "left")
    )
    every = sketched.select("doc_id", "set_key").join(by_class, "set_key", "left")
    return every.select(
        "doc_id",
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("component", "copy_id", "doc_id").alias("class_id"),
        (F.coalesce("linked", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
    )
