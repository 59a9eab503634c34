"""Documents that hold passages of test questions and answers.

Texts are lower-cased (A to Z) and reduced to their words: runs of letters, digits and all characters outside ASCII.
A window is ten consecutive words of an item; an item with fewer words is one window, an item without words has none.
All windows of all items stand in one Aho-Corasick automaton, and every document passes through it once. The ends of
matches are word numbers of the document, which lead back to its characters.

Null texts have no words. Items that are equal, or share windows, are all reported.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.inputs import held, id_and_text, texts_of, with_columns
from sievemark.sources.tables import materialise

WINDOW_WORDS = 10
AUTOMATON_BYTES = 4_000_000

# The bytes of UTF-8 that make up words, lower-cased; all others separate words.
_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(low if (low := ord(chr(b).lower()) if 0x41 <= b <= 0x5A else b) in _WORD_BYTES else 0x20 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

HIT_SCHEMA = "_n_words long, _hit_words array<int>, _item_ids array<string>"
_HIT_COLUMNS = ("_n_words", "_hit_words", "_item_ids")


def words_of(text: str) -> list[bytes]:
    """Words of a text in order."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows_of(text: str, size: int = WINDOW_WORDS) -> set[str]:
    """Windows of an item, its words between single spaces."""
    words = words_of(text)
    return {_joined(words[at : at + size]) for at in range(max(1, len(words) - size + 1))} if words else set()


def _joined(words: list[bytes]) -> str:
    # Latin-1 gives one character a byte, so automaton places are byte places.
    return f" {b' '.join(words).decode('latin-1')} "


def automaton(items: tuple[tuple[str, str], ...], size: int):
    """Automaton over the windows of the items; each window leads to its number of words and its items."""
    import ahocorasick

    owners: dict[str, set[str]] = defaultdict(set)
    for item_id, text in items:
        for window in windows_of(text, size):
            owners[window].add(item_id)
    found = ahocorasick.Automaton()
    for window, ids in owners.items():
        found.add_word(window, (window.count(" ") - 1, sorted(ids)))
    if owners:
        found.make_automaton()
    return found


def scan(text: str, found) -> tuple[int, np.ndarray, list[str]]:
    """Number of words of a text, the words inside matches, and the items matched."""
    words = words_of(text)
    if not words or not len(found):
        return len(words), np.empty(0, dtype=np.int32), []
    joined = _joined(words)
    matches = list(found.iter(joined))
    if not matches:
        return len(words), np.empty(0, dtype=np.int32), []
    spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), dtype=np.uint8) == 0x20)
    after = np.searchsorted(spaces, [end for end, _ in matches])  # words before the closing space
    sizes = np.array([length for _, (length, _) in matches])
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, after - sizes, 1)
    np.add.at(steps, after, -1)
    hit = np.flatnonzero(np.cumsum(steps[:-1]) > 0).astype(np.int32)
    return len(words), hit, sorted({item for _, (_, ids) in matches for item in ids})


def block_count(items: DataFrame, most_bytes: int = AUTOMATON_BYTES) -> int:
    """Blocks of about `most_bytes` of text that the items make; a benchmark of usual size is one."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("total")).first()["total"]
    return max(1, -(-total // most_bytes))


def with_passages(rows: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, most_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The rows with the number of words of their text (`_n_words`), the numbers of the words inside benchmark windows
    (`_hit_words`) and the items of these (`_item_ids`).

    Each block of items is one automaton and one pass; the driver and a task hold one block at a time. A benchmark of several
    blocks has its rows stored between passes.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    count = block_count(items, most_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    found = rows
    for at in range(count):
        of_block = tuple(sorted((r["item_id"], r["text"]) for r in items.filter(block == at).toLocalIterator()))
        found = _pass(found, of_block, size, first=at == 0)
        found = found if at == count - 1 else materialise(found)
    return found


def _pass(rows: DataFrame, items: tuple[tuple[str, str], ...], size: int, first: bool) -> DataFrame:
    """One pass of the rows through the automaton of some items, added to what earlier passes found."""
    name = hashlib.blake2b(repr((size, items)).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    if first:

        def make(texts: list[str]) -> list[pa.Array]:
            found = held("contamination", name, lambda: automaton(items, size))
            return _columns([scan(text, found) for text in texts])

        return with_columns(rows, HIT_SCHEMA, make)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = held("contamination", name, lambda: automaton(items, size))
            before = zip(batch.column("_hit_words").to_pylist(), batch.column("_item_ids").to_pylist())
            merged = []
            for (hit, ids), text in zip(before, texts_of(batch)):
                n, also, others = scan(text, found)
                merged.append((n, np.union1d(np.array(hit, dtype=np.int32), also), sorted({*ids, *others})))
            for column, values in zip(_HIT_COLUMNS, _columns(merged)):
                batch = batch.set_column(batch.schema.get_field_index(column), column, values)
            yield batch

    return rows.mapInArrow(run, rows.schema)


def _columns(found: list[tuple[int, np.ndarray, list[str]]]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]
    return [pa.array([row[at] for row in found], kind) for at, kind in enumerate(kinds)]


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, most_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Words, hit words and items of each document: doc_id, n_words, hit_words, item_ids."""
    found = with_passages(id_and_text(docs), benchmark, size, most_bytes).drop("text")
    return found.withColumnsRenamed({name: name[1:] for name in _HIT_COLUMNS})


def spans_of(text: str, hit_words: Iterable[int]) -> list[tuple[int, int]]:
    """Characters of the original text (start, end) that runs of hit words cover."""
    places = [match.span() for match in _WORD.finditer(text)]
    spans: list[list[int]] = []
    last = -2
    for word in hit_words:
        if word == last + 1:
            spans[-1][1] = places[word][1]
        else:
            spans.append(list(places[word]))
        last = word
    return [tuple(span) for span in spans]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words and items of each document, the item list as a digest."""
    hits = find_passages(docs, benchmark)
    return hits.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def digest(item_ids: Iterable[str]) -> str:
    """Digest of an item list as `contamination` gives it."""
    return hashlib.sha256(",".join(sorted(item_ids)).encode()).hexdigest()
