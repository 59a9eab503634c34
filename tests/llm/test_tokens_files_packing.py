import random
import zlib

import numpy as np
import pytest
from cases import LONG, awkward, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from sievemark.llm import id_files, packing
from sievemark.llm.tokens import Encoder, default_path
from sievemark.sources.tables import scratch_path


@pytest.fixture(scope="module")
def encode():
    return Encoder(default_path())


def whole_ids(encode, text):
    return np.frombuffer(encode.encode_whole(text or ""), "<u4").tolist() + [1]


def test_cached_words_give_the_tokenizers_ids(encode):
    draw = random.Random(1)
    letters = "abcAB'sStTrRelLvV m<|>endoftext09²¼é́İıß  \x1c\x85​\n\t_-!*$’…ŒœſǅΣς漢字🙂­ªµ÷×"
    parts = ["<|endoftext|>", "<|startoftext|>", "'ll", "'RE", "don't", "word***", "A’s"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) if draw.random() < 0.05 else draw.choice(letters) for _ in range(draw.randrange(25)))
        assert encode.encode(text) == encode.encode_whole(text), repr(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from([id_files.BYTE_PLANES, id_files.BIT_PLANES]), st.integers(1, 70))
def test_segments_round_trip(ids, kind, block):
    ids = np.array(ids, dtype="<u4")
    assert (id_files.unpack_segment(id_files.pack_segment(ids, kind, block)) == ids).all()


def test_a_file_of_another_format_is_refused():
    with pytest.raises(ValueError):
        id_files.unpack_segment(b"x" * 40)


@pytest.mark.parametrize("kind", [id_files.BYTE_PLANES, id_files.BIT_PLANES])
def test_stored_ids_come_back_in_key_order(text_spark, encode, kind, monkeypatch):
    monkeypatch.setattr(id_files, "SEGMENT_IDS", 50)
    docs = awkward(text_spark, ["a b c " * at for at in range(30)])
    path = scratch_path(text_spark)
    id_files.write_ids(docs, path, kind=kind)
    found = sorted(id_files.read_ids(text_spark, path).collect(), key=lambda r: r["start"])
    wanted = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in found] == [key for key, _ in wanted]
    start = 0
    for row, (_, text) in zip(found, wanted):
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert row["start"] == start and ids == whole_ids(encode, text)
        start += len(ids)
    digest = {r["start"]: r for r in id_files.id_digest(text_spark, path).collect()}
    assert all(digest[r["start"]]["ids_crc32"] == zlib.crc32(r["ids"]) for r in found)


def test_no_documents_give_no_ids(text_spark):
    path = scratch_path(text_spark)
    id_files.write_ids(awkward(text_spark).filter("false"), path)
    assert id_files.id_digest(text_spark, path).count() == 0


def check_packing(rows, capacity):
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for held in sequences.values():
        held.sort()
        ends = np.cumsum([length for _, length in held])
        assert [offset for offset, _ in held] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(sequences)


def test_pieces_cover_each_document_and_sequences_have_no_gaps(text_spark, encode):
    docs = awkward(text_spark, ["word " * (at % 60) for at in range(200)])
    rows = rows_of(packing.packed_documents(docs, capacity=64))
    by_doc = {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], set()).add((row["start"], row["length"], row["ids_crc32"]))
    for doc in docs.collect():
        ids = np.array(whole_ids(encode, doc["text"]), "<u4")
        wanted = {(at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())) for at in range(0, len(ids), 64)}
        assert by_doc[doc["doc_id"]] == wanted
    total = sum(row["length"] for row in rows)
    assert check_packing(rows, 64) <= -(-total // 64) + 2
    assert len(LONG) > 64


def test_empty_tables_pack_to_nothing(text_spark):
    assert packing.packed_documents(awkward(text_spark).filter("false")).count() == 0


def test_exchanges_empty_bins():
    # Best fit decreasing opens four bins here; three hold everything.
    lengths = np.array([44, 32, 31, 30, 27, 25, 25, 22, 22, 20, 22])
    first = packing.best_fit(lengths, 100)
    better = packing.improve(lengths, first, 100)
    assert np.bincount(better, lengths).max() <= 100
    used = lambda bins: len(set(bins.tolist()))
    assert used(better) <= used(first)
    square = lambda bins: (np.bincount(bins, lengths) ** 2).sum()
    assert square(better) >= square(first)


def best_exchange(lengths, bins, capacity, source):
    """Greatest rise of the squared fills by giving one or two pieces of a bin for nothing or for one piece, all tried."""
    fills = np.bincount(bins, lengths)
    own = np.flatnonzero(bins == source)
    best = 0
    for given in [[i] for i in own] + [[i, j] for i in own for j in own if i < j]:
        for target in np.flatnonzero((fills > 0) & (fills < capacity)):
            if target == source:
                continue
            for back in [None, *np.flatnonzero(bins == target)]:
                gain = lengths[given].sum() - (0 if back is None else lengths[back])
                after = fills[target] + gain
                if gain > 0 and after <= capacity:
                    best = max(best, after**2 + (fills[source] - gain) ** 2 - fills[target] ** 2 - fills[source] ** 2)
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=70), st.integers(20, 60))
def test_no_exchange_is_left(lengths, capacity):
    """Bins of many small pieces too: every pair of them is looked at."""
    lengths = np.array(lengths)
    bins = packing.improve(lengths, packing.best_fit(lengths, capacity), capacity)
    fills = np.bincount(bins, lengths)
    for source in np.flatnonzero((fills > 0) & (fills < capacity)):
        assert best_exchange(lengths, bins, capacity, source) <= 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_local_search_keeps_every_piece_within_capacity(lengths):
    lengths = np.array(lengths)
    bins = packing.improve(lengths, packing.best_fit(lengths, 50), 50)
    assert len(bins) == len(lengths) and np.bincount(bins, lengths).max() <= 50
