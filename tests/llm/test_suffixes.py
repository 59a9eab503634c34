import random

import numpy as np
import pytest
from cases import LONG, awkward
from hypothesis import given, settings
from hypothesis import strategies as st

from sievemark.llm import suffixes as s


def brute(rows):
    """Removed bytes of each (key, text): windows that a row with a smaller key has."""
    found = {}
    for key, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        if key is not None:
            earlier = {b[at : at + s.LENGTH] for k, t in rows if k is not None and k < key for b in [(t or "").encode()] for at in range(len(b) - s.LENGTH + 1)}
            for at in range(len(raw) - s.LENGTH + 1):
                if raw[at : at + s.LENGTH] in earlier:
                    gone[at : at + s.LENGTH] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        found[key, text] = (len(raw), int(gone.sum()), spans, s.digest(kept))
    return found


def texts_with_passages(draw, n):
    passages = ["".join(draw.choice("abé ") for _ in range(draw.randrange(45, 160))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = ["".join(draw.choice("xyzü\n") for _ in range(draw.randrange(0, 90))) for _ in range(3)]
        for _ in range(draw.randrange(0, 3)):
            passage = draw.choice(passages)
            cut = draw.randrange(0, 20)
            parts.insert(draw.randrange(len(parts)), passage[cut : len(passage) - draw.randrange(0, 20)])
        texts.append("".join(parts))
    return texts + texts[:5] + ["ab" * 100, "ab" * 90, "z" * 300, "z" * 49, "z" * 50]


@pytest.mark.parametrize("shard_bytes", [10_000_000, 1500])
def test_repeats_are_those_of_brute_force(text_spark, shard_bytes, monkeypatch):
    monkeypatch.setattr(s, "TEXT_PIECE", 120 if shard_bytes == 1500 else 1 << 20)
    texts = texts_with_passages(random.Random(6), 50)
    docs = awkward(text_spark, texts, [(101, "another row of this key " * 9), (300, "another row of this key " * 8)]).filter("length(text) < 9999 OR text IS NULL")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted = brute(rows)
    found = s.repeated_text(docs, shard_bytes, 4000).collect()
    assert sorted((repr(r["doc_id"]), *tuple(r)[1:]) for r in found) == sorted((repr(k), *wanted[k, t]) for k, t in rows)


def test_a_passage_in_every_document(text_spark):
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdef gh") for _ in range(400))
    rows = [(key, f"{key} only here {key * 7}" + passage[key % 5 :] + f"{key}") for key in range(300)]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = brute(rows)
    found = s.repeated_text(docs, 2000, 4000).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == {k: wanted[k, t] for k, t in rows}


def test_long_and_awkward_documents(text_spark):
    found = {r["doc_id"]: r for r in s.repeated_text(awkward(text_spark, [LONG])).collect()}
    assert found[4]["n_removed"] == 0 and found[100]["n_removed"] == len(LONG) and found[100]["n_spans"] == 1
    assert found[1]["n_bytes"] == 0 and found[1]["kept_sha256"] == s.digest(b"")
    assert s.repeated_text(awkward(text_spark).filter("false")).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=400).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 60))
def test_suffix_order_and_common_prefixes(data, depth):
    text = np.frombuffer(data + b"\x01" * 60, dtype=np.uint8)
    starts = np.arange(len(data))
    words = s.words_at(text)
    order = s.suffix_array(text, words, starts, max(depth, 9))
    raw = text.tobytes()
    keys = [raw[at : at + max(depth, 9)] for at in order]
    assert sorted(order.tolist()) == starts.tolist() and keys == sorted(keys)
    shared = s.common_prefixes(words, order)
    for before, at, got in zip(order[:-1], order[1:], shared[1:]):
        wanted = 0
        while max(before, at) + wanted < len(raw) and raw[before + wanted] == raw[at + wanted]:
            wanted += 1
        assert got == wanted


def test_equal_windows_have_equal_anchors():
    draw = random.Random(2)
    middle = bytes(draw.randrange(256) for _ in range(300))
    texts = [bytes(draw.randrange(256) for _ in range(n)) + middle for n in (0, 77, 1000)]
    found = []
    for text in texts:
        first, count, anchor = s.runs_of(np.frombuffer(text, np.uint8), np.array([len(text)]))
        windows = {f + at: a for f, c, a in zip(first, count, anchor) for at in range(c)}
        assert len(windows) == len(text) - s.LENGTH + 1
        found.append([windows[len(text) - 300 + at] for at in range(251)])
    assert found[0] == found[1] == found[2]
