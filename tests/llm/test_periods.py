import hashlib
import random
import zlib

import numpy as np
from cases import LONG, awkward, by_key
from hypothesis import given, settings
from hypothesis import strategies as st

from sievemark.llm import periods as p


def brute(words):
    """Runs by comparing all words with those q places on, for every q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            if at > start and at + q - start >= max(12, 2 * q):
                found.setdefault((start, at + q), q)
            at += at == start
    return sorted((start, end - start, q) for (start, end), q in found.items())


def digest(key, text):
    """A row of the query by brute force."""
    words = (text or "").encode().split()
    value = zlib.crc32(str(key).encode())
    if key is not None and value % 10 == 0 and words:
        g = value // 10
        a = g % len(words)
        step = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % step] for i in range(len(words))]
    runs = brute(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return {
        "doc_id": key,
        "n_runs": len(runs),
        "start": best[0],
        "length": best[1],
        "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(kept).hexdigest(),
    }


words = st.integers(1, 3).flatmap(lambda k: st.lists(st.integers(0, k), max_size=40))
documents = st.lists(st.tuples(words, st.integers(0, 39), st.integers(1, 5)), max_size=5)


@settings(max_examples=300, deadline=None)
@given(documents)
def test_runs_are_those_of_brute_force(made):
    lists = [w[:at] + w[at:] * times for w, at, times in made]
    found = p.runs_of([np.array(w, dtype=np.int64) for w in lists])
    assert found == [brute(w) for w in lists]


def test_much_repetition_takes_little_work():
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 3000:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    blocks = sum(([at + 1, *[0] * 40] for at in range(60)), [])
    for made in ([0] * 3000, [0, 1, 2, 3, 4] * 500, fibonacci[1], blocks, blocks + blocks):
        assert p.runs_of([np.array(made)]) == [brute(made)]
    (run,) = p.runs_of([np.zeros(200_000, dtype=np.int64)])[0]
    assert run == (0, 200_000, 1)


def texts(draw):
    made = []
    for _ in range(60):
        line = [draw.choice(["a", "b", "é", "漢", "x y", "z\x1c"]) for _ in range(draw.randrange(1, 9))]
        made.append(draw.choice([" ", "\t", "\r\n", " \v\f "]).join(line * draw.randrange(1, 12) + ["end"] * draw.randrange(0, 15)))
    return made


def test_query_matches_brute_force(text_spark, monkeypatch):
    monkeypatch.setattr(p, "BATCH_BYTES", 300)
    docs = awkward(text_spark, texts(random.Random(3)), [(-5, "a b " * 30), (10**15, "q " * 13)]).filter("length(text) < 9999 OR text IS NULL")
    found = by_key(p.planted_runs(docs))
    rows = docs.collect()
    assert {r["doc_id"]: found[r["doc_id"]] for r in rows} == {r["doc_id"]: digest(r["doc_id"], r["text"]) for r in rows}
    assert sum(zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in rows) > 3


def test_operator_keeps_texts_as_they_are(text_spark):
    docs = awkward(text_spark, texts(random.Random(4)) + ["one  two " * 20])
    found = by_key(p.periodic_runs(docs))
    assert found[1]["collapsed"] == found[2]["collapsed"] == found[3]["collapsed"] == "" and found[1]["runs"] == []
    assert found[4] == {"doc_id": 4, "runs": [{"start": 0, "length": 200_000, "period": 5}], "collapsed": " ".join(LONG.split()[:5])}
    assert found[160]["collapsed"] == "one two"
    for row in docs.filter("doc_id >= 100").collect():
        own = row["text"].encode().split()
        assert [tuple(r.values()) for r in found[row["doc_id"]]["runs"]] == brute(own)
    assert p.periodic_runs(docs.filter("false")).count() == 0 and p.planted_runs(docs.filter("false")).count() == 0
