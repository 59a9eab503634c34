import random
from collections import defaultdict

import numpy as np
import pytest
from cases import awkward, by_key

from sievemark.llm import jaccard, links, vectors
from sievemark.llm.contamination import words_of


def components_of(nodes, pairs):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {node: find(node) for node in nodes}


def test_components(text_spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(40)] + [(at, at + 1) for at in range(100, 130)] + [(200, at) for at in range(201, 260)]
    nodes = {n for pair in pairs for n in pair if pair[0] != pair[1]}
    found = {r["node"]: r["component"] for r in links.components(text_spark.createDataFrame(pairs, "a long, b long")).collect()}
    wanted = components_of(nodes, [p for p in pairs if p[0] != p[1]])
    assert found == {node: low for node, low in wanted.items() if node != low}
    assert links.components(text_spark.createDataFrame([], "a long, b long")).count() == 0
    assert links.roots(5, [4, 3], [3, 1]).tolist() == [0, 1, 2, 1, 1]


def shingles(text):
    words = words_of(text or "")
    return frozenset(tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))) if words else frozenset()


def near_texts(draw):
    base = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    texts = []
    for group in range(8):
        words = [draw.choice(base) for _ in range(draw.randrange(8, 120))]
        for _ in range(draw.randrange(1, 9)):
            copy = list(words)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(base)
            texts.append(" ".join(copy))
            if draw.random() < 0.3:
                texts.append(" ".join(copy).upper() + "!")
    return texts + ["a b", "A, b", "a b c", "a"]


@pytest.mark.parametrize("block", [1024, 3])
def test_near_duplicates_are_those_of_brute_force(text_spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", block)
    docs = awkward(text_spark, near_texts(random.Random(9))).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    pairs = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    counts = defaultdict(int)
    for a, b in pairs:
        counts[a] += 1
        counts[b] += 1
    wanted = components_of(sets, pairs)
    found = by_key(jaccard.near_duplicates(docs))
    assert {key: row["class_id"] for key, row in found.items()} == wanted
    assert {key: row["n_links"] for key, row in found.items()} == {key: counts[key] for key in sets}


def test_awkward_documents_are_their_own_class(text_spark):
    found = by_key(jaccard.near_duplicates(awkward(text_spark)))
    assert [found[key]["class_id"] for key in (1, 2, 3, 4, 5, 6, None)] == [1, 2, 3, 4, 5, 5, None]
    assert found[5]["n_links"] == 2 and found[1]["n_links"] == 0
    assert jaccard.near_duplicates(awkward(text_spark).filter("false")).count() == 0


def test_prefixes_shorten_until_the_target():
    lengths = [jaccard.prefix_length(0.8, target) for target in (0.5, 0.99, 0.9995, 1.0)]
    assert lengths == sorted(lengths, reverse=True) and lengths[-1] == 1
    assert 1 - (1 - 0.8 ** lengths[2]) ** jaccard.TREES >= 0.9995


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links string").repartition(3)


def clustered(seed, groups, size, noise, dim=64):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, dim))
    rows = np.concatenate([c + noise * draw.normal(size=(size, dim)) for c in centres])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1024, 7])
def test_vector_links_are_those_of_brute_force(text_spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_VECTORS", block)
    values = np.concatenate([clustered(1, 30, 6, 0.1), clustered(2, 1, 40, 0.05), clustered(3, 60, 2, 0.28)]).astype(np.float32)
    labels = np.arange(len(values)) // 7 % 2
    rows = [(at, v.tolist(), int(label), "x") for at, (v, label) in enumerate(zip(values, labels))]
    rows += [(1000, rows[0][1], rows[0][2], "x"), (1001, None, 0, "x"), (1002, [0.0] * 64, 0, "x"), (1003, rows[0][1], None, "x")]
    rows += [(1004, [float("nan")] * 64, 0, "x"), (1005, [1.0, None], 0, "x"), (1006, [1.0, 0.0], 0, "x"), (1007, [1.0, 0.01], 0, "x"), (1008, [], 0, "x"), (0, rows[0][1], rows[0][2], "x")]
    good = {r[0]: (np.array(r[1], dtype=float), r[2]) for r in rows if r[0] < 1001 or r[0] in (1006, 1007)}
    pairs = []
    for a, (x, one) in good.items():
        for b, (y, other) in good.items():
            if a < b and one == other and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                pairs.append((a, b))
    wanted = components_of([r[0] for r in rows], pairs)
    found = by_key(vectors.near_vectors(table(text_spark, rows)), "vec_id")
    got = sum(row["n_links"] for row in found.values())
    assert 0.97 * 2 * len(pairs) <= got <= 2 * len(pairs) + 40  # vec_id 0 stands there twice
    assert np.mean([found[key]["component_id"] == wanted[key] for key in wanted]) > 0.97
    for key in (1001, 1002, 1003, 1004, 1005, 1008):
        assert found[key]["n_links"] == 0 and found[key]["kept"]
    assert found[1007]["component_id"] == 1006 and not found[1007]["kept"]


@pytest.mark.parametrize("shared", [1, 2, 3])
def test_long_lists_by_a_second_pivot_find_the_same_links(text_spark, shared, monkeypatch):
    """Few pivots make lists as long as on large tables; taking them apart changes no link."""
    values = np.concatenate([clustered(5, 12, 25, 0.25), clustered(6, 200, 2, 0.3)]).astype(np.float32)
    rows = table(text_spark, [(at, v.tolist(), 0, "x") for at, v in enumerate(values)])

    def found():
        return by_key(vectors.near_vectors(rows, cosine=0.8, shared=shared, count=24), "vec_id")

    whole = found()
    monkeypatch.setattr(vectors, "BLOCK_VECTORS", 20)
    classes = vectors.classes_of(vectors.usable(rows))
    listed = vectors.listings(vectors.described(classes, vectors.pivots_of(classes, 24)), shared)
    sizes = [(r["second"] >= 0, r["count"]) for r in listed.groupBy("list", "second").count().collect()]
    assert found() == whole and sum(row["n_links"] for row in whole.values()) > 1000
    assert any(taken for taken, _ in sizes) == (shared > 1)
    if shared > 1:
        assert all(size <= 20 for taken, size in sizes if not taken)


def test_no_vectors(text_spark):
    assert vectors.near_vectors(table(text_spark, [])).count() == 0
    alone = vectors.near_vectors(table(text_spark, [(1, None, None, "x")])).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in alone] == [(0, 1, True)]


def test_recall_at_the_threshold_itself():
    draw = np.random.default_rng(4)
    rows = vectors.unit(draw.normal(size=(4000, 64)))
    pivots = vectors.thinned(rows[: int(4 * len(rows) ** 0.5)])
    other = draw.normal(size=rows.shape)
    other = vectors.unit(other - (other * rows).sum(axis=1, keepdims=True) * rows)
    near = 0.93 * rows + np.sqrt(1 - 0.93**2) * other
    one, two = vectors.nearest(rows, pivots), vectors.nearest(near, pivots)
    shared = (one[:, :, None] == two[:, None, :]).sum(axis=(1, 2))
    assert (shared >= vectors.SHARED).mean() >= 0.98
