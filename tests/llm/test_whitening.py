import math
import random

import numpy as np
import pytest

from sievemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, index int, x string, z double, part int, deviation int"


def frame(spark, rows):
    return spark.createDataFrame([(key, vector, 1, 3, "x", 0.5, 1, 2) for key, vector in rows], SCHEMA).repartition(3)


def brute(rows):
    """Results in plain numpy and whole numbers: by row, and the shares of the components."""
    good = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for _, v in good]
    listed = np.array(sorted(set(x)), dtype=float)
    n, sums = len(listed), [sum(v[at] for v in set(x)) for at in range(len(x[0]))]
    centred = listed - listed.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (np.array(x, dtype=float) - listed.mean(axis=0)) @ vectors[:, :4] / np.sqrt(np.maximum(values[:4], 1e-300))
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return [k for k, _ in good], z, deviations, values[:4] / values.sum(), n


def vectors(count, size, seed=1):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(count, size)) @ draw.normal(size=(size, size)) * 0.3 + 0.1).astype(np.float32).tolist()


@pytest.mark.parametrize("block", [1024, 7])
def test_components_are_those_of_numpy(text_spark, block, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", block)
    monkeypatch.setattr(whitening, "COLUMNS_PER_BLOCK", 1024 if block == 1024 else 3)
    made = vectors(60, 9)
    rows = list(enumerate(made)) + [(100 + at, made[0]) for at in range(40)]  # copies are fitted once
    rows += [(200, None), (201, [None] * 9), (202, [float("nan")] * 9), (203, [float("inf")] * 9), (204, [1.0] * 3), (205, []), (None, made[1]), (7, made[2])]
    found = whitening.whitened_vectors(frame(text_spark, rows)).collect()
    keys, z, deviations, shares, n = brute([(k, v) for k, v in rows if k not in (204, 205)])
    assert len(found) == 4 * len(keys)
    wanted = sorted((repr(k), d, at + 1) for k, d in zip(keys, deviations) for at in range(4))
    assert sorted((repr(r["vec_id"]), r["deviation"], r["component"]) for r in found) == wanted
    by = {(k, d): row for k, d, row in zip(keys, deviations, z)}
    signs = {}
    for r in found:
        want = by[r["vec_id"], r["deviation"]][r["component"] - 1]
        assert abs(abs(r["whitened"]) - abs(want)) < 1e-7
        if abs(want) > 1e-3:
            assert signs.setdefault(r["component"], np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
        assert abs(r["explained"] - shares[r["component"] - 1]) < 1e-9
        assert r["n"] == n and r["identity_error"] < 1e-9


def test_same_results_for_any_partitioning(text_spark):
    rows = list(enumerate(vectors(50, 5, 4)))
    a, b = (
        {(r["vec_id"], r["component"]): (r["deviation"], round(r["whitened"], 7)) for r in whitening.whitened_vectors(frame(text_spark, rows).repartition(parts)).collect()}
        for parts in (1, 5)
    )
    assert a == b


def test_empty_tables_and_vectors_without_variance(text_spark):
    assert whitening.whitened_vectors(frame(text_spark, [(1, [1.0])]).filter("false")).collect() == []
    assert whitening.whitened_vectors(frame(text_spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whitened_vectors(frame(text_spark, [(1, [0.5, -0.25]), (1, [0.5, -0.25])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.whitened_vectors(frame(text_spark, [(1, [0.0, 3.0]), (2, [1.0, 3.0]), (3, [2.0, 3.0])])).collect()
    assert {r["component"]: r["explained"] for r in flat} == {1: 1.0, 2: 0.0}
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["identity_error"] < 1e-12 for r in flat)


def test_deviations_stay_exact_beyond_a_long(text_spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.0])]
    _, _, deviations, _, _ = brute(rows)
    exact = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(text_spark, rows)).collect()}
    assert [int(exact[k]) for k in (1, 2, 3)] == deviations and deviations[0] > 1 << 63
    as_long = {r["vec_id"]: r["deviation"] for r in whitening.whitened_vectors(frame(text_spark, rows)).collect()}
    assert as_long == {k: d if d < 1 << 63 else None for k, d in zip((1, 2, 3), deviations)}
    random.seed(0)
    assert whitening.whitened_vectors(frame(text_spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0])])).count() == 4
